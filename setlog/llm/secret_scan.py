"""Secret scan: patterns, and encoded candidates confirmed by their structure.

Patterns give assigned values, access ids and long hex runs. Beyond them, base64 and hex runs
are decoded and reported only if they parse as a private key (nested lengths that fill each
other exactly, the key's fields in order), an OpenSSH key or a signed token (a JSON header that
names its algorithm, a JSON body). A key glued to a path or name, or wrapped over lines without marks,
is cut out by the length that its own encoding states. Spans are code points, end exclusive.
"""

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setlog.llm.text import small

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "key", "jwt")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN, CODED_MIN = 6, 20, 24, 32

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_ANY = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){24,}(?![0-9A-Fa-f])")
CODED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}")
JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{12,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
BREAK = r"(?:\s|\\[nr])"
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----"
                 rf"((?:{BREAK}*+[A-Za-z][A-Za-z0-9-]*+:(?:(?!-----)[^\n\\])*+)*+)"
                 r"([A-Za-z0-9+/=\s\\]*)-----END \1-----")
DEK = re.compile(r"DEK-Info:[ \t]*[A-Za-z0-9-]+,[0-9A-Fa-f]{16,}")
#: Encoded lines, all but the last of ``CODED_MIN`` characters or more.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/=])(?:[A-Za-z0-9+/]{32,}+(?:[ \t]*+\r?\n[ \t]*+|(?:\\r)?\\n))++"
                     r"(?:[A-Za-z0-9+/]++={0,2})?+")
GLUED = re.compile(r"[A-Za-z0-9+/_-]{32,}+")
#: How the encodings of a DER sequence and of an OpenSSH key begin.
KEY_START = re.compile(r"M[C-I]|b3BlbnNzaC1rZXktdjE")
SSH_MAGIC = b"openssh-key-v1\0"


def _decoded(run: str) -> bytes | None:
    plain = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, body) of the elements that fill ``data`` exactly, or None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size = int.from_bytes(data[at:at + width], "big")
            at += width
        if at + size > len(data):
            return None
        items.append((tag, data[at:at + size]))
        at += size
    return items


def is_private_key(data: bytes) -> bool:
    """DER of a PKCS#1, PKCS#8, encrypted PKCS#8 or SEC1 private key."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    fields = der_items(outer[0][1])
    if not fields:
        return False
    tags = [tag for tag, _ in fields]

    def names_algorithm(body: bytes) -> bool:
        inner = der_items(body)
        return bool(inner) and inner[0][0] == 0x06
    if len(tags) >= 9 and set(tags[:9]) == {0x02}:  # version, modulus, exponents, primes
        return len(fields[0][1]) == 1 and len(fields[1][1]) >= 32
    if tags[:3] == [0x02, 0x30, 0x04]:
        return len(fields[0][1]) == 1 and names_algorithm(fields[1][1])
    if tags == [0x30, 0x04]:
        return names_algorithm(fields[0][1]) and len(fields[1][1]) >= 16
    return tags[:2] == [0x02, 0x04] and fields[0][1] == b"\x01" and len(fields[1][1]) >= 16


def is_openssh_key(data: bytes) -> bool:
    """The magic, then cipher, kdf and options as length-prefixed strings, then the keys."""
    if not data.startswith(SSH_MAGIC):
        return False
    at = len(SSH_MAGIC)
    for _ in range(3):
        size = int.from_bytes(data[at:at + 4], "big")
        at += 4 + size
        if at + 4 > len(data):
            return False
    return int.from_bytes(data[at:at + 4], "big") >= 1


def _bytes_at(run: str, start: int, at: int, n: int) -> bytes:
    """Bytes ``at`` to ``at + n`` of what the run encodes from ``start`` on, fewer at its end."""
    first, skip = start + at // 3 * 4, at % 3
    part = run[first:first + (skip + n + 2) // 3 * 4]
    return (_decoded(part) or b"")[skip:skip + n]


def stated_size(run: str, start: int = 0) -> int:
    """Bytes of the key that begins at ``start``, as its first length or lengths say; 0 if none begins there."""
    if run[start] == "b":
        at, keys = len(SSH_MAGIC), 0
        for k in range(4):  # cipher, kdf, options, number of keys
            field = _bytes_at(run, start, at, 4)
            keys = int.from_bytes(field, "big")
            at += 4 + (keys if k < 3 else 0)
        for _ in range(keys + 1):  # the public keys, then the private part
            field = _bytes_at(run, start, at, 4)
            if len(field) < 4:
                return 0
            at += 4 + int.from_bytes(field, "big")
        return at
    data = _bytes_at(run, start, 0, 7)
    width = data[1] & 0x7F if len(data) == 7 and data[1] & 0x80 else 0
    if len(data) < 7 or data[0] != 0x30 or data[1] == 0x80 or width > 4:
        return 0
    size = int.from_bytes(data[2:2 + width], "big") if width else data[1]
    # A version or a sequence comes first in every key.
    return 2 + width + size if data[2 + width] in (0x02, 0x30) else 0


def keys_within(run: str, lines: frozenset[int] = frozenset()) -> list[tuple[int, int]]:
    """(start, end) of keys at the run's start, at ``lines`` and after its signs, none in another."""
    found, after = [], 0
    for m in KEY_START.finditer(run):
        start = m.start()
        if start < after or (start and run[start - 1].isalnum() and start not in lines):
            continue
        # The lengths tell the end before anything but them is decoded.
        size = stated_size(run, start)
        end = start + -(-size * 8 // 6)
        if not size or end > len(run):
            continue
        data = _decoded(run[start:end])
        if data and (is_private_key(data) or is_openssh_key(data)):
            found.append((start, end))
            after = end
    return found


def is_signed_token(header: str, body: str) -> bool:
    parts = []
    for run in (header, body):
        data = _decoded(run)
        try:
            parts.append(json.loads(data) if data else None)
        except (ValueError, RecursionError):
            return False
    return all(isinstance(p, dict) for p in parts) and isinstance(parts[0].get("alg"), str)


def _hidden_keys(text: str) -> list[tuple[int, int]]:
    """Keys glued to other characters of their run, and keys over several lines."""
    found = set()

    def add(start: int, end: int) -> None:
        found.add((start, end + len(re.match("={0,2}", text[end:end + 2])[0])))
    for m in GLUED.finditer(text):
        for a, b in keys_within(m[0]):
            add(m.start() + a, m.start() + b)
    for m in WRAPPED.finditer(text):
        lines = list(re.finditer(r"[A-Za-z0-9+/]+", re.sub(r"\\[nr]", "  ", m[0])))
        begins = [0, *accumulate(len(x[0]) for x in lines)]

        def place(at: int) -> int:
            k = bisect_right(begins, at) - 1
            return m.start() + lines[k].start() + at - begins[k]
        for a, b in keys_within("".join(x[0] for x in lines), frozenset(begins)):
            add(place(a), place(b - 1) + 1)
    return sorted(found)


def _apart(found: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those of ``found`` that overlap none of ``taken``, themselves disjoint."""
    taken = sorted(taken)
    begins = [a for a, _ in taken]
    return [(a, b) for a, b in found
            if (k := bisect_left(begins, b)) == 0 or taken[k - 1][1] <= a]


def _longest(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans, a longer one before a shorter."""
    kept: list[tuple[int, int]] = []
    for a, b in sorted(set(found), key=lambda s: (s[0] - s[1], s[0])):
        k = bisect_left(kept, (a, b))
        if (k == 0 or kept[k - 1][1] <= a) and (k == len(kept) or kept[k][0] >= b):
            kept.insert(k, (a, b))
    return kept


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind in the order of ``KINDS``."""
    if not text:
        return []
    found = []
    folded = text.lower()
    if any(w in folded for w in ASSIGN_WORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
                  if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= ACCESS_MIN]
    long_run = max(map(len, text.split()), default=0) >= HEX_MIN
    if long_run:
        found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)
                  if m.end() - m.start() >= HEX_MIN]
        coded = [(m, bytes.fromhex(m[0])) for m in HEX_ANY.finditer(text)]
        coded += [(m, _decoded(m[0])) for m in CODED.finditer(text)]
        found += [("key", m.start(), m.end()) for m, data in coded
                  if data and (is_private_key(data) or is_openssh_key(data))]
        found += [("jwt", m.start(), m.end()) for m in JWT.finditer(text)
                  if is_signed_token(m[1], m[2])]
    if "-----BEGIN " in text:
        for m in PEM.finditer(text):
            data = _decoded(re.sub(BREAK, "", m[3]))
            # An encrypted body is whole cipher blocks, and its header says how it was made.
            if data and (is_private_key(data) or is_openssh_key(data)
                         or (DEK.search(m[2]) and len(data) >= 32 and len(data) % 8 == 0)):
                found.append(("pem", m.start(), m.end()))
    if long_run:
        hidden = _apart(_hidden_keys(text), [(a, b) for kind, a, b in found if kind == "pem"])
        # The first line of a wrapped key may parse alone; the whole key stands for it.
        keys = _longest([(a, b) for kind, a, b in found if kind == "key"] + hidden)
        found = [s for s in found if s[0] != "key"] + [("key", a, b) for a, b in keys]
    return sorted(set(found), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and an array of (kind, start, end, value) for every row, empty where none.

    Null and empty texts have none; repeated rows give repeated results; other columns aren't
    looked at. Overlapping kinds are all reported.
    """
    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                   ("end", pa.int64()), ("value", pa.string())]))
        for batch in small(batches):
            rows = [[(k, a, b, x[a:b]) for k, a, b in spans(x)]
                    for x in batch.column("text").to_pylist()]
            made = pa.array([[dict(zip(("kind", "start", "end", "value"), s, strict=True))
                              for s in row] for row in rows], kind)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), made], ["doc_id", "spans"])
    rows = docs.select("doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {id_type}, spans array<struct<kind:string,start:long,end:long,value:string>>")


def listed(spans_: Column) -> Column:
    """``kind:start:end`` of each, comma-joined."""
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
