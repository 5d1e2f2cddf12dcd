"""Main text of web pages by the maximum-scoring subsequence.

A page is a run of words and tags. Words score positive, tags negative: pages that mark
their article (``article`` or ``main``) label all pages' words and tags, and a word weighs the share
of such words that lie inside articles, a tag the share that lies outside. Menus, adverts,
comments and the like, known by tag, role, class or id, are passed over. One linear scan finds the contiguous region with the highest sum;
its blocks are the text. Tags of articles weigh like others. Forms are passed over unless they hold most of
a page's words.
"""

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setlog.llm.text import small

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)/?>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest2>[^>]*)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\b(hidden)\b")
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"}
#: Where a raw element ends, in the page itself: lower case may be longer.
RAW_END = {tag: re.compile(f"</{tag}", re.IGNORECASE | re.ASCII) for tag in RAW}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog",
          "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
          "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre",
          "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul"}
INLINE = {"a", "abbr", "b", "br", "code", "em", "font", "i", "img", "small", "span", "strong",
          "sub", "sup", "td", "th", "u"}
REGIONS = {"article", "main"}
DROPPED = {"head", "nav", "aside", "footer", "form", "button", "select", "option", "label", "svg",
           "math", "canvas", "object", "audio", "video", "dialog", "menu"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "menu", "menubar",
         "dialog", "alert", "form"}
#: First or last part of a class or id that marks what isn't content.
MARKS = {
    "ad", "ads", "adv", "advert", "advertisement", "adverts", "alert", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright", "discussion",
    "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "notices", "notification", "overlay", "pager", "pagination", "popup",
    "promo", "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing",
    "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar",
    "widget",
}
CLOSES_P = BLOCKS - {"html", "body"}
PASSED, UNKNOWN = -0.5, 0.5


def _marked(rest: str, in_region: bool) -> bool:
    for m in ATTRIBUTE.finditer(rest):
        name = (m[1] or m[5] or "").lower()
        value = m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name in ("class", "id"):
            for label in value.split():
                parts = [x.lower() for x in re.split(r"[-_]+|(?<=[a-z])(?=[A-Z])", label) if x]
                if not parts or {"has", "with", "no"} & set(parts):
                    continue
                ends = {parts[0], parts[-1]}
                if ends & MARKS or (not in_region and "header" in ends):
                    return True
    return False


def tokens(page: str):
    """("word run", text) and ("open" or "close", tag, attributes) in page order."""
    at = 0
    for m in iter(lambda: TOKEN.search(page, at), None):
        if m.start() > at:
            yield "text", page[at:m.start()], ""
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        close = m["close"] or m["close2"]
        yield ("close" if close else "open"), tag, m["rest"] or m["rest2"] or ""
        if not close and tag in RAW:
            end = RAW_END[tag].search(page, at)
            at = end.start() if end else len(page)
    if at < len(page):
        yield "text", page[at:], ""


def events(page: str | None):
    """Items of a page: ("tag", name), ("passed",), ("break",) and
    ("words", words, innermost block, inside a marked region)."""
    if not page:
        return iter(())
    if "<form" in page.lower():
        every = list(_events(page, DROPPED - {"form"}))
        n, rest = (sum(len(e[1].split()) for e in found if e[0] == "words")
                   for found in (every, _events(page, DROPPED)))
        if 2 * rest < n:
            return iter(every)
    return _events(page, DROPPED)


def _events(page: str, passed_over: set[str]):
    stack: list[tuple[str, bool]] = []
    blocks: list[str] = []  # those of the stack's tags that are blocks
    held = Counter()  # tags on the stack
    dropped, regions = 0, 0

    def pop() -> None:
        nonlocal dropped, regions
        tag, out = stack.pop()
        held[tag] -= 1
        if tag in BLOCKS:
            blocks.pop()
        dropped -= out
        regions -= tag in REGIONS

    def part_of(tag: str) -> str:
        """A region within another is a section of it."""
        return "section" if tag in REGIONS and regions else tag

    for kind, what, rest in tokens(page):
        # Text or a block ends a head that isn't closed.
        if stack and ((kind == "text" and stack[-1][0] == "head" and what.strip()) or (
                kind == "open" and what in BLOCKS and held["head"])):
            while stack[-1][0] != "head":
                pop()
            pop()
        if kind == "text":
            if dropped:
                continue
            ws = html.unescape(what)
            inner = blocks[-1] if blocks else "body"
            anchored = any(t == "a" for t, _ in stack[-3:])
            yield "words", ws, "a" if anchored else inner, regions > 0
            continue
        if kind == "close":
            if not held[what]:
                continue
            was = dropped
            while stack[-1][0] != what:
                pop()
            pop()
            if was and not dropped:
                yield "break", "", "", False
            elif not dropped:
                yield "tag", part_of(what), "", regions > 0
                if what in BLOCKS:
                    yield "break", "", "", False
            continue
        if what in CLOSES_P and blocks and blocks[-1] == "p":
            while stack[-1][0] != "p":
                pop()
            pop()
        if what == "li" and stack and stack[-1][0] == "li":
            pop()
        out = what in passed_over or what in RAW or (
            what == "header" and not regions) or (
            what not in ("html", "body", *REGIONS) and _marked(rest, regions > 0))
        if out and not dropped:
            yield "passed", what, "", regions > 0
            yield "break", "", "", False
        elif not dropped:
            yield "tag", part_of(what), "", regions > 0
            if what in BLOCKS:
                yield "break", "", "", False
            elif what in ("br", "td", "th"):
                yield "words", " ", "", regions > 0
        if what not in VOID:
            stack.append((what, out))
            held[what] += 1
            if what in BLOCKS:
                blocks.append(what)
            dropped += out
            regions += what in REGIONS


def feature(kind: str, name: str) -> str:
    known = BLOCKS | INLINE
    return f"{kind}:{name if name in known else 'other'}"


def page_counts(page: str | None) -> dict[str, list[int]]:
    """Words by block and tags inside and outside the page's marked region; none without one."""
    counts: dict[str, list[int]] = {}
    any_region = False
    for kind, what, where, inside in events(page):
        any_region |= inside
        if kind == "words":
            n = len(what.split())
            if n:
                counts.setdefault(feature("word", where), [0, 0])[not inside] += n
        elif kind == "tag":
            counts.setdefault(feature("tag", what), [0, 0])[not inside] += 1
    return counts if any_region else {}


def weigh(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Word weights 0.05 to 1, tag weights -3 to -0.05."""
    out = {}
    for name, (inside, outside) in counts.items():
        share = (inside + 1) / (inside + outside + 2)
        out[name] = max(share, 0.05) if name.startswith("word") else -max(3 * (1 - share), 0.05)
    return out


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """Blocks of the best region, one a line; empty without words."""
    blocks: list[list[str]] = [[]]
    total = best = 0.0
    start, chosen = 0, (0, 0)
    for kind, what, where, _ in events(page):
        if kind == "break":
            if blocks[-1]:
                blocks.append([])
            continue
        if kind == "words":
            blocks[-1].append(what)
            score = len(what.split()) * weights.get(feature("word", where), UNKNOWN)
        elif kind == "passed":
            score = PASSED
        else:
            score = weights.get(feature("tag", what), -UNKNOWN)
        total += score
        if total <= 0:
            if blocks[-1]:
                blocks.append([])
            total, start = 0.0, len(blocks) - 1
        elif total > best:
            best, chosen = total, (start, len(blocks))
    lines = (" ".join("".join(b).split()) for b in blocks[chosen[0]:chosen[1]])
    return "\n".join(line for line in lines if line)


def learn(pages: DataFrame) -> dict[str, float]:
    """Weights from all pages that mark their article; one row per kind of tag is collected."""
    def run(batches):
        total: dict[str, list[int]] = {}
        for batch in batches:
            for page in batch.column("html").to_pylist():
                for name, (a, b) in page_counts(page).items():
                    have = total.setdefault(name, [0, 0])
                    have[0] += a
                    have[1] += b
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array([x[0] for x in total.values()], pa.int64()),
             pa.array([x[1] for x in total.values()], pa.int64())], ["name", "inside", "outside"])
    rows = pages.select("html").mapInArrow(run, "name string, inside long, outside long")
    return weigh({r[0]: (r[1], r[2]) for r in rows.groupBy("name").agg(
        F.sum("inside"), F.sum("outside")).collect()})


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row.

    Null and empty pages have an empty text. Character references are decoded after tags are
    told apart, white space in a block becomes one space. Repeated rows give repeated results;
    other columns aren't looked at.
    """
    weights = learn(pages)
    rows = pages.select("page_id", "url", "html")

    def run(batches):
        for batch in small(batches, "html"):
            texts = [main_text(x, weights) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])
    id_type, url_type = (rows.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    return rows.mapInArrow(run, f"page_id {id_type}, url {url_type}, text string, n_chars long")
