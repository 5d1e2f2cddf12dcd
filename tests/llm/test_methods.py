"""Operators against brute force, round trips and held-out accuracy on small tables."""

import base64
import collections
import hashlib
import json
import math
import random
import string
import time
import tracemalloc
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from setlog.llm import (
    components,
    decontamination,
    html_extraction,
    language_id,
    line_dedup,
    mixing,
    ngram_join,
    ppm,
    quality_classifier,
    quality_rules,
    queries,
    secret_scan,
    text,
)

DOCS = "doc_id long, text string, lang string, source string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, None, None) for i, t in rows], DOCS)


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def prose(rng, n, words=60):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def ppm_by_hand(train, order, discount):
    """Code of a symbol after a history, by the definition."""
    counts = collections.defaultdict(collections.Counter)
    for x in train:
        for k in range(order, len(x)):
            for n in range(order + 1):
                counts[tuple(x[k - n:k])][x[k]] += 1

    def p(history, symbol, n):
        if n < 0:
            return 1 / 257
        seen = counts.get(tuple(history[len(history) - n:]))
        if not seen:
            return p(history, symbol, n - 1)
        total = sum(seen.values())
        if symbol in seen:
            return (seen[symbol] - discount) / total
        left = 1 - sum(p(history, s, n - 1) for s in seen)
        return discount * len(seen) / total * p(history, symbol, n - 1) / left
    return p


def test_trie_codes_are_those_of_the_definition():
    rng, order = random.Random(1), 3
    sample = [ppm.symbols([bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 5)))
                           for _ in range(12)], order) for _ in range(6)]
    grams = ppm._added(None, np.concatenate([ppm.gram_keys(x, order) for x in sample]))
    by_order = {k: ppm._added(None, grams[0] & ((1 << (ppm.BITS * (k + 1))) - 1), grams[1])
                for k in range(order + 1)}
    trie = ppm.build(by_order, order)
    p = ppm_by_hand([x.tolist() for x in sample], order, ppm.DISCOUNT)
    new = ppm.symbols([b"abca", b"cxa", b"b"], order)
    expected = [math.log10(p(new[:k].tolist(), int(new[k]), order)) for k in range(order, len(new))]
    assert np.allclose(trie.costs([new])[order:], expected, atol=1e-5)
    weights = np.ones(trie.width)
    weights[-1] = 257 - (trie.width - 1)
    sums = (10.0 ** trie.log10.reshape(-1, trie.width).astype(float) * weights).sum(1)
    assert np.allclose(sums, 1, atol=1e-5)


def test_trie_is_built_in_little_more_memory_than_its_own():
    rng, order = np.random.default_rng(3), 5
    words = [rng.integers(97, 123, rng.integers(2, 9)).astype(np.uint8).tobytes() for _ in range(3000)]
    key = ppm.gram_keys(ppm.symbols([words[i] for i in rng.integers(0, len(words), 20_000)], order), order)
    grams = {k: np.unique(key & ((1 << (ppm.BITS * (k + 1))) - 1), return_counts=True) for k in range(order + 1)}
    tracemalloc.start()
    try:
        trie = ppm.build(grams, order)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2 * (trie.after.nbytes + trie.log10.nbytes)


def test_base_scores_and_held_out_gain(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randrange(1, 80)).title()) for i in range(300)] + [(301, None)]
    got = {r.doc_id: r for r in ppm.score(documents(spark, rows), frequent=20).collect()}
    words = {i: text.folded_words(t) for i, t in rows}
    train = [i for i, _ in rows if remainder(i, 5) != 1]
    c = collections.Counter(w for i in train for w in words[i])
    n, v = sum(c.values()) + len(train), len(c) + 1
    for i, ws in words.items():
        base = sum(math.log10((x + 0.5) / (n + 0.5 * (v + 1))) for x in [*(c[w] for w in ws), len(train)])
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            remainder(i, 5) == 1, len(ws) + 1, sum(c[w] > 0 for w in ws) + 1, n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    held = [r for r in got.values() if r.held_out]
    uniform = sum(-math.log10(257) * (len(" ".join(map(bytes.decode, words[r.doc_id]))) + 1) for r in held)
    assert uniform * 0.5 < sum(r.score for r in held) < 0


def test_contexts_beyond_the_held_trie_count(spark):
    rng = random.Random(22)
    rows = [(i, prose(rng, rng.randrange(0, 60), 400)) for i in range(200)] + [(300, None), (301, "Łódź ~")]
    docs = documents(spark, rows)
    whole, cut = ({r.doc_id: r.score for r in ppm.score(docs, cells=cells).collect()}
                  for cells in (10 ** 7, 600))
    assert cut == pytest.approx(whole, abs=1e-3)


def test_new_words_of_a_text_meet_rare_contexts_as_one():
    far = {"text": np.zeros(4, int), "word": np.arange(4), "gram": np.arange(4), "root": np.arange(4),
           "lead": np.full(4, -0.1), "cost": np.full(4, -5.0), "extra": np.array([0.0, 0.2, 0.0, 0.1])}
    got = ppm.new_words_as_one(far)
    assert got["word"].tolist() == [ppm.NEW, 1, ppm.NEW, 3]
    assert got["cost"].tolist() == [0, -5, 0, -5] and got["lead"].tolist() == [0, -0.1, 0, -0.1]
    assert got["gram"].tolist() == far["gram"].tolist() and far["word"].tolist() == [0, 1, 2, 3]


def test_long_texts_score_alike_in_blocks():
    x = ppm.symbols([b"abc", b"de"] * 900)
    grams = ppm._added(None, ppm.gram_keys(x, ppm.ORDER))
    trie = ppm.build({k: ppm._added(None, grams[0] & ((1 << (ppm.BITS * (k + 1))) - 1), grams[1])
                      for k in range(ppm.ORDER + 1)}, ppm.ORDER)
    row, step = 0, []
    for s in x.tolist():
        at = row * trie.width + trie.column[s]
        step.append(trie.log10[at])
        row = trie.after[at]
    # After the lead the row is that of the last symbols, whatever it began with.
    assert np.allclose(trie.costs([x, x[:40]])[ppm.ORDER:len(x)], step[ppm.ORDER:], atol=1e-6)


PAGE = """<!doctype html><html><head><title>T</title><script>if (a<b) x("</p>")</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><a href=/a>Home</a></nav>
<div class="cookie-notice">We use cookies</div><{0}><h2>The &lt;head&gt;line</h2><p>First   one
&amp; more<br>words<div class="ad">Buy</div><p>Second</p><div id="comments"><p>A reader says many many words
here</p></div></{0}><aside>See also</aside><form>Mail</form><footer>&copy; All</footer></body></html>"""


def test_main_text_of_marked_and_unmarked_pages(spark):
    pages = spark.createDataFrame(
        [(k, "u", PAGE.format("article")) for k in range(5)] + [(9, "u", PAGE.format("div"))],
        "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in html_extraction.extract(pages).collect()}
    assert set(texts.values()) == {"The <head>line\nFirst one & more words\nSecond"}


def test_mix_meets_targets(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randrange(0, 40)), None,
             rng.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(2000)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(docs, bucket=64).collect()
    assert sorted(got) == sorted(mixing.mix(docs, bucket=64).collect())
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += len(t.split())
    order = sorted(s for s in sizes if s) + [None]
    live, left, target = dict(zip(order, [5, 2, 1, 5, 2])), 1.5 * sum(sizes.values()), {}
    while live:
        level = left / sum(live.values())
        full = [s for s in live if live[s] * level > 2 * sizes[s]]
        for s in full or list(live):
            target[s] = 2.0 * sizes[s] if full else live[s] * level
            left -= target[s]
            del live[s]
    taken = collections.Counter()
    for r in got:
        assert 0 <= r.copies <= 2 and r.target == pytest.approx(target[r.source])
        taken[r.source] += r.copies * r.size * r.m
    assert all(abs(taken[s] - target[s]) <= 40 for s in sizes)
    mixed = mixing.mixed(docs, bucket=64)
    assert mixed.count() == sum(r.copies * r.m for r in got)


def test_settling_is_unbiased():
    size, part = np.array([3.0, 5.0, 2.0, 7.0]), np.array([0.2, 0.5, 0.9, 0.4])
    mean = np.mean([mixing.settle(size, part, k) for k in range(4000)], axis=0)
    assert np.allclose(mean, part, atol=0.03)
    assert all(((x > 0) & (x < 1)).sum() <= 1 and abs((x * size).sum() - (part * size).sum()) < 1e-9
               for x in (mixing.settle(size, part, k) for k in range(50)))


def join_by_hand(rows, n, percent):
    sets = {}
    for i, t in rows:
        ws = text.folded_words(t)
        k = min(n, len(ws))
        sets[i] = {tuple(ws[j:j + k]) for j in range(len(ws) - k + 1)} if k else set()
    label = {i: i for i in sets}
    ids = sorted(sets)

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("block", [8, 512])
def test_join_is_that_of_all_pairs(spark, block):
    rng = random.Random(4)
    bases = [prose(rng, 60, 500).split() for _ in range(6)]
    rows = [(900, ""), (901, "One two"), (902, "one TWO"), (903, None), (904, "one"), (905, "a b c d")]
    for i in range(130):  # mostly one family, whose members differ by more and more words
        ws = list(bases[0] if i < 90 else rng.choice(bases))
        for _ in range(rng.randrange(0, 4)):
            ws[rng.randrange(len(ws))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(ws)))
    got = ngram_join.join(documents(spark, rows), n=4, percent=85, block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == join_by_hand(rows, 4, 85)


def test_tree_bound_never_drops_a_link():
    rng = np.random.default_rng(5)
    for _ in range(20):
        base = rng.integers(-2 ** 62, 2 ** 62, 300)
        sets = [np.unique(np.r_[base[rng.random(300) < 0.95], rng.integers(-2 ** 62, 2 ** 62, 10)])
                for _ in range(20)]
        size, maps = np.array([len(s) for s in sets]), np.array([ngram_join.bitmap(s) for s in sets])
        tree = ngram_join.SignatureTree(maps, size)
        i = np.arange(20)
        may = ngram_join.possible(tree.levels[0], i, tree.levels[0], i, 85)
        assert all(may[a, b] for a in i for b in i if ngram_join.linked(sets[a], sets[b], 85))


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(k, k + 1) for k in range(500, 560)]
    label = list(range(600))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for a, b in edges:
        x, y = find(a), find(b)
        label[max(x, y)] = min(x, y)
    got = dict(tuple(r) for r in components.components(
        spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: find(i) for e in edges for i in e if find(i) != i}


def test_parsing_is_greedy():
    rng = np.random.default_rng(7)
    source, x = rng.integers(3, 6, 80).astype(np.uint8), rng.integers(3, 7, 700).astype(np.uint8)
    model = language_id.Model(["l"], None, 8, [language_id.parser(source, 8).ravel()], np.ones(1))
    known = {bytes(source[i:j]) for i in range(80) for j in range(i + 1, 81)}
    phrases = 0
    for cut in range(0, len(x), language_id.lanes.BLOCK):
        part, at = bytes(x[cut:cut + language_id.lanes.BLOCK]), 0
        while at < len(part):
            end = at + 1
            while end < len(part) and part[at:end + 1] in known:
                end += 1
            phrases, at = phrases + 1, end
    assert round(model.costs([x])[0, 0] * len(x)) == phrases


def test_languages_are_told_apart(spark):
    rng = random.Random(8)
    parts = {"xx": ["ka", "lo", "mi", "tu"], "yy": ["pre", "sto", "ung", "ein"]}
    rows = [(i, " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(20)), lang, None)
            for i, lang in ((i, ("xx", "yy")[i % 2]) for i in range(200))] + [(500, "12 !", "xx", None)]
    got = language_id.identify(spark.createDataFrame(rows, DOCS)).collect()
    truth = {r[0]: r[2] for r in rows} | {500: "und"}
    assert all(r.lang_pred == truth[r.doc_id] and 0 <= r.score <= 1 for r in got)


def test_counts_by_hand():
    rng = random.Random(9)
    for _ in range(60):
        t = "\n".join(prose(rng, rng.randrange(0, 9), 4) + rng.choice(["", "#", " é"]) for _ in range(rng.randrange(0, 7)))
        ws, lines = t.encode().split(), [x for x in t.split("\n") if x.strip()]
        windows = [tuple(ws[k:k + 5]) for k in range(len(ws) - 4)]
        often = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
        got = dict(zip(text.STAT_FIELDS, text.count_stats(t), strict=True))
        assert got["n_repeat_words"] == len(often) and got["n_words"] == len(ws)
        assert got["n_dup_lines"] == sum(x in lines[:k] for k, x in enumerate(lines))
        assert got["word_chars"] == sum(len(w.decode()) for w in ws) and got["n_symbols"] == t.count("#")


def test_rules_find_the_planted_condition():
    rng = np.random.default_rng(10)
    x = rng.random((3000, 3))
    bad = (x[:, 0] > 0.8) & (x[:, 1] < 0.5) | (x[:, 2] > 0.97)
    rules = quality_rules.learn(x, bad, ["a", "b", "c"])
    hit = np.any([r.covers(x, ["a", "b", "c"]) for r in rules], axis=0)
    assert (hit == bad).mean() > 0.98 and not quality_rules.learn(x, np.zeros(3000, bool), ["a", "b", "c"])


def test_classifier_on_held_out_rows(spark):
    rng = random.Random(11)
    rows = [(i, prose(rng, 40, 900) if i % 2 else " ".join(["spam!!"] * 40)) for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    got = quality_classifier.score(documents(spark, rows), labels, features=32).collect()
    held = [r for r in got if r.held_out]
    assert held and all(r.held_out == (remainder(r.doc_id, 3) == 1) for r in got)
    assert np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.95
    y = quality_classifier.isotonic(np.array([1.0, 3, 2, 2, 5]), np.ones(5))
    assert np.allclose(y, [1, 7 / 3, 7 / 3, 7 / 3, 5])


def lines_by_hand(rows):
    pieces, count, first = {}, collections.Counter(), {}
    for i, t in sorted(rows):
        lines = t.split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
        spans = set()
        for a, b in line_dedup.CUTS:
            begin = 0
            for k in range(len(lines)):
                rolled = (a * h[k] + b * (h[k - 1] if k else 0)) % line_dedup.PRIME % line_dedup.EVERY
                if k == len(lines) - 1 or not rolled:
                    if k > begin:
                        spans.add((begin, k))
                    begin = k + 1
        pieces[i] = [(a, b, "\n".join(lines[a:b + 1])) for a, b in sorted(spans)]
        for a, b, x in pieces[i]:
            count[x] += 1
            first.setdefault(x, (i, a, b))
    out = {}
    for i, t in rows:
        drop, keep = set(), set()
        for a, b, x in pieces[i]:
            if count[x] > 1:
                (keep if first[x] == (i, a, b) else drop).update(range(a, b + 1))
        out[i] = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in drop - keep)
    return out


def test_line_dedup_by_hand(spark):
    rng = random.Random(12)
    passages = [[prose(rng, 8) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(60):
        own = [prose(rng, 6) for _ in range(rng.randrange(1, 6))]
        rows.append((i, "\n".join(own + rng.choice(passages) + own[:1])))
    got = {r.doc_id: r for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    assert {i: r.kept_text for i, r in got.items()} == lines_by_hand(rows)
    assert sum(r.n_removed for r in got.values()) > 60


def whole_lines_by_hand(rows, words):
    """Kept texts where runs of ``words`` words count too, by trying every start and end."""
    pieces, first = [], {}
    for i, t in sorted(rows):
        lines = t.split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
        n = [len(x.split()) for x in lines]
        filled = [k for k, x in enumerate(n) if x]
        spans = {}
        for a in filled:
            for b in filled:
                total = sum(n[a:b + 1])
                if a <= b and total >= words and (total - n[a] < words or total - n[b] < words):
                    spans.setdefault((a, b), set()).add("\n".join(x for x in lines[a:b + 1] if x.split()))
        for f, g in line_dedup.CUTS:
            begin = 0
            for k in range(len(lines)):
                rolled = (f * h[k] + g * (h[k - 1] if k else 0)) % line_dedup.PRIME % line_dedup.EVERY
                if k == len(lines) - 1 or not rolled:
                    if k > begin:
                        spans.setdefault((begin, k), set()).add("\n".join(lines[begin:k + 1]))
                    begin = k + 1
        for (a, b), texts in sorted(spans.items()):
            for x in texts:
                pieces.append((i, a, b, x))
                first.setdefault(x, (i, a, b))
    gone = {(i, k) for i, a, b, x in pieces if first[x] != (i, a, b) for k in range(a, b + 1)}
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in rows}


def test_whole_line_dedup_by_hand(spark):
    rng = random.Random(21)
    lines = [prose(rng, n) for n in (1, 2, 3, 5, 9, 14, 30, 55) for _ in range(3)] + ["", " "]
    passages = [[rng.choice(lines) for _ in range(rng.randrange(1, 30))] for _ in range(6)]
    rows = [(0, ""), (1, " "), (2, "\n".join(["a"] * 120)), (3, "\n".join(["b"] * 700))]
    for i in range(4, 60):
        own = [prose(rng, rng.randrange(1, 9), 9999) for _ in range(rng.randrange(0, 8))]
        rows.append((i, "\n".join(own + rng.choice(passages) + own[1:3] + rng.choice(passages))))
    for words in (50, 7):
        got = line_dedup.dedup_lines(documents(spark, rows), words=words).collect()
        assert {r.doc_id: r.kept_text for r in got} == whole_lines_by_hand(rows, words)


def test_runs_of_fifty_words_go_wherever_they_stand(spark):
    rng = random.Random(13)
    runs = [[prose(rng, 60, 9999)], [prose(rng, 30, 9999), prose(rng, 30, 9999)],
            [prose(rng, 20, 9999), "", prose(rng, 20, 9999), prose(rng, 20, 9999), prose(rng, 9, 9999)]]
    rows = [(100 * k + i, "\n".join([prose(rng, 7, 9999), *run, prose(rng, 7, 9999)]))
            for k, run in enumerate(runs) for i in range(12)]
    rows += [(900 + k, "\n".join(run)) for k, run in enumerate(runs)]
    got = {r.doc_id: r.text.split("\n") for r in line_dedup.without_repeats(documents(spark, rows)).collect()}
    for i, t in rows:
        lines = t.split("\n")
        own = i < 900 and [lines[0], lines[-1]]
        assert got[i] == (lines if i < 900 and i % 100 == 0 else own or [""]), i
    same = dict(rows) | {1: "short line", 2: "other\nshort line"}
    left = line_dedup.without_repeats(documents(spark, [(1, same[1]), (2, same[2])]))
    assert {r.doc_id: r.text for r in left.collect()} == {1: same[1], 2: same[2]}


def der(tag, body):
    size = len(body)
    return bytes([tag]) + (bytes([size]) if size < 128 else b"\x82" + size.to_bytes(2, "big")) + body


def test_confirmed_secrets(spark):
    number = der(2, bytes(range(1, 65)))
    rsa = der(0x30, der(2, b"\0") + number * 8)
    pkcs8 = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2a\x03")) + der(4, rsa))
    coded = base64.b64encode(pkcs8).decode()
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    jwt = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': '1'})}.c2lnbmF0dXJl"
    pem = "-----BEGIN RSA PRIVATE KEY-----\n" + base64.encodebytes(rsa).decode() + "-----END RSA PRIVATE KEY-----"
    for t, kinds in (
            (f"é key {coded} end", ["key"]), (f"é {jwt} x", ["jwt"]), (f"a {pem} b", ["pem"]),
            (rsa.hex(), ["hex", "key"]), (coded[:-8], []), (coded[4:], []), ("eyJhbGciOiJub3Q.eyJ4.c2ln", []),
            ('API_KEY: "abc123" token=12345', ["assign"]), ("AKIA" + "A" * 15, []), ("AKIA" + "Z" * 16, ["access"]),
            ("ſecret = abcdefg", []), ("f" * 23, []), ("xf" + "0" * 24, ["hex"])):
        got = secret_scan.spans(t)
        assert [k for k, _, _ in got] == kinds, t
        assert all(t[a:b].strip() == t[a:b] for _, a, b in got)


def test_glued_and_wrapped_secrets():
    number = der(2, bytes(range(1, 65)))
    rsa = der(0x30, der(2, b"\0") + number * 8)
    field = lambda x: len(x).to_bytes(4, "big") + x
    ssh = secret_scan.SSH_MAGIC + field(b"none") * 2 + field(b"") + b"\0\0\0\1" + field(b"p" * 51) + field(b"k" * 136)
    for data in (rsa, ssh, rsa[:1] + b"\x82" + (len(rsa) - 4).to_bytes(2, "big") + rsa[4:]):
        coded = base64.b64encode(data).decode()
        lines = base64.encodebytes(data).decode().strip()
        for before in ("", "é backup/", "key-", "x_", "a+b/"):
            for after in (" end", "", "/x", ".", " = y"):
                t = before + coded + after
                assert [t[a:b].rstrip("=") for k, a, b in secret_scan.spans(t) if k == "key"] == [coded.rstrip("=")] or (
                    after == "/x" and not coded.endswith("="))
            for body in (lines, lines.replace("\n", "\r\n  "), lines.replace("\n", "\\n")):
                for after in ("", "\n", "\nand more words", " ."):
                    t = before + body + after
                    assert [t[a:b] for k, a, b in secret_scan.spans(t) if k == "key"] == [body], t
        t = "Key-of-" + "A" * 40 + "\n" + lines
        assert [t[a:b] for k, a, b in secret_scan.spans(t) if k == "key"] == [lines]
        assert not secret_scan.spans(f"x/{coded[:-9]}") and (data is ssh or not secret_scan.spans(lines[:-9]))
    mark = "-----{} RSA PRIVATE KEY-----"
    for headers, body, kinds in (
            ("Comment: mine\n\n", base64.encodebytes(rsa).decode(), ["pem"]),
            ("Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF\n\n",
             base64.encodebytes(bytes(range(160))).decode(), ["pem"]),
            ("Comment: mine\n\n", base64.encodebytes(bytes(range(160))).decode(), [])):
        t = f"a {mark.format('BEGIN')}\n{headers}{body}{mark.format('END')} b"
        assert [k for k, a, b in secret_scan.spans(t) if k in ("pem", "key")] == kinds
    for hostile in ("/MIIEpQIBAAKCAQEA" * 30_000, "/b3BlbnNzaC1rZXktdjE" * 30_000, ("A" * 40 + "\n") * 20_000,
                    (mark.format("BEGIN") + "\nA: b") * 10_000):
        began = time.monotonic()
        secret_scan.spans(hostile)
        assert time.monotonic() - began < 20


def test_base_spans_are_those_of_a_plain_reading():
    rng, letters = random.Random(31), string.ascii_letters + string.digits

    def by_hand(t):
        found, at = [], 0
        names = ("password", "passwd", "secret", "token", "api_key", "apikey")
        lower = "".join(c.lower() if c in string.ascii_letters else c for c in t)
        while at < len(t):
            name = next((n for n in names if lower.startswith(n, at)), None)
            end = at + len(name) if name else at
            end += t[end:end + 1] in ("'", '"') if name else 0
            while name and t[end:end + 1] == " ":
                end += 1
            if not name or t[end:end + 1] not in (":", "="):
                at += 1
                continue
            end += 1
            while t[end:end + 1] == " ":
                end += 1
            end += t[end:end + 1] in ("'", '"') and t[end:end + 1] != ""
            first = end
            while t[end:end + 1] and t[end] in letters + "+/_.=-":
                end += 1
            if end == first:
                at += 1
                continue
            if end - first >= 6:
                found.append(("assign", at, end))
            at = end
        for kind, start, alphabet, least in (("access", "AKIA", string.ascii_uppercase + string.digits, 20),
                                             ("hex", "", "0123456789abcdef", 24)):
            at = 0
            while at < len(t):
                end = at + len(start) if t.startswith(start, at) else at
                body = end
                while (end > at or not start) and end < len(t) and t[end] in alphabet:
                    end += 1
                if end > body and end - at >= least:
                    found.append((kind, at, end))
                at = end if end > body else at + 1
        return found
    parts = ["password", "Token", "API_KEY", "apikey", "secret", "passwd", ":", "=", " ", "'", '"', "AKIA", "\n", "é",
             "abc.123", "x", "0a" * 12, "Z9" * 8, "deadbeef" * 3]
    for _ in range(3000):
        t = "".join(rng.choices(parts, k=rng.randrange(1, 14)))
        got = [s for s in secret_scan.spans(t) if s[0] in secret_scan.BASE_KINDS]
        assert sorted(got) == sorted(by_hand(t)), t


def test_reparameterised_questions(spark, monkeypatch):
    benchmark = spark.createDataFrame(
        [(1, "Yesterday a farmer called Anna sold 12 apples for 30 cents and bought 12 pears from Ben.")],
        "item_id long, text string")
    rows = [
        (1, "Intro words. Yesterday a farmer called Maria sold 7 apples for 5 cents and bought 7 pears from Tom."),
        (2, "Yesterday a farmer called Anna sold 12 apples for 30 cents and bought 12 pears from Ben. Fine."),
        (3, "Yesterday a farmer called Maria sold 7 apples for 5 cents and bought 8 pears from Tom."),
        (4, "Nothing of the kind is in this text about a farmer called Anna."),
    ]
    docs = documents(spark, rows)
    got = {(r.doc_id, r.same_values) for r in decontamination.leaks(docs, benchmark).collect()}
    assert got == {(1, False), (2, True)}
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    assert {(r.doc_id, r.same_values) for r in decontamination.leaks(docs, benchmark).collect()} == got
    assert sorted(r.doc_id for r in decontamination.without_leaks(docs, benchmark).collect()) == [3, 4]


def test_edited_questions_go(spark):
    rng = random.Random(23)
    item = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(36)]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    around = lambda ws: " ".join([prose(rng, 11, 99), *ws, prose(rng, 9, 99)])
    thirds = [*item[:12], "oh", *item[12:24], "well", *item[24:], "now"]
    rows = [(1, around(thirds)), (2, around(item[:9] + item[10:20] + item[21:])),
            (30, around(item[:12])), (31, around(["no"] * 36))]
    for shift in range(7):  # one word in seven replaced
        rows.append((10 + shift, around([w if (k + shift) % 7 else "zz" for k, w in enumerate(item)])))
        rows.append((20 + shift, " ".join(["pad"] * shift + [w if k % 7 else "zz" for k, w in enumerate(item)])))
    docs = documents(spark, rows)
    left = decontamination.without_leaks(docs, benchmark).collect()
    assert sorted(r.doc_id for r in left) == [30, 31]
    found = decontamination.leaks(docs, benchmark).drop("key").toPandas()
    assert sorted(found.doc_id) == sorted({i for i, _ in rows} - {30, 31})
    with duckdb.connect() as db:
        db.register("documents", docs.select("doc_id", "text").toPandas())
        db.register("benchmark", benchmark.toPandas())
        expected = db.sql(queries.ORACLE_SQL["op10_decontamination"]).df()
    as_rows = lambda x: sorted(map(tuple, x[["doc_id", "item_id", "n_words", "n_agree", "same_values"]].values.tolist()))
    assert as_rows(found) == as_rows(expected)


def test_templates_of_hostile_words_take_linear_time(spark):
    words = ["x" * 200_000, "." * 200_000 + " A", "x" * 99_999 + "7", "a." * 50_000, "# @ ~ ^ " * 20_000]
    began = time.monotonic()
    got = documents(spark, list(enumerate(words))).select(
        "doc_id", decontamination.template(F.col("text")).alias("t")).collect()
    assert time.monotonic() - began < 20
    assert [r.t for r in got[:3]] == [["x" * 200_000], ["a"], ["#"]]


def test_rare_letters_and_late_text_tell_languages_apart(spark):
    rng = random.Random(24)
    words = lambda first, n: " ".join("".join(chr(first + rng.randrange(24)) for _ in range(3)) for _ in range(n))
    first = {"aa": 0x61, "el": 0x3B1, "ka": 0x10D0, "ru": 0x430}
    rows = [(1000 * k + i, words(first[lang], 200 if lang in ("aa", "el", "ka") else 20), lang, None)
            for k, lang in enumerate(first) for i in range(40)]
    same = words(0x100, 1200)  # two languages whose long texts differ only after 4,096 characters
    rows += [(9000 + i, same + " " + words(0x531 if i % 2 else 0x5D0, 100), "hy" if i % 2 else "he", None)
             for i in range(60)]
    rows += [(9900 + i, words(0x531 if i % 2 else 0x5D0, 30), "hy" if i % 2 else "he", None) for i in range(20)]
    got = {r.doc_id: r.lang_pred for r in language_id.identify(spark.createDataFrame(rows, DOCS)).collect()}
    assert {r[0]: r[2] for r in rows if r[0] < 9000 or r[0] >= 9900} == {
        i: p for i, p in got.items() if i < 9000 or i >= 9900}


def test_hashed_moves_are_those_of_the_table():
    rng = np.random.default_rng(25)
    source, x = rng.integers(1, 9, 900).astype(np.uint16), rng.integers(1, 12, 3000).astype(np.uint16)
    dense, thin = (language_id.Model(["l"], None, 12, [t], np.ones(1)).costs([x]) for t in (
        language_id.parser(source, 12).ravel(), language_id.hashed_parser(source, 12)))
    assert np.array_equal(dense, thin)


def test_raw_tags_after_letters_that_grow_in_lower_case():
    own = " ".join(f"word{k}" for k in range(40))
    page = f"<h1>The long title of \u0130</h1><script>if (a) x('<p>')</SCRIPT><p>{own}</p><style>p</style>"
    assert html_extraction.main_text(page, {}) == f"The long title of \u0130\n{own}"


def test_the_region_is_the_best_of_all():
    rng = random.Random(32)
    names = ["div", "p", "article", "section", "h2", "li"]  # blocks, as a region ends with its block
    for _ in range(300):
        parts = [rng.choice([f"<{rng.choice(names)}>", f"</{rng.choice(names)}>", f" w{k} " * rng.randrange(1, 4)])
                 for k in range(rng.randrange(1, 30))]
        page = "".join(parts)
        weights = {html_extraction.feature(kind, n): rng.choice([0.25, 0.5, 1.0]) if kind == "word" else
                   -rng.choice([0.25, 1.0, 2.0, 3.0]) for kind in ("word", "tag") for n in [*names, "body"]}
        items = [(sum(1 for _ in what.split()) * weights.get(html_extraction.feature("word", where), html_extraction.UNKNOWN)
                  if kind == "words" else html_extraction.PASSED if kind == "passed" else
                  weights.get(html_extraction.feature("tag", what), -html_extraction.UNKNOWN),
                  what.split() if kind == "words" else [])
                 for kind, what, where, _ in html_extraction.events(page) if kind != "break"]
        best = max([0.0] + [sum(x for x, _ in items[a:b]) for a in range(len(items)) for b in range(a + 1, len(items) + 1)])
        regions = [[w for _, ws in items[a:b] for w in ws] for a in range(len(items)) for b in range(a + 1, len(items) + 1)
                   if sum(x for x, _ in items[a:b]) == best]
        got = html_extraction.main_text(page, weights).split()
        assert got in regions or (best == 0 and not got), page


def test_deep_and_unclosed_tags_take_linear_time():
    for page in ("<div>" * 60_000 + "word " * 50, "<b><p>x" * 30_000, "<p></i>" * 60_000):
        began = time.monotonic()
        html_extraction.main_text(page, {})
        assert time.monotonic() - began < 10


def test_learning_texts_are_the_least_hashes_of_each_language(spark):
    rows = [(i, f"text {i} of", "ab"[i % 2]) for i in range(400)] + [(7, "same", "a")] * 300 + [(9, "only", "c")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    got = language_id.sample(docs)
    by_lang = collections.defaultdict(set)
    for r in docs.selectExpr("lang", "text", "xxhash64(doc_id, text) as h").collect():
        by_lang[r.lang].add((r.h, r.text))
    assert {k: sorted(v) for k, v in got.items()} == {
        k: sorted(t for _, t in sorted(v)[:language_id.FIT_DOCS]) for k, v in by_lang.items()}


@pytest.mark.parametrize("page, text", [
    ("<body><article><h2>The first of two</h2><p>{0}</p></article><article><h2>Then the second one</h2><p>{0}</p></article></body>",
     "The first of two\n{0}\nThen the second one\n{0}"),
    ("<main><h1>Title</h1><p>Lead</p><article><p>{0}</p></article></main>",
     "Title\nLead\n{0}"),
    ("<html><head><title>T</title><body><p>{0}</p></body></html>", "{0}"),
    ("<html><head><title>T</title><p>{0}</p></html>", "{0}"),
    ("<body><form action=x><div><p>{0}</p></div><input></form></body>", "{0}"),
])
def test_no_tag_alone_picks_the_region(page, text):
    own = " ".join(f"word{k}" for k in range(40))
    seen = collections.Counter()
    for marked in (PAGE, PAGE.replace("h2", "h1").replace("head&gt;line", "one")):
        for name, (inside, outside) in html_extraction.page_counts(marked.format("article")).items():
            seen.update({(name, 0): 20 * inside, (name, 1): 20 * outside})
    weights = html_extraction.weigh({n: (seen[n, 0], seen[n, 1]) for n, _ in seen})
    assert html_extraction.main_text(page.format(own), weights) == text.format(own)


def test_a_repeated_document_counts_once_for_the_rules(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_rules, "learn", lambda x, bad, names: seen.append(len(x)) or [])
    docs = documents(spark, [(1, "a b c")] * 300 + [(2, f"a b {'c ' * k}") for k in range(50)] + [(3, "d")])
    stats = text.with_stats(docs, doc_id=docs.doc_id)
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id long, quality int")
    quality_rules.fit(stats, labels)
    quality_rules.fit(stats, labels, 20)
    assert seen == [52, 20]
