"""Hard negatives and whitening against the definition, chats by round trip; edge cases of all three."""

import hashlib
import math
import random

import numpy as np
import pytest

from setlog.llm import chat_format, hard_negatives, spectrum, whitening

VECTORS = "vec_id long, embedding array<float>, label int, uid string, planes int"


def vectors(rng, n, dims=11, labels=3):
    """Rows with ties (copies of vectors), and every kind of row that takes no part."""
    rows, made = [], []
    for k in range(n):
        made.append(made[rng.integers(len(made))] if made and rng.random() < .3 else
                    [float(x) for x in rng.normal(0, .3, dims).astype(np.float32)])
        rows.append((k, made[-1], int(rng.integers(labels)), "x", 1))
    odd = [(n, None, 1), (n + 1, [1.0] * dims, None), (n + 2, [None] + [1.0] * (dims - 1), 1),
           (n + 3, [math.nan] * dims, 1), (n + 4, [math.inf] * dims, 1)]
    return rows + [(*x, "x", 1) for x in odd]


def mined_by_hand(rows):
    good = [(i, [math.floor(256 * x) for x in v], (y + 1) % 10 if i % 7 == 0 else y) for i, v, y, *_ in rows
            if v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, av, ay in good:
        if a % 100:
            continue
        score = {i: sum(p * q for p, q in zip(av, v)) for i, v, _ in good}
        order = sorted(((-score[i], i, y) for i, _, y in good if i != a))
        for p in [x for x in order if x[2] == ay][:5]:
            fits = [x for x in order if x[2] != ay and 80 * -p[0] <= 100 * -x[0] <= 100 * -p[0]]
            out += [(a, p[1], k + 1, x[1], -p[0], -x[0]) for k, x in enumerate(fits[:5])]
    return sorted(out)


@pytest.mark.parametrize("at_once", [2, 8192])
def test_hard_negatives_by_hand(spark, at_once):
    rows = vectors(np.random.default_rng(3), 420)
    got = hard_negatives.mine(spark.createDataFrame(rows, VECTORS), at_once=at_once).collect()
    assert sorted(map(tuple, got)) == mined_by_hand(rows)
    assert got


def test_lookups_are_inner_products():
    rng = np.random.default_rng(5)
    for most in (1, 100, 1 << 20):
        a, b = rng.integers(-most, most, (7, 19)), rng.integers(-most, most, (30, 19))
        bits = most.bit_length() + 1
        planes = hard_negatives.planes_of(b, bits)
        assert (hard_negatives.values_of(planes, bits)[:, :19] == b).all()
        padded = hard_negatives.values_of(hard_negatives.planes_of(a, bits), bits)
        tables = hard_negatives.narrow(hard_negatives.tables_of(padded), bits)
        assert (hard_negatives.scores_of(tables, planes, bits) == b @ a.T).all()


def test_hard_negatives_edges(spark):
    none = hard_negatives.mine(spark.createDataFrame([], VECTORS))
    assert none.count() == 0 and none.columns[0] == "anchor_id"
    one = [1.0, 0.0]
    rows = [(100, one, 1, "", 0), (100, one, 1, "", 0), (None, one, 1, "", 0), (5, [1.0], 2, "", 0), (None, [], 2, "", 0),
            (6, [0.9, 9.0], 2, "", 0), (8, [1e30, 0.0], 1, "", 0)]
    got = sorted(map(tuple, hard_negatives.mine(spark.createDataFrame(rows, VECTORS)).collect()), key=repr)
    # Each row 100 has the other, the huge one (counted as MOST) and the one without id as positives; 5 and 6 are near
    # those with a score of their kind. A shorter vector ends in zeros.
    full, near = 256 * 256, 256 * 230
    assert [g for g in got if g[1] != 8] == sorted(
        2 * [(100, p, r, n, full, s) for p in (100, None) for r, n, s in ((1, 5, full), (2, 6, near))], key=repr)


def test_leading_eigenvectors():
    rng = np.random.default_rng(1)
    for _ in range(60):
        d = int(rng.integers(1, 24))
        q = np.linalg.qr(rng.standard_normal((d, d)))[0]
        e = np.sort(rng.choice([1e-3, 1.0, 1.0 + 1e-9, 2.0, 2.0, 7.0, 1e3], d) * rng.choice([1.0, rng.random()]))[::-1]
        matrix = (q * e) @ q.T
        values, vectors_ = spectrum.leading(matrix, 8)
        k = len(values)
        assert k == min(8, d) and np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:k], rtol=1e-12, atol=1e-12 * e[0])
        assert np.abs(vectors_.T @ vectors_ - np.eye(k)).max() < 1e-12
        assert np.abs(matrix @ vectors_ - vectors_ * values).max() < 1e-11 * e[0]
        shift = float(rng.random() * e[0])
        assert spectrum.count_above(matrix, shift) == (np.linalg.eigvalsh(matrix) > shift).sum()


def test_whitening_by_hand(spark):
    rng = np.random.default_rng(2)
    rows = vectors(rng, 300, dims=6) + [(900, [1.0, 2.0], 1, "", 0), (901, [], 1, "", 0), (None, [0.5] * 6, None, "", 0)]
    out = whitening.whiten(spark.createDataFrame(rows, VECTORS), components=4).toPandas()
    good = [(i, v) for i, v, *_ in rows if v is not None and len(v) == 6 and all(
        x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in good])
    n, sums = len(x), x.sum(0)
    assert len(out) == 4 * n and set(out.n) == {n}
    centred = x - sums / n
    e, vs = np.linalg.eigh(centred.T @ centred / n)
    e, vs = e[::-1][:4], vs[:, ::-1][:, :4]
    want = centred @ vs / np.sqrt(e)
    for c in range(4):
        mine = out[out.component == c + 1].sort_values("vec_id", na_position="last")
        assert (mine.deviation.to_numpy() == ((n * x - sums) ** 2).sum(1)).all()
        w = mine.whitened.to_numpy()
        assert np.allclose(w * np.sign(w[0]), want[:, c] * np.sign(want[0, c]), atol=1e-8)
        assert abs(mine.explained.iloc[0] / (e[c] / (centred ** 2).sum() * n) - 1) < 1e-9
    assert out.identity_error.nunique() == 1 and out.identity_error.iloc[0] < 1e-9


def test_whitening_edges(spark):
    for rows in ([], [(1, None, 1, "", 0)], [(1, [1.0, 2.0], 1, "", 0)] * 3):
        out = whitening.whiten(spark.createDataFrame(rows, VECTORS))
        assert out.count() == 0 and len(out.columns) == 7
    # One direction varies, and so far that a deviation passes 64 bits.
    rows = [(1, [0.0, 1.0], 1, "", 0), (2, [3e9, 1.0], 1, "", 0), (2, [3e9, 1.0], 1, "", 0)]
    out = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(out) == 3 and {r.component for r in out} == {1}
    assert all(r.deviation is None and abs(r.explained - 1) < 1e-12 for r in out)


TURNS = "conv_id long, turn long, role string, text string, formatted string, blocks int"


def test_chats_round_trip(spark):
    rng = random.Random(4)
    pieces = ["<|im_end|>", "<", "\\", "|", "im_sep|>", "<|im_sep|>\n", "a", "é", "\n", "𝄞", "<\\|", "<|nl|>", ""]
    roles = ["user", "assistant", "assistant", None, "", "a\nb", "<|im_start|>", "assistant\n"]

    def text():
        return None if rng.random() < .1 else "".join(rng.choice(pieces) for _ in range(rng.randrange(9)))
    rows = [(c, t if rng.random() < .95 else None, rng.choice(roles), text(), "f", 0)
            for c in (1, 2, 3, None) for t in [rng.randrange(60) for _ in range(40)]]
    rows += [(4, 9, "assistant", None, "f", 0)] * 3
    chats = chat_format.format_chats(spark.createDataFrame(rows, TURNS), span=7)
    found = {r.conv_id: r for r in chat_format.read_back(chats).collect()}
    assert set(found) == {1, 2, 3, 4, None}
    for c, r in found.items():
        mine = sorted(((t is None, t or 0, role or "", x or "") for cc, t, role, x, *_ in rows if cc == c))
        # Ties of a turn go by the role as it is written, then the text as it is written.
        assert sorted(map(tuple, r.turns)) == sorted((role, x) for _, _, role, x in mine)
        assert r.loss_text == "".join(t.text for t in r.turns if t.role == "assistant")
        assert r.formatted.count("<|im_start|>") == 1 + sum(
            a.role != b.role for a, b in zip(r.turns, r.turns[1:]))
        if c == 4:
            assert r.formatted == "<|im_start|>assistant\n<|im_sep|><|im_sep|><|im_end|>\n"


def test_chat_digests_and_merging(spark):
    rows = [(1, 2, "assistant", "B", "", 0), (1, 0, "user", "q", "", 0), (1, 1, "assistant", "A", "", 0),
            (1, 700, "assistant", "C<|", "", 0)]
    df = spark.createDataFrame(rows, TURNS)
    got = {r.conv_id: r for r in chat_format.digests(chat_format.format_chats(
        chat_format.with_control(df))).collect()}
    text = "user\nq\nassistant\nA\nassistant\nB\nassistant\nC<|\n"
    assert (got[1].n_turns, got[1].turns_sha256) == (4, hashlib.sha256(text.encode()).hexdigest())
    assert (got[1].loss_chars, got[1].loss_sha256) == (5, hashlib.sha256(b"ABC<|").hexdigest())
    control = "<|im_end|><|im_start|>assistant ok"
    assert got[-1].loss_sha256 == hashlib.sha256(control.encode()).hexdigest()
    assert chat_format.format_chats(df.filter("conv_id = 1")).first().formatted == (
        "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\nA<|im_sep|>B<|im_sep|>C<\\|<|im_end|>\n")
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_a_very_long_text(spark):
    long_text = "<|" * 200_000
    df = spark.createDataFrame([(1, 0, "assistant", long_text, "", 0)], TURNS)
    r = chat_format.digests(chat_format.format_chats(df)).first()
    assert r.loss_chars == 400_000 and r.loss_sha256 == hashlib.sha256(long_text.encode()).hexdigest()
