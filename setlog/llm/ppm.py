"""Language-model scores: prediction by partial matching over bytes.

Text is its folded words, a space between two, and an end. A trie holds byte contexts up to
``ORDER`` with the counts of what follows them, over all training documents. Tasks hold the contexts
seen most often, as many as ``CELLS`` allows; positions whose context may be a rarer one meet its
counts in a shuffle join, so that every counted context is used. A symbol is coded in the longest context
the trie knows; where it never followed, an escape (method D) leads to the next shorter one, in
which the symbols already ruled out are excluded. Every (context, symbol) has one code length,
so the trie becomes an automaton that scores all texts in lanes. Beside the pretrained trie the
text's own words so far predict its next word (adaptive part), mixed in by fixed weights.
"""

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setlog.llm import lanes
from setlog.llm.text import folded_words, id_remainder, least_count, small, staged

ORDER = 5
END, SPACE, BITS = 256, 32, 9
LN10 = float(np.log(10))
#: Weight of the text's own words so far, and of what followed the word before.
PAST, PAIRS = 0.1, 0.1
DISCOUNT = 0.5  # what each symbol that follows a context gives to its escape
#: Contexts x symbols of the trie's part that reaches the driver and every task; rarer ones are joined.
CELLS = 10_000_000
#: Bytes of text that a task works on together, or one text, if longer.
AT_ONCE = 1_000_000
#: Contexts x symbols that the driver codes together.
CODED = 250_000
#: Distinct grams that a task counts before it hands them on.
COUNTED = 2_000_000
#: Words whose counts every task holds; rarer ones meet their counts in a join.
FREQUENT = 200_000


def held_out(doc_id: Column) -> Column:
    return id_remainder(doc_id, 5) == 1


def symbols(ws: list[bytes], order: int = ORDER) -> np.ndarray:
    """The text's symbols, after ``order`` ends as the context of the first."""
    body = np.frombuffer(b" ".join(ws), np.uint8).astype(np.uint16)
    edge = np.full(order, END, np.uint16)
    return np.concatenate([edge, body, edge[:1]])


def gram_keys(x: np.ndarray, order: int) -> np.ndarray:
    """Context and symbol of every position, ``BITS`` bits each, packed."""
    n = len(x) - order
    key = np.zeros(n, np.int64)
    for k in range(order + 1):
        key = (key << BITS) | x[k:k + n]
    return key


@dataclass
class Trie:
    """``row * width + column`` of ``after`` and ``log10`` tell the next row and the code."""
    column: np.ndarray  # symbol -> column
    width: int
    after: np.ndarray
    log10: np.ndarray
    order: int
    depth: np.ndarray | None = None  # symbols of each row's context

    def costs(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 probability of every symbol of the texts, one after the other; 0 for leads."""
        return self.walk(texts)[0]

    def walk(self, texts: list[np.ndarray], depth: np.ndarray | None = None
             ) -> tuple[np.ndarray, np.ndarray | None]:
        """The same, and ``depth`` of the contexts they were coded in; ``order`` for leads."""
        column = self.column.astype(np.int16)
        matrix, _, begin, length = lanes.blocks([column[x] for x in texts], 0, self.order)
        running = lanes.active(length, len(matrix))
        row = np.zeros(len(begin), np.int32)
        out = np.zeros(sum(map(len, texts)))
        held = None if depth is None else np.full(len(out), self.order, np.int8)
        for t in range(len(matrix)):
            live = running[t]
            at = row[:live] * self.width + matrix[t, :live]
            if t >= self.order:
                out[begin[:live] + t] = self.log10[at]
                if held is not None:
                    held[begin[:live] + t] = depth[row[:live]]
            row[:live] = self.after[at]
        return out, held

    def row_of(self, context: np.ndarray, k: int) -> np.ndarray:
        """The row of the longest end of each packed context of ``k`` symbols that the trie has."""
        row = np.zeros(len(context), np.int64)
        for i in range(k - 1, -1, -1):
            symbol = (context >> (BITS * i)) & ((1 << BITS) - 1)
            row = self.after[row * self.width + self.column[symbol]].astype(np.int64)
        return row


def packed(trie: Trie) -> tuple:
    """The trie as each executor keeps it on its disk."""
    return (trie.column, trie.width, trie.order, trie.depth, *(
        (pa.compress(x.tobytes(), "zstd", asbytes=True), x.nbytes, x.dtype.str) for x in (trie.after, trie.log10)))


def unpacked(column, width, order, depth, *held) -> Trie:
    after, log10 = (np.frombuffer(pa.decompress(data, size, "zstd"), kind) for data, size, kind in held)
    return Trie(column, width, after, log10, order, depth)


def root_keys(context: np.ndarray, depth: np.ndarray, order: int) -> np.ndarray:
    """The shortest end of each packed context that the trie lacks, and its length, packed."""
    k = depth.astype(np.int64) + 1
    return (k << (BITS * order)) | (context & ((1 << (BITS * k)) - 1))


def alike_of(width: int) -> np.ndarray:
    """Symbols per column."""
    out = np.ones(width)
    out[-1] = END + 1 - (width - 1)
    return out


def coded(own: np.ndarray, shorter: np.ndarray, alike: np.ndarray) -> np.ndarray:
    """Probabilities per context (row) from its counts and those of the next shorter context."""
    total = np.maximum(own.sum(1), 1)
    follows = own > 0
    escape = np.where(follows.any(1), DISCOUNT * follows.sum(1) / total, 1.0)
    own = np.maximum(own - DISCOUNT, 0) / total[:, None]
    # What escapes is coded in the shorter context, without the symbols that follow here.
    left = np.maximum((np.where(follows, 0, shorter) * alike).sum(1), 1e-12)
    return np.where(follows, own, shorter * (escape / left)[:, None])


def rare_codes(model: Trie, k: np.ndarray, key: np.ndarray, n: np.ndarray, wanted: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
    """(gram, log10 probability) of those grams of ``wanted`` whose context ends in a rare one.

    ``k``, ``key`` and ``n`` are all grams of the rare contexts that share ends with them.
    """
    mask, alike = (1 << BITS) - 1, alike_of(model.width)
    code = np.zeros(len(wanted))
    found = np.zeros(len(wanted), bool)
    known, rows = np.zeros(0, np.int64), None
    for order in range(1, model.order + 1):
        at = k == order
        contexts = np.unique(key[at] >> BITS)
        if len(contexts):
            own = np.zeros((len(contexts), model.width))
            own[np.searchsorted(contexts, key[at] >> BITS), model.column[key[at] & mask]] = n[at]
            short = contexts & ((1 << (BITS * (order - 1))) - 1)
            row = model.row_of(contexts, order)
            shorter = 10.0 ** model.log10[row[:, None] * model.width + np.arange(model.width)].astype(float)
            if len(known):
                place = np.minimum(np.searchsorted(known, short), len(known) - 1)
                hit = known[place] == short
                shorter[hit] = rows[place[hit]]
            new = coded(own, shorter, alike)
            ends = (wanted >> BITS) & ((1 << (BITS * order)) - 1)
            place = np.minimum(np.searchsorted(contexts, ends), len(contexts) - 1)
            hit = contexts[place] == ends
            code[hit] = np.log10(new[place[hit], model.column[wanted[hit] & mask]])
            found |= hit
            known, rows = contexts, new
        else:
            known = np.zeros(0, np.int64)
    return wanted[found], code[found]


def _earlier(key: np.ndarray) -> np.ndarray:
    """How often each element occurred before it."""
    order = np.argsort(key, kind="stable")
    run = key[order]
    start = np.maximum.accumulate(np.where(np.r_[True, run[1:] != run[:-1]], np.arange(len(run)), 0))
    out = np.empty(len(key), np.int64)
    out[order] = np.arange(len(key)) - start
    return out


def code_lengths(model: "Trie", texts: list[np.ndarray], ids: np.ndarray, sizes: np.ndarray,
                 end_share: float, depth: np.ndarray | None = None) -> tuple[np.ndarray, dict]:
    """log10 probability of each text: per word, the trie's code mixed with the text's own past.

    With ``depth``, also the positions whose context may be longer than the trie's: text, word,
    gram, root, and the word's parts that the position's code goes into.

    ``ids`` numbers the words of all texts, ``sizes`` words each. The past gives a word its
    share of the words so far, and of those that followed the word before.
    """
    cost, held = model.walk(texts, depth)
    flat = np.concatenate(texts)
    lead = np.zeros(len(flat), bool)
    begin = np.concatenate([[0], np.cumsum([len(x) for x in texts])[:-1]])
    for k in range(model.order):
        lead[begin + k] = True
    ends = np.flatnonzero(((flat == SPACE) | (flat == END)) & ~lead)
    by_word = np.diff(np.r_[0.0, np.cumsum(cost)[ends]])
    segments = np.maximum(sizes, 1)
    doc = np.repeat(np.arange(len(texts)), segments)
    first = np.cumsum(segments) - segments
    at = np.arange(len(doc)) - first[doc]
    word = np.full(len(doc), -1, np.int64)
    word[sizes[doc] > 0] = ids
    n = int(word.max()) + 2 if len(word) else 2
    before = _earlier(doc * n + word + 1)
    last = np.where(at > 0, np.r_[-1, word[:-1]], -1)
    pair = np.unique(doc * n + last + 1, return_inverse=True)[1] * n + word + 1
    followed = np.where(at > 0, np.r_[0, before[:-1]], 0)
    share = np.where(at == segments[doc] - 1, end_share, 1 - end_share)
    past = np.where(at > 0, before / np.maximum(at, 1), 0) * share
    pairs = np.where(followed > 0, _earlier(pair) / np.maximum(followed, 1), 0) * share
    own = np.where(at > 0, PAST, 0.0)
    own_pairs = np.where(followed > 0, PAIRS, 0.0)
    with np.errstate(under="ignore"):
        lead_in = np.log10(1 - own - own_pairs)
        mixed = lead_in + by_word
        # Long unlikely words underflow as probabilities, so that the sum is taken in logs.
        extra = own * past + own_pairs * pairs
        with np.errstate(divide="ignore"):
            mixed = np.logaddexp(mixed * LN10, np.log(extra)) / LN10
    sums = np.bincount(doc, weights=mixed, minlength=len(texts))
    if held is None:
        return sums, {}
    at = np.flatnonzero(held < model.order)
    gram = np.zeros(len(at), np.int64)
    for k in range(model.order + 1):
        gram = (gram << BITS) | flat[at - model.order + k]
    of = np.searchsorted(ends, at)
    return sums, {"text": doc[of], "word": of, "gram": gram,
                  "root": root_keys(gram >> BITS, held[at], model.order),
                  "lead": lead_in[of], "cost": by_word[of], "extra": extra[of]}


FAR = ("word", "gram", "root", "lead", "cost", "extra")
#: Stands for all words of a text that its past says nothing of: what changes their codes just adds up.
NEW = -1


def new_words_as_one(far: dict) -> dict:
    """The same positions, words without a past as one and without parts: few bytes move, and fewer sums."""
    new = far["extra"] == 0
    return far | {c: np.where(new, alike, far[c]) for c, alike in (("word", NEW), ("lead", 0.0), ("cost", 0.0))}


def build(grams: dict[int, tuple[np.ndarray, np.ndarray]], order: int) -> Trie:
    """Trie from ``grams[k]``: packed (context of k symbols, symbol) and counts, for contexts
    closed under dropping the first or the last symbol. ``grams`` is emptied on the way.

    Contexts are coded some at a time: beside the trie itself, only the probabilities of the order before and of
    the current one are held.
    """
    mask = (1 << BITS) - 1
    seen = np.unique(grams[0][0] & mask) if 0 in grams else np.zeros(0, np.int64)
    column = np.full(END + 1, len(seen), np.int64)  # one column for symbols never seen
    column[seen] = np.arange(len(seen))
    width = len(seen) + 1
    alike = alike_of(width)
    contexts = {0: np.zeros(1, np.int64)} | {k: np.unique(grams[k][0] >> BITS)
                                             for k in range(1, order + 1) if k in grams}
    first = np.cumsum([0, *(len(contexts.get(k, ())) for k in range(order + 1))])
    log10 = np.zeros((int(first[-1]), width), np.float32)
    shorter, together = np.full((1, width), 1 / (END + 1)), max(CODED // width, 1)
    for k in range(order + 1):
        if k not in contexts:
            break
        key, count = grams.pop(k, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        by = np.argsort(key >> BITS, kind="stable")
        key, count = key[by], count[by]
        own_row = np.searchsorted(contexts[k], key >> BITS)
        short_row = np.searchsorted(contexts[k - 1], contexts[k] & ((1 << (BITS * (k - 1))) - 1)) if k \
            else np.zeros(1, np.int64)
        longer = np.empty((len(contexts[k]), width)) if k + 1 in contexts else None
        for begin in range(0, len(contexts[k]), together):
            end = min(begin + together, len(contexts[k]))
            at = slice(*np.searchsorted(own_row, [begin, end]))
            own = np.zeros((end - begin, width))
            own[own_row[at] - begin, column[key[at] & mask]] = count[at]
            new = coded(own, shorter[short_row[begin:end]], alike)
            log10[first[k] + begin:first[k] + end] = np.log10(new)
            if longer is not None:
                longer[begin:end] = new
        shorter = longer
    del shorter, longer
    after = np.zeros((int(first[-1]), width), np.int32)
    for k in range(order + 1):
        if k not in contexts:
            break
        here = np.arange(first[k], first[k + 1])
        for symbol in [*seen.tolist(), None]:
            c = len(seen) if symbol is None else column[symbol]
            target = np.zeros(len(here), np.int64)
            if symbol is not None:
                done = np.zeros(len(here), bool)
                for m in range(min(k + 1, order), 0, -1):
                    if m not in contexts:
                        continue
                    want = ((contexts[k] << BITS) | symbol) & ((1 << (BITS * m)) - 1)
                    at = np.minimum(np.searchsorted(contexts[m], want), len(contexts[m]) - 1)
                    hit = ~done & (contexts[m][at] == want)
                    target[hit] = first[m] + at[hit]
                    done |= hit
            after[here, c] = target
    depth = np.repeat(np.arange(order + 1, dtype=np.int8), np.diff(first))
    return Trie(column, width, after.ravel(), log10.ravel(), order, depth)


def _word_key(word: bytes) -> int:
    """64 bits that stand for a word."""
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def _added(old, keys: np.ndarray, counts: np.ndarray | None = None):
    """(distinct keys, counts) with ``keys`` added."""
    if counts is None:
        new, n = np.unique(keys, return_counts=True)
    else:
        at = np.argsort(keys, kind="stable")
        keys, counts = keys[at], counts[at]
        first = np.flatnonzero(np.r_[len(keys) > 0, keys[1:] != keys[:-1]][:len(keys)])
        new, n = keys[first], (np.add.reduceat(counts, first) if len(first) else counts)
    if old is None:
        return new, n
    return _added(None, np.concatenate([old[0], new]), np.concatenate([old[1], n]))


def corpus_counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(kind, key, n): kind 0 the grams of all texts, 1 their words, 2 the number of texts."""
    def run(batches):
        parts, held, words, n_texts = [], 0, Counter(), 0
        for batch in small(batches, most=AT_ONCE):
            keys = []
            for x in batch.column("text").to_pylist():
                ws = folded_words(x)
                words.update(ws)
                keys.append(gram_keys(symbols(ws, order), order))
            n_texts += len(keys)
            parts.append(_added(None, np.concatenate(keys)))
            held += len(parts[-1][0])
            if held > COUNTED:
                parts = [_added(None, *map(np.concatenate, zip(*parts)))]
                held = len(parts[0][0])
                if held > COUNTED // 2:
                    yield out(0, *parts.pop())
                    held = 0
            if len(words) > COUNTED // 10:
                yield out(1, *counted(words))
                words = Counter()
        if parts:
            yield out(0, *_added(None, *map(np.concatenate, zip(*parts))))
        if n_texts:
            yield out(1, *counted(words))
            yield out(2, np.zeros(1, np.int64), np.full(1, n_texts))

    def counted(words):
        return (np.fromiter(map(_word_key, words), np.int64, len(words)),
                np.fromiter(words.values(), np.int64, len(words)))

    def out(kind, keys, counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(keys), kind, np.int8)), pa.array(keys), pa.array(counts)],
            ["kind", "key", "n"])
    rows = texts.select("text").mapInArrow(run, "kind byte, key long, n long")
    return rows.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def trie_of(counts: DataFrame, order: int = ORDER, cells: int = CELLS
            ) -> tuple[Trie, DataFrame | None]:
    """The trie of the contexts seen most often, as many as ``cells`` holds, and (k, key, n) of
    the grams of all others, if there are any."""
    grams = counts.filter("kind = 0")
    by_order = [grams.select(F.lit(k).alias("k"), F.col("key").bitwiseAND(
        (1 << (BITS * (k + 1))) - 1).alias("key"), "n") for k in range(order + 1)]
    every = by_order[0]
    for more in by_order[1:]:
        every = every.unionByName(more)
    every = staged(every.groupBy("k", "key").agg(F.sum("n").alias("n")).withColumn(
        "context", F.shiftright("key", BITS)), "grams")
    contexts = every.groupBy("k", "context").agg(F.sum("n").alias("seen"))
    # The empty context is always held.
    width = every.filter("k = 0").count() + 1
    least = least_count(contexts, "seen", max(cells // width, 1))
    held = (F.col("seen") >= least) | (F.col("k") == 0)
    kept = every.join(contexts.filter(held), ["k", "context"], "left_semi").select(
        "k", "key", "n").toArrow()
    k, key, n = (kept.column(c).to_numpy() for c in ("k", "key", "n"))
    grams = {o: (key[k == o], n[k == o]) for o in range(order + 1) if (k == o).any()}
    # Beside the trie the driver holds its grams once.
    del kept, k, key, n
    trie = build(grams, order)
    rest = every.join(contexts.filter(~held), ["k", "context"], "left_semi").select("k", "key", "n")
    return trie, rest if least > 1 else None


def far_codes(shared, rest: DataFrame, wanted: DataFrame) -> DataFrame:
    """(gram, change) of the wanted (root, gram) whose context the trie lacks and ``rest`` has: log10 of its
    probability, less that of the trie's code, which the gram tells.

    Grams that share a root meet in one task; a root was seen less often than the trie's contexts.
    """
    most = 20_000  # grams worked on together, at least those of one root

    def rooted(batches):
        model = unpacked(*shared.value[0])
        for batch in batches:
            k, key = batch.column("k").to_numpy(), batch.column("key").to_numpy()
            root = np.zeros(len(k), np.int64)
            for o in np.unique(k).tolist():
                at = k == o
                context = key[at] >> BITS
                root[at] = root_keys(context, model.depth[model.row_of(context, o)], model.order)
            yield pa.RecordBatch.from_arrays(
                [pa.array(root), batch.column("k"), batch.column("key"), batch.column("n")],
                ["root", "k", "key", "n"])

    def code(batches):
        model = unpacked(*shared.value[0])
        parts, held = [], 0

        def out(root, k, key, n):
            is_wanted = k < 0
            gram, value = rare_codes(model, k[~is_wanted], key[~is_wanted], n[~is_wanted], key[is_wanted])
            held = model.log10[model.row_of(gram >> BITS, model.order) * model.width
                               + model.column[gram & ((1 << BITS) - 1)]]
            return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(value - held)], ["gram", "change"])
        for batch in batches:
            parts.append([batch.column(c).to_numpy() for c in ("root", "k", "key", "n")])
            held += batch.num_rows
            if held < most:
                continue
            whole = [np.concatenate(x) for x in zip(*parts)]
            # The last root may go on in the next batch.
            begin, last = 0, int(np.searchsorted(whole[0], whole[0][-1]))
            while begin < last:
                end = last if last - begin <= most else int(np.searchsorted(
                    whole[0], whole[0][begin + most - 1], side="right"))
                yield out(*(x[begin:end] for x in whole))
                begin = end
            parts, held = [[x[last:] for x in whole]], len(whole[0]) - last
        if held:
            yield out(*(np.concatenate(x) for x in zip(*parts)))
    grams = rest.select(F.col("k").cast("int"), "key", "n").mapInArrow(
        rooted, "root long, k int, key long, n long")
    both = grams.unionByName(wanted.select(
        "root", F.lit(-1).alias("k"), F.col("gram").alias("key"), F.lit(0).cast("long").alias("n")))
    return both.repartition("root").sortWithinPartitions("root").mapInArrow(code, "gram long, change double")


def _mixed(cost) -> Column:
    """log10 of a word's probability from the trie's code of it and its own past."""
    mine = F.col("lead") + cost
    past = F.log10(F.when(F.col("extra") > 0, F.col("extra")))
    high, low = F.greatest(mine, past), F.least(mine, past)
    return F.when(past.isNull(), mine).otherwise(high + F.log10(1 + F.pow(F.lit(10.0), low - high)))


def score(docs: DataFrame, order: int = ORDER, cells: int = CELLS,
          frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    A null text counts as empty: one end. Repeated rows are scored (and learned from) each;
    other columns aren't looked at. With nothing to learn from all symbols are alike.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    counts = staged(corpus_counts(rows.filter("not held_out"), order), "corpus-counts")
    trie, rest = trie_of(counts, order, cells)
    known = counts.filter("kind = 1")
    n_words, n_kinds, n_texts = (x or 0 for x in counts.agg(
        F.sum(F.expr("if(kind = 1, n, 0)")), F.sum(F.expr("if(kind = 1, 1, 0)")),
        F.sum(F.expr("if(kind = 2, n, 0)"))).first())
    tokens = n_words + n_texts
    log_all = float(np.log10(tokens + 0.5 * (n_kinds + bool(n_texts) + 1)))
    end = float(np.log10(n_texts + 0.5)) - log_all
    top = known.filter(F.col("n") >= least_count(known, "n", frequent)).select("key", "n").toArrow()
    top_keys, top_n = top.column("key").to_numpy(), top.column("n").to_numpy()
    at = np.argsort(top_keys)
    shared = spark.sparkContext.broadcast(
        (packed(trie), top_keys[at], top_n[at]))
    any_rest = rest is not None
    end_known = int(n_texts > 0)
    end_share = n_texts / tokens if tokens else 0.5
    del trie

    def run(batches):
        held, keys, n = shared.value
        model = unpacked(*held)
        gain = np.log10(n + 0.5) - log_all
        uid = TaskContext.get().partitionId() << 36
        for batch in small(batches, most=AT_ONCE):
            texts = [folded_words(x) for x in batch.column("text").to_pylist()]
            number: dict[bytes, int] = {}
            size = np.array([len(ws) for ws in texts], np.int64)
            ids = np.fromiter((number.setdefault(w, len(number)) for ws in texts for w in ws),
                              np.int64, int(size.sum()))
            key = np.fromiter(map(_word_key, number), np.int64, len(number))
            if len(keys):
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[place] == key
                worth = np.where(hit, gain[place], 0.0)
            else:
                hit, worth = np.zeros(len(key), bool), np.zeros(len(key))
            owner = np.repeat(np.arange(len(texts)), size)
            base = np.bincount(owner, weights=worth[ids], minlength=len(texts))
            n_known = np.bincount(owner, weights=hit[ids], minlength=len(texts)).astype(np.int64)
            rare = ~hit[ids]
            pair, tf = np.unique(owner[rare] * max(len(number), 1) + ids[rare], return_counts=True)
            who, what = np.divmod(pair, max(len(number), 1))
            offsets = np.searchsorted(who, np.arange(len(texts) + 1)).astype(np.int32)
            del owner, rare, number
            scores, far, done, words_done = [], [], 0, 0
            for first, run_ in lanes.groups([symbols(ws, order) for ws in texts]):
                some = size[first:first + len(run_)]
                sums, more = code_lengths(model, run_, ids[done:done + some.sum()], some, end_share,
                                          model.depth if any_rest else None)
                scores.append(sums)
                if any_rest:
                    more["text"] = more["text"] + first
                    more["word"] = more["word"] + words_done
                    far.append(new_words_as_one(more))
                done += some.sum()
                words_done += int(np.maximum(some, 1).sum())
            far = {c: np.concatenate([x[c] for x in far] or [np.zeros(0, np.int64)])
                   for c in ("text", *FAR)} if any_rest else {c: np.zeros(0, np.int64) for c in ("text", *FAR)}
            far_offsets = np.searchsorted(far["text"], np.arange(len(texts) + 1)).astype(np.int32)
            far_rows = pa.StructArray.from_arrays(
                [pa.array(far[c], pa.int64() if c in FAR[:3] else pa.float64()) for c in FAR], list(FAR))
            scores = np.concatenate(scores or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([
                pa.array(uid + np.arange(len(texts))), batch.column("doc_id"),
                batch.column("held_out"), pa.array(size + 1), pa.array(n_known + end_known),
                pa.array(base + end), pa.array(scores.astype(float)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(key[what])),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(tf)),
                pa.ListArray.from_arrays(pa.array(far_offsets), far_rows)],
                ["uid", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score",
                 "rare", "times", "far"])
            uid += len(texts)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    scored = staged(rows.mapInArrow(run, f"uid long, doc_id {id_type}, held_out boolean, "
                    "n_tokens long, n_known long, base_score double, score double, "
                    "rare array<long>, times array<long>, far array<struct<word: long, gram: long, "
                    "root: long, lead: double, cost: double, extra: double>>"), "scored")
    rare = scored.select("uid", F.inline(F.arrays_zip("rare", "times")).alias("key", "times"))
    more = rare.join(known.select("key", "n"), "key", "left").groupBy("uid").agg(
        F.sum(F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + 0.5) - log_all)).alias("more"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"))
    if any_rest:
        far = scored.select("uid", F.inline("far"))
        codes = far_codes(shared, rest, far.select("root", "gram").distinct())
        words = far.drop("root").join(codes, "gram").groupBy("uid", "word").agg(
            F.sum("change").alias("change"),
            *(F.first(c).alias(c) for c in ("lead", "cost", "extra")))
        changes = words.groupBy("uid").agg(F.sum(
            _mixed(F.col("cost") + F.col("change")) - _mixed(F.col("cost"))).alias("change"))
        scored = scored.join(changes, "uid", "left").withColumn(
            "score", F.col("score") + F.coalesce("change", F.lit(0.0)))
    return scored.join(more, "uid", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score")
