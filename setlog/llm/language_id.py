"""Language by cross-parsing: the language whose text explains a document in fewest phrases.

Per language, a suffix automaton of labelled text. A document is cut greedily into the longest
substrings that occur in that text; a phrase costs the logarithm of the text's length. The
automaton with its restarts is one table, so all documents and languages are parsed in lanes; a table
that would be large is kept as a hash table of its moves.
A phrase ends at a block's end, for every language alike.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setlog.llm import lanes
from setlog.llm.text import id_remainder, small, staged

FIT_DOCS = 64  # documents sampled for a language's automaton, at most
CELLS = 16_000_000  # states x letters over all languages, beyond which moves are hashed
PAD, BREAK, OTHER = 0, 1, 2
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    return id_remainder(doc_id, 4) == 2


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)


def letter_table() -> np.ndarray:
    """Per code point: OTHER for letters, BREAK for all else."""
    return np.fromiter((OTHER if chr(c).isalpha() else BREAK for c in range(0x110000)),
                       np.uint8, 0x110000)


def folded(text: str | None, table: np.ndarray) -> np.ndarray:
    """Letters' numbers, each run of anything else as one BREAK."""
    x = table[code_points(text or "")]
    return x[~((x == BREAK) & (np.r_[x.dtype.type(BREAK), x[:-1]] == BREAK))] if len(x) else x


def automaton_moves(x: np.ndarray) -> list[dict[int, int]]:
    """Per state, letter to state, of the automaton of all substrings of ``x``."""
    link, length, go = [-1], [0], [{}]
    last = 0
    for c in x.tolist():
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p != -1:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and go[p].get(c) == q:
                    go[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return go


def suffix_automaton(x: np.ndarray, width: int) -> np.ndarray:
    """The same as a table (states x width, -1 for none)."""
    go = automaton_moves(x)
    table = np.full((len(go), width), -1, np.int32)
    for state, moves in enumerate(go):
        for c, target in moves.items():
            table[state, c] = target
    return table


def parser(x: np.ndarray, width: int) -> np.ndarray:
    """Per state and letter: next state times 2, plus 1 where a new phrase begins."""
    moves = suffix_automaton(x, width)
    moves[:, [PAD, OTHER]] = -1
    restart = np.maximum(moves[0], 0) * 2 + 1
    table = np.where(moves >= 0, moves * 2, restart[None, :]).astype(np.int32)
    table[0] = restart
    table[:, PAD] = 0
    return table


def _slot(key: np.ndarray, slots: int) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(
        64 - (slots.bit_length() - 1))).astype(np.int64)


def hashed_parser(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``parser``'s moves as keys (state x width + letter, -1 for none) and values of an open hash
    table, and the moves where the state has none by that letter."""
    go = automaton_moves(x)
    sizes = np.fromiter(map(len, go), np.int64, len(go))
    n = int(sizes.sum())
    letter = np.fromiter((c for moves in go for c in moves), np.int64, n)
    target = np.fromiter((t for moves in go for t in moves.values()), np.int64, n)
    state = np.repeat(np.arange(len(go)), sizes)
    del go
    known = (letter != PAD) & (letter != OTHER)
    letter, target, state = letter[known], target[known], state[known]
    restart = np.ones(width, np.int32)
    restart[letter[state == 0]] = target[state == 0] * 2 + 1
    restart[PAD] = 0
    at = state > 0  # the first state's moves all begin phrases
    key, value = state[at] * width + letter[at], (target[at] * 2).astype(np.int32)
    slots = 1 << max(2 * len(key), 2).bit_length()
    keys, values = np.full(slots, -1, np.int64), np.zeros(slots, np.int32)
    slot = _slot(key, slots)
    while len(key):
        free = keys[slot] < 0
        keys[slot[free]] = key[free]  # of several the last stays
        done = keys[slot] == key
        values[slot[done]] = value[done]
        key, value, slot = key[~done], value[~done], (slot[~done] + 1) & (slots - 1)
    return keys, values, restart


def moved(table, width: int, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """Next state times 2, plus 1 where a new phrase begins."""
    if isinstance(table, np.ndarray):
        return table[state * width + letter]
    keys, values, restart = table
    key = state.astype(np.int64) * width + letter
    slot = _slot(key, len(keys))
    held = keys[slot]
    hit = held == key
    out = np.where(hit, values[slot], restart[letter])
    left = np.flatnonzero(~hit & (held >= 0))
    slot = slot[left]
    while len(left):
        slot = (slot + 1) & (len(keys) - 1)
        held = keys[slot]
        hit = held == key[left]
        out[left[hit]] = values[slot[hit]]
        on = ~hit & (held >= 0)
        left, slot = left[on], slot[on]
    return out


@dataclass
class Model:
    languages: list[str]
    letters: np.ndarray
    width: int
    tables: list  # of a parser or a hashed parser
    bits: np.ndarray  # of a phrase, per language

    def costs(self, texts: list[np.ndarray]) -> np.ndarray:
        """Texts x languages: bits of all phrases per character."""
        out = np.zeros((len(texts), len(self.languages)))
        for first, run in lanes.groups(texts):
            matrix, owner, _, length = lanes.blocks(run, PAD)
            running = lanes.active(length, len(matrix))
            for k, table in enumerate(self.tables):
                state = np.zeros(len(owner), np.int32)
                phrases = np.zeros(len(owner), np.int32)
                for t in range(len(matrix)):
                    live = running[t]
                    move = moved(table, self.width, state[:live], matrix[t, :live])
                    phrases[:live] += move & 1
                    state[:live] = move >> 1
                np.add.at(out[:, k], first + owner, phrases)
        sizes = np.maximum([len(x) for x in texts], 1)
        return out * self.bits / sizes[:, None] if len(texts) else out


def fit(texts: dict[str, list[str]]) -> Model:
    """Automata from the texts of each language; every letter of theirs is told apart."""
    languages = sorted(texts, key=lambda x: x.encode())
    points = [code_points(t) for lang in languages for t in texts[lang]]
    kinds = letter_table()
    every = np.unique(np.concatenate(points or [np.zeros(0, np.uint32)]))
    known = kinds[every] == OTHER
    width = OTHER + 1 + int(known.sum())
    kinds = kinds.astype(np.min_scalar_type(width))
    kinds[every[known]] = np.arange(OTHER + 1, width)
    learned = [np.concatenate([np.r_[kinds.dtype.type(BREAK), folded(t, kinds)] for t in texts[lang]])
               for lang in languages]
    small_enough = sum(map(len, learned)) * 2 * width <= CELLS
    tables = [parser(x, width).ravel() if small_enough else hashed_parser(x, width) for x in learned]
    bits = [np.log2(max(len(x), 2)) for x in learned]
    return Model(languages, kinds, width, tables, np.array(bits))


def sample(rows: DataFrame) -> dict[str, list[str]]:
    """Per language the ``FIT_DOCS`` labelled texts (all, if fewer) whose hash of id and text is least.

    Every task names the least hashes of its rows, so that those alone move, whatever the number of
    rows; then the texts they stand for are read. Rows alike in id and text count once.
    """
    hashed = rows.select("lang", F.xxhash64("doc_id", "text").alias("hash"), "text")

    def least(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            hashes, lang = batch.column("hash").to_numpy(), batch.column("lang").dictionary_encode()
            codes = lang.indices.to_numpy()
            for k, name in enumerate(lang.dictionary.to_pylist()):
                both = np.concatenate([held.get(name, hashes[:0]), hashes[codes == k]])
                held[name] = np.unique(both)[:FIT_DOCS]
        yield pa.RecordBatch.from_arrays(
            [pa.array([name for name, x in held.items() for _ in x], pa.string()),
             pa.array([h for x in held.values() for h in x.tolist()], pa.int64())], ["lang", "hash"])
    named = hashed.select("lang", "hash").mapInArrow(least, "lang string, hash long").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    # At most FIT_DOCS hashes a language.
    chosen = staged(named.withColumn("place", place).filter(F.col("place") <= FIT_DOCS).drop("place"), "sampled")
    texts = hashed.join(F.broadcast(chosen), ["lang", "hash"]).dropDuplicates(["lang", "hash"])
    out: dict[str, list[str]] = {}
    for lang, text in texts.select("lang", "text").orderBy("lang", F.xxhash64("text"), "text").collect():
        out.setdefault(lang, []).append(text)
    return out


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    ``und`` with score 0 for null texts, texts without a letter, and where nothing was
    learned. Ties go to the first language by code point. The score falls with the ratio of
    the best to the second best cost. Repeated rows get repeated results; other columns aren't
    looked at.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text", "lang")
    learned = rows.filter("not held_out and lang is not null and text is not null")
    model = fit(sample(learned))
    shared = spark.sparkContext.broadcast(
        (model.languages, model.letters, model.width, model.tables, model.bits))

    def run(batches):
        model = Model(*shared.value)
        n = len(model.languages)
        for batch in small(batches):
            pred, score = [], []
            raw = batch.column("text").to_pylist()
            texts = [folded(t, model.letters) for t in raw]
            cost = model.costs(texts) if n else None
            for k, x in enumerate(texts):
                if not n or not (x > BREAK).any():
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    continue
                best = int(np.argmin(cost[k]))
                pred.append(model.languages[best])
                second = np.partition(cost[k], 1)[1] if n > 1 else np.inf
                score.append(float(1 - 0.5 * cost[k, best] / second) if second > 0 else 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()),
                 pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")
