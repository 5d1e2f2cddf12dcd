"""Line dedup by content-defined chunks, in DataFrame functions alone.

A rolling hash over the hashes of two lines says where a chunk of lines ends, so that chunks
begin alike wherever a passage stands. Chunks of two lines or more that occur again anywhere lose
all but their first occurrence, after their bytes were compared with it. Several boundary hashes
cut every text in several ways, which catches shorter passages. A line goes if it is in a later
occurrence of some chunk and in no first one, so first occurrences stay whole.

With ``words`` (in the query and in ``without_repeats``) more is looked at: the shortest run of lines of ``LEAST_WORDS`` words from every
line on and up to every line, blank lines aside. Each line of a shared run of so many words is in one of them,
wherever the run stands. There a line goes if it is in a later occurrence of anything; its first one stays.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setlog.llm.text import columns, staged, unused

#: (factor of a line, factor of the line before) of each boundary hash.
CUTS = ((1, 31), (17, 5), (7, 101))
WORD = r"[^\\x20\\x09-\\x0D]+"  # as a literal of SQL
PRIME, EVERY = 1_000_003, 2  # one line in EVERY ends a chunk, about
LEAST_LINES = 2
LEAST_WORDS = 50  # of a shared run of lines that counts whatever its lines


def spans_of(lines: str, hashes: str, cuts=CUTS, every: int = EVERY,
             least: int = LEAST_LINES) -> tuple[list[Column], Column]:
    """The chunks' ends by each cut, and from them the distinct (start, end), 1-based, of the
    chunks of ``least`` lines or more."""
    def ends(a: int, b: int) -> str:
        rolled = (f"({a}L * {hashes}[i - 1] + {b}L * if(i > 1, {hashes}[greatest(i - 2, 0)], 0L)) "
                  f"% {PRIME}L % {every}L = 0")
        return f"filter(sequence(1, size({lines})), i -> i = size({lines}) or {rolled})"
    chunks = ", ".join(
        "transform(ends_, (e, k) -> struct(if(k = 0, 1, ends_[greatest(k - 1, 0)] + 1) as start, "
        "e as end))".replace("ends_", f"ends_{k}") for k in range(len(cuts)))
    return ([F.expr(ends(*c)).alias(f"ends_{k}") for k, c in enumerate(cuts)],
            F.expr(f"filter(array_distinct(concat({chunks})), c -> c.end - c.start + 1 >= {least})"))


def _runs(filled: str, upto: str, words: int) -> str:
    """(start, end, tight) of the shortest runs of ``words`` words that begin or end at each line
    of ``filled``, the places of lines with words; ``upto`` has the words up to the end of each."""
    n = f"size({filled})"
    down = (f"reverse(transform(sequence(1, {n}), i -> element_at({upto}, -1) - "
            f"if(i = 1, 0, {upto}[greatest(i - 2, 0)])))")

    def runs(of: str, start: str, end: str, near: int = 8) -> str:
        # ``more`` lines follow the first until a run is whole: each has a word, most have several.
        aims = f"transform(sequence(1, {n}), i -> struct(i, if(i = 1, 0, of[greatest(i - 2, 0)]) + {words} as aim))"
        more = (f"transform({aims}, p -> struct(p.i, size(filter(slice(of, p.i, if(coalesce(get(of, p.i + {near - 2}), 0)"
                f" >= p.aim, {near}, {words})), x -> x < p.aim)) as more))")
        return (f"transform(array({of}), of -> transform({more}, p -> if(p.i + p.more > {n}, null, struct("
                f"{filled}[{start}] as start, {filled}[{end}] as end, true as tight))))[0]")
    ahead = runs(upto, "p.i - 1", "p.i - 1 + p.more")
    back = runs(down, f"{n} - p.i - p.more", f"{n} - p.i")
    return f"if({n} = 0, array(), filter(concat({ahead}, {back}), c -> c is not null))"


def _running(counts: str, block: int = 256) -> str:
    """Running sums of an array, block by block: appending to one long array would copy it each time."""
    blocks = f"transform(sequence(0, (size({counts}) - 1) div {block}), b -> slice({counts}, b * {block} + 1, {block}))"
    return (f"if(size({counts}) = 0, cast(array() as array<int>), flatten(aggregate({blocks}, "
            "cast(array() as array<array<int>>), (done, b) -> array_append(done, slice(aggregate(b, "
            "array(if(size(done) = 0, 0, element_at(element_at(done, -1), -1))), "
            f"(sums, x) -> array_append(sums, element_at(sums, -1) + x)), 2, {block})))))")


def _cut(docs: DataFrame, cuts, every: int, least: int, words: int | None = None) -> DataFrame:
    """key, doc_id, lines and spans (chunks, runs of ``words``) of every text; there may be none."""
    keyed = docs.filter("text is not null").select(
        F.xxhash64("doc_id", "text").alias("key"), "doc_id", F.split("text", "\n", -1).alias("lines"))
    hashed = (keyed if words else keyed.filter(F.size("lines") >= least)).withColumn("hashes", F.expr(
        "transform(lines, l -> cast(conv(substring(md5(l), 1, 7), 16, 10) as bigint))"))
    ends, spans = spans_of("lines", "hashes", cuts, every, least)
    cut = hashed.select("key", "doc_id", "lines", *ends).select(
        "key", "doc_id", "lines",
        F.transform(spans, lambda c: F.struct(c.start, c.end, F.lit(False).alias("tight"))).alias("spans"))
    if not words:
        return cut
    counted = cut.withColumn("counts", F.expr(
        rf"transform(lines, l -> regexp_count(l, '{WORD}'))")).withColumn("filled", F.expr(
            "filter(sequence(1, size(lines)), i -> counts[i - 1] > 0)")).withColumn(
        "counts", F.expr("filter(counts, n -> n > 0)")).withColumn("upto", F.expr(_running("counts")))
    # No filter on the spans: it would be pushed below the projections and work the lambdas anew per line.
    return counted.select("key", "doc_id", "lines", F.expr(
        f"array_distinct(concat(spans, {_runs('filled', 'upto', words)}))").alias("spans"))


def _piece(c: str) -> str:
    """The chunk's bytes; those of its lines with words where it is ``tight``."""
    part = f"slice(lines, {c}.start, {c}.end - {c}.start + 1)"
    return f"array_join(if({c}.tight, filter({part}, l -> l rlike '{WORD}'), {part}), '\\n')"


def _found(cut: DataFrame) -> DataFrame:
    """key, doc_id, start, end, tight and hash (of the hashes of its lines) of every chunk and run."""
    part = "slice({0}, c.start, c.end - c.start + 1)".format
    # Blank lines have no hash where the chunk is tight.
    hashed = cut.select("key", "doc_id", "spans", F.expr("transform(lines, l -> xxhash64(l))").alias("line_hashes"),
                        F.expr(rf"transform(lines, l -> if(l rlike '{WORD}', xxhash64(l), null))").alias("word_hashes"))
    return hashed.select("key", "doc_id", F.expr(
        "inline(transform(spans, c -> struct(c.start as start, c.end as end, c.tight as tight, xxhash64(if(c.tight, "
        f"array_compact({part('word_hashes')}), {part('line_hashes')})) as hash)))"))


#: Of spans in order a smallest choice that covers the same lines: each time the one that reaches farthest.
_COVER = """aggregate(array_sort(spans), named_struct('chosen', cast(array() as array<{0}>), 'reach', 0,
    'best', cast(null as {0})),
  (a, s) -> if(s.start <= a.reach + 1,
    named_struct('chosen', a.chosen, 'reach', a.reach, 'best', if(coalesce(a.best.end, 0) >= s.end, a.best, s)),
    named_struct('chosen', if(coalesce(a.best.end, 0) > a.reach, array_append(a.chosen, a.best), a.chosen),
      'reach', if(s.start > greatest(a.reach, coalesce(a.best.end, 0)) + 1, s.start - 1,
                  greatest(a.reach, coalesce(a.best.end, 0))), 'best', s)),
  a -> if(coalesce(a.best.end, 0) > a.reach, array_append(a.chosen, a.best), a.chosen))""".format(
    "struct<start:int,end:int,tight:boolean,hash:bigint>")


def removals(docs: DataFrame, cuts=CUTS, every: int = EVERY, least: int = LEAST_LINES,
             words: int | None = None) -> DataFrame:
    """key, and the arrays ``later`` and ``firsts`` of (start, end), of texts with repeated chunks.

    Hashes that occur again are found first, from hashes alone; only chunks with one of them move after that.
    With ``words`` only later occurrences count, and of each text as few as cover all their lines are compared.
    """
    cut = _cut(docs, cuts, every, least, words)
    found = _found(cut)
    again = staged(found.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"), "line-hashes")
    hits = staged(found.join(again, "hash", "left_semi"), "line-chunks")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "start", "end", "tight")
    first = hits.groupBy("hash").agg(F.min(place).alias("first")).select(
        "hash", F.col("first.key").alias("first_key"), F.col("first.start").alias("first_start"),
        F.col("first.end").alias("first_end"), F.col("first.tight").alias("first_tight"))
    is_first = (F.col("key") == F.col("first_key")) & (F.col("start") == F.col("first_start")) & (
        F.col("end") == F.col("first_end"))
    span = F.struct("start", "end", "tight", "hash")
    if words:
        covers = staged(hits.join(first, "hash").filter(~is_first).groupBy("key").agg(
            F.collect_set(span).alias("spans")).select("key", F.expr(f"inline({_COVER})")), "line-covers")
        wanted = covers.select("hash").distinct().join(first, "hash").select(
            F.col("first_key").alias("key"), F.col("first_start").alias("start"), F.col("first_end").alias("end"),
            F.col("first_tight").alias("tight"), "hash", F.lit(True).alias("is_first"))
        placed = covers.withColumn("is_first", F.lit(False)).unionByName(wanted)
    else:
        placed = hits.join(first, "hash").select("key", "start", "end", "tight", "hash", is_first.alias("is_first"))
    marked = placed.groupBy("key").agg(F.collect_set(
        F.struct("start", "end", "tight", "hash", "is_first")).alias("found"))
    # The bytes of repeated chunks alone move: each later one meets its first.
    lines = cut.select("key", "lines").join(marked, "key")
    pieces = lines.select("key", F.expr(
        "inline(transform(found, c -> struct(c.start as start, c.end as end, c.hash as hash, "
        f"c.is_first as is_first, {_piece('c')} as piece)))"))
    firsts = pieces.filter("is_first").select(
        "hash", F.col("piece").alias("first_piece")).dropDuplicates(["hash"])
    checked = pieces.join(firsts, "hash").filter("is_first or piece = first_piece")
    span = F.struct("start", "end")
    return checked.groupBy("key").agg(
        F.collect_set(F.when(~F.col("is_first"), span)).alias("later"),
        F.collect_set(F.when(F.col("is_first"), span)).alias("firsts"))


def _shortened(docs: DataFrame, result: str, cuts, every: int, least: int,
               words: int | None = None) -> DataFrame:
    """``docs`` with the struct ``result`` of kept text, n_lines and n_removed."""
    gone = removals(docs, cuts, every, least, words).filter(F.size("later") > 0).select(
        F.struct("key", "later", "firsts").alias(result))
    joined = docs.join(gone, F.xxhash64("doc_id", "text") == F.col(f"{result}.key"), "left")
    spans = ("flatten(transform({0}.later, c -> sequence(c.start, c.end)))",
             "flatten(transform({0}.firsts, c -> sequence(c.start, c.end)))")
    drop = F.expr((f"array_distinct({spans[0]})" if words else
                   f"array_except({spans[0]}, {spans[1]})").format(f"`{result}`"))
    # Lines are a column used twice, so that no lambda splits the text anew for each of them.
    lines = unused(docs, "text_lines")
    joined = joined.select(*columns(docs), drop.alias(result), F.split("text", "\n", -1).alias(lines))
    kept = F.expr(f"transform(array_except(sequence(1, size(`{lines}`)), `{result}`), i -> element_at(`{lines}`, i))")
    return joined.select(*columns(docs), F.struct(
        F.when(F.coalesce(F.size(result), F.lit(-1)) <= 0, F.col("text")).otherwise(
            F.array_join(kept, "\n")).alias("kept_text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col(result).isNull(), 0).otherwise(F.size(result)).cast("long").alias("n_removed"),
    ).alias(result))


def dedup_lines(docs: DataFrame, cuts=CUTS, every: int = EVERY,
                least: int = LEAST_LINES, words: int | None = None) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_removed`` (in place of such columns).

    With ``words`` the runs of so many words count too, as in ``without_repeats``.

    First is the occurrence with the lowest id (null last), then key, then place. Rows alike in
    id and text are one document and get the same result. Null texts stay null with 0 lines; a
    text all of whose lines go becomes empty. An empty table gives an empty one.
    """
    result = unused(docs, "dedup")
    out = _shortened(docs, result, cuts, every, least, words)
    return out.drop("kept_text", "n_lines", "n_removed").select(
        *columns(docs.drop("kept_text", "n_lines", "n_removed")), f"{result}.*")


def without_repeats(docs: DataFrame, cuts=CUTS, every: int = EVERY,
                    least: int = LEAST_LINES, words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` without repeated chunks and runs of ``words`` words (and ``n_chars`` of what is left, where there is
    such a column)."""
    result = unused(docs, "dedup")
    out = _shortened(docs, result, cuts, every, least, words)
    changed = {"text": F.col(f"{result}.kept_text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col(f"{result}.n_removed") > 0, F.char_length(
            F.col(f"{result}.kept_text")).cast(kind)).otherwise(F.col("n_chars"))
    return out.select(*(changed.get(name, column).alias(name)
                        for name, column in zip(docs.columns, columns(docs), strict=True)))
