"""Benchmark decontamination by templates, in DataFrame functions alone.

Numbers, names (capitals inside a sentence) and units after a number become typed slots, so
that a question with other figures has the same template. Windows of template words join by hash, all of the
benchmark and all of the documents. A hit aligns the whole item with the document; it is a
leak if enough words agree and the slots are filled consistently: equal values by equal
values, different by different. What neighbouring shifts of one item hold is added up too, so that
items with words put in or left out are found; there slots count inside runs of ``WINDOW`` agreeing words alone.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setlog.llm.text import staged, unused

WINDOW, LITERALS = 6, 3  # words, and words of a window that are no slots
COVER = 0.5  # part of an item's words that must agree
BROADCAST_WINDOWS = 500_000  # benchmark windows that are broadcast, at most
UNITS = ("km", "m", "cm", "mm", "kg", "g", "mg", "l", "ml", "s", "h", "min", "hours", "hour",
         "minutes", "seconds", "days", "years", "miles", "feet", "inches", "pounds", "dollars",
         "euros", "cents", "percent", "degrees", "meters", "metres", "liters", "litres", "grams")
SPACE = r"[\x20\x09-\x0D]"
MARKS = "#@~"  # of number, name and unit; such characters of the text itself go first
#: (pattern, replacement with $n) in turn.
STEPS = (
    (r"([^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*)", "#$1"),
    (rf"([.!?:;][^\p{{L}}.!?:;\x20\x09-\x0D]*{SPACE}+)(\p{{Lu}})", "$1^$2"),
    (rf"({SPACE}[^\p{{L}}\x20\x09-\x0D#^]*)(\p{{Lu}}\p{{Ll}}+)", "$1@$2"),
    (r"[^\p{L}\p{N}#@\x20\x09-\x0D]+", ""),
    (rf"(#[^\x20\x09-\x0D]*{SPACE}+)({'|'.join(UNITS)})({SPACE})", "$1~$2$3"),
)
#: The first pattern as written for an engine that goes back: tried once a word, never character by character.
ANCHORED = {STEPS[0][0]: r"(?<![^\x20\x09-\x0D])([^0-9\x20\x09-\x0D]*+[0-9][^\x20\x09-\x0D]*+)"}


def _marked(text: Column) -> Column:
    """The text in lower case without punctuation, slots as a mark and the value."""
    out = F.concat(F.lit(". "), F.translate(text, MARKS + "^", ""), F.lit(" "))
    for pattern, replacement in STEPS:
        out = F.regexp_replace(out, ANCHORED.get(pattern, pattern), replacement)
    return F.lower(out)


def _split(text: Column) -> Column:
    return F.split(F.btrim(text, F.lit(" \t\n\x0b\f\r")), SPACE + "+")


def valued(text: Column) -> Column:
    """The marked text's words as an array."""
    return _split(_marked(text))


def template(text: Column) -> Column:
    """The same, with slots as their mark alone."""
    return _split(F.regexp_replace(_marked(text), rf"([{MARKS}])[^\x20\x09-\x0D]+", "$1"))


def windows(words: str, window: int = WINDOW) -> Column:
    """(place, hash) of the windows of array ``words``."""
    return F.expr(
        f"transform(if(size({words}) < {window}, array(), "
        f"sequence(0, size({words}) - {window})), "
        f"p -> struct(p as place, xxhash64(slice({words}, p + 1, {window})) as hash))")


def _aligned(docs: DataFrame, benchmark: DataFrame, window: int, literals: int) -> DataFrame:
    """key, doc_id, item_id, shift, n_words, and the words of document and item side by side."""
    items = staged(benchmark.filter("text is not null").select(
        "item_id", valued(F.col("text")).alias("item_words")).distinct(), "benchmark-words")
    # Windows of enough literal words; the documents' windows that meet them have as many.
    marks = ", ".join(f"'{m}'" for m in MARKS)
    wanted = staged(benchmark.filter("text is not null").select(
        "item_id", template(F.col("text")).alias("t")).distinct().select(
        "item_id", "t", F.inline(windows("t", window)).alias("at", "hash")).filter(F.expr(
            f"size(filter(slice(t, at + 1, {window}), w -> w not in ({marks}))) >= {literals}")).drop("t"),
        "benchmark-windows")
    few = wanted.count() <= BROADCAST_WINDOWS
    if few:
        wanted = F.broadcast(wanted)
    texts = docs.filter("text is not null").select(
        F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    # Windows unfold without their text, which would be copied for each; texts join the few that hit.
    found = texts.withColumn("t", template(F.col("text"))).select(
        "key", "doc_id", F.inline(windows("t", window)).alias("place", "hash"))
    hits = staged(found.join(wanted, "hash").select(
        "key", "doc_id", "item_id", (F.col("place") - F.col("at")).alias("shift")).distinct(), "benchmark-shifts")
    valued_texts = texts.join(hits.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"]).select(
        "key", valued(F.col("text")).alias("words"))
    hits = hits.join(valued_texts, "key")
    lo = "greatest(0, -shift)"
    return hits.join(items if not few else F.broadcast(items), "item_id").select(
        "key", "doc_id", "item_id", "shift", F.size("item_words").alias("n_words"), F.expr(
            f"slice(words, {lo} + shift + 1, least(size(item_words), size(words) - shift) - {lo})"
        ).alias("mine"), F.expr(
            f"slice(item_words, {lo} + 1, least(size(item_words), size(words) - shift) - {lo})"
        ).alias("theirs")).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
          literals: int = LITERALS, cover: float = COVER) -> DataFrame:
    """One row per document and benchmark item in it: key, doc_id, item_id, n_words (of the
    item), n_agree (of its words, at most by one shift or by neighbouring ones), and whether all slots have
    the item's own values.

    ``key`` stands for id and text; rows alike in both are one document. Null and empty texts
    leak nothing, items of fewer than ``window`` words or without a window of ``literals`` are never found.
    Items alike are each reported. Empty tables give an empty result; other columns aren't looked at.
    """
    sliced = staged(_aligned(docs, benchmark, window, literals), "benchmark-hits")
    return _agreeing(sliced, cover).unionByName(_pieced(sliced, window, cover)).groupBy(
        "key", "doc_id", "item_id", "n_words").agg(
        F.max("n_agree").alias("n_agree"), F.max("same_values").alias("same_values"))


def _agreeing(sliced: DataFrame, cover: float) -> DataFrame:
    """The leaks by one shift each."""
    marks = ", ".join(f"'{m}'" for m in MARKS)
    pairs = sliced.withColumn("pairs", F.expr(
        "filter(zip_with(mine, theirs, (a, b) -> struct(a as a, b as b)), "
        f"p -> p.a = p.b or (left(p.a, 1) = left(p.b, 1) and left(p.a, 1) in ({marks})))"))
    slots = pairs.withColumn("slots", F.expr(
        f"array_distinct(filter(pairs, p -> left(p.a, 1) in ({marks})))"))
    steady = F.expr("size(slots) = size(array_distinct(slots.a)) and "
                    "size(slots) = size(array_distinct(slots.b))")
    return slots.filter(steady & (F.size("pairs") >= F.lit(cover) * F.col("n_words"))).groupBy(
        "key", "doc_id", "item_id", "n_words").agg(
        F.max(F.size("pairs")).alias("n_agree"),
        F.max(F.expr("forall(slots, p -> p.a = p.b)")).alias("same_values"))


def _pieced(sliced: DataFrame, window: int, cover: float) -> DataFrame:
    """The leaks where runs of ``window`` agreeing words, of one shift or of several no further
    apart than the item is long, hold enough of the item and fill its slots consistently."""
    marks = ", ".join(f"'{m}'" for m in MARKS)
    runs = sliced.withColumn("agree", F.expr(
        "zip_with(mine, theirs, (a, b) -> a = b or (left(a, 1) = left(b, 1) and "
        f"left(a, 1) in ({marks})))")).withColumn("whole", F.expr(
            f"transform(agree, (x, p) -> size(slice(agree, p + 1, {window})) = {window} and "
            f"forall(slice(agree, p + 1, {window}), y -> y))")).withColumn("run", F.expr(
                "filter(transform(mine, (a, p) -> struct(greatest(0, -shift) + p as at, a as a, "
                f"theirs[p] as b, exists(slice(whole, greatest(p + 2 - {window}, 1), "
                f"least(p + 1, {window})), y -> y) as held)), x -> x.held)"))
    places = Window.partitionBy("key", "item_id", "n_words").orderBy("shift")
    apart = F.col("shift") - F.lag("shift").over(places) > F.col("n_words")
    rows = runs.select("key", "doc_id", "item_id", "n_words", "shift", "run").withColumn(
        "apart", F.coalesce(apart.cast("int"), F.lit(0))).withColumn("group", F.sum("apart").over(places))
    # Each shift alone, and all of a group.
    rows = rows.withColumn("part", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("shift").cast("long").alias("of")),
        F.struct(F.lit(1).alias("kind"), F.col("group").cast("long").alias("of")))))
    groups = rows.groupBy("key", "doc_id", "item_id", "n_words", "part").agg(
        F.flatten(F.collect_list("run")).alias("run"))
    slots = groups.withColumn("slots", F.expr(
        f"array_distinct(transform(filter(run, x -> left(x.a, 1) in ({marks})), x -> struct(x.a as a, x.b as b)))"))
    steady = F.expr("size(slots) = size(array_distinct(slots.a)) and "
                    "size(slots) = size(array_distinct(slots.b))")
    return slots.withColumn("n_agree", F.size(F.array_distinct("run.at"))).filter(
        steady & (F.col("n_agree") >= F.lit(cover) * F.col("n_words"))).select(
        "key", "doc_id", "item_id", "n_words", "n_agree", F.expr("forall(slots, p -> p.a = p.b)").alias("same_values"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  literals: int = LITERALS, cover: float = COVER) -> DataFrame:
    """``docs`` without those that hold a benchmark item, edited ones too; all columns stay."""
    key = unused(docs, "leaked")
    gone = leaks(docs, benchmark, window, literals, cover).select(F.col("key").alias(key)).distinct()
    return docs.join(gone, F.xxhash64("doc_id", "text") == F.col(key), "left_anti")
