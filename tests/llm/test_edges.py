"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from setlog.llm import (
    decontamination,
    html_extraction,
    language_id,
    line_dedup,
    mixing,
    ngram_join,
    ppm,
    quality_classifier,
    quality_rules,
    secret_scan,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("key", "score", "kept", "later", "dedup", "taken", "copy", "h", "place", "stats", "node",
         "label", "n_words", "t", "words", "held_out", "a.b")
LONG = " ".join(f"word{k % 977}x{k}" for k in range(60_000))
PLAIN = "The quick brown fox jumps over the lazy dog and then runs away from it all."
ROWS = [
    (1, PLAIN, "en", "a", 10), (1, PLAIN, "en", "a", 10), (2, PLAIN, None, None, None),
    (None, PLAIN, "en", "a", 1), (None, None, None, None, None), (3, "", "en", "b", 0),
    (4, " \n\t\n ", "fr", "b", 5), (5, LONG, "en", "c", len(LONG)), (6, None, "de", "a", 0),
    (7, "é" * 30_000, "fr", "c", 30_000), (8, "\n".join(["same line", "other line"] * 50), "en", "a", 1),
    (9, "1 2 3 | # !", "en", "b", 9),
]
LABELS = [(1, 1, 0), (3, 0, 0), (5, 1, None), (8, 0, 1), (None, 1, 0), (9, None, 0), (2, 1, 0), (2, 0, 0)]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *(F.lit(k).alias(c) for k, c in enumerate(CLASH)))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, PLAIN), (2, None), (3, ""), (4, "too short")],
                                 "item_id long, text string")


def per_row(docs, labels, benchmark):
    return {
        "ppm": lambda d: ppm.score(d),
        "mixing": lambda d: mixing.mix(d).withColumn("row", F.explode(F.sequence(F.lit(1), "m"))),
        "join": lambda d: ngram_join.join(d),
        "language": lambda d: language_id.identify(d),
        "rules": lambda d: quality_rules.apply_rules(d, labels),
        "lines": lambda d: line_dedup.dedup_lines(d),
        "secrets": lambda d: secret_scan.find_secrets(d),
        "classifier": lambda d: quality_classifier.score(d, labels),
    }


NAMES = ["ppm", "mixing", "join", "language", "rules", "lines", "secrets", "classifier"]


@pytest.mark.parametrize("name", NAMES)
def test_a_row_for_every_row(docs, labels, benchmark, name):
    run = per_row(docs, labels, benchmark)[name]
    got = run(docs)
    assert got.count() == len(ROWS)
    ids = sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in got.select("doc_id").collect())
    assert ids == sorted((r[0] is not None, r[0] or 0) for r in ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(docs, labels, benchmark, name):
    assert per_row(docs, labels, benchmark)[name](docs.limit(0)).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_keep_columns(spark, docs, labels, benchmark, tmp_path, name, stage):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = stage(spark, docs, str(tmp_path))
    extra = ["copy_"] if name == "mixing" else []
    assert got.columns == docs.columns + extra
    got.collect()
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_leaks_edges(docs, benchmark):
    got = decontamination.leaks(docs, benchmark)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(1, 1), (2, 1), (None, 1)}
    assert decontamination.leaks(docs, benchmark.limit(0)).count() == 0
    assert decontamination.leaks(docs.limit(0), benchmark).count() == 0
    assert decontamination.without_leaks(docs, benchmark).count() == len(ROWS) - 4


def test_without_labels(docs, labels):
    none = labels.limit(0)
    assert quality_rules.apply_rules(docs, none).filter("kept = base_failed").count() == 0
    assert {r.score for r in quality_classifier.score(docs, none).collect()} == {0.5}


def test_pages_edges(spark):
    pages = spark.createDataFrame(
        [(1, "u", None), (1, "u", None), (2, None, ""), (None, "u", "<p>plain words here"),
         (4, "u", "<article><p>" + "many words " * 50_000 + "</article>"), (5, "u", "<p title='x"),
         (6, "u", "no tags at all")], "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = {(r.page_id, r.n_chars, r.text[:11]) for r in html_extraction.extract(pages).collect()}
    assert got == {(1, 0, ""), (2, 0, ""), (None, 16, "plain words"), (4, 549_999, "many words "),
                   (5, 0, ""), (6, 14, "no tags at ")}
    assert html_extraction.extract(pages.limit(0)).count() == 0
