"""The pipeline on odd rows: nulls, empty and long texts, copies, repeated rows, clashing columns."""

import corpus_pipeline
from pyspark.sql import functions as F

from tidewatch.session import scratch_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def word(i):
    return "".join(chr(97 + i // 26 ** k % 26) for k in range(4))


def text(seed, n=60):
    return " ".join(word(seed * 997 + j * 31) for j in range(n))


def run(spark, rows, leak):
    folder = scratch_path(spark, "edges")
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("x") for c in ("quality", "spans", "fp", "row", "numbers", "gone", "_t", "c0", "ids")})
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return corpus_pipeline.run(spark, folder).collect()


def test_odd_rows(spark):
    leak = text(7, 40)
    long = text(11, 20_000)
    rows = [(1, None, "en", "s", None), (2, "", None, None, 0), (3, "  \n ", "en", "s", 3), (4, "short", "en", "s", 5),
            (5, long, "en", "s", 1), (6, long + " end", "en", "s", 1),          # near copies of a long text
            (7, text(1), None, None, None), (7, text(1), None, None, None),      # a repeated row
            (8, text(2), "fr", "t", 1), (9, text(2), "fr", "t", 1), (None, text(2), "fr", "t", 1),  # copies
            (None, text(3), "en", "s", 1),                                       # a null id alone
            (10, f"{text(4)} {leak} {text(5)}", "en", "s", 1),                   # a benchmark passage
            (11, text(6) + " write to someone@example.org now", "en", "s", 1)]
    got = run(spark, rows, leak)
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in got if r["doc_id"] is not None) == [
        (False, i) for i in (5, 7, 8, 11)]
    assert sum(r["doc_id"] is None for r in got) == 1 and len(got) == 5
    assert max(r["n_tokens"] for r in got) >= 20_000


def test_empty_table(spark):
    assert run(spark, [], "a passage that nothing holds") == []
