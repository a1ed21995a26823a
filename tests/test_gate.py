"""Waiting for all sources of a batch: the stream's gate and the file job's."""

import json
import os
import time

from pyspark.sql import functions as F

from tidewatch.config import NEWS_CATEGORIES
from tidewatch.operators import periods, state
from tidewatch.plans import news, replay
from tidewatch.sources import io, standins
from tidewatch.streaming import stream_complete_news, stream_news

SF = "/root/testdata/sf0.001"
P = ["2024-01-01-00-00-00_2024-01-01-01-00-00", "2024-01-01-01-00-00_2024-01-01-02-00-00",
     "2024-01-01-02-00-00_2024-01-01-03-00-00"]


def _marker(folder, name, *arrived, status="success"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w") as f:
        for source, period in arrived:
            start, end = period.split("_")
            f.write(json.dumps({"source": source, "start_time": start, "end_time": end, "status": status}) + "\n")
        f.write("not a marker\n")
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")
    time.sleep(0.02)  # files are taken in the order of their times


def _rows(df):
    for c in ("news_score", "comm_score", "issue_score"):
        df = df.withColumn(c, F.round(c, 6))
    return sorted((tuple(r) for r in df.collect()), key=str)


def _inputs(spark, base):
    docs = standins.table(spark, SF, "documents")
    raw = standins.raw_news(docs)
    scorer, seed = standins.label_scorer(standins.table(spark, SF, "labels")), standins.seed(docs)
    hourly = periods.assign_period(raw, "1 hour").drop("period_start", "period_end")
    hourly.repartition("batch_period").write.partitionBy("batch_period").parquet(f"{base}/raw")
    return hourly, scorer, seed


def test_a_period_is_folded_when_complete_and_once(spark, tmp_dir):
    base = tmp_dir.removeprefix("file:")
    hourly, scorer, seed = _inputs(spark, base)

    def run():
        stream_complete_news(spark, f"{base}/markers", f"{base}/raw", f"{base}/out", f"{base}/ckpt", NEWS_CATEGORIES,
                             scorer, seed, ["a", "b"], patience="1 second", threshold=2,
                             max_files_per_trigger=1).awaitTermination()
        return io.state_periods(spark, f"{base}/out/state")

    def want(*ps):
        some = hourly.filter(F.col("batch_period").isin(*ps))
        return _rows(replay.replay_news(some, seed, NEWS_CATEGORIES, scorer, threshold=2).drop("is_alert"))

    def got():
        return _rows(io.read_state(spark, f"{base}/out/state").drop("is_alert"))

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    _marker(f"{base}/markers", "1", ("a", P[0]), ("a", P[1]), ("b", P[2]))
    _marker(f"{base}/markers", "2", ("b", P[0]), status="failed")
    assert run() == set()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    # a restart knows what had arrived; the later period is complete before the earlier one
    _marker(f"{base}/markers", "3", ("b", P[0]))
    _marker(f"{base}/markers", "4", ("a", P[2]), ("a", P[0]))
    assert run() == {P[0], P[2]}
    assert got() == want(P[0], P[2])
    time.sleep(1.1)
    _marker(f"{base}/markers", "5", ("c", P[2]), ("a", P[2]), ("b", P[2]))  # again: changes nothing
    assert run() == {P[0], P[2]} and got() == want(P[0], P[2])
    waiting = spark.read.parquet(f"{base}/out/incomplete").select("batch_period", "missing").distinct().collect()
    assert [tuple(r) for r in waiting if r[0] == P[1]] == [(P[1], "b")]
    # the period that had been given up on is folded when its last source arrives
    _marker(f"{base}/markers", "6", ("b", P[1]))
    assert run() == set(P) and got() == want(*P)


def test_stream_with_expiry_equals_replay(spark, tmp_dir):
    """Split and late folders, issues that expire and open again."""
    base = tmp_dir.removeprefix("file:")
    docs = standins.table(spark, SF, "documents")
    raw = periods.assign_period(standins.raw_news(docs), "30 minutes").drop("period_start", "period_end")
    scorer, seed = standins.label_scorer(standins.table(spark, SF, "labels")), standins.seed(docs)
    n = F.pmod(F.xxhash64("link"), F.lit(3))
    late = F.col("batch_period").startswith("2024-01-01-01")
    for drop in (raw.filter((n > 0) & ~late), raw.filter(late), raw.filter((n == 0) & ~late)):
        drop.repartition(2).write.mode("append").partitionBy("batch_period").parquet(f"{base}/raw")
        stream_news(spark, f"{base}/raw", f"{base}/out", f"{base}/ckpt", NEWS_CATEGORIES, scorer, seed, threshold=2,
                    max_files_per_trigger=8, ttl="30 minutes").awaitTermination()
    want = replay.replay_news(raw, seed, NEWS_CATEGORIES, scorer, threshold=2, every="30 minutes", ttl="30 minutes")
    got = io.read_state(spark, f"{base}/out/state")
    assert _rows(got) == _rows(want) and got.filter("is_issue").count() > 0
    assert _rows(want) != _rows(replay.replay_news(raw, seed, NEWS_CATEGORIES, scorer, threshold=2,
                                                   every="30 minutes"))


def test_file_job_runs_ready_batches_only(spark, tmp_dir):
    base = tmp_dir.removeprefix("file:")
    _, scorer, seed = _inputs(spark, base)
    args = (spark, f"{base}/markers", f"{base}/raw", f"{base}/out", NEWS_CATEGORIES, scorer, seed, ["a", "b"])
    _marker(f"{base}/markers", "1", ("a", P[0]), ("a", P[1]), ("b", P[1]))
    assert news.run_ready_news(*args) == [P[1]] and news.run_ready_news(*args) == []
    _marker(f"{base}/markers", "2", ("b", P[0]), ("b", P[2]))
    assert news.run_ready_news(*args) == [P[0]]


def test_evidence_of_the_current_run(spark):
    rows = [("A", "x", "old", "l1", P[0]), ("A", "x", "new", "l2", P[1]), ("A", "x", "later", "l3", P[2]),
            ("B", "x", "closed", "l4", P[0]), ("C", "x", "no state", "l5", P[0])]
    evidence = spark.createDataFrame(rows, "car_model string, accident string, content string, link string, "
                                           "batch_period string")
    snapshot = spark.createDataFrame([("A", "x", "2024-01-01 01:00:00"), ("B", "x", None)],
                                     "car_model string, accident string, t string").select(
        "car_model", "accident", F.col("t").cast("timestamp_ntz").alias("start_batch_time"))
    assert sorted(r.link for r in state.current_evidence(evidence, snapshot).collect()) == ["l2", "l3"]
    assert [r.link for r in state.current_evidence(evidence, snapshot, P[1]).collect()] == ["l2"]
