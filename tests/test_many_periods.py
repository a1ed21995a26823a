"""Work whose batches are many: files and plans must not grow with (periods x tasks)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.time import month, texts
from tidewatch.operators.scoring import ColumnScorer
from tidewatch.operators.state import seed_from
from tidewatch.sources import io
from tidewatch.sources.snapshots import SnapshotStore
from tidewatch.streaming import news_stream

PERIODS = [f"2024-01-{d:02d}-{h:02d}-00-00_2024-01-{d:02d}-{h:02d}-59-59" for d in range(1, 6) for h in range(24)]


def _raw(spark, n=3):
    rows = spark.createDataFrame([(p,) for p in PERIODS], "batch_period string").withColumn("i", F.explode(F.array(*map(F.lit, range(n)))))
    return rows.select(F.lit("t").alias("title"), F.lit("a x").alias("content"), F.lit("s").alias("source"),
                       F.concat("batch_period", "i").alias("link"), F.concat(F.lit("e"), "i").alias("keyword"), "batch_period")


def test_periods_are_one_literal_and_have_a_month(spark):
    got = spark.range(1).select(F.explode(texts(["b", "a"])).alias("p")).select("p", month(F.lit("2024-05-01")).alias("m"))
    assert [tuple(r) for r in got.collect()] == [("a", "2024-05"), ("b", "2024-05")] and month("2024-05-01") == "2024-05"


def test_many_batches_are_read_in_one_scan_of_their_folders(spark, tmp_dir):
    _raw(spark).write.partitionBy("batch_period").parquet(f"{tmp_dir}/raw")
    asked = [*PERIODS[3:50], "2031-01-01-00-00-00_2031-01-01-00-59-59"]
    got = io.read_raw_periods(spark, "news", f"{tmp_dir}/raw", asked)
    assert got.count() == 47 * 3 and {r[0] for r in got.select("batch_period").distinct().collect()} == set(PERIODS[3:50])
    plan = got._jdf.queryExecution().optimizedPlan()
    assert plan.collectLeaves().size() == 1
    assert io.read_raw_periods(spark, "news", f"{tmp_dir}/none", asked).count() == 0


def test_snapshots_of_many_periods_are_few_files(spark, tmp_dir):
    schema = T.StructType([T.StructField("car_model", T.StringType()), T.StructField("accident", T.StringType()),
                           T.StructField("n", T.LongType())])
    rows = spark.createDataFrame([(k, "x", i, p) for i, p in enumerate(PERIODS) for k in "abcdef"],
                                 T.StructType([*schema.fields, T.StructField("batch_period", T.StringType())]))
    store = SnapshotStore(spark, tmp_dir, schema, ["car_model", "accident"], base_every=5)
    store.write(rows, PERIODS)
    assert len(spark.read.parquet(f"{tmp_dir}/rows").inputFiles()) <= 4  # a file per task and month
    assert {r["n"] for r in store.read(PERIODS[63]).collect()} == {63} and store.read(PERIODS[63]).count() == 6


def test_a_micro_batch_writes_one_file_a_period(spark, tmp_dir):
    raw = _raw(spark).withColumn("post_time", F.lit(None).cast("timestamp_ntz")).repartition(8)
    seed = seed_from(raw.select(F.col("keyword").alias("car_model")), ["x"])
    for epoch in range(2):
        news_stream.fold(raw, PERIODS, epoch, tmp_dir, ["x"], ColumnScorer(lambda df: F.lit(50), inputs=()), seed)
    assert len(spark.read.parquet(f"{tmp_dir}/news").inputFiles()) == len(PERIODS)
    assert len(spark.read.parquet(f"{tmp_dir}/news_parts").inputFiles()) == 2
    last = io.read_state(spark, f"{tmp_dir}/state").collect()
    assert {(r["car_model"], r["news_acc_count"]) for r in last} == {(f"e{i}", 2 * len(PERIODS)) for i in range(3)}
