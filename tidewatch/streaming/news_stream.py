"""News batches as a file stream.

New raw-news files under ``raw_base`` (partitioned by ``batch_period``) are picked up by
a file-source stream. A record belongs to the batch of its folder, as in G1, whatever its
own time says. A batch may arrive in any number of micro-batches and in any order:

* ``news_parts/month=/epoch=`` holds what one micro-batch adds to the periods of a month, as
  counts and score sums, so the text work and the scorer run once per record and a
  replayed micro-batch rewrites its own partitions;
* ``news/batch_period=`` is the union of a period's parts (D13);
* ``state`` holds one snapshot per period (A5). A micro-batch rewrites the snapshots from
  the earliest period it touched on, in one job: running sums over each key's periods,
  begun from the snapshot before, which holds the sums and the start of each key's current
  run. With ``ttl`` a key that is stale in a batch (E6) begins a new run there.

Every micro-batch thus leaves the tables that G1 leaves after the same files, one batch
per period. ``out_base`` and ``checkpoint`` belong together: the epoch numbers in the
parts come from the checkpoint. Records in no ``batch_period`` folder are in no batch.

A micro-batch may touch any number of periods: it writes one file per period and no more
(``news``), the rest by month, and names no period in a plan one by one.

``stream_complete_news`` folds a period only when all its sources have arrived (``gate``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ISSUE_THRESHOLD
from ..functions.time import month, parse_period_end, parse_period_start, texts
from ..operators.scoring import Scorer, materialise
from ..operators.state import KEYS, STATE_COLS
from ..plans.news import score_news
from ..plans.replay import from_seed, news_states, seeded
from ..schemas import RAW_NEWS
from ..session import many_folders, scratch_scope
from ..sources import io
from .gate import STATE_STORE, arrivals, gate

PERIOD = T.StructField("batch_period", T.StringType())
PARTS = T.StructType([T.StructField(n, t) for n, t in (
    ("car_model", T.StringType()), ("accident", T.StringType()), ("count", T.LongType()), ("scored", T.LongType()),
    ("score_sum", T.LongType()), ("batch_period", T.StringType()), ("month", T.StringType()),
    ("epoch", T.LongType()))])


def news_parts(batch: DataFrame, categories, scorer: Scorer) -> DataFrame:
    """What ``batch`` adds to each (key, period): articles, scored articles, score sum."""
    scored = score_news(batch, categories, scorer, keep=("batch_period",))
    return scored.groupBy(*KEYS, "batch_period").agg(
        F.count(F.lit(1)).alias("count"), F.count("news_score").alias("scored"),
        F.sum("news_score").cast("bigint").alias("score_sum"))


def union_parts(parts: DataFrame) -> DataFrame:
    """D13 per (key, period) over every micro-batch that added to it."""
    return parts.groupBy(*KEYS, "batch_period").agg(
        F.sum("count").alias("count"),
        F.try_divide(F.sum("score_sum").cast("double"), F.sum("scored")).alias("avg_news_score"))


def snapshots(per: DataFrame, before: DataFrame, periods: list[str],
              threshold: int = ISSUE_THRESHOLD, ttl: str | None = None) -> DataFrame:
    """The state after each of ``periods`` (with its ``batch_period``), from the state
    before the first of them and the aggregates ``per`` of the periods: (state rows) x
    (periods) rows, none of them per article."""
    dense = seeded(before).withColumn("batch_period", F.explode(texts(periods))).withColumns({
        "period_start": parse_period_start("batch_period"), "period_end": parse_period_end("batch_period")})
    rows = news_states(dense, per, threshold, ttl)
    zero, none = F.lit(0.0), F.lit(0).cast("bigint")
    return rows.withColumns({
        "comm_acc_count": from_seed("comm_acc_count", none), "comm_score": from_seed("comm_score", zero),
        "issue_score": from_seed("issue_score", zero), "is_alert": F.col("_opened"),
        "dashboard_url": F.col("_seed_dashboard_url")}).select(*STATE_COLS, "batch_period")


def _replace(df: DataFrame, path: str, *by: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*by).parquet(path))


def _gathered(df: DataFrame, *by: str) -> DataFrame:
    """The rows of a partition in one task, so it becomes one file; the partitions are
    spread over the cores, however few bytes they hold."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *by)


def fold(batch: DataFrame, touched: list[str], epoch: int, out_base: str, categories, scorer: Scorer,
         seed: DataFrame, threshold: int = ISSUE_THRESHOLD, ttl: str | None = None) -> None:
    """Add ``batch`` (raw news with ``batch_period``, of the periods ``touched``) to the
    tables under ``out_base``."""
    spark, touched = batch.sparkSession, sorted(touched)
    parts_base, store = f"{out_base}/news_parts", io.state_store(batch.sparkSession, f"{out_base}/state")
    mine = batch.filter(F.col("batch_period").isNotNull())
    added = news_parts(mine, categories, scorer).withColumns({"month": month(F.col("batch_period")), "epoch": F.lit(epoch)})
    _replace(_gathered(added, "month"), parts_base, "month", "epoch")
    parts = spark.read.schema(PARTS).parquet(parts_base).filter(
        (F.col("month") >= month(touched[0])) & (F.col("batch_period") >= touched[0]))
    per = materialise(union_parts(parts), "news-per")
    now = parts.filter(F.col("epoch") == epoch).select("batch_period").distinct()
    _replace(_gathered(per.join(now, "batch_period", "left_semi"), "batch_period"), f"{out_base}/news", "batch_period")
    later = [p for p in store.periods() if p >= touched[0]]
    before = store.read_before(touched[0])
    periods = sorted({*touched, *later})
    store.write(snapshots(per, seed if before is None else before, periods, threshold, ttl), periods)


def _started(stream: DataFrame, run, checkpoint: str, available_now: bool):
    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def stream_news(spark: SparkSession, raw_base: str, out_base: str, checkpoint: str,
                categories, scorer: Scorer, seed: DataFrame,
                threshold: int = ISSUE_THRESHOLD, available_now: bool = True,
                max_files_per_trigger: int | None = None, ttl: str | None = None):
    """Start the stream; returns the StreamingQuery (``availableNow`` drains
    what has arrived, then stops)."""
    schema = T.StructType([*RAW_NEWS.fields, PERIOD])
    reader = spark.readStream.schema(schema).option("basePath", raw_base)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def run(batch: DataFrame, epoch: int) -> None:
        # folder names of this micro-batch: the schedule, not data
        touched = [r[0] for r in batch.select("batch_period").distinct().collect() if r[0] is not None]
        if touched:
            with scratch_scope(spark):
                fold(batch, touched, epoch, out_base, categories, scorer, seed, threshold, ttl)

    with many_folders(spark):
        return _started(reader.parquet(raw_base), run, checkpoint, available_now)


def stream_complete_news(spark: SparkSession, marker_base: str, raw_base: str, out_base: str, checkpoint: str,
                         categories, scorer: Scorer, seed: DataFrame, required: list[str],
                         patience: str = "1 hour", threshold: int = ISSUE_THRESHOLD,
                         available_now: bool = True, max_files_per_trigger: int | None = None,
                         ttl: str | None = None):
    """The news stream behind the arrival gate: a period is folded once, when markers of all
    ``required`` sources have arrived, with all files that its folder then has. Periods that
    stay incomplete for ``patience`` are listed in ``<out_base>/incomplete`` with the sources
    they lack; one that is completed afterwards is folded then."""
    events = gate(arrivals(spark, marker_base, max_files_per_trigger), required, patience)

    def run(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()  # at most two rows per period, read twice
        try:
            rows = batch.collect()
            _replace(batch.filter("status = 'incomplete'").withColumn("epoch", F.lit(epoch)),
                     f"{out_base}/incomplete", "epoch")
        finally:
            batch.unpersist()
        ready = sorted({r["batch_period"] for r in rows if r["status"] == "complete"})
        if ready:
            with scratch_scope(spark), many_folders(spark):
                fold(io.read_raw_periods(spark, "news", raw_base, ready), ready, epoch, out_base, categories, scorer,
                     seed, threshold, ttl)

    # the gate keeps its state in the provider that allows timers; other streams keep theirs
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, STATE_STORE)
    try:
        return _started(events, run, checkpoint, available_now)
    finally:
        spark.conf.set(key, old)
