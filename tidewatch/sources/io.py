"""Table reads and writes.

Every table is Parquet, partitioned by ``batch_period`` (and ``source`` for raw
records). Writes use dynamic partition overwrite, so rerunning a batch replaces
its partition instead of appending a second copy. State snapshots are kept as a base
plus changes (``snapshots``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..session import missing_path
from .snapshots import BASE_EVERY, SnapshotStore

RAW_SCHEMAS = {"news": schemas.RAW_NEWS, "posts": schemas.RAW_POSTS}
AGG_SCHEMAS = {"news": schemas.NEWS_AGG, "posts": schemas.POST_AGG,
               "evidence": schemas.EVIDENCE}


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_batch(spark: SparkSession, schema: T.StructType, base: str, period: str) -> DataFrame:
    """One batch partition of a table, with the declared schema; a missing
    partition is an empty batch."""
    path = f"{base.rstrip('/')}/batch_period={period}"
    try:
        return spark.read.schema(schema).option("basePath", base).parquet(path).select(
            *schema.fieldNames())
    except AnalysisException as e:
        if missing_path(e):
            return empty(spark, schema)
        raise


def read_raw(spark: SparkSession, kind: str, base: str, period: str) -> DataFrame:
    """Raw news or posts of one batch (A1)."""
    return read_batch(spark, RAW_SCHEMAS[kind], base, period)


def read_raw_periods(spark: SparkSession, kind: str, base: str, periods: list[str]) -> DataFrame:
    """Raw news or posts of any number of batches, with their ``batch_period``, in one scan
    that opens these batches' folders only; a missing folder is an empty batch."""
    schema = T.StructType([*RAW_SCHEMAS[kind].fields, T.StructField("batch_period", T.StringType())])
    try:
        return spark.read.schema(schema).parquet(base).filter(F.col("batch_period").isin(periods))
    except AnalysisException as e:
        if missing_path(e):
            return empty(spark, schema)
        raise


def read_aggregate(spark: SparkSession, kind: str, base: str, period: str) -> DataFrame:
    """A batch aggregate (news / posts / evidence) of one batch (A2)."""
    return read_batch(spark, AGG_SCHEMAS[kind], base, period)


def write_batch(df: DataFrame, base: str, period: str, extra_partitions=()) -> None:
    """Replace one batch partition (dynamic partition overwrite)."""
    (df.withColumn("batch_period", F.lit(period))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_period", *extra_partitions).parquet(base))


def write_aggregate(df: DataFrame, base: str, period: str) -> None:
    """Write a batch aggregate (A3). No ``coalesce(1)``: the last stage keeps
    its parallelism; AQE already coalesces small shuffle partitions."""
    write_batch(df, base, period)


def write_records(df: DataFrame, base: str, period: str) -> None:
    """Write extracted records under batch period and source (A4)."""
    write_batch(df, base, period, ("source",))


def read_records(spark: SparkSession, kind: str, base: str, period: str) -> DataFrame:
    """Records written by ``write_records`` for one batch (all sources)."""
    return read_raw(spark, kind, base, period)


def state_store(spark: SparkSession, base: str, base_every: int = BASE_EVERY) -> SnapshotStore:
    """The state snapshots under ``base`` (A5)."""
    return SnapshotStore(spark, base, schemas.STATE, ["car_model", "accident"], base_every)


def read_state(spark: SparkSession, base: str, before_period: str | None = None,
               seed: DataFrame | None = None) -> DataFrame:
    """The latest state snapshot strictly before ``before_period`` (A5); ``seed``
    when there is none."""
    got = state_store(spark, base).read_before(before_period)
    if got is None:
        return seed if seed is not None else empty(spark, schemas.STATE)
    return got


def state_periods(spark: SparkSession, base: str) -> set[str]:
    """Batch periods that have a state snapshot under ``base``; none yet is empty."""
    return state_store(spark, base).periods()


def write_state(state: DataFrame, base: str, period: str) -> None:
    """Write the snapshot produced by ``period`` (A5): its changes, or a base."""
    state_store(state.sparkSession, base).write(state.withColumn("batch_period", F.lit(period)), [period])


def append_fact(fact: DataFrame, base: str, period: str) -> None:
    """Add a batch's fact rows (A6); a rerun replaces the batch's partition."""
    write_batch(fact, base, period)


def read_fact(spark: SparkSession, base: str) -> DataFrame:
    """Every fact row appended under ``base``; none yet is an empty table."""
    schema = T.StructType(list(schemas.FACT.fields)
                          + [T.StructField("batch_period", T.StringType())])
    try:
        return spark.read.schema(schema).parquet(base)
    except AnalysisException as e:
        if missing_path(e):
            return empty(spark, schema)
        raise


def issues_from_list(spark: SparkSession, issues: list[dict]) -> DataFrame:
    """Issue list given as job arguments -> DataFrame (A7). Explicit schema, so
    an empty list works."""
    return spark.createDataFrame([(i["car_model"], i["accident"]) for i in issues],
                                 schemas.ISSUES)


def keywords_from_map(spark: SparkSession, mapping) -> DataFrame:
    """Keyword configuration -> (accident, keyword) rows (A7). A list maps each
    category to itself; a dict maps a category to its sub-keywords."""
    if isinstance(mapping, dict):
        rows = [(c, k) for c, ks in mapping.items() for k in ks]
    else:
        rows = [(c, c) for c in mapping]
    return spark.createDataFrame(rows, schemas.KEYWORDS)


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """CSV of links with a ``link`` header."""
    return spark.read.option("header", True).schema(schemas.LINKS).csv(path)


def write_links(df: DataFrame, path: str) -> None:
    """Write a ``link`` CSV with header."""
    df.select("link").write.mode("overwrite").option("header", True).csv(path)


def union_sources(dfs: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), dfs)
