"""Binding of the driver's generic tables to the engine's inputs.

``documents`` stands in for crawled news (T1) and community posts (T2):
entity <- source, site <- lang, title <- first line, content <- whole text,
link <- 'doc/<doc_id>', post time <- BASE_TIME + doc_id minutes, views <- n_chars.
``labels`` stands in for the scoring model; ``events`` for arrival markers and
batch periods; ``pages`` for raw pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BASE_TIME, COMMUNITY_KEYWORDS, DASHBOARD_URL, NEWS_CATEGORIES, \
    SCORE_CLEAN, SCORE_TOXIC
from ..operators.scoring import LookupScorer
from ..operators.state import seed_from
from .io import keywords_from_map


# tables whose rows carry long text: CPU-heavy per row
TEXT_TABLES = {"documents", "pages", "conversations"}


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has cores
    (a small file, one row group) before CPU-heavy text work. A large input
    already has one split per 128 MB and is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def doc_time(doc_id: Column) -> Column:
    return F.timestamp_add("MINUTE", doc_id, F.to_timestamp_ntz(F.lit(BASE_TIME)))


def doc_link(doc_id: Column) -> Column:
    return F.concat(F.lit("doc/"), doc_id.cast("string"))


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def raw_news(docs: DataFrame) -> DataFrame:
    """documents -> raw news rows."""
    return docs.select(doc_time(F.col("doc_id")).alias("post_time"),
                       first_line(F.col("text")).alias("title"),
                       F.col("text").alias("content"),
                       F.col("lang").alias("source"),
                       doc_link(F.col("doc_id")).alias("link"),
                       F.col("source").alias("keyword"))


def raw_posts(docs: DataFrame) -> DataFrame:
    """documents -> raw community posts."""
    return docs.select(doc_time(F.col("doc_id")).alias("post_time"),
                       first_line(F.col("text")).alias("title"),
                       F.col("text").alias("content"),
                       F.col("n_chars").alias("view_count"),
                       F.size(F.split(F.col("text"), "\n")).cast("bigint").alias("like_count"),
                       F.col("lang").alias("source"),
                       doc_link(F.col("doc_id")).alias("link"))


def label_scorer(labels: DataFrame) -> LookupScorer:
    """Model stand-in: toxic -> 80, clean -> 20, unlabeled -> NULL (failed)."""
    t = labels.select(doc_link(F.col("doc_id")).alias("link"), "toxic")
    return LookupScorer(t, "link",
                        F.when(F.col("toxic") == 1, SCORE_TOXIC).otherwise(SCORE_CLEAN))


def keyword_table(spark: SparkSession) -> DataFrame:
    return keywords_from_map(spark, COMMUNITY_KEYWORDS)


def seed(docs: DataFrame) -> DataFrame:
    """State seeded with every entity (document source) x every category."""
    return seed_from(docs.select(F.col("source").alias("car_model")), NEWS_CATEGORIES,
                     dashboard_url=DASHBOARD_URL)
