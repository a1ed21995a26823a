"""News batch (G1): clean -> tag -> explode -> score -> aggregate -> fold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ISSUE_THRESHOLD
from ..operators.aggregate import aggregate_news, news_evidence
from ..operators.periods import arrived_markers, ready_periods
from ..operators.scoring import Scorer, apply_scorer, materialise
from ..operators.state import news_step
from ..operators.tagging import (clean_columns, explode_tags, project_news, tag_flat,
                                 with_tags)
from ..session import scratch_scope
from ..sources import io


@dataclass
class NewsBatch:
    aggregate: DataFrame   # T3 without the packed array
    evidence: DataFrame    # the articles behind it, one row each
    state: DataFrame       # state after the batch


def _tag_arrays(raw: DataFrame, categories, keep=()) -> DataFrame:
    """D2 -> D1 (content only; titles stay raw) -> D3, one row per article."""
    return tag_flat(clean_columns(project_news(raw, keep), ("content",)), categories)


def tag_news(raw: DataFrame, categories, keep=()) -> DataFrame:
    """D2 -> D1 -> D3 -> D5: one row per (article, category)."""
    return explode_tags(_tag_arrays(raw, categories, keep))


def score_news(raw: DataFrame, categories, scorer: Scorer, on_failure: int | None = 0,
               keep=()) -> DataFrame:
    """Tagged articles with their score (D10), one row per (article, category).

    A scorer that reads the category (a model asked about an entity and a
    category) scores each exploded row. One that does not (a lookup by link,
    a model over the text alone) scores each tagged article once before the
    explode, so it runs and shuffles once per article, not once per tag."""
    if scorer.reads_any(["accident"]):
        return apply_scorer(tag_news(raw, categories, keep), scorer, "news_score", on_failure)
    tagged = with_tags(_tag_arrays(raw, categories, keep))
    return explode_tags(apply_scorer(tagged, scorer, "news_score", on_failure))


def run_news(raw: DataFrame, batch_period: str, state: DataFrame, categories, scorer: Scorer,
             threshold: int = ISSUE_THRESHOLD, ttl: str | None = None,
             on_failure: int | None = 0, evidence: bool = True) -> NewsBatch:
    """One news batch as DataFrames (G1).

    The scored rows are materialised once (with their text when ``evidence``),
    so the text work and the scorer run once; the aggregate reads only the key
    and score columns back. The aggregate and the new state have one row per
    (entity, category) and are materialised too, so the steps that read them
    several times (issue list, keyword selection, scoring) stay cheap."""
    cols = ["car_model", "accident", "link", "news_score"] + (["content"] if evidence else [])
    scored = materialise(score_news(raw, categories, scorer, on_failure).select(*cols),
                         "news-scored")
    agg = materialise(aggregate_news(scored), "news-agg")
    new_state = materialise(news_step(state, agg, batch_period, threshold, ttl), "state")
    ev = news_evidence(scored) if evidence else scored.select(
        "car_model", "accident", "link").withColumn("content", F.lit(None).cast("string"))
    return NewsBatch(agg, ev, new_state)


def run_news_job(spark: SparkSession, raw_base: str, out_base: str, batch_period: str,
                 categories, scorer: Scorer, seed: DataFrame,
                 threshold: int = ISSUE_THRESHOLD, ttl: str | None = None) -> NewsBatch:
    """G1 over files: read the batch, write aggregate, evidence and the news
    stage's state snapshot (``state_news``).

    Reruns are idempotent: the state is rebuilt from the final snapshot
    (``state``) before this batch and every output partition is replaced. What is
    returned reads these outputs; scratch tables are deleted."""
    with scratch_scope(spark):
        raw = io.read_raw(spark, "news", raw_base, batch_period)
        prev = io.read_state(spark, f"{out_base}/state", batch_period, seed)
        res = run_news(raw, batch_period, prev, categories, scorer, threshold, ttl)
        io.write_aggregate(res.aggregate, f"{out_base}/news", batch_period)
        io.write_aggregate(res.evidence, f"{out_base}/evidence", batch_period)
        io.write_state(res.state, f"{out_base}/state_news", batch_period)
    state = io.read_state(spark, f"{out_base}/state_news", _after(batch_period))
    return NewsBatch(io.read_aggregate(spark, "news", f"{out_base}/news", batch_period),
                     io.read_aggregate(spark, "evidence", f"{out_base}/evidence", batch_period),
                     state)


def run_ready_news(spark: SparkSession, marker_base: str, raw_base: str, out_base: str, categories,
                   scorer: Scorer, seed: DataFrame, sources: list[str], threshold: int = ISSUE_THRESHOLD,
                   ttl: str | None = None) -> list[str]:
    """G1 for every batch whose ``sources`` have all left a marker under ``marker_base`` (B6,
    B7) and that has not been run, in order; returns their periods. Batches that still lack
    a source are left for a later call."""
    arrived = arrived_markers(spark.read.text(marker_base))
    ready = {r[0] for r in ready_periods(arrived, sources).collect()}  # the schedule, one text a batch
    todo = sorted(ready - io.state_periods(spark, f"{out_base}/state_news"))
    for period in todo:
        run_news_job(spark, raw_base, out_base, period, categories, scorer, seed, threshold, ttl)
    return todo


def _after(batch_period: str) -> str:
    """A key that sorts right after ``batch_period`` (snapshots compare as text)."""
    return batch_period + "~"
