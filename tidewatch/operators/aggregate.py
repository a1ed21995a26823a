"""Per-(entity, category) aggregation of scored records.

Every aggregate here is algebraic (count, sum, avg), so Spark combines it
map-side before the shuffle and a hot group costs one partial row per task.
The per-group top-k is limited map-side too (WindowGroupLimit), so at most
k rows per group and task cross the shuffle.

Posts are aggregated in two levels where the score does not depend on the entity:
statistics and top posts per category, then one row per entity that has an open issue
in the category (``to_entities``). No row per post and entity is made.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import NEGATIVE_MIN, POSITIVE_MAX, TOP_K
from .joins import join_small

KEYS = ["car_model", "accident"]
# a post's own identity (link and raw text), carried while its text is not
POST_ID = "_post"
# groups whose first posts a task remembers
GROUPS_AT_ONCE = 20_000


def with_post_id(raw: DataFrame) -> DataFrame:
    """Add ``POST_ID``, a hash of the link and the raw text that tells NULL from empty."""
    parts = [x for c in ("link", "content") for x in (F.col(c).isNull(), F.coalesce(c, F.lit("")))]
    return raw.withColumn(POST_ID, F.xxhash64(*parts))


def aggregate_news(scored: DataFrame, score_col: str = "news_score") -> DataFrame:
    """Article count and mean score per (entity, category)."""
    return scored.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("count"),
                                     F.avg(score_col).alias("avg_news_score"))


def news_evidence(scored: DataFrame) -> DataFrame:
    """The articles behind each news aggregate, one row each (D13 evidence).

    The original packs every article of a group into one JSON array; a group
    is unbounded, so here the evidence stays a long table that is written
    beside the aggregate and joined on the keys when needed."""
    return scored.select(*KEYS, "content", "link")


def pack_evidence(evidence: DataFrame, counts: DataFrame, max_items: int = 1000) -> DataFrame:
    """The original's JSON array of {content, link} per group, in bounded pieces.

    A group is split into ceil(count / max_items) chunks by a hash of the link,
    so each JSON array holds about ``max_items`` articles and a hot group spreads
    over as many tasks as it has chunks. ``counts`` is the news aggregate (one
    row per key). Within a chunk the articles are ordered by link."""
    chunks = counts.select(*KEYS, F.greatest(F.lit(1), F.ceil(F.col("count") / max_items))
                           .cast("int").alias("_chunks"))
    ev = join_small(evidence, chunks, KEYS, "inner")
    ev = ev.withColumn("chunk", F.pmod(F.xxhash64("link"), F.col("_chunks")).cast("int"))
    items = F.sort_array(F.collect_list(F.struct("link", "content")))
    packed = F.transform(items, lambda x: F.struct(x["content"].alias("content"),
                                                   x["link"].alias("link")))
    return ev.groupBy(*KEYS, "chunk").agg(F.count(F.lit(1)).alias("n_items"),
                                          F.to_json(packed).alias("news"))


def aggregate_posts(scored: DataFrame, score_col: str = "comm_score", keys=tuple(KEYS)) -> DataFrame:
    """Mean score, count, positives (<= 45) and negatives (>= 55)."""
    s = F.col(score_col)
    return scored.groupBy(*keys).agg(
        F.avg(s).alias("avg_comm_score"),
        F.count(F.lit(1)).alias("count"),
        F.count_if(s <= POSITIVE_MAX).alias("comm_positive_count"),
        F.count_if(s >= NEGATIVE_MIN).alias("comm_negative_count"))


def keep_top_texts(scored: DataFrame, k: int = TOP_K, keys=tuple(KEYS)) -> DataFrame:
    """The rows with ``content`` only where it may be wanted, and ``kept``, which says where.

    A row keeps its text if, among the rows of its group that its task has seen so far, it
    is one of the first k by the order of ``top_k_posts``. These are few (about
    k log(rows) per group and task) and hold the first k of all, so the rows can be written
    once without their texts, and the top posts need no second scan of the texts. A task
    remembers k order keys for at most ``GROUPS_AT_ONCE`` groups; past that it forgets them,
    which only keeps more texts. Only the groups and the order keys go to Python, never the
    texts."""
    keys = list(keys)

    def wanted(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        best: dict[tuple, list] = {}
        for batch in batches:
            *names, views, links, posts = (column.to_pylist() for column in batch)
            kept = []
            for group, view, link, post in zip(zip(*names), views, links, posts, strict=True):
                # views descending with null last, link ascending with null first
                key = (view is None, -(view or 0), link is not None, link or "", post)
                if group not in best and len(best) >= GROUPS_AT_ONCE:
                    best.clear()
                top = best.setdefault(group, [])
                first = len(top) < k or key < top[-1]
                if first:
                    insort(top, key)
                    del top[k:]
                kept.append(first)
            yield pa.array(kept, pa.bool_())

    # what is kept depends on the rows before: evaluated once, where it stands
    mark = F.arrow_udf(wanted, "boolean").asNondeterministic()
    marked = scored.withColumn("kept", mark(*keys, "view_count", "link", POST_ID))
    return marked.withColumn("content", F.when(F.col("kept"), F.col("content")))


def top_k_posts(scored: DataFrame, k: int = TOP_K, order_col: str = "view_count",
                tie_col: str = "link", keys=tuple(KEYS)) -> DataFrame:
    """The k most-viewed posts per group, ties broken by link, then by the post's identity
    where the rows carry it (D15). Rows of ``keep_top_texts`` come with their texts."""
    ties = [tie_col] + ([POST_ID] if POST_ID in scored.columns else [])
    w = Window.partitionBy(*keys).orderBy(F.desc(order_col), *ties)
    if "kept" in scored.columns:
        scored = scored.filter("kept").drop("kept")
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def pack_posts(top: DataFrame, keys=tuple(KEYS)) -> DataFrame:
    """JSON array of {content, link} per group, in rank order.

    Input is the output of ``top_k_posts``: at most k rows per group."""
    items = F.sort_array(F.collect_list(F.struct("rank", "content", "link")))
    packed = F.transform(items, lambda x: F.struct(x["content"].alias("content"),
                                                   x["link"].alias("link")))
    return top.groupBy(*keys).agg(F.to_json(packed).alias("top_comm"))


def join_aggregates(packed: DataFrame, stats: DataFrame, keys=tuple(KEYS)) -> DataFrame:
    """Left join of the packed top posts with the group statistics."""
    return packed.join(stats, list(keys), "left")


def to_entities(grouped: DataFrame, issues: DataFrame, on=("accident",)) -> DataFrame:
    """Rows per category -> rows per (entity, category) with an open issue: the second
    level of D14-D17. Both sides have a few rows per category."""
    pairs = issues.select("car_model", *on).distinct()
    return pairs.join(grouped, list(on))
