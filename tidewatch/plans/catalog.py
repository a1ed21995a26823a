"""The registered queries: one per operator of the inventory, over the driver's
tables (see ``sources.standins`` for the binding). Each builder takes
``(spark, sf_dir)`` and returns a DataFrame; ``oracle.py`` holds the matching
SQL. Scores are rounded to 6 places and every computed column is aliased so
both sides carry the same names.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (BATCH_A, BATCH_B, COMMUNITY_KEYWORDS, EXPIRY_NOW, ONE_BATCH, EXPECTED_SOURCES, ISSUE_THRESHOLD, NEWS_CATEGORIES,
                      RANGE_COMM_COUNT, RANGE_NEWS_ACC_COUNT, REPLAY_TTL)
from ..functions import (clean_text, collapse_ws, format_period, join_paragraphs,
                         parse_count, parse_local_time, parse_period_end, parse_period_start,
                         parse_score, piecewise, render_prompt, score_from_response, severity,
                         strip_suffix)
from ..functions.scoring import alert_color, alert_label
from ..operators import aggregate as agg
from ..operators import alerts, issue, periods, state, tagging
from ..operators.scoring import (BatchScorer, CachedScorer, ColumnScorer, FallbackScorer,
                                 apply_scorer)
from ..session import many_folders, scratch_path
from ..sources import io, pages, standins
from ..sources.selectors import Field
from ..sources.standins import label_scorer, raw_news, raw_posts, table
from . import community, news, replay

R = 6  # rounding of averages and scores on both sides
ENTITY_WORDS = ["the", "und", "los", "les"]
SITES = {"de", "en", "es", "fr"}  # the sources whose markers a batch waits for
# period of the news records read from pages
NEWS_FROM, NEWS_TO = "2024-01-01 01:00:00", "2024-01-09 00:00:00"
PROMPT = "[%s / %s] %s :: %s"


# ---------------------------------------------------------------- shared pieces
def _docs(spark, sf):
    return table(spark, sf, "documents")


def _events(spark, sf):
    return table(spark, sf, "events")


def _pages(spark, sf):
    return table(spark, sf, "pages")


def _scorer(spark, sf):
    return label_scorer(table(spark, sf, "labels"))


def _news_tagged(spark, sf, keep=()):
    return news.tag_news(raw_news(_docs(spark, sf)), NEWS_CATEGORIES, keep)


def _news_scored(spark, sf, keep=()):
    return apply_scorer(_news_tagged(spark, sf, keep), _scorer(spark, sf), "news_score")


def _news_batch(spark, sf, period=ONE_BATCH, raw=None, evidence=False):
    docs = _docs(spark, sf)
    raw = raw_news(docs) if raw is None else raw
    return news.run_news(raw, period, standins.seed(docs), NEWS_CATEGORIES, _scorer(spark, sf),
                         evidence=evidence)


def _community_batch(spark, sf):
    nb = _news_batch(spark, sf)
    return nb, community.run_community(raw_posts(_docs(spark, sf)), ONE_BATCH, nb.state,
                                       standins.keyword_table(spark), _scorer(spark, sf),
                                       nb.aggregate)


def _posts_scored(spark, sf):
    """Scored posts (texts of possible top posts only), as the community batch computes them."""
    nb = _news_batch(spark, sf)
    return community.score_posts(raw_posts(_docs(spark, sf)), standins.keyword_table(spark),
                                 state.issue_list(nb.state), _scorer(spark, sf))


def _rounded(df, cols):
    for c in cols:
        df = df.withColumn(c, F.round(c, R))
    return df


def _state_out(df):
    return _rounded(df, ["news_score", "comm_score", "issue_score"])


def _hourly(spark, sf):
    return periods.assign_period(_events(spark, sf), "1 hour", col="ts")


def _in_batch(raw, p):
    return periods.in_period(raw, parse_period_start(F.lit(p)), parse_period_end(F.lit(p)))


# ---------------------------------------------------------------- A: sources / sinks
def a1_read_raw(spark, sf):
    """A4 write (per period and source) then A1 read of every written batch."""
    raw = periods.assign_period(raw_news(_docs(spark, sf)), "1 day")
    base = scratch_path(spark, "raw-news")
    raw.drop("period_start", "period_end").write.partitionBy("batch_period", "source") \
        .parquet(base)
    schema = T.StructType(list(io.RAW_SCHEMAS["news"].fields)
                          + [T.StructField("batch_period", T.StringType())])
    return spark.read.schema(schema).option("basePath", base).parquet(base)


def a2_read_aggregate(spark, sf):
    """A3 write of two batch aggregates, A2 read of each, A9 union."""
    base = scratch_path(spark, "news-agg")
    raw = raw_news(_docs(spark, sf))
    outs = []
    for p in (BATCH_A, BATCH_B):
        io.write_aggregate(_news_batch(spark, sf, p, _in_batch(raw, p)).aggregate, base, p)
        outs.append(io.read_aggregate(spark, "news", base, p).withColumn("batch_period", F.lit(p)))
    return _rounded(io.union_sources(outs), ["avg_news_score"])


def a3_write_aggregate(spark, sf):
    base = scratch_path(spark, "post-agg")
    _, cb = _community_batch(spark, sf)
    io.write_aggregate(cb.aggregate, base, ONE_BATCH)
    io.write_aggregate(cb.aggregate, base, ONE_BATCH)   # rerun replaces, never duplicates
    return _rounded(io.read_aggregate(spark, "posts", base, ONE_BATCH), ["avg_comm_score"])


def a4_write_records(spark, sf):
    """Records written per batch period and source (A4); each batch is read
    back on its own (one partition path each) and labelled."""
    base = scratch_path(spark, "records")
    raw = raw_news(_docs(spark, sf))
    io.write_records(_in_batch(raw, BATCH_A), base, BATCH_A)
    io.write_records(_in_batch(raw, BATCH_B), base, BATCH_B)
    return io.union_sources([io.read_records(spark, "news", base, p)
                             .withColumn("batch_period", F.lit(p)) for p in (BATCH_A, BATCH_B)])


def a7_config_tables(spark, sf):
    """Keyword map given as configuration (A7), limited to categories seen in the news."""
    seen = _news_tagged(spark, sf).select("accident").distinct()
    return standins.keyword_table(spark).join(seen, "accident", "left_semi")


def a5_state_snapshots(spark, sf):
    """Snapshots per batch; the read before BATCH_B returns BATCH_A's."""
    base = scratch_path(spark, "state")
    raw = raw_news(_docs(spark, sf))
    seed = standins.seed(_docs(spark, sf))
    s_a = _news_batch(spark, sf, BATCH_A, _in_batch(raw, BATCH_A)).state
    io.write_state(s_a, base, BATCH_A)
    prev = io.read_state(spark, base, BATCH_B, seed)
    s_b = news.run_news(_in_batch(raw, BATCH_B), BATCH_B, prev, NEWS_CATEGORIES,
                        _scorer(spark, sf), evidence=False).state
    io.write_state(s_b, base, BATCH_B)
    return _state_out(io.read_state(spark, base, BATCH_B + "~"))


AS_OF = ["2024-01-01-03-30-00", "2024-01-01-10-30-00", "2124"]


def a5_state_as_of(spark, sf):
    """The state after every hourly batch, stored as bases and changes, read as of some
    times: the last snapshot before each."""
    states = _replay(spark, sf).states
    store = io.state_store(spark, scratch_path(spark, "snapshots"), base_every=5)
    store.write(states, [r[0] for r in states.select("batch_period").distinct().collect()])
    return _state_out(io.union_sources([store.read_before(t).withColumn("as_of", F.lit(t)) for t in AS_OF]))


def a6_append_fact(spark, sf):
    base = scratch_path(spark, "fact")
    _, cb = _community_batch(spark, sf)
    io.append_fact(cb.fact, base, ONE_BATCH)
    io.append_fact(cb.fact, base, ONE_BATCH)   # a rerun replaces the batch partition
    got = io.read_fact(spark, base).drop("batch_period")
    return _rounded(got, ["issue_score"])


def a8_links_csv(spark, sf):
    path = scratch_path(spark, "links")
    io.write_links(pages.extract_links(_pages(spark, sf)), path)
    return io.read_links(spark, path)


def a9_union_sources(spark, sf):
    raw = raw_news(_docs(spark, sf))
    # one source per site, the rest as one more source: together every row
    sites = ("en", "fr", "de")
    parts = [raw.filter(F.col("source") == l) for l in sites]
    parts.append(raw.filter(~F.coalesce(F.col("source").isin(*sites), F.lit(False))))
    return io.union_sources(parts + [raw.filter(F.col("source") == "en")]).select(
        "link", "source", "keyword")


# ---------------------------------------------------------------- B: periods
def b1_parse_period(spark, sf):
    h = _hourly(spark, sf).select("batch_period").distinct()
    return h.select("batch_period", parse_period_start("batch_period").alias("period_start"),
                    parse_period_end("batch_period").alias("period_end"))


def b2_format_period(spark, sf):
    # both periods in one pass over the rows (no join back on the id)
    day = periods.assign_period(_events(spark, sf), "1 day", col="ts").select(
        "event_id", "ts", F.col("batch_period").alias("day_period"))
    return periods.assign_period(day, "1 hour", col="ts").select(
        "event_id", "batch_period", "day_period")


def b3_in_period(spark, sf):
    return periods.in_period(_events(spark, sf), "2024-01-01 02:00:00", "2024-01-01 09:00:00",
                             col="ts").select("event_id", "ts", "event_type")


def b3_in_period_closed(spark, sf):
    e = _events(spark, sf)
    first = e.agg(F.min("ts")).scalar()
    return periods.in_period(e, first, F.timestamp_add("HOUR", F.lit(3), first), col="ts",
                             closed="both").select("event_id", "ts")


def b4_in_time_of_day(spark, sf):
    return periods.in_time_of_day(_events(spark, sf), "09:00", "17:30", col="ts").select(
        "event_id", "ts")


def b5_assign_period(spark, sf):
    return _hourly(spark, sf).groupBy("batch_period", "period_start", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), R).alias("value"))


def b6_missing_sources(spark, sf):
    h = _hourly(spark, sf)
    arrived = h.select("batch_period", F.col("event_type").alias("source")).distinct()
    expected = periods.expected_markers(h, EXPECTED_SOURCES)
    return periods.missing_sources(expected, arrived, on=("batch_period", "source"))


def b7_period_from_marker(spark, sf):
    h = _hourly(spark, sf).select("event_type", "period_start", "period_end").distinct()
    markers = h.select(F.to_json(F.struct(
        F.col("event_type").alias("source"),
        F.date_format("period_start", "yyyy-MM-dd-HH-mm-ss").alias("start_time"),
        F.date_format("period_end", "yyyy-MM-dd-HH-mm-ss").alias("end_time"),
        F.lit("success").alias("status"))).alias("marker"))
    return periods.period_from_marker(markers).select(
        F.col("marker_source").alias("source"), "batch_period")


def b8_sort_by_time(spark, sf):
    return periods.sort_by_time(_events(spark, sf), col="ts").select("event_id", "ts",
                                                                      "event_type")


# ---------------------------------------------------------------- C: extraction
# the driver's pages: heading and paragraphs in an article, the language on the root, links
# in a list; paragraphs and links stand in for the counts
PAGE_RULES = {
    "heading": Field("body > article > h1"),
    "title": Field("head title"),
    "lang": Field("html", attr="lang"),
    "views": Field("article p", count=True),
    "likes": Field("nav li > a:not([class])", count=True),
}


def c1_extract_records(spark, sf):
    return pages.extract_records(_pages(spark, sf), F.col("lang"), "2024-01-01 00:00:00", PAGE_RULES)


def c1_title_tag(spark, sf):
    return _pages(spark, sf).select("page_id", pages.extract_tag("html", "title").alias("title"))


def c1_news_records(spark, sf):
    """Articles found by one search per entity, with the list's time and the page's texts,
    of one period."""
    p = _pages(spark, sf)
    minutes = F.timestamp_add("MINUTE", F.col("page_id"), F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")))
    found = p.select("url", F.date_format(minutes, "yyyy.MM.dd HH:mm").alias("time_text"),
                     pages.extract_tag("html", "title").alias("title"))
    hits = tagging.explode_tags(tagging.tag_flat(found, ENTITY_WORDS, "keyword", cols=("title",)), "keyword")
    rules = {"title": Field("article > h1", strip=True),
             "content": Field("article", drop=("h1", ".ad"), sep=" ")}
    return pages.news_records(p, hits, "pages", F.lit(NEWS_FROM).cast("timestamp_ntz"),
                              F.lit(NEWS_TO).cast("timestamp_ntz"), rules, suffix=".")[0]


def c2_drop_blocks(spark, sf):
    """Blocks by class, by nesting, and one that is never closed."""
    p = pages.drop_blocks(_pages(spark, sf), [".ad", "body > nav", "footer", "nav li"])
    open_ended = pages.drop_blocks(p, ["article b"])
    return open_ended.select("page_id", "html")


def c2_page_spans(spark, sf):
    """Where the dropped blocks stand."""
    spans = pages.page_spans(_pages(spark, sf), ["div.ad", "article > h1"])
    return spans.filter("selected").select("page_id", "tag", "depth", F.array_join("classes", " ").alias("classes"),
                                           "begin", "inner_begin", "inner_end", "end")


def c8_fill_defaults(spark, sf):
    """Posts that lack a time, a title, a text or counts."""
    posts = raw_posts(_docs(spark, sf))
    lacking = posts.select(
        "link", F.when(F.col("source") != "en", F.col("post_time")).alias("post_time"),
        F.when(F.length("title") < 40, F.col("title")).alias("title"),
        F.when(F.col("view_count") > 200, F.col("content")).otherwise("").alias("content"),
        F.nullif("view_count", "like_count").alias("view_count"),
        F.when(F.col("like_count") > 1, F.col("like_count")).alias("like_count"))
    return pages.fill_defaults(lacking, "2024-01-01 00:00:00")


def c9_absolute_link(spark, sf):
    from ..functions.text import absolute_link
    links = pages.extract_links(_pages(spark, sf))
    return links.select("page_id", absolute_link("link", "https://m.example").alias("link"))


def c3_join_paragraphs(spark, sf):
    return _docs(spark, sf).select("doc_id", join_paragraphs(F.split("text", "\n"), " ")
                                   .alias("joined"))


def c4_collapse_ws(spark, sf):
    return _docs(spark, sf).select("doc_id", collapse_ws("text").alias("collapsed"))


def c5_strip_suffix(spark, sf):
    return _docs(spark, sf).select("doc_id", strip_suffix("text", ".").alias("stripped"))


def _time_texts(spark, sf):
    e = _events(spark, sf)
    h = F.hour("ts")
    marker = F.when(h < 12, F.lit("오전")).otherwise(F.lit("오후"))
    return e.select(
        "event_id",
        F.concat(F.date_format("ts", "yyyy.MM.dd. "), marker, F.lit(" "),
                 F.date_format("ts", "hh:mm."))
        .alias("t_marker"),
        F.date_format("ts", "yyyy.MM.dd. HH:mm").alias("t_24"),
        F.date_format("ts", "yyyyMMdd HHmmss").alias("t_compact"),
        F.col("event_type").alias("t_junk"))


def c6_parse_local_time(spark, sf):
    t = _time_texts(spark, sf)
    return t.select("event_id", *[parse_local_time(c).alias(c.replace("t_", "p_"))
                                  for c in ("t_marker", "t_24", "t_compact", "t_junk")])


def c7_parse_count(spark, sf):
    e = _events(spark, sf)
    k = F.get_json_object("props", "$.k")
    big = F.format_number(F.round(F.col("value") * 1000).cast("bigint"), 0)
    return e.select("event_id", parse_count(k).alias("k"), parse_count(big).alias("big"),
                    parse_count("event_type").alias("junk"))


def c10_explode_search(spark, sf):
    e = _events(spark, sf).select(
        "event_id",
        F.concat(F.lit("Search.SearchPreCallback({\"KR_ARTICLE\":{\"result\":["), F.col("props"),
                 F.lit(",{\"k\":"), F.col("user_id").cast("string"), F.lit("}]}})"))
        .alias("response"))
    hits = pages.explode_search(e, "KR_ARTICLE struct<result: array<struct<k: bigint>>>",
                                ["KR_ARTICLE", "result"])
    return hits.select("event_id", F.col("hit.k").alias("k"))


def c11_extract_links(spark, sf):
    return pages.extract_links(_pages(spark, sf), base="https://site.example").select(
        "page_id", "pos", "link")


def c11_select_links(spark, sf):
    """Rows of the page's list by selectors, with the link and text of each."""
    return pages.extract_rows(_pages(spark, sf), "nav > ul > li", {"link": Field("a", attr="href"),
                                                                   "text": Field("a", strip=True)})


def c12_drop_failed(spark, sf):
    scored = _scorer(spark, sf)(raw_news(_docs(spark, sf)), "score")
    kept, _ = pages.drop_failed(scored, ["score"])
    return kept.select("link", "score")


def c13_match_entities(spark, sf):
    return tagging.match_entities(raw_news(_docs(spark, sf)), ENTITY_WORDS).select(
        "link", "keyword")


def c13_match_entity_table(spark, sf):
    """A row per (article, entity it mentions) for a table of entities: here every longer
    word of the benchmark."""
    words = table(spark, sf, "benchmark").select(F.explode(F.split("text", "[^a-zA-Z]+")).alias("entity"))
    entities = words.filter(F.length("entity") >= 5).distinct()
    return tagging.match_keyword_table(raw_news(_docs(spark, sf)), entities, "entity").select("link", "entity")


# ---------------------------------------------------------------- D: transform
def d1_clean_text(spark, sf):
    return _docs(spark, sf).select("doc_id", clean_text("text").alias("cleaned"))


def d2_project_news(spark, sf):
    return tagging.project_news(raw_news(_docs(spark, sf)))


def d3_tag_flat(spark, sf):
    df = tagging.clean_columns(tagging.project_news(raw_news(_docs(spark, sf))), ("content",))
    t = tagging.tag_flat(df, NEWS_CATEGORIES)
    return t.select("link", F.array_join("accident", ",", "-").alias("tags"))


def d4_tag_mapped(spark, sf):
    df = tagging.clean_columns(raw_posts(_docs(spark, sf)), ("content", "title"))
    t = tagging.tag_mapped(df, COMMUNITY_KEYWORDS)
    return t.select("link", F.array_join(F.array_sort("accident"), ",").alias("tags"))


def d5_explode_tags(spark, sf):
    return _news_tagged(spark, sf).select("car_model", "accident", "link")


def d6_select_keywords(spark, sf):
    issues = state.issue_list(_news_batch(spark, sf).state)
    return tagging.select_keywords(standins.keyword_table(spark), issues)


def d7_expand_to_entities(spark, sf):
    nb = _news_batch(spark, sf)
    posts = community.tag_posts(raw_posts(_docs(spark, sf)), standins.keyword_table(spark),
                                state.issue_list(nb.state))
    return posts.select("link", "accident", "car_model")


def d8_render_prompt(spark, sf):
    t = _news_tagged(spark, sf)
    return t.select("link", "accident",
                    render_prompt(PROMPT, "car_model", "accident", "title", "content")
                    .alias("prompt"))


def d9_parse_score(spark, sf):
    e = _events(spark, sf)
    k = F.get_json_object("props", "$.k")
    return e.select("event_id", parse_score(k).alias("s_plain"),
                    parse_score(F.concat(F.lit(" "), k, F.lit("\n"))).alias("s_padded"),
                    parse_score(F.col("value").cast("string")).alias("s_decimal"),
                    parse_score(F.concat(F.lit("+"), k)).alias("s_signed"),
                    parse_score(F.concat(k, F.lit("점"))).alias("s_suffixed"),
                    score_from_response("props", "$.k").alias("s_response"),
                    score_from_response("event_type", "$.k").alias("s_malformed"))


def d10_apply_scorer(spark, sf):
    return _news_scored(spark, sf).select("car_model", "accident", "link", "news_score")


def d11_fallback_score(spark, sf):
    secondary = ColumnScorer(lambda df: F.least(F.length("title"), F.lit(100)))
    scorer = FallbackScorer(_scorer(spark, sf), secondary)
    return apply_scorer(_news_tagged(spark, sf), scorer, "news_score").select(
        "car_model", "accident", "link", "news_score")


def _length_model(pdf: pd.DataFrame) -> pd.Series:
    """Stand-in for a remote model: a score from the text length."""
    return (pdf["content"].str.len() // 50).clip(upper=100)


def d12_materialise_scores(spark, sf):
    scorer = BatchScorer(_length_model, ["content"], max_in_flight=4)
    scored = apply_scorer(_news_tagged(spark, sf), scorer, "news_score")   # materialised
    return scored.select("car_model", "accident", "link", "news_score")


def d12_cached_scores(spark, sf):
    """Two batches scored through one table of scores: the second asks the model only for
    texts that the first has not asked for."""
    scorer = CachedScorer(BatchScorer(_length_model, ["content"], max_in_flight=4), scratch_path(spark, "scores"),
                          "length-1")
    raw = raw_news(_docs(spark, sf))
    scored = [news.score_news(_in_batch(raw, p), NEWS_CATEGORIES, scorer).withColumn("batch_period", F.lit(p))
              for p in (BATCH_A, BATCH_B)]
    return io.union_sources(scored).select("car_model", "accident", "link", "news_score", "batch_period")


def d13_aggregate_news(spark, sf):
    return _rounded(_news_batch(spark, sf).aggregate, ["avg_news_score"])


def d13_news_evidence(spark, sf):
    return _news_batch(spark, sf, evidence=True).evidence


def d13_packed_news(spark, sf):
    nb = _news_batch(spark, sf, evidence=True)
    return agg.pack_evidence(nb.evidence, nb.aggregate, max_items=1000)


def d14_aggregate_posts(spark, sf):
    return _rounded(community.post_stats(_posts_scored(spark, sf)), ["avg_comm_score"])


def d15_top_k_posts(spark, sf):
    return community.top_posts(_posts_scored(spark, sf)).select("car_model", "accident", "rank", "link",
                                                                "view_count")


def d16_pack_posts(spark, sf):
    return community.packed_posts(_posts_scored(spark, sf))


def d17_join_aggregates(spark, sf):
    return _rounded(community.aggregate_batch(_posts_scored(spark, sf)), ["avg_comm_score"])


# ---------------------------------------------------------------- E: state, issues
def e1_fold_news(spark, sf):
    docs = _docs(spark, sf)
    nb = _news_batch(spark, sf)
    return _state_out(state.fold_news(standins.seed(docs), nb.aggregate, ONE_BATCH))


def _two_batches(spark, sf):
    raw = raw_news(_docs(spark, sf))
    s_a = _news_batch(spark, sf, BATCH_A, _in_batch(raw, BATCH_A)).state
    return news.run_news(_in_batch(raw, BATCH_B), BATCH_B, s_a, NEWS_CATEGORIES,
                         _scorer(spark, sf), evidence=False).state


def e2_start_on_first(spark, sf):
    return _two_batches(spark, sf).select("car_model", "accident", "start_batch_time",
                                          "last_batch_time", "news_acc_count")


def e4_clear_alerts(spark, sf):
    return _two_batches(spark, sf).select("car_model", "accident", "is_issue", "is_alert")


def e3_append_evidence(spark, sf):
    raw = raw_news(_docs(spark, sf))
    ev = None
    for p in (BATCH_A, BATCH_B):
        ev = state.append_evidence(
            ev, _news_batch(spark, sf, p, _in_batch(raw, p), evidence=True).evidence, p)
    return ev


def e3_current_evidence(spark, sf):
    """The articles of each key's current run, after a replay with expiry."""
    docs = _docs(spark, sf)
    timed = periods.assign_period(raw_news(docs), "1 hour")
    evidence = news.tag_news(timed, NEWS_CATEGORIES, keep=("batch_period",)).select(
        "car_model", "accident", "content", "link", "batch_period")
    return state.current_evidence(evidence, g3_replay_news_expiry(spark, sf))


def e5_open_issues(spark, sf):
    return _state_out(_news_batch(spark, sf).state)


def e6_expire_issues(spark, sf):
    docs = _docs(spark, sf)
    raw = raw_news(docs)
    s = _news_batch(spark, sf, BATCH_A, _in_batch(raw, BATCH_A)).state
    s = news.run_news(_in_batch(raw, BATCH_B), BATCH_B, s, NEWS_CATEGORIES,
                      _scorer(spark, sf), evidence=False).state
    return _state_out(state.expire_issues(s, EXPIRY_NOW))


def e7_fold_posts(spark, sf):
    nb, cb = _community_batch(spark, sf)
    return _state_out(state.fold_posts(nb.state, cb.aggregate))


def e8_issue_list(spark, sf):
    return state.issue_list(_news_batch(spark, sf).state)


def e9_distinct_entities(spark, sf):
    return state.distinct_entities(state.issue_list(_news_batch(spark, sf).state))


def e10_piecewise(spark, sf):
    e = _events(spark, sf)
    return e.select("event_id", F.round(piecewise("value", 20, 50, 100), R).alias("p"))


def _scored_issues(spark, sf):
    nb, cb = _community_batch(spark, sf)
    folded = state.fold_posts(nb.state, cb.aggregate)
    return issue.score_issues(folded, nb.aggregate, cb.aggregate)


def e11_normalise(spark, sf):
    n = issue.normalise(_scored_issues(spark, sf))
    cols = ["n_news_score", "n_comm_score", "n_news_count", "n_news_acc_count", "n_comm_count"]
    return _rounded(n.select("car_model", "accident", *cols), cols)


def e12_attach_batch_counts(spark, sf):
    s = _scored_issues(spark, sf)
    return s.select("car_model", "accident", "news_count", "comm_count", "comm_positive_count",
                    "comm_negative_count", "top_comm")


def e13_issue_score(spark, sf):
    s = _scored_issues(spark, sf)
    return s.select("car_model", "accident",
                    F.round("new_issue_score", R).alias("issue_score"))


def e14_severity(spark, sf):
    s = _scored_issues(spark, sf)
    x = F.round("new_issue_score", R)
    return s.select("car_model", "accident", severity(x).alias("severity"),
                    severity(x, closed="right").alias("severity_inclusive"))


def e15_alert_on_change(spark, sf):
    return _state_out(_community_batch(spark, sf)[1].state)


def e16_batch_view(spark, sf):
    return _state_out(_community_batch(spark, sf)[1].view)


def e17_to_fact(spark, sf):
    return _rounded(_community_batch(spark, sf)[1].fact, ["issue_score"])


def e18_parse_top_posts(spark, sf):
    f = _community_batch(spark, sf)[1].fact
    return f.select("car_model", "accident",
                    F.posexplode(issue.parse_top_posts("top_comm")).alias("pos", "post")).select(
        "car_model", "accident", "pos", F.col("post.link").alias("link"))


def e19_seed_state(spark, sf):
    return _state_out(standins.seed(_docs(spark, sf)))


# ---------------------------------------------------------------- F: alerts
def f1_alertable(spark, sf):
    return _rounded(alerts.alertable(_community_batch(spark, sf)[1].state), ["issue_score"])


def f2_alert_level(spark, sf):
    s = _scored_issues(spark, sf)
    x = F.round("new_issue_score", R)
    return s.select("car_model", "accident", alert_label(x).alias("level"),
                    alert_color(x).alias("color"))


def f3_render_alert(spark, sf):
    return _community_batch(spark, sf)[1].alerts


# ---------------------------------------------------------------- G: compositions
def _write_markers(spark, path, arrived):
    """Marker files as the sources leave them, from (source, batch_period)."""
    bounds = F.split("batch_period", "_")
    arrived.select(F.to_json(F.struct("source", bounds[0].alias("start_time"), bounds[1].alias("end_time"),
                                      F.lit("success").alias("status"))).alias("value")) \
        .repartition(3).write.text(path)


def _run_news_files(spark, sf):
    """G1 as a file job behind its markers; returns the folder and its inputs."""
    docs = _docs(spark, sf)
    base = scratch_path(spark, "job")
    io.write_records(raw_news(docs), f"{base}/raw", ONE_BATCH)
    _write_markers(spark, f"{base}/markers", docs.select(
        F.col("lang").alias("source"), F.lit(ONE_BATCH).alias("batch_period")).distinct())
    news.run_ready_news(spark, f"{base}/markers", f"{base}/raw", f"{base}/out", NEWS_CATEGORIES,
                        _scorer(spark, sf), standins.seed(docs), sorted(SITES))
    return docs, base


def g1_run_news(spark, sf):
    """The news job over files, started by its markers: the snapshot that it wrote."""
    _, base = _run_news_files(spark, sf)
    return _state_out(io.read_state(spark, f"{base}/out/state_news"))


def g2_run_community(spark, sf):
    """The community job over files, after the news job: the fact rows that it appended."""
    docs, base = _run_news_files(spark, sf)
    io.write_records(raw_posts(docs), f"{base}/posts", ONE_BATCH)
    community.run_community_job(spark, f"{base}/posts", f"{base}/out", ONE_BATCH, standins.keyword_table(spark),
                                _scorer(spark, sf))
    return _rounded(io.read_fact(spark, f"{base}/out/fact").drop("batch_period"), ["issue_score"])


def g3_replay_news(spark, sf):
    docs = _docs(spark, sf)
    s = replay.replay_news(raw_news(docs), standins.seed(docs), NEWS_CATEGORIES,
                           _scorer(spark, sf))
    return _state_out(s)


def g3_replay_news_expiry(spark, sf):
    """Replay with issues expiring two hours after a key's last article."""
    docs = _docs(spark, sf)
    s = replay.replay_news(raw_news(docs), standins.seed(docs), NEWS_CATEGORIES,
                           _scorer(spark, sf), ttl=REPLAY_TTL)
    return _state_out(s)


def _replay(spark, sf):
    docs = _docs(spark, sf)
    return replay.replay(raw_news(docs), raw_posts(docs), standins.seed(docs), NEWS_CATEGORIES, _scorer(spark, sf),
                         standins.keyword_table(spark), _scorer(spark, sf), ttl=REPLAY_TTL)


def g3_replay_states(spark, sf):
    """Both stages of every hourly batch in one pass, with expiry: the state after each."""
    return _rounded(_replay(spark, sf).states, ["news_score", "comm_score", "issue_score"])


def g3_replay_facts(spark, sf):
    """The fact rows of every hourly batch of the same replay."""
    return _rounded(_replay(spark, sf).facts, ["issue_score"])


def g3_replay_alerts(spark, sf):
    """The alert payloads of every hourly batch of the same replay."""
    return _replay(spark, sf).alerts.select("car_model", "accident", "batch_period", "level", "color")


def _hourly_folders(spark, docs, base):
    """Raw-news folders of several files each; returns their number. The hours are cut into
    stretches, as many as there are cores, and each is written by three tasks."""
    raw = periods.assign_period(raw_news(docs), "1 hour").drop("period_end")
    first, last = (raw.agg(f("period_start")).scalar() for f in (F.min, F.max))
    hours, n = lambda to: F.timestamp_diff("HOUR", first, to), spark.sparkContext.defaultParallelism
    stretch = F.floor(hours(F.col("period_start")) * n / (hours(last) + 1))
    task = (stretch * 3 + F.pmod(F.xxhash64("link"), F.lit(3))).cast("int")
    (raw.withColumn("_task", F.coalesce(task, F.lit(0))).repartitionById(3 * n, "_task").drop("_task", "period_start")
     .write.partitionBy("batch_period").parquet(f"{base}/raw"))
    with many_folders(spark):
        return len(spark.read.parquet(f"{base}/raw").inputFiles())


def _streamed(spark, sf, ttl=None):
    from ..streaming import stream_news
    docs = _docs(spark, sf)
    base = scratch_path(spark, "stream")
    files = _hourly_folders(spark, docs, base)
    q = stream_news(spark, f"{base}/raw", f"{base}/out", f"{base}/ckpt", NEWS_CATEGORIES,
                    _scorer(spark, sf), standins.seed(docs),
                    max_files_per_trigger=-(-files // 4), ttl=ttl)
    q.awaitTermination()
    return _state_out(io.read_state(spark, f"{base}/out/state"))


def g4_stream_news(spark, sf):
    """Hourly raw-news folders of several files each, drained by the file stream in
    micro-batches that cut through the hours; final state snapshot."""
    return _streamed(spark, sf)


def g4_stream_news_expiry(spark, sf):
    """The same with issues expiring two hours after a key's last article."""
    return _streamed(spark, sf, REPLAY_TTL)


# a site's marker for an hour is there if it has this many articles
ARRIVED_FROM = 5


def g4_complete_news(spark, sf):
    """The stream behind the arrival gate: only hours for which every site's marker has
    arrived are folded; final state snapshot."""
    from ..streaming import stream_complete_news
    docs = _docs(spark, sf)
    base = scratch_path(spark, "gated")
    _hourly_folders(spark, docs, base)
    hours = periods.assign_period(raw_news(docs), "1 hour")
    arrived = hours.groupBy("source", "batch_period").count().filter(F.col("count") >= ARRIVED_FROM)
    _write_markers(spark, f"{base}/markers", arrived)
    q = stream_complete_news(spark, f"{base}/markers", f"{base}/raw", f"{base}/out", f"{base}/ckpt",
                             NEWS_CATEGORIES, _scorer(spark, sf), standins.seed(docs), sorted(SITES),
                             max_files_per_trigger=1)
    q.awaitTermination()
    return _state_out(io.read_state(spark, f"{base}/out/state", seed=standins.seed(docs)))


QUERIES = {name: fn for name, fn in globals().items()
           if callable(fn) and name[:1] in "abcdefg" and name[1:2].isdigit()}
