"""Declared schemas for every table the engine reads or writes.

Every read uses one of these (no inference), so an empty batch folder or a
file with null-typed columns still yields the right column types.
"""

from pyspark.sql import types as T

S, L, D, B, NTZ = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampNTZType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# One crawled news article; ``keyword`` is the entity searched for
RAW_NEWS = _struct(("post_time", NTZ), ("title", S), ("content", S), ("source", S),
                   ("link", S), ("keyword", S))

# One community post (no entity column: entities come from open issues)
RAW_POSTS = _struct(("post_time", NTZ), ("title", S), ("content", S), ("view_count", L),
                    ("like_count", L), ("source", S), ("link", S))

# News aggregate per (entity, category) for one batch
NEWS_AGG = _struct(("car_model", S), ("accident", S), ("count", L), ("avg_news_score", D))

# evidence rows behind T3 (the reference packs them into one JSON array per group)
EVIDENCE = _struct(("car_model", S), ("accident", S), ("content", S), ("link", S))

# T4: community aggregate per (entity, category) for one batch
POST_AGG = _struct(("car_model", S), ("accident", S), ("top_comm", S), ("avg_comm_score", D),
                   ("count", L), ("comm_positive_count", L), ("comm_negative_count", L))

# T5: state, one row per (entity, category)
STATE = _struct(("car_model", S), ("accident", S), ("start_batch_time", NTZ),
                ("last_batch_time", NTZ), ("news_acc_count", L), ("comm_acc_count", L),
                ("news_score", D), ("comm_score", D), ("issue_score", D), ("is_issue", B),
                ("is_alert", B), ("dashboard_url", S))

# Fact row per (entity, category, batch)
FACT = _struct(("car_model", S), ("accident", S), ("issue_score", D), ("comm_count", L),
               ("news_count", L), ("start_batch_time", NTZ), ("batch_time", NTZ),
               ("top_comm", S), ("comm_positive_count", L), ("comm_negative_count", L))

# T7 issue list, T8 keyword configuration
ISSUES = _struct(("car_model", S), ("accident", S))
KEYWORDS = _struct(("accident", S), ("keyword", S))

# T9 search response, T10 arrival marker, raw pages, link lists
SEARCH_RESPONSE = _struct(("url", S), ("response", S))
MARKER = _struct(("source", S), ("batch_period", S))
PAGES = _struct(("page_id", L), ("url", S), ("html", S))
LINKS = _struct(("link", S))

# scored row: the scorer output type is an integer, NULL meaning "failed"
SCORE_TYPE = T.IntegerType()
