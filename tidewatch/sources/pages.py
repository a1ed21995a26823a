"""Record extraction from raw pages and search responses.

Pages arrive as a table ``(page_id, url, html)``; extraction is a distributed
job over it. Fields that one regular expression can find (a ``<title>``, all
``href`` values, a JSONP body) use built-in functions. Fields named by selectors
(class, id, nesting) need a tokenizer, so that part runs over Arrow batches, one
pass per page for all fields (``selectors``).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_BODY, DEFAULT_TITLE, JSONP_PATTERN, PAGE_DROP_CLASSES
from ..functions.text import absolute_link, collapse_ws, parse_count, strip_suffix, strip_ws
from ..functions.time import parse_local_time
from ..operators.periods import in_period
from .selectors import Automaton, Field, FieldReader, SpanReader, cut, read_fields, read_rows, walked

# the fields of a record; ``heading`` wins over ``title``
PAGE_FIELDS = {
    "title": Field("title"),
    "heading": Field("h1"),
    "body": Field("article", drop=("h1", *(f".{c}" for c in PAGE_DROP_CLASSES)), sep=" "),
    "n_paragraphs": Field("article p", count=True),
}

_ROWS = 256  # pages that are held as Python texts at a time


def parse_page(html: str | None, rules=PAGE_FIELDS):
    """(title, heading, body, n_paragraphs) of one page; (None,)*3 + (0,) on failure."""
    got = read_fields(html, rules)
    if got is None:
        return None, None, None, 0
    page = dict(zip(rules, got, strict=True))
    return page["title"], page["heading"], page["body"] or "", int(page["n_paragraphs"])


def _sliced(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _fields_ddl(df: DataFrame, cols) -> list[str]:
    types = dict(df.dtypes)
    return [f"`{c}` {types[c]}" for c in cols]


def extract_fields(pages: DataFrame, rules: dict[str, Field], keep: tuple[str, ...] = ()) -> DataFrame:
    """The fields of every page (C1), one row per page: page_id, url, a text column per
    rule (null without a match), ``parsed`` (whether the page could be read) and ``keep``."""
    rules, keep = dict(rules), ("page_id", "url", *keep)

    def run(batches):
        automaton = FieldReader.compiled(rules)
        for batch in _sliced(batches):
            rows = [read_fields(h, rules, automaton) for h in batch.column(0).to_pylist()]
            texts = [pa.array([r[i] if r else None for r in rows], pa.string()) for i in range(len(rules))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *texts, pa.array([r is not None for r in rows], pa.bool_())],
                names=[*keep, *rules, "parsed"])

    ddl = [*_fields_ddl(pages, keep), *(f"`{r}` string" for r in rules), "parsed boolean"]
    return pages.select("html", *keep).mapInArrow(run, ", ".join(ddl))


def extract_rows(pages: DataFrame, row: str, rules: dict[str, Field]) -> DataFrame:
    """Rows of a list page by selectors (C11): page_id, ``pos`` and a text column per rule,
    one row per match of ``row``; rows in which no rule matches are left out."""
    rules = dict(rules)

    def run(batches):
        automaton = FieldReader.compiled(rules, row)
        for batch in _sliced(batches):
            ids, pos, found = [], [], []
            for page_id, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = [r for r in read_rows(html, row, rules, automaton) if any(v is not None for v in r)]
                ids += [page_id] * len(rows)
                pos += range(len(rows))
                found += rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field(0).type), pa.array(pos, pa.int32()),
                 *(pa.array([r[i] for r in found], pa.string()) for i in range(len(rules)))],
                names=["page_id", "pos", *rules])

    ddl = [*_fields_ddl(pages, ["page_id"]), "pos int", *(f"`{r}` string" for r in rules)]
    return pages.select("page_id", "html").mapInArrow(run, ", ".join(ddl))


_SPAN = {"element": ("bigint", pa.int64()), "parent": ("bigint", pa.int64()), "depth": ("int", pa.int32()),
         "tag": ("string", pa.string()), "id": ("string", pa.string()),
         "classes": ("array<string>", pa.list_(pa.string())), "begin": ("bigint", pa.int64()),
         "inner_begin": ("bigint", pa.int64()), "inner_end": ("bigint", pa.int64()), "end": ("bigint", pa.int64()),
         "selected": ("boolean", pa.bool_())}


def page_spans(pages: DataFrame, selectors: list[str]) -> DataFrame:
    """The span table of the pages: one row per element with its place in the page (offsets
    in code points), its depth, parent, tag, id and classes, and whether any of
    ``selectors`` matches it. Pages that cannot be read have no rows."""
    def run(batches):
        automaton = Automaton(list(selectors))
        for batch in _sliced(batches):
            ids, rows = [], []
            for page_id, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reader = SpanReader(automaton)
                if walked(reader, html):
                    ids += [page_id] * len(reader.rows)
                    rows += reader.rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field(0).type),
                 *(pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(_SPAN.values()))],
                names=["page_id", *_SPAN])

    ddl = [*_fields_ddl(pages, ["page_id"]), *(f"`{n}` {t}" for n, (t, _) in _SPAN.items())]
    return pages.select("page_id", "html").mapInArrow(run, ", ".join(ddl))


def drop_blocks(pages: DataFrame, selectors: list[str], col: str = "html") -> DataFrame:
    """The pages without the elements that match any of ``selectors`` (C2): html in, html
    out, all else as it was. Each element is an interval of the page, from its start tag to
    its end, so nested blocks are cut once and a block without an end tag goes up to where
    its parent ends. A page that cannot be read stays as it is."""
    names = pages.columns
    at = names.index(col)

    def run(batches):
        automaton = Automaton(list(selectors))
        for batch in _sliced(batches):
            out = []
            for html in batch.column(at).to_pylist():
                reader = SpanReader(automaton)
                if walked(reader, html):
                    html = cut(html, [(r[6], r[9]) for r in reader.rows if r[10]])
                out.append(html)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.string()) if i == at else c for i, c in enumerate(batch.columns)], names=names)

    return pages.mapInArrow(run, pages.schema)


def extract_pages(pages: DataFrame, rules=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Title, heading and body text of every page (C1, C2, C3) and ``parsed``; columns
    named in ``keep`` pass through unchanged."""
    rules = {**PAGE_FIELDS, **(rules or {})}
    x = extract_fields(pages, rules, keep)
    body = F.when(F.col("parsed"), F.coalesce("body", F.lit("")))
    count = F.coalesce(F.col("n_paragraphs").cast("bigint"), F.lit(0))
    return x.withColumns({"body": body, "n_paragraphs": count})


def _field(html: Column, pattern: str | None) -> Column:
    """First capture group of ``pattern`` in the page, NULL when absent."""
    if not pattern:
        return F.lit(None).cast("string")
    return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))


_TIME_VIEWS_LIKES = {"time": "time_regex", "views": "views_regex", "likes": "likes_regex"}


def fill_defaults(records: DataFrame, default_time: str | Column) -> DataFrame:
    """Defaults of a post's fields (C8): a missing title becomes "Untitled", a missing or
    empty content one space, a missing count 0, a missing time ``default_time`` (a batch
    start, never the clock). Only the columns that are there are filled."""
    at = F.to_timestamp_ntz(F.lit(default_time)) if isinstance(default_time, str) else default_time
    zero = F.lit(0).cast("bigint")
    fill = {"post_time": F.coalesce("post_time", at),
            "title": F.coalesce("title", F.lit(DEFAULT_TITLE)),
            "content": F.coalesce(F.nullif(F.col("content"), F.lit("")), F.lit(DEFAULT_BODY)),
            "view_count": F.coalesce("view_count", zero), "like_count": F.coalesce("like_count", zero)}
    return records.withColumns({c: v for c, v in fill.items() if c in records.columns})


def extract_posts(pages: DataFrame, source: str | Column, rules=None) -> DataFrame:
    """Pages -> posts as read (C1): post_time, title (the heading, else the title), content
    (white space collapsed), view_count, like_count, source, link, ``parsed``. What a page
    lacks is null.

    ``rules`` adds or replaces fields; ``time``, ``views`` and ``likes`` are read by such a
    rule or found by an expression with one group (``time_regex``, ``views_regex``,
    ``likes_regex``). ``source`` may be a column over the fields."""
    r = dict(rules or {})
    found = {f"_{name}": _field(F.col("html"), r.pop(key, None)) for name, key in _TIME_VIEWS_LIKES.items()}
    fields = {**PAGE_FIELDS, **r}
    x = extract_fields(pages.withColumns(found), fields, tuple(found))
    time, views, likes = (F.col(n if n in fields else f"_{n}") for n in _TIME_VIEWS_LIKES)
    return x.select(
        parse_local_time(time).alias("post_time"), F.coalesce("heading", "title").alias("title"),
        collapse_ws("body").alias("content"),
        F.when(views.isNotNull(), parse_count(views)).alias("view_count"),
        F.when(likes.isNotNull(), parse_count(likes)).alias("like_count"),
        (F.lit(source) if isinstance(source, str) else source).alias("source"),
        F.col("url").alias("link"), "parsed")


def extract_records(pages: DataFrame, source: str | Column, default_time: str,
                    rules=None) -> DataFrame:
    """Pages -> community-post rows (T2) (C1 + C12 + C4 + C6 + C7 + C8): pages that cannot
    be read are left out, what a page lacks gets its default."""
    read, _ = drop_unread(extract_posts(pages, source, rules))
    return fill_defaults(read, default_time)


def drop_unread(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records of the pages that could be read, the others)."""
    ok = F.col("parsed")
    return records.filter(ok).drop("parsed"), records.filter(~ok).drop("parsed")


NEWS_REQUIRED = ["post_time", "title", "content"]


def news_records(pages: DataFrame, hits: DataFrame, source: str, start, end, rules: dict[str, Field],
                 suffix: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Article pages and the searches that found them -> news rows (T1) of one period, and
    the rows that lack a time, a title or a text (C1 + C3-C6 + C12 + B3).

    ``hits`` has ``url`` and ``keyword`` (the entity searched for) and may have ``time_text``
    and ``title``, which a result list gives; a page's own ``time`` and ``title`` rules win.
    An article found by several keywords gives a row for each. Every page is read once,
    before the join, and only its fields are joined."""
    x = extract_fields(pages, rules).drop("page_id", "parsed")
    listed = hits.select("url", "keyword", *[F.col(c).alias(f"_{c}") for c in ("time_text", "title")
                                             if c in hits.columns]).distinct()
    x = x.join(listed, "url")

    def either(rule, hit):
        have = [F.col(c) for c in (rule, hit) if c in x.columns]
        return F.coalesce(*have) if have else F.lit(None).cast("string")

    content = collapse_ws(either("content", "body"))
    rows = x.select(parse_local_time(either("time", "_time_text")).alias("post_time"),
                    strip_ws(either("title", "_title")).alias("title"),
                    (strip_suffix(content, suffix) if suffix else content).alias("content"),
                    F.lit(source).alias("source"), F.col("url").alias("link"), "keyword")
    good, bad = drop_failed(rows, NEWS_REQUIRED)
    return in_period(good, start, end), bad


def extract_tag(html, tag: str) -> Column:
    """Raw inner text of the first ``<tag>`` element; '' when absent (C1, native)."""
    c = F.col(html) if isinstance(html, str) else html
    return F.regexp_extract(c, f"(?s)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>", 1)


# the value with its quotes, if it has any
HREF_PATTERN = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def _unquoted(c: Column) -> Column:
    return F.regexp_replace(c, """^["']|["']$""", "")


def extract_links(pages: DataFrame, base: str | None = None, pattern: str = HREF_PATTERN,
                  time_pattern: str | None = None, row_pattern: str | None = None) -> DataFrame:
    """List page -> one row per link, in page order (C11).

    With ``time_pattern`` each link carries a time: the one of its own list row if
    ``row_pattern`` matches the rows, else the n-th time found on the page. A row
    without a link is left out; one without a time has an empty time."""
    if row_pattern:
        rows = F.transform(F.regexp_extract_all("html", F.lit(row_pattern), 0), lambda r: F.struct(
            _unquoted(F.regexp_extract(r, pattern, 1)).alias("link"),
            (F.regexp_extract(r, time_pattern, 1) if time_pattern else F.lit("")).alias("time_text")))
        rows = F.filter(rows, lambda r: r["link"] != "")
        out = pages.select("page_id", F.posexplode(rows).alias("pos", "p")).select(
            "page_id", "pos", "p.link", *(["p.time_text"] if time_pattern else []))
        return out.withColumn("link", absolute_link("link", base)) if base else out
    links = F.transform(F.regexp_extract_all(F.col("html"), F.lit(pattern), 1), _unquoted)
    if time_pattern:
        times = F.regexp_extract_all(F.col("html"), F.lit(time_pattern), 1)
        pairs = F.arrays_zip(links.alias("link"), times.alias("time_text"))
        out = pages.select("page_id", F.posexplode(pairs).alias("pos", "p")).select(
            "page_id", "pos", "p.link", "p.time_text")
    else:
        out = pages.select("page_id", F.posexplode(links).alias("pos", "link"))
    if base:
        out = out.withColumn("link", absolute_link("link", base))
    return out


def explode_search(df: DataFrame, schema: str, path: list[str], col: str = "response",
                   pattern: str = JSONP_PATTERN) -> DataFrame:
    """Search response (JSON, or JSONP with the wrapper stripped) -> one row per
    hit (C10). A malformed response yields no rows."""
    parsed = F.from_json(F.regexp_replace(F.col(col), pattern, ""), schema)
    hits = parsed
    for p in path:
        hits = hits[p]
    return df.select("*", F.explode(hits).alias("hit"))


def drop_failed(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every required field, rejected rows)."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return df.filter(ok), df.filter(~ok)
