"""Projection, cleaning and keyword tagging of records."""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text
from .joins import join_small
from .scoring import materialise

KEYS = ["car_model", "accident"]


def project_news(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rename the searched keyword to ``car_model`` and keep four columns."""
    return raw.withColumnRenamed("keyword", "car_model").select(
        "car_model", "title", "content", "link", *keep)


def clean_columns(df: DataFrame, cols=("content",)) -> DataFrame:
    """Apply text cleaning (D1) to each named column. News cleans only content,
    community cleans title and content."""
    for c in cols:
        df = df.withColumn(c, clean_text(c))
    return df


def _dedupe(xs):
    seen, out = set(), []
    for x in xs:
        if x not in seen:
            seen.add(x)
            out.append(x)
    return out


def _per_keyword(keywords: Column, cols, value) -> Column:
    """``value(keyword)`` where any of ``cols`` contains the keyword's text, else NULL, for
    each element of ``keywords``.

    The texts are bound once, as the one element of an outer array. Referred to inside the
    function over the keywords, a computed text (a cleaned one, say) would be computed
    again for every keyword, since the optimiser puts its expression there."""
    row = F.array(F.struct(keywords.alias("keywords"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(cols)]))

    def over(r):
        def one(k):
            text, out = value(k)
            return F.when(reduce(or_, [r[f"t{i}"].contains(text) for i in range(len(cols))]), out)
        return F.transform(r["keywords"], one)

    return F.transform(row, over)[0]


def tag_flat(df: DataFrame, keywords, out: str = "accident", cols=("title", "content")) -> DataFrame:
    """Array holding each keyword found in any of ``cols``, NULL elsewhere (D3).

    The keyword list is de-duplicated first, so one article counts once per
    keyword. The keywords are one literal array and the test is one function over
    it, so the plan has the same size for any number of keywords."""
    kws = F.array(*[F.lit(k) for k in _dedupe(keywords)]).cast("array<string>")
    return df.withColumn(out, _per_keyword(kws, cols, lambda k: (k, k)))


def keyword_pairs(mapping: dict[str, list[str]]) -> Column:
    """A literal array of (accident, keyword)."""
    pairs = [F.struct(F.lit(cat).alias("accident"), F.lit(k).alias("keyword"))
             for cat, subs in mapping.items() for k in subs]
    return F.array(*pairs).cast("array<struct<accident:string,keyword:string>>")


def selected_pairs(keywords: DataFrame) -> Column:
    """Keyword rows as one sorted array value of (accident, keyword): a scalar
    subquery, so nothing is brought to the driver."""
    pair = F.struct("accident", "keyword")
    return keywords.agg(F.sort_array(F.collect_set(pair)).alias("pairs")).scalar()


def tag_mapped(df: DataFrame, mapping: dict[str, list[str]] | Column, out: str = "accident",
               cols=("title", "content")) -> DataFrame:
    """Array of the categories whose sub-keywords occur, de-duplicated per row.

    ``mapping`` is a dict or an array column of (accident, keyword)."""
    pairs = keyword_pairs(mapping) if isinstance(mapping, dict) else mapping
    # a subquery may not stand inside the function, so it is a column of its own
    tagged = df.withColumn("_pairs", pairs)
    found = _per_keyword(F.col("_pairs"), cols, lambda p: (p["keyword"], p["accident"]))
    return tagged.withColumn(out, F.array_distinct(found)).drop("_pairs")


def explode_tags(df: DataFrame, col: str = "accident") -> DataFrame:
    """One row per (record, tag); records without a tag disappear."""
    return df.withColumn(col, F.explode(F.array_compact(F.col(col))))


def with_tags(df: DataFrame, col: str = "accident") -> DataFrame:
    """Records that have at least one tag (exactly those ``explode_tags`` keeps),
    one row each with the whole tag array.

    Written as "the first of the exploded tags", not as a filter on the array:
    Catalyst would push such a filter below the spreading repartition into the
    scan and evaluate the tag expression, i.e. the text work, twice."""
    g = df.select("*", F.posexplode(F.array_compact(F.col(col))).alias("_pos", "_tag"))
    return g.filter(F.col("_pos") == 0).drop("_pos", "_tag")


def select_keywords(keywords: DataFrame, issues: DataFrame) -> DataFrame:
    """Keyword rows whose category has an open issue."""
    return keywords.join(issues.select("accident").distinct(), "accident", "left_semi")


def expand_to_entities(df: DataFrame, issues: DataFrame, require_mention: bool = False,
                       on=("accident",), **join_opts) -> DataFrame:
    """Attach every entity with an open issue in the row's category.

    Left join on the category: a post becomes one row per such entity. The
    category has few distinct values, so a shuffle join on it would put each
    category in one task; the issue side is broadcast after a size check, or
    salted past the bound. ``require_mention`` keeps only entities the post names. ``on``
    may name more columns that an issue must share with the row (its batch period).
    """
    mapping = issues.select(*on, "car_model").distinct()
    out = join_small(df, mapping, list(on), "left", **join_opts)
    if require_mention:
        out = out.filter(F.col("title").contains(F.col("car_model"))
                         | F.col("content").contains(F.col("car_model")))
    return out


def match_entities(df: DataFrame, entities, out: str = "keyword",
                   cols=("title", "content")) -> DataFrame:
    """One row per (article, entity it mentions), like one search per entity.

    The entity list is configuration; the test is a row expression, no join."""
    return explode_tags(tag_flat(df, entities, out=out, cols=cols), out)


# a gram is a number: up to GRAM bytes of UTF-8 text below, their count above
GRAM = 6
_FOLD = 20
_PIECE = 1 << 16


def _keyword_grams(n: int):
    """Arrow function: the different grams of ``n`` bytes of each keyword; a shorter keyword is
    its own gram."""
    def grams(words: pa.Array) -> pa.Array:
        out = []
        for w in words.to_pylist():
            k = min(n, len(w))
            out.append(list({int.from_bytes(w[i:i + k], "little") | k << 8 * GRAM for i in range(len(w) - k + 1)}))
        return pa.array(out, pa.list_(pa.int64()))

    return F.arrow_udf(grams, "array<bigint>")


def _folded(gram):
    """A gram's place among ``1 << _FOLD``: of a Column or of numbers."""
    low = (1 << _FOLD) - 1
    if isinstance(gram, Column):
        a, b = F.shiftrightunsigned(gram, _FOLD), F.shiftrightunsigned(gram, 2 * _FOLD)
        return gram.bitwiseXOR(a).bitwiseXOR(b).bitwiseAND(F.lit(low))
    return (gram ^ gram >> _FOLD ^ gram >> 2 * _FOLD) & low


def _text_grams(known):
    """Arrow function: the different grams of each text whose place is set in ``known``, a
    broadcast list of places per length. Of a number of bytes that no gram has, none is made."""
    def grams(texts: pa.Array) -> pa.Array:
        places, texts = known.value, texts.cast(pa.binary())
        top = max(places, default=0)
        at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
        at = at.astype(np.int64) - at[0]
        rows, found = [], []
        for begin in range(0, len(data), _PIECE):
            piece = data[begin:begin + _PIECE + GRAM - 1].astype(np.int64)
            gram = piece.copy()
            for n in range(1, min(top, len(piece)) + 1):
                if n > 1:
                    gram = gram[:-1] | piece[n - 1:] << 8 * (n - 1)
                if n in places:
                    mine = gram[:_PIECE] | n << 8 * GRAM
                    hit = np.flatnonzero(places[n][_folded(mine)])
                    row = np.searchsorted(at, hit + begin, "right") - 1
                    whole = hit + begin + n <= at[row + 1]
                    rows.append(row[whole])
                    found.append(mine[hit[whole]])
        if not rows:
            return pa.array([[]] * len(texts), pa.list_(pa.int64()))
        row, gram = np.concatenate(rows), np.concatenate(found)
        order = np.lexsort((gram, row))
        row, gram = row[order], gram[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
        ends = np.append(0, np.cumsum(np.bincount(row[new], minlength=len(texts)))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(gram[new]))

    return F.arrow_udf(grams, "array<bigint>")


def keyword_index(keywords: DataFrame, col: str = "keyword", n: int = GRAM) -> DataFrame:
    """``keywords`` with ``_gram``: of each keyword's grams of ``n`` bytes the one that
    the fewest keywords have (a shorter keyword is its own gram). Null and empty keywords
    are left out."""
    words = keywords.filter(F.col(col).isNotNull() & (F.col(col) != ""))
    grams = _keyword_grams(n)(F.col(col).cast("binary"))
    each = words.select(col).distinct().select(col, F.explode(grams).alias("_gram"))
    shared = each.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = each.join(shared, "_gram").groupBy(col).agg(F.min(F.struct("_n", "_gram")).alias("_r"))
    return words.join(rarest.select(col, F.col("_r._gram").alias("_gram")), col)


def match_keyword_table(df: DataFrame, keywords: DataFrame, col: str = "keyword", cols=("title", "content"),
                        **join_opts) -> DataFrame:
    """One row per (record, row of ``keywords``) whose keyword any of ``cols`` contains: D3,
    D5 and C13 for a table of any number of keywords.

    The index has one gram per keyword. Of a text's grams those are taken, by arrays, whose
    place in a table of bits some keyword's gram has (at most ``1 << _FOLD`` places per number
    of bytes, whatever the number of keywords); the join to the index drops what only shares a
    place. Only the keywords that this finds are looked for in the text. So the work per text
    depends on its length and on what it contains, not on the number of keywords. The index
    is broadcast after a check of its size (past it the join is salted); in a broadcast join
    the grams of a text are probed one after another without a copy of the text."""
    spark = df.sparkSession
    index = materialise(keyword_index(keywords, col), "keyword-index")
    length = F.shiftright("_gram", 8 * GRAM).cast("int")
    seen = index.select(length.alias("n"), _folded(F.col("_gram")).cast("int").alias("place")).distinct().toArrow()
    size, place = (seen[c].to_numpy() for c in ("n", "place"))
    known = {}
    for n in np.unique(size).tolist():
        known[n] = np.zeros(1 << _FOLD, bool)
        known[n][place[size == n]] = True
    text = F.concat_ws("\n", *cols).cast("binary")
    probes = df.withColumn("_gram", F.explode(_text_grams(spark.sparkContext.broadcast(known))(text)))
    found = join_small(probes, index, "_gram", "inner", **join_opts)
    return found.filter(reduce(or_, [F.coalesce(F.col(c).contains(F.col(col)), F.lit(False)) for c in cols])).drop("_gram")
