"""Quality rules: base measures of each text, then cross-document line frequency.

Everything is a built-in DataFrame expression. Steps that use an array twice are
columns of their own, so the optimiser computes them once.

Base. Words are ``[^\\x20\\x09-\\x0D]+``; a document fails with fewer than ``min_words``
words, or when words in 8-word windows found twice or more in the text exceed
``max_repeat`` percent. Windows are compared by a 64-bit hash of their word hashes.

Method. Lines are normalised (lower case, numbers to 0, white space runs to one blank),
hashed to 128 bits, and counted per host over distinct documents; exact copies of a text
are one document there. A line is removed from a host's documents when at least
``min_docs`` of the host's distinct documents have it, however many documents the host
has; the host's first document with the line (smallest id) keeps it, so content that only
copies share stays in the corpus once. A document is rejected as depleted when lines were
removed and less than the share ``min_left`` of its words remains.

Counts are aggregated before they are shuffled by line, so a line that every document
has is one row per task. The removed lines have no bound per host, so they stay rows:
written to the shared folder and joined to the documents' lines by host and digest, which
the planner broadcasts when they are few and splits where one line is hot. What is joined
back to the documents is one row per document that loses lines, with their numbers; the
text is rebuilt from the other lines.

Defined results: null text has no words and fails; null hosts form one host; a null id
sorts last among a host's documents; rows that share an id are separate rows of the
result, and all of them keep the lines that their id keeps; an empty table gives no rows. Extra columns are passed through by
``reject`` and never clash with the working columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fenced, fresh, saved

SPACE = r"[\x20\x09-\x0D]"
WORDS = r"[^\x20\x09-\x0D]+"
WINDOW = 8

RULES = {"min_words": 20, "max_repeat": 30, "min_docs": 20, "min_left": 0.5}


def _shift(a: str, by: int) -> Column:
    return F.slice(a, F.lit(by + 1), F.greatest(F.size(a) - by, F.lit(0)))


def _paired(a: str, by: int) -> Column:
    """Hashes of element i with element i + by."""
    n = F.greatest(F.size(a) - by, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), _shift(a, by), lambda x, y: F.xxhash64(x, y))


def base_measures(docs: DataFrame, text: Column, min_words: int, max_repeat: int) -> DataFrame:
    """``docs`` with a struct column ``base`` added (see the module's text)."""
    d = docs.withColumn("_t", F.coalesce(text, F.lit("")))
    d = d.withColumn("_h1", F.transform(F.regexp_extract_all("_t", F.lit(WORDS), F.lit(0)), lambda w: F.xxhash64(w)))
    d = d.withColumn("_lines", F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    # doubling: hashes of 2, 4 and 8 words from every place
    d = d.withColumn("_n", F.size("_h1")).withColumn("_h2", _paired("_h1", 1)).drop("_h1")
    d = d.withColumn("_h4", _paired("_h2", 2)).drop("_h2")
    d = d.withColumn("_h8", _paired("_h4", 4)).drop("_h4")
    d = d.withColumn("_twice", F.size(F.array_distinct("_h8")) < F.size("_h8"))
    # windows sorted by hash; the places of those that equal a neighbour, in order
    d = d.withColumn("_s", F.when(F.col("_twice"), F.sort_array(
        F.transform("_h8", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("_h8")
    d = d.withColumn("_e", F.when(F.col("_twice"), F.zip_with(
        F.slice("_s", F.lit(1), F.size("_s") - 1), _shift("_s", 1), lambda x, y: x["h"] == y["h"])))
    no = F.array(F.lit(False))
    d = d.withColumn("_f", F.when(F.col("_twice"), F.zip_with(
        F.concat(no, F.col("_e")), F.concat(F.col("_e"), no), lambda x, y: x | y)))
    d = d.withColumn("_p", F.when(F.col("_twice"), F.sort_array(F.filter(
        F.zip_with("_s", "_f", lambda s, f: F.when(f, s["i"])), lambda i: i.isNotNull())))).drop("_s", "_e", "_f")
    covered = F.aggregate(
        F.zip_with(F.slice("_p", F.lit(1), F.size("_p") - 1), _shift("_p", 1),
                   lambda x, y: F.least(F.lit(WINDOW), y - x)), F.lit(WINDOW), lambda a, x: a + x)
    d = d.withColumn("_r", F.when(F.col("_twice"), covered).otherwise(F.lit(0)))
    long = lambda c: c.cast("bigint")
    return d.withColumn("base", F.struct(
        long(F.col("_n")).alias("n_words"),
        long(F.length(F.regexp_replace("_t", SPACE + "+", ""))).alias("word_chars"),
        long(F.regexp_count("_t", F.lit(r"[#*$%&|<>]"))).alias("n_symbols"),
        long(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        long(F.col("_r")).alias("n_repeat_words"),
        ((F.col("_n") < min_words) | (F.col("_r") * 100 > F.col("_n") * max_repeat)).alias("base_failed"),
    )).drop("_t", "_n", "_lines", "_twice", "_p", "_r")


def line_digests(text: Column) -> Column:
    """For each line with a word: its number among all lines, two 64-bit hashes of the
    normalised line, its words."""
    flat = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09\x0B-\x0D]+", " ")
    flat = F.regexp_replace(flat, "[0-9]+", "0")
    lines = F.transform(F.split(flat, "\n", -1), lambda x: F.trim(x))
    numbered = F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("no")))
    return F.transform(F.filter(numbered, lambda l: l["x"] != ""), lambda l: F.struct(
        l["no"].alias("no"), F.xxhash64(l["x"]).alias("a"), F.xxhash64(F.lit("b"), l["x"]).alias("b"),
        F.size(F.split(l["x"], " ")).alias("words")))


def line_rows(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One row per line that has a word: host, id, hash of the text, number, digest, words."""
    each = docs.select(F.col(host_col).alias("host"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("doc"),
                       line_digests(F.col(text_col)).alias("lines"))
    return each.select("host", "id", "doc", F.explode("lines").alias("l")).select("host", "id", "doc", "l.*")


def frequent_lines(rows: DataFrame, min_docs: int) -> DataFrame:
    """The removed lines: host, digest and the id of the document that keeps the line."""
    # first by document (copies fall together), then by line: both steps combine in the tasks first
    per_doc = rows.groupBy("host", "a", "b", "doc").agg(F.min("id").alias("id"))
    lines = per_doc.groupBy("host", "a", "b").agg(F.count("*").alias("n"), F.min("id").alias("id"))
    return saved(lines.filter(F.col("n") >= min_docs).drop("n"), "frequent-lines")


def removed_words(rows: DataFrame, removed: DataFrame) -> DataFrame:
    """For each document that loses lines: host, id, hash of the text, ``gone`` words and the
    ``numbers`` of these lines, which are of one document."""
    r = removed.toDF(*[f"r_{c}" for c in removed.columns])
    hit = rows.join(r, F.col("host").eqNullSafe(F.col("r_host")) & (F.col("a") == F.col("r_a")) & (F.col("b") == F.col("r_b")))
    # distinct: repeated rows are one document here
    hit = hit.filter(~F.col("id").eqNullSafe(F.col("r_id"))).select("host", "id", "doc", "no", "words").distinct()
    return saved(hit.groupBy("host", "id", "doc").agg(
        F.sum("words").alias("gone"), F.collect_list("no").alias("numbers")), "removed-words")


def without_lines(text: Column, numbers: Column) -> Column:
    """The text without the lines of these numbers; the others are as they were."""
    # the lines are bound once, as the one element of an outer array
    return F.transform(F.array(F.split(text, "\n", -1)), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), numbers), lambda i: F.get(lines, i)), "\n"))[0]


def _judged(docs: DataFrame, id_col: str, text_col: str, host_col: str, rules: dict) -> tuple[DataFrame, dict]:
    """The input's columns by place (``at``), ``_out`` (the verdict) and ``numbers`` (of the
    removed lines, or null)."""
    rule = RULES | rules
    rows = line_rows(docs, id_col, text_col, host_col)
    removed = removed_words(rows, frequent_lines(rows, rule["min_docs"]))
    # by place, so that none can clash and those not asked for are not shuffled
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    d = docs.toDF(*at.values())
    d = base_measures(d, F.col(at[text_col]), rule["min_words"], rule["max_repeat"])
    d = d.withColumns({"_host": F.col(at[host_col]), "_id": F.col(at[id_col]), "_doc": F.xxhash64(F.col(at[text_col]))})
    d = d.join(removed, F.col("_host").eqNullSafe(F.col("host")) & F.col("_id").eqNullSafe(F.col("id"))
               & (F.col("_doc") == F.col("doc")), "left")
    d = d.withColumn("_gone", F.coalesce(F.col("gone"), F.lit(0).cast("bigint")))
    left = F.col("base.n_words") - F.col("_gone")
    depleted = (F.col("_gone") > 0) & (left < F.col("base.n_words") * F.lit(rule["min_left"]))
    return d.withColumn("_out", fenced(F.struct(
        "base.*", F.col("_gone").alias("n_removed"), (~F.col("base.base_failed") & ~depleted).alias("kept")))), at


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          **rules) -> DataFrame:
    """``docs`` with a struct column ``quality`` added: the base measures, ``n_removed``
    (words in removed lines) and ``kept``. The name gets underscores if it is taken. Texts
    stay whole; ``reject`` removes the lines."""
    d, at = _judged(docs, id_col, text_col, host_col, rules)
    return d.select(*[F.col(c).alias(old) for old, c in at.items()], F.col("_out").alias(fresh(docs, "quality")))


def reject(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
           **rules) -> DataFrame:
    """The rows of ``docs`` that are kept, with its columns, their texts without the removed
    lines. Other columns (a length, say) stay as they were."""
    d, at = _judged(docs, id_col, text_col, host_col, rules)
    text = F.col(at[text_col])
    cut = F.when(F.col("numbers").isNotNull(), without_lines(text, F.col("numbers"))).otherwise(text)
    return d.filter(F.col("_out")["kept"]).select(
        *[(cut if old == text_col else F.col(c)).alias(old) for old, c in at.items()])
