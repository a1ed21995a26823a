"""Personal data: patterns propose spans, checksums confirm them, context adjusts scores.

Everything is a built-in DataFrame expression. For each kind the pattern's matches and
the gaps between them (``regexp_extract_all`` and ``split`` with the same pattern) give
the offsets in code points as running sums of lengths; texts without a match skip the
rest. Validators drop matches: at most 255 per part of an address, 12 to 19 digits
passing Luhn for a card, 9 to 15 digits for a phone number, mod-97 for an account number.
A dropped match is not tried again at other lengths.

Every span has a score: the kind's own, plus a bonus for a passed checksum, plus a bonus
for a context word within ``CONTEXT`` characters on either side, capped at 1. The four
base kinds (email, ip, card, phone) always stay; added kinds (iban, ssn, secret) stay
with a score of ``MIN_SCORE`` or more.

The patterns are written so that they neither backtrack nor recurse: possessive
quantifiers, and a start that is the previous match's end or the beginning of a run, so
a run of any length is read once. They match exactly what the plain patterns match.

Running sums go in chunks of ``CHUNK`` (sums inside a chunk, then over chunk totals), so
a text with very many matches costs little more than linear time.

Defined results: null text is the empty text for ``find`` and stays null in ``redact``;
spans are ordered by start, then kind as listed, and overlapping spans of different kinds
are all reported and become one redaction named by the first; repeated rows give repeated
results; an empty table gives no rows; extra columns are passed through and never clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fenced, fresh

CONTEXT = 40
CHUNK = 64
MIN_SCORE = 0.5

_LOCAL = r"[A-Za-z0-9._%+-]"
# kind: pattern, own score, bonus of a passed checksum, context words
KINDS = {
    "email": (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.8, 0.0,
              "mail|contact|kontakt|correo|courriel"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.5, 0.0, "ip|address|host|server|login"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", 0.4, 0.4, "card|visa|master|credit|karte|carte|tarjeta|pay"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, 0.0, "phone|call|tel|mobile|fax|cell"),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
             0.3, 0.5, "iban|bank|account|konto|compte|cuenta"),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.3, 0.0, "ssn|social|security|tax|insurance"),
    "secret": (r"""[=:]\x20?["']?[A-Za-z0-9+/_-]{16,}+""", 0.3, 0.0, "token|secret|password|passwd|api|key|auth"),
}
BASE_KINDS = ["email", "ip", "card", "phone"]
CONTEXT_BONUS = 0.2
# what a text must contain for the pattern to be tried at all
NEEDS = {"email": "@", "phone": "+", "ssn": "-"}

_SPAN = "array<struct<start:bigint,rank:int,end:bigint,score:double>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _mod97(m: Column) -> Column:
    """The remainder that account numbers must have as 1: letters count 10 to 35."""
    plain = F.regexp_replace(m, " ", "")
    turned = F.concat(F.substring(plain, 5, 1 << 20), F.substring(plain, 1, 4))
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(
        (a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97))


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return F.length(_digits(m)).between(12, 19) & F.call_function("luhn_check", _digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        return _mod97(m) == 1
    return F.lit(True)


def _running(d: DataFrame, col: str, out: str) -> DataFrame:
    """``out``: for each element of the array ``col`` of bigint, the sum of those before."""
    empty = F.array().cast("array<bigint>")
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x)

    def sums(a: Column, begin: Column, step) -> Column:
        return F.aggregate(a, F.struct(begin.alias("s"), empty.alias("a")),
                           lambda acc, x: F.struct((acc["s"] + step(x)).alias("s"),
                                                   F.concat(acc["a"], F.array(acc["s"])).alias("a")),
                           lambda acc: acc["a"])

    d = d.withColumn("_c", F.when(F.size(col) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(col) - 1) / CHUNK).cast("int")),
        lambda c: F.slice(col, c * CHUNK + 1, CHUNK))))
    bases = sums(F.col("_c"), F.lit(0).cast("bigint"), total)
    return d.withColumn(out, F.flatten(F.zip_with("_c", bases, lambda a, b: sums(a, b, lambda x: x)))).drop("_c")


def _spans(d: DataFrame, kind: str, rank: int) -> DataFrame:
    """Column ``_s<rank>``: the confirmed spans of a kind, null if there is none."""
    pattern, own, checksum, context = KINDS[kind]
    found = F.regexp_extract_all("_t", F.lit(pattern), F.lit(0))
    if kind in NEEDS:
        found = F.when(F.contains("_t", F.lit(NEEDS[kind])), found)
    d = d.withColumn("_m", found)
    d = d.withColumn("_g", F.when(F.size("_m") > 0, F.split("_t", pattern, -1)))
    d = d.withColumn("_len", F.when(F.size("_m") > 0, F.zip_with(
        F.slice("_g", F.lit(1), F.size("_m")), "_m", lambda g, m: (F.length(g) + F.length(m)).cast("bigint"))))
    d = _running(d, "_len", "_at").drop("_len")
    # match, the text before and after it, and its begin without the gap before
    around = F.zip_with(
        F.arrays_zip(F.col("_m").alias("m"), F.col("_at").alias("at"),
                     F.slice("_g", F.lit(1), F.size("_m")).alias("g")),
        F.slice("_g", F.lit(2), F.size("_m")),
        lambda x, after: F.struct(
            x["m"].alias("m"), (x["at"] + F.length(x["g"])).alias("start"),
            F.lower(F.concat(F.right(x["g"], F.lit(CONTEXT)), F.lit(" "), F.left(after, F.lit(CONTEXT)))).alias("near")))
    d = d.withColumn("_x", F.when(F.size("_m") > 0, F.filter(around, lambda x: _valid(kind, x["m"]))))

    def span(x: Column) -> Column:
        score = F.least(F.lit(1.0), F.lit(own + checksum)
                        + F.when(x["near"].rlike(rf"\b(?:{context})"), F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0)))
        return F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"),
                        (x["start"] + F.length(x["m"])).cast("bigint").alias("end"), score.alias("score"))

    spans = F.transform("_x", span)
    if kind not in BASE_KINDS:
        spans = F.filter(spans, lambda s: s["score"] >= MIN_SCORE)
    return d.withColumn(f"_s{rank}", spans.cast(_SPAN)).drop("_m", "_g", "_at", "_x")


def _name(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), rank + 1)


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``spans`` added (underscores before it if it is taken): an
    array of (kind, start, end, score) by start, then kind as listed; offsets are code
    points, the end exclusive."""
    name = fresh(docs, "spans")
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    d = d.withColumn("_t", F.coalesce(F.col("row")[text_col], F.lit("")))
    for rank, kind in enumerate(KINDS):
        d = _spans(d, kind, rank)
    none = F.array().cast(_SPAN)
    every = reduce(F.concat, [F.coalesce(f"_s{r}", none) for r in range(len(KINDS))])
    named = F.transform(F.sort_array(every), lambda s: F.struct(
        _name(s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")))
    return d.withColumn("_out", fenced(named)).select("row.*", F.col("_out").alias(name))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def spans_text(spans: Column, base_only: bool = False) -> Column:
    """kind:start:end of the spans, comma-joined."""
    if base_only:
        spans = F.filter(spans, lambda s: s["kind"].isin(BASE_KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in the text replaced by its kind in brackets."""
    found = find(docs, text_col)
    spans = found.columns[-1]
    # overlapping spans become one: done so far, and the span that may still grow
    one = "struct<s:bigint,e:bigint,k:string>"

    def step(acc: Column, x: Column) -> Column:
        new = F.struct(x["start"].alias("s"), x["end"].alias("e"), x["kind"].alias("k"))
        grown = F.struct(acc["last"]["s"].alias("s"), F.greatest(acc["last"]["e"], x["end"]).alias("e"),
                         acc["last"]["k"].alias("k"))
        overlaps = acc["last"].isNotNull() & (x["start"] < acc["last"]["e"])
        return F.struct(
            F.when(overlaps | acc["last"].isNull(), acc["done"]).otherwise(
                F.concat(acc["done"], F.array(acc["last"]))).alias("done"),
            F.when(overlaps, grown).otherwise(new).cast(one).alias("last"))

    merged = F.aggregate(
        spans, F.struct(F.array().cast(f"array<{one}>").alias("done"), F.lit(None).cast(one).alias("last")),
        step, lambda acc: F.concat(acc["done"], F.array(acc["last"])))
    cut = fresh(found, "_cut")
    d = found.withColumn(cut, F.when(F.size(spans) > 0, merged))
    text, long = F.col(f"`{text_col}`"), lambda n: F.lit(n).cast("bigint")
    pieces = F.zip_with(
        cut, F.concat(F.array(long(0)), F.transform(cut, lambda x: x["e"])),
        lambda x, before: F.when(x.isNotNull(), F.concat(
            F.substring(text, (before + 1).cast("int"), (x["s"] - before).cast("int")), F.lit("["), F.upper(x["k"]), F.lit("]")))
        .otherwise(F.substring(text, (before + 1).cast("int"), F.length(text))))
    d = d.withColumn(text_col, fenced(F.when(F.col(cut).isNull(), text).otherwise(F.array_join(pieces, ""))))
    return d.select(*[F.col(f"`{c}`") for c in docs.columns])
