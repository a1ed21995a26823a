"""Substring dedup by hashing units of text.

A unit is a paragraph, a line or (by default) a part of a sentence. A sentence is a part of
a line that ends behind ``.``, ``!`` or ``?`` and white space; it is cut behind a word where
a hash of that word and the two before it is less than those at the ``REACH`` words on
either side (about every seven words, never closer than four). Such cuts depend on a few
words alone, so a passage that begins or ends inside longer sentences has the same units
inside as its copy, whatever surrounds them. Units are normalised (lower case, words only,
one blank between) and hashed to 128 bits; units without a word are skipped. Digests are
grouped over the whole corpus; the occurrence that ranks first (smallest id, then
hash of the text, then offset) is kept and the others are repeats.

A repeated unit alone may be chance (a common short sentence), so neighbouring repeats of
a document form runs, and a run is removed when it has at least ``min_words`` words. Runs
keep their original offsets (code points, the end exclusive).

Only digests and offsets are shuffled, never text. Grouping combines in the tasks first,
so a unit that every document has is one row per task; joining the repeats back to their
places is a plain join on the digest that adaptive execution splits where one is hot.

Defined results: null text has no units; occurrences of one text at one id and offset
(repeated rows) are the same occurrence, so none of them is a repeat of the others; different
texts that share an id (null included) are told apart and rank by their hash; a null id
ranks first; a document's later copy of its own unit is a repeat too; an empty table
gives no rows; extra columns are passed through by ``remove`` and never clash.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Memo, fresh, saved, text_of

UNITS = {
    "line": re.compile(r"[^\n]+"),
    "paragraph": re.compile(r"(?:[^\n]|\n(?![^\S\n]*(?:\n|$)))+"),
}
_WORD = re.compile(r"\w+")
REACH = 3

UNIT_SCHEMA = "doc_id bigint, tid bigint, no int, start bigint, end bigint, words int, a bigint, b bigint"


def units(text: str, unit: str = "sentence") -> list[tuple[int, int, int, str]]:
    """Start, end, number of words and normalised text of each unit that has words."""
    _, table, norms = unit_arrays([text], unit)
    return [(*row, norm.decode()) for row, norm in zip(table.tolist(), norms, strict=True)]


def unit_arrays(texts: list[str], unit: str = "sentence") -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The units of some texts, each text's in order: the number of the text, then start, end
    and number of words, and the normalised text."""
    slow, out = range(len(texts)), []
    if unit == "sentence":
        # lower case moves the offsets, or goes by what stands around a word
        slow = [i for i, t in enumerate(texts) if "\u0130" in t or "\u03a3" in t]
        out.append(_sentence_parts(["" if i in set(slow) else t for i, t in enumerate(texts)] if slow else texts))
    for i in slow:
        found = list(_units_of(texts[i], unit))
        out.append((np.full(len(found), i), np.array([x[:3] for x in found], np.int64).reshape(-1, 3),
                    [x[3].encode("utf-8", "replace") for x in found]))
    places, tables, norms = zip(*out, strict=True) if out else ([np.zeros(0, np.int64)], [np.zeros((0, 3), np.int64)], [])
    return np.concatenate(places), np.concatenate(tables), [x for part in norms for x in part]


def _units_of(text: str, unit: str):
    if unit == "sentence":
        for begin, end in _sentences(text):
            yield from _parts(text, begin, end)
        return
    for begin, end in (m.span() for m in UNITS[unit].finditer(text)):
        words = _WORD.findall(text[begin:end].lower())
        if words:
            yield begin, end, len(words), " ".join(words)


_word_hash = Memo(lambda word: zlib.crc32(word.encode("utf-8", "replace")))


def _parts(text: str, begin: int, end: int):
    """The units of a sentence; blanks between two of them belong to the later one."""
    # found before lowering, which may change lengths
    words = [w.lower() for w in _WORD.findall(text, begin, end)]
    h = [_word_hash[w] for w in words]
    v = [((5 * x + 7 * y + z) * 2654435761) & 0xFFFFFFFF for x, y, z in zip(h, h[1:], h[2:])]
    # v[i] is of the words i to i + 2; equal neighbours (one word again and again) are no cut
    cuts = [i + 2 for i in range(REACH, len(v) - REACH)
            if v[i] < min(v[i - REACH:i]) and v[i] < min(v[i + 1:i + 1 + REACH])]
    at = 0
    if cuts:
        ends = [m.end() for m in _WORD.finditer(text, begin, end)]
        for i in cuts:
            yield begin, ends[i], i + 1 - at, " ".join(words[at:i + 1])
            begin, at = ends[i], i + 1
    if words:
        yield begin, end, len(words) - at, " ".join(words[at:])


_STOP = re.compile(r"[.!?]+(?=\s|$)|\n")


def _sentences(text: str):
    at = 0
    for stop in _STOP.finditer(text):
        end = stop.start() if stop[0] == "\n" else stop.end()
        if end > at:
            yield at, end
        at = stop.end()
    if at < len(text):
        yield at, len(text)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Of each code point: 1 if it is part of a word, 2 if white space, 4 if a stop, as the
    patterns have it."""
    chars = [chr(i) for i in range(0x110000)]
    out = np.zeros(len(chars), np.uint8)
    out[[i for i, c in enumerate(chars) if c == "_" or c.isalnum()]] = 1
    out[[i for i, c in enumerate(chars) if c.isspace()]] = 2
    out[[ord(c) for c in ".!?"]] = 4
    return out


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> 1 ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC, _CRC_WORD = _crc_table(), 32


def word_crcs(raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of the words at ``begin``, a byte of every word at a time; of long words by zlib."""
    crc = np.full(len(begin), 0xFFFFFFFF, np.uint32)
    mine = np.flatnonzero(size <= _CRC_WORD)
    for k in range(_CRC_WORD):
        mine = mine[size[mine] > k]
        if not len(mine):
            break
        c = crc[mine]
        crc[mine] = _CRC[(c ^ raw[begin[mine] + k]) & np.uint32(255)] ^ c >> np.uint32(8)
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > _CRC_WORD):
        crc[i] = zlib.crc32(raw[begin[i]:begin[i] + size[i]].tobytes())
    return crc


def _sentence_parts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """What ``_sentences`` and ``_parts`` give, by arrays over all texts. A text ends as a line
    does. Lower case must keep every character's place."""
    text = "\n".join(texts)
    low = text.lower()
    starts = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
    if text.isascii():
        chars = np.frombuffer(text.encode(), np.uint8)
        kind = _classes()[chars]
        size = None
    else:
        chars = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        kind = _classes()[chars]
        spelled = np.frombuffer(low.encode("utf-32-le", "replace"), np.uint32)
        size = 1 + (spelled >= 0x80).astype(np.int8) + (spelled >= 0x800) + (spelled >= 0x10000)
    inside = np.zeros(len(chars) + 2, np.int8)
    inside[1:-1] = kind == 1
    edge = np.diff(inside)
    word_begin, word_end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    n = len(word_begin)
    if not n:
        return np.zeros(0, np.int64), np.zeros((0, 3), np.int64), []

    # the words in lower case with one blank behind each
    raw = np.frombuffer(low.encode("utf-8", "replace") + b" ", np.uint8).copy()
    if size is None:
        keep, begin, end = inside[1:] == 1, word_begin, word_end
    else:
        keep = np.append(np.repeat(kind == 1, size), False)
        at = np.append(0, np.cumsum(size, dtype=np.int64))
        begin, end = at[word_begin], at[word_end]
    raw[end], keep[end] = 32, True
    raw = raw[keep]
    at = np.append(0, np.cumsum(end - begin + 1))

    # a sentence ends behind a stop before white space or the text's end, or at a line break
    stop = np.flatnonzero(kind == 4)
    stop = stop[np.append(kind, 2)[stop + 1] == 2] + 1
    line = np.flatnonzero(chars == 10)
    ends = np.concatenate([stop, line, [len(chars)]])
    order = np.argsort(ends, kind="stable")
    ends = ends[order]
    begins = np.append(0, np.concatenate([stop, line + 1])[order[:-1]])
    sentence = np.searchsorted(begins, word_begin, "right") - 1

    first = np.ones(n, bool)
    first[1:] = sentence[1:] != sentence[:-1]
    cuts = np.zeros(0, np.int64)
    if n >= 2 * REACH + 3:
        h = word_crcs(raw, at[:-1], end - begin).astype(np.uint64)
        # v[i] is of the words i to i + 2; equal neighbours (one word again and again) are no cut
        v = (5 * h[:-2] + 7 * h[1:-1] + h[2:]) * np.uint64(2654435761) & np.uint64(0xFFFFFFFF)
        m = len(v) - 2 * REACH
        mine = v[REACH:REACH + m]
        least = sentence[:m] == sentence[2 * REACH + 2:]  # all words looked at are of one sentence
        for k in range(1, REACH + 1):
            least &= (mine < v[REACH - k:REACH - k + m]) & (mine < v[REACH + k:REACH + k + m])
        cuts = np.flatnonzero(least) + REACH + 2

    # a unit ends with a cut's word, or with its sentence
    last = np.append(first[1:], True)
    begin_at, end_at = begins[sentence], ends[sentence]
    first[cuts + 1], last[cuts] = True, True
    begin_at[cuts + 1], end_at[cuts] = word_end[cuts], word_end[cuts]
    a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
    place = np.searchsorted(starts, word_begin[a], "right") - 1
    table = np.stack([begin_at[a] - starts[place], end_at[b - 1] - starts[place], b - a], axis=1)
    spelt = raw.tobytes()
    return place, table, [spelt[x:y] for x, y in zip(at[a].tolist(), (at[b] - 1).tolist(), strict=True)]


def unit_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               unit: str = "sentence") -> DataFrame:
    """One row per unit: id, hash of the text, number, offsets, words, digest (a, b)."""
    def run(batches):
        from xxhash import xxh3_128_digest

        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                place, table, norms = unit_arrays(batch.column(2).to_pylist(), unit)
                digests = [xxh3_128_digest(x) for x in norms]
                # units of a text stand together
                edge = np.flatnonzero(np.diff(place, prepend=-1))
                number = np.arange(len(place)) - np.repeat(edge, np.diff(edge, append=len(place)))
                place = pa.array(place)
                digest = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(place), batch.column(1).take(place),
                     pa.array(number.astype(np.int32)), pa.array(table[:, 0]), pa.array(table[:, 1]),
                     pa.array(table[:, 2].astype(np.int32)), pa.array(digest[:, 0]), pa.array(digest[:, 1])],
                    names=[x.split(" ")[0] for x in UNIT_SCHEMA.split(", ")])

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("tid"),
                       text_of(text_col).alias("text"))
    return slim.mapInArrow(run, UNIT_SCHEMA)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence",
            min_words: int = 25) -> DataFrame:
    """The runs to remove: doc_id, ``text_hash``, start, end, n_units, n_words and
    ``first_doc_id``, the smallest id that keeps one of the run's units."""
    table = unit_table(docs, id_col, text_col, unit)
    rank = F.struct(*[F.col(c).alias(c) for c in ("doc_id", "tid", "start")])
    # written, so that both sides of the join below are plain exchanges: adaptive execution
    # can then split a digest that many documents have, and broadcast a short list
    first = saved(table.groupBy("a", "b").agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
                  .filter(~F.col("first").eqNullSafe(F.col("last"))).select("a", "b", "first"), "unit-first")
    again = (table.join(first, ["a", "b"]).filter(~rank.eqNullSafe(F.col("first")))
             .select("doc_id", "tid", "no", "start", "end", "words", F.col("first.doc_id").alias("first_doc_id"))
             .distinct())
    # neighbouring numbers form a run; a document's units are bounded by its own length
    of_doc = Window.partitionBy("doc_id", "tid").orderBy("no")
    runs = (again.withColumn("run", F.col("no") - F.row_number().over(of_doc))
            .groupBy("doc_id", "tid", "run")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_units"),
                 F.sum("words").alias("n_words"), F.min("first_doc_id").alias("first_doc_id")))
    return (runs.filter(F.col("n_words") >= min_words)
            .select("doc_id", F.col("tid").alias("text_hash"), "start", "end", "n_units", "n_words", "first_doc_id"))


def remove(docs: DataFrame, runs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the runs' characters."""
    cuts = runs.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    row = row.withColumn("id", F.col("row")[id_col].cast("bigint")).withColumn(
        "hash", F.xxhash64(F.coalesce(F.col("row")[text_col], F.lit(""))))
    joined = row.join(cuts, row["id"].eqNullSafe(cuts["doc_id"]) & (row["hash"] == cuts["text_hash"]), "left")
    long = F.lit(0).cast("bigint")
    text = F.col("row")[text_col]
    kept = F.zip_with(
        "cuts", F.concat(F.array(long), F.transform("cuts", lambda x: x["end"])),
        lambda x, before: F.when(x.isNotNull(), F.substring(
            text, (before + 1).cast("int"), (x["start"] - before).cast("int")))
        .otherwise(F.substring(text, (before + 1).cast("int"), F.length(text))))
    cleaned = fresh(docs, "cleaned")
    joined = joined.withColumn("_out", F.when(F.col("cuts").isNull(), text).otherwise(F.array_join(kept, "")))
    out = joined.select("row.*", F.col("_out").alias(cleaned))
    return out.select(*[F.col(cleaned).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
