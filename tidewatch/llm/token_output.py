"""Token ids as ORC files.

Documents are range-partitioned by id and sorted inside each partition, so the files
hold the corpus in ascending id order and each file covers its own id range. Rows are
(part, doc_id, start_in_part, n_tokens, ids). ORC stores the integers run-length
encoded in stripes; the row index keeps minimum and maximum per ``row_stride`` rows and
a Bloom filter of the document ids, so a read of some documents skips stripes and row
groups by metadata, and a full read takes the stripes in parallel.

The offset of a document in the whole sequence is its offset in its part plus the
lengths of the parts before; a part's length is one row, so only that list (one row per
file) is summed up, never the documents.

Defined results: null text is the empty text (the end id alone); null ids come first;
rows that share an id are ordered by their text's hash, and rows equal in both are
equal in the output too, up to ``start``; an empty table gives no rows; only the id and
text columns are read, so other columns never clash.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_of, white_chunks
from .word_bpe import WordBpe, byte_letters, symbols, words

ORC_OPTIONS = {
    "orc.compress": "ZSTD",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
}

# text that one step of the encoder lays out as columns
SLICE_BYTES = 4 << 20
# words that the library is asked for at once
ASKED = 1 << 14
# texts with these go by white_chunks
_ODD = r"[\x1c-\x1f]"
# runs that are one word, or one and a stop: Latin letters that Arrow lower-cases as Python does
_LETTERS = r"^[A-Za-zÀ-ÖØ-öø-įı-ſ]+[.,]?$"
_STOPS = (".", ",")


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _lists(ids: list[bytes]) -> pa.LargeListArray:
    """Lists of 32-bit integers of their bytes."""
    ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)])
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<u4")))


class Kept:
    """Ids by short key, in two generations of about ``limit`` keys each.

    ``young`` answers directly; ``missing`` brings keys over from the old generation and
    returns those that nobody knows. ``turn`` ends a group of texts: long keys go, and a
    full young generation becomes the old one, so memory is bounded.
    """

    def __init__(self, limit: int, max_key: int = 64):
        self.limit, self.max_key, self.young, self.old, self.long = limit, max_key, {}, {}, []

    def missing(self, keys: set[str]) -> list[str]:
        out, old, young = [], self.old, self.young
        for key in keys.difference(young):
            value = old.get(key)
            if value is None:
                out.append(key)
            else:
                young[key] = value
        return out

    def add(self, keys: list[str], values: list[bytes]) -> None:
        self.young.update(zip(keys, values, strict=True))
        self.long += [key for key in keys if len(key) > self.max_key]

    def turn(self) -> None:
        for key in self.long:
            self.young.pop(key, None)
        self.long = []
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}


class LibraryEncoder:
    """The tokenizers library's model, asked once for all new words of a group of texts.

    The ids of a text are those of its words, one after the other; words are found as the
    vocabulary's pattern finds them, and special strings are ids of their own. The ids of
    runs (the text between white space) and of words are kept while they are frequent.
    """

    def __init__(self, raw: bytes, limit: int = 200_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        # the model alone: words arrive spelled in its letters, which hold no white space
        self.model = Tokenizer(Tokenizer.from_str(raw.decode()).model)
        self.model.pre_tokenizer = WhitespaceSplit()
        self.bpe = WordBpe(raw)
        self.special = {s: i.to_bytes(4, "little") for s, i in self.bpe.special.items()}
        self.letters = np.array([ord(x) for x in byte_letters()], "<u4")
        self.letters[ord(" ")] = ord(" ")  # in no word
        ends = [i for i, name in zip(self.bpe.ids, self.bpe.names, strict=True) if name.endswith(self.bpe.suffix)]
        self.is_end = np.zeros(max(self.bpe.ids) + 1, bool)
        self.is_end[ends] = True
        # one byte is one symbol, the one at a word's end
        self.stops = [self.bpe.ids[symbols(stop)[0]] for stop in _STOPS]
        self.runs, self.words = Kept(limit), Kept(limit)

    def _spelled(self, words: list[str]) -> str:
        """The words in the vocabulary's letters, one for each byte, with spaces between."""
        raw = np.frombuffer(" ".join(words).encode("utf-8", "replace"), np.uint8)
        return self.letters[raw].tobytes().decode("utf-32-le")

    def _learn_words(self, asked: set[str]) -> None:
        new = self.words.missing(asked)
        if not new:
            return
        for i in range(0, len(new), ASKED):
            part = new[i:i + ASKED]
            # without offsets and word numbers; the last piece of a word, and no other, is an end
            answer, = self.model.encode_batch_fast([self._spelled(part)], add_special_tokens=False)
            pieces = np.array(answer.ids, "<u4")
            ids, at = pieces.tobytes(), [0, *(4 * np.flatnonzero(self.is_end[pieces]) + 4).tolist()]
            self.words.add(part, [ids[a:b] for a, b in zip(at[:-1], at[1:], strict=True)])

    def _learn_runs(self, asked: set[str]) -> None:
        """One list of words per new run; a special string stands for itself."""
        special, cut = self.special, self.bpe.parts_of
        new = self.runs.missing(asked)
        found = [words(run) if "<" not in run else
                 [w for part in cut(run) for w in ([part] if part in special else words(part))]
                 for run in new]
        self._learn_words({w for ws in found for w in ws}.difference(special))
        ids = self.words.young
        self.runs.add(new, [ids[ws[0]] if len(ws) == 1 and ws[0] not in special else
                            b"".join([special[w] if w in special else ids[w] for w in ws])
                            for ws in found])

    def _ids_of_words(self, asked: list[str]) -> list[bytes]:
        known = self.words.young
        ids = list(map(known.get, asked))
        if None in ids:
            self._learn_words({w for w, x in zip(asked, ids, strict=True) if x is None})
            ids = [known[w] if x is None else x for w, x in zip(asked, ids, strict=True)]
        return ids

    def _ids_of_runs(self, asked: list[str]) -> list[bytes]:
        known = self.runs.young
        ids = list(map(known.get, asked))
        if None in ids:
            self._learn_runs({run for run, x in zip(asked, ids, strict=True) if x is None})
            ids = [known[run] if x is None else x for run, x in zip(asked, ids, strict=True)]
        return ids

    def _encode_letters(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of runs of letters, some with a stop, one after the other, and how many each
        run has: those of the word, which many runs share, and of the stop."""
        low = pc.utf8_lower(runs)
        word = pc.utf8_rtrim(low, characters="".join(_STOPS))
        has_stop = np.asarray(pc.not_equal(pc.binary_length(low), pc.binary_length(word)))
        numbered = word.dictionary_encode()
        of_word = _lists(self._ids_of_words(_strings(numbered.dictionary)))
        laid = of_word.take(numbered.indices)
        ends = laid.offsets.to_numpy()[1:]
        stopped = np.asarray(pc.ends_with(low, pattern=_STOPS[0]))[has_stop]
        stop = np.where(stopped, *self.stops).astype("<u4")
        return np.insert(laid.flatten().to_numpy(), ends[has_stop], stop), np.diff(laid.offsets.to_numpy()) + has_stop

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each text has.

        Runs are cut, numbered and laid out as Arrow columns, and so are the words of runs of
        letters; Python handles each different word and each different other run once."""
        if pc.any(pc.match_substring_regex(texts, _ODD)).as_py():
            # separators that Arrow knows but the vocabulary does not
            runs = pa.array([white_chunks(t) for t in texts.to_pylist()], pa.list_(pa.string()))
        else:
            runs = pc.utf8_split_whitespace(texts)
        numbered = runs.flatten().dictionary_encode()
        letters = pc.match_substring_regex(numbered.dictionary, _LETTERS)
        flat, n = self._encode_letters(numbered.dictionary.filter(letters))
        others = self._ids_of_runs(_strings(numbered.dictionary.filter(pc.invert(letters))))
        self.runs.turn()
        self.words.turn()
        rest = _lists(others)
        ends = np.concatenate([[0], np.cumsum(np.concatenate([n, np.diff(rest.offsets.to_numpy())]))])
        of_run = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([flat, rest.values.to_numpy()])))
        # the runs of letters come first there
        first = np.asarray(letters)
        at = np.where(first, np.cumsum(first) - 1, len(n) + np.cumsum(~first) - 1)
        laid = of_run.take(pa.array(at).take(numbered.indices))
        at = laid.offsets.to_numpy()[runs.offsets.to_numpy() - runs.offsets[0].as_py()]
        return laid.flatten().to_numpy(), np.diff(at)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        ids, n = self.encode_column(pa.array(texts, pa.string()))
        at = np.concatenate([[0], np.cumsum(n)])
        return [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]


def slices(batch: pa.RecordBatch, column: int, max_bytes: int):
    """Slices of ``batch`` with about ``max_bytes`` of text each (one row at least)."""
    size = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, before + max_bytes, "right")))
        yield batch.slice(at, to - at)
        at = to


@lru_cache(maxsize=2)
def library_encoder(raw: bytes) -> LibraryEncoder:
    """One encoder per Python worker and vocabulary."""
    import gc
    import os

    # a task has one core
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    # the memo holds many objects and no cycles; the collector need not walk it often
    gc.set_threshold(200_000, 50, 100)
    return LibraryEncoder(raw)


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id",
              text_col: str = "text", parts: int | None = None, stripe_bytes: int = 64 << 20,
              row_stride: int = 1000) -> None:
    """Encode every text, append ``end_id`` and write the ORC files to ``path``.

    ``vocabulary`` names the tokenizers file on the driver. ``parts`` is the number of
    id ranges (the session's shuffle partitions by default).
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(batches):
        encoder, start = library_encoder(shared.value), 0
        for whole in batches:
            for batch in slices(whole, 2, SLICE_BYTES):
                flat, n = encoder.encode_column(batch.column(2))
                ids = np.insert(flat.astype(np.int32), np.cumsum(n), end_id)
                n = n + 1
                offsets = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(start + offsets[:-1]), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))],
                    names=["part", "doc_id", "start_in_part", "n_tokens", "ids"])
                start += int(n.sum())

    slim = docs.select(docs[id_col].cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    n_parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_docs = (slim.repartitionByRange(n_parts, "doc_id")
                   .sortWithinPartitions("doc_id", F.xxhash64("text"))
                   .select(F.spark_partition_id().alias("part"), "doc_id", "text"))
    encoded = sorted_docs.mapInArrow(
        run, "part int, doc_id bigint, start_in_part bigint, n_tokens bigint, ids array<int>")
    (encoded.write.mode("overwrite").options(**ORC_OPTIONS)
     .option("orc.stripe.size", str(stripe_bytes)).option("orc.row.index.stride", str(row_stride))
     .orc(path))


def read_ids(spark: SparkSession, path: str, with_start: bool = True) -> DataFrame:
    """The written rows with ``start``, the number of ids before each document.

    A filter on ``doc_id`` reaches the ORC reader, which prunes by the row index and
    the Bloom filter.
    """
    rows = spark.read.orc(path)
    if not with_start:
        return rows
    # lengths per part come from two small columns; one row per file goes to the window
    size = rows.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = size.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    # one row per file: bounded by the number of files, which the writer set
    joined = rows.join(F.broadcast(base), "part")
    return joined.select("doc_id", (F.col("base") + F.col("start_in_part")).alias("start"),
                         "n_tokens", "ids")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The ids of some documents; stripes that cannot hold them are not read."""
    return read_ids(spark, path, with_start=False).filter(F.col("doc_id").isin(doc_ids))


def id_digests(rows: DataFrame) -> DataFrame:
    """``ids_crc32``: CRC-32 of each document's ids as little-endian 32-bit integers."""
    def run(batches):
        for batch in batches:
            ids = batch.column(3)
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            at = ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
