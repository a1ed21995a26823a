"""Benchmark decontamination by latent semantic retrieval.

Words are lower-cased runs of letters and digits. A passage is ``WINDOW``
consecutive words; documents are read in passages that start every ``STRIDE`` words,
benchmark items in passages that start every ``ITEM_STRIDE`` words (and one that ends with
the item), shorter items whole.

Model. A passage's features are TF-IDF weights of words hashed to ``SIZE`` places; document
frequencies are counted over all documents. A randomised SVD of the corpus's passages
(sketch the Gram operator with a random matrix, orthonormalise, iterate, solve the small
problem) gives ``rank`` latent directions; each round multiplies in the tasks and sums the
sketches in Spark. It is fitted on every passage of at least half the length of every
document, and every passage is then searched. Coordinates are centred and divided by their
singular values.

Search. A passage's latent vector is a sum over its words, so it is a sum of block sums.
Passages whose cosine with an item's passage is at least ``min_cosine`` are candidates.

Verification. The longest common subsequence of words between the item's passage and the
text around the candidate decides: a share of ``copy_share`` is a copy; from
``paraphrase_share`` on it is a paraphrase if at least half of the words of the item's
answer (its ``answer`` column, or else its last sentence) are there too. The text looked at
is narrowed to little more than the passage's length, so common words far apart don't add
up. Items of fewer than ``short_words`` words must be there whole.

Items are searched in blocks of ``ITEM_BLOCK`` against all documents, so what is sent to
the tasks is bounded whatever the benchmark holds.

Defined results: null or empty texts and items match nothing; several items, or one item
several times, in a document give one row per document and item with the best match; an
item id that is null is kept as null; repeated rows give one result for their id in
``matches``, and ``drop_leaks`` judges every row by itself; empty tables give no rows;
extra columns are passed through by ``drop_leaks`` and never clash.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import scratch_path

from .common import text_of

BITS = 13
SIZE = 1 << BITS
WINDOW, STRIDE, ITEM_STRIDE = 32, 16, 8
ITEM_BLOCK = 5_000
BLOCK_WORDS = 1 << 14
# blocks of short texts that are searched together
SEARCHED = BLOCK_WORDS // STRIDE
# words (of 4 bytes) per task of the fit, beside which the task's sums (9.6 MB) are small
FIT_WORDS = 1 << 24

@dataclass
class Settings:
    rank: int = 128
    rounds: int = 2
    min_cosine: float = 0.5
    copy_share: float = 0.8
    paraphrase_share: float = 0.6
    short_words: int = 8


# -- words ----------------------------------------------------------------------------

# a random number for each byte of a word; 0 for what separates words
_rng = np.random.default_rng(7)
_BYTE = _rng.integers(1, 1 << 63, 256, np.uint64)
_IN_WORD = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
_BYTE[~_IN_WORD] = 0
_CHUNK = 1 << 16
_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def _powers(x: int) -> np.ndarray:
    factors = np.full(_CHUNK + 1, x, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


_POWER, _INVERSE = _powers(_P), _powers(pow(_P, -1, 1 << 64))


def _words_of_part(part: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of at most ``_CHUNK`` bytes begin, and their hashes."""
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begin, end = edge[::2], edge[1::2]
    total = np.zeros(len(part) + 1, np.uint64)
    np.cumsum(_BYTE.take(part) * _POWER[:len(part)], out=total[1:])
    h = (total.take(end) - total.take(begin)) * _INVERSE.take(begin)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return begin, (h >> np.uint64(32)).astype(np.int64)


def _bytes_of(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def word_hashes(text: str) -> np.ndarray:
    """The 32-bit hashes of a text's words, in order.

    Words are runs of ASCII letters and digits and of anything beyond ASCII. A word's hash
    is a polynomial over its bytes, read off a running sum, so all words of a chunk are
    hashed by array operations. Chunks end between words; a word longer than a chunk is
    read as several.
    """
    return _hashes_of_bytes(_bytes_of(text))


def _hashes_of_bytes(text: bytes) -> np.ndarray:
    raw, out, at = np.frombuffer(text, np.uint8), [], 0
    while at < len(raw):
        part = raw[at:at + _CHUNK]
        inside = _IN_WORD.take(part)
        if at + len(part) < len(raw):
            gap = np.flatnonzero(~inside[::-1])
            if len(gap):
                part, inside = part[:len(part) - gap[0]], inside[:len(part) - gap[0]]
        at += len(part)
        out.append(_words_of_part(part, inside)[1])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


# short texts are hashed so many bytes at a time
_TOGETHER = 1 << 15


def hashes_of_texts(texts: list[str]) -> list[bytes]:
    """``word_hashes`` of every text as 32-bit integers; short texts are read together, with
    a byte between them that is in no word."""
    out, held, size = [], [], 0

    def together():
        part = np.frombuffer(b"\0".join(held), np.uint8)
        begin, hashes = _words_of_part(part, _IN_WORD.take(part))
        ends = np.cumsum([len(raw) + 1 for raw in held])
        at, hashes = [0, *(4 * np.searchsorted(begin, ends)).tolist()], hashes.astype("<u4").tobytes()
        out.extend(hashes[a:b] for a, b in zip(at[:-1], at[1:], strict=True))
        held.clear()

    for text in texts:
        raw = _bytes_of(text)
        if held and size + len(raw) >= _TOGETHER:
            together()
            size = 0
        if len(raw) >= _TOGETHER:
            out.append(_hashes_of_bytes(raw).astype("<u4").tobytes())
        else:
            held.append(raw)
            size += len(raw) + 1
    if held:
        together()
    return out


def places(hashes: np.ndarray) -> np.ndarray:
    return hashes >> (32 - BITS)


# -- model ----------------------------------------------------------------------------

def written_places(texts: DataFrame) -> DataFrame:
    """The hashes of every text's words, in order, as 32-bit integers, whose upper bits are
    the places; with the texts' ``doc_id``, if there is one. Written once, since every round
    and the search read them. Each task adds a row of its own: the number of its texts that
    hold each place, of all its texts and of their words (``counts``, null for a text)."""
    kept = [c for c in texts.columns if c == "doc_id"]
    names = ["words", *kept, "counts"]

    def run(batches):
        counts, seen = np.zeros(SIZE + 2, np.int64), np.zeros(SIZE, bool)
        for batch in batches:
            hashes = hashes_of_texts(batch.column(0).to_pylist())
            for raw in hashes:
                at = places(np.frombuffer(raw, "<u4"))
                seen[at] = True
                counts[:SIZE] += seen
                seen[at] = False
            counts[SIZE] += len(hashes)
            counts[SIZE + 1] += sum(map(len, hashes)) // 4
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.binary()), *batch.columns[1:],
                                              pa.nulls(len(hashes), pa.binary())], names=names)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.binary()), *[pa.nulls(1, pa.int64()) for _ in kept],
                                          pa.array([counts.tobytes()], pa.binary())], names=names)

    path = scratch_path(texts.sparkSession, "svd-places")
    schema = ", ".join(["words binary", *[f"{c} bigint" for c in kept], "counts binary"])
    # the values are long, so the writer need not try a dictionary of them
    (texts.select("text", *kept).mapInArrow(run, schema)
     .write.option("parquet.enable.dictionary", "false").parquet(path))
    return texts.sparkSession.read.schema(schema).parquet(path)


def of_texts(placed: DataFrame, *columns: str) -> DataFrame:
    """The rows of texts."""
    return placed.filter("counts IS NULL").select(*columns)


def places_of(batches):
    """The places of each text of the batches of ``written_places``."""
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            yield places(np.frombuffer(raw, "<u4")).astype(np.int16)


def counts_of(placed: DataFrame) -> np.ndarray:
    """The number of texts that hold each place, of all texts and of their words."""
    def run(batches):
        total = np.zeros(SIZE + 2, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total += np.frombuffer(raw, np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["place", "n"])

    # one small row for each task that wrote
    counts = placed.filter("counts IS NOT NULL").select("counts").coalesce(placed.sparkSession.sparkContext.defaultParallelism)
    rows = counts.mapInArrow(run, "place bigint, n bigint").groupBy("place").agg(
        F.sum("n").alias("n")).collect()  # at most SIZE + 2 rows
    out = np.zeros(SIZE + 2, np.int64)
    for at, n in rows:
        out[at] = n
    return out


def inverse_frequencies(counts: np.ndarray) -> np.ndarray:
    return np.log((1 + counts[SIZE]) / (1.0 + counts[:SIZE])) + 1


def document_frequencies(placed: DataFrame) -> np.ndarray:
    """Inverse document frequencies by place over all texts."""
    return inverse_frequencies(counts_of(placed))


def for_sums(placed: DataFrame, words: int) -> DataFrame:
    """``placed`` in as many tasks as there are cores, or more if a task has ``FIT_WORDS``: every
    task of the fit writes sums of the same size, so what they take on disk follows the words
    and not the number of the input's partitions. No row is moved."""
    cores = placed.sparkSession.sparkContext.defaultParallelism
    return placed.coalesce(max(1, cores, math.ceil(words / FIT_WORDS)))


def blocks_of(texts) -> tuple[np.ndarray, np.ndarray]:
    """Texts' places in blocks of ``STRIDE``, filled up with ``SIZE``, about ``BLOCK_WORDS``
    at a time, and which blocks begin a passage (a block and the next one, of at least
    half a passage's words).

    The last block of a text, which may be empty, begins none. A long text is cut into
    pieces that share the block between them, so each passage is in one piece."""
    held, starts, size = [], [], 0
    step = BLOCK_WORDS // STRIDE
    for at in texts:
        n = len(at) // STRIDE  # passages
        if not n:
            continue
        words = np.full((n + 1) * STRIDE, SIZE, np.int16)
        words[:len(at)] = at
        words = words.reshape(-1, STRIDE)
        for i in range(0, n, step):
            held.append(words[i:i + step + 1])
            begins = np.ones(len(held[-1]), bool)
            begins[-1] = False
            starts.append(begins)
            size += len(begins)
            if size >= step:
                yield np.concatenate(held), np.concatenate(starts)
                held, starts, size = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(starts)


def block_sums(rows: np.ndarray, words: np.ndarray, step: int = 256) -> np.ndarray:
    """The sum of each block's rows, one word of every block at a time and ``step`` blocks
    together: what is gathered stays near and is added where it lies."""
    out = np.empty((len(words), rows.shape[1]), rows.dtype)
    part = np.empty((min(step, len(words)), rows.shape[1]), rows.dtype)
    for i in range(0, len(words), step):
        mine, sums = words[i:i + step].T, out[i:i + step]
        rows.take(mine[0], axis=0, out=sums, mode="clip")  # with "raise" it is buffered
        for places_ in mine[1:]:
            rows.take(places_, axis=0, out=part[:len(sums)], mode="clip")
            sums += part[:len(sums)]
    return out


# runs of rows of at most so many are summed up by eight partial sums, longer ones in halves
_LEAF = 128


def leaves_of(begin: int, n: int) -> list[tuple[int, int]]:
    """The (first row, number of rows) of the runs that ``n`` rows fall into by halving."""
    if n <= _LEAF:
        return [(begin, n)]
    half = n // 2 // 8 * 8
    return leaves_of(begin, half) + leaves_of(begin + half, n - half)


def sum_of_leaves(sums, n: int) -> np.ndarray:
    """The sum of ``n`` rows from an iterator over the sums of their leaves, half by half."""
    if n <= _LEAF:
        return next(sums)
    half = n // 2 // 8 * 8
    return sum_of_leaves(sums, half) + sum_of_leaves(sums, n - half)


def leaf_sums(y: np.ndarray, block: np.ndarray, begin: np.ndarray, n: np.ndarray, step: int = 128) -> np.ndarray:
    """The sum of the ``n`` (8 to ``_LEAF``) rows of ``y`` that ``block`` names from ``begin`` on,
    for many runs at once: the first, second, ... eight rows of ``step`` runs are added
    together to eight partial sums of each run, then these in pairs, then the rows left over."""
    out = np.empty((len(begin), y.shape[1]), y.dtype)
    by_length = np.argsort(-n, kind="stable")
    for i in range(0, len(n), step):
        mine = by_length[i:i + step]
        first, eights, left = begin[mine], n[mine] // 8, n[mine] % 8
        r = y.take(block[first[:, None] + np.arange(8)], axis=0)
        more = np.empty_like(r)
        for k in range(1, int(eights[0])):
            longer = int(np.searchsorted(-eights, -k, "left"))
            y.take(block[first[:longer, None] + np.arange(8 * k, 8 * k + 8)], axis=0, out=more[:longer], mode="clip")
            r[:longer] += more[:longer]
        r = r[:, ::2] + r[:, 1::2]
        r = r[:, ::2] + r[:, 1::2]
        r = r[:, 0] + r[:, 1]
        for k in range(int(left.max())):
            with_row = np.flatnonzero(left > k)
            r[with_row] += y.take(block[(first + 8 * eights + k)[with_row]], axis=0)
        out[mine] = r
    return out


# up to so many words of a place are added up beside those of other places
_FEW = 8


def add_by_place(total: np.ndarray, words: np.ndarray, y: np.ndarray, step: int = 128) -> None:
    """Add each block's row of ``y`` to the rows of ``total`` of its words' places; the place
    ``SIZE`` is none.

    Rows of frequent places are summed up in halves and by eight partial sums, which keeps more
    digits than one row after the other (the order of ``np.add.reduceat``, whose result it
    gives); of the others the second, third, ... word of ``step`` places is added at once, so
    no place comes twice in one step, and then the first."""
    flat = words.ravel()
    order = np.argsort(flat, kind="stable")
    ranked = flat.take(order)
    edge = np.flatnonzero(np.diff(ranked, prepend=-1))
    at, counts, block = ranked.take(edge), np.diff(edge, append=len(flat)), order // words.shape[1]
    real = at < SIZE
    at, edge, counts = at[real], edge[real], counts[real]
    many = counts > _FEW
    if many.any():
        begin, n = edge[many] + 1, counts[many] - 1
        rest = np.empty((len(n), y.shape[1]), y.dtype)
        whole = n <= _LEAF
        halved = list(zip(begin[~whole].tolist(), n[~whole].tolist(), strict=True))
        leaves = np.array([x for run in halved for x in leaves_of(*run)], np.int64).reshape(-1, 2)
        sums = leaf_sums(y, block, np.append(begin[whole], leaves[:, 0]), np.append(n[whole], leaves[:, 1]))
        at_leaf = iter(sums[whole.sum():])
        rest[whole] = sums[:whole.sum()]
        for k, (_, rows) in zip(np.flatnonzero(~whole).tolist(), halved, strict=True):
            rest[k] = sum_of_leaves(at_leaf, rows)
        rest += y.take(block[begin - 1], axis=0)
        total[at[many]] += rest
    few = np.flatnonzero(~many)
    few = few[np.argsort(-counts[few], kind="stable")]
    for i in range(0, len(few), step):
        mine = few[i:i + step]
        begin, n = edge.take(mine), counts.take(mine)
        sums = y.take(block.take(begin), axis=0)
        rest = np.zeros((int(np.searchsorted(-n, -1, "left")), y.shape[1]), y.dtype)  # of places with more words
        for k in range(1, int(n[0])):
            longer = int(np.searchsorted(-n, -k, "left"))
            rest[:longer] += y.take(block.take(begin[:longer] + k), axis=0)
        sums[:len(rest)] += rest
        total[at.take(mine)] += sums


def add_products(total: np.ndarray, words: np.ndarray, begins: np.ndarray, idf: np.ndarray, weighted: np.ndarray) -> None:
    """Add to ``total`` the passages' share of (A'A) q and of the column sums, both still to be
    multiplied by the words' weights, and the number of passages.

    ``weighted`` is q times the weights; it and ``idf`` have a last row of zeros. What a
    passage has of q is the sum of its two blocks, and what a block gives back is the sum of
    its two passages, so each word is gathered and scattered once."""
    width = weighted.shape[1]
    first = np.flatnonzero(begins)
    pairs = np.sort(np.concatenate([words.take(first, axis=0), words.take(first + 1, axis=0)], axis=1), axis=1)
    new = np.ones(pairs.shape, bool)
    new[:, 1:] = pairs[:, 1:] != pairs[:, :-1]
    run = np.flatnonzero(new.ravel())
    counts = np.diff(run, append=pairs.size)
    square = np.bincount(run // pairs.shape[1], (counts * idf.take(pairs.ravel().take(run))) ** 2, len(first))
    square = np.maximum(square, 1e-18)
    z = block_sums(weighted, words)
    y = np.zeros((len(words), width + 1), np.float32)
    mine = np.empty((len(first), width + 1), np.float32)
    mine[:, :width] = (z.take(first, axis=0) + z.take(first + 1, axis=0)) / square[:, None]
    mine[:, width] = 1 / np.sqrt(square)
    y[first] = mine
    y[first + 1] += mine
    add_by_place(total[:, :width + 1], words, y)
    total[0, width + 1] += len(first)


def gram_times(placed: DataFrame, idf: np.ndarray, q: np.ndarray,
               block: int = 64) -> tuple[np.ndarray, np.ndarray, int]:
    """(A'A) q, the column sums of A and the number of rows of the TF-IDF matrix A, whose
    rows are the passages of all texts, of unit length.

    Each task multiplies its rows; the partial products are summed by blocks of places in
    Spark. ``q`` and the result have a fixed size.
    """
    spark = placed.sparkSession
    width = q.shape[1]
    weights = np.append(idf, 0.0)
    shared = spark.sparkContext.broadcast((weights, np.vstack([idf[:, None] * q, np.zeros((1, width))]).astype(np.float32)))

    def run(batches):
        idf_, weighted = shared.value
        total = np.zeros((SIZE, width + 2), np.float64)
        for words, begins in blocks_of(places_of(batches)):
            add_products(total, words, begins, idf_, weighted)
        total[:, :width + 1] *= idf_[:SIZE, None]
        parts = [total[i:i + block].tobytes() for i in range(0, SIZE, block)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())],
                                         names=["block", "sums"])

    def add(parts):
        total = sum(np.frombuffer(x.as_py()) for x in parts.column("sums"))
        return pa.table({"block": parts.column("block")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    rows = (of_texts(placed, "words").mapInArrow(run, "block int, sums binary")
            .groupBy("block").applyInArrow(add, "block int, sums binary").collect())  # SIZE / block rows
    full = np.concatenate([np.frombuffer(r["sums"]).reshape(-1, width + 2) for r in sorted(rows)])
    return full[:, :width], full[:, width], int(full[0, width + 1])


def fit(placed: DataFrame, settings: Settings | None = None) -> np.ndarray:
    """A latent vector for every place; a passage's vector is the sum over its words."""
    s = settings or Settings()
    counts = counts_of(placed)
    idf = inverse_frequencies(counts)
    placed = for_sums(placed, int(counts[SIZE + 1]))
    q = np.linalg.qr(np.random.default_rng(0).standard_normal((SIZE, s.rank + 16)))[0]
    for i in range(s.rounds):
        product, sums, n = gram_times(placed, idf, q)
        if n == 0:
            return np.zeros((SIZE, s.rank), np.float32)
        if i + 1 < s.rounds:
            q = np.linalg.qr(product)[0]
    # eigenvectors of q'(A'A)q are the right singular vectors in the sketch's basis
    values, vectors = np.linalg.eigh(q.T @ product)
    best = np.argsort(values)[::-1][:s.rank]
    keep = best[values[best] > 1e-6]
    v = (q @ vectors[:, keep]) / np.sqrt(values[keep])
    mean = (sums / n) @ v  # of unit rows
    weighted = idf[:, None] * v
    # rows were scaled to unit length; a passage has WINDOW words of about mean weight
    scale = np.sqrt(WINDOW) * float(idf.mean())
    return (weighted - mean * scale / WINDOW).astype(np.float32)


# -- items ----------------------------------------------------------------------------

@dataclass
class Passage:
    item: int | None
    words: np.ndarray
    answer: frozenset
    masks: dict = field(init=False)

    def __post_init__(self):
        self.masks = {}
        for i, w in enumerate(self.words.tolist()):
            self.masks[w] = self.masks.get(w, 0) | 1 << i


def answer_text(text: str) -> str:
    sentences = [x for x in re.split(r"(?<=[.!?])\s+", text.strip()) if x]
    return sentences[-1] if sentences else ""


def item_passages(item: int | None, text: str | None, answer: str | None = None) -> list[Passage]:
    words = word_hashes(text or "")
    told = frozenset(word_hashes(answer or answer_text(text or "")).tolist())
    if not len(words):
        return []
    starts = sorted({*range(0, max(1, len(words) - WINDOW + 1), ITEM_STRIDE), max(0, len(words) - WINDOW)})
    return [Passage(item, words[i:i + WINDOW], told) for i in starts]


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text"):
    """The items' passages, a bounded number of items at a time."""
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col(id_col).cast("bigint").alias("item"), F.col(text_col).alias("text"),
                            answer.cast("string").alias("answer"))
    block = max(1, math.ceil(rows.count() / ITEM_BLOCK))
    for k in range(block):
        part = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(block)) == k).collect()
        passages = [p for r in sorted(part, key=lambda r: (r["item"] is None, r["item"], r["text"] or ""))
                    for p in item_passages(r["item"], r["text"], r["answer"])]
        if passages:
            yield passages


# -- search ---------------------------------------------------------------------------

def common_length(masks: dict, n: int, words: list[int]) -> int:
    """Length of the longest common subsequence with the passage of ``masks``; a bit of
    ``row`` is 0 where the length grows (bit-parallel dynamic programme)."""
    full = row = (1 << n) - 1
    for w in words:
        m = row & masks.get(w, 0)
        row = (row + m | row - m) & full
    return n - row.bit_count()


class Searcher:
    def __init__(self, vectors: np.ndarray, passages: list[Passage], settings: Settings):
        # the place ``SIZE`` fills up the last block
        self.vectors = np.vstack([vectors, np.zeros((1, vectors.shape[1]), vectors.dtype)])
        self.passages, self.s = passages, settings
        m = np.stack([vectors[places(p.words)].sum(0) for p in passages])
        self.items = np.ascontiguousarray((m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)).T)

    def candidates(self, texts: list[np.ndarray]):
        """(number of the text, first word of the passage, number of the item's passage, cosine),
        in the order of the texts; short texts are searched together."""
        held, blocks = [], 0
        for k, words in enumerate(texts):
            for at in range(0, max(1, len(words)), BLOCK_WORDS) if len(words) else ():
                part = words[at:at + BLOCK_WORDS + WINDOW - STRIDE]
                n = math.ceil(len(part) / STRIDE)
                if held and blocks + n > SEARCHED:
                    yield from self._candidates_of(held)
                    held, blocks = [], 0
                held.append((k, at, part, n))
                blocks += n
        if held:
            yield from self._candidates_of(held)

    def _candidates_of(self, parts: list[tuple[int, int, np.ndarray, int]]):
        n = np.array([x[3] for x in parts])
        ends = np.cumsum(n)
        where = np.full((int(ends[-1]), STRIDE), SIZE)
        flat = where.reshape(-1)
        for (_, _, part, _), begin in zip(parts, (STRIDE * (ends - n)).tolist(), strict=True):
            flat[begin:begin + len(part)] = places(part)
        sums = block_sums(self.vectors, where)
        # a block and the next one; the last of a part begins none, unless it is the only one
        begins = np.ones(len(sums), bool)
        begins[ends - 1] = n == 1
        pair = np.ones(len(sums), bool)
        pair[ends - 1] = False
        first = np.flatnonzero(pair)
        sums[first] += sums[first + 1]
        at = np.flatnonzero(begins)
        sums = sums[at]
        sums /= np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
        cosine = sums @ self.items
        row, item = np.divmod(np.flatnonzero(cosine >= self.s.min_cosine), cosine.shape[1])
        owner = np.searchsorted(ends, at[row], "right")
        offset = STRIDE * (at[row] - (ends - n)[owner])
        for i, o, j, c in zip(owner.tolist(), offset.tolist(), item.tolist(), cosine[row, item].tolist(), strict=True):
            yield parts[i][0], parts[i][1] + o, j, c

    def verify(self, words: np.ndarray, at: int, p: Passage) -> tuple[float, int] | None:
        """The share of the passage found in order, and where; None if it is no match."""
        n, s = len(p.words), self.s
        begin = max(0, at - STRIDE)
        region = words[begin:at + WINDOW + STRIDE].tolist()
        need = n if n < s.short_words else s.paraphrase_share * n
        # words that are there at all, in any order: an upper bound
        there = p.masks.keys() & set(region)
        if sum(p.masks[w].bit_count() for w in there) < need or common_length(p.masks, n, region) < need:
            return None
        # narrowed to a little more than the passage's length
        length = n + n // 4 + 1
        best, where = 0, 0
        for i in range(0, max(1, len(region) - length + 1 + max(1, n // 8)), max(1, n // 8)):
            found = common_length(p.masks, n, region[i:i + length])
            if found > best:
                best, where = found, i
        if best < need:
            return None
        if best < s.copy_share * n:
            there = set(words[begin + where:begin + where + length + STRIDE].tolist())
            if 2 * len(p.answer & there) < len(p.answer):
                return None
        return best / n, begin + where

    def search(self, texts: list[np.ndarray]) -> list[dict]:
        """The best match by item in each text, given by its words' hashes: (share, cosine, first
        word, number of matches)."""
        found_in = [{} for _ in texts]
        for k, at, j, cosine in self.candidates(texts):
            p, out = self.passages[j], found_in[k]
            found = self.verify(texts[k], at, p)
            if found:
                share, where, n = out.get(p.item, (0.0, 0, 0, 0))[0], found[1], out.get(p.item, (0, 0, 0, 0))[3]
                if n == 0 or (found[0], cosine) > (share, out[p.item][1]):
                    out[p.item] = (found[0], cosine, where, n + 1)
                else:
                    out[p.item] = (*out[p.item][:3], n + 1)
        return found_in


def _searcher(shared):
    """One searcher per Python worker and broadcast."""
    key = id(shared.value)
    if _searcher.key != key:
        _searcher.key, _searcher.made = key, Searcher(*shared.value)
    return _searcher.made


_searcher.key = _searcher.made = None

MATCHES = ("doc_id bigint, item_id bigint, lcs_share double, cosine double, word_start bigint, "
           "n_matches bigint, kind string")


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            settings: Settings | None = None) -> DataFrame:
    """One row per document and item found in it."""
    s, spark = settings or Settings(), docs.sparkSession
    placed = written_places(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text")))
    vectors = fit(placed, s)
    out = spark.createDataFrame([], MATCHES)
    for passages in item_blocks(benchmark):
        out = out.union(_matches_of(placed, spark.sparkContext.broadcast((vectors, passages, s)), s.copy_share))
    best = F.max(F.struct("lcs_share", "cosine", "word_start", "kind")).alias("m")
    return out.groupBy("doc_id", "item_id").agg(best, F.sum("n_matches").alias("n_matches")).select(
        "doc_id", "item_id", "m.lcs_share", "m.cosine", "m.word_start", "n_matches", "m.kind")


def _matches_of(placed: DataFrame, shared, copy_share: float) -> DataFrame:
    names = [x.split(" ")[0] for x in MATCHES.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.string()]

    def run(batches):
        searcher = _searcher(shared)
        for batch in batches:
            found = searcher.search([np.frombuffer(raw, "<u4") for raw in batch.column(0).to_pylist()])
            rows = [(doc, item, share, cosine, at, n, "copy" if share >= copy_share else "paraphrase")
                    for doc, best in zip(batch.column(1).to_pylist(), found, strict=True)
                    for item, (share, cosine, at, n) in best.items()]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return of_texts(placed, "words", "doc_id").mapInArrow(run, MATCHES)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
               settings: Settings | None = None) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    s, spark = settings or Settings(), docs.sparkSession
    vectors = fit(written_places(docs.select(text_of(text_col).alias("text"))), s)
    place = docs.columns.index(text_col)
    for passages in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast((vectors, passages, s))

        def run(batches, shared=shared):
            searcher = _searcher(shared)
            for batch in batches:
                hashes = hashes_of_texts([t or "" for t in batch.column(place).to_pylist()])
                clean = [not found for found in searcher.search([np.frombuffer(raw, "<u4") for raw in hashes])]
                yield batch.filter(pa.array(clean, pa.bool_()))

        # Arrow has no name clashes to resolve: columns go by place
        plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
        schema = T.StructType([T.StructField(f"c{i}", f.dataType, True) for i, f in enumerate(docs.schema.fields)])
        docs = plain.mapInArrow(run, schema).toDF(*docs.columns)
    return docs
