"""Hard-negative mining with rotated one-bit codes and exact integer scores.

Vectors are integers, ``floor(scale * x)`` per component, and a score is the integer inner
product with the anchor. For each anchor, its ``positives`` best rows of the same label are
found; for each of these the ``negatives`` best rows of other labels whose score lies
between ``low`` and ``high`` hundredths of the positive's. Higher scores come first, ties by
the smaller id.

Codes. One random rotation R serves all rows. The signs of R x, as the unit vector c, are a
code of one bit a dimension, and the stored alignment a = <R x, c> makes a c the nearest
point on its line. What is left is orthogonal to c and gets the next code, so
R x = a1 c1 + a2 c2 + ... + r, with |r| about 0.6 times shorter for each code. An anchor is
cut into ``PLANES`` bit planes: R q = low + step * u + e with u whole numbers.

Filter. <u, c> is a sum of popcounts of planes and code, so <R q - e, R x - r> needs no
multiplication by components. By Cauchy and Schwarz the true score differs from it by at
most |e| |R x - r| + |q| |r|. This is no estimate of an error but a limit of it: a pair
outside cannot matter, and every pair inside is scored with integers. So the result is
exact whatever the codes are worth; they only decide how many pairs are scored.

Scale. Anchors are the stated query set. They are taken in blocks of about ``block_rows``
(by a hash of the id), each block is broadcast (its size bounded by ``block_rows`` and the
dimension) and scanned against all rows' codes, a written table of which every task reads
its own part. A task keeps the best few of each anchor, so a merge gets at most
tasks x anchors x few rows, and no label, id or vector gathers rows anywhere. Each block's
result is written, so a lost executor costs only its tasks.

Defined results. Rows with a null id, a null label, a null vector, a null or non-finite
component, or a vector longer than 2^28 after scaling (scores might leave 64 bits) take no
part. Shorter vectors, empty ones included, count as filled up with zeros. Rows alike in id,
label and integer vector count once; a row with the anchor's id is never its positive or
negative. Labels are integers. Fewer rows than asked for give fewer results. An empty table
gives no rows. Only the named columns are read, so other columns never clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import scratch_path

from .common import saved

CODES = 4            # one-bit codes per row
PLANES = 6           # bit planes per anchor
MOST_NORM = 2.0 ** 28
TILE_ANCHORS, TILE_ROWS = 256, 2048
LOWEST = np.iinfo(np.int64).min


# -- codes ------------------------------------------------------------------------------

def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


class RowCodes:
    """Codes of some rows: ``words[k]`` (n x words), ``align[k]`` (n), the length of what
    the codes give (``hat``) and of what they leave (``rest``)."""

    def __init__(self, vectors: np.ndarray, turn: np.ndarray, codes: int = CODES):
        left = vectors @ turn
        dim = left.shape[1]
        whole = np.linalg.norm(left, axis=1)
        words, align = [], []
        for _ in range(codes):
            sign = left >= 0
            a = np.abs(left).sum(1) / np.sqrt(dim)
            left = left - np.where(sign, 1.0, -1.0) * (a / np.sqrt(dim))[:, None]
            words.append(packed(sign))
            align.append(a)
        self.words, self.align = np.stack(words), np.stack(align)
        self.rest = np.linalg.norm(left, axis=1)
        self.hat = whole + self.rest


class AnchorPlanes:
    """Bit planes of some anchors, with the length of the cut-off part and of the anchor."""

    def __init__(self, vectors: np.ndarray, turn: np.ndarray, planes: int = PLANES):
        q = vectors @ turn
        self.dim = q.shape[1]
        self.low = q.min(1)
        self.step = np.maximum((q.max(1) - self.low) / (2 ** planes - 1), 1e-300)
        u = np.rint((q - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        self.planes = np.stack([packed((u >> j & 1).astype(np.uint8)) for j in range(planes)])
        self.total = u.sum(1).astype(np.float64)
        self.lost = np.linalg.norm(q - (self.low[:, None] + self.step[:, None] * u), axis=1)
        self.norm = np.linalg.norm(q, axis=1)

    def limits(self, rows: RowCodes, at: slice, to: slice) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible score of the anchors ``at`` with the rows ``to``."""
        root = np.sqrt(self.dim)
        score = np.zeros((len(self.low[at]), len(rows.rest[to])))
        both, count = np.empty(score.shape, np.uint64), np.empty(score.shape, np.uint8)
        for words, align in zip(rows.words, rows.align, strict=True):
            ones = np.zeros(score.shape, np.uint32)
            for plane in self.planes[::-1]:  # the highest first
                ones <<= 1
                for w in range(words.shape[1]):
                    np.bitwise_and(plane[at, w, None], words[None, to, w], out=both)
                    ones += np.bitwise_count(both, out=count)
            signs = 2.0 * np.bitwise_count(words[to]).sum(1) - self.dim
            dot = self.step[at, None] * (2.0 * ones - self.total[at, None]) + self.low[at, None] * signs[None]
            score += dot * (align[to] / root)[None]
        # the last term is for rounding
        half = (self.lost[at, None] * rows.hat[None, to] + self.norm[at, None] * rows.rest[None, to]
                + 1e-9 * self.norm[at, None] * rows.hat[None, to])
        return score - half, score + half


# -- scans ------------------------------------------------------------------------------

def best_first(group: np.ndarray, score: np.ndarray, ident: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` best of each group: by score, then by the smaller id."""
    order = np.lexsort((ident, -score, group))
    g = group[order]
    new = np.r_[True, g[1:] != g[:-1]] if len(g) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
    return order[np.arange(len(g)) - start < most]


class Kept:
    """The best few (group, score, id) of those seen, and each group's bar: the score that
    a newcomer must reach to matter."""

    def __init__(self, groups: int, most: int):
        self.most, self.bar = most, np.full(groups, LOWEST)
        self.rows = [np.zeros(0, np.int64)] * 3

    def add(self, group, score, ident):
        both = [np.concatenate(x) for x in zip(self.rows, (group, score, ident), strict=True)]
        keep = best_first(*both, self.most)
        self.rows = [x[keep] for x in both]
        g, s, _ = self.rows
        full = np.bincount(g, minlength=len(self.bar)) >= self.most
        least = np.full(len(self.bar), np.iinfo(np.int64).max)
        np.minimum.at(least, g, s)
        self.bar = np.where(full, least, LOWEST)


def tiles(n: int, size: int):
    return (slice(i, min(i + size, n)) for i in range(0, n, size))


class Block:
    """A block of anchors: ids, labels and integer vectors, ready to be scanned."""

    def __init__(self, ids, labels, ints, turn):
        order = np.argsort(labels, kind="stable")
        self.ids, self.labels, self.ints, self.turn = ids[order], labels[order], ints[order], turn

    def survivors(self, rows: dict, planes: AnchorPlanes, same: bool, floor, ceiling):
        """(anchor, row, score) of every pair whose interval meets [floor, ceiling] of its
        anchor; ``floor(at)`` is asked again for every tile, as it rises."""
        for to in tiles(len(rows["ids"]), TILE_ROWS):
            for at in tiles(len(self.ids), TILE_ANCHORS):
                mask = (self.labels[at, None] == rows["labels"][None, to]) == same
                if not mask.any():  # rows and anchors are sorted by label
                    continue
                mask &= self.ids[at, None] != rows["ids"][None, to]
                low, high = planes.limits(rows["codes"], at, to)
                mask &= high >= floor()[at, None]
                if ceiling is not None:
                    mask &= low <= ceiling[at, None]
                a, r = np.nonzero(mask)
                a, r = a + at.start, r + to.start
                if len(a):
                    yield a, r, np.einsum("ij,ij->i", self.ints[a], rows["ints"][r])

    def positives(self, batches, most: int):
        """Best rows of the same label, as (anchor, score, id) arrays."""
        planes = AnchorPlanes(self.ints.astype(float), self.turn)
        kept = Kept(len(self.ids), most)
        for rows in batches:
            for a, r, score in self.survivors(rows, planes, True, lambda: kept.bar, None):
                kept.add(a, score, rows["ids"][r])
        return kept.rows

    def negatives(self, batches, windows: dict, most: int):
        """Best rows of other labels in each window, as (window, score, id) arrays.
        ``windows`` has an anchor, a least and a greatest score for each window."""
        planes = AnchorPlanes(self.ints.astype(float), self.turn)
        anchor, least, greatest = windows["anchor"], windows["least"], windows["greatest"]
        ceiling = np.full(len(self.ids), LOWEST)
        np.maximum.at(ceiling, anchor, greatest)
        kept = Kept(len(anchor), most)

        def floor():
            out = np.full(len(self.ids), np.iinfo(np.int64).max)
            np.minimum.at(out, anchor, np.maximum(least, kept.bar))
            return out

        first = np.searchsorted(anchor, np.arange(len(self.ids) + 1))  # windows are sorted by anchor
        for rows in batches:
            for a, r, score in self.survivors(rows, planes, False, floor, ceiling):
                n = first[a + 1] - first[a]
                at = np.repeat(np.arange(len(a)), n)
                w = first[a][at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                fits = (score[at] >= np.maximum(least, kept.bar)[w]) & (score[at] <= greatest[w])
                kept.add(w[fits], score[at][fits], rows["ids"][r][at[fits]])
        return kept.rows


# -- the job ----------------------------------------------------------------------------

def integer_rows(rows: DataFrame, id_col: str, vec_col: str, label: Column, is_anchor: Column,
                 scale: float) -> DataFrame:
    """vec_id, label, is_anchor, ints: the rows that take part, alike rows once."""
    x = F.col(vec_col)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                    & (F.abs(v.cast("double")) <= MOST_NORM / scale))
    ints = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(scale))).cast("bigint"))
    out = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
                      F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
                      F.when(fine, ints).alias("ints"))
    length = F.aggregate("ints", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    out = out.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("ints").isNotNull()
                     & (length <= MOST_NORM ** 2))
    return out.dropDuplicates(["vec_id", "label", "is_anchor", "ints"])


def matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """Integer vectors, short ones filled up with zeros."""
    at = column.offsets.to_numpy()
    out = np.zeros((len(column), dim), np.int64)
    out[np.arange(dim)[None] < np.diff(at)[:, None]] = column.values.to_numpy()[at[0]:at[-1]]
    return out


def with_codes(rows: DataFrame, dim: int, turn) -> DataFrame:
    """Rows with their packed codes and alignments: vec_id, label, is_anchor, ints, words,
    align, hat, rest."""
    def run(batches):
        for batch in batches:
            ints = matrix(batch.column(3), dim)
            codes = RowCodes(ints.astype(float), turn.value)
            words = np.ascontiguousarray(codes.words.transpose(1, 0, 2)).astype("<u8")
            align = np.ascontiguousarray(codes.align.T).astype("<f8")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([w.tobytes() for w in words], pa.binary()),
                 pa.array([a.tobytes() for a in align], pa.binary()), pa.array(codes.hat), pa.array(codes.rest)],
                names=[*batch.schema.names, "words", "align", "hat", "rest"])

    # rows of one label side by side, so that a scan can pass over tiles of other labels
    return rows.sortWithinPartitions("label").mapInArrow(run, "vec_id bigint, label bigint, is_anchor boolean, "
        "ints array<bigint>, words binary, align binary, hat double, rest double")


def read_codes(batch: pa.RecordBatch, dim: int) -> dict:
    """The arrays of a batch of ``with_codes``."""
    codes, n = RowCodes.__new__(RowCodes), batch.num_rows
    words = np.frombuffer(b"".join(batch.column("words").to_pylist()), "<u8").reshape(n, CODES, dim // 64)
    align = np.frombuffer(b"".join(batch.column("align").to_pylist()), "<f8").reshape(n, CODES)
    codes.words, codes.align = words.transpose(1, 0, 2), align.T
    codes.hat, codes.rest = batch.column("hat").to_numpy(), batch.column("rest").to_numpy()
    return {"ids": batch.column("vec_id").to_numpy(), "labels": batch.column("label").to_numpy(),
            "ints": matrix(batch.column("ints"), dim), "codes": codes}


def best(found: DataFrame, group: str, most: int) -> DataFrame:
    """The ``most`` best of each group with their rank. A task gave at most ``most`` rows
    of a group, so a group has at most that many times the tasks."""
    order = Window.partitionBy(group).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mine_block(coded: DataFrame, block: Block, dim: int, positives: int, negatives: int,
               low: int, high: int) -> DataFrame:
    """Results of one broadcast block of anchors against all rows."""
    spark = coded.sparkSession
    shared = spark.sparkContext.broadcast(block)

    def run_positives(batches):
        a, score, ident = shared.value.positives((read_codes(b, dim) for b in batches), positives)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(score), pa.array(ident)],
                                         names=["anchor", "score", "vec_id"])

    near = best(coded.mapInArrow(run_positives, "anchor bigint, score bigint, vec_id bigint"),
                "anchor", positives)
    # at most ``positives`` rows for each anchor of the block
    near = near.orderBy("anchor", "rank").toArrow()
    score = near["score"].to_numpy()
    windows = {"anchor": near["anchor"].to_numpy(), "score": score, "vec_id": near["vec_id"].to_numpy(),
               "least": -(-low * score // 100), "greatest": high * score // 100}
    wide = spark.sparkContext.broadcast(windows)

    def run_negatives(batches):
        w, score, ident = shared.value.negatives((read_codes(b, dim) for b in batches), wide.value, negatives)
        yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(score), pa.array(ident)],
                                         names=["window", "score", "vec_id"])

    def named(batches):
        ids, win = shared.value.ids, wide.value
        for b in batches:
            w = b.column("window").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[win["anchor"][w]]), pa.array(win["vec_id"][w]), b.column("rank"),
                 b.column("vec_id"), pa.array(win["score"][w]), b.column("score")],
                names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    far = best(coded.mapInArrow(run_negatives, "window bigint, score bigint, vec_id bigint"),
               "window", negatives)
    return far.select("window", "rank", "vec_id", "score").mapInArrow(named, RESULT)


RESULT = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
          "positive_score bigint, negative_score bigint")


def mine(rows: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id",
         vec_col: str = "embedding", positives: int = 5, negatives: int = 3, low: int = 50,
         high: int = 95, scale: float = 256.0, block_rows: int = 4096, seed: int = 7) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = rows.sparkSession
    plain = saved(integer_rows(rows, id_col, vec_col, label, is_anchor, scale), "mining-rows")
    widest, anchors = plain.agg(F.max(F.size("ints")), F.count_if("is_anchor")).first()
    dim = max(1, -(-(widest or 0) // 64)) * 64
    turn = spark.sparkContext.broadcast(rotation(dim, seed))
    coded = saved(with_codes(plain, dim, turn), "mining-codes")
    blocks = max(1, -(-anchors // block_rows))
    path = scratch_path(spark, "mined")
    for k in range(blocks):
        mine_now = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == k
        # about ``block_rows`` anchors
        part = coded.filter(F.col("is_anchor") & mine_now).select("vec_id", "label", "ints").toArrow()
        block = Block(part["vec_id"].to_numpy(), part["label"].to_numpy(),
                      matrix(part["ints"].combine_chunks(), dim), turn.value)
        mine_block(coded, block, dim, positives, negatives, low, high).write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)
