"""SimHash near-duplicates by a generalised pigeonhole.

Fingerprints. Texts are lower-cased in A-Z; words are runs of anything but ASCII white
space; a shingle is ``shingle`` words joined by a space. A fingerprint bit is 1 if it is
set in more than half of the shingles' XXH64 hashes (seed 42).

Candidates. Two fingerprints within distance d differ in at most t_i bits of some part i
of the bits whenever the thresholds satisfy sum(t_i + 1) > d. The 64 bits are grouped
into parts by their correlation over all fingerprints, and a dynamic programme gives each
part the threshold (-1: not probed) with the least estimated cost: probe rows plus
candidates. Candidates are estimated from the exact number of fingerprint pairs that
agree in a part and from the frequencies of its bits. Fingerprints that agree in a part
but for t_i masked bits share a bucket; so each fingerprint is sent to one bucket for
every choice of t_i masked bits, and any pair within distance d meets in some bucket.

Verification, without all pairs of a group. Equal fingerprints are one node. Each bucket
elects its node of most documents as centre, and nodes within distance d of the centre
are linked to it: one row per node, however large the bucket. Connected components of
these links come next. Then only nodes of *different* components that share a bucket are
compared, so a large group of near copies, already one component, costs nothing, and no
link between components is lost. The components of both kinds of links are the result.

Counting, centres, links and components are joins and aggregations in Spark; nothing but
bit statistics (64 x 64 numbers) and pair counts of a few parts reaches the driver.

Defined results: null text is the empty text; a text without words has fingerprint zero
and is linked like any other; fewer words than a shingle make one shingle; a null id
never becomes a component's name (a component of null ids alone has a null name);
repeated rows are exact copies; an empty table gives no rows; only the id and text
columns are read, so other columns never clash.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, text_of

BITS = 64
SEED = 42


# -- fingerprints ---------------------------------------------------------------------

def fingerprint(text: str, shingle: int = 4, block: int = 1 << 16) -> int:
    """The fingerprint as an unsigned integer."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "replace").lower().split()  # of bytes: ASCII letters and white space
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()[shingle - 1:] or [len(line)]
    n, ones = len(ends), np.zeros(BITS, np.int64)
    for at in range(0, n, block):
        h = np.array([xxh64_intdigest(line[a:b], SEED)
                      for a, b in zip(begins[at:at + block], ends[at:at + block], strict=False)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def row_keys(id_col: Column, text_col: Column) -> list[Column]:
    """Two hashes that tell a row's id and text apart from any other's."""
    text = F.coalesce(text_col, F.lit(""))
    return [F.xxhash64(id_col, text).alias("k1"), F.xxhash64(F.lit(1), text, id_col).alias("k2")]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 4) -> DataFrame:
    """doc_id, the row's keys and ``fp``, the fingerprint as a signed 64-bit integer."""
    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(3).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(fps.view(np.int64))],
                names=["doc_id", "k1", "k2", "fp"])

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       *row_keys(F.col(id_col).cast("bigint"), F.col(text_col)), text_of(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, k1 bigint, k2 bigint, fp bigint")


# -- partitions and thresholds --------------------------------------------------------

def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how many have both bits i and j (all of them)."""
    def run(batches):
        n, both = 0, np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            fp = batch.column(0).to_numpy()
            bits = np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1,
                                 bitorder="little").astype(np.float64)
            n += len(fp)
            both += (bits.T @ bits).astype(np.int64)
        at = np.arange(BITS * BITS)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(both.ravel(), n))],
                                         names=["at", "n"])

    rows = nodes.select("fp").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(
        F.sum("n").alias("n")).collect()  # at most 64 * 64 + 1 numbers
    both, n = np.zeros(BITS * BITS, np.int64), 0
    for at, count in rows:
        if at < 0:
            n = count
        else:
            both[at] = count
    return n, both.reshape(BITS, BITS)


def correlated_parts(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Group the bits into parts of nearly equal size, each grown around a bit by adding
    the bit of the largest mean absolute correlation with it."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    spread = np.sqrt(np.maximum(np.outer(p * (1 - p), p * (1 - p)), 1e-12))
    corr = np.abs(cov / spread)
    left, out = set(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(len, out))) // (parts - k)
        # start from the bit most correlated with what is left
        rest = sorted(left)
        group = [max(rest, key=lambda b: corr[b, rest].sum())]
        left.remove(group[0])
        while len(group) < size:
            best = max(sorted(left), key=lambda b: corr[b, group].mean())
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def equal_pairs(nodes: DataFrame, masks: list[int]) -> list[float]:
    """For each mask, the number of pairs of fingerprints that agree in its bits."""
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
                               for i, m in enumerate(masks)])).alias("x")
    counts = nodes.select(keys).groupBy("x.k", "x.key").count()
    got = dict(counts.groupBy("k").agg(F.sum(F.col("count") * (F.col("count") - 1) / 2.0)).collect())
    return [got.get(i, 0.0) for i in range(len(masks))]


def agreement(q: np.ndarray, most: int) -> np.ndarray:
    """Probabilities that independent bits, each agreeing with its probability in
    ``q``, disagree in 0..most places."""
    p = np.zeros(most + 1)
    p[0] = 1.0
    for x in q:
        p[1:] = p[1:] * x + p[:-1] * (1 - x)
        p[0] *= x
    return p


def part_costs(n: int, freq: np.ndarray, part: list[int], pairs: float, distance: int,
               row_cost: float = 4.0) -> list[float]:
    """Estimated cost of thresholds -1..distance for a part, in candidate pairs. A probe
    row (it is shuffled) counts as ``row_cost`` pairs."""
    q = freq[part] ** 2 + (1 - freq[part]) ** 2
    p = agreement(q, distance)
    all_pairs = n * (n - 1) / 2.0
    # how much likelier agreement is than for independent bits: correlated bits, copies
    lift = max(1.0, pairs / max(all_pairs * p[0], 1e-9))
    costs = [0.0]
    for t in range(distance + 1):
        # a pair that differs in j of the masked bits' places meets once per choice that covers them
        within = sum(p[j] * comb(len(part) - j, t - j) for j in range(t + 1) if t <= len(part))
        costs.append(max(n, 1) * comb(len(part), t) * row_cost
                     + min(all_pairs, all_pairs * within * lift) if t <= len(part) else float("inf"))
    return costs


def allocate(costs: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """Thresholds with sum(t + 1) = distance + 1 of least total cost, by dynamic
    programming over the parts. ``costs[i][t + 1]`` is the cost of threshold t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for more, c in enumerate(cost):
                at, made = used + more, total + c
                if at <= distance + 1 and made < step.get(at, (float("inf"),))[0]:
                    step[at] = (made, [*chosen, more - 1])
        best = step
    return best[distance + 1]


def plan_masks(nodes: DataFrame, distance: int, part_counts: tuple[int, ...] = (2, 3, 4, 5)) -> list[int]:
    """Masks such that any two fingerprints within ``distance`` agree under one."""
    n, both = bit_statistics(nodes)
    freq = np.diag(both) / max(n, 1)
    plans = [correlated_parts(n, both, m) for m in part_counts if m <= distance + 1] or [[list(range(BITS))]]
    masks = [sum(1 << b for b in part) for plan in plans for part in plan]
    pairs = iter(equal_pairs(nodes, masks))
    choices = []
    for plan in plans:
        total, thresholds = allocate([part_costs(n, freq, part, next(pairs), distance) for part in plan], distance)
        choices.append((total, len(plan), plan, thresholds))
    _, _, plan, thresholds = min(choices, key=lambda c: c[:2])
    return [sum(1 << b for b in part) & ~sum(1 << b for b in masked)
            for part, t in zip(plan, thresholds, strict=True) if t >= 0
            for masked in combinations(part, t)]


# -- links and components -------------------------------------------------------------

def bucket_rows(nodes: DataFrame, masks: list[int], *more: str) -> DataFrame:
    """A row per node and mask: ``k`` (the mask's number), ``key``, fp and ``more``."""
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
                               for i, m in enumerate(masks)])).alias("x")
    return nodes.select(keys, "fp", *more).select("x.k", "x.key", "fp", *more)


def apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node connected with each linked node.

    Alternates large-star and small-star steps, each a grouped minimum joined back, so
    no neighbour list is ever collected; a node of many links is a skewed join key that
    adaptive execution splits.
    """
    pairs = saved(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .filter("u <> v").distinct(), "cc-links")
    state = None
    for _ in range(most_rounds):
        # large star: every larger neighbour of u goes to the least of u's neighbourhood
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        # small star: u and its smaller neighbours go to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        pairs = saved(small, "cc-round")
        now = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)).first()
        if now == state:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
    raise RuntimeError("components did not settle")


def linked_prints(prints: DataFrame, distance: int = 4) -> DataFrame:
    """(fp, whole): the component of each fingerprint, named by one of its fingerprints.
    ``prints`` is a written table with a row per document."""
    nodes = saved(prints.groupBy("fp").agg(F.count("*").alias("n")), "simhash-nodes")
    masks = plan_masks(nodes, distance)

    # centre links: a node of each bucket with its centre, one row per node
    rows = bucket_rows(nodes, masks, "n")
    centre = (rows.groupBy("k", "key").agg(F.max(F.struct("n", "fp")).alias("c"), F.count("*").alias("size"))
              .filter("size > 1").select("k", "key", F.col("c.fp").alias("centre")))
    # written, so that the join's sides are plain exchanges and a hot bucket can be split
    centre = saved(centre, "simhash-centres")
    near = (rows.drop("n").join(centre, ["k", "key"]).filter("fp <> centre")
            .filter(apart("fp", "centre") <= distance)
            .select(F.col("fp").alias("a"), F.col("centre").alias("b")))
    first = components(near)

    # what is left: nodes of different components in one bucket
    named = saved(nodes.select("fp").join(first, F.col("fp") == F.col("node"), "left")
                  .select("fp", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    rows = bucket_rows(named, masks, "root")
    mixed = (rows.groupBy("k", "key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
             .filter("low <> high").select("k", "key"))
    mixed = saved(mixed, "simhash-mixed-keys")
    rows = saved(rows.join(mixed, ["k", "key"]), "simhash-mixed")
    other = rows.select("k", "key", F.col("fp").alias("fp2"), F.col("root").alias("root2"))
    across = (rows.join(other, ["k", "key"])
              .filter((F.col("root") < F.col("root2")) & (apart("fp", "fp2") <= distance))
              .select(F.col("root").alias("a"), F.col("root2").alias("b")))
    second = components(across).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return named.join(second, "root", "left").select("fp", F.coalesce("top", "root").alias("whole"))


def first_rows(prints: DataFrame, whole: DataFrame) -> DataFrame:
    """(fp, doc_id, k1, k2): for each fingerprint the first row of its component, by id
    (null last), then by the row's keys."""
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")
    best = prints.groupBy("fp").agg(F.min(rank).alias("first"))
    names = saved(whole.join(best, "fp"), "simhash-names")
    top = names.groupBy("whole").agg(F.min("first").alias("first"))
    return names.select("fp", "whole").join(top, "whole").select("fp", "first.doc_id", "first.k1", "first.k2")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the smallest
    id that links of at most ``distance`` differing bits reach, itself included."""
    prints = saved(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    first = first_rows(prints, linked_prints(prints, distance))
    named = first.select("fp", F.col("doc_id").alias("component_id"))
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row of each component, the one that ranks first, with the columns of ``docs``."""
    prints = saved(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    kept = first_rows(prints, linked_prints(prints, distance)).select("k1", "k2").distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    row = row.select("row", *row_keys(F.col("row")[id_col].cast("bigint"), F.col("row")[text_col]))
    # rows alike in id and text are told apart by their number; the join has already
    # brought them together
    alike = Window.partitionBy("k1", "k2").orderBy("k1")
    return (row.join(kept, ["k1", "k2"], "left_semi").withColumn("no", F.row_number().over(alike))
            .filter("no = 1").select("row.*"))
