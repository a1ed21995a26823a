"""A Merkle manifest of a dataset, with octopus multiproofs.

Tree. A leaf is the SHA-256 of a row's columns: each is ``-`` if null, else its UTF-8 byte
count, ``:`` and its value (integers in decimal). Digests are lower-case hexadecimal text,
also where they are hashed. The leaves of one tree (here: one language) stand in the order
of the id; each two consecutive nodes become the hash of their concatenation, a last one by
itself the hash of it alone, until one node is left, the subroot (a lone leaf is its own).
The subroots, in the order of their names (null first, then by UTF-8 bytes), give the root
in the same way.

Building. Rows are numbered by a range partitioning on (tree, id, leaf): each task numbers
its sorted rows, and only the first tree of a task can continue one of the task before, so
one number per task completes the positions. Aligned chunks of 2^CHUNK leaves are hashed up
by a task each; their tops are the leaves of the next round. A tree of n leaves takes
log(n) / CHUNK rounds, and no group is larger than a chunk, however large the tree.

Proving. Requests are bundled by ``BUNDLE`` consecutive rows of a range. A bundle knows its
own leaves. It walks up the tree with the set of coordinates that it can derive and notes
the siblings that exist and that it cannot: the minimal union of missing nodes for all its
proofs together (the octopus). These are fetched by one join with the node table. With them
the bundle derives every shared interior node once and expands each row's own proof, the
siblings on its way to the root. Each proof is then folded from the claimed leaf by itself.

Defined results. Rows with a null id come first, ties are in the order of their leaves;
repeated rows are leaves of their own. A null tree name is a tree. Texts of any length are
hashed whole. An empty table has no rows and no root. Only the named columns are read, so
other columns never clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.operators.joins import join_small
from tidewatch.session import scratch_path

from .common import saved

CHUNK = 10       # levels that one task hashes up
BUNDLE = 8192    # consecutive rows that are proved together
TOP = "top"      # name of the tree of subroots (names of others begin with "=" or are empty)
NODE = "tree string, level int, idx bigint, hash string"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


# -- leaves and positions ---------------------------------------------------------------

def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def tree_name(value: Column) -> Column:
    """A name that is never null; names sort as the values do, null first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` (a written table with ``tree``) with ``pos``, the place in its tree, and
    ``part``, ``row``, the place in the range partitioning; and (tree, size)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, "tree", *order).sortWithinPartitions("tree", *order)
    at = rows.columns.index("tree")

    def run(batches):
        tree, here, runs, row = None, 0, 0, 0
        for batch in batches:
            local, head = [], []
            for name in batch.column(at).to_pylist():
                if name != tree:
                    tree, here, runs = name, 0, runs + 1
                local.append(here)
                head.append(runs == 1)
                here += 1
            place = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(local, pa.int64()), pa.array(head, pa.bool_()), pa.array(place)],
                names=[*batch.schema.names, "local", "head", "row"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    ranged = ranged.withColumn("part", F.spark_partition_id())
    placed = saved(ranged.mapInArrow(run, ", ".join([*fields, "part int, local bigint, head boolean, row bigint"])),
                   "merkle-placed")
    counts = saved(placed.groupBy("tree", "part").agg(F.count("*").alias("n")), "merkle-counts")
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # only the first tree of a part can have leaves before it: at most one row a part
    base = (counts.withColumn("base", F.sum("n").over(before)).filter("base > 0")
            .select("part", "base", F.lit(True).alias("head")))
    sizes = counts.groupBy("tree").agg(F.sum("n").alias("size"))
    out = placed.join(F.broadcast(base), ["part", "head"], "left")
    return out.select(*rows.columns, "part", "row", (F.col("local") + F.coalesce("base", F.lit(0))).alias("pos")), sizes


# -- building ---------------------------------------------------------------------------

def parents(hashes: list[str]) -> list[str]:
    return [digest("".join(hashes[i:i + 2])) for i in range(0, len(hashes), 2)]


def hash_up(table: pa.Table, chunk: int = CHUNK) -> pa.Table:
    """All nodes above a chunk's consecutive nodes, up to its top."""
    at = table["idx"].to_numpy()
    order = np.argsort(at, kind="stable")
    hashes = table["hash"].take(pa.array(order)).to_pylist()
    tree, level, first = table["tree"][0].as_py(), table["level"][0].as_py(), int(at[order[0]])
    # a first chunk that is not full is its tree's only one
    only = first == 0 and len(hashes) < 1 << chunk
    levels, at, made = [level], [first], [hashes]
    while len(levels) <= chunk and not (only and len(made[-1]) == 1):
        made.append(parents(made[-1]))
        levels.append(levels[-1] + 1)
        at.append(at[-1] >> 1)
    new = range(1, len(made)) if len(made) > 1 else range(1)
    n = [len(made[k]) for k in new]
    return pa.table({
        "tree": pa.array([tree] * sum(n), pa.string()),
        "level": pa.array(np.repeat([levels[k] for k in new], n), pa.int32()),
        "idx": pa.array(np.concatenate([np.arange(at[k], at[k] + len(made[k])) for k in new]), pa.int64()),
        "hash": pa.array([h for k in new for h in made[k]], pa.string()),
        "is_top": pa.array(np.repeat([k == len(made) - 1 for k in new], n)),
        "is_new": pa.array(np.repeat([k > 0 for k in new], n))})


def grow(bottom: DataFrame, chunk: int = CHUNK) -> tuple[list[DataFrame], DataFrame]:
    """Tables of the nodes above ``bottom`` (tree, level, idx, hash) and the trees' tops."""
    made, level = [], bottom
    while True:
        out = saved(level.groupBy("tree", F.shiftright("idx", chunk)).applyInArrow(
            lambda table: hash_up(table, chunk), NODE + ", is_top boolean, is_new boolean"), "merkle-nodes")
        made.append(out.filter("is_new").select("tree", "level", "idx", "hash"))
        level = out.filter("is_top").select("tree", "level", "idx", "hash")
        if level.filter("idx > 0").isEmpty():
            return made, level


@dataclass
class Manifest:
    """``leaves``: the rows with tree, pos, part, row and leaf; ``nodes``: tree, level, idx,
    hash of all nodes, leaves included; ``trees``: tree, size, subroot, rank."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    root: str | None
    n_trees: int

    def write(self, path: str) -> None:
        for name in ("leaves", "nodes", "trees"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    """A written manifest; its root is the top of the tree of subroots."""
    leaves, nodes, trees = (spark.read.parquet(f"{path}/{x}") for x in ("leaves", "nodes", "trees"))
    return Manifest(leaves, nodes, trees, *top_of(nodes, trees))


def top_of(nodes: DataFrame, trees: DataFrame) -> tuple[str | None, int]:
    """The root and the number of trees."""
    tops = nodes.filter(F.col("tree") == TOP).agg(F.max_by("hash", "level").alias("root"))
    return tops.first()["root"], trees.count()


def build(rows: DataFrame, order: list[str], chunk: int = CHUNK) -> Manifest:
    """The manifest of ``rows`` (tree, leaf and whatever else is to be kept), the leaves of
    a tree in the order of the columns ``order``, then of the leaves."""
    rows = saved(rows.withColumn("serial", F.monotonically_increasing_id()), "merkle-leaves")
    # the serial number splits a row that is repeated very often
    leaves, sizes = numbered(rows, [*order, "leaf", "serial"])
    leaves = saved(leaves.drop("serial"), "merkle-positions")
    bottom = leaves.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("leaf").alias("hash"))
    nodes, tops = grow(bottom, chunk)

    roots = saved(tops.select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "hash"), "merkle-roots")
    ranked, _ = numbered(roots, ["name"])
    ranked = saved(ranked, "merkle-ranks")
    upper = ranked.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), "hash")
    upper_nodes, _ = grow(upper, chunk)
    for more in [*nodes, upper, *upper_nodes]:
        bottom = bottom.union(more)
    trees = saved(ranked.select(F.col("name").alias("tree"), F.col("hash").alias("subroot"), F.col("pos").alias("rank"))
                  .join(sizes, "tree"), "merkle-trees")
    return Manifest(leaves, bottom, trees, *top_of(bottom, trees))


# -- proving ----------------------------------------------------------------------------

def climb(at: np.ndarray, size: int):
    """For each level below the top: level, derivable places, existing siblings that are
    not derivable."""
    level, at = 0, np.unique(at)
    while size > 1:
        beside = at ^ 1
        yield level, at, beside[(beside < size) & ~np.isin(beside, at)]
        at, size, level = np.unique(at >> 1), (size + 1) // 2, level + 1


def trees_in(table: pa.Table) -> list[tuple[str, int, int, np.ndarray]]:
    """(tree, size, rank, rows) of each tree of a bundle."""
    names = table["tree"].combine_chunks().dictionary_encode()
    code = names.indices.to_numpy()
    out = []
    for k, name in enumerate(names.dictionary.to_pylist()):
        rows = np.flatnonzero(code == k)
        out.append((name, table["size"][int(rows[0])].as_py(), table["rank"][int(rows[0])].as_py(), rows))
    return out


def missing_nodes(table: pa.Table, n_trees: int) -> pa.Table:
    """Coordinates of the nodes that a bundle needs and cannot derive."""
    bundle, pos = table["bundle"][0].as_py(), table["pos"].to_numpy()
    trees = trees_in(table)
    need = [(tree, level, idx) for tree, size, _, rows in trees
            for level, _, beside in climb(pos[rows], size) for idx in beside.tolist()]
    need += [(TOP, level, idx) for level, _, beside in climb(np.array([t[2] for t in trees]), n_trees)
             for idx in beside.tolist()]
    return pa.table({"bundle": pa.array([bundle] * len(need), pa.string()),
                     "tree": pa.array([x[0] for x in need], pa.string()),
                     "level": pa.array([x[1] for x in need], pa.int32()),
                     "idx": pa.array([x[2] for x in need], pa.int64())})


def derive(at, hashes, size: int, fetched: dict) -> tuple[list[dict], str]:
    """All nodes known to a bundle, by level and place, and the top."""
    known = dict(zip(at, hashes, strict=True))
    levels, level = [], 0
    while size > 1:
        known |= fetched.get(level, {})
        levels.append(known)
        known = {i >> 1: digest(known.get(i & ~1, "") + known.get(i | 1, ""))
                 for i in known if not (i & 1 and i - 1 in known)}
        size, level = (size + 1) // 2, level + 1
    (top,) = known.values()
    return levels, top


def siblings(levels: list[dict], at: int) -> list[tuple[str | None, int]]:
    """(sibling or None, whether it stands left) for each level of the way up."""
    return [(known.get(at >> k ^ 1), at >> k & 1) for k, known in enumerate(levels)]


def fold(claimed: str, way) -> str:
    """The root that a claimed leaf and its proof give."""
    for beside, left in way:
        claimed = digest((beside or "") + claimed if left else claimed + (beside or ""))
    return claimed


def expand(table: pa.Table, got: pa.Table, n_trees: int) -> pa.Table:
    """Each row's proof and what it folds to, from the bundle's leaves and fetched nodes."""
    fetched: dict = {}
    for tree, level, idx, h in zip(*(got[c].to_pylist() for c in ("tree", "level", "idx", "hash")), strict=True):
        fetched.setdefault(tree, {}).setdefault(level, {})[idx] = h
    pos, leaves, claimed = table["pos"].to_numpy(), table["leaf"].to_pylist(), table["claimed"].to_pylist()
    trees = trees_in(table)
    derived = {}
    for tree, size, rank, rows in trees:
        derived[tree] = derive(pos[rows].tolist(), [leaves[r] for r in rows], size, fetched.get(tree, {}))
    upper, root = derive([t[2] for t in trees], [derived[t[0]][1] for t in trees], n_trees, fetched.get(TOP, {}))
    n = table.num_rows
    proof, folded = [""] * n, [""] * n
    for tree, _, rank, rows in trees:
        above = siblings(upper, rank)
        levels = derived[tree][0]
        for r in rows.tolist():
            way = siblings(levels, int(pos[r])) + above
            proof[r] = digest("".join(s for s, _ in way if s))
            folded[r] = fold(claimed[r], way)
    return (table.drop_columns(["bundle", "size", "rank"]).append_column("proof_sha256", pa.array(proof, pa.string()))
            .append_column("derived_root", pa.array([root] * n, pa.string()))
            .append_column("folded_root", pa.array(folded, pa.string())))


def prove(manifest: Manifest, requests: DataFrame | None = None, bundle_rows: int = BUNDLE) -> DataFrame:
    """Proofs for ``requests``: rows of the manifest's leaves, all of them by default, with
    ``claimed``, the leaf that is to be checked. Adds size, subroot, root, proof_sha256 (the
    digest of the row's siblings on its way to the root), derived_root (from the bundle's
    own leaves), folded_root (from the claimed leaf) and verified."""
    rows = manifest.leaves if requests is None else requests
    n_trees = manifest.n_trees
    # broadcast after a check of its size, else salted
    rows = join_small(rows, manifest.trees, "tree", "inner", salt_cols=["pos"])
    bundle = F.concat_ws("/", "part", F.floor(F.col("row") / bundle_rows).cast("string"))
    rows = saved(rows.withColumn("bundle", bundle), "merkle-requests")
    need = rows.select("bundle", "tree", "pos", "size", "rank").groupBy("bundle").applyInArrow(
        lambda table: missing_nodes(table, n_trees), "bundle string, tree string, level int, idx bigint")
    need = saved(need, "merkle-missing")
    got = need.join(manifest.nodes, ["tree", "level", "idx"]).select("bundle", "tree", "level", "idx", "hash")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields
              if f.name not in ("bundle", "size", "rank")]
    proved = rows.groupBy("bundle").cogroup(got.groupBy("bundle")).applyInArrow(
        lambda table, fetched: expand(table, fetched, n_trees),
        ", ".join([*fields, "proof_sha256 string, derived_root string, folded_root string"]))
    return (proved.withColumn("root", F.lit(manifest.root).cast("string"))
            .withColumn("verified", F.col("folded_root").eqNullSafe(F.col("root"))))


# -- documents --------------------------------------------------------------------------

def document_leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tree (the language), leaf and ``claimed``: the leaf as an auditor meets it.
    Where 7 divides the CRC-32 of the id, one character too many is claimed."""
    values = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.col("text")]
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    altered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    right = leaf(*values)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), tree_name(F.col("lang")).alias("tree"),
                       right.alias("leaf"), F.when(altered, leaf(*values[:3], more, values[4])).alias("altered"))


def audit(docs: DataFrame, chunk: int = CHUNK, bundle_rows: int = BUNDLE) -> DataFrame:
    """The manifest of ``docs``, and every row's claimed leaf checked against it."""
    made = build(document_leaves(docs), ["doc_id"], chunk)
    rows = made.leaves.withColumn("claimed", F.coalesce("altered", "leaf")).drop("altered")
    return prove(made, rows, bundle_rows).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
