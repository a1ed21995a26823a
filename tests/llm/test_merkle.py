"""The Merkle manifest against a plain version, subsets, edge rows."""

import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import merkle
from tidewatch.session import scratch_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, leaf string, pos int"


def h(s):
    return sha256(s.encode()).hexdigest()


def leaf(r, more=0):
    i, text, lang, source, n = r
    values = [i, source, lang, n + more if n is not None else None, text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_of(hashes):
    """(top, proofs as lists of (sibling or '', stands left))"""
    way = [[] for _ in hashes]
    at, row = list(range(len(hashes))), list(hashes)
    while len(row) > 1:
        for k, i in enumerate(at):
            way[k].append((row[i ^ 1] if (i ^ 1) < len(row) else "", i & 1))
            at[k] = i >> 1
        row = [h("".join(row[i:i + 2])) for i in range(0, len(row), 2)]
    return row[0], way


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    done = []
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        done.append((mine, *tree_of([leaf(r) for r in mine])))
    if not done:
        return []
    root, upper = tree_of([top for _, top, _ in done])
    out = []
    for (mine, top, ways), above in zip(done, upper, strict=True):
        for r, way in zip(mine, ways, strict=True):
            got = leaf(r, int(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0))
            for s, left in way + above:
                got = h(s + got if left else got + s)
            proof = h("".join(s for s, _ in way + above))
            out.append((r[0], leaf(r), top, root, proof, got, got == root))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    out = [(int(i), f"text {i} é", ["en", "fr", "z", None, "é"][int(rng.integers(0, 5))], None if i % 5 == 0 else "s",
            None if i % 4 == 0 else int(i)) for i in rng.permutation(150)]
    out += out[:7] + [(None, "a", "en", "s", 1), (None, "b", "en", None, 1), (None, None, None, None, None)]
    return out + [(500, "", "alone", "s", 2 ** 63 - 1), (501, "x" * 300_000, "en", "s", 3)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", "l", 1) for r in rows], SCHEMA).repartition(6)


@pytest.mark.parametrize(("chunk", "bundle"), [(10, 8192), (2, 9)])
def test_equals_plain_version(spark, rows, chunk, bundle):
    got = merkle.audit(frame(spark, rows), chunk, bundle)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_empty_table_and_single_row(spark):
    assert merkle.audit(frame(spark, [])).collect() == []
    one = [(3, "a", None, "s", 1)]
    assert [tuple(r) for r in merkle.audit(frame(spark, one)).collect()] == brute(one)


def test_subset_after_writing(spark, rows):
    path = scratch_path(spark, "manifest")
    merkle.build(merkle.document_leaves(frame(spark, rows)), ["doc_id"], chunk=3).write(path)
    made = merkle.read_manifest(spark, path)
    some = made.leaves.filter("doc_id % 11 = 3").withColumn(
        "claimed", F.when(F.col("doc_id") == 14, F.lit("0" * 64)).otherwise(F.col("leaf")))
    got = merkle.prove(made, some, bundle_rows=50).collect()
    want = {r[0]: r for r in brute(rows) if r[0] is not None}
    assert len(got) == sum(r[0] is not None and r[0] % 11 == 3 for r in rows)
    for r in got:
        assert r["proof_sha256"] == want[r["doc_id"]][4] and r["derived_root"] == r["root"] == want[r["doc_id"]][3]
        assert r["verified"] == (r["doc_id"] != 14)


def test_missing_nodes_are_minimal():
    # leaves 2, 3, 4 of 7: the parent of 2 and 3 is derived; 5, the pair 0-1 and the single 6 are missing
    got = [(level, beside.tolist()) for level, _, beside in merkle.climb(np.array([2, 3, 4]), 7)]
    assert got == [(0, [5]), (1, [0, 3]), (2, [])]
