"""Hard negatives: intervals hold, the result equals brute force, edge rows."""

import math

import numpy as np
from pyspark.sql import functions as F

from tidewatch.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int, words string, ints string"


def brute(rows, positives=5, negatives=3, low=50, high=95):
    """Plain loops over (id, vector, label)."""
    seen = set()
    for i, v, lab in rows:
        if i is None or lab is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        seen.add((i, lab, tuple(math.floor(256 * float(x)) for x in v)))
    out = []
    for i, lab, v in seen:
        if i % 50:
            continue
        score = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in seen if j != i]
        for neg, j, other in sorted(x for x in score if x[2] == lab)[:positives]:
            fit = sorted(x for x in score if x[2] != lab and 50 * -neg <= 100 * -x[0] <= 95 * -neg)
            out += [(i, j, k + 1, x[1], -neg, -x[0]) for k, x in enumerate(fit[:negatives])]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(i, v, lab, "x", "y") for i, v, lab in rows], SCHEMA).repartition(5)
    got = hn.mine(df, F.col("vec_id") % 50 == 0, F.col("label"), **more)
    return sorted(tuple(r) for r in got.collect())


def test_intervals_hold_and_prune():
    rng = np.random.default_rng(1)
    rows = rng.integers(-200, 200, (3000, 64))
    rows[:5] = 0
    rows[5] = 200
    turn = hn.rotation(64)
    low, high = hn.AnchorPlanes(rows[:40].astype(float), turn).limits(
        hn.RowCodes(rows.astype(float), turn), slice(0, 40), slice(0, 3000))
    true = rows[:40] @ rows.T
    assert (low <= true).all() and (true <= high).all()
    # an interval is far narrower than the range of scores
    size = np.linalg.norm(rows[:40], axis=1)[:, None] * np.linalg.norm(rows, axis=1)[None]
    assert np.median((high - low)[6:, 6:] / size[6:, 6:]) < 0.6


def test_equals_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=70) / 8], int(rng.integers(0, 4))) for i in range(400)]
    same = [0.25] * 70
    rows += [(1000 + i, same, 1) for i in range(150)] + [(2000 + i, same, 2) for i in range(80)]  # ties
    rows += rows[:20] + rows[400:420]                                                              # repeated rows
    rows += [(3000, None, 1), (3050, [1.0], 1), (3100, [], 2), (3001, [float("nan")] + same[1:], 1),
             (3002, [None] + same[1:], 1), (3003, [float("inf")] + same[1:], 1), (None, same, 1),
             (3150, same, None), (3200, [0.0] * 70, 3), (-50, same, 9), (3004, [4000.0] * 70, 2)]
    want = brute(rows)
    assert len(want) > 60
    assert mined(spark, rows) == want
    assert mined(spark, rows, block_rows=4) == want


def test_few_rows_and_empty_table(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 0.5], 1), (2, [0.5, 0.5], 2), (3, [9.0, 9.0], 2)]
    assert mined(spark, rows) == brute(rows) != []
