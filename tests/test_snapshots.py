"""State snapshots as a base plus changes: any past period equals the full snapshot."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.sources.snapshots import SnapshotStore

SCHEMA = T.StructType([T.StructField("car_model", T.StringType()), T.StructField("accident", T.StringType()),
                       T.StructField("n", T.LongType())])
KEYS = [("A", "x"), ("A", "y"), (None, "x"), ("B", None), ("C", "z")]


def _name(i):
    # across a month's end
    day, hour = divmod(i, 24)
    d = f"2024-01-{30 + day:02d}" if day < 2 else f"2024-02-{day - 1:02d}"
    return f"{d}-{hour:02d}-00-00_x"


def _history(n, seed):
    """Per period a full snapshot: few keys change, values become null, keys are added."""
    rng, now, out = random.Random(seed), {k: 0 for k in KEYS[:3]}, {}
    for i in range(n):
        for k in KEYS[:3 + i // 4]:
            if rng.random() < 0.3:
                now[k] = rng.choice([None, rng.randrange(5)])
        out[_name(i * 7)] = dict(now)
    return out


def _frame(spark, snapshots):
    rows = [(*k, v, p) for p, snap in snapshots.items() for k, v in snap.items()]
    return spark.createDataFrame(rows, T.StructType([*SCHEMA.fields, T.StructField("batch_period", T.StringType())]))


def _read(store, period):
    return {(r["car_model"], r["accident"]): r["n"] for r in store.read(period).collect()}


def _check(store, want):
    assert store.periods() == set(want)
    for p, snap in want.items():
        assert _read(store, p) == snap, p


def test_one_by_one_and_in_one_job(spark, tmp_dir):
    want = _history(7, 1)
    one = SnapshotStore(spark, tmp_dir + "/one", SCHEMA, ["car_model", "accident"], base_every=3)
    assert one.read_before() is None and one.periods() == set() and one.latest("2024") is None
    for p, snap in want.items():
        one.write(_frame(spark, {p: snap}), [p])
    _check(one, want)
    lengths = {r["batch_period"]: r["length"] for r in one.manifest().collect()}
    assert [lengths[p] for p in sorted(want)] == [1, 2, 3, 1, 2, 3, 1]
    # changes are smaller than snapshots, and as-of reads find the one before
    assert spark.read.parquet(f"{tmp_dir}/one/rows").count() < sum(map(len, want.values()))
    names = sorted(want)
    assert one.latest(names[3]) == names[2] and one.latest(names[0]) is None
    assert {(r[0], r[1]): r[2] for r in one.read_before(names[5] + "~").collect()} == want[names[5]]

    many = SnapshotStore(spark, tmp_dir + "/many", SCHEMA, ["car_model", "accident"], base_every=4)
    many.write(_frame(spark, {p: want[p] for p in names[:3]}), names[:3])
    many.write(_frame(spark, {p: want[p] for p in names[3:]}), names[3:])
    _check(many, want)


@pytest.mark.parametrize("which", [[0], [3, 6], [8]])
def test_written_again_leaves_later_ones_alone(spark, tmp_dir, which):
    want = _history(9, 2)
    names = sorted(want)
    store = SnapshotStore(spark, f"{tmp_dir}/{which[0]}", SCHEMA, ["car_model", "accident"], base_every=4)
    store.write(_frame(spark, want), names)
    again = {names[i]: {k: 90 + i for k in KEYS[:2]} | {("N", "n"): i} for i in which}
    for _ in range(2):  # a job that runs again
        store.write(_frame(spark, again), list(again))
    for p, snap in want.items():
        got = _read(store, p)
        if p in again:
            assert {k: got[k] for k in again[p]} == again[p]
        else:
            assert got == snap, p


def test_empty_state(spark, tmp_dir):
    store = SnapshotStore(spark, tmp_dir, SCHEMA, ["car_model", "accident"])
    store.write(_frame(spark, {}).limit(0), ["2024-01-01"])
    assert store.read("2024-01-01").collect() == [] and store.periods() == {"2024-01-01"}
    store.write(_frame(spark, {"2024-01-02": {("A", "x"): 1}}), ["2024-01-02"])
    assert _read(store, "2024-01-02") == {("A", "x"): 1} and _read(store, "2024-01-01") == {}
    assert store.read("2024-01-02").filter(F.col("n") == 1).count() == 1
