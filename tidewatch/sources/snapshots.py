"""Versioned state snapshots as a base plus changes (A5).

A snapshot is the state table after one batch. Most keys do not change in a batch, so a
snapshot is stored as the rows that differ from the one before; now and then (every
``base_every`` snapshots) it is stored whole, as a base. The state as of any batch is, for
each key, the last row among its base and the changes up to it.

    <base>/rows/version=V/month=YYYY-MM/    rows of one write, of any number of snapshots,
                                            ordered by batch period in each file
    <base>/manifest/month=YYYY-MM/          one row per snapshot: the version of its rows
                                            and the batch period of its base

The manifest decides what is there: rows are written first, under a new version, and the
month's manifest is replaced afterwards. A job that fails in between leaves rows that
nobody reads, a job that runs again replaces its snapshots, and no reader lists files. A
read opens the manifest's rows of one or two months and the at most ``base_every`` versions
of one chain, of which only the months of the chain's periods are opened, and of their files
only the row groups that may hold these periods. So the number of files follows the months
and the bytes, not the number of snapshots.

Keys are added but never removed: a state keeps a row for every key it has ever had.

A snapshot that is written again while later ones exist would change what these add up to;
the next one is then stored as a base first, so they keep their contents.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import month
from ..session import missing_path

BASE_EVERY = 24

_TEXT = T.StringType()
MANIFEST = T.StructType([T.StructField("batch_period", _TEXT), T.StructField("base_period", _TEXT),
                         T.StructField("version", _TEXT), T.StructField("length", T.IntegerType()),
                         T.StructField("month", _TEXT)])


class SnapshotStore:
    """Snapshots of one state table with the given schema and keys under ``base``."""

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, keys: list[str],
                 base_every: int = BASE_EVERY):
        self.spark, self.base, self.schema, self.keys = spark, base.rstrip("/"), schema, list(keys)
        self.base_every = base_every

    # -- manifest -----------------------------------------------------------------------

    def manifest(self) -> DataFrame | None:
        """One row per snapshot; None if nothing has been written."""
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.base}/manifest")
        except AnalysisException as e:
            if missing_path(e):
                return None
            raise

    def periods(self) -> set[str]:
        """The batch periods that have a snapshot (the schedule, one text each)."""
        m = self.manifest()
        return set() if m is None else {r[0] for r in m.select("batch_period").collect()}

    def latest(self, before: str | None = None) -> str | None:
        """The last snapshot's batch period strictly before ``before``."""
        m = self.manifest()
        if m is None:
            return None
        if before is not None:  # whole months after it are not opened
            m = m.filter((F.col("month") <= month(before)) & (F.col("batch_period") < before))
        return m.agg(F.max("batch_period")).first()[0]

    def _chain(self, period: str) -> list:
        """Manifest rows from the period's base up to it: at most ``base_every``."""
        m = self.manifest().filter(F.col("month") <= month(period))
        base = m.filter((F.col("month") == month(period)) & (F.col("batch_period") == period)).first()["base_period"]
        return (m.filter((F.col("month") >= month(base)) & (F.col("base_period") == base)
                         & F.col("batch_period").between(base, period)).orderBy("batch_period").collect())

    def _replace_manifest(self, rows: list[tuple]) -> None:
        """Adds or replaces manifest rows, month by month (at most a month's rows each)."""
        new = {r[0]: r for r in rows}
        months = sorted({r[4] for r in rows})
        old = self.manifest()
        if old is not None:
            kept = old.filter(F.col("month").isin(months)).collect()
            new = {r["batch_period"]: tuple(r[c] for c in MANIFEST.names) for r in kept} | new
        (self.spark.createDataFrame(sorted(new.values()), MANIFEST).coalesce(1).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{self.base}/manifest"))

    # -- reading ------------------------------------------------------------------------

    def read(self, period: str) -> DataFrame:
        """The snapshot of ``period``: the last row of each key in its chain."""
        versions: dict[str, list[str]] = {}
        for row in self._chain(period):
            versions.setdefault(row["version"], []).append(row["batch_period"])
        rows = f"{self.base}/rows"
        schema = T.StructType([*self.schema.fields, *(T.StructField(n, _TEXT) for n in ("batch_period", "version", "month"))])
        table = (self.spark.read.schema(schema).option("basePath", rows)
                 .parquet(*[f"{rows}/version={v}" for v in versions]))
        mine = F.lit(False)  # a version may hold snapshots that have been written again since
        for v, periods in versions.items():
            mine = mine | ((F.col("version") == v) & F.col("batch_period").isin(periods))
        names = [p for periods in versions.values() for p in periods]
        months = sorted({month(p) for p in names})
        rows = table.filter(F.col("month").isin(months) & F.col("batch_period").isin(names) & mine)
        if sum(map(len, versions.values())) == 1:
            return rows.select(*self.schema.names)  # a base: no changes to lay over it
        last = F.max_by(F.struct(*self.schema.names), "batch_period").alias("row")
        # null keys are keys too
        return rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)]).agg(last).select("row.*")

    def read_before(self, before: str | None = None) -> DataFrame | None:
        """The latest snapshot strictly before ``before``; None if there is none."""
        period = self.latest(before)
        return None if period is None else self.read(period)

    # -- writing ------------------------------------------------------------------------

    def write(self, snapshots: DataFrame, periods: list[str]) -> None:
        """Write the snapshots of ``periods`` (whole states with ``batch_period``), in one
        job. All snapshots from the first of them on that are not among them stay as they
        are."""
        periods = sorted(periods)
        have = self.periods()
        after = min((p for p in have if p > periods[0] and p not in periods), default=None)
        if after is not None:
            self._as_base(after)
        previous = self.latest(periods[0])
        chain = self._chain(previous) if previous else []
        # a base where nothing comes before, or the chain is long enough
        rows, bases, length, base = [], [], len(chain), chain[0]["batch_period"] if chain else None
        version = uuid.uuid4().hex
        for p in periods:
            if base is None or length >= self.base_every:
                base, length = p, 0
                bases.append(p)
            length += 1
            rows.append((p, base, version, length, month(p)))
        names = self.schema.names
        states = snapshots.select(*names, "batch_period")
        if previous and periods[0] not in bases:
            states = states.unionByName(self.read(previous).withColumn("batch_period", F.lit("")))
        w = Window.partitionBy(*self.keys).orderBy("batch_period")
        row = F.struct(*names)
        changed = ~row.eqNullSafe(F.lag(row).over(w)) | F.lag(F.lit(1)).over(w).isNull()
        # null periods are none
        whole = self.spark.createDataFrame([(p,) for p in bases], "batch_period string").withColumn("_whole", F.lit(True))
        out = (states.withColumn("_changed", changed).join(F.broadcast(whole), "batch_period", "left")
               .filter((F.col("_changed") | F.col("_whole")) & (F.col("batch_period") != "")).drop("_changed", "_whole"))
        self._write_rows(out, version)
        self._replace_manifest(rows)

    def _write_rows(self, rows: DataFrame, version: str) -> None:
        (rows.withColumn("month", month(F.col("batch_period"))).sortWithinPartitions("month", "batch_period")
         .write.partitionBy("month").parquet(f"{self.base}/rows/version={version}"))

    def _as_base(self, period: str) -> None:
        """Store an existing snapshot whole; those that build on it build on its base now."""
        row = self._chain(period)[-1]
        if row["base_period"] == period:
            return
        version = uuid.uuid4().hex
        self._write_rows(self.read(period).withColumn("batch_period", F.lit(period)), version)
        chained = (self.manifest().filter((F.col("batch_period") > period) & (F.col("base_period") == row["base_period"]))
                   .collect())  # at most ``base_every`` rows
        rows = [(period, period, version, 1, month(period))]
        rows += [(r["batch_period"], period, r["version"], r["length"] - row["length"] + 1, r["month"]) for r in chained]
        self._replace_manifest(rows)
