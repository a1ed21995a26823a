"""Small helpers shared by the text-corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import scratch_path

# separators that str.split() knows but Unicode's White_Space property does not
_NOT_WHITE = "\x1c\x1d\x1e\x1f"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that ``df`` has no column of (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def fenced(col: Column) -> Column:
    """``col``, which the optimiser must not copy into filters above it.

    A filter on a computed column is pushed down by repeating the column's expression,
    at every place where it is used; for columns that build on each other that repeats
    the work many times over. An expression that depends on the task stays where it is;
    this condition is always true.
    """
    return F.when(F.spark_partition_id() >= 0, col)


def white_chunks(text: str) -> list[str]:
    """The runs between Unicode white space."""
    if any(c in text for c in _NOT_WHITE):
        import regex
        return regex.findall(r"[^\p{White_Space}]+", text)
    return text.split()


def saved(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared scratch folder and read back: cuts the lineage, survives
    lost executors and gives the planner the real size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class Memo(dict):
    """Values by key, computed on demand and kept in two generations.

    At most ``2 * limit`` keys stay: when the young generation is full it becomes
    the old one, so frequent keys survive and memory is bounded whatever the
    input holds. Long keys are never kept.
    """

    def __init__(self, make, limit: int = 250_000, max_key: int = 64):
        super().__init__()
        self.make, self.limit, self.max_key, self.old = make, limit, max_key, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.max_key:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
