"""Pluggable scorers.

A scorer adds one integer column to a DataFrame; NULL means "scoring failed".
Three shapes cover the cases:

* ``ColumnScorer``  - a pure Column expression of the row (stays in codegen);
* ``LookupScorer``  - scores held in a table (a join on a key);
* ``BatchScorer``   - a pandas callable over Arrow batches (``mapInPandas``),
  e.g. a model client, with a bounded number of calls in flight per task.

A costly scorer runs once per row: its output is materialised under the
checkpoint folder before the two downstream consumers read it.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import missing_path, scratch_path


class Scorer:
    costly = False
    # columns the score depends on; None when unknown (a Column function)
    inputs: frozenset[str] | None = None

    def reads_any(self, cols) -> bool:
        """Whether the score may depend on any of ``cols``."""
        return self.inputs is None or bool(self.inputs & set(cols))

    def __call__(self, df: DataFrame, out: str) -> DataFrame:  # pragma: no cover
        raise NotImplementedError


class ColumnScorer(Scorer):
    def __init__(self, fn: Callable[[DataFrame], Column], inputs=None):
        self.fn = fn
        self.inputs = None if inputs is None else frozenset(inputs)

    def __call__(self, df, out):
        return df.withColumn(out, self.fn(df).cast("int"))


class LookupScorer(Scorer):
    """Scores looked up in ``table`` by ``on``; rows without an entry get NULL.

    The table grows with the data, so it is not broadcast by hint: AQE
    broadcasts it only when its measured size is under the threshold."""

    def __init__(self, table: DataFrame, on: list[str] | str, score: Column):
        self.on = [on] if isinstance(on, str) else list(on)
        self.inputs = frozenset(self.on)
        # one score per key, so the join never multiplies the scored rows; a key
        # listed twice keeps its highest score. The aggregate is hash-partitioned
        # on the keys, which a shuffle join on them reuses.
        self.table = table.groupBy(*self.on).agg(F.max(score.cast("int")).alias("_score"))

    def __call__(self, df, out):
        return df.join(self.table, self.on, "left").withColumnRenamed("_score", out)


class BatchScorer(Scorer):
    """``fn(pandas.DataFrame[input_cols]) -> Series[int | None]`` over row batches.

    ``max_in_flight`` chunks of a batch are scored concurrently (threads, for an
    I/O-bound client); total concurrency is partitions x max_in_flight, so
    repartition first to set it. A chunk that raises is tried again ``retries``
    times, then row by row, so only the failing rows score NULL."""

    costly = True

    def __init__(self, fn, input_cols: list[str], max_in_flight: int = 10,
                 chunk_rows: int = 64, retries: int = 1):
        self.fn, self.input_cols = fn, list(input_cols)
        self.inputs = frozenset(self.input_cols)
        self.max_in_flight, self.chunk_rows, self.retries = max_in_flight, chunk_rows, retries

    def __call__(self, df, out):
        schema = T.StructType(list(df.schema.fields) + [T.StructField(out, T.IntegerType(), True)])
        fn, cols, limit, size, retries = (self.fn, self.input_cols, self.max_in_flight,
                                          self.chunk_rows, self.retries)

        def score_chunk(chunk: pd.DataFrame) -> pd.Series:
            for attempt in range(retries + 1):
                try:
                    s = pd.Series(fn(chunk[cols]), index=chunk.index)
                    return pd.to_numeric(s, errors="coerce").astype("Int32")
                except Exception:  # after the retries each row by itself; a failing row scores NULL
                    if attempt == retries and len(chunk) > 1:
                        return pd.concat([score_chunk(chunk.iloc[i:i + 1]) for i in range(len(chunk))])
            return pd.Series([pd.NA] * len(chunk), index=chunk.index, dtype="Int32")

        def run(batches):
            with ThreadPoolExecutor(max_workers=limit) as pool:
                for pdf in batches:
                    if pdf.empty:
                        yield pdf.assign(**{out: pd.Series([], dtype="Int32")})
                        continue
                    chunks = [pdf.iloc[i:i + size] for i in range(0, len(pdf), size)]
                    scores = pd.concat(list(pool.map(score_chunk, chunks)))
                    yield pdf.assign(**{out: scores})

        return df.mapInPandas(run, schema)


class FallbackScorer(Scorer):
    """Primary scorer, then ``secondary`` only for the rows the primary failed."""

    def __init__(self, primary: Scorer, secondary: Scorer):
        self.primary, self.secondary = primary, secondary
        self.costly = primary.costly or secondary.costly
        both = (primary.inputs, secondary.inputs)
        self.inputs = None if None in both else both[0] | both[1]

    def __call__(self, df, out):
        first = self.primary(df, out)
        if isinstance(self.secondary, ColumnScorer):
            # a row expression: one pass, no split of the rows
            return first.withColumn(out, F.coalesce(F.col(out),
                                                    self.secondary.fn(first).cast("int")))
        # The rows are split into scored and failed ones and the secondary runs
        # on the failed ones only. Both halves read the primary's output, so it
        # is written once rather than computed (with the text work) twice.
        first = materialise(first, "scored-primary")
        ok = first.filter(F.col(out).isNotNull())
        retry = self.secondary(first.filter(F.col(out).isNull()).drop(out), out)
        return ok.unionByName(retry)


class CachedScorer(Scorer):
    """``inner`` behind a table of scores that outlives the batch.

    A score is kept by the hash of the scorer's inputs (the prompt) under ``version``, which
    names the scorer. A batch asks the inner scorer once for each different prompt that the
    table lacks, with nothing but the prompt's columns, and writes the new scores beside the
    others before it uses them, so a batch that runs again asks nothing. A prompt that
    failed is not kept and is asked again by the next batch.

    The rows are written once, since both the search for new prompts and the result read
    them; a prompt that very many rows share is one row of the table, and the join to it is
    split where it is skewed."""

    def __init__(self, inner: Scorer, path: str, version: str):
        if inner.inputs is None:
            raise ValueError("a cached scorer must name its inputs")
        self.inner, self.path, self.inputs = inner, f"{path.rstrip('/')}/scorer={version}", inner.inputs

    def known(self, spark) -> DataFrame | None:
        """(prompt, score) of everything asked so far; None before the first batch."""
        try:
            rows = spark.read.schema("_prompt string, _score int").parquet(f"{self.path}/*")
        except AnalysisException as e:
            if missing_path(e):
                return None
            raise
        # two jobs at once may both have asked
        return rows.groupBy("_prompt").agg(F.max("_score").alias("_score"))

    def __call__(self, df, out):
        cols = sorted(self.inputs)
        prompt = F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)
        rows = materialise(df.withColumn("_prompt", prompt), "prompts")
        asked = rows.select("_prompt", *cols).dropDuplicates(["_prompt"])
        known = self.known(df.sparkSession)
        if known is not None:
            asked = asked.join(known, "_prompt", "left_anti")
        new = self.inner(asked, "_score").filter(F.col("_score").isNotNull()).select("_prompt", "_score")
        new.write.parquet(f"{self.path}/{uuid.uuid4().hex}")
        return rows.join(self.known(df.sparkSession), "_prompt", "left").drop("_prompt").withColumnRenamed("_score", out)


def fallback_score(primary, secondary, default: int = 0) -> Column:
    """Column form of D11: first non-NULL score, else ``default``."""
    return F.coalesce(primary, secondary, F.lit(default))


def materialise(df: DataFrame, name: str = "scored") -> DataFrame:
    """Write ``df`` under the checkpoint folder and read it back.

    Cuts the lineage, so an expensive upstream (a model scorer) runs once even
    with two consumers, and a lost executor re-reads files instead of re-scoring."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apply_scorer(df: DataFrame, scorer: Scorer, out: str, on_failure: int | None = 0,
                 materialise_costly: bool = True) -> DataFrame:
    """Add the score column (D10). A failed score becomes ``on_failure`` (0 like
    the original; ``None`` keeps NULL so averages exclude it)."""
    scored = scorer(df, out)
    if on_failure is not None:
        scored = scored.withColumn(out, F.coalesce(F.col(out), F.lit(on_failure)).cast("int"))
    if scorer.costly and materialise_costly:
        scored = materialise(scored, "scored")
    return scored
