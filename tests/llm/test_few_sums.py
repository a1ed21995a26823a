"""What the fit of op2 and the pipeline writes follows the words, not the input's partitions."""

import numpy as np
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate as d

KEY = "spark.sql.files.maxPartitionBytes"


def _tasks(frame):
    return frame.select(F.spark_partition_id().alias("p")).distinct().count()


def test_sums_are_made_by_few_tasks(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    parts = 2 * cores + 3
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 400, 60)) for _ in range(3 * parts)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(parts)
    seen, gram_times = [], d.gram_times

    def watched(placed, idf, q):
        seen.append(_tasks(placed))
        got, want = gram_times(placed, idf, q), gram_times(written, idf, q)
        assert got[2] == want[2] == 3 * len(texts)
        assert np.allclose(got[0], want[0], rtol=1e-4, atol=1e-3) and np.allclose(got[1], want[1], rtol=1e-4, atol=1e-4)
        return got

    monkeypatch.setattr(d, "gram_times", watched)
    old = spark.conf.get(KEY)
    spark.conf.set(KEY, "1k")
    try:
        written = d.written_places(docs)
        assert _tasks(written) >= parts
        d.fit(written, d.Settings(rank=4))
        assert len(seen) == 2 and max(seen) <= cores
        # many words are not crowded into as few tasks
        monkeypatch.setattr(d, "FIT_WORDS", 60)
        seen.clear()
        d.fit(written, d.Settings(rank=4))
        assert min(seen) > cores
    finally:
        spark.conf.set(KEY, old)
