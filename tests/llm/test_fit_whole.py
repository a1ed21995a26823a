"""The latent model of op2 and the pipeline is fitted on every passage."""

import numpy as np

from tidewatch.llm import decontaminate as d


def _plain(texts, idf, q):
    rows = []
    for t in texts:
        at = d.places(d.word_hashes(t))
        for i in range(0, len(at), d.STRIDE):
            p = at[i:i + d.WINDOW]
            if len(p) >= d.WINDOW // 2:
                row = np.zeros(d.SIZE)
                np.add.at(row, p, 1)
                rows.append(row * idf / np.linalg.norm(row * idf))
    a = np.array(rows)
    return a.T @ (a @ q), a.sum(0), len(a)


def test_every_passage_counts_once(spark, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.5, n) % 500) for n in (0, 1, 15, 16, 17, 31, 32, 33, 48, 700, 5000, 16)]
    monkeypatch.setattr(d, "BLOCK_WORDS", 1024)
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    placed = d.written_places(frame)
    idf = d.document_frequencies(placed)
    q = rng.standard_normal((d.SIZE, 5))
    product, sums, n = d.gram_times(placed, idf, q)
    want, columns, rows = _plain(texts, idf, q)
    assert n == rows > 300
    assert np.allclose(product, want, rtol=1e-4, atol=1e-3) and np.allclose(sums, columns, rtol=1e-4, atol=1e-4)
    assert not hasattr(d, "sample_passages") and not hasattr(d.Settings(), "fit_passages")
