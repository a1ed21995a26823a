"""op2 reads a text's words once, for the fit and the search; sums and searches in groups give
what single ones give."""

import random
import re

import numpy as np
import pytest

from tidewatch.llm import decontaminate as d


def test_texts_hashed_together_equal_single_ones(monkeypatch):
    monkeypatch.setattr(d, "_TOGETHER", 300)
    rng = random.Random(4)
    texts = ["", " ", ".", "a", "a b", "\0a\0\0b", "x" * 299, "y" * 300, "z " * 400, "é", "İ ß\ud800 q"]
    texts += ["".join(rng.choices("abé C1.,\n\0😀", k=rng.randrange(0, 120))) for _ in range(300)] + [""]
    assert [np.frombuffer(raw, "<u4").tolist() for raw in d.hashes_of_texts(texts)] == [
        d.word_hashes(t).tolist() for t in texts]
    assert d.hashes_of_texts([]) == []


@pytest.mark.parametrize("step", [1, 7, 500])
def test_sums_of_frequent_places_in_the_old_order(step):
    rng = np.random.default_rng(6)
    y = rng.standard_normal((600, 9)).astype(np.float32)
    counts = np.array([1, 2, 8, 9, 16, 17, 24, 128, 129, 130, 137, 255, 257, 700, 2001, 3])
    flat = rng.permutation(np.append(np.repeat(np.arange(len(counts)), counts), [d.SIZE] * 27)).astype(np.int16)
    words = np.append(flat, np.full(-len(flat) % d.STRIDE, d.SIZE, np.int16)).reshape(-1, d.STRIDE)
    got = np.zeros((d.SIZE, 9))
    d.add_by_place(got, words, y, step=step)
    order = np.argsort(words.ravel(), kind="stable")
    ends = np.cumsum(counts)
    want = np.add.reduceat(y[order // d.STRIDE], np.append(0, ends), axis=0)[:-1]
    assert got[:len(counts)].tobytes() == want.astype(float).tobytes() and not got[len(counts):].any()


def test_texts_searched_together_equal_single_ones(monkeypatch):
    monkeypatch.setattr(d, "BLOCK_WORDS", 256)
    monkeypatch.setattr(d, "SEARCHED", 16)
    rng = random.Random(8)
    draw = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    items = [draw(n) for n in (6, 20, 40, 70, 33)]
    texts = ["", "w1", items[0], draw(15), draw(16), draw(300) + " " + items[3] + " " + draw(400), items[2], draw(17)]
    texts += [draw(rng.randrange(0, 60)) + " " + rng.choice(items) + " " + draw(rng.randrange(0, 90)) for _ in range(40)]
    vectors = np.random.default_rng(1).standard_normal((d.SIZE, 24)).astype(np.float32)
    searcher = d.Searcher(vectors, [p for i, t in enumerate(items) for p in d.item_passages(i, t)], d.Settings())
    words = [d.word_hashes(t) for t in texts]
    together, single = searcher.search(words), [searcher.search([w])[0] for w in words]
    assert sum(map(len, together)) > 20
    for a, b in zip(together, single, strict=True):
        assert a.keys() == b.keys()
        for k in a:
            assert a[k][0] == b[k][0] and a[k][2:] == b[k][2:] and a[k][1] == pytest.approx(b[k][1], abs=1e-5)


def test_the_search_reads_words_and_not_texts_again(spark):
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, "other words"), (None, None), (3, text + " and more")],
                                 "doc_id bigint, text string")
    found = d.matches(docs, spark.createDataFrame([(7, text)], "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id, r.kind) for r in found.collect()} <= {(1, 7, "copy"), (3, 7, "copy")}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "words#" in plan and not re.search(r"\btext#", plan)
