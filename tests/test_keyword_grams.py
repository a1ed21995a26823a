"""Texts meet the keyword index by the grams that keywords have, not by all of their own."""

import random

import pyarrow as pa

from tidewatch.operators import tagging


class _Known:
    def __init__(self, value):
        self.value = value


def _known(words):
    import numpy as np
    known = {}
    for w in words:
        places = known.setdefault(len(w), np.zeros(1 << tagging._FOLD, bool))
        places[tagging._folded(int.from_bytes(w, "little") | len(w) << 8 * tagging.GRAM)] = True
    return known


def test_only_known_grams_come_out(spark, monkeypatch):
    rng = random.Random(2)
    words = [b"ab", b"c", b"abcab", bytes([0xC3, 0xA9]), b"ccccbb"]
    texts = [bytes(rng.choices(b"abcd\xc3\xa9", k=rng.randrange(0, 60))) for _ in range(200)] + [b"", b"a"]
    monkeypatch.setattr(tagging, "_PIECE", 16)  # grams cross pieces, never texts
    run = tagging._text_grams(_Known(_known(words))).func
    want = [sorted(int.from_bytes(w, "little") | len(w) << 8 * tagging.GRAM for w in words if w in t) for t in texts]
    for at in (0, 3):  # a slice of a batch too
        got = run(pa.array(texts, pa.binary()).slice(at)).to_pylist()
        assert [sorted(set(g) & {x for w in want for x in w}) for g in got] == want[at:]
        assert sum(map(len, got)) <= 1.1 * sum(map(len, want[at:])) + 5
    assert run(pa.array([], pa.binary())).to_pylist() == []
    assert tagging._text_grams(_Known({})).func(pa.array(texts, pa.binary())).to_pylist() == [[]] * len(texts)


def test_no_function_over_characters(spark):
    df = spark.createDataFrame([("t", "some content here")], "title string, content string")
    kw = spark.createDataFrame([("content",), ("ab",)], "keyword string")
    out = tagging.match_keyword_table(df, kw)
    assert "lambdafunction" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [r.keyword for r in out.collect()] == ["content"]
