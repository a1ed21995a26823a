"""Array versions of op7's units and op2's sums equal the plain ones."""

import random

import numpy as np

from tidewatch.llm import decontaminate, unit_dedup


def _plain(text):
    return [x for begin, end in unit_dedup._sentences(text) for x in unit_dedup._parts(text, begin, end)]


def test_units_of_a_batch_equal_plain_units():
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab c. !?\n\t  é가😀İΣσ_9 \x1c\x85'Ab", k=rng.randrange(0, 120))) for _ in range(2000)]
    words = ["a", "bb", "Cc", "ddé", "e.", "f\n", "G!", "w1", "x" * 70]
    texts += [" ".join(rng.choices(words, k=rng.randrange(0, 200))) for _ in range(300)] + ["", "\n", "end."]
    place, table, norms = unit_dedup.unit_arrays(texts)
    got = [[] for _ in texts]
    for i, row, norm in zip(place.tolist(), table.tolist(), norms, strict=True):
        got[i].append((*row, norm.decode()))
    assert got == [_plain(t) for t in texts]
    assert max(map(len, got)) > 10
    assert [len(x) for x in unit_dedup.unit_arrays([])] == [0, 0, 0]


def test_sums_by_block_and_by_place():
    rng = np.random.default_rng(5)
    rows = rng.standard_normal((decontaminate.SIZE + 1, 7)).astype(np.float32)
    words = np.minimum(rng.zipf(1.3, (700, decontaminate.STRIDE)), decontaminate.SIZE).astype(np.int16)
    y = rng.standard_normal((700, 7)).astype(np.float32)
    sums = decontaminate.block_sums(rows, words, step=64)
    assert np.allclose(sums, rows[words].sum(1), atol=1e-4)
    total, want = np.zeros((decontaminate.SIZE, 7)), np.zeros((decontaminate.SIZE + 1, 7))
    decontaminate.add_by_place(total, words, y)
    np.add.at(want, words, y[:, None, :].astype(float))
    assert np.allclose(total, want[:-1], atol=1e-3)
    decontaminate.add_by_place(total, np.full((2, decontaminate.STRIDE), decontaminate.SIZE, np.int16), y[:2])
    assert np.allclose(total, want[:-1], atol=1e-3)
