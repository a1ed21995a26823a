"""Language identification: sparse multinomial logistic regression.

Features are character 1- to 3-grams of the lower-cased text, with every run of
non-letters as one blank, hashed to ``2 ** BITS`` places and weighted by TF-IDF
(1 + ln count, times ln((1 + n) / (1 + df)) + 1, scaled to length one). The document
frequencies are counted over every training document in Spark.

Training is follow-the-regularised-leader (per-coordinate, proximal) with elastic-net
penalties: L1 sets weights of useless n-grams to exactly zero, L2 shrinks the rest.
It runs over a bounded sample: about ``per_label`` documents of each label (all of a
rarer label), taken by a hash of the id, so neither a hot label nor the corpus size
changes its cost. A fifth of the sample is kept from training and fits a temperature
that calibrates the scores.

Prediction reads the text alone.

Defined results: ``und`` with score 0 where the text is null or has no letter; ties
between labels go to the first in alphabetical order; a null id counts as not held out;
with no labelled text at all every prediction is ``und``; with one label it is that
label with score 1; repeated rows give repeated results; only the id, text and label
columns are read, so other columns never clash.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 14
SIZE = 1 << BITS
UND = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)])


def grams(text: str) -> np.ndarray | None:
    """Counts of the hashed n-grams; None without a letter. The text is read in blocks,
    so a very long one takes no more memory; a block overlaps the next by an n-gram."""
    total, blank = np.zeros(SIZE, np.int64), np.array([32], np.uint64)
    tail, seen = blank, False
    for at in range(0, len(text), 1 << 20):
        codes = np.frombuffer(text[at:at + (1 << 20)].lower().encode("utf-32-le", "replace"), np.uint32)
        is_letter = _letters()[codes]
        seen = seen or bool(is_letter.any())
        codes = np.where(is_letter, codes, 32).astype(np.uint64)
        last = at + (1 << 20) >= len(text)
        c = np.concatenate([tail, codes, blank] if last else [tail, codes])
        keep = np.ones(len(c), bool)
        keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
        c, new = c[keep], 0 if at == 0 else len(tail)
        total += _count(c, new)
        tail = c[-2:]
    return total if seen else None


def _count(c: np.ndarray, new: int) -> np.ndarray:
    """N-grams that end at place ``new`` or later."""
    places = []
    h = np.zeros(len(c), np.uint64)
    for n in (1, 2, 3):
        if len(c) < n:
            break
        # n-grams by their start; multiplicative hash, high bits
        h = (h[:len(c) - n + 1] * np.uint64(0x100000001B3) + c[n - 1:] + np.uint64(n)) & np.uint64(0xFFFFFFFFFFFF)
        mixed = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
        places.append(mixed[max(0, new - n + 1):])
    return np.bincount(np.concatenate(places).astype(np.int64), minlength=SIZE)


def vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places and values of a document's scaled TF-IDF vector."""
    at = np.flatnonzero(counts)
    x = (1 + np.log(counts[at])) * idf[at]
    return at.astype(np.int32), (x / np.linalg.norm(x)).astype(np.float32)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Ftrl:
    """Follow-the-regularised-leader for multinomial logistic regression."""

    size: int
    labels: int
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1

    def __post_init__(self):
        self.z = np.zeros((self.size, self.labels))
        self.n = np.zeros((self.size, self.labels))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = softmax(x @ w)
        error[label] -= 1
        g = np.outer(x, error)
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits that minimises the log loss (golden-section search
    over its logarithm)."""
    def loss(t: float) -> float:
        p = softmax(z / np.exp(t))[np.arange(len(y)), y]
        return -float(np.log(np.maximum(p, 1e-12)).mean())

    a, b, r = -4.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str) -> tuple[str, float]:
        counts = grams(text) if self.labels else None
        if counts is None:
            return UND, 0.0
        at, x = vector(counts, self.idf)
        p = softmax(x @ self.weights[at] / self.temperature)
        k = int(p.argmax())
        return self.labels[k], float(p[k])


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Documents with letters, and in how many of them each hashed n-gram is. A task
    sends at most one number per place."""
    def run(batches):
        n, df = 0, np.zeros(SIZE, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts = grams(text)
                if counts is not None:
                    n += 1
                    df += counts > 0
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))],
                                         names=["place", "n"])

    rows = texts.select("text").mapInArrow(run, "place bigint, n bigint").groupBy("place").agg(
        F.sum("n").alias("n")).collect()  # at most SIZE + 1 rows
    df, n = np.zeros(SIZE, np.int64), 0
    for place, count in rows:
        if place < 0:
            n = count
        else:
            df[place] = count
    return n, df


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
          per_label: int = 800, epochs: int = 3) -> Model:
    """Learn from the rows with a text and a label. ``per_label`` bounds the expected
    number of documents of each label that the classifier is fitted on; document
    frequencies come from all rows."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(label_col).alias("label")).filter("text is not null and label is not null")
    label_rows = dict(rows.groupBy("label").count().collect())
    labels = sorted(label_rows)
    if not labels:
        return Model([], np.zeros(SIZE), np.zeros((SIZE, 0)), 1.0)
    n, df = document_frequencies(rows)
    idf = np.log((1 + n) / (1 + df)) + 1

    # a hash of id and text in [0, 1), so that many rows of one id don't go together
    at = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for k in labels for x in (k, min(1.0, per_label / label_rows[k]))])
    sample = rows.withColumn("at", at).filter(F.col("at") < share[F.col("label")])

    def vectors(batches):
        for whole in batches:
            for begin in range(0, whole.num_rows, 64):
                batch = whole.slice(begin, 64)
                made = [(order, label, *(v.tobytes() for v in vector(counts, idf)))
                        for text, label, order in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
                        if (counts := grams(text)) is not None]
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made, strict=True)],
                                                     names=["at", "label", "places", "x"])

    # bounded by per_label rows a label of at most SIZE entries each
    got = (sample.select("text", "label", F.xxhash64(F.lit(7), "id", "text").alias("at"))
           .mapInArrow(vectors, "at bigint, label string, places binary, x binary").collect())
    got.sort(key=lambda r: (r["at"], r["label"], r["places"]))
    known = {k: i for i, k in enumerate(labels)}
    data = [(np.frombuffer(r["places"], np.int32), np.frombuffer(r["x"], np.float32).astype(float),
             known[r["label"]]) for r in got]
    fit = [d for i, d in enumerate(data) if i % 5]
    model = Ftrl(SIZE, len(labels))
    for _ in range(epochs):
        for places, x, y in fit:
            model.learn(places, x, y)
    w = model.weights().astype(np.float64)
    check = data[::5] if len(data) >= 50 else []
    t = 1.0
    if check and len(labels) > 1:
        t = temperature(np.array([x @ w[places] for places, x, _ in check]),
                        np.array([y for _, _, y in check]))
    return Model(labels, idf, w, t)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row. The model has a fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            told = [shared.value.predict(t or "") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([t[0] for t in told], pa.string()),
                 pa.array([t[1] for t in told], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")
