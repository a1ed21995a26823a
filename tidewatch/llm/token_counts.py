"""Token counts by merging byte pairs with a heap over a linked list.

A word starts as the linked list of its symbols. A heap holds the adjacent pairs
that have a merge, by rank and place. The lowest pair is popped; if both ends are
still what they were, they become one piece and the new pairs with its neighbours
are pushed. The number of tokens is the number of symbols less the number of merges,
so no identifiers are made.

Defined results: null text is the empty text (0 bytes, 0 tokens); repeated rows give
repeated results; a null doc_id stays null; an empty table gives no rows; only the id
and text columns are read, so other columns never clash.
"""

from __future__ import annotations

from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, text_of, white_chunks
from .word_bpe import WordBpe, symbols, words


class Counter:
    def __init__(self, raw: bytes):
        self.bpe = WordBpe(raw)
        self.of_word = Memo(self._count_word)
        self.of_chunk = Memo(self._count_chunk)

    def merges(self, piece: list[int]) -> int:
        """How many merges a word's symbols undergo (``piece`` is used up)."""
        merge_of, n = self.bpe.merge_of, len(piece)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        # the piece that a pair makes is its rank; -1 marks a place merged away
        heap = [(made, i) for i in range(n - 1)
                if (made := merge_of.get((piece[i], piece[i + 1]))) is not None]
        heapify(heap)
        done = 0
        while heap:
            made, i = heappop(heap)
            j = after[i]
            if piece[i] < 0 or j >= n or merge_of.get((piece[i], piece[j])) != made:
                continue
            done += 1
            piece[i], piece[j] = made, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                right = merge_of.get((made, piece[k]))
                if right is not None:
                    heappush(heap, (right, i))
            h = before[i]
            if h >= 0:
                left = merge_of.get((piece[h], made))
                if left is not None:
                    heappush(heap, (left, h))
        return done

    def _count_word(self, word: str) -> int:
        piece = symbols(word)
        return len(piece) - self.merges(piece)

    def _count_chunk(self, chunk: str) -> int:
        special, of_word = self.bpe.special, self.of_word
        return sum(1 if part in special else sum(map(of_word.__getitem__, words(part)))
                   for part in self.bpe.parts_of(chunk))

    def count(self, text: str) -> int:
        return sum(map(self.of_chunk.__getitem__, white_chunks(text)))


@lru_cache(maxsize=2)
def counter(raw: bytes) -> Counter:
    """One counter per Python worker and vocabulary."""
    return Counter(raw)


def count_tokens(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every text, and whether the tokens exceed ``limit``.

    ``path`` names the vocabulary file on the driver, which ships its few MB to the
    tasks.
    """
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        count = counter(shared.value).count
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                n = [count(text) for text in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())],
                                                 names=["doc_id", "n_bytes", "n_tokens"])

    slim = docs.select(docs[id_col].cast("bigint").alias("doc_id"),
                       F.octet_length(text_of(text_col)).cast("bigint").alias("n_bytes"),
                       text_of(text_col).alias("text"))
    counted = slim.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
