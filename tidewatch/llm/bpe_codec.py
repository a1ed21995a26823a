"""BPE encoding by backtracking over longest matches, decoding by an offset table.

Encoding. An Aho-Corasick automaton over the vocabulary's pieces finds every piece
that occurs in a word, in one pass. The encoder takes the longest piece at each
position that may follow the piece before it; where none may, it gives back that
piece and goes on with the next shorter one. A position once found to be a dead end
is never entered again, so the work is linear in the word's length. Two pieces may
follow each other if merging their joined symbols in rank order yields exactly the
two; that is read off the pair-compatibility table. A sequence whose neighbours are
all compatible is the one that merging the whole word yields, so the result is exact.

Decoding. All piece texts lie in one byte buffer; an offset table gives each id its
slice, and a document is gathered from the buffer with array operations.

Words repeat, so a bounded memo keeps the ids of recent words and white-space runs.

Defined results: null text is the empty text (no ids, empty decoded text); repeated
rows give repeated results; a null doc_id stays null; an empty table gives no rows;
only the id and text columns are read, so other columns never clash.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Memo, text_of, white_chunks
from .word_bpe import SYMBOLS, WordBpe, symbols, words

_BASE = 0x100  # symbols as characters, clear of NUL


class PairTable:
    """Whether two pieces can stand next to each other in an encoding.

    Only pairs that occur are computed; the table holds at most ``limit`` of them.
    """

    def __init__(self, bpe: WordBpe, limit: int = 150_000):
        self.bpe, self.limit, self.known = bpe, limit, {}

    def __call__(self, left: int, right: int) -> bool:
        key = left << 32 | right
        ok = self.known.get(key)
        if ok is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            ok = self.known[key] = not self.crossed(left, right, len(self.bpe.parts))
        return ok

    def crossed(self, left: int, right: int, until: int) -> bool:
        """Does merging, up to but without merge ``until``, join the two sides?

        Walks back in time: of the two pieces at the border the later one is undone.
        A border pair that has a merge would have been merged if the merge comes
        before either piece is used up; equal merges go from left to right, so the
        right piece's own merge comes after a border merge of the same rank.
        """
        parts, merge_of = self.bpe.parts, self.bpe.merge_of
        left_used = right_used = until
        while True:
            joined = merge_of.get((left, right))
            if joined is not None and joined < left_used and (joined < right_used
                                                              or joined == right_used != until):
                return True
            if left > right and parts[left]:
                left_used, left = left, parts[left][1]
            elif parts[right]:
                right_used, right = right, parts[right][0]
            else:
                return False


class Codec:
    def __init__(self, raw: bytes):
        import ahocorasick

        self.bpe = bpe = WordBpe(raw)
        self.may_follow = PairTable(bpe)
        # pieces that merging can reach, with their symbols
        spelled: list[str | None] = [chr(_BASE + s) for s in range(SYMBOLS)]
        for p in range(SYMBOLS, len(bpe.parts)):
            left, right = bpe.parts[p]
            whole = spelled[left] and spelled[right] and not self.may_follow.crossed(left, right, p)
            spelled.append(spelled[left] + spelled[right] if whole else None)
        self.find = ahocorasick.Automaton()
        for p, spelling in enumerate(spelled):
            if spelling:
                self.find.add_word(spelling, (p, len(spelling)))
        self.find.make_automaton()
        self.of_word = Memo(self._encode_word, limit=150_000)
        self.of_chunk = Memo(self._encode_chunk, limit=100_000)
        self._offsets()

    # -- encoding -----------------------------------------------------------------

    def pieces(self, word: str) -> list[int]:
        """The pieces of one word."""
        text = "".join([chr(_BASE + s) for s in symbols(word)])
        n = len(text)
        at: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, hit in self.find.iter(text):  # shorter pieces of a start come first
            at[end + 1 - hit[1]].append(hit)
        may_follow, dead = self.may_follow, bytearray(n + 1)
        taken: list[tuple[int, int, int]] = []  # piece, its length, its place among the choices
        pos, k = 0, len(at[0]) - 1
        while pos < n:
            while k >= 0:
                piece, length = at[pos][k]
                if not dead[pos + length] and (not taken or may_follow(taken[-1][0], piece)):
                    break
                k -= 1
            if k >= 0:
                taken.append((piece, length, k))
                pos += length
                k = len(at[pos]) - 1 if pos < n else 0
            else:
                dead[pos] = 1
                _, length, k = taken.pop()
                pos -= length
                k -= 1
        return [t[0] for t in taken]

    def _encode_word(self, word: str) -> bytes:
        ids = self.bpe.ids
        return np.array([ids[p] for p in self.pieces(word)], "<u4").tobytes()

    def _encode_chunk(self, chunk: str) -> bytes:
        special, of_word = self.bpe.special, self.of_word
        out = []
        for part in self.bpe.parts_of(chunk):
            if part in special:
                out.append(special[part].to_bytes(4, "little"))
            else:
                out.extend(map(of_word.__getitem__, words(part)))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.of_chunk.__getitem__, white_chunks(text)))

    # -- decoding -----------------------------------------------------------------

    def _offsets(self) -> None:
        texts = self.bpe.text_of_id
        pieces = [texts.get(i, "").encode() + b" " for i in range(max(texts) + 1)]
        self.buffer = np.frombuffer(b"".join(pieces), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(x) for x in pieces])]).astype(np.int64)

    def decode(self, ids: np.ndarray, block: int = 1 << 20) -> bytes:
        """The pieces' texts in UTF-8 with one space between."""
        out = []
        for at in range(0, len(ids), block):
            part = ids[at:at + block]
            begin = self.offsets[part]
            length = self.offsets[part + 1] - begin
            first = np.cumsum(length) - length
            out.append(self.buffer[np.repeat(begin - first, length)
                                   + np.arange(int(length.sum()))].tobytes())
        return b"".join(out)[:-1]


@lru_cache(maxsize=2)
def codec(raw: bytes) -> Codec:
    """One codec per Python worker and vocabulary."""
    return Codec(raw)


RESULT = ("doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
          "ids binary, decoded string")


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  keep: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """Encode every text and decode the ids again.

    ``path`` names the vocabulary file on the driver, which ships its few MB to the
    tasks. Gives id, number of ids, digests of the ids (little-endian 32-bit) and of
    the decoded text, and of ``ids`` (binary) and ``decoded`` those in ``keep``.
    """
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *keep]
    schema = ", ".join(x for x in RESULT.split(", ") if x.split(" ")[0] in names)

    def run(batches):
        code = codec(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows = {n: [] for n in names[1:]}
                for text in batch.column(1).to_pylist():
                    raw = code.encode(text)
                    ids = np.frombuffer(raw, "<u4").astype(np.int64)
                    decoded = code.decode(ids)
                    rows["n_tokens"].append(len(ids))
                    rows["ids_sha256"].append(hashlib.sha256(raw).hexdigest())
                    rows["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
                    if "ids" in keep:
                        rows["ids"].append(raw)
                    if "decoded" in keep:
                        rows["decoded"].append(decoded.decode())
                arrays = {"doc_id": batch.column(0), **rows}
                kinds = {"n_tokens": pa.int64(), "ids": pa.binary()}
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0) if n == "doc_id" else pa.array(arrays[n], kinds.get(n, pa.string()))
                     for n in schema_names], names=schema_names)

    schema_names = [x.split(" ")[0] for x in schema.split(", ")]
    slim = docs.select(docs[id_col].cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    return slim.mapInArrow(run, schema)
