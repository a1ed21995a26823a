"""Brute force and round trips for the parts that need no Spark."""

import random
from collections import Counter as Bag

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewatch.llm import chat_format, decontaminate, lang_id, simhash, unit_dedup
from tidewatch.llm.bpe_codec import codec
from tidewatch.llm.common import Memo
from tidewatch.llm.token_counts import counter
from tidewatch.llm.token_output import LibraryEncoder, library_encoder, slices

PATH = P.path("word_bpe_49k.json")
PIECES = ["a", "b", "the", "The", "ing", " ", "  ", "\n", "é", "é", "ß", "Σ", "ΑΣ", "İ", "漢", "한", "12", "²", "½",
          "_", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "<|end", "\x00", "\x1c", "\x85", "\xa0", "😀", "...", "$$",
          "aaaa", "ﬁ", "don't", ".,", "x,"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def raw():
    with open(PATH, "rb") as f:
        return f.read()


def texts():
    rng = random.Random(5)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    return [*made, "", "a" * 3000, "the" * 2000, "!" * 2000, "".join(rng.choice("abcdeths") for _ in range(9000))]


def test_bpe_equals_the_library(library, raw):
    code, count, encoder = codec(raw), counter(raw).count, library_encoder(raw)
    data = texts()
    for text, got in zip(data, library.encode_batch(data, add_special_tokens=False), strict=True):
        ids = np.frombuffer(code.encode(text), "<u4").astype(np.int64)
        assert ids.tolist() == got.ids, text
        assert code.decode(ids).decode() == library.decode(got.ids, skip_special_tokens=False)
        assert code.decode(ids, block=7) == code.decode(ids) if len(ids) <= 7 else True
        assert count(text) == len(got.ids)
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == got.ids


def test_column_encoder_with_small_memo(library, raw):
    """Whole columns, with memos that turn over all the time, and long runs."""
    encoder, data = LibraryEncoder(raw, limit=40), texts()
    want = [x.ids for x in library.encode_batch(data, add_special_tokens=False)]
    got = []
    for i in range(0, len(data), 64):
        ids, n = encoder.encode_column(pa.array(["skipped", *data[i:i + 64]]).slice(1))
        got += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
        assert all(len(key) <= 64 for kept in (encoder.runs, encoder.words) for key in kept.young)
        assert len(encoder.runs.young) < 40 and len(encoder.words.young) < 40
    assert got == want
    assert encoder.encode([]) == [] and encoder.encode([" \n"]) == [b""]


@pytest.mark.parametrize("most", [1, 5, 1000])
def test_slices_hold_every_row_once(most):
    batch = pa.RecordBatch.from_pydict({"text": ["", "aaaa", "b" * 50, "", "c", "漢漢"]})
    cut = list(slices(batch, 0, most))
    assert [x for b in cut for x in b.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(b.num_rows == 1 or sum(len(x.encode()) for x in b.column(0).to_pylist()) <= most for b in cut)


def test_memo_is_bounded_and_right():
    asked = []
    memo = Memo(lambda k: asked.append(k) or len(k), limit=10, max_key=5)
    for _ in range(3):
        for i in range(50):
            assert memo["x" * (i % 8) + str(i)] == len("x" * (i % 8) + str(i))
    assert len(memo) <= 10 and len(memo.old) <= 10


control = st.sampled_from(["[INST]", "[/INST]", "</s>", "<s>", "[OUT] ", "[SYS]", " [/SYS]", "[ROLE] ", " [AS] ", "\\",
                           "[\\INST]", "<\\/s>", "[", "<", " ", "\n", "x", "é", "😀"])
messy = st.lists(control, max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), messy), messy), max_size=5))
def test_chat_round_trip(turns):
    made = [chat_format.format_turn(r, t) for r, t in turns]
    whole = "".join(m[0] for m in made)
    assert [(r, t) for r, t, _, _ in chat_format.parse(whole)] == turns
    for (_, text), (segment, begin, end, _) in zip(turns, made, strict=True):
        assert chat_format.unescape(segment[begin:end]) == text or chat_format.escape(text) != segment[begin:end]


def test_chat_escapes_only_when_needed():
    assert chat_format.format_turn("user", "plain [text]")[3] is False
    assert chat_format.format_turn("user", "</s>[INST] ok [/INST]")[3] is True
    with pytest.raises(chat_format.Unparsable):
        chat_format.parse("no turn")


def test_fingerprint_against_plain_bits():
    from xxhash import xxh64_intdigest
    rng = random.Random(2)
    for _ in range(60):
        text = " ".join(rng.choice(["A", "é", "the", "x\x0by", "Of"]) for _ in range(rng.randint(0, 40)))
        words = [w for w in "".join(c.lower() if c.isascii() else c for c in text).replace("\x0b", " ").split(" ") if w]
        shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
        h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert simhash.fingerprint(text) == want
        assert simhash.fingerprint(text, block=3) == want


def test_allocation_is_the_least_cost():
    from itertools import product
    rng = random.Random(3)
    for parts in (2, 3, 4):
        costs = [[0.0, *sorted(rng.random() * 100 for _ in range(5))] for _ in range(parts)]
        total, chosen = simhash.allocate(costs, 4)
        best = min(sum(c[k] for c, k in zip(costs, ks, strict=True))
                   for ks in product(range(6), repeat=parts) if sum(ks) == 5)
        assert abs(total - best) < 1e-9 and sum(t + 1 for t in chosen) == 5


def test_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.randint(0, 6) for _ in range(rng.randint(1, 20))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        p = decontaminate.Passage(1, np.array(a), frozenset())
        assert decontaminate.common_length(p.masks, len(a), b) == table[-1][-1]


def test_word_hashes_do_not_depend_on_chunks():
    text = ("Tea, for two; été " * 9000) + "z" * 70000 + " end"
    h = decontaminate.word_hashes(text)
    one = {w: int(decontaminate.word_hashes(w)[0]) for w in ("tea", "for", "two", "été", "end")}
    assert h[:4].tolist() == [one[w] for w in ("tea", "for", "two", "été")] and h[-1] == one["end"]
    assert Bag(h.tolist())[one["été"]] == 9000
    assert len(decontaminate.word_hashes("")) == len(decontaminate.word_hashes(" ,. ")) == 0


def test_grams_do_not_depend_on_blocks():
    text = "ab c1d " * 200000
    assert lang_id.grams(text).sum() == sum(len(" ab c d " + "ab c d " * 199999) - k for k in range(3))
    assert lang_id.grams("12 !") is None and lang_id.grams("") is None


def test_ftrl_learns_sparse_weights():
    rng = np.random.default_rng(0)
    model = lang_id.Ftrl(50, 2, l1=0.5)
    for _ in range(400):
        y = int(rng.integers(2))
        at = np.array([y, 2 + int(rng.integers(48))])
        model.learn(at, np.array([1.0, 0.2]), y)
    w = model.weights()
    assert w[0, 0] > w[0, 1] and w[1, 1] > w[1, 0] and (w == 0).mean() > 0.3
    z = rng.standard_normal((500, 2)) * 10
    y = np.array([rng.random() < lang_id.softmax(r / 4)[1] for r in z]).astype(int)
    assert 2.5 < lang_id.temperature(z, y) < 6.5


def test_units_cover_their_offsets():
    text = "One two. Three!\n\n Four?Five ...\nsix"
    for unit in ("sentence", "line", "paragraph"):
        for a, b, n, norm in unit_dedup.units(text, unit):
            assert norm == " ".join(text[a:b].lower().replace(".", " ").replace("!", " ").replace("?", " ").split()) and n
    assert [text[a:b].strip() for a, b, _, _ in unit_dedup.units(text)] == ["One two.", "Three!", "Four?Five ...", "six"]
