"""Words, ids and counts as the library gives them, for every code point and orders of marks."""

import random
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tidewatch.llm.bpe_codec import Codec
from tidewatch.llm.common import white_chunks
from tidewatch.llm.token_output import LibraryEncoder
from tidewatch.llm.word_bpe import WordBpe, words


@pytest.fixture(scope="module")
def raw():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(raw):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(raw.decode())
    t.no_truncation()
    t.no_padding()
    return t


def texts():
    """Every code point between and behind others; marks in two orders and behind letters."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    yield from ("".join(f"a{c}b 1{c} {c}́ " for c in points[i:i + 300]) for i in range(0, len(points), 300))
    rng = random.Random(1)
    marks = [c for c in points if unicodedata.category(c)[0] == "M" or unicodedata.category(c) == "Cn" and ord(c) < 0x20000]
    pairs = [(rng.choice("aeiouΣσkẛ가ᄀ"), rng.choice(marks), rng.choice(marks)) for _ in range(10_000)]
    pairs += [("a", "࣐", "̀"), ("", "̀", "᷷"), ("Σ", "ͅ", "́"), ("s", "̣", "̇")]
    yield from (" ".join(f"{x}{m}{n} {m}{n}{x}" for x, m, n in pairs[i:i + 300]) for i in range(0, len(pairs), 300))


def test_words_of_every_code_point_and_order_of_marks(library, raw):
    whole, bpe = list(texts()), WordBpe(raw)
    want = [len(e.ids) for e in library.encode_batch(whole, add_special_tokens=False)]
    spell = library.pre_tokenizer.pre_tokenize_str
    for text in whole[::40]:
        mine = [w for chunk in white_chunks(text) for w in words(chunk)]
        assert [w for w, _ in spell(library.normalizer.normalize_str(text))] == [
            bpe_spelled(w) for w in mine]
    encoder = LibraryEncoder(raw)
    ids, n = encoder.encode_column(pa.array(whole))
    assert n.tolist() == want
    assert ids.tolist() == [i for e in library.encode_batch(whole, add_special_tokens=False) for i in e.ids]


def bpe_spelled(word):
    from tidewatch.llm.word_bpe import byte_letters

    letters = byte_letters()
    return "".join(letters[b] for b in word.encode())


def test_codec_on_odd_texts(library, raw):
    codec = Codec(raw)
    for text in [t for i, t in enumerate(texts()) if i % 120 == 7] + ["", "<|endoftext|>a<|startoftext|>", "౜" * 50]:
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
