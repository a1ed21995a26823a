"""Runs of letters are encoded by their word, which many runs share, as the library does it."""

import random
import re

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from tidewatch.llm import token_output
from tidewatch.llm.word_bpe import words

RUNS = ["tea", "Tea", "TEA", "tea,", "Tea.", "TEA.", "straße", "ÉTÉ.", "Ÿ,", "İi", "ŉa.", "ſ", "tea.,", "tea..", ".",
        ",", "tea's", "a1", "naı̈ve", "<|endoftext|>", "a<|endoftext|>.", "чай.", "x" * 90 + ".", "ＴＥＡ,"]


def _library():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        raw = f.read()
    from tokenizers import Tokenizer

    return raw, Tokenizer.from_str(raw.decode())


def test_letters_are_lowered_as_python_does():
    letters = [chr(c) for c in range(0x250) if re.match(token_output._LETTERS, chr(c))]
    assert len(letters) > 200
    assert pc.utf8_lower(pa.array(letters)).to_pylist() == [x.lower() for x in letters]
    assert all(words(x) == [x.lower()] for x in letters)


def test_runs_that_share_a_word_are_learnt_once(monkeypatch):
    monkeypatch.setattr(token_output, "ASKED", 3)
    raw, library = _library()
    encoder = token_output.LibraryEncoder(raw)
    rng = random.Random(2)
    texts = ["", " "] + [" ".join(rng.choices(RUNS, k=rng.randrange(1, 40))) for _ in range(200)]
    for _ in range(2):
        ids, n = encoder.encode_column(pa.array(texts))
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert n.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]
    assert "tea" in encoder.words.young
    assert not {"tea", "Tea", "TEA", "tea,", "Tea.", "TEA.", "straße", "ÉTÉ."} & set(encoder.runs.young)
