"""The word-ending BPE vocabulary: its file, its pieces and how texts split into words.

The file is the tokenizers JSON of a BPE model with an end-of-word suffix. A text
is cut at its special strings, each part is NFC-normalised and lower-cased, words
are the matches of a fixed pattern, and a word is the sequence of its UTF-8 bytes
of which the last one is marked as the word's end. Every piece is therefore a
sequence over 512 symbols: 256 bytes inside a word and 256 at its end.

Pieces are numbered by the order they come to be: symbols 0..511, then one piece
per merge, so a smaller number means an earlier merge.
"""

from __future__ import annotations

import json
from functools import lru_cache

import regex

SYMBOLS = 512

# fixed value: the vocabulary's word pattern
_STOPS = (".", ",")
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
LIBRARY_WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Latin letters without combining marks: composed already, and of the same classes in every
# version of Unicode. Beyond these the tables of Python and of the library may differ.
PLAIN = regex.compile(r"[\x00-\u024f]*")


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte:
    printable Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


class WordBpe:
    """Parsed vocabulary.

    ``ids[p]`` is the identifier of piece ``p``, ``parts[p]`` the two pieces it is
    merged from (None for a symbol), ``merge_of[(l, r)]`` the piece of a pair.
    """

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        if model["type"] != "BPE" or not suffix:
            raise ValueError("a BPE vocabulary with an end-of-word suffix is needed")
        vocab = model["vocab"]
        letters = byte_letters()
        names = letters + [x + suffix for x in letters]
        self.suffix = suffix
        piece = {name: p for p, name in enumerate(names)}
        self.ids = [vocab[name] for name in names]
        self.parts: list[tuple[int, int] | None] = [None] * SYMBOLS
        self.merge_of: dict[tuple[int, int], int] = {}
        self.names = list(names)
        for pair in model["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            name, p = left + right, len(self.parts)
            if name in piece:
                raise ValueError(f"two merges make {name!r}")
            both = piece[left], piece[right]
            piece[name] = self.merge_of[both] = p
            self.parts.append(both)
            self.ids.append(vocab[name])
            self.names.append(name)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of_id = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        cut = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self._cut = regex.compile(f"({cut})") if cut else None

    def parts_of(self, text: str) -> list[str]:
        """The text cut at special strings, which are items of their own."""
        return [x for x in self._cut.split(text) if x] if self._cut and "<" in text else [text]


@lru_cache(maxsize=1)
def library_splitter():
    """The library's own normaliser and word pattern, for texts that are not plain."""
    from tokenizers import Regex
    from tokenizers.normalizers import NFC, Lowercase, Replace, Sequence
    from tokenizers.pre_tokenizers import Split

    return (Sequence([NFC(), Replace(Regex(r"\s+"), " "), Lowercase()]),
            Split(Regex(LIBRARY_WORD), "removed", invert=True))


def words(part: str) -> list[str]:
    """The words of a part without special strings and white space."""
    if not part.isascii() and not PLAIN.fullmatch(part):
        normaliser, split = library_splitter()
        return [w for w, _ in split.pre_tokenize_str(normaliser.normalize_str(part))]
    part = part.lower()
    # the two common cases, without the pattern: letters, letters and a stop
    if part.isalpha():
        return [part]
    if part[-1:] in _STOPS and part[:-1].isalpha():
        return [part[:-1], part[-1]]
    return WORD.findall(part)


def symbols(word: str) -> list[int]:
    """The symbols of a word: its bytes, the last one marked as an end."""
    out = list(word.encode("utf-8", "replace"))
    out[-1] += 256
    return out
