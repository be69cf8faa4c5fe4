"""Exact token ids of texts through a bounded cache of parts of words.

Tokenizers of the ``word_bpe`` kind replace white space by one space, split there and drop it, so the ids of a
text are those of its white-space separated words, joined; a word is split into runs of letters, single digits and
runs of other signs before pieces are merged. Texts of plain characters are lower-cased and split into such parts at
once; of other texts each plain word is, and what remains goes to the tokenizers library word by word. Each part is
encoded when it is first seen and looked up after that. Only space, line feed, tab and carriage return separate
words here; a word that holds any other white space goes to the library as it is.
"""

from __future__ import annotations

import re
from array import array
from itertools import chain, islice

import numpy as np

#: Parts longer than this are encoded each time and not kept.
LONG_PART = 64
#: Entries of each cache; beyond that it begins anew, and the old one serves until the next time.
CACHE_SIZE = 400_000
#: Texts whose parts are looked up together.
TEXTS = 64

# Characters that no normal form changes and whose lower case is one character, whatever stands next to them.
_CHARS = "!-~¡-¬®-įı-ŷŹ-ž‐-‧‰-⁞€"
_PLAIN = re.compile(f"[{_CHARS}]*")
_PLAIN_TEXT = re.compile(f"[ \n\t\r{_CHARS}]*")
_LETTERS = "a-zªµºß-öø-ž"
_DIGITS = "0-9²³¹¼-¾"
_PART = re.compile(f"[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[^{_LETTERS}{_DIGITS} \n\t\r]+|[{_DIGITS}]")


def split_words(text: str) -> list[str]:
    """The pieces between single separators; empty ones stand between adjacent separators."""
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def _split(text: str) -> list[str]:
    """Parts of plain words, and other words whole."""
    if "<|" not in text and _PLAIN_TEXT.fullmatch(text):
        return _PART.findall(text.lower())
    out: list[str] = []
    for w in split_words(text):
        if _PLAIN.fullmatch(w) and "<|" not in w:
            out += _PART.findall(w.lower())
        else:
            out.append(w)
    return out


def is_plain(part: str) -> bool:
    """Whether the part is looked up letter by letter, and doesn't go to the library as a whole word."""
    return "<|" not in part and bool(_PLAIN.fullmatch(part))


def _byte_letters() -> list[str]:
    """The letter that byte-level models use for each byte: itself if it is printable, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordEncoder:
    """Parts' ids, kept in two generations of a cache."""

    def __init__(self, path: str, cache_size: int = CACHE_SIZE):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model  # without the steps that plain parts have behind them
        self.letters = _byte_letters()
        self.cache_size = cache_size
        self.parts: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _learn(self, missing: set[str]) -> dict[str, bytes]:
        """The ids of parts that the cache doesn't hold; those that left it last are still at hand."""
        if len(self.parts) > self.cache_size:
            self.parts, self.before = {}, self.parts
        found, other, before, tokenize = {}, [], self.before.get, self.model.tokenize
        for p in missing:
            if (known := before(p)) is not None:
                found[p] = known
            elif p.isascii():
                if "<|" in p or not _PLAIN.fullmatch(p):
                    other.append(p)
                else:
                    found[p] = array("I", [t.id for t in tokenize(p)]).tobytes()
            elif _PLAIN.fullmatch(p) and "<|" not in p:
                letters = "".join(map(self.letters.__getitem__, p.encode()))
                found[p] = array("I", [t.id for t in tokenize(letters)]).tobytes()
            else:
                other.append(p)
        if other:
            coded = self.library.encode_batch(other, add_special_tokens=False)
            found.update((p, np.array(x.ids, dtype="<u4").tobytes()) for p, x in zip(other, coded, strict=True))
        self.parts.update(found)
        for p in missing:
            if len(p) > LONG_PART:
                del self.parts[p]
        return found

    def ids(self, texts: list[str]) -> list[list[bytes]]:
        """The ids of each part of each text, little-endian unsigned 32-bit."""
        return self.coded(texts)[1]

    def coded(self, texts: list[str]) -> tuple[list[list[str]], list[list[bytes]]]:
        """The parts of each text and their ids."""
        split = list(map(_split, texts))
        flat = list(chain.from_iterable(split))
        got = list(map(self.parts.get, flat))
        if None in got:
            learned = self._learn({p for p, x in zip(flat, got, strict=True) if x is None})
            got = [learned[p] if x is None else x for p, x in zip(flat, got, strict=True)]
        rest = iter(got)
        return split, [list(islice(rest, len(parts))) for parts in split]

    def word_counts(self, text: str) -> list[int]:
        """The number of tokens of each of the text's ``split_words``."""
        return [sum(map(len, parts)) // 4 for parts in self.ids(split_words(text))]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder in each Python worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
