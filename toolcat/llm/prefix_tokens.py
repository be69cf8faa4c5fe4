"""Token counts of every prefix of a part of a word, by dynamic programming over the prefixes.

The tokens of a prefix are those of a shorter prefix and one last token. The last one is the only token of the
vocabulary that ends there, stays whole when it is merged from its letters, and isn't merged with the token before it;
so each prefix takes its count from the shorter one, and none is encoded again. The last letter of a part bears a mark,
so two rows are kept: the tokens of a prefix that goes on, and the count of one that ends.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

from toolcat.llm.tokens import LONG_PART

#: Pairs of tokens and parts whose answers are kept.
KEPT = 1 << 17


class PrefixTable:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.mark = model.get("end_of_word_suffix") or ""
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.vocabulary = model["vocab"]
        self.longest = max(map(len, self.vocabulary))
        self.whole = lru_cache(KEPT)(self._whole)
        self.apart = lru_cache(KEPT)(self._apart)
        self.kept_counts = lru_cache(KEPT)(self._counts)

    def symbols(self, letters: str, ends: bool) -> list[str]:
        return [*letters[:-1], letters[-1] + self.mark] if ends else list(letters)

    def merged(self, symbols: list[str]) -> list[str]:
        """The pair of least rank, the first of equal ones, is merged until none is left."""
        while len(symbols) > 1:
            ranks = [self.rank.get(p, len(self.rank)) for p in zip(symbols, symbols[1:], strict=False)]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[at] == len(self.rank):
                break
            symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2 :]]
        return symbols

    def _whole(self, letters: str, ends: bool) -> bool:
        token = letters + self.mark if ends else letters
        return token in self.vocabulary and self.merged(self.symbols(letters, ends)) == [token]

    def _apart(self, a: str, b: str, ends: bool) -> bool:
        return self.merged([*a, *self.symbols(b, ends)]) == [a, b + self.mark if ends else b]

    def _last(self, letters: str, i: int, last: list[str], ends: bool) -> str:
        for n in range(min(i, self.longest), 0, -1):
            token = letters[i - n : i]
            if self.whole(token, ends) and (n == i or self.apart(last[i - n], token, ends)):
                return token
        raise ValueError(f"no token ends at {i} in {letters!r}")

    def counts(self, letters: str) -> np.ndarray:
        return self.kept_counts(letters) if len(letters) <= LONG_PART else self._counts(letters)

    def _counts(self, letters: str) -> np.ndarray:
        """The number of tokens of ``letters[:i]`` for each i from 0 on."""
        last, open_, out = [""], [0], [0]
        for i in range(1, len(letters) + 1):
            token = self._last(letters, i, last, False)
            last.append(token)
            open_.append(open_[i - len(token)] + 1)
            out.append(open_[i - len(self._last(letters, i, last, True))] + 1 if self.mark else open_[i])
        return np.array(out, dtype=np.int64)


_tables: dict[str, PrefixTable] = {}


def prefix_table(path: str) -> PrefixTable:
    """One table in each Python worker."""
    if path not in _tables:
        _tables[path] = PrefixTable(path)
    return _tables[path]
