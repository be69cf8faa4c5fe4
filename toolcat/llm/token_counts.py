"""Token counts by prefix dynamic programming.

``count[i] = count[i - 1] + tokens of part i`` gives the exact token count of every prefix that ends with a part of a
word, and ``prefix_tokens`` those of the prefixes of one part. ``token_counts`` writes the counts of all prefixes that
end with a word, and of the longest prefixes within a limit, to a table; totals, limits and budgets are read from it and
nothing is encoded again. ``prefix_counts`` returns the stored counts, by words or for every prefix
(``level="character"``).

Null texts count as empty: no bytes, no tokens. Null or repeated ``doc_id``: each row is answered by itself. Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolcat.llm.common import materialize, text_or_empty
from toolcat.llm.prefix_tokens import prefix_table
from toolcat.llm.tokens import TEXTS, WordEncoder, encoder, is_plain, tokenizer_path

_SEPARATORS = np.array([9, 10, 13, 32], dtype=np.uint32)
#: Parts that are cut by a rule of their own.
CONTRACTIONS = frozenset(("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"))


def part_counts(part: str, path: str) -> np.ndarray:
    """The token count of ``part[:i]`` for each i from 0 to the part's length. Words that go to the library as a whole,
    whose normal form can change with each letter, and the few contractions are encoded at each length."""
    enc = encoder(path)
    if part in CONTRACTIONS or not is_plain(part):
        cut = (part[:j] for j in range(1, len(part) + 1))
        return np.array([0, *(sum(map(len, enc.ids([c])[0])) // 4 for c in cut)], dtype=np.int64)
    if part.isascii():
        return prefix_table(path).counts(part)
    coded = [c.encode() for c in part]
    letters = "".join(enc.letters[b] for c in coded for b in c)
    return prefix_table(path).counts(letters)[np.cumsum([0, *map(len, coded)])]


class Prefixes:
    """Where the words and parts of a text end, in characters, and the token counts of the prefixes that end there."""

    def __init__(self, text: str, parts: list[str], ids: list[bytes]):
        letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        self.text, self.parts = text, parts
        self.ends = np.append(np.flatnonzero(np.isin(letters, _SEPARATORS)), len(text))
        self.inked = self.ends - np.arange(len(self.ends))  # characters but separators up to there
        self.part_ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)))
        self.part_counts = np.cumsum(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))) // 4

    def counts(self) -> np.ndarray:
        """Of the prefixes that end with a word."""
        return np.concatenate([[0], self.part_counts])[np.searchsorted(self.part_ends, self.inked, "right")]

    def within(self, limit: int, path: str) -> int:
        """The length of the longest prefix of at most ``limit`` tokens that ends inside a plain part, or with a word."""
        k = int(np.searchsorted(self.part_counts, limit, "right"))
        if k == len(self.parts):
            return len(self.text)
        before, start = (int(self.part_counts[k - 1]), int(self.part_ends[k - 1])) if k else (0, 0)
        if is_plain(self.parts[k]):
            fit = int(np.flatnonzero(part_counts(self.parts[k], path) <= limit - before)[-1])
            if fit:
                return start + fit + int(np.searchsorted(self.inked, start, "right"))
        return start + int(np.searchsorted(self.inked, start - 1, "right")) if start else 0


def prefixes(texts: list[str], path: str) -> Iterator[Prefixes]:
    enc: WordEncoder = encoder(path)
    for k in range(0, len(texts), TEXTS):
        some = texts[k : k + TEXTS]
        yield from map(Prefixes, some, *enc.coded(some))


def character_prefixes(text: str, path: str) -> np.ndarray:
    """The token count of ``text[:i]`` for each i from 0 to its length."""
    p = next(prefixes([text], path))
    before, pieces = 0, [np.zeros(1, dtype=np.int64)]
    for part, total in zip(p.parts, p.part_counts, strict=True):
        pieces.append(part_counts(part, path)[1:] + before)
        before = int(total)
    inked = np.ones(len(p.text), dtype=np.int64)
    inked[p.ends[:-1]] = 0  # a separator leaves the count as it is
    return np.concatenate(pieces)[np.concatenate([[0], np.cumsum(inked)])]


def token_counts(docs: DataFrame, limit: int = 2048, path: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, limit_chars, limit_words``: from the stored prefix counts. ``limit_chars`` is
    the length of the longest prefix of at most ``limit`` tokens that ends inside a plain part or with a word,
    ``limit_words`` the number of whole words in it, as single separators cut them."""
    path = path or tokenizer_path("word_bpe_49k.json")
    stored = materialize(prefix_counts(docs, "word", path, limit), "prefixes")
    n = F.element_at("counts", -1)
    words = F.size(F.filter("counts", lambda c: c <= limit)).cast("long")
    return stored.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"), "limit_chars", words.alias("limit_words"))


def prefix_counts(docs: DataFrame, level: str = "word", path: str | None = None, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, ends, counts, limit_chars``: ascending prefix lengths in characters with their exact token counts,
    for prefixes that end with a word or, with ``level="character"``, for all."""
    path = path or tokenizer_path("word_bpe_49k.json")
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, counts, within = [], [], []
            for p in prefixes(batch.column(1).to_pylist(), path):
                c = character_prefixes(p.text, path) if level == "character" else p.counts()
                ends.append(np.arange(len(c)) if level == "character" else p.ends)
                counts.append(c)
                within.append(p.within(limit, path))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (ends, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *lists, pa.array(within, pa.int64())], names=["doc_id", "n_bytes", "ends", "counts", "limit_chars"]
            )

    rows = docs.select("doc_id", text_or_empty().alias("text"))
    rows = rows.select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    return rows.mapInArrow(run, f"doc_id {id_type.simpleString()}, n_bytes long, ends array<long>, counts array<long>, limit_chars long")


def truncation_point(limit: Column | int) -> Column:
    """Over the columns of ``prefix_counts``: characters in the longest stored prefix of at most ``limit`` tokens."""
    n = limit if isinstance(limit, Column) else F.lit(limit)
    fits = F.filter(F.arrays_zip("ends", "counts"), lambda x: x["counts"] <= n)
    return F.coalesce(F.array_max(F.transform(fits, lambda x: x["ends"])), F.lit(0))


def tokens_before(n_chars: Column | int) -> Column:
    """Over the columns of ``prefix_counts``: tokens of the longest stored prefix of at most ``n_chars`` characters."""
    n = n_chars if isinstance(n_chars, Column) else F.lit(n_chars)
    fits = F.filter(F.arrays_zip("ends", "counts"), lambda x: x["ends"] <= n)
    return F.coalesce(F.array_max(F.transform(fits, lambda x: x["counts"])), F.lit(0))
