"""Toxicity by the nearest labelled examples.

Examples are a bounded sample of the labelled documents. Every whole text becomes a TF-IDF vector over all words of
the examples, whose document frequencies are counted over all documents, and its nearest examples by cosine are found
exactly: postings lie in blocks of examples with the largest weight of each. Lists of rarer words are added first;
what the frequent words can still add to a block is bounded by its largest weights, and only groups of blocks whose
bound reaches the k-th best of the most promising group are completed, for many texts at once. A second vector of the
same kind holds only the words, and starts of words, that the examples tie to the label. The neighbours' votes, weighted
by their distance, are weighed against each other and calibrated on the examples themselves, each held against all
others.

Null texts count as empty. A text that shares no word with an example gets the share of toxic ones among examples without words.
Null ``doc_id``: scored like any other, never an example, ``held_out`` null. Repeated rows are scored each; a
repeated id gives one example. Labels that are null are ignored. Without labels every score is zero. Other columns
are never read; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolcat.llm.common import materialize, text_or_empty

#: Bounds: labelled examples, label-tied features, neighbours that vote, and examples in a block of postings.
EXAMPLES, TERMS, NEIGHBOURS, BLOCK = 20_000, 1024, 25, 64
#: Blocks that are completed together, texts that are searched together, and the most frequent words, each in more
#: than one of SPREAD examples, whose lists are completed last.
GROUP, QUERIES, FREQUENT, SPREAD = 8, 128, 512, 32
#: Examples whose weights are computed at a time.
CHUNK = 2048
#: A feature is tied to the label from this log-likelihood ratio and this ratio of its rates on.
MIN_LLR, MIN_RATIO = 20.0, 3.0

# ASCII letters in lower case and all bytes of other characters make words.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


_PREFIXES = (4, 5, 6, 7)


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_WORD_BYTES).split()


def features_of(word: bytes) -> list[bytes]:
    """The word, and its starts in some bytes (marked ``^``)."""
    return [word, *(b"^" + word[:k] for k in _PREFIXES if len(word) >= k)]


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def examples(docs: DataFrame, labels: DataFrame, limit: int = EXAMPLES) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``limit`` labelled documents outside the held-out fold, by hash order."""
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = usable.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    share = 2.0 * limit / max(1, known.count())
    order = F.xxhash64(F.col("doc_id").cast("string"))
    drawn = known.filter(F.pmod(order, F.lit(1_000_003)) < F.lit(int(share * 1_000_003) + 1))
    drawn = drawn.orderBy(order, "doc_id").limit(limit)
    found = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(drawn), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))


def vocabulary(sample: DataFrame, limit: int = TERMS) -> list[bytes]:
    """The features most tied to the label."""
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(seen: tuple[Counter, Counter]) -> pa.RecordBatch:
            terms = list(seen[0].keys() | seen[1].keys())
            numbers = [pa.array([c.get(t, 0) for t in terms], pa.int64()) for c in seen]
            return pa.RecordBatch.from_arrays([pa.array(terms, pa.binary()), *numbers], names=["term", "good", "bad"])

        seen = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[toxic].update(set(chain.from_iterable(map(features_of, set(words_of(text))))))
                if len(seen[0]) + len(seen[1]) > 300_000:
                    yield rows(seen)
                    seen = Counter(), Counter()
        yield rows(seen)

    found = sample.select("text", "toxic").mapInArrow(count, "term binary, good long, bad long")
    found = found.groupBy("term").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))

    def part(n: Column, of: int, other: Column) -> Column:  # n log(n / expected)
        expected = (n + other) * (of / (bad + good))
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    llr = 2 * (part(F.col("bad"), bad, F.col("good")) + part(F.col("good"), good, F.col("bad")))
    ratio = (F.col("bad") / bad) / ((F.col("good") + 0.5) / good)
    best = found.select("term", llr.alias("llr"), ratio.alias("ratio"))
    best = best.filter((F.col("llr") >= MIN_LLR) & (F.col("ratio") >= MIN_RATIO)).orderBy(F.desc("llr"), "term").limit(limit)
    return [bytes(r["term"]) for r in best.collect()]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


class Encoder:
    """Texts as counts of words, numbered by their place among sorted hashes, and of label-tied features."""

    def __init__(self, hashes: np.ndarray, tied: list[bytes], slots: int = 200_000):
        """hashes: the sorted hashes of all words of the examples; other words are passed over. slots: words that are
        remembered at once."""
        self.hashes, self.tied, self.slots = hashes, {t: i for i, t in enumerate(tied)}, slots
        starts, short = [t.removeprefix(b"^") for t in tied], _PREFIXES[0]
        # Words that begin otherwise have no tied feature.
        self.heads, self.longer = {t for t in starts if len(t) <= short}, {t[: short + 1] for t in starts if len(t) > short}
        self._forget()

    def _forget(self) -> None:
        self.of: dict[bytes, int] = {}
        self.number = np.full(1024, -1, dtype=np.int32)  # by slot
        self.own: dict[int, list[int]] = {}  # tied features by slot

    def __getstate__(self) -> dict:
        return {**self.__dict__, "of": {}, "own": {}, "number": np.full(1024, -1, dtype=np.int32)}

    def _learn(self, fresh: list[bytes]) -> None:
        hashed = word_hashes(fresh)
        at = np.minimum(np.searchsorted(self.hashes, hashed), max(0, len(self.hashes) - 1))
        known = self.hashes[at] == hashed if len(self.hashes) else np.zeros(len(fresh), dtype=bool)
        begin = len(self.of)
        if begin + len(fresh) > len(self.number):
            self.number = np.concatenate([self.number, np.full(len(self.number) + len(fresh), -1, dtype=np.int32)])
        self.number[begin : begin + len(fresh)] = np.where(known, at, -1)
        self.of.update(zip(fresh, range(begin, begin + len(fresh)), strict=True))
        heads, longer, short = self.heads, self.longer, _PREFIXES[0]
        for n, w in enumerate(fresh):
            if (w[:short] in heads or w[: short + 1] in longer) and (own := [self.tied[f] for f in features_of(w) if f in self.tied]):
                self.own[begin + n] = own

    def __call__(self, texts: list[str]) -> tuple[tuple, tuple]:
        """For words and for tied features: where each text's begin, with the end of the last; their numbers, ascending;
        and how often each occurs."""
        split = [Counter(words_of(t)) for t in texts]
        sizes = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        flat = list(chain.from_iterable(split))
        if len(self.of) > self.slots:
            self._forget()
        slot = np.fromiter(map(self.of.get, flat, repeat(-1)), dtype=np.int64, count=len(flat))
        new = np.flatnonzero(slot < 0)
        if len(new):
            fresh = [flat[i] for i in new.tolist()]
            self._learn(list(dict.fromkeys(fresh)))
            slot[new] = list(map(self.of.__getitem__, fresh))
        counts = np.fromiter(chain.from_iterable(c.values() for c in split), dtype=np.int64, count=len(flat))
        text, number = np.repeat(np.arange(len(texts)), sizes), self.number[slot]
        some = np.flatnonzero(number >= 0)
        some = some[np.argsort(text[some] << 32 | number[some])]
        words = np.searchsorted(text[some], np.arange(len(texts) + 1)), number[some], counts[some].astype(np.int32)
        tied: list[tuple[int, int]] = []
        weights: list[int] = []
        if self.own:
            for i in np.flatnonzero(np.isin(slot, np.fromiter(self.own, dtype=np.int64, count=len(self.own)))).tolist():
                for f in self.own[int(slot[i])]:
                    tied.append(int(text[i]) << 32 | f)
                    weights.append(int(counts[i]))
        key, at = np.unique(np.array(tied, dtype=np.int64), return_inverse=True)
        total = np.bincount(at, np.array(weights, dtype=np.float64), minlength=len(key)).astype(np.int32)
        return words, (np.searchsorted(key >> 32, np.arange(len(texts) + 1)), (key & 0xFFFFFFFF).astype(np.int32), total)


def example_words(sample: DataFrame) -> np.ndarray:
    """The sorted hashes of all words of the examples."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(words_of(text))
        yield pa.RecordBatch.from_arrays([pa.array(word_hashes(list(seen)).view(np.int64))], names=["h"])

    found = sample.select("text").mapInArrow(distinct, "h long").distinct().toArrow()
    return np.sort(found.column(0).to_numpy().view(np.uint64))


def _least_type(counts: np.ndarray) -> np.ndarray:
    top = int(counts.max(initial=0))
    return counts.astype("u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4")


def encoded(docs: DataFrame, encoder: Encoder) -> DataFrame:
    """``doc_id, digest, words, counts, tied, tied_counts``: every whole text as the encoder gives it, written down, so
    that texts are read and split once. ``digest`` tells equal texts."""
    model = docs.sparkSession.sparkContext.broadcast(encoder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, QUERIES):
                batch = whole.slice(at, QUERIES)
                texts = batch.column(1).to_pylist()
                columns = [[xxhash.xxh3_128_digest(t.encode()) for t in texts]]
                for begin, terms, counts in model.value(texts):
                    cuts = list(zip(begin.tolist(), begin[1:].tolist(), strict=False))
                    columns.append([terms[a:b].astype("<i4").tobytes() for a, b in cuts])
                    columns.append([_least_type(counts[a:b]).tobytes() for a, b in cuts])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(c, pa.binary()) for c in columns)], names=["doc_id", "digest", "words", "counts", "tied", "tied_counts"]
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    return materialize(rows.mapInArrow(run, f"doc_id {id_type}, digest binary, words binary, counts binary, tied binary, tied_counts binary"), "encoded")


def _vectors(terms: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``encoded`` wrote, as the encoder gave it."""
    begin = np.cumsum([0] + [len(t) // 4 for t in terms])
    read = [np.frombuffer(c, dtype=f"<u{4 * len(c) // len(t)}") for t, c in zip(terms, counts, strict=True) if t]
    whole = np.concatenate(read).astype(np.int32) if read else np.zeros(0, dtype=np.int32)
    return begin, np.frombuffer(b"".join(terms), dtype="<i4"), whole


def document_frequencies(rows: DataFrame, encoder: Encoder) -> tuple[np.ndarray, np.ndarray]:
    """How many of all documents hold each word of the examples, and each tied feature. ``rows``: words, tied."""
    words, tied = len(encoder.hashes), len(encoder.tied)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(words + tied, dtype=np.int64)
        for batch in batches:
            for column, offset in ((0, 0), (1, words)):
                np.add.at(seen, np.frombuffer(b"".join(batch.column(column).to_pylist()), dtype="<i4") + offset, 1)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(seen[some])], names=["term", "n"])

    found = rows.select("words", "tied").mapInArrow(count, "term int, n long")
    found = found.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(words + tied, dtype=np.int64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return out[:words], out[words:]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of several ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class BlockMaxIndex:
    """An inverted index over unit vectors, with the largest weight of each frequent term in each block of vectors."""

    def __init__(self, begin: np.ndarray, term: np.ndarray, weight: np.ndarray, terms: int, block: int = BLOCK):
        """begin: where each vector's entries begin, with the end of the last; term, weight: the entries."""
        self.begin, self.weight, self.block = begin, weight.astype(np.float32, copy=False), block
        self.size = len(begin) - 1
        self.span = block * GROUP
        padded = -(-self.size // self.span) * self.span
        sizes = np.diff(begin)
        lengths = np.bincount(term, minlength=terms)
        order = np.argsort(-lengths, kind="stable")
        # By term: its number here. The more frequent, the lower, so that what is read often lies together.
        self.number = np.empty(terms, dtype=np.int32)
        self.number[order] = np.arange(terms)
        self.term, lengths = self.number[term], lengths[order]
        often = int((lengths[:FREQUENT] * SPREAD > self.size).sum())
        docs = np.repeat(np.arange(self.size, dtype=np.int32), sizes)
        # Sums in single precision find candidates; their cosines are computed again in double precision.
        self.rows = np.zeros((padded, often), dtype=np.float32)
        held = np.flatnonzero(self.term < often)
        self.rows[docs[held], self.term[held]] = self.weight[held]
        del held
        self.most = self.rows.reshape(padded // block, block, often).max(axis=1) if padded else self.rows
        rare = np.flatnonzero(self.term >= often).astype(np.int32)
        rare = rare[np.argsort(self.term[rare], kind="stable")]
        self.postings = np.empty(len(rare), dtype=np.int64)  # pairs of a vector and its weight
        self.postings.view(np.int32)[::2], self.postings.view(np.float32)[1::2] = docs[rare], self.weight[rare]
        lengths[:often] = 0
        self.post = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        self.dense = np.zeros(terms, dtype=np.float32)

    def nearest(self, begin: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int, leave_out: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query, positions and cosines of the k nearest vectors with a positive cosine; ties go to the
        first. leave_out: for each query a vector that doesn't count."""
        return self._all_nearest(begin, self.number[term], weight, k, leave_out)

    def nearest_others(self, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """The same for some of the vectors, each without itself."""
        return self._all_nearest(*_taken((self.begin, self.term, self.weight), own), k, own)

    def _all_nearest(self, begin, term, weight, k, leave_out) -> list[tuple[np.ndarray, np.ndarray]]:
        out = [(np.zeros(0, dtype=np.int64), np.zeros(0))] * (len(begin) - 1)
        some = np.flatnonzero(np.diff(begin)) if self.size else np.zeros(0, dtype=np.int64)
        for a in range(0, len(some), QUERIES):
            queries = some[a : a + QUERIES]
            cuts = np.append(begin[queries], begin[queries[-1] + 1])
            own = slice(cuts[0], cuts[-1])
            found = self._nearest(cuts - cuts[0], term[own], weight[own], k, None if leave_out is None else leave_out[queries])
            for q, x in zip(queries.tolist(), found, strict=True):
                out[q] = x
        return out

    def _nearest(self, begin, term, weight, k, leave_out) -> list[tuple[np.ndarray, np.ndarray]]:
        n, (padded, often) = len(begin) - 1, self.rows.shape
        sums, frequent = np.zeros((n, padded), dtype=np.float32), np.zeros((n, often), dtype=np.float32)
        held = np.flatnonzero(term < often)
        frequent[np.repeat(np.arange(n), np.diff(begin))[held], term[held]] = weight[held]
        first, last = self.post[term], self.post[term + 1]
        rare = np.flatnonzero(last > first)
        cuts = np.searchsorted(rare, begin)
        for q in range(n):
            own = rare[cuts[q] : cuts[q + 1]]
            if len(own):
                found = np.concatenate([self.postings[a:b] for a, b in zip(first[own].tolist(), last[own].tolist(), strict=True)])
                weights = found.view(np.float32)[1::2] * np.repeat(weight[own].astype(np.float32), last[own] - first[own])
                sums[q] = np.bincount(found.view(np.int32)[::2], weights, minlength=padded)
        if leave_out is not None:
            sums[np.arange(n), leave_out] = -np.inf
        # What a vector of each block can reach at most.
        bounds = sums.reshape(n, -1, self.block).max(axis=2) + frequent @ self.most.T + np.float32(1e-5)
        bounds = bounds.reshape(n, -1, GROUP).max(axis=2)

        def complete(group: int, queries: np.ndarray) -> np.ndarray:
            own = slice(group * self.span, (group + 1) * self.span)
            whole = frequent[queries] @ self.rows[own].T
            whole += sums[queries, own]
            sums[queries, own] = whole
            return whole

        best, least = bounds.argmax(axis=1), np.zeros(n, dtype=np.float32)
        for group in np.unique(best).tolist():  # the most promising group of each query sets what others must reach
            queries = np.flatnonzero(best == group)
            whole = complete(group, queries)
            if self.span > k:
                least[queries] = np.partition(whole, self.span - k, axis=1)[:, self.span - k]
        for group in range(bounds.shape[1]):
            queries = np.flatnonzero((best != group) & (bounds[:, group] >= least) & (bounds[:, group] > 1e-5))
            if len(queries):
                complete(group, queries)
        # Sums that were not completed are below what k vectors reach. So do k blocks reach the k-th largest of the blocks' best.
        blocks = sums.reshape(-1, self.block)
        most = blocks.max(axis=1).reshape(n, -1)
        if most.shape[1] > k:
            least = np.maximum(least, np.partition(most, most.shape[1] - k, axis=1)[:, most.shape[1] - k])
        least = np.maximum(least - np.float32(2e-5), np.float32(1e-9))
        near = np.flatnonzero(most >= least[:, None])
        query = near // most.shape[1]
        row, at = np.nonzero(blocks[near] >= least[query][:, None])
        query, at = query[row], near[row] % most.shape[1] * self.block + at
        about, cuts = sums[query, at], np.searchsorted(query, np.arange(n + 1))
        out = []
        for q in range(n):
            own, found = slice(begin[q], begin[q + 1]), slice(cuts[q], cuts[q + 1])
            out.append(self._exact(term[own], weight[own], at[found], about[found], k))
        return out

    def _exact(self, term, weight, at, about, k) -> tuple[np.ndarray, np.ndarray]:
        if not len(at):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        if len(at) > k:
            keep = about >= np.partition(about, len(at) - k)[len(at) - k] - 2e-5
            at = at[keep]
        self.dense[term] = weight
        parts = list(map(slice, self.begin[at].tolist(), self.begin[at + 1].tolist()))
        sizes = self.begin[at + 1] - self.begin[at]
        terms, weights = (np.concatenate([x[p] for p in parts]) for x in (self.term, self.weight))
        cosines = np.add.reduceat(np.multiply(self.dense.take(terms), weights, dtype=np.float64), np.cumsum(sizes) - sizes)
        self.dense[term] = 0.0
        keep = np.lexsort((at, -cosines))[:k]
        keep = keep[cosines[keep] > 0]
        return at[keep], cosines[keep]


def _unit(begin: np.ndarray, term: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weights of vectors of length one. Vectors may be empty; some are done at a time, to need little memory."""
    out = np.empty(len(term), dtype=np.float32)
    for a in range(0, len(begin) - 1, CHUNK):
        cuts = begin[a : a + CHUNK + 1]
        own = slice(cuts[0], cuts[-1])
        raw = (1 + np.log(counts[own])) * idf[term[own]]
        of = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        norms = np.sqrt(np.bincount(of, raw * raw, minlength=len(cuts) - 1))  # the same whatever stands in the batch
        out[own] = raw / norms[of]
    return out


class Examples:
    """The examples as tasks need them, of bounded size: words, frequencies, labels and counts, from which each Python
    worker builds the two indexes once."""

    def __init__(self, encoder: Encoder, idf: np.ndarray, tied_idf: np.ndarray, packed: list[bytes], ids: list, labels: list[int], k: int = NEIGHBOURS):
        """packed: by part of the sample, the arrays that the encoder gives, compressed; ids and labels in that order."""
        self.encoder, self.idf, self.tied_idf, self.packed = encoder, idf.astype(np.float32), tied_idf, packed
        self.all_ids, self.all_labels, self.k = ids, labels, k
        self.index: BlockMaxIndex | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "index": None, "tied_index": None}

    def build(self) -> Examples:
        if self.index is not None:
            return self
        parts = [_unpacked(p) for p in self.packed]
        words, tied = (_joined([p[i] for p in parts]) for i in (0, 1))
        del parts
        labels, some = np.array(self.all_labels, dtype=np.float64), np.diff(words[0]) > 0
        overall = float(labels.mean()) if len(labels) else 0.0
        self.base = (float(labels[~some].sum()) + overall) / (int((~some).sum()) + 1) if len(labels) else 0.0
        plain = some & (np.diff(tied[0]) == 0)
        self.tied_base = (float(labels[plain].sum()) + overall) / (int(plain.sum()) + 1)
        order = np.flatnonzero(some)
        order = order[np.argsort(np.array([str(self.all_ids[i]) for i in order.tolist()]), kind="stable")] if len(order) else order
        begin, term, weight = words[0], words[1], _unit(*words, self.idf)
        del words
        order = order[_alike(begin, term, weight, len(self.idf), order)]
        begin, term, weight = _taken((begin, term, weight), order)
        self.ids, self.labels = [self.all_ids[i] for i in order.tolist()], labels[order]
        self.index = BlockMaxIndex(begin, term, weight, len(self.idf))
        del begin, term, weight
        tied = _taken(tied, order)
        self.owners = np.flatnonzero(np.diff(tied[0]))
        self.place = np.full(len(order), -1, dtype=np.int64)  # by example: its place in the second index
        self.place[self.owners] = np.arange(len(self.owners))
        begin, term, counts = _taken(tied, self.owners)
        self.tied_index = BlockMaxIndex(begin, term, _unit(begin, term, counts, self.tied_idf), len(self.tied_idf))
        return self

    def _vote(self, labels: np.ndarray, cosines: np.ndarray, base: float) -> float:
        """The share of toxic neighbours, each weighted by the inverse of its distance, drawn to the base rate."""
        weights = 1 / (0.05 + np.maximum(0.0, 1 - cosines))
        return float((weights @ labels + base) / (weights.sum() + 1))

    def left_out(self, numbers: np.ndarray) -> np.ndarray:
        """The two votes for some of the examples by the others."""
        votes = np.full((len(numbers), 2), (self.base, self.tied_base))
        index, tied = self.index, self.tied_index
        for n, (at, cosines) in enumerate(index.nearest_others(numbers, self.k)):
            votes[n, 0] = self._vote(self.labels[at], cosines, self.base)
        place = self.place[numbers]
        some = np.flatnonzero(place >= 0)
        for n, (at, cosines) in zip(some.tolist(), tied.nearest_others(place[some], self.k), strict=True):
            votes[n, 1] = self._vote(self.labels[self.owners[at]], cosines, self.tied_base)
        return votes

    def votes(self, words: tuple, own: tuple) -> tuple[np.ndarray, np.ndarray, list[list[tuple]]]:
        """The two votes for each text, whether it shares anything with an example, and the three nearest examples.
        words, own: what the encoder gives for some texts."""
        (begin, term, counts), (tied_begin, tied_term, tied_counts) = words, own
        out = np.full((len(begin) - 1, 2), (self.base, self.tied_base))
        known, near = np.zeros(len(out), dtype=bool), []
        found = self.index.nearest(begin, term, _unit(begin, term, counts, self.idf), self.k)
        tied = self.tied_index.nearest(tied_begin, tied_term, _unit(tied_begin, tied_term, tied_counts, self.tied_idf), self.k)
        for n, ((at, cosines), (own, tied_cosines)) in enumerate(zip(found, tied, strict=True)):
            if len(at):
                out[n, 0] = self._vote(self.labels[at], cosines, self.base)
            if len(own):
                out[n, 1] = self._vote(self.labels[self.owners[own]], tied_cosines, self.tied_base)
            known[n] = len(at) or len(own)
            near.append([(self.ids[i], float(c)) for i, c in zip(at[:3].tolist(), cosines[:3].tolist(), strict=True)])
        return out, known, near


def _packed(arrays: tuple[tuple, tuple]) -> bytes:
    """Both triples of an ``Encoder``'s result as compressed bytes."""
    flat = [x.astype("<i4") for triple in arrays for x in triple]
    sizes = np.array([len(x) for x in flat], dtype="<i4")
    return zlib.compress(b"".join(x.tobytes() for x in (sizes, *flat)), 1)


def _unpacked(packed: bytes) -> tuple[tuple, tuple]:
    whole = np.frombuffer(zlib.decompress(packed), dtype="<i4")
    cuts = 6 + np.concatenate([[0], np.cumsum(whole[:6])])
    six = [whole[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    return tuple(six[:3]), tuple(six[3:])


def _joined(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([0] + [len(t) for _, t, _ in parts])
    begin = np.concatenate([[0], *(b[1:].astype(np.int64) + e for (b, _, _), e in zip(parts, ends, strict=False))]).astype(np.int64)
    term, counts = (np.concatenate([np.zeros(0, dtype=np.int32), *(p[i] for p in parts)]) for i in (1, 2))
    return begin, term, counts


def _taken(vectors: tuple, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Some of the vectors, in the order given; some are copied at a time, to need little memory."""
    begin, term, values = vectors
    sizes = begin[order + 1] - begin[order]
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    out = np.empty(ends[-1], dtype=term.dtype), np.empty(ends[-1], dtype=values.dtype)
    for a in range(0, len(order), CHUNK):
        at = _ranges(begin[order[a : a + CHUNK]], sizes[a : a + CHUNK])
        own = slice(ends[a], ends[min(a + CHUNK, len(order))])
        out[0][own], out[1][own] = term[at], values[at]
    return ends, *out


def _alike(begin: np.ndarray, term: np.ndarray, weight: np.ndarray, terms: int, some: np.ndarray, words: int = 96) -> np.ndarray:
    """An order of ``some`` of the vectors that puts those together whose most frequent terms are alike, so that blocks
    have low bounds."""
    often = np.argsort(-np.bincount(term, minlength=terms), kind="stable")[:words]
    column = np.full(terms, -1, dtype=np.int16)
    column[often] = np.arange(len(often))
    rows = np.zeros((len(begin) - 1, len(often)), dtype=np.float32)
    at = np.flatnonzero(column[term] >= 0)
    rows[np.searchsorted(begin, at, "right") - 1, column[term[at]]] = weight[at]
    rows = rows[some].astype(np.float64)
    _, axes = np.linalg.eigh(rows.T @ rows)
    sides = rows @ axes[:, ::-1][:, 1:5] if len(often) > 4 else rows
    marks = tuple((sides[:, i] > 0) for i in range(1, sides.shape[1])) + ((sides[:, 0] > 0),) if sides.shape[1] else ()
    return np.lexsort((np.arange(len(some)), np.round(sides[:, 0], 6), *marks)) if marks else np.arange(len(some))


class Scorer:
    """The broadcast examples, and how their votes are weighed and calibrated."""

    def __init__(self, model, votes: np.ndarray, labels: np.ndarray):
        """model: a broadcast ``Examples``; votes: those of each example by the others."""
        self.model = model
        self.weights = _logistic(_logits(votes), labels)
        self.steps, self.levels = _isotonic(_logits(votes) @ self.weights, labels)

    def score(self, texts: list[str]) -> list[tuple[float, list]]:
        """Score and evidence of each text."""
        return self.score_encoded(*self.model.value.encoder(texts))

    def score_encoded(self, words: tuple, own: tuple) -> list[tuple[float, list]]:
        examples = self.model.value.build()
        votes, known, near = examples.votes(words, own)
        if len(self.steps):
            scores = np.where(known, np.interp(_logits(votes) @ self.weights, self.steps, self.levels), examples.base)
        else:
            scores = np.full(len(votes), examples.base)
        return [(s, n if k else []) for s, n, k in zip(scores.tolist(), near, known.tolist(), strict=True)]


def _logits(votes: np.ndarray) -> np.ndarray:
    held = np.clip(votes, 1e-3, 1 - 1e-3)
    return np.log(held / (1 - held))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with an intercept that is left out here, none below zero, of sum one."""
    if not len(y):
        return np.full(x.shape[1], 1 / x.shape[1])
    wide, at = np.column_stack([x, np.ones(len(y))]), np.zeros(x.shape[1] + 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(wide @ at, -30, 30)))
        slope = wide.T @ (y - p) - at
        at = at + np.linalg.solve((wide * (p * (1 - p))[:, None]).T @ wide + np.eye(len(at)), slope)
    found = np.maximum(at[:-1], 0.0)
    return found / found.sum() if found.sum() > 0 else np.full(x.shape[1], 1 / x.shape[1])


def _isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the non-decreasing shares of y over ascending x, each smoothed by one half."""
    pools: list[list[float]] = []  # sum of x, sum of y, size
    for a, b in sorted(zip(x.tolist(), y.tolist(), strict=True)):
        pools.append([a, b, 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    levels = np.array([(p[1] + 0.5) / (p[2] + 1) for p in pools])
    return np.array([p[0] / p[2] for p in pools]), np.maximum.accumulate(levels)


def fit(docs: DataFrame, labels: DataFrame, limit: int = EXAMPLES, texts: DataFrame | None = None) -> tuple[Scorer, DataFrame]:
    """The scorer, and all of ``docs`` as ``encoded`` for it; ``texts`` may give its texts under other ids."""
    sample = materialize(examples(docs, labels, limit), "examples")
    encoder = Encoder(example_words(sample), vocabulary(sample))
    spark, n = docs.sparkSession, docs.count()
    model = spark.sparkContext.broadcast(encoder)
    rows = encoded(docs if texts is None else texts, encoder)
    idf, tied_idf = (np.log((1 + n) / (1 + f)) + 1 for f in document_frequencies(rows, encoder))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                counted = _packed(model.value(part.column(1).to_pylist()))
                ids, marks = pa.array([part.column(0).to_pylist()]), pa.array([part.column(2).to_pylist()], pa.list_(pa.int32()))
                ids = ids.cast(pa.list_(part.schema.field(0).type))
                yield pa.RecordBatch.from_arrays([ids, marks, pa.array([counted], pa.binary())], names=["ids", "labels", "packed"])

    id_type = sample.schema["doc_id"].dataType.simpleString()
    parts = sample.select("doc_id", "text", "toxic").mapInArrow(pack, f"ids array<{id_type}>, labels array<int>, packed binary")
    parts = sorted(parts.collect(), key=lambda p: p["ids"][0])  # of at most ``limit`` examples, compressed
    ids, marks = [i for p in parts for i in p["ids"]], [x for p in parts for x in p["labels"]]
    found = Examples(encoder, idf, tied_idf, [bytes(p["packed"]) for p in parts], ids, marks)
    del parts
    indexed = spark.sparkContext.broadcast(found)

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = indexed.value.build()
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            numbers = numbers[numbers < len(built.ids)]
            votes = built.left_out(numbers)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers), pa.array(votes[:, 0]), pa.array(votes[:, 1]), pa.array(built.labels[numbers])], names=["id", "v", "w", "y"]
            )

    votes = spark.range(len(ids)).mapInArrow(left_out, "id long, v double, w double, y double").toArrow().sort_by("id")  # sorted here: sorting in Spark computes all twice
    v, w, y = (votes.column(c).to_numpy() for c in ("v", "w", "y"))
    return Scorer(indexed, np.column_stack([v, w]).reshape(-1, 2), y), rows


def _scores(keys: list[bytes], score, known: dict) -> list[tuple[float, list]]:
    """Score and evidence of each text; ``known`` keeps those of some texts, so that copies are scored once. ``score``
    gives them for some positions."""
    fresh = {k: i for i, k in enumerate(keys) if k not in known}
    if len(known) + len(fresh) > 20_000:
        known.clear()
        fresh = {k: i for i, k in enumerate(keys)}
    todo = list(fresh.items())
    for at in range(0, len(todo), QUERIES):
        part = todo[at : at + QUERIES]
        known.update(zip((k for k, _ in part), score([i for _, i in part]), strict=True))
    return [known[k] for k in keys]


def score(rows: DataFrame, scorer: Scorer) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` of what ``fit`` encoded; evidence: the nearest examples and
    their cosines."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        kind = pa.list_(pa.struct([("doc_id", pa.int64() if id_type == "bigint" else pa.string()), ("cosine", pa.float64())]))
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                digests, words, counts, tied, tied_counts = (c.to_pylist() for c in batch.columns[1:])

                def some(at: list[int], columns=(words, counts, tied, tied_counts)) -> list[tuple[float, list]]:
                    w, c, t, d = ([x[i] for i in at] for x in columns)
                    return scorer.score_encoded(_vectors(w, c), _vectors(t, d))

                found = _scores(digests, some, known)
                why = [[{"doc_id": i if id_type == "bigint" else str(i), "cosine": c} for i, c in near] for _, near in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([s for s, _ in found], pa.float64()), pa.array(why, kind)], names=["doc_id", "score", "evidence"]
                )

    evidence = "array<struct<doc_id: bigint, cosine: double>>" if id_type == "bigint" else "array<struct<doc_id: string, cosine: double>>"
    scored = rows.mapInArrow(run, f"doc_id {id_type}, score double, evidence {evidence}")
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted, "evidence")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scorer, rows = fit(docs, labels)
    return score(rows, scorer)


def toxic_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``digest``: MD5 of the texts whose score is 0.5 or more. Each text is encoded once, whatever its row's id."""
    digest = F.md5(text_or_empty().cast("binary")).alias("doc_id")
    scorer, rows = fit(docs, labels, texts=docs.select(digest, "text"))
    return materialize(score(rows, scorer).filter("predicted = 1").select(F.col("doc_id").alias("digest")).distinct(), "toxic")


def toxic_flag(scorer: Scorer) -> Column:
    """1 where the score of ``text`` is 0.5 or more, else 0."""

    @F.pandas_udf("int")
    def flag(texts: pd.Series) -> pd.Series:
        texts = texts.tolist()
        found = _scores([xxhash.xxh3_128_digest(t.encode()) for t in texts], lambda at: scorer.score([texts[i] for i in at]), {})
        return pd.Series([int(s >= 0.5) for s, _ in found], dtype="int32")

    return flag(text_or_empty())
