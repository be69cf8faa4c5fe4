"""Runs of repeated words (maximal repetitions) by an enhanced suffix array.

Several texts are numbered word by word and sorted together by prefix doubling, each under a first key of its own, so
that nothing matches across texts. The longest common prefixes (LCP) of neighbours follow from the ranks kept for each
doubling. An LCP interval of depth d holds all places at which the same d words stand. For the members i of all its
children but the largest the branching test asks the inverse suffix array (ISA) whether i + d or i - d lies in another
child: if so, a square of period d stands at the smaller of the two and goes on no further. Each run ends in exactly
one such square of its smallest period; rotating the square to the left, word by word, gives the run's start. Squares
of multiples of the period that lie inside the run are merged into it. Intervals are index ranges; no tree is built.

Null texts have no words; empty texts and texts without runs give an empty array of runs and the words joined by single
spaces. Rows are independent: repeated rows, null ids and other columns change nothing, an empty table gives no rows.
A text is handled whole by one task, in memory that grows linearly with it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolcat.llm.common import text_or_empty

EXPONENT, LEAST = 4, 6
#: Words of several texts that are sorted together, and members of intervals that are tested together.
WORDS, MEMBERS = 1 << 18, 1 << 21


def suffix_order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse and the LCP of each suffix with the one before it (0 for the first).

    ``keys``: numbers of the words, which differ between texts; so suffixes of different texts have nothing in common."""
    n = len(keys)
    sa = np.argsort(keys, kind="stable")
    new = np.r_[True, keys[sa[1:]] != keys[sa[:-1]]]
    starts = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.full(n + 1, -1, dtype=np.int32)  # the first place of a suffix's group; -1 behind the last word
    rank[sa] = starts
    levels, step = [rank.copy()], 1
    while True:
        slots = np.flatnonzero(~(new & np.r_[new[1:], True]))  # of groups with more than one member
        if not len(slots):
            break
        at = sa[slots]
        own, then = rank[at], rank[np.minimum(at + step, n)]
        order = np.lexsort((then, own))
        at, own, then = at[order], own[order], then[order]
        sa[slots] = at
        first = np.r_[True, (own[1:] != own[:-1]) | (then[1:] != then[:-1])]
        new[slots] = first
        rank[at] = np.maximum.accumulate(np.where(first, slots, 0))
        levels.append(rank.copy())
        step *= 2
    lcp = np.zeros(n, dtype=np.int64)
    pair = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1 if n else np.zeros(0, dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        a, b = sa[pair - 1] + lcp[pair], sa[pair] + lcp[pair]
        same = levels[level][np.minimum(a, n)] == levels[level][np.minimum(b, n)]
        lcp[pair[same]] += 1 << level
    return sa, rank[:n].astype(np.int64), lcp


def intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each place with a common prefix: the place, and the first and the end of the suffixes of its LCP interval."""
    places = np.flatnonzero(lcp)
    if not len(places):
        return places, places, places
    gaps = np.flatnonzero(np.diff(places) > 1)  # between stretches without a zero
    values, at = np.insert(lcp[places], gaps + 1, 0).tolist(), np.insert(places, gaps + 1, places[gaps] + 1).tolist()
    left, right = [int(places[0]) - 1] * len(values), [int(places[-1]) + 1] * len(values)
    stack: list[int] = []
    for k, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            right[stack.pop()] = at[k]
        if stack:
            top = stack[-1]
            left[k] = left[top] if values[top] == v else at[top] if values[top] else at[top + 1] - 1
        stack.append(k)
    shared = np.flatnonzero(np.array(values))
    return places, np.array(left)[shared], np.array(right)[shared]


def branching_squares(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of the squares that don't go on to the right, of every period."""
    sa, isa, lcp = suffix_order(keys)
    place, left, right = intervals(lcp)
    none = np.zeros(0, dtype=np.int64)
    if not len(place):
        return none, none
    order = np.lexsort((place, right, left, lcp[place]))
    place, left, right = place[order], left[order], right[order]
    depth = lcp[place]
    first = np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1]) | (depth[1:] != depth[:-1])]
    last = np.r_[first[1:], True]
    # Children: one from each place to the next, and one from the interval's left end to its first place.
    begin = np.concatenate([place, left[first]])
    end = np.concatenate([np.where(last, right, np.r_[place[1:], 0]), place[first]])
    group = np.concatenate([np.cumsum(first) - 1, np.arange(first.sum())])
    of = np.concatenate([np.arange(len(place)), np.flatnonzero(first)])
    by = np.lexsort((end - begin, group))
    small = by[np.r_[group[by[1:]] == group[by[:-1]], False]]  # all but the largest of each interval
    sizes = end[small] - begin[small]
    stops = np.cumsum(sizes)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(small):
        stop = max(at + 1, int(np.searchsorted(stops, (stops[at - 1] if at else 0) + MEMBERS, "right")))
        some, size = small[at:stop], sizes[at:stop]
        offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        c = np.repeat(some, size)
        i, d, lo, hi = sa[begin[c] + offset], depth[of[c]], left[of[c]], right[of[c]]
        for start, other in ((i, i + d), (i - d, i - d)):
            slot = isa[np.clip(other, 0, len(isa) - 1)]
            hit = (other >= 0) & (other < len(isa)) & (slot >= lo) & (slot < hi) & ((slot < begin[c]) | (slot >= end[c]))
            found.append((start[hit], d[hit]))
        at = stop
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _back(keys: np.ndarray, start: int, period: int) -> int:
    """By how many words the square at ``start`` can be rotated to the left."""
    done, step = 0, 16
    while done < start:
        size = min(step, start - done)
        a = keys[start - done - size : start - done]
        b = keys[start + period - done - size : start + period - done]
        differ = np.flatnonzero(a != b)
        if len(differ):
            return done + size - 1 - int(differ[-1])
        done, step = done + size, 4 * step
    return done


def runs(keys: np.ndarray, exponent: int = EXPONENT, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of all runs of at least ``least`` words and ``exponent`` periods, in order.

    ``keys``: numbers of words, which differ between texts."""
    starts, periods = branching_squares(keys)
    ends = starts + 2 * periods
    order = np.lexsort((periods, ends))
    out: list[tuple[int, int, int]] = []
    before, here = -1, []  # the runs that end where the last one did
    for start, period, end in zip(starts[order].tolist(), periods[order].tolist(), ends[order].tolist(), strict=True):
        if end != before:
            before, here = end, []
        if any(period % p == 0 and start >= s for s, p in here):
            continue
        here.append((start - _back(keys, start, period), period))
        s = here[-1][0]
        if end - s >= max(least, exponent * period):
            out.append((s, end - s, period))
    return sorted(out)


def text_runs(texts: list[list[bytes]], exponent: int = EXPONENT, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """The runs of each of some texts, given as words."""
    number = defaultdict(count().__next__)
    ids = np.array([number[w] for words in texts for w in words], dtype=np.int64)
    edges = np.cumsum([0] + [len(words) for words in texts])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(ids):
        return out
    of = np.repeat(np.arange(len(texts)), np.diff(edges))
    for start, length, period in runs(of * len(number) + ids, exponent, least):
        k = int(of[start])
        out[k].append((start - int(edges[k]), length, period))
    return out


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by spaces."""
    if not found:
        return b" ".join(words)
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in found:
        keep[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def periodic_runs(docs: DataFrame, exponent: int = EXPONENT, least: int = LEAST, prepare: Callable | None = None) -> DataFrame:
    """``doc_id, runs, text``: the runs of each text, as an array of ``start, length, period`` in words, and the text
    without what repeats. ``prepare`` takes a row's id and words and returns other words."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, begin = batch.column(1), 0
            ids = batch.column(0).to_pylist() if prepare else None
            while begin < batch.num_rows:
                end, words, size = begin, [], 0
                while end < batch.num_rows and (end == begin or size < WORDS):
                    split = texts[end].as_py().split()
                    words.append(prepare(ids[end], split) if prepare else split)
                    size += len(split)
                    end += 1
                found = text_runs(words, exponent, least)
                rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in found]
                short = [collapsed(w, rs).decode() for w, rs in zip(words, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), pa.array(rows, kind), pa.array(short, pa.string())], names=["doc_id", "runs", "text"]
                )
                begin = end

    rows = docs.select("doc_id", text_or_empty().cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, runs array<struct<start:long,length:long,period:long>>, text string")


def spread(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Makes the words of one text in ten periodic from some word on, as the query's contract lays down; rows without
    an id stay."""
    if doc_id is None or not words:
        return words
    h = crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def run_digests(found: DataFrame) -> DataFrame:
    """What ``periodic_runs`` found as numbers and digests: the count of runs, the longest run (ties: smallest start, then
    period), SHA-256 of all runs and of the shortened text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    length, start, period = longest["n"], -longest["s"], -longest["p"]
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        ((1000 * length - (1000 * length) % period) / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )
