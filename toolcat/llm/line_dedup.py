"""Line deduplication by pairwise alignment.

A document's lines of ``LINE`` words or more are hashed, and, so that a passage inside a longer line is found as
well, runs of ``LINE`` words that their own hashes choose: of each ``REACH`` neighbouring runs the one with the least
hash, so any ``LINE + REACH - 1`` words in a row hold one wherever they stand. A hash leads to the earliest document
(smallest ``doc_id``) that holds it, and later documents are paired with that one, so pairs grow with the text and
not with the square of a group. That one may hold no more than the short run, while a document between the two holds
the whole passage. So what a pair shares without a block that goes is looked up once more in a second round, by chosen
runs of ``BLOCK`` words around it: any ``BLOCK + SPARE`` words in a row hold one, and the earliest document that has it
holds a whole block. Each pair is aligned by patience diff: of the runs of words that are unique in both
texts the heaviest rising chain is kept and extended word by word, and the gaps between are aligned in the same
way. From the later document go

* aligned blocks of at least ``block`` words,
* whole lines of at least ``line`` words inside smaller aligned blocks, and
* passages of at least ``block`` words that the earlier document holds elsewhere or that the later one repeats;
  shorter passages out of order stay.

Words end at white space; signs of three or more bytes in UTF-8 (as in Chinese) are words of their own. Null texts
count as empty (the returned text is ''). Rows with a null ``doc_id`` stay as they are and own nothing. Rows that
share a ``doc_id`` are parts of one document and don't delete from each other; equal repeated rows get the same
result. Texts without repeated blocks come back unchanged. Other columns are ignored by ``repeated_blocks`` and kept
by ``remove_repeated``; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolcat.llm.common import join_groups, materialize, text_or_empty, unused, with_texts

LINE, BLOCK, REACH = 12, 40, 39
#: Of so many neighbouring runs of BLOCK words, and one more, the second round chooses one.
SPARE = 10
#: So many words by which a block reaches into one more line are chance and stay.
CHANCE = 3
#: Bytes of texts whose words are hashed together.
BYTES = 1 << 20

_P, _Q = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2^64."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, BYTES)
            steps = np.full(size, _P, dtype=np.uint64), np.full(size, pow(_P, -1, 1 << 64), dtype=np.uint64)
            for s in steps:
                s[0] = 1
            cls.up, cls.down = (np.multiply.accumulate(s) for s in steps)
        return cls.up[:n], cls.down[:n]


def words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of a UTF-8 text begin and end, in bytes, and their hashes."""
    b = np.frombuffer(data, dtype=np.uint8)
    n = len(b)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    space = b <= 32
    begin = np.ones(n + 4, dtype=bool)
    begin[1:n] = space[:-1]
    wide = np.flatnonzero(b >= 0xE0)  # each sign of three or four bytes stands alone
    begin[wide] = True
    begin[wide + 3 + (b[wide] >= 0xF0)] = True
    begin = begin[:n] & ~space
    bounds = np.append(np.flatnonzero(begin | space), n)
    word = np.flatnonzero(begin[bounds[:-1]])
    starts, ends = bounds[word], bounds[word + 1]
    up, down = _Powers.get(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h = (h ^ (h >> np.uint64(31))) * _Q
    return starts, ends, h ^ (h >> np.uint64(29))


def runs_of(h: np.ndarray, size: int = LINE) -> np.ndarray:
    """The hash of each ``size`` words in a row."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, done, part, k = None, 0, h, 1  # part: runs of k words, a power of two
    while True:
        if size & k:
            out = part if out is None else part[: len(part) - done] * _power(done) + out[k:]
            done += k
        if done == size:
            return out ^ (out >> np.uint64(32))
        part, k = part[: len(part) - k] * _power(k) + part[k:], 2 * k


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_Q), n, 1 << 64))


def long_runs(h: np.ndarray, size: int) -> np.ndarray:
    """As ``runs_of``, other values, by sums from the start, which take as long for any size."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _Powers.get(len(h))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(h * up)])
    out = (sums[size:] - sums[:n]) * down[:n]
    return (out ^ (out >> np.uint64(31))) * _Q


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of each ``size`` values in a row."""
    done, out = 1, values
    while done < size:
        step = min(done, size - done)
        out = pick(out[: len(out) - step], out[step:])
        done += step
    return out


def _lines(data: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first word of each line that has words, and how many it has."""
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    after = np.append(0, np.searchsorted(starts, np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10)))
    first = after[np.append(after[1:] != after[:-1], True) & (after < len(starts))]
    return first, np.diff(np.append(first, len(starts)))


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and hashes of the lines and chosen runs of some texts; each hash once a text."""
    data = b"\n".join(texts)
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])
    starts, _, h = words(data)
    of = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, edges)))
    out = []
    runs = runs_of(h)
    if len(runs):
        last = np.uint64(2**64 - 1)
        runs = np.where(of[: len(runs)] == of[LINE - 1 :], np.minimum(runs, last - np.uint64(1)), last)
        inside = np.flatnonzero(runs < last)
        first = np.flatnonzero(np.diff(of[inside], prepend=-1))  # of each text with a run at all, its least
        if len(inside):
            least = np.minimum.reduceat(runs[inside], first)
            out.append((of[inside][first], least))
        if len(runs) >= REACH:
            lowest = _sliding(runs, REACH, np.minimum)
            lowest[of[: len(lowest)] != of[REACH + LINE - 2 :]] = 0
            held = np.concatenate([np.zeros(REACH - 1, dtype=np.uint64), lowest, np.zeros(REACH - 1, dtype=np.uint64)])
            chosen = np.flatnonzero(runs == _sliding(held, REACH, np.maximum))
            out.append((of[chosen], runs[chosen]))
        # Lines, too short to hold a chosen run for sure.
        first, sizes = _lines(data, starts)
        some = (sizes >= LINE) & (sizes < LINE + REACH)
        up, down = _Powers.get(len(h))
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(h * up)])
        whole = (sums[first + sizes] - sums[first]) * down[first]
        out.append((of[first[some]], ((whole ^ (whole >> np.uint64(31))) * _Q)[some]))
    if not out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    text, value = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    keep = np.r_[True, (text[1:] != text[:-1]) | (value[1:] != value[:-1])] if len(text) else np.zeros(0, dtype=bool)
    return text[keep], value[keep]


def _mark(text: bytes) -> int:
    return zlib.crc32(text) & 0x7FFFFFFF


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """``doc, h``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, begin = [t.encode() for t in batch.column(1).to_pylist()], 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and (end == begin or size + len(texts[end]) < BYTES):
                    size += len(texts[end]) + 1
                    end += 1
                of, h = anchors(texts[begin:end])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of + begin)), pa.array(h.view(np.int64))], names=["doc", "h"])
                begin = end

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc {id_type}, h long")


def patience(runs: list[tuple[int, int, int]]) -> list[int]:
    """Positions in ``runs`` (start, other start, weight; ascending by start) of the heaviest chain that rises in
    both."""
    tops: list[int] = []  # other starts at which lighter and heavier chains end, both ascending
    best: list[tuple[int, int]] = []  # their weights and last runs
    before = [-1] * len(runs)
    for i, (_, y, weight) in enumerate(runs):
        k = bisect_left(tops, y)
        total = weight
        if k:
            total, before[i] = weight + best[k - 1][0], best[k - 1][1]
        stop = k
        while stop < len(tops) and best[stop][0] <= total:
            stop += 1
        if stop > k or k == len(tops) or tops[k] != y:
            tops[k:stop], best[k:stop] = [y], [(total, i)]
    out, i = [], best[-1][1] if best else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """How many values both begin with."""
    n, done, step = min(len(a), len(b)), 0, 64
    while done < n:
        stop = min(n, done + step)
        differ = a[done:stop] != b[done:stop]
        at = int(differ.argmax())
        if differ[at]:
            return done + at
        done, step = stop, 4 * step
    return n


def _diagonals(at: np.ndarray, other: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of matches that go on in both texts, as start, other start and number of matches; ``at`` ascends."""
    if not len(at):
        return []
    new = (at[1:] - at[:-1] != 1) | (other[1:] - other[:-1] != 1)
    first = [0, *(new.nonzero()[0] + 1).tolist()]
    sizes = [y - x for x, y in zip(first, [*first[1:], len(at)], strict=True)]
    return list(zip(at[first].tolist(), other[first].tolist(), sizes, strict=True))


class Text:
    """A text as alignment needs it: where its words begin and end, their hashes, those of its runs, and the distinct
    runs with their first places and numbers."""

    kept: dict[tuple[str, int], Text] = {}

    def __init__(self, text: str, size: int = LINE):
        self.data = text.encode()
        self.starts, self.ends, self.words = words(self.data)
        self.runs = runs_of(self.words, size)
        order = self.runs.argsort(kind="stable")
        ascending = self.runs[order]
        first = np.ones(len(order), dtype=bool)
        first[1:] = ascending[1:] != ascending[:-1]
        edges = first.nonzero()[0]
        #: Distinct runs, their first places and numbers, and for each run which of them it is.
        self.distinct = ascending[edges], order[edges], np.diff(np.append(edges, len(order)))
        self.which = np.empty(len(order), dtype=np.int64)
        self.which[order] = first.cumsum() - 1
        self._longer: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def longer(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each ``block`` words in a row, and where those start that their hashes choose."""
        if block not in self._longer:
            runs = long_runs(self.words, block)
            reach = min(SPARE + 1, len(runs))
            lowest = _sliding(runs, reach, np.minimum)
            pad = np.zeros(reach - 1, dtype=np.uint64)
            self._longer[block] = runs, np.flatnonzero(runs == _sliding(np.concatenate([pad, lowest, pad]), reach, np.maximum))
        return self._longer[block]

    @classmethod
    def of(cls, text: str, size: int) -> Text:
        """The same object for a text that came not long ago; pairs of one document come together."""
        key = text, size
        if key not in cls.kept:
            if len(cls.kept) >= 32:
                cls.kept.clear()
            cls.kept[key] = cls(text, size)
        return cls.kept[key]


class Shared:
    """The runs that two texts share: where they stand in each, ascending, and their numbers among the other's distinct
    runs."""

    def __init__(self, one: Text, other: Text):
        own, their = one.distinct[0], other.distinct[0]
        self.at = self.number = self.to = self.other_number = np.zeros(0, dtype=np.int64)
        if not len(own) or not len(their):
            return
        k = np.minimum(their.searchsorted(own), len(their) - 1)
        same = their[k] == own
        if not same.any():
            return
        self.at = same[one.which].nonzero()[0]
        self.number = k[one.which[self.at]]
        held = np.zeros(len(their), dtype=bool)
        held[k[same]] = True
        self.to = held[other.which].nonzero()[0]
        self.other_number = other.which[self.to]

    def unique(self, a0: int, a1: int, b0: int, b1: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the runs that start once in ``a0:a1`` and once in ``b0:b1``, ascending by the first."""
        i, j = self.at.searchsorted((a0, a1)).tolist()
        k, m = self.to.searchsorted((b0, b1)).tolist()
        none = np.zeros(0, dtype=np.int64)
        if i == j or k == m:
            return none, none
        own, their = self.number[i:j], self.other_number[k:m]
        a, b = _once(own), _once(their)
        if not len(a) or not len(b):
            return none, none
        own, their = own[a], their[b]
        n = np.minimum(their.searchsorted(own), len(their) - 1)
        both = their[n] == own
        at, to = self.at[i:j][a[both]], self.to[k:m][b[n[both]]]
        order = at.argsort()
        return at[order], to[order]


def _once(values: np.ndarray) -> np.ndarray:
    """Where those values stand that occur once, ascending by value."""
    order = values.argsort(kind="stable")
    ascending = values[order]
    new = ascending[1:] != ascending[:-1]
    once = np.ones(len(order), dtype=bool)
    once[1:] = new
    once[:-1] &= new
    return order[once]


def align(one: Text, other: Text, size: int = LINE, shared: Shared | None = None) -> list[tuple[int, int, int]]:
    """Aligned blocks of two texts by patience diff: start, other start, words."""
    a, b = one.words, other.words
    shared = shared or Shared(one, other)
    out: list[tuple[int, int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if min(a1 - a0, b1 - b0) < size:
            continue
        at, to = shared.unique(a0, a1 - size + 1, b0, b1 - size + 1)
        if not len(at):
            continue
        runs = _diagonals(at, to)
        before = a0, b0
        for x, y, _ in (runs[i] for i in patience(runs)):
            if x < before[0] or y < before[1]:
                continue  # inside the block before, which was extended over it
            back = _same(a[before[0] : x][::-1], b[before[1] : y][::-1])
            x, y = x - back, y - back
            n_same = _same(a[x:a1], b[y:b1])
            if n_same < size:
                continue  # hashes of runs agree, words don't
            out.append((x, y, n_same))
            todo.append((before[0], x, before[1], y))
            before = x + n_same, y + n_same
        if before != (a0, b0):
            todo.append((before[0], a1, before[1], b1))
    return sorted(out)


def elsewhere(one: Text, other: Text, taken: list[tuple[int, int, int]], least: int, size: int = LINE, shared: Shared | None = None) -> list[tuple[int, int]]:
    """Passages of at least ``least`` words outside the taken blocks that the other text holds at any place."""
    a, b = one.words, other.words
    shared = shared or Shared(one, other)
    free = np.ones(len(shared.at), dtype=bool)
    for x, _, n in taken:
        free[slice(*shared.at.searchsorted((x, x + n - size + 1)))] = False
    if not free.any():
        return []
    at = shared.at[free]
    out, end = [], 0
    for x, y, n in _diagonals(at, other.distinct[1][shared.number[free]]):
        if x + n <= end:
            continue
        back = _same(a[end:x][::-1], b[:y][::-1])
        n_same = _same(a[x - back :], b[y - back :])
        if n_same >= least:
            out.append((x - back, n_same))
            end = x - back + n_same
    return out


def _gone(one: Text, owner: Text, block: int, line: int, shared: Shared | None = None) -> list[list[int]]:
    """The words of ``one`` that go because an earlier text is ``owner``, as starts and ends."""
    a = one.words
    if one.data == owner.data and len(a) >= block:
        return [[0, len(a)]]
    shared = shared or Shared(one, owner)
    found = align(one, owner, line, shared)
    moved = elsewhere(one, owner, found, block, line, shared)
    if not found and not moved:
        return []
    first, sizes = _lines(one.data, one.starts)
    lines, spans = first.tolist(), []
    begin = set(lines)
    for x, n in [(x, n) for x, _, n in found] + moved:
        y = x + n
        if n >= block:  # few words of a line at either end are chance
            edges = lines[bisect_right(lines, x) : bisect_left(lines, y)]
            if edges and edges[0] - x <= CHANCE and x not in begin:
                x = edges[0]
            if edges and y - edges[-1] <= CHANCE and y < len(a) and y not in begin:
                y = edges[-1]
            spans.append((x, y))
        else:
            whole = (first >= x) & (first + sizes <= y) & (sizes >= line)
            spans += [(int(i), int(i + k)) for i, k in zip(first[whole], sizes[whole], strict=True)]
    out: list[list[int]] = []
    for x, y in sorted(spans):
        if out and x <= out[-1][1]:
            out[-1][1] = max(out[-1][1], y)
        else:
            out.append([x, y])
    return out


def _places(one: Text, out: list[list[int]]) -> list[tuple[int, int]]:
    """Starts and lengths in characters of such words; white space behind a block goes with it."""
    data, starts = one.data, one.starts
    cuts = [(int(starts[x]) if x else 0, int(starts[y]) if y < len(starts) else len(data)) for x, y in out]
    if not cuts or data.isascii():
        return [(a, b - a) for a, b in cuts]
    place = np.concatenate([[0], np.cumsum(np.frombuffer(data, dtype=np.uint8) & 0xC0 != 0x80)])
    return [(int(place[a]), int(place[b] - place[a])) for a, b in cuts]


def blocks(text: str, other: str, block: int = BLOCK, line: int = LINE) -> list[tuple[int, int]]:
    """The parts of ``text`` that go because an earlier text is ``other``, as start and length in characters."""
    one = Text.of(text, line)
    return _places(one, _gone(one, Text.of(other, line), block, line))


def unexplained(one: Text, owner: Text, out: list[list[int]], block: int = BLOCK, line: int = LINE, shared: Shared | None = None) -> np.ndarray:
    """Hashes of chosen runs of ``block`` words of ``one`` around those runs of ``line`` words that the owner holds as well,
    but as part of no block that goes: another document may hold more of them."""
    if len(one.words) < block or out == [[0, len(one.words)]]:
        return np.zeros(0, dtype=np.uint64)
    at = (shared or Shared(one, owner)).at
    for x, y in out:
        at = at[(at < x) | (at > y - line)]
    if not len(at):
        return np.zeros(0, dtype=np.uint64)
    runs, chosen = one.longer(block)
    # Any BLOCK + SPARE words around a run of ``line`` words hold a chosen one that overlaps it.
    k = np.searchsorted(at, chosen - line + 1)
    near = at[np.minimum(k, len(at) - 1)] - chosen
    return np.unique(runs[chosen[(near > -line) & (near < block)]])


def _pairs(rows: DataFrame) -> DataFrame:
    """``doc, owner``: later documents and the earliest ones that share a hash with them. ``rows``: doc, h."""
    owners = rows.groupBy("h").agg(F.count("*").alias("size"), F.min("doc").alias("owner"), F.max("doc").alias("last"))
    owners = owners.filter("owner < last").drop("last")
    shared = join_groups(rows, owners, "h", "size", max(1, rows.count()))
    return materialize(shared.filter("doc > owner").select("doc", "owner").distinct(), "pairs")


def _aligned(pairs: DataFrame, texts: DataFrame, block: int, line: int) -> DataFrame:
    """``doc, mark, start, len, h``: for each pair the blocks that go, and rows of ``h`` alone, the hashes of longer runs by
    which ``doc`` may belong to another document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                at, rows = [], []
                for i, (own, other) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                    one, owner = Text.of(own, line), Text.of(other, line)
                    shared = None if own == other and len(one.words) >= block else Shared(one, owner)
                    out = _gone(one, owner, block, line, shared)
                    new = [(_mark(one.data), start, size, None) for start, size in _places(one, out)]
                    new += [(None, None, None, h) for h in unexplained(one, owner, out, block, line, shared).view(np.int64).tolist()]
                    rows += new
                    at += [i] * len(new)
                numbers = [pa.array([r[j] for r in rows], pa.int32() if j < 3 else pa.int64()) for j in range(4)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *numbers], names=["doc", "mark", "start", "len", "h"])

    id_type = texts.schema["doc_id"].dataType.simpleString()
    both = with_texts(pairs, texts).select("doc", "own", "other")
    return both.mapInArrow(run, f"doc {id_type}, mark int, start int, len int, h long")


def repeated_blocks(docs: DataFrame, block: int = BLOCK, line: int = LINE) -> DataFrame:
    """``doc, found``: for later documents the blocks that go, as an array of ``mark, start, len`` in characters;
    ``mark`` tells apart texts that share an id."""
    texts = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", text_or_empty().alias("text"))
    pairs = _pairs(materialize(_anchor_rows(texts), "anchors"))
    found = materialize(_aligned(pairs, texts, block, line), "aligned")
    # Second round: what an owner shares only in short runs leads to the earliest document with a long one.
    more = _pairs(found.filter("h IS NOT NULL").select("doc", "h").distinct()).join(pairs, ["doc", "owner"], "left_anti")
    if not (more := materialize(more, "more_pairs")).isEmpty():
        found = found.unionByName(_aligned(more, texts, block, line))
    found = found.filter("mark IS NOT NULL")
    return found.groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("mark", "start", "len"))).alias("found"))


def remove_repeated(docs: DataFrame, block: int = BLOCK, line: int = LINE, removed: str | None = None) -> DataFrame:
    """``docs`` with the repeated blocks taken out of ``text``; with ``removed``, also a last column of that name, the
    number of characters taken out."""
    found = repeated_blocks(docs, block, line)
    key, cut, text = (unused(docs, n) for n in ("doc", "cut", "new_text"))
    # The same columns as in ``repeated_blocks`` where there are no others, so that texts are shuffled once in all.
    rows = docs.select(*(text_or_empty().alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns))
    known = rows.filter(F.col("doc_id").isNotNull())
    found = found.select(F.col("doc").alias(key), F.col("found").alias(cut))
    marked = known.join(found, known["doc_id"] == found[key], "left").drop(key)
    unknown = rows.filter(F.col("doc_id").isNull()).withColumn(cut, F.lit(None).cast(found.schema[cut].dataType))
    rows, whole = marked.unionByName(unknown), F.col("text")
    mine = F.filter(cut, lambda b: b["mark"] == F.crc32(whole.cast("binary")).bitwiseAND(F.lit(0x7FFFFFFF)))

    def kept(parts):  # what stands between the blocks; blocks that overlap leave nothing between them
        before = lambda i: F.coalesce(F.array_max(F.transform(F.slice(parts, 1, i), lambda p: p["start"] + p["len"])), F.lit(0))
        gaps = F.transform(parts, lambda b, i: F.substring(whole, before(i) + 1, F.greatest(F.lit(0), b["start"] - before(i))))
        rest = F.substring(whole, before(F.size(parts)) + 1, F.length(whole))
        return F.rtrim(F.concat(F.array_join(gaps, ""), rest), F.lit(" \n\t\r"))

    rows = rows.withColumn(cut, F.when(F.col(cut).isNotNull(), mine))
    rows = rows.withColumn(text, F.when(F.size(cut) > 0, kept(F.col(cut))).otherwise(whole))
    out = [F.col(text).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    lost = [(F.length(whole) - F.length(text)).cast("long").alias(removed)] if removed else []
    return rows.select(*out, *lost)


def line_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n_removed``: every document with its text after deletion and the characters it lost."""
    return remove_repeated(docs.select("doc_id", "text"), removed="n_removed")
