"""Removal of repeated byte strings by prefix-free parsing, with suffix ranks of phrases combined into corpus order.

A rolling hash runs over each ``TRIGGER`` bytes; the trigger of a string of ``WIDTH`` bytes is the one with the least
hash in it (the first of equal ones), so every such string holds its trigger, and equal strings hold it at the same place.
Triggers cut a text into phrases. The strings with one trigger reach from some way into the phrase before it to some way
into the phrases after it; that stretch is its context. Contexts that are equal in a chunk of documents are one entry of
its dictionary, which keeps the least ``doc_id``.

Only entries whose trigger stands in several documents move: the chunks' sorted trigger hashes are counted in ranges
first, and what comes back is a bit for each. A task then gets all entries of a range of triggers, sorts what stands
before the trigger, read backwards (the phrase suffixes), and what stands from it on (the suffixes of the parse), and
takes the longest common prefix of neighbours in both orders. Two strings of ``WIDTH`` bytes that reach ``o`` bytes before
their trigger are equal if they agree to ``o`` in the first order and to ``WIDTH - o`` in the second: pairs of ranks sort
all strings in corpus order, exactly and without comparing texts again. In each class of equal strings all but those of
the least ``doc_id`` are repeats. A trigger that stands in very many places (over ``HEAVY``) would gather too much in one
task; its strings are dealt one by one by their own bytes, with the same result.

Null texts count as empty. Rows with a null ``doc_id`` stay whole and own nothing. Rows that share a ``doc_id`` are parts
of one document and don't take from each other. A string that repeats only inside one document stays. Texts shorter
than ``WIDTH`` bytes come back unchanged, whatever they are copies of. Other columns are ignored; an empty table gives no
rows. A single text is handled by one task, in memory that grows linearly with it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from toolcat.llm.common import materialize, text_or_empty
from toolcat.llm.packed import pack, unpack

WIDTH, TRIGGER = 50, 16
#: Bytes before a trigger that a string can hold.
REACH = WIDTH - TRIGGER
CHUNK, HEAVY = 4 << 20, 4096
#: Trigger hashes, and entries of dictionaries, that one range should get; ranges there are at least.
HASHES, ENTRIES, RANGES = 1 << 22, 1 << 17, 256
_PIECE_BITS = 17
_BITS = 64 - _PIECE_BITS
_P, _Q, _R = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def _hashes(b: np.ndarray) -> np.ndarray:
    """The hash of each ``TRIGGER`` bytes."""
    h = (b.astype(np.uint64) + np.uint64(1)) * _P
    h ^= h >> np.uint64(29)
    size = 1
    while size < TRIGGER:
        h = h[:-size] * _Q + h[size:]
        h ^= h >> np.uint64(31)
        size *= 2
    return h


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` values in a row."""
    done = 1
    while done < size:
        step = min(done, size - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def triggers(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Triggers of the strings in texts that lie one after the other: their places, the first and the last start of the
    strings that have them, and their hashes, in order of place. ``edges``: where texts start, and the end."""
    n, parts = len(data) - WIDTH + 1, []
    mask = np.uint64((1 << _PIECE_BITS) - 1)
    size = (1 << _PIECE_BITS) - REACH
    blocked = np.zeros(max(n, 0), dtype=bool)  # starts of strings that would go over a text's end
    for end in edges[1:-1].tolist():
        blocked[max(0, end - WIDTH + 1) : end] = True
    for begin in range(0, n, size):
        h = _hashes(data[begin : begin + size + WIDTH - 1])
        low = _least((h & ~mask) | np.arange(len(h), dtype=np.uint64), REACH + 1)
        start = np.flatnonzero(~blocked[begin : begin + len(low)])
        if not len(start):
            continue
        low = low[start]
        change = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
        last = start[np.r_[change[1:] - 1, len(start) - 1]]
        low = low[change]
        mixed = (low >> np.uint64(_PIECE_BITS)) * _R >> np.uint64(_PIECE_BITS)  # least hashes are small; these are spread evenly
        parts.append((begin + (low & mask).astype(np.int64), begin + start[change], begin + last, mixed.astype(np.int64)))
    if not parts:
        return (np.zeros(0, dtype=np.int64),) * 4
    at, first, last, h = (np.concatenate(x) for x in zip(*parts, strict=True))
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])  # a trigger may go on from one piece to the next
    return at[new], first[new], last[np.r_[new[1:] - 1, len(at) - 1]], h[new]


class Chunk:
    """The texts of a chunk, their triggers and the dictionary of those contexts that may repeat elsewhere."""

    def __init__(self, data):
        columns = unpack(data)
        self.ids, texts = columns["doc_id"], columns["text"]
        self.sizes = np.diff(np.frombuffer(texts.buffers()[1], dtype=np.int32, count=len(texts) + 1, offset=4 * texts.offset))
        self.edges = np.concatenate([[0], np.cumsum(self.sizes, dtype=np.int64)])
        self.bytes = np.frombuffer(b"".join(t.as_buffer() for t in texts), dtype=np.uint8)
        self.at, self.first, self.last, h = triggers(self.bytes, self.edges)
        self.doc = np.searchsorted(self.edges, self.first, "right") - 1
        if self.ids.null_count:
            keep = self.ids.is_valid().to_numpy(zero_copy_only=False)[self.doc]
            self.at, self.first, self.last, self.doc, h = (x[keep] for x in (self.at, self.first, self.last, self.doc, h))
        self.hashes, self.number, self.counts = np.unique(h, return_inverse=True, return_counts=True)
        known = [i for i in self.ids.to_pylist() if i is not None]
        place = {v: k for k, v in enumerate(sorted(set(known)))}
        self.rank = np.array([place.get(i, -1) for i in self.ids.to_pylist()], dtype=np.int64)[self.doc] if len(known) else self.doc

    def dictionary(self, shared: np.ndarray) -> None:
        """Number the contexts of triggers that are shared, by the bits of their hashes or by documents of the chunk.
        ``entry`` is -1 for others; ``owner`` is the occurrence with the least id of each entry."""
        low, high = np.full(len(self.hashes), len(self.sizes)), np.full(len(self.hashes), -1)
        np.minimum.at(low, self.number, self.rank)
        np.maximum.at(high, self.number, self.rank)
        self.some = np.flatnonzero((shared | (low < high))[self.number])
        start, size = self.first[self.some], self.last[self.some] - self.first[self.some] + WIDTH
        columns = np.arange(WIDTH + REACH + 4)
        table = self.bytes[np.minimum(start[:, None] + columns, len(self.bytes) - 1)] if len(start) else np.zeros((0, len(columns)), dtype=np.uint8)
        table[columns >= size[:, None]] = 0
        before = self.at[self.some] - start
        words = np.column_stack([table.view(np.uint64), (size * 64 + before).astype(np.uint64)])
        mixed = np.zeros(len(words), dtype=np.uint64)
        for k in range(words.shape[1]):
            mixed = (mixed ^ words[:, k]) * _Q
            mixed ^= mixed >> np.uint64(29)
        order = np.lexsort((self.rank[self.some], mixed))
        words = words[order]
        new = np.concatenate([[True], (words[1:] != words[:-1]).any(axis=1)]) if len(order) else np.zeros(0, dtype=bool)
        self.entry = np.empty(len(order), dtype=np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.owner = order[new]  # positions in ``some``
        if len(order):  # equal contexts that a collision of hashes parts are entries of their own
            least = np.full(len(self.owner), np.iinfo(np.int64).max)
            np.minimum.at(least, self.entry, self.rank[self.some])
            self.least = least
        else:
            self.least = np.zeros(0, dtype=np.int64)
        self.table = table[self.owner]
        self.size, self.before = size[self.owner], before[self.owner]
        self.after = before[self.owner] - (self.last[self.some] - self.first[self.some])[self.owner]  # the least o


def _chunks(docs: DataFrame) -> DataFrame:
    """``chunk, size, data``: documents of about ``CHUNK`` bytes together, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            data = pack(doc_id=pa.array(ids, kind), text=pa.array(texts, pa.binary()))
            number = uuid.uuid4().int >> 65
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([held], pa.int64()), pa.array([data], pa.binary())], names=["chunk", "size", "data"])

        ids, texts, held, kind = [], [], 0, None
        for batch in batches:
            kind = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc_id)
                texts.append(text.as_py())
                held += len(texts[-1])
                if held >= CHUNK or len(ids) >= 1 << 16:
                    yield done()
                    ids, texts, held = [], [], 0
        if ids:
            yield done()

    rows = docs.select("doc_id", text_or_empty().cast("binary").alias("text"))
    return materialize(rows.mapInArrow(run, "chunk long, size long, data binary"), "chunks")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each range; they come sorted by it."""
    rows: list[dict] = []
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(j)[i] for j, n in enumerate(batch.schema.names)}
            if rows and row["range"] != rows[0]["range"]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _slices(hashes: np.ndarray, ranges: int) -> list[tuple[int, int, int]]:
    """Range, begin and end of the parts of sorted hashes."""
    of = (hashes.astype(object) * ranges >> _BITS).astype(np.int64) if ranges >> (63 - _BITS) else hashes * ranges >> _BITS
    cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]).tolist() if len(of) else []
    return [(int(of[a]), a, b) for a, b in zip(cuts, [*cuts[1:], len(of)], strict=True)]


def _shared(chunks: DataFrame, ranges: int, heavy: int) -> DataFrame:
    """``chunk, bits``: for the sorted trigger hashes of a chunk, by range, whether another chunk has them and whether
    they stand in over ``heavy`` places."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                chunk = Chunk(data)
                length = np.minimum(np.frexp(chunk.counts.astype(float))[1], 255).astype(np.uint8)
                parts = _slices(chunk.hashes, ranges)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for r, _, _ in parts], pa.int64()), pa.array([number] * len(parts), pa.int64()),
                     pa.array([chunk.hashes[a:b].tobytes() for _, a, b in parts], pa.binary()), pa.array([length[a:b].tobytes() for _, a, b in parts], pa.binary())],
                    names=["range", "chunk", "hashes", "lengths"],
                )

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            parts = [np.frombuffer(r["hashes"].as_buffer(), dtype=np.int64) for r in rows]
            length = np.concatenate([np.frombuffer(r["lengths"].as_buffer(), dtype=np.uint8) for r in rows]).astype(np.int64)
            _, number, chunks_of = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
            places = np.bincount(number, weights=2.0 ** (length - 1))
            flags = ((chunks_of > 1) + 2 * (places > heavy)).astype(np.uint8)[number]
            cuts = np.cumsum([0] + [len(p) for p in parts])
            data = [flags[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["chunk"].as_py() for r in rows], pa.int64()), pa.array([rows[0]["range"].as_py()] * len(rows), pa.int64()), pa.array(data, pa.binary())],
                names=["chunk", "range", "flags"],
            )

    counted = chunks.select("chunk", "data").mapInArrow(count, "range long, chunk long, hashes binary, lengths binary")
    counted = counted.repartition("range").sortWithinPartitions("range")
    found = counted.mapInArrow(bits, "chunk long, range long, flags binary")
    return materialize(found.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("range", "flags"))).alias("bits")), "bits")


def _flags(cell) -> np.ndarray:
    """The flags of a chunk's hashes, from its list of ranges."""
    parts = cell.as_py() or []
    return np.frombuffer(b"".join(p["flags"] for p in parts), dtype=np.uint8)


def _entries(chunks: DataFrame, ranges: int, id_kind: str) -> DataFrame:
    """``range, chunk, entries, docs, before, after, sizes, bytes``: the dictionary entries of a chunk in each range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data, cell in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                chunk, flags = Chunk(data), _flags(cell)
                chunk.dictionary((flags & 1) > 0)
                if not len(chunk.owner):
                    continue
                of = chunk.some[chunk.owner]
                key, entry = chunk.hashes[chunk.number[of]], np.arange(len(of))
                before, after, size, table = chunk.before, chunk.after, chunk.size, chunk.table
                if len(heavy := np.flatnonzero((flags[chunk.number[of]] & 2) > 0)):
                    # Each string of a heavy trigger goes by its own bytes.
                    light = np.setdiff1d(entry, heavy)
                    times = before[heavy] - after[heavy] + 1
                    e = np.repeat(heavy, times)
                    o = before[e] - (np.arange(len(e)) - np.repeat(np.cumsum(times) - times, times))
                    strings = table[e[:, None], (before[e] - o)[:, None] + np.arange(table.shape[1])[None, :] % WIDTH]
                    strings[:, WIDTH:] = 0
                    mixed = np.zeros(len(e), dtype=np.uint64)
                    for k in range(strings.shape[1] // 8):
                        mixed = (mixed ^ np.ascontiguousarray(strings).view(np.uint64)[:, k]) * _R
                        mixed ^= mixed >> np.uint64(32)
                    key = np.concatenate([key[light], (mixed >> np.uint64(_PIECE_BITS)).astype(np.int64)])
                    entry, table = np.concatenate([light, e]), np.concatenate([table[light], strings])
                    size = np.concatenate([size[light], np.full(len(e), WIDTH)])
                    before, after = np.concatenate([before[light], o]), np.concatenate([after[light], o])
                order = np.argsort(key, kind="stable")
                ids = chunk.ids.take(pa.array(chunk.doc[of][entry[order]]))
                inside = np.arange(table.shape[1]) < size[order][:, None]
                text, ends = table[order][inside], np.concatenate([[0], np.cumsum(size[order])])
                parts = _slices(key[order], ranges)
                cuts = pa.array([a for _, a, _ in parts] + [len(order)], pa.int32())
                columns = [pa.array([r for r, _, _ in parts], pa.int64()), pa.array([number] * len(parts), pa.int64())]
                columns += [pa.ListArray.from_arrays(cuts, pa.array(entry[order].astype(np.int32))), pa.ListArray.from_arrays(cuts, ids)]
                for x in (before, after, size):
                    x = x[order].astype(np.uint8)
                    columns.append(pa.array([x[a:b].tobytes() for _, a, b in parts], pa.binary()))
                columns.append(pa.array([text[ends[a] : ends[b]].tobytes() for _, a, b in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["range", "chunk", "entries", "docs", "before", "after", "sizes", "bytes"])

    return chunks.mapInArrow(run, f"range long, chunk long, entries array<int>, docs array<{id_kind}>, before binary, after binary, sizes binary, bytes binary")


def _ordered(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of rows of bytes in ascending order, and how many bytes each row shares with the one before it."""
    words = table.view(">u8")
    order = np.lexsort(tuple(words[:, k] for k in range(words.shape[1] - 1, -1, -1)))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    differ = table[order[1:]] != table[order[:-1]]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), table.shape[1])
    return rank, np.concatenate([[0], shared])


def repeats(bytes_: np.ndarray, size: np.ndarray, before: np.ndarray, after: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each context the strings that a context of a lesser ``doc`` holds, as bits by their reach before the
    trigger. Contexts lie in ``bytes_`` one after the other, sorted by ``doc``."""
    start = np.cumsum(size) - size
    at = start + before
    columns, end = np.arange(56), len(bytes_) - 1
    left = bytes_[np.clip(at[:, None] - 1 - columns[:40], 0, end)]
    left[columns[:40] >= before[:, None]] = 0
    right = bytes_[np.clip(at[:, None] + columns, 0, end)]
    right[columns >= (size - before)[:, None]] = 0
    (left_rank, left_shared), (right_rank, right_shared) = _ordered(left), _ordered(right)
    mask = np.zeros(len(size), dtype=np.int64)
    for o in range(REACH + 1):
        rows = np.flatnonzero((after <= o) & (o <= before))
        if len(rows) < 2:
            continue
        key = np.cumsum(left_shared < o)[left_rank[rows]] * (len(size) + 1) + np.cumsum(right_shared < WIDTH - o)[right_rank[rows]]
        order = np.argsort(key, kind="stable")
        new = np.r_[True, key[order[1:]] != key[order[:-1]]]
        least = doc[rows[order]][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        gone = doc[rows[order]] > least
        mask[rows[order[gone]]] |= 1 << o
    return mask


def _repeats(entries: DataFrame) -> DataFrame:
    """``chunk, found``: for the entries of each chunk the strings that a lesser document holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            before, after, size = (np.concatenate([np.frombuffer(r[n].as_buffer(), dtype=np.uint8) for r in rows]).astype(np.int64) for n in ("before", "after", "sizes"))
            ids = [i for r in rows for i in r["docs"].values.to_pylist()]
            place = {v: k for k, v in enumerate(sorted(set(ids)))}
            doc = np.array([place[i] for i in ids], dtype=np.int64)
            text = np.frombuffer(b"".join(r["bytes"].as_buffer() for r in rows), dtype=np.uint8)
            order = np.argsort(doc, kind="stable")
            starts = np.cumsum(size) - size
            offset = np.arange(size.sum()) - np.repeat(np.cumsum(size[order]) - size[order], size[order])
            text = text[np.repeat(starts[order], size[order]) + offset]
            mask = np.empty(len(order), dtype=np.int64)
            mask[order] = repeats(text, size[order], before[order], after[order], doc[order])
            cut, chunks, found = 0, [], []
            for r in rows:
                entry = r["entries"].values.to_numpy()
                own = mask[cut : cut + len(entry)]
                cut += len(entry)
                if own.any():
                    chunks.append(r["chunk"].as_py())
                    found.append(np.column_stack([entry[own != 0].astype(np.int64), own[own != 0]]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(found, pa.binary())], names=["chunk", "found"])

    dealt = entries.repartition("range").sortWithinPartitions("range")
    return dealt.mapInArrow(run, "chunk long, found binary").groupBy("chunk").agg(F.collect_list("found").alias("found"))


def _covered(chunk: Chunk, found: np.ndarray) -> np.ndarray:
    """Which bytes of a chunk go; ``found``: entries and bits."""
    bits = np.zeros(len(chunk.owner), dtype=np.int64)
    np.bitwise_or.at(bits, found[:, 0], found[:, 1])
    edge = np.zeros(len(chunk.bytes) + 1, dtype=np.int32)
    whole = chunk.some[chunk.rank[chunk.some] > chunk.least[chunk.entry]]  # a lesser document of the chunk has all of it
    np.add.at(edge, chunk.first[whole], 1)
    np.add.at(edge, chunk.last[whole] + WIDTH, -1)
    part = np.flatnonzero(bits[chunk.entry])
    own, at = bits[chunk.entry[part]], chunk.at[chunk.some[part]]
    for o in range(REACH + 1):
        start = at[(own >> o) & 1 > 0] - o
        np.add.at(edge, start, 1)
        np.add.at(edge, start + WIDTH, -1)
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """``doc_id, kept, n_bytes, n_removed, n_spans``: for every document the bytes that stay, how many it had and lost,
    and in how many stretches. Bytes go that lie in ``WIDTH`` bytes which a document with a lesser id holds as well."""
    kind = docs.schema["doc_id"].dataType
    id_kind, arrow_kind = kind.simpleString(), to_arrow_type(kind)
    chunks = _chunks(docs)
    size = chunks.agg(F.sum("size")).first()[0] or 0
    hashes = 2 * size // (REACH + 2)
    bits = _shared(chunks, max(RANGES, hashes // HASHES), heavy)
    marked = chunks.select("chunk", "data").join(bits, "chunk", "left")
    entries = _entries(marked.select("chunk", "data", "bits"), max(RANGES, hashes // ENTRIES), id_kind)
    found = materialize(_repeats(entries), "repeats")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, cell, parts in zip(*batch.columns, strict=True):
                chunk = Chunk(data)
                chunk.dictionary((_flags(cell) & 1) > 0)
                pairs = np.frombuffer(b"".join(parts.as_py() or []), dtype=np.int64).reshape(-1, 2)
                gone = _covered(chunk, pairs)
                kept, removed, spans = [], [], []
                for a, b in zip(chunk.edges[:-1].tolist(), chunk.edges[1:].tolist(), strict=True):
                    own = gone[a:b]
                    kept.append(chunk.bytes[a:b][~own].tobytes())
                    removed.append(b - a - len(kept[-1]))
                    spans.append(int(np.count_nonzero(own[1:] & ~own[:-1]) + (b > a and own[0])))
                numbers = [pa.array(x, pa.int64()) for x in (chunk.sizes, removed, spans)]
                yield pa.RecordBatch.from_arrays([chunk.ids.cast(arrow_kind), pa.array(kept, pa.binary()), *numbers], names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    done = marked.join(found, "chunk", "left").select("data", "bits", "found")
    return done.mapInArrow(run, f"doc_id {id_kind}, kept binary, n_bytes long, n_removed long, n_spans long")
