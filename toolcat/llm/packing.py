"""Packing of documents into sequences by Karmarkar-Karp multiway differencing.

Every document is encoded once, closed by an end id and cut each ``capacity`` tokens. Full pieces are sequences of
their own. The remainder of each document in FILLERS, chosen by a checksum, is cut on into pieces of FILLER_TOKENS,
small change that lets windows come out nearly equal. All remainders are dealt evenly into groups of about ``GROUP`` pieces, as numbers without their ids; in
each group the two partial partitions with the largest differences are merged, the fullest window of one with the
emptiest of the other, until one partition of near-equal windows is left. While its fullest window exceeds the
capacity, the number of windows rises by one and the group is done again, so that the windows stay near-equal.

Null texts count as empty and give one piece with the end id. Null or repeated ``doc_id``: each row is packed by
itself. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from toolcat.llm.common import text_or_empty
from toolcat.llm.tokens import TEXTS, encoder, tokenizer_path

#: Documents to a group: what one task holds, and what bounds its padding to about a window in GROUP / 5.
GROUP = 4096
#: Tasks at most; beyond GROUP times as many documents a task packs several groups, one after the other.
TASKS = 20_000
FILLERS, FILLER_TOKENS = 8, 128


def differencing(lengths: np.ndarray, windows: int) -> list[list[int]]:
    """Positions of ``lengths`` for each of the ``windows``, with sums that differ little."""
    n = len(lengths)
    left, right = list(range(n)), [-1] * n  # nodes: the pieces, then unions of two nodes

    def union(a: int, b: int) -> int:
        left.append(a)
        right.append(b)
        return len(left) - 1

    # A partial partition: its windows' sums, negative and ascending, and their nodes; empty windows aren't listed.
    heap: list = [(-int(x), i, [-int(x)], [i]) for i, x in enumerate(lengths)]
    heapq.heapify(heap)
    count = n
    while len(heap) > 1:
        (_, _, sa, na), (_, _, sb, nb) = heapq.heappop(heap), heapq.heappop(heap)
        if len(sa) < len(sb):
            sa, na, sb, nb = sb, nb, sa, na
        free = windows - len(sa)
        if len(sb) == 1:
            x, node = sb[0], nb[0]
            if not free:  # to the emptiest window
                x, node = x + sa.pop(), union(na.pop(), node)
            at = bisect_right(sa, x)
            sa.insert(at, x)
            na.insert(at, node)
        else:  # the fullest windows of the one join the emptiest of the other, empty ones first
            sa += [0] * free
            na += [-1] * free
            for x, node, at in zip(sb, nb, range(windows - 1, -1, -1), strict=False):
                sa[at] += x
                na[at] = node if na[at] < 0 else union(na[at], node)
            order = sorted((i for i in range(windows) if na[i] >= 0), key=sa.__getitem__)
            sa, na = [sa[i] for i in order], [na[i] for i in order]
        count += 1
        spread = sa[0] - (sa[-1] if len(sa) == windows else 0)
        heapq.heappush(heap, (spread, count, sa, na))
    out = []
    for node in heap[0][3] if heap else []:
        todo, own = [node], []
        while todo:
            x = todo.pop()
            if x < n:
                own.append(x)
            else:
                todo += (right[x], left[x])
        out.append(own)
    return out


def pack_lengths(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``, each a list of positions; empty windows are left out."""
    halves = int((2 * lengths > capacity).sum())  # no two of these share a window
    windows, tries = max(1, halves, -(-int(lengths.sum()) // capacity)), 0
    while True:
        found = differencing(lengths, windows)
        if max(int(lengths[w].sum()) for w in found if w) <= capacity:
            return [w for w in found if w]
        windows, tries = windows + (1 << max(0, tries - 8)), tries + 1  # longer steps where it takes many


def pieces(docs: DataFrame, capacity: int, end_id: int, path: str) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` for each piece; its ids do not leave the task."""
    end = np.array([end_id], dtype="<u4").tobytes()
    id_type = docs.schema["doc_id"].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            at, rows = [], []
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            coded = (x for k in range(0, len(texts), TEXTS) for x in enc.ids(texts[k : k + TEXTS]))
            for i, (doc_id, parts) in enumerate(zip(keys, coded, strict=True)):
                ids = b"".join(parts) + end
                n = len(ids) // 4
                starts = list(range(0, n, capacity))
                if n % capacity and zlib.crc32(f"{doc_id} {zlib.crc32(ids)}".encode()) % FILLERS == 0:
                    starts += range(starts[-1] + FILLER_TOKENS, n, FILLER_TOKENS)
                for start, stop in zip(starts, [*starts[1:], n], strict=True):
                    part = ids[4 * start : 4 * stop]
                    at.append(i)
                    rows.append((start, len(part) // 4, zlib.crc32(part), n))
            columns = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), *columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    schema = f"doc_id {id_type.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(cut, schema)


def pack(
    docs: DataFrame, capacity: int = 4096, end_id: int = 2, path: str | None = None, group: int = GROUP
) -> DataFrame:
    """One row per piece: those of ``pieces`` with ``sequence_id`` and its gapless ``offset`` there."""
    path = path or tokenizer_path("word_bpe_49k.json")
    groups = max(1, -(-docs.count() // group))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, rest, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            full = np.asarray(batch.column(2)) == capacity
            rest.append(batch.filter(pa.array(~full)))
            held += rest[-1].num_rows
            if n := int(full.sum()):
                own = [pa.array(np.arange(sequence, sequence + n)), pa.array(np.zeros(n, dtype=np.int64))]
                sequence += n
                yield pa.RecordBatch.from_arrays([*batch.filter(pa.array(full)).columns, *own], names=names)
            if held > 4 * group:  # a task of several groups
                packed, sequence = packed_group(rest, sequence)
                rest, held = [], 0
                yield from packed
        if held:
            yield from packed_group(rest, sequence)[0]

    def packed_group(rest: list[pa.RecordBatch], sequence: int) -> tuple[list[pa.RecordBatch], int]:
        """The pieces of one group with their places, and the next sequence's number."""
        whole = pa.Table.from_batches(rest).combine_chunks()
        lengths = np.asarray(whole.column(2))
        order, ids, offsets = [], [], []
        for window in pack_lengths(lengths, capacity):
            order += window
            ids += [sequence] * len(window)
            offsets += [0, *np.cumsum(lengths[window])[:-1].tolist()]
            sequence += 1
        packed = whole.take(pa.array(order, pa.int64())).combine_chunks()
        packed = packed.append_column("sequence_id", pa.array(ids, pa.int64()))
        return packed.append_column("offset", pa.array(offsets, pa.int64())).to_batches(), sequence

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    cut = pieces(docs, capacity, end_id, path)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    return cut.repartition(min(groups, TASKS)).mapInArrow(assign, schema)
