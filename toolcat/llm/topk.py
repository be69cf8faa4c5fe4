"""Exact top-k inner-product search by distributed histogram selection.

Queries are taken in blocks of bounded size. For a block, every task scores its vectors against all queries and
counts the scores in bins; the summed histograms tell in which bin each query's k-th best score lies, and that bin
is refined until it is one value. Then one more pass keeps the rows from there on, each task its own k best at
most, and ties go to the smaller ``vec_id``. No score is stored and no row pairs are shuffled.

Components become ``floor(scale * x)``; scores are exact integers (beyond the range of a long they saturate).
Vectors that are null or hold null or non-finite components take no part, nor do rows without ``vec_id``. Missing
components of a shorter vector count as zero; an empty vector scores zero. Repeated rows: a ``vec_id`` is asked
once (its least vector), each row is a candidate, and rows that share the query's ``vec_id`` are the query's own.
Other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from toolcat.llm.common import materialize, shared_dir

#: Queries in a block, bins of a histogram, and scores that a task holds at once.
BLOCK, DIGIT, CELLS = 2048, 9, 1 << 21
BINS = 1 << DIGIT
_LONG = 2**63 - 1


def _usable(vectors: DataFrame) -> DataFrame:
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    return vectors.select("vec_id", "embedding").filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite
    )


def _matrix(lists: pa.ListArray, scale: float) -> np.ndarray:
    """The integer components, as doubles, one row for each list; short rows are filled up with zeros."""
    lengths = np.asarray(lists.value_lengths()).astype(np.int64)
    values = np.floor(scale * np.asarray(lists.flatten()).astype(np.float64))
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of a and b."""
    n = min(a.shape[1], b.shape[1])
    a, b = a[:, :n], b[:, :n]
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, n) < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(a) @ whole(b).T if n else np.zeros((len(a), len(b)), dtype=object)
    return np.clip(exact, -_LONG, _LONG).astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], queries: int, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    rows = max(1, CELLS // max(1, queries))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield np.asarray(part.column(0)).astype(np.int64), _matrix(part.column(1), scale)


def _select(base: DataFrame, ids: np.ndarray, asked: np.ndarray, k: int, scale: float, bound: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` of one block of queries."""
    sc, n = base.sparkSession.sparkContext, len(ids)
    block, offset = sc.broadcast((ids, asked)), np.uint64(bound)
    bits = (2 * bound).bit_length()
    # Scores count from -bound on. Digit by digit, from the highest, the k-th best score of each query is found.
    prefix, need, live = np.zeros(n, dtype=np.uint64), np.full(n, k, dtype=np.int64), np.ones(n, dtype=bool)
    for shift in range(max(0, -(-bits // DIGIT) - 1) * DIGIT, -1, -DIGIT):
        if not live.any():
            break
        state = sc.broadcast((prefix, need, live, shift))

        def histogram(batches: Iterator[pa.RecordBatch], block=block, state=state) -> Iterator[pa.RecordBatch]:
            (ids, asked), (prefix, need, live, shift) = block.value, state.value
            q = np.flatnonzero(live)
            counts = np.zeros((len(q), BINS), dtype=np.int64)
            for vec_ids, vectors in _chunks(batches, len(q), scale):
                u = _scores(asked[q], vectors).view(np.uint64) + offset
                digits = ((u >> np.uint64(shift)) & np.uint64(BINS - 1)).astype(np.int64)
                above = u >> np.uint64(shift + DIGIT) if shift + DIGIT < 64 else np.zeros_like(u)
                inside = (above == prefix[q, None]) & (ids[q, None] != vec_ids[None, :])
                flat = (np.arange(len(q))[:, None] * BINS + digits)[inside]
                counts += np.bincount(flat, minlength=counts.size).reshape(counts.shape)
            before = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts  # what lies in higher bins
            at, bins = np.nonzero((counts > 0) & (before < need[q, None]))  # below these no k-th score can lie
            yield pa.RecordBatch.from_arrays(
                [pa.array(q[at]), pa.array(bins), pa.array(counts[at, bins])], names=["q", "bin", "n"]
            )

        found = base.mapInArrow(histogram, "q long, bin long, n long").groupBy("q", "bin").agg(F.sum("n").alias("n")).toArrow()
        whole = np.zeros((n, BINS), dtype=np.int64)  # at most BINS numbers for each query of the block
        whole[found.column(0).to_numpy(), found.column(1).to_numpy()] = found.column(2).to_numpy()
        total = np.cumsum(whole[:, ::-1], axis=1)  # from the highest bin down
        for q in np.flatnonzero(live):
            if total[q, -1] < need[q]:  # fewer rows than k: all of them
                live[q] = False
                continue
            b = int(np.searchsorted(total[q], need[q]))
            need[q] -= total[q, b - 1] if b else 0
            prefix[q] = (prefix[q] << np.uint64(DIGIT)) | np.uint64(BINS - 1 - b)
    low = np.where(live, (prefix - offset).view(np.int64), -_LONG)
    limits = sc.broadcast(low)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (ids, asked), low = block.value, limits.value
        q_at, v_at, s_at = (np.zeros(0, dtype=np.int64) for _ in range(3))
        for vec_ids, vectors in _chunks(batches, len(ids), scale):
            s = _scores(asked, vectors)
            q, v = np.nonzero((s >= low[:, None]) & (ids[:, None] != vec_ids[None, :]))
            q_at, v_at = np.concatenate([q_at, q]), np.concatenate([v_at, vec_ids[v]])
            s_at = np.concatenate([s_at, s[q, v]])
            order = np.lexsort((v_at, -s_at, q_at))
            q_at, v_at, s_at = q_at[order], v_at[order], s_at[order]
            rank = np.arange(len(q_at)) - np.searchsorted(q_at, q_at)
            q_at, v_at, s_at = (x[rank < k] for x in (q_at, v_at, s_at))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[q_at]), pa.array(v_at), pa.array(s_at)], names=["query_id", "vec_id", "score"]
        )

    rows = base.mapInArrow(keep, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def exact_topk(
    candidates: DataFrame, queries: DataFrame, k: int = 10, scale: float = 1024.0, block: int = BLOCK
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of each query, without its own rows."""
    spark = candidates.sparkSession
    base = _usable(candidates).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    asked = _usable(queries).groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("embedding").alias("embedding"))
    asked = materialize(asked, "asked")
    largest = lambda x: F.aggregate(
        x, F.lit(0.0), lambda s, e: s + F.floor(F.lit(scale) * e.cast("double")).cast("double") ** 2
    )
    norm = base.agg(F.max(largest(F.col("embedding")))).first()[0] or 0.0
    wide = asked.agg(F.max(largest(F.col("embedding"))), F.count("*")).first()
    bound = int(min(float(_LONG), np.sqrt(norm) * np.sqrt(wide[0] or 0.0) * 1.001 + 2))
    bound = min(bound, _LONG)
    blocks = max(1, -(-wide[1] // block))
    path = f"{shared_dir(spark)}/topk-{uuid.uuid4().hex}"
    schema = "query_id long, rank int, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(path)
    for b in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").toArrow().combine_chunks()
        if part.num_rows:  # about ``block`` queries, whatever the number of rows
            lists = part.column(1).combine_chunks() if isinstance(part.column(1), pa.ChunkedArray) else part.column(1)
            ids = np.asarray(part.column(0)).astype(np.int64)
            _select(base, ids, _matrix(lists, scale), k, scale, bound).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
