"""Ranked lexical search over a length-stratified inverted index.

A term is a maximal run of ASCII letters and digits and of all signs beyond ASCII, with A-Z lower-cased. A document of
n terms has the normaliser m = 100 - S + (S n N) div L, where S = 50, N counts the documents with a term and L their
terms; a term that stands tf times in it adds w * ((10^9 tf) div (1000 tf + 20 m)) to its score, and w follows from
N and the number of documents that hold the term.

``build`` writes the index: documents stay where they are read, and each ``SHARD`` bytes of text become a shard. In it
documents are grouped into strata of equal m; a term's postings are grouped by stratum and in it by tf, highest first,
so that one impact stands for a whole group of documents and the first group of a stratum bounds it. ``search`` adds up
those bounds, visits the strata of a shard from the highest bound down and stops where no bound reaches the k-th score
found so far in the task. Only the best k of each task are shuffled, in which ties go to the smaller ``doc_id``.

Queries come in blocks of at most ``ITEMS`` rows and ``QUERY_TERMS`` different terms (a single larger query is a block of
its own), each against all shards. All counts cover all documents and all of each text.

Null texts and texts without terms count in neither N nor L and are never found. Rows with a null ``doc_id`` count, but
aren't returned. Repeated rows are ranked each by itself. Queries without terms, or whose terms no document holds, give
no rows; equal queries get the same ranks. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from toolcat.llm.common import materialize, text_or_empty
from toolcat.llm.packed import pack, unpack

SHARD, ITEMS, QUERY_TERMS, SLOPE = 16 << 20, 2000, 200_000, 50
#: Bytes that belong to terms, lower-cased; all others become spaces.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM).split()


@dataclass
class Index:
    """``shards``: ``data``, a packed shard a row. ``docs`` and ``tokens`` are N and L."""

    shards: DataFrame
    docs: int
    tokens: int
    id_type: T.DataType


def _shard(ids: list, counts: list[int], words: list[np.ndarray], number: dict[bytes, int], docs: int, tokens: int, kind: pa.DataType) -> bytes:
    """A packed shard of documents: their ids, how many terms each has, the terms' numbers."""
    size = np.array(counts, dtype=np.int64)
    norms = {n: 100 - SLOPE + SLOPE * n * docs // tokens for n in set(counts)}
    m = np.array([norms[n] for n in counts], dtype=np.int64)
    order = np.argsort(m, kind="stable")  # rows are numbered along the strata
    row = np.empty(len(order), dtype=np.int64)
    row[order] = np.arange(len(order))
    strata, first = np.unique(m[order], return_index=True)
    posting, tf = np.unique(np.concatenate(words) * len(size) + np.repeat(row, size), return_counts=True)
    term, row = posting // len(size), posting % len(size)
    stratum = np.searchsorted(first, row, "right") - 1
    by = np.lexsort((row, -tf, stratum, term))
    term, row, stratum, tf = term[by], row[by], stratum[by], tf[by]
    group = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1]) | (tf[1:] != tf[:-1])])
    known = np.flatnonzero(np.r_[True, term[group[1:]] != term[group[:-1]]])
    small = lambda x: pa.array(x.astype(np.int32))
    lists = {
        "docs": pa.array(ids, kind).take(pa.array(order)),
        "norms": pa.array(strata),
        "strata": small(np.r_[first, len(size)]),
        "terms": pa.array(list(number), pa.binary()),  # numbers follow this order
        "term_groups": small(np.r_[known, len(group)]),
        "group_strata": small(stratum[group]),
        "group_tfs": small(tf[group]),
        "group_rows": small(np.r_[group, len(row)]),
        "rows": small(row),
    }
    return pack(**{k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for k, v in lists.items()})


def build(docs: DataFrame) -> Index:
    """The index of all documents, written to the shared folder."""
    rows = docs.select("doc_id", text_or_empty().cast("binary").alias("text"))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(terms(t.as_py())) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([sum(x > 0 for x in n)], pa.int64()), pa.array([sum(n)], pa.int64())], names=["docs", "tokens"])

    total = rows.select("text").mapInArrow(sizes, "docs long, tokens long").agg(F.sum("docs"), F.sum("tokens")).first()
    n_docs, n_tokens = total[0] or 0, total[1] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            data = _shard(ids, counts, words, number, n_docs, n_tokens, kind)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["data"])

        ids, counts, words, number, held, kind = [], [], [], defaultdict(count().__next__), 0, None
        for batch in batches:
            kind = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if not (found := terms(text)):
                    continue
                ids.append(doc_id)
                counts.append(len(found))
                words.append(np.fromiter(map(number.__getitem__, found), dtype=np.int64, count=len(found)))
                held += len(text)
                if held >= SHARD:
                    yield done()
                    ids, counts, words, number, held = [], [], [], defaultdict(count().__next__), 0
        if ids:
            yield done()

    return Index(materialize(rows.mapInArrow(run, "data binary"), "lexical"), n_docs, n_tokens, docs.schema["doc_id"].dataType)


class Shard:
    def __init__(self, data):
        lists = {k: v.values for k, v in unpack(data).items()}
        self.terms, self.docs = lists.pop("terms"), lists.pop("docs")
        self.named = self.docs.is_valid().to_numpy(zero_copy_only=False)
        for k, v in lists.items():
            setattr(self, k, v.to_numpy(zero_copy_only=False))

    def places(self, words: pa.Array) -> np.ndarray:
        """The number of each word in the shard, -1 where it has none."""
        return pc.fill_null(pc.index_in(words, value_set=self.terms), -1).to_numpy(zero_copy_only=False)

    def frequency(self, term: int) -> int:
        first, end = self.term_groups[term], self.term_groups[term + 1]
        return int(self.group_rows[end] - self.group_rows[first])

    def best(self, weighted: list[tuple[int, int]], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores that hold all of the shard's best ``k`` that reach ``least``. ``weighted``: terms and w."""
        bound = np.zeros(len(self.norms), dtype=np.int64)
        lists = []
        for term, w in weighted:
            groups = slice(self.term_groups[term], self.term_groups[term + 1])
            stratum, tf = self.group_strata[groups], self.group_tfs[groups].astype(np.int64)
            impact = w * (1_000_000_000 * tf // (1000 * tf + 20 * self.norms[stratum]))
            top = np.r_[True, stratum[1:] != stratum[:-1]]  # tf falls within a stratum
            bound[stratum[top]] += impact[top]
            starts = self.group_rows[groups.start : groups.stop + 1]
            lists.append((stratum, impact, starts[:-1], np.diff(starts)))
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        scores = np.zeros(len(self.docs), dtype=np.int64)
        rows, at, step = np.zeros(0, dtype=np.int64), 0, 8
        while at < len(order) and bound[order[at]] >= least:
            some = order[at : at + step]
            visit = np.zeros(len(bound), dtype=bool)
            visit[some[bound[some] >= least]] = True
            hit = [rows]
            for stratum, impact, starts, sizes in lists:
                chosen = visit[stratum]
                size = sizes[chosen]
                offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                found = self.rows[np.repeat(starts[chosen], size) + offset]
                scores[found] += np.repeat(impact[chosen], size)
                hit.append(found)
            rows = np.unique(np.concatenate(hit))
            rows = rows[(scores[rows] > 0) & self.named[rows]]
            if len(rows) > k:
                least = max(least, int(np.partition(scores[rows], len(rows) - k)[len(rows) - k]))
                rows = rows[scores[rows] >= least]
            at, step = at + step, 4 * step
        return rows, scores[rows]


def _blocks(queries: DataFrame) -> Iterator[tuple[list, list[Counter]]]:
    """Blocks of item ids and their terms, read one after the other."""
    ids, items, size = [], [], 0
    for row in queries.select("item_id", text_or_empty().cast("binary").alias("text")).toLocalIterator():
        own = Counter(terms(bytes(row["text"])))
        if not own:
            continue
        if ids and (len(ids) >= ITEMS or size + len(own) > QUERY_TERMS):
            yield ids, items
            ids, items, size = [], [], 0
        ids.append(row["item_id"])
        items.append(own)
        size += len(own)
    if ids:
        yield ids, items


def _search(index: Index, ids: list, items: list[Counter], id_type: T.DataType, k: int) -> DataFrame:
    words = sorted({w for item in items for w in item})

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, total = pa.array(words, pa.binary()), np.zeros(len(words), dtype=np.int64)
        for batch in batches:
            for data in batch.column(0):
                shard = Shard(data)
                places = shard.places(asked)
                for j in np.flatnonzero(places >= 0).tolist():
                    total[j] += shard.frequency(places[j])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["word", "df"])

    counted = index.shards.mapInArrow(frequencies, "word int, df long").groupBy("word").agg(F.sum("df").alias("df"))
    df = {r["word"]: r["df"] for r in counted.collect()}  # at most the block's terms
    weight = {words[j]: math.floor(1000 * math.log((2 * index.docs + 2) / (2 * n + 1))) for j, n in df.items()}
    weighted = [[(w, weight[w]) for w in item if weight.get(w)] for item in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, at = pa.array(words, pa.binary()), {w: j for j, w in enumerate(words)}
        lists = [[(at[w], x) for w, x in item] for item in weighted]
        found: list[list[tuple[int, object]]] = [[] for _ in lists]  # the best k so far: minus score, doc
        for batch in batches:
            for data in batch.column(0):
                shard = Shard(data)
                places = shard.places(asked).tolist()
                for i, item in enumerate(lists):
                    here = [(places[j], x) for j, x in item if places[j] >= 0]
                    if not here:
                        continue
                    least = -found[i][-1][0] if len(found[i]) == k else 1
                    rows, scores = shard.best(here, k, least)
                    if len(rows):
                        docs = shard.docs.take(pa.array(rows)).to_pylist()
                        found[i] = sorted([*found[i], *zip((-scores).tolist(), docs, strict=True)])[:k]
        number = [i for i, best in enumerate(found) for _ in best]
        docs, scores = [d for best in found for _, d in best], [-s for best in found for s, _ in best]
        yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(docs, doc_kind), pa.array(scores, pa.int64())], names=["item", "doc_id", "score"])

    doc_kind = to_arrow_type(index.id_type)
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("doc_id", index.id_type), T.StructField("score", T.LongType())])
    best = index.shards.mapInArrow(run, schema)
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = index.shards.sparkSession.createDataFrame(list(enumerate(ids)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", id_type)]))
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = 50) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each query the ``k`` best of all documents with a score above 0."""
    index, out = build(docs), None
    id_type = queries.schema["item_id"].dataType
    for ids, items in _blocks(queries):
        found = materialize(_search(index, ids, items, id_type, k), "ranked")
        out = found if out is None else out.unionByName(found)
    if out is None:
        kinds = {"item_id": id_type, "rank": T.IntegerType(), "doc_id": index.id_type, "score": T.LongType()}
        return docs.sparkSession.createDataFrame([], T.StructType([T.StructField(n, t) for n, t in kinds.items()]))
    return out
