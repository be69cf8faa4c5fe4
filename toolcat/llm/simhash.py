"""Near-deduplication by SimHash, with BK-trees to find fingerprints within a few bits.

Distinct fingerprints are dealt into shards so that any two within ``radius`` bits meet in one: of ``radius + 1``
bands of bits such a pair has one in common. A shard of more than ``SHARD`` fingerprints is dealt again by bands of
its remaining bits, so a dense cluster spreads out as well; after ``LEVELS`` rounds at most 2^15 differ. The task
that holds a shard builds its BK-tree, in which children are keyed by their Hamming distance to the parent, and
follows only the edges within the radius. (A broadcast of all trees would grow with the corpus; a shard's tree has
a proven bound, so it stays with its shard.) Each shard returns the spanning edges of its links, and the components
of all edges are found by Spark.

Null texts count as empty; texts without words have fingerprint zero and are linked like any other. Rows with a
null ``doc_id`` link their group like any other but give it no name; ``component_id`` is null only where no row of
the component has an id. Repeated rows share a component. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toolcat.llm.common import join_groups, materialize, text_or_empty, with_texts
from toolcat.llm.components import connected_components

SHARD, LEVELS = 256, 5
#: For near copies: bits by which fingerprints may differ, orders of shingles, and nodes in a shard.
NEAR_RADIUS, KEYS, NEAR_SHARD = 18, 6, 96
#: What a task gets of a larger shard: nodes of a part, as many of the core, and bytes of their shingles; where parts
#: are compared, nodes on either side of a cell, and bits of a set's signature.
PART, PART_BYTES, CELL, BITS = 1024, 32 << 20, 8192, 2048
_BLOCK = 65_000  # shingles whose bits are counted at once


def _bit_counts(hashes: list[int]) -> np.ndarray:
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    full = len(bits) // 250 * 250
    counts = bits[:full].reshape(-1, 250, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return counts + bits[full:].sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of the word shingles of a UTF-8 text, ASCII lower-cased; repeats count."""
    words = text.lower().split()
    if not words:
        return 0
    counts, n = np.zeros(64, dtype=np.int64), max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _BLOCK):
        stop = min(n, at + _BLOCK)
        runs = zip(*(words[at + k : stop + k] for k in range(width)), strict=True) if len(words) >= width else [words]
        counts += _bit_counts([digest(b" ".join(r), seed) for r in runs])
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, fp``, the fingerprint as a signed long."""
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, width, seed) for t in batch.column(1).to_pylist()], dtype="<u8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view("<i8"))], names=["doc_id", "fp"])

    rows = docs.select("doc_id", text_or_empty().cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type.simpleString()}, fp long")


def _masks(radius: int) -> list[list[int]]:
    """By level and path: the bits that the path's last band holds, as signed longs. Path p has the children
    (radius + 1) p + j."""
    ways, free, out = radius + 1, [list(range(64))], []
    for _ in range(LEVELS):
        masks, rest = [], []
        for bits in free:
            for j in range(ways):
                band = bits[len(bits) * j // ways : len(bits) * (j + 1) // ways]
                mask = sum(1 << b for b in band)
                masks.append(mask - (1 << 64) if mask >> 63 else mask)
                rest.append([b for b in bits if b not in band])
        free = rest
        out.append(masks)
    return out


def _shards(fps: DataFrame, radius: int) -> DataFrame:
    """``key, fp``: shards of at most SHARD fingerprints, or of the last level; each pair within the radius is
    together in one at least. Single fingerprints are left out."""
    ways, done, rows = radius + 1, [], fps.select("fp", F.lit(0).alias("path"), F.lit(0).cast("long").alias("key"))
    for level, masks in enumerate(_masks(radius)):
        table = F.array(*map(F.lit, masks))
        rows = rows.select("fp", "key", F.explode(F.array(*(F.col("path") * ways + j for j in range(ways)))).alias("path"))
        band = F.col("fp").bitwiseAND(F.element_at(table, F.col("path") + 1))
        rows = rows.select("fp", "path", F.xxhash64("key", "path", band).alias("key"))
        sizes = rows.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
        rows = materialize(join_groups(rows, sizes, "key", "size", max(1, rows.count())), f"shards{level}")
        last = level == LEVELS - 1
        done.append((rows if last else rows.filter(F.col("size") <= SHARD)).select("key", "fp"))
        rows = rows.filter(F.col("size") > SHARD).select("fp", "path", "key")
        if last or rows.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


class BKTree:
    """Integers by Hamming distance; a node's children are keyed by their distance to it."""

    def __init__(self) -> None:
        self.root: list | None = None  # [value, index, {distance: child}]

    def search(self, value: int, radius: int) -> list[int]:
        """The indexes of the values within the radius; only edges that can lead to one are followed."""
        near, todo = [], [self.root] if self.root else []
        while todo:
            other, i, children = todo.pop()
            d = (value ^ other).bit_count()
            if d <= radius:
                near.append(i)
            if children:
                todo += [child for k, child in children.items() if d - radius <= k <= d + radius]
        return near

    def insert(self, value: int, index: int) -> None:
        if self.root is None:
            self.root = [value, index, {}]
            return
        node = self.root
        while (d := (value ^ node[0]).bit_count()) in node[2]:
            node = node[2][d]
        node[2][d] = [value, index, {}]

    def add(self, value: int, index: int, radius: int) -> list[int]:
        """Insert a value; return the indexes of those within the radius that are there already."""
        near = self.search(value, radius)
        self.insert(value, index)
        return near


def shard_edges(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Spanning edges of the links between distinct values, each with the least value of its part."""
    tree, parent = BKTree(), list(range(len(values)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, value in enumerate(values):
        for j in tree.add(value & (1 << 64) - 1, i, radius):
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b, key=values.__getitem__)] = min(a, b, key=values.__getitem__)
    return [(values[i], values[r]) for i in range(len(values)) if (r := find(i)) != i]


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Edges ``a, b`` that connect the distinct fingerprints of ``fps`` just as the links within ``radius`` do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(keys: np.ndarray, values: np.ndarray) -> list[tuple[int, int]]:
            cuts = np.flatnonzero(np.diff(keys)) + 1
            return [e for part in np.split(values, cuts) for e in shard_edges(part.tolist(), radius)]

        keys = values = np.array([], dtype=np.int64)
        for batch in batches:
            keys = np.concatenate([keys, np.asarray(batch.column(0))])
            values = np.concatenate([values, np.asarray(batch.column(1))])
            whole = int(np.searchsorted(keys, keys[-1], "left")) if len(keys) else 0  # the last shard may go on
            if found := edges(keys[:whole], values[:whole]) if whole else []:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])
            keys, values = keys[whole:], values[whole:]
        if found := edges(keys, values) if len(keys) else []:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])

    shards = _shards(fps, radius).repartition("key").sortWithinPartitions("key", "fp")
    return shards.mapInArrow(run, "a long, b long").distinct()


def simhash_groups(docs: DataFrame, width: int = 3, radius: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, fingerprint, component_id``: documents whose fingerprints differ by at most ``radius`` bits are
    linked; a component is named after its smallest ``doc_id``."""
    rows = materialize(fingerprints(docs, width, seed), "fingerprints")
    total = max(1, rows.count())
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("own"), F.count("*").alias("copies")), "nodes")
    linked = connected_components(links(nodes.select("fp"), radius))
    roots = linked.groupBy("root").agg(F.count("*").alias("size"))
    members = linked.unionByName(roots.select(F.col("root").alias("node"), "root"))
    members = materialize(members.join(nodes.select(F.col("fp").alias("node"), "own"), "node"), "members")
    named = members.groupBy("root").agg(F.min("own").alias("least"), F.count("*").alias("size"))
    named = join_groups(members.select("node", "root"), named, "root", "size", max(1, members.count()))
    groups = nodes.join(named.select(F.col("node").alias("fp"), "least"), "fp", "left")
    groups = groups.select("fp", "copies", F.coalesce("least", "own").alias("component_id"))
    return join_groups(rows, groups, "fp", "copies", total).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _shingles(words: list[bytes], width: int) -> set:
    return set(zip(*(words[k:] for k in range(width)), strict=False)) if len(words) >= width else {tuple(words)}


def _sketches(docs: DataFrame, width: int, seed: int) -> DataFrame:
    """``doc_id, fp, same, keys, n``: the fingerprint, a digest of the words, the least shingle hash in each of KEYS
    orders, and the number of shingles."""
    id_type = docs.schema["doc_id"].dataType
    odd = np.array([2 * xxhash.xxh64_intdigest(bytes([j]), seed) + 1 & (1 << 64) - 1 for j in range(KEYS)], dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, same, keys, sizes = [], [], [], []
            for text in batch.column(1).to_pylist():
                words = text.lower().split()
                fps.append(fingerprint(text, width, seed))
                same.append(xxhash.xxh3_128_digest(b" ".join(words)))
                n, digest = max(1, len(words) - width + 1), xxhash.xxh64_intdigest
                h = np.fromiter((digest(b" ".join(words[i : i + width]), seed) for i in range(n)), dtype=np.uint64, count=n)
                sizes.append(n)
                least = [(x ^ (x >> np.uint64(32))).min() for x in (h * m for m in odd)]
                keys.append(np.array(least, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(fps, dtype="<u8").view("<i8")), pa.array(same, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(sizes, pa.int64())],
                names=["doc_id", "fp", "same", "keys", "n"],
            )

    rows = docs.select("doc_id", text_or_empty().cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type.simpleString()}, fp long, same binary, keys array<long>, n long")


def near_pairs(members: list[tuple], radius: int) -> list[tuple]:
    """Pairs of ``(id, fingerprint)`` within the radius, the larger id first."""
    tree, out = BKTree(), []
    for i, (node, fp) in enumerate(members):
        near = tree.add(fp & (1 << 64) - 1, i, radius)
        out += [(max(node, members[j][0]), min(node, members[j][0])) for j in near if node != members[j][0]]
    return out


def near_links(members: list[tuple], radius: int, similarity: float) -> list[tuple]:
    """Spanning pairs of the verified links between ``(id, fingerprint, sorted shingle hashes)``, the larger id first:
    what a BK-tree finds within the radius is compared exactly unless it is linked already."""
    tree, out, parent = BKTree(), [], list(range(len(members)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, (node, fp, own) in enumerate(members):
        for j in tree.add(fp & (1 << 64) - 1, i, radius):
            a, b, (other, _, their) = find(i), find(j), members[j]
            if a == b or min(len(own), len(their)) < similarity * max(len(own), len(their)):
                continue
            at = np.searchsorted(their, own)
            both = int(np.count_nonzero(their[np.minimum(at, len(their) - 1)] == own))
            if both >= similarity * (len(own) + len(their) - both):
                parent[max(a, b)] = min(a, b)
                if node != other:
                    out.append((max(node, other), min(node, other)))
    return out


def _by_shard(found, columns: list[str]):
    """The rows of each shard, which come sorted by its key (the first columns of ``columns``), handed to ``found``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            pairs = found(own)
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], kind) for i in (0, 1)], names=["doc", "owner"])

        key, own, kind = None, [], None
        for batch in batches:
            kind = batch.schema.field("doc").type
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[: len(columns)] != key:
                    if len(own) > 1:
                        yield done()
                    key, own = row[: len(columns)], []
                own.append(row[len(columns) :])
        if len(own) > 1:
            yield done()

    return run


def near_shards(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes that share a least shingle in one of the orders, as shards of at most NEAR_SHARD nodes, ``key, doc, fp``,
    and larger ones, with ``n`` and ``size`` besides. ``nodes``: doc, fp, keys, n."""
    rows = nodes.select("doc", "fp", "n", F.posexplode("keys").alias("order", "least"))
    rows = rows.select("doc", "fp", "n", F.xxhash64("order", "least").alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    dealt = materialize(join_groups(rows, sizes, "key", "size", max(1, KEYS * nodes.count())), "near")
    return dealt.filter(F.col("size") <= NEAR_SHARD).select("key", "doc", "fp"), dealt.filter(F.col("size") > NEAR_SHARD)


def near_candidates(shards: DataFrame, radius: int) -> DataFrame:
    """``doc, owner``: nodes of one shard whose fingerprints lie within the radius."""
    id_type = shards.schema["doc"].dataType.simpleString()
    dealt = shards.repartition("key").sortWithinPartitions("key", "doc")
    return dealt.mapInArrow(_by_shard(lambda own: near_pairs(own, radius), ["key"]), f"doc {id_type}, owner {id_type}").distinct()


def _parts(large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``key, part, doc, fp``: large shards in parts that fit a task, and ``key, doc, fp`` of those that have several. Each
    of several parts gets its shard's core besides: about PART nodes, fewer if they are long, whose fingerprints differ
    least from the majority of the shard's."""
    total = max(1, large.count())
    ones = [F.sum(F.shiftrightunsigned("fp", i).bitwiseAND(F.lit(1))).alias(f"b{i}") for i in range(64)]
    stats = large.groupBy("key").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"), *ones)
    value = lambda i: F.lit((1 << i) if i < 63 else -(1 << 63))
    centre = sum((F.when(2 * F.col(f"b{i}") > F.col("members"), value(i)).otherwise(F.lit(0).cast("long")) for i in range(1, 64)), F.when(2 * F.col("b0") > F.col("members"), value(0)).otherwise(F.lit(0).cast("long")))
    parts = F.ceil(F.greatest(F.col("members") / PART, F.col("shingles") * 8 / PART_BYTES)).cast("int")
    parts = F.when((F.col("members") <= 2 * PART) & (F.col("shingles") * 8 <= 2 * PART_BYTES), 1).otherwise(parts)
    core = F.least(F.lit(float(PART)), PART_BYTES * F.col("members") / (8 * F.col("shingles")))
    stats = stats.select("key", "members", centre.alias("centre"), parts.alias("parts"), core.alias("core"))
    rows = join_groups(large.select("key", "doc", "fp"), stats, "key", "members", total)
    rows = rows.withColumn("off", F.bit_count(F.col("fp").bitwiseXOR(F.col("centre"))))
    rows = materialize(rows, "large")
    whole, several = rows.filter("parts = 1"), rows.filter("parts > 1")
    near = several.groupBy("key", "off").agg(F.count("*").alias("c"), F.first("members").alias("members"), F.first("core").alias("core"))  # at most 65 rows a key
    before = F.sum("c").over(Window.partitionBy("key").orderBy("off")) - F.col("c")
    shares = near.withColumn("share", F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("core") - before) / F.col("c"))))
    shares = shares.groupBy("key").agg(F.max("members").alias("size"), F.map_from_entries(F.collect_list(F.struct("off", "share"))).alias("shares"))
    split = join_groups(several, shares, "key", "size", total)
    core = F.pmod(F.xxhash64("doc", "key"), F.lit(1_000_003)) < F.try_element_at("shares", "off") * 1_000_003
    own = F.array(F.pmod(F.xxhash64("key", "doc"), "parts").cast("int"))
    split = split.withColumn("part", F.explode(F.when(core, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(own)))
    placed = whole.select("key", F.lit(0).alias("part"), "doc", "fp").unionByName(split.select("key", "part", "doc", "fp"))
    return placed, several.select("key", "doc", "fp")


def shingle_bits(hashes: np.ndarray) -> np.ndarray:
    """BITS bits, those set which the remainders of a set's hashes name."""
    out = np.zeros(BITS, dtype=np.uint8)
    out[(hashes % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(out)


def possible_pairs(first: tuple, second: tuple, radius: int, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``first`` and ``second`` of all pairs of different roots within the radius whose similarity can reach the
    one asked for. Both hold arrays: fingerprint, number of the root, number of shingles, ``shingle_bits`` as words. A bit
    that only one side has set stands for a shingle at least that the other side lacks, so no true link is left out."""
    (fps, roots, sizes, bits), (other_fps, other_roots, other_sizes, other_bits) = first, second
    for a in range(0, len(fps), 128):
        near = np.bitwise_count(fps[a : a + 128, None] ^ other_fps) <= radius
        near &= roots[a : a + 128, None] != other_roots
        i, j = np.nonzero(near)
        i += a
        for c in range(0, len(i), 16_384):
            x, y = i[c : c + 16_384], j[c : c + 16_384]
            own, other = bits[x], other_bits[y]
            lone = np.bitwise_count(own & ~other).sum(axis=1, dtype=np.int64), np.bitwise_count(other & ~own).sum(axis=1, dtype=np.int64)
            both = np.minimum(sizes[x] - lone[0], other_sizes[y] - lone[1])
            keep = both >= similarity * (sizes[x] + other_sizes[y] - both)
            yield x[keep], y[keep]


def _across_parts(split: DataFrame, shingles: DataFrame, found: DataFrame, radius: int, similarity: float) -> DataFrame:
    """``doc, owner``: the pairs of nodes of one shard that ``found`` (a, b) doesn't connect and that can be links.
    ``split``: key, doc, fp; ``shingles``: doc, hashes. Of two such nodes one lies outside the shard's largest component,
    so each node outside is compared with all, in cells of at most CELL by CELL nodes."""
    id_type = split.schema["doc"].dataType.simpleString()

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(h, dtype=np.uint64) for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([shingle_bits(s).tobytes() for s in sets], pa.binary())], names=["doc", "m", "bits"]
            )

    roots = connected_components(found).withColumnRenamed("node", "doc")
    nodes = materialize(split.join(roots, "doc", "left").withColumn("root", F.coalesce("root", "doc")), "rooted")
    parts = nodes.groupBy("key", "root").agg(F.count("*").alias("c"))
    parts = parts.groupBy("key").agg(F.max_by("root", "c").alias("main"), F.sum("c").alias("members"), (F.sum("c") - F.max("c")).alias("rest"))
    parts = parts.filter("rest > 0").withColumns({"wide": F.ceil(F.col("members") / CELL).cast("int"), "high": F.ceil(F.col("rest") / CELL).cast("int")})
    rows = join_groups(nodes, parts, "key", "members", max(1, nodes.count()))
    wanted = rows.select("doc").distinct()
    signed = shingles.join(wanted, "doc", "left_semi").mapInArrow(marks, f"doc {id_type}, m long, bits binary")
    rows = materialize(rows.join(signed, "doc"), "across")
    place = lambda n: F.pmod(F.xxhash64("key", "doc"), n).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ("key", "doc", "fp", "root", "m", "bits")
    outside = rows.filter("root <> main").select(*columns, F.lit(0).alias("side"), place("high").alias("row"), upto("wide").alias("col"))
    every = rows.select(*columns, F.lit(1).alias("side"), upto("high").alias("row"), place("wide").alias("col"))

    def cell(held: pa.Table) -> pa.Table:
        held = held.combine_chunks()
        root = held.column("root").combine_chunks().dictionary_encode().indices.to_numpy()
        bits = np.frombuffer(b"".join(held.column("bits").to_pylist()), dtype=np.uint64).reshape(-1, BITS // 64)
        arrays = held.column("fp").to_numpy().view(np.uint64), root, held.column("m").to_numpy(), bits
        at = [np.flatnonzero(held.column("side").to_numpy() == s) for s in (0, 1)]
        pairs = list(possible_pairs(*(tuple(x[own] for x in arrays) for own in at), radius, similarity))
        x, y = (np.concatenate([np.zeros(0, dtype=np.int64), *(p[i] for p in pairs)]) for i in (0, 1))
        doc = held.column("doc")
        return pa.table({"a": doc.take(pa.array(at[0][x])), "b": doc.take(pa.array(at[1][y]))})

    pairs = outside.unionByName(every).groupBy("key", "row", "col").applyInArrow(cell, f"a {id_type}, b {id_type}")
    return pairs.select(F.greatest("a", "b").alias("doc"), F.least("a", "b").alias("owner")).distinct()


def verified(pairs: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """``a, b``: those of the pairs ``doc, owner`` whose sets of shingles have the similarity."""

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = _shingles(a.encode().lower().split(), width), _shingles(b.encode().lower().split(), width)
                both = len(x & y)
                keep.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    id_type = pairs.schema["doc"].dataType.simpleString()
    both = with_texts(pairs, texts).select(F.col("doc").alias("a"), F.col("owner").alias("b"), "own", "other")
    return both.mapInArrow(alike, f"a {id_type}, b {id_type}")


def large_links(large: DataFrame, texts: DataFrame, others: DataFrame, width: int, radius: int, similarity: float, seed: int) -> DataFrame:
    """``a, b``: verified links that, with ``others`` (a, b), connect the nodes of large shards as all their links do. A
    shard in one part is searched by its task. Of a shard in several parts each is searched with the core; then all
    pairs that aren't connected yet are. ``texts``: doc_id, text."""
    id_type = large.schema["doc"].dataType.simpleString()
    placed, split = _parts(large)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                words, digest = text.encode().lower().split(), xxhash.xxh64_intdigest
                n = max(1, len(words) - width + 1)
                out.append(np.unique(np.fromiter((digest(b" ".join(words[i : i + width]), seed) for i in range(n)), dtype=np.uint64, count=n)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc", "hashes"])

    wanted = large.select(F.col("doc").alias("doc_id")).distinct()
    shingles = texts.join(wanted, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(sets, f"doc {id_type}, hashes binary")
    shingles = materialize(shingles, "shingles")
    dealt = placed.join(shingles, "doc").select("key", "part", "doc", "fp", "hashes").repartition("key", "part").sortWithinPartitions("key", "part", "doc")

    def found(own: list[tuple]) -> list[tuple]:
        return near_links([(doc, fp, np.frombuffer(h, dtype=np.uint64)) for doc, fp, h in own], radius, similarity)

    links = dealt.mapInArrow(_by_shard(found, ["key", "part"]), f"doc {id_type}, owner {id_type}").distinct()
    links = materialize(links.select(F.col("doc").alias("a"), F.col("owner").alias("b")), "large_links")
    if split.isEmpty():
        return links
    pairs = materialize(_across_parts(split, shingles, links.unionByName(others), radius, similarity), "across_pairs")
    return links.unionByName(materialize(verified(pairs, texts, width, similarity), "across_links"))


def simhash_keep(docs: DataFrame, width: int = 5, radius: int = NEAR_RADIUS, similarity: float = 0.8, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near copies the one with the smallest ``doc_id``, and all rows
    without an id. Rows that share an id are parts of one document, which stays or goes as a whole and is compared by one of
    its texts; of its rows with equal texts one stays.

    Texts of the same words, in any case, are one group. Others are linked if they share a least shingle in one of KEYS
    orders, their fingerprints lie within ``radius`` bits, and the Jaccard similarity of their sets of ``width``-word
    shingles is ``similarity`` or more; the groups are those of all such links, however many share a shingle. In large
    shards, where nearly all may be candidates of all, links are verified where they are found and only those that
    connect go on."""
    known = docs.filter(F.col("doc_id").isNotNull())
    rows = materialize(_sketches(known, width, seed), "sketches")
    first = rows.groupBy("same").agg(F.min("doc_id").alias("first"), F.count("*").alias("size"))
    rows_first = materialize(join_groups(rows, first, "same", "size", max(1, rows.count())), "first")
    one = F.min_by(F.struct("fp", "keys", "n"), "same").alias("x")
    nodes = rows_first.filter("doc_id = first").groupBy(F.col("doc_id").alias("doc")).agg(one).select("doc", "x.*")
    shards, large = near_shards(nodes)
    pairs = materialize(near_candidates(shards, radius), "candidates")

    texts = known.select("doc_id", text_or_empty().alias("text"))
    links = verified(pairs, texts, width, similarity)
    copies = rows_first.filter("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    if not large.isEmpty():
        links = materialize(links, "links")
        links = links.unionByName(large_links(large, texts, links, width, radius, similarity, seed))
    gone = connected_components(links.unionByName(copies)).select(F.col("node").alias("_gone"))
    kept = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    repeated = rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("_twice"))
    if repeated.isEmpty():
        return kept
    twice = kept.join(repeated, kept["doc_id"] == repeated["_twice"], "left_semi")
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    once = twice.select(F.col("doc_id").alias("_id"), text_or_empty().alias("_text"), whole.alias("_row")).groupBy("_id", "_text").agg(F.any_value("_row").alias("_row"))
    single = kept.join(repeated, kept["doc_id"] == repeated["_twice"], "left_anti")
    return single.unionByName(once.select(*(F.col(f"_row.`{c}`") for c in docs.columns)))
