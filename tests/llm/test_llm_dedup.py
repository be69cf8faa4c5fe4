"""Exact dedup, SimHash and line dedup against brute force, with odd rows."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from toolcat.llm import exact_dedup as ed
from toolcat.llm import line_dedup as ld
from toolcat.llm import simhash as sh
from toolcat.llm.components import connected_components

WORDS = [f"w{i}" for i in range(400)]


def passage(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + ("." if i % 9 == 8 else "") for i in range(n)) + "."


def odd_docs(spark):
    long = passage(1, 20_000)
    rows = [
        (1, "a b c d", "x"), (2, "a b c d", None), (3, None, "x"), (4, "", "x"), (5, long, "x"), (6, long, "x"), (7, long + "!", "x"),
        (7, long + "!", "x"), (None, "a b c d", "x"), (None, "only null", "x"), (9, "A B C D", "x"), (10, "é ü " * 9, "x"), (11, "x" * 30_000, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, h string").withColumn("size", F.lit(0)).withColumn("key", F.lit("k"))


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup_matches_brute_force(spark, weak):
    docs = odd_docs(spark)
    hashed = (lambda c: (F.length(c) % 2).cast("long")) if weak else F.xxhash64  # a weak hash makes chunks collide
    found = ed.exact_dedup(docs, hashed).collect()
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    assert len(found) == len(rows)
    for r in found:
        same = [d for d, t in rows if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256]
        best = max((d for d in same if d is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (best, len(same), r.doc_id == best)


def test_chunks_join_to_the_text_and_follow_content(spark):
    text = passage(3, 3000)
    docs = spark.createDataFrame([(text,), ("Inserted words here. " + text,)], "text string")
    one, two = [r[0] for r in docs.select(ed.chunks(F.col("text"))).collect()]
    assert "".join(one) == text and len(one) > 3
    assert len(set(one) & set(two)) >= 1


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ed.exact_dedup(docs).count() == 0
    assert sh.simhash_groups(docs).count() == 0
    assert ld.line_dedup(docs).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**12 - 1), max_size=60), st.integers(0, 4))
def test_bk_tree_finds_all(values, radius):
    tree, seen = sh.BKTree(), []
    for i, v in enumerate(values):
        assert sorted(tree.add(v, i, radius)) == [j for j, w in enumerate(seen) if (v ^ w).bit_count() <= radius]
        seen.append(v)


def test_fingerprint_by_definition():
    import xxhash

    text = "The quick  brown\tfox THE quick brown fox"
    words = text.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert sh.fingerprint(text.encode()) == want
    assert sh.fingerprint(b" \n") == 0 and sh.fingerprint(b"One two") == xxhash.xxh64_intdigest("one two", 42)


@pytest.mark.parametrize("shard", [2, 256])
def test_simhash_groups_match_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(sh, "SHARD", shard)
    rng = random.Random(5)
    fps, base = [], [rng.getrandbits(64) for _ in range(30)]
    for b in base:
        for _ in range(6):
            x = b
            for _ in range(rng.randrange(4)):
                x ^= 1 << rng.randrange(64)
            fps.append(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in dict.fromkeys(fps)]
    edges = sh.links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    root = {r.node: r.root for r in connected_components(edges).collect()}
    want = {x: x for x in signed}
    for _ in signed:
        for x in signed:
            for y in signed:
                if ((x ^ y) & (1 << 64) - 1).bit_count() <= 3 and want[y] < want[x]:
                    want[x] = want[y]
        if all(want[x] == want[want[x]] for x in signed):
            break
    assert {x: root.get(x, x) for x in signed} == want


def test_simhash_odd_rows_and_keep(spark):
    docs = odd_docs(spark)
    got = [(str(r.doc_id), r.component_id) for r in sh.simhash_groups(docs).collect()]
    assert len(got) == docs.count()
    assert dict(got)["2"] == dict(got)["9"] == 1 and dict(got)["4"] == 3
    kept = sh.simhash_keep(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 2 not in ids and 1 in ids and 9 not in ids and ids.count(7) <= 1 and ids.count(None) == 2


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    root = {r.node: r.root for r in connected_components(edges).collect()}
    assert root == {i: 0 for i in range(1, 61)} | {101: 100}


def test_line_dedup_removes_later_passages_only(spark):
    p, q, own = passage(10, 60), passage(11, 70), [passage(20 + i, 50) for i in range(5)]
    rows = [
        (1, f"{own[0]}\n{p}\n{q}\n{own[1]}"), (2, f"{own[2]} {q}\n{own[3]}\n{p}"), (3, own[4]), (4, "Short line.\nw1 w2."),
        (5, "Short line.\nw1 w2."), (6, None), (None, p), (7, f"{p}\n{p}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_extra", F.lit(1))
    got = {r.doc_id: r.text for r in ld.line_dedup(docs).collect()}
    assert got[1] == rows[0][1] and got[3] == own[4] and got[4] == got[5] == "Short line.\nw1 w2." and got[6] == "" and got[None] == p
    assert p not in got[2] and q not in got[2] and own[2] in got[2] and own[3] in got[2]
    assert got[7] == ""
    out = ld.remove_repeated(docs)
    assert out.columns == docs.columns and out.count() == len(rows)


def test_a_passage_in_very_many_documents(spark):
    p = passage(77, 55)
    rows = [(i, f"{passage(1000 + i, 30)}\n{p}\n{passage(5000 + i, 30)}") for i in range(300)]
    got = {r.doc_id: r.text for r in ld.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i, t in got.items() if p in t] == [0]
    assert all(passage(1000 + i, 30) in t and passage(5000 + i, 30) in t for i, t in got.items())


def test_patience_is_a_heaviest_rising_chain():
    pairs = [(0, 5, 1), (1, 1, 1), (2, 2, 1), (3, 9, 1), (4, 3, 1)]
    assert [pairs[i][1] for i in ld.patience(pairs)] == [1, 2, 3]
    assert ld.patience([(0, 9, 10), (1, 1, 2), (2, 2, 3)]) == [0]
    assert ld.patience([]) == []


@settings(max_examples=60, deadline=None)
@given(st.permutations(range(7)), st.lists(st.integers(1, 5), min_size=7, max_size=7))
def test_patience_equals_brute_force(others, weights):
    runs = [(i, y, w) for i, (y, w) in enumerate(zip(others, weights, strict=True))]
    best = 0
    for mask in range(1 << 7):
        chain = [runs[i] for i in range(7) if mask >> i & 1]
        if all(a[1] < b[1] for a, b in zip(chain, chain[1:], strict=False)):
            best = max(best, sum(w for *_, w in chain))
    found = ld.patience(runs)
    assert sum(runs[i][2] for i in found) == best and all(runs[a][1] < runs[b][1] for a, b in zip(found, found[1:], strict=False))


def words_by_rule(text):
    import re

    return [m.group() for m in re.finditer(r"[\u0800-\U0010ffff]|[^\x00-\x20\u0800-\U0010ffff]+", text)]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab é漢😀\n\t", max_size=40))
def test_words_by_definition(text):
    data = text.encode()
    starts, ends, h = ld.words(data)
    found = [data[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    assert found == words_by_rule(text)
    assert len({(w, x) for w, x in zip(found, h.tolist(), strict=True)}) == len(set(found)) == len(set(h.tolist()))


def brute_blocks(text, other, block, line):
    """Patience diff by its definition over runs of ``line`` words, then passages elsewhere; the words that go."""
    a, b, gone = words_by_rule(text), words_by_rule(other), set()
    ends, at = [], 0
    for w in a:
        at = text.index(w, at) + len(w)
        ends.append(at)
    of_line = [text.count("\n", 0, e) for e in ends]

    def runs(x, lo, hi):
        places = {}
        for i in range(lo, hi - line + 1):
            places.setdefault(tuple(x[i : i + line]), []).append(i)
        return places

    def chain(pairs):  # the longest rising one; of equal ones any
        best = []
        for i, (x, y) in enumerate(pairs):
            n, j = max(((best[j][0], j) for j in range(i) if pairs[j][1] < y), default=(0, -1))
            best.append((n + 1, j))
        out, i = [], max(range(len(best)), key=lambda i: best[i][0]) if best else -1
        while i >= 0:
            out.append(pairs[i])
            i = best[i][1]
        return out[::-1]

    aligned = []

    def align(a0, a1, b0, b1):
        own, theirs = runs(a, a0, a1), runs(b, b0, b1)
        pairs = sorted((p[0], theirs[r][0]) for r, p in own.items() if len(p) == 1 and len(theirs.get(r, [])) == 1)
        before = a0, b0
        for x, y in chain(pairs):
            if x < before[0] or y < before[1]:
                continue
            while x > before[0] and y > before[1] and a[x - 1] == b[y - 1]:
                x, y = x - 1, y - 1
            n = 0
            while x + n < a1 and y + n < b1 and a[x + n] == b[y + n]:
                n += 1
            aligned.append((x, n))
            align(before[0], x, before[1], y)
            before = x + n, y + n
        if before != (a0, b0):
            align(before[0], a1, before[1], b1)

    align(0, len(a), 0, len(b))
    def trimmed(x, y):  # up to CHANCE words of one more line at either end
        heads = [i for i in range(len(a)) if i == 0 or of_line[i] != of_line[i - 1]]
        inner = [i for i in heads if x < i < y]
        lo = inner[0] if inner and inner[0] - x <= ld.CHANCE and x not in heads else x
        hi = inner[-1] if inner and y - inner[-1] <= ld.CHANCE and y < len(a) and y not in heads else y
        return set(range(lo, hi))

    for x, n in aligned:
        if n >= block:
            gone |= trimmed(x, x + n)
            continue
        for number in set(of_line[x : x + n]):
            whole = [i for i in range(len(a)) if of_line[i] == number]
            if len(whole) >= line and x <= whole[0] and whole[-1] < x + n:
                gone |= set(whole)
    inside = {i for x, n in aligned for i in range(x, x + n)}
    for x in range(len(a)):  # out of order: long passages alone
        for y in range(len(b)):
            n = 0
            while x + n < len(a) and y + n < len(b) and a[x + n] == b[y + n] and x + n not in inside:
                n += 1
            if n >= block and not (x and y and a[x - 1] == b[y - 1] and x - 1 not in inside):
                gone |= trimmed(x, x + n)
    return [w for i, w in enumerate(a) if i not in gone]


def cut(text, found):
    out, at = [], 0
    for start, n in found:
        out.append(text[at:start])
        at = start + n
    return "".join([*out, text[at:]])


@pytest.mark.parametrize("seed", range(60))
def test_blocks_match_a_brute_force_diff(seed):
    r = random.Random(seed)
    pieces = [" ".join(r.choice(WORDS) for _ in range(r.choice([3, 5, 7, 9, 12, 15, 25]))) for _ in range(8)]
    own = lambda: " ".join(r.choice(WORDS) + "x" for _ in range(r.randrange(1, 6)))
    make = lambda: "".join(r.choice(pieces) + r.choice(["\n", " "]) + r.choice(["", own() + r.choice(["\n", " "])]) for _ in range(r.randrange(1, 7)))
    text, other = make(), make()
    found = ld.blocks(text, other, 10, 4)
    assert words_by_rule(cut(text, found)) == brute_blocks(text, other, 10, 4), (text, other)


def test_short_passages_out_of_order_stay():
    p, q, r = (passage(s, 20) for s in (31, 32, 33))
    first, later = f"{p}\n{q}\n{r}", f"{q}\n{p}\n{r}"
    left = cut(later, ld.blocks(later, first))
    assert r not in left and (p in left) + (q in left) == 1  # a union of all shared runs would take both
    long = [passage(s, 60) for s in (34, 35)]
    assert cut(f"{long[1]} {long[0]}", ld.blocks(f"{long[1]} {long[0]}", f"{long[0]} {long[1]}")) == ""


def test_every_long_passage_has_an_anchor():
    r = random.Random(8)
    for n in range(200):
        p = " ".join(r.choice(WORDS) for _ in range(ld.LINE + ld.REACH - 1))
        texts = [" ".join(r.choice(WORDS) for _ in range(r.randrange(60))) + f" {p} " + " ".join(r.choice(WORDS) for _ in range(r.randrange(60))) for _ in range(2)]
        of, h = ld.anchors([t.encode() for t in texts])
        assert set(h[of == 0].tolist()) & set(h[of == 1].tolist()), n
        alone = [ld.anchors([t.encode()])[1].tolist() for t in texts]
        assert [h[of == i].tolist() for i in (0, 1)] == alone  # whatever stands in the same batch
    lines = [f"{passage(i, 15)}\n{passage(99, 14)}\n{passage(50 + i, 15)}" for i in (1, 2)]
    of, h = ld.anchors([t.encode() for t in lines])
    assert set(h[of == 0].tolist()) & set(h[of == 1].tolist())


def test_line_dedup_odd_rows(spark):
    p, own = passage(61, 55), passage(62, 30)
    chinese = "".join(chr(0x4E00 + (i * 7919) % 5000) for i in range(80))
    rows = [
        (1, f"{own} {p}", "a"), (2, f"no stop before {p} none after", "b"), (2, f"no stop before {p} none after", "b"), (2, "other text of this id", None),
        (3, f"前文{chinese}后", "c"), (4, f"别的{chinese}完", "d"), (5, "x" * 40_000, "e"), (6, "x" * 40_000, "f"), (None, p, "g"), (7, None, None),
        (8, passage(63, 13) + "\nshort", "h"), (9, passage(63, 13) + "\nshort", "i"), (10, f"{p} " * 3, "j"), (11, passage(64, 20_000), "k"), (12, passage(64, 20_000) + " end", "l"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _removed string").withColumn("row", F.lit(1)).withColumn("cut", F.lit(2))
    out = ld.remove_repeated(docs.repartition(3), removed="n_removed")
    assert out.columns == [*docs.columns, "n_removed"] and out.count() == len(rows)
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, set()).add((r.text, r._removed))
    assert got[2] == {("no stop before none after", "b"), ("other text of this id", None)}
    assert got[1] == {(rows[0][1], "a")} and got[3] == {(rows[4][1], "c")} and got[4] == {("别的完", "d")}
    assert got[5] == {("x" * 40_000, "e")} and got[6] == {("x" * 40_000, "f")} and got[None] == {(p, "g")} and got[7] == {("", None)}
    assert got[9] == {("short", "i")} and got[10] == {("", "j")} and got[12] == {("end", "l")}
    assert ld.remove_repeated(docs.limit(0)).columns == docs.columns


def near_corpus():
    """Originals, copies with a Jaccard similarity on both sides of 0.8, and many copies of one."""
    r = random.Random(21)
    texts, i = {}, 0
    for g in range(60):
        base = [r.choice(WORDS) + str(g) for _ in range(r.choice([40, 120, 400]))]
        texts[i] = base
        for _ in range(3):
            i += 1
            copy = list(base)
            for _ in range(r.randrange(1, max(2, len(base) // 18))):
                copy[r.randrange(len(copy))] = f"new{r.randrange(10**6)}"
            texts[i] = copy
        i += 1
    base = [r.choice(WORDS) + "big" for _ in range(150)]
    for _ in range(400):
        copy = list(base)
        copy[r.randrange(150)] = f"other{r.randrange(10**6)}"
        texts[i] = copy
        i += 1
    return {k: " ".join(v) for k, v in texts.items()}


def test_near_copies_match_brute_force(spark):
    texts = near_corpus()
    sets = {k: sh._shingles(t.encode().lower().split(), 5) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    small = [k for k in texts if k < 240]
    pairs = [(a, b) for group in (range(g, g + 4) for g in range(0, 240, 4)) for a in group for b in group if a < b]
    pairs += [(a, b) for a in texts if a >= 240 for b in texts if a < b]
    linked = 0
    for a, b in pairs:
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            linked += a < 240
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    want = {k for k in texts if find(k) == k}
    docs = spark.createDataFrame([(k, t.upper() if k % 2 else t, "x") for k, t in texts.items()], "doc_id long, text string, same string")
    kept = {r.doc_id for r in sh.simhash_keep(docs.repartition(3)).collect()}
    assert linked > 60 and want <= kept  # nothing goes that is no near copy
    assert len(kept - want) <= 0.02 * (len(texts) - len(want)) and len(small) == 240


@pytest.mark.parametrize("members", [800, 5000])
def test_near_copies_of_one_template(spark, members):
    """2 to 5 of 300 words changed: similarities on both sides of 0.8 in one dense cluster."""
    r = random.Random(members)
    base, texts = [f"{r.choice(WORDS)}{i}" for i in range(300)], {}
    for k in range(members):
        copy = list(base)
        for at in r.sample(range(300), r.randint(2, 5)):
            copy[at] = f"new{r.randrange(10**7)}"
        texts[k] = " ".join(copy)
    texts |= {members + k: " ".join(f"{r.choice(WORDS)}{r.randrange(10**6)}" for _ in range(200)) for k in range(50)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    kept = {row.doc_id for row in sh.simhash_keep(docs).collect()}
    assert {k for k in texts if k >= members} <= kept
    if members <= 800:  # brute force: all but those without any link are one component
        sets = [sh._shingles(texts[k].encode().split(), 5) for k in range(members)]
        alone = {k for k in range(1, members) if not any(j != k and len(sets[k] & sets[j]) >= 0.8 * len(sets[k] | sets[j]) for j in range(members))}
        assert len({k for k in kept if k < members} - alone) <= 2
    else:
        assert len({k for k in kept if k < members}) <= 0.02 * members


def test_large_shards_lose_no_link(spark, monkeypatch):
    """Couples of one template, each only like its other half: in large shards of many parts the groups are those of all
    links, by brute force."""
    monkeypatch.setattr(sh, "NEAR_SHARD", 8)
    monkeypatch.setattr(sh, "PART", 16)
    monkeypatch.setattr(sh, "CELL", 32, raising=False)
    r = random.Random(31)
    base, texts = [f"{r.choice(WORDS)}{i}" for i in range(300)], {}
    for k in range(60):
        words = list(base)
        for i in range(6):
            words[50 * i + r.randrange(5, 45)] = f"new{r.randrange(10**7)}"
        texts[k] = " ".join(words)
        words[r.randrange(300)] = f"own{k}"
        texts[60 + k] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    sketches = {row.doc_id: row for row in sh._sketches(docs, 5, 42).collect()}
    sets = {k: sh._shingles(t.encode().lower().split(), 5) for k, t in texts.items()}
    least = {k: k for k in texts}
    for a in texts:
        for b in range(a):
            x, y = sketches[a], sketches[b]
            if any(p == q for p, q in zip(x["keys"], y["keys"], strict=True)) and ((x.fp ^ y.fp) & (1 << 64) - 1).bit_count() <= sh.NEAR_RADIUS:
                if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                    own, other = least[a], least[b]
                    least = {k: min(own, other) if v in (own, other) else v for k, v in least.items()}
    kept = {row.doc_id for row in sh.simhash_keep(docs).collect()}
    assert kept == set(least.values()) and 50 <= len(kept) <= 60


def test_possible_pairs_hold_all_similar_ones():
    r = np.random.default_rng(5)
    sets = [np.unique(r.integers(0, 400, r.integers(1, 300))).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(90)]
    sets += [np.unique(np.concatenate([s[: int(len(s) * 0.93)], s[:2] + np.uint64(1)])) for s in sets]
    fps, roots = r.integers(0, 1 << 16, len(sets)).astype(np.uint64), np.arange(len(sets)) // 3
    bits = np.stack([sh.shingle_bits(s) for s in sets]).view(np.uint64)
    held = fps, roots, np.array([len(s) for s in sets]), bits
    found = {(a, b) for x, y in sh.possible_pairs(held, held, 18, 0.8) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    every = {(a, b) for a in range(len(sets)) for b in range(len(sets)) if roots[a] != roots[b]}
    true = {(a, b) for a, b in every if len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))}
    assert len(true) > 60 and true <= found and len(found) < len(every) / 4


def test_near_copies_keep_parts_and_maps(spark):
    r = random.Random(2)
    a, b, c = (" ".join(r.choice(WORDS) + str(r.randrange(10**6)) for _ in range(60)) for _ in range(3))
    docs = spark.createDataFrame([(1, a), (2, b), (2, c), (2, b), (3, f"{b} more"), (4, f"{a} more"), (5, None), (6, ""), (None, a)], "doc_id long, text string")
    docs = docs.withColumn("tags", F.create_map(F.lit("k"), F.col("text")))
    got = sorted(((row.doc_id, row.text) for row in sh.simhash_keep(docs).collect()), key=repr)
    assert got == sorted([(1, a), (2, b), (2, c), (5, None), (None, a)] + ([(3, f"{b} more")] if (3, f"{b} more") in got else []), key=repr)


def test_passage_whose_runs_an_earlier_document_quotes(spark):
    """The first document holds only runs of 12 words of a passage that the two others share."""
    r = random.Random(8)
    rows, passages = [], {}
    for case in range(60):
        own = lambda n, tag: [f"{tag}{case}x{r.randrange(10**6)}" for _ in range(n)]  # noqa: B023, E731
        p = own(60, "p")
        quotes = []
        for at in range(0, 49):
            quotes += p[at : at + 12] + own(3, "q")
        rows += [(3 * case, " ".join(quotes)), (3 * case + 1, " ".join(own(30, "b") + p + own(30, "b"))), (3 * case + 2, " ".join(own(30, "c") + p + own(30, "c")))]
        passages[3 * case + 2] = " ".join(p)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {row.doc_id: row.text for row in ld.remove_repeated(docs).collect()}
    assert not [k for k, p in passages.items() if p in got[k]]
    assert all(got[k] == t for k, t in rows if k % 3 < 2)  # nothing goes from the other two
    assert all(len(got[k].split()) == 60 for k in passages)
