"""Repeated bytes, runs of words and ranked search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from toolcat.llm import lexical, prefix_parse, word_runs
from toolcat.llm.queries import oracle_sql, queries


def _bytes_by_definition(rows):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - 49) if d is not None else ():
            first[b[s : s + 50]] = min(d, first.get(b[s : s + 50], d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - 49) if d is not None else ():
            if first[b[s : s + 50]] < d:
                gone[s : s + 50] = [True] * 50
        spans = sum(x and not (i and gone[i - 1]) for i, x in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, bytes(c for c, x in zip(b, gone, strict=True) if not x)))
    return sorted(out, key=repr)


def _texts(seed, n):
    rnd = random.Random(seed)
    passages = ["".join(rnd.choice("abcdefgh äö中") for _ in range(rnd.randint(30, 130))) for _ in range(12)]

    def part():
        return rnd.choice([
            rnd.choice(passages), "".join(rnd.choice("abcdefghij ") for _ in range(rnd.randint(1, 60))),
            "ab" * rnd.randint(1, 50), rnd.choice(passages)[: rnd.randint(20, 80)],
        ])

    return [(rnd.randint(0, n), "".join(part() for _ in range(rnd.randint(0, 9)))) for _ in range(n)]


@pytest.mark.parametrize("heavy", [prefix_parse.HEAVY, 3])  # the second deals most strings one by one
def test_repeated_bytes(spark, heavy):
    rows = _texts(3, 200)
    rows += [(None, rows[5][1]), (7, None), (9999, rows[3][1] * 3), (3, ""), (9998, "\0" * 120), (9997, "\0" * 70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1)).repartition(5)
    found = prefix_parse.remove_repeats(docs, heavy).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found), key=repr)
    assert got == _bytes_by_definition(rows)
    assert sum(r[2] for r in got) > 10_000


def test_repeated_bytes_over_chunks(spark, monkeypatch):
    rows = [(i, t) for i, (_, t) in enumerate(_texts(4, 150))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)  # a chunk each
    found = prefix_parse.remove_repeats(docs).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found), key=repr) == _bytes_by_definition(rows)


def test_triggers_over_pieces():
    rnd = random.Random(1)
    import numpy as np

    text = bytes(rnd.choice(b"abc") for _ in range(300_000)) + b"x" * 1000
    data, edges = np.frombuffer(text, dtype=np.uint8), np.array([0, 1000, 1030, len(text)])
    at, first, last, h = prefix_parse.triggers(data, edges)
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first.tolist(), last.tolist(), strict=True)])
    want = [s for a, b in ((0, 1000), (1000, 1030), (1030, len(text))) for s in range(a, b - 49)]
    assert starts.tolist() == want  # each string has one trigger, inside it
    assert ((first <= at) & (at + 16 <= last + 50) & (at - last >= 0) & (at - first <= 34)).all()
    by = dict(zip((text[a : a + 16] for a in at.tolist()), h.tolist(), strict=True))
    assert all(by[text[a : a + 16]] == x for a, x in zip(at.tolist(), h.tolist(), strict=True))


def _runs_by_definition(words, exponent, least):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        x = 0
        while x + q < len(words):
            s = x
            while x + q < len(words) and words[x] == words[x + q]:
                x += 1
            length = x + q - s
            if x > s and length >= max(least, exponent * q) and length >= 2 * q:
                found.setdefault((s, length), q)
            x = max(x, s + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def test_runs_of_words():
    rnd = random.Random(1)
    for _ in range(400):
        texts = []
        for _ in range(rnd.randint(1, 4)):
            letters = rnd.choice(["ab", "ab", "abcd"])
            words = [rnd.choice(letters).encode() for _ in range(rnd.randint(0, 14))] * rnd.randint(1, 6)
            k = rnd.randint(0, len(words))
            texts.append(words if rnd.random() < 0.5 else [*words[:k], rnd.choice("abc").encode(), *words[k:], *words[:k]])
        exponent, least = rnd.choice([(4, 6), (2, 2), (3, 5)])
        assert word_runs.text_runs(texts, exponent, least) == [_runs_by_definition(t, exponent, least) for t in texts]


def test_long_runs():
    assert word_runs.text_runs([[b"a"] * 50_000, [b"a", b"b"] * 20_000]) == [[(0, 50_000, 1)], [(0, 40_000, 2)]]


def test_periodic_runs_query(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 90)))) for i in range(120)]
    rows += [(3, "x y " * 9), (None, "z " * 12), (200, None), (201, ""), (202, " \n"), (203, "a b c a b c a b c a b c ä")]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in queries()["op12_periodic_runs"](spark, str(tmp_path)).collect()), key=repr)
    want = []
    for doc_id, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        h, n = (zlib.crc32(str(doc_id).encode()), len(words)) if doc_id is not None else (1, 0)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = _runs_by_definition(words, 4, 6)
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        longest = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        short = b" ".join(w for i, w in enumerate(words) if i not in gone)
        milli = 1000 * longest[1] // longest[2] if found else None
        want.append((doc_id, len(found), *longest, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(short).hexdigest()))
    assert got == sorted(want, key=repr)
    assert sum(r[1] for r in got) >= 12


def _ranks_by_definition(docs, items, k):
    def terms(text):
        text = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)

    counts = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    out = []
    for item, text in items:
        found = []
        for d, c in counts:
            score = 0
            for w in set(terms(text)) & set(c):
                m = 100 - 50 + 50 * c.total() * n_docs // total
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 20 * m))
            if score and d is not None:
                found.append((-score, d))
        out += [(item, i, d, -s) for i, (s, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard", [lexical.SHARD, 2000])
def test_ranked_search(spark, monkeypatch, shard):
    monkeypatch.setattr(lexical, "SHARD", shard)
    monkeypatch.setattr(lexical, "ITEMS", 3)  # several blocks
    rnd = random.Random(7)
    words = [f"w{i}" if i % 3 else f"Ä{i}É" for i in range(60)] + ["the", "THE", "x_y"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, rnd.choice(" ,-\n").join(rnd.choices(words, weights, k=rnd.choice([0, 1, 5, 20, 20, 150])))) for i in range(300)]
    docs += [(i + 300, docs[i][1]) for i in range(100)]  # ties
    docs += [(5, docs[5][1]), (None, "w1 w2 the"), (900, None), (901, " -- ")]
    items = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 6)))) for i in range(7)] + [(7, "the the the"), (8, "nowhere"), (9, None), (10, "THE w1"), (10, "THE w1")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(0)).repartition(6)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    got = sorted((tuple(r) for r in lexical.ranked_search(frame, asked, k=20).collect()), key=repr)
    assert got == _ranks_by_definition(docs, items, 20)
    assert len(got) > 100


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert prefix_parse.remove_repeats(docs).collect() == []
    assert word_runs.run_digests(word_runs.periodic_runs(docs)).collect() == []
    assert lexical.ranked_search(docs, items).collect() == []
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert lexical.ranked_search(some, items.limit(0)).collect() == []


def test_registered():
    assert {"op11_repeated_bytes", "op12_periodic_runs", "op13_ranked_search"} <= set(queries())
    assert "op13_ranked_search" in oracle_sql()
