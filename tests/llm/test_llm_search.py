"""Top-k search, toxicity, pages and personal data."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from toolcat.llm import html_text, pii, topk, toxicity


def test_topk_matches_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.3, 1.0]) for _ in range(4)]) for i in range(300)]
    rows += [(1000, None), (1001, [1.0, None, 0.0, 0.0]), (1002, [float("nan")] * 4), (1003, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (5, rows[5][1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).repartition(5)
    ints = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and i < 1000]
    want = {}
    for q, a in ints:
        if q % 10 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in ints if i != q)[:7]
            want[q] = [(i, -s) for s, i in scored]
    for block in (2048, 7):
        found = topk.exact_topk(vectors, vectors.filter("vec_id % 10 = 0"), k=7, block=block).collect()
        got = {}
        for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert got == want


def test_topk_with_few_rows_and_large_numbers(spark):
    vectors = spark.createDataFrame([(0, [3e30]), (1, [2.0]), (2, [-1e9])], "vec_id long, embedding array<float>")
    got = topk.exact_topk(vectors, vectors.filter("vec_id < 2"), k=10).collect()
    assert len(got) == 4 and {r.score for r in got if r.query_id == 1} == {2048 * math.floor(1024 * float(np.float32(-1e9))), 2**63 - 1}
    assert topk.exact_topk(vectors.limit(0), vectors.limit(0)).count() == 0


def test_block_max_index_is_exact(monkeypatch):
    rng = random.Random(1)
    vectors = []
    for _ in range(700):
        v = {t: rng.random() for t in rng.sample(range(40), rng.randrange(1, 6))}
        n = math.sqrt(sum(x * x for x in v.values()))
        vectors.append({t: x / n for t, x in v.items()})
    begin = np.cumsum([0] + [len(v) for v in vectors])
    term = np.array([t for v in vectors for t in v], dtype=np.int32)
    weight = np.array([x for v in vectors for x in v.values()])
    for frequent in (1024, 5):
        monkeypatch.setattr(toxicity, "FREQUENT", frequent)
        index = toxicity.BlockMaxIndex(begin, term, weight, 40, block=4)
        leave_out = np.arange(700) if frequent == 5 else None
        for n, (q, (at, cosines)) in enumerate(zip(vectors, index.nearest(begin, term, weight, 9, leave_out), strict=True)):
            every = np.array([sum(q[t] * v.get(t, 0.0) for t in q) for v in vectors])
            if leave_out is not None:
                every[n] = 0.0
            best = np.sort(every[every > 0])[::-1][:9]
            assert np.allclose(cosines, best) and np.allclose(every[at], cosines)


def test_block_max_index_with_few_blocks_and_copies():
    rng = np.random.default_rng(5)
    for size, k, block in ((0, 3, 4), (1, 3, 4), (30, 25, 4), (300, 25, 64), (300, 3, 4)):
        rows = (rng.random((size, 50)) < 0.2) * rng.random((size, 50)).round(1)
        rows[size // 2 :] = rows[size // 2] if size else rows  # one large group of copies
        rows = np.column_stack([rows, np.arange(size) % 7 == 0, np.full(size, 0.5)]).astype(np.float32)
        rows /= np.linalg.norm(rows, axis=1, keepdims=True)
        own, term = np.nonzero(rows)
        begin = np.searchsorted(own, np.arange(size + 1))
        index = toxicity.BlockMaxIndex(begin, term, rows[own, term], 53, block=block)
        wide = [*rows[:: max(1, size // 60)], np.zeros(52), np.eye(52)[3]]
        query = [np.flatnonzero(q) for q in wide]
        cuts, weight = np.cumsum([0, *map(len, query)]), np.concatenate([q[t] for q, t in zip(wide, query, strict=True)])
        for q, (at, cosines) in zip(wide, index.nearest(cuts, np.concatenate(query), weight, k), strict=True):
            every = rows.astype(float) @ q
            best = np.sort(every[every > 0])[::-1][:k]
            assert len(set(at.tolist())) == len(at) == len(best) and np.allclose(cosines, best) and np.allclose(every[at], cosines)
        for n, (at, cosines) in enumerate(index.nearest_others(np.arange(size), k)):
            every = rows.astype(float) @ rows[n]
            every[n] = 0
            assert n not in at and np.allclose(cosines, np.sort(every[every > 0])[::-1][:k])


def test_encoder_gives_a_text_the_same_arrays_whatever_came_before():
    text, words = "pathetic north stone north ABCDEF river", [b"river", b"north", b"stone", b"abcdef", b"pathetic"]
    hashes, tied = np.sort(toxicity.word_hashes(words)), [b"^path", b"pathetic", b"^abcde", b"sea"]
    used, fresh = toxicity.Encoder(hashes, tied), toxicity.Encoder(hashes, tied)
    used(["river stone sea", "abcdef", "north pathetic unknown"])
    (begin, numbers, counts), (own_begin, own, own_counts) = used([text, "", "sea abcd pathogen"])
    for got, want in zip((*used([text])[0], *used([text])[1]), (*fresh([text])[0], *fresh([text])[1]), strict=True):
        assert got.tolist() == want.tolist()
    assert begin.tolist() == [0, 5, 5, 5] and numbers.tolist() == [0, 1, 2, 3, 4]
    assert dict(zip(hashes[numbers].tolist(), counts.tolist(), strict=True)) == dict(zip(toxicity.word_hashes(words).tolist(), (1, 2, 1, 1, 1), strict=True))
    assert own_begin.tolist() == [0, 3, 3, 5] and own.tolist() == [0, 1, 2, 0, 3] and own_counts.tolist() == [1] * 5


def toxic_corpus(n=1200):
    rng = random.Random(9)
    words, bad = [f"word{i}" for i in range(300)], ["vilea", "vileb", "grim"]
    docs, labels = [], []
    for i in range(n):
        toxic = int(i % 7 == 0)
        text = [rng.choice(words) for _ in range(60)]
        for _ in range(2 * toxic):
            text[rng.randrange(60)] = rng.choice(bad)
        docs.append((i, " ".join(text)))
        labels.append((i, toxic))
    return docs, labels


def test_toxicity_on_the_held_out_fold(spark):
    docs, labels = toxic_corpus()
    odd = [(5000, None), (5001, "VILEA!"), (None, "grim"), (5002, "x" * 50_000), (5003, "vilez word1")]
    frame = spark.createDataFrame(docs + odd, "doc_id long, text string").withColumn("score", F.lit("clash"))
    marks = spark.createDataFrame([*labels, (1, None), (None, 1)], "doc_id long, toxic int")
    rows = {r.doc_id: r for r in toxicity.toxicity(frame, marks).collect()}
    assert len(rows) == len(docs) + len(odd)
    known = dict(labels)
    held = [r for i, r in rows.items() if i is not None and i < 5000 and r.held_out]
    assert len(held) > 100 and sum(r.predicted != known[r.doc_id] for r in held) <= 0.02 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    assert rows[5001].predicted == 1 and rows[5000].predicted == 0 and rows[5002].predicted == 0 and rows[None].held_out is None
    assert rows[5001].evidence and rows[5000].evidence == []


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.toxicity(docs, none).collect()} == {(0.0, 0)}
    assert toxicity.toxicity(docs.limit(0), none).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><a href="/">Home</a></nav><div class="post-12 content"><h2>Head &amp; line</h2><p>One <a href=x>link</a>&nbsp; two<p><b>Bold<br>
next</p><!-- no --><script>var t="</p>";</script><ul><li>item</ul><div class="share-buttons">Share</div></div>
<div id="comments"><p>reader</p></div><aside>side</aside><form>f</form><footer>&copy; foot</footer></body></html>"""


def test_main_text(spark):
    rows = [(1, "http://a.example/x", PAGE), (2, "http://a.example/y", None), (3, None, "plain text\nonly"), (4, "http://a.example/z", PAGE.replace("post-12", "post-99"))]
    got = {r.page_id: r for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].text == got[4].text == "Head & line\nOne link two\nBold\nnext\nitem" and got[1].n_chars == len(got[1].text)
    assert got[2].text == "" and got[3].text == "plain text only"
    assert html_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_hosts_outvote_an_odd_page(spark):
    usual = "<body><div class='ad-box x'>buy</div><div class='text'><p>{}</p></div><div class='links'><p>{}</p></div></body>"
    rows = [(i, f"http://h.example/{i}", usual.format("long article text " * 20, "short")) for i in range(8)]
    rows.append((99, "http://h.example/99", usual.format("brief", "a list of other things " * 30)))
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[99] == "brief"


def base(text):
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0:
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


PII = [
    "", None, "a@b.c_x@d.e a@@b.c 1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4", "4111 1111 1111 1111, 4111-1111-1111-1111 and 4111111111111112",
    "+1 (262) 555-3752 +12 + 1 +44 20 7946 0958.", "é😀 a@b.co 😀 10.0.0.1", " ".join(f"u{i}@x{i}.org" for i in range(300)), "1" * 5000, "1 " * 3000,
]


def test_base_spans_match_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(PII)], "doc_id long, text string, base string")
    for r in pii.pii(docs).collect():
        want = base(PII[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == len(list(filter(None, want.split(","))))
    assert pii.pii(docs.limit(0)).count() == 0


def test_running_sums(spark):
    n = [list(range(k)) for k in (0, 1, 63, 64, 65, 200)]
    got = spark.createDataFrame([(x,) for x in n], "a array<int>").select(pii.running_sums(F.col("a"))).collect()
    assert [r[0] for r in got] == [np.cumsum(x).tolist() for x in n]


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "Mail a@b.co or 10.0.0.1!", 3), (None, None, 1), (2, "none", 1)], "doc_id long, text string, n_chars long")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "Mail <email> or <ip>!", None: "", 2: "none"}


def test_boosted_trees_add_what_looks_like_base_spans(spark):
    rng = random.Random(4)
    digit = lambda k: "".join(str(rng.randrange(10)) for _ in range(k))
    rows, hidden, clean = [], {}, set()
    for i in range(900):
        area, mid, end = digit(3), digit(3), digit(4)
        kind = i % 6
        if kind == 0:
            text = f"word call +1 ({area}) {mid}-{end} now"
        elif kind == 1:
            text = f"batch {digit(4)} {digit(9)} ref {digit(11)} id{digit(9)}x"
        elif kind == 2:
            text = f"please call ({area}) {mid}-{end} or 1 ({area}) {mid}-{end} soon"
            hidden[i] = [f"({area}) {mid}-{end}", f"1 ({area}) {mid}-{end}"]
        elif kind == 3:
            text = f"mail me at u{digit(3)}@host{digit(2)}.example.com please"
        elif kind == 4:
            text = f"mail me at u{digit(3)} (at) host{digit(2)} (dot) example (dot) com please"
        else:
            text = f"on 2024-0{rng.randrange(1, 9)}-1{rng.randrange(9)} host 300.{rng.randrange(300)}.1.2 code {digit(16)}0"
        rows.append((i, text))
        if kind in (1, 5):
            clean.add(i)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [x.split(":") for x in r.spans.split(",") if x] for r in pii.pii(docs).collect()}
    texts = dict(rows)
    phones = sum(any(k == "phone" and texts[i][int(a) : int(b)] in h for k, a, b in got[i]) for i, h in hidden.items())
    spelled = [i for i in got if i % 6 == 4]
    assert phones >= 0.95 * len(hidden)
    assert sum(any(k == "email" for k, *_ in got[i]) for i in spelled) >= 0.95 * len(spelled)
    base = {i: base_of(texts[i]) for i in clean}
    added = [i for i in clean if {":".join(x) for x in got[i]} - base[i]]
    assert len(added) <= 0.02 * len(clean)


def test_trees_learn_from_all_examples(spark):
    """So few of the examples are bad that a third of them would be too few to learn from."""
    rows = spark.range(60_200, numPartitions=4).select(F.col("id").alias("key"), F.lit(0).alias("start"), (F.col("id") >= 200).cast("double").alias("label"))
    value = {"digits": F.when(F.col("label") > 0, 10).otherwise(8), "length": F.lit(12) + F.col("key") % 3, "kind_rank": F.lit(3)}
    rows = rows.select("*", *(value.get(n, F.lit(0)).cast("double").alias(n) for n in pii.FEATURES))
    accept = pii.train(rows)
    assert accept is not None
    seen = spark.createDataFrame([(10.0, False), (8.0, False), (10.0, True)], "digits double, no boolean")
    given = {n: F.lit(13.0 if n == "length" else 3.0 if n == "kind_rank" else 0.0) for n in pii.FEATURES}
    one = seen.select(F.struct("no", *(F.col(n) if n == "digits" else c.alias(n) for n, c in given.items())).alias("c"))
    assert [r[0] for r in one.select(accept(F.col("c"))).collect()] == [True, False, False]


def base_of(text):
    return set(filter(None, base(text).split(",")))


def test_redaction_odd_rows(spark):
    rows = [(1, "a@b.co 10.0.0.1", 5), (1, "a@b.co 10.0.0.1", 5), (None, "x@y.org", 1), (2, "a@b.co" * 3000, 1), (3, "+1 " * 5000, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("base", F.lit(1)).withColumn("_text", F.lit("t")).withColumn("kind", F.lit(0))
    out = pii.redact(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert sorted(r.text for r in out.filter("doc_id = 1").collect()) == ["<email> <ip>"] * 2
    assert pii.redact(docs.limit(0)).count() == 0


@pytest.mark.parametrize("html", ["<", "<p", "<!--", "<a b='", "</p></p>", "<script>", "<p>&#x110000;&bogus;&amp;"])
def test_broken_markup_does_not_stop(html):
    html_text.extract(html_text.parse(html), [0])


def test_toxicity_searches_by_all_words_with_few_labels(spark):
    rng = random.Random(4)
    words = [f"plain{i}" for i in range(200)]
    text = lambda: " ".join(rng.choice(words) for _ in range(40))
    docs = [(i, text() + (f" rare{i} odd{i}" if i % 6 == 0 else "")) for i in range(60)]
    docs += [(1000 + i, docs[i][1]) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(60)], "doc_id long, toxic int")
    known = {r.doc_id for r in toxicity.examples(frame, marks).collect()}
    rows = {r.doc_id: r for r in toxicity.toxicity(frame, marks).collect()}
    for i in known:  # the tied vocabulary is empty, and still each copy finds its example
        assert rows[1000 + i].evidence[0].doc_id == i and math.isclose(rows[1000 + i].evidence[0].cosine, 1.0, abs_tol=1e-6)
    assert all(len(r.evidence) == 3 for r in rows.values())


def test_main_text_takes_the_whole_article(spark):
    part = lambda n, w: f"<p>{(w + ' ') * n}</p>"
    whole = "<body><article><h1>Title</h1>{}<div class='wrap'><div class='body'>{}</div></div><section class='more'>{}</section></article></body>"
    parts = "<body><div class='page'><div class='part-one'>{}</div><div class='part-two'>{}</div></div></body>"
    odd = "<body><div class='page'><div class='part-one'>{}</div></div><div class='story'>{}</div></body>"
    rows = [(1, "http://one.example/", whole.format(part(10, "lead"), part(600, "main"), part(80, "more")))]
    rows += [(10 + i, f"http://two.example/{i}", parts.format(part(600, "first"), part(200, "second"))) for i in range(9)]
    rows.append((99, "http://two.example/99", odd.format(part(2, "little"), part(500, "story"))))
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(w in got[1] for w in ("Title", "lead", "main", "more"))
    assert all("first" in got[10 + i] and "second" in got[10 + i] for i in range(9))
    assert "story" in got[99]


def test_deep_and_broken_pages_take_linear_time():
    import time

    n = 4000
    pages = ["<div>x " * n, "<div>x " * n + "</div>" * n, "</p></span></div>" * n + "<div>" * n + "</ul>" * n, '<a "' * n, '<a "' * n + ">", "<a '>" * n + "t",
             "<script" * n, "<!-" * n, "<p class='" * n, "<x y=\"" * n + ">z", "<" * n * 5, "<div class=" + "a " * n + ">t", "&amp" * n]
    for html in pages:
        began = time.process_time()
        html_text.extract(html_text.parse(html), [1, 2, 3], {0})
        assert time.process_time() - began < 2, html[:20]
    deep = html_text.parse("<div>x " * 500)
    assert html_text.extract(deep, []).count("x") == 500


def brute_scores(html):
    """Scores by definition: each block counts in full at its own container, and by DECAY less at each one around it."""
    page, scores = html_text.parse(html), {}
    for node, text, linked in page.blocks:
        weight = float(len(text) - linked) or 0.01
        while node >= 0:
            scores[node] = scores.get(node, 0.0) + weight
            node, weight = page.parent[node], weight * html_text.DECAY
    scores = {n: s * (html_text.MAIN_BONUS if page.main[n] else 1) for n, s in scores.items()}
    best = sorted(scores, key=lambda n: (-scores[n], page.key[n]))[: html_text.VOTES]
    return [(n, scores[n] / sum(scores[b] for b in best)) for n in best]


@pytest.mark.parametrize("seed", range(30))
def test_container_scores_match_brute_force(seed):
    rng = random.Random(seed)
    html = "".join(rng.choice(["<div class=a1>", "<div class='b'>", "<article>", "</div>", "</article>", "<p>", "some words ", "<a>link text</a>", "<section>", "</section>"]) for _ in range(60))
    for (n, share), (m, want) in zip(html_text.path_scores(html_text.parse(html)), brute_scores(html), strict=True):
        assert n == m and math.isclose(share, want, rel_tol=1e-9)


def test_main_text_odd_rows(spark):
    rows = [(1, "http://a.example/x", PAGE), (1, "http://a.example/x", PAGE), (None, "http://a.example/q", PAGE), (2, "http://a.example/w", "<div>" * 3000 + "deep"),
            (3, "http://a.example/l", "<p>" + "long text " * 30_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("t")).withColumn("host", F.lit("h")).withColumn("path", F.lit(1))
    got = html_text.main_text(pages.repartition(3)).collect()
    assert len(got) == len(rows) and len({r.text for r in got if r.page_id in (1, None)}) == 1
    assert [r.text for r in got if r.page_id == 2] == ["deep"] and [r.n_chars for r in got if r.page_id == 3] == [299_999]


def brute_toxicity_votes(examples, idf, texts, k):
    """The neighbours' vote over all words by definition."""
    def vector(text):
        counts = {}
        for w in toxicity.words_of(text):
            counts[w] = counts.get(w, 0) + 1
        raw = {w: (1 + math.log(n)) * idf[w] for w, n in counts.items() if w in idf}
        norm = math.sqrt(sum(x * x for x in raw.values())) or 1.0
        return {w: x / norm for w, x in raw.items()}

    vectors = [(y, vector(t)) for _, t, y in examples]
    some = [(y, v) for y, v in vectors if v]
    overall = sum(y for _, _, y in examples) / len(examples)
    empty = [y for y, v in vectors if not v]
    base = (sum(empty) + overall) / (len(empty) + 1)
    out = []
    for text in texts:
        v = vector(text)
        near = sorted(((sum(x * u.get(w, 0.0) for w, x in v.items()), y) for y, u in some), reverse=True)[:k]
        near = [(c, y) for c, y in near if c > 0]
        weights = [1 / (0.05 + max(0.0, 1 - c)) for c, _ in near]
        out.append((sum(w * y for w, (_, y) in zip(weights, near, strict=True)) + base) / (sum(weights) + 1) if near else base)
    return out


def test_toxicity_votes_match_brute_force(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))), i % 3 == 0) for i in range(150)] + [(999, "", True)]
    frame = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    scorer, _ = toxicity.fit(frame, spark.createDataFrame([(i, int(y)) for i, _, y in docs], "doc_id long, toxic int"))
    model = scorer.model.value.build()
    known = {r.doc_id: (r.text, r.toxic) for r in toxicity.examples(frame, spark.createDataFrame([(i, int(y)) for i, _, y in docs], "doc_id long, toxic int")).collect()}
    used = {w for t, _ in known.values() for w in toxicity.words_of(t)}
    idf = {w: math.log((1 + len(docs)) / (1 + sum(w in set(toxicity.words_of(t)) for _, t, _ in docs))) + 1 for w in used}
    texts = [t for _, t, _ in docs[:60]] + ["nothing known here", "W1 w2, w3!"]
    votes, _, _ = model.votes(*model.encoder(texts))
    want = brute_toxicity_votes([(i, t, y) for i, (t, y) in known.items()], idf, texts, toxicity.NEIGHBOURS)
    assert np.allclose(votes[:, 0], want, atol=1e-4)
    scores = [s for s, _ in scorer.score(texts)]
    assert all(0 <= s <= 1 for s in scores)


def test_toxicity_of_repeated_rows(spark):
    docs, labels = toxic_corpus(400)
    frame = spark.createDataFrame(docs + docs[:50], "doc_id long, text string")
    rows = toxicity.toxicity(frame, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(rows) == 450 and len({(r.doc_id, r.score) for r in rows}) == 400
