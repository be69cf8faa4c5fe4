"""Token counts, packing and SentencePiece sampling against the libraries and brute force."""

import collections
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from toolcat.llm import packing, pieces, token_counts
from toolcat.llm.tokens import WordEncoder, tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
ODD = [
    "", "  ", "áb ΣΑΣ İstanbul x<|endoftext|>y <|startoftext|>", "don't DON'T 'stuff' it's... 12²½", "\x1c\x1dz\x85q\xa0w e", "你好 世界 ßẞ",
    "a" * 300, "é ́x", "ǅ ŉ ſ Ÿ", "''s l'été", "ẛ̣ ﬁ Å", "line\none\ttwo\r\nthree", "x" * 70 + " y",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_cached_words_equal_the_library(library):
    for size in (3, 500_000):
        enc = WordEncoder(PATH, size)
        for texts in (ODD, ODD[::-1], ["the cat's THE, cat"] * 2):
            got = [np.frombuffer(b"".join(x), dtype="<u4").tolist() for x in enc.ids(texts)]
            assert got == [ids_of(library, t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=40))
def test_any_text_equals_the_library(text):
    from tokenizers import Tokenizer

    enc, lib = WordEncoder(PATH), Tokenizer.from_file(PATH)
    got = np.frombuffer(b"".join(enc.ids([text])[0]), dtype="<u4").tolist()
    assert got == lib.encode(text, add_special_tokens=False).ids


def test_token_counts(spark, library):
    rows = [(i, t, 5) for i, t in enumerate(ODD)] + [(None, None, 5), (0, "again", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = token_counts.token_counts(docs, limit=3).collect()
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (len((t or "").encode()), (n := len(ids_of(library, t or ""))), n > 3) for _, t, _ in rows
    )
    texts = {i: t for i, t, _ in rows[: len(ODD)]}
    for r in got:
        if r.doc_id:
            assert len(ids_of(library, texts[r.doc_id][: r.limit_chars])) <= 3
            words = texts[r.doc_id].replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            assert r.limit_words == sum(len(ids_of(library, " ".join(words[: k + 1]))) <= 3 for k in range(len(words)))
    assert token_counts.token_counts(docs.limit(0)).count() == 0


def test_every_prefix(spark, library):
    texts = ["Don't  stop, 12 tokenizers!\nEnd", *ODD]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = token_counts.prefix_counts(docs, "character", limit=5)
    got = {r.doc_id: r for r in rows.collect()}
    for i, text in enumerate(texts):
        assert got[i].counts == [len(ids_of(library, text[:j])) for j in range(len(text) + 1)], text
        plain = all(map(token_counts.is_plain, text.split()))
        best = max(j for j, n in enumerate(got[i].counts) if n <= 5)
        # white space behind the last token is left out
        assert text[: got[i].limit_chars].rstrip() == text[:best].rstrip() if plain else got[i].counts[got[i].limit_chars] <= 5
    cut = rows.filter("doc_id = 0").select(token_counts.truncation_point(4).alias("cut"), token_counts.tokens_before(10).alias("n")).first()
    assert len(ids_of(library, texts[0][: cut.cut])) <= 4 and cut.n == got[0].counts[10]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abcdeilnorstu-'é½.!", min_size=1, max_size=30))
def test_prefixes_of_parts_equal_the_library(text):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(PATH)
    want = [len(lib.encode(text[:j], add_special_tokens=False).ids) for j in range(len(text) + 1)]
    assert token_counts.character_prefixes(text, PATH).tolist() == want


def test_packing(spark, library):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["alpha", "beta,", "gamma", "Zeta"]) for _ in range(rng.randrange(1, 300)))) for i in range(150)]
    rows += [(900, None), (901, "word " * 3000), (None, "x y"), (3, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = packing.pack(docs, capacity=256, group=64).collect()
    want = {t: np.array([*ids_of(library, t or ""), 2], dtype="<u4") for _, t in rows}
    assert sum(r.length for r in got) == sum(map(len, want.values()))
    known = collections.Counter((i, len(want[t])) for i, t in rows)
    starts = collections.Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0)
    assert starts == known
    for r in got:
        ids = next(want[t] for i, t in rows if i == r.doc_id and len(want[t]) == r.doc_tokens)
        assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    at = collections.defaultdict(list)
    for r in got:
        at[r.sequence_id].append((r.offset, r.length))
    for parts in at.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    assert len(at) * 256 < 1.1 * sum(r.length for r in got) + 256 * 4
    assert packing.pack(docs.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_windows_hold_each_piece_once(lengths):
    found = packing.pack_lengths(np.array(lengths, dtype=np.int64), 50) if lengths else []
    assert sorted(i for w in found for i in w) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in w) <= 50 for w in found)


def _all_paths(arcs, at, n):
    if at == n:
        yield (), 0.0
        return
    for piece, nxt, w in arcs[at]:
        for rest, s in _all_paths(arcs, nxt, n):
            yield (piece, *rest), w + s


def _arcs(word, penalty=1.0, temperature=4000.0):
    """By position: ids, next position and log weight of each piece, by the library's vocabulary."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    known = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    out = []
    for at in range(len(word)):
        here = [((known[p],), at + n, max(-32000.0, sp.get_score(known[p])) / temperature - penalty)
                for n in range(1, len(word) - at + 1) if (p := word[at : at + n]) in known]
        if word[at] not in known:
            spelled = tuple(sp.piece_to_id(f"<0x{b:02X}>") for b in word[at].encode())
            here.append((spelled, at + 1, -penalty * len(spelled)))
        out.append(here)
    return out


def _sampled(lattice, text, k, seed):
    """Ids, log-probability and log inclusion of each sample."""
    found = lattice.sample(lattice.words([text]), k, np.array([seed], dtype=np.uint64))[0]
    out = []
    for arcs, log_p, inclusion in found:
        ids, _ = lattice.ids([arcs])
        out.append((tuple(ids.tolist()), log_p, inclusion))
    return out


@pytest.mark.parametrize("text, words", [("the cat", ["▁the", "▁cat"]), ("é漢 a", ["▁é漢", "▁a"])])
def test_samples_follow_the_lattice(text, words):
    lattice = pieces.Lattice(tokenizer_path("piece_bpe_32k.model"), 4000.0, 1.0)
    paths = [((), 0.0)]
    for w in words:
        paths = [(sum(map(tuple, b), a), s + t) for a, s in paths for b, t in _all_paths(_arcs(w), 0, len(w))]
    total = np.logaddexp.reduce([s for _, s in paths])
    prob = {p: float(np.exp(s - total)) for p, s in paths}
    n, first, estimate = 3000, collections.Counter(), collections.Counter()
    k = min(3, len(prob))
    for seed in range(n):
        got = _sampled(lattice, text, k, 1_000_003 * seed)
        assert len({s for s, _, _ in got}) == k
        first[got[0][0]] += 1
        for s, log_p, inclusion in got:
            assert abs(log_p - np.log(prob[s])) < 1e-9
            estimate[s] += np.exp(log_p - inclusion)  # weighted by inclusion, samples are unbiased
    for p in sorted(prob, key=prob.get)[-4:]:
        assert abs(first[p] / n - prob[p]) < 0.04 and abs(estimate[p] / n - prob[p]) < 0.04


def test_all_segmentations_of_a_short_text():
    lattice = pieces.Lattice(tokenizer_path("piece_bpe_32k.model"))
    want = {sum(p, ()) for p, _ in _all_paths(_arcs("▁ab"), 0, 3)}
    got = _sampled(lattice, "ab", 50, 7)
    assert {s for s, _, _ in got} == want and len(got) == len(want)
    assert all(i == 0.0 for _, _, i in got)  # all are in for sure
    assert _sampled(lattice, "", 3, 7) == [((), 0.0, 0.0)]


def test_samples_do_not_depend_on_the_cache_or_on_other_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdé 漢\n.") for _ in range(rng.randrange(300))) for _ in range(80)] + ["x" * 400, "", "  two  spaces ", " ▁a"]
    small, large = (pieces.Lattice(tokenizer_path("piece_bpe_32k.model"), nodes=n) for n in (50, 10**6))
    keys = list(range(len(texts)))
    whole = pieces.sample_texts(large, keys, texts, 3).to_pylist()
    parts = []
    for i in range(0, len(texts), 7):
        parts += [{**r, "at": r["at"] + i} for r in pieces.sample_texts(small, keys[i : i + 7], texts[i : i + 7], 3).to_pylist()]
    for r, s in zip(whole, parts, strict=True):
        assert r.pop("log_prob") == pytest.approx(s.pop("log_prob")) and r.pop("log_inclusion") == pytest.approx(s.pop("log_inclusion"))
        assert r == s and r["round_trip"]
    assert small.store.nodes < 3000


def test_sampling_and_decoding_round_trip(spark):
    rows = [(1, "x\ny  z é😀 漢字"), (2, None), (3, "a" * 200 + " b"), (None, "plain words"), (1, "x\ny  z é😀 漢字")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = pieces.sample_pieces(docs, k=3)
    again = {(r.doc_id, r["sample"], r.ids_crc32) for r in pieces.sample_pieces(docs.repartition(3), k=3).collect()}
    assert {(r.doc_id, r["sample"], r.ids_crc32) for r in got.collect()} == again
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in got.collect())
    assert pieces.sample_pieces(docs.limit(0)).count() == 0
    clash = docs.withColumn("ids", F.lit("x")).withColumn("sample", F.lit(0)).withColumn("at", F.lit(0))
    assert {(r.doc_id, r["sample"], r.ids_crc32) for r in pieces.sample_pieces(clash, k=3).collect()} == again
    back = {(r.doc_id, r.text) for r in pieces.decode(got.select("doc_id", "ids")).collect()}
    assert back == {(i, t or "") for i, t in rows}
    best = {(r.doc_id, r.text) for r in pieces.decode(pieces.encode(docs)).collect()}
    assert best == back


def test_packing_of_several_groups_a_task(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASKS", 1)
    docs = spark.range(2000).selectExpr("id AS doc_id", "repeat('word ', CAST(id % 90 AS INT)) AS text").repartition(4)
    got = packing.pack(docs, capacity=256, group=64).collect()
    windows = collections.Counter()
    for r in got:
        windows[r.sequence_id] += r.length
    assert sum(windows.values()) == sum(i % 90 + 1 for i in range(2000)) and max(windows.values()) <= 256
    assert len(windows) * 256 < 1.1 * sum(windows.values())


def test_packing_at_the_real_capacity_and_odd_rows(spark, library):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(1, 9)))
    rows = [(i, " ".join(word() for _ in range(rng.choice([5, 200, 900, 7000])))) for i in range(60)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (900, " ".join(word() for _ in range(30_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("x")).withColumn("start", F.lit(0)).withColumn("offset", F.lit(1))
    got = packing.pack(docs.repartition(4)).collect()
    want = collections.Counter()
    for i, t in rows:
        want[i] += len(ids_of(library, t)) + 1
    have, windows, full = collections.Counter(), collections.Counter(), 0
    for r in got:
        have[r.doc_id] += r.length
        windows[r.sequence_id] += r.length
        assert r.length <= 4096 and r.offset + r.length <= 4096
        full += r.length == 4096
    assert have == want and max(windows.values()) == 4096 and full >= 20
    assert len(windows) * 4096 <= sum(want.values()) * 1.1 + 4096


def test_character_prefixes_of_long_texts(library):
    text = "word " * 120 + "x" * 90 + " 1234567890 end!!! " + "é" * 40
    got = token_counts.character_prefixes(text, PATH)
    for i in (0, 1, 599, 600, 640, 690, 691, 700, len(text) - 1, len(text)):
        assert got[i] == len(ids_of(library, text[:i]))
