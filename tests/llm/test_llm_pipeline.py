"""The pipeline over a small corpus, stage by stage."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from toolcat.llm import toxicity


def corpus():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    shared = line(60)
    docs, labels = [], []
    for i in range(700):
        toxic = int(i % 9 == 0)
        text = line(40) + (" vile scorn." if toxic else "")
        if i in (100, 200, 301):
            text += "\n" + shared
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, 1, toxic))
    docs += [(800, docs[1][1], "en", "s", 1), (801, "Mail me: a@b.co " + line(30), "en", "s", 1), (802, None, None, None, None), (None, "no id here", "en", "s", 1)]
    return docs, labels, shared


def test_stages(spark, tmp_path):
    docs, labels, shared = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    at, state = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, str(tmp_path))
        if name != "packing":
            assert out.columns == frame.columns
            state[name] = {r.doc_id: r for r in out.collect()}
        out.write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
    clean = {i for i, *_ in docs if i is None or i % 9 or i >= 700}
    assert set(state["toxicity"]) == clean
    assert set(state["line_dedup"]) == clean
    assert shared in state["line_dedup"][100].text and shared not in state["line_dedup"][200].text and shared not in state["line_dedup"][301].text
    assert state["line_dedup"][800].text == "" and state["line_dedup"][1].text == docs[1][1]
    assert 802 not in state["near_dedup"] and {1, 800} <= set(state["near_dedup"]) and len(state["near_dedup"]) == len(clean) - 1
    assert "<email>" in state["pii"][801].text and state["pii"][801].n_chars == len(state["pii"][801].text)
    rows = at.collect()
    assert {r.doc_id for r in rows} == set(state["pii"])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(rows)


def test_examples_are_bounded(spark):
    docs, labels, _ = corpus()
    frame = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    marks = spark.createDataFrame([(i, t) for i, _, t in labels], "doc_id long, toxic int")
    assert toxicity.examples(frame, marks, limit=50).count() <= 50


def test_stages_keep_columns_of_any_name_and_repeated_rows(spark, tmp_path):
    docs, labels, shared = corpus()
    docs = docs[:200] + [docs[3], docs[3]]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("_toxic", "_removed", "_row", "cut", "doc", "new_text", "base", "owner", "keys"):
        frame = frame.withColumn(name, F.concat(F.lit("k"), F.col("doc_id").cast("string")))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    at = frame
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == frame.columns
        at.write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        rows = at.collect()
        assert all(r._toxic == r._removed == r.keys == f"k{r.doc_id}" for r in rows if r.doc_id is not None)
        assert sum(r.doc_id == 3 for r in rows) == (3 if name in ("toxicity", "line_dedup") else 1)
    assert "doc_id" in corpus_pipeline.STAGES[-1][1](spark, at, str(tmp_path)).columns


def test_empty_tables(spark, tmp_path):
    frame = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_go_in_their_stage(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(500)]
    docs = []
    for i in range(40):
        base = [rng.choice(words) for _ in range(100)]
        copy = list(base)
        copy[rng.randrange(20, 80)] = "changed"
        docs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, frame, "").collect()}
    assert kept == set(range(0, 80, 2))
