"""Exact deduplication by content-defined chunk recipes, with built-in functions alone.

A text is cut where its content says so: at the first ``BOUNDARY`` after ``MIN_CHUNK`` characters, or after
``MAX_CHUNK`` characters where there is none. A chunk's identifier is its 64-bit hash with its length; the
chunk dictionary, which moves digests and never texts, verifies by SHA-256 that no identifier stands for two
chunks. Texts are equal when their ordered lists of verified identifiers are. Long documents are read once and
never shuffled.

Null texts count as empty; all empty texts are equal (their recipe is the empty list). Null ``doc_id``: the row
takes part, but stays only if every equal row has none either. Rows repeated with one ``doc_id`` share its
decision. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolcat.llm.common import join_groups, materialize, text_or_empty

MIN_CHUNK, MAX_CHUNK = 128, 8192
#: A chunk ends behind white space after letters or digits of these classes, which comes about every 200 characters.
BOUNDARY = r"[a-h0-3][q-z6-9][i-p4-5]\s"


def chunks(text: Column) -> Column:
    """The array of content-defined chunks, which joined give the text again."""
    pattern = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?{BOUNDARY}|.{{1,{MAX_CHUNK}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def list_key(items: Column) -> Column:
    """SHA-256 of an ordered list of strings without commas."""
    return F.unhex(F.sha2(F.array_join(items, ","), 256))


def _named(hash64: Column, length: Column) -> Column:
    return F.concat_ws(":", F.hex(hash64), length)


def _with_lists(recipes: DataFrame) -> DataFrame:
    """Add ``ids_key``, the digest of a row's ordered list of verified identifiers."""
    seen = recipes.select(F.explode("recipe").alias("c")).select("c.h", "c.n", "c.sha").distinct()
    collided = seen.groupBy("h", "n").agg(F.count("*").alias("texts")).filter("texts > 1").drop("texts")
    if collided.isEmpty():
        return recipes.withColumn("ids_key", list_key(F.transform("recipe", lambda c: _named(c["h"], c["n"]))))
    # Some identifier stands for two chunks: the digest takes its place.
    rows = recipes.select("doc_id", "text_sha256", "recipe").distinct()
    parts = rows.select("doc_id", "text_sha256", F.posexplode_outer("recipe").alias("pos", "c"))
    parts = parts.select("doc_id", "text_sha256", "pos", "c.h", "c.n", "c.sha")
    known = parts.join(collided.withColumn("twice", F.lit(True)), ["h", "n"], "left")
    name = F.when(F.col("twice"), F.hex("sha")).when(F.col("pos").isNotNull(), _named(F.col("h"), F.col("n")))
    lists = known.groupBy("doc_id", "text_sha256").agg(
        F.sort_array(F.collect_list(F.when(name.isNotNull(), F.struct("pos", name.alias("id"))))).alias("ids")
    )
    lists = lists.select("doc_id", "text_sha256", list_key(F.transform("ids", lambda x: x["id"])).alias("ids_key"))
    same = F.col("r.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("r.text_sha256") == F.col("l.text_sha256"))
    return recipes.alias("r").join(lists.alias("l"), same).select("r.doc_id", "r.text_sha256", "l.ids_key")


def exact_dedup(docs: DataFrame, chunk_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``; of equal texts the row with the
    largest ``doc_id`` stays. An empty table gives no rows."""
    text = text_or_empty()
    recipes = docs.select(
        "doc_id",
        F.sha2(text.cast("binary"), 256).alias("text_sha256"),
        F.transform(
            chunks(text),
            lambda c: F.struct(
                chunk_hash(c).alias("h"), F.length(c).alias("n"), F.unhex(F.sha2(c.cast("binary"), 256)).alias("sha")
            ),
        ).alias("recipe"),
    )
    recipes = materialize(recipes, "recipes")
    lists = _with_lists(recipes).select("doc_id", "text_sha256", "ids_key")
    groups = lists.groupBy("ids_key").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return join_groups(lists, groups, "ids_key", "group_size", recipes.count()).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
