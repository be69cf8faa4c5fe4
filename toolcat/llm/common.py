"""Helpers shared by the corpus operators: reading tables, cutting lineage, joins on keys that may be hot."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more than this share of all rows is joined by broadcast; there are at most 1 / HEAVY_SHARE such keys.
HEAVY_SHARE = 1 / 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Where that is unset, a cluster's tables lie in a
    folder of its warehouse, and a session on one machine gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.startswith("local"):
        folder = getattr(shared_dir, "own", None) or tempfile.mkdtemp(prefix="toolcat-")
        shared_dir.own = folder
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/toolcat").rstrip("/")


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as ``docs`` has such a column."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: it is computed once, and a lost executor
    loses none of it."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of many ``rows`` with one row of ``groups`` per ``key``, where ``size`` is a group's row count.

    Keys that hold over 1/1000 of the ``total`` rows, of which there can be 1,000 at most, are broadcast; the
    others are spread evenly by an ordinary join.
    """
    groups = materialize(groups, "joined")
    heavy = groups.filter(F.col(size) > F.lit(total * HEAVY_SHARE))
    if heavy.isEmpty():
        return rows.join(groups, key)
    light = groups.filter(F.col(size) <= F.lit(total * HEAVY_SHARE))
    return rows.join(F.broadcast(heavy), key).unionByName(
        rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key)
    )


#: Parts into which the rows of one ``owner`` are split if they are more than 1/1000 of all.
SALTS = 64


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``doc, owner, own, other``: pairs of documents with the texts of both. ``pairs``: doc, owner, without nulls;
    ``texts``: doc_id, text, shuffled once for both sides. An owner of very many pairs is copied, so that no task gets
    them all."""
    sizes = pairs.groupBy("owner").agg(F.count("*").alias("size"))
    heavy = sizes.filter(F.col("size") > HEAVY_SHARE * max(1, pairs.count())).select("owner")
    heavy = F.broadcast(materialize(heavy, "heavy").withColumn("heavy", F.lit(True)))
    salt = F.when(F.col("heavy"), F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int")).otherwise(0)
    salted = pairs.join(heavy, "owner", "left").withColumn("salt", salt).drop("heavy")
    later = salted.withColumnRenamed("doc", "doc_id").join(texts, "doc_id").withColumnsRenamed({"doc_id": "doc", "text": "own"})
    owned = texts.join(sizes.select(F.col("owner").alias("doc_id")), "doc_id").withColumnRenamed("doc_id", "owner").join(heavy, "owner", "left")
    salts = F.when(F.col("heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    owned = owned.select("owner", F.col("text").alias("other"), F.explode(salts).alias("salt"))
    return later.join(owned, ["owner", "salt"]).select("doc", "owner", "own", "other")
