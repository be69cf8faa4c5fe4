"""Readers of landed catalogue data. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolcat import schemas
from toolcat.functions.text import file_name, parent_dir
from toolcat.functions.toolxml import first_workflow


def _json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def hub_listing(spark: SparkSession, path: str) -> DataFrame:
    """All pages of the workflow hub's listing; a page is a file, an empty one adds nothing."""
    return _json(spark, path, schemas.hub_entry)


def archives(spark: SparkSession, path: str) -> DataFrame:
    """``path, entry, position, ga, error`` of each workflow archive."""
    return first_workflows(spark.read.format("binaryFile").load(path))


def first_workflows(files: DataFrame) -> DataFrame:
    """L2: the first workflow of each archive. ``files``: path, content."""
    return files.select("path", "content").mapInPandas(first_workflow, "path string, entry string, position int, ga string, error string")


def repositories(spark: SparkSession, path: str) -> DataFrame:
    """S3."""
    return _json(spark, path, schemas.repo_listing)


def install_info(spark: SparkSession, path: str) -> DataFrame:
    """S4."""
    return _json(spark, path, schemas.install_info)


def tool_versions(spark: SparkSession, path: str) -> DataFrame:
    """S5."""
    return _json(spark, path, "owner string, repo string, name string, revision string, body string")


def repo_tree(spark: SparkSession, path: str) -> DataFrame:
    """``repo_owner, repo, branch, path, type`` of every entry of each repository's default branch."""
    rows = _json(spark, path, schemas.git_tree)
    return rows.select("repo_owner", "repo", "branch", F.explode("tree").alias("e")).select("repo_owner", "repo", "branch", "e.*")


def directory_listing(tree: DataFrame) -> DataFrame:
    """The tree with each entry's directory and name."""
    return tree.withColumn("dir", parent_dir(F.col("path"))).withColumn("name", file_name(F.col("path")))


def text_files(spark: SparkSession, path: str, root: str) -> DataFrame:
    """``path`` below ``root``, ``dir, name, content`` of whole files."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("at"), F.col("value").alias("content"))
    inside = F.substring_index(F.col("at"), f"{root.rstrip('/')}/", -1)
    return directory_listing(rows.select(inside.alias("path"), "content")).select("path", "dir", "name", "content")


def app_index(spark: SparkSession, path: str) -> DataFrame:
    """The names of known applications; a missing index is an empty one."""
    return _json(spark, path, schemas.app_index)


def descriptor_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, content`` of every JSON file one directory below ``root``."""
    return text_files(spark, f"{root.rstrip('/')}/*/*.json", root).select("path", "content")


def registry(spark: SparkSession, path: str, archetype: str | None = None) -> DataFrame:
    """The stored tools, of one archetype if it is named."""
    rows = spark.read.schema(schemas.tool_generic).parquet(path)
    return rows if archetype is None else rows.filter(F.col("archetype") == archetype)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """S13."""
    return spark.read.schema(schemas.tool_harvest).parquet(path)


def tool_io(spark: SparkSession, path: str) -> DataFrame:
    """``tool_id, io_json``."""
    return _json(spark, path, "tool_id string, io_json string")


def snapshot(df: DataFrame, path: str, form: str = "parquet") -> DataFrame:
    """K6: write a listing and go on from what was written."""
    df.write.mode("overwrite").format(form).save(path)
    return df.sparkSession.read.schema(df.schema).format(form).load(path)
