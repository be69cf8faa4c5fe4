"""Repositories and their file trees. A tree has ``repo_owner, repo, branch, path, type`` (``blob`` is a file)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolcat.functions.text import file_name, folder_url, git_url_to_api, parent_dir, under_base

REPO = ["repo_owner", "repo"]
IGNORED = ("kubernetes",)
MARKER = ".shed.yml"


def usable_repositories(listing: DataFrame) -> DataFrame:
    """repositories that aren't ignored, with their ``api_url``."""
    rows = listing.withColumn("api_url", git_url_to_api(F.col("remote_repository_url")))
    return rows.filter(~F.coalesce(F.lower("name").isin(*IGNORED), F.lit(False)) & (F.col("remote_repository_url") != "") & F.col("api_url").isNotNull())


def unique_repositories(listing: DataFrame) -> DataFrame:
    """A2."""
    return usable_repositories(listing).select("api_url").distinct()


def tool_folders(tree: DataFrame, base: str | Column = "") -> DataFrame:
    """The folders below ``base`` that hold a marker file, with their addresses."""
    base = F.lit(base) if isinstance(base, str) else base
    rows = tree.filter((F.col("type") == "blob") & F.lower("path").endswith(MARKER) & under_base(base, F.col("path")))
    rows = rows.select(*REPO, "branch", parent_dir(F.col("path")).alias("folder")).distinct()
    root = F.concat(F.lit("https://api.github.com/repos/"), F.concat_ws("/", "repo_owner", "repo"), F.lit("/contents"))
    return rows.withColumn("folder_url", folder_url(root, F.col("folder"), F.col("branch")))


def _files(tree: DataFrame) -> DataFrame:
    rows = tree.filter((F.col("type") == "blob") & ~F.lower("path").contains("depricated"))  # F12; spelt as in the trees
    return rows.select(*REPO, "branch", "path", parent_dir(F.col("path")).alias("dir"), file_name(F.col("path")).alias("name"))


def _markers(tree: DataFrame) -> DataFrame:
    """Directories with a file that is the marker itself."""
    return _files(tree).filter(F.lower("name") == MARKER).select(*REPO, "dir").distinct()


def _marked_xml(tree: DataFrame) -> DataFrame:
    """XML files in a directory with a marker."""
    return _files(tree).filter(F.lower("name").endswith(".xml")).join(_markers(tree), [*REPO, "dir"], "left_semi")


def _ancestors(path: Column) -> Column:
    """The directories above one, the root '' first."""
    parts = F.split(path, "/")
    return F.when(path == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    )


def crawl(tree: DataFrame) -> DataFrame:
    """Going down from the root, the XML files of the first marked directory on each way."""
    files = _marked_xml(tree)
    dirs = files.select(*REPO, "dir").distinct()
    above = dirs.select(*REPO, "dir", F.explode(_ancestors(F.col("dir"))).alias("above"))
    marks = _markers(tree).withColumnRenamed("dir", "above")
    hidden = above.join(marks, [*REPO, "above"], "left_semi").select(*REPO, "dir").distinct()
    return files.join(hidden, [*REPO, "dir"], "left_anti")


def smart_crawl(tree: DataFrame) -> DataFrame:
    """The XML files of all marked directories, nested ones too."""
    return _marked_xml(tree)


def tool_counts(files: DataFrame) -> DataFrame:
    """A10: XML files by repository."""
    return files.groupBy(*REPO).agg(F.count("*").alias("tools"), F.count_distinct("dir").alias("folders"))
