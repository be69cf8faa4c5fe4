"""Repairs of stored rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolcat import schemas
from toolcat.functions.text import clean_categories, first_text, git_url_to_api, name_variants, without_newlines
from toolcat.operators.catalog import patch


def uri_patches(registry: DataFrame, archetype: str = schemas.VIP_APP) -> DataFrame:
    """``id, uri, location`` of the rows whose uri holds a line feed."""
    rows = registry.filter((F.col("archetype") == archetype) & F.contains("uri", F.lit("\n")))
    clean = without_newlines(F.col("uri"))
    return rows.select("id", clean.alias("uri"), clean.alias("location"))


def without_tools(repositories: DataFrame, stored: DataFrame) -> DataFrame:
    """Repositories with a usable URL under none of whose name variants a tool is stored. ``stored``: name."""
    rows = repositories.filter(git_url_to_api(F.col("remote_repository_url")).isNotNull())
    spelt = rows.select("name", F.explode(name_variants(F.col("name"))).alias("variant")).distinct()
    names = stored.select(F.col("name").alias("variant")).distinct()
    found = spelt.join(names, "variant", "left_semi").select("name").distinct()
    return rows.join(found, "name", "left_anti")


def unexpanded_versions(tools: DataFrame) -> DataFrame:
    """D2."""
    return tools.filter(F.col("version").contains("VERSION"))


def repaired_versions(tools: DataFrame, parsed: DataFrame) -> DataFrame:
    """D3: the next snapshot, with versions from freshly parsed tools of the same id. ``parsed``: id, version."""
    good = parsed.filter(~F.col("version").contains("VERSION")).groupBy("id").agg(F.min("version").alias("version"))
    wanted = unexpanded_versions(tools).select("id").distinct()
    return patch(tools, good.join(wanted, "id", "left_semi"))


def converter_differences(urls: DataFrame, one: Callable[[Column], Column], other: Callable[[Column], Column]) -> DataFrame:
    """``url, a, b`` where two converters differ."""
    rows = urls.select("url", one(F.col("url")).alias("a"), other(F.col("url")).alias("b"))
    return rows.filter(~F.col("a").eqNullSafe(F.col("b")))


def repointed(ledger: DataFrame, corrected: DataFrame, now: Column) -> DataFrame:
    """The next snapshot: error rows with a corrected url take it and are pending again. ``corrected``: url, new."""
    rows = ledger.join(corrected.select("url", "new"), "url", "left")
    move = (F.col("status") == schemas.ERROR) & F.col("new").isNotNull()
    new = {
        "url": F.when(move, F.col("new")).otherwise(F.col("url")),
        "status": F.when(move, F.lit(schemas.PENDING)).otherwise(F.col("status")),
        "error_code": F.when(~move, F.col("error_code")),
        "updated_at": F.when(move, now).otherwise(F.col("updated_at")),
    }
    return rows.select(*(new[c].alias(c) if c in new else F.col(c) for c in ledger.columns))


def backfilled(tools: DataFrame, sidecars: DataFrame, key: str = "folder_url") -> DataFrame:
    """The next snapshot: description, owner and categories from the sidecar where both texts are empty."""
    s = sidecars.select(key, F.struct("owner", "description", "long_description", "categories").alias("s"))
    empty = first_text(F.col("description"), F.col("owner")).isNull() & F.col("s").isNotNull()
    text = F.coalesce(first_text(F.col("s.long_description"), F.col("s.description")), F.lit(""))
    new = {
        "description": F.when(empty, text).otherwise(F.col("description")),
        "owner": F.when(empty, F.coalesce("s.owner", F.lit(""))).otherwise(F.col("owner")),
        "categories": F.when(empty, clean_categories(F.col("s.categories"))).otherwise(F.col("categories")),
    }
    rows = tools.join(s, key, "left")
    return rows.select(*(new[c].alias(c) if c in new else F.col(c) for c in tools.columns))
