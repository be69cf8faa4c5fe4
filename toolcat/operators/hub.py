"""The workflow hub's listing and its archives."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolcat.functions.text import or_default
from toolcat.scratch import written


def of_kind(hub: DataFrame, kind: str | None = None) -> DataFrame:
    """entries whose first descriptor type is ``kind``, in any case; all without one."""
    if kind is None:
        return hub
    first = F.get(F.get(F.col("versions"), 0)["descriptor_type"], 0)
    return hub.filter(F.lower(first) == kind.lower())


def download_url(url: Column) -> Column:
    return F.concat(url, F.lit("/download"))


def with_documents(hub: DataFrame, archives: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hub entries with their documents, the hub's url and description holding, and the failures.
    ``archives``: ``url, ga, error``."""
    got = archives.filter("ga IS NOT NULL").select("url", "ga")
    found = hub.join(got, "url").withColumn("description", or_default(F.col("description"), ""))
    missing = hub.join(got.select("url"), "url", "left_anti").join(archives.select("url", "error"), "url", "left")
    reason = F.coalesce("error", F.lit("no archive")).alias("reason")
    return found, missing.select(F.lit("archive").alias("stage"), F.col("url").alias("key"), reason)


def first_successful(rows: DataFrame, n: int, order: str = "hub_pos") -> DataFrame:
    """L1: the first n of what is left after failures."""
    return rows.orderBy(order).limit(n)


def take_successful(listing: DataFrame, n: int, attempt: Callable, order: str = "hub_pos") -> tuple[DataFrame, DataFrame]:
    """L1 with an early stop: the first ``n`` successes in the order of the listing, and the failures before the last of
    them. ``attempt`` takes entries and returns their successes and their failures, both with ``order``, a position
    without repeats. It is given the first 2 n entries, then twice as many of the next, until n have succeeded."""
    good_parts, bad_parts, left, size, after = [], [], n, 2 * n, None
    while left > 0:
        rest = listing if after is None else listing.filter(F.col(order) > after)
        some = written(rest.orderBy(order).limit(size), "entries")
        tried = some.agg(F.count("*").alias("n"), F.max(order).alias("last")).first()
        if not tried["n"] and good_parts:
            break
        good, bad = attempt(some)
        good = written(good.orderBy(order).limit(left), "successes")
        got = good.agg(F.count("*").alias("n"), F.max(order).alias("last")).first()
        left -= got["n"]
        good_parts.append(good)
        bad_parts.append(bad if left else bad.filter(F.col(order) < F.lit(got["last"])))
        if not tried["n"]:
            break
        after, size = tried["last"], 2 * size
    return reduce(DataFrame.unionByName, good_parts), reduce(DataFrame.unionByName, bad_parts)


def run_summary(headers: DataFrame, inputs: DataFrame, outputs: DataFrame, tools: DataFrame, key: str = "url") -> DataFrame:
    """Name, tags and counts of each workflow."""
    rows = headers.select(key, "uuid", "name", "version", F.concat_ws(", ", "tags").alias("tags"))
    for name, part in (("inputs", inputs), ("outputs", outputs), ("tools", tools)):
        rows = rows.join(part.groupBy(key).agg(F.count("*").alias(f"n_{name}")), key, "left")
    return rows.fillna(0, [f"n_{n}" for n in ("inputs", "outputs", "tools")])
