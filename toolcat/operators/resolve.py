"""Tools from XML files with their macros and sidecars, and workflows' tool ids resolved to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolcat import schemas
from toolcat.functions.text import clean_categories, first_text, or_default, resolve_path, shed_uri_parts, sorted_set, split_formats, strip_http
from toolcat.functions.toolxml import parse_sidecar, parse_tool, xml_head
from toolcat.operators.keyfilter import prefilter
from toolcat.operators.repotree import MARKER, REPO
from toolcat.scratch import written

PLACE = [*REPO, "dir"]


def _redirected(macros: DataFrame, contents: DataFrame) -> DataFrame:
    """Macro files, those that hold nothing but the relative path of another replaced by that one, if it is there.
    Only they are joined, with the files that they lead to."""
    target = F.when(F.col("content").startswith("../"), resolve_path(F.col("dir"), F.trim("content")))
    macros = written(macros.withColumn("target", target), "macros")
    moved, direct = macros.filter("target IS NOT NULL"), macros.filter("target IS NULL").drop("target")
    path = F.concat_ws("/", F.nullif("dir", F.lit("")), "name")
    there = prefilter(contents.select(*REPO, path.alias("target"), "content"), moved, [*REPO, "target"]).withColumnRenamed("content", "there")
    moved = moved.join(there, [*REPO, "target"], "left").select(*PLACE, "name", F.coalesce("there", "content").alias("content"))
    return direct.select(*PLACE, "name", "content").unionByName(moved)


def macro_tokens(heads: DataFrame, contents: DataFrame) -> DataFrame:
    """By tool file its tokens in order of definition: those of its macro files, as it imports them, then its
    own. A name keeps its first place and takes its last value. ``heads``: place, path, head; ``contents``: place, name,
    content of every file, of which only the files named in an import move."""
    wanted = heads.select(*PLACE, "path", F.posexplode("head.imports").alias("file", "name"))
    names = wanted.select(*PLACE, "name").distinct()
    near = prefilter(contents.select(*PLACE, "name", "content"), names, [*PLACE, "name"])
    macros = _redirected(near.join(names, [*PLACE, "name"], "left_semi"), contents)
    macros = macros.select(*PLACE, "name", xml_head("content").alias("head")).select(*PLACE, "name", "head.tokens")
    own = heads.select(*PLACE, "path", F.lit(None).cast("int").alias("file"), "head.tokens")
    lists = wanted.join(macros, [*PLACE, "name"]).select(*PLACE, "path", "file", "tokens").unionByName(own)
    one = lists.select(*PLACE, "path", F.coalesce("file", F.lit(2**31 - 1)).alias("file"), F.posexplode("tokens").alias("pos", "t"))
    at = F.struct("file", "pos")
    named = one.groupBy(*PLACE, "path", "t.name").agg(F.min(at).alias("at"), F.max_by("t.value", at).alias("value"))
    ordered = F.sort_array(F.collect_list(F.struct("at", "name", "value")))
    return named.groupBy(*PLACE, "path").agg(F.transform(ordered, lambda t: F.struct(t["name"].alias("name"), t["value"].alias("value"))).alias("tokens"))


def tools(files: DataFrame, contents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tools of ``files`` (place, path, content) and the files that are none, as errors. Heads and tools are
    parsed once and written."""
    heads = written(files.select(*PLACE, "path", "content", xml_head("content").alias("head")), "heads")
    tokens = macro_tokens(heads.select(*PLACE, "path", "head"), contents)
    # Dealt out by number, as parsing takes long for few bytes, and by the keys that joins and groups need anyway.
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = heads.select(*PLACE, "path", "content").repartition(n, *PLACE, "path").join(tokens, [*PLACE, "path"], "left")
    rows = written(rows.select(*PLACE, "path", parse_tool("content", F.coalesce("tokens", F.array().cast(schemas.tokens))).alias("t")), "parsed")
    bad = rows.filter("t.inputs IS NULL").select(F.lit("tool").alias("stage"), F.col("path").alias("key"), F.col("t.error").alias("reason"))
    sides = contents.filter(F.lower("name") == MARKER).repartition(n, *PLACE).groupBy(*PLACE).agg(F.min("content").alias("yml"))
    sides = sides.select(*PLACE, parse_sidecar("yml").alias("side"))
    good = rows.filter("t.inputs IS NOT NULL").join(sides, PLACE, "left")
    empty = F.lit("")
    return good.select(
        *PLACE, "path", F.col("t.id").alias("id"), F.col("t.name").alias("tool_name"), F.col("t.version").alias("version"),
        F.coalesce(first_text(F.col("t.description"), F.col("side.long_description"), F.col("side.description")), empty).alias("description"),
        or_default(F.col("t.help"), "").alias("help"), or_default(F.col("side.owner"), "").alias("owner"),
        clean_categories(F.col("side.categories")).alias("categories"), F.col("t.inputs").alias("inputs"),
        F.col("t.outputs").alias("outputs"), F.lit(schemas.SHED_TOOL).alias("archetype"),
        F.col("t.error").alias("note"),
    ), bad


def tool_formats(inputs: Column) -> Column:
    """The sorted set of one tool's input formats."""
    return sorted_set(F.flatten(F.transform(inputs, lambda p: split_formats(p["format"]))))


def resolve(uris: DataFrame, info: DataFrame, tools: DataFrame) -> DataFrame:
    """Distinct tool ids with the first tool, by folder and file, of their repository that has the name;
    ``version_mismatch`` where its version is another. ``uris``: ``tool``; ``tools`` with ``repo_url``."""
    rows = uris.select("tool").distinct().withColumn("u", shed_uri_parts(F.col("tool"))).filter("u IS NOT NULL")
    rows = rows.select("tool", "u.owner", "u.repo", "u.name", "u.revision")
    known = info.select("owner", "repo", "revision", F.get(F.col("info"), 0)["remote_repository_url"].alias("repo_url"))
    found = rows.join(known, ["owner", "repo", "revision"]).select("tool", "name", "revision", "repo_url")
    have = tools.select("repo_url", F.col("id").alias("name"), F.struct("dir", "path", "version", "inputs", "outputs", "description").alias("t"))
    best = found.join(have, ["repo_url", "name"]).groupBy("tool", "name", "revision", "repo_url").agg(
        F.min_by("t", F.struct("t.dir", "t.path")).alias("t")
    )
    return best.select("tool", "name", "repo_url", "t.*", (~F.col("t.version").eqNullSafe(F.col("revision"))).alias("version_mismatch"))


def tool_versions(uris: DataFrame, versions: DataFrame) -> DataFrame:
    """Tool ids, with or without a scheme before them, with what the tool service says about that very version.
    ``uris``: tool; ``versions``: owner, repo, name, revision, body."""
    rows = uris.select("tool").distinct().withColumn("u", shed_uri_parts(strip_http(F.col("tool")))).filter("u IS NOT NULL")
    rows = rows.select("tool", "u.owner", "u.repo", "u.name", "u.revision")
    return rows.join(versions, ["owner", "repo", "name", "revision"])


def attach(endpoints: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """End points with their tools, and those whose tool isn't known."""
    return endpoints.join(resolved, "tool"), endpoints.join(resolved.select("tool"), "tool", "left_anti")


def workflow_parameters(attached: DataFrame, column: str, key: str = "url") -> DataFrame:
    """All parameters of a workflow's tools, in the tools' order."""
    rows = attached.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "tool", column))).alias("x"))
    return rows.select(key, F.flatten(F.transform("x", lambda r: r[column])).alias(column))
