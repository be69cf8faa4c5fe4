"""Workflow documents: headers, steps, edges, end points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolcat import schemas
from toolcat.functions.text import first_text, is_shed_uri, or_default, output_tool_id, split_formats, step_tool_id

_LINKS = "array<struct<id:string>>"
INPUT_TYPES = ("data_input", "data_collection_input", "parameter_input")


def parse(docs: DataFrame, raw: str = "ga") -> DataFrame:
    """``docs`` with ``doc``, the parsed document, beside the raw one; ``doc`` is null where it is no object."""
    parsed = F.from_json(raw, schemas.workflow_doc, {"mode": "PERMISSIVE"})
    usable = F.get_json_object(raw, "$").startswith("{")
    return docs.withColumn("doc", F.when(usable, parsed))


def headers(parsed: DataFrame, key: str = "url") -> DataFrame:
    """One row per document with its defaults."""
    empty = F.array().cast("array<string>")
    names = ("uuid", "name", "version", "description")
    return parsed.filter("doc IS NOT NULL").select(
        key, *(or_default(F.col(f"doc.{n}"), "").alias(n) for n in names), or_default(F.col("doc.tags"), empty).alias("tags"),
        F.col("doc.`format-version`").alias("format_version"),
    )


def steps(parsed: DataFrame, key: str = "url") -> DataFrame:
    """One row per step in document order."""
    rows = parsed.select(key, F.posexplode("doc.steps").alias("pos", "step_id", "s"))
    return rows.select(key, "pos", "step_id", "s.*")


def edges(step_rows: DataFrame, key: str = "url") -> DataFrame:
    """One row per connection: the step it feeds and the step it comes from. A connection's value is one
    object or a list of them; entries without an id are left out."""
    one = step_rows.select(key, "pos", F.col("step_id").alias("dst"), "tool_id", "content_id", F.explode("input_connections").alias("input_name", "value"))
    links = F.when(
        F.ltrim("value").startswith("["), F.from_json("value", _LINKS)
    ).otherwise(F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), _LINKS))
    rows = one.select(key, "pos", "dst", "tool_id", "content_id", "input_name", F.explode(links).alias("l"))
    return rows.filter("l.id IS NOT NULL").select(key, "pos", "dst", "tool_id", "content_id", "input_name", F.col("l.id").alias("src"))


def tool_steps(step_rows: DataFrame, key: str = "url") -> DataFrame:
    """tool steps whose tool comes from a repository, in document order, repeats kept."""
    tool = step_tool_id(F.col("tool_id"), F.col("content_id")).alias("tool")
    rows = step_rows.filter(F.lower("type") == "tool").select(key, "pos", "step_id", tool)
    return rows.filter(F.col("tool").startswith("toolshed"))


def input_steps(step_rows: DataFrame, key: str = "url") -> DataFrame:
    """The steps by which data or parameters come in."""
    return step_rows.filter(F.col("type").isin(*INPUT_TYPES)).select(
        key, "pos", "step_id", or_default(F.col("name"), "").alias("name"), or_default(F.col("label"), "").alias("label"),
        F.col("type").alias("data_type"), or_default(F.col("optional"), False).alias("optional"),
    )


def tools_at_inputs(step_rows: DataFrame, key: str = "url") -> DataFrame:
    """The tools one connection behind an input step, one row per connection."""
    inputs = input_steps(step_rows, key).select(key, F.col("step_id").alias("src"))
    rows = edges(step_rows, key).join(inputs, [key, "src"], "left_semi")
    tool = step_tool_id(F.col("tool_id"), F.col("content_id")).alias("tool")
    return rows.select(key, "pos", "dst", "input_name", "src", tool).filter("tool IS NOT NULL")


def in_degrees(step_rows: DataFrame, key: str = "url") -> DataFrame:
    """How many connections refer to each step."""
    used = edges(step_rows, key).groupBy(key, F.col("src").alias("step_id")).agg(F.count("*").alias("n"))
    rows = step_rows.select(key, "step_id").join(used, [key, "step_id"], "left")
    return rows.select(key, "step_id", F.coalesce("n", F.lit(0)).alias("references"))


def terminal_steps(step_rows: DataFrame, key: str = "url") -> DataFrame:
    """The steps to which no connection refers, isolated ones too."""
    used = edges(step_rows, key).select(key, F.col("src").alias("step_id")).distinct()
    rows = step_rows.join(used, [key, "step_id"], "left_anti")
    return rows.select(
        key, "pos", "step_id", or_default(F.col("name"), "").alias("name"), or_default(F.col("label"), "").alias("label"),
        F.col("type").alias("data_type"), or_default(F.col("optional"), False).alias("optional"),
        output_tool_id(F.col("tool_id"), F.col("content_id")).alias("tool"),
    )


def first_seen(rows: DataFrame, key: str = "url") -> DataFrame:
    """A4: each tool once per workflow, in the order of its first appearance. ``rows``: key, pos, tool."""
    return rows.groupBy(key, "tool").agg(F.min("pos").alias("pos"))


def endpoint_tools(step_rows: DataFrame, key: str = "url") -> DataFrame:
    """The repository tools at both ends: key, side (``in`` or ``out``), tool, pos."""
    sides = [tools_at_inputs(step_rows, key), terminal_steps(step_rows, key)]
    found = [first_seen(s.filter(is_shed_uri(F.col("tool"))), key).withColumn("side", F.lit(n)) for s, n in zip(sides, ("in", "out"), strict=True)]
    return found[0].unionByName(found[1]).select(key, "side", "tool", "pos")


def defects(parsed: DataFrame, key: str = "url") -> DataFrame:
    """Steps on which a strict reader would give up the whole document: ``stage, key, reason``."""
    rows = steps(parsed, key)
    reason = F.when(F.col("type").isNull(), "step without type").when(
        (F.lower("type") == "tool") & first_text(F.col("tool_id"), F.col("content_id")).isNull(), "tool step without id"
    ).when(F.col("input_connections").isNull(), "step without connections")
    bad = parsed.filter("doc IS NULL").select(F.lit("workflow").alias("stage"), F.col(key).alias("key"), F.lit("not a document").alias("reason"))
    odd = rows.select(F.lit("workflow").alias("stage"), F.col(key).alias("key"), reason.alias("reason")).filter("reason IS NOT NULL")
    return bad.unionByName(odd.distinct())


def reject_defective(parsed: DataFrame, key: str = "url") -> DataFrame:
    """Strict mode: documents without defects only."""
    bad = defects(parsed, key).select(F.col("key").alias(key)).distinct()
    return parsed.join(bad, key, "left_anti")


def formats_of(tools: DataFrame, key: str, column: str) -> DataFrame:
    """A1: the sorted set of formats over all parameters of a workflow's tools. ``tools``: key and ``column``, an
    array of parameters."""
    rows = tools.select(key, F.explode(column).alias("p")).select(key, F.explode(split_formats(F.col("p.format"))).alias("format"))
    return rows.groupBy(key).agg(F.array_sort(F.collect_set("format")).alias("formats"))
