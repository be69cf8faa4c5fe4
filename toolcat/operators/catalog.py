"""The registry table: inserts, updates, normalized tables. Tables are rewritten to new snapshots, never in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toolcat import schemas
from toolcat.functions.text import or_default, split_formats, tool_id


def workflow_records(headers: DataFrame, created_by: str) -> DataFrame:
    """Registry rows of workflows. ``headers``: url, name, version, description, tags, format_version, ga and the
    two format sets."""
    none = F.array().cast("array<string>")
    return headers.select(
        tool_id(F.col("url")).alias("id"), F.col("url").alias("uri"), "name", "description", "version",
        F.lit(schemas.GALAXY_WORKFLOW).alias("archetype"), or_default(F.col("input_formats"), none).alias("input_file_formats"),
        or_default(F.col("output_formats"), none).alias("output_file_formats"), F.col("url").alias("location"),
        F.col("ga").alias("raw_metadata"), F.lit("{}").alias("metadata_schema"),
        F.lit(schemas.WORKFLOW_METADATA).alias("metadata_type"), or_default(F.col("format_version"), "unknown").alias("metadata_version"),
        F.lit(created_by).alias("created_by"),
    )


def one_per_key(batch: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row for each ``key``: the first by ``order``, or the least."""
    fields = [c for c in batch.columns if c != key]
    packed = F.struct(*fields)
    pick = F.min(packed) if order is None else F.min_by(packed, order)
    return batch.groupBy(key).agg(pick.alias("_r")).select(key, "_r.*").select(*batch.columns)


def new_rows(batch: DataFrame, target: DataFrame, key: str = "uri", order: str | None = None) -> DataFrame:
    """The batch's rows, one per key, whose key the target doesn't have. Repeats in the target do no harm."""
    return one_per_key(batch, key, order).join(target.select(key), key, "left_anti").select(*batch.columns)


def insert_if_absent(batch: DataFrame, target: DataFrame, key: str = "uri", order: str | None = None) -> DataFrame:
    """K1, I4: the next snapshot; rows that exist stay as they are, and a second run adds nothing."""
    return target.unionByName(new_rows(batch, target, key, order), allowMissingColumns=True)


def patch(target: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """K5: the next snapshot, with the changes' non-null fields in the rows they name. ``changes``: a row per key."""
    t, c = target.alias("t"), changes.alias("c")
    changed = set(changes.columns) - {key}
    columns = [F.coalesce(f"c.{n}", f"t.{n}").alias(n) if n in changed else F.col(f"t.{n}") for n in target.columns]
    return t.join(c, F.col(f"t.{key}") == F.col(f"c.{key}"), "left").select(*columns)


def evolve(table: DataFrame, added) -> DataFrame:
    """K9: the table with further nullable columns."""
    return table.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in added if f.name not in table.columns))


def devolve(table: DataFrame, added) -> DataFrame:
    """K9 undone."""
    return table.drop(*(f.name for f in added))


def create_tables(spark: SparkSession, root: str) -> None:
    """K7: empty tables where there are none."""
    for name in ("tool_generic", "tool_harvest", "artifact", "contract", "implementation", "contract_input", "contract_output"):
        spark.createDataFrame([], getattr(schemas, name)).write.mode("ignore").parquet(f"{root.rstrip('/')}/{name}")


def save_snapshot(table: DataFrame, path: str) -> None:
    """K8: a dump; it fails rather than overwrite."""
    table.write.mode("error").parquet(path)


def load_snapshot(spark: SparkSession, path: str, schema=schemas.tool_generic) -> DataFrame:
    """K8: a restore; columns that an old dump lacks are null."""
    return spark.read.schema(schema).parquet(path)


def _key(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\u001f", *parts), 256)


def normalized(workflows: DataFrame, inputs: DataFrame, outputs: DataFrame) -> dict[str, DataFrame]:
    """Five tables. ``workflows``: url, name, version, description, ga, format_version; ``inputs`` and
    ``outputs``: url, params."""
    artifact_id, contract_id = _key(F.lit("artifact"), F.col("url")), _key(F.lit("contract"), F.col("url"))
    kind = F.when(F.col("p.tag") == "param", "parameter").when(F.col("p.tag") == "data", "data").otherwise("")
    label = or_default(F.col("p.label"), "").alias("description")
    formats = split_formats(F.col("p.format")).alias("encoding_formats")
    ins = inputs.select(contract_id.alias("contract_id"), F.explode("params").alias("p"))
    outs = outputs.select(contract_id.alias("contract_id"), F.explode("params").alias("p"))
    return {
        "artifact": workflows.select(
            artifact_id.alias("id"), "name", "version", F.lit(schemas.GALAXY_WORKFLOW).alias("archetype"),
            F.col("url").alias("location"), F.col("ga").alias("raw_metadata"),
            F.lit(schemas.WORKFLOW_METADATA).alias("metadata_type"), or_default(F.col("format_version"), "unknown").alias("metadata_version"),
        ),
        "contract": workflows.select(contract_id.alias("id"), "description", F.col("version").alias("contract_version")),
        "implementation": workflows.select(contract_id.alias("contract_id"), artifact_id.alias("artifact_id")),
        "contract_input": ins.select("contract_id", "p.name", F.lit("input").alias("role"), kind.alias("input_kind"), "p.type", label, formats),
        "contract_output": outs.select("contract_id", "p.name", "p.type", label, formats),
    }


def tool_tables(tools: DataFrame) -> dict[str, DataFrame]:
    """Tools with their own input and output tables, keyed by uri. ``tools``: uri, inputs, outputs, ..."""
    def ports(column: str) -> DataFrame:
        rows = tools.select("uri", F.posexplode(column).alias("pos", "p"))
        return rows.select("uri", "pos", "p.name", "p.type", "p.label", split_formats(F.col("p.format")).alias("formats"))

    return {"tool": tools.drop("inputs", "outputs"), "tool_input": ports("inputs"), "tool_output": ports("outputs")}
