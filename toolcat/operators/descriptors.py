"""Application descriptors to registry records. Files are ``path, content``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolcat import schemas
from toolcat.functions.text import or_default, source_location


def parse(files: DataFrame) -> DataFrame:
    """``files`` with ``d``, the parsed descriptor; null where the content is no JSON object."""
    usable = F.try_parse_json("content").isNotNull() & F.ltrim("content").startswith("{")
    return files.withColumn("d", F.when(usable, F.from_json("content", schemas.descriptor)))


def errors(parsed: DataFrame) -> DataFrame:
    """Unreadable descriptors and those without name or version."""
    reason = F.when(F.col("d").isNull(), "not_json").when(F.col("d.name").isNull() | F.col("d.`tool-version`").isNull(), "missing_key")
    return parsed.select(F.lit("descriptor").alias("stage"), F.col("path").alias("key"), reason.alias("reason")).filter("reason IS NOT NULL")


def required(parsed: DataFrame) -> DataFrame:
    """F8: name and version are there; empty ones pass."""
    return parsed.filter("d.name IS NOT NULL AND d.`tool-version` IS NOT NULL")


def input_descriptions(inputs: Column) -> Column:
    """Lower-cased descriptions of the file inputs."""
    kept = F.filter(inputs, lambda x: x["type"] == "File")
    return F.coalesce(F.transform(kept, lambda x: F.lower(or_default(x["description"], ""))), F.array().cast("array<string>"))


def output_descriptions(outputs: Column) -> Column:
    """P10."""
    return F.coalesce(F.transform(outputs, lambda x: F.lower(or_default(x["description"], ""))), F.array().cast("array<string>"))


def to_registry_record(df: DataFrame, mapping: dict[str, Column], archetype: str, metadata_type: str, keep: tuple = ()) -> DataFrame:
    """P5: the 14 fields of a record, from ``mapping`` or by default."""
    text, none = F.lit(""), F.array().cast("array<string>")
    defaults = {
        "uri": text, "name": text, "description": text, "version": text, "archetype": F.lit(archetype),
        "input_file_formats": none, "output_file_formats": none, "input_file_descriptions": none,
        "output_file_descriptions": none, "location": text, "raw_metadata": F.lit("{}"), "metadata_schema": F.lit("{}"),
        "metadata_type": F.lit(metadata_type), "metadata_version": text,
    }
    return df.select(*keep, *(or_default(mapping[n], d).alias(n) if n in mapping else d.alias(n) for n, d in defaults.items()))


def records(parsed: DataFrame, owner: str, repo: str, branch: str) -> DataFrame:
    """One record per descriptor, with its path."""
    place = source_location(F.lit(owner), F.lit(repo), F.lit(branch), F.col("path"))
    return to_registry_record(required(parsed), {
        "uri": place, "location": place, "name": F.col("d.name"), "version": F.col("d.`tool-version`"),
        "description": F.col("d.description"), "raw_metadata": F.col("content"),
        "metadata_version": F.col("d.`schema-version`"), "input_file_descriptions": input_descriptions(F.col("d.inputs")),
        "output_file_descriptions": output_descriptions(F.col("d.`output-files`")),
    }, schemas.VIP_APP, schemas.DESCRIPTOR_METADATA, keep=("path",))


def latest(rows: DataFrame) -> DataFrame:
    """Of each name and version the record with the last path."""
    fields = [c for c in rows.columns if c not in ("name", "version")]
    best = rows.groupBy("name", "version").agg(F.max_by(F.struct(*fields), "path").alias("r"))
    return best.select("name", "version", "r.*")


def known_apps(rows: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records whose name is in the index, and the others."""
    names = index.select("name").distinct()
    return rows.join(names, "name", "left_semi"), rows.join(names, "name", "left_anti")
