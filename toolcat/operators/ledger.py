"""The harvest ledger: which repositories and folders were harvested, and with what result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolcat import schemas

DONE = (schemas.PROCESSED, schemas.COMPLETED)


def _new(rows: DataFrame, artifact_type: str, source_type: str, now: Column) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return rows.select(
        "url", F.lit(schemas.PENDING).alias("status"), nothing.alias("error_code"), F.lit(source_type).alias("source_type"),
        F.lit(artifact_type).alias("artifact_type"), nothing.alias("stored_id"), nothing.alias("stored_table"),
        now.alias("created_at"), now.alias("updated_at"),
    )


def seed(ledger: DataFrame, repositories: DataFrame, now: Column, source_type: str = "toolshed") -> DataFrame:
    """K3: the ledger with a pending row for each repository it doesn't have. ``repositories``: api_url."""
    urls = repositories.select(F.col("api_url").alias("url")).distinct().join(ledger.select("url"), "url", "left_anti")
    return ledger.unionByName(_new(urls, schemas.SHED_TOOL, source_type, now))


def pending(folders: DataFrame, ledger: DataFrame) -> DataFrame:
    """The folders that are still to be harvested. ``folders``: url."""
    done = ledger.filter(F.col("status").isin(*DONE)).select("url")
    return folders.select("url").distinct().join(done, "url", "left_anti")


def transition(ledger: DataFrame, outcomes: DataFrame, now: Column, source_type: str = "toolshed") -> DataFrame:
    """The next snapshot. ``outcomes``: a row per url with ``tools``, the number found, and
    ``error_code``. New urls enter as pending; done ones are skipped; tools make a url completed, an error makes it
    an error, neither leaves it as it is. ``updated_at`` moves only where something changes."""
    known = ledger.select("url")
    all_rows = ledger.unionByName(_new(outcomes.select("url").distinct().join(known, "url", "left_anti"), schemas.SHED_TOOL, source_type, now))
    l, o = all_rows.alias("l"), outcomes.select("url", "tools", F.col("error_code").alias("code")).alias("o")
    rows = l.join(o, F.col("l.url") == F.col("o.url"), "left").drop(F.col("o.url"))
    skip = F.col("status").isin(*DONE)
    status = F.when(skip, F.col("status")).when(F.col("code").isNotNull(), schemas.ERROR).when(F.col("tools") > 0, schemas.COMPLETED).otherwise(F.col("status"))
    code = F.when(skip | (F.col("code").isNull() & ~(F.coalesce("tools", F.lit(0)) > 0)), F.col("error_code")).otherwise(F.col("code"))
    changed = ~(status.eqNullSafe(F.col("status")) & code.eqNullSafe(F.col("error_code")))
    new = {"status": status, "error_code": code, "updated_at": F.when(changed, now).otherwise(F.col("updated_at"))}
    return rows.select(*(new[c].alias(c) if c in new else F.col(c) for c in ledger.columns))


def outcomes(files: DataFrame, errors: DataFrame) -> DataFrame:
    """Tool count and error code by url. ``files``: url, one row per tool; ``errors``: url, error_code."""
    counts = files.groupBy("url").agg(F.count("*").alias("tools"))
    codes = errors.groupBy("url").agg(F.max("error_code").alias("error_code"))
    return counts.join(codes, "url", "full").select("url", F.coalesce("tools", F.lit(0)).alias("tools"), "error_code")


def with_status(ledger: DataFrame, status: str, artifact_type: str | None = None) -> DataFrame:
    """F14."""
    rows = ledger.filter(F.col("status") == status)
    return rows if artifact_type is None else rows.filter(F.col("artifact_type") == artifact_type)


def retry_list(ledger: DataFrame) -> DataFrame:
    """I2."""
    return with_status(ledger, schemas.ERROR).select("url")


def statuses(ledger: DataFrame) -> DataFrame:
    """I3."""
    return ledger.select("url", "status")


def current(history: DataFrame, key: str = "url", order: tuple[str, ...] = ("updated_at",)) -> DataFrame:
    """The last row of each key in a history of ledger rows."""
    fields = [c for c in history.columns if c != key]
    best = history.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(*order)).alias("r"))
    return best.select(key, "r.*").select(*history.columns)
