"""The harvests from end to end, over landed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolcat.operators import catalog, descriptors, hub, ledger, repotree, resolve, workflow
from toolcat.scratch import written


def harvest_workflows(
    listing: DataFrame, archives: DataFrame, info: DataFrame, tools: DataFrame, target: DataFrame,
    kind: str = "galaxy", limit: int = 10, created_by: str = "harvester",
) -> tuple[DataFrame, DataFrame]:
    """Hub listing to the next registry snapshot, and the errors. ``listing`` with ``hub_pos``; ``archives``: url, ga,
    error; ``tools`` with ``repo_url``. All workflows' tools are resolved at once."""
    found, failed = hub.with_documents(hub.of_kind(listing, kind), archives)
    parsed = workflow.parse(found)
    bad = parsed.filter("doc IS NULL").select(F.lit("workflow").alias("stage"), F.col("url").alias("key"), F.lit("not a document").alias("reason"))
    taken = hub.first_successful(parsed.filter("doc IS NOT NULL"), limit)
    ends = workflow.endpoint_tools(workflow.steps(taken))
    attached, unknown = resolve.attach(ends, resolve.resolve(ends, info, tools))
    sides = {"in": "inputs", "out": "outputs"}
    formats = {s: workflow.formats_of(attached.filter(F.col("side") == s), "url", c) for s, c in sides.items()}
    rows = workflow.headers(taken).drop("description").join(taken.select("url", "description", "ga"), "url")
    rows = rows.join(formats["in"].withColumnRenamed("formats", "input_formats"), "url", "left")
    rows = rows.join(formats["out"].withColumnRenamed("formats", "output_formats"), "url", "left")
    missing = unknown.select(F.lit("resolve").alias("stage"), F.concat_ws(" ", "url", "tool").alias("key"), F.lit("unknown tool").alias("reason"))
    errors = failed.unionByName(bad).unionByName(missing)
    return catalog.insert_if_absent(catalog.workflow_records(rows, created_by), target), errors


def harvest_descriptors(files: DataFrame, index: DataFrame, owner: str, repo: str, branch: str) -> tuple[DataFrame, DataFrame]:
    """Descriptor files to registry records, and the errors."""
    parsed = descriptors.parse(files)
    known, unknown = descriptors.known_apps(descriptors.latest(descriptors.records(parsed, owner, repo, branch)), index)
    missing = unknown.select(F.lit("index").alias("stage"), F.col("path").alias("key"), F.lit("not in index").alias("reason"))
    return known.drop("path"), descriptors.errors(parsed).unionByName(missing)


def crawl_repositories(
    listing: DataFrame, tree: DataFrame, contents: DataFrame, state: DataFrame, now: Column, failures: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Repository listing and trees to tools, errors and the next ledger. ``contents``: place, name, content;
    ``failures``: ``url, error_code`` of folders that could not be fetched."""
    seeded = ledger.seed(state, repotree.unique_repositories(listing), now)
    folders = repotree.tool_folders(tree)
    todo = ledger.pending(folders.select(F.col("folder_url").alias("url")), seeded)
    due = written(folders.join(todo.withColumnRenamed("url", "folder_url"), "folder_url", "left_semi"), "due")
    files = repotree.crawl(tree).join(due.select(*repotree.REPO, F.col("folder").alias("dir"), "folder_url"), [*repotree.REPO, "dir"])
    if failures is not None:
        files = files.join(failures.select(F.col("url").alias("folder_url")), "folder_url", "left_anti")
    texts = files.join(contents.select(*repotree.REPO, "dir", "name", "content"), [*repotree.REPO, "dir", "name"])
    place = [*repotree.REPO, "dir", "path"]
    good, bad = resolve.tools(texts.select(*place, "content"), contents)
    good = written(good.join(files.select(*place, "folder_url"), place), "tools")  # parsed once, used below
    urls = due.select(F.col("folder_url").alias("url"))
    failed = urls.withColumn("error_code", F.lit(None).cast("string")).limit(0) if failures is None else failures.join(urls, "url", "left_semi")
    found = written(ledger.outcomes(good.select(F.col("folder_url").alias("url")), failed), "outcomes")
    idle = urls.join(found.select("url"), "url", "left_anti")
    found = found.unionByName(idle.select("url", F.lit(0).cast("bigint").alias("tools"), F.lit(None).cast("string").alias("error_code")))
    return {"tools": good, "errors": bad, "ledger": ledger.transition(seeded, found, now)}
