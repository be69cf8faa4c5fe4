"""The harvests as queries over the supplied tables (by way of ``repository_lifts``), and the same answers in SQL."""

from __future__ import annotations

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import functions as F

from toolcat import schemas
from toolcat.functions.text import is_shed_uri, shed_uri_parts, strip_http, tool_id, tool_uri
from toolcat.operators import catalog, hub, ledger, publish, repair, repotree, resolve, toolio, versions, workflow
from toolcat.plans import lifts, pipelines
from toolcat.plans import repository_lifts as repos
from toolcat.scratch import new_path, written
from toolcat.sources import landing
from toolcat.streaming import ledger_state


def _tools(spark, sf):
    files = written(repos.contents(spark, sf), "contents")
    found, bad = resolve.tools(files.filter("name = 't.xml'").select("repo_owner", "repo", "dir", "path", "content"), files.drop("path"))
    return found, bad


def macro_tools(spark, sf):
    rows = _tools(spark, sf)[0]
    return rows.select(
        "id", "version", F.array_join(resolve.tool_formats(F.col("inputs")), "|").alias("formats"), F.col("outputs")[0]["format"].alias("out_format"),
        "description", "owner", F.array_join("categories", "|").alias("categories"),
    )


def token_expansions(spark, sf):
    files = written(repos.token_files(spark, sf), "contents")
    rows = resolve.tools(files.filter("name = 't.xml'").select("repo_owner", "repo", "dir", "path", "content"), files.drop("path"))[0]
    return rows.select("id", "version", "description", "help", F.coalesce("note", F.lit("")).alias("note"))


def rejected_tools(spark, sf):
    files = repos.contents(spark, sf).filter("name = 't.xml'")
    k = F.regexp_extract("dir", r"d(\d+)$", 1).cast("long")
    broken = F.when(k % 5 == 0, F.substring("content", 1, 40)).when(k % 3 == 0, F.concat(F.lit("<macros>"), "content", F.lit("</macros>"))).otherwise(F.col("content"))
    files = files.select("repo_owner", "repo", "dir", "path", broken.alias("content"))
    return resolve.tools(files, files.select("repo_owner", "repo", "dir", F.lit("t.xml").alias("name"), "content"))[1].select("stage", "key", "reason")


def tool_ids(spark, sf):
    return lifts.hub(spark, sf).select("url", tool_id(F.col("url")).alias("id"))


def _resolved(spark, sf):
    steps = workflow.steps(workflow.parse(repos.part_workflows(spark, sf)))
    ends = workflow.endpoint_tools(steps)
    tools = _tools(spark, sf)[0].withColumn("repo_url", F.concat(F.lit("https://github.com/o/"), "repo"))
    return ends, resolve.resolve(ends, repos.install_info(spark, sf), written(tools, "tools"))


def resolved_tools(spark, sf):
    _, found = _resolved(spark, sf)
    return found.select("tool", "name", "repo_url", "dir", "version", "version_mismatch")


def unresolved_tools(spark, sf):
    return resolve.attach(*_resolved(spark, sf))[1].select(F.col("url").cast("string").alias("url"), "side", "tool")


def workflow_tool_parameters(spark, sf):
    found, _ = resolve.attach(*_resolved(spark, sf))
    rows = resolve.workflow_parameters(found.filter("side = 'out'"), "inputs")
    return rows.select(F.col("url").cast("string").alias("url"), F.array_join(F.transform("inputs", lambda p: p["name"]), "|").alias("names"))


def rival_tools(spark, sf):
    """Tools at both ends where several files claim one id and steps carry two ids."""
    ends = workflow.endpoint_tools(workflow.steps(workflow.parse(repos.rival_workflows(spark, sf))))
    found = resolve.resolve(ends, repos.install_info(spark, sf), repos.rival_tools(spark, sf))
    return resolve.attach(ends, found)[0].select("url", "side", "name", "dir", "path", "version")


def strict_workflows(spark, sf):
    parsed = workflow.parse(repos.rival_workflows(spark, sf))
    kept = workflow.reject_defective(parsed).select(F.lit("kept").alias("stage"), F.col("url").alias("key"), F.lit("").alias("reason"))
    return kept.unionByName(workflow.defects(parsed))


def tool_uri_parts(spark, sf):
    tools = workflow.tool_steps(workflow.steps(workflow.parse(repos.part_workflows(spark, sf))))
    u = shed_uri_parts(F.col("tool"))
    rows = tools.filter(is_shed_uri(F.col("tool"))).select(
        "tool", u["host"].alias("host"), u["owner"].alias("owner"), u["repo"].alias("repo"), u["name"].alias("name"), u["revision"].alias("revision")
    )
    again = tool_uri(F.col("name"), F.col("owner"), F.col("repo"), F.col("revision"), "h")
    return rows.distinct().select("tool", "owner", "repo", "name", "revision", again.alias("short"))


def tool_version_lookup(spark, sf):
    uris = workflow.tool_steps(workflow.steps(workflow.parse(repos.part_workflows(spark, sf)))).select(F.concat(F.lit("https://"), "tool").alias("tool"))
    known = lifts.read(spark, sf, "part").select(
        F.lit("o").alias("owner"), F.concat(F.lit("r"), (F.col("p_partkey") % repos.REPOS).cast("string")).alias("repo"),
        F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("name"), F.lit("9.9").alias("revision"), F.col("p_name").alias("body"),
    )
    path = repos.landed_json(known, "versions", F.pmod(F.xxhash64("name"), F.lit(4)))
    return resolve.tool_versions(uris, landing.tool_versions(spark, path)).select(strip_http(F.col("tool")).alias("tool"), "body")


def _harvest(spark, sf):
    listing = repos.conversation_hub(spark, sf)
    docs = repos.part_workflows(spark, sf)
    n, none = F.col("url").cast("long"), F.lit(None).cast("string")
    archives = docs.select("url", F.when(n % 5 != 0, F.when(n % 7 == 0, "[]").otherwise(F.col("ga"))).alias("ga"), F.when(n % 5 == 0, "BadZipFile").otherwise(none).alias("error"))
    tools = written(_tools(spark, sf)[0].withColumn("repo_url", F.concat(F.lit("https://github.com/o/"), "repo")), "tools")
    target = written(docs.filter(n % 4 == 0).select(F.col("url").alias("uri"), F.lit("old").alias("name")), "target")
    return pipelines.harvest_workflows(listing, archives, repos.install_info(spark, sf), tools, target, limit=60)


def harvested_workflows(spark, sf):
    rows, _ = _harvest(spark, sf)
    return rows.select(
        F.col("uri").cast("string").alias("uri"), "name", F.coalesce("archetype", F.lit("-")).alias("archetype"), F.coalesce("description", F.lit("-")).alias("description"),
        F.coalesce(F.array_join("input_file_formats", "|"), F.lit("-")).alias("inputs"), F.coalesce(F.array_join("output_file_formats", "|"), F.lit("-")).alias("outputs"),
        F.coalesce(F.get_json_object("raw_metadata", "$.uuid"), F.lit("-")).alias("raw"),
    )


def harvest_failures(spark, sf):
    return _harvest(spark, sf)[1].filter("stage <> 'resolve'").select("stage", "key", "reason")


def archived_workflows(spark, sf):
    found = landing.first_workflows(repos.archives(spark, sf))
    parsed = workflow.headers(workflow.parse(found.select(F.col("path").alias("url"), "ga")))
    rows = found.join(parsed, F.col("path") == F.col("url"), "left")
    return rows.select("path", F.coalesce(F.col("position").cast("long"), F.lit(-1)).alias("position"), "entry", "name", F.md5(F.col("ga").cast("binary")).alias("raw_md5"), F.col("error").isNotNull().alias("failed"))


def landed_hub(spark, sf):
    entries = lifts.hub(spark, sf).select("url", "description", "versions")
    listing = landing.hub_listing(spark, repos.landed_json(entries, "hub", F.pmod(F.xxhash64("url"), F.lit(7))))
    kept = landing.snapshot(hub.of_kind(listing, "5-LOW").select("url", "description"), new_path(spark, "listing"), "json")
    return kept.select("url", "description", hub.download_url(F.col("url")).alias("download"))


def landed_repositories(spark, sf):
    rows = lifts.git_urls(spark, sf).select("name", "remote_repository_url")
    return repotree.unique_repositories(landing.repositories(spark, repos.landed_json(rows, "repositories", F.pmod(F.xxhash64("name"), F.lit(5)))))


def landed_install_info(spark, sf):
    rows = landing.install_info(spark, repos.landed_json(repos.install_info(spark, sf), "info", F.col("revision")))
    return rows.select("owner", "repo", "revision", F.col("info")[0]["remote_repository_url"].alias("url"))


def landed_tree(spark, sf):
    rows = repos.tree(spark, sf).groupBy("repo_owner", "repo", "branch").agg(F.collect_list(F.struct("path", "type")).alias("tree"))
    listed = landing.directory_listing(landing.repo_tree(spark, repos.landed_json(rows, "trees", F.col("repo"))))
    return listed.groupBy("repo", "name").agg(F.count("*").alias("n"), F.count_distinct("dir").alias("dirs"))


def landed_descriptors(spark, sf):
    rows = lifts.read(spark, sf, "supplier").select((F.col("s_suppkey") % 50).alias("app"), F.col("s_name").alias("name"), F.lit("1").alias("tool-version"))
    one, root = rows.groupBy("app").agg(F.max("name").alias("name"), F.max("tool-version").alias("tool-version")), new_path(spark, "descriptors")
    one.write.partitionBy("app").json(root)
    files = landing.descriptor_files(spark, root)
    return files.select(F.regexp_extract("path", r"^app=(\d+)/", 1).cast("long").alias("app"), F.get_json_object("content", "$.name").alias("name"))


def landed_app_index(spark, sf):
    names = lifts.read(spark, sf, "nation").select(F.col("n_name").alias("name"))
    rows = landing.app_index(spark, repos.landed_json(names, "index", F.lit(0)))
    parts = lifts.read(spark, sf, "supplier").join(lifts.read(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return parts.join(rows.filter("name < 'NATION_2'"), F.col("n_name") == F.col("name"), "left_semi").select("s_suppkey", "n_name")


def landed_texts(spark, sf):
    root = new_path(spark, "texts")
    rows = repos.contents(spark, sf).filter("name = '.shed.yml'").groupBy("repo").agg(F.max_by("content", "path").alias("value"))
    rows.write.partitionBy("repo").text(root)
    files = landing.text_files(spark, f"{root}/*/*.txt", root)
    return files.select(F.substring_index("dir", "=", -1).alias("repo"), F.md5(F.rtrim("content", F.lit("\n")).cast("binary")).alias("content_md5"))


def landed_tool_io(spark, sf):
    rows = landing.tool_io(spark, repos.landed_json(repos.tool_io(spark, sf), "io", F.pmod(F.xxhash64("tool_id"), F.lit(3))))
    found = toolio.data_inputs(rows)
    return found.select("tool_id", "name", "type", F.array_join("extensions", "|").alias("extensions"), F.size("place").cast("long").alias("depth"))


def tool_io_outputs(spark, sf):
    rows = toolio.outputs(repos.tool_io(spark, sf))
    return rows.select("tool_id", F.col("pos").cast("long").alias("pos"), "name", "type", "format", "hidden")


def crawl_many(spark, sf):
    return repotree.crawl(repos.tree(spark, sf)).select("repo", "path")


def crawl_many_smart(spark, sf):
    return repotree.smart_crawl(repos.tree(spark, sf)).select("repo", "path")


def tool_folders_below(spark, sf):
    return repotree.tool_folders(repos.tree(spark, sf), "/lib/").select("repo", "folder")


def crawl_many_counts(spark, sf):
    return repotree.tool_counts(repotree.crawl(repos.tree(spark, sf)))


def _crawl(spark, sf):
    files = repos.contents(spark, sf)
    tree = files.select("repo_owner", "repo", F.lit("main").alias("branch"), "path", F.lit("blob").alias("type"))
    listing = files.select(F.col("repo").alias("name"), F.concat(F.lit("https://github.com/o/"), "repo").alias("remote_repository_url")).distinct()
    urls = repotree.tool_folders(tree).select(F.col("folder_url").alias("url"))
    n = F.regexp_extract("url", r"lib/d(\d+)", 1).cast("long")
    now = F.lit("2030-01-01").cast("timestamp")
    state = ledger.seed(spark.createDataFrame([], schemas.tool_harvest), urls.filter(n % 9 == 0).select(F.col("url").alias("api_url")), now)
    done = state.withColumn("status", F.when(n % 2 == 0, schemas.COMPLETED).otherwise(F.col("status")))
    failures = urls.filter(n % 11 == 0).select("url", F.lit("404").alias("error_code"))
    return pipelines.crawl_repositories(listing, tree, files.drop("path"), written(done, "ledger"), now, written(failures, "failures"))


def crawled_ledger(spark, sf):
    rows = _crawl(spark, sf)["ledger"]
    return rows.select("url", "status", F.coalesce("error_code", F.lit("")).alias("code"), "source_type", "artifact_type")


def crawled_tools(spark, sf):
    return _crawl(spark, sf)["tools"].select("repo", "id", "version")


def stored_ledger_pending(spark, sf):
    path = new_path(spark, "tool_harvest")
    lifts.ledger_history(spark, sf).select(*schemas.tool_harvest.names).write.parquet(path)
    rows = ledger.with_status(landing.ledger(spark, path), schemas.PENDING, schemas.SHED_TOOL)
    return rows.groupBy("url").agg(F.count("*").alias("n"))


def streamed_ledger(spark, sf):
    """The ledger as keyed state: an outcome per event, landed and taken in three parts by time."""
    seen = lifts.read(spark, sf, "events").filter("user_id IS NOT NULL AND ts IS NOT NULL").select(
        F.col("user_id").cast("string").alias("url"), (F.col("event_type") == "purchase").cast("long").alias("tools"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("e"), (F.col("event_id") % 3).cast("string"))).alias("error_code"),
        F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("seq"),
    )
    root, days = new_path(spark, "outcomes"), F.dayofmonth("at")
    for i, part in enumerate((days <= 10, (days > 10) & (days <= 20), days > 20)):
        seen.filter(part).write.parquet(f"{root}/landed/{i}")
        stream = spark.readStream.schema(seen.schema).parquet(f"{root}/landed/*")
        ledger_state.run(stream, f"{root}/changes", f"{root}/checkpoint")
    rows = ledger_state.latest(spark.read.schema(ledger_state.changes).parquet(f"{root}/changes"))
    return rows.select("url", "status", F.coalesce("error_code", F.lit("")).alias("code"), *(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("created_at", "updated_at")))


def stored_registry(spark, sf):
    root = new_path(spark, "registry")
    catalog.create_tables(spark, root)
    empty = landing.registry(spark, f"{root}/tool_generic")
    batch = _registry(spark, sf).select("id", "uri", "name", "archetype")
    full = catalog.insert_if_absent(batch, catalog.devolve(empty, schemas.migrations[1]))
    catalog.save_snapshot(full, f"{root}/dump")
    rows = catalog.load_snapshot(spark, f"{root}/dump").filter(F.col("archetype") == schemas.VIP_APP)
    return rows.select("id", "uri", "name", F.col("license").isNull().alias("no_license"))


def _registry(spark, sf):
    """A row per document whose uri, for each third, holds a line feed."""
    key = F.col("doc_id").cast("string")
    return lifts.read(spark, sf, "documents").select(
        key.alias("id"), F.concat(F.lit("app/"), F.when(F.col("doc_id") % 3 == 0, F.lit("\n")).otherwise(""), key).alias("uri"), F.lit("there").alias("location"),
        F.col("source").alias("name"), F.when(F.col("doc_id") % 2 == 0, schemas.VIP_APP).otherwise(schemas.SHED_TOOL).alias("archetype"),
    )


def registry_without_newlines(spark, sf):
    rows = _registry(spark, sf)
    return catalog.patch(rows, repair.uri_patches(rows)).select("id", F.replace("uri", F.lit("\n"), F.lit("|")).alias("uri"), F.replace("location", F.lit("\n"), F.lit("|")).alias("location"))


def repaired_versions(spark, sf):
    key = F.col("p_partkey")
    stored = lifts.read(spark, sf, "part").select(key.cast("string").alias("id"), F.when(key % 4 == 0, "@TOOL_VERSION@").otherwise(F.col("p_size").cast("string")).alias("version"))
    parsed = lifts.read(spark, sf, "part").filter(key % 3 != 0).select(key.cast("string").alias("id"), F.when(key % 5 == 0, "VERSION").otherwise(F.concat(F.lit("v"), F.col("p_size").cast("string"))).alias("version"))
    return repair.repaired_versions(stored, parsed).select("id", "version", F.col("version").contains("VERSION").alias("left"))


def converter_differences(spark, sf):
    from toolcat.functions.text import git_url_to_api

    plain = lambda u: F.when(u.startswith("https://github.com/"), F.concat(F.lit("https://api.github.com/repos/"), F.substring(u, 20, 9999), F.lit("/contents")))
    urls = lifts.git_urls(spark, sf).select(F.col("remote_repository_url").alias("url")).distinct()
    return repair.converter_differences(urls, git_url_to_api, plain).select("url", F.coalesce("a", F.lit("")).alias("a"), F.coalesce("b", F.lit("")).alias("b"))


def repointed_ledger(spark, sf):
    state = ledger.current(lifts.ledger_history(spark, sf), order=("updated_at", "event_id")).drop("event_id")
    n = F.col("url").cast("long")
    fixed = state.filter(n % 2 == 0).select("url", F.concat(F.lit("new/"), "url").alias("new"))
    now = F.lit("2030-01-01").cast("timestamp")
    return repair.repointed(state, fixed, now).select("url", "status", (F.col("updated_at") == now).alias("moved"))


def backfilled_tools(spark, sf):
    key = F.col("p_partkey")
    none = F.array().cast("array<string>")
    rows = lifts.read(spark, sf, "part")
    tools = rows.select(key.cast("string").alias("folder_url"), F.when(key % 2 == 0, "").otherwise("has").alias("description"), F.when(key % 3 == 0, "me").otherwise("").alias("owner"), none.alias("categories"))
    sides = rows.filter(key % 5 != 0).select(
        key.cast("string").alias("folder_url"), F.col("p_brand").alias("owner"), F.lit("short").alias("description"),
        F.when(key % 4 == 0, "").otherwise(F.col("p_type")).alias("long_description"), F.array(F.concat(F.lit(" "), "p_brand"), F.lit(" ")).alias("categories"),
    )
    return repair.backfilled(tools, sides).select("folder_url", "description", "owner", F.array_join("categories", "|").alias("categories"))


def published_without_token(spark, sf):
    records = _registry(spark, sf).filter(F.col("archetype") == schemas.VIP_APP)
    sent, failed = publish.publish(records, "http://registry.invalid/tools", None)
    return failed.select("key", F.col("status").cast("long").alias("status")).unionByName(sent.select("key", F.col("status").cast("long").alias("status")))


class _Answers(BaseHTTPRequestHandler):
    """A registry that knows uris which end in 1 already, fails for those in 2 and takes all others."""

    def do_POST(self):
        uri = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["uri"]
        body = f"got {uri[-1]}".encode()
        self.send_response({"1": 409, "2": 500}.get(uri[-1], 201))
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *_):
        pass


def published_records(spark, sf):
    server = ThreadingHTTPServer(("", 0), _Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://{spark.conf.get('spark.driver.host')}:{server.server_port}/tools"
    try:  # the answers are written when this returns
        sent, failed = publish.publish_batches(_registry(spark, sf), url, "token", new_path(spark, "answers"))
    finally:
        server.shutdown()
        server.server_close()
    rows = sent.withColumn("side", F.lit("sent")).unionByName(failed.withColumn("side", F.lit("failed")))
    return rows.select("key", "side", F.col("status").cast("long").alias("status"), F.coalesce("response", "error").alias("answer"))


def registry_versions(spark, sf):
    rows = lifts.registry_batches(spark, sf)
    store = versions.Versions(spark, new_path(spark, "store"), rows.schema)
    for b in range(3):
        store.update(lambda target, b=b: catalog.insert_if_absent(rows.filter(F.col("batch") == b), target, order="id"))
    second = store.read(2).agg(F.sum("id").alias("ids"), F.count("*").alias("rows")).select(F.lit(-2).cast("long").alias("version"), "rows", "ids")
    return store.history().withColumn("ids", F.lit(0).cast("long")).unionByName(second)


def early_stopped_workflows(spark, sf):
    raw = repos.archives(spark, sf)
    listing = lifts.read(spark, sf, "orders").select(F.col("o_orderkey").alias("hub_pos"), F.concat(F.col("o_orderkey").cast("string"), F.lit(".zip")).alias("path"))

    def attempt(entries):
        opened = landing.first_workflows(raw.join(entries.select("path"), "path", "left_semi")).join(entries, "path")
        return opened.filter("ga IS NOT NULL").select("hub_pos", "path", "entry"), opened.filter("ga IS NULL").select("hub_pos", "path", "error")

    good, bad = hub.take_successful(listing, 25, attempt)
    return good.select("hub_pos", "path", "entry").unionByName(bad.select("hub_pos", "path", F.lit("failed").alias("entry")))


def _five_tables(spark, sf):
    tools = written(_tools(spark, sf)[0], "tools")
    rows = tools.select(F.col("id").alias("url"), F.col("tool_name").alias("name"), "version", "description", F.lit("{}").alias("ga"), F.lit(None).cast("string").alias("format_version"), "inputs", "outputs")
    return catalog.normalized(rows, rows.select("url", F.col("inputs").alias("params")), rows.select("url", F.col("outputs").alias("params")))


def normalized_artifacts(spark, sf):
    t = _five_tables(spark, sf)
    both = t["artifact"].join(t["implementation"], F.col("id") == F.col("artifact_id")).join(t["contract"].withColumnRenamed("id", "contract_id"), "contract_id")
    return both.select("location", "name", "version", "metadata_version", "contract_version", "description")


def normalized_outputs(spark, sf):
    t = _five_tables(spark, sf)
    rows = t["contract_output"].join(t["implementation"], "contract_id").join(t["artifact"].select(F.col("id").alias("artifact_id"), "location"), "artifact_id")
    return rows.select("location", "name", "type", "description", F.array_join("encoding_formats", "|").alias("formats"))


def tool_tables_outputs(spark, sf):
    t = catalog.tool_tables(written(_tools(spark, sf)[0].withColumn("uri", F.col("id")), "tools"))
    rows = t["tool_output"].join(t["tool"].select("uri", "tool_name"), "uri")
    return rows.select("uri", "tool_name", F.col("pos").cast("long").alias("pos"), "name", "label", F.array_join("formats", "|").alias("formats"))


def queries() -> dict:
    return {f.__name__: f for f in (
        macro_tools, token_expansions, rejected_tools, rival_tools, strict_workflows, streamed_ledger, tool_ids, resolved_tools, unresolved_tools, workflow_tool_parameters, tool_uri_parts, tool_version_lookup, harvested_workflows,
        harvest_failures, archived_workflows, landed_hub, landed_repositories, landed_install_info, landed_tree, landed_descriptors, landed_app_index,
        landed_texts, landed_tool_io, tool_io_outputs, crawl_many, crawl_many_smart, tool_folders_below, crawl_many_counts, crawled_ledger,
        crawled_tools, stored_ledger_pending, stored_registry, registry_without_newlines, repaired_versions, converter_differences,
        repointed_ledger, backfilled_tools, published_without_token, published_records, registry_versions, early_stopped_workflows, normalized_artifacts, normalized_outputs, tool_tables_outputs,
    )}


# The tools of the repositories, straight from the parts.
_TOOLS = """
    t AS (SELECT p_partkey AS k, p_partkey % 20 AS r, p_name, string_split(p_name, ' ') AS w, lower(replace(p_brand, '#', '')) AS brand,
          CASE WHEN p_partkey % 3 = 0 THEN '1.' ELSE '2.' END || p_size AS version,
          CASE WHEN p_partkey % 7 = 0 THEN lower(replace(p_brand, '#', '')) WHEN p_partkey % 5 = 0 THEN 'shared' || (p_partkey % 20)
               WHEN p_partkey % 2 = 0 THEN 'x' || string_split(p_name, ' ')[2] ELSE lower(replace(p_brand, '#', '')) END AS f,
          CASE WHEN p_partkey % 4 = 1 THEN 'own' WHEN p_partkey % 4 = 0 THEN '' ELSE 'short' END AS description FROM part)
"""
# A part's own workflow steps: ends, tools and what they resolve to.
_ENDS = """
    s AS (SELECT conv_id AS c, turn, min(role) AS role FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
    p AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn) - 1 AS pos, (c * 7919 + turn) % (SELECT max(p_partkey) + 60 FROM part) + 1 AS k FROM s),
    u AS (SELECT *, CASE WHEN role NOT IN ('system', 'user') THEN 'toolshed.example.org/repos/o/r' || (k % 20) || '/t' || k || '/' ||
          CASE WHEN turn % 4 = 1 THEN '9.9' WHEN k % 3 = 0 THEN '1.0' ELSE '2.0' END END AS tool FROM p),
    e AS (SELECT c, turn AS dst, turn - 1 AS src FROM s WHERE turn > 0 AND turn % 4 <> 3
          UNION ALL SELECT c, turn, turn - 2 FROM s WHERE turn > 1 AND turn % 2 = 0),
    ends AS (SELECT u.c, 'in' AS side, u.tool, u.k, u.turn, min(u.pos) AS pos FROM u JOIN e ON e.c = u.c AND e.dst = u.turn
             JOIN s i ON i.c = e.c AND i.turn = e.src AND i.role IN ('system', 'user') WHERE u.tool IS NOT NULL GROUP BY ALL
             UNION ALL SELECT u.c, 'out', u.tool, u.k, u.turn, min(u.pos) FROM u WHERE u.tool IS NOT NULL
             AND NOT EXISTS (SELECT 1 FROM e WHERE e.c = u.c AND e.src = u.turn) GROUP BY ALL),
    known AS (SELECT ends.*, t.w, t.f, t.brand, t.version FROM ends JOIN t ON t.k = ends.k AND t.r <> 13)
"""
_DIR = "CASE WHEN p_partkey % 7 = 0 THEN 'old/depricated/' ELSE '' END || CASE WHEN p_partkey % 2 = 0 THEN 'lib/d' ELSE 'tools/d' END || p_partkey"
_LEDGER = """
    l AS (SELECT CAST(user_id AS VARCHAR) AS url, arg_max(event_type, (ts, event_id)) AS kind FROM events GROUP BY user_id),
    c AS (SELECT url, CASE kind WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'completed' WHEN 'signup' THEN 'processed' ELSE 'pending' END AS status FROM l)
"""
_URI = "'app/' || CASE WHEN doc_id % 3 = 0 THEN chr(10) ELSE '' END || doc_id"


def oracle_sql() -> dict[str, str]:
    git = """
        u AS (SELECT DISTINCT page_id % 8 AS k, page_id % 50 AS n FROM pages),
        v AS (SELECT *, CASE k WHEN 6 THEN 'https://example.org/o/r' || n WHEN 7 THEN '' WHEN 0 THEN 'https://github.com/o/r' || n
                     WHEN 1 THEN 'https://github.com/o/r' || n || '.git' WHEN 2 THEN 'https://github.com/o/r' || n || '/tree/main'
                     WHEN 3 THEN 'https://github.com/o/r' || n || '/tree/dev/tools' WHEN 4 THEN 'https://github.com/o/r' || n || '/tree'
                     ELSE 'https://github.com/o/r' || n || '/blob/main' END AS url FROM u),
        x AS (SELECT url, CASE WHEN k IN (0, 1, 2) THEN 'https://api.github.com/repos/o/r' || n || '/contents'
                     WHEN k = 3 THEN 'https://api.github.com/repos/o/r' || n || '/contents/tools?ref=dev' ELSE '' END AS a,
                     CASE WHEN k < 6 THEN 'https://api.github.com/repos/' || substr(url, 20) || '/contents' ELSE '' END AS b FROM v)
    """
    taken = """
        h AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
        got AS (SELECT c FROM h WHERE c % 3 <> 0 AND c % 5 <> 0 AND c % 7 <> 0 ORDER BY c LIMIT 60),
        fi AS (SELECT DISTINCT c, unnest([f, w[2]]) AS x FROM known WHERE side = 'in'),
        fo AS (SELECT DISTINCT c, f AS x FROM known WHERE side = 'out')
    """
    return {
        "macro_tools": f"WITH {_TOOLS} SELECT 't' || k AS id, version, array_to_string(list_sort(list_distinct([f, w[2]])), '|') AS formats, f AS out_format, "
        "CASE WHEN k % 4 = 1 THEN 'own' WHEN k % 4 = 0 THEN '' ELSE 'short' END AS description, CASE WHEN k % 4 = 0 THEN '' ELSE 'own' || k END AS owner, "
        "CASE WHEN k % 4 = 0 THEN '' ELSE 'a' || r || '|bb' END AS categories FROM t",
        "token_expansions": "SELECT 't' || p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN 'eER@' ELSE CAST(p_size AS VARCHAR) END AS version, "
        "CASE WHEN p_partkey % 7 = 0 THEN 'late-a' ELSE lower(replace(p_brand, '#', '')) || 'b-a' END AS description, "
        "CASE WHEN p_partkey % 5 < 2 THEN '@P@' ELSE 'p' END AS help, CASE WHEN p_partkey % 5 = 0 THEN 'token_cycle' ELSE '' END AS note FROM part",
        "rejected_tools": "SELECT 'tool' AS stage, 'lib/d' || p_partkey || '/t.xml' AS key, CASE WHEN p_partkey % 5 = 0 THEN 'not_xml' ELSE 'not_a_tool' END AS reason "
        "FROM part WHERE p_partkey % 5 = 0 OR p_partkey % 3 = 0",
        "rival_tools": """WITH f AS (SELECT p_partkey % 100 AS x, 'lib/d' || p_partkey AS dir, 'lib/d' || p_partkey || '/t.xml' AS path, 't' || p_size AS version FROM part
                UNION ALL SELECT p_partkey % 100, 'lib/d' || p_partkey, 'lib/d' || p_partkey || '/b.xml', 'b' || p_size FROM part WHERE p_partkey % 2 = 0),
            b AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY x ORDER BY dir, path) = 1),
            e AS (SELECT o_orderkey AS k, 'in' AS side, CASE WHEN o_orderkey % 4 < 2 THEN 0 ELSE 1 END AS d FROM orders WHERE o_orderkey % 4 <> 3
                  UNION ALL SELECT o_orderkey, 'out', CASE WHEN o_orderkey % 4 = 1 THEN 0 ELSE 1 END FROM orders)
            SELECT CAST(k AS VARCHAR) AS url, side, 't' || x AS name, dir, path, version FROM e JOIN b ON x = (k + d) % 100 WHERE x % 20 <> 13""",
        "strict_workflows": """SELECT 'kept' AS stage, CAST(o_orderkey AS VARCHAR) AS key, '' AS reason FROM orders WHERE o_orderkey % 6 <> 0 AND o_orderkey % 10 <> 0
            UNION ALL SELECT 'workflow', CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey % 10 = 0 THEN 'step without type' ELSE 'step without connections' END
            FROM orders WHERE o_orderkey % 6 = 0 OR o_orderkey % 10 = 0""",
        "streamed_ledger": """WITH o AS (SELECT user_id AS u, ts, event_id AS i, event_type = 'purchase' AS p, CASE WHEN event_type = 'error' THEN 'e' || (event_id % 3) END AS code
                       FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
            d AS (SELECT u, min((ts, i)) AS at, arg_min(ts, (ts, i)) AS ts FROM o WHERE p GROUP BY u),
            e AS (SELECT o.u, o.ts, o.i, code, lag(code) OVER (PARTITION BY o.u ORDER BY o.ts, o.i) AS b FROM o WHERE code IS NOT NULL),
            c AS (SELECT u, arg_max(code, (ts, i)) AS code, arg_max(ts, (ts, i)) AS ts FROM e WHERE b IS NULL OR b <> code GROUP BY u),
            f AS (SELECT u, min(ts) AS ts FROM o GROUP BY u)
            SELECT CAST(f.u AS VARCHAR) AS url, CASE WHEN d.u IS NOT NULL THEN 'completed' WHEN c.u IS NOT NULL THEN 'error' ELSE 'pending' END AS status,
                   CASE WHEN d.u IS NULL THEN coalesce(c.code, '') ELSE '' END AS code, strftime(f.ts, '%Y-%m-%d %H:%M:%S') AS created_at,
                   strftime(CASE WHEN d.u IS NOT NULL THEN d.ts ELSE coalesce(c.ts, f.ts) END, '%Y-%m-%d %H:%M:%S') AS updated_at
            FROM f LEFT JOIN d ON d.u = f.u LEFT JOIN c ON c.u = f.u""",
        "tool_ids": "SELECT url, 'edc:tool:' || right(lpad(lower(to_base(CAST('0x' || substr(sha256(url), 1, 15) AS BIGINT), 36)), 12, '0'), 9) AS id "
        "FROM (SELECT 'https://hub.example.org/' || o_orderkey AS url FROM orders)",
        "resolved_tools": f"WITH {_TOOLS}, {_ENDS} SELECT DISTINCT tool, 't' || k AS name, 'https://github.com/o/r' || (k % 20) AS repo_url, 'lib/d' || k AS dir, "
        "version, version <> split_part(tool, '/', 6) AS version_mismatch FROM known",
        "unresolved_tools": f"WITH {_TOOLS}, {_ENDS} SELECT CAST(c AS VARCHAR) AS url, side, tool FROM ends WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.k = ends.k AND t.r <> 13)",
        "workflow_tool_parameters": f"WITH {_TOOLS}, {_ENDS} SELECT CAST(c AS VARCHAR) AS url, string_agg(w[1], '|' ORDER BY pos, tool) AS names FROM known WHERE side = 'out' GROUP BY c",
        "tool_uri_parts": f"WITH {_TOOLS}, {_ENDS} SELECT DISTINCT tool, 'o' AS owner, 'r' || (k % 20) AS repo, 't' || k AS name, split_part(tool, '/', 6) AS revision, "
        "'h/o/r' || (k % 20) || '/t' || k || '/' || split_part(tool, '/', 6) AS short FROM u WHERE tool IS NOT NULL",
        "tool_version_lookup": f"WITH {_TOOLS}, {_ENDS} SELECT DISTINCT tool, p_name AS body FROM u JOIN t ON t.k = u.k WHERE tool IS NOT NULL AND turn % 4 = 1",
        "harvested_workflows": f"""WITH {_TOOLS}, {_ENDS}, {taken}
            SELECT CAST(c AS VARCHAR) AS uri, 'old' AS name, '-' AS archetype, '-' AS description, '-' AS inputs, '-' AS outputs, '-' AS raw FROM h WHERE c % 4 = 0
            UNION ALL SELECT CAST(c AS VARCHAR), 'w' || c, 'galaxy_workflow', 'from hub ' || c,
                   coalesce((SELECT string_agg(x, '|' ORDER BY x) FROM fi WHERE fi.c = got.c), ''),
                   coalesce((SELECT string_agg(x, '|' ORDER BY x) FROM fo WHERE fo.c = got.c), ''), CAST(c AS VARCHAR) FROM got WHERE c % 4 <> 0""",
        "harvest_failures": """WITH h AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL)
            SELECT 'archive' AS stage, CAST(c AS VARCHAR) AS key, 'BadZipFile' AS reason FROM h WHERE c % 3 <> 0 AND c % 5 = 0
            UNION ALL SELECT 'workflow', CAST(c AS VARCHAR), 'not a document' FROM h WHERE c % 3 <> 0 AND c % 5 <> 0 AND c % 7 = 0""",
        "archived_workflows": """SELECT o_orderkey || '.zip' AS path, CASE WHEN ok THEN CAST(1 AS BIGINT) ELSE -1 END AS position, CASE WHEN ok THEN 'z/second.ga' END AS entry,
            CASE WHEN ok THEN 'z/second.ga of ' || o_orderkey END AS name,
            CASE WHEN ok THEN md5('{"uuid": "' || o_orderkey || '", "name": "z/second.ga of ' || o_orderkey || '", "steps": {}}') END AS raw_md5, NOT ok AS failed
            FROM (SELECT *, o_orderkey % 5 <> 0 AND o_orderkey % 11 <> 0 AS ok FROM orders)""",
        "landed_hub": "SELECT 'https://hub.example.org/' || o_orderkey AS url, o_orderstatus AS description, 'https://hub.example.org/' || o_orderkey || '/download' AS download "
        "FROM orders WHERE lower(o_orderpriority) = '5-low'",
        "landed_repositories": "SELECT DISTINCT 'https://api.github.com/repos/o/r' || (page_id % 50) || '/contents' || CASE WHEN page_id % 8 = 3 THEN '/tools?ref=dev' ELSE '' END AS api_url "
        "FROM pages WHERE page_id % 8 < 4 AND page_id % 11 <> 0",
        "landed_install_info": "SELECT DISTINCT 'o' AS owner, 'r' || (p_partkey % 20) AS repo, v AS revision, 'https://github.com/o/r' || (p_partkey % 20) AS url "
        "FROM part, (SELECT unnest(['1.0', '2.0', '9.9']) AS v) WHERE p_partkey % 20 <> 13",
        "landed_tree": f"""WITH d AS (SELECT p_partkey AS k, 'r' || (p_partkey % 20) AS repo, {_DIR} AS dir FROM part),
            x AS (SELECT repo, dir, 't.xml' AS name FROM d UNION ALL SELECT repo, regexp_extract(dir, '^(.*)/[^/]*$', 1), 'd' || k FROM d
                  UNION ALL SELECT repo, dir, '.shed.yml' FROM d WHERE k % 3 <> 0 UNION ALL SELECT repo, dir || '/sub', 'u.XML' FROM d WHERE k % 10 = 0
                  UNION ALL SELECT repo, dir || '/sub', '.Shed.yml' FROM d WHERE k % 10 = 0)
            SELECT repo, name, count(*) AS n, count(DISTINCT dir) AS dirs FROM x GROUP BY ALL""",
        "landed_descriptors": "SELECT s_suppkey % 50 AS app, max(s_name) AS name FROM supplier GROUP BY s_suppkey % 50",
        "landed_app_index": "SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_name < 'NATION_2'",
        "landed_texts": """WITH p AS (SELECT p_partkey % 20 AS r, arg_max(p_partkey, 'lib/d' || p_partkey || '/') AS k FROM part WHERE p_partkey % 4 <> 0 GROUP BY 1)
            SELECT 'r' || r AS repo, md5('owner: own' || k || chr(10) || CASE WHEN k % 8 = 0 THEN 'long_description: long' || chr(10) ELSE '' END
                   || 'description: short' || chr(10) || 'categories: [" A' || r || '", "  ", Bb]') AS content_md5 FROM p""",
        "landed_tool_io": "SELECT 't' || p_partkey AS tool_id, string_split(p_name, ' ')[1] AS name, 'data' AS type, lower(replace(p_brand, '#', '')) AS extensions, "
        "1 + (p_partkey % 9) + CAST(ceil((p_partkey % 9) / 2) AS BIGINT) AS depth FROM part",
        "tool_io_outputs": "SELECT 't' || p_partkey AS tool_id, CAST(0 AS BIGINT) AS pos, 'o' AS name, 'data' AS type, lower(replace(p_brand, '#', '')) AS format, p_partkey % 2 = 0 AS hidden FROM part",
        "crawl_many": f"WITH d AS (SELECT p_partkey AS k, 'r' || (p_partkey % 20) AS repo, {_DIR} AS dir FROM part WHERE p_partkey % 7 <> 0) "
        "SELECT repo, dir || '/t.xml' AS path FROM d WHERE k % 3 <> 0 UNION ALL SELECT repo, dir || '/sub/u.XML' FROM d WHERE k % 10 = 0 AND k % 3 = 0",
        "crawl_many_smart": f"WITH d AS (SELECT p_partkey AS k, 'r' || (p_partkey % 20) AS repo, {_DIR} AS dir FROM part WHERE p_partkey % 7 <> 0) "
        "SELECT repo, dir || '/t.xml' AS path FROM d WHERE k % 3 <> 0 UNION ALL SELECT repo, dir || '/sub/u.XML' FROM d WHERE k % 10 = 0",
        "tool_folders_below": f"WITH d AS (SELECT p_partkey AS k, 'r' || (p_partkey % 20) AS repo, {_DIR} AS dir FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 2 = 0) "
        "SELECT repo, dir AS folder FROM d WHERE k % 3 <> 0 UNION ALL SELECT repo, dir || '/sub' FROM d WHERE k % 10 = 0",
        "crawl_many_counts": "SELECT 'o' AS repo_owner, 'r' || (p_partkey % 20) AS repo, count(*) AS tools, count(*) AS folders FROM part "
        "WHERE p_partkey % 7 <> 0 AND (p_partkey % 3 <> 0 OR p_partkey % 10 = 0) GROUP BY p_partkey % 20",
        "crawled_ledger": """WITH f AS (SELECT p_partkey AS k, 'https://api.github.com/repos/o/r' || (p_partkey % 20) || '/contents/lib/d' || p_partkey || '?ref=main' AS url
                   FROM part WHERE p_partkey % 4 <> 0)
            SELECT url, CASE WHEN k % 9 = 0 AND k % 2 = 0 THEN 'completed' WHEN k % 11 = 0 THEN 'error' ELSE 'completed' END AS status,
                   CASE WHEN k % 11 = 0 AND NOT (k % 9 = 0 AND k % 2 = 0) THEN '404' ELSE '' END AS code, 'toolshed' AS source_type, 'galaxy_shed_tool' AS artifact_type FROM f
            UNION ALL SELECT DISTINCT 'https://api.github.com/repos/o/r' || (p_partkey % 20) || '/contents', 'pending', '', 'toolshed', 'galaxy_shed_tool' FROM part""",
        "crawled_tools": f"WITH {_TOOLS} SELECT 'r' || r AS repo, 't' || k AS id, version FROM t WHERE k % 4 <> 0 AND k % 11 <> 0 AND NOT (k % 9 = 0 AND k % 2 = 0)",
        "stored_ledger_pending": "SELECT CAST(user_id AS VARCHAR) AS url, count(*) AS n FROM events WHERE event_type IS NULL OR event_type NOT IN ('error', 'purchase', 'signup') GROUP BY user_id",
        "stored_registry": f"SELECT CAST(doc_id AS VARCHAR) AS id, {_URI} AS uri, source AS name, true AS no_license FROM documents WHERE doc_id % 2 = 0",
        "registry_without_newlines": f"SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 2 = 0 THEN 'app/' || doc_id ELSE replace({_URI}, chr(10), '|') END AS uri, "
        "CASE WHEN doc_id % 6 = 0 THEN 'app/' || doc_id ELSE 'there' END AS location FROM documents",
        "repaired_versions": "SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN k THEN CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 5 <> 0 THEN 'v' || p_size ELSE '@TOOL_VERSION@' END "
        "ELSE CAST(p_size AS VARCHAR) END AS version, k AND (p_partkey % 3 = 0 OR p_partkey % 5 = 0) AS \"left\" FROM (SELECT *, p_partkey % 4 = 0 AS k FROM part)",
        "converter_differences": f"WITH {git} SELECT DISTINCT url, a, b FROM x WHERE a <> b",
        "repointed_ledger": f"WITH {_LEDGER}, m AS (SELECT *, status = 'error' AND CAST(url AS BIGINT) % 2 = 0 AS go FROM c) "
        "SELECT CASE WHEN go THEN 'new/' || url ELSE url END AS url, CASE WHEN go THEN 'pending' ELSE status END AS status, go AS moved FROM m",
        "backfilled_tools": """SELECT CAST(k AS VARCHAR) AS folder_url, CASE WHEN e THEN CASE WHEN k % 4 = 0 THEN 'short' ELSE p_type END WHEN k % 2 = 0 THEN '' ELSE 'has' END AS description,
            CASE WHEN e THEN p_brand WHEN k % 3 = 0 THEN 'me' ELSE '' END AS owner, CASE WHEN e THEN lower(p_brand) ELSE '' END AS categories
            FROM (SELECT *, p_partkey AS k, p_partkey % 2 = 0 AND p_partkey % 3 <> 0 AND p_partkey % 5 <> 0 AS e FROM part)""",
        "published_records": f"SELECT {_URI} AS key, CASE WHEN doc_id % 10 IN (1, 2) THEN 'failed' ELSE 'sent' END AS side, "
        "CAST(CASE doc_id % 10 WHEN 1 THEN 409 WHEN 2 THEN 500 ELSE 201 END AS BIGINT) AS status, 'got ' || (doc_id % 10) AS answer FROM documents",
        "registry_versions": """WITH b AS (SELECT md5(text) AS uri, min(doc_id % 3) AS batch, arg_min(doc_id, (doc_id % 3, doc_id)) AS id FROM documents GROUP BY 1)
            SELECT CAST(v + 1 AS BIGINT) AS version, CAST((SELECT count(*) FROM b WHERE batch <= v) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS ids FROM range(3) t(v)
            UNION ALL SELECT CAST(-2 AS BIGINT), count(*), CAST(sum(id) AS BIGINT) FROM b WHERE batch <= 1""",
        "early_stopped_workflows": """WITH k AS (SELECT o_orderkey AS k, o_orderkey % 5 = 0 OR o_orderkey % 11 = 0 AS bad FROM orders),
            r AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (ORDER BY k) AS n FROM k)
            SELECT k AS hub_pos, k || '.zip' AS path, CASE WHEN bad THEN 'failed' ELSE 'z/second.ga' END AS entry FROM r WHERE n < 25 OR (n = 25 AND NOT bad)""",
        "published_without_token": f"SELECT {_URI} AS key, CAST(403 AS BIGINT) AS status FROM documents WHERE doc_id % 2 = 0",
        "normalized_artifacts": f"WITH {_TOOLS} SELECT 't' || k AS location, p_name AS name, version, 'unknown' AS metadata_version, version AS contract_version, "
        "CASE WHEN k % 4 = 1 THEN 'own' WHEN k % 4 = 0 THEN '' ELSE 'short' END AS description FROM t",
        "normalized_outputs": f"WITH {_TOOLS} SELECT 't' || k AS location, 'o' AS name, 'data' AS type, 'out' AS description, f AS formats FROM t",
        "tool_tables_outputs": f"WITH {_TOOLS} SELECT 't' || k AS uri, p_name AS tool_name, CAST(0 AS BIGINT) AS pos, 'o' AS name, 'out' AS label, f AS formats FROM t",
    }
