"""The operators as queries over the supplied tables (by way of ``lifts``), and the same answers in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from toolcat import schemas
from toolcat.functions.text import base_path, git_url_to_api, name_variants, sorted_set, split_formats, strip_query, tool_id
from toolcat.functions.toolxml import parse_tool
from toolcat.operators import catalog, descriptors, hub, ledger, repair, repotree, resolve, workflow
from toolcat.plans import lifts
from toolcat.scratch import written


def _steps(spark, sf):
    return workflow.steps(workflow.parse(lifts.workflows(spark, sf)))


def workflow_terminal_steps(spark, sf):
    return workflow.terminal_steps(_steps(spark, sf)).select("url", F.col("step_id").cast("long").alias("step"), "data_type", "tool")


def workflow_input_tools(spark, sf):
    rows = workflow.tools_at_inputs(_steps(spark, sf))
    return rows.select("url", F.col("dst").cast("long").alias("dst"), F.col("src").cast("long").alias("src"), "tool")


def workflow_in_degrees(spark, sf):
    return workflow.in_degrees(_steps(spark, sf)).select("url", F.col("step_id").cast("long").alias("step"), "references")


def workflow_tool_sequence(spark, sf):
    rows = workflow.tool_steps(_steps(spark, sf))
    return rows.select("url", F.col("pos").cast("long").alias("pos"), F.col("step_id").cast("long").alias("step"), "tool")


def workflow_input_steps(spark, sf):
    rows = workflow.input_steps(_steps(spark, sf))
    return rows.select("url", F.col("step_id").cast("long").alias("step"), "name", "data_type", "optional")


def workflow_endpoint_tools(spark, sf):
    rows = workflow.first_seen(workflow.terminal_steps(_steps(spark, sf)).filter("tool IS NOT NULL"))
    return rows.select("url", "tool", F.col("pos").cast("long").alias("pos"))


def workflow_summary(spark, sf):
    parsed = workflow.parse(lifts.workflows(spark, sf))
    steps = workflow.steps(parsed)
    rows = hub.run_summary(workflow.headers(parsed), workflow.input_steps(steps), workflow.terminal_steps(steps), workflow.tool_steps(steps))
    return rows.select("url", "uuid", "name", "tags", "n_inputs", "n_outputs", "n_tools")


def _tools(spark, sf):
    files = lifts.tool_files(spark, sf)
    return resolve.tools(files, files.select("repo_owner", "repo", "dir", F.lit("t.xml").alias("name"), "content"))


def tool_xml(spark, sf):
    rows = _tools(spark, sf)[0]
    return rows.select(
        "id", "tool_name", "version", F.size("inputs").cast("long").alias("n_inputs"),
        F.array_join(resolve.tool_formats(F.col("inputs")), "|").alias("formats"), F.col("outputs")[0]["format"].alias("out_format"),
    )


def tool_input_formats(spark, sf):
    rows = _tools(spark, sf)[0].select(F.col("repo").alias("url"), "inputs")
    return workflow.formats_of(rows, "url", "inputs").select("url", F.array_join("formats", "|").alias("formats"))


def tool_tables_inputs(spark, sf):
    rows = catalog.tool_tables(_tools(spark, sf)[0].withColumn("uri", F.col("id")))["tool_input"]
    return rows.select("uri", F.col("pos").cast("long").alias("pos"), "name", F.array_join("formats", "|").alias("formats"))


def html_rejected(spark, sf):
    pages = lifts.read(spark, sf, "pages").withColumn("t", parse_tool("html", F.array().cast(schemas.tokens)))
    return pages.filter("t.inputs IS NULL").select("page_id", F.col("t.error").alias("reason"))


def git_url_api(spark, sf):
    rows = lifts.git_urls(spark, sf)
    api = git_url_to_api(F.col("remote_repository_url"))
    return rows.select("page_id", api.alias("api_url"), base_path(api).alias("base"), strip_query(api).alias("plain"))


def unique_repositories(spark, sf):
    return repotree.unique_repositories(lifts.git_urls(spark, sf))


def crawl(spark, sf):
    return repotree.crawl(lifts.repo_tree(spark, sf)).select("path")


def smart_crawl(spark, sf):
    return repotree.smart_crawl(lifts.repo_tree(spark, sf)).select("path")


def tool_folders(spark, sf):
    return repotree.tool_folders(lifts.repo_tree(spark, sf)).select("folder", "folder_url")


def crawl_counts(spark, sf):
    return repotree.tool_counts(repotree.crawl(lifts.repo_tree(spark, sf)))


def hub_of_kind(spark, sf):
    return hub.of_kind(lifts.hub(spark, sf), "2-high").select("url", "description")


def hub_first_successful(spark, sf):
    rows = hub.of_kind(lifts.hub(spark, sf), "1-urgent")
    archives = rows.filter("hub_pos % 3 <> 0").select("url", F.lit("{}").alias("ga"), F.lit(None).cast("string").alias("error"))
    found, _ = hub.with_documents(rows, archives)
    return hub.first_successful(found, 10).select("hub_pos", "url", "description")


def descriptor_records(spark, sf):
    files, index = lifts.descriptor_files(spark, sf)
    rows = descriptors.latest(descriptors.records(descriptors.parse(files), "own", "apps", "main"))
    known, _ = descriptors.known_apps(rows, index)
    return known.select(
        "name", "version", "path", "location", "description", F.array_join("input_file_descriptions", "|").alias("inputs"),
        F.array_join("output_file_descriptions", "|").alias("outputs"),
    )


def descriptor_errors(spark, sf):
    return descriptors.errors(descriptors.parse(lifts.descriptor_files(spark, sf)[0])).select("key", "reason")


def registry_inserts(spark, sf):
    rows = lifts.registry_batches(spark, sf)
    target = rows.filter("batch < 0")
    for b in range(3):
        target = written(catalog.insert_if_absent(rows.filter(F.col("batch") == b), target, order="id"), "registry")
    return target.select("uri", "id", "name")


def registry_patch(spark, sf):
    rows = lifts.registry_batches(spark, sf).drop("batch")
    changes = rows.filter("id % 7 = 0").select("id", F.concat(F.lit("patched "), "name").alias("name"))
    return catalog.patch(rows, changes).select("id", "uri", "name")


def registry_evolved(spark, sf):
    rows = catalog.evolve(lifts.registry_batches(spark, sf).select("id", "uri"), schemas.migrations[1])
    return rows.select("id", "uri", F.coalesce("license", F.lit("none")).alias("license"), F.coalesce(F.size("tags"), F.lit(-1)).cast("long").alias("n_tags"))


def _current(spark, sf):
    return ledger.current(lifts.ledger_history(spark, sf), order=("updated_at", "event_id"))


def ledger_statuses(spark, sf):
    return ledger.statuses(_current(spark, sf))


def ledger_retry_list(spark, sf):
    return ledger.retry_list(_current(spark, sf))


def ledger_transition(spark, sf):
    state = _current(spark, sf).drop("event_id")
    n = F.col("url").cast("long")
    code = F.when(n % 3 == 0, F.lit("403"))
    found = state.select("url", (n % 2).alias("tools"), code.alias("error_code"))
    now = F.lit("2030-01-01").cast("timestamp")
    rows = ledger.transition(state, found, now)
    return rows.select("url", "status", F.coalesce("error_code", F.lit("")).alias("code"), (F.col("updated_at") == now).alias("moved"))


def ledger_pending(spark, sf):
    state = _current(spark, sf)
    return ledger.pending(state.select("url"), state)


def repositories_without_tools(spark, sf):
    repos, stored = lifts.named_repositories(spark, sf)
    return repair.without_tools(repos, stored).select("name")


def repository_name_variants(spark, sf):
    repos, _ = lifts.named_repositories(spark, sf)
    return repos.select("name", F.array_join(F.array_sort(name_variants(F.col("name"))), "|").alias("variants"))


def part_formats(spark, sf):
    rows = lifts.read(spark, sf, "part").select("p_partkey", F.concat_ws(" , ", "p_brand", "p_type", F.lit(""), "p_brand").alias("f"))
    return rows.select("p_partkey", F.array_join(sorted_set(split_formats(F.col("f"))), "|").alias("formats"))


def deterministic_ids(spark, sf):
    rows = lifts.hub(spark, sf).select("url", tool_id(F.col("url")).alias("id"))
    return rows.groupBy(F.length("id").cast("long").alias("length"), F.substring("id", 1, 9).alias("start")).agg(
        F.count("*").alias("n"), F.count_distinct("id").alias("ids")
    )


def normalized_inputs(spark, sf):
    tools = _tools(spark, sf)[0].select(F.col("id").alias("url"), F.col("tool_name").alias("name"), "version", "description",
                                        F.lit("{}").alias("ga"), F.lit("1").alias("format_version"), "inputs", "outputs")
    tables = catalog.normalized(tools, tools.select("url", F.col("inputs").alias("params")), tools.select("url", F.col("outputs").alias("params")))
    ins = tables["contract_input"].join(tables["implementation"], "contract_id").join(tables["artifact"].withColumnRenamed("name", "tool"), F.col("artifact_id") == F.col("id"))
    return ins.groupBy("location").agg(F.count("*").alias("n"), F.max("input_kind").alias("kind"), F.max("role").alias("role"))


def queries() -> dict:
    return {f.__name__: f for f in (
        workflow_terminal_steps, workflow_input_tools, workflow_in_degrees, workflow_tool_sequence, workflow_input_steps,
        workflow_endpoint_tools, workflow_summary, tool_xml, tool_input_formats, tool_tables_inputs, html_rejected, git_url_api,
        unique_repositories, crawl, smart_crawl, tool_folders, crawl_counts, hub_of_kind, hub_first_successful,
        descriptor_records, descriptor_errors, registry_inserts, registry_patch, registry_evolved, ledger_statuses,
        ledger_retry_list, ledger_transition, ledger_pending, repositories_without_tools, repository_name_variants, part_formats,
        deterministic_ids, normalized_inputs,
    )}


_STEPS = """
    s AS (SELECT conv_id AS url, turn, min(role) AS role FROM conversations
          WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
    e AS (SELECT url, turn AS dst, turn - 1 AS src FROM s WHERE turn > 0 AND turn % 4 <> 3
          UNION ALL SELECT url, turn, turn - 2 FROM s WHERE turn > 1 AND turn % 2 = 0)
"""
_KIND = "CASE role WHEN 'system' THEN 'parameter_input' WHEN 'user' THEN 'data_input' ELSE 'tool' END"
_TOOL = "CASE WHEN role IN ('system', 'user') THEN NULL ELSE 'toolshed.example.org/repos/o/r/tool' || (turn % 3) || '/1.0' END"
_TREE = """
    r AS (SELECT DISTINCT o_custkey % 50 AS a, o_orderkey % 7 AS b, l_linenumber AS n
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    x AS (SELECT a, b, n, CASE WHEN n = 1 THEN 'd' || a || '/f' || b || '.xml' ELSE 'd' || a || '/d' || b || '/f' || n || '.xml' END AS path FROM r)
"""
_URL = """
    u AS (SELECT page_id, page_id % 8 AS k, page_id % 50 AS n, page_id % 11 = 0 AS ignored,
          'https://api.github.com/repos/o/r' || (page_id % 50) || '/contents' AS root FROM pages),
    v AS (SELECT *, CASE WHEN k IN (0, 1, 2) THEN root WHEN k = 3 THEN root || '/tools?ref=dev' END AS api FROM u)
"""
_PARTS = """
    w AS (SELECT p_partkey, p_name, p_size, string_split(p_name, ' ') AS words, lower(replace(p_brand, '#', '')) AS brand FROM part)
"""
_LEDGER = """
    l AS (SELECT CAST(user_id AS VARCHAR) AS url, arg_max(event_type, (ts, event_id)) AS kind FROM events GROUP BY user_id),
    c AS (SELECT url, CASE kind WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'completed' WHEN 'signup' THEN 'processed' ELSE 'pending' END AS status FROM l)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "workflow_terminal_steps": f"WITH {_STEPS} SELECT url, turn AS step, {_KIND} AS data_type, {_TOOL} AS tool FROM s "
        "WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.url = s.url AND e.src = s.turn)",
        "workflow_input_tools": f"WITH {_STEPS} SELECT s.url, e.dst, e.src, {_TOOL} AS tool FROM e JOIN s ON s.url = e.url AND s.turn = e.dst "
        "WHERE s.role NOT IN ('system', 'user') AND EXISTS (SELECT 1 FROM s i WHERE i.url = e.url AND i.turn = e.src AND i.role IN ('system', 'user'))",
        "workflow_in_degrees": f'WITH {_STEPS} SELECT s.url, s.turn AS step, count(e.src) AS "references" FROM s LEFT JOIN e ON e.url = s.url AND e.src = s.turn GROUP BY s.url, s.turn',
        "workflow_tool_sequence": f"WITH {_STEPS}, p AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY turn) - 1 AS pos FROM s) "
        f"SELECT url, pos, turn AS step, {_TOOL} AS tool FROM p WHERE role NOT IN ('system', 'user')",
        "workflow_input_steps": f"WITH {_STEPS} SELECT url, turn AS step, 'step ' || turn AS name, {_KIND} AS data_type, false AS optional FROM s WHERE role IN ('system', 'user')",
        "workflow_endpoint_tools": f"WITH {_STEPS}, p AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY turn) - 1 AS pos FROM s) "
        f"SELECT url, {_TOOL} AS tool, min(pos) AS pos FROM p WHERE role NOT IN ('system', 'user') "
        "AND NOT EXISTS (SELECT 1 FROM e WHERE e.url = p.url AND e.src = p.turn) GROUP BY ALL",
        "workflow_summary": f"WITH {_STEPS} SELECT url, CAST(url AS VARCHAR) AS uuid, 'w' || url AS name, 'a, b' AS tags, "
        "count(*) FILTER (role IN ('system', 'user')) AS n_inputs, "
        "count(*) FILTER (NOT EXISTS (SELECT 1 FROM e WHERE e.url = s.url AND e.src = s.turn)) AS n_outputs, "
        "count(*) FILTER (role NOT IN ('system', 'user')) AS n_tools FROM s GROUP BY url",
        "tool_xml": f"WITH {_PARTS} SELECT 't' || p_partkey AS id, p_name AS tool_name, '1.' || p_size AS version, len(words) AS n_inputs, "
        "array_to_string(list_sort(list_distinct(list_append(words, brand))), '|') AS formats, words[1] AS out_format FROM w",
        "tool_input_formats": f"WITH {_PARTS}, f AS (SELECT DISTINCT p_partkey % 20 AS r, unnest(list_append(words, brand)) AS x FROM w) "
        "SELECT 'r' || r AS url, string_agg(x, '|' ORDER BY x) AS formats FROM f GROUP BY r",
        "tool_tables_inputs": f"WITH {_PARTS} SELECT 't' || p_partkey AS uri, i - 1 AS pos, words[i] AS name, words[i] || '|' || brand AS formats "
        "FROM (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM w)",
        "html_rejected": "SELECT page_id, 'not_xml' AS reason FROM pages",
        "git_url_api": f"WITH {_URL} SELECT page_id, api AS api_url, CASE WHEN k = 3 THEN 'tools' WHEN api IS NOT NULL THEN '' END AS base, "
        "split_part(api, '?', 1) AS plain FROM v",
        "unique_repositories": f"WITH {_URL} SELECT DISTINCT api AS api_url FROM v WHERE api IS NOT NULL AND NOT ignored",
        "crawl": f"WITH {_TREE} SELECT DISTINCT path FROM x WHERE CASE WHEN n = 1 THEN a % 5 = 0 ELSE (a + b) % 3 = 0 AND a % 5 <> 0 END",
        "smart_crawl": f"WITH {_TREE} SELECT DISTINCT path FROM x WHERE CASE WHEN n = 1 THEN a % 5 = 0 ELSE (a + b) % 3 = 0 END",
        "tool_folders": f"WITH {_TREE}, f AS (SELECT DISTINCT 'd' || a AS folder FROM r WHERE a % 5 = 0 "
        "UNION SELECT DISTINCT 'd' || a || '/d' || b FROM r WHERE (a + b) % 3 = 0) "
        "SELECT folder, 'https://api.github.com/repos/o/r/contents/' || folder || '?ref=main' AS folder_url FROM f",
        "crawl_counts": f"WITH {_TREE}, k AS (SELECT DISTINCT path, CASE WHEN n = 1 THEN 'd' || a ELSE 'd' || a || '/d' || b END AS dir FROM x "
        "WHERE CASE WHEN n = 1 THEN a % 5 = 0 ELSE (a + b) % 3 = 0 AND a % 5 <> 0 END) "
        "SELECT 'o' AS repo_owner, 'r' AS repo, count(*) AS tools, count(DISTINCT dir) AS folders FROM k",
        "hub_of_kind": "SELECT 'https://hub.example.org/' || o_orderkey AS url, o_orderstatus AS description FROM orders WHERE lower(o_orderpriority) = '2-high'",
        "hub_first_successful": "SELECT o_orderkey AS hub_pos, 'https://hub.example.org/' || o_orderkey AS url, o_orderstatus AS description "
        "FROM orders WHERE lower(o_orderpriority) = '1-urgent' AND o_orderkey % 3 <> 0 ORDER BY o_orderkey LIMIT 10",
        "descriptor_records": """
            WITH d AS (SELECT n_name AS name, n_regionkey, s_suppkey % 5 AS v, max(s_suppkey) AS k, arg_max(s_name, s_suppkey) AS s
                       FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 17 <> 0 AND s_suppkey % 23 <> 0 GROUP BY ALL)
            SELECT name, CAST(v AS VARCHAR) AS version, lpad(CAST(k AS VARCHAR), 9, '0') || '/app.json' AS path,
                   'https://github.com/own/apps/blob/main/' || lpad(CAST(k AS VARCHAR), 9, '0') || '/app.json' AS location,
                   'D' || k AS description, lower(s) || '|' AS inputs, 'out' AS outputs FROM d WHERE n_regionkey IN (1, 2)
        """,
        "descriptor_errors": "SELECT lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || '/app.json' AS key, "
        "CASE WHEN s_suppkey % 23 = 0 THEN 'not_json' ELSE 'missing_key' END AS reason FROM supplier JOIN nation ON s_nationkey = n_nationkey "
        "WHERE s_suppkey % 23 = 0 OR s_suppkey % 17 = 0",
        "registry_inserts": "SELECT md5(text) AS uri, arg_min(doc_id, (doc_id % 3, doc_id)) AS id, arg_min(source, (doc_id % 3, doc_id)) AS name FROM documents GROUP BY md5(text)",
        "registry_patch": "SELECT doc_id AS id, md5(text) AS uri, CASE WHEN doc_id % 7 = 0 THEN 'patched ' || source ELSE source END AS name FROM documents",
        "registry_evolved": "SELECT doc_id AS id, md5(text) AS uri, 'none' AS license, CAST(-1 AS BIGINT) AS n_tags FROM documents",
        "ledger_statuses": f"WITH {_LEDGER} SELECT url, status FROM c",
        "ledger_retry_list": f"WITH {_LEDGER} SELECT url FROM c WHERE status = 'error'",
        "ledger_transition": f"""WITH {_LEDGER}, n AS (SELECT *, CAST(url AS BIGINT) AS i, status IN ('completed', 'processed') AS done FROM c),
            t AS (SELECT *, CASE WHEN done THEN status WHEN i % 3 = 0 THEN 'error' WHEN i % 2 > 0 THEN 'completed' ELSE status END AS new,
                  CASE WHEN NOT done AND i % 3 = 0 THEN '403' ELSE '' END AS code FROM n)
            SELECT url, new AS status, code, new <> status OR code <> '' AS moved FROM t""",
        "ledger_pending": f"WITH {_LEDGER} SELECT url FROM c WHERE status NOT IN ('completed', 'processed')",
        "repositories_without_tools": "SELECT p_partkey || 'x_' || replace(p_name, ' ', '_') AS name FROM part WHERE p_partkey % 2 <> 0",
        "repository_name_variants": """
            WITH r AS (SELECT p_partkey || 'x_' || replace(p_name, ' ', '_') AS name FROM part)
            SELECT name, array_to_string(list_sort(list_distinct([name, replace(name, '-', '_'), replace(name, '_', '-'), replace(name, '_', ''),
                   replace(name, '-', ''), split_part(name, '_', 1), split_part(name, '-', 1)])), '|') AS variants FROM r
        """,
        "part_formats": "SELECT p_partkey, array_to_string(list_sort(list_distinct([p_brand, p_type, ''])), '|') AS formats FROM part",
        "deterministic_ids": "SELECT CAST(18 AS BIGINT) AS length, 'edc:tool:' AS start, count(*) AS n, count(DISTINCT o_orderkey) AS ids FROM orders",
        "normalized_inputs": f"WITH {_PARTS} SELECT 't' || p_partkey AS location, len(words) AS n, 'parameter' AS kind, 'input' AS role FROM w",
    }
