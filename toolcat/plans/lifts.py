"""Domain documents derived from the supplied tables, so that the operators can be run over them at any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOOL_PREFIX = "toolshed.example.org/repos"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workflows(spark: SparkSession, sf_dir: str, tool: Column | None = None) -> DataFrame:
    """``url, ga``: one workflow per conversation, one step per turn. Roles give the step types; a step is fed by the
    turn before it (odd turns) or the two turns before it (even turns), but for turn 0 and each fourth. ``tool``: the
    tools' ids over ``conv_id`` and ``turn``."""
    t, previous = F.col("turn"), F.col("turn") - 1
    kind = F.when(F.col("role") == "system", "parameter_input").when(F.col("role") == "user", "data_input").otherwise("tool")
    tool = F.concat(F.lit(f"{TOOL_PREFIX}/o/r/tool"), (t % 3).cast("string"), F.lit("/1.0")) if tool is None else tool
    one = F.concat(F.lit('{"id": '), previous.cast("string"), F.lit(', "output_name": "out"}'))
    two = F.concat(F.lit("["), one, F.when(t > 1, F.concat(F.lit(', {"id": '), (t - 2).cast("string"), F.lit("}"))).otherwise(""), F.lit("]"))
    link = F.when((t == 0) | (t % 4 == 3), "{}").otherwise(F.concat(F.lit('{"in": '), F.when(t % 2 == 1, one).otherwise(two), F.lit("}")))
    step = F.concat(
        F.lit('"'), t.cast("string"), F.lit('": {"type": "'), kind, F.lit('", "name": "step '), t.cast("string"),
        F.lit('", "tool_id": '), F.when(kind == "tool", F.concat(F.lit('"'), tool, F.lit('"'))).otherwise("null"),
        F.lit(', "input_connections": '), link, F.lit("}"),
    )
    rows = read(spark, sf_dir, "conversations").filter("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.min("role").alias("role"))
    docs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", step.alias("s")))).alias("steps"))
    body = F.array_join(F.transform("steps", lambda x: x["s"]), ", ")
    return docs.select(
        F.col("conv_id").alias("url"),
        F.concat(F.lit('{"uuid": "'), F.col("conv_id").cast("string"), F.lit('", "name": "w'), F.col("conv_id").cast("string"),
                 F.lit('", "tags": ["a", "b"], "format-version": "0.1", "steps": {'), body, F.lit("}}")).alias("ga"),
    )


def tool_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``repo_owner, repo, dir, path, content``: one tool XML per part, with a version token, a parameter per word of
    its name, nested in a conditional for each third, and two formats."""
    key, words = F.col("p_partkey"), F.split("p_name", " ")
    param = lambda w: F.concat(F.lit('<param name="'), w, F.lit('" type="data" format="'), w, F.lit(", "), F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), F.lit('"/>'))
    params = F.array_join(F.transform(words, param), "")
    nested = F.when(key % 3 == 0, F.concat(F.lit('<conditional name="c"><when value="1">'), params, F.lit("</when></conditional>"))).otherwise(params)
    xml = F.concat(
        F.lit('<tool id="t'), key.cast("string"), F.lit('" name="'), F.col("p_name"), F.lit('" version="@V@"><macros><token name="@V@">1.'),
        F.col("p_size").cast("string"), F.lit('</token></macros><description>tool</description><inputs>'), nested,
        F.lit('<param name="s" type="select"/></inputs><outputs><collection name="k"><data name="o" format="'), words[0], F.lit('"/></collection></outputs></tool>'),
    )
    return read(spark, sf_dir, "part").select(
        F.lit("o").alias("repo_owner"), F.concat(F.lit("r"), (key % 20).cast("string")).alias("repo"),
        F.concat(F.lit("d"), key.cast("string")).alias("dir"), F.concat(F.lit("d"), key.cast("string"), F.lit("/t.xml")).alias("path"), xml.alias("content"),
    )


def git_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, name, remote_repository_url``: eight kinds of code-host address."""
    k, n = F.col("page_id") % 8, (F.col("page_id") % 50).cast("string")
    ends = {0: "", 1: ".git", 2: "/tree/main", 3: "/tree/dev/tools", 4: "/tree", 5: "/blob/main"}
    url = F.when(k == 6, F.concat(F.lit("https://example.org/o/r"), n)).when(k == 7, F.lit(""))
    for i, end in ends.items():
        url = url.when(k == i, F.concat(F.lit("https://github.com/o/r"), n, F.lit(end)))
    name = F.when(F.col("page_id") % 11 == 0, "Kubernetes").otherwise(F.concat(F.lit("n"), n))
    return read(spark, sf_dir, "pages").select("page_id", name.alias("name"), url.alias("remote_repository_url"))


def repo_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file tree from the distinct (customer % 50, order % 7, line number)."""
    li, o = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    rows = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    rows = rows.select((F.col("o_custkey") % 50).alias("a"), (F.col("o_orderkey") % 7).alias("b"), F.col("l_linenumber").alias("n")).distinct()
    a, b, n = (F.col(c).cast("string") for c in "abn")
    top = F.concat(F.lit("d"), a)
    deep = F.concat(top, F.lit("/d"), b)
    file = F.when(F.col("n") == 1, F.concat(top, F.lit("/f"), b, F.lit(".xml"))).otherwise(F.concat(deep, F.lit("/f"), n, F.lit(".xml")))
    marks = F.array(
        F.when((F.col("a") + F.col("b")) % 3 == 0, F.concat(deep, F.lit("/.shed.yml"))),
        F.when(F.col("a") % 5 == 0, F.concat(top, F.lit("/.shed.yml"))), file,
    )
    paths = rows.select(F.explode(marks).alias("path")).filter("path IS NOT NULL").distinct()
    return paths.select(F.lit("o").alias("repo_owner"), F.lit("r").alias("repo"), F.lit("main").alias("branch"), "path", F.lit("blob").alias("type"))


def hub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hub_pos, url, description, versions``: an entry per order, its kind the priority in mixed case."""
    kind = F.when(F.col("o_orderkey") % 2 == 0, F.lower("o_orderpriority")).otherwise(F.col("o_orderpriority"))
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("hub_pos"), F.concat(F.lit("https://hub.example.org/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.col("o_orderstatus").alias("description"), F.array(F.struct(F.array(kind).alias("descriptor_type"))).alias("versions"),
    )


def descriptor_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Descriptors, one per supplier and named after its nation, and the index of two regions' nations."""
    s, n = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    rows = s.join(n, s["s_nationkey"] == n["n_nationkey"])
    key = F.col("s_suppkey")
    version = F.when(key % 17 == 0, "null").otherwise(F.concat(F.lit('"'), (key % 5).cast("string"), F.lit('"')))
    body = F.concat(
        F.lit('{"name": "'), F.col("n_name"), F.lit('", "tool-version": '), version, F.lit(', "description": "D'), key.cast("string"),
        F.lit('", "inputs": [{"type": "File", "description": "'), F.col("s_name"), F.lit('"}, {"type": "file"}, {"type": "File"}], "output-files": [{"description": "OUT"}]}'),
    )
    content = F.when(key % 23 == 0, F.lit("{broken")).otherwise(body)
    path = F.concat(F.lpad(key.cast("string"), 9, "0"), F.lit("/app.json"))
    return rows.select(path.alias("path"), content.alias("content")), n.filter("n_regionkey IN (1, 2)").select(F.col("n_name").alias("name"))


def registry_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``batch, uri, id, name``: registry rows from the documents, keyed by the text's digest."""
    return read(spark, sf_dir, "documents").select(
        (F.col("doc_id") % 3).alias("batch"), F.md5(F.col("text").cast("binary")).alias("uri"), F.col("doc_id").alias("id"), F.col("source").alias("name")
    )


def ledger_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows in the order of the events; a user is a url, the kind of event its state."""
    kind, nothing = F.col("event_type"), F.lit(None).cast("string")
    status = F.when(kind == "error", "error").when(kind == "purchase", "completed").when(kind == "signup", "processed").otherwise("pending")
    return read(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("url"), status.alias("status"), nothing.alias("error_code"), F.lit("toolshed").alias("source_type"),
        F.lit("galaxy_shed_tool").alias("artifact_type"), F.col("event_id").cast("string").alias("stored_id"), nothing.alias("stored_table"),
        F.col("ts").cast("timestamp").alias("created_at"), F.col("ts").cast("timestamp").alias("updated_at"), "event_id",
    )


def named_repositories(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Repositories named after parts with underscores, and stored names with hyphens for every second part."""
    rows = read(spark, sf_dir, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("_")).alias("name"))
    repos = rows.select(F.concat(F.col("p_partkey").cast("string"), F.lit("x_"), "name").alias("name"),
                        F.lit("https://github.com/o/r").alias("remote_repository_url"))
    stored = rows.filter("p_partkey % 2 = 0").select(F.replace(F.concat(F.col("p_partkey").cast("string"), F.lit("x_"), "name"), F.lit("_"), F.lit("-")).alias("name"))
    return repos, stored
