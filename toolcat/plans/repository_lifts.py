"""Tool repositories with macro files and sidecars, workflows that use their tools, and landed files, derived from the
supplied tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toolcat.plans.lifts import TOOL_PREFIX, read, workflows
from toolcat.schemas import tool_xml
from toolcat.scratch import new_path

REPOS = 20


def _text(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(
        key.alias("k"), key.cast("string").alias("ks"), (key % REPOS).cast("string").alias("r"), F.split("p_name", " ").alias("words"),
        F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))).alias("brand"), F.col("p_size").cast("string").alias("size"), F.col("p_type").alias("kind"),
    )


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``repo_owner, repo, dir, name, path, content``: every file of 20 repositories. Each part is a tool ``lib/d<key>/t.xml``
    that imports two macro files. ``m.xml`` defines a version and a format; ``n.xml`` overrides the format for even
    keys, but leads to a file all tools of the repository share for each fifth, and isn't there for each seventh. A
    tool's own token overrides the version for each third. Three in four have a sidecar."""
    p, k = _part(spark, sf_dir), F.col("k")
    tool = _text(
        '<tool id="t', F.col("ks"), '" name="', F.array_join("words", " "), '" version="@V@"><macros><import>m.xml</import><import> n.xml </import>',
        F.when(k % 3 == 0, _text('<token name="@V@">1.', F.col("size"), "</token>")).otherwise(""), "</macros>",
        F.when(k % 4 == 1, "<description>own</description>").otherwise(""),
        '<inputs><section name="s"><param name="', F.col("words")[0], '" type="data" format="@F@, ', F.col("words")[1], '" label="in"/></section></inputs>',
        '<outputs><data name="o" format="@F@" label="out"/></outputs></tool>',
    )
    first = _text('<macros><token name="@V@">@MAJOR@.', F.col("size"), '</token><token name="@MAJOR@">2</token><token name="@F@">', F.col("brand"), "</token></macros>")
    second = F.when(k % 5 == 0, "../shared/n.xml").when(k % 2 == 0, _text('<macros><token name="@F@">x', F.col("words")[1], "</token></macros>")).otherwise("<macros/>")
    side = _text("owner: own", F.col("ks"), "\n", F.when(k % 8 == 0, "long_description: long\n").otherwise(""), 'description: short\ncategories: [" A', F.col("r"), '", "  ", Bb]\n')
    place = _text("lib/d", F.col("ks"))
    files = [("t.xml", F.lit(True), tool), ("m.xml", F.lit(True), first), ("n.xml", k % 7 != 0, second), (".shed.yml", k % 4 != 0, side)]
    made = F.filter(F.array(*(F.when(when, F.struct(F.lit(n).alias("name"), c.alias("content"))) for n, when, c in files)), lambda f: f.isNotNull())
    own = p.select("r", place.alias("dir"), F.explode(made).alias("f")).select("r", "dir", "f.name", "f.content")
    shared = p.select("r").distinct().select("r", F.lit("lib/shared").alias("dir"), F.lit("n.xml").alias("name"),
                                             _text('<macros><token name="@F@">shared', F.col("r"), "</token></macros>").alias("content"))
    return own.unionByName(shared).select(
        F.lit("o").alias("repo_owner"), _text("r", F.col("r")).alias("repo"), "dir", "name", F.concat_ws("/", "dir", "name").alias("path"), "content"
    )


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``repo_owner, repo, dir, name, path, content``: a tool per part whose tokens depend on their order. ``@V`` is part of
    the name ``@VER@`` and defined before it for even keys, behind it for odd ones. ``@A@`` leads to ``@B@`` in the first macro
    file and that to ``@C@`` in the second, which gives ``@B@`` another value for each seventh. ``@P@`` and ``@Q@`` lead to
    each other for each fifth key, growing, and for the next one without growth."""
    p, k = _part(spark, sf_dir), F.col("k")
    token = lambda name, *value: _text(f'<token name="{name}">', *value, "</token>")
    v, ver = token("@V", F.when(k % 2 == 0, "e").otherwise("o")), token("@VER@", F.col("size"))
    first = _text("<macros>", F.when(k % 2 == 0, v).otherwise(ver), token("@B@", "@C@b"), "</macros>")
    second = _text("<macros>", F.when(k % 2 == 0, ver).otherwise(v), token("@C@", F.col("brand")), F.when(k % 7 == 0, token("@B@", "late")).otherwise(""), "</macros>")
    pair = F.when(k % 5 == 0, _text(token("@P@", "@Q@x"), token("@Q@", "@P@y"))).when(k % 5 == 1, _text(token("@P@", "@Q@"), token("@Q@", "@P@"))).otherwise(token("@P@", "p"))
    tool = _text(
        '<tool id="t', F.col("ks"), '" name="n" version="@VER@"><macros><import>a.xml</import><import>b.xml</import>', token("@A@", "@B@-a"), pair,
        "</macros><description>@A@</description><help>@P@</help><inputs/><outputs/></tool>",
    )
    files = F.array(*(F.struct(F.lit(n).alias("name"), c.alias("content")) for n, c in (("t.xml", tool), ("a.xml", first), ("b.xml", second))))
    rows = p.select("r", _text("tok/d", F.col("ks")).alias("dir"), F.explode(files).alias("f"))
    return rows.select(F.lit("o").alias("repo_owner"), _text("r", F.col("r")).alias("repo"), "dir", "f.name", F.concat_ws("/", "dir", "f.name").alias("path"), "f.content")


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``repo_owner, repo, branch, path, type``: trees of 20 repositories. Each part is a folder below ``lib`` (even keys)
    or ``tools``, each seventh in one that is out of use; two in three are marked; each tenth has a marked folder
    inside."""
    p, k = _part(spark, sf_dir), F.col("k")
    top = _text(F.when(k % 7 == 0, "old/depricated/").otherwise(""), F.when(k % 2 == 0, "lib/d").otherwise("tools/d"), F.col("ks"))
    paths = F.array(
        F.struct(_text(top, "/t.xml").alias("path"), F.lit("blob").alias("type")), F.struct(top.alias("path"), F.lit("tree").alias("type")),
        F.when(k % 3 != 0, F.struct(_text(top, "/.shed.yml").alias("path"), F.lit("blob").alias("type"))),
        F.when(k % 10 == 0, F.struct(_text(top, "/sub/u.XML").alias("path"), F.lit("blob").alias("type"))),
        F.when(k % 10 == 0, F.struct(_text(top, "/sub/.Shed.yml").alias("path"), F.lit("blob").alias("type"))),
    )
    rows = p.select("r", F.explode(F.filter(paths, lambda x: x.isNotNull())).alias("e"))
    return rows.select(F.lit("o").alias("repo_owner"), _text("r", F.col("r")).alias("repo"), F.lit("main").alias("branch"), "e.path", "e.type")


def part_workflows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url, ga``: workflows whose steps use the tools of ``contents``; for each fourth turn a version that differs, and
    60 keys beyond the parts there are."""
    last = read(spark, sf_dir, "part").agg(F.max("p_partkey")).first()[0] or 0
    k = (F.col("conv_id") * 7919 + F.col("turn")) % (last + 60) + 1
    version = F.when(F.col("turn") % 4 == 1, "9.9").otherwise(F.when(k % 3 == 0, "1.0").otherwise("2.0"))
    return workflows(spark, sf_dir, _text(TOOL_PREFIX, "/o/r", (k % REPOS).cast("string"), "/t", k.cast("string"), "/", version))


def rival_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``repo_url, id, dir, path, version, ...``: tools of which many folders of a repository, and two files of each folder with
    an even key, claim the same id."""
    p, k = _part(spark, sf_dir), F.col("k")
    file = F.explode(F.when(k % 2 == 0, F.array(F.lit("t.xml"), F.lit("b.xml"))).otherwise(F.array(F.lit("t.xml"))))
    rows = p.select("k", "r", "size", _text("lib/d", F.col("ks")).alias("dir"), file.alias("file"))
    none = F.array().cast(tool_xml["inputs"].dataType)
    return rows.select(
        _text("https://github.com/o/r", F.col("r")).alias("repo_url"), _text("t", (k % 100).cast("string")).alias("id"), "dir",
        F.concat_ws("/", "dir", "file").alias("path"), F.concat(F.substring("file", 1, 1), "size").alias("version"),
        none.alias("inputs"), none.alias("outputs"), F.lit("").alias("description"),
    )


def rival_workflows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url, ga``: a workflow per order, an input step and two tool steps, whose steps name one tool in ``tool_id`` and the
    next one in ``content_id`` (keys 0 by 4), leave out either (1, 2), or have a tool of no repository first (3). For each sixth
    the last step's connections aren't there, and for each tenth its type."""
    k = F.col("o_orderkey")
    uri = lambda x, v: _text('"', TOOL_PREFIX, "/o/r", (x % 100 % REPOS).cast("string"), "/t", (x % 100).cast("string"), f'/{v}"')
    ids = _text(
        '"tool_id": ', F.when(k % 4 < 2, uri(k, "1.0")).when(k % 4 == 2, '""').otherwise('"Filter1"'),
        ', "content_id": ', F.when(k % 4 == 1, "null").otherwise(uri(k + 1, "2.0")),
    )
    steps = _text(
        '{"0": {"type": "data_input", "input_connections": {}}, "1": {"type": "tool", "input_connections": {"in": {"id": 0}}, ', ids,
        '}, "2": {', F.when(k % 10 != 0, '"type": "tool", ').otherwise(""), F.when(k % 6 != 0, '"input_connections": {"in": {"id": 1}}, ').otherwise(""), ids, "}}",
    )
    return read(spark, sf_dir, "orders").select(k.cast("string").alias("url"), _text('{"uuid": "u", "steps": ', steps, "}").alias("ga"))


def install_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``owner, repo, revision, info``: where each revision of a repository comes from; repository 13 isn't known."""
    rows = _part(spark, sf_dir).select("r", F.explode(F.array(F.lit("1.0"), F.lit("2.0"), F.lit("9.9"))).alias("revision")).distinct().filter("r <> '13'")
    url = _text("https://github.com/o/r", F.col("r"))
    return rows.select(F.lit("o").alias("owner"), _text("r", F.col("r")).alias("repo"), "revision", F.array(F.struct(url.alias("remote_repository_url"))).alias("info"))


def conversation_hub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hub_pos, url, description, versions``: an entry per conversation, each third of another kind."""
    ids = read(spark, sf_dir, "conversations").filter("conv_id IS NOT NULL").select("conv_id").distinct()
    kind = F.when(F.col("conv_id") % 3 == 0, "CWL").otherwise("Galaxy")
    return ids.select(
        F.col("conv_id").alias("hub_pos"), F.col("conv_id").cast("string").alias("url"), _text("from hub ", F.col("conv_id").cast("string")).alias("description"),
        F.array(F.struct(F.array(kind).alias("descriptor_type"))).alias("versions"),
    )


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, content``: a ZIP archive per order. Two workflows lie in it behind another file; for each fifth order none,
    and each eleventh is no archive."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for key in batch["o_orderkey"]:
                held = io.BytesIO()
                with zipfile.ZipFile(held, "w") as z:
                    z.writestr("a.txt", "no workflow")
                    for name in () if key % 5 == 0 else ("z/second.ga", "first.ga"):
                        z.writestr(name, f'{{"uuid": "{key}", "name": "{name} of {key}", "steps": {{}}}}')
                made.append(b"no archive" if key % 11 == 0 else held.getvalue())
            yield pd.DataFrame({"path": batch["o_orderkey"].map("{:d}.zip".format), "content": made})

    return read(spark, sf_dir, "orders").select("o_orderkey").mapInPandas(build, "path string, content binary")


def tool_io(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tool_id, io_json``: a description per part; its data port lies as many levels deep as the key's remainder by 9,
    sections and conditionals by turns, with a repeat beside it that isn't entered."""
    p, k = _part(spark, sf_dir), F.col("k")
    port = _text('{"name": "', F.col("words")[0], '", "type": "data", "extensions": ["', F.col("brand"), '"]}')
    hidden = '{"name": "no", "type": "repeat", "inputs": [{"name": "never", "type": "data"}]}'

    def wrap(inner: Column, i: Column) -> Column:
        section = _text('{"name": "s", "type": "section", "inputs": [', inner, "]}")
        return F.when(i % 2 == 0, section).otherwise(_text('{"name": "c", "type": "conditional", "cases": [{"value": "x", "inputs": [', inner, "]}]}"))

    deep = F.aggregate(F.when(k % 9 == 0, F.array().cast("array<bigint>")).otherwise(F.sequence(F.lit(1).cast("bigint"), k % 9)), port, wrap)
    outs = _text('[{"name": "o", "output_type": "data", "format": "', F.col("brand"), '"', F.when(k % 2 == 0, ', "hidden": true').otherwise(""), "}]")
    return p.select(_text("t", F.col("ks")).alias("tool_id"), _text('{"inputs": [', hidden, ", ", deep, '], "outputs": ', outs, "}").alias("io_json"))


def landed_json(rows: DataFrame, label: str, page: Column) -> str:
    """The path of ``rows`` written as files that each hold one JSON array, as a service's pages are landed."""
    path = new_path(rows.sparkSession, label)
    pages = rows.groupBy(page.alias("page")).agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value"))
    pages.write.partitionBy("page").text(path)
    return path
