"""Operators on hand-written rows."""

import json
import random

from pyspark.sql import functions as F

from toolcat import schemas
from toolcat.functions import text, toolxml
from toolcat.operators import catalog, descriptors, hub, keyfilter, ledger, repair, repotree, resolve, toolio, workflow
from toolcat.plans import pipelines


def values(spark, rows, column, name="x"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], f"{name} string").select(column).collect()]


def test_git_urls(spark):
    api = "https://api.github.com/repos/o/r/contents"
    cases = {
        "https://github.com/o/r": api, "https://github.com/o/r.git": api, "https://github.com/o/r/": api, "https://github.com/o/r?x=1": api,
        "https://github.com/o/r/tree/main": api, "https://github.com/o/r/tree/master/x/y": f"{api}/x/y",
        "https://github.com/o/r/tree/dev/x": f"{api}/x?ref=dev", "https://github.com/o/r/blobl/dev": f"{api}?ref=dev",
        "https://github.com/o/r/blob/dev/x": None, "https://github.com/o/r/tree": None, "https://github.com/o": None,
        "https://GitHub.com/o/r": None, "https://github.com:443/o/r": None, "https://gitlab.com/o/r": None, "git@github.com:o/r": None, "": None,
    }
    assert dict(zip(cases, values(spark, list(cases), text.git_url_to_api(F.col("x"))), strict=True)) == cases
    assert values(spark, [None], text.git_url_to_api(F.col("x"))) == [None]


def test_strings(spark):
    x = F.col("x")
    assert values(spark, ["a, b", "a,,b ", "", None, " a\t"], text.split_formats(x)) == [["a", "b"], ["a", "", "b"], [], [], ["a"]]
    assert values(spark, ["http://https://a", "https://a", "a"], text.strip_http(x)) == ["a", "a", "a"]
    assert values(spark, ["../m.xml", "./m.xml", "../../../m.xml", "s/m.xml"], text.resolve_path(F.lit("a/b"), x)) == ["a/m.xml", "a/b/m.xml", "m.xml", "a/b/s/m.xml"]
    assert values(spark, ["foo/a", "foobar/a", "foo", "", "x"], text.under_base(F.lit("foo"), x)) == [True, False, True, False, False]
    assert values(spark, ["", "/"], text.under_base(x, F.lit("any/where"))) == [True, True]
    assert values(spark, ["toolshed.a/repos/o/r/n/1", "toolsheda/repos/o/r/n/1", "toolshed.a/x", None], text.shed_uri_parts(x)["name"]) == ["n", None, None, None]
    assert values(spark, ["https://h/repos/o/r/contents", "https://h/repos/o/r/contents/a/b/?ref=x"], text.base_path(x)) == ["", "a/b"]
    assert set(values(spark, ["a_b-c"], text.name_variants(x))[0]) == {"a_b-c", "a_b_c", "a-b-c", "ab-c", "a_bc", "a", "a_b"}
    ids = values(spark, ["u", "v", "u"], text.tool_id(x))
    assert ids[0] == ids[2] != ids[1] and len(ids[0]) == 18
    assert values(spark, ["u\nv"], text.without_newlines(x)) == ["uv"]
    cats = spark.createDataFrame([([" A ", "", "b"],), (None,)], "c array<string>").select(text.clean_categories(F.col("c"))).collect()
    assert [r[0] for r in cats] == [["a", "b"], []]
    ends = spark.createDataFrame([("t", "c"), ("", "c"), ("t", None)], "t string, c string")
    assert [tuple(r) for r in ends.select(text.step_tool_id(F.col("t"), F.col("c")), text.output_tool_id(F.col("t"), F.col("c"))).collect()] == [("t", "c"), ("c", "c"), ("t", "t")]


SHED = "toolshed.x/repos/o/r/n/1.0"
GA = {
    "uuid": "u", "name": "w", "tags": ["t"], "format-version": "0.1",
    "steps": {
        "0": {"type": "data_input", "name": "in", "input_connections": {}},
        "10": {"type": "Tool", "tool_id": SHED, "content_id": "", "input_connections": {"a": {"id": 0}, "b": [{"id": 0}, {"id": 77}, {}]}},
        "2": {"type": "tool", "tool_id": "cat1", "input_connections": {"q": [], "z": {"id": 10}}},
        "3": {"type": "parameter_input", "input_connections": None},
        "4": {"type": None, "tool_id": None, "input_connections": {"self": {"id": 4}}},
    },
}


def test_workflow_graph(spark):
    docs = spark.createDataFrame([("u1", json.dumps(GA)), ("u2", "[1]"), ("u3", "broken"), ("u4", '{"name": "none"}')], "url string, ga string")
    parsed = workflow.parse(docs)
    steps = workflow.steps(parsed)
    assert [r.step_id for r in steps.orderBy("pos").collect()] == ["0", "10", "2", "3", "4"]
    assert {r.step_id for r in workflow.terminal_steps(steps).collect()} == {"2", "3"}
    assert [(r.dst, r.src, r.input_name) for r in workflow.tools_at_inputs(steps).orderBy("input_name").collect()] == [("10", "0", "a"), ("10", "0", "b")]
    assert {r.step_id: r.references for r in workflow.in_degrees(steps).collect()} == {"0": 2, "10": 1, "2": 0, "3": 0, "4": 1}
    assert [r.tool for r in workflow.tool_steps(steps).collect()] == [SHED]
    assert {(r.key, r.reason) for r in workflow.defects(parsed).collect()} == {
        ("u2", "not a document"), ("u3", "not a document"), ("u1", "step without connections"), ("u1", "step without type"),
    }
    assert {r.url for r in workflow.reject_defective(parsed).collect()} == {"u4"}
    head = {r.url: r for r in workflow.headers(parsed).collect()}
    assert head["u1"].description == "" and head["u4"].tags == [] and set(head) == {"u1", "u4"}
    # every step is terminal or referred to, in any order of rows
    shuffled = steps.repartition(3)
    used = workflow.edges(shuffled).select("src").distinct().join(steps.select(F.col("step_id").alias("src")), "src").count()
    assert used + workflow.terminal_steps(shuffled).count() == steps.count()


TOOL = """<tool id="n" name="N" version="@V@"><macros><import>m.xml</import><import>redirect.xml</import><import>gone.xml</import>
<token name="@OWN@">own</token></macros><description>{}</description><inputs><conditional name="c"><when value="1"><param name="p" type="data" format="a, b"/></when></conditional>
<PARAM name="q" label="@OWN@"/><param name="s" type="select"/></inputs><outputs><collection name="k"><data name="o" format="f" label="@M@"/></collection></outputs></tool>"""


def tool_rows(spark):
    place = lambda d, n, c: ("o", "r", d, n, c)
    rows = [
        place("t", "n.xml", TOOL.format("")), place("t", ".shed.yml", "owner: me\nlong_description: Long\ncategories: [' A ', '']"),
        place("t", "m.xml", '<macros><token name="@V@">@W@.1</token><token name="@W@">2</token><token name="@M@">first</token></macros>'),
        place("t", "redirect.xml", "../shared.xml"), place("", "shared.xml", '<macros><token name="@M@">later</token><token name="@OWN@">no</token></macros>'),
        place("t", "bad.xml", "<tool"), place("t", "other.xml", "<macros/>"),
    ]
    contents = spark.createDataFrame(rows, "repo_owner string, repo string, dir string, name string, content string")
    tree = contents.select("repo_owner", "repo", F.lit("main").alias("branch"), F.concat_ws("/", F.nullif("dir", F.lit("")), "name").alias("path"), F.lit("blob").alias("type"))
    return contents, tree


def test_tool_xml_with_macros(spark):
    contents, tree = tool_rows(spark)
    files = repotree.crawl(tree).join(contents, ["repo_owner", "repo", "dir", "name"]).select("repo_owner", "repo", "dir", "path", "content")
    good, bad = resolve.tools(files, contents)
    t = good.collect()
    assert len(t) == 1
    t = t[0]
    assert (t.id, t.version, t.description, t.owner, t.categories) == ("n", "2.1", "Long", "me", ["a"])
    assert [(p.name, p.type, p.format, p.label) for p in t.inputs] == [("p", "data", "a, b", None), ("q", None, None, "own")]
    assert [(p.name, p.type, p.label) for p in t.outputs] == [("o", "data", "later")]
    assert {(r.key, r.reason) for r in bad.collect()} == {
        ("t/bad.xml", "not_xml"), ("t/other.xml", "not_a_tool"), ("t/m.xml", "not_a_tool"), ("t/redirect.xml", "not_xml"),
    }


def test_token_rules():
    assert toolxml.substitute("<a>@X@</a>", {"@X@": "@Y@", "@Y@": "1"}) == ("<a>1</a>", None)
    assert toolxml.substitute("<a>@X@</a>", {"@X@": "<b>"}) == ("<a>@X@</a>", "token_breaks_xml")
    assert toolxml.substitute("<a>@X@</a>", {"@X@": "@X@x"}) == ("<a>@X@</a>", "token_cycle")
    # A cycle leaves other tokens alone; one that comes back to itself within a pass stands still.
    assert toolxml.substitute("<a>@X@@N@</a>", {"@X@": "@Y@x", "@N@": "n", "@Y@": "@X@"}) == ("<a>@X@n</a>", "token_cycle")
    assert toolxml.substitute("<a>@X@</a>", {"@X@": "@Y@", "@Y@": "@X@"}) == ("<a>@X@</a>", None)
    # Names that hold each other: what is defined first is replaced first.
    assert toolxml.substitute("<a>@VER@</a>", {"@V": "1", "@VER@": "2"}) == ("<a>1ER@</a>", None)
    assert toolxml.substitute("<a>@VER@</a>", {"@VER@": "2", "@V": "1"}) == ("<a>2</a>", None)
    chain = {f"@{i}@": f"@{i + 1}@" for i in range(40)}
    assert toolxml.substitute("<a>@0@</a>", chain | {"@40@": "end"}) == ("<a>end</a>", None)
    assert toolxml.substitute("<a>@0@</a>", dict(reversed(chain.items())) | {"@40@": "end"}) == ("<a>end</a>", None)
    assert toolxml.cyclic({"a": "b", "b": "c", "c": "b", "d": "d", "e": "a"}) == {"b", "c", "d"}


def test_tokens_against_the_plain_loop(monkeypatch):
    monkeypatch.setattr(toolxml, "LONGEST", 5000)
    rnd, ended = random.Random(4), 0
    for _ in range(1000):
        names = rnd.sample(["@A@", "@A", "@B@", "B@", "@AB@", "@C@", "C"], rnd.randint(1, 5))
        tokens = {n: "".join(rnd.choice([*names, "x", "y", "@"]) for _ in range(rnd.randint(0, 2))) for n in names}
        text = "<a>" + "".join(rnd.choice([*names, "z"]) for _ in range(rnd.randint(0, 4))) + "</a>"
        before, now = None, text
        for _ in range(14):
            before = now
            for n, v in tokens.items():
                now = now.replace(n, v)
            if now == before or len(now) > 5000:
                break
        got = toolxml.substitute(text, tokens)
        if now == before and len(now) <= 5000:
            ended += 1
            assert got == (now, None), (text, tokens)
        else:
            assert got[1] == "token_cycle", (text, tokens)
    assert 500 < ended < 1000


def test_token_order_over_files(spark):
    place = lambda d, n, c: ("o", "r", d, n, c)
    tool = '<tool id="{}" version="@VER@"><macros>{}</macros><inputs/><outputs/></tool>'
    imports = "<import>{}.xml</import><import>{}.xml</import>".format
    rows = [
        place("a", "t.xml", tool.format("a", imports("v", "w"))), place("b", "t.xml", tool.format("b", imports("w", "v"))), place("c", "t.xml", tool.format("c", '<token name="@VER@">own</token>')),
        *(place(d, n, f'<macros><token name="{k}">{v}</token></macros>') for d in "ab" for n, k, v in (("v.xml", "@V", "1"), ("w.xml", "@VER@", "2"))),
    ]
    contents = spark.createDataFrame(rows, "repo_owner string, repo string, dir string, name string, content string")
    files = contents.filter("name = 't.xml'").select("repo_owner", "repo", "dir", F.concat_ws("/", "dir", "name").alias("path"), "content")
    assert {(r.id, r.version) for r in resolve.tools(files, contents)[0].collect()} == {("a", "1ER@"), ("b", "2"), ("c", "own")}


def test_prefilter(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 7).alias("k"), F.lit("wide").alias("text"))
    keys = spark.createDataFrame([(5, 5), (6, 0), (None, 1), (9999, 3)], "id long, k long")
    got = keyfilter.prefilter(rows, keys, ["id", "k"])
    assert got.columns == rows.columns and {5} <= {r.id for r in got.collect()} and got.count() < 20


def test_crawls(spark):
    paths = [
        "a/.shed.yml", "a/t.xml", "a/b/.shed.yml", "a/b/u.xml", "c/x.shed.yml", "c/v.xml", "depricated/.shed.yml", "depricated/w.xml",
        "d/.SHED.YML", "d/T.XML", "d/e/y.xml", "foobar/.shed.yml", "foobar/z.xml",
    ]
    tree = spark.createDataFrame([("o", "r", "main", p, "blob") for p in paths], "repo_owner string, repo string, branch string, path string, type string")
    assert {r.path for r in repotree.crawl(tree).collect()} == {"a/t.xml", "d/T.XML", "foobar/z.xml"}
    assert {r.path for r in repotree.smart_crawl(tree).collect()} == {"a/t.xml", "a/b/u.xml", "d/T.XML", "foobar/z.xml"}
    assert {r.folder for r in repotree.tool_folders(tree, "foo").collect()} == set()
    assert {r.folder for r in repotree.tool_folders(tree).collect()} == {"a", "a/b", "c", "depricated", "d", "foobar"}
    root = tree.limit(0).unionByName(spark.createDataFrame([("o", "r", "main", p, "blob") for p in [".shed.yml", "t.xml", "a/.shed.yml", "a/u.xml"]], tree.schema))
    assert {r.path for r in repotree.crawl(root).collect()} == {"t.xml"}


def test_resolution_and_harvest(spark):
    contents, tree = tool_rows(spark)
    files = repotree.crawl(tree).join(contents, ["repo_owner", "repo", "dir", "name"]).select("repo_owner", "repo", "dir", "path", "content")
    tools = resolve.tools(files, contents)[0].withColumn("repo_url", F.lit("https://github.com/o/r"))
    info = spark.createDataFrame([("o", "r", "1.0", [("https://github.com/o/r",)]), ("o", "empty", "1", [])], schemas.install_info)
    listing = spark.createDataFrame(
        [(1, "u1", None, [(["Galaxy"],)]), (2, "u2", "d", [(["galaxy"],)]), (3, "u3", "d", [(["cwl"],)]), (4, "u4", "d", []), (5, "u5", "d", [([],)])],
        "hub_pos int, url string, description string, versions array<struct<descriptor_type:array<string>>>",
    )
    archives = spark.createDataFrame([("u1", json.dumps(GA), None), ("u2", None, "BadZipFile"), ("u3", "{}", None)], "url string, ga string, error string")
    target = spark.createDataFrame([], schemas.tool_generic)
    rows, errors = pipelines.harvest_workflows(listing, archives, info, tools, target)
    got = rows.collect()
    assert [(r.uri, r.input_file_formats, r.output_file_formats, r.metadata_version) for r in got] == [("u1", ["a", "b"], [], "0.1")]
    assert {(r.stage, r.key) for r in errors.collect()} == {("archive", "u2")}
    again, _ = pipelines.harvest_workflows(listing, archives, info, tools, rows)
    assert again.count() == 1
    uris = spark.createDataFrame([(SHED,), ("toolshed.x/repos/o/empty/n/1",)], "tool string")
    found = resolve.resolve(uris, info, tools).collect()
    assert [(r.name, r.version_mismatch) for r in found] == [("n", True)]


def test_descriptors(spark):
    body = {"name": "app", "tool-version": "1", "inputs": [{"type": "File", "description": "IN"}, {"type": "file"}, {"type": "File", "description": None}]}
    files = [
        ("a/x.json", json.dumps(body)), ("b/x.json", json.dumps(body | {"description": "newer"})), ("c/x.json", "{bad"), ("d/x.json", '{"name": "n"}'),
        ("e/x.json", json.dumps(body | {"name": "other"})), ("f/x.json", json.dumps(body | {"tool-version": ""})),
    ]
    frame = spark.createDataFrame(files, "path string, content string")
    index = spark.createDataFrame([("app",), ("app",)], "name string")
    rows, errors = pipelines.harvest_descriptors(frame, index, "o", "r", "main")
    got = {(r.name, r.version): r for r in rows.collect()}
    assert set(got) == {("app", "1"), ("app", "")} and got["app", "1"].description == "newer"
    assert got["app", "1"].input_file_descriptions == ["in", ""] and got["app", "1"].location == "https://github.com/o/r/blob/main/b/x.json"
    assert {(r.key, r.reason) for r in errors.collect()} == {("c/x.json", "not_json"), ("d/x.json", "missing_key"), ("e/x.json", "not in index")}
    empty, _ = pipelines.harvest_descriptors(frame, index.limit(0), "o", "r", "main")
    assert empty.count() == 0


def test_tool_io(spark):
    io = {
        "inputs": [
            {"name": "a", "type": "data", "extensions": ["x"]}, {"name": "r", "type": "repeat", "inputs": [{"name": "no", "type": "data"}]},
            {"name": "c", "type": "conditional", "cases": [{"inputs": [{"name": "s", "type": "section", "inputs": [{"name": "b", "type": "data_collection", "collection_types": ["list"]}]}]}, {}]},
            {"name": "z", "type": "data"},
        ],
        "outputs": [{"name": "o", "output_type": "data", "format": "f"}, {"name": "h", "hidden": True}],
    }
    frame = spark.createDataFrame([("t", json.dumps(io)), ("none", "{}")], "tool_id string, io_json string")
    assert [r.name for r in toolio.data_inputs(frame).orderBy("place").collect()] == ["a", "b", "z"]
    assert [(r.name, r.type, r.hidden) for r in toolio.outputs(frame).orderBy("pos").collect()] == [("o", "data", False), ("h", None, True)]


def test_registry(spark):
    target = spark.createDataFrame([("i1", "u1", "old"), ("i9", "u1", "twice")], "id string, uri string, name string")
    batch = spark.createDataFrame([("i2", "u2", "b"), ("i3", "u2", "a"), ("i4", "u1", "new")], target.schema)
    once = catalog.insert_if_absent(batch, target)
    assert {(r.id, r.uri) for r in once.collect()} == {("i1", "u1"), ("i9", "u1"), ("i2", "u2")}
    assert catalog.insert_if_absent(batch, once).count() == 3
    changes = spark.createDataFrame([("i1", "fixed", None)], "id string, name string, uri string")
    assert {(r.id, r.name, r.uri) for r in catalog.patch(target, changes).collect()} == {("i1", "fixed", "u1"), ("i9", "twice", "u1")}
    old = spark.createDataFrame([], schemas.tool_generic_v1)
    new = old
    for step in schemas.migrations:
        new = catalog.evolve(new, step)
    assert set(new.columns) == set(schemas.tool_generic.names)
    assert catalog.devolve(new, schemas.migrations[1]).columns == catalog.evolve(old, schemas.migrations[0]).columns


def test_tables_on_disk(spark, tmp_path):
    catalog.create_tables(spark, str(tmp_path))
    catalog.create_tables(spark, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "tool_harvest")).schema == schemas.tool_harvest
    old = spark.createDataFrame([("i",)], "id string").withColumn("uri", F.lit("u"))
    catalog.save_snapshot(old, str(tmp_path / "dump"))
    row = catalog.load_snapshot(spark, str(tmp_path / "dump")).first()
    assert row.uri == "u" and row.license is None


def test_ledger(spark):
    now, then = F.lit("2030-01-01").cast("timestamp"), "2020-01-01"
    rows = [(u, s, None, "toolshed", "galaxy_shed_tool", None, None) for u, s in (("done", "processed"), ("old", "pending"), ("bad", "error"), ("idle", "pending"))]
    state = spark.createDataFrame(rows, "url string, status string, error_code string, source_type string, artifact_type string, stored_id string, stored_table string")
    state = state.withColumns({c: F.lit(then).cast("timestamp") for c in ("created_at", "updated_at")})
    seen = [("done", 3, None), ("old", 2, None), ("bad", 0, "403"), ("idle", 0, None), ("new", 1, None), ("empty", 0, None)]
    outcomes = spark.createDataFrame(seen, "url string, tools long, error_code string")
    after = ledger.transition(state, outcomes, now)
    got = {r.url: (r.status, r.error_code, str(r.updated_at)[:4]) for r in after.collect()}
    assert got == {
        "done": ("processed", None, "2020"), "old": ("completed", None, "2030"), "bad": ("error", "403", "2030"), "idle": ("pending", None, "2020"),
        "new": ("completed", None, "2030"), "empty": ("pending", None, "2030"),
    }
    assert {r.url for r in ledger.pending(outcomes, after).collect()} == {"bad", "idle", "empty"}
    assert [r.url for r in ledger.retry_list(after).collect()] == ["bad"]
    repos = spark.createDataFrame([("old",), ("x",), ("x",)], "api_url string")
    seeded = ledger.seed(state, repos, now)
    assert seeded.count() == 5 and ledger.seed(seeded, repos, now).count() == 5
    fixed = spark.createDataFrame([("bad", "good")], "url string, new string")
    moved = {r.url: r.status for r in repair.repointed(after, fixed, now).collect()}
    assert moved["good"] == "pending" and "bad" not in moved


def test_crawl_pipeline(spark, tmp_path):
    contents, tree = tool_rows(spark)
    contents.write.parquet(str(tmp_path / "contents"))
    tree.write.parquet(str(tmp_path / "tree"))
    contents, tree = spark.read.parquet(str(tmp_path / "contents")), spark.read.parquet(str(tmp_path / "tree"))
    listing = spark.createDataFrame([("r", "https://github.com/o/r"), ("Kubernetes", "https://github.com/o/k"), ("n", None)], schemas.repo_listing)
    now = F.lit("2030-01-01").cast("timestamp")
    out = pipelines.crawl_repositories(listing, tree, contents, spark.createDataFrame([], schemas.tool_harvest), now)
    assert out["tools"].count() == 1
    states = {r.url.rpartition("/")[2]: r.status for r in out["ledger"].collect()}
    assert states == {"contents": "pending", "t?ref=main": "completed"}
    out["ledger"].write.parquet(str(tmp_path / "ledger"))
    stored = spark.read.parquet(str(tmp_path / "ledger"))
    again = pipelines.crawl_repositories(listing, tree, contents, stored, now)
    assert again["tools"].count() == 0 and again["ledger"].count() == 2


def test_repairs(spark):
    registry = spark.createDataFrame([("1", "a\nb", "vip_app_boutique"), ("2", "a\nb", "x"), ("3", "ab", "vip_app_boutique")], "id string, uri string, archetype string")
    assert [tuple(r) for r in repair.uri_patches(registry).collect()] == [("1", "ab", "ab")]
    tools = spark.createDataFrame([("t", "@VERSION@"), ("u", "1"), ("v", "X_VERSION")], "id string, version string")
    parsed = spark.createDataFrame([("t", "2"), ("u", "9"), ("v", "VERSION")], tools.schema)
    assert {r.id: r.version for r in repair.repaired_versions(tools, parsed).collect()} == {"t": "2", "u": "1", "v": "X_VERSION"}
    urls = spark.createDataFrame([("a?b",), ("a",)], "url string")
    assert [r.url for r in repair.converter_differences(urls, text.strip_query, lambda c: c).collect()] == ["a?b"]
    stored = spark.createDataFrame([("f1", "", "", []), ("f2", "has", "", [])], "folder_url string, description string, owner string, categories array<string>")
    sides = spark.createDataFrame([("f1", "me", "short", "", [" C "]), ("f2", "me", "s", "", [])], "folder_url string, owner string, description string, long_description string, categories array<string>")
    assert {r.folder_url: (r.description, r.owner, r.categories) for r in repair.backfilled(stored, sides).collect()} == {"f1": ("short", "me", ["c"]), "f2": ("has", "", [])}


def test_normalized_tables(spark):
    flows = spark.createDataFrame([("u", "n", "1", "d", "{}", None)], "url string, name string, version string, description string, ga string, format_version string")
    params = spark.createDataFrame([("u", [("p", "param", "data", "a,b", None)])], f"url string, params array<{schemas.parameter.simpleString()}>")
    tables = catalog.normalized(flows, params, params)
    assert tables["artifact"].first().metadata_version == "unknown"
    row = tables["contract_input"].first()
    assert (row.input_kind, row.encoding_formats, row.description) == ("parameter", ["a", "b"], "")
    assert tables["implementation"].first().contract_id == tables["contract"].first().id == row.contract_id


def test_hub_without_kind(spark):
    listing = spark.createDataFrame([("u", "d", None)], schemas.hub_entry)
    assert hub.of_kind(listing).count() == 1 and hub.of_kind(listing, "galaxy").count() == 0


def test_record_defaults(spark):
    row = descriptors.to_registry_record(spark.range(1), {}, "a", "m").first()
    assert len(row) == 14 and row.name == "" and row.input_file_formats == [] and row.archetype == "a"


def test_ports_at_any_depth(spark):
    def nested(depth):
        item = {"name": "deep", "type": "data", "extensions": ["x", 1], "collection_types": None}
        for i in range(depth):
            item = {"type": "section", "inputs": [item]} if i % 2 else {"type": "conditional", "cases": [{"inputs": []}, {"inputs": [item]}]}
        return {"inputs": [{"name": "first", "type": "data_collection"}, item, {"type": "repeat", "inputs": [{"name": "no", "type": "data"}]}, {"name": "last", "type": "data"}]}

    rows = [(f"t{d}", json.dumps(nested(d))) for d in (0, 1, 5, 200)] + [("bad", "{"), ("none", None), ("odd", '{"inputs": {"type": "data"}}'), ("list", "[1]"), ("mixed", '{"inputs": [1, null, {"type": "data", "extensions": "x"}]}')]
    found = toolio.data_inputs(spark.createDataFrame(rows, "tool_id string, io_json string"))
    got = {}
    for r in found.collect():
        got.setdefault(r.tool_id, []).append((r.name, len(r.place), r.extensions))
    for d in (0, 1, 5, 200):
        assert got[f"t{d}"] == [("first", 1, None), ("deep", 1 + d + (d + 1) // 2, ["x", "1"]), ("last", 1, None)]
    assert got["mixed"] == [(None, 1, None)] and set(got) == {"t0", "t1", "t5", "t200", "mixed"}
    assert found._jdf.queryExecution().executedPlan().toString().count("Generate explode") == 1


def test_early_stop(spark):
    listing, opened = spark.range(15_000).select(F.col("id").alias("hub_pos")), []

    def attempt(entries):
        opened.append(entries.count())
        return entries.filter("hub_pos % 3 > 0"), entries.filter("hub_pos % 3 = 0")

    good, bad = hub.take_successful(listing, 10, attempt)
    assert [r.hub_pos for r in good.orderBy("hub_pos").collect()] == [i for i in range(15) if i % 3] and [r.hub_pos for r in bad.orderBy("hub_pos").collect()] == [0, 3, 6, 9, 12]
    assert sum(opened) < 100
    good, bad = hub.take_successful(listing.limit(7), 10, attempt)
    assert good.count() == 4 and bad.count() == 3 and hub.take_successful(listing.limit(0), 10, attempt)[0].isEmpty()
    far = lambda e: (e.filter("hub_pos >= 100"), e.filter("hub_pos < 100"))
    assert [r.hub_pos for r in hub.take_successful(listing, 2, far)[0].collect()] == [100, 101]
