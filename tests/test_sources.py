"""Readers, the REST source, publishing and the incremental job."""

import io
import json
import random
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, HTTPServer, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from toolcat import schemas
from toolcat.operators import catalog, ledger, publish, versions
from toolcat.sources import landing, rest
from toolcat.streaming import incremental, ledger_state


def archive(*entries):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in entries:
            z.writestr(name, body)
    return out.getvalue()


def test_archives(spark, tmp_path):
    files = {
        "one.zip": archive(("x/a.ga", '{"n": 1}')), "two.zip": archive(("r.md", ""), ("z.ga", "{}"), ("a.ga", "no")), "none.zip": archive(("A.GA", "{}")), "bad.zip": b"PK",
    }
    for name, body in files.items():
        (tmp_path / name).write_bytes(body)
    got = {r.path.rpartition("/")[2]: r for r in landing.archives(spark, str(tmp_path)).collect()}
    assert (got["one.zip"].entry, got["one.zip"].ga) == ("x/a.ga", '{"n": 1}')
    assert (got["two.zip"].entry, got["two.zip"].position) == ("z.ga", 1)
    assert got["none.zip"].ga is None and got["none.zip"].error and got["bad.zip"].error == "BadZipFile"


def test_landed_json(spark, tmp_path):
    (tmp_path / "hub").mkdir()
    (tmp_path / "hub" / "1.json").write_text("[]")
    (tmp_path / "hub" / "2.json").write_text(json.dumps([{"url": "u", "versions": [{"descriptor_type": ["Galaxy"]}], "more": 1}, {"url": "v"}]))
    assert [r.url for r in landing.hub_listing(spark, str(tmp_path / "hub")).orderBy("url").collect()] == ["u", "v"]
    (tmp_path / "tree.json").write_text(json.dumps({"repo_owner": "o", "repo": "r", "branch": "main", "tree": [{"path": "a/b.xml", "type": "blob"}]}))
    row = landing.directory_listing(landing.repo_tree(spark, str(tmp_path / "tree.json"))).first()
    assert (row.dir, row.name, row.type) == ("a", "b.xml", "blob")
    for at in ("x.json", "d/x.json", "d/e/x.json"):
        (tmp_path / "apps" / at).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "apps" / at).write_text("{}\n")
    assert [r.path for r in landing.descriptor_files(spark, str(tmp_path / "apps")).collect()] == ["d/x.json"]
    kept = landing.snapshot(spark.range(3), str(tmp_path / "snap"))
    assert kept.count() == 3


@pytest.fixture
def server():
    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *_):
            pass

        def do_GET(self):
            page = int(self.path.rpartition("=")[2]) if "=" in self.path else 0
            self.send_response(500 if self.path.startswith("/fail") else 200)
            if page < 2:
                self.send_header("next_page", f"http://127.0.0.1:{self.server.server_port}/list?page={page + 1}")
            self.end_headers()
            self.wfile.write(json.dumps([] if page == 0 else [{"page": page, "auth": self.headers.get("Authorization")}]).encode())

        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            self.send_response(body.get("status", 200))
            self.end_headers()
            self.wfile.write(self.path.encode())

        do_PATCH = do_POST

    http = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{http.server_port}"
    http.shutdown()


def test_rest_pages(spark, server):
    spark.dataSource.register(rest.RestSource)
    rows = spark.read.format("rest_pages").option("urls", f"{server}/list").option("token", "t").load().collect()
    assert [json.loads(r.body) for r in sorted(rows)] == [{"page": 1, "auth": "Bearer t"}, {"page": 2, "auth": "Bearer t"}]
    with pytest.raises(Exception, match="500"):
        spark.read.format("rest_pages").options(urls=f"{server}/fail", attempts=2, pauseSeconds=0).load().collect()


def test_publishing(spark, server):
    rows = spark.createDataFrame([("a", 200), ("b", 201), ("c", 400), ("d", 500)], "uri string, status int")
    got = {r.key: r for r in publish.post(rows, f"{server}/tools", "t").collect()}
    assert {k: (r.success, r.status) for k, r in got.items()} == {"a": (True, 200), "b": (True, 201), "c": (False, 400), "d": (False, 500)}
    good, bad = publish.split(publish.post(rows, f"{server}/tools", "t"))
    assert good.count() == bad.count() == 2
    assert {r.status for r in publish.post(rows, server, None).collect()} == {403} and {r.status for r in publish.patch(rows, server, "", key="uri").collect()} == {443}
    assert publish.patch(rows.limit(1), f"{server}/tools", "t", key="uri").first().response == "/tools/a"
    dead = publish.post(rows.limit(1), "http://127.0.0.1:9/", "t").first()
    assert not dead.success and dead.status is None and dead.error


def test_publishing_sink(spark, server, tmp_path):
    rows = spark.createDataFrame([(f"u{i}", 201 if i % 3 else 400) for i in range(50)], "uri string, status int").repartition(4)
    good, bad = publish.publish_batches(rows, f"{server}/tools", "t", str(tmp_path / "answers"), batch=20)
    assert {r.key for r in good.collect()} == {f"u{i}" for i in range(50) if i % 3} and {r.status for r in bad.collect()} == {400}
    assert bad.count() == 17 and len(list((tmp_path / "answers").glob("*.parquet"))) == 3  # a file a job
    none, failed = publish.publish_batches(rows, f"{server}/tools", None, str(tmp_path / "none"))
    assert none.isEmpty() and {r.status for r in failed.collect()} == {403}
    assert publish.publish_batches(rows.limit(0), server, "t", str(tmp_path / "empty"))[0].isEmpty()


def test_publishing_sink_keeps_what_a_broken_task_sent(spark, server, tmp_path):
    spark.dataSource.register(publish.Registry)
    rows = spark.createDataFrame([(f"u{i}", '{"status": 201}' if i != 5 else None) for i in range(10)], "key string, body string").coalesce(1)
    results = str(tmp_path / "answers")
    with pytest.raises(Exception, match="broke off"):
        rows.write.format("registry").mode("append").options(url=f"{server}/tools", token="t", results=results).save()
    assert sorted(r.key for r in spark.read.parquet(results).collect()) == [f"u{i}" for i in range(5)]


def test_versions(spark, tmp_path):
    schema = "uri string, n long"
    store = versions.Versions(spark, str(tmp_path / "store"), schema)
    assert store.latest() == 0 and store.read().isEmpty()
    insert = lambda *uris: lambda t: catalog.insert_if_absent(spark.createDataFrame([(u, len(u)) for u in uris], schema), t)
    assert store.update(insert("a", "b")) == 1
    pinned = store.read()
    base = store.read(1)
    assert store.commit(insert("c")(base), 1) == 2
    with pytest.raises(versions.Conflict):
        store.commit(insert("d")(base), 1)  # its base isn't the last version any more
    calls, late = [], threading.Barrier(2, timeout=60)

    def change(uri):
        def run(target):
            calls.append(uri)
            if calls.count(uri) == 1:
                late.wait()  # both start from one version
            return insert(uri)(target)

        return run

    threads = [threading.Thread(target=store.update, args=(change(u),)) for u in "ef"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert store.latest() == 4 and len(calls) == 3 and {r.uri for r in store.read().collect()} == set("abcef")
    assert {r.uri for r in pinned.collect()} == set("ab") and [tuple(r) for r in store.history().orderBy("version").collect()] == [(1, 2), (2, 3), (3, 4), (4, 5)]
    store.tidy(2)
    assert store.read(3).count() == 4 and len(list((tmp_path / "store" / "data").iterdir())) == 2


def test_incremental_ingest(spark, tmp_path):
    target, landed = str(tmp_path / "registry"), tmp_path / "landing"
    landed.mkdir()
    spark.createDataFrame([], schemas.tool_generic).write.parquet(target)
    for n, uris in enumerate((["a", "b", "b"], ["b", "c"])):
        (landed / f"{n}.json").write_text("".join(json.dumps({"uri": u, "name": f"{u}{n}"}) + "\n" for u in uris))
        incremental.ingest(spark, str(landed), target, str(tmp_path / "checkpoint"), schemas.tool_generic)
    incremental.ingest(spark, str(landed), target, str(tmp_path / "checkpoint"), schemas.tool_generic)
    assert sorted((r.uri, r.name) for r in landing.registry(spark, target).collect()) == [("a", "a0"), ("b", "b0"), ("c", "c1")]


@pytest.fixture
def listing():
    """Pages of two entries; each status in ``refusals`` is given once instead of page 3."""

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *_):
            pass

        def do_GET(self):
            page, held = int(self.path.rpartition("=")[2]), self.server.held
            if page == 3 and self.server.refusals:
                self.send_response(self.server.refusals.pop())
                self.send_header("Retry-After", "0")
                return self.end_headers()
            self.send_response(200)
            if len(held) > 2 * page:
                self.send_header("next_page", f"http://127.0.0.1:{self.server.server_port}/list?page={page + 1}")
            self.end_headers()
            self.wfile.write(json.dumps(held[2 * page - 2 : 2 * page]).encode())

    http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    http.held, http.refusals = [], []
    threading.Thread(target=http.serve_forever, daemon=True).start()
    yield http
    http.shutdown()


def test_rest_stream_resumes(spark, listing, tmp_path):
    spark.dataSource.register(rest.RestSource)
    target, url = str(tmp_path / "entries"), f"http://127.0.0.1:{listing.server_port}/list?page=1"

    def harvest():
        rows = spark.readStream.format("rest_pages").options(urls=url, pauseSeconds=0).load()
        job = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", str(tmp_path / "checkpoint"))
        job.trigger(availableNow=True).start().awaitTermination()

    listing.held = list(range(7))
    listing.refusals = [500, 403]  # page 3 fails twice
    harvest()
    assert listing.refusals == []
    for more in (0, 1, 4):  # nothing new, the last page fills up, pages follow
        listing.held += range(len(listing.held), len(listing.held) + more)
        harvest()
    rows = spark.read.parquet(target).collect()
    assert sorted(int(r.body) for r in rows) == list(range(12)) and all(r.page.endswith(f"={int(r.body) // 2 + 1}") for r in rows)
    listing.refusals = [403] * 9
    with pytest.raises(Exception, match="403"):
        spark.read.format("rest_pages").options(urls=url, pauseSeconds=0, attempts=3).load().collect()


def test_ledger_as_state(spark, tmp_path):
    """Equal to ``ledger.transition`` over the same outcomes, a step at a time, however they are cut into batches."""
    rng = random.Random(5)
    urls = [f"u{i}" for i in range(12)]
    rows = [(u, rng.choice([0, 0, 0, 3, None]), rng.choice([None, None, "403", "500"]), n, 0) for n in range(8) for u in rng.sample(urls, 7)]
    state = spark.createDataFrame([("u0", "processed"), ("u1", "error"), ("x", "pending")], "url string, status string")
    then, none = F.timestamp_seconds(F.lit(0)), F.lit(None).cast("string")
    state = state.select(
        "url", "status", F.when(F.col("status") == "error", "500").alias("error_code"), F.lit("toolshed").alias("source_type"),
        F.lit("galaxy_shed_tool").alias("artifact_type"), none.alias("stored_id"), none.alias("stored_table"), then.alias("created_at"), then.alias("updated_at"),
    )
    outcomes = spark.createDataFrame(rows, "url string, tools long, error_code string, n long, seq long")
    outcomes = outcomes.withColumn("at", F.timestamp_seconds(F.col("n") + 1))
    landed = tmp_path / "outcomes"
    landed.mkdir()

    def run(retry_ms):
        stream = spark.readStream.schema(outcomes.schema).parquet(str(landed / "*"))
        ledger_state.run(stream, str(tmp_path / "changes"), str(tmp_path / "checkpoint"), retry_ms, state)

    for i, (a, b) in enumerate(((0, 2), (2, 6), (6, 8))):
        outcomes.filter(f"n >= {a} AND n < {b}").repartition(1).write.parquet(str(landed / str(i)))
        run(3_600_000)
    after = state
    for n in range(8):
        now = F.timestamp_seconds(F.lit(n + 1))
        after = spark.createDataFrame(ledger.transition(after, outcomes.filter(F.col("n") == n), now).collect(), state.schema)
    want = {r.url: (r.status, r.error_code, r.updated_at) for r in after.collect()}
    changed = spark.read.parquet(str(tmp_path / "changes"))
    got = {r.url: (r.status, r.error_code, r.updated_at) for r in ledger_state.latest(changed).collect()}
    untouched = {r.url: (r.status, r.error_code, r.updated_at) for r in state.collect() if r.url not in got}
    assert got | untouched == want and "x" in untouched and "u0" in untouched and not changed.filter("retry").count()


def test_errors_are_due_again(spark, tmp_path):
    schema = "url string, tools long, error_code string, at timestamp, seq long"
    landed = tmp_path / "outcomes"
    landed.mkdir()
    for i, (url, tools, code) in enumerate((("a", 0, "403"), ("b", 1, None), ("a", 2, None), ("c", 0, None))):
        one = spark.createDataFrame([(url, tools, code, i, i)], "url string, tools long, error_code string, n long, seq long")
        one.select("url", "tools", "error_code", F.timestamp_seconds("n").alias("at"), "seq").write.parquet(str(landed / str(i)))
        ledger_state.run(spark.readStream.schema(schema).parquet(str(landed / "*")), str(tmp_path / "changes"), str(tmp_path / "checkpoint"), 0)
    rows = spark.read.parquet(str(tmp_path / "changes")).collect()
    assert {r.url for r in rows if r.retry} == {"a"}
    assert {(r.url, r.status) for r in rows if not r.retry} == {("a", "error"), ("b", "completed"), ("a", "completed"), ("c", "pending")}
