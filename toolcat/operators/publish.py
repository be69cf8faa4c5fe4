"""Publishing of registry records over HTTP: one result row for each record."""

from __future__ import annotations

import hashlib
import urllib.error
import urllib.request
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs, parquet
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from toolcat.scratch import written

TIMEOUT_S = 10
NO_TOKEN_POST, NO_TOKEN_PATCH = 403, 443
#: Records whose answers pass the driver together.
BATCH = 100_000
RESULTS = "key string, success boolean, status int, response string, error string"


def _send(url: str, body: str, token: str | None, method: str, no_token: int, timeout: float) -> tuple:
    """success, status, response, error."""
    if not token:
        return False, no_token, None, "no token"
    head = {"Authorization": f"Bearer {token}", "Content-Type": "application/json", "Idempotency-Key": hashlib.sha256(f"{method} {url} {body}".encode()).hexdigest()}
    request = urllib.request.Request(url, body.encode(), head, method=method)
    try:
        with urllib.request.urlopen(request, timeout=timeout) as reply:
            return reply.status in (200, 201), reply.status, reply.read().decode(), None
    except urllib.error.HTTPError as e:
        return False, e.code, None, e.read().decode(errors="replace")
    except OSError as e:
        return False, None, None, str(e)


def _sent(df: DataFrame, key: str, url: str, token: str | None, method: str, no_token: int, timeout: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, body in zip(batch["key"], batch["body"], strict=True):
                at = f"{url.rstrip('/')}/{k}" if method == "PATCH" else url
                rows.append((k, *_send(at, body, token, method, no_token, timeout)))
            out = pd.DataFrame(rows, columns=["key", "success", "status", "response", "error"])
            yield out.astype({"status": "Int32"})

    fields = [c for c in df.columns if method == "POST" or c != key]
    rows = df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("body"))
    return rows.mapInPandas(run, "key string, success boolean, status int, response string, error string")


def post(records: DataFrame, url: str, token: str | None, timeout: float = TIMEOUT_S, key: str = "uri") -> DataFrame:
    """K4: ``key, success, status, response, error``; without a token nothing is sent and the status is 403."""
    return _sent(records, key, url, token, "POST", NO_TOKEN_POST, timeout)


def patch(changes: DataFrame, url: str, token: str | None, timeout: float = TIMEOUT_S, key: str = "id") -> DataFrame:
    """K5 over HTTP: null fields aren't sent."""
    return _sent(changes, key, url, token, "PATCH", NO_TOKEN_PATCH, timeout)


def publish(records: DataFrame, url: str, token: str | None, timeout: float = TIMEOUT_S, key: str = "uri") -> tuple[DataFrame, DataFrame]:
    """What was published and what wasn't. Every record is sent once, as the results are written down before
    they are split; a task that runs again sends the same key, by which a registry can tell."""
    return split(written(post(records, url, token, timeout, key), "published"))


class Sent(WriterCommitMessage):
    """What one task has sent, and what ended it early."""

    def __init__(self, rows: list[tuple], error: str | None) -> None:
        self.rows, self.error = rows, error


class RegistryWriter(DataSourceWriter):
    """Sends each record (``key, body``) and gathers the answers. A task that breaks off still reports what it sent;
    the job then fails once its results are written down."""

    def __init__(self, options: dict) -> None:
        self.url, self.token, self.method = options["url"], options.get("token") or None, options.get("method", "POST")
        self.timeout, self.results = float(options.get("timeout", TIMEOUT_S)), options["results"]

    def write(self, iterator: Iterator) -> Sent:
        rows: list[tuple] = []
        none = NO_TOKEN_PATCH if self.method == "PATCH" else NO_TOKEN_POST
        try:
            for row in iterator:
                at = f"{self.url.rstrip('/')}/{row['key']}" if self.method == "PATCH" else self.url
                rows.append((row["key"], *_send(at, row["body"], self.token, self.method, none, self.timeout)))
        except Exception as e:
            return Sent(rows, f"{type(e).__name__}: {e}")
        return Sent(rows, None)

    def _keep(self, messages: list) -> None:
        rows = [r for m in messages if m is not None for r in m.rows]
        kinds = [pa.string(), pa.bool_(), pa.int32(), pa.string(), pa.string()]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        table = pa.table(columns, names=["key", "success", "status", "response", "error"])
        files, path = fs.FileSystem.from_uri(self.results if "://" in self.results else f"file://{self.results}")
        files.create_dir(path)
        parquet.write_table(table, f"{path}/part-{uuid.uuid4().hex}.parquet", filesystem=files)

    def commit(self, messages: list) -> None:
        self._keep(messages)
        if broken := [m.error for m in messages if m is not None and m.error]:
            raise RuntimeError(f"{len(broken)} tasks broke off, the first: {broken[0]}")

    def abort(self, messages: list) -> None:
        if any(m is not None for m in messages) and not any(m is not None and m.error for m in messages):
            self._keep(messages)  # after a broken task commit() has kept them


class Registry(DataSource):
    """K4 as a sink. Options: ``url``, ``token``, ``method``, ``timeout``, ``results`` (the folder for answers)."""

    @classmethod
    def name(cls) -> str:
        return "registry"

    def schema(self) -> str:
        return "key string, body string"

    def writer(self, schema, overwrite: bool) -> RegistryWriter:
        return RegistryWriter(dict(self.options))


def publish_batches(records: DataFrame, url: str, token: str | None, results: str, key: str = "uri", batch: int = BATCH) -> tuple[DataFrame, DataFrame]:
    """K4, F18 through the sink: what was published and what wasn't. Answers pass the driver when a job ends, so records
    are dealt into jobs of about ``batch``; each leaves its answers in ``results`` before the next begins, also if it
    fails."""
    spark = records.sparkSession
    spark.dataSource.register(Registry)
    rows = written(records.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*records.columns)).alias("body")), "records")
    jobs = -(-rows.count() // batch)
    for i in range(jobs):
        part = rows.filter(F.pmod(F.xxhash64("key"), F.lit(jobs)) == i)
        part.write.format("registry").mode("append").options(url=url, token=token or "", results=results).save()
    return split(spark.read.schema(RESULTS).parquet(results) if jobs else spark.createDataFrame([], RESULTS))


def split(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """published records and failures."""
    return results.filter("success"), results.filter("NOT coalesce(success, false)")


