"""The ledger as keyed state: outcomes of harvests come as a stream, each url's row is kept, its changes go out."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from toolcat import schemas
from toolcat.operators.ledger import DONE

#: Batches without data would go on for ever where the trigger ends with the data, as timers may always come.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}

#: What is kept of a url, and the rows that go out: ``retry`` marks an error that is due again, all others a change.
kept = T.StructType([T.StructField(n, T.StringType()) for n in ("status", "error_code")] + [T.StructField(n, T.TimestampType()) for n in ("created_at", "updated_at")])
changes = T.StructType([T.StructField("url", T.StringType()), *kept.fields, T.StructField("retry", T.BooleanType())])


def _change(key, row, retry: bool) -> Row:
    return Row(**dict(zip(changes.names, (key[0], *row, retry), strict=True)))


class Transitions(StatefulProcessor):
    """I1 by url. Outcomes are taken in order of ``at`` and ``seq``: a done url stays as it is, an error makes it an error, tools
    make it completed, neither leaves it as it is. An error is due again ``retry_ms`` after it was seen. A task holds the
    outcomes that a micro-batch has for one url."""

    def __init__(self, retry_ms: int):
        self.retry_ms = retry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.row = handle.getValueState("row", kept)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.row.update((initialState.status, initialState.error_code, initialState.created_at, initialState.updated_at))
        if initialState.status == schemas.ERROR:
            self._again(timerValues)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.row.get() if self.row.exists() else None
        now = tuple(before) if before else None
        for r in sorted(rows, key=lambda r: (r["at"], r["seq"])):
            now = now or (schemas.PENDING, None, r["at"], r["at"])
            status, code, created, _ = now
            if status in DONE:
                break
            if r["error_code"] is not None:
                new = (schemas.ERROR, r["error_code"])
            elif (r["tools"] or 0) > 0:
                new = (schemas.COMPLETED, None)
            else:
                continue
            if new != (status, code):
                now = (*new, created, r["at"])
        if now is None or (before and tuple(before) == now):
            return
        self.row.update(now)
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if now[0] == schemas.ERROR:
            self._again(timerValues)
        yield _change(key, now, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self.row.get()
        if now and now[0] == schemas.ERROR:
            yield _change(key, now, True)
            self._again(timerValues)

    def _again(self, timerValues) -> None:
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.retry_ms)

    def close(self) -> None:
        pass


def transitions(outcomes: DataFrame, retry_ms: int, ledger: DataFrame | None = None) -> DataFrame:
    """``outcomes``: a stream of ``url, tools, error_code, at, seq``; ``at`` doesn't go back from one micro-batch to the next for
    a url. ``ledger``: rows to begin with. Rows without a url or a time have no effect. The session needs RocksDB as
    its state store (``run`` sets it)."""
    rows = outcomes.select("url", F.col("tools").cast("long").alias("tools"), "error_code", "at", F.col("seq").cast("long").alias("seq"))
    known = None if ledger is None else ledger.select("url", *kept.names).groupBy("url")
    rows = rows.filter("url IS NOT NULL AND at IS NOT NULL").withColumn("seq", F.coalesce("seq", F.lit(0)))
    return rows.groupBy("url").transformWithState(Transitions(retry_ms), changes, "Append", "ProcessingTime", known)


def run(outcomes: DataFrame, target: str, checkpoint: str, retry_ms: int = 86_400_000, ledger: DataFrame | None = None) -> None:
    """All that has landed, once: changes are appended to the Parquet table ``target``. Errors that are due go out with the
    next outcomes of any url; a job that runs on sends them in time (``transitions`` without this trigger)."""
    spark, held = outcomes.sparkSession, {}
    for k, v in SETTINGS.items():
        held[k] = spark.conf.get(k, None)
        spark.conf.set(k, v)
    try:
        job = transitions(outcomes, retry_ms, ledger).writeStream.format("parquet").option("path", target)
        job.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def latest(rows: DataFrame) -> DataFrame:
    """Each url's last change. Of changes at one time the later state counts: pending, then errors, then done."""
    rank = F.when(F.col("status") == schemas.PENDING, 0).when(F.col("status") == schemas.ERROR, 1).otherwise(2)
    best = rows.filter("NOT retry").groupBy("url").agg(F.max_by(F.struct(*kept.names), F.struct("updated_at", rank)).alias("r"))
    return best.select("url", "r.*")
