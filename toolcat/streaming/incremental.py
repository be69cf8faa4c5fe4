"""The harvest as an incremental job: new files of landed records go into the registry once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from toolcat.operators.catalog import new_rows


def ingest(spark: SparkSession, landing: str, target: str, checkpoint: str, schema, key: str = "uri") -> None:
    """Read the JSON files that are new in ``landing`` and append the rows whose key ``target`` lacks. A batch that
    is run again after a failure adds nothing twice."""

    def add(batch: DataFrame, _: int) -> None:
        stored = batch.sparkSession.read.schema(schema).parquet(target)
        new_rows(batch, stored, key).write.mode("append").parquet(target)

    query = (
        spark.readStream.schema(schema).json(landing).writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
