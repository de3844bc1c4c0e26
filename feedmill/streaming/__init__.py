"""Endless jobs over the same row functions the batch jobs use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedmill.operators import telemetry
from feedmill.sinks import write_parquet
from feedmill.sources import read_parquet
from feedmill.stores import delete


def _trigger(every: str | None) -> dict:
    """An endless query when an interval is given, else drain what is there and stop."""
    return {"processingTime": every} if every else {"availableNow": True}


def critical_rows(lines: DataFrame, enriched: bool = False, zone: str = "UTC") -> DataFrame:
    """Good rows that carry diagnostics, from a streaming (or batch) frame of lines."""
    return telemetry.accepted(telemetry.flatten(lines, zone=zone, route=telemetry.STREAM), telemetry.STREAM, enriched)


def start_critical(
    lines: DataFrame,
    output: str,
    checkpoint: str,
    every: str | None = None,
    shards: int | None = None,
    enriched: bool = False,
    zone: str = "UTC",
) -> StreamingQuery:
    """Append the critical rows to a gzip Parquet folder, exactly once.

    ``shards`` fixes the files per micro-batch; by default every task writes its own.
    """
    rows = critical_rows(lines, enriched, zone)
    if shards is not None:
        rows = rows.repartition(shards)
    return (
        rows.writeStream.format("parquet")
        .option("compression", "gzip")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**_trigger(every))
        .start()
    )


def start_split(
    lines: DataFrame,
    outputs: dict[str, str],
    rejects: str,
    checkpoint: str,
    every: str | None = None,
    enriched: bool = False,
    zone: str = "UTC",
    shards: int | None = None,
) -> StreamingQuery:
    """Write each named route and the rejects from one parse per micro-batch.

    ``outputs`` maps a route to its folder. A batch writes to its own
    ``batch_id=N`` folders and overwrites them when it is run again after a
    failure, so every line lands exactly once. The parsed rows wait beside the
    checkpoint until both routes are written, with the raw line of rejects only. Readers of a folder see
    ``batch_id`` as a partition column. ``shards`` fixes the files of a route per
    micro-batch.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parsed = telemetry.flatten(batch, zone=zone)
        slim = parsed.withColumn("line", F.when(F.col("reason").isNotNull(), F.col("line")))
        judged = f"{checkpoint}/judged/batch_id={batch_id}"
        try:
            rows = read_parquet(spark, write_parquet(slim, judged, "SNAPPY", mode="overwrite"), slim.schema)
            for route, folder in outputs.items():
                good = telemetry.accepted(rows, route, enriched)
                write_parquet(good, f"{folder}/batch_id={batch_id}", shards=shards, mode="overwrite")
            write_parquet(telemetry.rejected(rows), f"{rejects}/batch_id={batch_id}", mode="overwrite")
        finally:
            delete(spark, judged)

    return (
        lines.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )
