"""Structured Streaming over event files: deduplicated events, windowed counts, and current state by key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.shared import shared_path

EVENT_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, path: str, files_per_trigger: int | None = None, schema: str = EVENT_SCHEMA) -> DataFrame:
    """A stream of Parquet event files. Event times are instants: files that say none are read as UTC-neutral."""
    folder, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.option("pathGlobFilter", name if name.endswith(".parquet") else "*.parquet").parquet(folder if name.endswith(".parquet") else path)


def distinct_events(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each event once, for as long as the watermark remembers it."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def windowed_counts(events: DataFrame, width: str, late: str = "1 hour", slide: str | None = None) -> DataFrame:
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return events.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count(F.lit(1)).alias("n"))


def session_counts(events: DataFrame, gap: str, late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))


def _newest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    now = state.get if state.exists else None
    for f in frames:
        top = f.sort_values(["ts", "event_id"]).iloc[-1]
        found = (top["ts"].value, int(top["event_id"]), top["event_type"])
        if now is None or found[:2] > tuple(now)[:2]:
            now = found
    state.update(now)
    yield pd.DataFrame({"user_id": [key[0]], "status": [now[2]], "event_id": [now[1]]})


def latest_status(events: DataFrame) -> DataFrame:
    """The newest status of each user, sent again whenever events of that user arrive; late events change nothing."""
    out = "user_id bigint, status string, event_id bigint"
    return events.select("user_id", "ts", "event_id", "event_type").groupBy("user_id").applyInPandasWithState(_newest, out, "ts bigint, event_id bigint, status string", "update", GroupStateTimeout.NoTimeout)


def merge_batch(target: str, key: list[str]):
    """A ``foreachBatch`` function that keeps the newest row of each key in a table of files, one version per batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.select("*", F.lit(batch_id).alias("version")).write.mode("overwrite").parquet(f"{target}/version={batch_id}")

    return run


def _drained(spark: SparkSession, stream: DataFrame, mode: str, name: str) -> DataFrame:
    """Everything that is there now, through the streaming engine, as a table in the shared folder."""
    at = shared_path(spark, name)
    schema = stream.schema

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/out/batch={batch_id}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    return spark.read.schema(StructType([*schema.fields, StructField("batch", IntegerType())])).parquet(f"{at}/out")


def latest_status_of(spark: SparkSession, path: str) -> DataFrame:
    out = _drained(spark, latest_status(_as_stored(spark, path)), "update", "latest-status")
    last = out.groupBy("user_id").agg(F.max_by(F.struct("status", "event_id"), "batch").alias("s"))
    return last.select("user_id", "s.status", "s.event_id")


def daily_counts_of(spark: SparkSession, path: str) -> DataFrame:
    counts = _as_stored(spark, path).groupBy(F.date_trunc("day", "ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    out = _drained(spark, counts, "complete", "daily-counts")
    newest = out.agg(F.max("batch").alias("batch"))
    return out.join(F.broadcast(newest), "batch").select("day", "event_type", "n")


def _as_stored(spark: SparkSession, path: str) -> DataFrame:
    """Streamed with the schema that the files have."""
    stored = spark.read.parquet(path).schema
    return read_events(spark, path, schema=stored)
