"""Structured Streaming: windows, de-duplication, last values, compaction."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def events(spark: SparkSession, path: str, schema, files: int = 1) -> DataFrame:
    """Stream of event files; ``ts`` becomes a timestamp that watermarks take."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_counts(stream: DataFrame, width: str = "10 minutes", late: str = "15 minutes") -> DataFrame:
    return stream.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def deduplicated(stream: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def last_values(stream: DataFrame) -> DataFrame:
    """Last signal of each user, and last signal with a value."""
    known = F.when(F.col("value").isNotNull(), F.struct("ts", "event_id"))
    return stream.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"), F.max_by("value", known).alias("last_value"))


def last_arrivals(stream: DataFrame, kept: str = "NoTimeout") -> DataFrame:
    """(user_id, last_type, last_value, signals) of each user whose signals came in, in update mode: the signal that arrived last, whatever its own time, and the last one that
    had a value, kept when later ones have none.

    Within a batch signals arrive in the order of ``arrived`` and event_id; later batches arrive later. The state of a user is three fields. With
    ``kept`` = ``ProcessingTimeTimeout`` a user that is silent for a day is forgotten. Null users share one state.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def take(key, frames, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        last, value, n = state.get if state.exists else (None, None, 0)
        # a group of one batch may come in several frames; the latest arrival over all of them counts
        newest = newest_known = None
        for frame in frames:
            n += len(frame)
            for row in frame.itertuples(index=False):
                at = (row.arrived, row.event_id)
                if newest is None or at > newest:
                    newest, last = at, row.event_type
                if row.value == row.value and row.value is not None and (newest_known is None or at > newest_known):
                    newest_known, value = at, row.value
        state.update((last, value, n))
        if kept != "NoTimeout":
            state.setTimeoutDuration(24 * 3600 * 1000)
        yield pd.DataFrame({"user_id": [key[0]], "last_type": [last], "last_value": [value], "signals": [n]})

    timeout = getattr(GroupStateTimeout, kept)
    return stream.select("user_id", "arrived", "event_id", "event_type", "value").groupBy("user_id").applyInPandasWithState(
        take, "user_id long, last_type string, last_value double, signals long", "last_type string, last_value double, signals long", "update", timeout
    )


def run_once(df: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Everything available now, into a table in memory (for tests and small results)."""
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.table(name)
