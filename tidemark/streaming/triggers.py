"""The two event-driven retention actions: dormancy and follow-up after a return.

Both take an event DataFrame and work the same way on a stream; dormancy also on a batch.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

DORMANT_AFTER = dt.timedelta(days=180)


def dormancy(
    events: DataFrame,
    key: str = "customer_id",
    ts: str = "ts",
    gap: dt.timedelta = DORMANT_AFTER,
    lateness: str = "1 day",
) -> DataFrame:
    """One row per customer and spell of activity that ended: no event for ``gap`` after it.

    On a stream a spell is a session window, emitted once the watermark passes its end: the moment
    the customer became dormant. The session default merges sessions before the shuffle, which
    keeps a customer with very many events cheap. A batch is handled without session windows.
    """
    known = events.where(F.col(key).isNotNull())
    if not events.isStreaming:
        return _spells(known, key, ts, gap)
    # The ends of a spell come from its events, not from the window column: that column is a
    # grouping key, and a filter on it would be moved below the merging of sessions.
    seconds = int(gap.total_seconds())
    return (
        known.withWatermark(ts, lateness)
        .groupBy(key, F.session_window(ts, f"{seconds} seconds").alias("spell"))
        .agg(
            F.min(ts).alias("active_from"),
            F.max(ts).alias("last_event"),
            (F.max(ts) + F.expr(f"INTERVAL '{seconds}' SECOND")).alias("dormant_at"),
            F.count(F.lit(1)).alias("events"),
        )
        .drop("spell")
    )


def _spells(events: DataFrame, key: str, ts: str, gap: dt.timedelta) -> DataFrame:
    """Spells of a batch.

    Events in one slice of length ``gap`` always belong to the same spell, so they are reduced to
    one row per customer and slice before the shuffle. What remains to be ordered per customer is
    at most the covered time divided by ``gap``, however many events there are.
    """
    seconds = int(gap.total_seconds())
    length = F.expr(f"INTERVAL '{seconds}' SECOND")
    slices = events.groupBy(
        key, F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)).alias("_slice")
    ).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_events")
    )
    ordered = W.partitionBy(key).orderBy("_slice")
    fresh = F.coalesce(F.col("_first") >= F.lag("_last").over(ordered) + length, F.lit(True))
    numbered = slices.withColumn("_fresh", fresh.cast("int")).withColumn(
        "_spell", F.sum("_fresh").over(ordered)
    )
    return (
        numbered.groupBy(key, "_spell")
        .agg(
            F.min("_first").alias("active_from"),
            F.max("_last").alias("last_event"),
            (F.max("_last") + length).alias("dormant_at"),
            F.sum("_events").alias("events"),
        )
        .drop("_spell")
    )


def dormant_by_now(spells: DataFrame, now) -> DataFrame:
    """Batch counterpart of the watermark: the spells that ended by ``now``."""
    return spells.where(F.col("dormant_at") <= now)


def return_follow_ups(
    events: DataFrame,
    event_id: str = "event_id",
    ts: str = "ts",
    kind: str = "event_type",
    trigger: str = "return",
    lateness: str = "1 day",
) -> DataFrame:
    """One follow-up per return event, however often the event is delivered within ``lateness``."""
    returns = events.where(F.col(kind) == trigger)
    if not events.isStreaming:
        return returns.dropDuplicates([event_id])
    return returns.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([event_id])


def written(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """What ``run_available`` wrote; a stream without output gives an empty table."""
    return spark.read.schema(schema).parquet(f"{folder}/out")


def run_available(df: DataFrame, folder: str) -> StreamingQuery:
    """Process what is there and stop; output and progress live under ``folder``."""
    # a sink that never gets a batch makes no folder
    df.sparkSession.createDataFrame([], df.schema).write.parquet(f"{folder}/out")
    query = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
