"""Gap-based sessions on a stream: the streaming twin of ``gap_groups``.

Batch ``gap_groups`` numbers sessions per user with ``cumsum(gap >= 12 h)``.
On a stream :func:`session_stream` summarises the same sessions with
``session_window(ts, gap)``, and :func:`numbered_sessions` gives every event its
session's number: a user's state is the last numbered event and the events that the
watermark has not passed; an event-time timer wakes the user when it does.  The
watermark bounds the state in both.  The source is a folder of parquet files (new
files are new events); the sink is chosen by the caller.  Checkpoints go to the
shared checkpoint folder.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.session import ensure_checkpoint_dir

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def session_stream(events: DataFrame, gap: str = "12 hours", watermark: str = "1 day") -> DataFrame:
    """Per-user sessions of a streaming (or batch) event frame: start, end, number of events, total value."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return (e.withWatermark("ts", watermark)
            .groupBy("user_id", F.session_window("ts", gap).alias("session"))
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("value"),
                 F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")))


NUMBERED = "user_id bigint, event_id bigint, ts timestamp, session bigint"
_STATE = "pending_ts array<bigint>, pending_id array<bigint>, last bigint, session bigint"


def numbered_sessions(events: DataFrame, gap_hours: float = 12, watermark: str = "1 day") -> DataFrame:
    """``user_id, event_id, ts, session`` for every event once the watermark has passed it, numbered from 0 as ``gap_groups`` does.

    Events may come in any order within the watermark; later ones are dropped, as Spark does.  Events of one user and time follow
    their ids.  Events without a user or a time are left out.
    """
    gap = int(gap_hours * 3600 * 1_000_000)

    def number(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        pending_ts, pending_id, last, session = state.get if state.exists else ([], [], None, 0)
        ts, ids = [np.array(pending_ts, np.int64)], [np.array(pending_id, np.int64)]
        for b in batches:
            ts.append(b["us"].to_numpy(np.int64))
            ids.append(b["event_id"].to_numpy(np.int64))
        ts, ids = np.concatenate(ts), np.concatenate(ids)
        passed = state.getCurrentWatermarkMs()
        ready = ts <= passed * 1000  # no earlier event can come any more
        order = np.lexsort((ids[ready], ts[ready]))
        done_ts, done_id = ts[ready][order], ids[ready][order]
        numbers = np.zeros(0, np.int64)
        if len(done_ts):
            before = np.concatenate([[done_ts[0] if last is None else last], done_ts[:-1]])
            numbers = session + np.cumsum(done_ts - before >= gap)
            last, session = int(done_ts[-1]), int(numbers[-1])
        wait_ts, wait_id = ts[~ready], ids[~ready]
        state.update((wait_ts.tolist(), wait_id.tolist(), last, session))
        if len(wait_ts):
            state.setTimeoutTimestamp(max(int(wait_ts.min()) // 1000, passed) + 1)
        yield pd.DataFrame({"user_id": np.full(len(numbers), key[0], np.int64), "event_id": done_id,
                            "ts": pd.to_datetime(done_ts, unit="us"), "session": numbers})

    e = events.withColumn("ts", F.col("ts").cast("timestamp")).where("user_id IS NOT NULL AND ts IS NOT NULL")
    e = e.withWatermark("ts", watermark).select("user_id", "event_id", "ts", F.unix_micros("ts").alias("us"))
    return e.groupBy("user_id").applyInPandasWithState(number, NUMBERED, _STATE, "append", "EventTimeTimeout")


def read_events_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 100) -> DataFrame:
    return (spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def run_to_table(spark: SparkSession, stream: DataFrame, name: str, output_mode: str = "complete"):
    """Drive a stream over all available input into a queryable in-memory table (tests, small runs)."""
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{name}"
    q = (stream.writeStream.outputMode(output_mode).format("memory").queryName(name)
         .option("checkpointLocation", ckpt).start())
    q.processAllAvailable()
    q.stop()
    return spark.table(name)
