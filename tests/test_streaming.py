"""Streaming sessions agree with the batch gap-based session numbering."""

import uuid

from pyspark.sql import functions as F

from tessera.sources.csv import scratch_path
from tessera.sources.tables import Tables
from tessera.streaming.sessions import numbered_sessions, read_events_stream, run_to_table, session_stream
from tessera.workloads import load_all


def test_stream_sessions_match_batch(spark, sf_dir):
    stream = session_stream(read_events_stream(spark, f"{sf_dir}/event[s].parquet"), gap="12 hours")
    out = run_to_table(spark, stream, f"sessions_{uuid.uuid4().hex[:8]}")
    per_user = {r["user_id"]: r["n"] for r in out.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    batch = load_all()["gap_groups"].fn(Tables(spark, sf_dir))
    want = {r["user_id"]: r["n"] for r in batch.groupBy("user_id").agg((F.max("session") + 1).alias("n")).collect()}
    assert per_user == want
    assert out.agg(F.sum("n_events")).first()[0] == spark.read.parquet(f"{sf_dir}/events.parquet").count()


def test_numbers_equal_the_batch_query_when_events_come_out_of_order(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    late = F.pmod(F.xxhash64("event_id"), F.lit(12 * 3600))  # up to twelve hours, within the watermark of a day
    arrival = F.unix_seconds(F.col("ts").cast("timestamp")) + late
    ends = events.agg(F.min(arrival).alias("a"), F.max(arrival).alias("b")).first()
    files = 6
    part = F.least(F.floor((arrival - ends["a"]) / (ends["b"] - ends["a"] + 1) * files), F.lit(files - 1))
    path = scratch_path(spark, "replay")
    for i in range(files):
        events.where(part == i).coalesce(1).write.mode("append").parquet(path)
    moved = events.withColumn("part", part).agg(F.count_if(F.col("part") > 0)).first()[0]
    assert moved > 0
    end = events.limit(1).select(F.lit(-1).cast("bigint").alias("event_id"), (F.col("ts") + F.expr("INTERVAL 4000 DAYS")).alias("ts"),
                                 F.lit(-1).cast("bigint").alias("user_id"), "event_type", "value", "props")
    end.write.mode("append").parquet(path)  # a far event moves the watermark past all others
    stream = numbered_sessions(read_events_stream(spark, path, max_files_per_trigger=1))
    out = run_to_table(spark, stream, f"numbered_{uuid.uuid4().hex[:8]}", "append")
    got = {(r["user_id"], r["event_id"]): r["session"] for r in out.collect()}
    batch = load_all()["gap_groups"].fn(Tables(spark, sf_dir)).where("user_id IS NOT NULL AND ts IS NOT NULL")
    want = {(r["user_id"], r["event_id"]): r["session"] for r in batch.collect()}
    assert got == want and max(want.values()) > 0
