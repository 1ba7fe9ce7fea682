from __future__ import annotations

from pyspark.sql import functions as F

from perfspark.functions.ids import uuid5
from perfspark.operators.ingest import null_out_of_range
from perfspark.operators.series import daily_load, session_best
from perfspark.plans.shapes import latest
from perfspark.streaming.incremental import NewestTable, daily_stream, ingest_stream, keep_daily

ROW = "name string, day string, height string, updated_at int, seq int"


def test_ingest_stream_equals_batch(spark, tmp_path):
    """Versions arrive out of order and one batch is delivered twice."""
    src, rules = str(tmp_path / "in"), {"height": (100, 230)}
    batches = [[("a", "1", "170", 2, 1), ("b", "1", "999", 1, 1)],
               [("a", "1", "160", 1, 1), ("c", "1", "150", 1, 1)],
               [("a", "1", "170", 2, 1), ("b", "1", "999", 1, 1)],
               [("b", "1", "180", 1, 2)]]
    target = NewestTable(spark, str(tmp_path / "t"), ["row_uid"], ["updated_at", "seq"])
    for rows in batches:
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(ROW).parquet(src)
        ingest_stream(stream, target, str(tmp_path / "cp"), natural_key=["name", "day"],
                      rules=rules).awaitTermination()
    everything = spark.createDataFrame([r for b in batches for r in b], ROW)
    batch = latest(null_out_of_range(everything.withColumn("row_uid", uuid5("name", "day")), rules),
                   ["row_uid"], [F.col("updated_at"), F.col("seq")])
    got = sorted(map(str, target.read().select(*sorted(batch.columns)).collect()))
    assert got == sorted(map(str, batch.select(*sorted(batch.columns)).collect()))
    assert {(r.name, r.height) for r in target.read().collect()} == {("a", "170"), ("b", "180"), ("c", "150")}


def test_daily_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "user_id", "event_type", "ts", "value").orderBy("ts")
    target = NewestTable(spark, str(tmp_path / "t"), ["user_id", "event_type", "date"], ["n"])
    low, high = F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-11").cast("timestamp_ntz")
    parts = [events.where(F.col("ts") < low), events.where(F.col("ts") >= high),
             events.where((F.col("ts") >= low) & (F.col("ts") < high))]
    for part in parts:  # the day cut out arrives last and is far too late only without a watermark
        part.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(events.schema).parquet(src)
        daily = daily_stream(stream, keys=["user_id", "event_type"], ts="ts", value="value", late="60 days")
        keep_daily(daily, target, str(tmp_path / "cp")).awaitTermination()
    keys = ["user_id", "event_type"]
    best = session_best(events, keys=keys, day="ts").withColumnRenamed("session_date", "date")
    want = best.join(daily_load(events, keys=keys, day="ts"), [*keys, "date"]).select(
        *keys, "date", F.col("value").alias("best"), "load", "n")
    got = target.read().select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
