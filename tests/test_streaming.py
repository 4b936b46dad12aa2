import datetime as dt

from pyspark.sql import functions as F

from tidemark.streaming import triggers

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "event_id long, customer_id long, ts timestamp, event_type string"


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def batches(spark, tmp_path, parts):
    """A file stream with one micro-batch per part, read in order."""
    folder = str(tmp_path / "events")
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def test_dormancy_on_a_stream_equals_batch(spark, tmp_path):
    parts = [
        [(1, 1, at(0), "v"), (2, 2, at(1), "v"), (3, 1, at(5), "v")],
        [(4, 1, at(30), "v"), (5, 2, at(4), "v")],
        [(6, 3, at(200), "v")],
        [(7, 3, at(201), "v")],
    ]
    stream = batches(spark, tmp_path, parts)
    triggers.run_available(triggers.dormancy(stream, gap=dt.timedelta(hours=12), lateness="2 hours"), str(tmp_path))
    out = spark.read.parquet(f"{tmp_path}/out")
    got = sorted((r["customer_id"], r["last_event"], r["dormant_at"], r["events"]) for r in out.collect())
    everything = spark.createDataFrame(sum(parts, []), SCHEMA)
    spells = triggers.dormancy(everything, gap=dt.timedelta(hours=12))
    expected = triggers.dormant_by_now(spells, F.lit(at(200)))
    assert got == sorted(
        (r["customer_id"], r["last_event"], r["dormant_at"], r["events"]) for r in expected.collect()
    )
    assert got[0] == (1, at(5), at(17), 2)


def test_now_filter_does_not_split_spells(spark):
    rows = [(1, 1, at(0), "v"), (2, 1, at(8), "v")]
    spells = triggers.dormancy(spark.createDataFrame(rows, SCHEMA), gap=dt.timedelta(hours=12))
    assert triggers.dormant_by_now(spells, F.lit(at(14))).count() == 0
    assert triggers.dormant_by_now(spells, F.lit(at(20))).first()["events"] == 2


def test_follow_ups_are_sent_once(spark, tmp_path):
    parts = [
        [(1, 1, at(0), "return"), (2, 1, at(1), "view")],
        [(1, 1, at(0), "return"), (3, 2, at(2), "return")],
    ]
    stream = batches(spark, tmp_path, parts)
    triggers.run_available(triggers.return_follow_ups(stream), str(tmp_path))
    got = sorted(r["event_id"] for r in spark.read.parquet(f"{tmp_path}/out").collect())
    batch = triggers.return_follow_ups(spark.createDataFrame(sum(parts, []), SCHEMA))
    assert got == sorted(r["event_id"] for r in batch.collect()) == [1, 3]
