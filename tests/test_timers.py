import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.streaming import timers, triggers

T0 = dt.datetime(2024, 1, 1)
GAP = dt.timedelta(hours=12)
SCHEMA = "event_id long, customer_id long, ts timestamp, event_type string"


def at(hours):
    return T0 + dt.timedelta(hours=hours)


@pytest.fixture(autouse=True)
def provider(spark):
    before = spark.conf.get(timers.PROVIDER)
    yield
    spark.conf.set(timers.PROVIDER, before)


def stream(spark, folder, parts, schema=SCHEMA):
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def spells(df):
    return sorted((r["customer_id"], r["active_from"], r["last_event"], r["dormant_at"], r["events"]) for r in df.collect())


def run(spark, df, folder):
    triggers.run_available(df, folder)
    return spells(triggers.written(spark, folder, df.schema))


def test_timers_equal_the_batch(spark, tmp_path):
    rng = np.random.default_rng(4)
    hours = np.sort(rng.uniform(0, 400, 160))
    rows = [(k, int(rng.integers(1, 6)), at(float(h)), "v") for k, h in enumerate(hours)]
    parts = [rows[a : a + 40] for a in range(0, 160, 40)]
    got = run(spark, timers.timed_dormancy(stream(spark, str(tmp_path / "e"), parts), gap=GAP, lateness="2 hours"), str(tmp_path))
    whole = triggers.dormancy(spark.createDataFrame(rows, SCHEMA), gap=GAP)
    # the watermark counts whole milliseconds
    expected = spells(triggers.dormant_by_now(whole, F.lit(rows[-1][2] - dt.timedelta(hours=2))))
    assert got == expected and len(got) > 20


def test_late_events_extend_join_or_are_dropped(spark, tmp_path):
    parts = [
        [(1, 1, at(0), "v"), (2, 1, at(20), "v"), (3, 2, at(21), "v")],
        [(4, 1, at(10), "v"), (5, None, at(22), "v")],  # within the lateness: joins both spells of customer 1
        [(6, 2, at(60), "v")],
        [(7, 2, at(1), "v"), (8, 2, at(100), "v")],  # older than the watermark: dropped
        [(9, 3, at(101), "v")],
    ]
    got = run(spark, timers.timed_dormancy(stream(spark, str(tmp_path / "e"), parts), gap=GAP, lateness="15 hours"), str(tmp_path))
    assert got == [(1, at(0), at(20), at(32), 3), (2, at(21), at(21), at(33), 1), (2, at(60), at(60), at(72), 1)]


def test_a_silent_stream_ends_its_spells_by_the_clock(spark, tmp_path):
    events = stream(spark, str(tmp_path / "e"), [[(1, 1, at(0), "v"), (2, 2, at(3), "v")]])
    quiet = run(spark, timers.timed_dormancy(events, gap=GAP, lateness="1 hour"), str(tmp_path / "quiet"))
    assert quiet == []
    ticks = stream(spark, str(tmp_path / "t"), [[(at(1),)], [(at(50),)]], "now timestamp")
    timed = timers.timed_dormancy(timers.with_clock(events, ticks), gap=GAP, lateness="1 hour")
    got = run(spark, timed, str(tmp_path / "timed"))
    assert got == [(1, at(0), at(0), at(12), 1), (2, at(3), at(3), at(15), 1)]


def test_state_is_dropped_when_the_timer_fires():
    """The processor alone, on a stand-in for Spark's state."""
    import pandas as pd

    class State:
        def __init__(self):
            self.rows = None

        exists = lambda self: self.rows is not None
        get = lambda self: iter(self.rows)

        def put(self, rows):
            self.rows = list(rows)

        def clear(self):
            self.rows = None

    class Handle:
        def __init__(self):
            self.armed, self.state = set(), State()

        getListState = lambda self, *a: self.state
        listTimers = lambda self: iter(self.armed)

        def registerTimer(self, at):
            self.armed.add(at)

        def deleteTimer(self, at):
            self.armed.discard(at)

    class Clock:
        getCurrentWatermarkInMs = lambda self: max(handle.armed)

    handle, own = Handle(), timers.DormancyTimer("c", "ts", 1_000_000)
    own.init(handle)
    list(own.handleInputRows((1,), iter([pd.DataFrame({"ts": pd.to_datetime([5_000_000, 5_400_000], unit="us")})]), None))
    assert handle.armed == {6400} and len(handle.state.rows) == 1
    list(own.handleInputRows((1,), iter([pd.DataFrame({"ts": pd.to_datetime([5_900_000], unit="us")})]), None))
    assert handle.armed == {6900}
    out = list(own.handleExpiredTimer((1,), Clock(), None))
    assert out[0].events.tolist() == [3] and handle.state.rows is None and handle.armed == set()
