"""Batches by size or elapsed time: both exits, restarts, changed settings, repeated rows and nulls."""

import time
from collections import Counter
from datetime import datetime

import pytest

from skygauge.streaming import sinks
from skygauge.streaming.groups import STORE, grouped, land_groups
from skygauge.streaming.sources import file_stream

TOPIC = "key string, value string, partition bigint, offset bigint, timestamp timestamp_ntz"
HOUR = 3_600_000


class Topic:
    def __init__(self, spark, root):
        self.spark = spark
        self.feed, self.sink, self.checkpoint = (str(root / n) for n in ("feed", "sink", "checkpoint"))
        self.schema = spark.createDataFrame([], TOPIC).schema

    def send(self, partition, offsets):
        rows = [("k", None if i % 5 == 0 else f"v{i}", partition, i, datetime(2024, 6, 15, 1, 2, 3, 456789)) for i in offsets]
        self.spark.createDataFrame(rows, TOPIC).coalesce(1).write.mode("append").parquet(self.feed)

    def start(self, size, delay_ms, trigger=sinks.ONCE, max_files=None):
        return land_groups(file_stream(self.spark, self.schema, self.feed, max_files=max_files), self.sink, self.checkpoint, trigger, size, delay_ms)

    def run(self, *args, **options):
        self.start(*args, **options).awaitTermination()

    def rows(self):
        return self.spark.read.parquet(f"{self.sink}/rows").collect()

    def log(self):
        return sorted((r.key, r.group, r.closed_by, r.records) for r in self.spark.read.parquet(f"{self.sink}/log").collect())


def test_full_groups_leave_and_the_rest_waits_over_restarts(spark, tmp_path):
    t = Topic(spark, tmp_path)
    t.send(0, range(7))
    t.send(1, range(100, 102))
    t.run(3, HOUR)
    assert t.log() == [(0, 0, "size", 3), (0, 1, "size", 3)]  # one row of 0 and two of 1 wait in the state
    t.send(0, range(7, 9))
    t.run(3, HOUR, max_files=1)
    assert t.log()[2:] == [(0, 2, "size", 3)]
    assert sorted(r.offset for r in t.rows()) == list(range(9))
    t.run(3, HOUR)  # a run without new messages
    assert len(t.log()) == 3


def test_waiting_rows_leave_by_the_timer(spark, tmp_path):
    t = Topic(spark, tmp_path)
    t.send(0, range(10))
    t.send(1, range(100, 103))
    query = t.start(4, 1500, {"processingTime": "200 milliseconds"})
    try:
        end = time.monotonic() + 90
        while time.monotonic() < end:
            if len(t.log() if query.lastProgress else []) == 4:
                break
            assert query.exception() is None
            time.sleep(0.3)
    finally:
        query.stop()
    assert t.log() == [(0, 0, "size", 4), (0, 1, "size", 4), (0, 2, "time", 2), (1, 0, "time", 3)]
    rows = t.rows()
    assert all(r.waited_ms >= 1500 for r in rows if r.closed_by == "time") and Counter(r.offset for r in rows) == Counter([*range(10), 100, 101, 102])
    assert all(r.value == (None if r.offset % 5 == 0 else f"v{r.offset}") and r.timestamp == datetime(2024, 6, 15, 1, 2, 3, 456789) for r in rows)


def test_a_shorter_delay_counts_from_the_first_row(spark, tmp_path):
    t = Topic(spark, tmp_path)
    t.send(0, [1, 1])  # repeated messages are messages
    t.run(5, HOUR)
    t.send(0, [2])
    t.run(5, 0)
    assert t.log() == [(0, 0, "time", 3)] and sorted(r.offset for r in t.rows()) == [1, 1, 2]
    t.send(0, range(3, 8))
    t.run(5, HOUR)
    assert t.log()[1:] == [(0, 1, "size", 5)]


def test_settings(spark, tmp_path):
    stream = file_stream(spark, spark.createDataFrame([], TOPIC).schema, str(tmp_path))
    for size, delay in ((0, 1), (1, -1)):
        with pytest.raises(ValueError):
            grouped(stream, size, delay)
    with pytest.raises(ValueError, match="closed_by"):
        grouped(stream.withColumnRenamed("value", "closed_by"), 1, 1)
    assert "RocksDB" not in (spark.conf.get(STORE, "") or "")
