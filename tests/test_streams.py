"""Streams: restarts, repeated batches, late and duplicate rows."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skygauge.streaming import sinks
from skygauge.streaming.sources import file_stream

TOPIC = "key string, value string, partition bigint, offset bigint, timestamp timestamp_ntz"
EVENT = "id bigint, District string, fetch_time timestamp_ntz, max_temp double, min_temp double, precipitation double, humidity double"


class Feed:
    def __init__(self, spark, root, schema):
        self.spark, self.schema = spark, schema
        self.feed, self.sink, self.checkpoint = (str(root / n) for n in ("feed", "sink", "checkpoint"))

    def send(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.feed)

    def run(self, start, max_files=None, **options):
        schema = self.spark.createDataFrame([], self.schema).schema
        query = start(file_stream(self.spark, schema, self.feed, max_files=max_files), self.sink, self.checkpoint, trigger=sinks.ONCE, **options)
        query.awaitTermination()
        return query


def message(i, **changes):
    body = {"District": f"D{i % 2}", "Date": "2024-06-15", "MaxTemp_2m": 30.0 + i, "timestamp": f"2024-06-15T00:00:{i:02d}", **changes}
    return ("k", json.dumps({k: v for k, v in body.items() if v is not None}), 0, i, datetime(2024, 6, 15))


def event(i, hours, temp=30.0, district="A"):
    return (i, district, datetime(2024, 1, 1) + timedelta(hours=hours), temp, 10.0, 1.0, 50.0)


def test_landing_restarts_without_repeating(spark, tmp_path):
    f = Feed(spark, tmp_path, TOPIC)
    for k in range(3):
        f.send([message(3 * k + j) for j in range(3)] + [("k", "{broken", 0, 90 + k, None)])
    query = f.run(sinks.land, max_files=1)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    f.run(sinks.land)
    assert spark.read.parquet(f"{f.sink}/rows").count() == 9
    f.send([message(9)])
    f.run(sinks.land)
    rows = spark.read.parquet(f"{f.sink}/rows")
    assert rows.count() == 10 and rows.filter("ingestion_time is null").count() == 0
    assert len(list((tmp_path / "sink" / "rows").glob("Date=2024-06-15/District=D*"))) == 2
    rejected = spark.read.parquet(f"{f.sink}/rejected")  # every message is landed or rejected
    assert sorted(r.kafka_offset for r in rejected.collect()) == [90, 91, 92] and rejected.filter("raw_value = '{broken'").count() == 3


def test_landing_drops_duplicates(spark, tmp_path):
    f = Feed(spark, tmp_path, TOPIC)
    f.send([message(1), message(1), message(2)])
    f.run(sinks.land, dedupe=True)
    f.send([message(2), message(3, timestamp="2020-01-01T00:00:00")])  # a repeat, and a message years late
    f.run(sinks.land, dedupe=True)
    assert spark.read.parquet(f"{f.sink}/rows").count() == 3
    f.send([message(2), message(4, Date="2024-06-16"), message(4, Date="2024-06-17")])
    f.run(sinks.land, dedupe=True)
    assert spark.read.parquet(f"{f.sink}/rows").count() == 5
    touched = sinks._held(spark, f.sink, spark.sql("SELECT DATE '2024-06-16' AS Date UNION ALL SELECT DATE '2024-06-17'"))
    assert touched.count() == 2
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "Date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sinks._held(spark, f.sink, spark.sql("SELECT DATE '2024-06-16' AS Date WHERE false")).count() == 0


def test_a_failing_batch_leaves_a_line_and_is_repeated(spark, tmp_path):
    f = Feed(spark, tmp_path, TOPIC)
    f.send([message(0), message(1)])

    def refuse(parsed):
        raise ValueError("store is down")
    with pytest.raises(Exception, match="store is down"):
        f.run(sinks.land, expect=refuse)
    assert [(r.batch_id, r.status) for r in spark.read.parquet(f"{f.sink}/log").collect()] == [(0, "failed: ValueError")]
    f.run(sinks.land)
    line = spark.read.parquet(f"{f.sink}/log").first()
    assert (line.batch_id, line.status, line.records, line.rejected) == (0, "success", 2, 0) and line.rows_per_second > 0
    assert spark.read.parquet(f"{f.sink}/rows").count() == 2


def test_small_tables_keep_a_few_versions(spark, tmp_path):
    f = Feed(spark, tmp_path, EVENT)
    for k in range(7):
        f.send([event(k, k, 30.0 + k)])
    f.run(sinks.running, max_files=1)
    assert len(list((tmp_path / "sink").glob("slot=*"))) <= sinks.KEPT_VERSIONS
    newest = sinks.newest_version(spark, f.sink).collect()
    assert [(r.District, r.fetches, r.last_temp) for r in newest] == [("A", 7, 36.0)]


def test_an_upserted_batch_is_computed_once(spark, tmp_path):
    from skygauge.sources.zones import upsert
    seen = spark.sparkContext.accumulator(0)

    def tap(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    schema = "k bigint, v bigint, part bigint"
    upsert(spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 1)], schema), str(tmp_path / "t"), ["k", "part"], ["v"], ["part"], "v")
    updates = spark.createDataFrame([(1, 2, 0), (4, 2, 0), (2, 0, 0)], schema).mapInArrow(tap, schema)
    upsert(updates, str(tmp_path / "t"), ["k", "part"], ["v"], ["part"], "v")
    assert seen.value == 3
    got = sorted((r.k, r.v, r.part) for r in spark.read.parquet(str(tmp_path / "t")).collect())
    assert got == [(1, 2, 0), (2, 1, 0), (3, 1, 1), (4, 2, 0)]  # an older version of key 2 does not replace the stored one


def test_batch_log_and_quarantine(spark, tmp_path):
    f = Feed(spark, tmp_path, TOPIC)
    f.send([message(0), message(1), message(2, District=None)])
    f.run(sinks.land_batches)
    log = spark.read.parquet(f"{f.sink}/log").first()
    assert (log.batch_id, log.source, log.records, log.rejected, log.status) == (0, "topic", 2, 1, "success") and log.duration_ms >= 0
    assert spark.read.parquet(f"{f.sink}/rejected").first().raw_value.startswith("{")


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    from skygauge.sources.zones import replace_partitions
    path = str(tmp_path / "rows")
    for n, batch in ((2, 0), (3, 1), (3, 1)):
        replace_partitions(spark.range(n).withColumn("batch_id", F.lit(batch)), path, ["batch_id"])
    assert spark.read.parquet(path).count() == 5


def test_hourly_adds_late_rows_to_their_hours(spark, tmp_path):
    f = Feed(spark, tmp_path, EVENT)
    f.send([event(1, 0.1), event(2, 0.2)])
    f.run(sinks.hourly)
    f.send([event(3, 0.3, temp=41.0), event(4, 72)])
    f.run(sinks.hourly)
    f.send([event(5, 0.4), event(6, 72.5)])  # the first is three days late
    f.run(sinks.hourly)
    got = {r.hour_bucket: (r.record_count, r.heatwave_alerts) for r in spark.read.parquet(f"{f.sink}/hours").collect()}
    assert got == {datetime(2024, 1, 1): (4, 1), datetime(2024, 1, 4): (2, 0)}
    assert [(r.id, r.batch_id) for r in spark.read.parquet(f"{f.sink}/late").collect()] == [(5, 2)]
    assert [(r.records, r.late) for r in spark.read.parquet(f"{f.sink}/log").orderBy("batch_id").collect()] == [(2, 0), (2, 0), (1, 1)]


def test_a_repeated_hourly_batch_counts_once(spark, tmp_path, monkeypatch):
    """The second batch fails after its hours are written; it runs again from the state before it."""
    f = Feed(spark, tmp_path, EVENT)
    f.send([event(1, 0.1), event(2, 5)])
    f.run(sinks.hourly)
    f.send([event(3, 0.2, temp=41.0), event(4, 0.3)])
    write = sinks.replace_partitions

    def failing(df, path, by):
        write(df, path, by)
        if path.endswith("hours"):
            raise ValueError("lost")
    monkeypatch.setattr(sinks, "replace_partitions", failing)
    with pytest.raises(Exception, match="lost"):
        f.run(sinks.hourly)
    monkeypatch.setattr(sinks, "replace_partitions", write)
    f.run(sinks.hourly)
    got = {r.hour_bucket.hour: (r.record_count, r.heatwave_alerts, r.batch_id) for r in spark.read.parquet(f"{f.sink}/hours").collect()}
    assert got == {0: (3, 1, 1), 5: (1, 0, 0)}


def test_running_totals_and_last_rows(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    totals, last = Feed(spark, tmp_path / "a", EVENT), Feed(spark, tmp_path / "b", EVENT)
    for f in (totals, last):
        f.send([event(i, i, temp=30.0 + i) for i in range(5)])
        f.run(sinks.running if f is totals else sinks.last_rows, **({} if f is totals else {"n": 3}))
        f.send([event(9, 9, temp=50.0)])
        f.run(sinks.running if f is totals else sinks.last_rows, **({} if f is totals else {"n": 3}))
    row = sinks.newest_version(spark, totals.sink).first()
    assert (row.fetches, row.last_temp, row.heatwave_alerts) == (6, 50.0, 1)
    assert sorted(r.id for r in sinks.newest_version(spark, last.sink).collect()) == [3, 4, 9]


def test_scoring_writes_both_tables(spark, tmp_path):
    f = Feed(spark, tmp_path, EVENT)
    f.send([event(1, 0, temp=50.0), event(2, 1)])
    f.run(sinks.score_messages)
    assert spark.read.parquet(f"{f.sink}/observations").count() == 2
    assert {(r.id, r.heatwave_risk) for r in spark.read.parquet(f"{f.sink}/predictions").collect()} == {(1, "HIGH"), (2, "LOW")}


@pytest.mark.parametrize("per, ids", [((), [8, 9]), (("District",), [5, 7, 8, 9])])
def test_last_rows_per_district(spark, tmp_path, per, ids):
    f = Feed(spark, tmp_path, EVENT)
    f.send([event(i, i, district="AB"[i >= 8]) for i in (1, 3, 5, 7, 8, 9)])
    f.run(sinks.last_rows, n=2, per=per)
    assert sorted(r.id for r in sinks.newest_version(spark, f.sink).collect()) == ids
