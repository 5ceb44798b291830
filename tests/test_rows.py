"""Parsing, cleaning, rules, merging and serving on a few hand-made rows."""

import json
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from skygauge import schemas
from skygauge.functions import rules as R
from skygauge.operators import cleaning as C, learning as M, serving as V, sets as U, summaries as A
from skygauge.plans import storage
from skygauge.sources import files, messages as S, zones
from skygauge.store import read_first, read_if_present


def topic(spark, *values):
    return spark.createDataFrame([("k", v, 0, i) for i, v in enumerate(values)], "key string, value string, partition int, offset bigint")


def test_malformed_messages_are_kept_for_repair(spark):
    good = json.dumps({"District": "Bara", "Date": "2024-06-15", "MaxTemp_2m": 42.5})
    raw = topic(spark, good, good[:20], json.dumps({"Date": "2024-06-15"}), json.dumps({"District": "Bara", "Date": "soon"}))
    parsed = S.parse_messages(raw)
    assert [(r.kafka_offset, r.MaxTemp_2m) for r in S.accepted(parsed).collect()] == [(0, 42.5)]
    assert sorted(r.raw_value[:9] for r in S.quarantined(parsed).collect()) == sorted([good[:9], '{"Date": ', '{"Distric'])


def test_submission_defaults(spark):
    row = ("Bara", "2024-06-15", None, None, 30.0, 0.0, 0.0, 5.0, 75.0, 3.5, None, None)
    m = S.canonicalize(spark.createDataFrame([row], schemas.SUBMISSION), F.lit("now")).first()
    assert (m.MinTemp_2m, m.TempRange_2m, m.Latitude, m.Longitude, m.WindSpeed_50m, m.timestamp, m.source) == (20.0, 10.0, 27.0, 85.0, 0.0, "now", "api")
    assert set(m.asDict()) == {f.name for f in schemas.MESSAGE.fields}


def test_required_fields(spark):
    row = (None, "2024-06-15", None, None, None, None, None, 5.0, 75.0, None, None, None)
    assert S.check_required(spark.createDataFrame([row], schemas.SUBMISSION)).first().missing == ["district", "max_temp"]


def test_empty_weather_document(spark):
    w = S.flatten_weather(spark.createDataFrame([("Bara", "{}")], "city string, value string")).first()
    assert (w.city_name, w.temperature, w.temp_range, w.humidity, w.pressure, w.precipitation) == ("Bara", 0.0, 0.0, 50.0, 1013.0, 0.0)
    assert (w.visibility_km, w.weather_main, w.sunrise, w.latitude) == (10.0, "N/A", "N/A", 27.0)


@pytest.mark.parametrize("rain, daily", [({"1h": 2.0, "3h": 5.0}, 48.0), ({"1h": 0.0, "3h": 5.0}, 40.0), ({"3h": 5.0}, 40.0), ({}, 0.0)])
def test_daily_rain_estimate(spark, rain, daily):
    doc = json.dumps({"rain": rain, "weather": []})
    assert S.flatten_weather(spark.createDataFrame([("x", doc)], "city string, value string")).first().precipitation == daily


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) if v is not None else F.lit(None).cast("double").alias(k) for k, v in values.items()]).select(column).first()[0]


def test_linear_rule_boundary(spark):
    t, p, h = F.col("t"), F.col("p"), F.col("h")
    at = dict(t=42.0, p=75.0, h=85.0)
    assert one(spark, R.heat_score_linear(t), **at) == pytest.approx(7 / 15)
    assert one(spark, R.risk_level(R.heat_score_linear(t)), **at) == "MEDIUM"
    assert one(spark, R.risk_level(R.flood_score_linear(p, h)), **at) == "LOW"  # exactly 0.30
    assert one(spark, R.heat_score_linear(t), t=20.0) == 0.0 and one(spark, R.heat_score_linear(t, clamp=False), t=20.0) == -1.0
    assert one(spark, R.heat_score_linear(t), t=None) is None


@pytest.mark.parametrize("temp, score", [(60.0, 1.0), (41.0, 0.75), (36.0, 0.4), (32.0, 0.1), (10.0, 0.0)])
def test_banded_heat(spark, temp, score):
    assert one(spark, R.heat_score_bands(F.col("t")), t=temp) == pytest.approx(score)


@pytest.mark.parametrize("rain, humidity, score", [(200.0, 95.0, 1.0), (60.0, 85.0, 0.6), (30.0, 50.0, 0.3), (0.0, 95.0, 0.2)])
def test_banded_flood(spark, rain, humidity, score):
    assert one(spark, R.flood_score_bands(F.col("p"), F.col("h")), p=rain, h=humidity) == pytest.approx(score)


def test_five_bands_include_their_bound(spark):
    assert [one(spark, R.risk_level_five(F.col("x"))["level"], x=x) for x in (0.8, 0.6, 0.4, 0.2, 0.1)] == [
        "EXTREME RISK", "HIGH RISK", "MODERATE RISK", "LOW RISK", "MINIMAL RISK"]


def events(spark, *rows):
    return spark.createDataFrame([(i, d, datetime.fromisoformat(t), temp, rain) for i, (d, t, temp, rain) in enumerate(rows)],
                                 "id bigint, District string, fetch_time timestamp_ntz, max_temp double, precipitation double")


def test_both_alerts_fire(spark):
    got = A.alerts(events(spark, ("A", "2024-01-01 00:00:00", 46.0, 151.0), ("A", "2024-01-02 00:00:00", 40.0, None))).collect()
    assert sorted((r.alert_type, r.severity, r.message) for r in got) == [
        ("FLOOD_RISK", "HIGH", "Heavy precipitation: 151.0mm"), ("HEATWAVE", "HIGH", "Extreme temperature: 46.0°C")]


def test_coercion_and_rejects(spark):
    text = "District string, Date string, " + ", ".join(f"{c} string" for c in C.MEASURES)
    rest = ["1"] * (len(C.MEASURES) - 1)
    df = spark.createDataFrame([(None, "2024-01-02 05:00", None, *rest), ("A", "no", "1", *rest), ("A", "2024-01-02", "wet", *rest)], text)
    kept = C.coerce_rows(df).collect()
    assert [(r.District, r.Date, r.year, r[C.MEASURES[0]]) for r in kept] == [("Unknown", date(2024, 1, 2), 2024, 0.0)]
    assert C.rejects(df).count() == 2


def test_impute_everything_not_finite(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (2.0,)], "x double")
    assert sorted(r.x for r in C.impute(df, 0.0).collect()) == [0.0, 0.0, 0.0, 0.0, 2.0]


def test_missing_date_column(spark):
    with pytest.raises(ValueError):
        C.parse_dates(spark.createDataFrame([(1,)], "x int"))


def test_merge_prefers_stream_then_newest(spark):
    hist = spark.createDataFrame([("A", date(2024, 1, 1), 1.0, "x"), ("B", date(2024, 1, 1), 2.0, "x")], "District string, Date date, Precip double, only_here string")
    t = [datetime(2024, 1, d) for d in (1, 2)]
    strm = spark.createDataFrame([("A", "2024-01-01", 5.0, t[0]), ("A", "2024-01-01", 6.0, t[1])], "District string, Date string, Precip double, ingestion_time timestamp_ntz")
    got = U.merge_zones(hist, strm).orderBy("District").collect()
    assert [tuple(r) for r in got] == [("A", date(2024, 1, 1), 6.0), ("B", date(2024, 1, 1), 2.0)]
    assert U.merge_zones(hist, None).count() == 2 and U.union_common(hist, None).columns == hist.columns


def test_standardize_uses_population_sigma(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    assert sorted(tuple(r) for r in M.standardize(df, df, ["x", "c"]).collect()) == [(-1.0, 0.0), (1.0, 0.0)]


def test_class_weight_never_below_one(spark):
    rows = M.weighted(spark.createDataFrame([(1,), (1,), (0,)], "y int"), "y").collect()
    assert {r.weight for r in rows} == {1.0}


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    def rows(*r):
        return spark.createDataFrame(r, "District string, at int, v int, seen int")
    args = dict(key=["District", "at"], newest=["seen"], by=["District"], time="at")
    zones.upsert(rows(("A", 1, 1, 1), ("B", 1, 1, 1)), path, **args)
    untouched = {f for f in (tmp_path / "t" / "District=B").glob("*.parquet")}
    zones.upsert(rows(("A", 1, 2, 2), ("A", 2, 9, 2)), path, **args)
    zones.upsert(rows(("A", 1, 0, 0)), path, **args)  # older than what is stored
    got = {(r.District, r.at): r.v for r in spark.read.parquet(path).collect()}
    assert got == {("A", 1): 2, ("A", 2): 9, ("B", 1): 1}
    assert untouched == {f for f in (tmp_path / "t" / "District=B").glob("*.parquet")}


def test_station_files(spark, tmp_path):
    for name in ("Zeta", "Alpha One"):
        (tmp_path / f"{name}.csv").write_text(" Date ,MaxTemp_2m, Precip\n2024-01-01,30.5,\n2024-01-02,31.5,2\n")
    got = files.read_station_folder(spark, str(tmp_path)).orderBy("station_id", "Date").collect()
    assert [(r.District, r.station_id, r.Date.day, r.MaxTemp_2m, r.Precip) for r in got] == [
        ("Alpha One", "WS-001", 1, 30.5, None), ("Alpha One", "WS-001", 2, 31.5, 2.0), ("Zeta", "WS-002", 1, 30.5, None), ("Zeta", "WS-002", 2, 31.5, 2.0)]


def test_json_batches_hold_at_most_n(spark, tmp_path):
    files.write_json_batches(spark.range(250).coalesce(1), str(tmp_path / "j"), 100)
    sizes = sorted(len(f.read_text().splitlines()) for f in (tmp_path / "j").glob("*.json"))
    assert sizes == [50, 100, 100]


def test_json_batches_are_written_by_many_tasks(spark, tmp_path):
    spark.range(20_000).select(F.col("id").alias("event_id"), F.col("id").alias("user_id"), F.lit("a").alias("event_type"), F.lit(1.5).alias("value"),
                               F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    rows = storage.json_batches(spark, str(tmp_path))
    paths = rows.inputFiles()
    sizes = [r["n"] for r in rows.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert rows.select("id").distinct().count() == sum(sizes) == 20_000 and max(sizes) == 100 and len(sizes) == len(paths)
    assert len({re.search(r"part-(\d+)", p)[1] for p in paths}) == 4 * spark.sparkContext.defaultParallelism


def test_zone_fallback(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "features"))
    assert read_if_present(spark, str(tmp_path / "labeled")) is None
    assert read_first(spark, str(tmp_path / "labeled"), str(tmp_path / "features")).count() == 3
    with pytest.raises(FileNotFoundError):
        read_first(spark, str(tmp_path / "labeled"))


def test_top_k_limits_before_the_shuffle(spark):
    df = events(spark, *[("A", f"2024-01-01 00:00:{s:02d}", 1.0, 1.0) for s in range(60)])
    top = V.top_per_district(df, "fetch_time", 50, tie=["id"])
    assert [r.id for r in top.collect()] == list(range(59, 49, -1))
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_latest_and_best_model(spark):
    rows = [("A", date(2024, 1, d), m, "heatwave", p, "LOW") for d, m, p in ((1, "rule", 0.1), (2, "rule", 0.2), (1, "lstm", 0.3))]
    latest = V.latest_per(spark.createDataFrame(rows, "District string, Date date, model string, target string, probability double, risk string"), ["District", "model", "target"], "Date")
    assert {(r.model, r.probability) for r in latest.collect()} == {("rule", 0.2), ("lstm", 0.3)}
    assert V.best_model(latest).first().model == "LSTM"
    assert V.prediction_pivot(latest).first().risk == "UNKNOWN"
    doc = json.loads(V.serving_document(latest).first().document)
    assert set(json.loads(doc["heatwave"])) == {"rule", "lstm"}


def test_store_stats_show_empty_districts(spark):
    some = spark.createDataFrame([("A",), ("A",)], "District string")
    listed = spark.createDataFrame([("A",), ("B",)], "District string")
    got = {r.District: (r.observations, r.predictions, r.monitored) for r in A.store_stats(some, some, listed).collect()}
    assert got == {"A": (2, 2, 1), "B": (0, 0, 0), None: (2, 2, 1)}


def test_empty_inputs(spark):
    nothing = events(spark, ("A", "2024-01-01 00:00:00", 1.0, 1.0)).filter("false")
    assert A.alerts(nothing).count() == 0 and A.ingest_counter(nothing).count() == 0
    assert V.recent_summary(nothing, "fetch_time").first().records == 0


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    from skygauge.sources.files import read_station_folder, read_csv_text, uncastable
    (tmp_path / "North Hill.csv").write_text("Date,MaxTemp_2m,Precip\n2024-01-01,31.5,2\n2024-01-02,bad,3\n")
    (tmp_path / "a+b.csv").write_text("Precip,Date,MaxTemp_2m\n2,2024-01-01,40\n")
    (tmp_path / "c.csv").write_text("Date,RH_2m,Extra\n2024-01-01,55,x\n")
    got = {(r.District, str(r.Date)): r for r in read_station_folder(spark, str(tmp_path)).collect()}
    assert (got["North Hill", "2024-01-01"].MaxTemp_2m, got["North Hill", "2024-01-01"].Precip, got["North Hill", "2024-01-01"].station_id) == (31.5, 2.0, "WS-001")
    assert (got["a+b", "2024-01-01"].MaxTemp_2m, got["a+b", "2024-01-01"].Precip, got["a+b", "2024-01-01"].station_id) == (40.0, 2.0, "WS-002")
    assert (got["c", "2024-01-01"].MaxTemp_2m, got["c", "2024-01-01"].RH_2m, got["c", "2024-01-01"].Extra) == (None, 55.0, "x")
    assert [(r.Date, r.rejected) for r in uncastable(read_csv_text(spark, str(tmp_path))).collect()] == [("2024-01-02", ["MaxTemp_2m"])]


def test_csv_headers_of_many_layouts_are_read_in_one_scan(spark, tmp_path):
    from skygauge.sources.files import read_csv_text
    (tmp_path / "1.csv").write_text("\ufeffDate, Rain ,\"a,b\"\n2024-01-01,1,\"x,y\"\nDate,Rain,z\n")  # a row that looks like a header is a row
    (tmp_path / "2.csv").write_text("\n rain,Date\r\n2,2024-01-02\r\n3\r\n")  # a blank line first, another spelling, a short row
    (tmp_path / "3.csv").write_text("k,,k\n1,2,3,4\n")  # repeated and empty names, a row that is too long
    (tmp_path / "4.csv").write_text("Date,Rain\n")
    (tmp_path / "5.csv").write_text("")
    rows = read_csv_text(spark, str(tmp_path))
    assert rows.columns == ["rain", "Date", "a,b", "k0", "_c1", "k2", "_file"]  # by header line, the first spelling counts
    got = sorted(((r._file[-5], r.Date, r.rain, r["a,b"], r.k0, r["_c1"], r.k2) for r in rows.collect()), key=str)
    none = (None,) * 3
    assert got == sorted([("1", "2024-01-01", "1", "x,y", *none), ("1", "Date", "Rain", "z", *none), ("2", "2024-01-02", "2", None, *none),
                          ("2", None, "3", None, *none), ("3", None, None, None, "1", "2", "3")], key=str)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("csv") == 1 and "Union" not in plan
    (tmp_path / "none").mkdir()
    assert read_csv_text(spark, str(tmp_path / "none")).count() == 0


def test_equal_times_take_the_smallest_tie(spark):
    from skygauge.operators.serving import latest_per, newest
    rows = spark.createDataFrame([("A", 2, 5), ("A", 1, 5), ("A", 0, 4)], "District string, id bigint, t bigint")
    assert latest_per(rows, ["District"], "t", "id").first().id == newest(rows, "t", 1, ["id"]).first().id == 1


def test_antecedent_rain_of_a_dense_panel(spark):
    from datetime import datetime, timedelta
    from skygauge.operators.features import add_api
    start = datetime(2023, 1, 1)
    rain = [float((7 * i) % 11) if i % 5 else None for i in range(3000)]
    df = spark.createDataFrame([("A", start + timedelta(hours=i), x) for i, x in enumerate(rain)], "District string, Date timestamp_ntz, Precip double")
    for decay in (0.8, 0.999):
        got, state = [r.API for r in add_api(df, decay).orderBy("Date").collect()], 0.0
        for value, x in zip(got, rain):
            state = decay * state + (x or 0.0)
            assert value == pytest.approx(state, abs=2e-6)
