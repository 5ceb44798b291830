"""Serving queries: newest rows, top-k, latest per group, merged zones."""

from pyspark.sql import functions as F

from skygauge.functions import rules as R
from skygauge.operators import serving as V, sets as U
from skygauge.operators.summaries import alerts as raise_alerts, daily_summary
from skygauge.plans.registry import query
from skygauge.plans.summaries import ALERTS_SQL, EVENT_DAY, LATEST_SQL
from skygauge.plans.views import hist, obs, predictions, station_events, strm


@query("latest_n", "SELECT id, District, fetch_time, max_temp, precipitation FROM station_events WHERE District = 'D3' ORDER BY station_events.fetch_time DESC, id LIMIT 20", "station_events")
def latest_n(spark, folder):
    return V.newest(station_events(spark, folder), "fetch_time", 20, ["id"], "D3").select("id", "District", "fetch_time", "max_temp", "precipitation")


@query("recent_hours", "SELECT id, District, fetch_time, max_temp FROM station_events WHERE fetch_time >= (SELECT max(fetch_time) - INTERVAL 24 HOUR FROM station_events)", "station_events")
def recent_hours(spark, folder):
    return V.recent(station_events(spark, folder), "fetch_time", hours=24).select("id", "District", "fetch_time", "max_temp")


@query("recent_days", f"""WITH d AS (SELECT District, CAST(fetch_time AS DATE) AS date, {EVENT_DAY} FROM station_events GROUP BY 1, 2)
SELECT District, date, record_count, round(avg_temp, 1) AS avg_temp, round(max_temp, 1) AS max_temp, round(min_temp, 1) AS min_temp, heatwave_alerts, flood_alerts
FROM d WHERE date >= (SELECT CAST(max(fetch_time) AS DATE) - 7 FROM station_events)""", "station_events")
def recent_days(spark, folder):
    """The daily summary of the last days; the date bound reaches the scan before the grouping."""
    events = station_events(spark, folder)
    first = events.agg(F.date_sub(F.max("fetch_time").cast("date"), 7).alias("d")).scalar()
    days = daily_summary(events.filter(F.col("fetch_time") >= first.cast("timestamp_ntz")))
    return days.select("District", "date", "record_count", *[F.round(c, 1).alias(c) for c in ("avg_temp", "max_temp", "min_temp")], "heatwave_alerts", "flood_alerts")


@query("hot_days", "SELECT Date, MaxTemp_2m, District FROM obs WHERE District = 'NATION_7' AND year(Date) = 1998 AND MaxTemp_2m > 40", "obs")
def hot_days(spark, folder):
    return V.hot_days(obs(spark, folder), "NATION_7", 1998).select("Date", "MaxTemp_2m", "District")


@query("latest_per_district", "SELECT id, District, fetch_time, max_temp, precipitation FROM (SELECT *, row_number() OVER (PARTITION BY District ORDER BY fetch_time DESC, id) AS rn FROM station_events) WHERE rn = 1", "station_events")
def latest_per_district(spark, folder):
    return V.latest_per(station_events(spark, folder).select("id", "District", "fetch_time", "max_temp", "precipitation"), ["District"], "fetch_time", "id")


@query("top_k_all_districts", "SELECT id, District, fetch_time, max_temp FROM (SELECT *, row_number() OVER (PARTITION BY District ORDER BY fetch_time DESC, id) AS rn FROM station_events) WHERE rn <= 10", "station_events")
def top_k_all_districts(spark, folder):
    return V.top_per_district(station_events(spark, folder).select("id", "District", "fetch_time", "max_temp"), "fetch_time", 50, tie=["id"])


@query("recent_alerts", f"WITH a AS ({ALERTS_SQL}) SELECT district, alert_type, severity, timestamp, message FROM a ORDER BY a.timestamp DESC, id, alert_type LIMIT 20", "station_events")
def recent_alerts(spark, folder):
    return V.newest(raise_alerts(station_events(spark, folder)), "timestamp", 20, ["id", "alert_type"]).select("district", "alert_type", "severity", "timestamp", "message")


@query("recent_alerts_district", f"WITH a AS ({ALERTS_SQL}) SELECT district, alert_type, severity, timestamp, message FROM a WHERE district = 'D2' ORDER BY a.timestamp DESC, id, alert_type LIMIT 20", "station_events")
def recent_alerts_district(spark, folder):
    rows = raise_alerts(station_events(spark, folder).filter("District = 'D2'"))
    return V.newest(rows, "timestamp", 20, ["id", "alert_type"]).select("district", "alert_type", "severity", "timestamp", "message")


@query("history_view", """
WITH s AS (SELECT *, greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), (max_temp - CAST(35 AS DOUBLE)) / CAST(15 AS DOUBLE))) AS h,
  greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), (precipitation - CAST(50 AS DOUBLE)) / CAST(100 AS DOUBLE) + (humidity - CAST(80 AS DOUBLE)) / CAST(100 AS DOUBLE))) AS f
  FROM station_events ORDER BY fetch_time DESC, id LIMIT 15)
SELECT strftime(fetch_time, '%Y-%m-%d %H:%M:%S') AS time, District, round(max_temp, 1) AS temp, round(humidity, 0) AS humidity, round(precipitation, 1) AS precip,
  round(h * CAST(100 AS DOUBLE), 1) AS heatwave_pct, round(f * CAST(100 AS DOUBLE), 1) AS flood_pct FROM s""", "station_events")
def history_view(spark, folder):
    scored = station_events(spark, folder).withColumn("heatwave_probability", R.heat_score_linear(F.col("max_temp"))).withColumn(
        "flood_probability", R.flood_score_linear(F.col("precipitation"), F.col("humidity")))
    return V.history_view(scored)


@query("recent_100_summary", """WITH r AS (SELECT * FROM station_events ORDER BY fetch_time DESC, id LIMIT 100)
SELECT round(avg(max_temp), 9) AS avg_temp, max(max_temp) AS max_temp, round(sum(precipitation), 6) AS total_precip, count(*) AS records, count(DISTINCT District) AS districts FROM r""", "station_events")
def recent_100_summary(spark, folder):
    return V.recent_summary(station_events(spark, folder), "fetch_time", 100, ["id"])


@query("latest_model", """WITH g AS (SELECT model, target, concat('models/', model, '_', target, '/', CAST(Date AS VARCHAR)) AS path, CAST(Date AS TIMESTAMP) AS saved_at, max(probability) AS best
  FROM predictions GROUP BY 1, 2, 3, 4)
SELECT model, target, path, saved_at, best FROM (SELECT *, row_number() OVER (PARTITION BY model, target ORDER BY saved_at DESC, path) AS rn FROM g) WHERE rn = 1""", "predictions")
def latest_model(spark, folder):
    """A registry with one saved model per day."""
    day = F.col("Date")
    registry = predictions(spark, folder).groupBy(
        "model", "target", F.concat(F.lit("models/"), "model", F.lit("_"), "target", F.lit("/"), day.cast("string")).alias("path"),
        day.cast("timestamp_ntz").alias("saved_at")).agg(F.max("probability").alias("best"))
    return V.latest_model(registry)


@query("best_model", f"""WITH {LATEST_SQL},
k AS (SELECT * FROM latest WHERE NOT (model = 'xgboost' AND District LIKE '%1') AND NOT (model = 'lstm' AND District LIKE '%11'))
SELECT District, target, upper(model) AS model, probability, risk FROM (SELECT *, row_number() OVER (PARTITION BY District, target
  ORDER BY CASE model WHEN 'xgboost' THEN 1 WHEN 'lstm' THEN 2 ELSE 3 END) AS k FROM k) WHERE k = 1""", "predictions")
def best_model(spark, folder):
    """Some districts lack the first or the first two models."""
    latest = V.latest_per(predictions(spark, folder), ["District", "model", "target"], "Date")
    lacking = latest.filter("not (model = 'xgboost' and District like '%1') and not (model = 'lstm' and District like '%11')")
    return V.best_model(lacking)


@query("prediction_pivot", f"""WITH {LATEST_SQL}
SELECT District, target, max(probability) FILTER (WHERE model = 'xgboost') AS xgb_probability, max(probability) FILTER (WHERE model = 'lstm') AS lstm_probability,
  coalesce(max(risk) FILTER (WHERE model = 'xgboost' AND NOT District LIKE '%1'), 'UNKNOWN') AS risk FROM latest WHERE NOT (model = 'xgboost' AND District LIKE '%1') GROUP BY 1, 2""", "predictions")
def prediction_pivot(spark, folder):
    latest = V.latest_per(predictions(spark, folder), ["District", "model", "target"], "Date")
    return V.prediction_pivot(latest.filter("not (model = 'xgboost' and District like '%1')"))


@query("serving_document", f"""WITH {LATEST_SQL},
t AS (SELECT District, target, bool_or(risk = 'HIGH') AS high, count(*) AS n, max(probability) FILTER (WHERE model = 'rule') AS rule_p, max(Date) AS d FROM latest GROUP BY 1, 2)
SELECT District, count(*) FILTER (WHERE high) AS high_targets, CAST(sum(n) AS BIGINT) AS predictions, max(rule_p) FILTER (WHERE target = 'heatwave') AS rule_heat,
  CAST(max(d) AS VARCHAR) AS date FROM t GROUP BY 1""", "predictions")
def serving_document(spark, folder):
    doc = V.serving_document(V.latest_per(predictions(spark, folder), ["District", "model", "target"], "Date"))
    heat = F.get_json_object("document", "$.heatwave")
    return doc.select("District", "high_targets", "predictions", F.get_json_object(heat, "$.rule.probability").cast("double").alias("rule_heat"),
                      F.get_json_object(heat, "$.rule.date").alias("date"))


@query("union_common", f"SELECT * FROM hist UNION ALL SELECT * EXCLUDE (kafka_key, ingestion_time, batch_id) FROM strm", "hist strm")
def union_common(spark, folder):
    return U.union_common(hist(spark, folder), strm(spark, folder))


@query("merge_dedup", """SELECT * EXCLUDE (kafka_key, ingestion_time, batch_id) FROM strm
  UNION ALL SELECT * FROM hist h WHERE NOT EXISTS (SELECT 1 FROM strm s WHERE s.District = h.District AND s.Date = h.Date)""", "hist strm")
def merge_dedup(spark, folder):
    return U.merge_zones(hist(spark, folder), strm(spark, folder))


@query("slice_batches", """WITH b AS (SELECT District, MaxTemp_2m, CAST(floor((row_number() OVER (ORDER BY District, Date) - 1) / 1000) AS BIGINT) + 1 AS batch FROM obs)
SELECT batch, District, count(*) AS records, round(CAST(sum(CAST(MaxTemp_2m AS DECIMAL(28,12))) AS DOUBLE) / count(*), 9) AS avg_temp FROM b GROUP BY 1, 2""", "obs")
def slice_batches(spark, folder):
    sliced = U.slices(obs(spark, folder).select("District", "Date", "MaxTemp_2m"), ["District", "Date"], 1000)
    return sliced.groupBy("batch", "District").agg(
        F.count(F.lit(1)).alias("records"), F.round(F.sum(F.col("MaxTemp_2m").cast("decimal(28,12)")).cast("double") / F.count(F.lit(1)), 9).alias("avg_temp"))


@query("except_rows", "SELECT District, Date FROM hist EXCEPT SELECT District, Date FROM strm", "hist strm")
def except_rows(spark, folder):
    return U.except_keys(hist(spark, folder), strm(spark, folder), ["District", "Date"]).select("District", "Date")


@query("all_predictions", "SELECT concat(model, '_', target) AS set_name, District, Date, probability, risk FROM predictions", "predictions")
def all_predictions(spark, folder):
    return predictions(spark, folder).select(F.concat_ws("_", "model", "target").alias("set_name"), "District", "Date", "probability", "risk")
