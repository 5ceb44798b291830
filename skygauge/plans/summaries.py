"""Aggregation and rule queries."""

from pyspark.sql import functions as F

from skygauge.functions import rules as R
from skygauge.operators import serving, summaries as A
from skygauge.plans.registry import query
from skygauge.plans.views import obs, predictions, station_events


def dsum(c):
    return f"CAST(sum(CAST({c} AS DECIMAL(28,12))) AS DOUBLE)"


def davg(c):
    return f"round({dsum(c)} / count({c}), 9)"


HAZARDS = "count(*) FILTER (WHERE {t} > 40) AS heatwave_alerts, count(*) FILTER (WHERE {p} > 100) AS flood_alerts"
D = "CAST({} AS DOUBLE)".format


@query("batch_by_district", f"SELECT District, count(*) AS records, {davg('MaxTemp_2m')} AS avg_temp, {dsum('Precip')} AS total_precip FROM obs GROUP BY 1", "obs")
def batch_by_district(spark, folder):
    return A.by_district(obs(spark, folder))


@query("batch_summary", f"""SELECT count(*) AS records, {davg('MaxTemp_2m')} AS avg_temp, max(MaxTemp_2m) AS max_temp, {dsum('Precip')} AS total_precip,
  count(DISTINCT District) AS districts, {HAZARDS.format(t='MaxTemp_2m', p='Precip')} FROM obs""", "obs")
def batch_summary(spark, folder):
    return A.batch_summary(obs(spark, folder))


@query("district_year_stats", f"""SELECT District, year(Date) AS year, {davg('MaxTemp_2m')} AS avg_temp, max(MaxTemp_2m) AS max_temp, {dsum('Precip')} AS total_precip,
  count(*) AS record_count FROM obs GROUP BY 1, 2""", "obs")
def district_year_stats(spark, folder):
    return A.district_year_stats(obs(spark, folder))


@query("store_stats", """
WITH l AS (SELECT DISTINCT n_name AS District FROM nation UNION SELECT 'Nowhere'),
c AS (SELECT l.District, (SELECT count(*) FROM obs o WHERE o.District = l.District) AS o, (SELECT count(*) FROM predictions p WHERE p.District = l.District) AS p FROM l)
SELECT District, CAST(sum(o) AS BIGINT) AS observations, CAST(sum(p) AS BIGINT) AS predictions, count(*) FILTER (WHERE o > 0) AS monitored FROM c GROUP BY ROLLUP (District)""", "obs predictions")
def store_stats(spark, folder):
    listed = spark.read.parquet(f"{folder}/nation.parquet").select(F.col("n_name").alias("District")).union(spark.sql("SELECT 'Nowhere'"))
    return A.store_stats(obs(spark, folder), predictions(spark, folder), listed)


EVENT_DAY = f"""count(*) AS record_count, {davg('max_temp')} AS avg_temp, max(max_temp) AS max_temp, min(min_temp) AS min_temp, {dsum('precipitation')} AS total_precip,
  {davg('humidity')} AS avg_humidity, {HAZARDS.format(t='max_temp', p='precipitation')}"""


@query("daily_summary", f"SELECT District, CAST(fetch_time AS DATE) AS date, {EVENT_DAY} FROM station_events GROUP BY 1, 2", "station_events")
def daily_summary(spark, folder):
    return A.daily_summary(station_events(spark, folder))


@query("daily_flags", f"""SELECT District, CAST(fetch_time AS DATE) AS date, {davg('max_temp')} AS avg_temp, max(max_temp) AS max_temp, min(min_temp) AS min_temp,
  {dsum('precipitation')} AS total_precip, bool_or(max_temp > 40) AS heatwave_flag, bool_or(precipitation > 100) AS flood_flag FROM station_events GROUP BY 1, 2""", "station_events")
def daily_flags(spark, folder):
    return A.daily_flags(station_events(spark, folder))


HOURLY_SQL = f"""SELECT District, date_trunc('hour', fetch_time) AS hour_bucket, count(*) AS record_count, {davg('max_temp')} AS avg_temp, max(max_temp) AS max_temp,
  {dsum('precipitation')} AS total_precip, {HAZARDS.format(t='max_temp', p='precipitation')} FROM station_events GROUP BY 1, 2"""


@query("hourly_stats", HOURLY_SQL, "station_events")
def hourly_stats(spark, folder):
    return A.hourly_stats(station_events(spark, folder))


COUNTER_SQL = "SELECT CAST(fetch_time AS DATE) AS stat_date, District, hour(fetch_time) AS hour, count(*) AS record_count FROM station_events GROUP BY 1, 2, 3"


@query("ingest_counter", COUNTER_SQL, "station_events")
def ingest_counter(spark, folder):
    return A.ingest_counter(station_events(spark, folder))


@query("high_risk_rate", f"""SELECT model, target, count(*) AS records, count(*) FILTER (WHERE probability > {D(0.5)}) AS high_risk,
  count(*) FILTER (WHERE probability > {D(0.5)}) * {D(100)} / count(*) AS high_risk_pct FROM predictions GROUP BY 1, 2""", "predictions")
def high_risk_rate(spark, folder):
    return A.high_risk_rate(predictions(spark, folder))


LATEST_SQL = "latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY District, model, target ORDER BY Date DESC) AS rn FROM predictions) WHERE rn = 1)"


@query("risk_summary", f"""WITH {LATEST_SQL},
d AS (SELECT District, target, bool_or(risk = 'HIGH') AS high FROM latest GROUP BY 1, 2)
SELECT count(*) FILTER (WHERE high AND target = 'heatwave') AS high_risk_heatwave, count(*) FILTER (WHERE high AND target = 'flood_proxy') AS high_risk_flood,
  count(DISTINCT District) AS districts FROM d""", "predictions")
def risk_summary(spark, folder):
    return A.risk_summary(serving.latest_per(predictions(spark, folder), ["District", "model", "target"], "Date"))


ALERTS_SQL = f"""SELECT * FROM (
  SELECT id, District AS district, 'HEATWAVE' AS alert_type, CASE WHEN max_temp > 45 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, fetch_time AS timestamp, max_temp AS temperature,
    precipitation, printf('Extreme temperature: %.1f°C', max_temp) AS message FROM station_events WHERE max_temp > 40
  UNION ALL
  SELECT id, District, 'FLOOD_RISK', CASE WHEN precipitation > 150 THEN 'HIGH' ELSE 'MEDIUM' END, fetch_time, max_temp, precipitation,
    concat('Heavy precipitation: ', CAST(round(CAST(precipitation AS DECIMAL(18,6)), 1) AS DECIMAL(18,1)), 'mm') FROM station_events WHERE precipitation > 100)"""


@query("alerts", ALERTS_SQL, "station_events")
def alerts(spark, folder):
    return A.alerts(station_events(spark, folder))


@query("status_exclusive", """SELECT id, District, CASE WHEN max_temp > 40 THEN 'HOT' WHEN precipitation > 100 THEN 'FLOOD' ELSE 'OK' END AS status FROM station_events""", "station_events")
def status_exclusive(spark, folder):
    return station_events(spark, folder).select("id", "District", R.exclusive_status(F.col("max_temp"), F.col("precipitation")).alias("status"))


@query("rule_score_linear", f"""SELECT District, Date, heat_rule AS heat, flood_rule AS flood, (MaxTemp_2m - {D(35)}) / {D(15)} AS heat_raw,
  (Precip - {D(50)}) / {D(100)} + (RH_2m - {D(80)}) / {D(100)} AS flood_raw FROM rule_scores""", "rule_scores")
def rule_score_linear(spark, folder):
    t, p, h = F.col("MaxTemp_2m"), F.col("Precip"), F.col("RH_2m")
    return obs(spark, folder).select(
        "District", "Date", R.heat_score_linear(t).alias("heat"), R.flood_score_linear(p, h).alias("flood"),
        R.heat_score_linear(t, clamp=False).alias("heat_raw"), R.flood_score_linear(p, h, clamp=False).alias("flood_raw"),
    )


@query("rule_score_piecewise", "SELECT District, Date, heat_bands AS heat, flood_bands AS flood FROM rule_scores", "rule_scores")
def rule_score_piecewise(spark, folder):
    return obs(spark, folder).select(
        "District", "Date", R.heat_score_bands(F.col("MaxTemp_2m")).alias("heat"), R.flood_score_bands(F.col("Precip"), F.col("RH_2m")).alias("flood"))


@query("risk_level_3", f"""SELECT District, Date, CASE WHEN heat_rule > {D(0.5)} THEN 'HIGH' WHEN heat_rule > {D(0.3)} THEN 'MEDIUM' ELSE 'LOW' END AS heat_risk,
  CASE WHEN flood_rule > {D(0.5)} THEN 'HIGH' WHEN flood_rule > {D(0.3)} THEN 'MEDIUM' ELSE 'LOW' END AS flood_risk FROM rule_scores""", "rule_scores")
def risk_level_3(spark, folder):
    return obs(spark, folder).select(
        "District", "Date", R.risk_level(R.heat_score_linear(F.col("MaxTemp_2m"))).alias("heat_risk"),
        R.risk_level(R.flood_score_linear(F.col("Precip"), F.col("RH_2m"))).alias("flood_risk"))


@query("risk_level_store", f"""SELECT District, Date, CASE WHEN heat_bands >= {D(0.7)} THEN 'HIGH' WHEN heat_bands >= {D(0.4)} THEN 'MEDIUM' ELSE 'LOW' END AS heat_risk FROM rule_scores""", "rule_scores")
def risk_level_store(spark, folder):
    return obs(spark, folder).select("District", "Date", R.risk_level_stored(R.heat_score_bands(F.col("MaxTemp_2m"))).alias("heat_risk"))


@query("risk_level_5", f"""WITH b AS (SELECT District, Date, CASE WHEN heat_bands >= {D(0.8)} THEN 1 WHEN heat_bands >= {D(0.6)} THEN 2 WHEN heat_bands >= {D(0.4)} THEN 3
    WHEN heat_bands >= {D(0.2)} THEN 4 ELSE 5 END AS k FROM rule_scores)
SELECT District, Date, ['EXTREME RISK', 'HIGH RISK', 'MODERATE RISK', 'LOW RISK', 'MINIMAL RISK'][k] AS level,
  ['Immediate action required!', 'High risk - Take precautions', 'Moderate risk - Stay alert', 'Low risk - Normal conditions', 'Minimal risk - Safe conditions'][k] AS advice FROM b""", "rule_scores")
def risk_level_5(spark, folder):
    return obs(spark, folder).select("District", "Date", R.risk_level_five(R.heat_score_bands(F.col("MaxTemp_2m"))).alias("r")).select("District", "Date", "r.*")


@query("score_rule", f"""
WITH s AS (SELECT District, Date, 'heatwave' AS target, heat_rule AS probability FROM rule_scores UNION ALL SELECT District, Date, 'flood_proxy', flood_rule FROM rule_scores)
SELECT *, CASE WHEN probability > {D(0.5)} THEN 'HIGH' WHEN probability > {D(0.3)} THEN 'MEDIUM' ELSE 'LOW' END AS risk, 'rule' AS model, 'fallback' AS status FROM s""", "rule_scores")
def score_rule(spark, folder):
    from skygauge.operators.learning import score_by_rule
    return score_by_rule(obs(spark, folder)).select("District", "Date", "target", "probability", "risk", "model", "status")
