"""Parsing, cleaning, validation and profiling queries."""

from pyspark.sql import functions as F

from skygauge.operators import cleaning as C
from skygauge.plans.registry import query
from skygauge.plans.views import hazard_labels, messages, obs, row_id, submissions, weather_docs
from skygauge.sources import messages as S


@query("clean_columns", "SELECT District, Date, MaxTemp_2m, Precip FROM obs", "obs")
def clean_columns(spark, folder):
    padded = obs(spark, folder).select(*[F.col(c).alias(f" {c} ") for c in ("District", "Date", "MaxTemp_2m", "Precip")])
    return C.clean_columns(padded)


@query("parse_dates", "SELECT id, CASE WHEN id % 83 <> 0 THEN Date END AS Date FROM messages", "messages")
def parse_dates(spark, folder):
    """Dates sent as text with a time behind them; every 83rd is no date."""
    i = F.col("id")
    text = obs(spark, folder).select(row_id().alias("id"), "Date").withColumn(
        "Date", F.when(i % 83 == 0, "n/a").otherwise(F.concat(F.col("Date").cast("string"), F.lit("T06:30:00"))))
    return C.parse_dates(text)


@query("parse_json", """SELECT District AS kafka_key, id AS kafka_offset, District, Date, MaxTemp_2m, MinTemp_2m, Precip, RH_2m, SolarRad, 'api' AS source
  FROM messages WHERE id % 97 <> 0 AND id % 89 <> 0""", "messages")
def parse_json(spark, folder):
    parsed = S.accepted(S.parse_messages(messages(spark, folder)))
    return parsed.select("kafka_key", "kafka_offset", "District", S.event_date(F.col("Date")).alias("Date"), "MaxTemp_2m", "MinTemp_2m", "Precip", "RH_2m", "SolarRad", "source")


@query("quarantine", "SELECT District AS kafka_key, count(*) AS messages FROM messages WHERE id % 97 = 0 OR id % 89 = 0 GROUP BY 1", "messages")
def quarantine(spark, folder):
    return S.quarantined(S.parse_messages(messages(spark, folder))).groupBy("kafka_key").agg(F.count(F.lit(1)).alias("messages"))


@query("encode_kv", "SELECT District AS key, District AS district_in_value, MaxTemp_2m AS temp_in_value, Precip AS rain_in_value FROM obs", "obs")
def encode_kv(spark, folder):
    def field(name):
        return F.get_json_object("value", f"$.{name}")
    return S.encode_kv(obs(spark, folder)).select(
        "key", field("District").alias("district_in_value"), field("MaxTemp_2m").cast("double").alias("temp_in_value"), field("Precip").cast("double").alias("rain_in_value"))


@query("canonicalize", """SELECT district AS District, date AS Date, coalesce(latitude, CAST(27 AS DOUBLE)) AS Latitude, coalesce(longitude, CAST(85 AS DOUBLE)) AS Longitude,
  max_temp AS MaxTemp_2m, CASE WHEN min_temp IS NULL OR min_temp = 0 THEN max_temp - CAST(10 AS DOUBLE) ELSE min_temp END AS MinTemp_2m,
  CASE WHEN temp_range IS NULL OR temp_range = 0 THEN CAST(10 AS DOUBLE) ELSE temp_range END AS TempRange_2m, precipitation AS Precip, humidity AS RH_2m,
  coalesce(wind_speed_10m, CAST(0 AS DOUBLE)) AS WindSpeed_10m, CAST(0 AS DOUBLE) AS WindSpeed_50m, CAST(0 AS DOUBLE) AS SolarRad, 'api' AS source FROM submissions""", "submissions")
def canonicalize(spark, folder):
    return S.canonicalize(submissions(spark, folder)).drop("timestamp")


@query("validate_rows", """SELECT id, CAST(CASE WHEN district IS NULL THEN 1 ELSE 0 END + CASE WHEN max_temp IS NULL THEN 1 ELSE 0 END + CASE WHEN humidity IS NULL THEN 1 ELSE 0 END AS BIGINT) AS n_missing,
  concat_ws(',', CASE WHEN district IS NULL THEN 'district' END, CASE WHEN max_temp IS NULL THEN 'max_temp' END, CASE WHEN humidity IS NULL THEN 'humidity' END) AS missing FROM submissions""", "submissions")
def validate_rows(spark, folder):
    return S.check_required(submissions(spark, folder)).select("id", F.size("missing").cast("bigint").alias("n_missing"), F.array_join("missing", ",").alias("missing"))


@query("flatten_weather", """
WITH k AS (SELECT *, max_temp + CAST(272.15 AS DOUBLE) AS temp,
    CASE WHEN id % 5 <> 0 THEN max_temp + CAST(273.15 AS DOUBLE) ELSE max_temp + CAST(272.15 AS DOUBLE) END AS tmax,
    coalesce(min_temp + CAST(273.15 AS DOUBLE), max_temp + CAST(272.15 AS DOUBLE)) AS tmin,
    TIMESTAMP '2024-01-01 00:00:00' + id * INTERVAL 1 MINUTE AS up FROM station_events)
SELECT CASE WHEN id % 7 <> 0 THEN concat('City ', District) ELSE District END AS city_name, District AS district,
  CASE WHEN id % 17 <> 0 THEN CAST(27 AS DOUBLE) + CAST(id % 5 AS DOUBLE) / CAST(8 AS DOUBLE) ELSE CAST(27 AS DOUBLE) END AS latitude,
  CASE WHEN id % 17 <> 0 THEN CAST(85 AS DOUBLE) + CAST(id % 5 AS DOUBLE) / CAST(8 AS DOUBLE) ELSE CAST(85 AS DOUBLE) END AS longitude,
  round(temp - CAST(273.15 AS DOUBLE), 1) AS temperature, round(tmax - CAST(273.15 AS DOUBLE), 1) AS temp_max, round(tmin - CAST(273.15 AS DOUBLE), 1) AS temp_min,
  round(max_temp + CAST(274.15 AS DOUBLE) - CAST(273.15 AS DOUBLE), 1) AS feels_like,
  round((tmax - CAST(273.15 AS DOUBLE)) - (tmin - CAST(273.15 AS DOUBLE)), 1) AS temp_range, humidity, CAST(1000 + id % 20 AS DOUBLE) AS pressure,
  CASE WHEN id % 3 = 0 THEN CAST(0 AS DOUBLE) WHEN id % 3 = 1 THEN round(precipitation / CAST(100 AS DOUBLE) * CAST(24 AS DOUBLE), 1)
       ELSE round(precipitation / CAST(50 AS DOUBLE) * CAST(8 AS DOUBLE), 1) END AS precipitation,
  round(CAST(id % 50 AS DOUBLE) / CAST(5 AS DOUBLE), 1) AS wind_speed, round(CAST(id % 50 AS DOUBLE) / CAST(5 AS DOUBLE), 1) * CAST(1.5 AS DOUBLE) AS wind_speed_50m,
  id % 360 AS wind_direction, id % 101 AS cloudiness, CASE WHEN id % 9 <> 0 THEN 1020 + (id % 90) * 100 ELSE 10000 END AS visibility,
  round(CAST(CASE WHEN id % 9 <> 0 THEN 1020 + (id % 90) * 100 ELSE 10000 END AS DOUBLE) / CAST(1000 AS DOUBLE), 1) AS visibility_km,
  CASE WHEN id % 11 <> 0 THEN source ELSE 'N/A' END AS weather_main, CASE WHEN id % 11 <> 0 THEN concat('desc ', source) ELSE 'N/A' END AS weather_description,
  CASE WHEN id % 13 <> 0 THEN strftime(up, '%H:%M') ELSE 'N/A' END AS sunrise, strftime(up + INTERVAL 12 HOUR, '%H:%M') AS sunset
FROM k""", "station_events")
def flatten_weather(spark, folder):
    return S.flatten_weather(weather_docs(spark, folder))


@query("flatten_weather_metric", """
WITH k AS (SELECT *, max_temp + CAST(272.15 AS DOUBLE) AS temp, CASE WHEN id % 5 <> 0 THEN max_temp + CAST(273.15 AS DOUBLE) END AS tmax, min_temp + CAST(273.15 AS DOUBLE) AS tmin,
    TIMESTAMP '2024-01-01 00:00:00' + id * INTERVAL 1 MINUTE AS up FROM station_events)
SELECT District AS district, coalesce(tmax, temp) AS max_temp, coalesce(tmin, temp) AS min_temp, coalesce(tmax, CAST(0 AS DOUBLE)) - coalesce(tmin, CAST(0 AS DOUBLE)) AS temp_range,
  CASE WHEN id % 3 = 1 THEN precipitation / CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS precipitation, humidity, CAST(id % 50 AS DOUBLE) / CAST(5 AS DOUBLE) AS wind_speed,
  CAST(1000 + id % 20 AS DOUBLE) AS pressure, id % 101 AS cloudiness, CAST(CASE WHEN id % 9 <> 0 THEN 1020 + (id % 90) * 100 ELSE 10000 END AS DOUBLE) / CAST(1000 AS DOUBLE) AS visibility,
  CASE WHEN id % 11 <> 0 THEN concat('desc ', source) ELSE '' END AS weather_desc,
  CASE WHEN id % 13 <> 0 THEN strftime(up, '%H:%M') ELSE '' END AS sunrise, strftime(up + INTERVAL 12 HOUR, '%H:%M') AS sunset
FROM k""", "station_events")
def flatten_weather_metric(spark, folder):
    return S.flatten_weather(weather_docs(spark, folder), units="metric")


def raw_text_rows(spark, folder):
    """The panel as untyped text, some rows with a broken date or number, some without a district."""
    i, cols = F.col("id"), [c for c in C.MEASURES]
    o = obs(spark, folder).withColumn("id", row_id())
    return o.select(
        "id", F.when(i % 53 != 0, F.col("District")).alias("District"),
        F.when(i % 59 == 0, "someday").otherwise(F.concat(F.col("Date").cast("string"), F.lit(" 00:00:00"))).alias("Date"),
        *[F.when((i % 61 == 0) & F.lit(c == "WindSpeed_10m"), "calm").otherwise(F.col(c).cast("string")).alias(c) for c in cols],
    )


@query("coerce_rows", """SELECT CASE WHEN id % 53 <> 0 THEN District ELSE 'Unknown' END AS District, year(Date) AS year, Date, Latitude, Longitude, MaxTemp_2m, MinTemp_2m, TempRange_2m,
  coalesce(Precip, CAST(0 AS DOUBLE)) AS Precip, coalesce(RH_2m, CAST(0 AS DOUBLE)) AS RH_2m, WindSpeed_10m, WindSpeed_50m, SolarRad
  FROM messages WHERE id % 59 <> 0 AND id % 61 <> 0""", "messages")
def coerce_rows(spark, folder):
    return C.coerce_rows(raw_text_rows(spark, folder))


@query("rejects", """SELECT id, CASE WHEN id % 59 = 0 THEN 'someday' ELSE concat(CAST(Date AS VARCHAR), ' 00:00:00') END AS Date
  FROM messages WHERE id % 59 = 0 OR id % 61 = 0""", "messages")
def rejects(spark, folder):
    return C.rejects(raw_text_rows(spark, folder)).select("id", "Date")


@query("impute_const", """SELECT District, Date, CASE WHEN id % 31 = 0 THEN CAST(-999 AS DOUBLE) ELSE MaxTemp_2m END AS MaxTemp_2m, coalesce(Precip, CAST(-999 AS DOUBLE)) AS Precip,
  CASE WHEN id % 29 = 0 THEN CAST(-999 AS DOUBLE) ELSE coalesce(RH_2m, CAST(-999 AS DOUBLE)) END AS RH_2m FROM messages""", "messages")
def impute_const(spark, folder):
    i = row_id()
    broken = obs(spark, folder).select(
        "District", "Date", F.when(i % 31 == 0, float("nan")).otherwise(F.col("MaxTemp_2m")).alias("MaxTemp_2m"), "Precip",
        F.when(i % 29 == 0, float("inf")).otherwise(F.col("RH_2m")).alias("RH_2m"))
    return C.impute(broken, -999.0)


@query("prepare_xy", """SELECT o.District, o.Date, MaxTemp_2m, MinTemp_2m, TempRange_2m, coalesce(Precip, CAST(-999 AS DOUBLE)) AS Precip, coalesce(RH_2m, CAST(-999 AS DOUBLE)) AS RH_2m,
  WindSpeed_10m, WindSpeed_50m, SolarRad, h.heatwave AS y FROM obs o JOIN hazard_labels h ON o.District = h.District AND o.Date = h.Date""", "obs hazard_labels")
def prepare_xy(spark, folder):
    return C.prepare_xy(obs(spark, folder).join(hazard_labels(spark, folder), ["District", "Date"]))


@query("null_profile", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM obs" for c in ["District", "Date", *C.MEASURES]) + ")", "obs")
def null_profile(spark, folder):
    return C.null_profile(obs(spark, folder))


@query("dataset_profile", """SELECT count(*) AS n_rows, CAST(12 AS BIGINT) AS n_columns, min(Date) AS first_date, max(Date) AS last_date, count(DISTINCT District) AS districts FROM obs""", "obs")
def dataset_profile(spark, folder):
    return C.dataset_profile(obs(spark, folder))


@query("time_split", "SELECT District, Date, CASE WHEN Date < (SELECT max(Date) - 365 FROM obs) THEN 'train' ELSE 'test' END AS split FROM obs", "obs")
def time_split(spark, folder):
    return C.time_split(obs(spark, folder).select("District", "Date"))
