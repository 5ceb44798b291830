"""The views the queries start from, as DataFrames and as SQL text.

``obs`` is the daily panel derived from the order tables and ``station_events`` the sub-daily
readings derived from ``events``; labels and predictions are derived from ``obs``. The panel, the
labels and the predictions are landed as Parquet zones once per application, as a deployment
would keep them, so each query starts with a pruned, filtered scan.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygauge.functions import rules
from skygauge.operators import labels as L
from skygauge.operators.blocks import block_window, own_rows, with_lookback
from skygauge.store import landed_zone


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _panel(spark: SparkSession, folder: str) -> DataFrame:
    """Daily observations per district from shipments per nation; sums on decimals, so exact."""
    line, supp, nation = (table(spark, folder, t) for t in ("lineitem", "supplier", "nation"))
    sites = supp.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_name").alias("District"), F.col("n_nationkey").alias("nk")
    )
    daily = (
        line.join(sites, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "District", F.col("l_shipdate").cast("date").alias("Date"), "nk",
            F.col("l_extendedprice").cast("decimal(12,2)").alias("ep"), F.col("l_discount").cast("decimal(4,2)").alias("dc"),
            F.col("l_tax").cast("decimal(4,2)").alias("tx"), F.col("l_quantity").cast("decimal(6,2)").alias("q"),
        )
        .groupBy("District", "Date")
        .agg(
            F.max("nk").cast("double").alias("nk"), F.count(F.lit(1)).cast("double").alias("n"),
            F.max("ep").cast("double").alias("ep_hi"), F.min("ep").cast("double").alias("ep_lo"),
            F.sum("ep").cast("double").alias("ep_sum"), F.sum(F.col("q") * F.col("dc")).cast("double").alias("qd"),
            F.sum("q").cast("double").alias("q_sum"), F.max("q").alias("q_hi"),
            F.sum("tx").cast("double").alias("tx_sum"), F.max("tx").alias("tx_hi"),
        )
    )
    month = F.month("Date")
    summer = (6 - F.abs(month - 7)) * 2.0
    hot = F.col("ep_hi") / 6000.0 + 16.0 + summer
    spread = (F.col("ep_hi") - F.col("ep_lo")) / 8000.0 + 4.0
    rain = F.col("qd") * 10.0 / F.col("n") * F.when(month.between(6, 9), 4).otherwise(1)
    wind = F.col("q_sum") / F.col("n") / 5.0
    return daily.select(
        "District", "Date",
        (26.0 + F.col("nk") / 10.0).alias("Latitude"), (80.0 + F.col("nk") / 10.0).alias("Longitude"),
        hot.alias("MaxTemp_2m"), (hot - spread).alias("MinTemp_2m"), spread.alias("TempRange_2m"),
        F.when(F.col("q_hi") != 50, rain).alias("Precip"),
        F.when(F.col("tx_hi") != 0, 40.0 + F.col("tx_sum") * 100.0 / F.col("n") * 7.0).alias("RH_2m"),
        wind.alias("WindSpeed_10m"), (wind * 1.5).alias("WindSpeed_50m"),
        (F.col("ep_sum") / F.col("n") / 5000.0).alias("SolarRad"),
    )


def obs(spark: SparkSession, folder: str) -> DataFrame:
    return landed_zone(spark, f"{folder}/processed", lambda: _panel(spark, folder))


def hist(spark, folder):
    return obs(spark, folder).filter(F.col("Date") < F.lit("2000-07-01").cast("date"))


def strm(spark, folder):
    return obs(spark, folder).filter(F.col("Date") >= F.lit("2000-01-01").cast("date")).select(
        *[(F.col(c) + 1.0).alias(c) if c == "Precip" else F.col(c) for c in obs(spark, folder).columns],
        F.col("District").alias("kafka_key"),
        F.lit("2002-01-01 00:00:00").cast("timestamp_ntz").alias("ingestion_time"), F.lit(0).cast("bigint").alias("batch_id"),
    )


def station_events(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    spread = F.col("event_id") % 331
    return e.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("D"), (F.col("user_id") % 5).cast("string")).alias("District"),
        F.col("ts").alias("fetch_time"),
        ((150 + spread).cast("double") / 10.0).alias("max_temp"),
        F.when(F.col("event_id") % 13 == 0, None).when(F.col("event_id") % 17 == 0, 0.0)
        .otherwise((70 + spread).cast("double") / 10.0).alias("min_temp"),
        F.col("value").alias("precipitation"),
        (40 + F.col("event_id") % 60).cast("double").alias("humidity"),
        F.col("event_type").alias("source"),
    )


def row_id():
    """A number per (District, Date), used to vary the message fixtures."""
    return F.unix_date("Date").cast("bigint") * 25 + F.round((F.col("Latitude") - 26.0) * 10.0).cast("bigint")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Topic rows: key, JSON value, partition, offset, timestamp. Some texts are cut off, some lack the district."""
    o = obs(spark, folder).withColumn("id", row_id())
    body = F.struct(
        F.when(F.col("id") % 89 != 0, F.col("District")).alias("District"), F.col("Date").cast("string").alias("Date"),
        *[F.col(c) for c in o.columns[2:12]], F.lit("2002-01-01T00:00:00").alias("timestamp"), F.lit("api").alias("source"),
    )
    text = F.to_json(body)
    return o.withColumn("text", text).select(
        F.col("District").alias("key"),
        F.when(F.col("id") % 97 == 0, F.substring("text", F.lit(1), (F.length("text") / 2).cast("int"))).otherwise(F.col("text")).alias("value"),
        (F.col("id") % 4).alias("partition"), F.col("id").alias("offset"), F.lit("2002-01-01 00:00:00").cast("timestamp_ntz").alias("timestamp"),
    )


def weather_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Current-weather documents from the station events, with every kind of missing part."""
    e, i = station_events(spark, folder), F.col("id")

    def unless(every, column):
        return F.when(i % every != 0, column)
    described = F.array(F.struct(F.col("source").alias("main"), F.concat(F.lit("desc "), "source").alias("description")))
    return e.select("id", F.col("District").alias("city"), F.to_json(F.struct(
        unless(7, F.concat(F.lit("City "), "District")).alias("name"),
        F.struct(
            (F.col("max_temp") + 272.15).alias("temp"), unless(5, F.col("max_temp") + 273.15).alias("temp_max"),
            (F.col("min_temp") + 273.15).alias("temp_min"), (F.col("max_temp") + 274.15).alias("feels_like"),
            "humidity", (1000.0 + i % 20).alias("pressure"),
        ).alias("main"),
        F.struct(((i % 50) / 5.0).alias("speed"), (i % 360).alias("deg")).alias("wind"),
        F.struct((i % 101).alias("all")).alias("clouds"),
        unless(3, F.struct(
            F.when(i % 3 == 1, F.col("precipitation") / 100.0).alias("1h"), F.when(i % 3 == 2, F.col("precipitation") / 50.0).alias("3h"),
        )).alias("rain"),
        unless(9, 1020 + (i % 90) * 100).alias("visibility"),
        F.when(i % 11 != 0, described).otherwise(F.slice(described, 1, 0)).alias("weather"),
        unless(17, F.struct((27.0 + (i % 5) / 8.0).alias("lat"), (85.0 + (i % 5) / 8.0).alias("lon"))).alias("coord"),
        F.struct(unless(13, 1704067200 + i * 60).alias("sunrise"), (1704110400 + i * 60).alias("sunset")).alias("sys"),
    )).alias("value"))


def submissions(spark: SparkSession, folder: str) -> DataFrame:
    """Observations as clients submit them, some with required fields missing."""
    i = F.col("id")
    return station_events(spark, folder).select(
        "id", F.when(i % 41 != 0, F.col("District")).alias("district"), F.col("fetch_time").cast("date").cast("string").alias("date"),
        F.when(i % 3 == 0, 26.5).alias("latitude"), F.when(i % 3 == 0, 84.5).alias("longitude"),
        F.when(i % 43 != 0, F.col("max_temp")).alias("max_temp"), "min_temp", F.when(i % 2 == 0, (i % 12).cast("double")).alias("temp_range"),
        F.col("precipitation"), F.when(i % 47 != 0, F.col("humidity")).alias("humidity"),
        F.when(i % 5 == 0, 2.5).alias("wind_speed_10m"), F.lit(None).cast("double").alias("wind_speed_50m"), F.lit(None).cast("double").alias("solar_radiation"),
    )


def hazard_labels(spark: SparkSession, folder: str) -> DataFrame:
    return landed_zone(spark, f"{folder}/labeled", lambda: L.hazard_labels(obs(spark, folder)))


def _scores(spark: SparkSession, folder: str) -> DataFrame:
    """Stand-in predictions of three models from the two rule families, one row per model and target."""
    temp, rain, rh = F.col("MaxTemp_2m"), F.col("Precip"), F.col("RH_2m")
    scored = obs(spark, folder).select(
        "District", "Date",
        rules.heat_score_linear(temp).alias("heat_rule"), rules.flood_score_linear(rain, rh).alias("flood_rule"),
        rules.heat_score_bands(temp).alias("heat_bands"), rules.flood_score_bands(rain, rh).alias("flood_bands"),
    )
    last3 = block_window().rowsBetween(-2, 0)
    smoothed = own_rows(with_lookback(scored, 2, ["heat_rule", "flood_rule"]).withColumns({
        f"{t}_mean": F.round(F.avg(f"{t}_rule").over(last3), 9) for t in ("heat", "flood")
    }))
    rows = F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(target).alias("target"), F.coalesce(column, F.lit(0.0)).alias("probability"))
        for target, t in (("heatwave", "heat"), ("flood_proxy", "flood"))
        for model, column in (("rule", f"{t}_rule"), ("xgboost", f"{t}_bands"), ("lstm", f"{t}_mean"))
    ])
    return smoothed.select("District", "Date", F.inline(rows)).withColumn("risk", rules.risk_level(F.col("probability")))


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return landed_zone(spark, f"{folder}/predictions", lambda: _scores(spark, folder))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Probability ``p`` of every model and target next to the true label ``y``."""
    y = hazard_labels(spark, folder).select("District", "Date", F.inline(F.array(*[
        F.struct(F.lit(t).alias("target"), F.col(t).alias("y")) for t in ("heatwave", "flood_proxy")])))
    return predictions(spark, folder).select("District", "Date", "model", "target", F.col("probability").alias("p")).join(y, ["District", "Date", "target"])


# The same views in SQL: name -> (views it reads, text).
SQL_VIEWS = {
    "obs": ("", """
  WITH o AS (
    SELECT n.n_name AS District, CAST(l.l_shipdate AS DATE) AS Date, n.n_nationkey AS nk,
           CAST(l.l_extendedprice AS DECIMAL(12,2)) AS ep, CAST(l.l_discount AS DECIMAL(4,2)) AS dc,
           CAST(l.l_tax AS DECIMAL(4,2)) AS tx, CAST(l.l_quantity AS DECIMAL(6,2)) AS q
    FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey),
  d AS (
    SELECT District, Date, CAST(max(nk) AS DOUBLE) AS nk, CAST(count(*) AS DOUBLE) AS n,
           CAST(max(ep) AS DOUBLE) AS ep_hi, CAST(min(ep) AS DOUBLE) AS ep_lo, CAST(sum(ep) AS DOUBLE) AS ep_sum,
           CAST(sum(q * dc) AS DOUBLE) AS qd, CAST(sum(q) AS DOUBLE) AS q_sum, max(q) AS q_hi,
           CAST(sum(tx) AS DOUBLE) AS tx_sum, max(tx) AS tx_hi
    FROM o GROUP BY District, Date)
  SELECT District, Date, 26.0 + nk / 10.0 AS Latitude, 80.0 + nk / 10.0 AS Longitude,
         ep_hi / 6000.0 + 16.0 + (6 - abs(month(Date) - 7)) * 2.0 AS MaxTemp_2m,
         ep_hi / 6000.0 + 16.0 + (6 - abs(month(Date) - 7)) * 2.0 - ((ep_hi - ep_lo) / 8000.0 + 4.0) AS MinTemp_2m,
         (ep_hi - ep_lo) / 8000.0 + 4.0 AS TempRange_2m,
         CASE WHEN q_hi = 50 THEN NULL
              ELSE qd * 10.0 / n * CASE WHEN month(Date) BETWEEN 6 AND 9 THEN 4 ELSE 1 END END AS Precip,
         CASE WHEN tx_hi = 0 THEN NULL ELSE 40.0 + tx_sum * 100.0 / n * 7.0 END AS RH_2m,
         q_sum / n / 5.0 AS WindSpeed_10m, q_sum / n / 5.0 * 1.5 AS WindSpeed_50m, ep_sum / n / 5000.0 AS SolarRad
  FROM d"""),
    "hist": ("obs", "SELECT * FROM obs WHERE Date < DATE '2000-07-01'"),
    "strm": ("obs", """
  SELECT * REPLACE (Precip + CAST(1 AS DOUBLE) AS Precip), District AS kafka_key,
         TIMESTAMP '2002-01-01 00:00:00' AS ingestion_time, CAST(0 AS BIGINT) AS batch_id
  FROM obs WHERE Date >= DATE '2000-01-01'"""),
    "station_events": ("", """
  SELECT event_id AS id, concat('D', CAST(user_id % 5 AS VARCHAR(10))) AS District, ts AS fetch_time,
         CAST(150 + event_id % 331 AS DOUBLE) / CAST(10 AS DOUBLE) AS max_temp,
         CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN CAST(0 AS DOUBLE)
              ELSE CAST(70 + event_id % 331 AS DOUBLE) / CAST(10 AS DOUBLE) END AS min_temp,
         value AS precipitation, CAST(40 + event_id % 60 AS DOUBLE) AS humidity, event_type AS source
  FROM events"""),
    "messages": ("obs", """
  SELECT *, (Date - DATE '1970-01-01')::BIGINT * 25 + CAST(round((Latitude - 26.0) * 10.0) AS BIGINT) AS id FROM obs"""),
    "submissions": ("station_events", """
  SELECT id, CASE WHEN id % 41 <> 0 THEN District END AS district, CAST(CAST(fetch_time AS DATE) AS VARCHAR) AS date,
    CASE WHEN id % 3 = 0 THEN CAST(26.5 AS DOUBLE) END AS latitude, CASE WHEN id % 3 = 0 THEN CAST(84.5 AS DOUBLE) END AS longitude,
    CASE WHEN id % 43 <> 0 THEN max_temp END AS max_temp, min_temp, CASE WHEN id % 2 = 0 THEN CAST(id % 12 AS DOUBLE) END AS temp_range,
    precipitation, CASE WHEN id % 47 <> 0 THEN humidity END AS humidity, CASE WHEN id % 5 = 0 THEN CAST(2.5 AS DOUBLE) END AS wind_speed_10m
  FROM station_events"""),
    "filled": ("obs", """
  SELECT *, coalesce(
           last_value(RH_2m IGNORE NULLS) OVER (PARTITION BY District ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(RH_2m IGNORE NULLS) OVER (PARTITION BY District ORDER BY Date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         ) AS RH_2m_filled,
         coalesce(Precip, CAST(0 AS DOUBLE)) AS precip_1d,
         round(sum(coalesce(Precip, CAST(0 AS DOUBLE))) OVER (PARTITION BY District ORDER BY Date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 9) AS precip_3d_sum
  FROM obs"""),
    "limits": ("filled", """
  SELECT District, quantile_cont(MaxTemp_2m, 0.95) AS temp_p95, quantile_cont(precip_1d, 0.99) AS precip_p99,
         quantile_cont(precip_3d_sum, 0.98) AS precip3_p98, quantile_cont(RH_2m_filled, 0.90) AS rh_p90
  FROM filled GROUP BY District"""),
    "runs": ("filled limits", """
  SELECT *, CASE WHEN heat_exceed THEN
           count(*) OVER (PARTITION BY District, island ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           - CASE WHEN island > 0 THEN 1 ELSE 0 END ELSE 0 END AS heat_run
  FROM (SELECT *, sum(CASE WHEN heat_exceed THEN 0 ELSE 1 END) OVER (PARTITION BY District ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
        FROM (SELECT f.*, l.temp_p95, l.precip_p99, l.precip3_p98, l.rh_p90, f.MaxTemp_2m > l.temp_p95 AS heat_exceed
              FROM filled f JOIN limits l ON f.District = l.District))"""),
    "hazard_labels": ("runs", """
  SELECT District, Date, CAST(heat_run >= 3 AS BIGINT) AS heatwave,
         CAST(coalesce((precip_1d > precip_p99 OR precip_3d_sum > precip3_p98) AND RH_2m_filled > rh_p90, FALSE) AS BIGINT) AS flood_proxy,
         CAST(heat_run AS BIGINT) AS heat_run, RH_2m_filled > rh_p90 AS wetness_flag
  FROM runs"""),
    "rule_scores": ("obs", """
  SELECT *,
    CASE WHEN MaxTemp_2m IS NOT NULL THEN greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), (MaxTemp_2m - CAST(35 AS DOUBLE)) / CAST(15 AS DOUBLE))) END AS heat_rule,
    CASE WHEN Precip IS NOT NULL AND RH_2m IS NOT NULL THEN greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE),
         (Precip - CAST(50 AS DOUBLE)) / CAST(100 AS DOUBLE) + (RH_2m - CAST(80 AS DOUBLE)) / CAST(100 AS DOUBLE))) END AS flood_rule,
    CASE WHEN MaxTemp_2m > 40 THEN least(CAST(1 AS DOUBLE), CAST(0.7 AS DOUBLE) + (MaxTemp_2m - CAST(40 AS DOUBLE)) / CAST(20 AS DOUBLE))
         WHEN MaxTemp_2m > 35 THEN least(CAST(1 AS DOUBLE), CAST(0.3 AS DOUBLE) + (MaxTemp_2m - CAST(35 AS DOUBLE)) / CAST(10 AS DOUBLE))
         WHEN MaxTemp_2m IS NOT NULL THEN greatest(CAST(0 AS DOUBLE), (MaxTemp_2m - CAST(30 AS DOUBLE)) / CAST(20 AS DOUBLE)) END AS heat_bands,
    least(CAST(1 AS DOUBLE),
      CASE WHEN Precip > 100 THEN CAST(0.8 AS DOUBLE) WHEN Precip > 50 THEN CAST(0.5 AS DOUBLE) WHEN Precip > 20 THEN CAST(0.3 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
      + CASE WHEN RH_2m > 90 THEN CAST(0.2 AS DOUBLE) WHEN RH_2m > 80 THEN CAST(0.1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS flood_bands
  FROM obs"""),
    "predictions": ("rule_scores", """
  WITH m AS (SELECT *,
      round(avg(heat_rule) OVER w, 9) AS heat_mean, round(avg(flood_rule) OVER w, 9) AS flood_mean FROM rule_scores
      WINDOW w AS (PARTITION BY District ORDER BY Date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
  u AS (
      SELECT District, Date, 'rule' AS model, 'heatwave' AS target, heat_rule AS probability FROM m
      UNION ALL SELECT District, Date, 'xgboost', 'heatwave', heat_bands FROM m
      UNION ALL SELECT District, Date, 'lstm', 'heatwave', heat_mean FROM m
      UNION ALL SELECT District, Date, 'rule', 'flood_proxy', flood_rule FROM m
      UNION ALL SELECT District, Date, 'xgboost', 'flood_proxy', flood_bands FROM m
      UNION ALL SELECT District, Date, 'lstm', 'flood_proxy', flood_mean FROM m)
  SELECT District, Date, model, target, coalesce(probability, CAST(0 AS DOUBLE)) AS probability,
         CASE WHEN probability > CAST(0.5 AS DOUBLE) THEN 'HIGH' WHEN probability > CAST(0.3 AS DOUBLE) THEN 'MEDIUM' ELSE 'LOW' END AS risk
  FROM u"""),
    "scored": ("predictions hazard_labels", """
  SELECT p.District, p.Date, p.model, p.target, p.probability AS p, CASE p.target WHEN 'heatwave' THEN h.heatwave ELSE h.flood_proxy END AS y
  FROM predictions p JOIN hazard_labels h ON p.District = h.District AND p.Date = h.Date"""),
}

# The label views once more, over the merged zones instead of the panel.
SQL_VIEWS["merged"] = ("hist strm", """
  SELECT * EXCLUDE (kafka_key, ingestion_time, batch_id) FROM strm
  UNION ALL SELECT * FROM hist h WHERE NOT EXISTS (SELECT 1 FROM strm s WHERE s.District = h.District AND s.Date = h.Date)""")
for _view, _input in (("filled", "merged"), ("limits", "m_filled"), ("runs", "m_filled m_limits"), ("hazard_labels", "m_runs")):
    _text = SQL_VIEWS[_view][1]
    for _old, _new in (("FROM obs", "FROM merged"), ("FROM filled", "FROM m_filled"), ("JOIN limits", "JOIN m_limits"), ("FROM runs", "FROM m_runs")):
        _changed = _text.replace(_old, _new)
        assert _changed != _text or _old not in SQL_VIEWS[_view][1], f"{_old} in {_view}"
        _text = _changed
    SQL_VIEWS[f"m_{_view}"] = (_input, _text)
