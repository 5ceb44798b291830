"""Feature queries: calendar terms, rolling windows, lags, antecedent rain, climatology, sequences."""

from pyspark.sql import functions as F

from skygauge.operators import features as X, learning as M
from skygauge.plans.registry import query
from skygauge.plans.views import hazard_labels, obs

W3 = "OVER (PARTITION BY District ORDER BY Date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
W7 = "OVER (PARTITION BY District ORDER BY Date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
ORD = "OVER (PARTITION BY District ORDER BY Date)"

TIME_SQL = """dayofyear(Date) AS doy, round(sin(CAST(2 AS DOUBLE) * pi() * dayofyear(Date) / CAST(365.25 AS DOUBLE)), 9) AS doy_sin,
  round(cos(CAST(2 AS DOUBLE) * pi() * dayofyear(Date) / CAST(365.25 AS DOUBLE)), 9) AS doy_cos, year(Date) AS year, month(Date) AS month"""

def seasonal_rounded(df):
    """Sine and cosine to 9 digits: the two engines' last bits differ."""
    return df.withColumns({c: F.round(c, 9) for c in ("doy_sin", "doy_cos")})


LAG_SQL = ", ".join(f"lag({c}, {k}) {ORD} AS {n}_lag_{k}" for k in X.LAGS for n, c in (("precip", "Precip"), ("maxT", "MaxTemp_2m")))
ROLL_SQL = f"""round(sum(Precip) {W3}, 9) AS precip_3d, round(sum(Precip) {W7}, 9) AS precip_7d,
  round(avg(MaxTemp_2m) {W3}, 9) AS maxT_3d_mean, max(TempRange_2m) {W3} AS temp_range_3d_max"""
API_SQL = """round(list_reduce(list(coalesce(Precip, CAST(0 AS DOUBLE)))
  OVER (PARTITION BY District ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  lambda s, x: CAST(0.8 AS DOUBLE) * s + x), 6) AS API"""
CLIM_SQL = "SELECT District, CAST(dayofyear(Date) AS BIGINT) AS doy, median(MaxTemp_2m) AS clim_maxT, median(Precip) AS clim_precip FROM obs GROUP BY 1, 2"


@query("time_features", f"SELECT District, Date, {TIME_SQL} FROM obs", "obs")
def time_features(spark, folder):
    return seasonal_rounded(X.add_time_features(obs(spark, folder).select("District", "Date")))


@query("rolling_precip", f"SELECT District, Date, round(sum(Precip) {W3}, 9) AS precip_3d, round(sum(Precip) {W7}, 9) AS precip_7d FROM obs", "obs")
def rolling_precip(spark, folder):
    return X.add_rolling(obs(spark, folder)).select("District", "Date", "precip_3d", "precip_7d")


@query("rolling_temp", f"SELECT District, Date, round(avg(MaxTemp_2m) {W3}, 9) AS maxT_3d_mean, max(TempRange_2m) {W3} AS temp_range_3d_max FROM obs", "obs")
def rolling_temp(spark, folder):
    return X.add_rolling(obs(spark, folder)).select("District", "Date", "maxT_3d_mean", "temp_range_3d_max")


RANGE = "OVER (PARTITION BY District ORDER BY Date RANGE BETWEEN INTERVAL {} DAY PRECEDING AND CURRENT ROW)".format


@query("rolling_calendar", f"SELECT District, Date, round(sum(Precip) {RANGE(2)}, 9) AS precip_3cd, round(sum(Precip) {RANGE(6)}, 9) AS precip_7cd FROM obs", "obs")
def rolling_calendar(spark, folder):
    return X.add_rolling_calendar(obs(spark, folder).select("District", "Date", "Precip")).drop("Precip")


@query("lags", f"SELECT District, Date, {LAG_SQL} FROM obs", "obs")
def lags(spark, folder):
    return X.add_lags(obs(spark, folder).select("District", "Date", "Precip", "MaxTemp_2m")).drop("Precip", "MaxTemp_2m")


@query("api_index", f"SELECT District, Date, {API_SQL} FROM obs", "obs")
def api_index(spark, folder):
    return X.add_api(obs(spark, folder).select("District", "Date", "Precip")).drop("Precip")


@query("climatology", CLIM_SQL, "obs")
def climatology(spark, folder):
    return X.climatology(obs(spark, folder))


@query("climatology_anomaly", f"""
WITH clim AS ({CLIM_SQL})
SELECT o.District, o.Date, c.clim_maxT, c.clim_precip, o.MaxTemp_2m - c.clim_maxT AS anom_maxT, o.Precip - c.clim_precip AS anom_precip
FROM obs o LEFT JOIN clim c ON o.District = c.District AND dayofyear(o.Date) = c.doy""", "obs")
def climatology_anomaly(spark, folder):
    return X.add_anomaly(obs(spark, folder)).select("District", "Date", "clim_maxT", "clim_precip", "anom_maxT", "anom_precip")


@query("features", f"""
WITH clim AS ({CLIM_SQL}),
f AS (SELECT *, {TIME_SQL}, {ROLL_SQL}, {LAG_SQL}, {API_SQL} FROM obs)
SELECT f.*, c.clim_maxT, c.clim_precip, f.MaxTemp_2m - c.clim_maxT AS anom_maxT, f.Precip - c.clim_precip AS anom_precip
FROM f LEFT JOIN clim c ON f.District = c.District AND f.doy = c.doy""", "obs")
def features(spark, folder):
    return seasonal_rounded(X.build_features(obs(spark, folder)))


@query("select_features", f"""
WITH clim AS ({CLIM_SQL}),
f AS (SELECT *, {TIME_SQL}, {ROLL_SQL}, {LAG_SQL}, {API_SQL} FROM obs)
SELECT f.Date, f.District, Latitude, Longitude, Precip, precip_3d, precip_7d, precip_lag_1, precip_lag_3, precip_lag_7,
       MaxTemp_2m, maxT_3d_mean, maxT_lag_1, maxT_lag_3, f.MaxTemp_2m - c.clim_maxT AS anom_maxT, RH_2m, wetness_flag, API, TempRange_2m,
       WindSpeed_10m, WindSpeed_50m, doy_sin, doy_cos, month, year, h.heatwave, h.flood_proxy
FROM f LEFT JOIN clim c ON f.District = c.District AND f.doy = c.doy
       JOIN hazard_labels h ON f.District = h.District AND f.Date = h.Date""", "obs hazard_labels")
def select_features(spark, folder):
    labels = hazard_labels(spark, folder).drop("heat_run")
    return seasonal_rounded(M.select_features(X.build_features(obs(spark, folder)).join(labels, ["District", "Date"])))


@query("serving_features", f"""
WITH h AS (SELECT *, count(*) OVER p7 AS n, coalesce(Precip, CAST(0 AS DOUBLE)) AS r,
    round(sum(coalesce(Precip, CAST(0 AS DOUBLE))) OVER p3, 9) AS s3, round(sum(coalesce(Precip, CAST(0 AS DOUBLE))) OVER p7, 9) AS s7,
    round(avg(MaxTemp_2m) OVER p3, 9) AS m3
  FROM obs WINDOW p3 AS (PARTITION BY District ORDER BY Date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
                  p7 AS (PARTITION BY District ORDER BY Date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT District, Date, CASE WHEN n >= 7 THEN s3 ELSE r * 3.0 END AS precip_3d, CASE WHEN n >= 7 THEN s7 ELSE r * 7.0 END AS precip_7d,
  CASE WHEN n >= 7 THEN lag(r, 1) {ORD} ELSE r END AS precip_lag_1, CASE WHEN n >= 7 THEN lag(r, 3) {ORD} ELSE r END AS precip_lag_3,
  CASE WHEN n >= 7 THEN lag(r, 7) {ORD} ELSE r END AS precip_lag_7, CASE WHEN n >= 3 THEN m3 ELSE MaxTemp_2m END AS maxT_3d_mean,
  CASE WHEN n >= 3 THEN lag(MaxTemp_2m, 1) {ORD} ELSE MaxTemp_2m END AS maxT_lag_1,
  CASE WHEN n >= 3 THEN lag(MaxTemp_2m, 3) {ORD} ELSE MaxTemp_2m END AS maxT_lag_3,
  MaxTemp_2m - CAST(30 AS DOUBLE) AS anom_maxT, CAST(RH_2m > 80 AS BIGINT) AS wetness_flag, r * CAST(1.5 AS DOUBLE) AS API
FROM h""", "obs")
def serving_features(spark, folder):
    return X.serving_features(obs(spark, folder)).select(
        "District", "Date", "precip_3d", "precip_7d", "precip_lag_1", "precip_lag_3", "precip_lag_7", "maxT_3d_mean",
        "maxT_lag_1", "maxT_lag_3", "anom_maxT", "wetness_flag", "API",
    )


COLD_SQL = """
WITH c AS (SELECT *, coalesce(Precip, CAST(0 AS DOUBLE)) AS r, coalesce(MaxTemp_2m, CAST(30 AS DOUBLE)) AS t, coalesce(RH_2m, CAST(50 AS DOUBLE)) AS h FROM obs)
SELECT District, Date, r AS Precip, r * CAST(3 AS DOUBLE) AS precip_3d, r * CAST(7 AS DOUBLE) AS precip_7d, r AS precip_lag_1, r AS precip_lag_3,
  r AS precip_lag_7, t AS MaxTemp_2m, t AS maxT_3d_mean, t AS maxT_lag_1, t AS maxT_lag_3, t - CAST(30 AS DOUBLE) AS anom_maxT, h AS RH_2m,
  CAST(h > 80 AS BIGINT) AS wetness_flag, r * CAST(%s AS DOUBLE) AS API, TempRange_2m, WindSpeed_10m, WindSpeed_50m,
  %s AS doy_sin, %s AS doy_cos, month(Date) AS month, year(Date) AS year FROM c"""


@query("cold_start_features", COLD_SQL % ("0.9", "CAST(0.5 AS DOUBLE)", "CAST(0.5 AS DOUBLE)"), "obs")
def cold_start_features(spark, folder):
    return X.cold_start_features(obs(spark, folder), **X.STREAM_ROW)


@query("cold_start_form", COLD_SQL % (
    "1.5", "round(sin(CAST(2 AS DOUBLE) * pi() * dayofyear(Date) / CAST(365.25 AS DOUBLE)), 9)",
    "round(cos(CAST(2 AS DOUBLE) * pi() * dayofyear(Date) / CAST(365.25 AS DOUBLE)), 9)"), "obs")
def cold_start_form(spark, folder):
    return seasonal_rounded(X.cold_start_features(obs(spark, folder), **X.FORM_ROW))


# Sequences are compared through their length, ends and sums: the two engines print nested arrays differently.
def seq_sql(first, last, steps, label):
    frame = f"OVER (PARTITION BY District ORDER BY Date ROWS BETWEEN {first} PRECEDING AND {last})"
    return f"""
WITH s AS (SELECT o.District, o.Date, count(*) {frame} AS steps, first_value(o.MaxTemp_2m) {frame} AS first_temp,
   last_value(o.MaxTemp_2m) {frame} AS last_temp, round(sum(coalesce(o.Precip, CAST(0 AS DOUBLE))) {frame}, 6) AS rain_sum{label}
   FROM (SELECT o.*, h.heatwave FROM obs o JOIN hazard_labels h ON o.District = h.District AND o.Date = h.Date) o)
SELECT * FROM s WHERE steps = {steps}"""


def seq_view(df, *extra):
    return df.select(
        "District", "Date", F.size("sequence").cast("bigint").alias("steps"), F.col("sequence")[0][0].alias("first_temp"),
        F.element_at("sequence", -1)[0].alias("last_temp"),
        F.round(F.aggregate("sequence", F.lit(0.0), lambda s, x: s + x[1]), 6).alias("rain_sum"), *extra,
    )


SEQUENCE_INPUTS = ["MaxTemp_2m", "Precip", "RH_2m", "TempRange_2m"]


def labelled(spark, folder):
    return obs(spark, folder).join(hazard_labels(spark, folder), ["District", "Date"])


@query("sequences_train", seq_sql(14, "1 PRECEDING", 14, ", o.heatwave AS label"), "obs hazard_labels")
def sequences_train(spark, folder):
    return seq_view(M.training_sequences(labelled(spark, folder), SEQUENCE_INPUTS, "heatwave", 14), "label")


@query("sequences_30", seq_sql(30, "1 PRECEDING", 30, ", o.heatwave AS label"), "obs hazard_labels")
def sequences_30(spark, folder):
    return seq_view(M.training_sequences(labelled(spark, folder), SEQUENCE_INPUTS, "heatwave", 30), "label")


@query("sequences_score", seq_sql(13, "CURRENT ROW", 14, ""), "obs hazard_labels")
def sequences_score(spark, folder):
    return seq_view(M.scoring_sequences(obs(spark, folder), SEQUENCE_INPUTS, 14).filter(F.col("sequence").isNotNull()))
