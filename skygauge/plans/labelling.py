"""Threshold and label queries."""

from pyspark.sql import functions as F

from skygauge.operators import labels as L
from skygauge.operators.blocks import in_blocks
from skygauge.plans.registry import query
from skygauge.plans import views
from skygauge.plans.views import obs


def round_limits(df):
    return df.select(*[F.round(c, 9).alias(c) if c != "District" else F.col(c) for c in df.columns])


@query("ffill_bfill", "SELECT District, Date, RH_2m, RH_2m_filled FROM filled", "filled")
def ffill_bfill(spark, folder):
    return L.fill_humidity(in_blocks(obs(spark, folder).select("District", "Date", "RH_2m"))).drop("_block")


@query("thresholds_exact", """SELECT District, round(temp_p95, 9) AS temp_p95, round(precip_p99, 9) AS precip_p99,
  round(precip3_p98, 9) AS precip3_p98, round(rh_p90, 9) AS rh_p90 FROM limits""", "limits")
def thresholds_exact(spark, folder):
    return round_limits(L.thresholds(L.label_base(obs(spark, folder)), L.ALL_SPECS, "exact"))


@query("thresholds_approx", """SELECT District, quantile_disc(MaxTemp_2m, 0.95) AS temp_p95, quantile_disc(precip_1d, 0.99) AS precip_p99,
  quantile_disc(precip_3d_sum, 0.98) AS precip3_p98, quantile_disc(RH_2m_filled, 0.90) AS rh_p90 FROM filled GROUP BY District""", "filled")
def thresholds_approx(spark, folder):
    return L.thresholds(L.label_base(obs(spark, folder)), L.ALL_SPECS, "approx")


@query("heat_runs", "SELECT District, Date, heat_exceed, CAST(heat_run AS BIGINT) AS heat_run, heat_run >= 3 AS in_heatwave FROM runs", "runs")
def heat_runs(spark, folder):
    df = L.label_heatwave(obs(spark, folder).select("District", "Date", "MaxTemp_2m"))
    return df.select("District", "Date", "heat_exceed", "heat_run", (F.col("heatwave") == 1).alias("in_heatwave"))


@query("label_heatwave", "SELECT r.District, r.Date, round(temp_p95, 9) AS temp_p95, heat_exceed, CAST(heat_run >= 3 AS BIGINT) AS heatwave FROM runs r", "runs")
def label_heatwave(spark, folder):
    df = L.label_heatwave(obs(spark, folder).select("District", "Date", "MaxTemp_2m"))
    return df.select("District", "Date", F.round("temp_p95", 9).alias("temp_p95"), "heat_exceed", "heatwave")


@query("label_heatwave_plain", """
WITH q AS (SELECT District, quantile_disc(MaxTemp_2m, 0.95) AS temp_p95 FROM obs GROUP BY District)
SELECT o.District, o.Date, q.temp_p95, CAST(o.MaxTemp_2m > q.temp_p95 AS BIGINT) AS heatwave FROM obs o JOIN q ON o.District = q.District""", "obs")
def label_heatwave_plain(spark, folder):
    df = L.label_heatwave(obs(spark, folder).select("District", "Date", "MaxTemp_2m"), method="approx", min_run=1)
    return df.select("District", "Date", "temp_p95", "heatwave")


@query("label_heatwave_whole_run", """
SELECT District, Date, CAST(heat_exceed AND max(heat_run) OVER (PARTITION BY District, island) >= 3 AS BIGINT) AS heatwave FROM runs""", "runs")
def label_heatwave_whole_run(spark, folder):
    df = L.label_heatwave(obs(spark, folder).select("District", "Date", "MaxTemp_2m"), backfill_run=True)
    return df.select("District", "Date", "heatwave")


@query("label_flood", """SELECT District, Date, precip_1d, precip_3d_sum, RH_2m_filled > rh_p90 AS wetness_flag,
  CAST(coalesce((precip_1d > precip_p99 OR precip_3d_sum > precip3_p98) AND RH_2m_filled > rh_p90, FALSE) AS BIGINT) AS flood_proxy FROM runs""", "runs")
def label_flood(spark, folder):
    df = L.label_flood(obs(spark, folder).select("District", "Date", "Precip", "RH_2m"))
    return df.select("District", "Date", "precip_1d", "precip_3d_sum", "wetness_flag", "flood_proxy")


@query("label_flood_unfilled", """
WITH q AS (SELECT District, quantile_disc(precip_1d, 0.99) AS p1, quantile_disc(precip_3d_sum, 0.98) AS p3, quantile_disc(RH_2m, 0.90) AS rh FROM filled GROUP BY District)
SELECT f.District, f.Date, CAST((precip_1d > p1 OR precip_3d_sum > p3) AND RH_2m > rh AS BIGINT) AS flood_proxy
FROM filled f JOIN q ON f.District = q.District""", "filled")
def label_flood_unfilled(spark, folder):
    df = L.label_flood(obs(spark, folder).select("District", "Date", "Precip", "RH_2m"), method="approx", fill=False, nulls="propagate")
    return df.select("District", "Date", "flood_proxy")


@query("hazard_labels", "SELECT District, Date, heatwave, flood_proxy, heat_run, wetness_flag FROM hazard_labels", "hazard_labels")
def hazard_labels(spark, folder):
    return L.hazard_labels(obs(spark, folder))


@query("label_stats", """SELECT count(*) AS records, sum(heatwave)::BIGINT AS heatwave_days, sum(flood_proxy)::BIGINT AS flood_days,
  sum(heatwave)::BIGINT * CAST(100 AS DOUBLE) / count(*) AS heatwave_pct, sum(flood_proxy)::BIGINT * CAST(100 AS DOUBLE) / count(*) AS flood_pct FROM hazard_labels""", "hazard_labels")
def label_stats(spark, folder):
    return L.label_stats(views.hazard_labels(spark, folder))


@query("label_rate_by_district", """SELECT District, count(*) AS days, sum(heatwave)::BIGINT * CAST(100 AS DOUBLE) / count(*) AS heatwave_pct,
  sum(flood_proxy)::BIGINT * CAST(100 AS DOUBLE) / count(*) AS flood_pct FROM hazard_labels GROUP BY District""", "hazard_labels")
def label_rate_by_district(spark, folder):
    return L.label_rate(views.hazard_labels(spark, folder))
