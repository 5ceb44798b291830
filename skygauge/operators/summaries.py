"""Grouped summaries of observations and predictions. Every one combines before its shuffle.

Rain and temperature sums run on DECIMAL(28,12): exact, so results do not depend on row order.
"""

from pyspark.sql import Column, DataFrame, functions as F

from skygauge.functions.rules import alert_list, is_heavy_rain, is_hot

DIGITS = 9


def exact_sum(c) -> Column:
    return F.sum(F.col(c).cast("decimal(28,12)")).cast("double")


def exact_avg(c) -> Column:
    return F.round(F.try_divide(exact_sum(c), F.count(c)), DIGITS)


def any_true(c: Column) -> Column:
    return F.coalesce(F.bool_or(c), F.lit(False))


def by_district(df: DataFrame) -> DataFrame:
    return df.groupBy("District").agg(
        F.count(F.lit(1)).alias("records"), exact_avg("MaxTemp_2m").alias("avg_temp"), exact_sum("Precip").alias("total_precip")
    )


def batch_summary(df: DataFrame, keys=(), approximate=False) -> DataFrame:
    """Mean, maximum, rain, districts and hazard counts of a batch (or per ``keys``)."""
    districts = F.approx_count_distinct("District") if approximate else F.countDistinct("District")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"), exact_avg("MaxTemp_2m").alias("avg_temp"), F.max("MaxTemp_2m").alias("max_temp"),
        exact_sum("Precip").alias("total_precip"), districts.alias("districts"),
        F.count_if(is_hot(F.col("MaxTemp_2m"))).alias("heatwave_alerts"), F.count_if(is_heavy_rain(F.col("Precip"))).alias("flood_alerts"),
    )


def district_year_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("District", F.year("Date").cast("bigint").alias("year")).agg(
        exact_avg("MaxTemp_2m").alias("avg_temp"), F.max("MaxTemp_2m").alias("max_temp"),
        exact_sum("Precip").alias("total_precip"), F.count(F.lit(1)).alias("record_count"),
    )


def store_stats(observations: DataFrame, predictions: DataFrame, districts: DataFrame) -> DataFrame:
    """Observation and prediction counts per listed district (0 when it has none) and in total.

    The total row has a null District; ``monitored`` counts districts with observations.
    """
    counted = (
        observations.select("District", F.lit(1).alias("o"), F.lit(0).alias("p"))
        .unionByName(predictions.select("District", F.lit(0).alias("o"), F.lit(1).alias("p")))
        .groupBy("District").agg(F.sum("o").alias("o"), F.sum("p").alias("p"))
    )
    listed = districts.select("District").distinct().join(counted, "District", "left").na.fill(0, ["o", "p"])
    return listed.rollup("District").agg(
        F.sum("o").alias("observations"), F.sum("p").alias("predictions"), F.count_if(F.col("o") > 0).alias("monitored")
    )


def _spell(df, keys):
    """Aggregates shared by the daily and hourly tables."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("record_count"), exact_avg("max_temp").alias("avg_temp"), F.max("max_temp").alias("max_temp"),
        F.min("min_temp").alias("min_temp"), exact_sum("precipitation").alias("total_precip"), exact_avg("humidity").alias("avg_humidity"),
        F.count_if(is_hot(F.col("max_temp"))).alias("heatwave_alerts"), F.count_if(is_heavy_rain(F.col("precipitation"))).alias("flood_alerts"),
    )


def daily_summary(events: DataFrame) -> DataFrame:
    return _spell(events, ["District", F.col("fetch_time").cast("date").alias("date")])


def daily_flags(events: DataFrame) -> DataFrame:
    """Daily extremes with boolean hazard flags."""
    return events.groupBy("District", F.col("fetch_time").cast("date").alias("date")).agg(
        exact_avg("max_temp").alias("avg_temp"), F.max("max_temp").alias("max_temp"), F.min("min_temp").alias("min_temp"),
        exact_sum("precipitation").alias("total_precip"),
        any_true(is_hot(F.col("max_temp"))).alias("heatwave_flag"), any_true(is_heavy_rain(F.col("precipitation"))).alias("flood_flag"),
    )


def hourly_stats(events: DataFrame) -> DataFrame:
    hour = F.window("fetch_time", "1 hour")["start"].alias("hour_bucket")
    return _spell(events, ["District", hour]).drop("min_temp", "avg_humidity")


def ingest_counter(events: DataFrame) -> DataFrame:
    return events.groupBy(
        F.col("fetch_time").cast("date").alias("stat_date"), "District", F.hour("fetch_time").cast("bigint").alias("hour")
    ).agg(F.count(F.lit(1)).alias("record_count"))


def high_risk_rate(predictions: DataFrame, keys=("model", "target"), above=0.5) -> DataFrame:
    risky = F.count_if(F.col("probability") > above)
    return predictions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"), risky.alias("high_risk"), (risky * F.lit(100.0) / F.count(F.lit(1))).alias("high_risk_pct")
    )


def risk_summary(latest: DataFrame) -> DataFrame:
    """Districts at high risk by at least one model, per target; expects the latest predictions."""
    per_district = latest.groupBy("District", "target").agg(F.bool_or(F.col("risk") == "HIGH").alias("high"))
    return per_district.agg(
        F.count_if(F.col("high") & (F.col("target") == "heatwave")).alias("high_risk_heatwave"),
        F.count_if(F.col("high") & (F.col("target") == "flood_proxy")).alias("high_risk_flood"),
        F.countDistinct("District").alias("districts"),
    )


def alerts(df: DataFrame, district="District", time="fetch_time", temp="max_temp", rain="precipitation") -> DataFrame:
    """One row per alert; an observation can raise a heat and a flood alert."""
    raised = alert_list(F.col(temp), F.col(rain))
    return df.select("*", F.inline(raised)).select(
        *[c for c in ("id",) if c in df.columns], F.col(district).alias("district"), "alert_type", "severity",
        F.col(time).alias("timestamp"), F.col(temp).alias("temperature"), F.col(rain).alias("precipitation"), "message",
    )
