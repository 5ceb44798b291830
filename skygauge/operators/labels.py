"""Heatwave and flood labels from per-district thresholds."""

from pyspark.sql import DataFrame, functions as F

from skygauge.operators.blocks import block_window, in_blocks, nearest, own_rows, per_block, run_lengths, with_lookback
from skygauge.operators.features import DIGITS
from skygauge.operators.percentiles import approx_percentiles, exact_percentiles
from skygauge.store import landed

HEAT_PCT, RAIN_PCT, RAIN3_PCT, WET_PCT = 0.95, 0.99, 0.98, 0.90


def fill_humidity(blocked: DataFrame) -> DataFrame:
    """Forward, then backward fill of humidity inside each district, as ``RH_2m_filled``.

    Expects the blocks of ``in_blocks``.
    """
    rh = F.col("RH_2m")
    both = nearest(blocked, before={"_rh_prev": rh}, after={"_rh_next": rh})
    return both.withColumn("RH_2m_filled", F.coalesce("_rh_prev", "_rh_next")).drop("_rh_prev", "_rh_next")


def add_rain_sums(df: DataFrame) -> DataFrame:
    """``precip_1d`` (missing rain is none) and its 3-row sum; the rows stay in blocks."""
    rained = with_lookback(df.withColumn("precip_1d", F.coalesce("Precip", F.lit(0.0))), 2, ["precip_1d"])
    total = F.sum("precip_1d").over(block_window().rowsBetween(-2, 0))
    return own_rows(rained.withColumn("precip_3d_sum", F.round(total, DIGITS)), keep_block=True)


HEAT_SPEC = {"temp_p95": ("MaxTemp_2m", HEAT_PCT)}


def flood_spec(humidity: str) -> dict:
    return {
        "precip_p99": ("precip_1d", RAIN_PCT),
        "precip3_p98": ("precip_3d_sum", RAIN3_PCT),
        "rh_p90": (humidity, WET_PCT),
    }


def thresholds(df: DataFrame, specs: dict, method="exact") -> DataFrame:
    return {"exact": exact_percentiles, "approx": approx_percentiles}[method](df, "District", specs)


def label_heatwave(df: DataFrame, method="exact", min_run=3, backfill_run=False, limits: DataFrame | None = None) -> DataFrame:
    """Heatwave = at least ``min_run`` consecutive rows above the district's threshold.

    Only the ``min_run``-th and later rows of a run are labelled, unless ``backfill_run``.
    ``min_run=1`` labels every exceedance.
    """
    limits = thresholds(df, HEAT_SPEC, method) if limits is None else limits
    hot = per_block(in_blocks(df), limits.select("District", "temp_p95")).withColumn(
        "heat_exceed", F.coalesce(F.col("MaxTemp_2m") > F.col("temp_p95"), F.lit(False)))
    runs = run_lengths(hot, "heat_exceed", "heat_run")
    flag = F.col("heat_run") >= min_run
    if backfill_run:
        # A row belongs to a long run when the run's label appears before its next cool row.
        runs = nearest(runs, after={
            "_next_cool": F.when(~F.col("heat_exceed"), F.col("Date")), "_next_hit": F.when(flag, F.col("Date"))})
        flag = F.col("heat_exceed") & (F.col("_next_hit") < F.coalesce("_next_cool", F.date_add("_next_hit", 1)))
    return runs.withColumn("heatwave", F.coalesce(flag, F.lit(False)).cast("bigint")).drop("_block", "_next_cool", "_next_hit")


def label_flood(df: DataFrame, method="exact", fill=True, nulls="false", limits: DataFrame | None = None) -> DataFrame:
    """Flood proxy = (day or 3-row rain above its threshold) and humidity above its threshold.

    ``fill`` fills humidity gaps inside the district first. With ``nulls="propagate"`` a wet day
    without humidity stays null instead of 0.
    """
    rained = add_rain_sums(df)
    humidity = "RH_2m"
    if fill:
        rained, humidity = fill_humidity(rained), "RH_2m_filled"
    limits = thresholds(rained, flood_spec(humidity), method) if limits is None else limits
    joined = per_block(rained, limits.select("District", "precip_p99", "precip3_p98", "rh_p90"))
    rainy = (F.col("precip_1d") > F.col("precip_p99")) | (F.col("precip_3d_sum") > F.col("precip3_p98"))
    wet = F.col(humidity) > F.col("rh_p90")
    proxy = F.coalesce(rainy, F.lit(False)) & wet
    if nulls == "false":
        proxy = F.coalesce(proxy, F.lit(False))
    return joined.withColumn("wetness_flag", wet).withColumn("flood_proxy", proxy.cast("bigint")).drop("_block")


ALL_SPECS = {**HEAT_SPEC, **flood_spec("RH_2m_filled")}


def label_base(df: DataFrame) -> DataFrame:
    """Temperature, rain sums and filled humidity in blocks: what both labels are made from.

    Landed, because the sketch, the counting pass, the labels and the run summaries all read it.
    """
    filled = fill_humidity(add_rain_sums(df.select("District", "Date", "MaxTemp_2m", "Precip", "RH_2m")))
    return landed(filled.drop("Precip", "RH_2m"), "label_base")


def hazard_labels(df: DataFrame, method="exact", min_run=3) -> DataFrame:
    """Both labels, the heat run and the wetness flag per (District, Date); all thresholds in one pass."""
    base = label_base(df)
    limits = landed(thresholds(base, ALL_SPECS, method), "label_limits")
    joined = per_block(base, limits)
    rainy = (F.col("precip_1d") > F.col("precip_p99")) | (F.col("precip_3d_sum") > F.col("precip3_p98"))
    wet = F.col("RH_2m_filled") > F.col("rh_p90")
    proxy = F.coalesce(rainy & wet, F.lit(False))
    hot = F.coalesce(F.col("MaxTemp_2m") > F.col("temp_p95"), F.lit(False))
    runs = run_lengths(joined.withColumns({"heat_exceed": hot, "wetness_flag": wet, "flood_proxy": proxy.cast("bigint")}), "heat_exceed", "heat_run")
    return runs.select(
        "District", "Date", (F.col("heat_run") >= min_run).cast("bigint").alias("heatwave"), "flood_proxy", "heat_run", "wetness_flag",
    )


def label_stats(labels: DataFrame) -> DataFrame:
    """Counts and percentages of both labels in one pass."""
    def share(c):
        return F.try_divide(F.count_if(F.col(c) == 1) * F.lit(100.0), F.count(F.lit(1)))
    return labels.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("heatwave") == 1).alias("heatwave_days"),
        F.count_if(F.col("flood_proxy") == 1).alias("flood_days"),
        share("heatwave").alias("heatwave_pct"), share("flood_proxy").alias("flood_pct"),
    )


def label_rate(labels: DataFrame) -> DataFrame:
    """Percentage of labelled days per district."""
    return labels.groupBy("District").agg(
        F.count(F.lit(1)).alias("days"),
        (F.sum("heatwave") * F.lit(100.0) / F.count("heatwave")).alias("heatwave_pct"),
        (F.sum("flood_proxy") * F.lit(100.0) / F.count("flood_proxy")).alias("flood_pct"),
    )
