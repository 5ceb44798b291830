"""Features of the daily panel: calendar, rolling, lag, antecedent rain, climatology, serving rows.

Frames count rows, not days (a gap in the dates is not a gap in the frame), unless
``calendar=True``. ``(District, Date)`` has to be unique; ``sets.merge_zones`` makes it so.
Rolling sums and means are rounded to 9 digits, far below any instrument, so that equal rain
totals compare equal whatever order they were added in.
"""

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from skygauge.functions.calendar import calendar_terms
from skygauge.operators.blocks import block_window, in_blocks, own_rows, with_lookback

LAGS = (1, 2, 3, 7, 14)
DECAY = 0.8
DIGITS = 9
API_DIGITS = 6


def add_time_features(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar_terms(F.col("Date")))


def rolling_columns(w) -> dict:
    def over(agg, column, rows):
        return agg(column).over(w.rowsBetween(1 - rows, 0))
    return {
        "precip_3d": F.round(over(F.sum, "Precip", 3), DIGITS),
        "precip_7d": F.round(over(F.sum, "Precip", 7), DIGITS),
        "maxT_3d_mean": F.round(over(F.avg, "MaxTemp_2m", 3), DIGITS),
        "temp_range_3d_max": over(F.max, "TempRange_2m", 3),
    }


def lag_columns(w) -> dict:
    return {
        f"{name}_lag_{k}": F.lag(column, k).over(w)
        for k in LAGS for name, column in (("precip", "Precip"), ("maxT", "MaxTemp_2m"))
    }


#: rows of one stretch of the antecedent rain index; the scale decay^-i stays finite within it
STRETCH = 256


def _stretch(decay: float) -> int:
    return max(1, min(STRETCH, math.floor(200 / -math.log10(decay))))


def _underflow(decay: float) -> int:
    """Rows after which a term's weight is below the smallest double: leaving it out changes nothing."""
    return math.ceil(746 / -math.log(decay))


def with_api(blocked: DataFrame, decay: float = DECAY) -> DataFrame:
    """Add API to rows that carry ``_block``: s[t] = decay * s[t-1] + rain[t] over the whole history.

    Inside a stretch of a block a running sum of rain scaled by decay^-i, scaled back; between stretches
    a tree scan of their end values carries the state.
    """
    if not 0 < decay < 1:
        raise ValueError("decay lies between 0 and 1")
    size = _stretch(decay)
    at = F.row_number().over(block_window()) - 1
    parts = W.partitionBy("District", "_block", "_part")
    placed = blocked.withColumn("_at", at).withColumns({"_part": F.floor(F.col("_at") / size), "_i": F.col("_at") % size + 1})
    rain = F.coalesce("Precip", F.lit(0.0))
    running = F.sum(rain * F.pow(F.lit(decay), -F.col("_i"))).over(parts.orderBy("Date").rowsBetween(W.unboundedPreceding, 0))
    local = placed.withColumn("_local", F.pow(F.lit(decay), F.col("_i")) * running)
    ends = local.groupBy("District", "_block", "_part").agg(F.count(F.lit(1)).alias("_n"), F.max_by("_local", "_i").alias("_end"))
    return local.join(_carried(ends, decay), ["District", "_block", "_part"]).withColumn(
        "API", F.round(F.col("_local") + F.pow(F.lit(decay), F.col("_i")) * F.col("_carry"), API_DIGITS)).drop("_at", "_part", "_i", "_local", "_carry")


#: blocks that are combined before the scan along a district
GROUP = 64


def _carried(ends: DataFrame, decay: float) -> DataFrame:
    """``_carry``, the state before each stretch, by a tree scan over (rows, end value) pairs.

    Two neighbouring pairs combine to (n + m, end * decay^m + other), in any grouping: stretches to their block, blocks to groups of
    ``GROUP``; on the way down each adds what lies before it in the next larger unit. Along a district there is one row for each block.
    """
    def joined(a, b):
        return F.struct((a["_n"] + b["_n"]).alias("_n"), (a["_end"] * F.pow(F.lit(decay), b["_n"]) + b["_end"]).alias("_end"))

    def earlier(pairs, w, start=W.unboundedPreceding):
        nothing = F.struct(F.lit(0).cast("bigint").alias("_n"), F.lit(0.0).alias("_end"))
        return F.aggregate(F.collect_list(pairs).over(w.rowsBetween(start, -1)), nothing, joined)

    pair = F.struct("_n", "_end")
    parts = ends.withColumn("_in_block", earlier(pair, W.partitionBy("District", "_block").orderBy("_part")))
    blocks = parts.groupBy("District", "_block").agg(F.max_by(joined(F.col("_in_block"), pair), "_part").alias("_whole"))
    along = W.partitionBy("District").orderBy("_block")
    blocks = blocks.withColumn("_block_group", F.floor((F.row_number().over(along) - 1) / GROUP))
    blocks = blocks.withColumn("_in_group", earlier(F.col("_whole"), W.partitionBy("District", "_block_group").orderBy("_block")))
    ends_group = F.lead("_block_group").over(along).eqNullSafe(F.col("_block_group"))
    blocks = blocks.withColumn("_group_whole", F.when(~ends_group, joined(F.col("_in_group"), F.col("_whole"))))
    # a block has a row at least, so what ended further back has no weight left
    blocks = blocks.withColumn("_groups", earlier(F.col("_group_whole"), along, -(_underflow(decay) + GROUP)))
    blocks = blocks.select("District", "_block", joined(F.col("_groups"), F.col("_in_group"))["_end"].alias("_before"))
    carry = F.col("_before") * F.pow(F.lit(decay), F.col("_in_block._n")) + F.col("_in_block._end")
    return parts.join(blocks, ["District", "_block"]).select("District", "_block", "_part", carry.alias("_carry"))


PANEL_VALUES = ["Precip", "MaxTemp_2m", "TempRange_2m"]


def _in_blocks(df: DataFrame, lookback: int, columns, values=None, block: Column | None = None, keep_block=False) -> DataFrame:
    """Add window columns computed per district and block (a year, or ``block``) instead of per district."""
    values = [c for c in values or PANEL_VALUES if c in df.columns]
    return own_rows(with_lookback(df, lookback, values, block=block).withColumns(columns(block_window())), keep_block)


def add_rolling(df: DataFrame, block: Column | None = None) -> DataFrame:
    return _in_blocks(df, 6, rolling_columns, block=block)


def add_lags(df: DataFrame, block: Column | None = None) -> DataFrame:
    return _in_blocks(df, max(LAGS), lag_columns, block=block)


def add_api(df: DataFrame, decay: float = DECAY, block: Column | None = None) -> DataFrame:
    return with_api(in_blocks(df, block=block), decay).drop("_block")


def add_rolling_calendar(df: DataFrame, days=(3, 7)) -> DataFrame:
    """Rain sums over calendar days instead of rows: exact when dates have gaps.

    Each row is copied into the month of every day that can see it, so a window holds one
    (district, month) and its lead-in, however far the frames reach.
    """
    day = F.unix_date("Date")
    home = F.trunc("Date", "month")
    ahead = F.trunc(F.date_add("Date", max(days) - 1), "month")
    months = F.sequence(home, ahead, F.expr("interval 1 month"))
    copied = df.withColumn("_block", F.explode(months)).withColumn("_own", F.col("_block") == home)
    w = W.partitionBy("District", "_block").orderBy(day)
    return own_rows(copied.withColumns({
        f"precip_{n}cd": F.round(F.sum("Precip").over(w.rangeBetween(1 - n, 0)), DIGITS) for n in days
    }))


def climatology(df: DataFrame) -> DataFrame:
    """Median temperature and rain per district and day of the year.

    A group holds one value per year, so the exact median is cheap.
    """
    return df.groupBy("District", F.dayofyear("Date").cast("bigint").alias("doy")).agg(
        F.median("MaxTemp_2m").alias("clim_maxT"), F.median("Precip").alias("clim_precip")
    )


def add_anomaly(df: DataFrame, clim: DataFrame | None = None) -> DataFrame:
    clim = climatology(df) if clim is None else clim
    return (
        df.withColumn("doy", F.dayofyear("Date").cast("bigint"))
        .join(clim, ["District", "doy"], "left")  # broadcast only if its statistics say it is small
        .withColumn("anom_maxT", F.col("MaxTemp_2m") - F.col("clim_maxT"))
        .withColumn("anom_precip", F.col("Precip") - F.col("clim_precip"))
    )


def window_features(df: DataFrame, decay: float = DECAY, block: Column | None = None) -> DataFrame:
    """Calendar, rolling, lag and antecedent rain features in one window pass. Keeps every input column."""
    rolled = _in_blocks(df, max(LAGS), lambda w: {**rolling_columns(w), **lag_columns(w)}, block=block, keep_block=True)
    return add_time_features(with_api(rolled, decay).drop("_block"))


def build_features(df: DataFrame, decay: float = DECAY, block: Column | None = None) -> DataFrame:
    """The window features, then the climatology join."""
    return add_anomaly(window_features(df, decay, block), climatology(df))


# Constants of the two single-observation rows.
STREAM_ROW = {"api_factor": 0.9, "base_temp": 30.0, "wet_above": 80.0, "season": 0.5}
FORM_ROW = {"api_factor": 1.5, "base_temp": 30.0, "wet_above": 80.0, "season": None}


def cold_start_features(df: DataFrame, api_factor=0.9, base_temp=30.0, wet_above=80.0, season=None) -> DataFrame:
    """A model input row from one observation alone: today stands in for the missing history.

    ``season`` fixes both seasonal terms to a constant; None computes them from the date.
    """
    rain = F.coalesce("Precip", F.lit(0.0))
    temp, wet = F.coalesce("MaxTemp_2m", F.lit(30.0)), F.coalesce("RH_2m", F.lit(50.0))
    terms = calendar_terms(F.col("Date"))
    return df.select(
        "District", "Date", rain.alias("Precip"), (rain * 3.0).alias("precip_3d"), (rain * 7.0).alias("precip_7d"),
        *[rain.alias(f"precip_lag_{k}") for k in (1, 3, 7)],
        temp.alias("MaxTemp_2m"), temp.alias("maxT_3d_mean"),
        *[temp.alias(f"maxT_lag_{k}") for k in (1, 3)],
        (temp - base_temp).alias("anom_maxT"), wet.alias("RH_2m"),
        (wet > wet_above).cast("bigint").alias("wetness_flag"), (rain * api_factor).alias("API"),
        F.coalesce("TempRange_2m", F.lit(10.0)).alias("TempRange_2m"),
        F.coalesce("WindSpeed_10m", F.lit(5.0)).alias("WindSpeed_10m"),
        F.coalesce("WindSpeed_50m", F.lit(10.0)).alias("WindSpeed_50m"),
        (terms["doy_sin"] if season is None else F.lit(season)).alias("doy_sin"),
        (terms["doy_cos"] if season is None else F.lit(season)).alias("doy_cos"),
        terms["month"].alias("month"), terms["year"].alias("year"),
    )


def serving_features(df: DataFrame, api_factor=1.5, base_temp=30.0, wet_above=80.0) -> DataFrame:
    """A model input row per observation from the rows before it, with cold-start values early on.

    Rain terms need 7 earlier rows and temperature terms 3; the history excludes the row itself,
    so lag k is the k-th latest of the history and the sums end one row back.
    """
    lookback = 7

    def columns(w):
        hist = F.count(F.lit(1)).over(w.rowsBetween(-lookback, -1))
        rain, temp = F.coalesce("Precip", F.lit(0.0)), F.col("MaxTemp_2m")
        long, some = hist >= 7, hist >= 3

        def past(agg, column, rows):
            return F.round(agg(column).over(w.rowsBetween(-rows, -1)), DIGITS)
        return {
            "precip_3d": F.when(long, past(F.sum, rain, 3)).otherwise(rain * 3.0),
            "precip_7d": F.when(long, past(F.sum, rain, 7)).otherwise(rain * 7.0),
            **{f"precip_lag_{k}": F.when(long, F.lag(rain, k).over(w)).otherwise(rain) for k in (1, 3, 7)},
            "maxT_3d_mean": F.when(some, past(F.avg, temp, 3)).otherwise(temp),
            **{f"maxT_lag_{k}": F.when(some, F.lag(temp, k).over(w)).otherwise(temp) for k in (1, 3)},
            "anom_maxT": temp - base_temp,
            "wetness_flag": (F.col("RH_2m") > wet_above).cast("bigint"),
            "API": rain * api_factor,
        }
    return add_time_features(_in_blocks(df, lookback, columns))
