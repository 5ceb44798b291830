"""Serving views: newest rows, top-k, latest per group, best model, serving documents."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def newest(df: DataFrame, time: str, n: int, tie=(), district: str | None = None) -> DataFrame:
    """The newest ``n`` rows, of one district if given; ``tie`` columns make the cut deterministic."""
    rows = df if district is None else df.filter(F.col("District") == district)
    return rows.orderBy(F.desc(time), *tie).limit(n)


def recent(df: DataFrame, time: str, hours=0, days=0, as_of=None) -> DataFrame:
    """Rows of the last hours or days before ``as_of`` (default: the newest row)."""
    end = df.agg(F.max(time)).scalar() if as_of is None else F.lit(as_of)
    return df.filter(F.col(time) >= end - F.make_dt_interval(F.lit(days), F.lit(hours)))


def hot_days(df: DataFrame, district: str, year: int, above=40.0) -> DataFrame:
    """One district's days above a temperature in one year; the year as a date range prunes row groups."""
    first, after = F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year + 1}-01-01").cast("date")
    return df.filter((F.col("District") == district) & (F.col("Date") >= first) & (F.col("Date") < after) & (F.col("MaxTemp_2m") > above))


def latest_per(df: DataFrame, keys: list, time: str, tie: str | None = None) -> DataFrame:
    """The newest row per group as an aggregate: combines before the shuffle, so hot groups are cheap.

    Of rows with equal times the one with the smallest ``tie`` stays, as in :func:`newest`.
    """
    rest = F.struct(*[c for c in df.columns if c not in keys])
    at = F.col(time)
    if tie is None:
        return df.groupBy(*keys).agg(F.max_by(rest, at).alias("_row")).select(*keys, "_row.*").select(*df.columns)
    # per time the smallest tie, then the newest time: both steps combine before the shuffle
    per_time = df.groupBy(*keys, at.alias("_time")).agg(F.min_by(rest, tie).alias("_row"))
    return per_time.groupBy(*keys).agg(F.max_by("_row", "_time").alias("_row")).select(*keys, "_row.*").select(*df.columns)


def top_per_district(df: DataFrame, time: str, limit: int, share=5, tie=()) -> DataFrame:
    """``limit // share`` newest rows of each district, all sorted by time.

    The row limit is applied before the shuffle too, so a task gets a few rows per upstream task.
    """
    w = W.partitionBy("District").orderBy(F.desc(time), *tie)
    return (
        df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= limit // share)
        .drop("_rank").orderBy(F.desc(time), *tie)
    )


def history_view(df: DataFrame, n=15, tie=("id",)) -> DataFrame:
    """The newest rows as a reader sees them: rounded, probabilities in percent."""
    return newest(df, "fetch_time", n, tie).select(
        F.date_format("fetch_time", "yyyy-MM-dd HH:mm:ss").alias("time"), "District",
        F.round("max_temp", 1).alias("temp"), F.round("humidity", 0).alias("humidity"), F.round("precipitation", 1).alias("precip"),
        F.round(F.col("heatwave_probability") * 100.0, 1).alias("heatwave_pct"), F.round(F.col("flood_probability") * 100.0, 1).alias("flood_pct"),
    )


def recent_summary(df: DataFrame, time: str, n=100, tie=()) -> DataFrame:
    """Summary of the newest ``n`` records."""
    return newest(df, time, n, tie).agg(
        F.round(F.avg("max_temp"), 9).alias("avg_temp"), F.max("max_temp").alias("max_temp"),
        F.round(F.sum("precipitation"), 6).alias("total_precip"), F.count(F.lit(1)).alias("records"), F.countDistinct("District").alias("districts"),
    )


def latest_model(registry: DataFrame) -> DataFrame:
    """The newest saved model per (model, target)."""
    return latest_per(registry, ["model", "target"], "saved_at", "path")


# Which model a reader prefers.
MODEL_ORDER = ("xgboost", "lstm", "rule")


def best_model(latest: DataFrame, order=MODEL_ORDER) -> DataFrame:
    """Per district and target the prediction of the best model that has one."""
    rank = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    known = latest.filter(F.col("model").isin(*order))
    return known.groupBy("District", "target").agg(F.min_by(F.struct("model", "probability", "risk"), rank).alias("_b")).select(
        "District", "target", F.upper("_b.model").alias("model"), "_b.probability", "_b.risk")


def prediction_pivot(latest: DataFrame) -> DataFrame:
    """One row per district and target: probability per model, risk from the tree model."""
    wide = latest.groupBy("District", "target").pivot("model", ["xgboost", "lstm"]).agg(
        F.first("probability").alias("probability"), F.first("risk").alias("risk"))
    return wide.select(
        "District", "target", F.col("xgboost_probability").alias("xgb_probability"), "lstm_probability",
        F.coalesce("xgboost_risk", F.lit("UNKNOWN")).alias("risk"))


def serving_document(latest: DataFrame) -> DataFrame:
    """Per district one JSON document target -> model -> prediction, and the counts readers show.

    One small row per (district, model, target) goes in, so the maps are bounded by the number of
    models and targets.
    """
    def entry(*fields) -> Column:
        return F.struct(*fields)
    per_target = latest.groupBy("District", "target").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry("model", entry("probability", "risk", F.col("Date").cast("string").alias("date")))))).alias("models"),
        F.bool_or(F.col("risk") == "HIGH").alias("high"), F.count(F.lit(1)).alias("n"),
    )
    return per_target.groupBy("District").agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry("target", F.to_json("models")))))).alias("document"),
        F.count_if(F.col("high")).alias("high_targets"), F.sum("n").alias("predictions"),
    )
