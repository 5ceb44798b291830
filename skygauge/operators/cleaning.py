"""Cleaning, coercion, imputation, validation and profiling of observations."""

from pyspark.sql import DataFrame, functions as F

from skygauge.operators.learning import input_columns
from skygauge.schemas import OBSERVATION


def clean_columns(df: DataFrame) -> DataFrame:
    """Trim the column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def parse_dates(df: DataFrame, column="Date") -> DataFrame:
    """Text to date by its first ten characters; null when it is no date. The column must exist."""
    if column not in df.columns:
        raise ValueError(f"no {column} column in {df.columns}")
    text = F.substring(F.col(column).cast("string"), 1, 10)
    return df.withColumn(column, F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))))


MEASURES = [f.name for f in OBSERVATION.fields if f.name not in ("District", "Date")]


def _loadable():
    """A row loads when its date parses and every measure that is given is a number."""
    ok = F.col("_date").isNotNull()
    for c in MEASURES:
        ok = ok & (F.col(c).isNull() | F.col(c).try_cast("double").isNotNull())
    return ok


def _dated(df):
    return df.withColumn("_date", F.to_date(F.try_to_timestamp(F.substring("Date", 1, 10), F.lit("yyyy-MM-dd"))))


def coerce_rows(df: DataFrame) -> DataFrame:
    """Text rows to typed rows: unknown district and missing measures get defaults, bad rows are left out."""
    return _dated(df).filter(_loadable()).select(
        F.coalesce("District", F.lit("Unknown")).alias("District"), F.year("_date").cast("bigint").alias("year"), F.col("_date").alias("Date"),
        *[F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias(c) for c in MEASURES],
    )


def rejects(df: DataFrame) -> DataFrame:
    """The rows ``coerce_rows`` leaves out, as they came."""
    return _dated(df).filter(~_loadable()).drop("_date")


def null_if_not_finite(df: DataFrame, columns=None) -> DataFrame:
    """NaN and infinities to null, so that aggregates and comparisons skip them."""
    inf = float("inf")
    names = columns or [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({
        c: F.when(~F.isnan(c) & (F.col(c) != inf) & (F.col(c) != -inf), F.col(c)) for c in names
    })


def impute(df: DataFrame, value: float, columns=None) -> DataFrame:
    """Null, NaN and infinities to a constant: -999 for trees, 0 for sequences."""
    names = columns or [n for n, t in df.dtypes if t in ("double", "float")]
    return null_if_not_finite(df, names).na.fill(value, names)


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "missing")


def dataset_profile(df: DataFrame) -> DataFrame:
    """Rows, columns, date range and districts, one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.min("Date").alias("first_date"), F.max("Date").alias("last_date"), F.countDistinct("District").alias("districts"),
    )


def time_split(df: DataFrame, days=365) -> DataFrame:
    """Tag rows ``train`` or ``test``: the last ``days`` days are the test set."""
    cutoff = df.agg(F.date_sub(F.max("Date"), days).alias("cutoff")).scalar()
    return df.withColumn("split", F.when(F.col("Date") < cutoff, "train").otherwise("test"))


def prepare_xy(df: DataFrame, target="heatwave", fill=-999.0, excluded=None) -> DataFrame:
    """Model inputs and an integer target: rows without target dropped, gaps filled."""
    inputs = input_columns(df, excluded)
    known = df.filter(F.col(target).isNotNull())
    return known.select(
        "District", "Date", *[F.coalesce(F.col(c).cast("double"), F.lit(fill)).alias(c) for c in inputs],
        F.col(target).cast("bigint").alias("y"),
    )
