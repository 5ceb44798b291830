"""Calendar terms of a date column."""

from pyspark.sql import Column, functions as F


def season_angle(day: Column, days=365.25) -> Column:
    return F.lit(2.0) * F.pi() * F.dayofyear(day) / days


def calendar_terms(day: Column) -> dict:
    return {
        "doy": F.dayofyear(day).cast("bigint"),
        "doy_sin": F.sin(season_angle(day)),
        "doy_cos": F.cos(season_angle(day)),
        "year": F.year(day).cast("bigint"),
        "month": F.month(day).cast("bigint"),
    }
