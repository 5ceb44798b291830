"""Merging, slicing and subtracting tables."""

from pyspark.sql import DataFrame, functions as F

from skygauge.operators.ordered import positions
from skygauge.sources.zones import newest_per_key


def union_common(left: DataFrame, right: DataFrame | None) -> DataFrame:
    """Rows of both on the columns both have, in the left order; the left alone without a right."""
    if right is None:
        return left
    common = [c for c in left.columns if c in right.columns]
    types = dict(left.dtypes)
    return left.select(*common).unionByName(right.select(*[F.col(c).cast(types[c]).alias(c) for c in common]))


def merge_zones(history: DataFrame, stream: DataFrame | None, key=("District", "Date"), newest="ingestion_time") -> DataFrame:
    """One row per key: streamed rows beat historical ones, then the newest, then a hash of the row."""
    if stream is None:
        common, tagged = history.columns, history.withColumn("_zone", F.lit(0)).withColumn("_when", F.lit(None).cast("timestamp_ntz"))
    else:
        common = [c for c in history.columns if c in stream.columns]
        types = dict(history.dtypes)
        tagged = history.select(*common, F.lit(0).alias("_zone"), F.lit(None).cast("timestamp_ntz").alias("_when")).unionByName(
            stream.select(*[F.col(c).cast(types[c]).alias(c) for c in common], F.lit(1).alias("_zone"), F.col(newest).cast("timestamp_ntz").alias("_when")))
    ranked = tagged.withColumn("_tie", F.xxhash64(*common))
    return newest_per_key(ranked, list(key), ["_zone", "_when", "_tie"]).select(*common)


def slices(df: DataFrame, order: list, size: int) -> DataFrame:
    """Add ``batch``: the table in total order, cut into slices of ``size`` rows (1, 2, ...)."""
    return positions(df, order, "_n").withColumn("batch", F.floor((F.col("_n") - 1) / size) + 1).drop("_n")


def except_keys(left: DataFrame, right: DataFrame, key: list) -> DataFrame:
    """Left rows whose key is not on the right."""
    return left.join(right.select(*key).distinct(), key, "left_anti")
