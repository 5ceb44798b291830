"""Positions and running totals over a total order of a whole table.

An unpartitioned window would sort everything in one task. Instead the rows are range-partitioned
by the order columns (equal parts whatever the value distribution), the layout is pinned with a
checkpoint, and each part is scanned on its own. Only one row of totals per part is scanned
globally: its size is the number of partitions, not of rows.
"""

from pyspark.sql import DataFrame, Window as W, functions as F

from skygauge.store import cut_lineage


def running_totals(df: DataFrame, order: list, totals: dict, parts: int | None = None) -> DataFrame:
    """Add inclusive running sums ``{new name: column name}`` along ``order``.

    The order columns must identify a row, so that the order is total.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pinned = cut_lineage(
        df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    )
    before = W.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sums = pinned.groupBy("_part").agg(*[F.sum(c).alias(n) for n, c in totals.items()])
    starts = sums.select("_part", *[
        F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_start_{n}") for n in totals
    ])
    inside = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return (
        pinned.select("*", *[F.sum(c).over(inside).alias(n) for n, c in totals.items()])
        .join(F.broadcast(starts), "_part")  # one row per partition
        .withColumns({n: F.col(n) + F.col(f"_start_{n}") for n in totals})
        .drop("_part", *[f"_start_{n}" for n in totals])
    )


def positions(df: DataFrame, order: list, name="position", parts: int | None = None) -> DataFrame:
    """Add the 1-based position of each row in the total order."""
    return running_totals(df.withColumn("_one", F.lit(1)), order, {name: "_one"}, parts).drop("_one")
