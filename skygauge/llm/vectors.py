"""Reading embedding tables: which vectors take part, and one row for each different vector."""

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(rows: DataFrame) -> DataFrame:
    """vec_id and embedding (array of doubles) of the vectors that take part.

    Null, empty and zero vectors and those with null or non-finite components don't; of different lengths, the most frequent
    one counts (of equally frequent ones the larger).
    """
    rows = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    fine = rows.where("vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0").where(
        ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))).where(F.exists("embedding", lambda x: x != 0))
    first = fine.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return fine.where(F.size("embedding") == (first.d if first else 0))


def smallest_ids(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of each different vector, those with the smallest ids; the limit runs before the shuffle too."""
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    return rows.withColumn("_place", place).where(F.col("_place") <= most).drop("_place")


def matrix(column) -> np.ndarray:
    """An Arrow list column of doubles, of one length, as a matrix."""
    flat = column.combine_chunks().flatten() if hasattr(column, "combine_chunks") else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
