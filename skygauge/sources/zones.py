"""Partitioned Parquet zones: append, replace partitions, upsert by key."""

from pyspark.sql import DataFrame, functions as F

from skygauge.store import read_if_present


def append_partitioned(df: DataFrame, path: str, by=("Date", "District")) -> None:
    """Append under one folder per key. The rebalance keeps a partition's rows in few files and
    splits partitions that are too big for one task."""
    df.hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(path)


def replace_partitions(df: DataFrame, path: str, by) -> None:
    """Overwrite only the partitions present in ``df``."""
    (
        df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by).parquet(path)
    )


def newest_per_key(df: DataFrame, key: list, newest: list) -> DataFrame:
    """One row per key, the one with the largest ``newest`` columns. Combines before the shuffle,
    so a key with very many versions does not gather them in one task."""
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*newest)).alias("_row"))
    return best.select(*key, "_row.*").select(*df.columns)


def upsert(updates: DataFrame, path: str, key: list, newest: list, by: list, time: str) -> None:
    """Insert or overwrite rows by primary key; only partitions touched by ``updates`` are rewritten.

    Rows inside a partition are sorted by ``time``, newest first. The partition columns must be
    functions of the key. Only the updates are reduced to one row per key; the stored rows of the touched partitions, unique already,
    are read once and joined with them once.
    """
    spark = updates.sparkSession
    kept = updates.persist()  # read for its partitions and its rows: computed once
    try:
        latest, columns = newest_per_key(kept, key, newest), updates.columns
        current = read_if_present(spark, path)
        if current is not None:
            here = current.select(*columns).join(kept.select(*by).distinct(), by, "left_semi")
            rest = F.struct(*[c for c in columns if c not in key])
            both = here.select(*key, rest.alias("_old")).join(latest.select(*key, rest.alias("_new")), key, "full_outer")
            rank = {side: F.struct(*[(F.col(c) if c in key else F.col(f"{side}.{c}")).alias(c) for c in newest]) for side in ("_old", "_new")}
            stays = F.col("_new").isNull() | (F.col("_old").isNotNull() & (rank["_old"] > rank["_new"]))
            latest = both.select(*key, F.when(stays, F.col("_old")).otherwise(F.col("_new")).alias("_row")).select(*key, "_row.*").select(*columns)
        (
            latest.hint("rebalance", *by).sortWithinPartitions(*by, F.desc(time))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
        )
    finally:
        kept.unpersist()
