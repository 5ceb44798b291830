"""Row-order operators over long per-key histories without one task per key.

A window partitioned by the key alone puts a whole key into one task, however long its history
is. Here every window runs per (key, calendar block) instead; a block is a year by default, so a
daily panel has at most 366 rows in one, whatever share of all rows its key holds:

* a frame that looks back at most ``k`` rows gets those rows copied in from the blocks before
  (:func:`with_lookback`); the wide rows are shuffled once, the copies carry only what the
  frame reads;
* an unbounded frame keeps one summary value per block, and only the summaries, one row per key
  and year, are scanned along the key (:func:`nearest`, :func:`run_lengths`).

``order`` must be unique per key, and a block must be a non-decreasing function of it.
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

def in_blocks(df: DataFrame, order="Date", block: Column | None = None) -> DataFrame:
    """Tag rows with their block."""
    return df.withColumn("_block", F.year(order) if block is None else block)


def block_window(key="District", order="Date"):
    return W.partitionBy(key, "_block").orderBy(order)


def _before(key):
    return W.partitionBy(key).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)


def with_lookback(df: DataFrame, rows: int, values: list, key="District", order="Date", block: Column | None = None) -> DataFrame:
    """Add ``_block`` and ``_own``; each block also holds the ``rows`` rows that precede it.

    The copied rows carry ``key``, ``order`` and ``values``. Compute windows per
    ``block_window``, then keep the :func:`own_rows`.
    """
    own = in_blocks(df, order, block)
    along = W.partitionBy(key).orderBy("_block")
    sizes = own.groupBy(key, "_block").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(_before(key)), F.lit(0)))
    # Every block has a row, so ``rows`` preceding rows lie in at most ``rows`` preceding blocks.
    reach = starts.select(
        key, "_block", (F.col("_start") + F.col("_n")).alias("_end"),
        F.collect_list(F.struct("_block", "_start")).over(along.rowsBetween(1, rows)).alias("_next"),
    )
    newest_first = W.partitionBy(key, "_block").orderBy(F.desc(order))
    tails = own.select(key, order, "_block", *values).withColumn("_back", F.row_number().over(newest_first)).filter(F.col("_back") <= rows)
    needed = F.filter("_next", lambda b: b["_start"] - F.col("_end") + F.col("_back") <= rows)
    copies = (
        tails.join(reach, [key, "_block"])
        .select(key, order, *values, F.explode(needed["_block"]).alias("_block"), F.lit(False).alias("_own"))
    )
    return own.withColumn("_own", F.lit(True)).unionByName(copies, allowMissingColumns=True)


def own_rows(df: DataFrame, keep_block=False) -> DataFrame:
    """Drop the copies."""
    kept = df.filter("_own").drop("_own")
    return kept if keep_block else kept.drop("_block")


def nearest(df: DataFrame, before: dict | None = None, after: dict | None = None, key="District", order="Date") -> DataFrame:
    """Add, per entry ``name: column``, the nearest non-null value at or before (after) each row.

    Expects ``_block`` and no copies.
    """
    before, after = before or {}, after or {}
    summary = df.groupBy(key, "_block").agg(
        *[F.max_by(c, F.when(c.isNotNull(), F.col(order))).alias(n) for n, c in before.items()],
        *[F.min_by(c, F.when(c.isNotNull(), F.col(order))).alias(n) for n, c in after.items()],
    )
    along = W.partitionBy(key).orderBy("_block")
    carried = summary.select(
        key, "_block",
        *[F.last(n, ignorenulls=True).over(along.rowsBetween(W.unboundedPreceding, -1)).alias(f"_far_{n}") for n in before],
        *[F.first(n, ignorenulls=True).over(along.rowsBetween(1, W.unboundedFollowing)).alias(f"_far_{n}") for n in after],
    )
    # Looking ahead is looking back in reverse order: a growing frame, linear in the block's length.
    forward, backward = block_window(key, order), W.partitionBy(key, "_block").orderBy(F.desc(order))
    found = df.withColumns({
        **{n: F.last(c, ignorenulls=True).over(forward.rowsBetween(W.unboundedPreceding, 0)) for n, c in before.items()},
        **{n: F.last(c, ignorenulls=True).over(backward.rowsBetween(W.unboundedPreceding, 0)) for n, c in after.items()},
    })
    names = [*before, *after]
    return found.join(carried, [key, "_block"]).withColumns({n: F.coalesce(n, f"_far_{n}") for n in names}).drop(*[f"_far_{n}" for n in names])


def run_lengths(df: DataFrame, flag: str, name: str, key="District", order="Date") -> DataFrame:
    """Add ``name``: how many rows in a row, up to and including this one, have ``flag``.

    Expects ``_block`` and no copies; ``flag`` must not be null.
    """
    w = block_window(key, order)
    at = F.row_number().over(w)
    numbered = df.withColumn("_at", at).withColumn(
        "_stop", F.max(F.when(~F.col(flag), F.col("_at"))).over(w.rowsBetween(W.unboundedPreceding, 0)))
    blocks = numbered.groupBy(key, "_block").agg(F.max("_at").alias("_n"), F.max("_stop").alias("_last"))
    starts = blocks.withColumn("_start", F.coalesce(F.sum("_n").over(_before(key)), F.lit(0)))
    carried = starts.select(key, "_block", "_start", F.max(F.col("_start") + F.col("_last")).over(_before(key)).alias("_far"))
    stop = F.coalesce(F.col("_start") + F.col("_stop"), "_far", F.lit(0))
    return (
        numbered.join(carried, [key, "_block"])
        .withColumn(name, F.col("_start") + F.col("_at") - stop).drop("_at", "_stop", "_start", "_far")
    )


def per_block(df: DataFrame, table: DataFrame, key="District") -> DataFrame:
    """Left-join a per-key table onto blocked rows by (key, block).

    The table is first spread over the key's blocks, a few rows per key. So a hot key's rows stay
    where they are, in their blocks, and are never gathered by key.
    """
    blocks = df.select(key, "_block").distinct().join(table, key)
    return df.join(blocks, [key, "_block"], "left")
