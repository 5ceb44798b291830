"""Change propagation: derived zones are kept current by rewriting only the blocks that a change reaches.

A zone is a folder of (District, year) blocks. New rows name the touched blocks; from there

* the windows and the rain index reach the blocks with one of the next :func:`reach_rows` rows, and are computed from as many
  rows before them (:func:`reached`);
* a humidity fill reaches the blocks whose carried value became another one (:func:`fills`);
* a threshold reaches the blocks in which some row's flags changed, and a heat run the blocks that it now enters with
  another length (:func:`flag_blocks`).

What is carried between blocks is one summary row per block. Summaries of touched districts are made anew by narrow scans and compared
with the stored ones; rows are sorted in the reached blocks alone. District and Date must not be null.
"""

import math

from pyspark.sql import DataFrame, Window as W, functions as F

from skygauge.operators.blocks import per_block
from skygauge.operators.features import DECAY, LAGS

BLOCK = ["District", "year"]


def reach_rows(decay: float = DECAY) -> int:
    """Rows over which a change is felt: the longest lag, or until its part of the rain index is 2**-60 of what it was."""
    return max(max(LAGS), math.ceil(60 * math.log(2) / -math.log(decay)))


def _along(start, end):
    return W.partitionBy("District").orderBy("year").rowsBetween(start, end)


def reached(rows: DataFrame, touched: DataFrame, reach: int, also: DataFrame | None = None) -> DataFrame:
    """``BLOCK``, ``affected``, ``context`` of all blocks in ``rows``, which hold whole touched districts.

    ``touched`` gives the date ``last`` of the last change per block. Affected are the touched blocks, those with one of the ``reach`` rows
    after a change, and the blocks ``also``; context are the blocks with one of the ``reach`` rows before an affected one.
    """
    counts = rows.select(*BLOCK, "Date").join(touched, BLOCK, "left").groupBy(*BLOCK).agg(
        F.count(F.lit(1)).alias("_n"), F.when(F.count("last") > 0, F.count_if(F.col("Date") > F.col("last"))).alias("_after"))
    placed = counts.withColumn("_end", F.sum("_n").over(_along(W.unboundedPreceding, 0))).withColumn("_start", F.col("_end") - F.col("_n"))
    changed = F.max(F.col("_end") - F.col("_after")).over(_along(W.unboundedPreceding, -1))
    near = placed.withColumn("affected", F.col("_after").isNotNull() | F.coalesce(F.col("_start") - changed < reach, F.lit(False)))
    if also is not None:
        near = near.join(also.select(*BLOCK, F.lit(True).alias("_also")), BLOCK, "left").withColumn(
            "affected", F.col("affected") | F.col("_also").isNotNull())
    following = F.min(F.when(F.col("affected"), F.col("_start"))).over(_along(1, W.unboundedFollowing))
    ahead = F.coalesce(following - F.col("_end") < reach, F.lit(False))
    return near.withColumn("context", ahead & ~F.col("affected")).select(*BLOCK, "affected", "context")


def fills(rows: DataFrame, column="RH_2m") -> DataFrame:
    """Per block the nearest known value of the blocks before (``before``) and after (``after``), and the number of ``gaps``."""
    known = F.when(F.col(column).isNotNull(), F.col("Date"))
    blocks = rows.groupBy(*BLOCK).agg(
        F.max_by(column, known).alias("_last"), F.min_by(column, known).alias("_first"), F.count_if(F.col(column).isNull()).alias("gaps"))
    return blocks.select(
        *BLOCK, "gaps", F.last("_last", ignorenulls=True).over(_along(W.unboundedPreceding, -1)).alias("before"),
        F.first("_first", ignorenulls=True).over(_along(1, W.unboundedFollowing)).alias("after"))


def fill(rows: DataFrame, carried: DataFrame, column="RH_2m") -> DataFrame:
    """Forward, then backward fill of ``column`` as ``{column}_filled``, from the block and what :func:`fills` carries to it."""
    w = W.partitionBy(*BLOCK)
    back = F.last(column, ignorenulls=True).over(w.orderBy("Date").rowsBetween(W.unboundedPreceding, 0))
    ahead = F.last(column, ignorenulls=True).over(w.orderBy(F.desc("Date")).rowsBetween(W.unboundedPreceding, 0))
    found = rows.withColumns({"_back": back, "_ahead": ahead}).join(carried.select(*BLOCK, "before", "after"), BLOCK)
    return found.withColumn(f"{column}_filled", F.coalesce("_back", "before", "_ahead", "after")).drop("_back", "_ahead", "before", "after")


def flags(base: DataFrame, limits: DataFrame) -> DataFrame:
    """``heat_exceed``, ``wetness_flag``, ``flood_proxy`` of each row, from its values and its district's limits alone."""
    joined = per_block(base.withColumn("_block", F.col("year")), limits)
    rainy = (F.col("precip_1d") > F.col("precip_p99")) | (F.col("precip_3d_sum") > F.col("precip3_p98"))
    wet = F.col("RH_2m_filled") > F.col("rh_p90")
    return joined.select(
        *BLOCK, "Date", F.coalesce(F.col("MaxTemp_2m") > F.col("temp_p95"), F.lit(False)).alias("heat_exceed"),
        wet.alias("wetness_flag"), F.coalesce(rainy & wet, F.lit(False)).cast("bigint").alias("flood_proxy"))


def flag_blocks(flagged: DataFrame) -> DataFrame:
    """Per block: rows, two digests of its flags, and ``entering``, the length of the heat run that reaches its first row."""
    def digest(seed):
        return F.bit_xor(F.xxhash64(F.lit(seed), "Date", "heat_exceed", "wetness_flag", "flood_proxy"))
    blocks = flagged.groupBy(*BLOCK).agg(
        F.count(F.lit(1)).alias("rows"), digest(0).alias("digest_a"), digest(1).alias("digest_b"),
        F.max(F.when(~F.col("heat_exceed"), F.col("Date"))).alias("_cool"))
    tails = flagged.select(*BLOCK, "Date").join(blocks.select(*BLOCK, "_cool"), BLOCK).groupBy(*BLOCK).agg(
        F.count_if(F.col("Date") > F.col("_cool")).alias("_tail"))
    placed = blocks.join(tails, BLOCK).withColumn("_end", F.sum("rows").over(_along(W.unboundedPreceding, 0)))
    cool = F.max(F.when(F.col("_cool").isNotNull(), F.col("_end") - F.col("_tail"))).over(_along(W.unboundedPreceding, -1))
    return placed.select(*BLOCK, "rows", "digest_a", "digest_b", (F.col("_end") - F.col("rows") - F.coalesce(cool, F.lit(0))).alias("entering"))


def changed_rows(new: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Summaries that are not in ``stored`` with the same values, nulls equal."""
    if stored is None:
        return new
    values = [c for c in new.columns if c not in BLOCK]
    old = stored.select(*BLOCK, F.struct(*values).alias("_old"))
    return new.join(old, BLOCK, "left").filter(~F.col("_old").eqNullSafe(F.struct(*values))).drop("_old")


def labels_from(flagged: DataFrame, blocks: DataFrame, min_run=3) -> DataFrame:
    """Labels of the blocks in ``blocks``, heat runs continued from ``entering``."""
    w = W.partitionBy(*BLOCK).orderBy("Date")
    rows = flagged.join(blocks.select(*BLOCK, "entering"), BLOCK).withColumn("_at", F.row_number().over(w))
    cool = F.max(F.when(~F.col("heat_exceed"), F.col("_at"))).over(w.rowsBetween(W.unboundedPreceding, 0))
    runs = rows.withColumn("heat_run", (F.col("_at") - F.coalesce(cool, -F.col("entering"))).cast("bigint"))
    return runs.select(
        *BLOCK, "Date", (F.col("heat_run") >= min_run).cast("bigint").alias("heatwave"), "flood_proxy", "heat_run", "wetness_flag")
