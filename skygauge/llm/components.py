"""Connected components by alternating large-star and small-star on DataFrames of links.

Large-star: every node links its larger neighbours to the smallest node it knows (itself included). Small-star: it links its
smaller neighbours and itself to the smallest of them. Both keep components and shorten paths; when nothing changes,
every node is linked to the smallest of its component. Minima are partial aggregates joined back, so a hub's neighbours are never
gathered in one task. Each round is written to the shared folder.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygauge.store import landed


def _large(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(links: DataFrame) -> DataFrame:
    """``links`` has v < u on every row."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``links``: pairs of longs. Returns (node, component) of each linked node; the component is its smallest node."""
    now = landed(links.where(f"{a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")

    def state(rows: DataFrame):
        return rows.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = None
    while (mark := state(now)) != before and mark[0]:
        before = mark
        large = _large(now).where("u <> v").distinct()
        now = landed(_small(large).distinct(), "links")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
