"""The scheduled run over a root folder of zones: merge, features, labels, rule predictions.

Reads ``processed`` (history) and, if present, ``streaming`` (landed messages); writes ``merged``,
``features``, ``labeled`` and ``predictions``. The features and labels are made from ``merged``,
so streamed rows reach them. Every zone is written whole before the next step reads it: a step
that fails can be repeated alone, and a step reads files, not the plans before it.
"""

from pyspark.sql import SparkSession, functions as F

from skygauge.operators.features import build_features
from skygauge.operators.labels import hazard_labels
from skygauge.operators.learning import score_by_rule
from skygauge.operators.sets import merge_zones
from skygauge.plans.registry import query
from skygauge.plans.views import hist, strm
from skygauge.sources.zones import replace_partitions
from skygauge.store import fresh_path, read_if_present


def refresh(spark: SparkSession, root: str, method="exact") -> None:
    """One scheduled run; ``method`` picks exact or approximate label thresholds."""
    def zone(name):
        return f"{root.rstrip('/')}/{name}"
    merged = merge_zones(spark.read.parquet(zone("processed")), read_if_present(spark, zone("streaming")))
    merged.write.mode("overwrite").parquet(zone("merged"))
    merged = spark.read.parquet(zone("merged"))
    build_features(merged).write.mode("overwrite").parquet(zone("features"))
    labels = hazard_labels(merged, method)
    spark.read.parquet(zone("features")).join(labels, ["District", "Date"]).write.mode("overwrite").parquet(zone("labeled"))
    scored = score_by_rule(spark.read.parquet(zone("labeled")))
    replace_partitions(scored.select("District", "Date", "probability", "risk", "status", "model", "target"), zone("predictions"), ["model", "target"])


def _refreshed(spark, folder):
    root = fresh_path(spark, "zones")
    hist(spark, folder).write.parquet(f"{root}/processed")
    strm(spark, folder).write.parquet(f"{root}/streaming")
    refresh(spark, root)
    return root


@query("refresh_zones", """
WITH p AS (SELECT District, Date, greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), (MaxTemp_2m - CAST(35 AS DOUBLE)) / CAST(15 AS DOUBLE))) AS probability FROM merged)
SELECT h.District, h.Date, h.heatwave, h.flood_proxy, m.Precip, p.probability
FROM m_hazard_labels h JOIN merged m ON h.District = m.District AND h.Date = m.Date JOIN p ON h.District = p.District AND h.Date = p.Date""", "merged m_hazard_labels")
def refresh_zones(spark, folder):
    """Labels and predictions after a run over the two overlapping zones."""
    root = _refreshed(spark, folder)
    labeled = spark.read.parquet(f"{root}/labeled").select("District", "Date", "heatwave", "flood_proxy", "Precip")
    heat = spark.read.parquet(f"{root}/predictions").filter(F.col("target") == "heatwave").select("District", "Date", "probability")
    return labeled.join(heat, ["District", "Date"])
