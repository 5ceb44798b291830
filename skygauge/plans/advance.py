"""Incremental run over a root folder of zones: new rows in, dependent blocks rewritten, all other files left alone.

``merged``, ``features``, ``labeled`` and ``predictions`` hold one folder per (District, year); ``climatology`` and ``limits`` one per
District; ``fills`` and ``label_blocks`` are the summaries of the last run. Anomalies are joined when ``features`` is read
(:func:`read_features`): a new day moves the normal of its day in every year, which would rewrite all blocks for one row each.
Each zone is written before the next step reads it and a summary only after the rows it describes, so a run that fails is
repeated with the same rows.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from skygauge.operators import labels as L, propagate as P
from skygauge.operators.features import add_anomaly, climatology, window_features
from skygauge.operators.learning import score_by_rule
from skygauge.plans.registry import query
from skygauge.plans.views import hist, strm
from skygauge.sources import zones
from skygauge.store import fresh_path, landed, read_if_present

#: how a stored row is ranked against another one of its key
RANK = ["origin", "ingested", "row_hash"]


def _ranked(rows: DataFrame, newest: str | None) -> DataFrame:
    """Streamed rows beat historical ones, then the newest, then a hash of the row."""
    values = [c for c in rows.columns if c not in (newest, "year", *RANK)]
    at = F.lit("0001-01-01 00:00:00") if newest is None else F.col(newest)
    return rows.select(
        *values, F.year("Date").alias("year"), F.lit(0 if newest is None else 1).alias("origin"),
        at.cast("timestamp_ntz").alias("ingested"), F.xxhash64(*values).alias("row_hash"))


def _zone(spark: SparkSession, root: str, name: str, districts: DataFrame | None = None) -> DataFrame | None:
    """A zone, or its rows of some districts; District is text whatever its values look like."""
    path = f"{root.rstrip('/')}/{name}"
    found = read_if_present(spark, path)
    if found is None:
        return None
    schema = found.schema
    schema["District"].dataType = StringType()
    zone = spark.read.schema(schema).parquet(path)
    return zone if districts is None else zone.join(districts, "District", "left_semi")


def _write(df: DataFrame, root: str, name: str, by) -> None:
    zones.replace_partitions(df, f"{root.rstrip('/')}/{name}", by)


def apply_changes(spark: SparkSession, root: str, rows: DataFrame, newest: str | None = "ingestion_time", method="exact") -> None:
    """Bring all zones up to date with ``rows``: streamed rows with their time ``newest``, or history (``newest=None``).

    The first call, on an empty folder, builds everything; columns are those of its rows. Rows of one key may repeat; the winner is
    the one that a merge of all rows so far would keep.
    """
    stored = _zone(spark, root, "merged")
    if stored is not None:
        values = [c for c in stored.columns if c not in ("year", *RANK)]
        types = dict(stored.dtypes)
        rows = rows.select(*[F.col(c).cast(types[c]).alias(c) for c in values], *([newest] if newest else []))
    new = landed(_ranked(rows, newest), "changes")
    touched = landed(new.groupBy(*P.BLOCK).agg(F.max("Date").alias("last")), "touched")
    districts = landed(touched.select("District").distinct(), "touched_districts")
    zones.upsert(new, f"{root.rstrip('/')}/merged", ["District", "Date", "year"], RANK, P.BLOCK, "Date")

    def zone(name):
        return _zone(spark, root, name, districts)

    # windows, rain index, fills
    merged = zone("merged")
    if merged is None:
        return  # no rows yet
    merged = merged.drop(*RANK)
    carried = landed(P.fills(merged), "fills")
    moved = P.changed_rows(carried, zone("fills")).filter("gaps > 0")
    blocks = landed(P.reached(merged, touched, P.reach_rows(), moved), "reached")
    affected = blocks.filter("affected").select(*P.BLOCK)
    wanted = merged.join(blocks.filter("affected or context").select(*P.BLOCK), P.BLOCK, "left_semi")
    rained = L.add_rain_sums(window_features(wanted.drop("year"))).drop("_block").withColumn("year", F.year("Date"))
    _write(P.fill(rained.join(affected, P.BLOCK, "left_semi"), carried), root, "features", P.BLOCK)
    _write(carried, root, "fills", ["District"])

    # normals of the touched days of the year
    days = new.select("District", F.dayofyear("Date").cast("bigint").alias("doy")).distinct()
    same_day = merged.withColumn("doy", F.dayofyear("Date").cast("bigint")).join(days, ["District", "doy"], "left_semi")
    normals, old = climatology(same_day), zone("climatology")
    if old is not None:
        normals = normals.unionByName(old.join(days, ["District", "doy"], "left_anti"))
    _write(landed(normals, "normals"), root, "climatology", ["District"])

    # thresholds, flags, runs
    base = zone("features").select(*P.BLOCK, "Date", "MaxTemp_2m", "precip_1d", "precip_3d_sum", "RH_2m_filled")
    limits = landed(L.thresholds(base, L.ALL_SPECS, method), "limits")
    _write(limits, root, "limits", ["District"])
    flagged = P.flags(base, limits)
    summaries = landed(P.flag_blocks(flagged), "label_blocks")
    changed = landed(P.changed_rows(summaries, zone("label_blocks")), "label_changes")
    _write(P.labels_from(flagged, changed), root, "labeled", P.BLOCK)
    _write(summaries, root, "label_blocks", ["District"])

    scored = score_by_rule(merged.join(touched, P.BLOCK, "left_semi"))
    _write(scored.select(*P.BLOCK, "Date", "probability", "risk", "status", "model", "target"), root, "predictions", P.BLOCK)


def read_features(spark: SparkSession, root: str) -> DataFrame:
    """All features, anomalies against today's normals included."""
    return add_anomaly(_zone(spark, root, "features"), _zone(spark, root, "climatology"))


def read_labels(spark: SparkSession, root: str) -> DataFrame:
    return _zone(spark, root, "labeled")


@query("refresh_incremental", """
WITH p AS (SELECT District, Date, greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), (MaxTemp_2m - CAST(35 AS DOUBLE)) / CAST(15 AS DOUBLE))) AS probability FROM merged),
c AS (SELECT District, dayofyear(Date) AS doy, median(MaxTemp_2m) AS clim FROM merged GROUP BY 1, 2),
w AS (SELECT District, Date, MaxTemp_2m, Precip, lag(MaxTemp_2m, 14) OVER d AS maxT_lag_14,
        round(sum(Precip) OVER (PARTITION BY District ORDER BY Date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 9) AS precip_7d
      FROM merged WINDOW d AS (PARTITION BY District ORDER BY Date))
SELECT h.District, h.Date, h.heatwave, h.flood_proxy, h.heat_run, w.Precip, w.precip_7d, w.maxT_lag_14,
       round(w.MaxTemp_2m - c.clim, 9) AS anom_maxT, p.probability
FROM m_hazard_labels h JOIN w ON h.District = w.District AND h.Date = w.Date JOIN p ON h.District = p.District AND h.Date = p.Date
JOIN c ON c.District = h.District AND c.doy = dayofyear(h.Date)""", "merged m_hazard_labels")
def refresh_incremental(spark, folder):
    """Features, labels and predictions after history and then the streamed rows were applied."""
    root = fresh_path(spark, "advanced")
    apply_changes(spark, root, hist(spark, folder), newest=None)
    apply_changes(spark, root, strm(spark, folder))
    features = read_features(spark, root).select(
        "District", "Date", "Precip", "precip_7d", "maxT_lag_14", F.round("anom_maxT", 9).alias("anom_maxT"))
    heat = _zone(spark, root, "predictions").filter(F.col("target") == "heatwave").select("District", "Date", "probability")
    labels = read_labels(spark, root).select("District", "Date", "heatwave", "flood_proxy", "heat_run")
    return features.join(labels, ["District", "Date"]).join(heat, ["District", "Date"])
