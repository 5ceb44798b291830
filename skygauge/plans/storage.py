"""Source and sink queries: each writes the whole table and reads it back."""

from pyspark.sql import functions as F

from skygauge.plans.registry import query
from skygauge.plans.views import hist, obs, predictions, station_events, strm
from skygauge.sources import files, zones
from skygauge.store import fresh_path, read_first


@query("csv_scan", "SELECT * FROM obs", "obs")
def csv_scan(spark, folder):
    path = fresh_path(spark, "csv")
    files.write_csv(obs(spark, folder), path)
    return files.read_csv(spark, path)


@query("csv_dir_station", """
WITH s AS (SELECT District, printf('WS-%03d', row_number() OVER (ORDER BY District)) AS station_id FROM (SELECT DISTINCT District FROM obs))
SELECT o.District, s.station_id, o.Date, o.MaxTemp_2m, o.Precip FROM obs o JOIN s ON o.District = s.District""", "obs")
def csv_dir_station(spark, folder):
    path = fresh_path(spark, "stations")
    (
        obs(spark, folder).select(F.col("District").alias("station"), "Date", "MaxTemp_2m", "Precip")
        .hint("rebalance", "station").write.option("header", True).partitionBy("station").csv(path)
    )
    return files.read_station_folder(spark, path, name_pattern=r"station=([^/]+)/").select("District", "station_id", "Date", "MaxTemp_2m", "Precip")


@query("parquet_roundtrip", "SELECT * FROM obs", "obs")
def parquet_roundtrip(spark, folder):
    path = fresh_path(spark, "roundtrip")
    for _ in range(2):  # the second write replaces the first
        obs(spark, folder).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("landing_partitioned", """SELECT id, CAST(fetch_time AS DATE) AS Date, District, max_temp, precipitation FROM station_events
  UNION ALL SELECT id, CAST(fetch_time AS DATE), District, max_temp, precipitation FROM station_events WHERE id % 2 = 0""", "station_events")
def landing_partitioned(spark, folder):
    path = fresh_path(spark, "landing")
    rows = station_events(spark, folder).select("id", F.col("fetch_time").cast("date").alias("Date"), "District", "max_temp", "precipitation")
    zones.append_partitioned(rows, path)
    zones.append_partitioned(rows.filter("id % 2 = 0"), path)  # appends keep what is there
    return spark.read.schema(rows.schema).parquet(path)


@query("json_batches", "SELECT id, District, max_temp, precipitation FROM station_events", "station_events")
def json_batches(spark, folder):
    path = fresh_path(spark, "json")
    rows = station_events(spark, folder).select("id", "District", "max_temp", "precipitation")
    files.write_json_batches(rows, path, tasks=4 * spark.sparkContext.defaultParallelism)
    return spark.read.schema(rows.schema).json(path)


@query("export_csv", """SELECT id, District, strftime(fetch_time, '%Y-%m-%d %H:%M:%S') AS fetch_time, max_temp, min_temp, precipitation
  FROM station_events WHERE District = 'D1' ORDER BY station_events.fetch_time DESC, id LIMIT 1000""", "station_events")
def export_csv(spark, folder):
    path = fresh_path(spark, "export")
    rows = station_events(spark, folder).select("id", "District", "fetch_time", "max_temp", "min_temp", "precipitation")
    files.export_district(rows, "D1", path)
    back = spark.read.option("header", True).schema(rows.schema).csv(path)
    return back.withColumn("fetch_time", F.date_format("fetch_time", "yyyy-MM-dd HH:mm:ss"))


@query("upsert_latest", """
WITH u AS (SELECT District, Date, MaxTemp_2m, Precip, TIMESTAMP '2001-01-01 00:00:00' AS ingestion_time FROM hist
  UNION ALL SELECT District, Date, MaxTemp_2m, Precip, ingestion_time FROM strm)
SELECT District, CAST(year(Date) AS INTEGER) AS year, Date, MaxTemp_2m, Precip, ingestion_time
FROM (SELECT *, row_number() OVER (PARTITION BY District, Date ORDER BY ingestion_time DESC) AS rn FROM u) WHERE rn = 1""", "hist strm")
def upsert_latest(spark, folder):
    path = fresh_path(spark, "upsert")
    first = hist(spark, folder).withColumn("ingestion_time", F.lit("2001-01-01 00:00:00").cast("timestamp_ntz"))
    for batch in (first, strm(spark, folder)):
        rows = batch.select("District", F.year("Date").alias("year"), "Date", "MaxTemp_2m", "Precip", "ingestion_time")
        zones.upsert(rows, path, key=["District", "Date", "year"], newest=["ingestion_time"], by=["District", "year"], time="Date")
    return spark.read.parquet(path)


@query("predictions_overwrite", """SELECT District, Date, model, target,
  CASE WHEN model = 'rule' AND target = 'heatwave' THEN probability / CAST(2 AS DOUBLE) ELSE probability END AS probability FROM predictions""", "predictions")
def predictions_overwrite(spark, folder):
    path = fresh_path(spark, "model_target")
    rows = predictions(spark, folder).select("District", "Date", "model", "target", "probability")
    zones.replace_partitions(rows, path, ["model", "target"])
    rerun = rows.filter("model = 'rule' and target = 'heatwave'").withColumn("probability", F.col("probability") / 2.0)
    zones.replace_partitions(rerun, path, ["model", "target"])
    return spark.read.parquet(path)


@query("zone_fallback", "SELECT District, Date, MaxTemp_2m FROM obs", "obs")
def zone_fallback(spark, folder):
    features = fresh_path(spark, "features")
    obs(spark, folder).select("District", "Date", "MaxTemp_2m").write.parquet(features)
    return read_first(spark, fresh_path(spark, "labeled"), features)
