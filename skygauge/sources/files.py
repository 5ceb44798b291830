"""Observation files: CSV scans and exports, per-district folders, JSON batches."""

import csv
from collections import Counter

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from skygauge.operators.ordered import positions
from skygauge.schemas import OBSERVATION
from skygauge.store import landed


def typed(df: DataFrame, schema=OBSERVATION) -> DataFrame:
    """Cast the columns the schema names; other columns stay as they are. :func:`uncastable` has what becomes null."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def uncastable(df: DataFrame, schema=OBSERVATION) -> DataFrame:
    """The text rows with a value that :func:`typed` can't read, and ``rejected``: the names of those columns."""
    bad = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in schema.fields if f.name in df.columns
    ]
    rows = df.withColumn("rejected", F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>"))
    return rows.filter(F.size("rejected") > 0)


def _file():
    """The path of the row's file as it is written."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _names(header: str) -> list:
    """Column names of a header line: trimmed; empty ones and repeated ones get their place, as Spark's reader does."""
    cells = [c.strip() for c in next(csv.reader([header]))]
    known = Counter(c.lower() for c in cells)
    return [f"_c{i}" if not c else f"{c}{i}" if known[c.lower()] > 1 else c for i, c in enumerate(cells)]


def read_csv_text(spark: SparkSession, path) -> DataFrame:
    """CSV files with a header each, all columns as text, matched by name.

    Files may order their columns differently, lack some or have more; missing columns are null. ``_file`` is the file. The values
    are read in one scan, by place. Where headers differ, a table of one row per file tells which place has which column, and the rows
    are joined with it. Only the different header lines come to the driver, never the files. Finding the headers is a pass over the lines before.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        _file().alias("_file"), "value", F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"))
    first = landed(lines.filter("at = 0 AND trim(value) <> ''").groupBy("_file").agg(F.min_by("value", "n").alias("header")), "headers")
    layouts = {r.header: _names(r.header) for r in first.select("header").distinct().orderBy("header").collect()}
    names = {n.lower(): n for own in reversed(layouts.values()) for n in reversed(own)}  # of spellings the first
    order = list(dict.fromkeys(n.lower() for own in layouts.values() for n in own))
    width = max(map(len, layouts.values()), default=0)
    cells = StructType([StructField(f"_at{i}", StringType()) for i in range(max(1, width))])
    rows = spark.read.option("header", True).option("recursiveFileLookup", True).schema(cells).csv(path).withColumn("_file", _file())
    if len(layouts) < 2:
        return rows.select(*[F.col(f"_at{i}").alias(names[n]) for i, n in enumerate(order)], "_file")
    places = [(header, [own.index(n) if n in own else None for n in order]) for header, own in ((h, [n.lower() for n in own]) for h, own in layouts.items())]
    placed = first.join(spark.createDataFrame(places, "header string, _places array<int>"), "header").drop("header")
    values = F.array(*cells.names)
    return rows.join(placed, "_file").select(*[F.get(values, F.get("_places", F.lit(i))).alias(names[n]) for i, n in enumerate(order)], "_file")


def read_csv(spark: SparkSession, path, schema=OBSERVATION) -> DataFrame:
    """CSV with a header. Types come from the schema by column name: no pass to infer them."""
    return typed(read_csv_text(spark, path).drop("_file"), schema)


def read_station_folder(spark: SparkSession, path, name_pattern=r"([^/]+)\.csv$", schema=OBSERVATION) -> DataFrame:
    """A folder of CSVs, one district per file: adds District from the file name and a station id.

    Stations are numbered WS-001, WS-002, ... in the order of their names, which come from the listing, not from the rows.
    """
    rows = read_csv_text(spark, path).withColumn("District", F.regexp_extract("_file", name_pattern, 1)).drop("_file")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        F.regexp_extract(F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B"))), name_pattern, 1).alias("District"))
    names = positions(listed.filter("District <> ''").distinct(), ["District"], "_n")
    stations = names.select("District", F.format_string("WS-%03d", "_n").alias("station_id"))
    return typed(rows.join(stations, "District"), schema)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json_batches(df: DataFrame, path: str, batch=100, tasks: int | None = None) -> None:
    """JSON files of at most ``batch`` records, written by ``tasks`` tasks (by as many as ``df`` has partitions, if None).

    The files are many and small, so making them is the work: each task moves its own into place, not the driver all of them
    one by one. A job that fails may leave some there; ``_SUCCESS`` is written last.
    """
    rows = df.repartition(tasks) if tasks else df
    rows.write.mode("overwrite").options(**{"maxRecordsPerFile": batch, "mapreduce.fileoutputcommitter.algorithm.version": 2}).json(path)


def export_district(df: DataFrame, district: str, path: str, time="fetch_time", limit=1000) -> None:
    """CSV of one district's newest observations."""
    write_csv(df.filter(F.col("District") == district).orderBy(F.desc(time), *_tie(df, time)).limit(limit), path)


def _tie(df, time):
    return [c for c in ("id",) if c in df.columns and c != time]
