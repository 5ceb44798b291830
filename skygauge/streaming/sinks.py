"""Continuous outputs. Every batch function can be repeated: a batch that runs twice after a
failure replaces its own output, found by the batch number, instead of adding to it.

``trigger`` is what ``DataStreamWriter.trigger`` takes: ``{"availableNow": True}`` for one bounded
run, ``{"processingTime": "10 seconds"}`` for a continuous one.
"""

import time

from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.streaming import StreamingQuery

from skygauge.functions import rules
from skygauge.operators import serving, summaries
from skygauge.sources.messages import accepted, event_date, parse_messages, quarantined
from skygauge.sources.zones import newest_per_key, replace_partitions
from skygauge.store import read_if_present

ONCE = {"availableNow": True}
EVERY_10S = {"processingTime": "10 seconds"}


def _batches(stream: DataFrame, checkpoint: str, trigger: dict, mode: str, batch) -> StreamingQuery:
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**trigger).foreachBatch(batch).start()


def _log(spark, path, number, records, rejected, status, seconds):
    """One line for a batch: how many rows, how it ended, rows a second."""
    row = [("topic", records, rejected, status, int(1000 * seconds), (records + rejected) / seconds if seconds > 0 else None, number)]
    line = spark.createDataFrame(row, "source string, records long, rejected long, status string, duration_ms long, rows_per_second double, batch_id int")
    replace_partitions(line, f"{path}/log", ["batch_id"])


def _held(spark, path, batch):
    """Landed rows of the dates in ``batch``, or None: other dates' folders are not opened. There are at most as many dates as days."""
    held = read_if_present(spark, f"{path}/rows")
    return None if held is None else held.filter(F.col("Date").isin([r.Date for r in batch.select("Date").distinct().collect()]))


def land(raw: DataFrame, path: str, checkpoint: str, trigger=EVERY_10S, by=("Date", "District"), dedupe: bool = False, expect=None) -> StreamingQuery:
    """Topic rows to ``path/rows`` under ``by`` and the batch number, with the ingestion time; messages that can't be
    read, or lack a required field, to ``path/rejected``; one line per batch to ``path/log``.

    Every message is in one of the two tables. With ``dedupe`` messages equal in district, date and sent time are landed once,
    however late they come: the batch is compared with what the touched dates hold. ``expect`` is called with the parsed batch
    before it is written and may raise. A batch that fails leaves a line with its error and stops the query; run again, it
    replaces its own rows and its line.
    """
    def batch(df, number):
        started, spark = time.monotonic(), df.sparkSession
        parsed = parse_messages(df).persist()
        try:
            if expect:
                expect(parsed)
            good = accepted(parsed).withColumn("Date", event_date(F.col("Date")))
            if dedupe:
                same = ["District", "Date", "timestamp"]
                good = good.dropDuplicates(same)
                held = _held(spark, path, good)
                if held is not None:
                    good = good.join(held.filter(F.col("batch_id") != number).select(*same), same, "left_anti")
            stamped = good.withColumn("ingestion_time", F.current_timestamp()).withColumn("batch_id", F.lit(number)).persist()
            bad = quarantined(parsed)
            replace_partitions(stamped, f"{path}/rows", [*by, "batch_id"])
            replace_partitions(bad.withColumn("batch_id", F.lit(number)), f"{path}/rejected", ["batch_id"])
            records, rejected = stamped.count(), bad.count()
            stamped.unpersist()
            _log(spark, path, number, records, rejected, "success", time.monotonic() - started)
        except Exception as err:
            _log(spark, path, number, 0, 0, f"failed: {type(err).__name__}", time.monotonic() - started)
            raise
        finally:
            parsed.unpersist()
    return _batches(raw, checkpoint, trigger, "append", batch)


def land_batches(raw: DataFrame, path: str, checkpoint: str, trigger=EVERY_10S) -> StreamingQuery:
    """:func:`land` by batch number alone."""
    return land(raw, path, checkpoint, trigger, by=())


def score_messages(events: DataFrame, path: str, checkpoint: str, trigger=EVERY_10S) -> StreamingQuery:
    """Observations and their rule predictions to two tables from one read of each batch."""
    def batch(df, number):
        heat = rules.heat_score_linear(F.col("max_temp"))
        flood = rules.flood_score_linear(F.coalesce("precipitation", F.lit(0.0)), F.coalesce("humidity", F.lit(50.0)))
        scored = df.withColumns({
            "heatwave_probability": heat, "flood_probability": flood,
            "heatwave_risk": rules.risk_level(heat), "flood_risk": rules.risk_level(flood), "batch_id": F.lit(number),
        }).persist()
        try:
            replace_partitions(scored.select(*df.columns, "batch_id"), f"{path}/observations", ["batch_id"])
            kept = [c for c in ("id", "District", "fetch_time") if c in df.columns]
            replace_partitions(
                scored.select(*kept, "heatwave_probability", "flood_probability", "heatwave_risk", "flood_risk", "batch_id"),
                f"{path}/predictions", ["batch_id"])
        finally:
            scored.unpersist()
    return _batches(events, checkpoint, trigger, "append", batch)


def raise_alerts(events: DataFrame, path: str, checkpoint: str, trigger=EVERY_10S) -> StreamingQuery:
    """Append the alerts of new observations."""
    return (
        summaries.alerts(events).writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def _hour_state(rows: DataFrame) -> DataFrame:
    """District, hour_bucket and what of an hour can be added up, as ``_new``."""
    rain = F.sum(F.col("precipitation").cast("decimal(28,12)"))
    hour = F.date_trunc("hour", "fetch_time").cast("timestamp_ntz")
    return rows.groupBy("District", hour.alias("hour_bucket")).agg(F.struct(
        F.count(F.lit(1)).alias("record_count"), F.sum(F.col("max_temp").cast("decimal(28,12)")).alias("temp_sum"), F.count("max_temp").alias("temp_count"),
        F.max("max_temp").alias("max_temp"), rain.alias("rain_sum"), F.count_if(rules.is_hot(F.col("max_temp"))).alias("heatwave_alerts"),
        F.count_if(rules.is_heavy_rain(F.col("precipitation"))).alias("flood_alerts")).alias("_new"))


def _added(a: str, b: str):
    """Two states of an hour as one; either may be null."""
    def both(name, f):
        return f(F.col(f"{a}.{name}"), F.col(f"{b}.{name}"))

    def plus(x, y):
        return F.coalesce(x + y, x, y)
    sums = {n: both(n, plus) for n in ("record_count", "temp_sum", "temp_count", "rain_sum", "heatwave_alerts", "flood_alerts")}
    sums |= {n: sums[n].cast("decimal(38,12)") for n in ("temp_sum", "rain_sum")} | {"max_temp": both("max_temp", F.greatest)}
    order = ("record_count", "temp_sum", "temp_count", "max_temp", "rain_sum", "heatwave_alerts", "flood_alerts")
    return F.struct(*[sums[n].alias(n) for n in order])


def hourly(events: DataFrame, path: str, checkpoint: str, trigger=EVERY_10S, late="1 day") -> StreamingQuery:
    """Hourly statistics per district in ``path/hours``, partitioned by day; rows count in their hour however late they come.

    A batch is reduced to one row per district and hour, which is added to what the table holds of that hour: sums, counts and maxima stay in ``state``,
    and ``before`` is the hour without its last batch, from which a repeated batch starts again. Only the days of changed hours are
    rewritten, and nothing is held between batches. Rows further than ``late`` behind the newest of the batches before, and rows without a time (which
    count in no hour), are also filed under ``path/late``; ``path/log`` has a line per batch, whose ``records`` and ``late`` add up to what was sent.
    """
    def batch(df, number):
        spark = df.sparkSession
        timed = df.withColumn("fetch_time", F.col("fetch_time").cast("timestamp")).persist()
        try:
            log, held = read_if_present(spark, f"{path}/log"), read_if_present(spark, f"{path}/hours")
            newest = None if log is None else log.filter(F.col("batch_id") < number).agg(F.max("newest")).first()[0]
            behind = F.col("fetch_time").isNull()
            if newest is not None:
                behind = behind | (F.col("fetch_time") < F.lit(newest) - F.expr(f"INTERVAL {late}"))
            replace_partitions(timed.filter(behind).withColumn("batch_id", F.lit(number)), f"{path}/late", ["batch_id"])
            states = _hour_state(timed.filter(F.col("fetch_time").isNotNull())).withColumn("day", F.col("hour_bucket").cast("date"))
            key = ["District", "hour_bucket", "day"]
            if held is None:
                merged = states.withColumn("before", F.when(F.lit(False), F.col("_new")))
            else:
                here = held.join(states.select("day").distinct(), "day", "left_semi")
                known = F.when(F.col("batch_id") == number, F.col("before")).otherwise(F.col("state"))
                merged = states.join(here.select(*key, known.alias("before"), "state", "batch_id"), key, "full_outer")
            state = _added("before", "_new")
            if held is not None:  # hours that the batch doesn't touch stay as they are
                touched = F.col("_new").isNotNull()
                state = F.when(touched, state).otherwise(F.col("state"))
                merged = merged.withColumn("_batch", F.when(touched, F.lit(number)).otherwise(F.col("batch_id"))).withColumn("_state", state)
            else:
                merged = merged.withColumn("_batch", F.lit(number)).withColumn("_state", state)
            rows = merged.select(
                "District", "hour_bucket", "_state.record_count", F.round(F.try_divide(F.col("_state.temp_sum").cast("double"), F.col("_state.temp_count")), summaries.DIGITS).alias("avg_temp"),
                "_state.max_temp", F.col("_state.rain_sum").cast("double").alias("total_precip"), "_state.heatwave_alerts", "_state.flood_alerts",
                F.col("_state").alias("state"), "before", F.col("_batch").alias("batch_id"), "day")
            replace_partitions(rows, f"{path}/hours", ["day"])
            counts = timed.agg(F.count_if(~behind).alias("records"), F.count_if(behind).alias("late"), F.max("fetch_time").alias("newest"))
            replace_partitions(counts.withColumn("batch_id", F.lit(number)), f"{path}/log", ["batch_id"])
        finally:
            timed.unpersist()
    return _batches(events, checkpoint, trigger, "append", batch)


#: versions of a small table that are kept: a reader may still be in the last but one
KEPT_VERSIONS = 4


def _versions(stream: DataFrame, path: str, checkpoint: str, trigger: dict, reduce, mode="append") -> StreamingQuery:
    """Keep a small table up to date: version n = reduce(version n-1 and batch n).

    Version n overwrites slot n modulo ``KEPT_VERSIONS``, so the folder never grows. The previous
    version is read by number, so a repeated batch starts from the same state.
    """
    def batch(df, number):
        spark = df.sparkSession
        slot = lambda n: f"{path}/slot={n % KEPT_VERSIONS}"
        rows = df if number == 0 else spark.read.parquet(slot(number - 1)).filter(F.col("version") == number - 1).drop("version").unionByName(df)
        reduce(rows).withColumn("version", F.lit(number)).write.mode("overwrite").parquet(slot(number))
    return _batches(stream, checkpoint, trigger, mode, batch)


def running(events: DataFrame, path: str, checkpoint: str, trigger=EVERY_10S) -> StreamingQuery:
    """Running totals per district: fetches, last time and temperature, hazard counts.
    The state is one row per district. Read with :func:`newest_version`."""
    grouped = events.groupBy("District").agg(
        F.count(F.lit(1)).alias("fetches"), F.max("fetch_time").alias("last_fetch"), F.max_by("max_temp", "fetch_time").alias("last_temp"),
        F.count_if(rules.is_hot(F.col("max_temp"))).alias("heatwave_alerts"), F.count_if(rules.is_heavy_rain(F.col("precipitation"))).alias("flood_alerts"))
    return _versions(grouped, path, checkpoint, trigger, lambda rows: newest_per_key(rows, ["District"], ["fetches"]), mode="update")


def last_rows(events: DataFrame, path: str, checkpoint: str, n=100, order="fetch_time", tie=("id",), per=(), trigger=EVERY_10S) -> StreamingQuery:
    """The newest ``n`` rows, overall or per ``per`` columns. Read with :func:`newest_version`."""
    def reduce(rows):
        if not per:
            return serving.newest(rows, order, n, tie)
        w = W.partitionBy(*per).orderBy(F.desc(order), *tie)
        return rows.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")
    return _versions(events, path, checkpoint, trigger, reduce)


def latest_predictions(predictions: DataFrame, path: str, checkpoint: str, trigger={"processingTime": "2 seconds"}) -> StreamingQuery:
    """The newest prediction per district, model and target. Read with :func:`newest_version`."""
    return _versions(predictions, path, checkpoint, trigger, lambda rows: serving.latest_per(rows, ["District", "model", "target"], "Date", "probability"))


def newest_version(spark, path: str) -> DataFrame:
    """The last version written."""
    versions = spark.read.parquet(path)
    return versions.filter(F.col("version") == versions.agg(F.max("version")).scalar()).drop("version", "slot")


def batch_progress(query: StreamingQuery) -> list:
    """(batch, input rows, rows per second) of a query's recent batches."""
    return [(p["batchId"], p["numInputRows"], p.get("processedRowsPerSecond")) for p in query.recentProgress]
