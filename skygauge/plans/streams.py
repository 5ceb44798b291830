"""Streaming queries: the whole table arrives in three instalments, each drained in its own
bounded run from the same checkpoint, and the sink is read back."""

from pyspark.sql import functions as F

from skygauge.plans.registry import query
from skygauge.plans.serving import LATEST_SQL
from skygauge.plans.summaries import ALERTS_SQL, HOURLY_SQL
from skygauge.plans.views import messages, predictions, station_events
from skygauge.store import fresh_path, read_if_present
from skygauge.streaming import sinks
from skygauge.streaming.groups import land_groups
from skygauge.streaming.sources import file_stream


def thirds(df, column, second, third):
    """Three instalments by a column's value."""
    c = F.col(column)
    return [df.filter(c < second), df.filter((c >= second) & (c < third)), df.filter(c >= third)]


def drain(spark, name, parts, start):
    """Run ``start(stream, sink, checkpoint)`` once per arriving part; returns the sink's path."""
    base = fresh_path(spark, name)
    feed, sink, checkpoint = f"{base}/feed", f"{base}/sink", f"{base}/checkpoint"
    for part in parts:
        part.write.mode("append").parquet(feed)
        start(file_stream(spark, part.schema, feed), sink, checkpoint).awaitTermination()
    return sink


def message_parts(spark, folder):
    """By offset, which grows with the date."""
    return thirds(messages(spark, folder), "offset", 245_000, 270_000)


def event_parts(spark, folder):
    """By time, so that nothing is late."""
    when = [F.lit(t).cast("timestamp_ntz") for t in ("2024-01-11 00:00:00", "2024-01-21 00:00:00")]
    return thirds(station_events(spark, folder), "fetch_time", *when)


LANDED_SQL = "SELECT id AS kafka_offset, District, Date, MaxTemp_2m, Precip FROM messages WHERE id % 97 <> 0 AND id % 89 <> 0"


@query("stream_land", """SELECT id AS kafka_offset, id % 4 AS kafka_partition, CASE WHEN id % 97 <> 0 THEN 'S' || (id % 5) END AS District,
  CASE WHEN id % 97 <> 0 THEN DATE '2024-01-01' + CAST(id % 30 AS INTEGER) END AS Date, id % 97 <> 0 AS landed,
  count(*) FILTER (WHERE id % 97 <> 0) OVER () AS n_landed, count(*) FILTER (WHERE id % 97 = 0) OVER () AS n_rejected, count(*) OVER () AS n_sent FROM station_events""", "station_events")
def stream_land(spark, folder):
    """Sub-daily messages land under 30 dates and 5 districts; every 97th text is cut off and goes to the rejected ones."""
    i = F.col("id")
    body = F.to_json(F.struct(
        F.concat(F.lit("S"), (i % 5).cast("string")).alias("District"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 30).cast("int")).cast("string").alias("Date"), F.col("max_temp").alias("MaxTemp_2m"),
        F.col("min_temp").alias("MinTemp_2m"), F.col("precipitation").alias("Precip"), F.col("humidity").alias("RH_2m"),
        F.col("fetch_time").cast("string").alias("timestamp"), F.col("source").alias("source")))
    topic = station_events(spark, folder).select(
        F.col("District").alias("key"), F.when(i % 97 == 0, F.lit('{"District": "S')).otherwise(body).alias("value"),
        (i % 4).alias("partition"), i.alias("offset"), F.col("fetch_time").alias("timestamp"))
    sink = drain(spark, "land", thirds(topic, "offset", 1_000, 2_000), lambda s, p, c: sinks.land(s, p, c, sinks.ONCE))
    rows, bad = spark.read.parquet(f"{sink}/rows"), spark.read.parquet(f"{sink}/rejected")
    every = rows.select("kafka_offset", "kafka_partition", "District", "Date", F.lit(True).alias("landed")).unionByName(
        bad.select("kafka_offset", "kafka_partition", F.lit(None).cast("string").alias("District"), F.lit(None).cast("date").alias("Date"), F.lit(False).alias("landed")))
    n = every.agg(F.struct(F.count_if("landed").alias("a"), F.count_if(~F.col("landed")).alias("b"), F.count(F.lit(1)).alias("c"))).scalar()
    return every.withColumns({"n_landed": n["a"], "n_rejected": n["b"], "n_sent": n["c"]})


@query("bounded_ingest", LANDED_SQL, "messages")
def bounded_ingest(spark, folder):
    """Bounded runs that remember their offsets: running again adds nothing."""
    parts = message_parts(spark, folder)
    parts.append(parts[0].limit(0))  # a run without new messages
    sink = drain(spark, "ingest", parts, lambda s, p, c: sinks.land_batches(s, p, c, sinks.ONCE))
    return spark.read.parquet(f"{sink}/rows").select("kafka_offset", "District", "Date", "MaxTemp_2m", "Precip")


@query("stream_batch_log", """WITH m AS (SELECT CASE WHEN id < 245000 THEN 0 WHEN id < 270000 THEN 1 ELSE 2 END AS batch_id, id % 97 <> 0 AND id % 89 <> 0 AS good FROM messages)
SELECT CAST(batch_id AS INTEGER) AS batch_id, 'topic' AS source, count(*) FILTER (WHERE good) AS records, count(*) FILTER (WHERE NOT good) AS rejected, 'success' AS status FROM m GROUP BY batch_id""", "messages")
def stream_batch_log(spark, folder):
    sink = drain(spark, "log", message_parts(spark, folder), lambda s, p, c: sinks.land_batches(s, p, c, sinks.ONCE))
    return spark.read.parquet(f"{sink}/log").select("batch_id", "source", "records", "rejected", "status")


@query("stream_groups", """WITH n AS (SELECT id % 4 AS part, count(*) AS landed, CAST(sum(id) AS BIGINT) AS sum_ids FROM station_events GROUP BY 1),
  g AS (SELECT *, unnest(range(0, (landed + 199) // 200)) AS grp FROM n)
SELECT part, grp, CASE WHEN (grp + 1) * 200 <= landed THEN 'size' ELSE 'time' END AS closed_by, least(200, landed - grp * 200) AS records, landed, sum_ids FROM g""", "station_events")
def stream_groups(spark, folder):
    """Groups of 200 messages a partition over three instalments; what is left waits in the state until a last run without patience."""
    i = F.col("id")
    topic = station_events(spark, folder).select(F.col("District").alias("key"), F.col("max_temp").cast("string").alias("value"),
                                                 (i % 4).alias("partition"), i.alias("offset"), F.col("fetch_time").alias("timestamp"))
    parts = [topic.filter(F.floor(i / 4) % 3 == k) for k in range(3)]
    delays = iter([3_600_000, 3_600_000, 0])
    sink = drain(spark, "groups", parts, lambda s, p, c: land_groups(s, p, c, sinks.ONCE, size=200, delay_ms=next(delays)))
    rows = spark.read.parquet(f"{sink}/rows").groupBy(F.col("partition").alias("part")).agg(F.count(F.lit(1)).alias("landed"), F.sum("offset").alias("sum_ids"))
    log = spark.read.parquet(f"{sink}/log").select(F.col("key").alias("part"), F.col("group").alias("grp"), "closed_by", "records")
    return log.join(rows, "part")


@query("stream_score", """WITH s AS (SELECT id, District, fetch_time,
  greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), (max_temp - CAST(35 AS DOUBLE)) / CAST(15 AS DOUBLE))) AS heatwave_probability,
  greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), (precipitation - CAST(50 AS DOUBLE)) / CAST(100 AS DOUBLE) + (humidity - CAST(80 AS DOUBLE)) / CAST(100 AS DOUBLE))) AS flood_probability FROM station_events)
SELECT *, CASE WHEN heatwave_probability > CAST(0.5 AS DOUBLE) THEN 'HIGH' WHEN heatwave_probability > CAST(0.3 AS DOUBLE) THEN 'MEDIUM' ELSE 'LOW' END AS heatwave_risk,
  CASE WHEN flood_probability > CAST(0.5 AS DOUBLE) THEN 'HIGH' WHEN flood_probability > CAST(0.3 AS DOUBLE) THEN 'MEDIUM' ELSE 'LOW' END AS flood_risk FROM s""", "station_events")
def stream_score(spark, folder):
    sink = drain(spark, "score", event_parts(spark, folder), lambda s, p, c: sinks.score_messages(s, p, c, sinks.ONCE))
    stored = spark.read.parquet(f"{sink}/observations").select("id")
    return spark.read.parquet(f"{sink}/predictions").drop("batch_id").join(stored, "id")


@query("stream_alerts", ALERTS_SQL, "station_events")
def stream_alerts(spark, folder):
    sink = drain(spark, "alerts", event_parts(spark, folder), lambda s, p, c: sinks.raise_alerts(s, p, c, sinks.ONCE))
    return spark.read.parquet(sink)


@query("stream_hourly", HOURLY_SQL.replace(" FROM station_events GROUP BY 1, 2", """,
  count(*) FILTER (WHERE id % 40 = 0 AND fetch_time < TIMESTAMP '2024-01-11') AS late_rows FROM station_events GROUP BY 1, 2"""), "station_events")
def stream_hourly(spark, folder):
    """Every 40th event of the first ten days arrives with the last instalment, many days late."""
    early = (F.col("id") % 40 == 0) & (F.col("fetch_time") < F.lit("2024-01-11 00:00:00").cast("timestamp_ntz"))
    first, second, third = event_parts(spark, folder)
    sink = drain(spark, "hourly", [first.filter(~early), second, third.unionByName(first.filter(early))], lambda s, p, c: sinks.hourly(s, p, c, sinks.ONCE))
    late = read_if_present(spark, f"{sink}/late")
    late = late.groupBy("District", F.date_trunc("hour", "fetch_time").cast("timestamp_ntz").alias("hour_bucket")).agg(F.count(F.lit(1)).alias("late_rows"))
    hours = spark.read.parquet(f"{sink}/hours").drop("batch_id", "day", "state", "before")
    return hours.join(late, ["District", "hour_bucket"], "left").fillna(0, ["late_rows"])


@query("stream_running", """SELECT District, count(*) AS fetches, max(fetch_time) AS last_fetch, arg_max(max_temp, fetch_time) AS last_temp,
  count(*) FILTER (WHERE max_temp > 40) AS heatwave_alerts, count(*) FILTER (WHERE precipitation > 100) AS flood_alerts FROM station_events GROUP BY 1""", "station_events")
def stream_running(spark, folder):
    sink = drain(spark, "running", event_parts(spark, folder), lambda s, p, c: sinks.running(s, p, c, sinks.ONCE))
    return sinks.newest_version(spark, sink)


@query("stream_last_n", "SELECT id, District, fetch_time, max_temp FROM station_events ORDER BY station_events.fetch_time DESC, id LIMIT 100", "station_events")
def stream_last_n(spark, folder):
    sink = drain(spark, "last", event_parts(spark, folder), lambda s, p, c: sinks.last_rows(s, p, c, 100, trigger=sinks.ONCE))
    return sinks.newest_version(spark, sink).select("id", "District", "fetch_time", "max_temp")


@query("stream_last_n_per_district", """SELECT id, District, fetch_time, max_temp FROM
  (SELECT *, row_number() OVER (PARTITION BY District ORDER BY fetch_time DESC, id) AS k FROM station_events) WHERE k <= 50""", "station_events")
def stream_last_n_per_district(spark, folder):
    sink = drain(spark, "last_each", event_parts(spark, folder), lambda s, p, c: sinks.last_rows(s, p, c, 50, per=["District"], trigger=sinks.ONCE))
    return sinks.newest_version(spark, sink).select("id", "District", "fetch_time", "max_temp")


@query("stream_latest", f"WITH {LATEST_SQL} SELECT District, Date, model, target, probability, risk FROM latest", "predictions")
def stream_latest(spark, folder):
    day = [F.lit(d).cast("date") for d in ("1997-01-01", "1999-06-01")]
    parts = thirds(predictions(spark, folder), "Date", *day)
    sink = drain(spark, "latest", parts, lambda s, p, c: sinks.latest_predictions(s, p, c, sinks.ONCE))
    return sinks.newest_version(spark, sink)
