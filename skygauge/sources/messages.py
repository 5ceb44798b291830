"""Messages: the keyed JSON topic, submitted observations, third-party weather documents."""

from pyspark.sql import Column, DataFrame, functions as F

from skygauge.schemas import MESSAGE, REQUIRED_FIELDS, WEATHER_DOC


def encode_kv(df: DataFrame, key="District") -> DataFrame:
    """Key and JSON value per row, ready for ``write.format("kafka")`` or any keyed sink."""
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


# Columns a message source adds to key and value.
SOURCE_COLUMNS = {"partition": "kafka_partition", "offset": "kafka_offset", "timestamp": "kafka_timestamp"}


def parse_messages(raw: DataFrame, schema=MESSAGE) -> DataFrame:
    """Message fields as columns; key, partition, offset and timestamp of the source carried along."""
    carried = [F.col(c).alias(n) for c, n in SOURCE_COLUMNS.items() if c in raw.columns]
    value = F.col("value").cast("string")
    parsed = raw.select(
        F.col("key").cast("string").alias("kafka_key"), *carried, value.alias("raw_value"),
        F.from_json(value, schema).alias("data"),
    )
    return parsed.select("kafka_key", *[n for c, n in SOURCE_COLUMNS.items() if c in raw.columns], "raw_value", "data.*")


def event_date(text: Column) -> Column:
    """Date from the first ten characters; null when they are no date."""
    return F.to_date(F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")))


def _landable() -> Column:
    """A message without district or date has no partition to land in."""
    return F.col("District").isNotNull() & event_date(F.col("Date")).isNotNull()


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(_landable()).drop("raw_value")


def quarantined(parsed: DataFrame) -> DataFrame:
    """Messages that cannot be landed, with their text and where they came from kept for repair."""
    source = [n for n in SOURCE_COLUMNS.values() if n in parsed.columns]
    return parsed.filter(~F.coalesce(_landable(), F.lit(False))).select("kafka_key", *source, "raw_value")


def _missing_or_zero(c: str, fallback: Column) -> Column:
    return F.when(F.col(c).isNull() | (F.col(c) == 0), fallback).otherwise(F.col(c))


def canonicalize(sub: DataFrame, sent_at: Column | None = None) -> DataFrame:
    """Submitted observation to message fields. A zero minimum or range counts as not given."""
    sent = F.current_timestamp() if sent_at is None else sent_at
    return sub.select(
        F.col("district").alias("District"), F.col("date").alias("Date"),
        F.coalesce("latitude", F.lit(27.0)).alias("Latitude"), F.coalesce("longitude", F.lit(85.0)).alias("Longitude"),
        F.col("max_temp").alias("MaxTemp_2m"), _missing_or_zero("min_temp", F.col("max_temp") - 10.0).alias("MinTemp_2m"),
        _missing_or_zero("temp_range", F.lit(10.0)).alias("TempRange_2m"),
        F.col("precipitation").alias("Precip"), F.col("humidity").alias("RH_2m"),
        F.coalesce("wind_speed_10m", F.lit(0.0)).alias("WindSpeed_10m"), F.coalesce("wind_speed_50m", F.lit(0.0)).alias("WindSpeed_50m"),
        F.coalesce("solar_radiation", F.lit(0.0)).alias("SolarRad"),
        sent.cast("string").alias("timestamp"), F.lit("api").alias("source"),
    )


def check_required(sub: DataFrame, required=REQUIRED_FIELDS) -> DataFrame:
    """Add ``missing``: the required fields a submission lacks."""
    return sub.withColumn("missing", F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])))


def _clock(seconds: Column, absent: str) -> Column:
    given = seconds.isNotNull() & (seconds != 0)
    return F.when(given, F.date_format(F.timestamp_seconds(seconds), "HH:mm")).otherwise(absent)


def flatten_weather(raw: DataFrame, value="value", city="city", units="kelvin") -> DataFrame:
    """Flatten a current-weather document.

    ``kelvin``: temperatures in K, daily rain estimated from the last hour or three.
    ``metric``: temperatures in degrees C, rain of the last hour as is.
    """
    doc = raw.select(F.col(city).alias("city"), F.from_json(F.col(value).cast("string"), WEATHER_DOC).alias("d"))
    m = F.col("d.main")
    first = F.get(F.col("d.weather"), F.lit(0))
    if units == "metric":
        top, bottom = F.coalesce(m["temp_max"], m["temp"]), F.coalesce(m["temp_min"], m["temp"])
        return doc.select(
            F.col("city").alias("district"), top.alias("max_temp"), bottom.alias("min_temp"),
            (F.coalesce(m["temp_max"], F.lit(0.0)) - F.coalesce(m["temp_min"], F.lit(0.0))).alias("temp_range"),
            F.coalesce(F.col("d.rain")["1h"], F.lit(0.0)).alias("precipitation"),
            F.coalesce(m["humidity"], F.lit(0.0)).alias("humidity"), F.coalesce(F.col("d.wind.speed"), F.lit(0.0)).alias("wind_speed"),
            F.coalesce(m["pressure"], F.lit(1013.0)).alias("pressure"), F.coalesce(F.col("d.clouds.all"), F.lit(0)).cast("bigint").alias("cloudiness"),
            (F.coalesce(F.col("d.visibility"), F.lit(10000)) / 1000.0).alias("visibility"),
            F.coalesce(first["description"], F.lit("")).alias("weather_desc"),
            _clock(F.col("d.sys.sunrise"), "").alias("sunrise"), _clock(F.col("d.sys.sunset"), "").alias("sunset"),
        )
    if units != "kelvin":
        raise ValueError(f"unknown units {units!r}")
    temp = F.coalesce(m["temp"], F.lit(273.15))

    def celsius(c):
        return F.coalesce(c, temp) - 273.15
    hour, three = F.col("d.rain")["1h"], F.col("d.rain")["3h"]
    rain = F.when(hour != 0, hour * 24.0).when(three != 0, three * 8.0).otherwise(0.0)
    seen = F.coalesce(F.col("d.visibility"), F.lit(10000)).cast("bigint")
    wind = F.round(F.coalesce(F.col("d.wind.speed"), F.lit(0.0)), 1)
    return doc.select(
        F.coalesce("d.name", "city").alias("city_name"), F.col("city").alias("district"),
        F.coalesce("d.coord.lat", F.lit(27.0)).alias("latitude"), F.coalesce("d.coord.lon", F.lit(85.0)).alias("longitude"),
        F.round(temp - 273.15, 1).alias("temperature"), F.round(celsius(m["temp_max"]), 1).alias("temp_max"),
        F.round(celsius(m["temp_min"]), 1).alias("temp_min"), F.round(celsius(m["feels_like"]), 1).alias("feels_like"),
        F.round(celsius(m["temp_max"]) - celsius(m["temp_min"]), 1).alias("temp_range"),
        F.coalesce(m["humidity"], F.lit(50.0)).alias("humidity"), F.coalesce(m["pressure"], F.lit(1013.0)).alias("pressure"),
        F.round(rain, 1).alias("precipitation"), wind.alias("wind_speed"), (wind * 1.5).alias("wind_speed_50m"),
        F.coalesce(F.col("d.wind.deg"), F.lit(0)).cast("bigint").alias("wind_direction"),
        F.coalesce(F.col("d.clouds.all"), F.lit(0)).cast("bigint").alias("cloudiness"),
        seen.alias("visibility"), F.round(seen / 1000.0, 1).alias("visibility_km"),
        F.coalesce(first["main"], F.lit("N/A")).alias("weather_main"), F.coalesce(first["description"], F.lit("N/A")).alias("weather_description"),
        _clock(F.col("d.sys.sunrise"), "N/A").alias("sunrise"), _clock(F.col("d.sys.sunset"), "N/A").alias("sunset"),
    )
