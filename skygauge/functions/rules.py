"""Hazard rules as column expressions. Thresholds are parameters; their defaults are fixed values."""

from pyspark.sql import Column, functions as F


def clamp01(x: Column) -> Column:
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def heat_score_linear(temp: Column, clamp=True) -> Column:
    score = (temp - 35.0) / 15.0
    return clamp01(score) if clamp else score


def flood_score_linear(rain: Column, humidity: Column, clamp=True) -> Column:
    score = (rain - 50.0) / 100.0 + (humidity - 80.0) / 100.0
    return clamp01(score) if clamp else score


def heat_score_bands(temp: Column) -> Column:
    return (
        F.when(temp > 40.0, F.least(F.lit(1.0), 0.7 + (temp - 40.0) / 20.0))
        .when(temp > 35.0, F.least(F.lit(1.0), 0.3 + (temp - 35.0) / 10.0))
        .when(temp.isNotNull(), F.greatest(F.lit(0.0), (temp - 30.0) / 20.0))
    )


def flood_score_bands(rain: Column, humidity: Column) -> Column:
    base = F.when(rain > 100.0, 0.8).when(rain > 50.0, 0.5).when(rain > 20.0, 0.3).otherwise(0.0)
    wet = F.when(humidity > 90.0, 0.2).when(humidity > 80.0, 0.1).otherwise(0.0)
    return F.least(F.lit(1.0), base + wet)


def risk_level(p: Column, high=0.5, medium=0.3) -> Column:
    """HIGH / MEDIUM / LOW, strictly above the bounds."""
    return F.when(p > high, "HIGH").when(p > medium, "MEDIUM").otherwise("LOW")


def risk_level_stored(p: Column, high=0.7, medium=0.4) -> Column:
    """HIGH / MEDIUM / LOW, bounds included: the bands of the prediction table."""
    return F.when(p >= high, "HIGH").when(p >= medium, "MEDIUM").otherwise("LOW")


# Lower bound, level, advice.
FIVE_BANDS = [
    (0.8, "EXTREME RISK", "Immediate action required!"),
    (0.6, "HIGH RISK", "High risk - Take precautions"),
    (0.4, "MODERATE RISK", "Moderate risk - Stay alert"),
    (0.2, "LOW RISK", "Low risk - Normal conditions"),
]
LOWEST_BAND = ("MINIMAL RISK", "Minimal risk - Safe conditions")


def risk_level_five(p: Column) -> Column:
    """Struct (level, advice)."""
    def band(level, advice):
        return F.struct(F.lit(level).alias("level"), F.lit(advice).alias("advice"))
    chain = F.when(F.lit(False), band(*LOWEST_BAND))
    for bound, level, advice in FIVE_BANDS:
        chain = chain.when(p >= bound, band(level, advice))
    return chain.otherwise(band(*LOWEST_BAND))


# Alert thresholds (degrees, millimetres); the kinds, severities and texts of ``alert_list`` are fixed too.
HOT_DAY, VERY_HOT_DAY, HEAVY_RAIN, VERY_HEAVY_RAIN = 40.0, 45.0, 100.0, 150.0


def is_hot(temp: Column) -> Column:
    return temp > HOT_DAY


def is_heavy_rain(rain: Column) -> Column:
    return rain > HEAVY_RAIN


def alert_list(temp: Column, rain: Column) -> Column:
    """Array of the alerts one observation raises: none, one or both."""
    def alert(kind, severe, text, value):
        return F.struct(
            F.lit(kind).alias("alert_type"),
            F.when(severe, "HIGH").otherwise("MEDIUM").alias("severity"),
            F.format_string(text, value).alias("message"),
        )
    heat = F.when(is_hot(temp), alert("HEATWAVE", temp > VERY_HOT_DAY, "Extreme temperature: %.1f°C", temp))
    rainy = F.when(is_heavy_rain(rain), alert("FLOOD_RISK", rain > VERY_HEAVY_RAIN, "Heavy precipitation: %.1fmm", rain))
    return F.array_compact(F.array(heat, rainy))


def exclusive_status(temp: Column, rain: Column) -> Column:
    return F.when(is_hot(temp), "HOT").when(is_heavy_rain(rain), "FLOOD").otherwise("OK")


def decide(p: Column, threshold=0.5) -> Column:
    """1 when the probability reaches the threshold."""
    return (p >= threshold).cast("bigint")
