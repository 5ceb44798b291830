"""Column contracts of the data that flows through the package."""

from pyspark.sql import types as T

_D, _S = T.DoubleType(), T.StringType()


def _struct(**fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


# One daily observation per district.
OBSERVATION = _struct(
    District=_S, Date=T.DateType(), Latitude=_D, Longitude=_D, MaxTemp_2m=_D, MinTemp_2m=_D,
    TempRange_2m=_D, Precip=_D, RH_2m=_D, WindSpeed_10m=_D, WindSpeed_50m=_D, SolarRad=_D,
)

# The JSON message on the topic; dates travel as text.
MESSAGE = _struct(
    District=_S, Date=_S, Latitude=_D, Longitude=_D, MaxTemp_2m=_D, MinTemp_2m=_D, TempRange_2m=_D,
    Precip=_D, RH_2m=_D, WindSpeed_10m=_D, WindSpeed_50m=_D, SolarRad=_D, timestamp=_S, source=_S,
)

# An observation as a client submits it.
SUBMISSION = _struct(
    district=_S, date=_S, latitude=_D, longitude=_D, max_temp=_D, min_temp=_D, temp_range=_D,
    precipitation=_D, humidity=_D, wind_speed_10m=_D, wind_speed_50m=_D, solar_radiation=_D,
)
REQUIRED_FIELDS = ("district", "date", "max_temp", "precipitation", "humidity")

# Current-weather document of a public forecast service.
WEATHER_DOC = _struct(
    name=_S,
    main=_struct(temp=_D, temp_max=_D, temp_min=_D, feels_like=_D, humidity=_D, pressure=_D),
    wind=_struct(speed=_D, deg=T.LongType()),
    clouds=_struct(all=T.LongType()),
    rain=T.StructType([T.StructField("1h", _D), T.StructField("3h", _D)]),
    visibility=T.LongType(),
    weather=T.ArrayType(_struct(main=_S, description=_S)),
    coord=_struct(lat=_D, lon=_D),
    sys=_struct(sunrise=T.LongType(), sunset=T.LongType()),
)

# The model input table, in the order its readers expect.
FEATURE_COLUMNS = [
    "Date", "District", "Latitude", "Longitude",
    "Precip", "precip_3d", "precip_7d", "precip_lag_1", "precip_lag_3", "precip_lag_7",
    "MaxTemp_2m", "maxT_3d_mean", "maxT_lag_1", "maxT_lag_3", "anom_maxT",
    "RH_2m", "wetness_flag", "API", "TempRange_2m", "WindSpeed_10m", "WindSpeed_50m",
    "doy_sin", "doy_cos", "month", "year", "heatwave", "flood_proxy",
]

# Never model inputs (keys, labels, and columns the labels were derived from).
NOT_INPUTS = [
    "Date", "District", "heatwave", "flood_proxy", "Latitude", "Longitude", "heat_exceed",
    "heat_run", "precip_1d", "precip_p99", "precip3_p98", "wetness_flag", "temp_p95", "rh_p90",
    "precip_3d_sum", "clim_maxT", "clim_precip",
]
