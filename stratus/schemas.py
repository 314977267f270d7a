"""Fixed schemas and the metric registry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Metric:
    name: str          # metric id, also the raw file stem `{name}_raw.json`
    value_column: str  # column name of the value in the per-metric view
    view: str          # temp-view name of the per-metric relation


# The five metrics, in source order, with their value column
# and temp-view names.  These must stay equal to the original pipeline.
METRICS: tuple[Metric, ...] = (
    Metric("air_temperature", "temperature_c", "temperature"),
    Metric("relative_humidity", "humidity_pct", "humidity"),
    Metric("rainfall", "rainfall_mm", "rainfall"),
    Metric("wind_speed", "wind_speed_kmh", "wind_speed"),
    Metric("wind_direction", "wind_direction_deg", "wind_direction"),
)

METRIC_BY_NAME = {m.name: m for m in METRICS}

TEMPERATURE = "air_temperature"
HUMIDITY = "relative_humidity"
RAINFALL = "rainfall"
WIND_SPEED = "wind_speed"
WIND_DIRECTION = "wind_direction"

# Raw day response: only the fields the flatten reads.  `value` and the
# coordinates are strings so that both JSON numbers and numeric text survive
# the read; they are parsed later.
RAW_STATION = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("location", T.StructType([
        T.StructField("latitude", T.StringType()),
        T.StructField("longitude", T.StringType()),
    ])),
])

RAW_ITEM = T.StructType([
    T.StructField("stationId", T.StringType()),
    T.StructField("value", T.StringType()),
])

RAW_READING = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("data", T.ArrayType(RAW_ITEM)),
])

RAW_SCHEMA = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("stations", T.ArrayType(RAW_STATION)),
        T.StructField("readings", T.ArrayType(RAW_READING)),
    ])),
])

# Raw day response read for exact null-vs-absent semantics: stations and
# readings as string maps keep which keys are present (a present key may hold
# NULL); nested objects and arrays arrive as their JSON text.
RAW_STRICT_SCHEMA = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("stations", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
        T.StructField("readings", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    ])),
])

# Clean layer, long form: one row per reading of one metric at one station.
CLEAN_SCHEMA = T.StructType([
    T.StructField("metric", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("station_id", T.StringType()),
    T.StructField("station_name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("value", T.DoubleType()),
])

CLEAN_COLUMNS = [f.name for f in CLEAN_SCHEMA.fields]

# Item-level and day-level rejects of the flatten.
REJECT_SCHEMA = T.StructType([
    T.StructField("metric", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("day_id", T.LongType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("station_id", T.StringType()),
    T.StructField("raw_value", T.StringType()),
    T.StructField("reason", T.StringType()),
])

# The clean layer as it is stored: readings and rejects side by side, told
# apart by `kind`; partition columns last.  `batch_id` names the run that wrote
# a folder ("full" for a rebuild).
FLATTENED_SCHEMA = T.StructType([
    *[f for f in CLEAN_SCHEMA.fields if f.name not in ("metric", "date")],
    *[f for f in REJECT_SCHEMA.fields if f.name in ("source_file", "day_id", "position", "raw_value", "reason")],
    T.StructField("kind", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("batch_id", T.StringType()),
])
