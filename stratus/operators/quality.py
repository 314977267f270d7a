"""Data-quality report: one row per metric.

Counts rows, NULL and NaN values, values outside the metric's plausible
range, readings whose station is unknown (empty name), readings whose
timestamp text has no date (they form a NULL-date group in the daily
tables), and extra copies of a reading key.  Two chained aggregations, both combined map-side: first per
reading key (metric, station_id, timestamp) — which also counts copies —
then per metric.  No join, no window, no collect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Plausible range per metric (inclusive), in its unit.
VALUE_RANGE = (
    ("air_temperature", -50.0, 60.0),
    ("relative_humidity", 0.0, 100.0),
    ("rainfall", 0.0, 300.0),
    ("wind_speed", 0.0, 250.0),
    ("wind_direction", 0.0, 360.0),
)


def _out_of_range(metric: Column, value: Column) -> Column:
    cond = None
    for name, lo, hi in VALUE_RANGE:
        bad = (metric == name) & ((value < lo) | (value > hi))
        cond = bad if cond is None else (cond | bad)
    return cond


def quality_report(readings: DataFrame) -> DataFrame:
    v = F.col("value")
    per_key = readings.groupBy("metric", "station_id", "timestamp").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(v.isNull()).alias("n_null"),
        F.count_if(F.isnan(v)).alias("n_nan"),
        F.count_if(_out_of_range(F.col("metric"), v) & ~F.isnan(v)).alias("n_range"),
        F.count_if(F.col("station_name") == "").alias("n_unknown"),
        F.count_if(F.col("date").isNull()).alias("n_no_date"),
    )
    return per_key.groupBy("metric").agg(
        F.sum("n").alias("n_rows"),
        F.sum("n_null").alias("n_null_value"),
        F.sum("n_nan").alias("n_nan_value"),
        F.sum("n_range").alias("n_out_of_range"),
        F.sum("n_unknown").alias("n_unknown_station"),
        F.sum("n_no_date").alias("n_null_date"),
        F.count(F.lit(1)).alias("n_keys"),
        F.sum(F.col("n") - 1).alias("n_duplicate_rows"),
    )


def rejects_report(rejects: DataFrame) -> DataFrame:
    """Rejects per metric and reason: rows and distinct days affected.

    Malformed days count once each (they have no items); lost items count
    one per item.  Grouped on two low-cardinality keys, so the partial
    aggregation leaves a handful of rows per task to shuffle.
    """
    return rejects.groupBy("metric", "reason").agg(
        F.count(F.lit(1)).alias("n_rejects"),
        F.countDistinct("day_id").alias("n_days"),
    )
