"""Curated tables over the clean long readings (DataFrame form).

Every function takes the clean readings (CLEAN_SCHEMA, all metrics) and
returns a lazy DataFrame.  Each aggregation is a partial (map-side) +
final hash aggregate over one exchange on its grouping keys, so a hot
station or date is combined before the shuffle.  Sorts run on aggregated
rows only; the top-k is a `TakeOrderedAndProject` (no full sort).

Ordering: the original sorts by the *rounded* values, where ties are
common; a unique final key (station_name / date) makes results
deterministic, which matters under LIMIT.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions.columns import (
    TOTAL_TYPE,
    as_sum_decimal,
    avg_of,
    exact_avg,
    exact_sum,
    misfits,
    round2,
)
from stratus.schemas import HUMIDITY, METRIC_BY_NAME, RAINFALL, TEMPERATURE


def metric_rows(readings: DataFrame, metric: str) -> DataFrame:
    """Rows of one metric (a partition filter on a metric-partitioned layer)."""
    return readings.where(F.col("metric") == F.lit(metric))


def metric_view(readings: DataFrame, metric: str) -> DataFrame:
    """The per-metric relation with its named value column (e.g. temperature_c)."""
    m = METRIC_BY_NAME[metric]
    return metric_rows(readings, metric).select(
        "timestamp", "station_id", "station_name", "latitude", "longitude",
        F.col("value").alias(m.value_column),
    )


def daily_temp(readings: DataFrame, by: str = "station_name",
               ordered: bool = True) -> DataFrame:
    """Average and max temperature per station per day."""
    out = (
        metric_rows(readings, TEMPERATURE)
        .groupBy("date", by)
        .agg(exact_avg("value").alias("avg_temp_c"),
             round2(F.max("value")).alias("max_temp_c"))
    )
    return out.orderBy(F.asc("date"), F.desc("avg_temp_c"), F.asc(by)) if ordered else out


def hottest_stations(readings: DataFrame, k: int = 10, by: str = "station_name") -> DataFrame:
    """Top-k stations by average temperature over all days."""
    return (
        metric_rows(readings, TEMPERATURE)
        .groupBy(by)
        .agg(exact_avg("value").alias("avg_temp_c"),
             round2(F.max("value")).alias("max_temp_c"))
        .orderBy(F.desc("avg_temp_c"), F.asc(by))
        .limit(k)
    )


def temperature_partials(readings: DataFrame, by: str = "station_name") -> DataFrame:
    """Mergeable partials per (date, station): exact sum, double sum, count,
    values the exact sum can't hold, max.

    `daily_temp` and `hottest_stations` both follow from this one small
    table, so a batch run scans the temperature rows once, and the
    incremental mode can keep a non-date-keyed table (hottest) current by
    re-aggregating the stored per-date partials.
    """
    return (
        metric_rows(readings, TEMPERATURE)
        .groupBy("date", by)
        .agg(F.try_sum(as_sum_decimal("value")).alias("sum_value"),
             F.sum("value").alias("sum_double"),
             F.count("value").alias("n_values"),
             misfits("value").alias("n_misfits"),
             F.max("value").alias("max_value"))
    )


def daily_temp_from_partials(partials: DataFrame, by: str = "station_name",
                             ordered: bool = True) -> DataFrame:
    out = partials.select(
        "date", by,
        avg_of(F.col("sum_value"), F.col("sum_double"), F.col("n_values"),
               F.col("n_misfits")).alias("avg_temp_c"),
        round2("max_value").alias("max_temp_c"),
    )
    return out.orderBy(F.asc("date"), F.desc("avg_temp_c"), F.asc(by)) if ordered else out


def merge_partials(partials: DataFrame, *keys: str, by: str = "station_name") -> DataFrame:
    """Partials of several periods as one per `keys` and station.  The sum keeps
    the type of a single scan's, so the quotient is the same; a sum beyond that
    type counts as a value it can't hold."""
    lost = F.col("sum_value").isNull() & (F.col("n_values") > 0)
    return partials.groupBy(*keys, by).agg(
        F.try_sum("sum_value").try_cast(TOTAL_TYPE).alias("sum_value"), F.sum("sum_double").alias("sum_double"),
        F.sum("n_values").alias("n_values"),
        F.sum(F.greatest(F.col("n_misfits"), lost.cast("long"))).alias("n_misfits"),
        F.max("max_value").alias("max_value"))


def hottest_from_partials(partials: DataFrame, k: int = 10, by: str = "station_name") -> DataFrame:
    """Top-k stations from partials of any period."""
    return (
        merge_partials(partials, by=by)
        .select(by, avg_of(F.col("sum_value"), F.col("sum_double"), F.col("n_values"),
                           F.col("n_misfits")).alias("avg_temp_c"),
                round2("max_value").alias("max_temp_c"))
        .orderBy(F.desc("avg_temp_c"), F.asc(by))
        .limit(k)
    )


def rainiest_days(readings: DataFrame, ordered: bool = True) -> DataFrame:
    """Total rainfall per day over all stations, wettest first."""
    out = (
        metric_rows(readings, RAINFALL)
        .groupBy("date")
        .agg(exact_sum("value").alias("total_rainfall_mm"))
    )
    return out.orderBy(F.desc("total_rainfall_mm"), F.asc("date")) if ordered else out


def rainiest_ranked(readings: DataFrame) -> DataFrame:
    """Rainfall per day with its rank; equal totals share a rank.

    The window has no partition key on purpose (a global rank), so it runs
    after the aggregation, over one row per date.
    """
    days = (
        metric_rows(readings, RAINFALL)
        .groupBy("date")
        .agg(exact_sum("value").alias("total_rainfall_mm"))
    )
    w = Window.orderBy(F.desc("total_rainfall_mm"))
    return days.withColumn("rain_rank", F.rank().over(w))


def daily_humidity(readings: DataFrame, ordered: bool = True) -> DataFrame:
    """Network-wide average and max humidity per day."""
    out = (
        metric_rows(readings, HUMIDITY)
        .groupBy("date")
        .agg(exact_avg("value").alias("avg_humidity_pct"),
             round2(F.max("value")).alias("max_humidity_pct"))
    )
    return out.orderBy("date") if ordered else out


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First n rows of a curated table, as data (the notebook's show(5))."""
    return df.limit(n)


def metric_counts(readings: DataFrame) -> DataFrame:
    """Rows per metric in one job (instead of one count action per metric)."""
    return readings.groupBy("metric").agg(F.count(F.lit(1)).alias("n_rows"))


def trailing_days(readings: DataFrame, days: int = 7) -> DataFrame:
    """Readings of the last `days` calendar dates present in the data.

    The end date is the data's own maximum (a scalar subquery), not the
    wall clock, so re-running on old data gives the same answer.
    """
    last = readings.select(F.max("date")).scalar()
    return readings.where(F.col("date") > F.date_sub(last, days))


# Presentation order of each curated table (unique final key).
ORDER = {
    "daily_temp": lambda: [F.asc("date"), F.desc("avg_temp_c"), F.asc("station_name")],
    "hottest_stations": lambda: [F.desc("avg_temp_c"), F.asc("station_name")],
    "rainiest_days": lambda: [F.desc("total_rainfall_mm"), F.asc("date")],
    "daily_humidity": lambda: [F.asc("date")],
}

CURATED = {
    "daily_temp": daily_temp,
    "hottest_stations": hottest_stations,
    "rainiest_days": rainiest_days,
    "daily_humidity": daily_humidity,
}
