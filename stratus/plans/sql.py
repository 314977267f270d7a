"""The curated tables as Spark SQL over per-metric temp views.

This is the original API surface: one temp view per metric, business
logic as SQL text.  The texts differ from the originals only where Spark 4
needs it: `try_cast(timestamp AS DATE)` (a malformed date is NULL instead
of failing the job under ANSI mode), the exact decimal average / sum, and
a unique final sort key.  Catalyst compiles them to the same plans as
plans/curated.py.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratus.functions.columns import SUM_TYPE
from stratus.plans.curated import CURATED, metric_view
from stratus.schemas import METRICS


def register_views(readings: DataFrame, curated: bool = False) -> list[str]:
    """The long table as `readings`, one temp view per metric (temperature,
    humidity, rainfall, ...), and with `curated=True` one per curated table
    (daily_temp, ...)."""
    readings.createOrReplaceTempView("readings")
    names = ["readings"]
    for m in METRICS:
        metric_view(readings, m.name).createOrReplaceTempView(m.view)
        names.append(m.view)
    if curated:
        for name, fn in CURATED.items():
            fn(readings).createOrReplaceTempView(name)
            names.append(name)
    return names


def _exact_or_double(c: str, exact: str, double: str) -> str:
    """The exact aggregate if the decimal type holds every value, else the double one."""
    misfits = f"COUNT_IF({c} IS NOT NULL AND COALESCE(CAST({_dec(c)} AS DOUBLE) <> {c}, TRUE))"
    return f"COALESCE(CASE WHEN {misfits} = 0 THEN CAST(ROUND({exact}, 2) AS DOUBLE) END, ROUND({double}, 2))"


def _dec(c: str) -> str:
    return f"try_cast({c} AS {SUM_TYPE})"


def _avg(c: str) -> str:
    return _exact_or_double(c, f"try_divide(try_sum({_dec(c)}), COUNT({c}))", f"AVG({c})")


def _sum(c: str) -> str:
    return _exact_or_double(c, f"try_sum({_dec(c)})", f"SUM({c})")


DAILY_TEMP = f"""
    SELECT try_cast(timestamp AS DATE) AS date,
           station_name,
           {_avg('temperature_c')} AS avg_temp_c,
           ROUND(MAX(temperature_c), 2) AS max_temp_c
    FROM temperature
    GROUP BY try_cast(timestamp AS DATE), station_name
    ORDER BY date, avg_temp_c DESC, station_name
"""

HOTTEST_STATIONS = f"""
    SELECT station_name,
           {_avg('temperature_c')} AS avg_temp_c,
           ROUND(MAX(temperature_c), 2) AS max_temp_c
    FROM temperature
    GROUP BY station_name
    ORDER BY avg_temp_c DESC, station_name
    LIMIT 10
"""

RAINIEST_DAYS = f"""
    SELECT try_cast(timestamp AS DATE) AS date,
           {_sum('rainfall_mm')} AS total_rainfall_mm
    FROM rainfall
    GROUP BY try_cast(timestamp AS DATE)
    ORDER BY total_rainfall_mm DESC, date
"""

DAILY_HUMIDITY = f"""
    SELECT try_cast(timestamp AS DATE) AS date,
           {_avg('humidity_pct')} AS avg_humidity_pct,
           ROUND(MAX(humidity_pct), 2) AS max_humidity_pct
    FROM humidity
    GROUP BY try_cast(timestamp AS DATE)
    ORDER BY date
"""

QUERIES = {
    "daily_temp": DAILY_TEMP,
    "hottest_stations": HOTTEST_STATIONS,
    "rainiest_days": RAINIEST_DAYS,
    "daily_humidity": DAILY_HUMIDITY,
}


def curated_sql(spark: SparkSession, readings: DataFrame, name: str) -> DataFrame:
    register_views(readings)
    return spark.sql(QUERIES[name])
