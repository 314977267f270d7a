"""Temperature rollups, days to months to years, for tables over all days.

The day partials (date, station) are merged into month partials and those into
year partials, each a table partitioned by its period.  After a batch, only the
months and years of its dates are merged again, from the one level below, read
by path.  `hottest_stations` then reads one row per station and year, however
many days the lake holds: a batch reads at most 31 days of each of its months
and 12 months of each of its years.

A level is always rebuilt from the one below, never added to, so late files,
corrections and redone batches need no retraction, and maxima stay right.  The
NULL date is a period of its own.  A level without its mark (an older lake, a first
build that died) is built from all of the level below; a full rebuild of
the partials drops the rollups first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.plans import curated as C
from stratus.schemas import CLEAN_SCHEMA
from stratus.sinks import snapshots

# Each level: its period and how much of an ISO date names one.
LEVELS = (("month", len("2026-03")), ("year", len("2026")))
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def path_of(partials: str, period: str) -> str:
    return f"{partials.rstrip('/')}_{period}"


def _schema(spark: SparkSession, period: str) -> T.StructType:
    days = C.temperature_partials(spark.createDataFrame([], CLEAN_SCHEMA)).schema
    return T.StructType([T.StructField(period if f.name == "date" else f.name, f.dataType) for f in days.fields])


def touched_paths(below: str, column: str, dates: list, named: int) -> list[str]:
    """What to read of the level below for the periods of `dates`."""
    names = sorted({d.isoformat()[:named] for d in dates if d is not None})
    return [f"{below}/{column}={n}-*" for n in names] + ([f"{below}/{column}={NULL_FOLDER}"] if None in dates else [])


def refresh(spark: SparkSession, partials: str, dates: list) -> DataFrame:
    """Merge the periods of `dates`, whose day partials were just replaced;
    returns the top level, one row per station and year."""
    below, column = partials.rstrip("/"), "date"
    for period, named in LEVELS:
        path = path_of(partials, period)
        complete = snapshots.read_pointer(spark, path) is not None
        paths = touched_paths(below, column, dates, named) if complete else [below]
        if paths:
            rows = spark.read.schema(_schema(spark, column)).option("basePath", below).parquet(*paths)
            merged = C.merge_partials(rows.withColumn(period, F.trunc(column, period)), period)
            (merged.hint("rebalance", period).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(period).parquet(path))
        if not complete:
            snapshots.write_pointer(spark, path, {"complete": True})
        below, column = path, period
    return spark.read.schema(_schema(spark, column)).parquet(below)


def drop(spark: SparkSession, partials: str) -> None:
    """Drop the rollups of partials that are about to be rebuilt as a whole."""
    for period, _ in LEVELS:
        fs, p, _ = snapshots._hadoop(spark, path_of(partials, period))
        fs.delete(p, True)
