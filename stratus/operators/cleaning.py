"""Cleaning operators: typed casting, deduplication, null policy.

All are column expressions or one aggregation; none collects data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.functions.columns import parse_value

READING_KEY = ["metric", "station_id", "timestamp"]

# Defaults of the station attributes of a reading whose
# station is unknown.
STATION_DEFAULTS = {"station_name": "", "latitude": 0.0, "longitude": 0.0}


def typed_cast(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Parse a text value column to DOUBLE; malformed text becomes NULL."""
    return df.withColumn(out or column, parse_value(F.col(column)))


def dedup_readings(df: DataFrame, key: list[str] | None = None,
                   order_by: str | None = None) -> DataFrame:
    """One row per reading key.

    Exact copies collapse; for differing copies the row with the largest
    `order_by` (e.g. ingest time) wins, or without it the largest row, so
    the result never depends on partitioning.  The choice is an
    aggregation (`max_by` / `max` over a struct), which Spark combines
    map-side: a key repeated millions of times is reduced before the
    shuffle instead of landing in one task.
    """
    key = key or READING_KEY
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.groupBy(*key).agg().select(*df.columns)
    row = F.struct(*rest)
    pick = F.max_by(row, F.col(order_by)) if order_by else F.max(row)
    return df.groupBy(*key).agg(pick.alias("_r")).select(*key, "_r.*").select(*df.columns)


def new_copies(batch: DataFrame, kept: DataFrame, key: list[str] | None = None) -> DataFrame:
    """The rows of `batch` to add to `kept` so that `dedup_readings` of all of
    them is what it is over both deliveries: one per key, the largest copy, and
    none where `kept` has one as large.

    The largest copy wins whichever run brought it, so the result doesn't depend
    on the order of arrival.  One aggregation, combined map-side; no join, so NULL
    keys and a key repeated millions of times need no care.
    """
    key, cols = key or READING_KEY, batch.columns
    rest = [c for c in cols if c not in key]
    both = kept.select(*cols, F.lit(True).alias("_old")).unionByName(batch.select(*cols, F.lit(False).alias("_old")))
    best = both.groupBy(*key).agg(F.max(F.struct(*rest, "_old")).alias("_r")).where(~F.col("_r._old"))
    return best.select(*[F.col(c) if c in key else F.col(f"_r.{c}").alias(c) for c in cols])


def null_policy(df: DataFrame, fill: dict | None = None,
                required: list[str] | None = None) -> DataFrame:
    """Fill defaults, then drop rows still missing a required column."""
    fill = STATION_DEFAULTS if fill is None else fill
    required = ["timestamp", "station_id", "value"] if required is None else required
    out = df
    present = {k: v for k, v in fill.items() if k in df.columns}
    if present:
        out = out.na.fill(present)
    if required:
        # Not na.drop, which takes NaN for missing; a NaN reading is a value.
        for c in required:
            if c in df.columns:
                out = out.where(F.col(c).isNotNull())
    return out
