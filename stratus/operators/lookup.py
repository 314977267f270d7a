"""Station lookup: left-outer equi-join of readings to a station dimension.

Spark chooses the join: it broadcasts a dimension whose size in bytes is under
its threshold, by the statistics of the plan or, with AQE, by the size measured
at run time.  A larger one is sort-merge joined, and AQE splits hot station
keys.  No job runs while the plan is built.  A missing station keeps the
reading with name "" and coordinates 0.0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_stations(stations: DataFrame, key: str = "station_id",
                    order_by: str | None = None) -> DataFrame:
    """One row per station id; with `order_by`, the row with the largest
    order value wins (the last entry, when it is an ingest position)."""
    if order_by is None:
        return stations
    others = [c for c in stations.columns if c not in (key, order_by)]
    return (
        stations.groupBy(key)
        .agg(F.max_by(F.struct(*others), F.col(order_by)).alias("s"))
        .select(key, "s.*")
    )


def station_lookup(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """readings(station_id, ...) ⟕ stations(station_id, station_name, latitude, longitude).

    The station columns are default-filled; the readings' own columns come
    first, in their order.  `stations` must hold one row per station_id (a
    dictionary, as in the original); `unique_stations` makes it so when a
    source repeats ids, so that a reading is never duplicated by the join.
    """
    dim = stations.selectExpr("station_id AS _sid", "station_name AS _name",
                              "latitude AS _lat", "longitude AS _lon")
    base = [c for c in readings.columns
            if c not in ("station_name", "latitude", "longitude")]
    return (
        readings.join(dim, readings["station_id"] == dim["_sid"], "left")
        .selectExpr(
            *[f"`{c}`" for c in base],
            "coalesce(_name, '') AS station_name",
            "coalesce(_lat, 0.0D) AS latitude",
            "coalesce(_lon, 0.0D) AS longitude",
        )
    )
