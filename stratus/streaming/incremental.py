"""Incremental ingest whose curated output equals the batch run.

New clean-reading files land in a directory (partitioned by `date`).  A
Structured Streaming file source picks them up (`trigger(availableNow=True)`
for scheduled runs, or a processing-time trigger), and each micro-batch:

1. appends the batch to the clean layer under `date=…/batch_id=…` with
   dynamic partition overwrite — a retried batch replaces its own files
   instead of appending twice;
2. recomputes the curated table for the dates the batch touched, from the
   whole clean layer (an average or max of a date cannot be merged from
   rounded output, so whole dates are recomputed); the date-partitioned
   clean layer is pruned to those dates (`touched_filter`);
3. replaces exactly those date partitions of the curated table.

Temperature is kept as exact per-(date, station) partials (decimal sum,
count, max; `curated.temperature_partials`), maintained per date like the
tables above.  daily_temp follows from the touched dates' partials, and
hottest_stations — not keyed by date — from their rollup to years
(`rollups.py`), of which only the touched months and years are merged again.

With `dedup` readings are kept once across runs: of a batch only the copies
that win over the stored ones are added (`cleaning.new_copies`), and the tables
are made of one row per reading key.  The largest copy wins, whichever run
brought it.

Late files simply touch older dates again.  Progress is kept in the
stream checkpoint under the shared checkpoint folder, so a restarted job
continues where it stopped.
"""

from __future__ import annotations

from typing import Callable
from zlib import crc32

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.operators.cleaning import dedup_readings, new_copies
from stratus.plans import curated as C
from stratus.schemas import CLEAN_COLUMNS, CLEAN_SCHEMA, TEMPERATURE
from stratus.sinks import snapshots
from stratus.streaming import rollups

# Curated tables that are keyed by date and so can be maintained per date.
# daily_temp is derived from the stored temperature partials instead.
DATE_KEYED: dict[str, Callable[[DataFrame], DataFrame]] = {
    "rainiest_days": lambda r: C.rainiest_days(r, ordered=False),
    "daily_humidity": lambda r: C.daily_humidity(r, ordered=False),
}
# Tables built from the per-date temperature partials.
FROM_PARTIALS = ("daily_temp", "hottest_stations")
SUPPORTED = tuple(DATE_KEYED) + FROM_PARTIALS
PARTIALS = "_temperature_partials"

BATCH_COL = "batch_id"

def land(readings: DataFrame, landing: str) -> str:
    """Append clean readings to a landing directory, one folder per date."""
    (readings.select(*CLEAN_COLUMNS).hint("rebalance", "date").write.mode("append").partitionBy("date").parquet(landing))
    return landing


def _dynamic_overwrite(df: DataFrame, path: str, partition_by: list[str]) -> None:
    # Rebalanced on the partition columns: file counts follow the data, not
    # tasks x dates.
    (df.hint("rebalance", *partition_by).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by)
       .parquet(path))


def _clean_schema_with_batch() -> T.StructType:
    return T.StructType(CLEAN_SCHEMA.fields + [T.StructField(BATCH_COL, T.StringType())])


def touched_filter(batch: DataFrame):
    """How to select the dates a batch touched from a date-partitioned table.

    Returns a function DataFrame -> DataFrame.  Dynamic partition pruning
    does not fire when the filtering side is a persisted micro-batch (no
    selective predicate), so the batch's distinct dates, one value per
    calendar day, become a literal filter that prunes partitions at planning
    time.  The NULL date is one of them.
    """
    dates = [r[0] for r in batch.select("date").distinct().collect()]
    known = [d for d in dates if d is not None]
    cond = F.col("date").isin(known)
    if len(known) < len(dates):
        cond = cond | F.col("date").isNull()
    return lambda df: df.where(cond)


def _stored(spark: SparkSession, clean: str) -> DataFrame:
    """The clean layer with its batch ids; empty before the first batch."""
    try:
        return spark.read.schema(_clean_schema_with_batch()).parquet(clean)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _clean_schema_with_batch())


def make_batch_handler(spark: SparkSession, clean: str, curated: dict[str, str],
                       partials: str | None = None, feed: str = "feed", dedup: bool = False):
    """foreachBatch body.  `feed` names the landing folder, so that batches of
    different feeds never overwrite each other in the clean layer.  `partials` (a path) is required when daily_temp or
    hottest_stations is maintained.  `dedup` keeps readings once across runs."""
    unknown = set(curated) - set(SUPPORTED)
    if unknown:
        raise ValueError(f"not maintainable incrementally: {sorted(unknown)}")
    if partials is None and set(curated) & set(FROM_PARTIALS):
        raise ValueError("a partials path is needed for daily_temp / hottest_stations")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select(*CLEAN_COLUMNS).persist()
        name = f"{feed}-{batch_id}"
        try:
            only_touched = touched_filter(batch)
            added = batch
            if dedup:      # a retried batch is held against what the others brought
                others = only_touched(_stored(spark, clean)).where(F.col(BATCH_COL) != name)
                added = new_copies(batch, others.select(*CLEAN_COLUMNS))
            _dynamic_overwrite(added.withColumn(BATCH_COL, F.lit(name)), clean, ["date", BATCH_COL])
            whole = only_touched(_stored(spark, clean)).select(*CLEAN_COLUMNS)
            if dedup:
                whole = dedup_readings(whole)
            for table, path in curated.items():
                if table in DATE_KEYED:
                    _dynamic_overwrite(DATE_KEYED[table](whole), path, ["date"])
            if partials is not None and set(curated) & set(FROM_PARTIALS):
                fresh_partials = C.temperature_partials(whole)
                _dynamic_overwrite(fresh_partials, partials, ["date"])
                if "daily_temp" in curated:
                    stored = spark.read.schema(fresh_partials.schema).parquet(partials)
                    _dynamic_overwrite(C.daily_temp_from_partials(only_touched(stored), ordered=False),
                                       curated["daily_temp"], ["date"])
                if "hottest_stations" in curated:
                    # One value per calendar day of the batch's temperatures.
                    dates = [r.date for r in C.metric_rows(batch, TEMPERATURE).select("date").distinct().collect()]
                    years = rollups.refresh(spark, partials, dates)
                    snapshots.publish(C.hottest_from_partials(years), curated["hottest_stations"])
        finally:
            batch.unpersist()
    return handle


def clean_path(root: str) -> str:
    return f"{root.rstrip('/')}/clean/readings"


def read_clean(spark: SparkSession, root: str, dedup: bool = False) -> DataFrame:
    """The clean rows of a lake; with `dedup` one per reading key."""
    rows = _stored(spark, clean_path(root)).select(*CLEAN_COLUMNS)
    return dedup_readings(rows) if dedup else rows


def run_incremental(spark: SparkSession, landing: str, root: str,
                    tables: list[str], files_per_batch: int = 10,
                    available_now: bool = True, timeout_s: float | None = None,
                    dedup: bool = False) -> dict[str, str]:
    """Process everything in `landing` not yet processed; return curated paths.
    A lake is kept with `dedup` from its first run on, or without."""
    clean = clean_path(root)
    curated = {t: f"{root.rstrip('/')}/curated/{t}" for t in tables}
    partials = f"{root.rstrip('/')}/curated/{PARTIALS}"
    landing = snapshots.qualified(spark, landing)      # one feed, however the folder is spelt
    feed = f"{crc32(landing.encode()):08x}"
    stream = (
        spark.readStream.schema(CLEAN_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
    )
    writer = (
        stream.writeStream
        .foreachBatch(make_batch_handler(spark, clean, curated, partials, feed, dedup))
        .option("checkpointLocation", f"{root.rstrip('/')}/_checkpoint/{feed}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    q = writer.start()
    # Raises if a micro-batch failed; a run that isn't over in time is stopped.
    if q.awaitTermination(timeout_s) is False:
        q.stop()
        raise TimeoutError(f"incremental run not finished within {timeout_s} s")
    return curated


def read_curated(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A curated table, with its declared schema, so that one without rows reads
    as empty; of hottest_stations its live snapshot."""
    table = C.CURATED[path.rstrip("/").rsplit("/", 1)[-1]]
    schema = table(spark.createDataFrame([], CLEAN_SCHEMA)).schema
    return spark.read.schema(schema).parquet(snapshots.current(spark, path)).select(*columns)


def main(argv: list[str] | None = None) -> None:
    """Scheduled run: process every landed file not processed yet, then stop.

        python -m stratus.streaming.incremental --landing <dir> --root <lake root> \
            --tables daily_temp hottest_stations rainiest_days daily_humidity
    """
    import argparse

    p = argparse.ArgumentParser(description=main.__doc__)
    p.add_argument("--landing", required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--tables", nargs="+", default=list(SUPPORTED), choices=list(SUPPORTED))
    p.add_argument("--files-per-batch", type=int, default=100)
    p.add_argument("--dedup", action="store_true", help="keep readings once across runs")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("stratus-incremental").getOrCreate()
    for table, path in run_incremental(spark, a.landing, a.root, a.tables,
                                       files_per_batch=a.files_per_batch, dedup=a.dedup).items():
        print(f"{table}\t{path}")


if __name__ == "__main__":
    main()
