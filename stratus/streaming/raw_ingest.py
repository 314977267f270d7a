"""Incremental runs from raw files, on the batch job's lake layout.

Raw JSON files land in a folder.  A Structured Streaming file source takes them
up as VARIANT; flatten, quarantine and station lookup are the batch job's own
expressions inside the stream.  Each micro-batch:

1. leaves out files that the ledger holds (by resolved path, length and time),
   whoever brought them;
2. writes clean readings and rejects under
   `clean/weather/flattened/kind=/metric=/date=/batch_id=`, replacing only its
   own folders, so a retried batch doesn't count twice;
3. recomputes the touched (metric, date) pairs of the curated tables from just
   those folders; `daily_temp` by date partition, the small tables as
   snapshots, which `read_table` resolves;
4. notes its files in the ledger, last, so a batch that died is redone whole.

A changed file (another length or time) is a delivery of its own, as it is to
a batch run over both.  Full rebuilds (`plans.batch.run_batch`) write the same
layout under `batch_id=full`.
"""

from __future__ import annotations

from zlib import crc32

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.operators.flatten import KIND_READINGS, annotate_days, split_of
from stratus.plans import curated as C
from stratus.schemas import CLEAN_COLUMNS, FLATTENED_SCHEMA, HUMIDITY, RAINFALL, TEMPERATURE
from stratus.sinks import lake, snapshots
from stratus.sources.raw_json import RAW_FILES, VARIANT_SCHEMA, variant_days
from stratus.streaming import rollups

LEDGER_SCHEMA = "file STRING, length BIGINT, modified TIMESTAMP, batch_id STRING"
_FILE = ["file", "length", "modified"]
# Each date-keyed table and the metric it is made of.
BY_DATE = {
    "rainiest_days": (RAINFALL, lambda r: C.rainiest_days(r, ordered=False)),
    "daily_humidity": (HUMIDITY, lambda r: C.daily_humidity(r, ordered=False)),
}
TABLES = (*BY_DATE, "daily_temp", "hottest_stations")
PARTIALS = "_temperature_partials"


def _replace(df: DataFrame, path: str, partitions: list[str]) -> None:
    (df.hint("rebalance", *partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions).parquet(path))


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def flattened(raw: DataFrame, multiline: bool) -> DataFrame:
    """Readings and rejects of `raw` (VARIANT_SCHEMA), each with its file."""
    rows = split_of(annotate_days(variant_days(raw, multiline, with_origin=True)))
    return rows.select(*[c for c in rows.columns if c != "origin"], "origin.*")


def _publish_dates(fresh: DataFrame, path: str, dates: list) -> None:
    """Publish a date-keyed table with the rows of `dates` replaced by `fresh`."""
    spark = fresh.sparkSession
    try:
        old = spark.read.schema(fresh.schema).parquet(snapshots.current(spark, path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        old = None
    snapshots.publish(fresh if old is None else old.where(~_on(dates)).unionByName(fresh), path)


def _on(dates: list):
    """Literal filter, never NULL: the rows of these dates, the NULL date too."""
    on = F.coalesce(F.col("date").isin([d for d in dates if d is not None]), F.lit(False))
    return on | F.col("date").isNull() if None in dates else on


def touched_folders(base: str, touched: list, metric: str) -> list[str]:
    """Folders of the touched dates of one metric."""
    return [f"{base}/kind={KIND_READINGS}/metric={metric}/date="
            + (str(t.date) if t.date is not None else "__HIVE_DEFAULT_PARTITION__") for t in touched if t.metric == metric]


def make_handler(spark: SparkSession, root: str, feed: str, tables: tuple[str, ...] = TABLES):
    """foreachBatch body over rows of flattened()."""
    unknown = set(tables) - set(TABLES)
    if unknown:
        raise ValueError(f"not maintainable incrementally: {sorted(unknown)}")
    base = lake.layer_path(root, lake.CLEAN, "flattened")
    ledger = lake.layer_path(root, lake.CLEAN, "ledger")
    table = {t: lake.layer_path(root, lake.CURATED, t) for t in (*TABLES, PARTIALS)}

    def clean(touched: list, metric: str) -> DataFrame | None:
        paths = touched_folders(base, touched, metric)
        if not paths:
            return None
        rows = spark.read.schema(FLATTENED_SCHEMA).option("basePath", base).parquet(*paths)
        return rows.where(snapshots.live_filter(spark, base)).select(*CLEAN_COLUMNS)

    def handle(batch: DataFrame, batch_id: int) -> None:
        name = f"{feed}-{batch_id}"
        known = _ledger(spark, ledger).where(F.col("batch_id") != name).select(*_FILE)
        fresh = batch.join(known, _FILE, "left_anti").persist()
        try:
            files = fresh.select(*_FILE).distinct()
            _replace(fresh.drop(*_FILE).withColumn("batch_id", F.lit(name)), base, snapshots.PARTITIONS)
            # One row per metric and calendar day of the batch.
            touched = fresh.where(F.col("kind") == KIND_READINGS).select("metric", "date").distinct().collect()
            for t, (metric, make) in BY_DATE.items():
                rows = clean(touched, metric) if t in tables else None
                if rows is not None:      # one row a date: the others stay as they are
                    _publish_dates(make(rows), table[t], [x.date for x in touched if x.metric == metric])
            rows = clean(touched, TEMPERATURE) if {"daily_temp", "hottest_stations"} & set(tables) else None
            if rows is not None:
                fresh_partials = C.temperature_partials(rows)
                _replace(fresh_partials, table[PARTIALS], ["date"])
                dates = [t.date for t in touched if t.metric == TEMPERATURE]
                if "daily_temp" in tables:
                    stored = spark.read.schema(fresh_partials.schema).parquet(table[PARTIALS])
                    _replace(C.daily_temp_from_partials(stored.where(_on(dates)), ordered=False), table["daily_temp"], ["date"])
                if "hottest_stations" in tables:
                    years = rollups.refresh(spark, table[PARTIALS], dates)
                    snapshots.publish(C.hottest_from_partials(years), table["hottest_stations"])
            (files.withColumn("batch_id", F.lit(name)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(ledger))
        finally:
            fresh.unpersist()
    return handle


def run_raw_incremental(spark: SparkSession, landing: str, root: str, tables: tuple[str, ...] = TABLES,
                        multiline: bool = True, files_per_batch: int = 100, timeout_s: float | None = None,
                        pattern: str = RAW_FILES) -> dict[str, str]:
    """Take up all raw files of `landing` that weren't yet; returns the tables' paths.

    `multiline`: files of one array each whose names match `pattern`, else files
    of lines under `metric=` folders.
    """
    source = snapshots.qualified(spark, landing)
    feed = f"raw-{crc32(source.encode()):08x}"
    schema = T.StructType.fromDDL(VARIANT_SCHEMA if multiline else f"{VARIANT_SCHEMA}, metric STRING")
    reader = (spark.readStream.schema(schema).option("singleVariantColumn", "body").option("multiLine", multiline)
              .option("maxFilesPerTrigger", files_per_batch))
    if multiline:
        reader = reader.option("pathGlobFilter", pattern)
    query = (flattened(reader.json(source), multiline).writeStream
             .foreachBatch(make_handler(spark, root, feed, tuple(tables)))
             .option("checkpointLocation", f"{root.rstrip('/')}/_checkpoint/{feed}")
             .trigger(availableNow=True).start())
    if query.awaitTermination(timeout_s) is False:
        query.stop()
        raise TimeoutError(f"incremental run not finished within {timeout_s} s")
    return {t: lake.layer_path(root, lake.CURATED, t) for t in tables}


def read_table(spark: SparkSession, root: str, table: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(snapshots.current(spark, lake.layer_path(root, lake.CURATED, table))).select(*columns)


def main(argv: list[str] | None = None) -> None:
    """Scheduled run: take up every raw file not taken up yet, then stop.

        python -m stratus raw-incremental --landing <raw folder> --root <lake root>
    """
    import argparse

    p = argparse.ArgumentParser(description=main.__doc__)
    p.add_argument("--landing", required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--ndjson", action="store_true", help="one day response per line, under metric= folders")
    p.add_argument("--files-per-batch", type=int, default=100)
    p.add_argument("--compact", type=int, default=0, metavar="FILES",
                   help="afterwards rewrite partitions of at least so many files")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("stratus-raw-incremental").getOrCreate()
    for table, path in run_raw_incremental(spark, a.landing, a.root, multiline=not a.ndjson,
                                           files_per_batch=a.files_per_batch).items():
        print(f"{table}\t{path}")
    if a.compact:
        snapshots.compact(spark, lake.layer_path(a.root, lake.CLEAN, "flattened"), FLATTENED_SCHEMA, a.compact)


if __name__ == "__main__":
    main()
