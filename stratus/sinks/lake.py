"""Lake layout, writers and the file manifest.

Layout: `{root}/{layer}/weather/{table}` with layers raw / clean / curated;
the clean layer holds the flattened readings and the rejects side by side
(`clean/weather/flattened/kind=readings|rejects/metric=/date=/batch_id=`), for
batch and incremental runs alike.  `root` may be any Hadoop path (`s3a://bucket`, `hdfs://…`,
`file:/…`); credentials come from the Hadoop configuration, not code.

Parquet is the system of record; CSV is an export.  CSV is written and read
with `nullValue="\\N"` (the empty string, a valid station name, is then
written quoted), and a text that starts with a backslash gets one more, so that
NULL, NaN, "" and a station called `\\N` all survive a round trip.
"""

from __future__ import annotations

import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.operators.flatten import KIND_READINGS, KIND_REJECTS, annotate_days, split_of
from stratus.schemas import CLEAN_SCHEMA, FLATTENED_SCHEMA, REJECT_SCHEMA
from stratus.sinks import snapshots

RAW, CLEAN, CURATED = "raw", "clean", "curated"
DOMAIN = "weather"
CSV_NULL = "\\N"
# Blanks, quotes and line ends in a text come back as they were.
CSV_FAITHFUL = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def layer_path(root: str, layer: str, table: str | None = None) -> str:
    base = f"{root.rstrip('/')}/{layer}/{DOMAIN}"
    return f"{base}/{table}" if table else base


# ---------------------------------------------------------------- parquet --

def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite", rebalance: bool = True) -> str:
    """A full rebuild replaces the whole table, whatever the session says about
    partition overwrites.  `rebalance` shuffles on the partition columns, so a
    partition's file count follows its size."""
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None,
                 schema: T.StructType | None = None) -> DataFrame:
    """Read back; partition columns are moved back into the given order."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    return df.select(*columns) if columns else df


# -------------------------------------------------------------------- csv --

def write_csv(df: DataFrame, path: str, single_file: bool = False,
              mode: str = "overwrite") -> str:
    """Header row, `\\N` for NULL.  `single_file` only for small curated
    tables: it funnels the (already aggregated) rows through one task."""
    df = _texts(df, lambda c: F.when(c.startswith("\\"), F.concat(F.lit("\\"), c)).otherwise(c))
    out = df.coalesce(1) if single_file else df
    (out.write.mode(mode)
        .option("header", True)
        .option("nullValue", CSV_NULL)
        .options(**CSV_FAITHFUL)
        .csv(path))
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    df = (spark.read.schema(schema)
          .option("header", True)
          .option("nullValue", CSV_NULL)
          .options(multiLine=True, **CSV_FAITHFUL)
          .csv(path))
    return _texts(df, lambda c: F.when(c.startswith("\\"), F.substring(c, 2, 1 << 30)).otherwise(c))


def _texts(df: DataFrame, change) -> DataFrame:
    """`change` applied to the text columns."""
    return df.select(*[change(df[f"`{f.name}`"]).alias(f.name) if isinstance(f.dataType, T.StringType) else df[f"`{f.name}`"]
                       for f in df.schema.fields])


# ------------------------------------------------------------------ layers --

def publish_raw(days: DataFrame, root: str) -> str:
    """Land day responses as newline-delimited JSON partitioned by metric.

    Rebalanced on the metric first: a metric holding most days is split over
    several tasks and files by AQE instead of one file per task per metric.
    """
    path = layer_path(root, RAW)
    (days.select("metric", "data").hint("rebalance", "metric")
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("metric").json(path))
    return path


def publish_raw_arrays(days: DataFrame, root: str, cut_short=None) -> str:
    """Land day responses (metric, date, span, text) in the original download's
    form: files that hold one JSON array each, here one per metric and date,
    under `metric=` folders.  `cut_short`, a boolean over metric and date, drops
    the last characters of files, as a broken transfer does.
    """
    path = layer_path(root, RAW, "arrays")
    text = F.col("body")
    if cut_short is not None:
        text = F.when(cut_short, F.expr("left(body, length(body) - 3)")).otherwise(F.col("body"))
    files = days.groupBy("metric", "date").agg(F.array_sort(F.collect_list(F.struct("span", "text"))).alias("days"))
    files = files.withColumn("body", F.concat(F.lit("["), F.array_join(F.col("days.text"), ","), F.lit("]")))
    (files.select("metric", text.alias("value"))
     .write.mode("overwrite").option("partitionOverwriteMode", "static").option("maxRecordsPerFile", 1)
     .partitionBy("metric").text(path))
    return path


def ingest_clean(spark: SparkSession, raw_days: DataFrame, root: str,
                 rebalance: bool = True) -> tuple[str, str]:
    """Flatten raw days into the clean layer; returns (readings path, rejects path).

    One job: the JSON is parsed once and clean readings and rejects leave the
    same `explode` (`flatten.split_of`), written under
    `clean/weather/flattened/kind={readings,rejects}/metric=…/date=…/batch_id=full`.
    Nothing is persisted, so the job's footprint does not grow with the
    input beyond what the write itself needs.

    `rebalance` (default) adds one shuffle on the partition columns before the
    write (the REBALANCE hint): AQE then coalesces small partitions and splits
    a hot date into several tasks, so the file count follows the data volume
    instead of tasks × dates.  Without it, raw files that each span many dates
    make every task write a file into every date it saw.
    """
    base = layer_path(root, CLEAN, "flattened")
    parts = snapshots.PARTITIONS
    rows = split_of(annotate_days(raw_days)).withColumn(snapshots.BATCH, F.lit("full"))
    write_parquet(rows, base, parts, rebalance=rebalance)
    return f"{base}/kind={KIND_READINGS}", f"{base}/kind={KIND_REJECTS}"


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """Clean readings with their declared schema and column order."""
    return _read_or_empty(spark, path, CLEAN_SCHEMA)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rejects with their declared schema (empty when none were written)."""
    return _read_or_empty(spark, path, REJECT_SCHEMA)


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a kind that count (see snapshots), with their declared
    schema; empty when nothing was written."""
    base = path.rsplit("/kind=", 1)[0]
    try:
        rows = spark.read.schema(FLATTENED_SCHEMA).option("basePath", base).parquet(path)
        return rows.where(snapshots.live_filter(spark, base)).select(*schema.names)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def publish_curated(df: DataFrame, root: str, table: str,
                    partition_by: list[str] | None = None,
                    order_by: list | None = None) -> tuple[str, str]:
    """Write one curated table as Parquet, then export the written table as
    CSV (the query runs once; the export reads the small curated files and
    sorts them for presentation when `order_by` is given)."""
    spark = df.sparkSession
    pq = write_parquet(df, layer_path(root, CURATED, table), partition_by)
    written = spark.read.schema(df.schema).parquet(pq).select(*df.columns)
    if order_by:
        written = written.orderBy(*order_by)
    csv = write_csv(written, layer_path(root, CURATED, f"{table}_csv"), single_file=not partition_by)
    return pq, csv


def publish_curated_all(tables: dict[str, DataFrame], root: str,
                        partitioning: dict[str, list[str]] | None = None,
                        order: dict[str, list] | None = None,
                        parallel: int = 4) -> dict[str, tuple[str, str]]:
    """Publish independent curated tables as concurrent Spark jobs.

    Each table is its own job; submitting them together lets the scheduler
    fill free task slots with the next table while one finishes (the
    tables are small aggregates, so their last stages are narrow).
    """
    from concurrent.futures import ThreadPoolExecutor

    partitioning = partitioning or {}
    order = order or {}
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futures = {
            name: pool.submit(publish_curated, df, root, name,
                              partitioning.get(name), order.get(name))
            for name, df in tables.items()
        }
        return {name: f.result() for name, f in futures.items()}


# ---------------------------------------------------------------- manifest --

def file_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Every data file under `root`: path relative to root, bytes, KB.

    Listing and sizes come from Spark's file source (`binaryFile`); the
    content column is never selected, so no file is read.  Paths are
    relative to `root` (like object keys under a bucket).
    """
    base = root.rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(base)
        .select("path", "length")
    )
    rel = F.regexp_extract(F.col("path"), "^.*?" + re.escape(_without_scheme(base)) + "/(.*)$", 1)
    return files.select(
        rel.alias("path"),
        F.col("length"),
        F.round(F.col("length") / F.lit(1024.0), 2).alias("size_kb"),
    )


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """Top-level entries of `root` with their size in bytes, a directory as 0
    (the local listing of the output folder); built from the manifest with
    one small aggregation."""
    m = file_manifest(spark, root)
    parts = F.split(F.col("path"), "/")            # [entry, ...]
    is_dir = F.size(parts) > 1
    return (
        m.select(F.element_at(parts, 1).alias("name"),
                 F.when(is_dir, F.lit(0)).otherwise(F.col("length")).cast("long").alias("length"))
        .groupBy("name").agg(F.max("length").alias("length"))
    )


def _without_scheme(base: str) -> str:
    """The root as it appears inside listed URIs: scheme dropped, local paths absolute."""
    m = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:(.*)$", base)
    if m:
        rest = m.group(1)
        return rest if rest.startswith("//") else "/" + rest.lstrip("/")
    return os.path.abspath(base)
