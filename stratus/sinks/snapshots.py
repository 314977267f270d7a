"""Whole-table snapshots behind a pointer file, and compaction of the clean layer.

A table that is replaced as a whole is written to a folder of its own and then
named in its pointer file, which is renamed into place in one step.  Readers
resolve the pointer, so a publish that dies half-way leaves the former version
readable, and no reader sees half of one.

The clean layer grows by `date=/batch_id=` folders, small ones with frequent
runs.  `compact` rewrites the (kind, metric, date) partitions that hold many
files as one folder and switches its pointer, which names the compactions that
count and the folders they replace; readers filter on partition columns only.
Replaced folders are deleted by the next compaction, when nobody reads them
any more.

Paths are any Hadoop paths; the pointer is a small file, read and written by the
driver through Spark's Hadoop FileSystem.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER = "_CURRENT"
COMPACTED = "compact-"
KEPT_VERSIONS = 2
BATCH = "batch_id"
PARTITIONS = ["kind", "metric", "date", BATCH]


def _hadoop(spark: SparkSession, path: str):
    conf = spark._jsc.hadoopConfiguration()
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, conf


def qualified(spark: SparkSession, path: str) -> str:
    """One spelling per folder: scheme, authority and absolute path, no end slash."""
    fs, p, _ = _hadoop(spark, path)
    return fs.makeQualified(p).toUri().toString().rstrip("/")


def read_pointer(spark: SparkSession, path: str) -> dict | None:
    """The content of the table's pointer file; None without one."""
    fs, p, conf = _hadoop(spark, f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_pointer(spark: SparkSession, path: str, content: dict) -> None:
    """Replace the pointer file in one step."""
    fs, target, conf = _hadoop(spark, f"{path.rstrip('/')}/{POINTER}")
    _, fresh, _ = _hadoop(spark, f"{path.rstrip('/')}/{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    context.rename(fs.makeQualified(fresh), fs.makeQualified(target), options)


def publish(df: DataFrame, path: str) -> str:
    """Write `df` as the table's next version; returns the version's folder.
    The last KEPT_VERSIONS stay for those who read them."""
    spark, base = df.sparkSession, path.rstrip("/")
    version = f"v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{base}/{version}")
    versions = [version, *(read_pointer(spark, base) or {}).get("versions", [])]
    write_pointer(spark, base, {"versions": versions[:KEPT_VERSIONS]})
    for old in versions[KEPT_VERSIONS:]:
        fs, p, _ = _hadoop(spark, f"{base}/{old}")
        fs.delete(p, True)
    return f"{base}/{version}"


def current(spark: SparkSession, path: str) -> str:
    """The folder to read: the live version, or the path itself without a pointer."""
    pointer = read_pointer(spark, path)
    return f"{path.rstrip('/')}/{pointer['versions'][0]}" if pointer and pointer.get("versions") else path


# ------------------------------------------------------------- clean layer --

def live_filter(spark: SparkSession, base: str) -> Column | None:
    """Which rows of the clean layer at `base` count, by its partition columns
    kind, metric, date and batch_id; None where all do."""
    pointer = read_pointer(spark, base)
    batch = F.coalesce(F.col(BATCH), F.lit(""))
    if pointer is None:
        return ~batch.startswith(COMPACTED)
    counts = ~batch.startswith(COMPACTED) | batch.isin(pointer["live"])
    folder = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in PARTITIONS])
    return counts & ~folder.isin(pointer["replaced"]) if pointer["replaced"] else counts


def _folder(base: str, name: str) -> str:
    values = name.split("/")
    return base.rstrip("/") + "".join(
        f"/{c}={v or '__HIVE_DEFAULT_PARTITION__'}" for c, v in zip(PARTITIONS, values, strict=True))


def compact(spark: SparkSession, base: str, schema: T.StructType, min_files: int = 8) -> int:
    """Rewrite the (kind, metric, date) partitions of `base` that hold at least
    `min_files` files; returns how many.  `schema`: all columns, partition
    columns last.  One run at a time, and none beside an ingest of the same
    partitions, as with any rewrite."""
    pointer = read_pointer(spark, base) or {"live": [], "replaced": []}
    for name in pointer["replaced"]:                  # replaced by the run before
        fs, p, _ = _hadoop(spark, _folder(base, name))
        fs.delete(p, True)
    pointer["replaced"] = []
    write_pointer(spark, base, pointer)
    rows = spark.read.schema(schema).parquet(base).where(live_filter(spark, base))
    files = (rows.select(*PARTITIONS, F.col("_metadata.file_path").alias("file")).distinct()
             .groupBy("kind", "metric", "date").agg(F.count("file").alias("files"), F.collect_set(F.concat_ws(
                 "/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in PARTITIONS])).alias("folders"))
             .where(F.col("files") >= min_files).collect())
    if not files:
        return 0
    chosen = None
    for f in files:       # a literal filter on partition columns: only these are read
        one = F.col("kind").eqNullSafe(f.kind) & F.col("metric").eqNullSafe(f.metric) & F.col("date").eqNullSafe(F.lit(f.date))
        chosen = one if chosen is None else chosen | one
    run = f"{COMPACTED}{uuid.uuid4().hex}"
    (rows.where(chosen).withColumn(BATCH, F.lit(run)).hint("rebalance", *PARTITIONS)
     .write.mode("append").partitionBy(*PARTITIONS).parquet(base))
    write_pointer(spark, base, {"live": [*pointer["live"], run], "replaced": sorted({n for f in files for n in f.folders})})
    return len(files)
