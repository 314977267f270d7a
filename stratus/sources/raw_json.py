"""Raw layer reader: day responses as JSON.

Two layouts are read with the same fixed schema (no inference):

* `{metric}_raw.json` files holding a top-level array of day responses
  (the original download format).  `multiLine` mode turns each array
  element into one row; such a file is not splittable, so it is one task.
  `read_raw_variants` reads the same files without a schema, element by
  element, so that a wrongly typed element costs nothing but itself.
* newline-delimited JSON, one day response per line, under
  `metric=<name>/` directories (what `sinks.lake.publish_raw` writes).
  Splittable: large raw layers spread over many tasks.

Files named one by one are read whatever their name; of a folder only
`{metric}_raw.json` and `{metric}_raw.json.gz` files are arrays.

The metric comes from the `metric=` directory when present, else from the
file name.
"""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.schemas import RAW_SCHEMA, RAW_STRICT_SCHEMA

FILE_METRIC = r"^([A-Za-z0-9_]+?)(?:_raw)?\.json(?:\.gz)?$"
RAW_FILES = "*_raw.json{,.gz}"       # day-response arrays of a folder
FILE_NAMED = re.compile(r"\.json(\.gz)?/?$")


def read_raw_days(spark: SparkSession, path: str | list[str],
                  multiline: bool = True, strict: bool = False) -> DataFrame:
    """Columns: metric, source_file, data.

    `strict=True` reads stations and readings as string maps
    (RAW_STRICT_SCHEMA) so the flatten can tell a present-but-null field
    from an absent one, exactly as the original per-day loop did.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = (
        spark.read.schema(RAW_STRICT_SCHEMA if strict else RAW_SCHEMA)
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
    )
    named = [p for p in paths if FILE_NAMED.search(p)]
    folders = [p for p in paths if p not in named]
    if multiline and folders:
        # Only `{metric}_raw.json` files of a folder are day-response arrays.
        # The filter would drop named files too, so those are read without it.
        df = reader.option("pathGlobFilter", RAW_FILES).json(folders)
        if named:
            return (_raw_columns(df).unionByName(
                read_raw_days(spark, named, multiline=True, strict=strict)))
    else:
        df = reader.json(paths)
    return _raw_columns(df)


def _raw_columns(df: DataFrame) -> DataFrame:
    file_name = F.col("_metadata.file_name")
    if "metric" in df.columns:
        metric = F.col("metric")
    else:
        metric = F.regexp_extract(file_name, FILE_METRIC, 1)
    return df.select(metric.cast("string").alias("metric"),
                     file_name.alias("source_file"), "data")


VARIANT_SCHEMA = "body VARIANT, _corrupt_record STRING"


def read_raw_variants(spark: SparkSession, path: str | list[str], multiline: bool = True,
                      on_unreadable: str = "keep", pattern: str = RAW_FILES) -> DataFrame:
    """Day responses as they are, of any JSON type: metric, source_file, place,
    day (VARIANT), day_text.

    A file of an array (`multiline`; of folders only those whose names match
    `pattern`) is one VARIANT, whose elements become rows in order; otherwise each line is a day response.  What isn't JSON (a file cut
    short) and files that hold no array keep their text in `day_text`, with
    `day` NULL; `on_unreadable="fail"` stops the job there instead.  `place`
    says where a day stands: the file's path and the element's position.
    Objects with a key twice are read if the session sets
    `spark.sql.variant.allowDuplicateKeys` (the last one counts), else they
    are unreadable.  A file's array must fit into one VARIANT (128 MB); land
    larger ones as lines.
    """
    if on_unreadable not in ("keep", "fail"):
        raise ValueError(f"on_unreadable is keep or fail, not {on_unreadable!r}")
    paths = [path] if isinstance(path, str) else list(path)
    named = [p for p in paths if FILE_NAMED.search(p)]
    folders = [p for p in paths if p not in named]
    if multiline and named and folders:
        return read_raw_variants(spark, named, True, on_unreadable).unionByName(
            read_raw_variants(spark, folders, True, on_unreadable, pattern))
    reader = (spark.read.schema(VARIANT_SCHEMA).option("singleVariantColumn", "body")
              .option("multiLine", multiline).option("mode", "PERMISSIVE"))
    if multiline and folders:
        reader = reader.option("pathGlobFilter", pattern)
    return variant_days(reader.json(paths), multiline, on_unreadable)


def variant_days(raw: DataFrame, multiline: bool, on_unreadable: str = "keep", with_origin: bool = False) -> DataFrame:
    """The days of `raw` (VARIANT_SCHEMA, read as files or as lines, batch or
    stream); `with_origin` adds `origin`, the file's path, length and time."""
    metric = F.col("metric") if "metric" in raw.columns else F.regexp_extract(F.col("_metadata.file_name"), FILE_METRIC, 1)
    origin = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("length"),
                      F.col("_metadata.file_modification_time").alias("modified"))
    keep = ["origin"] if with_origin else []
    days = raw.select(metric.cast("string").alias("metric"), F.col("_metadata.file_name").alias("source_file"),
                      F.col("_metadata.file_path").alias("file"), "body", F.col("_corrupt_record").alias("cut"),
                      *[origin.alias(n) for n in keep])
    if on_unreadable == "fail":
        days = days.withColumn("cut", F.when(F.col("cut").isNotNull(), F.raise_error(
            F.concat(F.lit("unreadable JSON in "), F.col("file")))).cast("string"))
    if not multiline:
        return days.select("metric", "source_file", F.col("file").alias("place"),
                           F.col("body").alias("day"), F.col("cut").alias("day_text"), *keep)
    # What stays of a file beside its elements is made before they become rows:
    # a row that carried the file's text or array would copy them once per day.
    # "Outer", as Spark evaluates the array of a plain explode in a filter as well.
    elements = F.transform(F.try_variant_get("body", "$", "array<variant>"), lambda day, nth: F.struct(
        nth.alias("nth"), day.alias("day"), F.lit(None).cast("string").alias("day_text")))
    whole = F.array(F.struct(F.lit(None).cast("int").alias("nth"), F.lit(None).cast("variant").alias("day"),
                             F.coalesce("cut", F.to_json("body")).alias("day_text")))
    return (days.select("metric", "source_file", "file", *keep, F.explode_outer(F.coalesce(elements, whole)).alias("x"))
            .filter("x IS NOT NULL")
            .select("metric", "source_file", F.concat_ws("#", "file", F.col("x.nth").cast("string")).alias("place"),
                    "x.day", "x.day_text", *keep))


def spread_days(days: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread parsed day responses over at least `min_partitions` tasks.

    A multiLine JSON array file is parsed by one task, and the flatten runs
    in the task that parsed it.  When there are fewer such tasks than cores
    (a handful of large files), a round-robin repartition of the parsed days
    lets the flatten and everything after it use the whole cluster; the
    parse itself stays one task per file.  Default: the default parallelism.
    """
    try:
        want = min_partitions or days.sparkSession.sparkContext.defaultParallelism
        have = days.rdd.getNumPartitions()
    except PySparkException:      # no RDD view (Spark Connect): leave as is
        return days
    return days if have >= want else days.repartition(want)
