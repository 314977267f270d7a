"""Small helpers the training-data operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.session import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to a fresh folder under spark.checkpoint.dir and read it back.

    Cuts lineage with files that every executor can read again, so a lost
    executor costs only its own tasks.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """The whole text; NULL counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def id_crc(c: Column) -> Column:
    """crc32 of the id as text (NULL as the empty text)."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def words(text: bytes) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of UTF-8 bytes, A-Z lower-cased.

    bytes.lower() and bytes.split() know ASCII only, which is just this rule.
    """
    return text.lower().split()


_cache = None


def use_cache(cache) -> None:
    """Say that this process is about to use `cache` (it has clear()).  Worker
    processes serve one operator after another; only one's cache is kept."""
    global _cache
    if cache is not _cache:
        if _cache is not None:
            _cache.clear()
        _cache = cache


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]],
                schema: str) -> DataFrame:
    """mapInArrow with a function that yields dicts of columns."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for cols in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, type=f.type)
                 for f, c in ((f, cols[f.name]) for f in arrow)], schema=arrow)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
