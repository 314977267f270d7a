"""Reruns, empty metrics, NULL dates, several feeds, and faithful CSV."""

import os

import pytest
from pyspark.sql import functions as F

from stratus.operators.cleaning import null_policy
from stratus.plans.batch import run_batch
from stratus.schemas import CLEAN_SCHEMA
from stratus.sinks import lake
from stratus.sources import events as ev
from stratus.streaming import incremental

from conftest import SF001


def test_null_policy_keeps_nan(spark):
    df = spark.createDataFrame([("t", "s", float("nan")), ("t", "s", None)],
                               "timestamp string, station_id string, value double")
    assert [str(r.value) for r in null_policy(df).collect()] == ["nan"]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_full_rebuild_leaves_nothing_stale(spark, tmp_dir, mode):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        docs = ev.day_documents(spark, SF001)
        days = sorted(str(r[0]) for r in ev.event_readings(spark, SF001).select("date").distinct().collect())
        for some in (docs, docs.where(F.to_json("data").contains(days[0]))):
            raw = lake.publish_raw(some, tmp_dir)
            out = run_batch(spark, raw, tmp_dir, multiline=False)
            left = {str(r[0]) for r in spark.read.parquet(out["daily_temp"]).select("date").distinct().collect()}
        assert left == {days[0]}
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


@pytest.mark.parametrize("metric", ["rainfall", None])
def test_batch_run_without_some_metrics(spark, tmp_dir, metric):
    docs = ev.day_documents(spark, SF001)
    raw = lake.publish_raw(docs.where(F.col("metric") == metric) if metric else
                           ev.day_documents(spark, SF001, bad_value=F.lit(True)), tmp_dir)
    out = run_batch(spark, raw, tmp_dir, multiline=False)
    assert spark.read.schema("station_name string").parquet(out["daily_temp"]).count() == 0
    assert (spark.read.schema("date date").parquet(out["rainiest_days"]).count() > 0) == (metric == "rainfall")


def test_feeds_and_null_dates(spark, tmp_dir):
    r = ev.readings(spark, SF001)
    r = r.withColumn("date", F.when(F.substring("timestamp", 21, 1) != "0", F.col("date")))
    halves = [r.where(F.crc32("timestamp") % 2 == k) for k in (0, 1)]
    for k, half in enumerate(halves):
        incremental.land(half, f"{tmp_dir}/landing{k}")
        paths = incremental.run_incremental(spark, f"{tmp_dir}/landing{k}", tmp_dir, ["rainiest_days"], files_per_batch=2)
    clean = spark.read.schema(CLEAN_SCHEMA).parquet(f"{tmp_dir}/clean/readings")
    assert clean.count() == r.count()
    want = incremental.DATE_KEYED["rainiest_days"](r)
    got = incremental.read_curated(spark, paths["rainiest_days"], want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_csv_round_trip_is_faithful(spark, tmp_dir):
    df = spark.createDataFrame([(" A ", 1), ("a\nb", 2), ('say "x"', 3), ("back\\slash", 4), ("", 5), (None, 6), ("c,d", 7)],
                               "name string, k int")
    path = lake.write_csv(df, os.path.join(tmp_dir, "csv"))
    assert sorted(map(tuple, lake.read_csv(spark, path, df.schema).collect()), key=lambda r: r[1]) == [tuple(r) for r in df.collect()]


def test_partitioned_write_has_a_file_per_date(spark, tmp_dir):
    df = spark.range(6400).select((F.col("id") % 30).alias("date"), "id").repartition(64)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lake.write_parquet(df, tmp_dir + "/t", ["date"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [f for _, _, names in os.walk(tmp_dir + "/t") for f in names if f.endswith(".parquet")]
    assert len(files) == 30


def test_csv_keeps_names_like_the_null_mark(spark, tmp_dir):
    rows = [(n, float(k)) for k, n in enumerate(["\\N", "\\\\N", "\\", "", None, "a\\N", 'q"\\', "\\\n"])]
    df = spark.createDataFrame(rows, "station_name string, `a.b` double")
    path = lake.write_csv(df, os.path.join(tmp_dir, "odd"))
    assert sorted(map(tuple, lake.read_csv(spark, path, df.schema).collect()), key=str) == sorted(rows, key=str)
