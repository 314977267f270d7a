"""Incremental ingest: stream result equals batch, retries and late files."""

import datetime as dt
import os

from pyspark.sql import functions as F

from stratus.plans import curated as C
from stratus.sources import events as ev
from stratus.streaming import incremental

from conftest import SF001


def _curated(spark, path, cols):
    return sorted(tuple(r) for r in incremental.read_curated(spark, path, cols).collect())


def test_stream_equals_batch_with_late_files_and_rerun(spark, tmp_dir):
    r = ev.readings(spark, SF001, metrics=["relative_humidity", "air_temperature"])
    landing = os.path.join(tmp_dir, "landing")
    root = os.path.join(tmp_dir, "lake")
    # first delivery: days up to the 20th; late delivery: everything else,
    # including more readings for days already processed
    first = r.where(F.dayofmonth("date") <= 20)
    rest = r.where(F.dayofmonth("date") > 20).unionByName(r.where(F.dayofmonth("date") == 5))
    everything = first.unionByName(rest)

    incremental.land(first, landing)
    tables = ["daily_humidity", "daily_temp", "hottest_stations", "rainiest_days"]
    paths = incremental.run_incremental(spark, landing, root, tables, files_per_batch=4)
    hum = ["date", "avg_humidity_pct", "max_humidity_pct"]
    assert _curated(spark, paths["daily_humidity"], hum) == sorted(
        tuple(x) for x in C.daily_humidity(first).collect())

    incremental.land(rest, landing)
    paths = incremental.run_incremental(spark, landing, root, tables, files_per_batch=4)
    assert _curated(spark, paths["daily_humidity"], hum) == sorted(
        tuple(x) for x in C.daily_humidity(everything).collect())
    tmp = ["date", "station_name", "avg_temp_c", "max_temp_c"]
    assert _curated(spark, paths["daily_temp"], tmp) == sorted(
        tuple(x) for x in C.daily_temp(everything).collect())
    hot = ["station_name", "avg_temp_c", "max_temp_c"]
    assert _curated(spark, paths["hottest_stations"], hot) == sorted(
        tuple(x) for x in C.hottest_stations(everything).collect())

    # nothing keeps running after an availableNow run
    assert spark.streams.active == []

    # a re-run with nothing new changes nothing
    paths = incremental.run_incremental(spark, landing, root, tables)
    assert _curated(spark, paths["daily_humidity"], hum) == sorted(
        tuple(x) for x in C.daily_humidity(everything).collect())


def test_retried_batch_does_not_append_twice(spark, tmp_dir):
    r = ev.readings(spark, SF001, metrics=["relative_humidity"])
    clean = os.path.join(tmp_dir, "clean")
    curated = {"daily_humidity": os.path.join(tmp_dir, "daily_humidity")}
    handle = incremental.make_batch_handler(spark, clean, curated, os.path.join(tmp_dir, "partials"))
    handle(r, 0)
    handle(r, 0)          # the same micro-batch delivered again
    assert spark.read.parquet(clean).count() == r.count()
    got = _curated(spark, curated["daily_humidity"], ["date", "avg_humidity_pct", "max_humidity_pct"])
    assert got == sorted(tuple(x) for x in C.daily_humidity(r).collect())


def test_recompute_prunes_to_touched_dates(spark, tmp_dir):
    r = ev.readings(spark, SF001, metrics=["relative_humidity"])
    clean = os.path.join(tmp_dir, "clean")
    r.withColumn("batch_id", F.lit("feed-0")).write.partitionBy("date", "batch_id").parquet(clean)
    batch = spark.createDataFrame(r.where(F.dayofmonth("date") == 3).collect(), r.schema).persist()
    pick = incremental.touched_filter(batch)
    whole = pick(spark.read.parquet(clean))
    plan = whole._jdf.queryExecution().executedPlan().toString()
    scan = [l for l in plan.split("\n") if "FileScan" in l][0]
    part_filters = scan.split("PartitionFilters:")[1].split("]")[0]
    assert "2024-01-03" in part_filters, scan
    assert {x[0].day for x in whole.select("date").distinct().collect()} == {3}
    # NULL dates are kept when the batch has them
    nb = spark.createDataFrame([(None,)], "date date")
    got = incremental.touched_filter(nb)(spark.createDataFrame([(None,), (dt.date(2024, 1, 1),)], "date date"))
    assert [x[0] for x in got.collect()] == [None]


def test_crash_mid_batch_then_restart_equals_batch(spark, tmp_dir):
    """A run dies inside a micro-batch after the clean layer was written; the
    restarted stream replays that batch from its checkpoint, the idempotent
    writes absorb the replay, and the result equals the batch run."""
    from pyspark.errors import StreamingQueryException
    from stratus.schemas import CLEAN_SCHEMA
    r = ev.readings(spark, SF001, metrics=["relative_humidity"])
    landing = os.path.join(tmp_dir, "landing")
    incremental.land(r, landing)
    clean = os.path.join(tmp_dir, "clean")
    curated = {"daily_humidity": os.path.join(tmp_dir, "daily_humidity")}
    partials = os.path.join(tmp_dir, "partials")
    ckpt = os.path.join(tmp_dir, "_checkpoint")

    def run(handler):
        q = (spark.readStream.schema(CLEAN_SCHEMA).option("maxFilesPerTrigger", 10)
             .parquet(landing).writeStream.foreachBatch(handler)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        try:
            q.awaitTermination()
        except StreamingQueryException as e:
            return e
        return None

    good = incremental.make_batch_handler(spark, clean, curated, partials)

    def crashing(batch, batch_id):
        if batch_id == 1:
            batch.withColumn("batch_id", F.lit(f"feed-{batch_id}")).write.mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").partitionBy("date", "batch_id").parquet(clean)
            raise RuntimeError("executor lost")
        good(batch, batch_id)

    assert run(crashing) is not None
    assert run(good) is None
    assert spark.read.parquet(clean).count() == r.count()
    got = _curated(spark, curated["daily_humidity"], ["date", "avg_humidity_pct", "max_humidity_pct"])
    assert got == sorted(tuple(x) for x in C.daily_humidity(r).collect())
