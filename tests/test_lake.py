"""Sinks: parquet / csv round trips, lake layers, manifest."""

import math
import os

from pyspark.sql import functions as F

from stratus.plans import curated as C
from stratus.sinks import lake
from stratus.sources import events as ev
from stratus.sources.raw_json import read_raw_days

from conftest import SF001


def test_csv_roundtrip_keeps_empty_null_nan(spark, tmp_dir):
    df = spark.createDataFrame(
        [("", 1.0), (None, float("nan")), ("a,b", None), ('q"x', 12345678.0)],
        "station_name string, v double")
    out = lake.write_csv(df, os.path.join(tmp_dir, "t"), single_file=True)
    back = lake.read_csv(spark, out, df.schema).collect()
    got = sorted(((r[0], r[1]) for r in back), key=str)
    assert ("", 1.0) in got and ("a,b", None) in got and ('q"x', 12345678.0) in got
    nan_row = [r for r in got if r[0] is None]
    assert len(nan_row) == 1 and math.isnan(nan_row[0][1])


def test_parquet_roundtrip_partitioned_restores_column_order(spark, tmp_dir):
    df = C.daily_temp(ev.readings(spark, SF001, metrics=["air_temperature"]), ordered=False)
    out = lake.write_parquet(df, os.path.join(tmp_dir, "daily_temp"), ["date"])
    back = lake.read_parquet(spark, out, columns=df.columns)
    assert back.columns == df.columns
    assert sorted(back.collect()) == sorted(df.collect())


def test_lake_layers_end_to_end(spark, tmp_dir):
    root = tmp_dir
    lake.publish_raw(ev.day_documents(spark, SF001), root)
    assert os.path.isdir(os.path.join(root, "raw", "weather", "metric=rainfall"))
    raw = read_raw_days(spark, lake.layer_path(root, lake.RAW), multiline=False)
    clean_path, rejects_path = lake.ingest_clean(spark, raw, root)
    clean = lake.read_clean(spark, clean_path)
    direct = ev.readings(spark, SF001)
    assert clean.exceptAll(direct).count() == 0 and direct.exceptAll(clean).count() == 0
    assert lake.read_rejects(spark, rejects_path).count() == 0
    for name, fn in C.CURATED.items():
        pq, csv = lake.publish_curated(fn(clean), root, name)
        a = sorted(spark.read.parquet(pq).collect())
        b = sorted(lake.read_csv(spark, csv, fn(clean).schema).collect())
        assert a == b == sorted(fn(direct).collect()), name


def test_manifest_sizes(spark, tmp_dir):
    sizes = {"daily_humidity.csv": 199, "daily_temp.csv": 4197,
             "hottest_stations.csv": 336, "rainiest_days.csv": 136}
    d = os.path.join(tmp_dir, "curated_data")
    os.makedirs(d)
    for name, n in sizes.items():
        with open(os.path.join(d, name), "wb") as f:
            f.write(b"x" * n)
    got = {r["path"]: (r["length"], r["size_kb"]) for r in lake.file_manifest(spark, d).collect()}
    assert got == {
        "daily_humidity.csv": (199, 0.19),
        "daily_temp.csv": (4197, 4.1),
        "hottest_stations.csv": (336, 0.33),
        "rainiest_days.csv": (136, 0.13),
    }


def test_manifest_paths_are_relative_to_the_root_even_with_a_same_named_ancestor(spark, tmp_dir):
    d = os.path.join(tmp_dir, "lake", "x", "lake")
    os.makedirs(os.path.join(d, "curated", "weather"))
    with open(os.path.join(d, "curated", "weather", "t.csv"), "wb") as f:
        f.write(b"z" * 3)
    for root in (d, "file:" + d, d + "/"):
        got = [(r["path"], r["length"]) for r in lake.file_manifest(spark, root).collect()]
        assert got == [("curated/weather/t.csv", 3)], (root, got)


def test_manifest_does_not_read_content(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "f.bin"), "wb") as f:
        f.write(b"y" * 10)
    plan = lake.file_manifest(spark, tmp_dir)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[-1]


def test_batch_run_from_multiline_files(spark, tmp_dir):
    import json
    from stratus.plans.batch import run_batch
    raw = os.path.join(tmp_dir, "raw_data")
    os.makedirs(raw)
    days = [{"data": {"stations": [{"id": "S1", "name": "A"}], "readings": [
        {"timestamp": f"2026-03-0{d}T00:0{i}:00+08:00",
         "data": [{"stationId": "S1", "value": 20 + d + i}, {"stationId": "S2", "value": 1}]}
        for i in range(3)]}} for d in (1, 2)]
    for m in ["air_temperature", "relative_humidity", "rainfall", "wind_speed", "wind_direction"]:
        with open(os.path.join(raw, f"{m}_raw.json"), "w") as f:
            json.dump(days, f)
    out = run_batch(spark, raw, os.path.join(tmp_dir, "lake"))
    clean = lake.read_clean(spark, out["clean"])
    assert clean.count() == 5 * 2 * 3 * 2
    temp = sorted(tuple(r) for r in spark.read.parquet(out["daily_temp"]).select(
        "date", "station_name", "avg_temp_c", "max_temp_c").collect())
    import datetime as dt
    assert temp == [(dt.date(2026, 3, 1), "", 1.0, 1.0), (dt.date(2026, 3, 1), "A", 22.0, 23.0),
                    (dt.date(2026, 3, 2), "", 1.0, 1.0), (dt.date(2026, 3, 2), "A", 23.0, 24.0)]
    q = {r["metric"]: r["n_rows"] for r in spark.read.parquet(out["quality_report"]).collect()}
    assert q == {m: 12 for m in ["air_temperature", "relative_humidity", "rainfall",
                                  "wind_speed", "wind_direction"]}
    assert spark.read.parquet(out["rejects_report"]).count() == 0
    csv_rows = lake.read_csv(spark, out["rainiest_days_csv"], spark.read.parquet(out["rainiest_days"]).schema).collect()
    assert [(str(r["date"]), r["total_rainfall_mm"]) for r in csv_rows] == [("2026-03-02", 72.0), ("2026-03-01", 69.0)]


def test_output_listing_top_level_dirs_as_zero(spark, tmp_dir):
    d = os.path.join(tmp_dir, "curated_data")
    os.makedirs(os.path.join(d, "daily_temp"))
    with open(os.path.join(d, "daily_temp", "part-0.parquet"), "wb") as f:
        f.write(b"p" * 50)
    with open(os.path.join(d, "daily_temp.csv"), "wb") as f:
        f.write(b"x" * 4197)
    got = {r["name"]: r["length"] for r in lake.file_listing(spark, d).collect()}
    assert got == {"daily_temp": 0, "daily_temp.csv": 4197}
