"""Incremental runs from raw files: equal to the batch job, whatever arrives how."""

import json
import os
import shutil
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException

from stratus.operators.flatten import flatten_readings, flatten_rejects
from stratus.plans.batch import run_batch
from stratus.schemas import CLEAN_COLUMNS, FLATTENED_SCHEMA, REJECT_SCHEMA
from stratus.sinks import lake, snapshots
from stratus.sources.raw_json import read_raw_variants
from stratus.streaming import raw_ingest

COLUMNS = {"daily_temp": ["date", "station_name", "avg_temp_c", "max_temp_c"],
           "hottest_stations": ["station_name", "avg_temp_c", "max_temp_c"],
           "rainiest_days": ["date", "total_rainfall_mm"],
           "daily_humidity": ["date", "avg_humidity_pct", "max_humidity_pct"]}


def day(date, values, station="S1"):
    return {"data": {"stations": [{"id": station, "name": f"N{station}"}], "readings": [
        {"timestamp": f"{date}T{k:02d}:00:00+08:00" if date else "never", "data": [{"stationId": station, "value": v}]}
        for k, v in enumerate(values)]}}


def land(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, content in files.items():
        os.makedirs(os.path.dirname(os.path.join(folder, name)), exist_ok=True)
        with open(os.path.join(folder, name), "w") as f:
            f.write(content if isinstance(content, str) else json.dumps(content))


FIRST = {"a/air_temperature_raw.json": [day("2026-03-01", [20.5, 21]), day("2026-03-02", ["30", True])],
         "a/rainfall_raw.json": [day("2026-03-01", [1, 2]), 5, day(None, [4])],
         "a/notes.json": "[1"}
SECOND = {"b/air_temperature_raw.json": [day("2026-03-01", [40], "S2"), day("2026-03-03", [10, None, 11])],
          "b/relative_humidity_raw.json": [day("2026-03-02", [50.25, 60])],
          "b/wind_speed_raw.json": '[{"data"'}


def rows(df):
    return Counter(map(tuple, df.collect()))


def state(spark, root, tables=tuple(COLUMNS)):
    base = lake.layer_path(root, lake.CLEAN, "flattened")
    out = {"clean": rows(lake.read_clean(spark, f"{base}/kind=readings")),
           "rejects": rows(lake.read_rejects(spark, f"{base}/kind=rejects").drop("date"))}
    return out | {t: rows(raw_ingest.read_table(spark, root, t, COLUMNS[t])) for t in tables}


def batch_state(spark, landing, root):
    out = run_batch(spark, [os.path.join(landing, d) for d in sorted(os.listdir(landing))], root, exact=True)
    return {"clean": rows(lake.read_clean(spark, out["clean"])), "rejects": rows(lake.read_rejects(spark, out["rejects"]))
            } | {t: rows(spark.read.parquet(out[t]).select(COLUMNS[t])) for t in COLUMNS}


def test_equals_batch_however_the_files_come(spark, tmp_dir):
    landing, root = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "lake")
    land(landing, FIRST)
    raw_ingest.run_raw_incremental(spark, f"{landing}/*", root, files_per_batch=1)
    land(landing, SECOND)
    raw_ingest.run_raw_incremental(spark, f"{landing}/*", root)
    # One folder of it under another spelling, as a feed of its own, and again.
    raw_ingest.run_raw_incremental(spark, f"file://{landing}/a", root)
    raw_ingest.run_raw_incremental(spark, f"{landing}/a/", root)
    want = batch_state(spark, landing, os.path.join(tmp_dir, "batch"))
    assert state(spark, root) == want
    assert sum(want["rejects"].values()) == 4 and want["hottest_stations"]
    # A rebuild of the same lake by the batch job leaves one copy.
    assert batch_state(spark, landing, root) == want


def test_rainfall_only_with_all_tables(spark, tmp_dir):
    landing, root = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "lake")
    land(landing, {"rainfall_raw.json": [day("2026-03-01", [10])]})
    for spelling in (landing, f"file://{landing}", landing + "/"):
        raw_ingest.run_raw_incremental(spark, spelling, root)
    got = raw_ingest.read_table(spark, root, "rainiest_days", COLUMNS["rainiest_days"]).collect()
    assert [r.total_rainfall_mm for r in got] == [10.0]


def test_a_batch_that_dies_is_redone(spark, tmp_dir, monkeypatch):
    landing, root = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "lake")
    land(landing, {k: v for k, v in FIRST.items() if "notes" not in k})
    with monkeypatch.context() as m:
        m.setattr(snapshots, "publish", lambda *a: 1 / 0)
        with pytest.raises(StreamingQueryException):
            raw_ingest.run_raw_incremental(spark, f"{landing}/*", root)
    raw_ingest.run_raw_incremental(spark, f"{landing}/*", root)
    tables = ("daily_temp", "hottest_stations", "rainiest_days")
    want = batch_state(spark, landing, os.path.join(tmp_dir, "batch"))
    assert state(spark, root, tables) == {k: v for k, v in want.items() if k != "daily_humidity"}


def test_lines_under_metric_folders(spark, tmp_dir):
    landing, root = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "lake")
    land(landing, {"metric=rainfall/x.json": "\n".join(json.dumps(d) for d in [day("2026-03-01", [1, 2]), 7, day("2026-03-01", [4])]),
                   "metric=air_temperature/x.json": json.dumps(day("2026-03-01", [9]))})
    raw_ingest.run_raw_incremental(spark, landing, root, multiline=False)
    days = read_raw_variants(spark, landing, multiline=False)
    got = state(spark, root, ("rainiest_days", "daily_temp", "hottest_stations"))
    assert got["clean"] == rows(flatten_readings(days).select(CLEAN_COLUMNS))
    assert got["rejects"] == rows(flatten_rejects(days).select(REJECT_SCHEMA.names))


def test_publish_that_dies_leaves_the_former_version(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    for k in range(4):
        snapshots.publish(spark.range(k, k + 1), path)
        assert [r.id for r in spark.read.parquet(snapshots.current(spark, path)).collect()] == [k]
    bad = spark.range(3).selectExpr("raise_error('dies') AS id")
    with pytest.raises(Exception, match="dies"):
        snapshots.publish(bad, path)
    assert [r.id for r in spark.read.parquet(snapshots.current(spark, path)).collect()] == [3]
    assert len([d for d in os.listdir(path) if d.startswith("v-")]) <= snapshots.KEPT_VERSIONS + 1
    assert snapshots.current(spark, tmp_dir) == tmp_dir


def files_of(base):
    return [os.path.join(d, f) for d, _, fs in os.walk(base) for f in fs if f.endswith(".parquet")]


def test_compaction(spark, tmp_dir, monkeypatch):
    landing, root = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "lake")
    base = lake.layer_path(root, lake.CLEAN, "flattened")
    for k in range(5):
        land(landing, {f"{k}/rainfall_raw.json": [day("2026-03-01", [k]), day("2026-03-02" if k % 2 else None, [k]), 5]})
        raw_ingest.run_raw_incremental(spark, f"{landing}/{k}", root, tables=("rainiest_days",))
    want = state(spark, root, ("rainiest_days",))
    before = len(files_of(base))
    # A compaction that dies before the pointer changes hides what it wrote.
    with monkeypatch.context() as m:
        real, calls = snapshots.write_pointer, []
        m.setattr(snapshots, "write_pointer", lambda *a: calls.append(1) or (real(*a) if len(calls) == 1 else 1 / 0))
        with pytest.raises(ZeroDivisionError):
            snapshots.compact(spark, base, FLATTENED_SCHEMA, 3)
    assert state(spark, root, ("rainiest_days",)) == want
    assert snapshots.compact(spark, base, FLATTENED_SCHEMA, 3) == 3
    assert state(spark, root, ("rainiest_days",)) == want
    # Later batches of the same dates count beside it, and a second run deletes
    # what the first replaced.
    land(landing, {"9/rainfall_raw.json": [day("2026-03-01", [100])]})
    raw_ingest.run_raw_incremental(spark, f"{landing}/9", root, tables=("rainiest_days",))
    got = state(spark, root, ("rainiest_days",))
    assert got["clean"] - want["clean"] == Counter({r: 1 for r in got["clean"] if r[-1] == 100.0})
    assert snapshots.compact(spark, base, FLATTENED_SCHEMA, 3) == 0
    assert state(spark, root, ("rainiest_days",)) == got
    assert len(files_of(base)) < before
    assert snapshots.compact(spark, base, FLATTENED_SCHEMA, 1) > 0
    assert state(spark, root, ("rainiest_days",)) == got
    shutil.rmtree(landing)
