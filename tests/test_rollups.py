"""Rollups of the temperature partials, and readings kept once across runs."""

import datetime as dt
import os
import random

import pytest
from pyspark.errors import StreamingQueryException

from stratus.operators.cleaning import dedup_readings, new_copies
from stratus.plans import curated as C
from stratus.schemas import CLEAN_COLUMNS, CLEAN_SCHEMA
from stratus.streaming import incremental, rollups

TABLES = list(incremental.SUPPORTED)
COLUMNS = {"daily_temp": ["date", "station_name", "avg_temp_c", "max_temp_c"],
           "hottest_stations": ["station_name", "avg_temp_c", "max_temp_c"],
           "rainiest_days": ["date", "total_rainfall_mm"],
           "daily_humidity": ["date", "avg_humidity_pct", "max_humidity_pct"]}


def reading(date, station, value, metric="air_temperature", hour=0):
    at = f"{date}T{hour:02d}:00" if date else f"never {hour}"
    return (metric, dt.date.fromisoformat(date) if date else None, at, station, f"N{station}" if station else None, 0.0, 0.0, value)


def frame(spark, rows):
    return spark.createDataFrame(rows, CLEAN_SCHEMA)


def random_rows(rng, n, years=(2025, 2026)):
    out = []
    for _ in range(n):
        date = None if rng.random() < 0.05 else dt.date(rng.choice(years), rng.choice([1, 12]), rng.choice([1, 28])).isoformat()
        value = rng.choice([None, float("nan"), float("inf"), 1e20, 0.1]) if rng.random() < 0.05 else round(rng.uniform(-20, 40), 2)
        out.append(reading(date, rng.choice(["a", "b", "c", None]), value,
                           rng.choice(["air_temperature", "air_temperature", "rainfall", "relative_humidity"]), rng.randint(0, 23)))
    return out


def text(rows):
    return sorted(repr(tuple(r)) for r in rows)


def lake_state(spark, paths):
    return {t: text(incremental.read_curated(spark, paths[t], COLUMNS[t]).collect()) for t in TABLES}


def batch_state(rows):
    made = {"daily_temp": C.daily_temp(rows), "hottest_stations": C.hottest_stations(rows),
            "rainiest_days": C.rainiest_days(rows), "daily_humidity": C.daily_humidity(rows)}
    return {t: text(df.select(COLUMNS[t]).collect()) for t, df in made.items()}


@pytest.mark.parametrize("dedup", [False, True])
def test_late_and_corrected_deliveries_equal_batch(spark, tmp_dir, dedup):
    rng = random.Random(4)
    root, landing = os.path.join(tmp_dir, "lake"), os.path.join(tmp_dir, "landing")
    first = random_rows(rng, 150)
    deliveries = [first, [r[:7] + (r[7] + rng.choice([-1, 1]) if r[7] is not None else 3.0,) for r in first[:40]],
                  first[20:60], random_rows(rng, 60, (2025,))]
    landed = []
    for rows in deliveries:
        landed += rows
        incremental.land(frame(spark, rows), landing)
        paths = incremental.run_incremental(spark, landing, root, TABLES, files_per_batch=1000, dedup=dedup)
    everything = frame(spark, landed)
    want = dedup_readings(everything) if dedup else everything
    assert text(incremental.read_clean(spark, root, dedup).collect()) == text(want.collect())
    assert lake_state(spark, paths) == batch_state(want)


def test_a_batch_reads_its_months_and_years_only(spark, tmp_dir):
    partials = os.path.join(tmp_dir, "p")
    rows = [reading(f"{y}-{m:02d}-{d:02d}", s, float(d)) for y in (2024, 2025) for m in (1, 3) for d in (1, 9) for s in "ab"]
    rows.append(reading(None, "a", 90.0))
    C.temperature_partials(frame(spark, rows)).write.partitionBy("date").parquet(partials)
    dates = [dt.date(2025, 3, 9), None]
    assert rollups.touched_paths("/p", "date", dates, 7) == ["/p/date=2025-03-*", f"/p/date={rollups.NULL_FOLDER}"]
    assert rollups.touched_paths("/p", "month", dates[:1], 4) == ["/p/month=2025-*"]
    # The first time all of it; then only the month and the year touched.
    years = rollups.refresh(spark, partials, dates)
    assert sorted((str(r.year)[:4], r.station_name, r.n_values) for r in years.collect()) == [
        ("2024", "Na", 4), ("2024", "Nb", 4), ("2025", "Na", 4), ("2025", "Nb", 4), ("None", "Na", 1)]
    month = rollups.path_of(partials, "month")
    age = {d: os.stat(os.path.join(month, d)).st_mtime_ns for d in os.listdir(month) if d.startswith("month=")}
    rollups.refresh(spark, partials, dates)
    changed = {d for d in age if os.stat(os.path.join(month, d)).st_mtime_ns != age[d]}
    assert changed == {"month=2025-03-01", f"month={rollups.NULL_FOLDER}"}
    rollups.drop(spark, partials)
    assert not os.path.exists(month) and os.path.exists(partials)


def test_rollups_when_a_batch_dies(spark, tmp_dir, monkeypatch):
    root, landing = os.path.join(tmp_dir, "lake"), os.path.join(tmp_dir, "landing")
    one = [reading("2026-03-01", "a", 20.0), reading("2026-03-02", "b", 30.0)]
    two = [reading("2026-03-01", "a", 50.0, hour=1), reading("2025-03-02", "b", 10.0)]
    incremental.land(frame(spark, one), landing)
    incremental.run_incremental(spark, landing, root, TABLES, dedup=True)
    incremental.land(frame(spark, two), landing)
    with monkeypatch.context() as m:
        m.setattr(rollups, "refresh", lambda *a: 1 / 0)       # clean rows and partials are written
        with pytest.raises(StreamingQueryException):
            incremental.run_incremental(spark, landing, root, TABLES, dedup=True)
    paths = incremental.run_incremental(spark, landing, root, TABLES, dedup=True)
    assert lake_state(spark, paths) == batch_state(frame(spark, one + two))


def test_new_copies(spark):
    nan = float("nan")
    kept = [reading("2026-03-01", "a", 5.0), reading("2026-03-01", "b", None), reading(None, None, 1.0), reading("2026-03-01", "n", nan)]
    batch = [reading("2026-03-01", "a", 5.0), reading("2026-03-01", "a", 4.0),      # no better
             reading("2026-03-01", "b", 7.0), reading("2026-03-01", "b", 6.0),      # a value wins over NULL, the largest one
             reading(None, None, 1.0), reading("2026-03-01", "n", 9.0),             # NULL keys meet; NaN is the largest
             reading("2026-03-02", "new", None), reading("2026-03-02", "new", None)]
    got = new_copies(frame(spark, batch), frame(spark, kept))
    assert got.columns == CLEAN_COLUMNS
    assert text(got.collect()) == text([reading("2026-03-01", "b", 7.0), reading("2026-03-02", "new", None)])
    assert text(new_copies(frame(spark, batch), frame(spark, [])).collect()) == text(dedup_readings(frame(spark, batch)).collect())
    assert new_copies(frame(spark, []), frame(spark, kept)).collect() == []
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
