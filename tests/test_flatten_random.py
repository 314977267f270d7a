"""Flatten against a brute-force model on randomly generated day responses.

The model walks each day like the original per-day loop (a day is a unit;
inside it, items are taken in order until the first bad one), with this
engine's documented choices for null fields.  Many random days go through
one Spark job per seed.
"""

import json
import os
import random
from collections import Counter

import pytest

from stratus.operators.flatten import flatten_readings, flatten_rejects
from stratus.sources.raw_json import read_raw_days

GOOD_TEXT = ["27.5", " 3 ", "-1.25", "1e1", "+.5", "0", "1_000", "NaN", "-nan", "inf", "1e400"]
BAD_TEXT = ["n/a", "", "1__0", "27.5d", "infinit"]


def number(text):
    """What float() makes of a text; None where it raises."""
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def counted(rows):
    """Rows with their counts; every NaN is the same value."""
    return Counter(tuple("nan" if x != x else x for x in r) for r in rows)


def rand_value(rng):
    p = rng.random()
    if p < 0.55:
        return round(rng.uniform(-5, 40), rng.choice([0, 1, 2]))
    if p < 0.75:
        return rng.choice(GOOD_TEXT)
    if p < 0.85:
        return rng.choice(BAD_TEXT)
    if p < 0.9:
        return None
    if p < 0.93:
        return rng.choice([True, False])
    return rng.randint(0, 30)


def rand_station(rng, ids):
    s = {"id": rng.choice(ids)}
    if rng.random() < 0.8:
        s["name"] = rng.choice(["A", "B", "C", "", None])
    if rng.random() < 0.7:
        loc = {}
        if rng.random() < 0.9:
            loc["latitude"] = rng.choice([1.25, -3.5, None])
        if rng.random() < 0.9:
            loc["longitude"] = rng.choice([103.75, 7.0])
        s["location"] = loc if rng.random() < 0.9 else None
    if rng.random() < 0.03:
        del s["id"]
    return s


def rand_day(rng, d):
    p = rng.random()
    if p < 0.03:
        return {"errorMsg": "x"}
    if p < 0.05:
        return {"data": {"stations": []}}
    if p < 0.07:
        return {"data": {"readings": []}}
    ids = ["S1", "S2", "S3", "S4"]
    stations = [rand_station(rng, ids) for _ in range(rng.randint(0, 5))]
    readings = []
    for k in range(rng.randint(0, 6)):
        r = {"timestamp": f"2026-03-{d:02d}T{k:02d}:05:00+08:00"}
        if rng.random() < 0.05:
            del r["timestamp"]
        if rng.random() < 0.95:
            items = []
            for _ in range(rng.randint(0, 4)):
                it = {"stationId": rng.choice(ids + ["S9"])}
                if rng.random() < 0.04:
                    del it["stationId"]
                it["value"] = rand_value(rng)
                items.append(it)
            r["data"] = items
        readings.append(r)
    return {"data": {"stations": stations, "readings": readings}}


def value_text(v):
    """The text a STRING field of the JSON reader holds for a value."""
    if v is None:
        return None
    if isinstance(v, str):
        return v
    return json.dumps(v)


def model(metric, days):
    rows, rejects = [], []
    for day in days:
        data = day.get("data")
        if data is None:
            rejects.append((None, "missing_data", None))
            continue
        if data.get("readings") is None:
            rejects.append((None, "missing_readings", None))
            continue
        if data.get("stations") is None:
            rejects.append((None, "missing_stations", None))
            continue
        if any(s.get("id") is None for s in data["stations"]):
            rejects.append((None, "station_without_id", None))
            continue
        station = {}
        for s in data["stations"]:
            station[s["id"]] = s                       # last one wins
        items = []
        for r in data["readings"]:
            if r.get("timestamp") is None or r.get("data") is None:
                items.append((None, None, None, "malformed_reading"))
                continue
            for it in r["data"]:
                sid = it.get("stationId")
                text = value_text(it.get("value"))
                if sid is None:
                    reason = "missing_station_id"
                elif number(text) is None:
                    reason = "bad_value"
                else:
                    reason = None
                items.append((r["timestamp"], sid, text, reason))
        cut = next((i for i, x in enumerate(items) if x[3] is not None), len(items))
        for ts, sid, text, _ in items[:cut]:
            s = station.get(sid, {})
            loc = s.get("location") or {}
            rows.append((metric, ts[:10], ts, sid, s.get("name") or "",
                         float(loc.get("latitude") or 0.0), float(loc.get("longitude") or 0.0),
                         float(text)))
        for i, (ts, sid, text, reason) in enumerate(items[cut:]):
            rejects.append((cut + i + 1, reason or "after_bad_item", sid))
    return rows, rejects


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_flatten_matches_brute_force(spark, tmp_dir, seed):
    rng = random.Random(seed)
    days = [rand_day(rng, 1 + i % 28) for i in range(300)]
    with open(os.path.join(tmp_dir, "rainfall_raw.json"), "w") as f:
        json.dump(days, f)
    raw = read_raw_days(spark, tmp_dir)
    got_rows = counted(
        (r["metric"], str(r["date"]), r["timestamp"], r["station_id"], r["station_name"],
         r["latitude"], r["longitude"], r["value"])
        for r in flatten_readings(raw).collect())
    got_rejects = Counter((r["position"], r["reason"], r["station_id"])
                          for r in flatten_rejects(raw).collect())
    want_rows, want_rejects = model("rainfall", days)
    assert got_rows == counted(want_rows)
    assert got_rejects == Counter(want_rejects)
    assert sum(got_rows.values()) > 50 and sum(got_rejects.values()) > 20


def test_split_equals_separate_outputs(spark, tmp_dir):
    from pyspark.sql import functions as F
    from stratus.operators.flatten import annotate_days, readings_of, rejects_of, split_of
    from stratus.schemas import CLEAN_COLUMNS, REJECT_SCHEMA
    rng = random.Random(11)
    days = [rand_day(rng, 1 + i % 28) for i in range(300)]
    with open(os.path.join(tmp_dir, "wind_speed_raw.json"), "w") as f:
        json.dump(days, f)
    a = annotate_days(read_raw_days(spark, tmp_dir))
    s = split_of(a)
    rj_cols = [f.name for f in REJECT_SCHEMA.fields]
    got_r = counted(tuple(x) for x in s.where(F.col("kind") == "readings").select(*CLEAN_COLUMNS).collect())
    got_j = Counter(tuple(x) for x in s.where(F.col("kind") == "rejects").select(*rj_cols).collect())
    assert got_r == counted(tuple(x) for x in readings_of(a).collect())
    assert got_j == Counter(tuple(x) for x in rejects_of(a).select(*rj_cols).collect())
    assert sum(got_r.values()) > 50 and sum(got_j.values()) > 20


# ------------------------------------------------------------------ strict --

def rand_day_strict(rng, d):
    """Like rand_day, plus present-but-null fields, null items and odd locations."""
    day = rand_day(rng, d)
    data = day.get("data")
    if not isinstance(data, dict) or data.get("readings") is None or data.get("stations") is None:
        return day
    for s in data["stations"]:
        p = rng.random()
        if p < 0.03 and "id" in s:
            s["id"] = None                                  # a JSON-null station id
        elif p < 0.1:
            s["name"] = None
        elif p < 0.15:
            s["location"] = None
        elif p < 0.2:
            s["location"] = "somewhere"
        elif p < 0.25 and isinstance(s.get("location"), dict):
            s["location"]["longitude"] = rng.choice([None, "east", "7.5"])
    for r in data["readings"]:
        p = rng.random()
        if p < 0.08 and "timestamp" in r:
            r["timestamp"] = None
        elif p < 0.12:
            r["data"] = None
        for i, it in enumerate(r.get("data") or []):
            q = rng.random()
            if q < 0.05 and "stationId" in it:
                it["stationId"] = None
            elif q < 0.08:
                del it["value"]
            elif q < 0.1:
                r["data"][i] = None
    return day


def model_strict(metric, days):
    """The original per-day loop, key presence and all."""
    rows, rejects = [], []

    def num(v):
        if isinstance(v, bool):                  # float(True) == 1.0
            return float(v)
        return number(value_text(v))

    for day in days:
        data = day.get("data")
        if data is None:
            rejects.append((None, "missing_data", None)); continue
        if data.get("readings") is None:
            rejects.append((None, "missing_readings", None)); continue
        if data.get("stations") is None:
            rejects.append((None, "missing_stations", None)); continue
        if any(s is None or "id" not in s for s in data["stations"]):
            rejects.append((None, "station_without_id", None)); continue
        station = {s["id"]: s for s in data["stations"]}
        items = []                                   # (ts, sid, reason, row)
        for r in data["readings"]:
            if r is None or "timestamp" not in r or not isinstance(r.get("data"), list):
                items.append((None, None, "malformed_reading", None)); continue
            ts = r["timestamp"]
            for it in r["data"]:
                if it is None:
                    items.append((ts, None, "malformed_item", None)); continue
                if "stationId" not in it:
                    items.append((ts, None, "missing_station_id", None)); continue
                sid = it["stationId"]
                if "value" not in it or num(it["value"]) is None:
                    items.append((ts, sid, "bad_value", None)); continue
                s = station.get(sid, {})                    # None finds a null-id station
                name = s.get("name", "")
                reason, lat, lon = None, 0.0, 0.0
                if "location" in s:
                    loc = s["location"]
                    if not isinstance(loc, dict):
                        reason = "bad_station_location"
                    else:
                        if "latitude" in loc:
                            lat = num(loc["latitude"])
                            reason = "bad_station_latitude" if lat is None else None
                        if reason is None and "longitude" in loc:
                            lon = num(loc["longitude"])
                            reason = "bad_station_longitude" if lon is None else None
                row = None if reason else (metric, ts[:10] if ts else None, ts, sid, name,
                                           lat, lon, num(it["value"]))
                items.append((ts, sid, reason, row))
        cut = next((i for i, x in enumerate(items) if x[2] is not None), len(items))
        rows += [x[3] for x in items[:cut]]
        for i, (ts, sid, reason, _) in enumerate(items[cut:]):
            rejects.append((cut + i + 1, reason or "after_bad_item", sid))
    return rows, rejects


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_strict_flatten_matches_original_loop(spark, tmp_dir, seed):
    rng = random.Random(seed)
    days = [rand_day_strict(rng, 1 + i % 28) for i in range(300)]
    with open(os.path.join(tmp_dir, "rainfall_raw.json"), "w") as f:
        json.dump(days, f)
    raw = read_raw_days(spark, tmp_dir, strict=True)
    got_rows = counted(
        (r["metric"], str(r["date"]) if r["date"] else None, r["timestamp"], r["station_id"],
         r["station_name"], r["latitude"], r["longitude"], r["value"])
        for r in flatten_readings(raw).collect())
    got_rejects = Counter((r["position"], r["reason"], r["station_id"])
                          for r in flatten_rejects(raw).collect())
    want_rows, want_rejects = model_strict("rainfall", days)
    assert got_rows == counted(want_rows)
    assert got_rejects == Counter(want_rejects)
    assert any(r[2] is None for r in want_rows) and any(r[4] is None for r in want_rows)


def test_strict_split_equals_separate_outputs(spark, tmp_dir):
    from pyspark.sql import functions as F
    from stratus.operators.flatten import annotate_days, readings_of, rejects_of, split_of
    from stratus.schemas import CLEAN_COLUMNS, REJECT_SCHEMA
    rng = random.Random(13)
    days = [rand_day_strict(rng, 1 + i % 28) for i in range(300)]
    with open(os.path.join(tmp_dir, "wind_speed_raw.json"), "w") as f:
        json.dump(days, f)
    a = annotate_days(read_raw_days(spark, tmp_dir, strict=True))
    s = split_of(a)
    rj_cols = [f.name for f in REJECT_SCHEMA.fields]
    got_r = counted(tuple(x) for x in s.where(F.col("kind") == "readings").select(*CLEAN_COLUMNS).collect())
    got_j = Counter(tuple(x) for x in s.where(F.col("kind") == "rejects").select(*rj_cols).collect())
    assert got_r == counted(tuple(x) for x in readings_of(a).collect())
    assert got_j == Counter(tuple(x) for x in rejects_of(a).select(*rj_cols).collect())
