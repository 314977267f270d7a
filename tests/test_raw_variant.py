"""Raw days of any JSON type against a plain loop over dictionaries."""

import gzip
import json
import os
import random
import re
from collections import Counter

import pytest

from stratus.operators.flatten import annotate_days, flatten_readings, flatten_rejects, split_of
from stratus.sources.raw_json import read_raw_variants


def loop(days):
    """The original's semantics: a try around each day, rows kept up to an error."""
    rows = []
    for day in days if isinstance(days, list) else []:
        try:
            readings = day["data"]["readings"]
            stations = {s["id"]: s for s in day["data"]["stations"]}
            for reading in readings:
                ts = reading["timestamp"]
                for item in reading["data"]:
                    sid, value = item["stationId"], float(item["value"])
                    st = stations.get(sid, {})
                    rows.append((ts, sid, st.get("name", ""), float(st.get("location", {}).get("latitude", 0)),
                                 float(st.get("location", {}).get("longitude", 0)), value))
        except (TypeError, KeyError, AttributeError, ValueError):
            pass
    return rows


def shown(x):
    """A JSON scalar as the clean layer's text."""
    return None if x is None else x if isinstance(x, str) else json.dumps(x)


def key(row):
    ts, sid, name, lat, lon, value = row
    return (shown(ts), shown(sid), shown(name), *("nan" if v != v else v for v in (lat, lon, value)))


def got_of(df):
    cols = ["timestamp", "station_id", "station_name", "latitude", "longitude", "value"]
    return Counter(tuple("nan" if v != v else v for v in r) for r in df.select(cols).collect())


def junk(rng):
    return rng.choice([5, 1.5, "x", "", None, True, [], {}, [1], {"a": 1}, ["x"], 108])


def maybe(rng, p, good):
    return junk(rng) if rng.random() < p else good()


IDS = ["S1", "S2", "108", 108, 7, None, True]


def station(rng):
    s = {"id": rng.choice(IDS)}
    if rng.random() < .7:
        s["name"] = rng.choice(["A", "B", "", None, 3])
    if rng.random() < .7:
        s["location"] = maybe(rng, .04, lambda: {k: maybe(rng, .05, lambda: rng.choice([1.25, "1.35", -3, "n/a", " 7 ", False, 0]))
                                                 for k in ("latitude", "longitude") if rng.random() < .8})
    if rng.random() < .01:
        del s["id"]
    return s


def item(rng):
    i = {"stationId": rng.choice(IDS + ["S9"]), "value": rng.choice([1.5, 3, "27.5", " 2 ", "1_0", True, "inf", -4.25])}
    if rng.random() < .02:
        del i[rng.choice(sorted(i))]
    elif rng.random() < .03:
        i[rng.choice(sorted(i))] = junk(rng)
    return i


def reading(rng, k):
    r = {"timestamp": rng.choice([f"2026-03-01T{k:02d}:05:00+08:00", None, 17]), "data": maybe(
        rng, .03, lambda: [maybe(rng, .02, lambda: item(rng)) for _ in range(rng.randint(0, 4))])}
    if rng.random() < .02:
        del r[rng.choice(sorted(r))]
    return r


def day(rng):
    d = {"stations": maybe(rng, .03, lambda: [maybe(rng, .005, lambda: station(rng)) for _ in range(rng.randint(0, 6))]),
         "readings": maybe(rng, .03, lambda: [maybe(rng, .02, lambda: reading(rng, k)) for k in range(rng.randint(0, 8))])}
    if rng.random() < .03:
        del d[rng.choice(sorted(d))]
    return maybe(rng, .03, lambda: {"data": maybe(rng, .03, lambda: d)})


def write(folder, name, text, zipped=False):
    path = os.path.join(folder, name + (".gz" if zipped else ""))
    with (gzip.open(path, "wt") if zipped else open(path, "w")) as f:
        f.write(text)
    return path


@pytest.mark.parametrize("seed", [1, 2])
def test_like_the_loop(spark, tmp_dir, seed):
    rng = random.Random(seed)
    files = [[day(rng) for _ in range(60)] for _ in range(3)] + [[], {"data": 1}, 5]
    for k, days in enumerate(files):
        write(tmp_dir, f"m{k}_raw.json", json.dumps(days), zipped=k % 2 == 1)
    want = Counter(key(r) for days in files for r in loop(days))
    assert sum(want.values()) > 300
    days = read_raw_variants(spark, tmp_dir)
    assert got_of(flatten_readings(days)) == want
    # One explode for both kinds gives the same rows and the same rejects.
    both = split_of(annotate_days(days))
    assert got_of(both.filter("kind = 'readings'")) == want
    cols = ["metric", "source_file", "day_id", "position", "reason", "raw_value"]
    assert (Counter(map(tuple, both.filter("kind = 'rejects'").select(cols).collect()))
            == Counter(map(tuple, flatten_rejects(days).select(cols).collect())))
    # The same days as lines.
    lines = os.path.join(tmp_dir, "lines", "metric=m")
    os.makedirs(lines)
    write(lines, "part.json", "\n".join(json.dumps(d) for days in files[:3] for d in days))
    ndjson = read_raw_variants(spark, os.path.dirname(lines), multiline=False)
    assert got_of(flatten_readings(ndjson)) == Counter(key(r) for days in files[:3] for r in loop(days))
    assert {r.metric for r in flatten_readings(ndjson).select("metric").distinct().collect()} == {"m"}


GOOD = {"data": {"stations": [{"id": "S1", "location": {"latitude": "1.35"}}],
                 "readings": [{"timestamp": "2026-03-01T00:05:00+08:00", "data": [{"stationId": "S1", "value": 2.5}]}]}}


def test_a_wrong_element_costs_itself(spark, tmp_dir):
    write(tmp_dir, "rainfall_raw.json", json.dumps([GOOD, 5, GOOD]))
    days = read_raw_variants(spark, tmp_dir)
    got = flatten_readings(days).collect()
    assert [(r.metric, r.value, r.latitude) for r in got] == [("rainfall", 2.5, 1.35)] * 2
    bad = flatten_rejects(days).collect()
    assert [(r.reason, r.raw_value) for r in bad] == [("missing_data", "5")]


def test_cut_files_keep_their_text(spark, tmp_dir):
    text = json.dumps([GOOD, GOOD])[:-30]
    write(tmp_dir, "rainfall_raw.json", text)
    write(tmp_dir, "wind_speed_raw.json", json.dumps([GOOD, {"a": 1}, {"a": 1}]))
    days = read_raw_variants(spark, tmp_dir)
    bad = {(r.metric, r.reason, r.raw_value): r.day_id for r in flatten_rejects(days).collect()}
    assert ("rainfall", "unreadable_json", text) in bad
    assert flatten_readings(days).count() == 1
    # Equal bad days are two days: their place tells them apart.
    assert len({r.day_id for r in flatten_rejects(days).filter("metric = 'wind_speed'").collect()}) == 2
    with pytest.raises(Exception, match="unreadable JSON in .*rainfall_raw.json"):
        flatten_readings(read_raw_variants(spark, tmp_dir, on_unreadable="fail")).collect()
    with pytest.raises(ValueError):
        read_raw_variants(spark, tmp_dir, on_unreadable="drop")


def test_named_files_and_narrow_plan(spark, tmp_dir):
    path = write(tmp_dir, "humidity.json", json.dumps([GOOD]))
    days = read_raw_variants(spark, [path])
    assert [r.metric for r in flatten_readings(days).collect()] == ["humidity"]
    plan = flatten_readings(days)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_text_coordinates_without_variant(spark, tmp_dir):
    from stratus.sources.raw_json import read_raw_days
    day = json.loads(json.dumps(GOOD))
    day["data"]["stations"][0]["location"]["longitude"] = 103.5
    write(tmp_dir, "rainfall_raw.json", json.dumps([day]))
    for strict in (False, True):
        got = flatten_readings(read_raw_days(spark, tmp_dir, strict=strict)).collect()
        assert [(r.latitude, r.longitude) for r in got] == [(1.35, 103.5)]


def test_batch_run_of_any_type(spark, tmp_dir):
    from stratus.plans.batch import run_batch
    write(tmp_dir, "rainfall_raw.json", json.dumps([GOOD, 5, GOOD]))
    write(tmp_dir, "wind_speed_raw.json", json.dumps([GOOD])[:-5])
    out = run_batch(spark, tmp_dir, os.path.join(tmp_dir, "lake"), exact=True)
    assert [r.total_rainfall_mm for r in spark.read.parquet(out["rainiest_days"]).collect()] == [5.0]
    reasons = {(r.metric, r.reason, r.n_days) for r in spark.read.parquet(out["rejects_report"]).collect()}
    assert reasons == {("rainfall", "missing_data", 1), ("wind_speed", "unreadable_json", 1)}


def variant_plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_days_are_not_rejected_by_a_filter_below(spark, tmp_dir):
    # Pushed below the projections it would build a day's stations once per item.
    write(tmp_dir, "rainfall_raw.json", json.dumps([GOOD]))
    plan = variant_plan(flatten_rejects(read_raw_variants(spark, tmp_dir)))
    assert not [line for line in plan.splitlines() if "Filter" in line and "transform(" in line], plan


def test_days_do_not_carry_their_file(spark, tmp_dir):
    # The file's text and array beside every day would be copied once per day.
    write(tmp_dir, "rainfall_raw.json", json.dumps([GOOD]))
    plan = variant_plan(read_raw_variants(spark, tmp_dir))
    generate = [line for line in plan.splitlines() if "Generate" in line]
    assert len(generate) == 1
    assert re.search(r"\), \[3, 4\], true, ", generate[0]), plan      # body and cut end here


def test_place_of_days_and_of_whole_files(spark, tmp_dir):
    write(tmp_dir, "rainfall_raw.json", json.dumps([1, None, {"data": 2}]))
    for name, text in (("wind_speed", "[1,"), ("air_temperature", "{}"), ("relative_humidity", "[]"), ("wind_direction", "null")):
        write(tmp_dir, f"{name}_raw.json", text)
    got = Counter((r.metric, r.place.rsplit("/", 1)[-1], r.day, r.day_text) for r in read_raw_variants(spark, tmp_dir).selectExpr(
        "metric", "place", "to_json(day) AS day", "day_text").collect())
    assert got == Counter([
        ("rainfall", "rainfall_raw.json#0", "1", None), ("rainfall", "rainfall_raw.json#1", "null", None),
        ("rainfall", "rainfall_raw.json#2", '{"data":2}', None), ("wind_speed", "wind_speed_raw.json", None, "[1,"),
        ("air_temperature", "air_temperature_raw.json", None, "{}"), ("wind_direction", "wind_direction_raw.json", None, "null")])
