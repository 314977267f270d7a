"""Flatten semantics: every edge case of the nested day responses."""

import json
import os

import pytest

from stratus.operators.flatten import flatten_readings, flatten_rejects
from stratus.sources.raw_json import read_raw_days


def write_raw(dir_, metric, days):
    path = os.path.join(dir_, f"{metric}_raw.json")
    with open(path, "w") as f:
        json.dump(days, f)
    return path


def _key(t):
    return tuple((v is not None, v) for v in t)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


STATIONS = [
    {"id": "S1", "name": "A", "location": {"latitude": 1.3, "longitude": 103.8}},
    {"id": "S1", "name": "A2"},
    {"id": "S3", "name": "C"},
]

FIXTURE = [
    {"data": {
        "stations": STATIONS,
        "readings": [
            {"timestamp": "2026-03-01T00:05:00+08:00",
             "data": [{"stationId": "S1", "value": 27.5}, {"stationId": "S2", "value": "28"}]},
            {"timestamp": "2026-03-01T00:10:00+08:00",
             "data": [{"stationId": "S3", "value": 1}, {"stationId": "S1", "value": None},
                      {"stationId": "S3", "value": 2}]},
            {"timestamp": "2026-03-01T00:15:00+08:00", "data": [{"stationId": "S1", "value": 9}]},
        ]}},
    {"data": {"stations": [], "readings": [
        {"timestamp": "2026-03-02T00:05:00+08:00", "data": [{"stationId": "S1", "value": 5}]}]}},
    {"errorMsg": "x"},
]


@pytest.fixture()
def fixture_days(spark, tmp_dir):
    write_raw(tmp_dir, "air_temperature", FIXTURE)
    return read_raw_days(spark, tmp_dir)


def test_fixture_rows(fixture_days):
    out = flatten_readings(fixture_days)
    got = rows(out, "timestamp", "station_id", "station_name", "latitude", "longitude", "value")
    assert got == [
        ("2026-03-01T00:05:00+08:00", "S1", "A2", 0.0, 0.0, 27.5),
        ("2026-03-01T00:05:00+08:00", "S2", "", 0.0, 0.0, 28.0),
        ("2026-03-01T00:10:00+08:00", "S3", "C", 0.0, 0.0, 1.0),
        ("2026-03-02T00:05:00+08:00", "S1", "", 0.0, 0.0, 5.0),
    ]
    metrics = {r["metric"] for r in out.collect()}
    assert metrics == {"air_temperature"}
    dates = sorted({str(r["date"]) for r in out.collect()})
    assert dates == ["2026-03-01", "2026-03-02"]


def test_fixture_rejects(fixture_days):
    rj = flatten_rejects(fixture_days)
    got = rows(rj, "position", "station_id", "raw_value", "reason")
    assert got == sorted([
        (None, None, None, "missing_data"),
        (4, "S1", None, "bad_value"),
        (5, "S3", "2", "after_bad_item"),
        (6, "S1", "9", "after_bad_item"),
    ], key=_key)


def _one_day(spark, tmp_dir, day):
    write_raw(tmp_dir, "rainfall", [day])
    d = read_raw_days(spark, tmp_dir)
    return flatten_readings(d), flatten_rejects(d)


def _reading(ts="2026-03-01T00:05:00+08:00", items=None):
    return {"timestamp": ts, "data": items if items is not None else []}


@pytest.mark.parametrize("day,reason", [
    ({"data": None}, "missing_data"),
    ({"data": {"stations": []}}, "missing_readings"),
    ({"data": {"readings": []}}, "missing_stations"),
    ({"data": {"stations": [{"name": "no id"}], "readings": [
        _reading(items=[{"stationId": "S1", "value": 1}])]}}, "station_without_id"),
])
def test_malformed_day_dropped_whole(spark, tmp_dir, day, reason):
    out, rj = _one_day(spark, tmp_dir, day)
    assert out.count() == 0
    assert rows(rj, "reason", "position") == [(reason, None)]


def test_station_of_another_day_not_visible(spark, tmp_dir):
    days = [
        {"data": {"stations": [{"id": "S1", "name": "A"}], "readings": [
            _reading("2026-03-01T00:05:00+08:00", [{"stationId": "S1", "value": 1}])]}},
        {"data": {"stations": [], "readings": [
            _reading("2026-03-02T00:05:00+08:00", [{"stationId": "S1", "value": 2}])]}},
    ]
    write_raw(tmp_dir, "rainfall", days)
    out = flatten_readings(read_raw_days(spark, tmp_dir))
    assert rows(out, "value", "station_name") == [(1.0, "A"), (2.0, "")]


@pytest.mark.parametrize("text,expected", [
    ("27.5", 27.5), (" 27.5 ", 27.5), ("-3", -3.0), ("1e2", 100.0), ("+.5", 0.5),
    ("1_000", 1000.0), ("inf", float("inf")), ("-Infinity", float("-inf")), ("1e400", float("inf")),
])
def test_numeric_text_parsed(spark, tmp_dir, text, expected):
    out, rj = _one_day(spark, tmp_dir, {"data": {"stations": [], "readings": [
        _reading(items=[{"stationId": "S1", "value": text}])]}})
    assert rows(out, "value") == [(expected,)]
    assert rj.count() == 0


@pytest.mark.parametrize("text", ["27.5d", "abc", "", "1__0", "_1", "infinit"])
def test_bad_text_cuts_the_day(spark, tmp_dir, text):
    items = [{"stationId": "S1", "value": 1}, {"stationId": "S1", "value": text},
             {"stationId": "S1", "value": 3}]
    out, rj = _one_day(spark, tmp_dir, {"data": {"stations": [], "readings": [_reading(items=items)]}})
    assert rows(out, "value") == [(1.0,)]
    assert rows(rj, "position", "reason") == [(2, "bad_value"), (3, "after_bad_item")]


def test_missing_station_id_and_reading_data(spark, tmp_dir):
    day = {"data": {"stations": [], "readings": [
        _reading("2026-03-01T00:05:00+08:00", [{"stationId": "S1", "value": 1}]),
        {"timestamp": "2026-03-01T00:10:00+08:00"},                  # no data
        _reading("2026-03-01T00:15:00+08:00", [{"stationId": "S1", "value": 3}]),
    ]}}
    out, rj = _one_day(spark, tmp_dir, day)
    assert rows(out, "value") == [(1.0,)]
    assert rows(rj, "position", "reason") == [(2, "malformed_reading"), (3, "after_bad_item")]

    day2 = {"data": {"stations": [], "readings": [
        _reading(items=[{"value": 1}, {"stationId": "S2", "value": 2}])]}}
    out2, rj2 = _one_day(spark, tmp_dir, day2)
    assert out2.count() == 0
    assert rows(rj2, "position", "reason") == [(1, "missing_station_id"), (2, "after_bad_item")]


def test_reading_without_timestamp_and_empty_data_is_bad(spark, tmp_dir):
    day = {"data": {"stations": [], "readings": [
        _reading(items=[{"stationId": "S1", "value": 1}]),
        {"data": []},
        _reading(items=[{"stationId": "S1", "value": 2}]),
    ]}}
    out, rj = _one_day(spark, tmp_dir, day)
    assert rows(out, "value") == [(1.0,)]
    assert rows(rj, "reason") == [("after_bad_item",), ("malformed_reading",)]


def test_null_station_attributes_default(spark, tmp_dir):
    day = {"data": {"stations": [{"id": "S1", "name": None, "location": None},
                                 {"id": "S2", "name": "B", "location": {"latitude": None, "longitude": 7}}],
                    "readings": [_reading(items=[{"stationId": "S1", "value": 1},
                                                 {"stationId": "S2", "value": 2}])]}}
    out, _ = _one_day(spark, tmp_dir, day)
    assert rows(out, "station_id", "station_name", "latitude", "longitude") == [
        ("S1", "", 0.0, 0.0), ("S2", "B", 0.0, 7.0)]


def test_empty_metric_gives_empty_typed_table(spark, tmp_dir):
    out, rj = _one_day(spark, tmp_dir, {"data": {"stations": [], "readings": []}})
    assert out.count() == 0 and rj.count() == 0
    assert [f.name for f in out.schema.fields] == [
        "metric", "date", "timestamp", "station_id", "station_name", "latitude", "longitude", "value"]


def test_metric_from_file_name_and_document_order(spark, tmp_dir):
    for m, v in [("air_temperature", 1), ("relative_humidity", 2)]:
        write_raw(tmp_dir, m, [{"data": {"stations": [], "readings": [
            _reading(items=[{"stationId": "S1", "value": v}, {"stationId": "S1", "value": v + 10}])]}}])
    out = flatten_readings(read_raw_days(spark, tmp_dir))
    assert rows(out, "metric", "value") == [
        ("air_temperature", 1.0), ("air_temperature", 11.0),
        ("relative_humidity", 2.0), ("relative_humidity", 12.0)]


def test_ndjson_partitioned_layout(spark, tmp_dir):
    d = os.path.join(tmp_dir, "metric=rainfall")
    os.makedirs(d)
    with open(os.path.join(d, "part-0.json"), "w") as f:
        for i in range(3):
            f.write(json.dumps({"data": {"stations": [], "readings": [
                _reading(f"2026-03-0{i + 1}T00:05:00+08:00", [{"stationId": "S1", "value": i}])]}}) + "\n")
    out = flatten_readings(read_raw_days(spark, tmp_dir, multiline=False))
    assert rows(out, "metric", "value") == [("rainfall", 0.0), ("rainfall", 1.0), ("rainfall", 2.0)]


def test_flatten_has_no_shuffle(fixture_days):
    plan = flatten_readings(fixture_days)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_other_files_in_raw_directory_are_ignored(spark, tmp_dir):
    write_raw(tmp_dir, "rainfall", [{"data": {"stations": [], "readings": [
        _reading(items=[{"stationId": "S1", "value": 1}])]}}])
    with open(os.path.join(tmp_dir, "notes.json"), "w") as f:
        json.dump([{"data": {"stations": [], "readings": [_reading(items=[{"stationId": "X", "value": 9}])]}}], f)
    out = flatten_readings(read_raw_days(spark, tmp_dir))
    assert rows(out, "metric", "station_id") == [("rainfall", "S1")]


def test_day_documents_group_equal_timestamps_into_one_reading(spark, tmp_dir):
    import datetime as dt
    from stratus.sources import events as ev
    ts1 = dt.datetime(2024, 1, 2, 3, 4, 5, 600000)
    ts2 = dt.datetime(2024, 1, 2, 3, 9, 0)
    spark.createDataFrame(
        [(1, ts1, 7, "click", 1.5, "{}"), (2, ts1, 8, "click", 2.5, "{}"),
         (3, ts2, 7, "click", 3.5, "{}"), (4, ts1, 7, "view", 9.0, "{}")],
        ev.TABLE_SCHEMAS["events"]).write.parquet(os.path.join(tmp_dir, "events.parquet"))
    spark.createDataFrame([(7, "Supplier#7", 3, 10.5)], ev.TABLE_SCHEMAS["supplier"]) \
        .write.parquet(os.path.join(tmp_dir, "supplier.parquet"))
    docs = {r["metric"]: r["data"] for r in ev.day_documents(spark, tmp_dir).collect()}
    temp = docs["air_temperature"]
    assert [(r["timestamp"], [(i["stationId"], i["value"]) for i in r["data"]]) for r in temp["readings"]] == [
        ("2024-01-02T03:04:05.600000+08:00", [("7", "1.5"), ("8", "2.5")]),
        ("2024-01-02T03:09:00.000000+08:00", [("7", "3.5")]),
    ]
    assert [s["id"] for s in temp["stations"]] == ["7"]
    flat = flatten_readings(ev.day_documents(spark, tmp_dir))
    assert rows(flat, "metric", "station_id", "station_name", "latitude", "value") == [
        ("air_temperature", "7", "Supplier#7", 10.5, 1.5), ("air_temperature", "7", "Supplier#7", 10.5, 3.5),
        ("air_temperature", "8", "", 0.0, 2.5), ("relative_humidity", "7", "Supplier#7", 10.5, 9.0)]


def test_per_day_arrays_are_not_recomputed_per_item(fixture_days):
    """The day's station arrays are computed once (below the explode) and the
    per-row lookup references them as attributes; the value is parsed once."""
    plan = flatten_readings(fixture_days)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    generate = [l for l in lines if "Generate" in l][0]
    assert "reverse(" not in generate, generate
    lookup = [l for l in lines if "array_position(ids_rev" in l]
    assert lookup and all("reverse(" not in l for l in lookup), plan
    assert plan.count("array_position(ids_rev") == 1, plan
    # the numeric-text check runs once per item and per coordinate of a station
    assert plan.count("RLIKE") == 3, plan


# ------------------------------------------------------------------ strict --

def test_strict_fixture_rows_and_rejects(spark, tmp_dir):
    write_raw(tmp_dir, "air_temperature", FIXTURE)
    raw = read_raw_days(spark, tmp_dir, strict=True)
    got = rows(flatten_readings(raw), "timestamp", "station_id", "station_name", "latitude",
               "longitude", "value")
    assert got == [
        ("2026-03-01T00:05:00+08:00", "S1", "A2", 0.0, 0.0, 27.5),
        ("2026-03-01T00:05:00+08:00", "S2", "", 0.0, 0.0, 28.0),
        ("2026-03-01T00:10:00+08:00", "S3", "C", 0.0, 0.0, 1.0),
        ("2026-03-02T00:05:00+08:00", "S1", "", 0.0, 0.0, 5.0),
    ]
    assert rows(flatten_rejects(raw), "position", "reason") == sorted(
        [(None, "missing_data"), (4, "bad_value"), (5, "after_bad_item"), (6, "after_bad_item")], key=_key)


def test_strict_null_is_not_absent(spark, tmp_dir):
    day = {"data": {
        "stations": [{"id": "N", "name": None},                       # present NULL name
                     {"id": "L", "name": "L", "location": None},       # NULL location
                     {"id": "T", "name": "T", "location": {"latitude": None, "longitude": 1}}],
        "readings": [
            {"timestamp": None, "data": [{"stationId": "N", "value": 1}]},      # NULL ts kept
            {"timestamp": "2026-03-01T00:10:00+08:00",
             "data": [{"stationId": None, "value": 2}, {"stationId": "L", "value": 3},
                      {"stationId": "N", "value": 4}]},
        ]}}
    write_raw(tmp_dir, "rainfall", [day])
    raw = read_raw_days(spark, tmp_dir, strict=True)
    assert rows(flatten_readings(raw), "timestamp", "station_id", "station_name", "value") == sorted([
        (None, "N", None, 1.0),
        ("2026-03-01T00:10:00+08:00", None, "", 2.0),
    ], key=_key)
    assert rows(flatten_rejects(raw), "position", "station_id", "reason") == [
        (3, "L", "bad_station_location"), (4, "N", "after_bad_item")]
    # the default reader treats the same NULLs as absent
    loose = read_raw_days(spark, tmp_dir)
    assert rows(flatten_rejects(loose), "position", "reason") == [
        (1, "malformed_reading"), (2, "missing_station_id"), (3, "after_bad_item"),
        (4, "after_bad_item")]


def test_strict_per_day_arrays_are_not_recomputed_per_item(spark, tmp_dir):
    write_raw(tmp_dir, "air_temperature", FIXTURE)
    raw = read_raw_days(spark, tmp_dir, strict=True)
    plan = flatten_readings(raw)._jdf.queryExecution().optimizedPlan().toString()
    item_lambdas = [l for l in plan.split("\n") if "raw_items" in l and "array_position" in l]
    assert item_lambdas, plan
    for l in item_lambdas:
        assert "reverse(" not in l and "from_json(lambda" not in l, l


def test_spread_days_parallelises_a_single_file(spark, tmp_dir):
    from stratus.sources.raw_json import spread_days
    write_raw(tmp_dir, "rainfall", [{"data": {"stations": [], "readings": [
        _reading(f"2026-03-01T00:{i:02d}:00+08:00", [{"stationId": "S1", "value": i}])]}} for i in range(40)])
    days = read_raw_days(spark, tmp_dir)
    assert days.rdd.getNumPartitions() == 1
    spread = spread_days(days, 4)
    assert spread.rdd.getNumPartitions() == 4
    assert sorted(r["value"] for r in flatten_readings(spread).collect()) == [float(i) for i in range(40)]
    assert spread_days(spread, 2) is spread


def test_strict_null_station_id_matches_null_station(spark, tmp_dir):
    day = {"data": {"stations": [{"id": None, "name": "Z", "location": {"latitude": 1, "longitude": 2}},
                                 {"id": "S1", "name": "A"}],
                    "readings": [_reading(items=[{"stationId": None, "value": 5},
                                                 {"stationId": "S1", "value": 6}])]}}
    write_raw(tmp_dir, "rainfall", [day])
    out = flatten_readings(read_raw_days(spark, tmp_dir, strict=True))
    assert rows(out, "station_id", "station_name", "latitude", "longitude", "value") == sorted([
        (None, "Z", 1.0, 2.0, 5.0), ("S1", "A", 0.0, 0.0, 6.0)], key=_key)


def test_named_and_compressed_files_are_read(spark, tmp_path):
    import gzip
    import json
    text = json.dumps(FIXTURE)
    (tmp_path / "rain.json").write_text(text)
    (tmp_path / "folder").mkdir()
    (tmp_path / "folder" / "rainfall_raw.json").write_text(text)
    (tmp_path / "folder" / "notes.json").write_text(text)
    (tmp_path / "folder" / "wind_speed_raw.json.gz").write_bytes(gzip.compress(text.encode()))

    def counts(path):
        return {r["metric"]: r["count"] for r in read_raw_days(spark, path).groupBy("metric").count().collect()}

    named, folder = str(tmp_path / "rain.json"), str(tmp_path / "folder")
    assert counts(named) == {"rain": 3}
    assert counts(folder) == {"rainfall": 3, "wind_speed": 3}
    assert counts([named, folder]) == {"rain": 3, "rainfall": 3, "wind_speed": 3}
