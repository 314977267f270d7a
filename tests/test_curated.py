"""Curated tables: semantics, traps (rounding, text dates, ties, NaN) and plan shape."""

import datetime as dt

from pyspark.sql import functions as F

from stratus.functions.columns import exact_avg, exact_sum, text_date
from stratus.plans import curated as C
from stratus.plans import sql as S
from stratus.schemas import CLEAN_SCHEMA
from stratus.sources import events as ev

from conftest import SF001, SF01


def readings(spark, rows):
    """rows: (metric, timestamp, station_id, station_name, value)."""
    data = [(m, None, ts, sid, name, 0.0, 0.0, v) for m, ts, sid, name, v in rows]
    df = spark.createDataFrame(data, CLEAN_SCHEMA)
    return df.withColumn("date", text_date("timestamp"))


def test_text_date_ignores_offset_in_any_session_zone(spark):
    df = spark.createDataFrame([("2026-03-01T00:05:00+08:00",), ("garbage",)], "ts string")
    for tz in ["UTC", "Asia/Singapore", "America/Los_Angeles"]:
        spark.conf.set("spark.sql.session.timeZone", tz)
        got = [r[0] for r in df.select(text_date("ts")).collect()]
        assert got == [dt.date(2026, 3, 1), None]
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_exact_average_half_up(spark):
    # 1.005 and 2.675 are below the half-way point as doubles; the exact
    # decimal mean is not, so HALF_UP rounds up.
    df = spark.createDataFrame([("a", 1.005), ("b", 2.675), ("c", 0.1), ("c", 0.2), ("d", -1.005)],
                               "k string, v double")
    got = dict(df.groupBy("k").agg(exact_avg("v").alias("a")).collect())
    assert got == {"a": 1.01, "b": 2.68, "c": 0.15, "d": -1.01}


def test_exact_average_independent_of_partitioning(spark):
    r = ev.readings(spark, SF01, metrics=["air_temperature"])
    base = sorted(C.hottest_stations(r, k=1000).collect())
    for n in [1, 4, 64]:
        assert sorted(C.hottest_stations(r.repartition(n), k=1000).collect()) == base
    shuffled = r.orderBy(F.rand(7))
    assert sorted(C.hottest_stations(shuffled, k=1000).collect()) == base


def test_daily_temp_and_ties(spark):
    r = readings(spark, [
        ("air_temperature", "2026-03-01T00:05:00+08:00", "S1", "B", 28.0),
        ("air_temperature", "2026-03-01T00:10:00+08:00", "S1", "B", 30.0),
        ("air_temperature", "2026-03-01T00:05:00+08:00", "S2", "A", 29.0),
        ("air_temperature", "2026-03-02T06:00:00+08:00", "S2", "A", 31.0),
        ("relative_humidity", "2026-03-01T00:05:00+08:00", "S2", "A", 99.0),
    ])
    got = [tuple(x) for x in C.daily_temp(r).collect()]
    # equal averages on 2026-03-01: the station name breaks the tie
    assert got == [
        (dt.date(2026, 3, 1), "A", 29.0, 29.0),
        (dt.date(2026, 3, 1), "B", 29.0, 30.0),
        (dt.date(2026, 3, 2), "A", 31.0, 31.0),
    ]
    top = [tuple(x) for x in C.hottest_stations(r, k=1).collect()]
    assert top == [("A", 30.0, 31.0)]


def test_rainfall_sums_all_readings_and_ranks(spark):
    r = readings(spark, [
        ("rainfall", "2026-03-01T00:05:00+08:00", "S1", "A", 0.2),
        ("rainfall", "2026-03-01T00:10:00+08:00", "S2", "", 0.4),
        ("rainfall", "2026-03-02T00:05:00+08:00", "S1", "A", 0.6),
        ("rainfall", "2026-03-03T00:05:00+08:00", "S1", "A", 1.0),
    ])
    assert [tuple(x) for x in C.rainiest_days(r).collect()] == [
        (dt.date(2026, 3, 3), 1.0), (dt.date(2026, 3, 1), 0.6), (dt.date(2026, 3, 2), 0.6)]
    ranked = {x["date"]: x["rain_rank"] for x in C.rainiest_ranked(r).collect()}
    assert ranked == {dt.date(2026, 3, 3): 1, dt.date(2026, 3, 1): 2, dt.date(2026, 3, 2): 2}


def test_unknown_stations_merge_into_empty_name_group(spark):
    r = readings(spark, [
        ("air_temperature", "2026-03-01T00:05:00+08:00", "X1", "", 40.0),
        ("air_temperature", "2026-03-01T00:05:00+08:00", "X2", "", 20.0),
        ("air_temperature", "2026-03-01T00:05:00+08:00", "S1", "A", 25.0),
    ])
    assert [tuple(x) for x in C.hottest_stations(r).collect()] == [("", 30.0, 40.0), ("A", 25.0, 25.0)]
    by_id = [tuple(x) for x in C.hottest_stations(r, by="station_id").collect()]
    assert by_id[0] == ("X1", 40.0, 40.0)


def test_garbage_timestamp_forms_null_date_group(spark):
    r = readings(spark, [
        ("relative_humidity", "not a time", "S1", "A", 50.0),
        ("relative_humidity", "2026-03-01T00:05:00+08:00", "S1", "A", 70.0),
    ])
    got = [tuple(x) for x in C.daily_humidity(r).collect()]
    assert got == [(None, 50.0, 50.0), (dt.date(2026, 3, 1), 70.0, 70.0)]


def test_sql_form_equals_dataframe_form(spark):
    r = ev.readings(spark, SF001)
    for name, fn in C.CURATED.items():
        a = [tuple(x) for x in fn(r).collect()]
        b = [tuple(x) for x in S.curated_sql(spark, r, name).collect()]
        assert a == b, name
    names = {t.name for t in spark.catalog.listTables()}
    assert {"temperature", "humidity", "rainfall", "wind_speed", "wind_direction"} <= names


def test_metric_counts_and_trailing_days(spark):
    r = ev.readings(spark, SF001)
    counts = dict(C.metric_counts(r).collect())
    assert sum(counts.values()) == r.count()
    last = C.trailing_days(r, 7)
    dates = {x[0] for x in last.select("date").distinct().collect()}
    assert len(dates) == 7 and max(dates) == r.agg(F.max("date")).first()[0]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hottest_plan_is_top_k_with_pruned_pushed_scan(spark):
    df = C.hottest_stations(ev.readings(spark, SF01, metrics=["air_temperature"]))
    plan = _plan(df)
    assert "TakeOrderedAndProject" in plan
    assert "BroadcastHashJoin" in plan
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan
    # only the columns the query needs are read
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_daily_aggregates_are_partial_then_final(spark):
    df = C.daily_temp(ev.readings(spark, SF01, metrics=["air_temperature"]))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    phys = _plan(df)
    assert phys.count("HashAggregate") >= 2, phys
    assert "Aggregate" in plan


def test_partials_give_identical_tables(spark):
    r = ev.readings(spark, SF01, metrics=["air_temperature"])
    p = C.temperature_partials(r)
    assert [tuple(x) for x in C.daily_temp_from_partials(p).collect()] == \
        [tuple(x) for x in C.daily_temp(r).collect()]
    assert [tuple(x) for x in C.hottest_from_partials(p).collect()] == \
        [tuple(x) for x in C.hottest_stations(r).collect()]


def test_no_value_is_left_out_of_averages_and_sums(spark):
    nan, inf = float("nan"), float("inf")
    groups = {
        "wide": [2e12, 10.0], "tiny": [4e-7] * 100_000, "inf": [inf, 5.0], "nan": [10.0, nan, 20.0],
        "huge": [1e300, 1e300], "both": [inf, -inf], "fine": [0.1 + 0.2, 0.1], "null": [None, None],
    }
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs],
                               "station_name string, value double").selectExpr(
        "'air_temperature' AS metric", "DATE'2026-03-01' AS date", "*")
    got = {r["station_name"]: (r["a"], r["s"]) for r in df.groupBy("station_name").agg(
        exact_avg("value").alias("a"), exact_sum("value").alias("s")).collect()}
    assert got["wide"] == (1000000000005.0, 2000000000010.0)
    assert got["tiny"] == (0.0, 0.04) and got["inf"] == (inf, inf)
    assert got["huge"] == (1e300, 2e300) and got["fine"] == (0.2, 0.4) and got["null"] == (None, None)
    assert all(str(x) == "nan" for k in ("nan", "both") for x in got[k])
    partials = C.temperature_partials(df)
    for table in (C.daily_temp_from_partials(partials, ordered=False), C.hottest_from_partials(partials),
                  C.daily_temp(df), C.hottest_stations(df)):
        assert {r["station_name"]: str(r["avg_temp_c"]) for r in table.collect()} == {
            k: str(a) for k, (a, _) in got.items()}


def test_curated_tables_as_views(spark):
    r = ev.readings(spark, SF001)
    names = S.register_views(r, curated=True)
    assert {"readings", "temperature", "daily_temp", "hottest_stations", "rainiest_days",
            "daily_humidity"} <= set(names)
    assert spark.sql("SELECT COUNT(*) FROM readings").first()[0] == r.count()
    top = spark.sql("SELECT station_name FROM hottest_stations LIMIT 1").first()[0]
    assert top == C.hottest_stations(r).first()["station_name"]


def test_plain_user_sql_runs_over_the_views(spark):
    """A user's own SQL written against the per-metric views (plain DATE and
    ROUND(AVG)) runs unchanged; it groups exactly like the curated table and
    differs at most in the last rounded digit (double vs exact decimal)."""
    r = ev.readings(spark, SF01)
    S.register_views(r)
    user = spark.sql("""
        SELECT DATE(timestamp) AS date, station_name,
               ROUND(AVG(temperature_c), 2) AS avg_temp_c, ROUND(MAX(temperature_c), 2) AS max_temp_c
        FROM temperature GROUP BY DATE(timestamp), station_name
    """)
    ours = {(x["date"], x["station_name"]): x for x in C.daily_temp(r).collect()}
    got = {(x["date"], x["station_name"]): x for x in user.collect()}
    assert got.keys() == ours.keys()
    for k, x in got.items():
        assert x["max_temp_c"] == ours[k]["max_temp_c"]
        assert abs(x["avg_temp_c"] - ours[k]["avg_temp_c"]) <= 0.0100001


def test_exact_avg_and_sum_match_decimal_half_up(spark):
    """Many random groups in one job against Python's decimal arithmetic."""
    import random
    from decimal import ROUND_HALF_UP, Decimal

    from stratus.functions.columns import exact_sum
    rng = random.Random(3)
    rows = []
    for g in range(2000):
        for _ in range(rng.randint(1, 40)):
            rows.append((g, round(rng.uniform(-50, 500), rng.choice([0, 1, 2]))))
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r["g"]: (r["a"], r["s"]) for r in
           df.groupBy("g").agg(exact_avg("v").alias("a"), exact_sum("v").alias("s")).collect()}
    q = Decimal("0.01")
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(Decimal(repr(v)))
    for g, vals in groups.items():
        total = sum(vals)
        want_avg = float((total / len(vals)).quantize(q, rounding=ROUND_HALF_UP))
        want_sum = float(total.quantize(q, rounding=ROUND_HALF_UP))
        assert got[g] == (want_avg, want_sum), (g, vals)
