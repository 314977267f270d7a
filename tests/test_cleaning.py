"""Dedup, null policy, typed cast, quality report, station lookup."""

from pyspark.sql import functions as F

from stratus.operators import cleaning, quality
from stratus.operators.lookup import station_lookup, unique_stations
from stratus.sources import events as ev

from conftest import SF001


def test_dedup_collapses_hot_key_and_is_deterministic(spark):
    # one key holds most rows; differing copies resolve by the order column
    rows = [("rainfall", "S1", "t1", float(i), i) for i in range(500)]
    rows += [("rainfall", "S2", "t1", 1.0, 0), ("rainfall", "S2", "t1", 1.0, 0)]
    df = spark.createDataFrame(rows, "metric string, station_id string, timestamp string, value double, ingest long")
    out = cleaning.dedup_readings(df, order_by="ingest")
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("rainfall", "S1", "t1", 499.0, 499), ("rainfall", "S2", "t1", 1.0, 0)]
    assert out.columns == df.columns
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan or plan.count("Aggregate") >= 2


def test_dedup_keeps_exact_copies_once(spark):
    r = ev.readings(spark, SF001)
    doubled = r.unionByName(r)
    assert cleaning.dedup_readings(doubled).count() == r.count()


def test_null_policy_fills_and_drops(spark):
    df = spark.createDataFrame(
        [("t", "S1", None, None, None, 1.0), ("t", "S2", "B", 1.0, 2.0, None), (None, "S3", "C", 0.0, 0.0, 3.0)],
        "timestamp string, station_id string, station_name string, latitude double, longitude double, value double")
    got = [tuple(r) for r in cleaning.null_policy(df).collect()]
    assert got == [("t", "S1", "", 0.0, 0.0, 1.0)]


def test_typed_cast(spark):
    """Text is read as float() reads it; what it refuses is NULL."""
    texts = ["1", " 2.5 ", "x", "3d", None, "NaN", "+nan", "-inf", "Infinity", "1_000", "1__0", "_1", "1_",
             "1e400", "1_0.5_0e1_0", ".5", "5.", ".", "e5", "", " ", "0x10", "1e", "\t7\n", "-.5E-2"]
    df = spark.createDataFrame([(t,) for t in texts], "v string").coalesce(1)

    def read(t):
        try:
            return repr(float(t))
        except (TypeError, ValueError):
            return "None"

    got = [repr(r[0]) for r in cleaning.typed_cast(df, "v", "d").select("d").collect()]
    assert got == [read(t) for t in texts]


def test_quality_report(spark):
    df = spark.createDataFrame([
        ("air_temperature", "S1", "t1", "A", 25.0),
        ("air_temperature", "S1", "t1", "A", 25.0),
        ("air_temperature", "S2", "t1", "", 99.0),
        ("air_temperature", "S3", "t1", "C", None),
        ("relative_humidity", "S1", "t1", "A", float("nan")),
    ], "metric string, station_id string, timestamp string, station_name string, value double") \
        .withColumn("date", F.expr("try_cast(timestamp AS DATE)"))
    got = {r["metric"]: r.asDict() for r in quality.quality_report(df).collect()}
    t = got["air_temperature"]
    assert (t["n_rows"], t["n_null_value"], t["n_nan_value"], t["n_out_of_range"],
            t["n_unknown_station"], t["n_keys"], t["n_duplicate_rows"]) == (4, 1, 0, 1, 1, 3, 1)
    h = got["relative_humidity"]
    assert (h["n_nan_value"], h["n_out_of_range"]) == (1, 0)
    assert t["n_null_date"] == 4 and h["n_null_date"] == 1          # "t1" is not a date


def test_station_lookup_defaults(spark):
    readings = spark.createDataFrame([("S1", 1.0), ("S9", 2.0)], "station_id string, value double")
    stations = spark.createDataFrame([("S1", "A", 1.5, 2.5)],
                                     "station_id string, station_name string, latitude double, longitude double")
    got = sorted(tuple(r) for r in station_lookup(readings, stations).collect())
    assert got == [("S1", 1.0, "A", 1.5, 2.5), ("S9", 2.0, "", 0.0, 0.0)]


def test_station_lookup_leaves_the_join_to_spark(spark, tmp_path):
    """No hint and no job while the plan is built: bytes decide."""
    path = str(tmp_path / "stations")
    (spark.range(5000).selectExpr("CAST(id AS STRING) AS station_id", "CONCAT('S', id) AS station_name",
                                  "0.0D AS latitude", "0.0D AS longitude").write.parquet(path))
    readings = spark.range(100).selectExpr("CAST(id AS STRING) AS station_id", "1.0D AS value")

    def plan():
        out = station_lookup(readings, spark.read.parquet(path))
        assert out.count() == 100
        return out._jdf.queryExecution().sparkPlan().toString()

    assert "BroadcastHashJoin" in plan()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
        assert "SortMergeJoin" in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_unique_stations_last_wins(spark):
    st = spark.createDataFrame([("S1", "A", 0.0, 0.0, 1), ("S1", "A2", 1.0, 1.0, 2)],
                               "station_id string, station_name string, latitude double, longitude double, pos int")
    got = [tuple(r) for r in unique_stations(st, order_by="pos").collect()]
    assert got == [("S1", "A2", 1.0, 1.0)]


def test_cluster_conf_scales_with_input():
    from stratus.session import cluster_conf
    small = cluster_conf(1 << 30, 8)
    big = cluster_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_hot_station_on_the_sort_merge_path_is_split_by_aqe(spark):
    """One station holds a third of the readings; the dimension is over the
    broadcast bound, so the join is a sort-merge join and AQE splits the hot
    partition.  Results stay whole."""
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30_000
        readings = spark.range(n).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 'HOT' ELSE CAST(id % 997 AS STRING) END AS station_id",
            "CAST(id AS DOUBLE) AS value")
        stations = spark.range(997).selectExpr(
            "CAST(id AS STRING) AS station_id", "CONCAT('S', id) AS station_name",
            "0.0D AS latitude", "0.0D AS longitude").union(
            spark.createDataFrame([("HOT", "Hot", 1.0, 2.0)], "station_id string, station_name string, latitude double, longitude double"))
        out = station_lookup(readings, stations)
        got = out.groupBy("station_name").count().where("station_name = 'Hot'").first()["count"]
        assert got == n // 3
        assert out.count() == n
        out.collect()           # runs this DataFrame's own plan to its final AQE form
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan, plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_rejects_report_counts_items_and_days(spark):
    rj = spark.createDataFrame([
        ("rainfall", 1, "missing_data"), ("rainfall", 2, "bad_value"),
        ("rainfall", 2, "after_bad_item"), ("rainfall", 2, "after_bad_item"),
        ("rainfall", 3, "bad_value")], "metric string, day_id long, reason string")
    got = {(r["reason"]): (r["n_rejects"], r["n_days"]) for r in quality.rejects_report(rj).collect()}
    assert got == {"missing_data": (1, 1), "bad_value": (2, 2), "after_bad_item": (2, 1)}
