"""

``entry(spark)`` runs the flagship query (hottest stations) on sf0.001.
(spark, sf_dir) -> DataFrame; ``oracle_sql()`` gives the equivalent DuckDB
SQL over the same parquet tables.

The given tables stand in for station readings: ``events`` are the readings
(event type -> metric, user -> station, value) and ``supplier`` is the
station dimension (a third of the users have no supplier row and so take
the unknown-station defaults).  Averages use the exact decimal form (see
stratus/functions/columns.py); the oracles reproduce it with integer
arithmetic.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# The package lives next to this file; make it importable however this file
# is loaded (by module name from the repo root, or by path from elsewhere).
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions.columns import exact_avg, exact_sum
from stratus.operators import cleaning, flatten, quality
from stratus.plans import curated as C
from stratus.plans import sql as S
from stratus.schemas import CLEAN_COLUMNS, FLATTENED_SCHEMA, HUMIDITY, RAINFALL, TEMPERATURE
from stratus.session import shared_dir
from stratus.sinks import lake, snapshots
from stratus.sources import events as ev
from stratus.sources.raw_json import read_raw_days, read_raw_variants
from stratus.streaming import incremental, raw_ingest

FLAGSHIP_SF = "/root/testdata/sf0.001"

# Deterministic faults injected into derived inputs (every row is still
# processed; these only change what some rows contain).
def _prefix_bad():
    return F.col("event_id") % 53 == 7          # bad value text in a document


def _null_value():
    return F.col("event_id") % 47 == 5          # NULL reading value


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top-10 hottest stations on sf0.001."""
    return C.hottest_stations(ev.readings(spark, FLAGSHIP_SF, metrics=[TEMPERATURE]))


# ------------------------------------------------------------ query bodies --

def _typed_cast_input(spark: SparkSession, sf: str) -> DataFrame:
    e = ev.table(spark, sf, "events")
    text = ev.value_text(F.col("value"))
    k = F.col("event_id") % 41
    raw = (
        F.when(k == 3, F.lit("n/a"))
        .when(k == 5, F.concat(F.lit(" "), text, F.lit(" ")))
        .when(k == 9, F.concat(text, F.lit("d")))
        .when(k == 11, F.lit("1e2"))
        .when(k == 13, F.lit(""))
        .when(k == 17, F.concat(F.lit("+"), text))
        .when(k == 19, F.lit(".5"))
        .when(k == 23, F.lit("NaN"))
        .when(k == 29, F.lit("-inf"))
        .otherwise(text)
    )
    return e.select("event_id", raw.alias("raw_value"))


def q_typed_cast(spark, sf):
    return cleaning.typed_cast(_typed_cast_input(spark, sf), "raw_value", "value")


def q_raw_flatten(spark, sf):
    return flatten.flatten_readings(ev.day_documents(spark, sf))


def q_flatten_prefix_keep(spark, sf):
    return flatten.flatten_readings(ev.day_documents(spark, sf, bad_value=_prefix_bad()))


def q_flatten_nonfinite(spark, sf):
    """Value texts that only float()'s full grammar reads; no reading is lost."""
    k = F.col("event_id") % 59
    text = (F.when(k == 3, F.lit("NaN")).when(k == 5, F.lit("-Infinity")).when(k == 7, F.lit("1_000"))
            .when(k == 11, F.lit(" 1e400 ")).when(k == 13, F.lit("+nan"))
            .otherwise(ev.value_text(F.col("value"))))
    return flatten.flatten_readings(ev.day_documents(spark, sf, text=text))


def q_agg_wide_values(spark, sf):
    """Average, sum and maximum per metric and date with some values very large,
    very small or not finite."""
    k, rare = F.col("event_id") % 97, F.col("event_id") % 997
    value = (F.when(rare == 1, F.lit(float("nan"))).when(rare == 2, F.lit(float("inf")))
             .when(k == 3, F.lit(2e12)).when(k == 5, F.lit(1e-7)).otherwise(F.col("value")))
    return ev.event_readings(spark, sf).withColumn("value", value).groupBy("metric", "date").agg(
        exact_avg("value").alias("avg_value"), exact_sum("value").alias("sum_value"),
        F.max("value").alias("max_value"))


def q_flatten_rejects(spark, sf):
    return flatten.flatten_rejects(ev.day_documents(spark, sf, bad_value=_prefix_bad())).drop("day_id")


def q_rejects_report(spark, sf):
    rj = flatten.flatten_rejects(ev.day_documents(spark, sf, bad_value=_prefix_bad()))
    return quality.rejects_report(rj).drop("n_days")


def q_parquet_roundtrip(spark, sf):
    out = shared_dir(spark, "parquet-roundtrip")
    df = C.daily_temp(ev.readings(spark, sf, metrics=[TEMPERATURE]), ordered=False)
    lake.write_parquet(df, out, ["date"])
    return lake.read_parquet(spark, out, columns=df.columns)


def q_csv_roundtrip(spark, sf):
    out = shared_dir(spark, "csv-roundtrip")
    df = C.daily_temp(ev.readings(spark, sf, metrics=[TEMPERATURE]))
    lake.write_csv(df, out)
    return lake.read_csv(spark, out, df.schema)


def _publish_lake(spark, sf) -> str:
    """raw JSON → clean/rejects parquet → curated parquet + csv, all on disk."""
    root = shared_dir(spark, "lake")
    lake.publish_raw(ev.day_documents(spark, sf), root)
    raw = read_raw_days(spark, lake.layer_path(root, lake.RAW), multiline=False)
    clean_path, _ = lake.ingest_clean(spark, raw, root)
    clean = lake.read_clean(spark, clean_path)
    tables = {name: fn(clean) if name == "hottest_stations" else fn(clean, ordered=False)
              for name, fn in C.CURATED.items()}
    lake.publish_curated_all(tables, root, order={n: C.ORDER[n]() for n in tables})
    return root


def q_raw_json_scan(spark, sf):
    """Day responses landed as JSON files, scanned with the fixed schema, flattened."""
    root = shared_dir(spark, "raw-scan")
    path = lake.publish_raw(ev.day_documents(spark, sf), root)
    return flatten.flatten_readings(read_raw_days(spark, path, multiline=False))


def q_raw_json_scan_strict(spark, sf):
    """As raw_json_scan, read with exact null-vs-absent semantics."""
    root = shared_dir(spark, "raw-scan-strict")
    path = lake.publish_raw(ev.day_documents(spark, sf), root)
    return flatten.flatten_readings(read_raw_days(spark, path, multiline=False, strict=True))


def q_raw_json_scan_multiline(spark, sf):
    """The original's own input form: files of one JSON array each."""
    path = lake.publish_raw_arrays(ev.day_texts(spark, sf), shared_dir(spark, "raw-arrays"))
    return flatten.flatten_readings(read_raw_variants(spark, path, pattern="*.txt"))


def _mistyped_files(spark, sf, root):
    """Array files with wrongly typed days, readings, items, ids, values and
    coordinates (ev.day_texts), and files cut short."""
    cut = (F.col("metric") == "wind_direction") & (F.dayofmonth("date") == 17)
    return lake.publish_raw_arrays(ev.day_texts(spark, sf, faults=True), root, cut)


def _mistyped_days(spark, sf):
    return read_raw_variants(spark, _mistyped_files(spark, sf, shared_dir(spark, "raw-mistyped")), pattern="*.txt")


def _streamed(spark, sf) -> str:
    """The same files taken up by the raw stream in several micro-batches, then
    once more under another feed, compacted, and taken up again."""
    root = shared_dir(spark, "raw-stream")
    files = _mistyped_files(spark, sf, root)
    raw_ingest.run_raw_incremental(spark, files, root, pattern="*.txt", files_per_batch=100)
    snapshots.compact(spark, lake.layer_path(root, lake.CLEAN, "flattened"), FLATTENED_SCHEMA, 2)
    raw_ingest.run_raw_incremental(spark, f"{files}/*", root, pattern="*.txt", files_per_batch=1000)
    return root


def q_stream_raw_clean(spark, sf):
    return lake.read_clean(spark, lake.layer_path(_streamed(spark, sf), lake.CLEAN, "flattened") + "/kind=readings")


def q_stream_raw_rejects(spark, sf):
    return quality.rejects_report(lake.read_rejects(
        spark, lake.layer_path(_streamed(spark, sf), lake.CLEAN, "flattened") + "/kind=rejects"))


def q_stream_raw_tables(spark, sf):
    """The four curated tables of the raw stream, one under the other."""
    root = _streamed(spark, sf)
    no = F.lit(None)
    shape = {"daily_temp": ("date", "station_name", "avg_temp_c", "max_temp_c"),
             "hottest_stations": (no, "station_name", "avg_temp_c", "max_temp_c"),
             "rainiest_days": ("date", no, "total_rainfall_mm", no),
             "daily_humidity": ("date", no, "avg_humidity_pct", "max_humidity_pct")}
    out = None
    for name, cols in shape.items():
        rows = raw_ingest.read_table(spark, root, name, [c for c in cols if isinstance(c, str)])
        rows = rows.select(F.lit(name).alias("table_name"), *[
            (F.col(c) if isinstance(c, str) else c).cast(t).alias(n)
            for c, n, t in zip(cols, ("date", "station_name", "first_value", "second_value"),
                               ("date", "string", "double", "double"), strict=True)])
        out = rows if out is None else out.unionByName(rows)
    return out


def q_raw_json_mistyped(spark, sf):
    return flatten.flatten_readings(_mistyped_days(spark, sf))


def q_raw_json_mistyped_rejects(spark, sf):
    return quality.rejects_report(flatten.flatten_rejects(_mistyped_days(spark, sf)))


def q_layer_publish(spark, sf):
    root = _publish_lake(spark, sf)
    return lake.read_parquet(spark, lake.layer_path(root, lake.CURATED, "rainiest_days"))


def q_file_manifest(spark, sf):
    return lake.file_manifest(spark, _publish_lake(spark, sf))


def q_batch_run(spark, sf):
    """The whole batch job (raw NDJSON → clean/rejects → partials → curated and
    reports); daily_temp read back from its date-partitioned Parquet."""
    from stratus.plans.batch import run_batch
    root = shared_dir(spark, "batch")
    raw = lake.publish_raw(ev.day_documents(spark, sf), root)
    out = run_batch(spark, raw, root, multiline=False)
    return spark.read.parquet(out["daily_temp"]).select(
        "date", "station_name", "avg_temp_c", "max_temp_c")


def q_output_listing(spark, sf):
    return lake.file_listing(spark, lake.layer_path(_publish_lake(spark, sf), lake.CURATED))


def q_dedup_readings(spark, sf):
    r = ev.readings(spark, sf)
    again = C.metric_rows(r, RAINFALL)          # a whole metric delivered twice
    return cleaning.dedup_readings(r.unionByName(again))


def q_null_policy(spark, sf):
    # Station attributes without defaults (NULL when the station is unknown)
    # and injected NULL values; the policy fills the former, drops the latter.
    r = ev.event_readings(spark, sf)
    r = r.withColumn("value", F.when(~_null_value(), F.col("value")))
    st = ev.stations(spark, sf)
    joined = r.join(st, "station_id", "left")
    return cleaning.null_policy(joined).select(*CLEAN_COLUMNS)


def q_last_7_days(spark, sf):
    return C.daily_temp(C.trailing_days(ev.readings(spark, sf), 7))


def q_stream_daily_equals_batch(spark, sf):
    root = shared_dir(spark, "incremental")
    landing = f"{root}/landing"
    incremental.land(ev.readings(spark, sf), landing)
    paths = incremental.run_incremental(spark, landing, root, ["daily_humidity"],
                                        files_per_batch=10)
    return incremental.read_curated(spark, paths["daily_humidity"],
                                    ["date", "avg_humidity_pct", "max_humidity_pct"])


def q_stream_hottest_equals_batch(spark, sf):
    root = shared_dir(spark, "incremental-hot")
    landing = f"{root}/landing"
    incremental.land(ev.readings(spark, sf), landing)
    paths = incremental.run_incremental(spark, landing, root, ["hottest_stations"],
                                        files_per_batch=10)
    return incremental.read_curated(spark, paths["hottest_stations"],
                                    ["station_name", "avg_temp_c", "max_temp_c"])


def _corrected(r: DataFrame) -> DataFrame:
    """Readings as a second delivery brings them: whole, some values corrected."""
    k = F.col("event_id") % 43
    return r.withColumn("value", F.when(k == 7, F.col("value") + 1.5).when(k == 9, F.col("value") - 1.5)
                        .otherwise(F.col("value")))


def _landed_twice(spark, sf) -> tuple[str, dict[str, str]]:
    """All readings, then all once more with corrections, kept once across runs."""
    root = shared_dir(spark, "incremental-dedup")
    r = ev.readings(spark, sf, with_event_id=True)
    for rows in (r, _corrected(r)):
        incremental.land(rows, f"{root}/landing")
        paths = incremental.run_incremental(spark, f"{root}/landing", root, ["hottest_stations"],
                                            files_per_batch=100, dedup=True)
    return root, paths


def q_stream_dedup_equals_batch(spark, sf):
    return incremental.read_clean(spark, _landed_twice(spark, sf)[0], dedup=True)


def q_stream_dedup_hottest(spark, sf):
    return incremental.read_curated(spark, _landed_twice(spark, sf)[1]["hottest_stations"],
                                    ["station_name", "avg_temp_c", "max_temp_c"])


def q_quality_report_faults(spark, sf):
    """The report over readings with NULLs, NaNs, timestamps without a date,
    values out of range, and one metric delivered twice."""
    k = F.col("event_id") % 61
    r = ev.readings(spark, sf, with_event_id=True)
    r = r.withColumn("value", F.when(k == 1, F.lit(None)).when(k == 2, F.lit(float("nan")))
                     .when(k == 3, F.lit(-999.0)).otherwise(F.col("value")))
    r = r.withColumn("date", F.when(k != 4, F.col("date"))).withColumn(
        "timestamp", F.when(k == 4, F.lit("never")).otherwise(F.col("timestamp")))
    return quality.quality_report(r.unionByName(C.metric_rows(r, RAINFALL)).drop("event_id"))


def _sql(name):
    def run(spark, sf):
        return S.curated_sql(spark, ev.readings(spark, sf), name)
    return run


def _llm() -> tuple[dict, dict]:
    """Queries and oracles of the training-data operators and their pipeline;
    empty when that subpackage isn't there."""
    try:
        import corpus_pipeline
        from stratus.llm import entry as llm
    except ImportError as e:
        if (e.name or "").split(".")[:2] not in (["corpus_pipeline"], ["stratus", "llm"]):
            raise
        return {}, {}
    qs, oracles = llm.queries(), llm.oracle_sql()
    qs["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return qs, oracles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_queries(), **_llm()[0]}


def _queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    temp = [TEMPERATURE]
    return {
        "daily_temp": lambda s, sf: C.daily_temp(ev.readings(s, sf, metrics=temp)),
        "hottest_stations": lambda s, sf: C.hottest_stations(ev.readings(s, sf, metrics=temp)),
        "rainiest_days": lambda s, sf: C.rainiest_days(ev.event_readings(s, sf, metrics=[RAINFALL])),
        "daily_humidity": lambda s, sf: C.daily_humidity(ev.event_readings(s, sf, metrics=[HUMIDITY])),
        "metric_counts": lambda s, sf: C.metric_counts(ev.event_readings(s, sf)),
        "view_sql": _sql("daily_temp"),
        "view_sql_hottest": _sql("hottest_stations"),
        "view_sql_rainiest": _sql("rainiest_days"),
        "view_sql_humidity": _sql("daily_humidity"),
        "preview_top5": lambda s, sf: C.preview(
            C.hottest_stations(ev.readings(s, sf, metrics=temp)), 5),
        "rainiest_ranked": lambda s, sf: C.rainiest_ranked(ev.event_readings(s, sf, metrics=[RAINFALL])),
        "last_7_days": q_last_7_days,
        "raw_flatten": q_raw_flatten,
        "raw_json_scan": q_raw_json_scan,
        "raw_json_scan_strict": q_raw_json_scan_strict,
        "raw_json_scan_multiline": q_raw_json_scan_multiline,
        "raw_json_mistyped": q_raw_json_mistyped,
        "raw_json_mistyped_rejects": q_raw_json_mistyped_rejects,
        "stream_raw_clean": q_stream_raw_clean,
        "stream_raw_rejects": q_stream_raw_rejects,
        "stream_raw_equals_batch": q_stream_raw_tables,
        "typed_cast": q_typed_cast,
        "flatten_prefix_keep": q_flatten_prefix_keep,
        "flatten_rejects": q_flatten_rejects,
        "flatten_nonfinite": q_flatten_nonfinite,
        "agg_wide_values": q_agg_wide_values,
        "station_lookup": lambda s, sf: ev.readings(s, sf),
        "parquet_roundtrip": q_parquet_roundtrip,
        "csv_roundtrip": q_csv_roundtrip,
        "layer_publish": q_layer_publish,
        "batch_run": q_batch_run,
        "file_manifest": q_file_manifest,
        "output_listing": q_output_listing,
        "dedup_readings": q_dedup_readings,
        "null_policy": q_null_policy,
        "quality_report": lambda s, sf: quality.quality_report(ev.readings(s, sf)),
        "rejects_report": q_rejects_report,
        "stream_daily_equals_batch": q_stream_daily_equals_batch,
        "stream_hottest_equals_batch": q_stream_hottest_equals_batch,
        "stream_dedup_equals_batch": q_stream_dedup_equals_batch,
        "stream_dedup_hottest": q_stream_dedup_hottest,
        "quality_report_faults": q_quality_report_faults,
    }


# ----------------------------------------------------------------- oracles --

_READINGS = """
readings AS (
  SELECT e.event_id,
         CASE e.event_type WHEN 'click' THEN 'air_temperature'
                           WHEN 'view' THEN 'relative_humidity'
                           WHEN 'purchase' THEN 'rainfall'
                           WHEN 'signup' THEN 'wind_speed'
                           WHEN 'error' THEN 'wind_direction' END AS metric,
         CAST(e.ts AS DATE) AS date,
         strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') || '+08:00' AS timestamp,
         CAST(e.user_id AS VARCHAR) AS station_id,
         COALESCE(s.s_name, '') AS station_name,
         COALESCE(s.s_acctbal, 0.0) AS latitude,
         COALESCE(CAST(s.s_nationkey AS DOUBLE), 0.0) AS longitude,
         e.value AS value
  FROM events e LEFT JOIN supplier s ON e.user_id = s.s_suppkey
)"""

_CLEAN = "metric, date, timestamp, station_id, station_name, latitude, longitude, value"


def _avg(x: str) -> str:
    """HALF_UP round to 2 places of the exact mean, in integer arithmetic."""
    s6 = f"CAST(SUM(CAST({x} AS DECIMAL(18,6))) * 1000000 AS HUGEINT)"
    n = f"COUNT({x})"
    return (f"(CAST(sign({s6}) * ((2 * abs({s6}) + {n} * 10000) // (2 * {n} * 10000))"
            f" AS DOUBLE) / 100)")


def _sum(x: str) -> str:
    return f"CAST(ROUND(SUM(CAST({x} AS DECIMAL(18,6))), 2) AS DOUBLE)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join((_READINGS,) + ctes)


DAILY_TEMP_SQL = _with() + f"""
SELECT date, station_name, {_avg('value')} AS avg_temp_c, ROUND(MAX(value), 2) AS max_temp_c
FROM readings WHERE metric = 'air_temperature'
GROUP BY date, station_name"""


def _hottest(k: int, rows: str = "readings", *ctes: str) -> str:
    return _with(*ctes) + f"""
SELECT station_name, {_avg('value')} AS avg_temp_c, ROUND(MAX(value), 2) AS max_temp_c
FROM {rows} WHERE metric = 'air_temperature'
GROUP BY station_name
ORDER BY avg_temp_c DESC NULLS LAST, station_name ASC NULLS FIRST
LIMIT {k}"""


RAINIEST_SQL = _with() + f"""
SELECT date, {_sum('value')} AS total_rainfall_mm
FROM readings WHERE metric = 'rainfall' GROUP BY date"""

HUMIDITY_SQL = _with() + f"""
SELECT date, {_avg('value')} AS avg_humidity_pct, ROUND(MAX(value), 2) AS max_humidity_pct
FROM readings WHERE metric = 'relative_humidity' GROUP BY date"""

CLEAN_SQL = _with() + f"\nSELECT {_CLEAN} FROM readings"

_PREFIX_DOCS = """
docs AS (
  SELECT *, event_id // 1024 AS span, (event_id % 53 = 7) AS bad FROM readings
),
ordered AS (
  SELECT *,
         CAST(ROW_NUMBER() OVER w AS INTEGER) AS position,
         SUM(CASE WHEN bad THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_bad
  FROM docs
  WINDOW w AS (PARTITION BY metric, date, span ORDER BY timestamp, event_id)
)"""

# What the faults of events.day_texts make of each event.  A broken reading is
# one element, whatever it held.
_MISTYPED = """
faulty AS (
  SELECT *, event_id // 1024 AS span, event_id % 101 AS k,
         MIN(event_id) OVER (PARTITION BY metric, date, event_id // 1024, timestamp) AS first_event
  FROM readings
),
marked AS (
  SELECT *,
         CASE WHEN first_event % 211 = 3 THEN 'malformed_reading' WHEN k = 11 THEN 'malformed_item'
              WHEN k = 3 THEN 'bad_value'
              WHEN k <> 7 AND station_name <> '' AND CAST(station_id AS BIGINT) % 50 = 7
              THEN 'bad_station_longitude' END AS own,
         CASE (span + day(date)) % 13 WHEN 4 THEN 'missing_data' WHEN 9 THEN 'missing_readings' END AS day_reason,
         metric = 'wind_direction' AND day(date) = 17 AS cut
  FROM faulty
),
elements AS (
  SELECT *, SUM(CASE WHEN own IS NOT NULL THEN 1 ELSE 0 END) OVER (
      PARTITION BY metric, date, span ORDER BY timestamp, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_bad
  FROM marked
  WHERE NOT cut AND day_reason IS NULL AND (first_event % 211 <> 3 OR event_id = first_event)
),
kept AS (
  SELECT metric, date, timestamp, station_id,
         CASE WHEN k = 7 THEN '' ELSE station_name END AS station_name,
         CASE WHEN k = 7 THEN 0.0 ELSE latitude END AS latitude,
         CASE WHEN k = 7 THEN 0.0 ELSE longitude END AS longitude,
         CASE k WHEN 5 THEN 1.0 WHEN 13 THEN 12.5 ELSE value END AS value
  FROM elements WHERE n_bad = 0
)"""

_MISTYPED_REJECTS_SQL = _with(_MISTYPED) + """
SELECT metric, reason, COUNT(*) AS n_rejects, COUNT(DISTINCT day) AS n_days FROM (
  SELECT metric, COALESCE(own, 'after_bad_item') AS reason, concat_ws(' ', date, span) AS day
  FROM elements WHERE n_bad > 0
  UNION ALL
  SELECT DISTINCT metric, day_reason, concat_ws(' ', date, span) FROM marked WHERE NOT cut AND day_reason IS NOT NULL
  UNION ALL
  SELECT DISTINCT metric, 'unreadable_json', concat_ws(' ', date) FROM marked WHERE cut) t
GROUP BY metric, reason"""

_TYPED_RAW = """
CASE event_id % 41
  WHEN 3 THEN 'n/a'
  WHEN 5 THEN ' ' || CAST(value AS VARCHAR) || ' '
  WHEN 9 THEN CAST(value AS VARCHAR) || 'd'
  WHEN 11 THEN '1e2'
  WHEN 13 THEN ''
  WHEN 17 THEN '+' || CAST(value AS VARCHAR)
  WHEN 19 THEN '.5'
  WHEN 23 THEN 'NaN'
  WHEN 29 THEN '-inf'
  ELSE CAST(value AS VARCHAR) END"""

# What float() makes of the injected texts, one by one.
_NONFINITE_SQL = f"""
SELECT {_CLEAN.replace(', value', '')},
       CASE event_id % 59
         WHEN 3 THEN 'nan'::DOUBLE WHEN 13 THEN 'nan'::DOUBLE
         WHEN 5 THEN '-inf'::DOUBLE WHEN 11 THEN 'inf'::DOUBLE
         WHEN 7 THEN 1000.0 ELSE value END AS value
FROM readings"""

# Finite values are summed as integers of 1e-8; 2e12, 1e-7 and values of two
# decimals are all whole numbers of that unit.
_WIDE_SQL = """
wide AS (
  SELECT metric, date,
         CASE WHEN event_id % 997 = 1 THEN 'nan'::DOUBLE WHEN event_id % 997 = 2 THEN 'inf'::DOUBLE
              WHEN event_id % 97 = 3 THEN 2e12 WHEN event_id % 97 = 5 THEN 1e-7 ELSE value END AS v
  FROM readings
),
sums AS (
  SELECT metric, date, COUNT(v) AS n, MAX(v) AS max_value,
         SUM(CASE WHEN isfinite(v) THEN CAST(ROUND(v * 1e8) AS HUGEINT) END) AS s,
         COALESCE(bool_or(isnan(v)), FALSE) AS has_nan, COALESCE(bool_or(isinf(v)), FALSE) AS has_inf
  FROM wide GROUP BY metric, date
)"""

def _quality(rows: str, *ctes: str) -> str:
    return _with(*ctes, f"""
keys AS (
  SELECT metric, station_id, timestamp,
         COUNT(*) AS n,
         COUNT(*) FILTER (WHERE value IS NULL) AS n_null,
         COUNT(*) FILTER (WHERE isnan(value)) AS n_nan,
         COUNT(*) FILTER (WHERE NOT isnan(value) AND (
             (metric = 'air_temperature' AND (value < -50 OR value > 60)) OR
             (metric = 'relative_humidity' AND (value < 0 OR value > 100)) OR
             (metric = 'rainfall' AND (value < 0 OR value > 300)) OR
             (metric = 'wind_speed' AND (value < 0 OR value > 250)) OR
             (metric = 'wind_direction' AND (value < 0 OR value > 360)))) AS n_range,
         COUNT(*) FILTER (WHERE station_name = '') AS n_unknown,
         COUNT(*) FILTER (WHERE date IS NULL) AS n_no_date
  FROM {rows} GROUP BY metric, station_id, timestamp
)""") + """
SELECT metric,
       CAST(SUM(n) AS BIGINT) AS n_rows,
       CAST(SUM(n_null) AS BIGINT) AS n_null_value,
       CAST(SUM(n_nan) AS BIGINT) AS n_nan_value,
       CAST(SUM(n_range) AS BIGINT) AS n_out_of_range,
       CAST(SUM(n_unknown) AS BIGINT) AS n_unknown_station,
       CAST(SUM(n_no_date) AS BIGINT) AS n_null_date,
       COUNT(*) AS n_keys,
       CAST(SUM(n - 1) AS BIGINT) AS n_duplicate_rows
FROM keys GROUP BY metric"""


# All readings, and once more with some values corrected: the largest copy stays.
_TWICE = """
twice AS (
  SELECT metric, date, timestamp, station_id, station_name, latitude, longitude, MAX(value) AS value FROM (
    SELECT * FROM readings
    UNION ALL
    SELECT * REPLACE (CASE event_id % 43 WHEN 7 THEN value + 1.5 WHEN 9 THEN value - 1.5 ELSE value END AS value)
    FROM readings) t
  GROUP BY ALL
)"""

_FAULTS = """
injected AS (
  SELECT * REPLACE (CASE event_id % 61 WHEN 1 THEN NULL WHEN 2 THEN 'nan'::DOUBLE WHEN 3 THEN -999.0 ELSE value END AS value,
                    CASE WHEN event_id % 61 <> 4 THEN date END AS date,
                    CASE WHEN event_id % 61 = 4 THEN 'never' ELSE timestamp END AS timestamp)
  FROM readings
),
faulty AS (
  SELECT * FROM injected UNION ALL SELECT * FROM injected WHERE metric = 'rainfall'
)"""


def oracle_sql() -> dict[str, str]:
    return {**_oracles(), **_llm()[1]}


def _oracles() -> dict[str, str]:
    return {
        "daily_temp": DAILY_TEMP_SQL,
        "hottest_stations": _hottest(10),
        "rainiest_days": RAINIEST_SQL,
        "daily_humidity": HUMIDITY_SQL,
        "metric_counts": _with() + "\nSELECT metric, COUNT(*) AS n_rows FROM readings GROUP BY metric",
        "view_sql": DAILY_TEMP_SQL,
        "view_sql_hottest": _hottest(10),
        "view_sql_rainiest": RAINIEST_SQL,
        "view_sql_humidity": HUMIDITY_SQL,
        "preview_top5": _hottest(5),
        "rainiest_ranked": _with() + f"""
SELECT date, total_rainfall_mm,
       CAST(RANK() OVER (ORDER BY total_rainfall_mm DESC NULLS LAST) AS INTEGER) AS rain_rank
FROM (SELECT date, {_sum('value')} AS total_rainfall_mm
      FROM readings WHERE metric = 'rainfall' GROUP BY date) t""",
        "last_7_days": _with() + f"""
SELECT date, station_name, {_avg('value')} AS avg_temp_c, ROUND(MAX(value), 2) AS max_temp_c
FROM readings
WHERE metric = 'air_temperature' AND date > (SELECT MAX(date) - 7 FROM readings)
GROUP BY date, station_name""",
        "raw_flatten": CLEAN_SQL,
        "raw_json_scan": CLEAN_SQL,
        "raw_json_scan_strict": CLEAN_SQL,
        "raw_json_scan_multiline": CLEAN_SQL,
        "raw_json_mistyped": _with(_MISTYPED) + f"\nSELECT {_CLEAN} FROM kept",
        "raw_json_mistyped_rejects": _MISTYPED_REJECTS_SQL,
        "stream_raw_clean": _with(_MISTYPED) + f"\nSELECT {_CLEAN} FROM kept",
        "stream_raw_rejects": _MISTYPED_REJECTS_SQL,
        "stream_raw_equals_batch": _with(_MISTYPED) + f"""
SELECT 'daily_temp' AS table_name, date, station_name, {_avg('value')} AS first_value, ROUND(MAX(value), 2) AS second_value
FROM kept WHERE metric = 'air_temperature' GROUP BY date, station_name
UNION ALL
SELECT * FROM (
  SELECT 'hottest_stations', CAST(NULL AS DATE), station_name, {_avg('value')} AS a, ROUND(MAX(value), 2) AS b
  FROM kept WHERE metric = 'air_temperature' GROUP BY station_name
  ORDER BY a DESC NULLS LAST, station_name ASC NULLS FIRST LIMIT 10) t
UNION ALL
SELECT 'rainiest_days', date, CAST(NULL AS VARCHAR), {_sum('value')}, CAST(NULL AS DOUBLE)
FROM kept WHERE metric = 'rainfall' GROUP BY date
UNION ALL
SELECT 'daily_humidity', date, CAST(NULL AS VARCHAR), {_avg('value')}, ROUND(MAX(value), 2)
FROM kept WHERE metric = 'relative_humidity' GROUP BY date""",
        "typed_cast": f"""
SELECT event_id, raw_value,
       CASE event_id % 41 WHEN 3 THEN NULL WHEN 9 THEN NULL WHEN 13 THEN NULL WHEN 11 THEN 100.0
            WHEN 19 THEN 0.5 WHEN 23 THEN 'nan'::DOUBLE WHEN 29 THEN '-inf'::DOUBLE
            ELSE event_value END AS value
FROM (SELECT event_id, value AS event_value, {_TYPED_RAW} AS raw_value FROM events) t""",
        "flatten_prefix_keep": _with(_PREFIX_DOCS) + f"\nSELECT {_CLEAN} FROM ordered WHERE n_bad = 0",
        "flatten_rejects": _with(_PREFIX_DOCS) + """
SELECT metric, metric || '_raw.json' AS source_file, position, timestamp, station_id,
       CASE WHEN bad THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS raw_value,
       CASE WHEN bad THEN 'bad_value' ELSE 'after_bad_item' END AS reason
FROM ordered WHERE n_bad > 0""",
        "flatten_nonfinite": _with() + _NONFINITE_SQL,
        "agg_wide_values": _with(_WIDE_SQL) + """
SELECT metric, date, max_value,
       CASE WHEN has_nan THEN 'nan'::DOUBLE WHEN has_inf THEN 'inf'::DOUBLE
            ELSE CAST(sign(s) * ((2 * abs(s) + n * 1000000) // (2 * n * 1000000)) AS DOUBLE) / 100 END AS avg_value,
       CASE WHEN has_nan THEN 'nan'::DOUBLE WHEN has_inf THEN 'inf'::DOUBLE
            ELSE CAST(sign(s) * ((2 * abs(s) + 1000000) // 2000000) AS DOUBLE) / 100 END AS sum_value
FROM sums""",
        "station_lookup": CLEAN_SQL,
        "parquet_roundtrip": DAILY_TEMP_SQL,
        "csv_roundtrip": DAILY_TEMP_SQL,
        "layer_publish": RAINIEST_SQL,
        "batch_run": DAILY_TEMP_SQL,
        "dedup_readings": _with() + f"""
SELECT DISTINCT {_CLEAN} FROM (
  SELECT {_CLEAN} FROM readings
  UNION ALL
  SELECT {_CLEAN} FROM readings WHERE metric = 'rainfall') t""",
        "null_policy": _with() + f"\nSELECT {_CLEAN} FROM readings WHERE NOT (event_id % 47 = 5)",
        "quality_report": _quality("readings"),
        "rejects_report": _with(_PREFIX_DOCS) + """
SELECT metric,
       CASE WHEN bad THEN 'bad_value' ELSE 'after_bad_item' END AS reason,
       COUNT(*) AS n_rejects
FROM ordered WHERE n_bad > 0
GROUP BY 1, 2""",
        "stream_daily_equals_batch": HUMIDITY_SQL,
        "stream_hottest_equals_batch": _hottest(10),
        "stream_dedup_equals_batch": _with(_TWICE) + f"\nSELECT {_CLEAN} FROM twice",
        "stream_dedup_hottest": _hottest(10, "twice", _TWICE),
        "quality_report_faults": _quality("faulty", _FAULTS),
    }
