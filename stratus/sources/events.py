"""The given parquet tables as station readings.

`events` plays the readings (event type → metric, user → station, value),
`supplier` the station dimension.  Everything here is a lazy DataFrame over
the parquet scans, so column pruning and filters reach the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.operators.lookup import station_lookup
from stratus.schemas import CLEAN_COLUMNS

# Which event type stands for which metric.
EVENT_METRIC = (
    ("click", "air_temperature"),
    ("view", "relative_humidity"),
    ("purchase", "rainfall"),
    ("signup", "wind_speed"),
    ("error", "wind_direction"),
)

# Local offset appended to reading timestamps, and the
# most readings one generated day document holds (event ids per document).
TIMESTAMP_OFFSET = "+08:00"
DOC_EVENT_SPAN = 1024


# Declared schemas of the tables read here: no footer inference at read time.
TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def metric_of(event_type: str = "event_type") -> Column:
    """Metric of an event type column (one CASE expression)."""
    whens = " ".join(f"WHEN '{et}' THEN '{m}'" for et, m in EVENT_METRIC)
    return F.expr(f"CASE {event_type} {whens} END")


def timestamp_text(ts: Column) -> Column:
    """ISO-8601 local time with offset, microsecond precision."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                    F.lit(TIMESTAMP_OFFSET))


def value_text(value: Column) -> Column:
    """Reading value as the text a JSON source would carry, all its digits."""
    return value.cast("string")


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station dimension: station_id, station_name, latitude, longitude."""
    # A NULL key never matches; filtering on the stored column lets the
    # scan skip such rows (the join's inferred filter is on the cast key).
    return table(spark, sf_dir, "supplier").where("s_suppkey IS NOT NULL").selectExpr(
        "CAST(s_suppkey AS STRING) AS station_id",
        "s_name AS station_name",
        "s_acctbal AS latitude",
        "CAST(s_nationkey AS DOUBLE) AS longitude",
    )


def event_types(metrics) -> list[str]:
    wanted = set(metrics)
    return [et for et, m in EVENT_METRIC if m in wanted]


def event_readings(spark: SparkSession, sf_dir: str, metrics=None) -> DataFrame:
    """Readings without station attributes: metric, date, timestamp, station_id, value, event_id.

    `metrics` restricts the scan with a predicate on the stored column
    (`event_type IN (...)`), which Parquet can push down.
    """
    e = table(spark, sf_dir, "events")
    if metrics is not None:
        e = e.where(F.col("event_type").isin(event_types(metrics)))
    return e.select(
        "event_id",
        metric_of().alias("metric"),
        F.to_date("ts").alias("date"),
        timestamp_text(F.col("ts")).alias("timestamp"),
        F.col("user_id").cast("string").alias("station_id"),
        "value",
    )


def readings(spark: SparkSession, sf_dir: str, metrics=None,
             with_event_id: bool = False) -> DataFrame:
    """Clean long readings (CLEAN_SCHEMA) derived from events ⟕ supplier."""
    r = station_lookup(event_readings(spark, sf_dir, metrics), stations(spark, sf_dir))
    cols = CLEAN_COLUMNS + (["event_id"] if with_event_id else [])
    return r.select(*cols)


def day_documents(spark: SparkSession, sf_dir: str,
                  bad_value: Column | None = None, text: Column | None = None) -> DataFrame:
    """Nested day responses (RAW_SCHEMA) built from events, one per
    (metric, date, event-id span): columns metric, source_file, data.

    Readings are grouped by timestamp, items ordered by event id, stations
    are those of the supplier table the document's items refer to.
    `bad_value`, a boolean over `events` columns, replaces the value text of
    matching events with "n/a" (to exercise the error policy); `text` gives
    the value texts, over `events` columns, in place of the values' own.
    """
    e = table(spark, sf_dir, "events")
    text = value_text(F.col("value")) if text is None else text
    if bad_value is not None:
        text = F.when(bad_value, F.lit("n/a")).otherwise(text)
    ev = e.select(
        metric_of().alias("metric"),
        F.to_date("ts").alias("date"),
        F.floor(F.col("event_id") / DOC_EVENT_SPAN).alias("span"),
        timestamp_text(F.col("ts")).alias("ts_text"),
        F.col("event_id"),
        F.col("user_id").cast("string").alias("station_id"),
        text.alias("value"),
    )
    st = stations(spark, sf_dir)
    ev = ev.join(st.select("station_id", F.struct(
        F.col("station_id").alias("id"),
        F.col("station_name").alias("name"),
        F.struct(F.col("latitude"), F.col("longitude")).alias("location"),
    ).alias("station")), "station_id", "left")

    # One aggregation per document (one shuffle); groups hold at most
    # DOC_EVENT_SPAN events.  Items are sorted by (timestamp, event id), and
    # runs of equal timestamps become the readings, in-row.
    docs = ev.groupBy("metric", "date", "span").agg(
        F.array_sort(F.collect_list(F.struct(
            "ts_text", "event_id", F.col("station_id").alias("stationId"), "value"))).alias("items"),
        F.array_sort(F.collect_set("station")).alias("stations"),
    )
    items = F.col("items")
    n = F.size(items)
    # 1-based positions where a new timestamp starts; `get` is 0-based and
    # NULL out of range, so the first item needs no special index.
    starts = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (
        F.get(items, i - 1)["ts_text"] != F.get(items, i - 2)["ts_text"]))
    ends = F.concat(F.slice(starts, 2, n), F.array(n + 1))
    readings = F.transform(
        F.arrays_zip(starts.alias("s"), ends.alias("e")),
        lambda z: F.struct(
            F.get(items, z["s"] - 1)["ts_text"].alias("timestamp"),
            F.transform(F.slice(items, z["s"], z["e"] - z["s"]), lambda i: F.struct(
                i["stationId"].alias("stationId"), i["value"].alias("value"))).alias("data"),
        ),
    )
    return docs.where(n > 0).select(
        "metric",
        F.concat(F.col("metric"), F.lit("_raw.json")).alias("source_file"),
        F.struct(F.col("stations"), readings.alias("readings")).alias("data"),
    )


def day_texts(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """The same day responses as JSON text: metric, date, span, text.

    `faults` gives some elements another type than the loop over them expects,
    by rules over ids (every event and station still goes in):
    event_id % 101 of an item: 3 an object as value, 5 true as value, 7 a
    number as stationId, 11 a text in place of the item, 13 a value as text;
    a reading whose smallest event_id % 211 = 3 is a number; stations:
    latitude as text where the key % 3 = 1, null longitude where it % 50 = 7;
    days: with (span + day of month) % 13 = 4 a number, = 9 a text as data.
    """
    def quoted(c: Column) -> Column:
        # to_json of a one-field struct, without the field around the text
        return F.regexp_replace(F.to_json(F.struct(c.alias("x"))), r'^\{"x":|\}$', "")

    e = table(spark, sf_dir, "events").select(
        metric_of().alias("metric"), F.to_date("ts").alias("date"),
        F.floor(F.col("event_id") / DOC_EVENT_SPAN).alias("span"),
        timestamp_text(F.col("ts")).alias("ts_text"), "event_id",
        F.col("user_id").cast("string").alias("station_id"), value_text(F.col("value")).alias("value"))
    k = F.col("event_id") % 101 if faults else F.lit(-1)
    value = (F.when(k == 3, F.lit('{"x":1}')).when(k == 5, F.lit("true")).when(k == 13, F.lit('" 12.5 "'))
             .otherwise(F.col("value")))
    sid = F.when(k == 7, F.col("station_id")).otherwise(quoted(F.col("station_id")))
    item = F.when(k == 11, F.lit('"x"')).otherwise(
        F.concat(F.lit('{"stationId":'), sid, F.lit(',"value":'), value, F.lit("}")))

    number = F.col("station_id").cast("long")
    lat, lon = F.col("latitude").cast("string"), F.col("longitude").cast("string")
    if faults:
        lat = F.when(number % 3 == 1, F.concat(F.lit('"'), lat, F.lit('"'))).otherwise(lat)
        lon = F.when(number % 50 == 7, F.lit("null")).otherwise(lon)
    station = F.concat(F.lit('{"id":'), quoted(F.col("station_id")), F.lit(',"name":'), quoted(F.col("station_name")),
                       F.lit(',"location":{"latitude":'), lat, F.lit(',"longitude":'), lon, F.lit("}}"))
    st = stations(spark, sf_dir).select("station_id", station.alias("station"))
    doc = ["metric", "date", "span"]
    readings = (e.withColumn("item", item).join(st, "station_id", "left")
                .groupBy(*doc, "ts_text").agg(
                    F.array_sort(F.collect_list(F.struct("event_id", "item"))).alias("items"),
                    F.collect_set("station").alias("stations")))
    text = F.concat(F.lit('{"timestamp":'), quoted(F.col("ts_text")), F.lit(',"data":['),
                    F.array_join(F.col("items.item"), ","), F.lit("]}"))
    if faults:
        text = F.when(F.get("items", F.lit(0))["event_id"] % 211 == 3, F.lit("7")).otherwise(text)
    days = (readings.select(*doc, "ts_text", text.alias("text"), "stations").groupBy(*doc).agg(
        F.array_sort(F.collect_list(F.struct("ts_text", "text"))).alias("readings"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("stations")))).alias("stations")))
    body = F.concat(F.lit('{"data":{"stations":['), F.array_join("stations", ","), F.lit('],"readings":['),
                    F.array_join(F.col("readings.text"), ","), F.lit("]}}"))
    if faults:
        place = (F.col("span") + F.dayofmonth("date")) % 13
        body = F.when(place == 4, F.lit("5")).when(place == 9, F.lit('{"data":"none"}')).otherwise(body)
    return days.select(*doc, body.alias("text"))
