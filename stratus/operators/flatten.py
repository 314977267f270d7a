"""Nested day responses → long readings, with prefix-keep error policy.

A day response is one row: `data.readings[*].data[*]` holds the items and
`data.stations` the station dimension *of that day*.  `annotate_days` is a
per-row expression (higher-order array functions) that builds the day's
items with their reject reasons and finds the first bad one; the outputs
are one `explode` each, with the station lookup as compiled code after it.
The flatten is narrow: no shuffle, any number of partitions, work
proportional to the input.

Error policy (same as the original loop, which wrapped a whole day in one
try/except): a malformed day yields no rows; inside a day, items are
emitted in document order until the first bad item, and that item and all
after it are lost.  Here the lost part is not silent: `flatten_rejects`
returns it with the day, position and reason.

Null and absent fields cannot be told apart by a struct schema.  Null
`name` / `location` / coordinates, and coordinates that are no numbers, take
the defaults ("" and 0.0); numeric text is a coordinate; null
`timestamp`, `stationId` or `value` make the item bad.  Days read with
RAW_STRICT_SCHEMA (string maps) get the original loop's exact semantics
instead; see the strict section below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions.columns import numeric_text, parse_value, text_date, text_to_double

# Reasons attached to rejects.
DAY_MISSING_DATA = "missing_data"
DAY_MISSING_READINGS = "missing_readings"
DAY_MISSING_STATIONS = "missing_stations"
DAY_STATION_WITHOUT_ID = "station_without_id"
ITEM_MALFORMED_READING = "malformed_reading"
ITEM_MISSING_STATION_ID = "missing_station_id"
ITEM_BAD_VALUE = "bad_value"
ITEM_AFTER_BAD = "after_bad_item"


def _day_reason() -> Column:
    data = F.col("data")
    return (
        F.when(data.isNull(), F.lit(DAY_MISSING_DATA))
        .when(data["readings"].isNull(), F.lit(DAY_MISSING_READINGS))
        .when(data["stations"].isNull(), F.lit(DAY_MISSING_STATIONS))
        .when(F.exists(data["stations"], lambda s: s.isNull() | s["id"].isNull()),
              F.lit(DAY_STATION_WITHOUT_ID))
    )


def _item(ts: Column, sid: Column, raw: Column, broken: Column) -> Column:
    """One item with its reason, built in a single pass.

    The numeric-text check runs once, inside the reason.  `value` is only ever
    used for items without a reason, i.e. whose text passed that check, where
    it equals `parse_value`.
    """
    reason = (
        F.when(broken, F.lit(ITEM_MALFORMED_READING))
        .when(sid.isNull(), F.lit(ITEM_MISSING_STATION_ID))
        .when(~F.coalesce(numeric_text(raw), F.lit(False)), F.lit(ITEM_BAD_VALUE))
    )
    return F.struct(ts.alias("timestamp"), sid.alias("station_id"), raw.alias("raw_value"),
                    text_to_double(raw).alias("value"), reason.alias("reason"))


def _items() -> Column:
    """All items of a day in document order; a broken reading is one bad item."""
    def per_reading(r: Column) -> Column:
        broken = r.isNull() | r["timestamp"].isNull() | r["data"].isNull()
        return F.when(
            broken,
            F.array(_item(r["timestamp"], F.lit(None).cast("string"),
                          F.lit(None).cast("string"), F.lit(True))),
        ).otherwise(
            F.transform(r["data"], lambda i: _item(
                r["timestamp"], i["stationId"], i["value"], F.lit(False)))
        )

    return F.flatten(F.transform(F.col("data.readings"), per_reading))


def _first_bad() -> Column:
    """1-based position of the day's first item with a reason, 0 if none.

    Scans the extracted reason strings (`items.reason`), not the item
    structs, so the pass is light.
    """
    return F.array_position(
        F.transform(F.col("items.reason"), lambda r: r.isNotNull()), True).cast("int")


def _with_day_id(a: DataFrame, digest: Column) -> DataFrame:
    """Add `day_id` (a hash of the whole day) only for days that have rejects.

    Rejects need a day identity; clean rows do not.  Hashing every document
    would cost another full pass over the nested data, so good days skip it.
    """
    has_rejects = F.col("day_reason").isNotNull() | (F.col("first_bad") > 0)
    kept = [c for c in ("day_text", "origin") if c in a.columns]
    return (a.withColumn("day_id", F.when(has_rejects, digest))
            .select("metric", "source_file", "day_id", "day_reason", "st_rev", "ids_rev",
                    "items", "first_bad", *kept))


def _stations(days: DataFrame) -> Column:
    """The day's stations, coordinates read from text parsed once per station."""
    location = days.schema["data"].dataType["stations"].dataType.elementType["location"].dataType
    if location["latitude"].dataType.simpleString() != "string":
        return F.col("data.stations")
    return F.transform(F.col("data.stations"), lambda s: F.struct(
        s["id"].alias("id"), s["name"].alias("name"),
        F.struct(*[parse_value(s["location"][c]).alias(c) for c in ("latitude", "longitude")]).alias("location")))


def annotate_days(days: DataFrame) -> DataFrame:
    """Per day: id, day-level reason, items with reasons, first bad position.

    Input columns: `metric`, `source_file`, `data` (RAW_SCHEMA's struct, or
    RAW_STRICT_SCHEMA's for exact null-vs-absent semantics), or the days of
    `read_raw_variants` (exact for elements of any type).
    """
    if "day" in days.columns:
        return _annotate_variant(days)
    if _is_strict(days):
        return _annotate_strict(days)
    return _with_day_id(
        days.select(
            "metric",
            "source_file",
            "data",
            _day_reason().alias("day_reason"),
            # Stations reversed so that the first match is the last entry
            # (duplicate ids: last one wins).  Computed once per day here,
            # below the explode, and only referenced from the item lambdas.
            F.reverse(_stations(days)).alias("st_rev"),
            F.reverse(F.col("data.stations.id")).alias("ids_rev"),
            _items().alias("items"),
        )
        .withColumn("first_bad", _first_bad()),
        F.xxhash64("metric", "source_file", "data"),
    )


# ------------------------------------------------------------------ strict --
# Exact null-vs-absent semantics (raw days read with RAW_STRICT_SCHEMA):
# - a present-but-null `timestamp` or `stationId` is kept as NULL, an absent
#   one cuts the day there;
# - station `name` absent → "", present-but-null → NULL;
# - a JSON true/false value is 1.0 / 0.0, as Python's float() makes it;
# - `location` absent → coordinates 0.0; present but NULL or not an object, or
#   a coordinate present but NULL or not numeric → the item that uses that
#   station cuts the day there (reasons bad_station_location / _latitude /
#   _longitude).
ITEM_MALFORMED = "malformed_item"
STATION_BAD_LOCATION = "bad_station_location"
STATION_BAD_LATITUDE = "bad_station_latitude"
STATION_BAD_LONGITUDE = "bad_station_longitude"

_STRMAP = "map<string,string>"
# Stand-in for a JSON-null station id, so that a JSON-null stationId finds
# that station the way a dictionary keyed by None does.
_NULL_ID = "\u0000null"


def _is_strict(days: DataFrame) -> bool:
    from pyspark.sql.types import MapType
    readings = days.schema["data"].dataType["readings"].dataType
    return isinstance(readings.elementType, MapType)


def _strict_day_reason() -> Column:
    data = F.col("data")
    return (
        F.when(data.isNull(), F.lit(DAY_MISSING_DATA))
        .when(data["readings"].isNull(), F.lit(DAY_MISSING_READINGS))
        .when(data["stations"].isNull(), F.lit(DAY_MISSING_STATIONS))
        .when(F.exists(data["stations"],
                       lambda s: s.isNull() | ~F.map_contains_key(s, "id")),
              F.lit(DAY_STATION_WITHOUT_ID))
    )


def _strict_station(s: Column) -> Column:
    """Station map → id, name, location(latitude, longitude), bad."""
    return F.struct(
        s["id"].alias("id"),
        F.map_contains_key(s, "name").alias("has_name"),
        s["name"].alias("name"),
        F.map_contains_key(s, "location").alias("has_loc"),
        F.from_json(s["location"], _STRMAP).alias("loc"),
    )


def _strict_station_resolved(t: Column) -> Column:
    def coord(key: str) -> tuple[Column, Column]:
        present = F.map_contains_key(t["loc"], key)
        v = parse_value(t["loc"][key])
        value = F.when(~t["has_loc"] | ~present, F.lit(0.0)).otherwise(v)
        bad = t["has_loc"] & t["loc"].isNotNull() & present & v.isNull()
        return value, bad

    lat, lat_bad = coord("latitude")
    lon, lon_bad = coord("longitude")
    bad = (
        F.when(t["has_loc"] & t["loc"].isNull(), F.lit(STATION_BAD_LOCATION))
        .when(lat_bad, F.lit(STATION_BAD_LATITUDE))
        .when(lon_bad, F.lit(STATION_BAD_LONGITUDE))
    )
    return F.struct(
        t["id"].alias("id"),
        F.when(t["has_name"], t["name"]).otherwise(F.lit("")).alias("name"),
        F.struct(lat.alias("latitude"), lon.alias("longitude")).alias("location"),
        bad.alias("bad"),
    )


def _strict_items() -> Column:
    """All items of a day in document order, with presence-aware checks."""
    # Each reading's items are parsed twice: as string maps (key presence,
    # text of every value) and with `value` typed BOOLEAN, which is non-NULL
    # exactly for JSON true/false (a string "true" stays NULL) — the values
    # Python's float() turns into 1.0 / 0.0.
    parsed = F.transform(F.col("data.readings"), lambda r: F.struct(
        r.alias("r"), F.from_json(r["data"], f"array<{_STRMAP}>").alias("items"),
        F.from_json(r["data"], "array<struct<value: boolean>>").alias("bools")))

    def per_reading(p: Column) -> Column:
        r = p["r"]
        broken = (r.isNull() | ~F.map_contains_key(r, "timestamp")
                  | ~F.map_contains_key(r, "data") | p["items"].isNull())
        null_s = F.lit(None).cast("string")

        def item(i: Column, k: Column) -> Column:
            pre = (
                F.when(i.isNull(), F.lit(ITEM_MALFORMED))
                .when(~F.map_contains_key(i, "stationId"), F.lit(ITEM_MISSING_STATION_ID))
                .when(~F.map_contains_key(i, "value"), F.lit(ITEM_BAD_VALUE))
            )
            flag = F.get(p["bools"], k)["value"]
            value = F.when(flag.isNotNull(), flag.cast("double")).otherwise(parse_value(i["value"]))
            return F.struct(r["timestamp"].alias("timestamp"), i["stationId"].alias("station_id"),
                            i["value"].alias("raw_value"), pre.alias("pre"), value.alias("value"))

        return F.when(
            broken,
            F.array(F.struct(r["timestamp"].alias("timestamp"), null_s.alias("station_id"),
                             null_s.alias("raw_value"), F.lit(ITEM_MALFORMED_READING).alias("pre"),
                             F.lit(None).cast("double").alias("value"))),
        ).otherwise(F.transform(p["items"], lambda i, k: item(i, k)))

    return F.flatten(F.transform(parsed, per_reading))


def _annotate_strict(days: DataFrame) -> DataFrame:
    per_day = days.select(
        "metric",
        "source_file",
        "data",
        _strict_day_reason().alias("day_reason"),
        F.reverse(F.transform(F.transform("data.stations", _strict_station),
                              _strict_station_resolved)).alias("st_rev"),
        F.reverse(F.transform("data.stations", lambda s: F.coalesce(s["id"], F.lit(_NULL_ID))))
        .alias("ids_rev"),
        _strict_items().alias("raw_items"),
    )
    st_rev, ids_rev = F.col("st_rev"), F.col("ids_rev")
    with_st = F.transform("raw_items", lambda x: F.struct(
        x["timestamp"], x["station_id"], x["raw_value"], x["pre"], x["value"],
        F.get(st_rev, F.array_position(
            ids_rev, F.coalesce(x["station_id"], F.lit(_NULL_ID))).cast("int") - 1).alias("st")))

    def finish(y: Column) -> Column:
        reason = F.coalesce(
            y["pre"],
            F.when(y["value"].isNull(), F.lit(ITEM_BAD_VALUE)),
            y["st"]["bad"],
        )
        return F.struct(y["timestamp"], y["station_id"], y["raw_value"], y["value"],
                        reason.alias("reason"), y["st"].alias("st"))

    # `size(st_rev)` references the per-day arrays a second time in the same
    # expression, so Catalyst keeps them as attributes of the projection below
    # instead of inlining (and recomputing) them inside the item lambda.
    items = F.when(F.size(st_rev) + F.size(ids_rev) >= 0, F.transform(with_st, finish))
    return _with_day_id(
        per_day.select("metric", "source_file", "data", "day_reason", "st_rev", "ids_rev",
                       items.alias("items"))
        .withColumn("first_bad", _first_bad()),
        # maps cannot be hashed directly; their JSON text can
        F.xxhash64("metric", "source_file", F.to_json("data")),
    )


# ----------------------------------------------------------------- variant --
# Days of any JSON type (read_raw_variants).  Every access is checked on its
# element, as a loop over dictionaries would fail there and no earlier:
# - what isn't an object where one is needed, or isn't a list where elements are
#   taken, cuts the day from that element on (before the first item: all of it);
# - station ids are compared by type and value, so the text "108" isn't the
#   number 108, which is 108.0; lists and objects are no ids;
# - values and coordinates may be numbers, numeric texts or true / false.
DAY_UNREADABLE = "unreadable_json"
DAY_BAD_STATIONS = "malformed_stations"
DAY_BAD_READINGS = "malformed_readings"
ITEM_BAD_STATION_ID = "bad_station_id"

_LIST = "array<variant>"
_OBJECT = "map<string,variant>"


def _at(v: Column, path: str = "", kind: str = "variant") -> Column:
    """The element at `path` (dot, names) as `kind`; NULL where there is none."""
    return F.try_variant_get(v, f"${path}", kind)


def _elements(v: Column) -> Column:
    """What a loop over `v` takes, as an array; NULL if it can't be looped over.
    Of texts and objects the elements are texts, of which nothing can be got."""
    kind = F.schema_of_variant(v)
    none = F.array().cast(_LIST)
    nothing = F.array(F.parse_json(F.lit("null")))
    return F.coalesce(
        _at(v, kind=_LIST),
        F.when(v.isNull(), F.lit(None).cast(_LIST))
        .when(kind == "STRING", F.when(_at(v, kind="string") == "", none).otherwise(nothing))
        .when(kind.startswith("OBJECT"), F.when(kind == "OBJECT<>", none).otherwise(nothing)))


def _number(v: Column) -> Column:
    """The DOUBLE that float() makes of an element; NULL where it raises."""
    return F.when(F.schema_of_variant(v) == "STRING", parse_value(_at(v, kind="string"))).otherwise(
        _at(v, kind="double"))


def _id_key(v: Column) -> Column:
    """A text that is equal for ids a dictionary takes as equal; NULL if it takes none."""
    kind = F.schema_of_variant(v)
    x, whole = _at(v, kind="double"), _at(v, kind="decimal(38,0)")
    number = F.when((x == F.floor(x)) & whole.isNotNull(), whole.cast("string")).otherwise(x.cast("string"))
    return (F.when(F.is_variant_null(v), F.lit("null"))
            .when(kind == "STRING", F.concat(F.lit("text "), _at(v, kind="string")))
            .when(x.isNotNull(), F.concat(F.lit("number "), number)))


def _variant_station(s: Column) -> Column:
    name, loc = _at(s, ".name"), _at(s, ".location")
    lat, lon = _at(s, ".location.latitude"), _at(s, ".location.longitude")
    bad = (F.when(loc.isNotNull() & _at(loc, kind=_OBJECT).isNull(), F.lit(STATION_BAD_LOCATION))
           .when(lat.isNotNull() & _number(lat).isNull(), F.lit(STATION_BAD_LATITUDE))
           .when(lon.isNotNull() & _number(lon).isNull(), F.lit(STATION_BAD_LONGITUDE)))
    return F.struct(
        _id_key(_at(s, ".id")).alias("id"),
        F.when(name.isNull(), F.lit("")).otherwise(_at(name, kind="string")).alias("name"),
        F.struct(F.when(lat.isNull(), F.lit(0.0)).otherwise(_number(lat)).alias("latitude"),
                 F.when(lon.isNull(), F.lit(0.0)).otherwise(_number(lon)).alias("longitude")).alias("location"),
        bad.alias("bad"))


def _variant_items(readings: Column) -> Column:
    null_s, null_d = F.lit(None).cast("string"), F.lit(None).cast("double")

    def item(r: Column, i: Column) -> Column:
        sid, raw = _at(i, ".stationId"), _at(i, ".value")
        value, key = _number(raw), _id_key(sid)
        pre = (F.when(sid.isNull(), F.when(_at(i, kind=_OBJECT).isNull(), F.lit(ITEM_MALFORMED))
                      .otherwise(F.lit(ITEM_MISSING_STATION_ID)))
               .when(raw.isNull() | value.isNull(), F.lit(ITEM_BAD_VALUE))
               .when(key.isNull(), F.lit(ITEM_BAD_STATION_ID)))
        return F.struct(_at(r["r"], ".timestamp", "string").alias("timestamp"), _at(sid, kind="string").alias("station_id"),
                        _at(raw, kind="string").alias("raw_value"), pre.alias("pre"), value.alias("value"), key.alias("key"))

    def per_reading(r: Column) -> Column:
        broken = _at(r["r"], ".timestamp").isNull() | r["items"].isNull()
        return F.when(broken, F.array(F.struct(
            _at(r["r"], ".timestamp", "string").alias("timestamp"), null_s.alias("station_id"), null_s.alias("raw_value"),
            F.lit(ITEM_MALFORMED_READING).alias("pre"), null_d.alias("value"), null_s.alias("key"),
        ))).otherwise(F.transform(r["items"], lambda i: item(r, i)))

    return F.flatten(F.transform(
        F.transform(readings, lambda r: F.struct(r.alias("r"), _elements(_at(r, ".data")).alias("items"))), per_reading))


def _annotate_variant(days: DataFrame) -> DataFrame:
    day = F.col("day")
    readings, stations = F.col("readings"), F.col("stations")
    reason = (
        F.when(F.col("day_text").isNotNull(), F.lit(DAY_UNREADABLE))
        .when(_at(day, ".data").isNull(), F.lit(DAY_MISSING_DATA))
        .when(_at(day, ".data.readings").isNull(), F.lit(DAY_MISSING_READINGS))
        .when(_at(day, ".data.stations").isNull(), F.lit(DAY_MISSING_STATIONS))
        .when(stations.isNull(), F.lit(DAY_BAD_STATIONS))
        .when(F.exists(stations, lambda s: _id_key(_at(s, ".id")).isNull()), F.lit(DAY_STATION_WITHOUT_ID))
        .when(readings.isNull(), F.lit(DAY_BAD_READINGS)))
    origin = [c for c in ("origin",) if c in days.columns]
    per_day = (
        days.select("metric", "source_file", "place", "day", "day_text", *origin,
                    _elements(_at(day, ".data.readings")).alias("readings"),
                    _elements(_at(day, ".data.stations")).alias("stations"))
        .select("metric", "source_file", "place", "day", "day_text", *origin, reason.alias("day_reason"),
                F.reverse(F.transform(stations, _variant_station)).alias("st_rev"),
                _variant_items(readings).alias("raw_items"))
        .withColumn("ids_rev", F.col("st_rev.id")))
    st_rev, ids_rev = F.col("st_rev"), F.col("ids_rev")
    with_st = F.transform("raw_items", lambda x: F.struct(
        x["timestamp"], x["station_id"], x["raw_value"], x["pre"], x["value"],
        F.get(st_rev, F.array_position(ids_rev, x["key"]).cast("int") - 1).alias("st")))
    finished = F.transform(with_st, lambda y: F.struct(
        y["timestamp"], y["station_id"], y["raw_value"], y["value"],
        F.coalesce(y["pre"], y["st"]["bad"]).alias("reason"), y["st"].alias("st")))
    # As in the strict form: the sizes keep the per-day arrays attributes below.
    items = F.when(F.size(st_rev) + F.size(ids_rev) >= 0, finished)
    annotated = per_day.withColumn("items", items).withColumn("first_bad", _first_bad())
    rejected = F.col("day_reason").isNotNull()
    return _with_day_id(
        annotated.withColumn("day_text", F.when(rejected, F.coalesce("day_text", F.to_json("day")))),
        F.xxhash64("metric", "place", F.coalesce("day_text", F.to_json("day"))))


def flatten_readings(days: DataFrame) -> DataFrame:
    """Clean long readings (CLEAN_SCHEMA) of the kept prefix of every good day."""
    return readings_of(annotate_days(days))


def flatten_rejects(days: DataFrame) -> DataFrame:
    """Everything the prefix-keep flatten drops, with position and reason.

    One row per malformed day (position NULL) and one row per lost item
    (1-based position among the day's items).  The first bad item carries
    its own reason; items lost after it carry `after_bad_item` unless they
    are bad themselves.
    """
    return rejects_of(annotate_days(days))


def _kept() -> Column:
    """The day's kept prefix; NULL for a malformed day (explode: no rows)."""
    start = F.col("first_bad")
    return F.when(
        F.col("day_reason").isNull(),
        F.when(start == 0, F.col("items")).otherwise(F.slice("items", 1, start - 1)),
    )


def _lost(a: DataFrame) -> Column:
    """The day's rejected part, as item structs (the element type of `items`).

    One placeholder item for a malformed day (its reason is the day's);
    otherwise the suffix from the first bad item on, where an item lost only
    because of an earlier one gets `after_bad_item`.  NULL when nothing was
    rejected.  The transform runs over rejected items only.
    """
    fields = a.schema["items"].dataType.elementType.fields
    start = F.col("first_bad")
    lost = F.slice("items", start, F.size("items") - start + 1)

    def fix(x: Column) -> Column:
        return F.struct(*[
            (F.coalesce(x["reason"], F.lit(ITEM_AFTER_BAD)) if f.name == "reason" else x[f.name])
            .alias(f.name) for f in fields])

    known = {"reason": F.col("day_reason")}
    if "day_text" in a.columns:                # the rejected day's own text
        known["raw_value"] = F.col("day_text")
    day = F.array(F.struct(*[known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in fields]))
    return F.when(F.col("day_reason").isNotNull(), day).when(start > 0, F.transform(lost, fix))


def _station_values(st: Column, strict: bool = False) -> dict[str, Column]:
    """Station attributes of a looked-up station struct, defaults when absent.

    Strict stations are already resolved (absent name → "", absent
    coordinates → 0.0, a present NULL name stays NULL); only a station that
    is not found takes the defaults.
    """
    if strict:
        missing = st.isNull()
        return {
            "station_name": F.when(missing, F.lit("")).otherwise(st["name"]),
            "latitude": F.when(missing, F.lit(0.0)).otherwise(st["location"]["latitude"]),
            "longitude": F.when(missing, F.lit(0.0)).otherwise(st["location"]["longitude"]),
        }
    return {
        "station_name": F.coalesce(st["name"], F.lit("")),
        "latitude": F.coalesce(st["location"]["latitude"], F.lit(0.0)),
        "longitude": F.coalesce(st["location"]["longitude"], F.lit(0.0)),
    }


def _strict_items_of(a: DataFrame) -> bool:
    """Strict annotations carry each item's resolved station (`st`)."""
    return "st" in a.schema["items"].dataType.elementType.fieldNames()


def _with_station(df: DataFrame, x: Column, strict: bool, when: Column | None = None) -> DataFrame:
    """Add `st`, the item's station, to exploded item rows.

    Strict items carry their resolved station.  Otherwise the day's station
    arrays travel with each row and the lookup is compiled code after the
    explode: the position is its own column (computed once), then read with
    the 0-based, null-safe `get`.
    """
    if strict:
        return df.withColumn("st", x["st"])
    pos = F.array_position(F.col("ids_rev"), x["station_id"]).cast("int")
    if when is not None:
        pos = F.when(when, pos)
    return (df.withColumn("_pos", pos)
              .withColumn("st", F.get(F.col("st_rev"), F.col("_pos") - 1)))


def readings_of(a: DataFrame) -> DataFrame:
    """Clean readings from `annotate_days` output (one explode, no shuffle)."""
    strict = _strict_items_of(a)
    x = F.col("x")
    rows = _with_station(a.select("metric", "st_rev", "ids_rev", F.explode(_kept()).alias("x")),
                         x, strict)
    return rows.select(
        "metric",
        text_date(x["timestamp"]).alias("date"),
        x["timestamp"].alias("timestamp"),
        x["station_id"].alias("station_id"),
        *[c.alias(name) for name, c in _station_values(F.col("st"), strict).items()],
        x["value"].alias("value"),
    )


def rejects_of(a: DataFrame) -> DataFrame:
    """Rejects from `annotate_days` output (one explode over rejected items).

    Days without rejects give no rows: their `_lost` is NULL.  No filter says so
    before, as Spark would move it below the projections and build the day's
    stations in it once per item.
    """
    x = F.col("x")
    position = F.when(F.col("day_reason").isNull(), F.col("first_bad") + F.col("i"))
    return (
        a.select("metric", "source_file", "day_id", "day_reason", "first_bad",
                F.posexplode(_lost(a)).alias("i", "x"))
        .select("metric", "source_file", "day_id", position.cast("int").alias("position"),
                x["timestamp"].alias("timestamp"), x["station_id"].alias("station_id"),
                x["raw_value"].alias("raw_value"), x["reason"].alias("reason"))
    )


KIND_READINGS = "readings"
KIND_REJECTS = "rejects"


def split_of(a: DataFrame) -> DataFrame:
    """Clean readings and rejects of `annotate_days` output as ONE DataFrame.

    Each day's kept items and rejected items are one array and one
    `posexplode`: the position in it tells a reading from a reject, so a
    single job over the raw input writes both — no second parse, no
    persisted copy of the input, and no per-item pass on the good path.
    Columns: kind, the clean columns, then source_file, day_id, position,
    raw_value, reason (NULL where they do not apply to the kind), and `origin`
    where the days have it.
    """
    strict = _strict_items_of(a)
    origin = [c for c in ("origin",) if c in a.columns]
    kept = _kept()
    n_kept = F.when(kept.isNull(), F.lit(0)).otherwise(F.size(kept))
    rows = F.flatten(F.array_compact(F.array(kept, _lost(a))))
    exploded = a.select("metric", "source_file", "day_id", "day_reason", "first_bad",
                        "st_rev", "ids_rev", *origin, n_kept.alias("n_kept"),
                        F.posexplode(rows).alias("i", "x"))
    is_reading = F.col("i") < F.col("n_kept")
    x = F.col("x")
    position = F.when(~is_reading & F.col("day_reason").isNull(),
                      F.col("first_bad") + F.col("i") - F.col("n_kept"))
    return _with_station(exploded, x, strict, when=is_reading).select(
        F.when(is_reading, F.lit(KIND_READINGS)).otherwise(F.lit(KIND_REJECTS)).alias("kind"),
        "metric",
        text_date(x["timestamp"]).alias("date"),
        x["timestamp"].alias("timestamp"),
        x["station_id"].alias("station_id"),
        *[F.when(is_reading, c).alias(name)
          for name, c in _station_values(F.col("st"), strict).items()],
        F.when(is_reading, x["value"]).alias("value"),
        F.when(~is_reading, F.col("source_file")).alias("source_file"),
        F.when(~is_reading, F.col("day_id")).alias("day_id"),
        position.cast("int").alias("position"),
        F.when(~is_reading, x["raw_value"]).alias("raw_value"),
        F.when(~is_reading, x["reason"]).alias("reason"),
        *origin,
    )
