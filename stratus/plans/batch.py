"""The whole batch run: raw day responses → clean / rejects → curated.

    python -m stratus.plans.batch --raw <raw dir or files> --root <lake root> [--ndjson]

Each stage is one Spark job over the layer before it, written to the lake;
nothing passes through the driver.  Curated tables are written as Parquet
(daily_temp partitioned by date) plus a CSV export, together with this
run's quality report (per metric) and rejects report (per metric, reason).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from stratus.operators import quality
from stratus.plans import curated as C
from stratus.sinks import lake
from stratus.sources.raw_json import read_raw_days, read_raw_variants, spread_days
from stratus.streaming import rollups

PARTITIONING = {"daily_temp": ["date"]}


def run_batch(spark: SparkSession, raw: str | list[str], root: str,
              multiline: bool = True, strict: bool = False, exact: bool = False,
              on_unreadable: str = "keep") -> dict[str, str]:
    """`exact` reads days as they are, of any JSON type (read_raw_variants);
    `on_unreadable` is its choice for files that aren't JSON."""
    if exact:
        days = read_raw_variants(spark, raw, multiline, on_unreadable)
    else:
        days = read_raw_days(spark, raw, multiline=multiline, strict=strict)
    if multiline:                 # one task per file: spread the flatten
        days = spread_days(days)
    clean_path, rejects_path = lake.ingest_clean(spark, days, root)
    clean = lake.read_clean(spark, clean_path)
    out = {"clean": clean_path, "rejects": rejects_path}
    # Temperature is scanned once: both temperature tables follow from the
    # stored per-(date, station) partials.
    by_station = C.temperature_partials(clean)
    partials = lake.layer_path(root, lake.CURATED, "_temperature_partials")
    rollups.drop(spark, partials)          # of an incremental run on this lake
    lake.write_parquet(by_station, partials, ["date"])
    stored = lake.read_parquet(spark, partials, by_station.columns, by_station.schema)
    tables = {
        "daily_temp": C.daily_temp_from_partials(stored, ordered=False),
        "hottest_stations": C.hottest_from_partials(stored),
        "rainiest_days": C.rainiest_days(clean, ordered=False),
        "daily_humidity": C.daily_humidity(clean, ordered=False),
        # data-quality reports of this run, next to the tables they describe
        "quality_report": quality.quality_report(clean),
        "rejects_report": quality.rejects_report(lake.read_rejects(spark, rejects_path)),
    }
    order = {name: C.ORDER[name]() for name in tables if name in C.ORDER}
    for name, (pq, csv) in lake.publish_curated_all(tables, root, PARTITIONING, order).items():
        out[name] = pq
        out[f"{name}_csv"] = csv
    return out


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--raw", required=True, nargs="+")
    p.add_argument("--root", required=True)
    p.add_argument("--ndjson", action="store_true", help="one day response per line")
    p.add_argument("--strict", action="store_true",
                   help="tell present-but-null fields from absent ones, as the original loop did")
    p.add_argument("--exact", action="store_true",
                   help="read days of any JSON type; an element of the wrong type cuts only from itself on")
    p.add_argument("--fail-unreadable", action="store_true", help="with --exact: stop at a file that isn't JSON")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("stratus-batch").getOrCreate()
    for k, v in run_batch(spark, a.raw, a.root, multiline=not a.ndjson, strict=a.strict, exact=a.exact,
                          on_unreadable="fail" if a.fail_unreadable else "keep").items():
        print(f"{k}\t{v}")


if __name__ == "__main__":
    main()
