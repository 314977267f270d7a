"""stratus: station-readings analytics expressed as Spark DataFrame / SQL plans.

Layers:
  sources/    raw JSON day responses, the given parquet tables
  operators/  flatten, station lookup, casting, dedup, null policy, quality
  functions/  column-level helpers (exact rounding, text dates)
  plans/      curated tables (DataFrame and SQL forms)
  sinks/      lake layout, parquet / csv writers, file manifest
  streaming/  incremental ingest whose results equal the batch run
"""

from stratus.schemas import CLEAN_SCHEMA, METRICS, RAW_SCHEMA  # noqa: F401
