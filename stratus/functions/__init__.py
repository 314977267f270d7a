"""Column-level helpers built only from pyspark.sql.functions (JVM side)."""

from stratus.functions.columns import (  # noqa: F401
    as_sum_decimal,
    exact_avg,
    exact_sum,
    numeric_text,
    parse_value,
    round2,
    text_date,
)
