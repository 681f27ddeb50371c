"""Scalar column expressions (all built-in, JVM-side, codegen'd)."""

from emporia.functions.dates import (  # noqa: F401
    date_key, date_parts, date_series, elapsed_days, parse_timestamp,
)
from emporia.functions.money import amount, exact_sum, sum_partials, sum_parts  # noqa: F401
