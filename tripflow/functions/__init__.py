"""Column-expression helpers. Every helper returns a built-in Spark Column
expression, so it stays inside whole-stage codegen (no Python UDFs)."""

from tripflow.functions.exprs import (  # noqa: F401
    default_numeric,
    duration_min,
    epoch_micros,
    hash_bucket,
    hash_hex,
    micros_between,
    numeric_columns,
    row_key,
    seconds_between,
    select_existing,
    weekday_monday0,
)
