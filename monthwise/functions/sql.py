"""Column helpers as Spark SQL expression text, for ``selectExpr`` / ``F.expr``: a whole
projection then costs one client call instead of several per column.  All are built-in
expressions (JVM side, code-generated)."""

from __future__ import annotations

import datetime as dt

# Fixed value of the public surrogate-key macro: stands for NULL; parts are joined by '-'.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def ntz(ts: dt.datetime) -> str:
    return f"TIMESTAMP_NTZ '{ts:%Y-%m-%d %H:%M:%S.%f}'"


def date(d: dt.date) -> str:
    return f"DATE '{d:%Y-%m-%d}'"


def epoch_to_ntz(c: str) -> str:
    """``to_timestamp(epoch)::timestamp_ntz`` (session time zone UTC)."""
    return f"CAST(timestamp_seconds({c}) AS TIMESTAMP_NTZ)"


def cents_to_dollars(c: str) -> str:
    """``cents / 100.0`` as an exact DECIMAL(18,2)."""
    return f"CAST(CAST({c} AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2))"


def month_of(c: str) -> str:
    """``date_trunc('month', ts)::date`` - a DATE, never a zoned timestamp."""
    return f"trunc(CAST({c} AS DATE), 'month')"


def flag(pred: str) -> str:
    """``case when pred then true else false end``: NULL becomes false."""
    return f"coalesce({pred}, false)"


def money_micros(c: str) -> str:
    """A MONEY value as its exact unscaled long (micro-units): summing longs is several
    times cheaper than summing wide decimals, where a group's sum is bounded."""
    return f"CAST({c} * 1000000 AS BIGINT)"


def micros_sum_to_money(c: str) -> str:
    """``sum`` of micro-unit longs, in DECIMAL so large totals cannot overflow."""
    return f"CAST(sum(CAST({c} AS DECIMAL(20,0))) / 1000000 AS DECIMAL(28,6))"


def surrogate_key(*cols: str) -> str:
    """md5 of the string casts joined by '-', NULL replaced by a marker."""
    parts = ", ".join(f"coalesce(CAST({c} AS STRING), '{SURROGATE_NULL}')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def json_text(document: str, key: str) -> str:
    """The value of a top-level key as text (H16); NULL for malformed documents.  Calls on one
    document share its parse.  Numbers come in their shortest form, a repeated key makes the
    document malformed."""
    return f"try_variant_get(try_parse_json({document}), '$.{key}', 'string')"
