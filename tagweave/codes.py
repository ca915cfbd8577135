"""Catalog codes, the types they stand for, and fixed table names."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import types as T

# --- Fixed values (must equal the reference's for the same results) -------
# tag_value_type codes: 1 = long, 2 = decimal, 3 = string, 4 = date
TYPE_LONG = "1"
TYPE_DECIMAL = "2"
TYPE_STRING = "3"
TYPE_DATE = "4"
# task_status of an enabled task
TASK_ENABLED = "1"
# token replaced by the execute date in a stored tag SQL
DATE_TOKEN = "executeDate"
# the one tag code whose rules are SQL predicates (zodiac sign by MM-dd)
PREDICATE_TAG_CODE = "TAG_PERSON_BASE_CONS"
# name prefix of the dated wide table
WIDE_TABLE_PREFIX = "user_tag_merge_"
# bitmap table per value type code
BITMAP_TABLES = {
    TYPE_STRING: "user_tag_value_string",
    TYPE_DECIMAL: "user_tag_value_decimal",
    TYPE_LONG: "user_tag_value_long",
    TYPE_DATE: "user_tag_value_date",
}
# --------------------------------------------------------------------------

# Spark type of ``query_value`` per code (a date tag stores yyyy-MM-dd text).
VALUE_TYPES: dict[str, T.DataType] = {
    TYPE_LONG: T.LongType(),
    TYPE_DECIMAL: T.DecimalType(16, 2),
    TYPE_STRING: T.StringType(),
    TYPE_DATE: T.StringType(),
}

MATCH_EXACT = "exact"
MATCH_PREDICATE = "predicate"

_DATE_RE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")


class CatalogError(ValueError):
    """Bad or missing catalog content (unknown type code, no such task...)."""


def value_type(code: str | None) -> T.DataType:
    """Spark type for a ``tag_value_type`` code; unknown codes are an error."""
    try:
        return VALUE_TYPES[str(code)]
    except KeyError:
        raise CatalogError(f"unknown tag_value_type code {code!r}") from None


def bitmap_table(code: str | None) -> str:
    try:
        return BITMAP_TABLES[str(code)]
    except KeyError:
        raise CatalogError(f"unknown tag_value_type code {code!r}") from None


def check_date(execute_date: str) -> str:
    """Execute dates are pasted into SQL text and paths: allow real yyyy-MM-dd dates only."""
    if not isinstance(execute_date, str) or not _DATE_RE.fullmatch(execute_date):
        raise ValueError(f"execute date must be yyyy-MM-dd, got {execute_date!r}")
    datetime.date.fromisoformat(execute_date)
    return execute_date


def table_suffix(execute_date: str) -> str:
    """``2024-01-15`` -> ``20240115``."""
    return check_date(execute_date).replace("-", "")


def wide_table_name(execute_date: str) -> str:
    return WIDE_TABLE_PREFIX + table_suffix(execute_date)
