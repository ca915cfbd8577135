"""Label rules as column expressions: a CASE chain in rule order.

First match wins; a value no rule matches, and a NULL value, give NULL.
Labels are literals (never pasted into SQL text), so any character in them
is kept as it is. Predicate fragments are SQL text from the catalog and are
trusted catalog content, like the tag SQL itself.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


_NUMBER = re.compile(r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d{1,3})?")
_INTEGRAL_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def rule_text(rule_value: str | None, value_type: T.DataType) -> str | None:
    """A rule's value as text that casts exactly to the tag value's type.

    Integers and decimals compare as exact numbers: ``'01'`` and ``'1.0'`` equal
    BIGINT 1, and a rule that the type cannot hold (``'1.005'`` for two decimal
    places) is None and never matches, as is one that is no number.
    """
    bits = _INTEGRAL_BITS.get(type(value_type))
    if rule_value is None or (bits is None and not isinstance(value_type, T.DecimalType)):
        return rule_value
    text = rule_value.strip()
    if not _NUMBER.fullmatch(text):
        return None
    number = Decimal(text)
    scale = 0 if bits else value_type.scale
    # Exact in integers of the last place, so no context precision rounds it.
    sign, digits, exponent = number.as_tuple()
    units = int("".join(map(str, digits)))
    shift = exponent + scale
    if shift < 0:
        units, rest = divmod(units, 10**-shift)
        if rest:
            return None
    else:
        units *= 10**shift
    units = -units if sign else units
    if bits:
        return str(units) if -(1 << (bits - 1)) <= units < 1 << (bits - 1) else None
    if abs(units) >= 10**value_type.precision:
        return None
    return format(Decimal((sign, tuple(map(int, str(abs(units)))), -scale)), "f")


def rule_key(rule_value: str | None, value_type: T.DataType) -> Column:
    """A rule's value in the type of the tag value (see :func:`rule_text`); NULL never matches."""
    text = F.lit(rule_text(rule_value, value_type)).cast(T.StringType())
    return text if isinstance(value_type, T.StringType) else text.try_cast(value_type)


def exact_label(
    value: Column, value_type: T.DataType, rules: Sequence[tuple[str | None, str | None]]
) -> Column:
    """``CASE value WHEN rule_1 THEN label_1 ... END`` (no ELSE)."""
    expr = None
    for rule_value, label in rules:
        cond = value == rule_key(rule_value, value_type)
        label_col = F.lit(label).cast(T.StringType())
        expr = F.when(cond, label_col) if expr is None else expr.when(cond, label_col)
    return expr if expr is not None else F.lit(None).cast(T.StringType())


def predicate_label(
    value_name: str, rules: Sequence[tuple[str, str | None]]
) -> Column:
    """``CASE WHEN value <fragment_1> THEN label_1 ... END`` (no ELSE).

    A fragment is the right-hand side of a predicate on the value, e.g.
    ``between '01-20' and '02-18'`` or ``>= 3000000``.
    """
    expr = None
    for fragment, label in rules:
        cond = F.expr(f"`{value_name}` {fragment}")
        label_col = F.lit(label).cast(T.StringType())
        expr = F.when(cond, label_col) if expr is None else expr.when(cond, label_col)
    return expr if expr is not None else F.lit(None).cast(T.StringType())
