"""Range rules as a lookup: disjoint intervals, found by halving.

A CASE chain tests a value against one rule after another. Where many rules are
ranges (``between``, ``=``, ``<``, ``<=``, ``>``, ``>=`` with plain literals), they are
flattened once, on the driver: the literals cut the value's line into points and
gaps, each belongs to the first rule that covers it, equal neighbours are joined. A value
then takes about log2(intervals) comparisons with a constant sorted array. Other
fragments stay a CASE chain; of the two the rule that comes first wins.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from decimal import Decimal
from heapq import heappop, heappush

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fewer range rules stay a CASE chain.
MIN_RANGES = 16

_LITERAL = r"('[^'\\]*'|[+-]?\d+(?:\.\d+)?)"
_BETWEEN = re.compile(rf"\s*between\s+{_LITERAL}\s+and\s+{_LITERAL}\s*", re.IGNORECASE)
_COMPARE = re.compile(rf"\s*(<=|>=|<|>|=)\s*{_LITERAL}\s*")


def parse_range(fragment: str | None, value_type: T.DataType):
    """((low, open), (high, open)) of a range fragment, None for a missing end; None if it is no such fragment.

    Ends are (key, literal): keys order as Spark orders values of the type.
    """
    text = isinstance(value_type, T.StringType)
    if not text and not isinstance(value_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
        return None

    def end(literal: str):
        if literal.startswith("'") != text:
            return None  # compared after a cast: left to Spark
        return (literal[1:-1].encode() if text else Decimal(literal)), literal

    if m := _BETWEEN.fullmatch(fragment or ""):
        low, high = end(m[1]), end(m[2])
        return ((low, False), (high, False)) if low and high else None
    m = _COMPARE.fullmatch(fragment or "")
    at = end(m[2]) if m else None
    if at is None:
        return None
    return {
        "=": ((at, False), (at, False)), "<": (None, (at, True)), "<=": (None, (at, False)),
        ">": ((at, True), None), ">=": ((at, False), None),
    }[m[1]]


def flatten(ranges: Sequence[tuple[int, tuple]]) -> list[tuple[tuple | None, int | None]]:
    """[(start, rule)]: from each start to the next the first covering rule (None: none).

    ``ranges``: (rule, parsed range). A start is None (from below) or (literal, whether the
    literal itself is left out).
    """
    points = sorted({e[0] for _, r in ranges for e in r if e}, key=lambda x: x[0])
    literal = {}
    for key, text in points:
        literal.setdefault(key, text)
    keys = sorted(literal)
    # Segments: 0 below the first point, then point, gap, point, gap...
    place = {k: 2 * i + 1 for i, k in enumerate(keys)}
    begin: dict[int, list] = {}
    for rule, (low, high) in ranges:
        a = 0 if low is None else place[low[0][0]] + low[1]
        b = 2 * len(keys) if high is None else place[high[0][0]] - high[1]
        if a <= b:
            begin.setdefault(a, []).append((rule, b))
    out, live = [], []
    for segment in range(2 * len(keys) + 1):
        for item in begin.get(segment, ()):
            heappush(live, item)
        while live and live[0][1] < segment:
            heappop(live)
        rule = live[0][0] if live else None
        if not out or out[-1][1] != rule:
            start = None if segment == 0 else (literal[keys[(segment - 1) // 2]], segment % 2 == 0)
            out.append((start, rule))
    return out


def _key_type(value_type: T.DataType, keys: Sequence) -> T.DataType | None:
    """A type that holds the value and all literals exactly, or None."""
    if isinstance(value_type, T.StringType):
        return value_type
    own = (value_type.precision, value_type.scale) if isinstance(value_type, T.DecimalType) else (19, 0)
    scale = max(own[1], *(max(0, -k.as_tuple().exponent) for k in keys))
    whole = max(own[0] - own[1], *(len(str(abs(int(k)))) for k in keys))
    return T.DecimalType(scale + whole, scale) if scale + whole <= 38 else None


def _find(value: Column, key_type: T.DataType, intervals: list) -> Column:
    """Index of the interval a value is in: how many starts it has reached."""
    kind = key_type.simpleString()
    starts = [start for start, _ in intervals[1:]]
    # A start that leaves its literal out lies just above it.
    items = ", ".join(f"struct(cast({literal} as {kind}) as k, {int(left_out)} as above)" for literal, left_out in starts)
    array = F.expr(f"array({items})")
    own = F.struct(value.cast(key_type).alias("k"), F.lit(0).alias("above"))
    steps = F.expr(f"array({', '.join(str(1 << i) for i in reversed(range(len(starts).bit_length())))})")

    def halve(at: Column, step: Column) -> Column:
        reached = F.coalesce(F.get(array, at + step - 1) <= own, F.lit(False))
        return F.when(reached, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), halve)


def interval_label(name: str, value_type: T.DataType, rules: Sequence[tuple[str | None, str | None]]) -> Column | None:
    """The label of the first rule whose fragment holds, or None where a CASE chain does as well."""
    parsed = [(i, parse_range(fragment, value_type)) for i, (fragment, _) in enumerate(rules)]
    ranges = [(i, r) for i, r in parsed if r]
    if len(ranges) < MIN_RANGES:
        return None
    key_type = _key_type(value_type, [e[0][0] for _, r in ranges for e in r if e])
    intervals = flatten(ranges)
    if key_type is None or len(intervals) < 2:
        return None
    owner = F.expr(f"array({', '.join('cast(null as int)' if rule is None else str(rule) for _, rule in intervals)})")
    found = F.when(F.col(name).isNotNull(), F.get(owner, _find(F.col(name), key_type, intervals)))
    others = None
    for i, r in parsed:
        if r is None:
            condition = F.expr(f"`{name}` {rules[i][0]}")
            others = F.when(condition, F.lit(i)) if others is None else others.when(condition, F.lit(i))
    first = found if others is None else F.least(found, others)
    labels = F.array(*[F.lit(label).cast("string") for _, label in rules])
    return F.get(labels, first)
