"""A composable filter language over JSON metadata and labels.

A filter is a small immutable tree; ``column(filter)`` turns it into one
Spark ``Column`` so that Catalyst places it.  Conditions are three-valued
as in SQL: a comparison on a missing key is NULL and selects nothing, except
``Ne``, which holds for a missing key.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from typing import Any, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from trawl.functions.properties import text_value, typed_value


class Filter:
    """Base of all filters; ``&``, ``|`` and ``~`` combine them."""

    def __and__(self, other: "Filter") -> "Filter":
        return And((self, other))

    def __or__(self, other: "Filter") -> "Filter":
        return Or((self, other))

    def __invert__(self) -> "Filter":
        return Not(self)


@dataclass(frozen=True)
class Eq(Filter):
    """The metadata contains ``key`` with exactly this typed JSON value."""

    key: str
    value: Any


@dataclass(frozen=True)
class Ne(Filter):
    """Not ``Eq``: a missing key passes, missing metadata does not."""

    key: str
    value: Any


@dataclass(frozen=True)
class Gt(Filter):
    key: str
    value: float


@dataclass(frozen=True)
class Gte(Filter):
    key: str
    value: float


@dataclass(frozen=True)
class Lt(Filter):
    key: str
    value: float


@dataclass(frozen=True)
class Lte(Filter):
    key: str
    value: float


@dataclass(frozen=True)
class In(Filter):
    key: str
    values: Sequence[str]


@dataclass(frozen=True)
class Nin(Filter):
    """Not in the list; unlike ``Ne`` a missing key does not pass."""

    key: str
    values: Sequence[str]


@dataclass(frozen=True)
class Contains(Filter):
    key: str
    value: str


@dataclass(frozen=True)
class ContainsIgnoreCase(Filter):
    key: str
    value: str


@dataclass(frozen=True)
class EqIgnoreCase(Filter):
    key: str
    value: str


@dataclass(frozen=True)
class StartsWith(Filter):
    key: str
    value: str


@dataclass(frozen=True)
class EndsWith(Filter):
    key: str
    value: str


@dataclass(frozen=True)
class Like(Filter):
    """A case-sensitive regular expression found anywhere in the value."""

    key: str
    pattern: str


@dataclass(frozen=True)
class And(Filter):
    filters: Sequence[Filter]


@dataclass(frozen=True)
class Or(Filter):
    filters: Sequence[Filter]


@dataclass(frozen=True)
class Not(Filter):
    filter: Filter


@dataclass(frozen=True)
class HasAnyLabel(Filter):
    labels: Sequence[str]


_NUMBER_TYPES = r"^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|FLOAT|DOUBLE)"


def _json_equals(value: Column, expected: Any) -> Column:
    """Typed containment of ``expected`` in a VARIANT value."""
    kind = F.schema_of_variant(value)
    if expected is None:
        return kind == "VOID"
    if isinstance(expected, bool):
        return (kind == "BOOLEAN") & (F.try_variant_get(value, "$", "boolean") == F.lit(expected))
    if isinstance(expected, (int, float, Decimal)):
        if isinstance(expected, int) and abs(expected) >= 2**53:
            same = F.try_variant_get(value, "$", "decimal(38,0)") == F.lit(str(expected)).cast("decimal(38,0)")
            return kind.rlike(r"^(BIGINT|DECIMAL\(\d+,0\))") & same
        return kind.rlike(_NUMBER_TYPES) & (
            F.try_variant_get(value, "$", "double") == F.lit(float(expected))
        )
    if isinstance(expected, str):
        return (kind == "STRING") & (F.try_variant_get(value, "$", "string") == F.lit(expected))
    if isinstance(expected, dict):
        members = F.try_variant_get(value, "$", "map<string,variant>")
        return reduce(
            lambda a, b: a & b,
            [
                F.coalesce(_json_equals(F.try_element_at(members, F.lit(k)), v), F.lit(False))
                for k, v in expected.items()
            ],
            kind.startswith("OBJECT"),
        )
    if isinstance(expected, (list, tuple)):
        items = F.try_variant_get(value, "$", "array<variant>")

        def held(v: Any) -> Column:
            some = F.exists(items, lambda item: F.coalesce(_json_equals(item, v), F.lit(False)))
            return F.coalesce(some, F.lit(False))

        return reduce(lambda a, b: a & b, map(held, expected), kind.startswith("ARRAY"))
    raise TypeError(f"no JSON form for a filter value of type {type(expected).__name__}")


def _contained(metadata: Column, key: str, value: Any) -> Column:
    found = F.coalesce(_json_equals(typed_value(metadata, key), value), F.lit(False))
    return F.when(metadata.isNotNull(), found)


def _compared(metadata: Column, key: str, value: Any, strict: bool, how: Callable[[Column, Column], Column]) -> Column:
    """A numeric comparison: whole numbers of up to 38 digits and decimals of
    up to 20 + 18 digits exactly, all others as doubles."""
    text = F.trim(text_value(metadata, key))
    number = text.cast("double") if strict else text.try_cast("double")
    found = how(number, F.lit(float(value)))
    exact = Decimal(str(value))
    if not exact.is_finite():
        return found

    def as_decimal(kind: str, shape: str) -> None:
        nonlocal found
        here = how(text.try_cast(kind), F.lit(format(exact, "f")).cast(kind))
        found = F.when(text.rlike(shape), here).otherwise(found)

    if abs(exact) < 10**20 and -exact.as_tuple().exponent <= 18:
        as_decimal("decimal(38,18)", r"^[-+]?\d{1,20}(\.\d{1,18})?$")
    if abs(exact) < 10**38 and exact == exact.to_integral_value():
        as_decimal("decimal(38,0)", r"^[-+]?\d{1,38}$")
    return found


def _strings(values: Sequence[str]) -> list[str]:
    if not all(isinstance(v, str) for v in values):
        raise TypeError("list filters compare text; give strings")
    return list(values)


def _has(text: Column, part: str, before: bool, after: bool, wildcards: bool) -> Column:
    """LIKE-style search; ``%`` and ``_`` are plain characters by default."""
    if wildcards:
        return text.like(("%" if before else "") + part + ("%" if after else ""))
    if before and after:
        return text.contains(part)
    return text.endswith(part) if before else text.startswith(part)


def column(
    node: Filter,
    metadata: Column | None = None,
    labels: Column | None = None,
    *,
    strict_numbers: bool = False,
    wildcards: bool = False,
) -> Column:
    """The filter tree as one boolean column.

    ``strict_numbers`` raises on a non-number in a numeric comparison instead
    of not selecting it; ``wildcards`` gives ``%`` and ``_`` their LIKE meaning.
    """
    metadata = F.col("metadata") if metadata is None else metadata
    labels = F.col("labels") if labels is None else labels

    def build(f: Filter) -> Column:
        match f:
            case Eq(key, value):
                return _contained(metadata, key, value)
            case Ne(key, value):
                return ~_contained(metadata, key, value)
            case Gt(key, value):
                return _compared(metadata, key, value, strict_numbers, operator.gt)
            case Gte(key, value):
                return _compared(metadata, key, value, strict_numbers, operator.ge)
            case Lt(key, value):
                return _compared(metadata, key, value, strict_numbers, operator.lt)
            case Lte(key, value):
                return _compared(metadata, key, value, strict_numbers, operator.le)
            case In(key, values):
                return text_value(metadata, key).isin(_strings(values))
            case Nin(key, values):
                return ~text_value(metadata, key).isin(_strings(values))
            case Contains(key, value):
                return _has(text_value(metadata, key), value, True, True, wildcards)
            case ContainsIgnoreCase(key, value):
                return _has(F.lower(text_value(metadata, key)), value.lower(), True, True, wildcards)
            case EqIgnoreCase(key, value):
                return F.lower(text_value(metadata, key)) == F.lit(value.lower())
            case StartsWith(key, value):
                return _has(text_value(metadata, key), value, False, True, wildcards)
            case EndsWith(key, value):
                return _has(text_value(metadata, key), value, True, False, wildcards)
            case Like(key, pattern):
                return text_value(metadata, key).rlike(pattern)
            case And(parts):
                return reduce(lambda a, b: a & b, [build(p) for p in parts], F.lit(True))
            case Or(parts):
                return reduce(lambda a, b: a | b, [build(p) for p in parts], F.lit(False))
            case Not(inner):
                return ~build(inner)
            case HasAnyLabel(wanted):
                return F.arrays_overlap(labels, F.array(*[F.lit(w) for w in wanted]).cast("array<string>"))
        raise TypeError(f"unsupported filter: {type(f).__name__}")

    return build(node)


def combine(
    metadata_filter: Filter | None = None, entity_filter: Filter | None = None, **options
) -> Column:
    """Both filters as one condition; no filter selects every row."""
    parts = [column(f, **options) for f in (metadata_filter, entity_filter) if f is not None]
    return reduce(lambda a, b: a & b, parts, F.lit(True))
