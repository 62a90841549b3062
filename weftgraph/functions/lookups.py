"""Keyword lookups and boolean trees, turned into Spark columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Lookup:
    """``path`` (relationship names), property, operator and value of one keyword."""

    path: tuple[str, ...]
    on_edge: bool
    prop: str
    op: str
    value: Any


def _equals(c: Column, v: Any) -> Column:
    return c == v


def _lowered(method: str) -> Callable[[Column, Any], Column]:
    return lambda c, v: getattr(F.lower(c), method)(F.lower(F.lit(v)))


OPERATORS: dict[str, Callable[[Column, Any], Column]] = {
    "exact": _equals,
    "ne": lambda c, v: c != v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "in": None,  # needs the column type, see lookup_column
    "isnull": None,
    # whole-string match; \z instead of $, which would accept a final newline
    "regex": lambda c, v: c.rlike(rf"\A(?:{v})\z"),
    "iregex": lambda c, v: c.rlike(rf"(?i)\A(?:{v})\z"),
    "iexact": lambda c, v: F.lower(c) == F.lower(F.lit(v)),
    "contains": lambda c, v: c.contains(F.lit(v)),
    "icontains": _lowered("contains"),
    "startswith": lambda c, v: c.startswith(F.lit(v)),
    "istartswith": _lowered("startswith"),
    "endswith": lambda c, v: c.endswith(F.lit(v)),
    "iendswith": _lowered("endswith"),
}


def split_path(path: str) -> tuple[str, ...]:
    return tuple(re.split(r"__|\|", path))


def parse_lookup(key: str, value: Any) -> Lookup:
    on_edge = "|" in key
    if on_edge:
        front, back = key.rsplit("|", 1)
        path, words = split_path(front), back.split("__")
    else:
        path, words = (), key.split("__")
    op = words.pop() if len(words) > 1 and words[-1] in OPERATORS else "exact"
    prop = words.pop()
    if not on_edge:
        path = tuple(words)
    elif words:
        raise ValueError(f"cannot read the lookup {key!r}")
    if op == "in" and not isinstance(value, (list, tuple)):
        raise ValueError(f"{key} takes a list of values, not {value!r}")
    if op == "isnull" and not isinstance(value, bool):
        raise ValueError(f"{key} takes True or False, not {value!r}")
    return Lookup(path, on_edge, prop, op, value)


def _constant(value: Any, dtype: T.DataType) -> Column:
    # date and time constants take the type of the column, so that the comparison
    # needs no cast of the column and can be pushed into the scan
    lit = F.lit(value)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return lit.cast(dtype)
    return lit


def lookup_column(column: Column, dtype: T.DataType, lookup: Lookup) -> Column:
    op, value = lookup.op, lookup.value
    if op == "isnull":
        return column.isNull() if value else column.isNotNull()
    if op == "in":
        if isinstance(dtype, T.ArrayType):
            wanted = F.array(*[F.lit(v) for v in value]).cast(dtype)
            return F.arrays_overlap(column, wanted)
        return column.isin([_constant(v, dtype) for v in value])
    if op in ("exact", "ne", "lt", "lte", "gt", "gte"):
        return OPERATORS[op](column, _constant(value, dtype))
    return OPERATORS[op](column, value)


class Q:
    """A boolean tree of lookups. Combine with ``&``, ``|`` and ``~``."""

    def __init__(self, *parts: Any, **lookups: Any):
        kept = [p for p in parts if not (isinstance(p, Q) and not p)]
        for p in kept:
            if not isinstance(p, (Q, Lookup)):
                raise TypeError(f"not a Q object: {p!r}")
        kept += [parse_lookup(k, v) for k, v in lookups.items()]
        self.parts: tuple[Q | Lookup, ...] = tuple(kept)
        self.either = False
        self.negated = False

    def __bool__(self) -> bool:
        return bool(self.parts)

    @staticmethod
    def _joined(a: Q, b: Q, either: bool) -> Q:
        joined = Q(a, b)
        joined.either = either and len(joined.parts) > 1
        return joined

    def __and__(self, other: Q) -> Q:
        return Q._joined(self, other, False)

    def __or__(self, other: Q) -> Q:
        return Q._joined(self, other, True)

    def __invert__(self) -> Q:
        if not self:
            return self
        turned = Q(self)
        turned.negated = True
        return turned

    def lookups(self) -> Iterator[Lookup]:
        for part in self.parts:
            if isinstance(part, Q):
                yield from part.lookups()
            else:
                yield part

    def conjuncts(self) -> list[Q]:
        """The parts that must all hold."""
        if self.negated or self.either:
            return [self]
        flat: list[Q] = []
        for part in self.parts:
            flat += part.conjuncts() if isinstance(part, Q) else [Q(part)]
        return flat

    def column(self, resolve: Callable[[Lookup], Column]) -> Column:
        columns = [
            p.column(resolve) if isinstance(p, Q) else resolve(p) for p in self.parts
        ]
        whole = columns[0]
        for c in columns[1:]:
            whole = (whole | c) if self.either else (whole & c)
        return ~whole if self.negated else whole
