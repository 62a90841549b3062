"""Functions accepted by ``annotate`` and references to bound variables."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Union

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NodeNameResolver:
    """The node at the end of a path; ``"self"`` is the root node."""

    node: str


@dataclass(frozen=True)
class RelationNameResolver:
    """The last edge of a path."""

    relation: str


Source = Union[str, NodeNameResolver, RelationNameResolver, "AnnotateFunction"]


@dataclass(frozen=True)
class AnnotateFunction:
    """Base of the functions usable in ``annotate``."""

    source: Source

    def collected(self) -> Collect | None:
        inner: Any = self
        while isinstance(inner, ScalarFunction):
            inner = inner.source
        return inner if isinstance(inner, Collect) else None


@dataclass(frozen=True)
class Collect(AnnotateFunction):
    """The list of all values in a group; nodes and edges are distinct by id.

    A group may hold a large share of all rows. With ``part_size`` every list is returned
    as rows numbered by ``part``, of that many elements each (the last may have fewer),
    and no task ever holds a whole group.
    """

    distinct: bool = False
    part_size: int | None = None


@dataclass(frozen=True)
class ScalarFunction(AnnotateFunction):
    """A function of one value. Subclass it and override ``apply`` to add others."""

    def apply(self, value: Column) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class Last(ScalarFunction):
    """The last element of a list; null for an empty one."""

    def apply(self, value: Column) -> Column:
        return F.try_element_at(value, F.lit(-1))


@dataclass(frozen=True)
class Size(ScalarFunction):
    """The number of elements of a list."""

    def apply(self, value: Column) -> Column:
        return F.size(value).cast("bigint")
