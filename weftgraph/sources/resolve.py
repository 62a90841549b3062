"""Which declared model a stored node or edge belongs to."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import NodeClassNotDefined, RelationshipClassNotDefined
from ..model import NodeModel, RelModel
from .graph import PropertyGraph, col


def label_sets(models: Iterable[type[NodeModel]]) -> dict[tuple[str, ...], str]:
    """Every set of labels a declared model accepts, with the name of the model."""
    found: dict[tuple[str, ...], str] = {}
    for model in models:
        base = model.inherited_labels()
        optional = list(model.__optional_labels__)
        for n in range(len(optional) + 1):
            for extra in combinations(optional, n):
                found[tuple(sorted({*base, *extra}))] = model.__name__
    return found


def resolve_nodes(frame: DataFrame, models: Iterable[type[NodeModel]]) -> DataFrame:
    """Adds ``class_name`` by the exact label set; null where no model fits."""
    known = label_sets(models)
    # the table has one entry per declared combination of labels
    entries = [
        F.when(F.array_sort(col("labels")) == F.array(*[F.lit(x) for x in labels]), name)
        for labels, name in known.items()
    ]
    return frame.withColumn("class_name", F.coalesce(*entries, F.lit(None).cast("string")))


def require_resolved(frame: DataFrame, models: Iterable[type[NodeModel]]) -> DataFrame:
    resolved = resolve_nodes(frame, models)
    unknown = resolved.where(col("class_name").isNull()).select("labels").first()
    if unknown is not None:
        raise NodeClassNotDefined(f"no node model for the labels {sorted(unknown[0])}")
    return resolved


def resolve_edges(edge_types: DataFrame, models: dict[str, type[RelModel] | None]) -> DataFrame:
    """Adds ``class_name`` by ``rel_type``; null where the type is not declared."""
    entries = [
        F.when(col("rel_type") == rel_type, model.__name__ if model else "RelModel")
        for rel_type, model in models.items()
    ]
    return edge_types.withColumn("class_name", F.coalesce(*entries, F.lit(None).cast("string")))


def all_edge_types(graph: PropertyGraph) -> DataFrame:
    """``rel_type`` of every edge of the graph."""
    whole = None
    for rel_type in graph.edges:
        one = graph.edge_frame(rel_type).select(F.lit(rel_type).alias("rel_type"))
        whole = one if whole is None else whole.unionByName(one)
    if whole is None:
        raise RelationshipClassNotDefined("the graph has no relationship types")
    return whole
