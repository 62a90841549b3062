"""Batch writes of nodes. Each returns a new graph; nothing is changed in place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ConstraintViolation, RequiredProperty, UniqueProperty
from ..model import Direction, NodeModel
from ..sources.graph import PropertyGraph, as_table, col, default_array
from ..sources.session import checkpointed

POSITION = "~position"


@dataclass(frozen=True)
class Upsert:
    """The new graph and the batch rows that could not be applied."""

    graph: PropertyGraph
    rejected: DataFrame

    def require_clean(self) -> PropertyGraph:
        bad = self.rejected.first()
        if bad is not None:
            raise ConstraintViolation(f"row without a merge key or a required property: {bad}")
        return self.graph


def as_batch(graph: PropertyGraph, model: type[NodeModel], rows: Any) -> DataFrame:
    """A DataFrame as it is; a list of dictionaries with its positions."""
    if isinstance(rows, DataFrame):
        return rows
    names = [n for n in model.properties() if any(n in r for r in rows)]
    extra = sorted({k for r in rows for k in r} - set(names))
    for name in extra:
        if name not in ("node_id", "source_id"):
            raise ValueError(f"No such property {name} on {model.__name__}")
    fields = [T.StructField(POSITION, T.LongType())]
    fields += [T.StructField(n, model.property(n).spark_type) for n in names]
    fields += [T.StructField(n, _id_type(graph, model)) for n in extra]
    data = [tuple([i] + [r.get(n) for n in names + extra]) for i, r in enumerate(rows)]
    return graph.spark.createDataFrame(data, T.StructType(fields))


def as_expr(value: Column | str) -> Column:
    """A column as it is, text as a SQL expression."""
    return F.expr(value) if isinstance(value, str) else value


def _id_type(graph: PropertyGraph, model: type[NodeModel]) -> T.DataType:
    return graph.tables[model.label_name()][1].schema["node_id"].dataType


def _positioned(batch: DataFrame, position: str | None) -> DataFrame:
    if position is not None:
        return batch.withColumnRenamed(position, POSITION)
    if POSITION in batch.columns:
        return batch
    # numbered once and kept: a repeated task would number its rows anew
    return checkpointed(batch.withColumn(POSITION, F.monotonically_increasing_id()))


def _unusable(model: type[NodeModel], batch: DataFrame, keys: Sequence[str]) -> Column:
    """Rows without a key, or without a required property that has no default."""
    bad = reduce(lambda a, b: a | b, [col(k).isNull() for k in keys])
    for name, prop in model.properties().items():
        if prop.required and not prop.has_default and name not in keys:
            bad = bad | (col(name).isNull() if name in batch.columns else F.lit(True))
    return bad


def _default_id(graph: PropertyGraph, model: type[NodeModel], keys: Sequence[str]) -> Column:
    """A text id made of the merge key: equal for equal keys, whatever task makes it."""
    if not isinstance(_id_type(graph, model), T.StringType):
        raise ValueError("give new_id: only text ids can be derived from the merge key")
    return F.sha2(F.to_json(F.struct(F.lit(model.label_name()), *[col(k) for k in keys])), 256)


def _as_stored(model: type[NodeModel], rows: DataFrame, labels: list[str] | None) -> DataFrame:
    """New rows in the stored column names, with defaults for what is missing."""
    present, chosen = set(rows.columns), [col("node_id")]
    for name, prop in model.properties().items():
        value = col(name) if name in present else F.lit(None).cast(prop.spark_type)
        if prop.has_default:
            value = F.coalesce(value, prop.default_column())
        chosen.append(value.alias(prop.stored_name))
    if labels is not None:
        chosen.append(default_array(labels).alias("labels"))
    return rows.select(*chosen)


def _append(graph: PropertyGraph, model, old: DataFrame, new: DataFrame, labels) -> PropertyGraph:
    if labels is not None and "labels" not in old.columns:
        old = old.withColumn("labels", default_array(model.inherited_labels()))
    if labels is None and "labels" in old.columns:
        new = new.withColumn("labels", default_array(model.inherited_labels()))
    new = new.select(
        *[
            col(c).cast(old.schema[c].dataType).alias(c) if c in old.columns else col(c)
            for c in new.columns
        ]
    )
    return graph.with_nodes(model, old.unionByName(new, allowMissingColumns=True))


# ---------------------------------------------------------------------- create
def create(
    graph: PropertyGraph, model: type[NodeModel], rows: Any, new_id: Column | str | None = None
) -> PropertyGraph:
    """Appends nodes with defaults filled. The batch needs a ``node_id`` or ``new_id``."""
    batch = as_batch(graph, model, rows)
    if new_id is not None:
        batch = batch.withColumn("node_id", as_expr(new_id))
    elif "node_id" not in batch.columns:
        raise ValueError("new nodes need a node_id column or a new_id expression")
    old = graph.tables[model.label_name()][1]
    return _append(graph, model, old, _as_stored(model, batch, None), None)


def create_violations(graph: PropertyGraph, model: type[NodeModel], rows: Any) -> DataFrame:
    """What would go wrong: missing required values, values that are not unique.

    Existing values are compared only with the values of the batch, so the node table
    is reduced by a semi join before anything is grouped.
    """
    batch = as_batch(graph, model, rows)
    found = []
    for name, prop in model.properties().items():
        if prop.required:
            value = col(name) if name in batch.columns else F.lit(None)
            found.append(
                batch.where(value.isNull())
                .groupBy()
                .agg(F.count(F.lit(1)).alias("n"))
                .where(col("n") > 0)
                .select(
                    F.lit("required").alias("rule"),
                    F.lit(name).alias("field"),
                    F.lit(None).cast("string").alias("value"),
                    "n",
                )
            )
        if prop.unique_index and name in batch.columns:
            given = batch.where(col(name).isNotNull()).select(col(name).alias("v"))
            stored = graph.node_frame(model).select(col(name).alias("v"))
            stored = stored.join(given.distinct(), "v", "left_semi")
            found.append(
                given.unionByName(stored)
                .groupBy("v")
                .agg(F.count(F.lit(1)).alias("n"))
                .where(col("n") > 1)
                .select(
                    F.lit("unique").alias("rule"),
                    F.lit(name).alias("field"),
                    col("v").cast("string").alias("value"),
                    "n",
                )
            )
    if not found:
        return batch.select(
            F.lit("").alias("rule"), F.lit("").alias("field"), F.lit("").alias("value"),
            F.lit(0).cast("bigint").alias("n"),
        ).where(F.lit(False))
    return reduce(DataFrame.unionByName, found)


def create_checked(
    graph: PropertyGraph, model: type[NodeModel], rows: Any, new_id: Column | str | None = None
) -> PropertyGraph:
    """As ``create``, but the whole batch is refused when any row breaks a rule."""
    batch = as_batch(graph, model, rows)
    bad = create_violations(graph, model, batch).first()
    if bad is not None:
        kind = RequiredProperty if bad["rule"] == "required" else UniqueProperty
        raise kind(f"{bad['field']}: {bad['value']} ({bad['n']} rows)")
    return create(graph, model, batch, new_id)


# ---------------------------------------------------------------------- merge
def get_or_create(graph, model, rows, **options: Any) -> Upsert:
    """Creates the nodes whose merge key is new; existing nodes stay as they are."""
    return _merge(graph, model, rows, update=False, **options)


def create_or_update(graph, model, rows, **options: Any) -> Upsert:
    """As ``get_or_create``, and given values overwrite those of existing nodes.

    Later rows of the batch win property by property; nulls never erase.
    """
    return _merge(graph, model, rows, update=True, **options)


def _reduced(batch: DataFrame, keys: list[str], update: bool) -> DataFrame:
    """One row per key: the first row, or the last given value of each property."""
    others = [c for c in batch.columns if c not in keys and c != POSITION]
    if update:
        picks = [
            F.max_by(col(c), F.when(col(c).isNotNull(), col(POSITION))).alias(c) for c in others
        ]
    else:
        picks = [F.min_by(col(c), col(POSITION)).alias(c) for c in others]
    picks.append(F.min(POSITION).alias(POSITION))
    return batch.groupBy(*[col(k) for k in keys]).agg(*picks)


def _merge(
    graph: PropertyGraph,
    model: type[NodeModel],
    rows: Any,
    *,
    update: bool,
    merge_by: dict[str, Any] | None = None,
    position: str | None = None,
    new_id: Column | str | None = None,
) -> Upsert:
    batch = _positioned(as_batch(graph, model, rows), position)
    keys = list(merge_by["keys"]) if merge_by else model.merge_keys()
    if not keys:
        raise ValueError(f"{model.__name__} has no merge key")
    labels = [merge_by["label"]] if merge_by and merge_by.get("label") else None
    unusable = _unusable(model, batch, keys)
    rejected = batch.where(unusable).drop(POSITION)
    wanted = _reduced(batch.where(~unusable), keys, update)
    old = graph.tables[model.label_name()][1]
    stored_key = {k: model.property(k).stored_name for k in keys}
    given = wanted.select(*[col(k).alias(f"~{k}") for k in keys])
    on = reduce(lambda a, b: a & b, [col(stored_key[k]) == col(f"~{k}") for k in keys])
    # only nodes that carry the labels can match
    fits = _carries(model, old, labels or model.inherited_labels())
    # the stored keys that the batch touches: no more than the batch has
    matched = old.where(fits).join(given, on, "left_semi").select(
        *[col(stored_key[k]).alias(k) for k in keys]
    )
    created = wanted.join(matched.distinct(), keys, "left_anti")
    identity = as_expr(new_id) if new_id is not None else _default_id(graph, model, keys)
    created = created.withColumn("node_id", identity)
    if update:
        old = _overwritten(model, old, wanted, keys, stored_key, fits)
    new = _as_stored(model, created, labels)
    return Upsert(_append(graph, model, old, new, labels), rejected)


def _carries(model, old: DataFrame, labels: list[str]) -> Column:
    if "labels" in old.columns:
        return reduce(lambda a, b: a & b, [F.array_contains(col("labels"), x) for x in labels])
    return F.lit(set(labels) <= set(model.inherited_labels()))


def _overwritten(
    model, old: DataFrame, wanted: DataFrame, keys, stored_key, fits: Column | None = None
) -> DataFrame:
    given = [c for c in wanted.columns if c in model.properties() and c not in keys]
    if not given:
        return old
    right = wanted.select(
        *[col(k).alias(f"~{k}") for k in keys], *[col(c).alias(f"~new~{c}") for c in given]
    )
    on = reduce(lambda a, b: a & b, [col(stored_key[k]) == col(f"~{k}") for k in keys])
    on = on if fits is None else on & fits
    changed = {model.property(c).stored_name: col(f"~new~{c}") for c in given}
    return old.join(right, on, "left").select(
        *[
            F.coalesce(changed[c].cast(old.schema[c].dataType), col(c)).alias(c)
            if c in changed
            else col(c)
            for c in old.columns
        ]
    )


def merge_under(
    graph: PropertyGraph,
    source: type[NodeModel],
    rel_name: str,
    rows: Any,
    *,
    source_id: Any = None,
    update: bool = False,
    rel_props: Sequence[str] | Mapping[str, Any] = (),
    keys: Sequence[str] | None = None,
    position: str | None = None,
    new_id: Column | str | None = None,
    new_edge_id: Column | str | None = None,
) -> Upsert:
    """Merge of whole patterns: source node, relationship and target node together.

    Each row names its ``source_id`` (or all share the given one). A target counts as
    existing only if it already hangs on that source by such a relationship, with equal
    edge properties; otherwise a new node and a new edge are created, even if an equal
    node exists elsewhere. ``rel_props`` are columns of the rows, or values for all rows.
    """
    rel = source.relationship(rel_name)
    target = rel.target
    keys = list(keys or target.merge_keys())
    batch = _positioned(as_batch(graph, target, rows), position)
    if source_id is not None:
        batch = batch.withColumn("source_id", F.lit(source_id))
    if isinstance(rel_props, Mapping):
        if rel.model is None and rel_props:
            raise NotImplementedError("edge properties need a relationship model")
        given = {p: F.lit(v).cast(rel.model.property(p).spark_type) for p, v in rel_props.items()}
        batch = batch.withColumns(given) if given else batch
        rel_props = list(rel_props)
    ident = ["source_id", *keys, *rel_props]
    unusable = _unusable(target, batch, ["source_id", *keys])
    rejected = batch.where(unusable).drop(POSITION)
    wanted = _reduced(batch.where(~unusable), ident, update)
    edges = graph.oriented_edges(source, rel)
    sources = wanted.select(col("source_id").alias("near_id")).distinct()
    near = edges.join(sources, "near_id", "left_semi")
    nodes = graph.node_frame(target).select("node_id", *keys)
    present = near.join(nodes, col("far_id") == col("node_id")).select(
        col("near_id").alias("~source_id"),
        *[col(k).alias(f"~{k}") for k in keys],
        *[col(p).alias(f"~{p}") for p in rel_props],
        col("far_id").alias("~far"),
    )
    same = [col(c) == col(f"~{c}") for c in ["source_id", *keys]]
    # a null property is set, not matched
    same += [col(p).isNull() | (col(p) == col(f"~{p}")) for p in rel_props]
    on = reduce(lambda a, b: a & b, same)
    created = wanted.join(present, on, "left_anti")
    identity = as_expr(new_id) if new_id is not None else _default_id(graph, target, ident)
    created = created.withColumn("node_id", identity)
    old = graph.tables[target.label_name()][1]
    if update:
        given = [c for c in wanted.columns if c in target.properties() and c not in ident]
        touched = wanted.join(present, on).withColumn("node_id", col("~far"))
        touched = touched.select("node_id", POSITION, *given)
        last = _reduced(touched, ["node_id"], True)
        old = _overwritten(target, old, last, ["node_id"], {"node_id": "node_id"})
    result = _append(graph, target, old, _as_stored(target, created, None), None)
    edge = graph.edge_table(rel.rel_type)
    outgoing = rel.direction != Direction.INCOMING
    a, b = ("source_id", "node_id") if outgoing else ("node_id", "source_id")
    edge_id = as_expr(new_edge_id) if new_edge_id is not None else F.sha2(
        F.to_json(F.struct(col("source_id"), col("node_id"), *[col(p) for p in rel_props])), 256
    )
    new_edges = created.select(
        edge_id.alias("edge_id"), col(a).alias("src_id"), col(b).alias("dst_id"),
        *[col(p) for p in rel_props],
    )
    from .edges import with_edge_rows

    return Upsert(with_edge_rows(result, graph, rel.rel_type, new_edges), rejected)


# ---------------------------------------------------------------------- other writes
def delete(graph: PropertyGraph, model: type[NodeModel], ids: DataFrame) -> PropertyGraph:
    """Removes nodes and every edge that begins or ends at one of them."""
    gone = ids.select(col("node_id").alias("~gone")).distinct()
    own, table = graph.tables[model.label_name()]
    kept = table.join(gone, col("node_id") == col("~gone"), "left_anti")
    result = graph.with_nodes(own, kept)
    for rel_type, edge in graph.edges.items():
        touched = [
            end
            for end, at in (("src_id", edge.src), ("dst_id", edge.dst))
            if issubclass(model, at) or issubclass(at, model)
        ]
        if edge.owner is not None and edge.owner is own:
            # edges held by the deleted rows went with them
            touched = [t for t in touched if t != f"{edge.owner_end}_id"]
        if not touched:
            continue
        frame = result.edge_frame(rel_type)
        for end in touched:
            frame = frame.join(gone, col(end) == col("~gone"), "left_anti")
        from .edges import stored_names

        result = result._with(as_table(edge, stored_names(edge, frame)))
    return result


def clear(graph: PropertyGraph) -> PropertyGraph:
    """Removes all nodes and edges and keeps the declarations."""
    result = graph
    for model, frame in graph.tables.values():
        result = result.with_nodes(model, frame.where(F.lit(False)))
    for rel_type, edge in graph.edges.items():
        if edge.owner is None:
            result = result._with(as_table(edge, edge.frame.where(F.lit(False))))
    return result


def save(graph: PropertyGraph, model: type[NodeModel], batch: DataFrame) -> PropertyGraph:
    """Overwrites all declared properties (and the labels) of the nodes in the batch."""
    old = graph.tables[model.label_name()][1]
    right = batch.select(
        col("node_id").alias("~id"),
        *[
            (col(n) if n in batch.columns else F.lit(None).cast(p.spark_type)).alias(f"~new~{n}")
            for n, p in model.properties().items()
        ],
    )
    hit = col("~id").isNotNull()
    stored = {p.stored_name: n for n, p in model.properties().items()}
    chosen = []
    for c in old.columns:
        if c in stored:
            new = col(f"~new~{stored[c]}").cast(old.schema[c].dataType)
            chosen.append(F.when(hit, new).otherwise(col(c)).alias(c))
        elif c == "labels":
            again = F.array_union(col(c), default_array(model.inherited_labels()))
            chosen.append(F.when(hit, again).otherwise(col(c)).alias(c))
        else:
            chosen.append(col(c))
    joined = old.join(right, col("node_id") == col("~id"), "left")
    return graph.with_nodes(model, joined.select(*chosen))


def refresh(graph: PropertyGraph, model: type[NodeModel], ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The current rows of the given ids, and the ids that no longer exist."""
    nodes = graph.node_frame(model)
    wanted = ids.select("node_id")
    return nodes.join(wanted, "node_id", "left_semi"), wanted.join(
        nodes.select("node_id"), "node_id", "left_anti"
    )
