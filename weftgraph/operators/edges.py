"""Batch writes of edges. Each returns a new graph; nothing is changed in place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import NotConnected
from ..model import Direction, NodeModel, RelationshipDef
from ..sources.graph import EdgeTable, PropertyGraph, as_table, col
from .constraints import connect_gates, disconnect_gate, enforce
from .writes import as_expr


def stored_names(edge: EdgeTable, frame: DataFrame) -> DataFrame:
    if edge.model is None:
        return frame
    names = {n: p.stored_name for n, p in edge.model.properties().items()}
    return frame.select(*[col(c).alias(names.get(c, c)) for c in frame.columns])


def with_edge_rows(
    target: PropertyGraph, source: PropertyGraph, rel_type: str, new: DataFrame
) -> PropertyGraph:
    """Adds rows to the edges of ``source`` and puts the result into ``target``."""
    edge = source.edge_table(rel_type)
    old = source.edge_frame(rel_type)
    return _store(target, edge, _with_rows(old, new))


def _with_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    if old.schema["edge_id"].dataType != new.schema["edge_id"].dataType:
        old = old.withColumn("edge_id", _text(col("edge_id"), old))
        new = new.withColumn("edge_id", _text(col("edge_id"), new))
    return old.unionByName(new, allowMissingColumns=True)


def _text(c: Column, frame: DataFrame) -> Column:
    kind = frame.schema["edge_id"].dataType.typeName()
    return F.to_json(c) if kind == "struct" else c.cast("string")


def _store(graph: PropertyGraph, edge: EdgeTable, frame: DataFrame) -> PropertyGraph:
    return graph._with(as_table(edge, stored_names(edge, frame)))


def _ends(rel: RelationshipDef) -> tuple[str, str]:
    return ("dst_id", "src_id") if rel.direction == Direction.INCOMING else ("src_id", "dst_id")


def _same_ends(rel: RelationshipDef, near: str, far: str) -> tuple[Column, Column]:
    """Keys of an edge and of a pair that agree when the edge joins the pair."""
    a, b = _ends(rel)
    if rel.direction == Direction.EITHER:
        # the order of the ends does not matter
        edge = F.array_sort(F.array(col("src_id"), col("dst_id")))
        pair = F.array_sort(F.array(col(near), col(far)))
        return edge, pair
    edge = F.struct(col(a).alias("near"), col(b).alias("far"))
    return edge, F.struct(col(near).alias("near"), col(far).alias("far"))


def with_defaults(edge: EdgeTable, pairs: DataFrame) -> tuple[DataFrame, list[str]]:
    """Pairs with the defaults of the edge's properties, and which properties they have."""
    props = [p for p in edge.prop_names() if p in pairs.columns]
    for name, prop in (edge.model.properties() if edge.model else {}).items():
        if prop.has_default:
            given = col(name) if name in props else F.lit(None).cast(prop.spark_type)
            pairs = pairs.withColumn(name, F.coalesce(given, prop.default_column()))
            props += [] if name in props else [name]
    return pairs, props


def hashed_id(props: list[str]) -> Column:
    """The id of a new edge: HASHED letters, which its ends and given properties decide."""
    return F.sha2(F.to_json(F.struct(col("~near"), col("~far"), *[col(f"~{p}") for p in props])), 256)


HASHED = 64


def additions(
    graph: PropertyGraph, model: type[NodeModel], rel_name: str, pairs: DataFrame
) -> DataFrame | None:
    """The edges that ``connect`` adds for pairs without a null property, which change no other.

    Edges and pairs meet in one exchange of ends and properties; edge ids do not travel. None if
    that does not decide it: ends in any order, or values of other types than the edges have.
    """
    rel = model.relationship(rel_name)
    if rel.direction == Direction.EITHER:
        return None
    edge = graph.edge_table(rel.rel_type)
    pairs, props = with_defaults(edge, pairs)
    near, far = _ends(rel)
    names = ["~near", "~far", *[f"~{p}" for p in props]]
    there = [c.alias(n) for c, n in zip(map(col, [near, far, *props]), names)]
    asked = [c.alias(n) for c, n in zip(map(col, ["near_id", "far_id", *props]), names)]
    old, new = graph.edge_frame(rel.rel_type).select(*there), pairs.select(*asked)
    if [f.dataType for f in old.schema] != [f.dataType for f in new.schema]:
        return None
    both = old.withColumn("~old", F.lit(True)).unionByName(new.withColumn("~old", F.lit(False)))
    kinds = both.groupBy(*map(col, names)).agg(F.bool_or("~old").alias("~old"))
    rows = kinds.where(~col("~old")).select(
        hashed_id(props).alias("edge_id"), col("~near").alias(near), col("~far").alias(far),
        *[col(f"~{p}").alias(p) for p in props],
    )
    return stored_names(edge, rows)


def connect(
    graph: PropertyGraph,
    model: type[NodeModel],
    rel_name: str,
    pairs: DataFrame,
    new_edge_id: Column | str | None = None,
) -> PropertyGraph:
    """Makes sure that each pair (``near_id, far_id`` and properties) has its edge.

    An edge with the same ends and equal non-null properties is kept and no second one
    is made; other properties give a parallel edge. A null property is not compared but
    set to null on the edges that match. Rows of one batch count as simultaneous.
    """
    rel = model.relationship(rel_name)
    edge = graph.edge_table(rel.rel_type)
    edges = graph.edge_frame(rel.rel_type)
    pairs, props = with_defaults(edge, pairs)
    right = pairs.select(
        col("near_id").alias("~near"), col("far_id").alias("~far"),
        *[col(p).alias(f"~{p}") for p in props],
    )
    edge_key, pair_key = _same_ends(rel, "~near", "~far")
    right = right.withColumn("~key", pair_key).dropDuplicates(["~key"] + [f"~{p}" for p in props])
    left = edges.withColumn("~edge_key", edge_key)
    same = [col("~edge_key") == col("~key")]
    same += [col(f"~{p}").isNull() | (col(p) == col(f"~{p}")) for p in props]
    on = reduce(lambda a, b: a & b, same)
    touched = left.join(right.select("~key").distinct(), col("~edge_key") == col("~key"), "left_semi")
    # each kind of edge once: a pair may have a large share of all edges
    kinds = touched.select("~edge_key", *[col(p) for p in props]).distinct()
    missing = right.join(kinds, on, "left_anti")
    near, far = _ends(rel)
    ident = as_expr(new_edge_id) if new_edge_id is not None else hashed_id(props)
    new = missing.select(
        ident.alias("edge_id"), col("~near").alias(near), col("~far").alias(far),
        *[col(f"~{p}").alias(p) for p in props],
    )
    kept = edges
    if props:
        # what is set to null depends on the ends and the properties alone: found for each kind
        some_null = reduce(lambda a, b: a | b, [col(f"~{p}").isNull() for p in props])
        cleared = (
            kinds.join(right.where(some_null), on)
            .groupBy(col("~edge_key").alias("~of"), *[col(p).alias(f"~had~{p}") for p in props])
            .agg(*[F.bool_or(col(f"~{p}").isNull()).alias(f"~null~{p}") for p in props])
        )
        is_kind = [col("~edge_key") == col("~of")]
        is_kind += [col(p).eqNullSafe(col(f"~had~{p}")) for p in props]
        kept = left.join(cleared, reduce(lambda a, b: a & b, is_kind), "left").select(
            *[
                F.when(~F.coalesce(col(f"~null~{c}"), F.lit(False)), col(c)).alias(c)
                if c in props
                else col(c)
                for c in edges.columns
            ]
        )
    return _store(graph, edge, _with_rows(kept, new))


def connect_checked(
    graph: PropertyGraph,
    model: type[NodeModel],
    rel_name: str,
    pairs: DataFrame,
    new_edge_id: Column | str | None = None,
    mode: str = "fail",
) -> PropertyGraph:
    """As ``connect``, but no edge is made if any pair breaks a rule (``mode="fail"``)."""
    enforce(connect_gates(graph, model, rel_name, pairs), mode)
    return connect(graph, model, rel_name, pairs, new_edge_id)


def disconnect_checked(
    graph: PropertyGraph,
    model: type[NodeModel],
    rel_name: str,
    pairs: DataFrame,
    mode: str = "fail",
) -> PropertyGraph:
    """As ``disconnect``, but the last edge of a node that needs one is kept."""
    enforce(disconnect_gate(graph, model, rel_name, pairs), mode)
    return disconnect(graph, model, rel_name, pairs)


def disconnect(
    graph: PropertyGraph, model: type[NodeModel], rel_name: str, pairs: DataFrame
) -> PropertyGraph:
    """Removes all edges of the type between the two nodes of each pair."""
    rel = model.relationship(rel_name)
    edge = graph.edge_table(rel.rel_type)
    edges = graph.edge_frame(rel.rel_type)
    edge_key, pair_key = _same_ends(rel, "near_id", "far_id")
    gone = pairs.select(pair_key.alias("~key")).distinct()
    return _store(graph, edge, edges.join(gone, edge_key == col("~key"), "left_anti"))


def disconnect_all(
    graph: PropertyGraph, model: type[NodeModel], rel_name: str, ids: DataFrame
) -> PropertyGraph:
    """Removes all edges of the type between the given nodes and the target label."""
    rel = model.relationship(rel_name)
    edge = graph.edge_table(rel.rel_type)
    frame = graph.edge_frame(rel.rel_type)
    gone = ids.select(col("node_id").alias("~gone")).distinct()
    near, far = _ends(rel)
    ends = [(near, far)]
    if rel.direction == Direction.EITHER:
        ends.append((far, near))
    declared = edge.dst if far == "dst_id" else edge.src
    for this, other in ends:
        if edge.verified or declared is rel.target:
            frame = frame.join(gone, col(this) == col("~gone"), "left_anti")
            continue
        target = graph.node_frame(rel.target).select(col("node_id").alias("~target"))
        hit = frame.join(gone, col(this) == col("~gone"), "left_semi").join(
            target, col(other) == col("~target"), "left_semi"
        )
        hit = hit.select(col("edge_id").alias("~edge"))
        frame = frame.join(hit, col("edge_id") == col("~edge"), "left_anti")
    return _store(graph, edge, frame)


def replace_edges(
    graph: PropertyGraph,
    model: type[NodeModel],
    rel_name: str,
    pairs: DataFrame,
    new_edge_id: Column | str | None = None,
) -> PropertyGraph:
    """All edges of the near nodes go, then the pairs are connected."""
    ids = pairs.select(col("near_id").alias("node_id"))
    emptied = disconnect_all(graph, model, rel_name, ids)
    return connect(emptied, model, rel_name, pairs, new_edge_id)


def reconnect(
    graph: PropertyGraph,
    model: type[NodeModel],
    rel_name: str,
    moves: DataFrame,
    new_edge_id: Column | str | None = None,
) -> PropertyGraph:
    """Moves edges from ``old_id`` to ``new_id`` and keeps their properties.

    If the near node already has an edge to the new node, that edge takes over the
    properties instead. Of several old edges the one with the greatest id decides.
    """
    rel = model.relationship(rel_name)
    edge = graph.edge_table(rel.rel_type)
    edges = graph.edge_frame(rel.rel_type)
    props = edge.prop_names()
    moves = moves.where(col("old_id") != col("new_id")).select(
        col("near_id").alias("~near"), col("old_id").alias("~old"), col("new_id").alias("~new")
    ).distinct()
    keys = moves.select("*", _same_ends(rel, "~near", "~old")[1].alias("~key"))
    edge_key = _same_ends(rel, "~near", "~old")[0]
    old = edges.withColumn("~edge_key", edge_key).join(keys, col("~edge_key") == col("~key"))
    carried = (
        F.max_by(F.struct(F.lit(1).alias("~"), *[col(p) for p in props]), col("edge_id"))
    )
    moved = old.groupBy("~near", "~new").agg(carried.alias("~props"))
    moved = moved.withColumn("~target", _same_ends(rel, "~near", "~new")[1])
    rest = edges.join(
        keys.select("~key").distinct(), edge_key == col("~key"), "left_anti"
    ).withColumn("~edge_key", edge_key)
    takes = moved.select(col("~target").alias("~to"), col("~props").alias("~over"))
    kept = rest.join(takes, col("~edge_key") == col("~to"), "left").select(
        *[
            F.when(col("~over").isNotNull(), col("~over")[c]).otherwise(col(c)).alias(c)
            if c in props
            else col(c)
            for c in edges.columns
        ]
    )
    there = rest.select(col("~edge_key").alias("~present")).distinct()
    new = moved.join(there, col("~target") == col("~present"), "left_anti")
    near, far = _ends(rel)
    ident = as_expr(new_edge_id) if new_edge_id is not None else F.sha2(
        F.to_json(F.struct(col("~near"), col("~new"))), 256
    )
    new = new.select(
        ident.alias("edge_id"), col("~near").alias(near), col("~new").alias(far),
        *[col("~props")[p].alias(p) for p in props],
    )
    return _store(graph, edge, _with_rows(kept, new))


def not_connected(
    graph: PropertyGraph, model: type[NodeModel], rel_name: str, moves: DataFrame
) -> DataFrame:
    """The moves whose old edge does not exist."""
    rel = model.relationship(rel_name)
    edge_key, pair_key = _same_ends(rel, "near_id", "old_id")
    present = graph.edge_frame(rel.rel_type).select(edge_key.alias("~key")).distinct()
    differ = moves.where(col("old_id") != col("new_id"))
    return differ.join(present, pair_key == col("~key"), "left_anti")


def reconnect_checked(graph, model, rel_name, moves, new_edge_id=None) -> PropertyGraph:
    bad = not_connected(graph, model, rel_name, moves).first()
    if bad is not None:
        raise NotConnected(f"reconnect: {bad['near_id']} is not connected to {bad['old_id']}")
    return reconnect(graph, model, rel_name, moves, new_edge_id)


def save_edges(graph: PropertyGraph, rel_type: str, batch: DataFrame) -> PropertyGraph:
    """Overwrites all properties of the edges in the batch (by ``edge_id``)."""
    edge = graph.edge_table(rel_type)
    edges = graph.edge_frame(rel_type)
    props = edge.prop_names()
    right = batch.select(
        col("edge_id").alias("~id"),
        *[(col(p) if p in batch.columns else F.lit(None)).alias(f"~{p}") for p in props],
    )
    joined = edges.join(right, col("edge_id") == col("~id"), "left")
    frame = joined.select(
        *[
            F.when(col("~id").isNotNull(), col(f"~{c}")).otherwise(col(c)).alias(c)
            if c in props
            else col(c)
            for c in edges.columns
        ]
    )
    return _store(graph, edge, frame)
