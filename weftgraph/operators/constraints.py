"""Rules over whole tables. Every check returns its violations as a DataFrame.

All violation frames have the columns ``rule, subject, field, item, n``: the broken
rule, the label or relationship type, the property or relationship, the offending value
or node id as text, and the number of rows or edges involved.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import CardinalityViolation, ConstraintViolation
from ..model import Cardinality, NodeModel, RelationshipDef
from ..sources.graph import PropertyGraph, col


def _violation(rule: str, subject: str, field: Column, item: Column, n: Column) -> list[Column]:
    return [
        F.lit(rule).alias("rule"),
        F.lit(subject).alias("subject"),
        field.alias("field"),
        item.cast("string").alias("item"),
        n.cast("bigint").alias("n"),
    ]


def _nothing(graph: PropertyGraph) -> DataFrame:
    schema = "rule string, subject string, field string, item string, n bigint"
    return graph.spark.createDataFrame([], schema)


def required(graph: PropertyGraph, model: type[NodeModel]) -> DataFrame:
    """Nodes without a required value; one pass for all properties."""
    names = [n for n, p in model.properties().items() if p.required]
    if not names:
        return _nothing(graph)
    missing = F.array_compact(F.array(*[F.when(col(n).isNull(), F.lit(n)) for n in names]))
    found = graph.node_frame(model).select("node_id", F.explode(missing).alias("field"))
    return found.select(
        *_violation("required", model.label_name(), col("field"), col("node_id"), F.lit(1))
    )


def _duplicates(frame: DataFrame, names: list[str], rule: str, subject: str) -> DataFrame:
    """Values that occur more than once; all properties share one scan and one shuffle."""
    values = F.array(
        *[F.struct(F.lit(n).alias("field"), col(n).cast("string").alias("item")) for n in names]
    )
    counted = (
        frame.select(F.explode(values).alias("v"))
        .where(col("v")["item"].isNotNull())
        .groupBy(col("v")["field"].alias("field"), col("v")["item"].alias("item"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(col("n") > 1)
    )
    return counted.select(*_violation(rule, subject, col("field"), col("item"), col("n")))


def unique(
    graph: PropertyGraph, model: type[NodeModel], names: list[str] | None = None
) -> DataFrame:
    """Duplicated values of unique properties; nulls may repeat."""
    names = names or [n for n, p in model.properties().items() if p.unique_index]
    if not names:
        return _nothing(graph)
    return _duplicates(graph.node_frame(model), names, "unique", model.label_name())


def unique_edges(graph: PropertyGraph, rel_type: str, names: list[str] | None = None) -> DataFrame:
    """Duplicated values of unique edge properties of one relationship type."""
    model = graph.edge_table(rel_type).model
    if names is None:
        names = [n for n, p in model.properties().items() if p.unique_index] if model else []
    if not names:
        return _nothing(graph)
    return _duplicates(graph.edge_frame(rel_type), names, "unique edge", rel_type)


def degrees(graph: PropertyGraph, model: type[NodeModel], rel: RelationshipDef) -> DataFrame:
    """``near_id, n``: edges per node that has any; counted before the shuffle."""
    return (
        graph.oriented_edges(model, rel).groupBy("near_id").agg(F.count(F.lit(1)).alias("n"))
    )


def cardinality(
    graph: PropertyGraph,
    model: type[NodeModel],
    rel_name: str,
    rule: type[Cardinality] | None = None,
) -> DataFrame:
    """Nodes with too many or too few edges of a relationship."""
    rel = model.relationship(rel_name)
    rule = rule or rel.cardinality
    name, found = rule.__name__, []
    if rule.most is not None:
        many = degrees(graph, model, rel).where(col("n") > rule.most)
        found.append(
            many.select(
                *_violation(name, model.label_name(), F.lit(rel_name), col("near_id"), col("n"))
            )
        )
    if rule.least > 0:
        linked = graph.oriented_edges(model, rel).select("near_id").distinct()
        none = graph.node_frame(model).join(linked, col("node_id") == col("near_id"), "left_anti")
        found.append(
            none.select(
                *_violation(name, model.label_name(), F.lit(rel_name), col("node_id"), F.lit(0))
            )
        )
    return reduce(DataFrame.unionByName, found) if found else _nothing(graph)


def inverse_of(model: type[NodeModel], rel: RelationshipDef) -> RelationshipDef | None:
    """The definition of the same relationship seen from its other end."""
    for other in rel.target.relationships().values():
        if (
            other.rel_type == rel.rel_type
            and other.direction != rel.direction
            and other.target is model
        ):
            return other
    return None


def inverse_cardinality(
    graph: PropertyGraph,
    model: type[NodeModel],
    rel_name: str,
    rule: type[Cardinality] | None = None,
) -> DataFrame:
    """The rule of the other end: its declared one unless given."""
    rel = model.relationship(rel_name)
    inverse = inverse_of(model, rel)
    if inverse is None:
        return _nothing(graph)
    return cardinality(graph, rel.target, inverse.name, rule)


def connect_gate(
    graph: PropertyGraph,
    model: type[NodeModel],
    rel_name: str,
    proposed: DataFrame,
    rule: type[Cardinality] | None = None,
) -> DataFrame:
    """Nodes that the proposed edges (``near_id, far_id``) would give too many edges."""
    rel = model.relationship(rel_name)
    rule = rule or rel.cardinality
    if rule.most is None:
        return _nothing(graph)
    asked = proposed.groupBy("near_id").agg(F.count(F.lit(1)).alias("asked"))
    present = graph.oriented_edges(model, rel)
    # only the nodes that ask for more are counted
    present = present.join(asked.select("near_id"), "near_id", "left_semi")
    present = present.groupBy("near_id").agg(F.count(F.lit(1)).alias("has"))
    both = asked.join(present, "near_id", "left")
    total = col("asked") + F.coalesce(col("has"), F.lit(0))
    return both.where(total > rule.most).select(
        *_violation(rule.__name__, model.label_name(), F.lit(rel_name), col("near_id"), total)
    )


def connect_gates(
    graph: PropertyGraph, model: type[NodeModel], rel_name: str, proposed: DataFrame
) -> DataFrame:
    """Everything that forbids the proposed edges: both cardinalities and the target class."""
    rel = model.relationship(rel_name)
    found = [connect_gate(graph, model, rel_name, proposed)]
    inverse = inverse_of(model, rel)
    if inverse is not None:
        turned = proposed.select(col("far_id").alias("near_id"), col("near_id").alias("far_id"))
        found.append(connect_gate(graph, rel.target, inverse.name, turned))
    nodes = graph.node_frame(rel.target).select("node_id")
    asked = proposed.groupBy("far_id").agg(F.count(F.lit(1)).alias("n"))
    strange = asked.join(nodes, col("far_id") == col("node_id"), "left_anti")
    found.append(
        strange.select(
            *_violation("endpoint", model.label_name(), F.lit(rel_name), col("far_id"), col("n"))
        )
    )
    return reduce(DataFrame.unionByName, found)


def disconnect_gate(
    graph: PropertyGraph,
    model: type[NodeModel],
    rel_name: str,
    pairs: DataFrame,
    rule: type[Cardinality] | None = None,
) -> DataFrame:
    """Nodes whose last edge (OneOrMore) or only edge (One) would be removed."""
    rel = model.relationship(rel_name)
    rule = rule or rel.cardinality
    if rule.least == 0:
        return _nothing(graph)
    gone = pairs.select("near_id", "far_id").distinct()
    edges = graph.oriented_edges(model, rel).select("near_id", "far_id")
    marked = edges.join(gone.select("near_id").distinct(), "near_id", "left_semi").join(
        gone.withColumn("~gone", F.lit(1)), ["near_id", "far_id"], "left"
    )
    left = marked.groupBy("near_id").agg(
        F.count(F.when(col("~gone").isNull(), F.lit(1))).alias("n"),
        F.count(col("~gone")).alias("removed"),
    )
    return left.where((col("n") < rule.least) & (col("removed") > 0)).select(
        *_violation(rule.__name__, model.label_name(), F.lit(rel_name), col("near_id"), col("n"))
    )


def disconnect_all_gate(
    graph: PropertyGraph,
    model: type[NodeModel],
    rel_name: str,
    sources: DataFrame,
    rule: type[Cardinality] | None = None,
) -> DataFrame:
    """Sources (``near_id``) that have edges and may not lose all of them, with 0 left over.

    Replacing all edges of a source empties it first, so that this is its gate too.
    """
    rel = model.relationship(rel_name)
    rule = rule or rel.cardinality
    if rule.least == 0:
        return _nothing(graph)
    linked = degrees(graph, model, rel).join(sources.select("near_id").distinct(), "near_id", "left_semi")
    return linked.select(
        *_violation(rule.__name__, model.label_name(), F.lit(rel_name), col("near_id"), F.lit(0))
    )


def cardinality_report(
    graph: PropertyGraph,
    model: type[NodeModel],
    rel_name: str,
    rule: type[Cardinality] | None = None,
) -> DataFrame:
    """One row: how many nodes and edges a rule was applied to, and how many nodes break it."""
    rel = model.relationship(rel_name)
    rule = rule or rel.cardinality
    counted = degrees(graph, model, rel)
    n = F.coalesce(col("n"), F.lit(0))
    broken = n < rule.least
    if rule.most is not None:
        broken = broken | (n > rule.most)
    nodes = graph.node_frame(model).select("node_id")
    return nodes.join(counted, col("node_id") == col("near_id"), "left").agg(
        F.first(F.lit(rule.__name__)).alias("rule"),
        F.count(F.lit(1)).alias("nodes"),
        F.coalesce(F.sum(n), F.lit(0)).alias("edges"),
        F.count_if(broken).alias("violations"),
    )


def endpoints(
    graph: PropertyGraph, rel_type: str, model: type[NodeModel] | None = None, end: str = "dst"
) -> DataFrame:
    """Edges whose end is not a node of the declared class."""
    edge = graph.edge_table(rel_type)
    model = model or (edge.dst if end == "dst" else edge.src)
    nodes = graph.node_frame(model).select("node_id")
    counted = (
        graph.edge_frame(rel_type).groupBy(col(f"{end}_id").alias("end_id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    lost = counted.join(nodes, col("end_id") == col("node_id"), "left_anti")
    return lost.select(*_violation("endpoint", rel_type, F.lit(end), col("end_id"), col("n")))


def check_model(graph: PropertyGraph, model: type[NodeModel]) -> DataFrame:
    parts = [required(graph, model), unique(graph, model)]
    for name, rel in model.relationships().items():
        if rel.rel_type in graph.edges:
            parts.append(cardinality(graph, model, name))
    return reduce(DataFrame.unionByName, parts)


def check_all(graph: PropertyGraph) -> DataFrame:
    """All rules of all declared models and relationship types in one table."""
    parts = [check_model(graph, model) for model, _ in graph.tables.values()]
    for rel_type in graph.edges:
        parts.append(unique_edges(graph, rel_type))
        parts += [endpoints(graph, rel_type, end="src"), endpoints(graph, rel_type)]
    return reduce(DataFrame.unionByName, parts)


def enforce(violations: DataFrame, mode: str = "fail") -> DataFrame:
    """``report`` hands the violations on; ``fail`` raises on the first one."""
    if mode not in ("report", "fail"):
        raise ValueError("mode is 'report' or 'fail'")
    if mode == "fail":
        bad = violations.first()
        if bad is not None:
            cardinal = bad["rule"] in ("ZeroOrOne", "OneOrMore", "One", "ZeroOrMore")
            kind = CardinalityViolation if cardinal else ConstraintViolation
            raise kind(f"{bad['rule']}: {bad['subject']}.{bad['field']} {bad['item']} ({bad['n']})")
    return violations
