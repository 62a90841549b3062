"""What a graph looks like: labels, properties, relationships and likely rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import Direction, NodeModel, RelationshipDef
from ..sources.graph import EdgeTable, PropertyGraph, col
from .constraints import degrees

# Property kind by column type.
PROPERTY_KIND = [
    (T.ArrayType, "ArrayProperty"),
    (T.BooleanType, "BooleanProperty"),
    (T.DateType, "DateProperty"),
    (T.TimestampType, "DateTimeNativeProperty"),
    (T.TimestampNTZType, "DateTimeNativeProperty"),
    (T.IntegralType, "IntegerProperty"),
    (T.FractionalType, "FloatProperty"),
    (T.StringType, "StringProperty"),
    (T.StructType, "PointProperty"),
]


def kind_of(dtype: T.DataType) -> str:
    return next((name for t, name in PROPERTY_KIND if isinstance(dtype, t)), "StringProperty")


def labels(graph: PropertyGraph) -> DataFrame:
    """Every label with its number of nodes."""
    parts = [
        graph.node_frame(model).select(F.explode("labels").alias("label"))
        for model, _ in graph.tables.values()
    ]
    whole = reduce(DataFrame.unionByName, parts)
    return whole.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def _present(names: list[str]) -> Column:
    return F.array_compact(F.array(*[F.when(col(n).isNotNull(), F.lit(n)) for n in names]))


def _richest(frame: DataFrame, names: list[str]) -> DataFrame:
    """The property names of the row that has most of them, as one array."""
    present = _present(sorted(names))
    return frame.agg(
        F.max(F.struct(F.size(present).alias("n"), present.alias("names"))).alias("best")
    ).select(col("best")["names"].alias("names"))


def node_properties(graph: PropertyGraph, model: type[NodeModel]) -> DataFrame:
    """Property names and kinds of the node with most properties."""
    frame = graph.node_frame(model)
    names = list(model.properties())
    if not names:
        schema = "label string, property string, kind string"
        return graph.spark.createDataFrame([], schema)
    kinds = [F.lit(x) for n in names for x in (n, kind_of(frame.schema[n].dataType))]
    return _richest(frame, names).select(
        F.lit(model.label_name()).alias("label"), F.explode("names").alias("property")
    ).withColumn("kind", F.create_map(*kinds)[col("property")])


def outgoing(graph: PropertyGraph, model: type[NodeModel]) -> DataFrame:
    """Relationship types that leave a label: type, target label and property names."""
    parts = []
    for edge in graph.edges.values():
        if edge.src is not model:
            continue
        names = edge.prop_names()
        edges = graph.edge_frame(edge.rel_type)
        present = _present(sorted(names)) if names else F.array().cast("array<string>")
        # per target node first, so that a popular target is one row in the join
        per_target = edges.groupBy("dst_id").agg(
            F.max(F.struct(F.size(present).alias("k"), present.alias("names"))).alias("best"),
            F.count(F.lit(1)).alias("n"),
        )
        targets = graph.node_frame(edge.dst).select("node_id", "labels")
        found = per_target.join(targets, col("dst_id") == col("node_id"))
        parts.append(
            found.groupBy(col("labels")[0].alias("target"))
            .agg(F.max("best").alias("best"), F.sum("n").alias("n"))
            .select(
                F.lit(model.label_name()).alias("label"),
                F.lit(edge.rel_type).alias("rel_type"),
                "target",
                F.array_join(col("best")["names"], ",").alias("properties"),
                "n",
            )
        )
    if not parts:
        schema = "label string, rel_type string, target string, properties string, n bigint"
        return graph.spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def inferred_cardinality(graph: PropertyGraph, edge: EdgeTable) -> DataFrame:
    """The likely cardinality of a type at its start, with the degrees behind it.

    "Zero" if any node lacks the edge, else "One"; "OrOne" only if no node has more
    than one and some have none, else "OrMore".
    """
    rel = RelationshipDef(edge.dst, edge.rel_type, Direction.OUTGOING)
    counted = degrees(graph, edge.src, rel)
    nodes = graph.node_frame(edge.src).select("node_id")
    per_node = nodes.join(counted, col("node_id") == col("near_id"), "left").select(
        F.coalesce(col("n"), F.lit(0)).alias("n")
    )
    ends = per_node.agg(F.min("n").alias("least"), F.max("n").alias("most"))
    zero = col("least") == 0
    first = F.when(zero, F.lit("Zero")).otherwise(F.lit("One"))
    second = F.when(zero & (col("most") <= 1), F.lit("OrOne")).otherwise(F.lit("OrMore"))
    return ends.select(
        F.lit(edge.src.label_name()).alias("label"),
        F.lit(edge.rel_type).alias("rel_type"),
        F.concat(first, second).alias("cardinality"),
        "least",
        "most",
    )


def unique_candidates(graph: PropertyGraph, model: type[NodeModel]) -> DataFrame:
    """Properties whose non-null values never repeat; one shuffle for all of them."""
    names = list(model.properties())
    frame = graph.node_frame(model)
    values = F.array(
        *[
            F.struct(F.lit(n).alias("property"), col(n).cast("string").alias("value"))
            for n in names
        ]
    )
    return (
        frame.select(F.explode(values).alias("v"))
        .groupBy(col("v")["property"].alias("property"), col("v")["value"].alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("property")
        .agg(
            F.coalesce(
                F.max(F.when(col("value").isNotNull(), col("n"))) == 1, F.lit(False)
            ).alias("unique")
        )
        .select(F.lit(model.label_name()).alias("label"), "property", "unique")
    )


def report(graph: PropertyGraph) -> DataFrame:
    """One row per property and per relationship of every label."""
    parts = []
    for model, _ in graph.tables.values():
        if model.properties():
            unique = unique_candidates(graph, model).select(
                "property", F.when(col("unique"), "unique").otherwise("").alias("detail")
            )
            parts.append(
                node_properties(graph, model)
                .join(unique, "property")
                .select("label", col("property").alias("name"), "kind", "detail")
            )
    for edge in graph.edges.values():
        ends = outgoing_of(graph, edge)
        # one value for each type: a scalar, not a join on a constant
        rule = inferred_cardinality(graph, edge).select("cardinality").scalar()
        parts.append(
            ends.select(
                "label",
                col("rel_type").alias("name"),
                F.concat(F.lit("to "), col("target")).alias("kind"),
                rule.alias("detail"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def outgoing_of(graph: PropertyGraph, edge: EdgeTable) -> DataFrame:
    only = PropertyGraph(graph.spark, graph.tables, {edge.rel_type: edge})
    return outgoing(only, edge.src)
