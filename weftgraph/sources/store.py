"""A graph as Parquet folders: one per label and one per relationship type.

Writing also cuts the lineage that a chain of batch writes builds up, and leaves a
state that survives lost executors.
"""

from __future__ import annotations

import json
from dataclasses import replace
from urllib.parse import quote

from pyspark.sql import types as T

from .graph import PropertyGraph, as_table, col
from .session import checkpointed


def _nodes(folder: str, label: str) -> str:
    return f"{folder}/nodes/{quote(label, safe='')}"


def _edges(folder: str, rel_type: str) -> str:
    return f"{folder}/edges/{quote(rel_type, safe='')}"


def _manifest(folder: str) -> str:
    return f"{folder}/manifest"


def write_graph(graph: PropertyGraph, folder: str, sort: bool = True) -> None:
    """Writes every table, and a manifest of what they are. Sorted by id, the files let a scan
    for some ids skip the rest.

    Rows are spread by range over the tasks, so that no single node decides the size
    of a file. Tables that the graph itself reads from the folder can't be written over.
    """
    entries = []
    for label, (_, frame) in graph.tables.items():
        rows = frame
        if sort:
            rows = frame.repartitionByRange(col("node_id")).sortWithinPartitions("node_id")
        rows.write.mode("overwrite").parquet(_nodes(folder, label))
        entries.append(("nodes", label, frame.schema.json(), False, False))
    for rel_type, edge in graph.edges.items():
        embedded = edge.owner is not None  # then its node table has it
        if not embedded:
            rows = edge.frame
            if sort:
                keys = [col("src_id"), col("edge_id")]
                rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
            rows.write.mode("overwrite").parquet(_edges(folder, rel_type))
        schema = "" if embedded else edge.frame.schema.json()
        entries.append(("edges", rel_type, schema, embedded, edge.verified))
    kinds = "kind string, name string, schema string, embedded boolean, verified boolean"
    listed = graph.spark.createDataFrame(entries, kinds).coalesce(1)
    listed.write.mode("overwrite").parquet(_manifest(folder))


def read_graph(declared: PropertyGraph, folder: str) -> PropertyGraph:
    """A written graph, its classes taken from the declarations of another one.

    Columns, and whether edges have a table of their own, are those that were written: a write
    may have added columns or turned embedded edges into a table.
    """
    spark, result = declared.spark, declared
    for entry in spark.read.parquet(_manifest(folder)).collect():
        if entry.kind == "nodes":
            model = declared.tables[entry.name][0]
            schema = T.StructType.fromJson(json.loads(entry.schema))
            result = result.with_nodes(model, spark.read.schema(schema).parquet(_nodes(folder, entry.name)))
        elif not entry.embedded:
            schema = T.StructType.fromJson(json.loads(entry.schema))
            rows = spark.read.schema(schema).parquet(_edges(folder, entry.name))
            edge = as_table(declared.edges[entry.name], rows)
            result = result._with(replace(edge, verified=entry.verified))
    return result


def checkpoint_graph(graph: PropertyGraph) -> PropertyGraph:
    """The same graph with all tables in the checkpoint folder."""
    result = graph
    for model, frame in graph.tables.values():
        result = result.with_nodes(model, checkpointed(frame))
    for edge in graph.edges.values():
        if edge.owner is None:
            result = result._with(as_table(edge, checkpointed(edge.frame)))
    return result
