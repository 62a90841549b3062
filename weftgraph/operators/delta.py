"""Batch writes that read and write only the buckets a batch touches.

The write operators work on graphs of any size. A store hands them a graph of the touched buckets
alone, and adds what came out differently as deltas of a new version. Nodes are placed by their id,
edges by their source; small copies of the merge keys (placed by them) and of the edges' ends
(placed by the target) find the buckets of what is asked for in other ways.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import Direction, NodeModel, RelationshipDef
from ..sources.graph import PropertyGraph, as_table, col, default_array
from ..sources.versions import (
    BUCKET,
    GONE,
    Folder,
    Manifest,
    TableState,
    bucket_of,
    compacted,
    differences,
    loose,
    lookup_rows,
    placed,
    with_segment,
)
from . import edges as E
from . import writes as W
from .constraints import connect_gates, enforce

TARGETS = "/by target"
KEYS = "/by key"


def node_name(model: type[NodeModel]) -> str:
    return f"nodes/{model.label_name()}"


def edge_name(rel_type: str) -> str:
    return f"edges/{rel_type}"


@dataclass(frozen=True)
class Touched:
    """What a write read of a table and added to it."""

    table: str
    buckets: int
    of: int
    read_bytes: int
    table_bytes: int
    written_rows: int = 0
    written_bytes: int = 0


@dataclass(frozen=True)
class Written:
    """The store after a write, what the write touched, and the rows handed back."""

    store: GraphStore
    touched: tuple[Touched, ...]
    rejected: DataFrame | None = None


@dataclass
class Part:
    """A graph of some buckets: the tables as they were read, and the buckets of each."""

    graph: PropertyGraph
    rows: dict[str, DataFrame] = field(default_factory=dict)
    buckets: dict[str, set[int] | None] = field(default_factory=dict)


class GraphStore:
    """A graph in versions. `graph()` is the whole of it; writes give the next version."""

    def __init__(self, declared: PropertyGraph, folder: Folder, manifest: Manifest):
        self.declared, self.folder, self.manifest = declared, folder, manifest

    # -- whole graphs -----------------------------------------------------
    @classmethod
    def create(
        cls,
        graph: PropertyGraph,
        path: str,
        buckets: int = 64,
        keys: Mapping[type[NodeModel], Sequence[str]] | None = None,
    ) -> GraphStore:
        """Writes the first version. `keys` are the properties that merges find nodes by (else the
        merge keys of each model). Embedded edges get a table of their own, ids of edges become text,
        and of edge properties the declared ones are kept."""
        folder = Folder(graph.spark, path)
        tables: dict[str, TableState] = {}
        given = {m.label_name(): list(k) for m, k in (keys or {}).items()}

        def add(name: str, rows: DataFrame, identity: str, place: Iterable[str]) -> None:
            state = TableState(loose(rows.schema).json(), identity, tuple(place))
            # tasks write what they read: a row of the first version does not travel
            first = folder.write(name, placed(state, rows, buckets), identity, True, moved=False)
            tables[name] = with_segment(state, first)

        for label, (model, frame) in graph.tables.items():
            if "labels" not in frame.columns:
                frame = frame.withColumn("labels", default_array(model.inherited_labels()))
            add(node_name(model), frame, "node_id", ["node_id"])
            found = given.get(label, model.merge_keys())
            if found:
                stored = [model.property(k).stored_name for k in found]
                few = frame.select("node_id", *map(col, stored))
                add(node_name(model) + KEYS, few, "node_id", stored)
        for rel_type, edge in graph.edges.items():
            frame = E.stored_names(edge, graph.edge_frame(rel_type))
            frame = frame.withColumn("edge_id", E._text(col("edge_id"), frame))
            add(edge_name(rel_type), frame, "edge_id", ["src_id"])
            ends = frame.select("edge_id", "src_id", "dst_id")
            add(edge_name(rel_type) + TARGETS, ends, "edge_id", ["dst_id"])
        verified = tuple(r for r, e in graph.edges.items() if e.verified)
        manifest = Manifest(1, buckets, tables, verified)
        folder.publish(manifest)
        return cls(graph, folder, manifest)

    @classmethod
    def open(cls, declared: PropertyGraph, path: str, version: int | None = None) -> GraphStore:
        """The newest version, or an earlier one; models come from the declarations."""
        folder = Folder(declared.spark, path)
        known = folder.versions()
        if not known or version is not None and version not in known:
            raise FileNotFoundError(f"no version {version or 1} in {path}")
        return cls(declared, folder, folder.manifest(known[-1] if version is None else version))

    def graph(self) -> PropertyGraph:
        return self._part({}).graph

    def _part(self, buckets: Mapping[str, set[int]]) -> Part:
        """The graph with only the given buckets of the tables named, and the rest whole."""
        part = Part(self.declared)
        graph = self.declared
        for model, _ in self.declared.tables.values():
            name = node_name(model)
            part.buckets[name] = buckets.get(name)
            part.rows[name] = self.folder.read(self.manifest.tables[name], buckets.get(name))
            graph = graph.with_nodes(model, part.rows[name].drop(BUCKET))
        for rel_type, edge in self.declared.edges.items():
            name = edge_name(rel_type)
            part.buckets[name] = buckets.get(name)
            part.rows[name] = self.folder.read(self.manifest.tables[name], buckets.get(name))
            own = as_table(edge, part.rows[name].drop(BUCKET))
            graph = graph._with(replace(own, verified=rel_type in self.manifest.verified))
        part.graph = graph
        return part

    # -- buckets of what is asked for -------------------------------------
    def _buckets(self, name: str, rows: DataFrame, columns: Sequence[str]) -> set[int]:
        """Buckets of the rows' values: a number for each bucket at most comes to the driver."""
        state = self.manifest.tables[name]
        kinds = {f.name: f.dataType for f in state.struct().fields}
        values = [col(c).cast(kinds[p]) for c, p in zip(columns, state.place, strict=True)]
        found = rows.select(bucket_of(values, self.manifest.buckets).alias("b")).distinct()
        return {r["b"] for r in found.collect()}

    def _nodes(self, model: type[NodeModel], ids: DataFrame) -> dict[str, set[int]]:
        return {node_name(model): self._buckets(node_name(model), ids, ["node_id"])}

    def _edges(self, rel_type: str, starts: DataFrame | None, ends: DataFrame | None) -> dict[str, set[int]]:
        """Buckets of the edges that begin at one of starts, or end at one of ends (`id`)."""
        name, found = edge_name(rel_type), set()
        if starts is not None:
            found |= self._buckets(name, starts, ["id"])
        if ends is not None:
            copy = name + TARGETS
            there = self.folder.read(
                self.manifest.tables[copy], self._buckets(copy, ends, ["id"])
            )
            hit = there.join(ends.select(col("id").alias("~id")), col("dst_id") == col("~id"), "left_semi")
            found |= self._buckets(name, hit.select(col("src_id").alias("id")), ["id"])
        return {name: found}

    def _near(self, rel: RelationshipDef, ids: DataFrame) -> dict[str, set[int]]:
        """Buckets of all edges of the near nodes."""
        starts = ids if rel.direction != Direction.INCOMING else None
        ends = ids if rel.direction != Direction.OUTGOING else None
        return self._edges(rel.rel_type, starts, ends)

    def _between(self, rel: RelationshipDef, pairs: DataFrame, near: str, *far: str) -> dict[str, set[int]]:
        """Buckets of the edges that join pairs: those of their sources."""
        if rel.direction == Direction.OUTGOING:
            used = [near]
        else:
            used = list(far) if rel.direction == Direction.INCOMING else [near, *far]
        ids = pairs.select(F.explode(F.array(*[col(c).cast("string") for c in used])).alias("id"))
        return self._edges(rel.rel_type, ids, None)

    def _asked(self, rel: RelationshipDef, pairs: DataFrame) -> tuple[dict[str, set[int]], bool]:
        """Buckets of the edges that join pairs, and whether a pair has a null property."""
        name = edge_name(rel.rel_type)
        state = self.manifest.tables[name]
        source = col("near_id" if rel.direction == Direction.OUTGOING else "far_id").cast("string")
        kind = next(f.dataType for f in state.struct().fields if f.name == "src_id")
        pairs, props = E.with_defaults(self.declared.edge_table(rel.rel_type), pairs)
        nulls = reduce(lambda a, b: a | b, [col(p).isNull() for p in props], F.lit(False))
        found = (
            pairs.select(
                bucket_of([source.cast(kind)], self.manifest.buckets).alias("b"), nulls.alias("n")
            )
            .groupBy("b")
            .agg(F.bool_or("n").alias("n"))
            .collect()
        )
        return {name: {r["b"] for r in found}}, any(r["n"] for r in found)

    # -- a new version ----------------------------------------------------
    def _commit(self, part: Part, after: PropertyGraph, rejected: DataFrame | None = None) -> Written:
        tables, touched = dict(self.manifest.tables), []
        verified = set(self.manifest.verified)

        def add(name: str, new: DataFrame) -> None:
            state = tables[name]
            changes = differences(state, part.rows[name], new, self.manifest.buckets)
            report = Touched(
                name,
                self.manifest.buckets if part.buckets[name] is None else len(part.buckets[name]),
                self.manifest.buckets,
                state.size(part.buckets[name]),
                state.size(),
            )
            rows = changes.count()
            if rows:
                chosen = [*state.struct().names, BUCKET, GONE]
                segment = self.folder.write(name, changes.select(*map(col, chosen)), state.identity, False)
                tables[name] = with_segment(state, segment)
                report = replace(report, written_rows=rows, written_bytes=sum(segment.buckets.values()))
                for suffix in (KEYS, TARGETS):
                    if name + suffix in tables:
                        copy = tables[name + suffix]
                        few = lookup_rows(copy, state, changes, self.manifest.buckets)
                        segment = self.folder.write(name + suffix, few, copy.identity, False)
                        tables[name + suffix] = with_segment(copy, segment)
            touched.append(report)

        for label, (model, frame) in after.tables.items():
            if frame is not part.graph.tables[label][1]:
                add(node_name(model), frame)
        for rel_type, edge in after.edges.items():
            if edge is not part.graph.edges[rel_type]:
                frame = edge.frame
                add(edge_name(rel_type), frame.withColumn("edge_id", E._text(col("edge_id"), frame)))
                verified -= set() if edge.verified else {rel_type}
        manifest = Manifest(
            self.manifest.version + 1, self.manifest.buckets, tables, tuple(sorted(verified))
        )
        self.folder.publish(manifest)
        store = GraphStore(self.declared, self.folder, manifest)
        return Written(store, tuple(touched), rejected)

    def _commit_additions(self, part: Part, rel_type: str, rows: DataFrame) -> Written | None:
        """A version with new edges, or None if an edge of their id is there already.

        The rows are written once, and the copy by target and the test of ids read that.
        """
        name, tables = edge_name(rel_type), dict(self.manifest.tables)
        state, buckets = tables[name], self.manifest.buckets
        fresh = dict(base=False, fresh=True, moved=False)
        segment = self.folder.write(name, placed(state, rows, buckets), state.identity, **fresh)
        new = self.folder.read(replace(state, segments=(segment,)))
        report = Touched(
            name, len(part.buckets[name]), buckets, state.size(part.buckets[name]), state.size()
        )
        if segment.buckets:
            old = part.rows[name].where(F.length("edge_id") == E.HASHED)
            if _repeated(old.select("edge_id").unionByName(new.select("edge_id"))):
                return None
            tables[name] = with_segment(state, segment)
            report = replace(
                report, written_rows=new.count(), written_bytes=sum(segment.buckets.values())
            )
            copy = tables[name + TARGETS]
            ends = placed(copy, new.select("edge_id", "src_id", "dst_id"), buckets)
            tables[name + TARGETS] = with_segment(
                copy, self.folder.write(name + TARGETS, ends, copy.identity, **fresh)
            )
        verified = tuple(r for r in self.manifest.verified if r != rel_type)
        manifest = Manifest(self.manifest.version + 1, buckets, tables, verified)
        self.folder.publish(manifest)
        return Written(GraphStore(self.declared, self.folder, manifest), (report,))

    def compact(self, least: int = 4) -> GraphStore:
        """A version with the same rows in which no bucket has `least` or more deltas."""
        tables = {
            name: compacted(self.folder, name, state, least)
            for name, state in self.manifest.tables.items()
        }
        if all(tables[n] is s for n, s in self.manifest.tables.items()):
            return self
        manifest = replace(self.manifest, version=self.manifest.version + 1, tables=tables)
        self.folder.publish(manifest)
        return GraphStore(self.declared, self.folder, manifest)

    # -- nodes ------------------------------------------------------------
    def create_nodes(
        self, model: type[NodeModel], rows: Any, new_id: Column | str | None = None
    ) -> Written:
        """Adds nodes; their ids must be new. Nothing is read."""
        part = self._part({node_name(model): set()})
        return self._commit(part, W.create(part.graph, model, rows, new_id))

    def get_or_create(self, model: type[NodeModel], rows: Any, **options: Any) -> Written:
        return self._merge(W.get_or_create, model, rows, options)

    def create_or_update(self, model: type[NodeModel], rows: Any, **options: Any) -> Written:
        return self._merge(W.create_or_update, model, rows, options)

    def _merge(self, function, model, rows: Any, options: dict) -> Written:
        """Only nodes whose keys the batch has can match: the copy of the keys tells their ids.

        Merging by other properties than those of the copy reads the whole table.
        """
        batch = W.as_batch(self.declared, model, rows)
        by = options.get("merge_by")
        keys = list(by["keys"]) if by else model.merge_keys()
        name = node_name(model) + KEYS
        stored = [model.property(k).stored_name for k in keys]
        copy = self.manifest.tables.get(name)
        buckets: dict[str, set[int]] = {}
        if copy is not None and sorted(copy.place) == sorted(stored):
            order = [keys[stored.index(p)] for p in copy.place]
            there = self.folder.read(copy, self._buckets(name, batch, order))
            wanted = batch.select(*[col(k).alias(f"~{p}") for k, p in zip(order, copy.place)])
            on = [col(p) == col(f"~{p}") for p in copy.place]
            buckets = self._nodes(model, there.join(wanted, on, "left_semi").select("node_id"))
        part = self._part(buckets)
        done = function(part.graph, model, batch, **options)
        return self._commit(part, done.graph, done.rejected)

    def save(self, model: type[NodeModel], batch: DataFrame) -> Written:
        part = self._part(self._nodes(model, batch))
        return self._commit(part, W.save(part.graph, model, batch))

    def delete(self, model: type[NodeModel], ids: DataFrame) -> Written:
        """Nodes and their edges: of the edges, the buckets that begin or end at one of them."""
        buckets = self._nodes(model, ids)
        own = ids.select(col("node_id").alias("id"))
        for rel_type, edge in self.declared.edges.items():
            at = [issubclass(model, e) or issubclass(e, model) for e in (edge.src, edge.dst)]
            if any(at):
                buckets |= self._edges(rel_type, own if at[0] else None, own if at[1] else None)
        part = self._part(buckets)
        return self._commit(part, W.delete(part.graph, model, ids))

    def merge_under(
        self, source: type[NodeModel], rel_name: str, rows: DataFrame, **options: Any
    ) -> Written:
        """As the operator; rows have their `source_id`. Read are the sources' edges and targets."""
        rel = source.relationship(rel_name)
        ids = rows.select(col("source_id").alias("id"))
        buckets = self._near(rel, ids)
        edges = self._part(buckets).graph.oriented_edges(source, rel)
        far = edges.join(ids.select(col("id").alias("~id")), col("near_id") == col("~id"), "left_semi")
        buckets |= self._nodes(rel.target, far.select(col("far_id").alias("node_id")))
        part = self._part(buckets)
        done = W.merge_under(part.graph, source, rel_name, rows, **options)
        return self._commit(part, done.graph, done.rejected)

    # -- edges ------------------------------------------------------------
    def connect(
        self,
        model: type[NodeModel],
        rel_name: str,
        pairs: DataFrame,
        new_edge_id: Column | str | None = None,
        checked: bool = False,
    ) -> Written:
        """With `checked`, the cardinality gates see all edges of both ends first."""
        rel = model.relationship(rel_name)
        if new_edge_id is None and rel.direction != Direction.EITHER:
            buckets, nulls = self._asked(rel, pairs)
        else:
            buckets, nulls = self._between(rel, pairs, "near_id", "far_id"), True
        part = self._part(buckets)
        if checked:
            ids = pairs.select(
                F.explode(F.array(col("near_id").cast("string"), col("far_id").cast("string"))).alias("id")
            )
            wide = self._part(self._edges(rel.rel_type, ids, ids)).graph
            enforce(connect_gates(wide, model, rel_name, pairs), "fail")
        rows = None if nulls else E.additions(part.graph, model, rel_name, pairs)
        done = None if rows is None else self._commit_additions(part, rel.rel_type, rows)
        if done is not None:
            return done
        return self._commit(part, E.connect(part.graph, model, rel_name, pairs, new_edge_id))

    def disconnect(self, model: type[NodeModel], rel_name: str, pairs: DataFrame) -> Written:
        rel = model.relationship(rel_name)
        part = self._part(self._between(rel, pairs, "near_id", "far_id"))
        return self._commit(part, E.disconnect(part.graph, model, rel_name, pairs))

    def disconnect_all(self, model: type[NodeModel], rel_name: str, ids: DataFrame) -> Written:
        rel = model.relationship(rel_name)
        part = self._part(self._near(rel, ids.select(col("node_id").alias("id"))))
        return self._commit(part, E.disconnect_all(part.graph, model, rel_name, ids))

    def replace_edges(
        self,
        model: type[NodeModel],
        rel_name: str,
        pairs: DataFrame,
        new_edge_id: Column | str | None = None,
    ) -> Written:
        rel = model.relationship(rel_name)
        near = self._near(rel, pairs.select(col("near_id").alias("id")))
        name = edge_name(rel.rel_type)
        near[name] |= self._between(rel, pairs, "near_id", "far_id")[name]
        part = self._part(near)
        return self._commit(part, E.replace_edges(part.graph, model, rel_name, pairs, new_edge_id))

    def reconnect(
        self,
        model: type[NodeModel],
        rel_name: str,
        moves: DataFrame,
        new_edge_id: Column | str | None = None,
    ) -> Written:
        rel = model.relationship(rel_name)
        part = self._part(self._between(rel, moves, "near_id", "old_id", "new_id"))
        return self._commit(part, E.reconnect(part.graph, model, rel_name, moves, new_edge_id))

    def save_edges(self, rel_type: str, batch: DataFrame) -> Written:
        """By `edge_id`; with a `src_id` in the batch only the buckets of the sources are read."""
        buckets: dict[str, set[int]] = {}
        if "src_id" in batch.columns:
            buckets = self._edges(rel_type, batch.select(col("src_id").alias("id")), None)
        part = self._part(buckets)
        values = batch.withColumn("edge_id", E._text(col("edge_id"), batch)).drop("src_id")
        return self._commit(part, E.save_edges(part.graph, rel_type, values))


def _repeated(ids: DataFrame) -> bool:
    """Whether a value is there twice. Hashes of them travel, and values only where hashes agree."""
    hashed = ids.select("edge_id", F.xxhash64("edge_id").alias("~hash"))
    twice = hashed.groupBy("~hash").count().where("count > 1").select("~hash")
    if twice.isEmpty():
        return False
    alike = hashed.join(twice, "~hash", "left_semi").groupBy("edge_id").count()
    return not alike.where("count > 1").isEmpty()


def touched_frame(written: Written) -> DataFrame:
    """What a write touched, as rows."""
    kinds = T.StructType(
        [T.StructField("table", T.StringType())]
        + [
            T.StructField(n, T.LongType())
            for n in ("buckets", "of", "read_bytes", "table_bytes", "written_rows", "written_bytes")
        ]
    )
    rows = [tuple(vars(t).values()) for t in written.touched]
    return written.store.declared.spark.createDataFrame(rows, kinds)
