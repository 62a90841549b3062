"""From a NodeSet to a DataFrame.

Every bound variable (node, edge or value) is carried as flat columns named
``variable.property``; structs are packed only for the final result. The steps follow
the meaning of the query: root and top-k search, required paths, conditions, existence,
optional paths, conditions over both, sub-queries, transforms, annotations, order, page.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import RelationshipClassNotDefined
from ..functions.aggregates import (
    AnnotateFunction,
    Collect,
    Last,
    NodeNameResolver,
    RelationNameResolver,
    ScalarFunction,
    Size,
)
from ..functions.lookups import Lookup, Q, lookup_column, split_path
from ..functions.ordering import RawExpr, SortKey, comparable
from ..model import Direction, NodeModel, RelationshipDef
from ..sources.graph import col, embedded_prop, key_column
from .nodeset import NodeSet, Path, Traversal
from .positions import POSITION, numbered
from .product import product
from .semantic import fulltext_topk, vector_topk


@dataclass(frozen=True)
class Bound:
    """A variable: where its id and its properties are in the frame."""

    kind: str  # node, edge or value
    id: str
    cols: dict[str, str] = field(default_factory=dict)
    model: type[NodeModel] | None = None
    rel: RelationshipDef | None = None
    embedded: dict[str, str] = field(default_factory=dict)
    optional: int | None = None

    def column(self, prop: str) -> Column:
        """A property column; fields of a packed value are reached by name."""
        if self.kind == "value":
            return col(self.id)[prop] if prop else col(self.id)
        return col(self.flat(prop))

    def flat(self, prop: str) -> str:
        """The name of the flat column of a property."""
        if self.kind == "value" or prop == "id":
            return self.id
        if prop not in self.cols and self.model is not None:
            prop = self.model.property(prop).name
        elif prop not in self.cols and self.rel is not None and self.rel.model is not None:
            prop = self.rel.model.property(prop).name
        if prop not in self.cols:
            raise ValueError(f"No such property {prop}")
        return self.cols[prop]

    def packed(self, only: set[str] | None = None) -> Column:
        """The whole variable as one column; null where an optional path is missing."""
        if self.kind == "value":
            return col(self.id)
        kept = {p: c for p, c in self.cols.items() if only is None or p in only}
        first = "node_id" if self.kind == "node" else "edge_id"
        fields = [col(self.id).alias(first)]
        fields += [col(c).alias(p) for p, c in kept.items() if p != first]
        return F.when(col(self.id).isNotNull(), F.struct(*fields))


def exported_names(ns: NodeSet) -> set[str]:
    """The names a sub-query may hand to the outer query."""
    bound = Composition(ns, until_conditions=True)
    names = {ns.model.label_name().lower(), *bound.returns}
    for step in ns.transforms:
        names |= {n for n, spec in step.vars.items() if spec.get("include_in_return")}
    for sq in ns.subqueries:
        names |= set(sq.return_set)
    for alias, function in ns.extras:
        inner: Any = function
        while isinstance(inner, AnnotateFunction):
            inner = inner.source
        names.add(alias or bound._source_name(inner))
    return names


@dataclass(frozen=True)
class Annotation:
    name: str
    function: AnnotateFunction
    bound: Bound


class Composition:
    def __init__(
        self,
        ns: NodeSet,
        requested: list[str] | None = None,
        keep: list[str] | None = None,
        seed: tuple[DataFrame, str | None, dict[str, Bound]] | None = None,
        until_conditions: bool = False,
        inside: bool = False,
    ):
        self.ns, self.graph = ns, ns.graph
        self.requested = requested
        self.vars: dict[str, Bound] = {}
        self.tree: dict[str, Any] = {}
        self.returns: list[str] = []
        self.row_key: list[str] = []
        self.root_frame: DataFrame | None = None
        self._reads: set[str] | None = None
        self.types: dict[str, Any] = {}  # of the flat columns that came from tables
        self.inside = inside  # a sub-query does not return its own root
        self.aggregates: dict[str, Annotation] = {}
        self.keep = list(keep or [])  # context columns every step must carry
        self.pending: list[SortKey] = []
        self.owner_of: dict[tuple[str, ...], int] = {}
        self.root_name = ns.model.label_name().lower()
        self.optional_frames: list[tuple[DataFrame, Column | None, list[str]]] = []
        self.counters = {"rel": 0, "node": 0}
        self.total = False  # an aggregate without grouping columns
        self.annotations: list[Annotation] = []
        self.grouped = False

        self._root(seed)
        self._paths()
        self._conditions()
        if until_conditions:
            return
        self._subqueries()
        self._transforms()
        self._resolve_annotations()
        self._annotate()

    # ------------------------------------------------------------------ root
    def _root(self, seed) -> None:
        ns = self.ns
        if isinstance(ns.source, Traversal):
            self._root_from_traversal(ns.source)
        else:
            frame = self.graph.node_frame(ns.model, embedded=True)
            given = ns.source
            if given is not None and not isinstance(given, DataFrame):
                given = list(given) if isinstance(given, (list, tuple, set)) else [given]
                kind = frame.schema["node_id"].dataType.simpleString()
                given = self.graph.spark.createDataFrame([(i,) for i in given], f"node_id {kind}")
            if isinstance(given, DataFrame):
                frame = frame.join(given.select("node_id"), "node_id", "left_semi")
            if ns.vector is not None:
                frame = vector_topk(frame, ns.model, ns.vector)
            if ns.fulltext is not None:
                frame = fulltext_topk(frame, ns.model, ns.fulltext)
            self.df = self._renamed(frame, self.root_name)
            self.root_frame = self.df
            self.root = self._node_bound(frame, self.root_name, ns.model)
            self.row_key = [self.root.id]
        self.vars[self.root_name] = self.root
        if not self.inside:
            self.returns.append(self.root_name)
        if ns.vector is not None or ns.fulltext is not None:
            self.vars["score"] = Bound("value", f"{self.root_name}.~score")
            self.returns.append("score")
        if ns.keep_source:
            self.vars["source_id"] = Bound("value", "~source")
            self.returns.insert(0, "source_id")
        if seed is not None:
            frame, on, imported = seed
            if on is None:
                self.df = product(self.df, frame)
            else:
                self.df = self.df.join(frame, col(self.root.id) == col(on))
            self.vars.update(imported)

    def _renamed(self, frame: DataFrame, name: str) -> DataFrame:
        names = [f"{name}.{c}" for c in frame.columns]
        self.types.update(zip(names, (f.dataType for f in frame.schema.fields)))
        return frame.toDF(*names)

    @staticmethod
    def _node_bound(frame: DataFrame, name: str, model: type[NodeModel]) -> Bound:
        cols, embedded = {}, {}
        for c in frame.columns:
            if c.startswith("~"):
                embedded[c] = f"{name}.{c}"
            else:
                cols[c] = f"{name}.{c}"
        embedded.pop("~score", None)
        return Bound("node", f"{name}.node_id", cols, model, embedded=embedded)

    def _root_from_traversal(self, source: Traversal) -> None:
        inner = Composition(source.start)
        inner_df = inner.paged()
        # nothing of the start nodes is kept but their ids and embedded keys
        kept = [col(inner.root.id).alias("~source")]
        kept += [col(c).alias(f"~start.{h}") for h, c in inner.root.embedded.items()]
        start = Bound(
            "node",
            "~source",
            {"node_id": "~source"},
            source.start.model,
            embedded={h: f"~start.{h}" for h in inner.root.embedded},
        )
        self.df = inner_df.select(*kept)
        node, edge = self.root_name, "r0"
        path = Path(source.rel.name, max_hops=source.max_hops)
        self.df, bound_node, bound_edge = self._hop(self.df, start, source.rel, node, edge, path)
        for lookup in source.edge_lookups:
            c = bound_edge.column(lookup.prop)
            self.df = self.df.where(lookup_column(c, self._type(c), lookup))
        self.root = bound_node
        self.row_key = ["~source", bound_edge.id]
        if bound_node.id not in self.row_key:
            self.row_key.append(bound_node.id)

    # ------------------------------------------------------------------ hops
    def _hop(
        self,
        df: DataFrame,
        near: Bound,
        rel: RelationshipDef,
        node: str,
        edge: str,
        path: Path,
        same: Bound | None = None,
        how: str = "inner",
        needed: bool = True,
    ) -> tuple[DataFrame, Bound, Bound]:
        """Follows one relationship from ``near``; ``same`` fixes the node reached.

        A node of which only the id is ``needed`` is not joined if its edge is known to
        end at an existing node.
        """
        table = None
        if rel.rel_type not in (None, "*"):
            table = self.graph.edge_table(rel.rel_type)
        if table is not None and table.owner is not None and rel.direction != Direction.EITHER:
            outgoing = rel.direction == Direction.OUTGOING
            near_owns = (table.owner_end == "src") == outgoing
            hidden = key_column(rel.rel_type)
            if near_owns and hidden in near.embedded:
                return self._hop_by_own_key(df, near, rel, node, edge, same, how, needed)
            if not near_owns and same is not None and hidden in same.embedded:
                df = df.where(col(same.embedded[hidden]) == col(near.id))
                df, bound = self._embedded_edge(df, same, near.id, rel, edge, False)
                return df, same, bound
            if not near_owns and same is None and self._sole_table(rel.target, table.owner):
                frame = self.graph.node_frame(rel.target, embedded=True)
                right = self._renamed(frame, node)
                bound = self._node_bound(frame, node, rel.target)
                df = df.join(right, col(near.id) == col(bound.embedded[hidden]), how)
                df, bound_edge = self._embedded_edge(df, bound, near.id, rel, edge, how == "left")
                return df, bound, bound_edge
        edges = self.graph.oriented_edges(near.model, rel, path.max_hops)
        right = self._renamed(edges, edge)
        bound_edge = self._edge_bound(edges, edge, rel)
        on = col(near.id) == col(f"{edge}.near_id")
        if same is not None:
            df = df.join(right, on & (col(f"{edge}.far_id") == col(same.id)), how)
            return df, same, bound_edge
        if not needed and table is not None and table.verified and how == "inner":
            far_id = f"{edge}.far_id"
            return df.join(right, on), Bound("node", far_id, {"node_id": far_id}, rel.target), bound_edge
        frame = self.graph.node_frame(rel.target, embedded=True)
        nodes = self._renamed(frame, node)
        bound = self._node_bound(frame, node, rel.target)
        far = col(f"{edge}.far_id") == col(bound.id)
        if how == "inner":
            return df.join(right, on).join(nodes, far), bound, bound_edge
        return df.join(right.join(nodes, far), on, how), bound, bound_edge

    def _hop_by_own_key(self, df, near, rel, node, edge, same, how, needed):
        hidden = near.embedded[key_column(rel.rel_type)]
        if same is not None:
            df = df.where(col(hidden) == col(same.id))
            bound = same
        elif not needed and self.graph.edge_table(rel.rel_type).verified:
            bound = Bound("node", hidden, {"node_id": hidden}, rel.target)
            df = df.where(col(hidden).isNotNull()) if how == "inner" else df
        else:
            frame = self.graph.node_frame(rel.target, embedded=True)
            bound = self._node_bound(frame, node, rel.target)
            df = df.join(self._renamed(frame, node), col(hidden) == col(bound.id), how)
        df, bound_edge = self._embedded_edge(df, near, bound.id, rel, edge, how == "left")
        return df, bound, bound_edge

    def _embedded_edge(self, df, owner: Bound, other_id: str, rel, edge: str, outer: bool):
        """Edge columns taken from the node row that holds the edge.

        After an outer join they are null unless both ends are there; otherwise they
        are the plain columns, so that conditions on them reach the scan.
        """
        table = self.graph.edge_table(rel.rel_type)
        own, other = col(owner.id), col(other_id)
        present = own.isNotNull() & other.isNotNull()
        ends = (own, other) if table.owner_end == "src" else (other, own)
        made = {"edge_id": own, "src_id": ends[0], "dst_id": ends[1]}
        for prop in table.props:
            hidden = owner.embedded[embedded_prop(rel.rel_type, prop)]
            made[prop] = col(hidden)
            self.types[f"{edge}.{prop}"] = self.types.get(hidden)
        if outer:
            made = {p: F.when(present, c) for p, c in made.items()}
        df = df.withColumns({f"{edge}.{p}": c for p, c in made.items()})
        cols = {p: f"{edge}.{p}" for p in made}
        return df, Bound("edge", f"{edge}.edge_id", cols, rel=rel)

    @staticmethod
    def _edge_bound(edges: DataFrame, edge: str, rel: RelationshipDef) -> Bound:
        cols = {c: f"{edge}.{c}" for c in edges.columns if c not in ("near_id", "far_id")}
        return Bound("edge", f"{edge}.edge_id", cols, rel=rel)

    def _sole_table(self, target: type[NodeModel], owner: type[NodeModel]) -> bool:
        tables = self.graph.tables_of(target)
        return len(tables) == 1 and tables[0][0] is owner

    # ------------------------------------------------------------------ paths
    def _paths(self) -> None:
        for index, path in enumerate(self.ns.paths):
            self._walk(path, index)
        known = len(self.ns.paths)
        drop_score = False
        for lookup in self.ns.q.lookups():
            if lookup.path and self._find(lookup.path) is None:
                self._walk(Path("__".join(lookup.path), on_edge=lookup.on_edge), known)
                known += 1
                drop_score = True
        if drop_score and "score" in self.returns:
            self.returns.remove("score")

    def _walk(self, path: Path, index: int) -> None:
        parts = split_path(path.value)
        steps, model = [], self.ns.model
        for name in parts:
            rel = model.relationship(name)
            if rel.rel_type not in (None, "*") and rel.rel_type not in self.graph.edges:
                raise RelationshipClassNotDefined(
                    f"path {path.value!r} needs edges of type {rel.rel_type!r}, "
                    "which the graph lacks"
                )
            steps.append(rel)
            model = rel.target
        if self._find(parts) is not None:
            return  # the same path again reuses the binding
        optional = len(self.optional_frames) if path.optional else None
        df, near = self.df, self.root
        if path.optional and not self._single_step_from_key(steps):
            df, near = None, None
        tree, seen, conditions, new_keys = self.tree, [], [], []
        for i, rel in enumerate(steps):
            prefix = "__".join(parts[: i + 1])
            last = i + 1 == len(parts)
            self.counters["rel"] += 1
            edge = f"r{self.counters['rel']}"
            same, node = None, f"{rel.target.label_name().lower()}_{prefix}"
            if last and path.alias:
                node = path.alias
            elif prefix in self.ns.unique:
                same = self.vars.get(node)
            else:
                self.counters["node"] += 1
                node = f"{node}{self.counters['node']}"
            how = "left" if path.optional and df is not None and i == 0 else "inner"
            needed = self._node_needed(prefix, node) or (
                not last and self._holds_key(rel.target, steps[i + 1])
            )
            detached = path.optional and df is not self.df
            if detached and same is not None:
                # the fixed node is outside this frame: match again, compare in the join
                shown, fixed, same = f"{node}~{edge}", same, None
            else:
                shown, fixed = node, None
            if df is None:
                # an optional path starts as a frame of its own, keyed by the root id
                df, near_col, bound, bound_edge = self._detached(rel, shown, edge, path)
                root_key = near_col
                ids = self._selected_roots()
                if ids is not None:
                    df = df.join(ids, col(near_col) == col("~root"), "left_semi")
            else:
                df, bound, bound_edge = self._hop(
                    df, near, rel, shown, edge, path, same, how, needed
                )
            if fixed is not None:
                conditions.append(col(fixed.id) == col(bound.id))
            for other_type, other_id in seen:
                if other_type == rel.rel_type:
                    df = df.where(col(other_id) != col(bound_edge.id))
            seen.append((rel.rel_type, bound_edge.id))
            new_keys.append(bound_edge.id)
            if same is None:
                new_keys.append(bound.id)
            bound = replace(bound, optional=optional) if same is None else bound
            bound_edge = replace(bound_edge, optional=optional)
            self.vars.setdefault(node, bound)
            self.vars[edge] = bound_edge
            if parts[i] not in tree:
                if path.include_nodes_in_return and not path.on_edge and node not in self.returns:
                    self.returns.append(node)
                if path.include_rels_in_return:
                    self.returns.append(edge)
                tree[parts[i]] = {"node": node, "edge": edge, "children": {}}
                self.owner_of[tuple(parts[: i + 1])] = index
            tree = tree[parts[i]]["children"]
            near = bound
        self.row_key += [k for k in new_keys if k not in self.row_key]
        if not path.optional:
            self.df = df
        elif how == "left" and len(steps) == 1:
            self.optional_frames.append((df, None, []))
            self.df = df
        else:
            on = col(self.root.id) == col(root_key)
            self.optional_frames.append((df, reduce(lambda a, b: a & b, conditions, on), []))

    def _node_needed(self, path: str, name: str) -> bool:
        """Is anything but the id of the node at the end of a path ever read?"""
        if self.requested is None or self.keep:
            return True
        if self._reads is None:
            self._reads = self._reads_of_query()
        return "*" in self._reads or path in self._reads or name in self._reads

    def _reads_of_query(self) -> set[str]:
        ns, reads = self.ns, set()
        raw = [o for o in ns.order if isinstance(o, RawExpr)]
        raw += [o for t in ns.transforms for o in t.ordering if isinstance(o, RawExpr)]
        raw += [v for t in ns.transforms for v in t.vars.values() if isinstance(v["source"], RawExpr)]
        if raw:
            return {"*"}
        for lookup in ns.q.lookups():
            if not lookup.on_edge:
                reads.add("__".join(lookup.path))
        for spec in [*self.requested, *(o.lstrip("-") for o in ns.order)]:
            if "|" in spec:
                continue
            path, _, prop = spec.rpartition("__")
            if path and prop not in ("id", "node_id"):
                reads.add(path)
            reads.add(spec.partition(".")[0])
        sources = [v["source"] for t in ns.transforms for v in t.vars.values()]
        sources += [c for sq in ns.subqueries for c in sq.context]
        for alias, function in ns.extras:
            counted = isinstance(function, Size) and isinstance(function.source, Collect)
            inner: Any = function
            while isinstance(inner, AnnotateFunction):
                inner = inner.source
            fields = {
                spec.partition(".")[2]
                for spec in self.requested
                if spec.partition(".")[0] == alias
            }
            only_ids = bool(fields) and fields <= {"node_id", "edge_id"}
            if not counted and not only_ids:
                sources.append(inner)
        for source in sources:
            reads.add(source.node if isinstance(source, NodeNameResolver) else str(source))
        return reads

    def _holds_key(self, model: type[NodeModel], rel: RelationshipDef) -> bool:
        table = self.graph.edges.get(rel.rel_type) if rel.rel_type else None
        return table is not None and table.owner is not None and issubclass(model, table.owner)

    def _selected_roots(self) -> DataFrame | None:
        """The ids left by the conditions on the root alone; None if there are none."""
        ns = self.ns
        if self.root_frame is None:
            return None
        own = [
            part
            for part in (ns.q.conjuncts() if ns.q else [])
            if all(not lookup.path for lookup in part.lookups())
        ]
        if not own and ns.source is None and ns.vector is None and ns.fulltext is None:
            return None
        frame = self.root_frame
        for part in own:
            frame = frame.where(self._q_column(part, frame))
        return frame.select(col(self.root.id).alias("~root"))

    def _single_step_from_key(self, steps: list[RelationshipDef]) -> bool:
        # conditions on such a path would have to sit in the join that is built at once,
        # so the short form is used only when no condition mentions the path
        if len(steps) != 1:
            return False
        return (
            key_column(str(steps[0].rel_type)) in self.root.embedded
            and steps[0].direction != Direction.EITHER
            and not any(lk.path[:1] == (steps[0].name,) for lk in self.ns.q.lookups())
            and (self.graph.edge_table(steps[0].rel_type).owner_end == "src")
            == (steps[0].direction == Direction.OUTGOING)
        )

    def _detached(self, rel, node: str, edge: str, path: Path):
        table = self.graph.edges.get(rel.rel_type) if rel.rel_type else None
        if (
            table is not None
            and table.owner is not None
            and rel.direction != Direction.EITHER
            and (table.owner_end == "dst") == (rel.direction == Direction.OUTGOING)
            and self._sole_table(rel.target, table.owner)
        ):
            frame = self.graph.node_frame(rel.target, embedded=True)
            bound = self._node_bound(frame, node, rel.target)
            near_col = bound.embedded[key_column(rel.rel_type)]
            df = self._renamed(frame, node)
            df, bound_edge = self._embedded_edge(df, bound, near_col, rel, edge, False)
            return df, near_col, bound, bound_edge
        edges = self.graph.oriented_edges(self.ns.model, rel, path.max_hops)
        frame = self.graph.node_frame(rel.target, embedded=True)
        bound = self._node_bound(frame, node, rel.target)
        df = self._renamed(edges, edge).join(
            self._renamed(frame, node), col(f"{edge}.far_id") == col(bound.id)
        )
        return df, f"{edge}.near_id", bound, self._edge_bound(edges, edge, rel)

    def _find(self, path: tuple[str, ...]) -> dict[str, Any] | None:
        tree, entry = self.tree, None
        for name in path:
            entry = tree.get(name)
            if entry is None:
                return None
            tree = entry["children"]
        return entry

    def bound_at(self, path: str | tuple[str, ...], edge: bool = False) -> Bound:
        parts = split_path(path) if isinstance(path, str) else path
        entry = self._find(parts)
        if entry is None:
            kind = "relation" if edge else "node"
            raise ValueError(f"the query has no {kind} at {'__'.join(parts)!r}")
        return self.vars[entry["edge" if edge else "node"]]

    # ------------------------------------------------------------------ conditions
    def _type(self, c: Column, frame: DataFrame | None = None):
        return (frame if frame is not None else self.df).select(c.alias("x")).schema[0].dataType

    def _lookup_bound(self, lookup: Lookup) -> Bound:
        return self.bound_at(lookup.path, lookup.on_edge) if lookup.path else self.root

    def _conditions(self) -> None:
        required, mixed = [], []
        attached: dict[int, list[Q]] = {}
        for part in self.ns.q.conjuncts() if self.ns.q else []:
            places = {self._lookup_bound(lk).optional for lk in part.lookups()}
            if places == {None}:
                required.append(part)
            elif None in places:
                mixed.append(part)
            else:
                attached.setdefault(max(places), []).append(part)
        for part in required:
            self.df = self.df.where(self._q_column(part, self.df))
        for name, wanted in self.ns.existence:
            self.df = self._exists(name, wanted)
        for i, (frame, on, _) in enumerate(self.optional_frames):
            if on is None:
                continue
            for part in attached.get(i, []):
                if {self._lookup_bound(lk).optional for lk in part.lookups()} == {i}:
                    frame = frame.where(self._q_column(part, frame))
                else:
                    both = self.df.join(frame, on, "left")
                    on = on & self._q_column(part, both)
            self.df = self.df.join(frame, on, "left")
        for part in mixed:
            self.df = self.df.where(self._q_column(part, self.df))

    def _q_column(self, q: Q, frame: DataFrame) -> Column:
        def resolve(lookup: Lookup) -> Column:
            bound = self._lookup_bound(lookup)
            c = bound.column(lookup.prop)
            dtype = None
            if lookup.op in ("exact", "ne", "lt", "lte", "gt", "gte", "in"):
                dtype = self.types.get(bound.flat(lookup.prop)) or self._type(c, frame)
            return lookup_column(c, dtype, lookup)

        return q.column(resolve)

    def _exists(self, name: str, wanted: bool) -> DataFrame:
        rel = self.ns.model.relationship(name)
        how = "left_semi" if wanted else "left_anti"
        if rel.rel_type == "*":
            from .paths import reaching

            ids = reaching(self.graph, self.ns.model, rel).select(col("node_id").alias("~has"))
            return self.df.join(ids, col(self.root.id) == col("~has"), how)
        table = self.graph.edge_table(rel.rel_type) if rel.rel_type else None
        hidden = key_column(str(rel.rel_type))
        near_owns = (
            table is not None
            and rel.direction != Direction.EITHER
            and hidden in self.root.embedded
            and (table.owner_end == "src") == (rel.direction == Direction.OUTGOING)
        )
        if near_owns:
            if table.verified:
                key = col(self.root.embedded[hidden])
                return self.df.where(key.isNotNull() if wanted else key.isNull())
            ids = self.graph.node_frame(rel.target).select(col("node_id").alias("~has"))
            return self.df.join(ids, col(self.root.embedded[hidden]) == col("~has"), how)
        near = self.graph.oriented_edges(self.ns.model, rel)
        if table is None or not (table.verified or table.owner is rel.target):
            ids = self.graph.node_frame(rel.target).select(col("node_id").alias("~far"))
            near = near.join(ids, col("far_id") == col("~far"), "left_semi")
        # one row per node before the shuffle: a node may have a large share of all edges
        near = near.select(col("near_id").alias("~has")).distinct()
        return self.df.join(near, col(self.root.id) == col("~has"), how)

    # ------------------------------------------------------------------ sub-queries
    def _subqueries(self) -> None:
        for number, sq in enumerate(self.ns.subqueries, 1):
            inner_ns = sq.nodeset
            correlated: Bound | None = None
            imported: dict[str, Bound] = {}
            for item in sq.context:
                if isinstance(item, NodeNameResolver):
                    bound = self.root if item.node == "self" else self.bound_at(item.node)
                    name = item.node
                elif isinstance(item, RelationNameResolver):
                    bound, name = self.bound_at(item.relation, True), item.relation
                else:
                    if item not in self.vars:
                        raise ValueError(f"Unknown variable '{item}' in initial context")
                    bound, name = self.vars[item], item
                same_label = bound.kind == "node" and bound.model is inner_ns.model
                if same_label and correlated is None:
                    correlated = bound
                else:
                    imported[name] = bound
            if imported:
                self._imported_subquery(number, sq, correlated, imported)
            elif correlated is not None:
                key = f"{inner_ns.model.label_name().lower()}.node_id"
                inner = Composition(inner_ns, keep=[key], inside=True)
                self._attach(number, sq, inner, {key: col(correlated.id)})
            else:
                self._uncorrelated(number, sq)

    def _exports(self, number: int, sq, inner: Composition) -> dict[str, Column]:
        return {
            f"sq{number}.{name}": inner.vars[name].packed() for name in sq.return_set
        }

    def _attach(self, number: int, sq, inner: Composition, keys: dict[str, Column]) -> None:
        """Joins the result of a correlated sub-query on its context columns."""
        exports = self._exports(number, sq, inner)
        names = {k: f"sq{number}.~{i}" for i, k in enumerate(keys)}
        right = inner.paged(partition=list(keys)).select(
            *[col(k).alias(a) for k, a in names.items()],
            *[c.alias(a) for a, c in exports.items()],
        )
        on = reduce(
            lambda a, b: a & b, [c.eqNullSafe(col(names[k])) for k, c in keys.items()]
        ) if len(keys) > 1 else [c == col(names[k]) for k, c in keys.items()][0]
        self.df = self.df.join(right, on, "left" if inner.total else "inner")
        for name in sq.return_set:
            flat = f"sq{number}.{name}"
            if inner.total:
                empty = inner.empty_value(name)
                if empty is not None:
                    dtype = self._type(col(flat))
                    filled = F.coalesce(col(flat), empty.cast(dtype))
                    self.df = self.df.withColumn(flat, filled)
            self.vars[name] = Bound("value", flat)
            self.returns = [r for r in self.returns if r != name]
        self.returns = list(sq.return_set) + self.returns
        if not inner.total:
            self.row_key += list(exports)

    def _imported_subquery(self, number, sq, correlated, imported) -> None:
        """Context values ride along: the inner query starts from the outer rows."""
        keys = list(self.row_key)
        seed_cols = {f"ctx{number}.{i}": col(k) for i, k in enumerate(keys)}
        bounds = {}
        for name, bound in imported.items():
            flat = f"ctx{number}.{name}"
            seed_cols[flat] = bound.packed()
            bounds[name] = Bound("value", flat)
        on = None
        if correlated is not None:
            on = f"ctx{number}.on"
            seed_cols[on] = col(correlated.id)
        seed = self.df.select(*[c.alias(a) for a, c in seed_cols.items()])
        keep = [f"ctx{number}.{i}" for i in range(len(keys))]
        inner = Composition(sq.nodeset, keep=keep, seed=(seed, on, bounds), inside=True)
        self._attach(number, sq, inner, {k: col(o) for k, o in zip(keep, keys)})

    def _uncorrelated(self, number: int, sq) -> None:
        inner = Composition(sq.nodeset, inside=True)
        exports = self._exports(number, sq, inner)
        frame = inner.paged().select(*[c.alias(a) for a, c in exports.items()])
        page = sq.nodeset.stop is not None and sq.nodeset.stop - sq.nodeset.skip <= 1
        if inner.total or page:
            # at most one row: a scalar sub-query, no join at all
            packed = F.struct(*[col(a).alias(f"f{i}") for i, a in enumerate(exports)])
            one = f"sq{number}"
            self.df = self.df.withColumn(one, frame.select(packed.alias("s")).scalar())
            self.df = self.df.where(col(one).isNotNull())
            fields = {a: col(one)[f"f{i}"] for i, a in enumerate(exports)}
            self.df = self.df.withColumns(fields)
        else:
            self.df = product(self.df, frame)
            self.row_key += list(exports)
        for name in sq.return_set:
            self.vars[name] = Bound("value", f"sq{number}.{name}")
        self.returns = list(sq.return_set) + [r for r in self.returns if r not in sq.return_set]

    # ------------------------------------------------------------------ transforms
    def _transforms(self) -> None:
        for number, step in enumerate(self.ns.transforms, 1):
            chosen: dict[str, Column] = {k: col(k) for k in self.keep}
            fresh: dict[str, Bound] = {}
            identity: list[str] = list(self.keep)
            prefix = f"t{number}."
            for name, spec in step.vars.items():
                source, prop = spec["source"], spec.get("source_prop")
                if isinstance(source, RawExpr):
                    chosen[prefix + name] = self.raw(source)
                    fresh[name] = Bound("value", prefix + name)
                    identity.append(prefix + name)
                    continue
                bound = self.source_bound(source)
                if prop or bound.kind == "value":
                    chosen[prefix + name] = bound.column(prop or "")
                    fresh[name] = Bound("value", prefix + name)
                    identity.append(prefix + name)
                    continue
                moved = {p: f"{prefix}{name}.{p}" for p in bound.cols}
                for p, c in bound.cols.items():
                    chosen[moved[p]] = col(c)
                key = moved["node_id" if bound.kind == "node" else "edge_id"]
                fresh[name] = replace(bound, id=key, cols=moved, embedded={}, optional=None)
                identity.append(key)
            if not step.distinct:
                for k in self.row_key:
                    chosen.setdefault(k, col(k))
            self.df = self.df.select(*[c.alias(a) for a, c in chosen.items()])
            if step.distinct:
                self.df = self.df.dropDuplicates(identity)
                self.row_key = identity
            self.vars = fresh
            self.tree = {}
            self.returns = [n for n, s in step.vars.items() if s.get("include_in_return")]
            self.pending = [self._transform_key(item) for item in step.ordering]
            if self.root_name in fresh and fresh[self.root_name].kind == "node":
                self.root = fresh[self.root_name]

    def _transform_key(self, item: Any) -> SortKey:
        if isinstance(item, RawExpr):
            return SortKey(self.raw(item))
        down = item.startswith("-")
        name, _, prop = item.lstrip("-").partition(".")
        if name not in self.vars:
            raise ValueError(f"Unknown variable '{name}' in ordering")
        bound = self.vars[name]
        if not prop and bound.kind != "value":
            return SortKey(col(bound.id), down)
        return SortKey(bound.column(prop), down)

    def raw(self, expr: RawExpr) -> Column:
        """A raw expression with its variables replaced by column names."""
        text = expr.text

        def flat(match: re.Match) -> str:
            name, prop = match.group(1), match.group(2)
            name = self.root_name if name == "$n" else name
            bound = self.vars.get(name)
            if bound is None:
                return match.group(0)
            if bound.kind == "value":
                return f"`{bound.id}`.`{prop}`"
            if prop == "id":
                return f"`{bound.id}`"
            if prop not in bound.cols:
                prop = (bound.model or bound.rel.model).property(prop).name
            return f"`{bound.cols[prop]}`"

        text = re.sub(r"(\$n|\b[A-Za-z_]\w*)\.([A-Za-z_]\w*)", flat, text)
        for name, bound in self.vars.items():
            if bound.kind == "value":
                text = re.sub(rf"(?<![\w`.]){re.escape(name)}(?![\w`.(])", f"`{bound.id}`", text)
        return F.expr(text)

    def source_bound(self, source: Any) -> Bound:
        if isinstance(source, NodeNameResolver):
            return self.root if source.node == "self" else self.bound_at(source.node)
        if isinstance(source, RelationNameResolver):
            return self.bound_at(source.relation, True)
        if source in self.vars:
            return self.vars[source]
        if self._find(split_path(source)) is not None:
            return self.bound_at(source)
        raise ValueError(f"Unknown variable '{source}'")

    def _source_name(self, source: Any) -> str:
        if isinstance(source, NodeNameResolver):
            if source.node == "self":
                return self.root_name
            return self._find(split_path(source.node))["node"]
        if isinstance(source, RelationNameResolver):
            return self._find(split_path(source.relation))["edge"]
        return source

    # ------------------------------------------------------------------ annotations
    def _resolve_annotations(self) -> None:
        for alias, function in self.ns.extras:
            inner: Any = function
            while isinstance(inner, AnnotateFunction):
                inner = inner.source
            bound = self.source_bound(inner)
            name = alias or self._source_name(inner)
            self.annotations.append(Annotation(name, function, bound))

    def _requested_of(self, name: str) -> set[str] | None:
        """The properties of a variable that the caller will read; None means all."""
        if self.requested is None or self.keep:
            return None
        wanted: set[str] = set()
        for spec in self.requested + [
            o.lstrip("-") for o in self.ns.order if isinstance(o, str) and o != "?"
        ]:
            bound_name, prop = self._spec(spec)
            if bound_name == name:
                bound = self.vars.get(name)
                known = bound is None or bound.model is None or prop in bound.cols
                if not known and prop not in ("", "id"):
                    prop = bound.model.property(prop).name
                wanted.add(prop)
        if any(isinstance(o, RawExpr) for o in self.ns.order):
            return None
        return wanted

    def _spec(self, spec: str) -> tuple[str, str]:
        """A column request as (variable name, property)."""
        if "|" in spec:
            path, prop = spec.rsplit("|", 1)
            entry = self._find(split_path(path))
            if entry is None:
                raise ValueError(f"'{path}' was not traversed")
            return entry["edge"], prop
        if "__" in spec:
            path, prop = spec.rsplit("__", 1)
            entry = self._find(split_path(path))
            if entry is None:
                raise ValueError(f"'{path}' was not traversed")
            return entry["node"], prop
        name, _, prop = spec.partition(".")
        names = {a.name for a in self.annotations} | {"part"}
        if name in self.vars or name in names:
            if prop or self.vars.get(name, Bound("value", "")).kind == "value" or name in names:
                return name, prop
        return self.root_name, spec

    def _annotate(self) -> None:
        if not self.annotations:
            return
        plain = [a for a in self.annotations if a.function.collected() is None]
        for a in plain:
            value = self._scalar(a.function, a.bound.packed())
            flat = f"x.{a.name}"
            self.df = self.df.withColumn(flat, value)
            self.vars[a.name] = Bound("value", flat)
            self.returns = [r for r in self.returns if r != a.name] + [a.name]
        grouped = [a for a in self.annotations if a.function.collected() is not None]
        if grouped:
            self._group(grouped)

    @staticmethod
    def _scalar(function: AnnotateFunction, value: Column) -> Column:
        chain = []
        while isinstance(function, ScalarFunction):
            chain.append(function)
            function = function.source
        for f in reversed(chain):
            value = f.apply(value)
        return value

    def _group(self, annotations: list[Annotation]) -> None:
        replaced = {a.name for a in annotations}
        returned = [r for r in self.returns if r not in replaced]
        kept_vars: dict[str, Bound] = {}
        keys: dict[str, None] = dict.fromkeys(self.keep)
        carried: dict[str, None] = {}
        for name in returned:
            bound = self.vars[name]
            keys[bound.id] = None
            if bound.kind != "value":
                wanted = self._requested_of(name)
                cols = {
                    p: c for p, c in bound.cols.items() if wanted is None or p in wanted
                }
                # a variable is determined by its id; its columns ride in the key so that
                # the aggregate stays a hash aggregate over a narrow buffer
                carried.update(dict.fromkeys(c for c in cols.values() if c != bound.id))
                bound = replace(bound, cols=cols)
            kept_vars[name] = bound
        self.total = not returned
        group = list(keys) + [c for c in carried if c not in keys]
        frame = self.df
        parts = [a.function.collected().part_size for a in annotations]
        part_size = min([p for p in parts if p], default=None)
        made = {}
        if part_size and group:
            frame, group_part = self._parted(frame, list(keys), group, annotations, part_size)
        else:
            group_part = group
        for a in annotations:
            flat = f"x.{a.name}"
            made[flat] = self._aggregate(a, frame, part_size is not None).alias(flat)
            kept_vars[a.name] = Bound("value", flat)
        self.df = frame.groupBy(*[col(g) for g in group_part]).agg(*made.values())
        self.vars = kept_vars
        self.returns = returned + [a.name for a in annotations]
        self.row_key = list(group_part) if group_part else list(made)
        if part_size and group:
            self.vars["part"] = Bound("value", "~part")
            self.returns.append("part")
        self.pending = []
        self.grouped = True
        if self.root_name in kept_vars and kept_vars[self.root_name].kind == "node":
            self.root = kept_vars[self.root_name]
        self.aggregates = {a.name: a for a in annotations}

    def _parted(self, frame, keys, group, annotations, part_size):
        """Numbers the rows of every group in order and cuts them into parts of ``part_size``."""
        collects = [a.function for a in annotations]
        distinct = any(isinstance(f, Collect) and f.distinct for f in collects)
        if not all(isinstance(f, Collect) for f in collects):
            raise ValueError("part_size goes with Collect only: count and pick in another query")
        if distinct and (self.pending or len({a.bound.id for a in annotations}) > 1):
            raise ValueError("distinct lists in parts take one variable and no ordering")
        first = annotations[0].bound.id
        ties = list(dict.fromkeys([first] if distinct else [first, *self.row_key]))
        if not self.pending:
            # numbering shuffles and stores its rows: only what is read of them goes along
            read = dict.fromkeys([*group, *ties])
            for a in annotations:
                only = self._read_of(a)
                read.update((c, None) for p, c in a.bound.cols.items() if only is None or p in only)
                read[a.bound.id] = None
            frame = frame.select(*[col(c) for c in read])
        if distinct:
            # what rides in the group is determined by its keys, and keeps this a hash aggregate
            frame = frame.dropDuplicates(list(dict.fromkeys([*group, first])))
        order = [k.sort_column() for k in self.pending]
        order += [col(k).asc_nulls_last() for k in ties]
        placed = numbered(frame, keys, order)
        part = F.floor(col(POSITION) / F.lit(part_size)).cast("bigint")
        return placed.withColumn("~part", part).drop(POSITION), group + ["~part"]

    def _read_of(self, a: Annotation) -> set[str] | None:
        """The properties of what is collected that will be read; None means all."""
        only = self._requested_of(a.name)
        return None if not only or "" in only else only

    def _aggregate(self, a: Annotation, frame: DataFrame, parted: bool) -> Column:
        collect = a.function.collected()
        bound, function = a.bound, a.function
        present = col(bound.id).isNotNull()
        only = self._read_of(a)
        if isinstance(function, Size) and isinstance(function.source, Collect):
            counted = F.count_distinct(col(bound.id)) if collect.distinct else F.count(col(bound.id))
            return counted.cast("bigint")
        ties = [col(bound.id)] + [col(k) for k in self.row_key if k != bound.id]
        if (
            isinstance(function, Last)
            and isinstance(function.source, Collect)
            and not collect.distinct
        ):
            order = comparable(self.pending, frame, ties)
            return F.max_by(bound.packed(only), F.when(present, order))
        value = bound.packed(only)
        if collect.distinct and not self.pending:
            whole = F.collect_set(value)
        elif self.pending:
            order = comparable(self.pending, frame, ties)
            pairs = F.collect_list(F.when(present, F.struct(order.alias("o"), value.alias("v"))))
            whole = F.transform(F.sort_array(pairs), lambda x: x["v"])
            if collect.distinct:
                whole = F.array_distinct(whole)
        else:
            whole = F.collect_list(value)
        chain = []
        while isinstance(function, ScalarFunction):
            chain.append(function)
            function = function.source
        for f in reversed(chain):
            whole = f.apply(whole)
        return whole

    def empty_value(self, name: str) -> Column | None:
        """What an aggregate over no rows gives."""
        a = self.aggregates.get(name)
        if a is None:
            return None
        if isinstance(a.function, Collect):
            return F.array()
        if isinstance(a.function, Size):
            return F.lit(0)
        return None

    # ------------------------------------------------------------------ order and page
    def sort_keys(self) -> list[SortKey]:
        keys: list[SortKey] = []
        for item in self.ns.order:
            if isinstance(item, RawExpr):
                keys.append(SortKey(self.raw(item)))
                continue
            down = item.startswith("-")
            name, prop = self._spec(item.lstrip("-"))
            bound = self.vars.get(name)
            if bound is None:
                raise ValueError(f"cannot order by {item!r}: it is not part of the result")
            keys.append(SortKey(bound.column(prop), down))
        if not keys and not self.annotations:
            keys = list(self.pending)
        return keys

    def _ordered(self) -> tuple[DataFrame, list[Column]]:
        if "?" in self.ns.order:
            rand = F.rand(self.ns.seed) if self.ns.seed is not None else F.rand()
            df = self.df.withColumn("~rand", rand)
            return df, [col("~rand").asc()]
        return self.df, [k.sort_column() for k in self.sort_keys()]

    def paged(self, partition: list[str] | None = None) -> DataFrame:
        """Rows in order and cut to the page; per context when ``partition`` is given."""
        ns = self.ns
        df, order = self._ordered()
        cut = ns.skip > 0 or ns.stop is not None
        if not cut:
            return df.orderBy(*order) if order and not partition else df
        total = order + [col(k).asc_nulls_last() for k in self.row_key]
        if partition:
            keys = [col(p) for p in partition]
            rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*total))
            if ns.stop is None:
                placed = numbered(df, partition, total)
                return placed.where(col(POSITION) >= ns.skip).drop(POSITION)
            # first within what each task has of a context, so that a large one is cut down by
            # many tasks before its rows meet
            within = Window.partitionBy(*keys, col("~share")).orderBy(*total)
            df = df.withColumn("~share", F.spark_partition_id())
            df = df.withColumn("~rank", F.row_number().over(within))
            df = df.where(col("~rank") <= ns.stop).drop("~rank", "~share")
            ranked = df.withColumn("~rank", rank).where(col("~rank") <= ns.stop)
            return ranked.where(col("~rank") > ns.skip).drop("~rank")
        if ns.stop is not None:
            page = df.orderBy(*total).offset(ns.skip) if ns.skip else df.orderBy(*total)
            return page.limit(ns.stop - ns.skip)
        # everything but the first rows: all are numbered over many tasks
        rest = numbered(df, [], total).where(col(POSITION) >= ns.skip).drop(POSITION)
        return rest.orderBy(*order) if order else rest

    def first_per_source(self) -> DataFrame:
        """The first row of every source; an aggregate, so that tasks reduce before the shuffle."""
        order = comparable(self.sort_keys(), self.df, [col(self.root.id)])
        others = [r for r in self.returns if r != "source_id"]
        row = F.struct(*[self.vars[r].packed().alias(r) for r in others])
        first = self.df.groupBy(col("~source").alias("source_id")).agg(
            F.min_by(row, order).alias("~first")
        )
        return first.select("source_id", *[col("~first")[r].alias(r) for r in others])

    # ------------------------------------------------------------------ results
    def structs(self) -> DataFrame:
        return self.paged().select(*[self.vars[r].packed().alias(r) for r in self.returns])

    def flat(self, wanted: dict[str, str]) -> DataFrame:
        columns = []
        for alias, spec in wanted.items():
            name, prop = self._spec(spec)
            bound = self.vars.get(name)
            if bound is None:
                raise ValueError(f"'{spec}' is not part of the result")
            columns.append(bound.column(prop).alias(alias))
        return self.paged().select(*columns)

    def nested(self) -> DataFrame:
        exported = [n for sq in self.ns.subqueries for n in sq.return_set if n in self.vars]
        if not self.tree and not exported:
            raise RuntimeError("the query follows no path, so there is nothing to nest")

        def relations(tree: dict[str, Any]) -> list[Column]:
            found = []
            for name, entry in tree.items():
                node = self.vars.get(entry["node"]) if entry["node"] in self.returns else None
                edge = self.vars.get(entry["edge"]) if entry["edge"] in self.returns else None
                children = relations(entry["children"])
                if node is not None:
                    fields = [col(c).alias(p) for p, c in node.cols.items()]
                    found.append(
                        F.when(col(node.id).isNotNull(), F.struct(*fields, *children)).alias(name)
                    )
                else:
                    found += children
                if edge is not None:
                    found.append(edge.packed().alias(f"{name}_relationship"))
            return found

        root = [col(c).alias(p) for p, c in self.root.cols.items()]
        extra = [self.vars[n].packed().alias(n) for n in exported]
        return self.paged().select(*root, *relations(self.tree), *extra)


# ---------------------------------------------------------------------- counting
def count_rows(ns: NodeSet, name: str) -> DataFrame:
    """The number of rows, paged by arithmetic instead of by moving rows."""
    counted = _factored(ns) or _plain_count(ns)
    n = counted
    if ns.skip or ns.stop is not None:
        value = F.greatest(col("n") - F.lit(ns.skip), F.lit(0))
        if ns.stop is not None:
            value = F.least(value, F.lit(ns.stop - ns.skip))
        n = counted.select(value.cast("bigint").alias("n"))
    return n.select(col("n").alias(name))


def _plain_count(ns: NodeSet) -> DataFrame:
    stripped = replace(ns, order=(), skip=0, stop=None, extras=())
    simple = not (ns.subqueries or ns.transforms)
    whole = Composition(stripped, requested=[] if simple else None, until_conditions=simple)
    return whole.df.agg(F.count(F.lit(1)).alias("n"))


def _factored(ns: NodeSet) -> DataFrame | None:
    """Independent paths multiply: count each per root instead of joining them.

    The rows of one root are all combinations of the matches of its paths. Their
    number is the product of the numbers of matches, so no combination is built.
    """
    simple = not (
        ns.subqueries or ns.transforms or ns.unique or ns.vector or ns.fulltext
        or isinstance(ns.source, Traversal) or any(p.optional for p in ns.paths)
    )
    if not simple:
        return None
    shape = Composition(replace(ns, order=(), skip=0, stop=None, extras=()), until_conditions=True)
    walked = sorted(set(shape.owner_of.values()))
    if len(walked) < 2:
        return None
    own: dict[int | None, list[Q]] = {}
    for part in ns.q.conjuncts() if ns.q else []:
        places = {shape.owner_of[lk.path] if lk.path else None for lk in part.lookups()}
        if len(places) > 1:
            return None
        own.setdefault(places.pop(), []).append(part)
    root_only = Q(*own.get(None, []))
    base = replace(ns, paths=(), q=root_only, order=(), skip=0, stop=None, extras=())
    root = Composition(base, requested=[], until_conditions=True)
    counted = root.df.select(col(root.root.id).alias("~root"))
    product_of = F.lit(1).cast("bigint")
    for i, index in enumerate(walked):
        if index < len(ns.paths):
            path = (ns.paths[index],)
        else:
            parts = [p for p, w in shape.owner_of.items() if w == index]
            path = (Path("__".join(max(parts, key=len))),)
        # the conditions on the root already cut the base
        one = Composition(
            replace(base, paths=path, q=Q(*own.get(index, [])), existence=()),
            requested=[],
            until_conditions=True,
        )
        matches = one.df.groupBy(col(one.root.id).alias(f"~id{i}")).agg(
            F.count(F.lit(1)).alias(f"~n{i}")
        )
        counted = counted.join(matches, col("~root") == col(f"~id{i}"))
        product_of = product_of * col(f"~n{i}")
    return counted.agg(F.coalesce(F.sum(product_of), F.lit(0)).cast("bigint").alias("n"))
