"""The property graph: node tables by label and edge tables by relationship type.

A graph is immutable. Every write operator returns a new graph that shares all
untouched tables with the old one.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import RelationshipClassNotDefined
from ..model import Direction, NodeModel, RelationshipDef, RelModel


def col(name: str) -> Column:
    """A column by its exact name, whatever characters the name has."""
    return F.col(_quoted(name))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def default_array(labels: Iterable[str]) -> Column:
    return F.array(*[F.lit(x) for x in labels])


@dataclass(frozen=True)
class EdgeTable:
    """Edges of one type.

    Either ``frame`` holds them (``edge_id, src_id, dst_id`` and properties), or they
    are *embedded*: each row of the ``owner`` node table is one edge whose own end is
    that node and whose other end is the column ``key``. Embedded edges save the join
    between the edge table and the node table it was derived from.

    ``verified`` says that both ends of every edge exist, so that a node table need
    not be read only to prove existence.
    """

    rel_type: str
    src: type[NodeModel]
    dst: type[NodeModel]
    model: type[RelModel] | None = None
    frame: DataFrame | None = None
    owner: type[NodeModel] | None = None
    owner_end: str = "src"
    key: Column | str | None = None
    props: Mapping[str, Column | str] = field(default_factory=dict)
    verified: bool = False

    def prop_names(self) -> list[str]:
        if self.model is not None:
            return list(self.model.properties())
        if self.frame is not None:
            fixed = {"edge_id", "src_id", "dst_id"}
            return [c for c in self.frame.columns if c not in fixed]
        return list(self.props)


def key_column(rel_type: str) -> str:
    return f"~{rel_type}"


def embedded_prop(rel_type: str, prop: str) -> str:
    return f"~{rel_type}~{prop}"


class PropertyGraph:
    def __init__(
        self,
        spark: SparkSession,
        tables: Mapping[str, tuple[type[NodeModel], DataFrame]] | None = None,
        edges: Mapping[str, EdgeTable] | None = None,
    ):
        self.spark = spark
        self.tables = dict(tables or {})
        self.edges = dict(edges or {})
        self._frames: dict[tuple[type[NodeModel], bool], DataFrame] = {}

    # -- building ---------------------------------------------------------
    def with_nodes(self, model: type[NodeModel], frame: DataFrame) -> PropertyGraph:
        """Adds or replaces the table of a label (stored column names, ``node_id``)."""
        if "node_id" not in frame.columns:
            raise ValueError("a node table needs a node_id column")
        return PropertyGraph(self.spark, {**self.tables, model.label_name(): (model, frame)}, self.edges)

    def with_edges(
        self,
        rel_type: str,
        frame: DataFrame,
        *,
        src: type[NodeModel],
        dst: type[NodeModel],
        model: type[RelModel] | None = None,
        verified: bool = False,
    ) -> PropertyGraph:
        missing = {"edge_id", "src_id", "dst_id"} - set(frame.columns)
        if missing:
            raise ValueError(f"an edge table needs the columns {sorted(missing)}")
        return self._with(
            EdgeTable(rel_type, src, dst, model, frame=frame, verified=verified)
        )

    def with_embedded_edges(
        self,
        rel_type: str,
        *,
        src: type[NodeModel],
        dst: type[NodeModel],
        owner_end: str,
        key: Column | str,
        props: Mapping[str, Column | str] | None = None,
        model: type[RelModel] | None = None,
        verified: bool = False,
    ) -> PropertyGraph:
        """Edges that are a column of the node table at ``owner_end``."""
        if owner_end not in ("src", "dst"):
            raise ValueError("owner_end is 'src' or 'dst'")
        owner = src if owner_end == "src" else dst
        return self._with(
            EdgeTable(
                rel_type,
                src,
                dst,
                model,
                owner=owner,
                owner_end=owner_end,
                key=key,
                props=dict(props or {}),
                verified=verified,
            )
        )

    def _with(self, edge: EdgeTable) -> PropertyGraph:
        known = self.edges.get(edge.rel_type)
        if known and known.model and edge.model and known.model is not edge.model:
            related = issubclass(known.model, edge.model) or issubclass(edge.model, known.model)
            if not related:
                raise ValueError(
                    f"relationship type {edge.rel_type!r} already has the model "
                    f"{known.model.__name__}"
                )
        return PropertyGraph(self.spark, self.tables, {**self.edges, edge.rel_type: edge})

    # -- nodes ------------------------------------------------------------
    def stored(self, model: type[NodeModel]) -> DataFrame:
        """The whole table of a label as it is stored."""
        return self.tables[model.label_name()][1]

    def tables_of(self, model: type[NodeModel]) -> list[tuple[type[NodeModel], DataFrame]]:
        """The tables with nodes of a label.

        They are those of the model and of the models derived from it, and any table of
        a parent model whose rows tell their own labels.
        """
        found = [
            (m, df)
            for m, df in self.tables.values()
            if issubclass(m, model) or (issubclass(model, m) and "labels" in df.columns)
        ]
        if not found:
            raise ValueError(f"no node table for label {model.label_name()!r}")
        return found

    def node_frame(self, model: type[NodeModel], embedded: bool = False) -> DataFrame:
        """``node_id, labels`` and the declared properties under their model names.

        With ``embedded`` the keys and properties of embedded edges ride along.
        """
        if (model, embedded) not in self._frames:
            parts = [self._one_table(m, df, model, embedded) for m, df in self.tables_of(model)]
            whole = parts[0]
            for part in parts[1:]:
                whole = whole.unionByName(part, allowMissingColumns=True)
            self._frames[model, embedded] = whole
        return self._frames[model, embedded]

    def _one_table(
        self, own: type[NodeModel], frame: DataFrame, asked: type[NodeModel], embedded: bool
    ) -> DataFrame:
        # one text per column: the whole projection is a single call to the JVM
        present = set(frame.columns)
        if "labels" in present:
            frame = frame.where(F.array_contains(col("labels"), asked.label_name()))
        labels = ", ".join("'" + x.replace("'", "\\'") + "'" for x in own.inherited_labels())
        chosen = ["node_id", "labels" if "labels" in present else f"array({labels}) AS labels"]
        computed: dict[str, Column] = {}
        for name, prop in asked.properties().items():
            if prop.stored_name in present:
                chosen.append(f"{_quoted(prop.stored_name)} AS {_quoted(name)}")
            elif prop.has_default and not callable(prop.default):
                computed[name] = prop.default_column()
                chosen.append(_quoted(name))
            else:
                kind = prop.spark_type.simpleString()
                chosen.append(f"CAST(NULL AS {kind}) AS {_quoted(name)}")
        carried: dict[str, Column | str] = {}
        if embedded:
            for edge in self.edges.values():
                if edge.owner is own:
                    carried[key_column(edge.rel_type)] = edge.key
                    for name, value in edge.props.items():
                        carried[embedded_prop(edge.rel_type, name)] = value
        for name, value in carried.items():
            if isinstance(value, str):
                chosen.append(f"{_quoted(value)} AS {_quoted(name)}")
            else:
                computed[name] = value
                chosen.append(_quoted(name))
        return (frame.withColumns(computed) if computed else frame).selectExpr(*chosen)

    def nodes(self, model: type[NodeModel], ids: Any = None):
        """A lazy query over all nodes of a label, or over the given ids only.

        ``ids`` is a list of ids or a DataFrame with one ``node_id`` column.
        """
        from ..operators.nodeset import NodeSet

        return NodeSet(self, model, source=ids)

    # -- edges ------------------------------------------------------------
    def edge_table(self, rel_type: str) -> EdgeTable:
        if rel_type not in self.edges:
            raise RelationshipClassNotDefined(f"the graph has no edges of type {rel_type!r}")
        return self.edges[rel_type]

    def edge_frame(self, rel_type: str) -> DataFrame:
        """``edge_id, src_id, dst_id`` and the edge properties."""
        edge = self.edge_table(rel_type)
        if edge.frame is not None:
            chosen = [col(c) for c in ("edge_id", "src_id", "dst_id")]
            if edge.model is None:
                chosen += [col(c) for c in edge.prop_names()]
            else:
                present = set(edge.frame.columns)
                for name, prop in edge.model.properties().items():
                    if prop.stored_name in present:
                        chosen.append(col(prop.stored_name).alias(name))
                    else:
                        chosen.append(F.lit(None).cast(prop.spark_type).alias(name))
            return edge.frame.select(*chosen)
        owner = self.tables[edge.owner.label_name()][1]
        key = _as_column(edge.key)
        own, other = col("node_id"), key
        src, dst = (own, other) if edge.owner_end == "src" else (other, own)
        return owner.where(key.isNotNull()).select(
            own.alias("edge_id"),
            src.alias("src_id"),
            dst.alias("dst_id"),
            *[_as_column(v).alias(n) for n, v in edge.props.items()],
        )

    def oriented_edges(
        self, near: type[NodeModel], rel: RelationshipDef, max_hops: int | None = None
    ) -> DataFrame:
        """Edges seen from the near end: ``near_id, far_id, edge_id, src_id, dst_id, …``."""
        if rel.rel_type == "*":
            from ..operators.paths import reachable

            return reachable(self, near, rel, max_hops)
        if rel.rel_type is None:
            return self._untyped(near, rel)
        return orient(self.edge_frame(rel.rel_type), rel.direction)

    def _untyped(self, near: type[NodeModel], rel: RelationshipDef) -> DataFrame:
        """All types that can join the two models, under one ``rel_type`` column."""
        whole: DataFrame | None = None
        for edge in self.edges.values():
            for direction, start, end in (
                (Direction.OUTGOING, edge.src, edge.dst),
                (Direction.INCOMING, edge.dst, edge.src),
            ):
                if rel.direction not in (direction, Direction.EITHER):
                    continue
                if not (_compatible(near, start) and _compatible(rel.target, end)):
                    continue
                one = orient(self.edge_frame(edge.rel_type), direction)
                if rel.direction == Direction.EITHER and direction == Direction.INCOMING:
                    if _compatible(near, edge.src) and _compatible(rel.target, edge.dst):
                        one = one.where(col("src_id") != col("dst_id"))
                one = one.select(
                    *["near_id", "far_id", "src_id", "dst_id"],
                    F.concat(F.lit(edge.rel_type + "/"), col("edge_id").cast("string")).alias(
                        "edge_id"
                    ),
                    F.lit(edge.rel_type).alias("rel_type"),
                )
                whole = one if whole is None else whole.unionByName(one)
        if whole is None:
            raise RelationshipClassNotDefined(
                f"no relationship joins {near.label_name()} and {rel.target.label_name()}"
            )
        return whole

    # -- raw queries ------------------------------------------------------
    def sql(self, text: str, args: Mapping[str, Any] | None = None, **views: Any) -> DataFrame:
        """Runs a parameterised SQL query over graph views.

        ``views`` maps a name used as ``{name}`` in the text to a node model, a
        relationship type or a DataFrame.
        """
        frames = {}
        for name, what in views.items():
            if isinstance(what, DataFrame):
                frames[name] = what
            elif isinstance(what, str):
                frames[name] = self.edge_frame(what)
            else:
                frames[name] = self.node_frame(what)
        return self.spark.sql(text, args=dict(args or {}), **frames)


def orient(edges: DataFrame, direction: Direction) -> DataFrame:
    if direction == Direction.EITHER:
        # one pass over the edges; a self-loop is seen once
        both = F.when(
            col("src_id") == col("dst_id"), F.array(F.struct(col("src_id"), col("dst_id")))
        ).otherwise(
            F.array(
                F.struct(col("src_id"), col("dst_id")),
                F.struct(col("dst_id").alias("src_id"), col("src_id").alias("dst_id")),
            )
        )
        ends = edges.withColumn("~ends", F.explode(both))
        return ends.select(
            col("~ends")["src_id"].alias("near_id"),
            col("~ends")["dst_id"].alias("far_id"),
            *[col(c) for c in edges.columns],
        )
    near, far = ("src_id", "dst_id") if direction == Direction.OUTGOING else ("dst_id", "src_id")
    return edges.select(
        col(near).alias("near_id"), col(far).alias("far_id"), *[col(c) for c in edges.columns]
    )


def _as_column(value: Column | str) -> Column:
    return col(value) if isinstance(value, str) else value


def _compatible(a: type[NodeModel], b: type[NodeModel]) -> bool:
    return issubclass(a, b) or issubclass(b, a)


def as_table(edge: EdgeTable, frame: DataFrame) -> EdgeTable:
    """The same relationship type held by an edge table of its own."""
    return replace(
        edge, frame=frame, owner=None, key=None, props={}, owner_end="src", verified=False
    )
