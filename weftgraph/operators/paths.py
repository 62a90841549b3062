"""Edges between given nodes, endpoints, path values and reachability."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lookups import split_path
from ..model import Direction, NodeModel, RelationshipDef
from ..sources.graph import PropertyGraph, col, orient
from ..sources.session import checkpointed
from .nodeset import NodeSet


def connected(
    graph: PropertyGraph, model: type[NodeModel], rel_name: str, pairs: DataFrame
) -> DataFrame:
    """``pairs`` (``near_id, far_id``) with a flag: is there an edge between the two?"""
    rel = model.relationship(rel_name)
    edges = graph.oriented_edges(model, rel).select(
        col("near_id").alias("~n"), col("far_id").alias("~f")
    )
    on = (col("near_id") == col("~n")) & (col("far_id") == col("~f"))
    flagged = pairs.join(edges.distinct(), on, "left")
    return flagged.withColumn("connected", col("~n").isNotNull()).drop("~n", "~f")


def relationships(
    graph: PropertyGraph, model: type[NodeModel], rel_name: str, pairs: DataFrame | None = None
) -> DataFrame:
    """All edges between the given pairs, or between all pairs."""
    edges = graph.oriented_edges(model, model.relationship(rel_name))
    if pairs is None:
        return edges
    return edges.join(pairs.select("near_id", "far_id"), ["near_id", "far_id"], "left_semi")


def first_relationship(
    graph: PropertyGraph, model: type[NodeModel], rel_name: str, pairs: DataFrame | None = None
) -> DataFrame:
    """One edge per pair of nodes (the least id) and the number of parallel edges."""
    edges = relationships(graph, model, rel_name, pairs)
    whole = F.struct(*[col(c) for c in edges.columns if c not in ("near_id", "far_id")])
    return edges.groupBy("near_id", "far_id").agg(
        F.min_by(whole, col("edge_id")).alias("edge"), F.count(F.lit(1)).alias("n")
    )


def endpoints(graph: PropertyGraph, rel_type: str) -> DataFrame:
    """Every edge with its start and end node as structs."""
    edge = graph.edge_table(rel_type)
    edges = graph.edge_frame(rel_type)
    result = edges
    for name, model, key in (("start", edge.src, "src_id"), ("end", edge.dst, "dst_id")):
        nodes = graph.node_frame(model)
        packed = F.struct(*[col(c) for c in nodes.columns]).alias(f"{name}_node")
        nodes = nodes.select(col("node_id").alias(f"~{name}"), packed)
        result = result.join(nodes, col(key) == col(f"~{name}")).drop(f"~{name}")
    return result


def path_values(ns: NodeSet, path: str) -> DataFrame:
    """One value per match of a path: its nodes, relationships, length, start and end.

    Nodes of different labels share one type: label, id and properties as text.
    """
    from .compose import Composition

    chosen = ns.traverse(path)
    comp = Composition(chosen)
    parts = split_path(path)
    nodes, edges, kinds = [comp.root], [], []
    for i in range(len(parts)):
        nodes.append(comp.bound_at(parts[: i + 1]))
        edges.append(comp.bound_at(parts[: i + 1], edge=True))
        kinds.append(edges[-1].rel.rel_type)

    def properties(cols: dict[str, str], fixed: tuple[str, ...]) -> Column:
        pairs: list[Column] = []
        for name, c in cols.items():
            if name not in fixed:
                pairs += [F.lit(name), col(c).cast("string")]
        return F.create_map(*pairs) if pairs else F.map_from_arrays(
            F.array().cast("array<string>"), F.array().cast("array<string>")
        )

    node_values = [
        F.struct(
            F.lit(n.model.label_name()).alias("label"),
            col(n.id).cast("string").alias("node_id"),
            properties(n.cols, ("node_id", "labels")).alias("properties"),
        )
        for n in nodes
    ]
    edge_values = [
        F.struct(
            F.lit(kind).alias("rel_type"),
            col(e.id).cast("string").alias("edge_id"),
            properties(e.cols, ("edge_id", "src_id", "dst_id")).alias("properties"),
        )
        for e, kind in zip(edges, kinds)
    ]
    return comp.paged().select(
        F.array(*node_values).alias("nodes"),
        F.array(*edge_values).alias("relationships"),
        F.lit(len(edges)).cast("bigint").alias("length"),
        nodes[0].packed().alias("start_node"),
        nodes[-1].packed().alias("end_node"),
    )


def repeated(ns: NodeSet, rel_name: str, times: int) -> NodeSet:
    """Exactly ``times`` hops along one relationship between nodes of one label."""
    if times < 1:
        raise ValueError("a path has at least one hop")
    return ns.traverse("__".join([rel_name] * times))


def reachable(
    graph: PropertyGraph,
    model: type[NodeModel],
    rel: RelationshipDef,
    max_hops: int | None = None,
    start: DataFrame | None = None,
) -> DataFrame:
    """Pairs joined by a path of one or more edges, with the least number of hops.

    Without ``max_hops`` paths may have any length. The wildcard type ``"*"`` follows edges
    of all types. Every round is written to the checkpoint folder, so that a lost executor
    repeats one round at most. A path that ends where it began counts in a directed search
    only: without direction it would walk one edge back and forth.
    """
    if max_hops is not None and max_hops < 1:
        raise ValueError("max_hops must be at least 1")
    wildcard = rel.rel_type == "*"
    step = _steps(graph, rel)
    either = rel.direction == Direction.EITHER
    begin = None
    if start is not None or max_hops is not None:
        begin = (graph.node_frame(model) if start is None else start).select("node_id")
        if wildcard:
            begin = begin.select(_global_id(model, col("node_id")).alias("node_id"))
    if max_hops is not None:
        pairs = _bounded(step, begin, max_hops, either)
    else:
        if begin is not None:
            # only what can be reached from there can lie on a path
            inside = spread(step, begin).select(col("node_id").alias("~in"))
            step = step.join(inside, col("~from") == col("~in"), "left_semi")
        pairs = _closure(step, either)
        if begin is not None:
            pairs = pairs.join(begin, col("near_id") == col("node_id"), "left_semi")
    if wildcard or max_hops is None:
        name = (lambda m, c: _global_id(m, c)) if wildcard else (lambda m, c: c)
        near = graph.node_frame(model).select(col("node_id").alias("~near"))
        far = graph.node_frame(rel.target).select(col("node_id").alias("~far"))
        pairs = (
            pairs.join(near, col("near_id") == name(model, col("~near")))
            .join(far, col("far_id") == name(rel.target, col("~far")))
            .select(col("~near").alias("near_id"), col("~far").alias("far_id"), "hops")
        )
    return pairs.select(
        "near_id",
        "far_id",
        F.struct("near_id", "far_id").alias("edge_id"),
        col("near_id").alias("src_id"),
        col("far_id").alias("dst_id"),
        "hops",
    )


def reaching(graph: PropertyGraph, model: type[NodeModel], rel: RelationshipDef) -> DataFrame:
    """``node_id`` of the nodes of ``model`` from which a target node can be reached, by one or
    more edges. One search backwards from all targets: it keeps nodes, never pairs.

    Without direction, walking one edge back and forth does not count as reaching oneself.
    """
    if rel.direction != Direction.EITHER:
        return _reaching_by_type(graph, model, rel)
    wildcard = rel.rel_type == "*"
    step = _steps(graph, rel)
    far = graph.node_frame(rel.target).select("node_id")
    near = graph.node_frame(model).select(col("node_id").alias("~own"))
    name = (lambda m, c: _global_id(m, c)) if wildcard else (lambda m, c: c)
    targets = far.select(name(rel.target, col("node_id")).alias("node_id"))
    # of every connected part the least and the greatest target: a node needs one other than itself
    parts = _parts(step.where(col("~from") != col("~to")))
    known = parts.join(targets.distinct(), "node_id").groupBy("~part")
    ends = known.agg(F.min("node_id").alias("~least"), F.max("node_id").alias("~most"))
    found = parts.join(ends, "~part").where(
        (col("~least") != col("node_id")) | (col("~most") != col("node_id"))
    )
    found = found.select(col("node_id").alias("~from"))
    return near.join(found, name(model, col("~own")) == col("~from"), "left_semi").select(
        col("~own").alias("node_id")
    )


#: Types of ids that compare as whole numbers; ids of any other type compare as text.
WHOLE = {"tinyint", "smallint", "int", "bigint"}


def _reaching_by_type(graph: PropertyGraph, model: type[NodeModel], rel: RelationshipDef) -> DataFrame:
    """As `reaching`, for edges with a direction.

    The first rounds join the edges of each type as they are, from the label whose nodes were just
    found: no edge is written, and of its columns only both ends are read. What goes on after
    them is left to `spread`.
    """
    wildcard = rel.rel_type == "*"
    outwards = rel.direction == Direction.OUTGOING

    def space(label: type[NodeModel]) -> str:
        return label.label_name() if wildcard else ""

    tables = []
    for edge in graph.edges.values() if wildcard else [graph.edge_table(rel.rel_type)]:
        ends = orient(graph.edge_frame(edge.rel_type), rel.direction)
        ends = ends.where(col("near_id").isNotNull() & col("far_id").isNotNull())
        near, far = (edge.src, edge.dst) if outwards else (edge.dst, edge.src)
        tables.append((space(near), space(far), ends.select("near_id", "far_id")))
    targets, own = space(rel.target), space(model)
    seeds = graph.node_frame(rel.target).select("node_id").where(col("node_id").isNotNull())
    nodes = graph.node_frame(model).select(col("node_id").alias("~own"))

    kinds = [(targets, seeds.dtypes[0][1]), (own, nodes.dtypes[0][1])]
    for near, far, ends in tables:
        kinds += zip((near, far), (kind for _, kind in ends.dtypes))
    text = {label for label, kind in kinds if kind not in WHOLE}

    def same(name: str, label: str) -> Column:
        return col(name).cast("string" if label in text else "bigint")

    tables = [
        (near, far, ends.select(same("near_id", near).alias("~from"), same("far_id", far).alias("~to")))
        for near, far, ends in tables
    ]
    frontier = {targets: checkpointed(seeds.select(same("node_id", targets).alias("node_id")).distinct())}
    reached = {label: [ids] for label, ids in frontier.items()}
    for _ in range(PLAIN_STEPS):
        steps: dict[str, list[DataFrame]] = {}
        for near, far, ends in tables:
            if far in frontier:
                before = ends.join(frontier[far], col("~to") == col("node_id"), "left_semi")
                steps.setdefault(near, []).append(before.select(col("~from").alias("node_id")))
        frontier = {}
        for label, found in steps.items():
            fresh = reduce(DataFrame.unionByName, found).distinct()
            if label in reached:
                fresh = fresh.join(reduce(DataFrame.unionByName, reached[label]), "node_id", "left_anti")
            fresh = checkpointed(fresh)
            if not fresh.isEmpty():
                frontier[label] = fresh
        for label, fresh in frontier.items():
            reached.setdefault(label, []).append(fresh)
        if not frontier:
            break
    known = {label: reduce(DataFrame.unionByName, ids) for label, ids in reached.items()}
    if frontier:

        def whole(name: str, label: str) -> Column:
            return F.concat(F.lit(label + "/"), col(name).cast("string"))

        step = reduce(
            DataFrame.unionByName,
            [
                ends.select(whole("~to", far).alias("~from"), whole("~from", near).alias("~to"))
                for near, far, ends in tables
            ],
        ).distinct()
        begun = [ids.select(whole("node_id", label).alias("node_id")) for label, ids in known.items()]
        every = spread(step, reduce(DataFrame.unionByName, begun), PLAIN_STEPS)
        known = {
            label: every.where(col("node_id").startswith(label + "/")).select(
                F.substring("node_id", F.lit(len(label) + 2), F.length("node_id"))
                .cast("string" if label in text else "bigint")
                .alias("node_id")
            )
            for label in {x for near, far, _ in tables for x in (near, far)} | {targets}
        }
    nears = [
        ends.join(known[far], col("~to") == col("node_id"), "left_semi").select("~from")
        for near, far, ends in tables
        if near == own and far in known
    ]
    if not nears:
        return nodes.where(F.lit(False)).select(col("~own").alias("node_id"))
    found = reduce(DataFrame.unionByName, nears)
    return nodes.join(found, same("~own", own) == col("~from"), "left_semi").select(
        col("~own").alias("node_id")
    )


def _steps(graph: PropertyGraph, rel: RelationshipDef) -> DataFrame:
    """Each pair of neighbours once: ``~from`` and ``~to``."""
    if rel.rel_type == "*":
        edges = _all_edges(graph, rel.direction)
    else:
        edges = orient(graph.edge_frame(rel.rel_type), rel.direction)
    edges = edges.where(col("near_id").isNotNull() & col("far_id").isNotNull())
    return edges.select(col("near_id").alias("~from"), col("far_id").alias("~to")).distinct()


def _bounded(step: DataFrame, begin: DataFrame, max_hops: int, either: bool) -> DataFrame:
    """Pairs within some hops of each other: every round joins only the newest pairs."""
    frontier = (
        step.join(begin, col("~from") == col("node_id"), "left_semi")
        .select(col("~from").alias("near_id"), col("~to").alias("far_id"))
    )
    if either:
        frontier = frontier.where(col("near_id") != col("far_id"))
    frontier = checkpointed(frontier.withColumn("hops", F.lit(1).cast("bigint")))
    rounds = [frontier]
    for hop in range(2, max_hops + 1):
        found = reduce(DataFrame.unionByName, rounds)
        further = (
            frontier.join(step, col("far_id") == col("~from"))
            .select("near_id", col("~to").alias("far_id"))
            .distinct()
        )
        if either:
            further = further.where(col("near_id") != col("far_id"))
        fresh = further.join(found.select("near_id", "far_id"), ["near_id", "far_id"], "left_anti")
        frontier = checkpointed(fresh.withColumn("hops", F.lit(hop).cast("bigint")))
        if frontier.isEmpty():
            break
        rounds.append(frontier)
    return reduce(DataFrame.unionByName, rounds)


def _closure(step: DataFrame, either: bool) -> DataFrame:
    """All pairs joined by a path, by doubling.

    With all pairs of at most n hops known, a least path of up to 2 n hops is a pair of exactly n
    hops and a known one behind it. So the rounds are the logarithm of the longest least path, and
    each joins only the outermost pairs with what is known.
    """
    pairs = step.select(col("~from").alias("near_id"), col("~to").alias("far_id"))
    if either:
        pairs = pairs.where(col("near_id") != col("far_id"))
    rounds = [checkpointed(pairs.withColumn("hops", F.lit(1).cast("bigint")))]
    length = 1
    while True:
        known = reduce(DataFrame.unionByName, rounds)
        outer = rounds[-1].where(col("hops") == length)
        if outer.isEmpty():
            return known
        behind = known.select(
            col("near_id").alias("~via"), col("far_id").alias("~end"), col("hops").alias("~more")
        )
        further = outer.join(behind, col("far_id") == col("~via")).select(
            "near_id", col("~end").alias("far_id"), (col("hops") + col("~more")).alias("hops")
        )
        if either:
            further = further.where(col("near_id") != col("far_id"))
        further = further.groupBy("near_id", "far_id").agg(F.min("hops").alias("hops"))
        rounds.append(
            checkpointed(
                further.join(known.select("near_id", "far_id"), ["near_id", "far_id"], "left_anti")
            )
        )
        length *= 2


#: Rounds of a search that take one step each before long ways are followed by jumps.
PLAIN_STEPS = 3


def spread(step: DataFrame, seeds: DataFrame, turn: int = 0) -> DataFrame:
    """The seeds and every node that they reach (``node_id``), for edges ``~from``, ``~to``.

    The first rounds take one step each. Then every open node picks one node before it, and these
    picks are doubled: a whole chain behind a reached node is found in a logarithm of its length.
    A search with ever new picks ends when no step finds anything. ``turn`` is the number of rounds
    that are done already.
    """
    step = checkpointed(step)
    frontier = checkpointed(seeds.select("node_id").where(col("node_id").isNotNull()).distinct())
    reached = [frontier]
    while True:
        found = reduce(DataFrame.unionByName, reached)
        fresh = (
            step.join(frontier, col("~from") == col("node_id"), "left_semi")
            .select(col("~to").alias("node_id"))
            .distinct()
            .join(found, "node_id", "left_anti")
        )
        frontier = checkpointed(fresh)
        if frontier.isEmpty():
            return found
        reached.append(frontier)
        turn += 1
        if turn < PLAIN_STEPS:
            continue
        found = reduce(DataFrame.unionByName, reached)
        jumped = _jumped(step, found, turn)
        reached.append(jumped)
        frontier = checkpointed(frontier.unionByName(jumped))


def _jumped(step: DataFrame, found: DataFrame, turn: int) -> DataFrame:
    """Open nodes with a reached one among the nodes before them, along one pick each."""
    open_steps = step.join(found, col("~to") == col("node_id"), "left_anti")
    picked = open_steps.groupBy(col("~to").alias("node_id")).agg(
        F.min_by("~from", F.xxhash64("~from", "~to", F.lit(turn))).alias("~at")
    )
    mark = found.select(col("node_id").alias("~known"))
    state = picked.join(mark, col("~at") == col("~known"), "left").select(
        "node_id", "~at", col("~known").isNotNull().alias("~hit")
    )
    state = checkpointed(state)
    hits = state.where("`~hit`").count()
    while True:
        before = state.select(
            col("node_id").alias("~via"), col("~at").alias("~next"), col("~hit").alias("~before")
        )
        state = checkpointed(
            state.join(before, col("~at") == col("~via"), "left").select(
                "node_id",
                F.when(col("~hit"), col("~at")).otherwise(F.coalesce("~next", "~at")).alias("~at"),
                (col("~hit") | F.coalesce("~before", F.lit(False))).alias("~hit"),
            )
        )
        now = state.where("`~hit`").count()
        if now == hits:
            return state.where("`~hit`").select("node_id")
        hits = now


def _parts(step: DataFrame) -> DataFrame:
    """``node_id`` and ``~part`` of all nodes of edges in both directions: the least node connected.

    Alternates two steps: every node hands its larger neighbours to its least one, then its smaller
    ones, so that the rounds are the logarithm of the longest way.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        least = pairs.groupBy("~from").agg(F.least(col("~from"), F.min("~to")).alias("~least"))
        side = col("~to") > col("~from") if large else col("~to") <= col("~from")
        moved = pairs.where(side).join(least, "~from")
        out = moved.select(col("~to").alias("~from"), col("~least").alias("~to"))
        if not large:
            out = out.unionByName(least.select("~from", col("~least").alias("~to")))
        return out.where(col("~from") != col("~to")).distinct()

    pairs, before = checkpointed(step.select("~from", "~to").distinct()), None
    while True:
        both = pairs.unionByName(pairs.select(col("~to").alias("~from"), col("~from").alias("~to")))
        pairs = checkpointed(star(star(both.distinct(), True).select(
            F.greatest("~from", "~to").alias("~from"), F.least("~from", "~to").alias("~to")
        ), False))
        state = pairs.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("~from", "~to").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    roots = pairs.select(col("~to").alias("node_id"), col("~to").alias("~part")).distinct()
    return pairs.select(col("~from").alias("node_id"), col("~to").alias("~part")).unionByName(roots)


def _global_id(model: type[NodeModel], node_id: Column) -> Column:
    return F.concat(F.lit(model.label_name() + "/"), node_id.cast("string"))


def _all_edges(graph: PropertyGraph, direction: Direction) -> DataFrame:
    whole = []
    for edge in graph.edges.values():
        whole.append(
            orient(
                graph.edge_frame(edge.rel_type).select(
                    col("edge_id").cast("string").alias("edge_id"),
                    _global_id(edge.src, col("src_id")).alias("src_id"),
                    _global_id(edge.dst, col("dst_id")).alias("dst_id"),
                ),
                direction,
            )
        )
    return reduce(DataFrame.unionByName, whole)


def node_pairs(
    left: NodeSet,
    right: NodeSet,
    names: tuple[str, str],
    equal: list[tuple[str, str]] | None = None,
    where: Column | None = None,
    compare: list[tuple[str, str, str]] | None = None,
) -> DataFrame:
    """Pairs of nodes from two independent queries, packed under the given names.

    ``equal`` lists properties that must agree and makes this a keyed join. ``compare`` lists
    inequalities (property, ``<`` ``<=`` ``>`` or ``>=``, property of the other node), which
    are joined by ranges of their values. Without either every node meets every other one,
    spread over a grid of tasks.
    """
    from .compose import Composition
    from .product import product
    from .theta import COMPARE, theta_join

    sides = []
    for i, (ns, name) in enumerate(zip((left, right), names)):
        comp = Composition(ns)
        keys = [comp.root.column(e[i]).alias(f"~{name}{n}") for n, e in enumerate(equal or [])]
        for n, e in enumerate(compare or []):
            keys.append(comp.root.column(e[2 * i]).alias(f"~{name}?{n}"))
        sides.append(comp.paged().select(comp.root.packed().alias(name), *keys))
    a, b = sides
    inequalities = [
        (f"~{names[0]}?{n}", e[1], f"~{names[1]}?{n}") for n, e in enumerate(compare or [])
    ]
    if equal:
        on = [col(f"~{names[0]}{n}") == col(f"~{names[1]}{n}") for n in range(len(equal))]
        pairs = a.join(b, on)
        for x, op, y in inequalities:
            pairs = pairs.where(COMPARE[op](col(x), col(y)))
    elif inequalities:
        pairs = theta_join(a, b, inequalities)
    else:
        pairs = product(a, b)
    pairs = pairs if where is None else pairs.where(where)
    return pairs.select(*names)
