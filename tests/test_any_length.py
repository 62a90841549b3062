"""Paths of any length and existence over them, against plain searches."""

import random
from collections import deque

import pytest

from weftgraph import NodeModel, PropertyGraph, Relationship, RelationshipTo, StringProperty
from weftgraph.model import Direction, RelationshipDef
from weftgraph.operators import paths
from weftgraph.operators.paths import reachable, reaching, spread


class Station(NodeModel):
    name = StringProperty()
    line = RelationshipTo("Station", "LINE")
    beside = Relationship("Station", "LINE")
    any_depot = RelationshipTo("Depot", "*")
    near_depot = Relationship("Depot", "*")


class Depot(NodeModel):
    name = StringProperty()
    back = RelationshipTo("Station", "FEEDS")


def network(spark, edges, stations, leads=(), feeds=(), depots=3):
    def frame(pairs):
        rows = [(i, a, b) for i, (a, b) in enumerate(pairs)]
        return spark.createDataFrame(rows, "edge_id long, src_id long, dst_id long")

    nodes = spark.range(stations).selectExpr("id as node_id", "concat('s', id) as name")
    g = PropertyGraph(spark).with_nodes(Station, nodes)
    g = g.with_nodes(Depot, spark.range(depots).selectExpr("id as node_id", "concat('d', id) as name"))
    g = g.with_edges("LINE", frame(edges), src=Station, dst=Station)
    g = g.with_edges("LEADS", frame(leads), src=Station, dst=Depot)
    return g.with_edges("FEEDS", frame(feeds), src=Depot, dst=Station)


def distances(edges, starts):
    after = {}
    for a, b in edges:
        after.setdefault(a, set()).add(b)
    out = {}
    for start in starts:
        seen, todo = {}, deque((b, 1) for b in sorted(after.get(start, ()), key=str))
        while todo:
            at, hops = todo.popleft()
            if at not in seen:
                seen[at] = hops
                todo.extend((b, hops + 1) for b in after.get(at, ()))
        out |= {(start, b): h for b, h in seen.items()}
    return out


def found(df):
    rows = df.collect()
    assert len({(r.near_id, r.far_id) for r in rows}) == len(rows)
    return {(r.near_id, r.far_id): r.hops for r in rows}


@pytest.fixture
def rounds(monkeypatch):
    seen = []
    real = paths.checkpointed

    def counted(frame):
        seen.append(1)
        return real(frame)

    monkeypatch.setattr(paths, "checkpointed", counted)
    return seen


@pytest.mark.parametrize("seed", [3, 4])
def test_closure_of_random_graphs_with_rings(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(25), rng.randrange(25)) for _ in range(30)]
    edges += [(30 + i, 30 + (i + 1) % 5) for i in range(5)] + [(29, 30), (28, 28)]
    g = network(spark, edges, 35)
    rel = Station.relationship("line")
    assert found(reachable(g, Station, rel)) == distances(edges, range(35))
    some = spark.range(0, 35, 7).selectExpr("id as node_id")
    assert found(reachable(g, Station, rel, start=some)) == distances(edges, range(0, 35, 7))
    both = distances([*edges, *[(b, a) for a, b in edges]], range(35))
    both = {k: h for k, h in both.items() if k[0] != k[1]}
    assert found(reachable(g, Station, Station.relationship("beside"))) == both


def test_a_long_chain_takes_few_rounds(spark, rounds):
    edges = [(i, i + 1) for i in range(300)]
    g = network(spark, edges, 301)
    pairs = reachable(g, Station, Station.relationship("line"))
    assert len(rounds) <= 11
    assert pairs.count() == 300 * 301 // 2
    assert pairs.agg({"hops": "max"}).first()[0] == 300
    assert found(g.nodes(Station).filter(name="s0").traverse("line").values(
        near_id="id", far_id="line__id", hops="line__id"
    )) == {(0, 1): 1}


def test_a_search_backwards_jumps_along_chains(spark, rounds):
    # a chain of 1,000 stations with one depot behind its end, and side ways into it
    edges = [(i, i + 1) for i in range(1000)] + [(2000 + i, 10 * i) for i in range(20)]
    g = network(spark, edges, 2050, leads=[(1000, 1)])
    ids = {r.node_id for r in reaching(g, Station, Station.relationship("any_depot")).collect()}
    assert ids == {*range(1001), *range(2000, 2020)}
    assert len(rounds) <= 40
    has = g.nodes(Station).has(any_depot=False).values("id").collect()
    assert {r.id for r in has} == set(range(2050)) - ids


@pytest.mark.parametrize("seed", [5, 6])
def test_existence_over_all_types(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(30), rng.randrange(30)) for _ in range(25)]
    leads = [(rng.randrange(30), rng.randrange(2)) for _ in range(2)]
    feeds = [(rng.randrange(3), rng.randrange(30)) for _ in range(2)]
    g = network(spark, edges, 30, leads, feeds)
    whole = [(("s", a), ("s", b)) for a, b in edges]
    whole += [(("s", a), ("d", b)) for a, b in leads] + [(("d", a), ("s", b)) for a, b in feeds]
    nodes = [("s", i) for i in range(30)]
    ahead = distances(whole, nodes)
    want = {i for i in range(30) if any((("s", i), ("d", d)) in ahead for d in range(3))}
    rel = Station.relationship("any_depot")
    assert {r.node_id for r in reaching(g, Station, rel).collect()} == want
    got = found(reachable(g, Station, rel))
    assert got == {(a[1], b[1]): h for (a, b), h in ahead.items() if b[0] == "d"}
    around = distances([*whole, *[(b, a) for a, b in whole]], nodes)
    want = {i for i in range(30) if any((("s", i), ("d", d)) in around for d in range(3))}
    near = Station.relationship("near_depot")
    assert {r.node_id for r in reaching(g, Station, near).collect()} == want
    names = g.nodes(Station).has(near_depot=True).values("id").collect()
    assert {r.id for r in names} == want


def test_reaching_oneself(spark):
    # 0 -> 1 -> 0 is a ring; 2 has a loop; 3 -> 4 is a way
    g = network(spark, [(0, 1), (1, 0), (2, 2), (3, 4)], 6)
    out = RelationshipDef(Station, "LINE", Direction.OUTGOING)
    assert {r.node_id for r in reaching(g, Station, out).collect()} == {0, 1, 2, 3}
    either = RelationshipDef(Station, "LINE", Direction.EITHER)
    assert {r.node_id for r in reaching(g, Station, either).collect()} == {0, 1, 3, 4}


def test_nothing_to_follow(spark):
    g = network(spark, [], 5)
    assert reachable(g, Station, Station.relationship("line")).count() == 0
    assert reaching(g, Station, Station.relationship("any_depot")).count() == 0
    empty = spark.createDataFrame([], "`~from` long, `~to` long")
    seeds = spark.createDataFrame([(1,), (1,), (None,)], "node_id long")
    assert [r.node_id for r in spread(empty, seeds).collect()] == [1]
    with pytest.raises(ValueError):
        reachable(g, Station, Station.relationship("line"), max_hops=0)


def test_existence_writes_no_edges(spark, monkeypatch):
    """Where three rounds find all, only ids of nodes are written, and ids keep their type."""
    written = []
    real = paths.checkpointed
    monkeypatch.setattr(paths, "checkpointed", lambda f: written.append(f.dtypes) or real(f))
    g = network(spark, [(1, 2), (7, 7)], 9, leads=[(2, 0), (5, 1), (6, 77)], feeds=[(1, 8)])
    rel = Station.relationship("any_depot")
    assert {r.node_id for r in reaching(g, Station, rel).collect()} == {1, 2, 5}
    assert written and all(kinds == [("node_id", "bigint")] for kinds in written)


@pytest.mark.parametrize("length", [2, 3, 4, 9])
def test_existence_before_and_after_the_plain_rounds(spark, length):
    chain = [(i, i + 1) for i in range(length)]
    g = network(spark, [*chain, (40, 41), (41, 40)], 50, leads=[(length, 2)])
    rel = Station.relationship("any_depot")
    assert {r.node_id for r in reaching(g, Station, rel).collect()} == set(range(length + 1))
