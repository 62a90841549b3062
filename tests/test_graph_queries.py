"""Queries over a small sky; what must come out is counted in the lists it is made from."""

from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.observatory import Cluster, Sky, Star, Telescope, catalogue, night
from weftgraph import Collect, Last, NodeNameResolver, Path, Q, RelationNameResolver, Size
from weftgraph.errors import CardinalityViolation, DoesNotExist, MultipleNodesReturned
from weftgraph.operators.positions import POSITION, numbered
from weftgraph.sources.store import read_graph, write_graph

SKY = catalogue()
STARS = {i: (name, m) for i, name, m in SKY.stars}
CLUSTERS = {i: name for i, name, _ in SKY.clusters}
#: (telescope, star, cluster) of all ways from a telescope to a cluster
WAYS = [(t, s, c) for t, s, _ in SKY.observed for s2, c in SKY.members if s == s2]


@pytest.fixture(scope="module")
def sky(spark):
    return SKY.graph(spark)


def tuples(frame):
    return sorted(map(tuple, frame.collect()))


def test_a_path_in_a_filter_gives_each_of_its_variables(sky):
    found = sky.nodes(Star).filter(clusters__name="Hyades")
    assert {r[0].name for r in found.all()} == {"HD102", "HD103"}
    assert all(len(r) == 3 for r in found.all())
    far = sky.nodes(Telescope).filter(stars__clusters__name="Omega").values("id", "stars__id")
    assert tuples(far) == sorted((t, s) for t, s, c in WAYS if CLUSTERS[c] == "Omega")
    assert not sky.nodes(Telescope).filter(stars__clusters__name="nowhere").all()


def test_edges_are_filtered_and_ordered_by_their_properties(sky):
    late = sky.nodes(Telescope).filter(**{"stars|night__gt": night(50)}).values("id", "stars__id")
    assert tuples(late) == sorted((t, s) for t, s, n in SKY.observed if n > 50)
    both = sky.nodes(Telescope).filter(stars__name="HD100", **{"stars|night__lte": night(12)})
    assert tuples(both.ids()) == sorted((t,) for t, s, n in SKY.observed if s == 0 and n <= 12)
    by_night = sky.nodes(Telescope).traverse("stars").order_by("-stars|night").values("stars__id")
    want = [s for _, s, n in sorted(SKY.observed, key=lambda o: -o[2])]
    assert [r[0] for r in by_night.collect()] == want


def test_paths_that_must_and_paths_that_may_lead_somewhere(sky):
    rows = sky.nodes(Telescope).traverse(Path("stars__clusters", include_rels_in_return=False)).all()
    assert sorted((r[0].node_id, r[1].node_id, r[2].node_id) for r in rows) == sorted(WAYS)
    may = sky.nodes(Star).traverse(Path("telescopes", optional=True)).values("id", "telescopes__id")
    seen = {s for _, s, _ in SKY.observed}
    want = [(s, t) for t, s, _ in SKY.observed] + [(s, None) for s in STARS if s not in seen]
    assert set(map(tuple, may.collect())) == set(want)
    some = sky.nodes(Telescope).traverse("stars__clusters").filter(name="scope-2")
    assert len(some) == sum(t == 2 for t, _, _ in WAYS)
    assert 2 in some and 3 not in some


def test_conditions_on_a_path_that_may_be_missing(sky):
    base = sky.nodes(Star).traverse(Path("clusters", optional=True))
    omega = {s for s, c in SKY.members if c == 2}
    only = {r.id for r in base.filter(Q(magnitude__gte=9) | Q(clusters__name="Omega")).ids().collect()}
    assert only == omega | {s for s, (_, m) in STARS.items() if m >= 9}
    not_both = base.filter(~(Q(magnitude=4) & Q(clusters__name="Omega"))).ids()
    assert {r.id for r in not_both.collect()} >= {s for s, (_, m) in STARS.items() if m != 4}
    rows = base.filter(clusters__name="Omega").values("id", "clusters__id").collect()
    assert {r.id for r in rows} == set(STARS)
    assert {r.id for r in rows if r[1] is not None} == omega


def test_order_by_a_traversed_property(sky):
    rows = sky.nodes(Cluster).traverse("stars").order_by("stars__magnitude", "name").values("stars__magnitude")
    found = [r[0] for r in rows.collect()]
    assert found == sorted(STARS[s][1] for s, _ in SKY.members)
    with pytest.raises(ValueError):
        sky.nodes(Cluster).order_by("stars__magnitude").all()


HIDDEN = dict(include_rels_in_return=False, include_nodes_in_return=False)


def reached():
    out = defaultdict(list)
    for t, _, c in WAYS:
        out[t].append(c)
    return out


def test_lists_and_their_sizes(sky):
    base = sky.nodes(Telescope).traverse(far=Path("stars__clusters", **HIDDEN))
    for distinct in (False, True):
        sizes = base.annotate(n=Size(Collect("far", distinct=distinct))).values("id", "n")
        kind = set if distinct else list
        assert tuples(sizes) == sorted((t, len(kind(c))) for t, c in reached().items())
    rows = base.annotate(
        ends=Collect(NodeNameResolver("stars__clusters"), distinct=True),
        steps=Collect(RelationNameResolver("stars__clusters"), distinct=True),
    ).all()
    assert {len(r.ends) for r in rows} == {len(set(c)) for c in reached().values()}
    with pytest.raises(NotImplementedError):
        base.annotate("far")


@pytest.mark.parametrize("size", [1, 2, 3, 50])
def test_lists_in_parts_have_one_shape_at_every_size(sky, size):
    base = sky.nodes(Telescope).traverse(far=Path("stars__clusters", **HIDDEN))
    parts = base.annotate(far=Collect("far", part_size=size)).values("id", "part", ids="far.node_id")
    got = defaultdict(list)
    for r in parts.orderBy("id", "part").collect():
        assert r.part * size == len(got[r.id]) and 1 <= len(r.ids) <= size
        got[r.id] += sorted(r.ids)
    assert dict(got) == {t: sorted(c) for t, c in reached().items()}


def test_ordered_lists_in_parts(sky):
    found = (
        sky.nodes(Telescope)
        .traverse(Path("stars", **HIDDEN))
        .intermediate_transform(
            {
                "telescope": {"source": "telescope", "include_in_return": True},
                "bright": {"source": NodeNameResolver("stars"), "source_prop": "magnitude"},
            },
            ordering=["-bright"],
        )
        .annotate(all=Collect("bright", part_size=2))
        .values("id", "part", "all")
    )
    got = defaultdict(list)
    for r in found.orderBy("id", "part").collect():
        got[r.id] += r["all"]
    want = defaultdict(list)
    for t, s, _ in SKY.observed:
        want[t].append(STARS[s][1])
    assert dict(got) == {t: sorted(m, reverse=True) for t, m in want.items()}


@pytest.mark.parametrize("tasks", ["3", "9"])
def test_positions_do_not_depend_on_the_number_of_tasks(spark, tasks):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        rows = spark.range(500).select((F.col("id") % 3).alias("g"), F.pmod(F.xxhash64("id"), F.lit(40)).alias("v"), "id")
        for keys in (["g"], []):
            found = numbered(rows, keys, [F.col("v").desc(), F.col("id").asc()]).collect()
            groups = defaultdict(list)
            for r in found:
                groups[r.g if keys else 0].append((r[POSITION], -r.v, r.id))
            for own in groups.values():
                own.sort()
                assert [p for p, _, _ in own] == list(range(len(own)))
                assert [x[1:] for x in own] == sorted(x[1:] for x in own)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_nested_results(sky):
    rows = sky.nodes(Telescope).traverse("stars__clusters").resolve_subgraph().collect()
    assert sorted((r.node_id, r.stars.node_id, r.stars.clusters.node_id) for r in rows) == sorted(WAYS)
    assert {r.stars_relationship.observer for r in rows} == {"observer 0", "observer 1"}
    with pytest.raises(RuntimeError, match="no path"):
        sky.nodes(Telescope).resolve_subgraph()


def widest():
    out = {}
    for t, s, _ in SKY.observed:
        out[s] = max(out.get(s, (-1, -1)), (SKY.telescopes[t][2], t))
    return {s: t for s, (_, t) in out.items()}


def test_an_inner_query_for_each_outer_row(sky):
    inner = (
        sky.nodes(Star)
        .traverse(telescopes="telescopes")
        .intermediate_transform({"telescopes": {"source": "telescopes"}}, ordering=["telescopes.aperture"])
        .annotate(widest=Last(Collect("telescopes")))
    )
    outer = sky.nodes(Star).subquery(inner, ["widest"], [NodeNameResolver("self")])
    got = {r[1].name: r[0] and r[0].node_id for r in outer.all()}
    assert got == {name: widest().get(s) for s, (name, _) in STARS.items()}
    with pytest.raises(RuntimeError, match="no column 'narrowest'"):
        sky.nodes(Star).subquery(inner, ["narrowest"])
    with pytest.raises(ValueError, match="names no variable"):
        sky.nodes(Star).subquery(inner, ["widest"], [3.5])


def test_an_inner_query_of_its_own(sky):
    inner = (
        sky.nodes(Telescope)
        .filter(name="scope-1")
        .intermediate_transform(
            {"wide": {"source": "telescope", "source_prop": "aperture", "include_in_return": True}}
        )
    )
    rows = sky.nodes(Cluster).subquery(inner, ["wide"]).all()
    assert len(rows) == len(CLUSTERS) and {r[0] for r in rows} == {2}
    assert sky.nodes(Cluster).subquery(inner.filter(name="none"), ["wide"]).all() == []


def test_transforms_name_what_goes_on(sky):
    first_seen = {}
    for t, s, n in SKY.observed:
        first_seen[s] = min(first_seen.get(s, (10**6, -1)), (n, t))
    rows = (
        sky.nodes(Star)
        .traverse("telescopes")
        .intermediate_transform(
            {
                "star": {"source": "star", "include_in_return": True},
                "scope": {"source": NodeNameResolver("telescopes")},
                "seen": {"source": RelationNameResolver("telescopes")},
            },
            distinct=True,
            ordering=["-seen.night"],
        )
        .annotate(first=Last(Collect("scope")))
        .all()
    )
    assert {r[0].node_id: r[1].node_id for r in rows} == {s: t for s, (_, t) in first_seen.items()}
    base = sky.nodes(Star).traverse(scope="telescopes")
    with pytest.raises(ValueError, match="names no variable"):
        base.intermediate_transform({"x": {"source": Collect("scope")}})
    with pytest.raises(ValueError, match="variable to keep"):
        base.intermediate_transform({})


def test_paths_may_share_their_first_variable(sky):
    base = sky.nodes(Telescope).traverse("stars", "stars__clusters")
    per_scope = defaultdict(int)
    for t, _, _ in SKY.observed:
        per_scope[t] += 1
    # apart, each star goes with each cluster of any other star, an edge being used once
    shared = base.unique_variables("stars")
    assert tuples(shared.values("id", "stars__id", "stars__clusters__id")) == sorted(WAYS)
    assert len(shared) == len(WAYS) < len(base)


def test_lists_of_values_in_lookups(sky):
    assert {r.name for r in sky.nodes(Cluster).filter(kinds__in=["young", "globular"]).all()} == {"Pleiades", "Omega"}
    assert {r.name for r in sky.nodes(Cluster).filter(~Q(kinds__in=["open"])).all()} == {"Omega"}
    for wrong in ({"kinds__in": "open"}, {"name__isnull": 1}, {"colour": "blue"}):
        with pytest.raises(ValueError):
            sky.nodes(Cluster).filter(**wrong)


def test_pages_and_getters(sky):
    order = sorted(STARS, key=lambda s: (STARS[s][1], s))
    q = sky.nodes(Star).order_by("magnitude")
    assert [r.node_id for r in q] == order
    for a, b in ((0, 3), (2, 5), (3, None), (0, 0), (6, 9)):
        assert [r.node_id for r in q[a:b].all()] == order[a:b] and len(q[a:b]) == len(order[a:b])
    assert q[4].node_id == order[4] and q.first().node_id == order[0]
    for wrong, error in ((99, IndexError), (-2, ValueError)):
        with pytest.raises(error):
            q[wrong]
    assert q.get(name="HD105").magnitude == 2
    assert q.get_or_none(name="HD999") is None and q.first_or_none(name="HD999") is None
    with pytest.raises(MultipleNodesReturned):
        q.get(magnitude=9)
    with pytest.raises(DoesNotExist):
        q.get(name="HD999")
    assert q and not q.filter(magnitude__gt=50)
    assert sorted(q.all(lazy=True)) == sorted(STARS)
    lone = set(STARS) - {s for s, _ in SKY.members}
    assert {r.node_id for r in sky.nodes(Star).has(clusters=False).all()} == lone
    assert len(sky.nodes(Star).has(clusters=True)) == len(STARS) - len(lone)
    with pytest.raises(NotImplementedError):
        sky.nodes(Star).has(clusters=sky.nodes(Cluster))


def test_single_minds_the_cardinality(spark):
    from weftgraph import NodeModel, One, PropertyGraph, RelationshipTo, StringProperty

    class Dome(NodeModel):
        name = StringProperty()

    class Mount(NodeModel):
        name = StringProperty()
        dome = RelationshipTo(Dome, "UNDER", cardinality=One)

    nodes = "node_id long, name string"
    g = (
        PropertyGraph(spark)
        .with_nodes(Dome, spark.createDataFrame([(1, "a"), (2, "b")], nodes))
        .with_nodes(Mount, spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], nodes))
        .with_edges(
            "UNDER",
            spark.createDataFrame([(0, 1, 1), (1, 2, 1), (2, 2, 2)], "edge_id long, src_id long, dst_id long"),
            src=Mount,
            dst=Dome,
        )
    )
    assert g.nodes(Mount).filter(name="x").dome.single().name == "a"
    for name in ("y", "z"):
        with pytest.raises(CardinalityViolation):
            g.nodes(Mount).filter(name=name).dome.single()
    first, wrong = g.nodes(Mount).dome.single_per_source()
    assert {r.source_id for r in first.collect()} == {1, 2}
    assert {(r.item, r.n) for r in wrong.collect()} == {("2", 2), ("3", 0)}


def test_graphs_read_back_as_they_were_written(sky, spark, tmp_path):
    wider = sky.with_nodes(Star, sky.stored(Star).withColumn("labels", F.array(F.lit("Star"))))
    write_graph(wider, str(tmp_path))
    again = read_graph(sky, str(tmp_path))
    assert "labels" in again.stored(Star).columns
    assert tuples(again.edge_frame("OBSERVED")) == tuples(sky.edge_frame("OBSERVED"))
    far = again.nodes(Telescope).filter(stars__clusters__name="Omega")
    assert len(far) == sum(c == 2 for _, _, c in WAYS)


def test_an_empty_sky(spark):
    g = Sky().graph(spark)
    assert g.nodes(Star).traverse("telescopes").all() == []
    assert len(g.nodes(Star)) == 0 and not g.nodes(Star)
    assert isinstance(night(0), datetime)
