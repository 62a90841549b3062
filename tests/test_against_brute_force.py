"""Random small graphs: composed queries against plain pattern matching."""

import random
from collections import Counter
from itertools import product

import pytest

from tests.observatory import Sky, Star, Telescope
from weftgraph import Collect, NodeNameResolver, Path, Q, RelationNameResolver, Size


@pytest.fixture(scope="module", params=[1, 2, 3])
def case(request, spark):
    rnd = random.Random(request.param)
    data = {
        "stars": [(i, f"c{i}", rnd.choice([1, 5, 9])) for i in range(5)],
        "telescopes": [(i, f"s{i}", rnd.choice([1, 2])) for i in range(4)],
        "clusters": [(i, f"k{i}") for i in range(3)],
        "supplies": [(rnd.randrange(4), rnd.randrange(5), None) for _ in range(9)],
        "kinds": [(rnd.randrange(5), rnd.randrange(3)) for _ in range(7)],
    }
    sky = {("observed" if k == "supplies" else "members" if k == "kinds" else k): v for k, v in data.items()}
    return Sky(**sky).graph(spark), data


def supplied(data, telescope):
    """(edge, star) of a telescope."""
    return [(e, c) for e, (s, c, _) in enumerate(data["supplies"]) if s == telescope]


def kinds(data, star):
    return [(e, k) for e, (c, k) in enumerate(data["kinds"]) if c == star]


def paths(data, telescope):
    """(edge, star, edge, clusters) of a telescope."""
    return [
        (e, c, f, k) for e, c in supplied(data, telescope) for f, k in kinds(data, c)
    ]


def magnitude(data, star):
    return data["stars"][star][2]


def rows(frame):
    return Counter(tuple(r) for r in frame.collect())


TWO = ("stars", "stars__clusters")


def test_required_path(case):
    g, data = case
    found = g.nodes(Telescope).traverse("stars__clusters").filter(stars__magnitude__gte=5)
    got = rows(found.values("id", "stars|id", "stars__clusters__id"))
    want = Counter(
        (s, e, k) for s in range(4) for e, c, f, k in paths(data, s) if magnitude(data, c) >= 5
    )
    assert got == want and len(found) == sum(want.values())


def test_two_paths_with_fresh_or_shared_prefix(case):
    g, data = case
    base = g.nodes(Telescope).traverse(*TWO).filter(stars__magnitude=5)
    want = Counter(
        (s, e, f)
        for s in range(4)
        for (e, c), (_, _, f, _) in product(supplied(data, s), paths(data, s))
        if magnitude(data, c) == 5
    )
    spec = ("id", "stars|id", "stars__clusters|id")
    assert rows(base.values(*spec)) == want and len(base) == sum(want.values())
    shared = base.unique_variables("stars")
    want = Counter(
        (s, e, f)
        for s in range(4)
        for (e, c), (_, d, f, _) in product(supplied(data, s), paths(data, s))
        if magnitude(data, c) == 5 and c == d
    )
    assert rows(shared.values(*spec)) == want and len(shared) == sum(want.values())


def test_optional_path_with_conditions(case):
    g, data = case
    base = g.nodes(Telescope).traverse(Path("stars__clusters", optional=True))
    spec = ("id", "stars|id", "stars__clusters__id")

    def optional(keep):
        for s in range(4):
            found = [p for p in paths(data, s) if keep(s, p)]
            yield from ((s, p[0], p[3]) for p in found) if found else [(s, None, None)]

    got = rows(base.filter(stars__clusters__name="k1").values(*spec))
    assert got == Counter(optional(lambda s, p: p[3] == 1))
    cheap = base.filter(aperture=1, stars__clusters__name="k1")
    want = Counter(r for r in optional(lambda s, p: p[3] == 1) if data["telescopes"][r[0]][2] == 1)
    assert rows(cheap.values(*spec)) == want and len(cheap) == sum(want.values())
    either = base.filter(Q(aperture=1) | Q(stars__clusters__name="k1"))
    want = Counter(
        r
        for r in optional(lambda s, p: True)
        if data["telescopes"][r[0]][2] == 1 or r[2] == 1
    )
    assert rows(either.values(*spec)) == want


def test_existence_and_exclusion(case):
    g, data = case
    got = {r.id for r in g.nodes(Star).has(telescopes=True, clusters=False).ids().collect()}
    with_telescopes = {c for _, c, _ in data["supplies"]}
    assert got == with_telescopes - {c for c, _ in data["kinds"]}
    left = g.nodes(Star).exclude(telescopes__name="s1", magnitude=5)
    want = Counter(
        (c, s) for s, c, _ in data["supplies"] if not (s == 1 and magnitude(data, c) == 5)
    )
    assert rows(left.values("id", "telescopes__id")) == want


def test_sizes(case):
    g, data = case
    hidden = Path(
        "stars__clusters", optional=True, include_nodes_in_return=False,
        include_rels_in_return=False,
    )
    found = g.nodes(Telescope).traverse(hidden).annotate(
        n=Size(Collect(RelationNameResolver("stars__clusters"))),
        d=Size(Collect(NodeNameResolver("stars__clusters"), distinct=True)),
    )
    want = {
        (s, len(paths(data, s)), len({p[3] for p in paths(data, s)})) for s in range(4)
    }
    assert set(rows(found.values("id", "n", "d"))) == want


def test_chained_traversals(case):
    g, data = case
    found = g.nodes(Telescope).filter(aperture=1).stars.filter(magnitude__lt=9).telescopes
    want = Counter(
        t
        for s, c, _ in data["supplies"]
        for t, d, _ in data["supplies"]
        if c == d and data["telescopes"][s][2] == 1 and magnitude(data, c) < 9
    )
    assert Counter(r.id for r in found.nodes().ids().collect()) == want
