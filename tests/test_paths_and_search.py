import pytest

from weftgraph import (
    ArrayProperty,
    FloatProperty,
    FulltextFilter,
    FulltextIndex,
    NodeModel,
    Path,
    PropertyGraph,
    Relationship,
    RelationshipFrom,
    RelationshipTo,
    StringProperty,
    VectorFilter,
    VectorIndex,
)
from weftgraph.errors import RelationshipClassNotDefined
from weftgraph.model import Direction, RelationshipDef
from weftgraph.operators.paths import node_pairs, path_values, reachable, repeated


class Country(NodeModel):
    code = StringProperty()


class City(NodeModel):
    name = StringProperty()
    country = RelationshipTo(Country, "FROM_COUNTRY")


class Person(NodeModel):
    name = StringProperty()
    city = RelationshipTo(City, "LIVES_IN")
    missing = RelationshipTo(City, "NEVER_LOADED")
    knows = RelationshipTo("Person", "KNOWS")
    friend = Relationship("Person", "KNOWS")


def people(spark, knows):
    g = PropertyGraph(spark)
    names = [(i, f"p{i}") for i in range(6)]
    g = g.with_nodes(Person, spark.createDataFrame(names, "node_id long, name string"))
    g = g.with_nodes(City, spark.createDataFrame([(1, "Berlin")], "node_id long, name string"))
    g = g.with_nodes(Country, spark.createDataFrame([(1, "DE")], "node_id long, code string"))
    ends = "edge_id long, src_id long, dst_id long"
    g = g.with_edges("LIVES_IN", spark.createDataFrame([(1, 0, 1)], ends), src=Person, dst=City)
    g = g.with_edges("FROM_COUNTRY", spark.createDataFrame([(1, 1, 1)], ends), src=City, dst=Country)
    rows = [(i, a, b) for i, (a, b) in enumerate(knows)]
    return g.with_edges("KNOWS", spark.createDataFrame(rows, ends), src=Person, dst=Person)


def test_path_value(spark):
    g = people(spark, [(0, 1)])
    row = path_values(g.nodes(Person), "city__country").first()
    assert row.length == 2 and row.start_node.name == "p0" and row.end_node.code == "DE"
    assert [n.label for n in row.nodes] == ["Person", "City", "Country"]
    assert [r.rel_type for r in row.relationships] == ["LIVES_IN", "FROM_COUNTRY"]
    with pytest.raises(RelationshipClassNotDefined):
        g.nodes(Person).traverse("missing").all()


def test_edge_used_once_in_a_path_only(spark):
    g = people(spark, [(0, 1), (1, 2), (3, 3)])
    two = repeated(g.nodes(Person), "friend", 2).values("id", "friend__friend__id")
    assert sorted(map(tuple, two.collect())) == [(0, 2), (2, 0)]
    apart = g.nodes(Person).friend.nodes().friend.nodes().ids()
    # separate steps may go back: 0-1-0 beside 2-1-0
    assert apart.where("id = 0").count() == 2
    assert g.nodes(Person).traverse("friend").values("id").where("id = 3").count() == 1


def brute(pairs, hops, both):
    step = set(pairs) | ({(b, a) for a, b in pairs} if both else set())
    best, frontier = {}, step
    for h in range(1, hops + 1):
        frontier = {p for p in frontier if not (both and p[0] == p[1])}
        fresh = {p for p in frontier if p not in best}
        best.update(dict.fromkeys(fresh, h))
        frontier = {(a, d) for a, b in fresh for c, d in step if b == c}
    return {(a, b, h) for (a, b), h in best.items()}


@pytest.mark.parametrize("direction", [Direction.OUTGOING, Direction.EITHER])
def test_reachable(spark, direction):
    knows = [(0, 1), (1, 2), (2, 0), (2, 3), (3, 4), (4, 4), (0, 1)]
    rel = RelationshipDef(Person, "KNOWS", direction)
    found = reachable(people(spark, knows), Person, rel, max_hops=4)
    got = {(r.near_id, r.far_id, r.hops) for r in found.collect()}
    assert got == brute(knows, 4, direction == Direction.EITHER)


def test_any_type_and_length(spark):
    g = people(spark, [(1, 0)])
    rel = RelationshipDef(Country, "*", Direction.OUTGOING)
    found = reachable(g, Person, rel, max_hops=5)
    assert {(r.near_id, r.far_id, r.hops) for r in found.collect()} == {(0, 1, 2), (1, 1, 3)}


def test_pairs_without_a_key(spark):
    g = people(spark, [(0, 1)])
    ns = g.nodes(Person)
    from pyspark.sql import functions as F

    found = node_pairs(ns, ns, ("a", "b"), where=F.expr("a.name < b.name"))
    assert found.count() == 15 and found.distinct().count() == 15
    assert "CartesianProduct" not in found._jdf.queryExecution().toString()


class Supplier(NodeModel):
    name = StringProperty()
    products = RelationshipTo("Product", "SUPPLIES")


class Product(NodeModel):
    name = StringProperty()
    description = StringProperty(fulltext_index=FulltextIndex())
    vector = ArrayProperty(FloatProperty(), vector_index=VectorIndex(2))
    plain = ArrayProperty(FloatProperty())
    suppliers = RelationshipFrom(Supplier, "SUPPLIES")


def shop(spark):
    g = PropertyGraph(spark)
    products = [
        (1, "a", "Red wool scarf", [0.5, 0.5]),
        (2, "b", "red red shirt", [1.0, 0.0]),
        (3, "c", "blue hat", [0.0, -1.0]),
        (4, "d", None, None),
    ]
    g = g.with_nodes(
        Product,
        spark.createDataFrame(
            products, "node_id long, name string, description string, vector array<double>"
        ),
    )
    g = g.with_nodes(Supplier, spark.createDataFrame([(1, "s")], "node_id long, name string"))
    ends = "edge_id long, src_id long, dst_id long"
    return g.with_edges(
        "SUPPLIES", spark.createDataFrame([(1, 1, 1), (2, 1, 3)], ends), src=Supplier, dst=Product
    )


def test_vector_search(spark):
    nodes = shop(spark).nodes(Product)

    def near(**k):
        return nodes.filter(vector_filter=VectorFilter(3, "vector", [0.25, 0.0], **k))

    rows = near().values("name", "score").collect()
    assert [(r.name, round(r.score, 3)) for r in rows] == [("b", 1.0), ("a", 0.854), ("c", 0.5)]
    assert len(near(threshold=0.8).all()) == 2
    one = nodes.filter(VectorFilter(1, "vector", [0.25, 0.0], threshold=0.8))
    assert len(one.all()) == 1 and list(one.df().columns) == ["product", "score"]
    assert near().filter(name="c").values("name").collect()[0].name == "c"
    path = near().filter(suppliers__name="s").df()
    assert "score" not in path.columns and path.count() == 2
    assert near().traverse(Path("suppliers", optional=True)).df().count() == 3
    with pytest.raises(ValueError):
        near(threshold="0.8").df()
    with pytest.raises(AttributeError):
        nodes.filter(VectorFilter(1, "plain", [1.0])).df()
    with pytest.raises(AttributeError):
        nodes.filter(VectorFilter(1, "nothing", [1.0])).df()


def test_text_search(spark):
    nodes = shop(spark).nodes(Product)

    def match(text, **k):
        return nodes.filter(fulltext_filter=FulltextFilter(text, "description", 10, **k))

    assert [r.name for r in match("RED, scarf").values("name").collect()] == ["a", "b"]
    assert [r.name for r in match("red").values("name").collect()] == ["b", "a"]
    assert match("green").df().count() == 0 and match("?").df().count() == 0
    best = match("red").values("score").first().score
    assert match("red", threshold=best).df().count() == 1
    assert match("red").filter(suppliers__name="s").values("name").collect()[0].name == "a"
    with pytest.raises(AttributeError):
        nodes.filter(FulltextFilter("x", "name", 1)).df()
    with pytest.raises(ValueError):
        match("red", threshold=1).df()
