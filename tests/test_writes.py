from datetime import datetime

import pytest

from weftgraph import (
    DateTimeNativeProperty,
    IntegerProperty,
    NodeModel,
    One,
    OneOrMore,
    PropertyGraph,
    Relationship,
    RelationshipFrom,
    RelationshipTo,
    RelModel,
    StringProperty,
    ZeroOrOne,
)
from weftgraph.errors import (
    CardinalityViolation,
    ConstraintViolation,
    NotConnected,
    RequiredProperty,
    UniqueProperty,
)
from weftgraph.operators import constraints as C
from weftgraph.operators import edges as E
from weftgraph.operators import writes as W


class Account(NodeModel):
    email = StringProperty(unique_index=True, required=True)
    age = IntegerProperty()


class WithDefault(NodeModel):
    name = StringProperty(required=True)
    age = IntegerProperty(default=30)
    other_prop = StringProperty()


class Keyed(NodeModel):
    name = StringProperty(required=True)
    email = StringProperty(required=True, unique_index=True)
    age = IntegerProperty()


class Crossing(RelModel):
    since = DateTimeNativeProperty()
    notes = StringProperty()


class Boat(NodeModel):
    name = StringProperty(required=True)
    skipper = RelationshipTo("Skipper", "SAILS", model=Crossing)


class Skipper(NodeModel):
    name = StringProperty(unique_index=True)
    boats = RelationshipFrom(Boat, "SAILS", model=Crossing)


class Rivalry(RelModel):
    since = IntegerProperty()
    reason = StringProperty()


class Harbour(NodeModel):
    name = StringProperty(unique_index=True)
    twins = Relationship("Harbour", "TWIN OF")
    rivals = RelationshipTo("Harbour", "RIVAL OF", model=Rivalry)
    pilot = RelationshipTo("Harbour", "PILOTED BY", cardinality=ZeroOrOne)
    piloted = RelationshipFrom("Harbour", "PILOTED BY", cardinality=ZeroOrOne)


def rows(graph, model, *names):
    return {tuple(r) for r in graph.nodes(model).values(*names).collect()}


def empty(spark, model, columns):
    g = PropertyGraph(spark)
    return g.with_nodes(model, spark.createDataFrame([], "node_id string, " + columns))


def test_create_or_update(spark):
    g = empty(spark, Account, "email string, age long")
    g = W.create_or_update(
        g,
        Account,
        [
            {"email": "merge1", "age": 11},
            {"email": "merge2"},
            {"email": "merge3", "age": 1},
            {"email": "merge2", "age": 2},
        ],
    ).require_clean()
    assert rows(g, Account, "email", "age") == {("merge1", 11), ("merge2", 2), ("merge3", 1)}
    before = rows(g, Account, "id", "email")
    g = W.create_or_update(
        g, Account, [{"email": "merge1", "age": 22}, {"email": "merge4", "age": None}]
    ).graph
    assert rows(g, Account, "email", "age") >= {("merge1", 22), ("merge4", None), ("merge2", 2)}
    assert before <= rows(g, Account, "id", "email")
    bad = W.get_or_create(g, Account, [{"email": None, "age": 1}])
    assert bad.rejected.count() == 1
    with pytest.raises(ConstraintViolation):
        bad.require_clean()


def test_create_checks_the_whole_batch(spark):
    g = empty(spark, Account, "email string, age long")
    g = W.create_checked(g, Account, [{"email": "jim6", "age": 3}], new_id="email")
    with pytest.raises(UniqueProperty):
        W.create_checked(
            g, Account, [{"email": "jim6", "age": 3}, {"email": "jim7", "age": 5}], new_id="email"
        )
    with pytest.raises(RequiredProperty):
        W.create_checked(g, Account, [{"age": 5}], new_id="'x'")
    assert not g.nodes(Account).filter(email="jim7")
    with pytest.raises(ValueError):
        W.create(g, Account, [{"email": "a"}])
    with pytest.raises(ValueError):
        W.create(g, Account, [{"mail": "a"}], new_id="'x'")


def test_defaults_and_given_values(spark):
    g = empty(spark, WithDefault, "name string, age long, other_prop string")
    g = W.get_or_create(g, WithDefault, [{"name": "Tania", "age": 20}]).graph
    for batch in ([{"name": "Tania"}], [{"name": "Tania", "age": 30}]):
        g = W.get_or_create(g, WithDefault, batch).graph
        assert rows(g, WithDefault, "name", "age") == {("Tania", 20)}
    g = W.create_or_update(g, WithDefault, [{"name": "Tania", "other_prop": "other"}]).graph
    assert rows(g, WithDefault, "age", "other_prop") == {(20, "other")}
    g = W.create_or_update(g, WithDefault, [{"name": "Tania", "age": 30}, {"name": "New"}]).graph
    assert rows(g, WithDefault, "name", "age") == {("Tania", 30), ("New", 30)}


def test_merge_by(spark):
    g = empty(spark, Keyed, "name string, email string, age long")
    g = W.create(g, Keyed, [{"name": "Jane", "email": "jane", "age": 25}], new_id="'j'")
    other = [{"name": "Jane Doe", "email": "jane", "age": 26}]
    same = W.get_or_create(g, Keyed, other, merge_by={"keys": ["email"], "label": "Keyed"}).graph
    assert rows(same, Keyed, "id", "name", "age") == {("j", "Jane", 25)}
    for by in ({"keys": ["email"]}, {"keys": ["email"], "label": "Keyed"}):
        new = W.create_or_update(g, Keyed, other, merge_by=by).graph
        assert rows(new, Keyed, "id", "name", "age") == {("j", "Jane Doe", 26)}
    assert len(W.create_or_update(g, Keyed, other).graph.nodes(Keyed)) == 2


def boats(spark):
    g = empty(spark, Boat, "name string")
    people = spark.createDataFrame([("b", "Bob"), ("t", "Tim")], "node_id string, name string")
    g = g.with_nodes(Skipper, people)
    none = spark.createDataFrame(
        [], "edge_id string, src_id string, dst_id string, since timestamp, notes string"
    )
    return g.with_edges("SAILS", none, src=Boat, dst=Skipper, model=Crossing)


def test_merge_under_a_source(spark):
    g = boats(spark)
    for skipper in ("b", "t", "b"):
        g = W.merge_under(g, Skipper, "boats", [{"name": "Gizmo"}], source_id=skipper).graph
    assert len(g.nodes(Boat)) == 2  # not the same gizmo, but Bob's is found again
    found = g.nodes(Skipper).traverse("boats").values("name", "boats__name").collect()
    assert sorted(map(tuple, found)) == [("Bob", "Gizmo"), ("Tim", "Gizmo")]


def test_merge_under_with_edge_properties(spark):
    g = boats(spark)
    first = {"since": datetime(2019, 3, 10), "notes": "First adoption"}
    for props in (first, first, {**first, "notes": "Updated note"}):
        g = W.merge_under(
            g, Skipper, "boats", [{"name": "Spot"}], source_id="b", rel_props=props, update=True
        ).graph
    found = g.nodes(Skipper).traverse("boats").values("boats__id", "boats|notes").collect()
    assert len({r[0] for r in found}) == 2
    assert {r[1] for r in found} == {"First adoption", "Updated note"}


def harbours(spark):
    g = PropertyGraph(spark)
    nodes = [(i, n) for i, n in enumerate("abcd")]
    g = g.with_nodes(Harbour, spark.createDataFrame(nodes, "node_id long, name string"))
    ends = "edge_id string, src_id long, dst_id long"
    for kind, more in (("TWIN OF", ""), ("RIVAL OF", ", since long, reason string"), ("PILOTED BY", "")):
        g = g.with_edges(
            kind, spark.createDataFrame([], ends + more), src=Harbour, dst=Harbour,
            model=Rivalry if more else None,
        )
    return g


def pair_frame(spark, rows, more=""):
    return spark.createDataFrame(rows, "near_id long, far_id long" + more)


def edge_set(g, kind, *columns):
    return sorted(map(tuple, g.edge_frame(kind).select(*columns).collect()))


def test_connect_in_either_direction_twice(spark):
    g = E.connect(harbours(spark), Harbour, "twins", pair_frame(spark, [(0, 1)]))
    g = E.connect(g, Harbour, "twins", pair_frame(spark, [(1, 0), (0, 1)]))
    assert edge_set(g, "TWIN OF", "src_id", "dst_id") == [(0, 1)]
    assert len(g.nodes(Harbour).traverse("twins")) == 2


def test_parallel_edges_by_property(spark):
    more = ", since long, reason string"
    g = E.connect(harbours(spark), Harbour, "rivals", pair_frame(spark, [(0, 1, 1, "a")], more))
    g = E.connect(
        g, Harbour, "rivals", pair_frame(spark, [(0, 1, 1, "a"), (0, 1, 1, "b")], more)
    )
    assert edge_set(g, "RIVAL OF", "since", "reason") == [(1, "a"), (1, "b")]
    # a null property is not compared: both edges match and lose it
    g = E.connect(g, Harbour, "rivals", pair_frame(spark, [(0, 1, 1, None)], more))
    assert edge_set(g, "RIVAL OF", "since", "reason") == [(1, None), (1, None)]


def test_disconnect_replace_reconnect(spark):
    g = E.connect(harbours(spark), Harbour, "twins", pair_frame(spark, [(0, 1), (0, 2), (3, 1)]))
    gone = E.disconnect(g, Harbour, "twins", pair_frame(spark, [(1, 0)]))
    assert edge_set(gone, "TWIN OF", "src_id", "dst_id") == [(0, 2), (3, 1)]
    ids = spark.createDataFrame([(1,)], "node_id long")
    gone = E.disconnect_all(g, Harbour, "twins", ids)
    assert edge_set(gone, "TWIN OF", "src_id", "dst_id") == [(0, 2)]
    new = E.replace_edges(g, Harbour, "twins", pair_frame(spark, [(0, 3)]))
    assert edge_set(new, "TWIN OF", "src_id", "dst_id") == [(0, 3), (3, 1)]
    more = ", since long, reason string"
    h = E.connect(g, Harbour, "rivals", pair_frame(spark, [(0, 1, 5, "x"), (0, 2, 6, "y")], more))
    moves = spark.createDataFrame([(0, 1, 3), (0, 2, 2)], "near_id long, old_id long, new_id long")
    moved = E.reconnect_checked(h, Harbour, "rivals", moves)
    assert edge_set(moved, "RIVAL OF", "dst_id", "since", "reason") == [(2, 6, "y"), (3, 5, "x")]
    onto = spark.createDataFrame([(0, 1, 2)], "near_id long, old_id long, new_id long")
    merged = E.reconnect(h, Harbour, "rivals", onto)
    assert edge_set(merged, "RIVAL OF", "dst_id", "since", "reason") == [(2, 5, "x")]
    wrong = spark.createDataFrame([(3, 1, 2)], "near_id long, old_id long, new_id long")
    with pytest.raises(NotConnected):
        E.reconnect_checked(h, Harbour, "rivals", wrong)


def test_delete_and_clear(spark):
    g = E.connect(harbours(spark), Harbour, "twins", pair_frame(spark, [(0, 1), (0, 2), (3, 1)]))
    g = W.delete(g, Harbour, spark.createDataFrame([(1,)], "node_id long"))
    assert len(g.nodes(Harbour)) == 3
    assert edge_set(g, "TWIN OF", "src_id", "dst_id") == [(0, 2)]
    none = W.clear(g)
    assert len(none.nodes(Harbour)) == 0 and none.edge_frame("TWIN OF").count() == 0


def test_cardinality_rules(spark):
    g = E.connect(harbours(spark), Harbour, "pilot", pair_frame(spark, [(0, 1), (2, 1)]))
    assert C.cardinality(g, Harbour, "pilot").count() == 0
    assert C.connect_gate(g, Harbour, "pilot", pair_frame(spark, [(0, 2), (1, 2)])).count() == 1
    twice = E.connect(g, Harbour, "pilot", pair_frame(spark, [(0, 2)]))
    with pytest.raises(CardinalityViolation):
        C.enforce(C.cardinality(twice, Harbour, "pilot"))
    assert C.enforce(C.cardinality(twice, Harbour, "pilot"), "report").count() == 1
    assert C.cardinality(g, Harbour, "pilot", OneOrMore).count() == 2
    assert C.cardinality(twice, Harbour, "pilot", One).count() == 3
    last = C.disconnect_gate(g, Harbour, "pilot", pair_frame(spark, [(0, 1)]), OneOrMore)
    assert [r.item for r in last.collect()] == ["0"]
    two = C.disconnect_gate(twice, Harbour, "pilot", pair_frame(spark, [(0, 1)]), OneOrMore)
    assert two.count() == 0


def test_endpoints_and_unique(spark):
    g = harbours(spark)
    lost = spark.createDataFrame(
        [("x", 0, 9)], "edge_id string, src_id long, dst_id long"
    )
    g = g.with_edges("PILOTED BY", lost, src=Harbour, dst=Harbour)
    assert [r.item for r in C.endpoints(g, "PILOTED BY").collect()] == ["9"]
    g = g.with_nodes(
        Harbour, spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "node_id long, name string")
    )
    assert [(r.item, r.n) for r in C.unique(g, Harbour).collect()] == [("a", 2)]


def test_checked_connect_and_disconnect(spark):
    g = E.connect_checked(harbours(spark), Harbour, "pilot", pair_frame(spark, [(0, 1)]))
    for wrong, rule in (((0, 2), "ZeroOrOne"), ((2, 1), "ZeroOrOne"), ((2, 9), "endpoint")):
        pairs = pair_frame(spark, [wrong])
        assert [r.rule for r in C.connect_gates(g, Harbour, "pilot", pairs).collect()] == [rule]
        with pytest.raises((CardinalityViolation, ConstraintViolation)):
            E.connect_checked(g, Harbour, "pilot", pairs)
    soft = E.connect_checked(g, Harbour, "pilot", pair_frame(spark, [(0, 2)]), mode="report")
    assert edge_set(soft, "PILOTED BY", "src_id", "dst_id") == [(0, 1), (0, 2)]
    gone = E.disconnect_checked(g, Harbour, "pilot", pair_frame(spark, [(0, 1)]))
    assert edge_set(gone, "PILOTED BY", "src_id", "dst_id") == []
