"""A store of versions against the plain writes, and what is seen of writes that failed."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from weftgraph import (
    IntegerProperty,
    NodeModel,
    PropertyGraph,
    RelationshipTo,
    RelModel,
    StringProperty,
    ZeroOrOne,
)
from weftgraph.errors import CardinalityViolation, ConstraintViolation, VersionConflict
from weftgraph.operators import edges as E
from weftgraph.operators import writes as W
from weftgraph.operators.delta import GraphStore, touched_frame


class Lent(RelModel):
    days = IntegerProperty()


class Shelf(NodeModel):
    code = StringProperty()


class Volume(NodeModel):
    title = StringProperty(unique_index=True)
    pages = IntegerProperty()
    shelf = RelationshipTo(Shelf, "STANDS_ON", cardinality=ZeroOrOne)
    lent = RelationshipTo(Shelf, "LENT_TO", model=Lent)


def library(spark, volumes=40):
    books = [(i, f"t{i}", i * 10) for i in range(volumes)]
    shelves = [(i, f"s{i}") for i in range(8)]
    lent = [(i, i % volumes, i % 8, i) for i in range(60)]
    g = PropertyGraph(spark)
    g = g.with_nodes(Volume, spark.createDataFrame(books, "node_id long, title string, pages long"))
    g = g.with_nodes(Shelf, spark.createDataFrame(shelves, "node_id long, code string"))
    g = g.with_edges(
        "LENT_TO", spark.createDataFrame(lent, "edge_id long, src_id long, dst_id long, days long"),
        src=Volume, dst=Shelf, model=Lent,
    )
    stands = spark.range(volumes).selectExpr("id as edge_id", "id as src_id", "id % 8 as dst_id")
    return g.with_edges("STANDS_ON", stands, src=Volume, dst=Shelf)


@pytest.fixture
def at():
    return tempfile.mkdtemp(prefix="weftgraph-store-") + "/store"


def content(g):
    return {
        "volumes": sorted(map(tuple, g.node_frame(Volume).select("node_id", "title", "pages").collect())),
        "shelves": sorted(map(tuple, g.node_frame(Shelf).select("node_id", "code").collect())),
        "lent": sorted(
            map(tuple, g.edge_frame("LENT_TO").select("src_id", "dst_id", "days").collect()), key=str
        ),
        "stands": sorted(map(tuple, g.edge_frame("STANDS_ON").select("src_id", "dst_id").collect())),
    }


def rows(spark, kind, data):
    return spark.createDataFrame(data, kind)


def some_write(spark, rng, turn):
    """A random batch: what to do with a store, and the same with a graph."""
    pick = lambda n, k: rng.sample(range(n), k)
    kind = rng.choice(["create", "upsert", "get", "save", "delete", "connect", "cut", "replace", "move"])
    if kind == "create":
        batch = rows(spark, "node_id long, title string, pages long",
                     [(1000 + 10 * turn + i, f"n{turn}-{i}", i) for i in range(3)])
        return (lambda s: s.create_nodes(Volume, batch)), lambda g: W.create(g, Volume, batch)
    if kind in ("upsert", "get"):
        batch = rows(spark, "title string, pages long, pos long",
                     [(f"t{i}", 7 * turn, i) for i in pick(50, 4)])
        options = dict(position="pos", new_id="2000 + crc32(cast(title as binary))")
        if kind == "get":
            return (
                lambda s: s.get_or_create(Volume, batch, **options),
                lambda g: W.get_or_create(g, Volume, batch, **options).graph,
            )
        return (
            lambda s: s.create_or_update(Volume, batch, **options),
            lambda g: W.create_or_update(g, Volume, batch, **options).graph,
        )
    if kind == "save":
        batch = rows(spark, "node_id long, title string, pages long",
                     [(i, f"t{i}x{turn}", turn) for i in pick(40, 3)])
        return (lambda s: s.save(Volume, batch)), lambda g: W.save(g, Volume, batch)
    if kind == "delete":
        model, n = rng.choice([(Volume, 40), (Shelf, 8)])
        ids = rows(spark, "node_id long", [(i,) for i in pick(n, 1)])
        return (lambda s: s.delete(model, ids)), lambda g: W.delete(g, model, ids)
    pairs = rows(spark, "near_id long, far_id long", [(i, rng.randrange(8)) for i in pick(40, 3)])
    if kind == "connect":
        pairs = pairs.withColumn("days", F.lit(100 + turn).cast("long"))
        return (
            lambda s: s.connect(Volume, "lent", pairs),
            lambda g: E.connect(g, Volume, "lent", pairs),
        )
    if kind == "cut":
        return (
            lambda s: s.disconnect(Volume, "lent", pairs),
            lambda g: E.disconnect(g, Volume, "lent", pairs),
        )
    if kind == "replace":
        return (
            lambda s: s.replace_edges(Volume, "shelf", pairs),
            lambda g: E.replace_edges(g, Volume, "shelf", pairs),
        )
    moves = pairs.selectExpr("near_id", "near_id % 8 as old_id", "far_id as new_id")
    return (
        lambda s: s.reconnect(Volume, "shelf", moves),
        lambda g: E.reconnect(g, Volume, "shelf", moves),
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_of_writes_are_those_of_the_plain_operators(spark, at, seed):
    rng = random.Random(seed)
    g = library(spark)
    store = GraphStore.create(g, at, buckets=7)
    assert content(store.graph()) == content(g)
    past = [content(g)]
    for turn in range(1, 5):
        on_store, on_graph = some_write(spark, rng, turn)
        store = on_store(store).store
        g = PropertyGraph(spark, g.tables, g.edges)
        g = on_graph(g)
        past.append(content(g))
        assert content(store.graph()) == past[-1]
        if turn == 3:
            store = store.compact(1)
            assert content(store.graph()) == past[-1]
            assert all(s.base for t in store.manifest.tables.values() for s in t.segments)
    # every version can still be read
    again = [GraphStore.open(g, at, v).manifest.version for v in range(1, store.manifest.version)]
    assert again == list(range(1, store.manifest.version))
    assert content(GraphStore.open(library(spark), at, 1).graph()) == past[0]
    assert content(GraphStore.open(library(spark), at, 3).graph()) == past[2]


def test_a_batch_reads_and_writes_its_buckets_only(spark, at):
    store = GraphStore.create(library(spark, 400), at, buckets=32)
    batch = rows(spark, "title string, pages long, pos long", [("t5", 1, 1), ("t6", 2, 2), ("new", 3, 3)])
    done = store.create_or_update(Volume, batch, position="pos", new_id="crc32(cast(title as binary))")
    (touched,) = done.touched
    assert touched.buckets <= 2 and touched.written_rows == 3
    assert touched.read_bytes < touched.table_bytes / 8
    segment = done.store.manifest.tables["nodes/Volume"].segments[-1]
    assert len(segment.buckets) <= 3
    # the second time nothing differs
    again = done.store.create_or_update(Volume, batch, position="pos", new_id="crc32(cast(title as binary))")
    assert again.touched[0].written_rows == 0
    assert touched_frame(done).first()["written_rows"] == 3
    # edges are found by their source or by their target, and in the end nodes with them
    gone = again.store.delete(Volume, rows(spark, "node_id long", [(5,), (6,)]))
    by = {t.table: t for t in gone.touched}
    assert by["nodes/Volume"].buckets <= 2 and by["edges/LENT_TO"].buckets <= 2
    part = gone.store.folder.read(gone.store.manifest.tables["nodes/Volume"], {0})
    assert "PartitionFilters: [isnotnull(~bucket" in part._jdf.queryExecution().toString()


def test_keys_that_change_are_found_by_the_new_key_alone(spark, at):
    store = GraphStore.create(library(spark), at, buckets=5)
    renamed = rows(spark, "node_id long, title string, pages long", [(3, "other", 1)])
    store = store.save(Volume, renamed).store
    batch = rows(spark, "title string, pages long, pos long", [("t3", 9, 1), ("other", 8, 2)])
    store = store.create_or_update(Volume, batch, position="pos", new_id="900 + length(title)").store
    found = {r.title: (r.node_id, r.pages) for r in store.graph().node_frame(Volume).collect()}
    assert found["other"] == (3, 8) and found["t3"] == (902, 9) and len(found) == 41


def test_what_failed_is_not_seen(spark, at, monkeypatch):
    g = library(spark)
    store = GraphStore.create(g, at, buckets=4)
    before = content(store.graph())
    batch = rows(spark, "node_id long, title string, pages long", [(1, "x", 1)])

    def broken(manifest):
        raise OSError("the driver was lost")

    monkeypatch.setattr(store.folder, "publish", broken)
    with pytest.raises(OSError):
        store.save(Volume, batch)
    monkeypatch.undo()
    assert GraphStore.open(g, at).manifest.version == 1
    assert content(GraphStore.open(g, at).graph()) == before
    # of two writers on one version the second fails, and what it wrote is not seen
    first, second = GraphStore.open(g, at), GraphStore.open(g, at)
    one = first.save(Volume, batch).store
    with pytest.raises(VersionConflict):
        second.save(Volume, rows(spark, "node_id long, title string, pages long", [(2, "y", 2)]))
    assert content(GraphStore.open(g, at).graph()) == content(one.graph())
    titles = {r.title for r in one.graph().node_frame(Volume).collect()}
    assert "x" in titles and "y" not in titles
    with pytest.raises(FileNotFoundError):
        GraphStore.open(g, at, 9)


def test_ids_that_would_be_there_twice_are_refused(spark, at):
    store = GraphStore.create(library(spark), at, buckets=4)
    twice = rows(spark, "node_id long, title string", [(77, "a"), (77, "b")])
    with pytest.raises(ConstraintViolation):
        store.create_nodes(Volume, twice)
    assert GraphStore.open(library(spark), at).manifest.version == 1


def test_gates_see_the_edges_of_both_ends(spark, at):
    store = GraphStore.create(library(spark), at, buckets=6)
    pairs = rows(spark, "near_id long, far_id long", [(3, 7)])
    with pytest.raises(CardinalityViolation):
        store.connect(Volume, "shelf", pairs, checked=True)
    cut = store.disconnect_all(Volume, "shelf", rows(spark, "node_id long", [(3,)])).store
    done = cut.connect(Volume, "shelf", pairs, checked=True).store
    assert (3, 7) in content(done.graph())["stands"]


def test_empty_graphs_and_empty_batches(spark, at):
    g = library(spark)
    empty = W.clear(g)
    store = GraphStore.create(empty, at, buckets=4)
    assert content(store.graph()) == content(empty)
    none = rows(spark, "node_id long, title string, pages long", [(1, "a", 1)]).limit(0)
    store = store.save(Volume, none).store.delete(Volume, none.select("node_id")).store
    one = rows(spark, "node_id long, title string, pages long", [(1, None, 1)])
    store = store.create_nodes(Volume, one).store
    assert content(store.graph())["volumes"] == [(1, None, 1)]
    ids = rows(spark, "edge_id string, days long, src_id long", [("0", 5, 0)])
    assert store.save_edges("LENT_TO", ids).touched[0].written_rows == 0


def test_new_edges_alone_travel_and_are_read_without_a_merge(spark, at):
    store = GraphStore.create(library(spark), at, buckets=4)
    pairs = rows(spark, "near_id long, far_id long, days long", [(3, 3, 3), (3, 4, 9), (3, 4, 9)])
    done = store.connect(Volume, "lent", pairs)
    (touched,) = done.touched
    assert touched.written_rows == 1
    for name in ("edges/LENT_TO", "edges/LENT_TO/by target"):
        last = done.store.manifest.tables[name].segments[-1]
        assert last.fresh and not last.base
    found = done.store.graph().edge_frame("LENT_TO")
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert content(done.store.graph()) == content(E.connect(library(spark), Volume, "lent", pairs))


def test_an_edge_that_was_cut_is_there_again_once(spark, at):
    store = GraphStore.create(library(spark), at, buckets=4)
    pairs = rows(spark, "near_id long, far_id long, days long", [(3, 4, 9), (5, 6, 9)])
    before = content(store.graph())
    for _ in range(2):
        store = store.connect(Volume, "lent", pairs).store
        joined = content(store.graph())
        assert sorted(joined["lent"]) == sorted([*before["lent"], (3, 4, 9), (5, 6, 9)])
        assert content(GraphStore.open(library(spark), at).graph()) == joined
        store = store.disconnect(Volume, "lent", pairs.drop("days")).store
        assert content(store.graph()) == before
    store = store.connect(Volume, "lent", pairs).store.compact(1)
    assert content(store.graph()) == joined
    ends = store.folder.read(store.manifest.tables["edges/LENT_TO/by target"])
    assert ends.count() == len(joined["lent"])


def test_an_edge_with_the_id_of_a_new_one_does_not_double_the_id(spark, at):
    store = GraphStore.create(library(spark), at, buckets=4)
    pair = rows(spark, "near_id long, far_id long, days long", [(3, 4, 9)])
    store = store.connect(Volume, "lent", pair).store
    edge = store.graph().edge_frame("LENT_TO").where("src_id = 3 and dst_id = 4 and days = 9")
    store = store.save_edges("LENT_TO", edge.selectExpr("edge_id", "src_id", "10L as days")).store
    store = store.connect(Volume, "lent", pair).store
    frame = store.graph().edge_frame("LENT_TO")
    assert frame.count() == frame.select("edge_id").distinct().count() == 61
