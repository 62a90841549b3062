"""Batch writes through a store of versions: the rows must be those of the plain writes."""

from uuid import uuid4

from pyspark.sql import functions as F

from ..operators.delta import GraphStore
from ..sources.session import shared_folder
from . import changes as C
from .registry import ORACLES, query
from .tables import Customer, Nation, Order, Part, Supplier, load, table


def stored(g, **options) -> GraphStore:
    at = f"{shared_folder(g.spark)}/store-{uuid4().hex}"
    return GraphStore.create(g, at, **{"buckets": 16, **options})


@query("W2_store_get_or_create", ORACLES["W2_get_or_create"])
def get_or_create(spark, folder):
    """The keys' buckets tell which members exist; the nameless rows come back."""
    nameless = table(spark, folder, "supplier").selectExpr(
        "cast(null as string) as name", "s_acctbal as balance", "'NAMELESS' as segment",
        "4000000000 + s_suppkey as pos",
    )
    batch = C.member_batch(spark, folder).unionByName(nameless)
    done = stored(C.members(spark, folder)).get_or_create(
        C.Member, batch, position="pos", new_id=C.NEW_ID
    )
    back = done.rejected.selectExpr(
        "cast(null as bigint) as id", "name", "balance", "segment", "cast(null as bigint) as rating"
    )
    return C.member_rows(done.store.graph()).unionByName(back)


@query("W3_store_create_or_update", ORACLES["W3_create_or_update"])
def create_or_update(spark, folder):
    """In three batches, each a version on the one before, and compacted in between."""
    store, batch = stored(C.members(spark, folder)), C.member_batch(spark, folder)
    for part in ("pos < 2000000000", "pos between 2000000000 and 2999999999", "pos >= 3000000000"):
        done = store.create_or_update(C.Member, batch.where(part), position="pos", new_id=C.NEW_ID)
        store = done.store.compact(2)
    return C.member_rows(store.graph())


@query("W5_store_merge_under_update", ORACLES["W5_merge_under_update"])
def merge_under_update(spark, folder):
    done = stored(load(spark, folder, Customer, Order)).merge_under(
        Customer, "orders", C.urgent_batch(spark, folder).drop("since"), update=True,
        keys=["status", "priority"], position="pos", new_id=C.NEW_ORDER, new_edge_id=C.NEW_ORDER,
    )
    return done.store.graph().nodes(Order).values("id", "totalprice")


@query("W7_store_connect", ORACLES["W7_connect"])
def connect(spark, folder):
    g = load(spark, folder, Supplier, Part)
    old = C.supplied(g).selectExpr("supplier as near_id", "part as far_id", "quantity", "shipdate")
    new = old.selectExpr(
        "near_id", "far_id", "0.0D as quantity", "timestamp_ntz '2003-01-01' as shipdate"
    )
    done = stored(g).connect(Supplier, "parts", old.unionByName(new))
    return C.supplied(done.store.graph())


@query("W10_store_replace", ORACLES["W10_replace"])
def replace(spark, folder):
    g = load(spark, folder, Customer, Nation)
    pairs = C.pairs_of(g).selectExpr("near_id", "0 as far_id")
    return C.homes(stored(g).replace_edges(Customer, "nation", pairs).store.graph())


@query("W11_store_reconnect", ORACLES["W11_reconnect"])
def reconnect(spark, folder):
    g = load(spark, folder, Customer, Nation)
    moves = C.pairs_of(g).selectExpr(
        "near_id", "far_id as old_id", "cast((far_id + 1) % 25 as int) as new_id"
    )
    return C.homes(stored(g).reconnect(Customer, "nation", moves).store.graph())


@query("W12_store_delete", ORACLES["W12_delete"])
def delete(spark, folder):
    """Deleted nodes, and their edges of both types, found by source and by target."""
    g = load(spark, folder, Customer, Order, Nation)
    gone = g.nodes(Customer).filter(segment="BUILDING").values(node_id="id")
    g = stored(g).delete(Customer, gone).store.graph()
    frames = {
        "customers": g.node_frame(Customer),
        "placed": g.edge_frame("PLACED"),
        "orders": g.node_frame(Order),
        "homes": g.edge_frame("LIVES_IN"),
    }
    counted = [
        f.agg(F.count(F.lit(1)).alias("n")).select(F.lit(w).alias("what"), "n")
        for w, f in frames.items()
    ]
    whole = counted[0]
    for one in counted[1:]:
        whole = whole.unionByName(one)
    return whole


@query(
    "W7_store_small_batch",
    """SELECT 'rows' AS what, (SELECT count(*) FROM lineitem)
              + (SELECT count(*) FROM part WHERE p_partkey < 1000) AS n
       UNION ALL SELECT 'written rows', count(*) FROM part WHERE p_partkey < 1000
       UNION ALL SELECT 'buckets read', 1
       UNION ALL SELECT 'halves of the bytes read', 0
       UNION ALL SELECT 'tenths of the bytes written', 0""",
)
def small_batch(spark, folder):
    """New edges of one supplier to a thousand parts: one bucket of 64 is read, and a delta written."""
    g = load(spark, folder, Supplier, Part)
    pairs = g.node_frame(Part).where("node_id < 1000").selectExpr(
        "5L as near_id", "node_id as far_id", "0.5D as quantity",
        "timestamp_ntz '2004-01-01' as shipdate",
    )
    done = stored(g, buckets=64).connect(Supplier, "parts", pairs)
    (touched,) = done.touched
    facts = [
        ("written rows", touched.written_rows),
        ("buckets read", touched.buckets),
        ("halves of the bytes read", 2 * touched.read_bytes // touched.table_bytes),
        ("tenths of the bytes written", 10 * touched.written_bytes // touched.table_bytes),
    ]
    rows = done.store.graph().edge_frame("SUPPLIES").agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.lit("rows").alias("what"), "n").unionByName(
        spark.createDataFrame(facts, "what string, n long")
    )
