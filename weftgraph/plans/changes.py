"""Batch writes: each query returns the content of the resulting tables."""

from uuid import uuid4

from pyspark.sql import functions as F

from .. import FloatProperty, IntegerProperty, NodeModel, PropertyGraph, StringProperty
from ..operators import edges as E
from ..operators import writes as W
from ..sources.session import shared_folder
from ..sources.store import read_graph, write_graph
from .registry import query
from .tables import Customer, Event, Nation, Order, Part, Supplier, load, node_table, table


class Member(NodeModel):
    """Customers recognised by name, with a default rating."""

    name = StringProperty(required=True)
    balance = FloatProperty()
    segment = StringProperty()
    rating = IntegerProperty(default=5)


def members(spark, folder):
    rows = node_table(spark, folder, Customer).selectExpr(
        "node_id", "c_name as name", "c_acctbal as balance", "c_mktsegment as segment",
        "cast(null as bigint) as rating",
    )
    return PropertyGraph(spark).with_nodes(Member, rows)


def member_batch(spark, folder):
    """Suppliers as new members, rich customers again (twice), and the suppliers again."""
    new = table(spark, folder, "supplier").selectExpr(
        "s_name as name", "s_acctbal as balance", "cast(null as string) as segment",
        "s_suppkey as pos",
    )
    rich = table(spark, folder, "customer").where("c_acctbal > 5000")
    first = rich.selectExpr(
        "c_name as name", "c_acctbal + 1 as balance", "'FIRST' as segment",
        "1000000000 + c_custkey as pos",
    )
    second = rich.selectExpr(
        "c_name as name", "cast(null as double) as balance", "'SECOND' as segment",
        "2000000000 + c_custkey as pos",
    )
    again = new.selectExpr("name", "balance * 2 as balance", "'AGAIN' as segment",
                           "3000000000 + pos as pos")
    return new.unionByName(first).unionByName(second).unionByName(again)


# stable ids for new members, apart from the customer ids
NEW_ID = "1000000000000 + cast(substring_index(name, '#', -1) as bigint)"


def member_rows(g):
    return g.nodes(Member).values("id", "name", "balance", "segment", "rating")


NEW_MEMBERS = """SELECT 1000000000000 + s_suppkey AS id, s_name AS name, {balance} AS balance,
                        {segment} AS segment, CAST(5 AS BIGINT) AS rating FROM supplier"""


@query(
    "W1_create",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment,
              CAST(NULL AS BIGINT) AS rating FROM customer UNION ALL """
    + NEW_MEMBERS.format(balance="s_acctbal", segment="NULL"),
)
def create(spark, folder):
    batch = table(spark, folder, "supplier").selectExpr("s_name as name", "s_acctbal as balance")
    return member_rows(W.create(members(spark, folder), Member, batch, new_id=NEW_ID))


@query("S7_create_events", """SELECT event_id AS id, event_type FROM events
       UNION ALL SELECT event_id + 100000000, 'copy' FROM events WHERE value > 20""")
def create_events(spark, folder):
    g = load(spark, folder, Event)
    batch = g.node_frame(Event).where("value > 20").selectExpr(
        "node_id + 100000000 as node_id", "ts", "'copy' as event_type", "value"
    )
    return W.create(g, Event, batch).nodes(Event).values("id", "event_type")


OLD = """SELECT c_custkey AS id, c_name AS name, {balance} AS balance, {segment} AS segment,
                CAST(NULL AS BIGINT) AS rating FROM customer UNION ALL """


@query(
    "W2_get_or_create",
    OLD.format(balance="c_acctbal", segment="c_mktsegment")
    + NEW_MEMBERS.format(balance="s_acctbal", segment="NULL")
    + """ UNION ALL SELECT NULL, NULL, s_acctbal, 'NAMELESS', NULL FROM supplier""",
)
def get_or_create(spark, folder):
    """The members afterwards, and the rows that were handed back for lack of a key."""
    nameless = table(spark, folder, "supplier").selectExpr(
        "cast(null as string) as name", "s_acctbal as balance", "'NAMELESS' as segment",
        "4000000000 + s_suppkey as pos",
    )
    batch = member_batch(spark, folder).unionByName(nameless)
    done = W.get_or_create(members(spark, folder), Member, batch, position="pos", new_id=NEW_ID)
    back = done.rejected.selectExpr(
        "cast(null as bigint) as id", "name", "balance", "segment", "cast(null as bigint) as rating"
    )
    return member_rows(done.graph).unionByName(back)


@query(
    "W3_create_or_update",
    OLD.format(
        balance="CASE WHEN c_acctbal > 5000 THEN c_acctbal + 1 ELSE c_acctbal END",
        segment="CASE WHEN c_acctbal > 5000 THEN 'SECOND' ELSE c_mktsegment END",
    )
    + NEW_MEMBERS.format(balance="s_acctbal * 2", segment="'AGAIN'"),
)
def create_or_update(spark, folder):
    batch = member_batch(spark, folder)
    done = W.create_or_update(
        members(spark, folder), Member, batch, position="pos", new_id=NEW_ID
    )
    return member_rows(done.graph)


@query(
    "W4_merge_by",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, 'Member' AS labels
       FROM customer UNION ALL
       SELECT 1000000000000 + min(s_suppkey), min_by(s_name, s_suppkey),
              concat('NATION ', s_nationkey), 'Partner' FROM supplier GROUP BY s_nationkey""",
)
def merge_by(spark, folder):
    # merged by segment; created nodes carry only the given label
    batch = table(spark, folder, "supplier").selectExpr(
        "s_name as name", "concat('NATION ', s_nationkey) as segment", "s_suppkey as pos"
    )
    done = W.get_or_create(
        members(spark, folder), Member, batch, position="pos", new_id=NEW_ID,
        merge_by={"keys": ["segment"], "label": "Partner"},
    )
    rows = done.graph.stored(Member).selectExpr("node_id as id", "name", "segment", "labels")
    return rows.withColumn("labels", F.array_join("labels", ","))


def urgent_batch(spark, folder):
    return table(spark, folder, "customer").selectExpr(
        "c_custkey as source_id", "'F' as status", "'1-URGENT' as priority",
        "timestamp_ntz '2002-01-01' as since", "c_acctbal as totalprice", "c_custkey as pos",
    )


NEW_ORDER = "source_id + 1000000000000"


@query(
    "W5_merge_under_source",
    """SELECT o_orderkey AS id, o_custkey AS customer, o_totalprice AS totalprice FROM orders
       UNION ALL SELECT c_custkey + 1000000000000, c_custkey, c_acctbal FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
                         AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')""",
)
def merge_under_source(spark, folder):
    g = load(spark, folder, Customer, Order)
    done = W.merge_under(
        g, Customer, "orders", urgent_batch(spark, folder).drop("since"),
        keys=["status", "priority"], position="pos", new_id=NEW_ORDER, new_edge_id=NEW_ORDER,
    )
    found = done.graph.nodes(Order).traverse("customer")
    return found.values(id="id", customer="customer__id", totalprice="totalprice")


@query(
    "W5_merge_under_update",
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
              THEN c_acctbal ELSE o_totalprice END AS totalprice
       FROM orders JOIN customer ON c_custkey = o_custkey
       UNION ALL SELECT c_custkey + 1000000000000, c_acctbal FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
                         AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')""",
)
def merge_under_update(spark, folder):
    g = load(spark, folder, Customer, Order)
    done = W.merge_under(
        g, Customer, "orders", urgent_batch(spark, folder).drop("since"), update=True,
        keys=["status", "priority"], position="pos", new_id=NEW_ORDER, new_edge_id=NEW_ORDER,
    )
    return done.graph.nodes(Order).values("id", "totalprice")


@query(
    "W6_merge_edge_properties",
    """SELECT o_orderkey AS id, o_custkey AS customer, o_orderdate AS since FROM orders
       UNION ALL SELECT c_custkey + 1000000000000, c_custkey, TIMESTAMP '2002-01-01' FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F'
         AND o_orderpriority = '1-URGENT' AND o_orderdate = TIMESTAMP '2002-01-01')""",
)
def merge_edge_properties(spark, folder):
    g = load(spark, folder, Customer, Order)
    done = W.merge_under(
        g, Customer, "orders", urgent_batch(spark, folder), rel_props=["since"],
        keys=["status", "priority"], position="pos", new_id=NEW_ORDER, new_edge_id=NEW_ORDER,
    )
    found = done.graph.nodes(Customer).traverse("orders")
    return found.values(id="orders__id", customer="id", since="orders|since")


def supplied(g):
    return g.edge_frame("SUPPLIES").selectExpr(
        "src_id as supplier", "dst_id as part", "quantity", "shipdate"
    )


@query(
    "W7_connect",
    """SELECT l_suppkey AS supplier, l_partkey AS part, l_quantity AS quantity,
              l_shipdate AS shipdate FROM lineitem
       UNION ALL SELECT DISTINCT l_suppkey, l_partkey, 0.0::DOUBLE, TIMESTAMP '2003-01-01'
       FROM lineitem""",
)
def connect(spark, folder):
    g = load(spark, folder, Supplier, Part)
    old = supplied(g).selectExpr("supplier as near_id", "part as far_id", "quantity", "shipdate")
    # the edges that exist, and one parallel edge per pair, asked for many times
    new = old.selectExpr(
        "near_id", "far_id", "0.0D as quantity", "timestamp_ntz '2003-01-01' as shipdate"
    )
    return supplied(E.connect(g, Supplier, "parts", old.unionByName(new)))


def homes(g):
    return g.edge_frame("LIVES_IN").selectExpr("src_id as customer", "dst_id as nation")


def building(g):
    return g.nodes(Customer).filter(segment="BUILDING").traverse("nation")


def pairs_of(g):
    return building(g).values(near_id="id", far_id="nation__id")


@query(
    "W8_disconnect",
    """SELECT c_custkey AS customer, c_nationkey AS nation FROM customer
       WHERE c_mktsegment <> 'BUILDING'""",
)
def disconnect(spark, folder):
    g = load(spark, folder, Customer, Nation)
    return homes(E.disconnect(g, Customer, "nation", pairs_of(g)))


@query(
    "W9_disconnect_all",
    """SELECT c_custkey AS customer, c_nationkey AS nation FROM customer WHERE c_acctbal >= 0""",
)
def disconnect_all(spark, folder):
    g = load(spark, folder, Customer, Nation)
    ids = g.node_frame(Customer).where("acctbal < 0").select("node_id")
    return homes(E.disconnect_all(g, Customer, "nation", ids))


@query(
    "W10_replace",
    """SELECT c_custkey AS customer, CASE WHEN c_mktsegment = 'BUILDING' THEN 0
              ELSE c_nationkey END AS nation FROM customer""",
)
def replace(spark, folder):
    g = load(spark, folder, Customer, Nation)
    pairs = pairs_of(g).selectExpr("near_id", "0 as far_id")
    return homes(E.replace_edges(g, Customer, "nation", pairs))


@query(
    "W10_replace_written",
    """SELECT c_custkey AS customer, CASE WHEN c_mktsegment = 'BUILDING' THEN 0
              ELSE c_nationkey END AS nation FROM customer""",
)
def replace_written(spark, folder):
    """The same after writing the graph and reading it back."""
    g = load(spark, folder, Customer, Nation)
    pairs = pairs_of(g).selectExpr("near_id", "0 as far_id")
    at = f"{shared_folder(spark)}/graph-{uuid4().hex}"
    write_graph(E.replace_edges(g, Customer, "nation", pairs), at)
    return homes(read_graph(g, at))


@query(
    "W11_reconnect",
    """SELECT c_custkey AS customer, CASE WHEN c_mktsegment = 'BUILDING'
              THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS nation FROM customer""",
)
def reconnect(spark, folder):
    g = load(spark, folder, Customer, Nation)
    moves = pairs_of(g).selectExpr(
        "near_id", "far_id as old_id", "cast((far_id + 1) % 25 as int) as new_id"
    )
    return homes(E.reconnect(g, Customer, "nation", moves))


@query(
    "W11_reconnect_with_properties",
    """WITH moved AS (SELECT l_suppkey, max_by(l_quantity, (l_orderkey, l_partkey, l_suppkey,
                 l_linenumber, l_shipdate, l_extendedprice)) AS q
               FROM lineitem WHERE l_partkey = 0 GROUP BY l_suppkey)
       SELECT l.l_suppkey AS supplier, l_partkey AS part, CASE WHEN l_partkey = 1 AND q IS NOT NULL
              THEN q ELSE l_quantity END AS quantity
       FROM lineitem l LEFT JOIN moved m ON m.l_suppkey = l.l_suppkey WHERE l_partkey <> 0
       UNION ALL SELECT l_suppkey, 1, q FROM moved WHERE l_suppkey NOT IN
         (SELECT l_suppkey FROM lineitem WHERE l_partkey = 1)""",
)
def reconnect_with_properties(spark, folder):
    g = load(spark, folder, Supplier, Part)
    moves = g.node_frame(Supplier).selectExpr(
        "node_id as near_id", "0L as old_id", "1L as new_id"
    )
    return supplied(E.reconnect(g, Supplier, "parts", moves)).drop("shipdate")


@query(
    "W12_delete",
    """SELECT 'customers' AS what, count(*) AS n FROM customer WHERE c_mktsegment <> 'BUILDING'
       UNION ALL SELECT 'placed', count(*) FROM orders JOIN customer ON c_custkey = o_custkey
       WHERE c_mktsegment <> 'BUILDING' UNION ALL SELECT 'orders', count(*) FROM orders
       UNION ALL SELECT 'homes', count(*) FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def delete(spark, folder):
    g = load(spark, folder, Customer, Order, Nation)
    gone = g.nodes(Customer).filter(segment="BUILDING").values(node_id="id")
    g = W.delete(g, Customer, gone)
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
    "W13_save",
    """SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN upper(c_name) ELSE c_name END AS name,
              CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS acctbal,
              CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer""",
)
def save(spark, folder):
    g = load(spark, folder, Customer)
    batch = g.node_frame(Customer).where("acctbal < 0").selectExpr(
        "node_id", "upper(name) as name", "0.0D as acctbal"
    )
    return W.save(g, Customer, batch).nodes(Customer).values("id", "name", "acctbal", "segment")


@query(
    "W14_save_edges",
    """SELECT o_custkey AS customer, o_orderkey AS order_id, CASE WHEN o_orderstatus = 'F'
              THEN NULL ELSE o_orderdate END AS since FROM orders""",
)
def save_edges(spark, folder):
    g = load(spark, folder, Customer, Order)
    done = g.node_frame(Order).where("status = 'F'").selectExpr(
        "node_id as edge_id", "cast(null as timestamp_ntz) as since"
    )
    saved = E.save_edges(g, "PLACED", done).edge_frame("PLACED")
    return saved.selectExpr("src_id as customer", "dst_id as order_id", "since")


@query(
    "W15_refresh",
    """SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal > 9000
       UNION ALL SELECT c_custkey + 1000000000, NULL FROM customer WHERE c_acctbal > 9000""",
)
def refresh(spark, folder):
    g = load(spark, folder, Customer)
    ids = g.node_frame(Customer).where("acctbal > 9000").select("node_id")
    asked = ids.unionByName(ids.selectExpr("node_id + 1000000000 as node_id"))
    found, missing = W.refresh(g, Customer, asked)
    return found.selectExpr("node_id as id", "name").unionByName(
        missing.selectExpr("node_id as id", "cast(null as string) as name")
    )
