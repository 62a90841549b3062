"""Traversals: hops, paths, existence, sub-queries and reachability."""

from pyspark.sql import functions as F

from .. import (
    Collect,
    Last,
    NodeModel,
    NodeNameResolver,
    Path,
    PropertyGraph,
    RelationshipTo,
    Size,
    StringProperty,
)
from ..operators.paths import (
    connected,
    endpoints,
    first_relationship,
    node_pairs,
    path_values,
    reachable,
    repeated,
)
from ..operators.theta import theta_join
from ..sources.session import tune
from .registry import query
from .tables import (
    Customer,
    Document,
    Label,
    Line,
    Nation,
    Order,
    Part,
    Region,
    Supplier,
    Turn,
    lines,
    load,
    node_table,
    with_stored,
)

NEXT = """(SELECT concat(a.conv_id, ':', a.turn) AS src, concat(b.conv_id, ':', b.turn) AS dst
           FROM conversations a JOIN conversations b
             ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""


@query(
    "J1_outgoing",
    """SELECT c_custkey AS id, o_orderkey AS order_id, o_orderdate AS since
       FROM customer JOIN orders ON o_custkey = c_custkey""",
)
def outgoing(spark, folder):
    g = load(spark, folder, Customer, Order)
    found = g.nodes(Customer).traverse("orders")
    return found.values(id="id", order_id="orders__id", since="orders|since")


@query(
    "J2_incoming",
    """SELECT p_partkey AS id, s_name AS supplier, l_quantity AS quantity
       FROM part JOIN lineitem ON l_partkey = p_partkey JOIN supplier ON s_suppkey = l_suppkey""",
)
def incoming(spark, folder):
    g = load(spark, folder, Part, Supplier)
    found = g.nodes(Part).traverse("suppliers")
    return found.values(id="id", supplier="suppliers__name", quantity="suppliers|quantity")


@query(
    "J3_either_direction",
    f"SELECT src AS id, dst AS neighbour FROM {NEXT} UNION ALL SELECT dst, src FROM {NEXT}",
)
def either_direction(spark, folder):
    found = load(spark, folder, Turn).nodes(Turn).traverse("near")
    return found.values(id="id", neighbour="near__id")


@query(
    "J4_untyped",
    """SELECT rel_type, count(*) AS n, CAST(sum(price) AS DOUBLE) AS total FROM (
         SELECT 'PLACED' AS rel_type, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders
         UNION ALL SELECT 'URGENT', CAST(o_totalprice AS DECIMAL(18,2)) FROM orders
         WHERE o_orderpriority = '1-URGENT') GROUP BY rel_type""",
)
def untyped(spark, folder):
    g = load(spark, folder, Customer, Order)
    urgent = g.tables["Order"][1].where("o_orderpriority = '1-URGENT'").selectExpr(
        "node_id as edge_id", "o_custkey as src_id", "node_id as dst_id"
    )
    g = g.with_edges("URGENT", urgent, src=Customer, dst=Order, verified=True)
    found = g.nodes(Customer).traverse("any_order")
    rows = found.values(rel_type="any_order|rel_type", price="any_order__totalprice")
    return rows.groupBy("rel_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("total"),
    )


@query(
    "J5_multi_hop",
    """SELECT c_custkey AS id, o_orderkey AS order_id, p_name AS part, l_quantity AS quantity,
              r_name AS region
       FROM customer JOIN orders ON o_custkey = c_custkey
       JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
       JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
)
def multi_hop(spark, folder):
    g = load(spark, folder, Customer, Order, Part, Nation, Region)
    found = g.nodes(Customer).traverse("orders__parts", "nation__region")
    return found.values(
        id="id", order_id="orders__id", part="orders__parts__name",
        quantity="orders__parts|quantity", region="nation__region__name",
    )


@query(
    "J6_several_paths",
    """SELECT c_custkey AS id, n_name AS nation, o_orderkey AS order_id
       FROM customer JOIN nation ON n_nationkey = c_nationkey
       JOIN orders ON o_custkey = c_custkey""",
)
def several_paths(spark, folder):
    g = load(spark, folder, Customer, Nation, Order)
    # the second call replaces the first
    found = g.nodes(Customer).traverse("nation__customers").traverse("nation", "orders")
    return found.values(id="id", nation="nation__name", order_id="orders__id")


@query(
    "J7_optional_path",
    """SELECT c_custkey AS id, o_orderkey AS order_id, p_partkey AS part
       FROM customer LEFT JOIN (
         SELECT * FROM orders JOIN lineitem ON l_orderkey = o_orderkey
         JOIN part ON p_partkey = l_partkey WHERE p_size = 1) ON o_custkey = c_custkey""",
)
def optional_path(spark, folder):
    g = load(spark, folder, Customer, Order, Part)
    found = g.nodes(Customer).traverse(Path("orders__parts", optional=True))
    found = found.filter(orders__parts__size=1)
    return found.values(id="id", order_id="orders__id", part="orders__parts__id")


@query(
    "J7_optional_label",
    """SELECT d.doc_id AS id, quality, toxic FROM documents d LEFT JOIN labels l
       ON l.doc_id = d.doc_id""",
)
def optional_label(spark, folder):
    g = load(spark, folder, Document, Label)
    found = g.nodes(Document).traverse(Path("label", optional=True))
    return found.values(id="id", quality="label__quality", toxic="label__toxic")


@query(
    "J8_shared_prefix",
    "SELECT c_custkey AS id, n_name AS nation FROM customer JOIN nation ON n_nationkey = c_nationkey",
)
def shared_prefix(spark, folder):
    g = load(spark, folder, Customer, Nation)
    found = g.nodes(Customer).traverse("nation", "nation").filter(nation__name__ne="x")
    return found.values(id="id", nation="nation__name")


@query(
    "J9_fresh_prefix",
    """SELECT CAST(sum(a.n * b.n) AS BIGINT) AS n FROM (
         SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT'
         GROUP BY o_custkey) a
       JOIN (SELECT o_custkey, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey
             GROUP BY o_custkey) b ON a.o_custkey = b.o_custkey""",
)
def fresh_prefix(spark, folder):
    g = load(spark, folder, Customer, Order, Part)
    found = g.nodes(Customer).traverse("orders", "orders__parts")
    return found.filter(orders__priority="1-URGENT").count_df()


@query(
    "J10_unique_variables",
    """SELECT c_custkey AS id, o_orderkey AS order_id, l_partkey AS part
       FROM customer JOIN orders ON o_custkey = c_custkey
       JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT'""",
)
def unique_variables(spark, folder):
    g = load(spark, folder, Customer, Order, Part)
    found = g.nodes(Customer).traverse("orders", "orders__parts").unique_variables("orders")
    found = found.filter(orders__priority="1-URGENT")
    return found.values(id="id", order_id="orders__id", part="orders__parts__id")


@query(
    "J11_has",
    "SELECT doc_id AS id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def has(spark, folder):
    return load(spark, folder, Document, Label).nodes(Document).has(label=True).ids()


@query(
    "J12_has_not",
    """SELECT o_orderkey AS id, o_totalprice AS totalprice FROM orders
       WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def has_not(spark, folder):
    found = load(spark, folder, Order, Part).nodes(Order).has(parts=False)
    return found.values("id", "totalprice")


@query(
    "J13_chained_traversal",
    """SELECT p_partkey AS id, p_name AS name
       FROM customer JOIN orders ON o_custkey = c_custkey
       JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
       WHERE c_acctbal > 9000 AND o_orderstatus = 'F'""",
)
def chained_traversal(spark, folder):
    g = load(spark, folder, Customer, Order, Part)
    rich = g.nodes(Customer).filter(acctbal__gt=9000)
    return rich.orders.filter(status="F").parts.nodes().values("id", "name")


@query(
    "J14_relationship_manager",
    """SELECT c_custkey AS customer, first.o_orderkey AS first_order, cheap
       FROM customer
       JOIN (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey
               ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) first
         ON first.o_custkey = c_custkey AND rn = 1
       LEFT JOIN (SELECT o_custkey, count(*) AS cheap FROM orders
             WHERE o_totalprice < 100000 AND NOT (o_orderstatus = 'F') GROUP BY o_custkey) k
         ON k.o_custkey = c_custkey
       WHERE c_mktsegment = 'BUILDING'""",
)
def relationship_manager(spark, folder):
    g = load(spark, folder, Customer, Order)
    orders = g.nodes(Customer).filter(segment="BUILDING").orders
    first = orders.first_per_source("orderdate").selectExpr(
        "source_id as customer", "order.node_id as first_order"
    )
    cheap = orders.nodes(keep_source=True).filter(totalprice__lt=100000).exclude(status="F")
    counted = cheap.values(customer="source_id").groupBy("customer").agg(
        F.count(F.lit(1)).alias("cheap")
    )
    return first.join(counted, "customer", "left")


@query(
    "J15_is_connected",
    """SELECT near_id, far_id, EXISTS (SELECT 1 FROM orders WHERE o_custkey = near_id
                                       AND o_orderkey = far_id) AS connected
       FROM (SELECT o_custkey AS near_id, o_orderkey AS far_id FROM orders
             UNION ALL SELECT o_custkey, o_orderkey + 1 FROM orders)""",
)
def is_connected(spark, folder):
    g = load(spark, folder, Customer, Order)
    real = g.edge_frame("PLACED").selectExpr("src_id as near_id", "dst_id as far_id")
    asked = real.unionByName(real.selectExpr("near_id", "far_id + 1 as far_id"))
    return connected(g, Customer, "orders", asked)


@query(
    "J16_edges_between",
    """SELECT supplier, part, n, quantity FROM (
         SELECT l_suppkey AS supplier, l_partkey AS part, l_quantity AS quantity,
           count(*) OVER (PARTITION BY l_suppkey, l_partkey) AS n,
           row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_orderkey, l_linenumber,
                              l_shipdate, l_extendedprice) AS rn FROM lineitem)
       WHERE rn = 1""",
)
def edges_between(spark, folder):
    g = load(spark, folder, Supplier, Part)
    found = first_relationship(g, Supplier, "parts")
    return found.selectExpr(
        "near_id as supplier", "far_id as part", "n", "edge.quantity as quantity"
    )


@query(
    "J17_endpoints",
    """SELECT l_orderkey AS order_id, l_quantity AS quantity, o_totalprice AS totalprice,
              p_name AS part
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey""",
)
def edge_endpoints(spark, folder):
    found = endpoints(load(spark, folder, Order, Part), "CONTAINS")
    return found.selectExpr(
        "src_id as order_id", "quantity", "start_node.totalprice as totalprice",
        "end_node.name as part",
    )


@query(
    "J18_path_value",
    """SELECT c_custkey AS id, CAST(2 AS BIGINT) AS length, c_name AS start_name, r_name AS end_name,
              concat('Customer=', c_name, ',Nation=', n_name, ',Region=', r_name) AS nodes,
              'LIVES_IN,IN_REGION' AS types
       FROM customer JOIN nation ON n_nationkey = c_nationkey
       JOIN region ON r_regionkey = n_regionkey""",
)
def path_value(spark, folder):
    g = load(spark, folder, Customer, Nation, Region)
    paths = path_values(g.nodes(Customer), "nation__region")
    named = F.transform("nodes", lambda n: F.concat(n["label"], F.lit("="), n["properties"]["name"]))
    return paths.select(
        F.col("start_node.node_id").alias("id"),
        "length",
        F.col("start_node.name").alias("start_name"),
        F.col("end_node.name").alias("end_name"),
        F.array_join(named, ",").alias("nodes"),
        F.array_join("relationships.rel_type", ",").alias("types"),
    )


@query(
    "J19_fixed_length",
    f"""WITH e AS (SELECT src, dst FROM {NEXT}),
             s AS (SELECT src AS a, dst AS b, src || dst AS k FROM e
                   UNION ALL SELECT dst, src, src || dst FROM e)
        SELECT x.a AS id, x.b AS middle, y.b AS far FROM s x JOIN s y ON x.b = y.a AND x.k <> y.k""",
)
def fixed_length(spark, folder):
    # two hops in any direction; one edge is never used twice in a path
    found = repeated(load(spark, folder, Turn).nodes(Turn), "near", 2)
    return found.values(id="id", middle="near__id", far="near__near__id")


@query(
    "J20_reachable",
    """SELECT concat(a.conv_id, ':', a.turn) AS near_id, concat(b.conv_id, ':', b.turn) AS far_id,
              b.turn - a.turn AS hops
       FROM conversations a JOIN conversations b
         ON a.conv_id = b.conv_id AND b.turn BETWEEN a.turn + 1 AND a.turn + 5""",
)
def reachable_turns(spark, folder):
    g = load(spark, folder, Turn)
    found = reachable(g, Turn, Turn.relationship("next"), max_hops=5)
    return found.select("near_id", "far_id", "hops")


@query(
    "J20_reachable_unbounded",
    f"""WITH RECURSIVE e AS (SELECT src, dst FROM {NEXT}),
        r(near_id, far_id, hops) AS (
            SELECT src, dst, 1 FROM e
            UNION ALL SELECT near_id, dst, hops + 1 FROM r JOIN e ON far_id = src)
        SELECT near_id, far_id, CAST(hops AS BIGINT) AS hops FROM r""",
)
def reachable_any_length(spark, folder):
    """Every later turn of a conversation, however far: rounds double the length."""
    g = load(spark, folder, Turn)
    return reachable(g, Turn, Turn.relationship("next")).select("near_id", "far_id", "hops")


#: Customers know another one each, so that there are ways into rings and round them.
KNOWS = "(c_custkey * c_custkey + 1) % {n}"


class Acquainted(NodeModel):
    segment = StringProperty(db_property="c_mktsegment")
    knows = RelationshipTo("Acquainted", "KNOWS")


@query(
    "J20_reachable_in_rings",
    f"""WITH RECURSIVE e AS (SELECT c_custkey AS src, {KNOWS.format(n="(SELECT count(*) FROM customer)")}
              AS dst FROM customer),
        r(near_id, far_id) AS (
            SELECT src, dst FROM e WHERE src < 200
            UNION SELECT near_id, dst FROM r JOIN e ON far_id = src)
        SELECT near_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(far_id) AS BIGINT) AS ids
        FROM r GROUP BY near_id""",
)
def reachable_in_rings(spark, folder):
    """How many customers some of them reach, where every way ends in a ring."""
    rows = node_table(spark, folder, Customer)
    g = PropertyGraph(tune(spark)).with_nodes(Acquainted, rows)
    known = rows.selectExpr(
        "node_id AS edge_id", "node_id AS src_id", f"{KNOWS.format(n=rows.count())} AS dst_id"
    )
    g = g.with_edges("KNOWS", known, src=Acquainted, dst=Acquainted)
    found = reachable(
        g, Acquainted, Acquainted.relationship("knows"), start=rows.where("node_id < 200")
    )
    return found.groupBy("near_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("far_id").alias("ids")
    )


class Shopper(NodeModel):
    """Customers of the dear orders alone, and whatever hangs on these."""

    segment = StringProperty(db_property="c_mktsegment")
    anything = RelationshipTo("Part", "*")


def shoppers(spark, folder):
    orders = node_table(spark, folder, Order).where("o_totalprice > 400000")
    g = PropertyGraph(tune(spark)).with_nodes(Shopper, node_table(spark, folder, Customer))
    g = g.with_nodes(Order, orders).with_nodes(Part, node_table(spark, folder, Part))
    g = g.with_embedded_edges("PLACED", src=Shopper, dst=Order, owner_end="dst", key="o_custkey")
    parts = lines(spark, folder, "l_orderkey", "l_partkey")
    return g.with_edges("CONTAINS", parts, src=Order, dst=Part, model=Line)


DEAR = """EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey
          JOIN part ON p_partkey = l_partkey WHERE o_custkey = c_custkey AND o_totalprice > 400000)"""


@query("J11_has_any_length", f"SELECT c_custkey AS id, c_mktsegment AS segment FROM customer WHERE {DEAR}")
def has_any_length(spark, folder):
    g = shoppers(spark, folder)
    return g.nodes(Shopper).has(anything=True).values("id", "segment")


@query(
    "J12_has_not_any_length",
    f"SELECT c_custkey AS id, c_mktsegment AS segment FROM customer WHERE NOT {DEAR}",
)
def has_not_any_length(spark, folder):
    g = shoppers(spark, folder)
    return g.nodes(Shopper).has(anything=False).values("id", "segment")


@query(
    "J21_node_pairs",
    """SELECT c_custkey AS customer, s_suppkey AS supplier, s_acctbal - c_acctbal AS gap
       FROM customer, supplier WHERE c_custkey = s_suppkey AND c_acctbal < s_acctbal""",
)
def pairs_of_nodes(spark, folder):
    g = load(spark, folder, Customer, Supplier)
    found = node_pairs(
        g.nodes(Customer), g.nodes(Supplier), ("c", "s"),
        equal=[("id", "id")], where=F.expr("c.acctbal < s.acctbal"),
    )
    return found.selectExpr(
        "c.node_id as customer", "s.node_id as supplier", "s.acctbal - c.acctbal as gap"
    )


@query(
    "J21_pairs_less",
    """SELECT n_nationkey AS nation, p_partkey AS part FROM nation, part
       WHERE n_nationkey > p_retailprice - 975""",
)
def pairs_less(spark, folder):
    """One inequality alone."""
    g = with_stored(load(spark, folder, Nation, Part), Part, p_retailprice="p_retailprice - 975")
    found = node_pairs(
        g.nodes(Nation), g.nodes(Part), ("n", "p"), compare=[("id", ">", "price")]
    )
    return found.selectExpr("n.node_id as nation", "p.node_id as part")


@query(
    "J21_pairs_between",
    """SELECT s_suppkey AS supplier, c_custkey AS customer FROM supplier, customer
       WHERE c_acctbal >= s_acctbal AND c_acctbal < s_acctbal + 25""",
)
def pairs_between(spark, folder):
    """Values between two bounds of the other side."""
    g = load(spark, folder, Supplier, Customer)
    ceiling = supplier_with_ceiling(g)
    found = theta_join(
        g.nodes(Customer).values(customer="id", balance="acctbal"), ceiling,
        [("balance", ">=", "floor"), ("balance", "<", "ceiling")],
    )
    return found.select("supplier", "customer")


def supplier_with_ceiling(g):
    return g.nodes(Supplier).values(supplier="id", floor="acctbal").selectExpr(
        "supplier", "floor", "floor + 25 as ceiling"
    )


@query(
    "J21_pairs_two_inequalities",
    """SELECT c_custkey AS customer, s_suppkey AS supplier FROM customer, supplier
       WHERE c_acctbal < s_acctbal - 4000 AND c_nationkey > s_nationkey + 5""",
)
def pairs_two(spark, folder):
    """Two columns compared at once: cells over both."""
    g = load(spark, folder, Customer, Supplier, Nation)
    left = g.nodes(Customer).traverse("nation").values(
        customer="id", balance="acctbal", home="nation__id"
    )
    right = g.nodes(Supplier).traverse("nation").values(
        supplier="id", other="acctbal", base="nation__id"
    )
    right = right.selectExpr("supplier", "other - 4000 as other", "base + 5 as base")
    found = theta_join(left, right, [("balance", "<", "other"), ("home", ">", "base")])
    return found.select("customer", "supplier")


HIDDEN = dict(include_nodes_in_return=False, include_rels_in_return=False)


def latest_order(g: PropertyGraph):
    return (
        g.nodes(Customer)
        .traverse(o="orders")
        .intermediate_transform({"o": {"source": "o"}}, ordering=["o.orderdate", "o.id"])
        .annotate(latest=Last(Collect("o")))
    )


LATEST = """(SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS latest,
                    max(o_orderdate) AS latest_date, count(*) AS n
             FROM orders GROUP BY o_custkey)"""


@query(
    "J22_correlated_subquery",
    f"""SELECT c_custkey AS id, latest, latest_date FROM customer
        LEFT JOIN {LATEST} ON o_custkey = c_custkey""",
)
def correlated_subquery(spark, folder):
    g = load(spark, folder, Customer, Order)
    found = g.nodes(Customer).subquery(latest_order(g), ["latest"], [NodeNameResolver("self")])
    return found.values(id="id", latest="latest.node_id", latest_date="latest.orderdate")


@query(
    "J22_top_per_context",
    """SELECT c_custkey AS id, o_orderkey AS order_id, o_totalprice AS totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey
           ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
       JOIN customer ON c_custkey = o_custkey WHERE rn <= 3""",
)
def top_per_context(spark, folder):
    g = load(spark, folder, Customer, Order)
    dearest = g.nodes(Customer).traverse(o="orders").order_by("-orders__totalprice")[:3]
    found = g.nodes(Customer).subquery(dearest, ["o"], [NodeNameResolver("self")])
    return found.values(id="id", order_id="o.node_id", totalprice="o.totalprice")


@query(
    "J23_uncorrelated_subquery",
    """SELECT s_suppkey AS id, (SELECT max(p_retailprice) FROM part) AS top_price FROM supplier""",
)
def uncorrelated_subquery(spark, folder):
    g = load(spark, folder, Supplier, Part)
    dearest = (
        g.nodes(Part)
        .intermediate_transform(
            {"price": {"source": "part", "source_prop": "price"}}, ordering=["price"]
        )
        .annotate(top_price=Last(Collect("price")))
    )
    found = g.nodes(Supplier).subquery(dearest, ["top_price"])
    return found.values("id", "top_price")


@query(
    "J23_uncorrelated_rows",
    """SELECT s_suppkey AS id, p_partkey AS part FROM supplier, part
       WHERE p_retailprice > 999""",
)
def uncorrelated_rows(spark, folder):
    """A sub-query of many rows: each supplier beside each of the dearest parts."""
    g = load(spark, folder, Supplier, Part)
    dear = g.nodes(Part).filter(price__gt=999)
    return g.nodes(Supplier).subquery(dear, ["part"]).values(id="id", part="part.node_id")


@query(
    "J24_nested_subquery",
    f"""SELECT c_custkey AS id, latest, coalesce(n, 0) AS times FROM customer
        LEFT JOIN {LATEST} ON o_custkey = c_custkey""",
)
def nested_subquery(spark, folder):
    g = load(spark, folder, Customer, Order)
    me = NodeNameResolver("self")
    again = g.nodes(Customer).traverse(Path("orders", **HIDDEN))
    found = (
        g.nodes(Customer)
        .subquery(latest_order(g), ["latest"], [me])
        .subquery(again.annotate(times=Size(Collect("latest"))), ["times"], [me, "latest"])
    )
    return found.values(id="id", latest="latest.node_id", times="times")
