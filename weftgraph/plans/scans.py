"""Label scans, raw queries and class resolution."""

from pyspark.sql import functions as F

from .. import FloatProperty, NodeModel, PropertyGraph, StringProperty
from ..sources.resolve import all_edge_types, resolve_edges, resolve_nodes
from .registry import query
from .tables import Customer, Line, Nation, Order, Part, Placed, Supplier, load, node_table


class Party(NodeModel):
    name = StringProperty()
    acctbal = FloatProperty()


class PartyCustomer(Party):
    segment = StringProperty()


class PartySupplier(Party):
    pass


def party_graph(spark, folder):
    # ids are unique within the family: even for customers, odd for suppliers
    customers = node_table(spark, folder, Customer).selectExpr(
        "node_id * 2 as node_id", "c_name as name", "c_acctbal as acctbal",
        "c_mktsegment as segment",
    )
    suppliers = node_table(spark, folder, Supplier).selectExpr(
        "node_id * 2 + 1 as node_id", "s_name as name", "s_acctbal as acctbal"
    )
    g = PropertyGraph(spark)
    return g.with_nodes(PartyCustomer, customers).with_nodes(PartySupplier, suppliers)


@query(
    "S1_label_scan",
    """SELECT p_partkey AS id, p_name AS name, p_brand AS brand, p_type AS type,
              p_size AS size, p_retailprice AS price FROM part""",
)
def label_scan(spark, folder):
    g = load(spark, folder, Part)
    return g.nodes(Part).values("id", "name", "brand", "type", "size", "price")


@query(
    "S2_polymorphic_scan",
    """SELECT c_custkey * 2 AS id, c_name AS name, c_acctbal AS acctbal,
              'PartyCustomer,Party' AS labels FROM customer
       UNION ALL
       SELECT s_suppkey * 2 + 1, s_name, s_acctbal, 'PartySupplier,Party' FROM supplier""",
)
def polymorphic_scan(spark, folder):
    found = party_graph(spark, folder).nodes(Party).values("id", "name", "acctbal", "labels")
    return found.withColumn("labels", F.array_join("labels", ","))


@query(
    "S3_scan_from_nodes",
    """SELECT c_custkey AS customer, o_orderkey AS id, o_totalprice AS totalprice
       FROM customer JOIN orders ON o_custkey = c_custkey
       WHERE c_mktsegment = 'BUILDING'""",
)
def scan_from_nodes(spark, folder):
    g = load(spark, folder, Customer, Order)
    given = g.node_frame(Customer).where("segment = 'BUILDING'").select("node_id")
    return (
        g.nodes(Customer, given)
        .traverse("orders")
        .values(customer="id", id="orders__id", totalprice="orders__totalprice")
    )


@query(
    "S4_raw_query",
    """SELECT c_name AS name, count(*) AS orders, min(o_orderdate) AS first_date
       FROM customer JOIN orders ON o_custkey = c_custkey
       WHERE c_acctbal > 9000 GROUP BY c_name""",
)
def raw_query(spark, folder):
    g = load(spark, folder, Customer, Order)
    return g.sql(
        """SELECT c.name, count(*) AS orders, min(p.since) AS first_date
           FROM {customers} c JOIN {placed} p ON p.src_id = c.node_id
           WHERE c.acctbal > :balance GROUP BY c.name""",
        args={"balance": 9000},
        customers=Customer,
        placed="PLACED",
    )


@query(
    "S5_all_rows",
    """SELECT s_suppkey AS node_id, s_name AS name, s_acctbal AS acctbal FROM supplier
       ORDER BY s_name""",
)
def all_rows(spark, folder):
    rows = load(spark, folder, Supplier).nodes(Supplier).order_by("name").df()
    return rows.select("supplier.node_id", "supplier.name", "supplier.acctbal")


@query("S6_lazy_ids", "SELECT s_suppkey AS id FROM supplier")
def lazy_ids(spark, folder):
    return load(spark, folder, Supplier).nodes(Supplier).ids()


@query(
    "S8_node_class_resolution",
    """SELECT class_name, count(*) AS n FROM (
         SELECT 'PartyCustomer' AS class_name FROM customer
         UNION ALL SELECT 'PartySupplier' FROM supplier
         UNION ALL SELECT NULL FROM part) GROUP BY class_name""",
)
def node_class_resolution(spark, folder):
    parts = load(spark, folder, Part).node_frame(Part).select("labels")
    nodes = party_graph(spark, folder).node_frame(Party).select("labels").unionByName(parts)
    # the model of parts is not declared here, so its nodes stay unresolved
    return resolve_nodes(nodes, [Party, PartyCustomer, PartySupplier]).groupBy("class_name").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "S9_edge_class_resolution",
    """SELECT rel_type, class_name, count(*) AS n FROM (
         SELECT 'PLACED' AS rel_type, 'Placed' AS class_name FROM orders
         UNION ALL SELECT 'LIVES_IN', 'RelModel' FROM customer
         UNION ALL SELECT 'CONTAINS', 'Line' FROM lineitem
         UNION ALL SELECT 'SUPPLIES', NULL FROM lineitem
         UNION ALL SELECT 'BASED_IN', NULL FROM supplier) GROUP BY ALL""",
)
def edge_class_resolution(spark, folder):
    g = load(spark, folder, Customer, Nation, Order, Part, Supplier)
    known = {"PLACED": Placed, "LIVES_IN": None, "CONTAINS": Line}
    counted = all_edge_types(g).groupBy("rel_type").agg(F.count(F.lit(1)).alias("n"))
    return resolve_edges(counted, known).select("rel_type", "class_name", "n")
