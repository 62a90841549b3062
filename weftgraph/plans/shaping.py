"""Projection, aggregation, order and paging."""

from pyspark.sql import functions as F

from .. import (
    Collect,
    Last,
    NodeNameResolver,
    Path,
    RawExpr,
    RelationNameResolver,
    Size,
)
from ..operators.constraints import degrees
from .registry import query
from .tables import Customer, Nation, Order, Part, Region, Supplier, load, with_stored

HIDDEN = dict(include_nodes_in_return=False, include_rels_in_return=False)
PART_SIZE = 50  # a list is returned in parts of so many elements

NULLED = "(SELECT *, nullif(c_mktsegment, 'BUILDING') AS seg FROM customer)"
ORDER_PART = """orders JOIN lineitem ON l_orderkey = o_orderkey
                JOIN part ON p_partkey = l_partkey"""


def order_parts(spark, folder):
    return load(spark, folder, Order, Part).nodes(Order)


# ---------------------------------------------------------------- projection
@query(
    "P1_return_list",
    f"""SELECT o_orderkey AS order_id, p_name AS part, l_quantity AS quantity,
               'order,part_parts1,r1' AS names FROM {ORDER_PART}""",
)
def return_list(spark, folder):
    rows = order_parts(spark, folder).traverse("parts").df()
    names = F.lit(",".join(rows.columns))
    return rows.select(
        F.col("order.node_id").alias("order_id"), F.col("part_parts1.name").alias("part"),
        F.col("r1.quantity").alias("quantity"), names.alias("names"),
    )


@query(
    "P2_hide_nodes",
    f"SELECT o_orderkey AS order_id, l_tax AS tax, 'order,r1' AS names FROM {ORDER_PART}",
)
def hide_nodes(spark, folder):
    rows = order_parts(spark, folder).traverse(Path("parts", include_nodes_in_return=False)).df()
    names = F.lit(",".join(rows.columns)).alias("names")
    return rows.select(
        F.col("order.node_id").alias("order_id"), F.col("r1.tax").alias("tax"), names
    )


@query(
    "P3_hide_edges",
    f"SELECT o_orderkey AS order_id, p_brand AS brand, 'order,part_parts1' AS names FROM {ORDER_PART}",
)
def hide_edges(spark, folder):
    rows = order_parts(spark, folder).traverse(Path("parts", include_rels_in_return=False)).df()
    names = F.lit(",".join(rows.columns)).alias("names")
    return rows.select(
        F.col("order.node_id").alias("order_id"), F.col("part_parts1.brand").alias("brand"), names
    )


@query(
    "P4_path_alias",
    f"SELECT o_orderkey AS order_id, p_type AS type FROM {ORDER_PART}",
)
def path_alias(spark, folder):
    rows = order_parts(spark, folder).traverse(bought="parts").df()
    return rows.select(F.col("order.node_id").alias("order_id"), F.col("bought.type").alias("type"))


@query(
    "P5_node_resolver",
    f"""SELECT o_orderkey AS order_id, count(DISTINCT p_partkey) AS parts FROM {ORDER_PART}
        GROUP BY o_orderkey""",
)
def node_resolver(spark, folder):
    found = order_parts(spark, folder).traverse(Path("parts", **HIDDEN))
    found = found.annotate(parts=Size(Collect(NodeNameResolver("parts"), distinct=True)))
    return found.values(order_id="id", parts="parts")


@query(
    "P6_relation_resolver",
    f"SELECT o_orderkey AS order_id, count(*) AS lines FROM {ORDER_PART} GROUP BY o_orderkey",
)
def relation_resolver(spark, folder):
    found = order_parts(spark, folder).traverse(Path("parts", **HIDDEN))
    found = found.annotate(lines=Size(Collect(RelationNameResolver("parts"))))
    return found.values(order_id="id", lines="lines")


def segment_nation(spark, folder, distinct):
    found = load(spark, folder, Customer, Nation).nodes(Customer).traverse("nation")
    return found.intermediate_transform(
        {
            "segment": {
                "source": "customer", "source_prop": "segment", "include_in_return": True,
            },
            "nation": {"source": NodeNameResolver("nation"), "include_in_return": True},
        },
        distinct=distinct,
    ).values(segment="segment", nation="nation.name")


SEGMENT_NATION = """ c_mktsegment AS segment, n_name AS nation
                     FROM customer JOIN nation ON n_nationkey = c_nationkey"""


@query("P7_transform", "SELECT" + SEGMENT_NATION)
def transform(spark, folder):
    return segment_nation(spark, folder, False)


@query("P8_distinct_transform", "SELECT DISTINCT" + SEGMENT_NATION)
def distinct_transform(spark, folder):
    return segment_nation(spark, folder, True)


@query(
    "P9_subgraph",
    """SELECT c_custkey AS id, n_name AS nation, r_name AS region, o_totalprice AS totalprice,
              o_orderdate AS since
       FROM customer JOIN nation ON n_nationkey = c_nationkey
       JOIN region ON r_regionkey = n_regionkey LEFT JOIN orders ON o_custkey = c_custkey
         AND o_orderstatus = 'P'""",
)
def subgraph(spark, folder):
    g = load(spark, folder, Customer, Nation, Region, Order)
    rows = (
        g.nodes(Customer)
        .traverse("nation__region", Path("orders", optional=True))
        .filter(orders__status="P")
        .resolve_subgraph()
    )
    return rows.selectExpr(
        "node_id as id", "nation.name as nation", "nation.region.name as region",
        "orders.totalprice as totalprice", "orders_relationship.since as since",
    )


@query(
    "P10_nested_values",
    """SELECT o_orderkey AS order_id, p_name AS first_name, p_name AS map_name,
              l_quantity AS quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey
       JOIN part ON p_partkey = l_partkey""",
)
def nested_values(spark, folder):
    rows = order_parts(spark, folder).traverse(item="parts").df()
    nested = rows.select(
        F.array("item").alias("items"),
        F.create_map(F.lit("item"), F.col("item")).alias("named"),
        F.struct(F.col("item"), F.col("r1").alias("rel"), F.col("order")).alias("pair"),
    )
    return nested.select(
        F.col("pair.order.node_id").alias("order_id"),
        F.col("items")[0]["name"].alias("first_name"),
        F.col("named")["item"]["name"].alias("map_name"),
        F.col("pair.rel.quantity").alias("quantity"),
    )


@query(
    "P11_subquery_columns",
    """SELECT c_custkey AS id, o_orderkey AS order_id, o_totalprice * 2 AS doubled
       FROM customer JOIN orders ON o_custkey = c_custkey""",
)
def subquery_columns(spark, folder):
    g = load(spark, folder, Customer, Order)
    inner = (
        g.nodes(Customer)
        .traverse(o="orders")
        .intermediate_transform(
            {
                "o": {"source": "o", "include_in_return": True},
                "doubled": {"source": RawExpr("o.totalprice * 2"), "include_in_return": True},
            }
        )
    )
    found = g.nodes(Customer).subquery(inner, ["o", "doubled"], [NodeNameResolver("self")])
    return found.values(id="id", order_id="o.node_id", doubled="doubled")


# ---------------------------------------------------------------- aggregation
def supplied_parts(spark, folder):
    g = load(spark, folder, Supplier, Part)
    return g.nodes(Supplier).traverse(part=Path("parts", **HIDDEN))


def joined(found):
    rows = found.values("id", "part", parts="all.node_id")
    return rows.withColumn("parts", F.array_join(F.array_sort("parts"), ","))


@query(
    "A1_collect",
    """SELECT id, part, array_to_string(list_sort(list(l_partkey)), ',') AS parts FROM (
         SELECT l_suppkey AS id, l_partkey, CAST((row_number() OVER (
           PARTITION BY l_suppkey ORDER BY l_partkey) - 1) // 50 AS BIGINT) AS part FROM lineitem)
       GROUP BY id, part""",
)
def collect(spark, folder):
    found = supplied_parts(spark, folder).annotate(all=Collect("part", part_size=PART_SIZE))
    return joined(found)


@query(
    "A2_collect_distinct",
    """SELECT id, part, array_to_string(list_sort(list(l_partkey)), ',') AS parts FROM (
         SELECT l_suppkey AS id, l_partkey, CAST((row_number() OVER (
           PARTITION BY l_suppkey ORDER BY l_partkey) - 1) // 50 AS BIGINT) AS part
         FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem))
       GROUP BY id, part""",
)
def collect_distinct(spark, folder):
    function = Collect("part", distinct=True, part_size=PART_SIZE)
    found = supplied_parts(spark, folder).annotate(all=function)
    return joined(found)


@query(
    "A3_last_in_order",
    """SELECT o_orderkey AS id, p_partkey AS last_part FROM (
         SELECT o_orderkey, p_partkey, row_number() OVER (PARTITION BY o_orderkey ORDER BY
           nullif(l_quantity, 50.0) ASC NULLS LAST, p_partkey DESC, l_suppkey DESC,
           l_linenumber DESC, l_shipdate DESC) AS rn
         FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey)
       WHERE rn = 1""",
)
def last_in_order(spark, folder):
    g = load(spark, folder, Order, Part)
    found = (
        g.nodes(Order)
        .traverse("parts")
        .intermediate_transform(
            {
                "order": {"source": "order", "include_in_return": True},
                "part": {"source": NodeNameResolver("parts")},
                "r": {"source": RelationNameResolver("parts")},
                "quantity": {"source": RawExpr("nullif(r1.quantity, 50.0D)")},
            },
            # descending: nulls come first, the least quantity last
            ordering=["-quantity"],
        )
        .annotate(last_part=Last(Collect("part")))
    )
    return found.values(id="id", last_part="last_part.node_id")


@query(
    "A4_size",
    """SELECT l_suppkey AS id, count(*) AS n, count(DISTINCT l_partkey) AS n_distinct
       FROM lineitem GROUP BY l_suppkey""",
)
def size(spark, folder):
    found = supplied_parts(spark, folder).annotate(
        n=Size(Collect("part")), n_distinct=Size(Collect("part", distinct=True))
    )
    return found.values("id", "n", "n_distinct")


@query(
    "A5_nested_functions",
    """SELECT n_nationkey AS id, max(c_custkey) AS last_customer, count(*) AS n
       FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey""",
)
def nested_functions(spark, folder):
    g = load(spark, folder, Nation, Customer)
    found = g.nodes(Nation).traverse(customer=Path("customers", **HIDDEN))
    found = found.annotate(last=Last(Collect("customer")), n=Size(Collect("customer")))
    return found.values(id="id", last_customer="last.node_id", n="n")


@query(
    "A6_implicit_grouping",
    """SELECT c_custkey AS id, o_orderkey AS order_id, count(*) AS parts
       FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
       GROUP BY ALL""",
)
def implicit_grouping(spark, folder):
    g = load(spark, folder, Customer, Order, Part)
    # "parts" is returned by the path and replaced by the annotation of that name
    path = Path("orders__parts", include_rels_in_return=False, alias="parts")
    found = g.nodes(Customer).traverse(path).annotate(parts=Size(Collect("parts")))
    return found.values(id="id", order_id="orders__id", parts="parts")


@query("A7_count", "SELECT count(*) AS n FROM customer WHERE c_acctbal > 0")
def count(spark, folder):
    nodes = load(spark, folder, Customer).nodes(Customer)
    return nodes.filter(acctbal__gt=0).order_by("name").count_df()


@query(
    "A8_count_of_page",
    "SELECT count(*) AS n FROM (SELECT * FROM customer WHERE c_acctbal > 0 LIMIT 20 OFFSET 10)",
)
def count_of_page(spark, folder):
    nodes = load(spark, folder, Customer).nodes(Customer)
    return nodes.filter(acctbal__gt=0)[10:30].count_df()


@query(
    "A9_any",
    """SELECT (SELECT count(*) > 0 FROM customer WHERE c_acctbal > 9000) AS some,
              (SELECT count(*) > 0 FROM customer WHERE c_acctbal > 1e12) AS none""",
)
def any_row(spark, folder):
    nodes = load(spark, folder, Customer).nodes(Customer)
    some = nodes.filter(acctbal__gt=9000).exists_df("some")
    none = nodes.filter(acctbal__gt=1e12).exists_df("none")
    return some.select("some", none.scalar().alias("none"))


@query(
    "A10_several_annotations",
    """SELECT o_custkey AS id, count(DISTINCT o_orderkey) AS orders,
              count(l_orderkey) AS lines, count(DISTINCT l_partkey) AS parts
       FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
       WHERE l_orderkey IS NOT NULL GROUP BY o_custkey""",
)
def several_annotations(spark, folder):
    g = load(spark, folder, Customer, Order, Part)
    found = g.nodes(Customer).traverse(Path("orders__parts", **HIDDEN)).annotate(
        orders=Size(Collect(NodeNameResolver("orders"), distinct=True)),
        lines=Size(Collect(RelationNameResolver("orders__parts"))),
        parts=Size(Collect(NodeNameResolver("orders__parts"), distinct=True)),
    )
    return found.values("id", "orders", "lines", "parts")


@query(
    "A11_degree",
    "SELECT o_custkey AS id, count(*) AS n FROM orders GROUP BY o_custkey",
)
def degree(spark, folder):
    g = load(spark, folder, Customer, Order)
    found = degrees(g, Customer, Customer.relationship("orders"))
    return found.select(F.col("near_id").alias("id"), "n")


# ---------------------------------------------------------------- order
@query(
    "O1_order_by",
    f"""SELECT c_custkey AS id, seg, c_acctbal AS acctbal FROM {NULLED}
        ORDER BY seg ASC NULLS LAST, c_acctbal DESC NULLS FIRST""",
)
def order_by(spark, folder):
    g = load(spark, folder, Customer)
    g = with_stored(g, Customer, c_mktsegment="nullif(c_mktsegment, 'BUILDING')")
    found = g.nodes(Customer).order_by("segment").order_by("-acctbal")
    return found.values(id="id", seg="segment", acctbal="acctbal")


@query("O2_random_order", "SELECT c_custkey AS id, c_name AS name FROM customer")
def random_order(spark, folder):
    return load(spark, folder, Customer).nodes(Customer).order_by("?", seed=7).values("id", "name")


@query("O3_order_cleared", "SELECT p_partkey AS id FROM part WHERE p_size < 5")
def order_cleared(spark, folder):
    nodes = load(spark, folder, Part).nodes(Part).filter(size__lt=5)
    return nodes.order_by("-price").order_by(None).ids()


@query(
    "O4_order_by_traversed",
    """SELECT c_custkey AS id, r_name AS region FROM customer
       JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
       ORDER BY r_name DESC""",
)
def order_by_traversed(spark, folder):
    g = load(spark, folder, Customer, Nation, Region)
    found = g.nodes(Customer).traverse("nation__region").order_by("-nation__region__name")
    return found.values(id="id", region="nation__region__name")


@query(
    "O5_order_by_edge",
    f"SELECT o_orderkey AS id, l_quantity AS quantity FROM {ORDER_PART} ORDER BY l_quantity",
)
def order_by_edge(spark, folder):
    found = order_parts(spark, folder).traverse("parts").order_by("parts|quantity")
    return found.values(id="id", quantity="parts|quantity")


@query(
    "O6_order_by_expression",
    """SELECT p_partkey AS id, p_brand AS brand FROM part
       ORDER BY CAST(string_split(p_brand, '#')[2] AS INT)""",
)
def order_by_expression(spark, folder):
    nodes = load(spark, folder, Part).nodes(Part)
    number = RawExpr("cast(split($n.brand, '#')[1] as int)")
    return nodes.order_by(number).values("id", "brand")


@query(
    "O7_ordered_collect",
    """SELECT id, part, string_agg(strftime(day, '%Y-%m-%d'), ',' ORDER BY day DESC) AS dates
       FROM (SELECT o_custkey AS id, o_orderdate AS day, CAST((row_number() OVER (
               PARTITION BY o_custkey ORDER BY o_orderdate DESC) - 1) // 5 AS BIGINT) AS part
             FROM orders) GROUP BY id, part""",
)
def ordered_collect(spark, folder):
    g = load(spark, folder, Customer, Order)
    found = (
        g.nodes(Customer)
        .traverse("orders")
        .intermediate_transform(
            {
                "customer": {"source": "customer", "include_in_return": True},
                "day": {"source": NodeNameResolver("orders"), "source_prop": "orderdate"},
            },
            ordering=["-day"],
        )
        .annotate(days=Collect("day", part_size=5))
        .values("id", "part", "days")
    )
    text = F.transform("days", lambda d: F.date_format(d, "yyyy-MM-dd"))
    return found.select("id", "part", F.array_join(text, ",").alias("dates"))


# ---------------------------------------------------------------- paging
ORDERED = "SELECT c_custkey AS id, c_acctbal AS acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey"


def by_balance(spark, folder):
    return load(spark, folder, Customer).nodes(Customer).order_by("-acctbal")


@query("L1_slice", f"({ORDERED} LIMIT 20 OFFSET 10)")
def page(spark, folder):
    return by_balance(spark, folder)[10:30].values("id", "acctbal")


@query("L1_skip", f"({ORDERED} OFFSET 10)")
def skip(spark, folder):
    return by_balance(spark, folder)[10:].values("id", "acctbal")


@query("L2_item", f"({ORDERED} LIMIT 1 OFFSET 5)")
def item(spark, folder):
    return by_balance(spark, folder).page_of(5).values("id", "acctbal")


@query("L3_get", "SELECT c_custkey AS id, c_acctbal AS acctbal FROM customer WHERE c_custkey = 7")
def get(spark, folder):
    nodes = load(spark, folder, Customer).nodes(Customer)
    return nodes.page_to_get(name="Customer#000000007").values("id", "acctbal")


@query("L4_get_or_none", "SELECT c_custkey AS id FROM customer WHERE c_name = 'nobody'")
def get_or_none(spark, folder):
    return load(spark, folder, Customer).nodes(Customer).page_to_get(name="nobody").ids()


@query("L5_first", f"({ORDERED} LIMIT 1)")
def first(spark, folder):
    return by_balance(spark, folder).page_of_first().values("id", "acctbal")


@query(
    "L6_top_k",
    """SELECT o_orderkey AS id, c_name AS customer, o_totalprice AS totalprice
       FROM orders JOIN customer ON c_custkey = o_custkey
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def top_k(spark, folder):
    g = load(spark, folder, Order, Customer)
    found = g.nodes(Order).traverse("customer").order_by("-totalprice")[:10]
    return found.values(id="id", customer="customer__name", totalprice="totalprice")
