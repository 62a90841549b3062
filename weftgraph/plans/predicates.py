"""The filter operators and boolean trees."""

from datetime import datetime

from .. import Path, Q
from .registry import query
from .tables import (
    Customer,
    Document,
    Nation,
    Order,
    Part,
    PartWords,
    Supplier,
    load,
    with_stored,
)

PART = "SELECT p_partkey AS id, p_name AS name FROM part WHERE "
DOC = "SELECT doc_id AS id, n_chars FROM documents WHERE "
NULLED = "(SELECT *, nullif(c_mktsegment, 'BUILDING') AS seg FROM customer)"


def parts(spark, folder, *args, **lookups):
    g = load(spark, folder, Part)
    return g.nodes(Part).filter(*args, **lookups).values("id", "name")


def documents(spark, folder, **lookups):
    g = load(spark, folder, Document)
    return g.nodes(Document).filter(**lookups).values("id", "n_chars")


def nulled_customers(spark, folder):
    g = load(spark, folder, Customer)
    g = with_stored(g, Customer, c_mktsegment="nullif(c_mktsegment, 'BUILDING')")
    return g.nodes(Customer)


@query("F1_exact", "SELECT c_custkey AS id FROM customer WHERE c_mktsegment = 'BUILDING'")
def exact(spark, folder):
    return load(spark, folder, Customer).nodes(Customer).filter(segment="BUILDING").ids()


@query("F2_ne", f"SELECT c_custkey AS id, seg FROM {NULLED} WHERE seg <> 'MACHINERY'")
def ne(spark, folder):
    return nulled_customers(spark, folder).filter(segment__ne="MACHINERY").values(
        id="id", seg="segment"
    )


@query("F3_lt", PART + "p_size < 5")
def lt(spark, folder):
    return parts(spark, folder, size__lt=5)


@query("F4_lte", PART + "p_size <= 5")
def lte(spark, folder):
    return parts(spark, folder, size__lte=5)


@query("F5_gt", "SELECT c_custkey AS id, c_acctbal AS acctbal FROM customer WHERE c_acctbal > 9000")
def gt(spark, folder):
    found = load(spark, folder, Customer).nodes(Customer).filter(acctbal__gt=9000)
    return found.values("id", "acctbal")


@query(
    "F6_gte",
    """SELECT o_orderkey AS id, o_orderdate AS orderdate FROM orders
       WHERE o_orderdate >= TIMESTAMP '2001-01-01'""",
)
def gte(spark, folder):
    found = load(spark, folder, Order).nodes(Order).filter(orderdate__gte=datetime(2001, 1, 1))
    return found.values("id", "orderdate")


@query("F7_in", PART + "p_size IN (1, 7, 49)")
def is_in(spark, folder):
    return parts(spark, folder, size__in=[1, 7, 49])


@query(
    "F8_in_array",
    PART + "list_has_any(string_split(p_name, ' '), ['red', 'ring'])",
)
def in_array(spark, folder):
    g = load(spark, folder, PartWords)
    return g.nodes(PartWords).filter(words__in=["red", "ring"]).values("id", "name")


@query("F9_isnull", f"SELECT c_custkey AS id, 'null' AS kind FROM {NULLED} WHERE seg IS NULL "
       f"UNION ALL SELECT c_custkey, 'value' FROM {NULLED} WHERE seg IS NOT NULL")
def isnull(spark, folder):
    nodes = nulled_customers(spark, folder)
    absent = nodes.filter(segment__isnull=True).ids().selectExpr("id", "'null' as kind")
    present = nodes.filter(segment__isnull=False).ids().selectExpr("id", "'value' as kind")
    return absent.union(present)


@query("F10_regex", PART + r"regexp_full_match(p_brand, 'Brand#1\d')")
def regex(spark, folder):
    return parts(spark, folder, brand__regex=r"Brand#1\d")


@query("F11_iregex", PART + "regexp_full_match(p_brand, 'BRAND#2.', 'i')")
def iregex(spark, folder):
    return parts(spark, folder, brand__iregex="BRAND#2.")


@query("F12_iexact", PART + "lower(p_type) = 'promo'")
def iexact(spark, folder):
    return parts(spark, folder, type__iexact="promo")


@query("F13_contains", DOC + "contains(text, 'the')")
def contains(spark, folder):
    return documents(spark, folder, text__contains="the")


@query("F14_icontains", DOC + "contains(lower(text), 'the')")
def icontains(spark, folder):
    return documents(spark, folder, text__icontains="THE")


@query("F15_startswith", PART + "starts_with(p_name, 'red')")
def startswith(spark, folder):
    return parts(spark, folder, name__startswith="red")


@query("F16_istartswith", PART + "starts_with(lower(p_name), 'red')")
def istartswith(spark, folder):
    return parts(spark, folder, name__istartswith="RED")


@query("F17_endswith", PART + "ends_with(p_name, 'ring')")
def endswith(spark, folder):
    return parts(spark, folder, name__endswith="ring")


@query("F18_iendswith", PART + "ends_with(lower(p_name), 'ring')")
def iendswith(spark, folder):
    return parts(spark, folder, name__iendswith="RING")


@query("F19_and", PART + "p_size < 25 AND lower(p_type) = 'promo' AND p_name LIKE '%r%'")
def and_(spark, folder):
    both = Q(size__lt=25) & Q(type__iexact="promo") & Q()
    return parts(spark, folder, both, name__contains="r")


@query("F20_or", PART + "p_size < 5 OR lower(p_type) = 'promo'")
def or_(spark, folder):
    return parts(spark, folder, Q(size__lt=5) | Q(type__iexact="promo"))


@query(
    "F21_not",
    f"SELECT c_custkey AS id FROM {NULLED} WHERE NOT (seg = 'MACHINERY' OR c_acctbal < 100)",
)
def not_(spark, folder):
    nodes = nulled_customers(spark, folder)
    return nodes.filter(~(Q(segment="MACHINERY") | Q(acctbal__lt=100))).ids()


@query(
    "F22_exclude",
    f"SELECT c_custkey AS id FROM {NULLED} WHERE NOT (seg = 'MACHINERY' AND c_acctbal > 0)",
)
def exclude(spark, folder):
    return nulled_customers(spark, folder).exclude(segment="MACHINERY", acctbal__gt=0).ids()


@query(
    "F23_path_filter",
    """SELECT o_orderkey AS id, c_name AS customer, n_name AS nation
       FROM orders JOIN customer ON c_custkey = o_custkey
       JOIN nation ON n_nationkey = c_nationkey WHERE n_name = 'NATION_3'""",
)
def path_filter(spark, folder):
    g = load(spark, folder, Order, Customer, Nation)
    found = g.nodes(Order).filter(customer__nation__name="NATION_3")
    return found.values(id="id", customer="customer__name", nation="customer__nation__name")


@query(
    "F24_edge_filter",
    """SELECT o_orderkey AS id, l_partkey AS part, l_quantity AS quantity
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_quantity > 49""",
)
def edge_filter(spark, folder):
    found = load(spark, folder, Order, Part).nodes(Order).filter(**{"parts|quantity__gt": 49})
    return found.values(id="id", part="parts__id", quantity="parts|quantity")


OPTIONAL_PART = """orders LEFT JOIN (SELECT l_orderkey, l_quantity, p_partkey, p_size FROM lineitem
       JOIN part ON p_partkey = l_partkey {where}) ON l_orderkey = o_orderkey"""


@query(
    "F25_optional_filter",
    "SELECT o_orderkey AS id, p_partkey AS part, l_quantity AS quantity FROM "
    + OPTIONAL_PART.format(where="WHERE p_size = 1"),
)
def optional_filter(spark, folder):
    g = load(spark, folder, Order, Part)
    found = g.nodes(Order).traverse(Path("parts", optional=True)).filter(parts__size=1)
    return found.values(id="id", part="parts__id", quantity="parts|quantity")


@query(
    "F26_mixed_or",
    "SELECT o_orderkey AS id, p_partkey AS part FROM "
    + OPTIONAL_PART.format(where="")
    + " WHERE (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') OR p_size = 1",
)
def mixed_or(spark, folder):
    g = load(spark, folder, Order, Part)
    either = (Q(status="P") & Q(priority="1-URGENT")) | Q(parts__size=1)
    found = g.nodes(Order).traverse(Path("parts", optional=True)).filter(either)
    return found.values(id="id", part="parts__id")


@query("F27_alias", PART + "p_name LIKE 'red%' AND p_name IN ('red ring', 'red bolt')")
def alias(spark, folder):
    return parts(spark, folder, title__startswith="red", title__in=["red ring", "red bolt"])


@query(
    "F28_db_property",
    "SELECT p_partkey AS id, p_retailprice AS price FROM part WHERE p_retailprice > 950",
)
def db_property(spark, folder):
    found = load(spark, folder, Part).nodes(Part).filter(price__gt=950).order_by("-price")
    return found.values("id", "price")


@query(
    "F29_match",
    """SELECT l_suppkey AS supplier, p_partkey AS id, p_name AS name
       FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN part ON p_partkey = l_partkey
       WHERE s_acctbal > 5000 AND l_quantity > 40""",
)
def match(spark, folder):
    g = load(spark, folder, Supplier, Part)
    rich = g.nodes(Supplier).filter(acctbal__gt=5000)
    found = rich.parts.match(quantity__gt=40).nodes(keep_source=True)
    return found.values(supplier="source_id", id="id", name="name")
