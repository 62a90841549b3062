"""Schema profiling of the derived graph."""

from functools import reduce

from pyspark.sql import DataFrame

from ..operators import profiling as P
from .registry import query
from .tables import Customer, Nation, Order, Part, Region, load, with_stored


def whole(spark, folder):
    return load(spark, folder, Customer, Order, Nation, Region, Part)


@query(
    "I1_labels",
    """SELECT 'Customer' AS label, count(*) AS n FROM customer
       UNION ALL SELECT 'Order', count(*) FROM orders UNION ALL SELECT 'Nation', count(*) FROM nation
       UNION ALL SELECT 'Region', count(*) FROM region UNION ALL SELECT 'Part', count(*) FROM part""",
)
def labels(spark, folder):
    return P.labels(whole(spark, folder))


@query(
    "I2_property_profile",
    """SELECT 'Customer' AS label, unnest(['acctbal', 'name']) AS property,
              unnest(['FloatProperty', 'StringProperty']) AS kind
       FROM (SELECT count(*) AS n FROM customer WHERE c_name IS NOT NULL HAVING n > 0)""",
)
def property_profile(spark, folder):
    # no customer has a segment here, so the richest node has two properties
    g = with_stored(whole(spark, folder), Customer, c_mktsegment="cast(null as string)")
    return P.node_properties(g, Customer)


@query(
    "I3_relationship_profile",
    """SELECT 'Customer' AS label, 'PLACED' AS rel_type, 'Order' AS target,
              'since' AS properties, count(*) AS n FROM orders
       UNION ALL SELECT 'Customer', 'LIVES_IN', 'Nation', '', count(*) FROM customer""",
)
def relationship_profile(spark, folder):
    return P.outgoing(whole(spark, folder), Customer)


CARDINALITY = """SELECT '{label}' AS label, '{rel}' AS rel_type,
   CASE WHEN min(n) = 0 THEN 'Zero' ELSE 'One' END
     || CASE WHEN min(n) = 0 AND max(n) <= 1 THEN 'OrOne' ELSE 'OrMore' END AS cardinality,
   min(n) AS least, max(n) AS most
   FROM (SELECT count({other}) AS n FROM {nodes} LEFT JOIN {edges} ON {on} GROUP BY {key})"""

CARDINALITIES = [
    CARDINALITY.format(label="Customer", rel="PLACED", other="o_orderkey", nodes="customer",
                       edges="orders", on="o_custkey = c_custkey", key="c_custkey"),
    CARDINALITY.format(label="Order", rel="CONTAINS", other="l_orderkey", nodes="orders",
                       edges="lineitem", on="l_orderkey = o_orderkey", key="o_orderkey"),
    CARDINALITY.format(label="Customer", rel="LIVES_IN", other="n_nationkey", nodes="customer",
                       edges="nation", on="n_nationkey = c_nationkey", key="c_custkey"),
    CARDINALITY.format(label="Nation", rel="IN_REGION", other="r_regionkey", nodes="nation",
                       edges="region", on="r_regionkey = n_regionkey", key="n_nationkey"),
]


@query("I4_cardinality_inference", " UNION ALL ".join(CARDINALITIES))
def cardinality_inference(spark, folder):
    g = whole(spark, folder)
    parts = [P.inferred_cardinality(g, edge) for edge in g.edges.values()]
    return reduce(DataFrame.unionByName, parts)


UNIQUE = """SELECT '{label}' AS label, '{name}' AS property,
            count(DISTINCT {column}) = count({column}) AS "unique" FROM {table}"""

PROPERTIES = {
    ("Customer", "customer"): {
        "name": ("c_name", "StringProperty"),
        "acctbal": ("c_acctbal", "FloatProperty"),
        "segment": ("c_mktsegment", "StringProperty"),
    },
    ("Order", "orders"): {
        "status": ("o_orderstatus", "StringProperty"),
        "totalprice": ("o_totalprice", "FloatProperty"),
        "orderdate": ("o_orderdate", "DateTimeNativeProperty"),
        "priority": ("o_orderpriority", "StringProperty"),
    },
    ("Nation", "nation"): {"name": ("n_name", "StringProperty")},
    ("Region", "region"): {"name": ("r_name", "StringProperty")},
    ("Part", "part"): {
        "name": ("p_name", "StringProperty"),
        "brand": ("p_brand", "StringProperty"),
        "type": ("p_type", "StringProperty"),
        "size": ("p_size", "IntegerProperty"),
        "price": ("p_retailprice", "FloatProperty"),
    },
}


def unique_sql(label, table):
    return " UNION ALL ".join(
        UNIQUE.format(label=label, name=n, column=c, table=table)
        for n, (c, _) in PROPERTIES[label, table].items()
    )


@query("I5_unique_detection", unique_sql("Customer", "customer"))
def unique_detection(spark, folder):
    return P.unique_candidates(whole(spark, folder), Customer)


def report_sql():
    parts = []
    for (label, table), properties in PROPERTIES.items():
        kinds = " ".join(f"WHEN '{n}' THEN '{k}'" for n, (_, k) in properties.items())
        parts.append(
            f"""SELECT label, property AS name, CASE property {kinds} END AS kind,
                CASE WHEN "unique" THEN 'unique' ELSE '' END AS detail
                FROM ({unique_sql(label, table)})"""
        )
    targets = {"PLACED": "Order", "CONTAINS": "Part", "LIVES_IN": "Nation", "IN_REGION": "Region"}
    kinds = " ".join(f"WHEN '{r}' THEN 'to {t}'" for r, t in targets.items())
    parts.append(
        f"""SELECT label, rel_type, CASE rel_type {kinds} END, cardinality
            FROM ({" UNION ALL ".join(CARDINALITIES)})"""
    )
    return " UNION ALL ".join(parts)


@query("I6_model_report", report_sql())
def model_report(spark, folder):
    return P.report(whole(spark, folder))
