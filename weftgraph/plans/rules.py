"""Constraints and typed validation: violations and good and bad rows."""

from pyspark.sql import functions as F

from .. import (
    ArrayProperty,
    BooleanProperty,
    DateProperty,
    DateTimeFormatProperty,
    DateTimeProperty,
    EmailProperty,
    FloatProperty,
    IntegerProperty,
    JSONProperty,
    NodeModel,
    NormalizedProperty,
    One,
    OneOrMore,
    PointProperty,
    RegexProperty,
    StringProperty,
    UniqueIdProperty,
    VectorIndex,
    ZeroOrMore,
    ZeroOrOne,
)
from ..operators import constraints as C
from ..operators import validation as V
from .registry import query
from .tables import (
    Customer,
    Document,
    Event,
    Label,
    Nation,
    Order,
    Part,
    Supplier,
    Vec,
    load,
    table,
    with_stored,
)


def rule_sql(rule, subject, field, item, n, source):
    return f"""SELECT '{rule}' AS rule, '{subject}' AS subject, '{field}' AS field,
               CAST({item} AS VARCHAR) AS item, CAST({n} AS BIGINT) AS n FROM {source}"""


def nameless(spark, folder, *models):
    g = load(spark, folder, Customer, *models)
    return with_stored(g, Customer, c_name="if(c_acctbal < 0, null, c_name)")


REQUIRED = rule_sql("required", "Customer", "name", "c_custkey", 1, "customer WHERE c_acctbal < 0")


@query("C1_required", REQUIRED)
def required(spark, folder):
    return C.required(nameless(spark, folder), Customer)


@query(
    "C2_node_uniqueness",
    rule_sql("unique", "Part", "name", "p_name", "count(*)",
             "part GROUP BY p_name HAVING count(*) > 1"),
)
def node_uniqueness(spark, folder):
    return C.unique(load(spark, folder, Part), Part, ["name"])


@query(
    "C3_edge_uniqueness",
    rule_sql("unique edge", "PLACED", "since", "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')",
             "count(*)", "orders GROUP BY o_orderdate HAVING count(*) > 1"),
)
def edge_uniqueness(spark, folder):
    return C.unique_edges(load(spark, folder, Customer, Order), "PLACED", ["since"])


@query(
    "C4_zero_or_more",
    """SELECT 'ZeroOrMore' AS rule, (SELECT count(*) FROM customer) AS nodes,
              CAST(count(*) AS BIGINT) AS edges, CAST(0 AS BIGINT) AS violations
       FROM orders JOIN customer ON c_custkey = o_custkey""",
)
def zero_or_more(spark, folder):
    g = load(spark, folder, Customer, Order)
    return C.cardinality_report(g, Customer, "orders", ZeroOrMore)


@query(
    "C7_cardinality_report",
    """SELECT 'One' AS rule, count(*) AS nodes, CAST(sum(n) AS BIGINT) AS edges,
              count(*) FILTER (n <> 1) AS violations
       FROM (SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem
             ON l_orderkey = o_orderkey GROUP BY o_orderkey)""",
)
def cardinality_report(spark, folder):
    return C.cardinality_report(load(spark, folder, Order, Part), Order, "parts", One)


@query(
    "C7_no_disconnect_all",
    rule_sql("One", "Order", "parts", "o_orderkey", 0,
             """orders WHERE o_orderstatus = 'P'
                AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""),
)
def no_disconnect_all(spark, folder):
    g = load(spark, folder, Order, Part)
    sources = g.nodes(Order).filter(status="P").values(near_id="id")
    return C.disconnect_all_gate(g, Order, "parts", sources, One)


@query(
    "C5_zero_or_one",
    rule_sql("ZeroOrOne", "Order", "parts", "l_orderkey", "count(*)",
             "lineitem GROUP BY l_orderkey HAVING count(*) > 1"),
)
def zero_or_one(spark, folder):
    return C.cardinality(load(spark, folder, Order, Part), Order, "parts", ZeroOrOne)


NO_LINE = rule_sql(
    "OneOrMore", "Order", "parts", "o_orderkey", 0,
    "orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)


@query("C6_one_or_more", NO_LINE)
def one_or_more(spark, folder):
    return C.cardinality(load(spark, folder, Order, Part), Order, "parts", OneOrMore)


@query(
    "C6_last_edge_kept",
    rule_sql("OneOrMore", "Order", "parts", "o", 0,
             """(SELECT l_orderkey AS o, count(*) FILTER (l_partkey >= 1000) AS n,
                 count(*) FILTER (l_partkey < 1000) AS gone FROM lineitem GROUP BY l_orderkey)
                WHERE n = 0 AND gone > 0"""),
)
def last_edge_kept(spark, folder):
    g = load(spark, folder, Order, Part)
    gone = g.edge_frame("CONTAINS").where("dst_id < 1000")
    pairs = gone.selectExpr("src_id as near_id", "dst_id as far_id")
    return C.disconnect_gate(g, Order, "parts", pairs, OneOrMore)


@query(
    "C7_one",
    rule_sql("One", "Order", "parts", "o_orderkey", "n",
             """(SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem
                 ON l_orderkey = o_orderkey GROUP BY o_orderkey) WHERE n <> 1"""),
)
def one(spark, folder):
    return C.cardinality(load(spark, folder, Order, Part), Order, "parts", One)


@query(
    "C8_inverse_end",
    rule_sql("ZeroOrOne", "Part", "suppliers", "l_partkey", "count(*)",
             "lineitem GROUP BY l_partkey HAVING count(*) > 1"),
)
def inverse_end(spark, folder):
    g = load(spark, folder, Supplier, Part)
    return C.inverse_cardinality(g, Supplier, "parts", ZeroOrOne)


@query(
    "C9_soft_check",
    f"""{REQUIRED} UNION ALL SELECT 'stored', 'Customer', 'name', NULL, count(*) FROM customer""",
)
def soft_check(spark, folder):
    """What breaks the rule, and that all nodes are there in spite of it."""
    g = nameless(spark, folder)
    found = C.enforce(C.required(g, Customer), mode="report")
    stored = g.nodes(Customer).count_df().selectExpr(
        "'stored' as rule", "'Customer' as subject", "'name' as field",
        "cast(null as string) as item", "n",
    )
    return found.unionByName(stored)


@query(
    "C10_connect_gate",
    rule_sql("ZeroOrOne", "Document", "label", "doc_id", "n",
             """(SELECT d.doc_id, 1 + count(l.doc_id) AS n FROM documents d LEFT JOIN labels l
                 ON l.doc_id = d.doc_id GROUP BY d.doc_id) WHERE n > 1"""),
)
def connect_gate(spark, folder):
    g = load(spark, folder, Document, Label)
    proposed = g.node_frame(Document).selectExpr("node_id as near_id", "node_id as far_id")
    return C.connect_gate(g, Document, "label", proposed, ZeroOrOne)


@query(
    "C10_both_ends",
    rule_sql("One", "Order", "customer", "o_orderkey", 2, "orders WHERE o_orderstatus = 'P'"),
)
def both_ends(spark, folder):
    # each such order has its one customer already
    g = load(spark, folder, Customer, Order)
    waiting = g.nodes(Order).filter(status="P").traverse("customer")
    proposed = waiting.values(near_id="customer__id", far_id="id")
    return C.connect_gates(g, Customer, "orders", proposed)


@query(
    "C11_endpoint_class",
    rule_sql("endpoint", "CONTAINS", "dst", "l_partkey", "count(*)",
             "lineitem JOIN part ON p_partkey = l_partkey WHERE p_size = 1 GROUP BY l_partkey"),
)
def endpoint_class(spark, folder):
    g = load(spark, folder, Order, Part)
    g = g.with_nodes(Part, g.tables["Part"][1].where("p_size <> 1"))
    return C.endpoints(g, "CONTAINS")


@query("C12_all_rules", f"{REQUIRED} UNION ALL {NO_LINE}")
def all_rules(spark, folder):
    return C.check_all(nameless(spark, folder, Order, Nation, Part))


# ---------------------------------------------------------------- validation
class Typed(NodeModel):
    """Every kind of check at once, over raw order columns."""

    whole = IntegerProperty()
    number = FloatProperty()
    truth = BooleanProperty()


def counts_sql(source, **checks):
    parts = [
        f"""SELECT '{name}' AS property, count(*) FILTER (NOT coalesce({bad}, false)) AS good,
            count(*) FILTER (coalesce({bad}, false)) AS bad FROM {source}"""
        for name, bad in checks.items()
    ]
    return " UNION ALL ".join(parts)


@query(
    "V1_numbers",
    """SELECT o_orderkey AS id,
         CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS whole,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS number,
         o_custkey <> 0 AS truth,
         concat_ws(',', CASE WHEN o_orderstatus = 'P' THEN 'whole' END,
                        CASE WHEN o_orderpriority = '5-LOW' THEN 'number' END) AS bad
       FROM orders""",
)
def numbers(spark, folder):
    raw = table(spark, folder, "orders").selectExpr(
        "o_orderkey as node_id",
        "if(o_orderstatus = 'P', 'x' || o_custkey, cast(o_custkey as string)) as whole",
        "if(o_orderpriority = '5-LOW', 'none', cast(o_totalprice as string)) as number",
        "o_custkey as truth",
    )
    rows = V.checked(Typed, raw)
    return rows.selectExpr(
        "node_id as id", "whole", "number", "truth", "array_join(bad_properties, ',') as bad"
    )


class Worded(NodeModel):
    # The accepted states and their labels.
    status = StringProperty(choices={"F": "finished", "O": "open"})
    priority = StringProperty(max_length=8)


@query(
    "V2_choices",
    counts_sql("orders", status="o_orderstatus NOT IN ('F', 'O')",
               priority="length(o_orderpriority) > 8"),
)
def choices(spark, folder):
    raw = table(spark, folder, "orders").selectExpr(
        "o_orderkey as node_id", "o_orderstatus as status", "o_orderpriority as priority"
    )
    return V.bad_counts(Worded, raw)


@query(
    "V2_display",
    """SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open'
       END AS shown FROM orders""",
)
def display(spark, folder):
    raw = table(spark, folder, "orders").selectExpr("o_orderkey as id", "o_orderstatus as status")
    return V.display(Worded, raw, "status").selectExpr("id", "status_display as shown")


class Patterned(NodeModel):
    brand = RegexProperty(expression=r"Brand#1\d?")
    mail = EmailProperty()


@query(
    "V3_patterns",
    counts_sql(
        "part",
        brand=r"NOT regexp_matches(p_brand, '\ABrand#1\d?')",
        mail="NOT regexp_matches(concat(p_name, CASE WHEN p_size > 25 THEN '@' ELSE '' END, "
        r"'shop.org'), '\A[^@]+@[^@]+\.[^@]+')",
    ),
)
def patterns(spark, folder):
    raw = table(spark, folder, "part").selectExpr(
        "p_partkey as node_id", "p_brand as brand",
        "concat(p_name, if(p_size > 25, '@', ''), 'shop.org') as mail",
    )
    return V.bad_counts(Patterned, raw)


class Dated(NodeModel):
    day = DateProperty()
    moment = DateTimeProperty()
    shown = DateTimeFormatProperty(format="%Y/%m/%d %H:%M")


@query(
    "V4_dates",
    """SELECT event_id AS id,
         CASE WHEN value < 20 THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS day,
         CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS moment,
         CASE WHEN user_id > 5 THEN strftime(ts, '%Y-%m-%d %H:%M') END AS shown FROM events""",
)
def dates(spark, folder):
    raw = table(spark, folder, "events").selectExpr(
        "event_id as node_id",
        "if(value < 20, date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '2024-13-45') as day",
        "if(event_type <> 'error', cast(unix_micros(cast(ts as timestamp)) / 1e6D as string), "
        "'soon') as moment",
        "if(user_id > 5, date_format(ts, 'yyyy/MM/dd HH:mm'), date_format(ts, 'dd.MM.yy')) as shown",
    )
    rows = V.checked(Dated, raw)
    return rows.select(
        F.col("node_id").alias("id"), F.col("day").cast("string").alias("day"),
        F.date_format("moment", "yyyy-MM-dd HH:mm:ss").alias("moment"),
        F.date_format("shown", "yyyy-MM-dd HH:mm").alias("shown"),
    )


class Structured(NodeModel):
    props = JSONProperty()


@query("V5_json", counts_sql("events", props="value >= 20"))
def json(spark, folder):
    raw = table(spark, folder, "events").selectExpr(
        "event_id as node_id", "if(value < 20, props, substring(props, 2)) as props"
    )
    return V.bad_counts(Structured, raw)


class Listed(NodeModel):
    sizes = ArrayProperty(IntegerProperty())


@query("V6_array_elements", counts_sql("part", sizes="p_size > 40"))
def array_elements(spark, folder):
    raw = table(spark, folder, "part").selectExpr(
        "p_partkey as node_id",
        "array(cast(p_size as string), if(p_size > 40, p_name, '1'), null) as sizes",
    )
    return V.bad_counts(Listed, raw)


class Numbered(NodeModel):
    uid = UniqueIdProperty()
    segment = StringProperty(default="NONE")
    rating = IntegerProperty(default=lambda: 5)


@query(
    "V7_unique_id",
    """SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN c_name END AS given,
              c_acctbal >= 0 AS generated, CAST(1 AS BIGINT) AS times FROM customer""",
)
def unique_id(spark, folder):
    raw = table(spark, folder, "customer").selectExpr(
        "c_custkey as node_id", "if(c_acctbal < 0, c_name, null) as uid"
    )
    filled = V.with_defaults(Numbered, raw)
    generated = F.col("uid").rlike(r"\A[0-9a-f]{32}\z")
    return filled.groupBy("uid").agg(
        F.min("node_id").alias("id"), F.count(F.lit(1)).alias("times")
    ).select(
        "id", F.when(~generated, F.col("uid")).alias("given"), generated.alias("generated"), "times"
    )


@query(
    "V8_defaults",
    """SELECT c_custkey AS id, coalesce(nullif(c_mktsegment, 'BUILDING'), 'NONE') AS segment,
              CAST(5 AS BIGINT) AS rating FROM customer""",
)
def defaults(spark, folder):
    raw = table(spark, folder, "customer").selectExpr(
        "c_custkey as id", "nullif(c_mktsegment, 'BUILDING') as segment"
    )
    return V.with_defaults(Numbered, raw).select("id", "segment", "rating")


@query(
    "V9_stored_names",
    """SELECT p_partkey AS node_id, p_name, p_brand, p_type, p_size, p_retailprice,
              'price' AS model_name FROM part""",
)
def stored_names(spark, folder):
    named = V.from_stored(Part, table(spark, folder, "part").withColumnRenamed("p_partkey", "node_id"))
    stored = V.to_stored(Part, named)
    return stored.withColumn("model_name", F.lit(named.columns[-1]))


class Loose(NodeModel):
    name = StringProperty()


@query(
    "V10_semi_structured",
    """SELECT event_id AS id, event_type AS name, concat('user_id=', user_id, ';k=',
              json_extract_string(props, '$.k')) AS extras, false AS conflict
       FROM events WHERE value < 20
       UNION ALL SELECT event_id, event_type, NULL, true FROM events WHERE value >= 20""",
)
def semi_structured(spark, folder):
    raw = table(spark, folder, "events").selectExpr(
        "event_id as node_id", "event_type as name", "user_id",
        "map(if(value < 20, 'k', 'name'), get_json_object(props, '$.k')) as more",
    )
    good, conflicts = V.split_extras(Loose, raw, extras="more")
    pairs = F.transform(F.map_entries("extras"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    kept = good.select(
        F.col("node_id").alias("id"), "name", F.array_join(pairs, ";").alias("extras"),
        F.lit(False).alias("conflict"),
    )
    lost = conflicts.selectExpr(
        "node_id as id", "name", "cast(null as string) as extras", "true as conflict"
    )
    return kept.unionByName(lost)


class Placed(NodeModel):
    flat = PointProperty(crs="cartesian")
    globe = PointProperty(crs="wgs-84")
    solid = PointProperty(crs="cartesian-3d")


@query(
    "V11_points",
    counts_sql("customer", flat="c_acctbal < 0", globe="c_mktsegment = 'BUILDING'",
               solid="c_acctbal > 5000"),
)
def points(spark, folder):
    raw = table(spark, folder, "customer").selectExpr(
        "c_custkey as node_id",
        # no system given: two coordinates are cartesian, three are cartesian-3d
        "named_struct('srid', cast(null as int), 'x', c_acctbal, 'y', 1.0D, "
        "'z', if(c_acctbal < 0, 1.0D, null)) as flat",
        "named_struct('srid', if(c_mktsegment = 'BUILDING', 7203, 4326), 'x', 1.0D, 'y', 2.0D, "
        "'z', cast(null as double)) as globe",
        "named_struct('srid', 9157, 'x', 1.0D, 'y', 2.0D, "
        "'z', if(c_acctbal > 5000, null, 3.0D)) as solid",
    )
    return V.bad_counts(Placed, raw)


class Vectored(NodeModel):
    embedding = ArrayProperty(FloatProperty(), vector_index=VectorIndex(dimensions=64))


@query("V12_vector_length", counts_sql("embeddings", embedding="label >= 5"))
def vector_length(spark, folder):
    raw = load(spark, folder, Vec).node_frame(Vec).selectExpr(
        "node_id", "if(label < 5, embedding, slice(embedding, 1, 63)) as embedding"
    )
    return V.bad_counts(Vectored, raw)


class Clean(NodeModel):
    name = NormalizedProperty(lambda c: F.initcap(F.trim(c)))
    kind = NormalizedProperty(lambda c: F.when(c != "error", F.upper(c)))


@query(
    "V13_normalized",
    """SELECT event_id AS id, CASE WHEN event_type <> 'error' THEN upper(event_type) END AS kind,
              CASE WHEN event_type = 'error' THEN 'kind' ELSE '' END AS bad FROM events""",
)
def normalized(spark, folder):
    raw = load(spark, folder, Event).node_frame(Event).selectExpr("node_id", "event_type as kind")
    rows = V.checked(Clean, raw)
    return rows.selectExpr("node_id as id", "kind", "array_join(bad_properties, ',') as bad")
