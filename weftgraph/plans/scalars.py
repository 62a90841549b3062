"""Scalar functions on text, lists, numbers, dates, JSON and maps."""

from pyspark.sql import functions as F

from .. import (
    Collect,
    DateTimeFormatProperty,
    DateTimeProperty,
    Last,
    Path,
    RawExpr,
    ScalarFunction,
    Size,
)
from ..operators.validation import from_stored
from .registry import query
from .tables import Customer, Event, Order, Part, PartWords, load


@query(
    "N1_text_predicates",
    """SELECT p_partkey AS id FROM part WHERE contains(p_name, 'o')
       AND NOT ends_with(lower(p_name), 'ring') AND lower(p_type) <> 'promo'""",
)
def text_predicates(spark, folder):
    nodes = load(spark, folder, Part).nodes(Part).filter(name__contains="o")
    return nodes.exclude(name__iendswith="RING").exclude(type__iexact="Promo").ids()


@query(
    "N2_array_functions",
    """SELECT p_partkey AS id, CAST(len(string_split(p_name, ' ')) AS BIGINT) AS n,
              string_split(p_name, ' ')[-1] AS last_word FROM part
       WHERE list_has_any(string_split(p_name, ' '), ['red', 'small'])""",
)
def array_functions(spark, folder):
    nodes = load(spark, folder, PartWords).nodes(PartWords).filter(words__in=["red", "small"])
    found = nodes.intermediate_transform(
        {
            "id": {"source": "partwords", "source_prop": "id", "include_in_return": True},
            "words": {"source": "partwords", "source_prop": "words", "include_in_return": True},
        }
    ).annotate(n=Size("words"), last_word=Last("words"))
    return found.values(id="id", n="n", last_word="last_word")


@query("N3_random", "SELECT c_custkey AS id, true AS in_range FROM customer")
def random(spark, folder):
    nodes = load(spark, folder, Customer).nodes(Customer)
    drawn = nodes.ids().withColumn("r", F.rand(3))
    return drawn.selectExpr("id", "r >= 0 and r < 1 as in_range")


@query(
    "N4_cast",
    """SELECT p_partkey AS id, TRY_CAST(string_split(p_brand, '#')[2] AS INT) AS number,
              TRY_CAST(p_type AS INT) AS none FROM part""",
)
def cast(spark, folder):
    found = load(spark, folder, Part).nodes(Part).intermediate_transform(
        {
            "key": {"source": "part", "source_prop": "id", "include_in_return": True},
            "number": {
                "source": RawExpr("try_cast(split(part.brand, '#')[1] as int)"),
                "include_in_return": True,
            },
            "none": {
                "source": RawExpr("try_cast(part.type as int)"), "include_in_return": True,
            },
        }
    )
    return found.values(id="key", number="number", none="none")


@query(
    "N5_dates",
    """SELECT o_orderkey AS id, epoch(o_orderdate) AS seconds,
              strftime(o_orderdate, '%Y-%m-%d %H:%M') AS back,
              strftime(o_orderdate, '%d/%m/%Y') AS shown,
              CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders""",
)
def dates(spark, folder):
    rows = load(spark, folder, Order).node_frame(Order)
    epoch, shown = DateTimeProperty(), DateTimeFormatProperty(format="%d/%m/%Y")
    stored = rows.select(
        F.col("node_id").alias("id"),
        epoch.stored(F.col("orderdate")).alias("seconds"),
        shown.stored(F.col("orderdate")).alias("shown"),
    )
    return stored.select(
        "id",
        "seconds",
        F.date_format(epoch.typed(F.col("seconds")), "yyyy-MM-dd HH:mm").alias("back"),
        "shown",
        shown.typed(F.col("shown")).cast("date").cast("string").alias("day"),
    )


@query(
    "N6_json",
    """SELECT event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
       WHERE CAST(json_extract(props, '$.k') AS BIGINT) > 50""",
)
def json(spark, folder):
    rows = load(spark, folder, Event).node_frame(Event)
    parsed = Event.property("props").typed(F.col("props"))
    k = F.try_variant_get(parsed, "$.k", "bigint").alias("k")
    return rows.select(F.col("node_id").alias("id"), k).where("k > 50")


@query(
    "N7_maps",
    """SELECT event_id AS id, event_type AS kind, value AS amount,
              concat('kind=', event_type, ';k=', json_extract_string(props, '$.k')) AS pairs
       FROM events""",
)
def maps(spark, folder):
    rows = from_stored(Event, load(spark, folder, Event).node_frame(Event))
    extras = F.map_from_arrays(
        F.array(F.lit("kind"), F.lit("k")),
        F.array(F.col("event_type"), F.get_json_object("props", "$.k")),
    )
    whole = rows.select("node_id", "value", extras.alias("m"))
    pairs = F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return whole.select(
        F.col("node_id").alias("id"),
        F.col("m")["kind"].alias("kind"),
        F.col("value").alias("amount"),
        F.array_join(pairs, ";").alias("pairs"),
    )


class Head(ScalarFunction):
    """A user-defined annotate function: the first element."""

    def apply(self, value):
        return F.try_element_at(value, F.lit(1))


@query(
    "A5_custom_function",
    "SELECT o_custkey AS id, min(o_orderdate) AS first_date FROM orders GROUP BY o_custkey",
)
def custom_function(spark, folder):
    g = load(spark, folder, Customer, Order)
    found = (
        g.nodes(Customer)
        .traverse(Path("orders"))
        .intermediate_transform(
            {
                "customer": {"source": "customer", "include_in_return": True},
                "day": {"source": "orders", "source_prop": "orderdate"},
            },
            ordering=["day"],
        )
        .annotate(first_date=Head(Collect("day")))
    )
    return found.values("id", "first_date")
