"""Node and edge models over the supplied tables, and the graph they form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import (
    AliasProperty,
    ArrayProperty,
    DateTimeNativeProperty,
    FloatProperty,
    FulltextIndex,
    IntegerProperty,
    JSONProperty,
    NodeModel,
    One,
    OneOrMore,
    PropertyGraph,
    Relationship,
    RelationshipFrom,
    RelationshipTo,
    RelModel,
    StringProperty,
    VectorIndex,
    ZeroOrMore,
    ZeroOrOne,
)
from ..sources.session import tune


class Placed(RelModel):
    since = DateTimeNativeProperty()


class Line(RelModel):
    quantity = FloatProperty()
    extendedprice = FloatProperty()
    discount = FloatProperty()
    tax = FloatProperty()
    returnflag = StringProperty()
    linestatus = StringProperty()
    shipdate = DateTimeNativeProperty()


class Supplied(RelModel):
    quantity = FloatProperty()
    shipdate = DateTimeNativeProperty()


class Did(RelModel):
    ts = DateTimeNativeProperty()
    value = FloatProperty()


class Region(NodeModel):
    name = StringProperty(required=True, db_property="r_name")
    nations = RelationshipFrom("Nation", "IN_REGION")


class Nation(NodeModel):
    name = StringProperty(required=True, db_property="n_name")
    region = RelationshipTo(Region, "IN_REGION", cardinality=One)
    customers = RelationshipFrom("Customer", "LIVES_IN", cardinality=ZeroOrMore)
    suppliers = RelationshipFrom("Supplier", "BASED_IN")


class Customer(NodeModel):
    name = StringProperty(required=True, db_property="c_name")
    acctbal = FloatProperty(db_property="c_acctbal")
    segment = StringProperty(db_property="c_mktsegment")
    title = AliasProperty(to="name")
    nation = RelationshipTo(Nation, "LIVES_IN", cardinality=One)
    orders = RelationshipTo("Order", "PLACED", model=Placed)
    events = RelationshipTo("Event", "DID", model=Did)
    any_order = RelationshipTo("Order", None)


class Supplier(NodeModel):
    name = StringProperty(required=True, db_property="s_name")
    acctbal = FloatProperty(db_property="s_acctbal")
    nation = RelationshipTo(Nation, "BASED_IN", cardinality=One)
    parts = RelationshipTo("Part", "SUPPLIES", model=Supplied)


class Part(NodeModel):
    name = StringProperty(required=True, db_property="p_name")
    brand = StringProperty(db_property="p_brand")
    type = StringProperty(db_property="p_type")
    size = IntegerProperty(db_property="p_size")
    price = FloatProperty(db_property="p_retailprice")
    title = AliasProperty(to="name")
    orders = RelationshipFrom("Order", "CONTAINS", model=Line)
    suppliers = RelationshipFrom(Supplier, "SUPPLIES", model=Supplied)


class PartWords(NodeModel):
    """Parts with their name as a list of words."""

    name = StringProperty(db_property="p_name")
    words = ArrayProperty(StringProperty())


class Order(NodeModel):
    status = StringProperty(db_property="o_orderstatus")
    totalprice = FloatProperty(db_property="o_totalprice")
    orderdate = DateTimeNativeProperty(db_property="o_orderdate")
    priority = StringProperty(db_property="o_orderpriority")
    customer = RelationshipFrom(Customer, "PLACED", model=Placed, cardinality=One)
    parts = RelationshipTo(Part, "CONTAINS", model=Line, cardinality=OneOrMore)


class Event(NodeModel):
    ts = DateTimeNativeProperty()
    event_type = StringProperty()
    value = FloatProperty()
    props = JSONProperty()
    customer = RelationshipFrom(Customer, "DID", model=Did, cardinality=One)


class Document(NodeModel):
    text = StringProperty(fulltext_index=FulltextIndex())
    lang = StringProperty()
    source = StringProperty()
    n_chars = IntegerProperty()
    label = RelationshipTo("Label", "LABELLED", cardinality=ZeroOrOne)


class Label(NodeModel):
    quality = IntegerProperty()
    toxic = IntegerProperty()
    document = RelationshipFrom(Document, "LABELLED", cardinality=One)


class Vec(NodeModel):
    embedding = ArrayProperty(
        FloatProperty(), vector_index=VectorIndex(dimensions=64, similarity_function="cosine")
    )
    label = IntegerProperty()
    document = RelationshipTo(Document, "EMBEDS", cardinality=ZeroOrOne)


class VecByDistance(NodeModel):
    embedding = ArrayProperty(
        FloatProperty(), vector_index=VectorIndex(dimensions=64, similarity_function="euclidean")
    )
    label = IntegerProperty()


class Turn(NodeModel):
    conv_id = IntegerProperty()
    turn = IntegerProperty()
    role = StringProperty()
    text = StringProperty()
    next = RelationshipTo("Turn", "NEXT", cardinality=ZeroOrOne)
    previous = RelationshipFrom("Turn", "NEXT", cardinality=ZeroOrOne)
    near = Relationship("Turn", "NEXT")


# model: table and node id
SOURCES = {
    Region: ("region", "r_regionkey"),
    Nation: ("nation", "n_nationkey"),
    Customer: ("customer", "c_custkey"),
    Supplier: ("supplier", "s_suppkey"),
    Part: ("part", "p_partkey"),
    Order: ("orders", "o_orderkey"),
    Event: ("events", "event_id"),
    Document: ("documents", "doc_id"),
    Label: ("labels", "doc_id"),
    Vec: ("embeddings", "vec_id"),
    VecByDistance: ("embeddings", "vec_id"),
    Turn: ("conversations", "concat(conv_id, ':', turn)"),
    PartWords: ("part", "p_partkey"),
}

# The columns of the supplied tables. With a given schema no file has to
# be opened before the query runs.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

LINE_ID = "struct(l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def node_table(spark: SparkSession, folder: str, model: type[NodeModel]) -> DataFrame:
    name, key = SOURCES[model]
    frame = table(spark, folder, name).withColumn("node_id", F.expr(key))
    if model is PartWords:
        frame = frame.withColumn("words", F.split("p_name", " "))
    return frame


def lines(spark: SparkSession, folder: str, src: str, dst: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(
        f"{LINE_ID} AS edge_id", f"{src} AS src_id", f"{dst} AS dst_id",
        *[f"l_{p} AS {p}" for p in Line.properties()],
    )


def load(spark: SparkSession, folder: str, *models: type[NodeModel]) -> PropertyGraph:
    """The graph of the given labels and of all relationships between them."""
    tune(spark)
    g = PropertyGraph(spark)
    for model in models:
        g = g.with_nodes(model, node_table(spark, folder, model))
    own = dict(verified=True)
    chosen = set(models)

    def both(a: type[NodeModel], b: type[NodeModel]) -> bool:
        return {a, b} <= chosen

    if both(Nation, Region):
        g = g.with_embedded_edges(
            "IN_REGION", src=Nation, dst=Region, owner_end="src", key="n_regionkey", **own
        )
    if both(Customer, Nation):
        g = g.with_embedded_edges(
            "LIVES_IN", src=Customer, dst=Nation, owner_end="src", key="c_nationkey", **own
        )
    if both(Supplier, Nation):
        g = g.with_embedded_edges(
            "BASED_IN", src=Supplier, dst=Nation, owner_end="src", key="s_nationkey", **own
        )
    if both(Customer, Order):
        g = g.with_embedded_edges(
            "PLACED", src=Customer, dst=Order, owner_end="dst", key="o_custkey",
            props={"since": "o_orderdate"}, model=Placed, **own,
        )
    if both(Customer, Event):
        g = g.with_embedded_edges(
            "DID", src=Customer, dst=Event, owner_end="dst", key="user_id",
            props={"ts": "ts", "value": "value"}, model=Did, **own,
        )
    if both(Document, Label):
        g = g.with_embedded_edges(
            "LABELLED", src=Document, dst=Label, owner_end="dst", key="node_id", **own
        )
    if both(Vec, Document):
        g = g.with_embedded_edges(
            "EMBEDS", src=Vec, dst=Document, owner_end="src", key="node_id"
        )
    if Turn in chosen:
        before = F.when(F.col("turn") > 0, F.expr("concat(conv_id, ':', turn - 1)"))
        g = g.with_embedded_edges(
            "NEXT", src=Turn, dst=Turn, owner_end="dst", key=before, **own
        )
    if both(Order, Part):
        g = g.with_edges(
            "CONTAINS", lines(spark, folder, "l_orderkey", "l_partkey"),
            src=Order, dst=Part, model=Line, **own,
        )
    if both(Supplier, Part):
        g = g.with_edges(
            "SUPPLIES", lines(spark, folder, "l_suppkey", "l_partkey"),
            src=Supplier, dst=Part, model=Supplied, **own,
        )
    return g


def with_stored(g: PropertyGraph, model: type[NodeModel], **columns: str) -> PropertyGraph:
    """The graph with some stored columns of a label replaced by SQL expressions."""
    frame = g.tables[model.label_name()][1]
    return g.with_nodes(model, frame.withColumns({c: F.expr(e) for c, e in columns.items()}))
