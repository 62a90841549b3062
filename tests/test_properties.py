import pytest
from pyspark.sql import functions as F

from weftgraph import (
    ArrayProperty,
    BooleanProperty,
    DateProperty,
    DateTimeFormatProperty,
    DateTimeProperty,
    EmailProperty,
    IntegerProperty,
    JSONProperty,
    NodeModel,
    PointProperty,
    RegexProperty,
    StringProperty,
    UniqueIdProperty,
)
from weftgraph.operators import validation as V
from weftgraph.sources.resolve import label_sets


def typed(spark, prop, values, kind="string"):
    frame = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    rows = frame.select(prop.typed(F.col("v")).alias("t"), prop.bad(F.col("v")).alias("b"))
    return [tuple(r) for r in rows.collect()]


def test_option_conflicts():
    for wrong in (
        lambda: StringProperty(choices={"a": "b"}, max_length=3),
        lambda: StringProperty(max_length=-1),
        lambda: StringProperty(required=True, default="x"),
        lambda: IntegerProperty(index=True, unique_index=True),
        lambda: ArrayProperty(StringProperty(required=True)),
        lambda: UniqueIdProperty(required=True),
        lambda: PointProperty(crs="mars"),
        lambda: RegexProperty(),
        lambda: DateTimeProperty(default_now=True, default=1),
    ):
        with pytest.raises(ValueError):
            wrong()
    with pytest.raises(TypeError):
        ArrayProperty(ArrayProperty())


def test_conversions(spark):
    assert typed(spark, IntegerProperty(), ["12", "dozen", None]) == [(12, False), (None, True), (None, False)]
    dates = typed(spark, DateProperty(), ["2021-02-28", "2021-13-40", "2021-02-28T10:00"])
    assert [(str(d) if d else None, b) for d, b in dates] == [
        ("2021-02-28", False), (None, True), ("2021-02-28", False),
    ]
    shown = DateTimeFormatProperty(format="%Y-%m-%d %H:%M:%S")
    rows = typed(spark, shown, ["2020-05-01 08:07:06", "1.5.2020"])
    assert str(rows[0][0]) == "2020-05-01 08:07:06" and rows[1] == (None, True)
    assert typed(spark, DateTimeProperty(), ["soon"]) == [(None, True)]
    mail = typed(spark, EmailProperty(), ["mara@kiln.org", "mara@kiln", "x@y.z q@"])
    assert [b for _, b in mail] == [False, True, False]  # a prefix is enough
    truth = typed(spark, BooleanProperty(), ["", "False", None])
    assert [t for t, _ in truth] == [False, True, None]
    json = typed(spark, JSONProperty(), ['{"b": 2}', '"q": 7}', "3, 4", "nil", ""])
    assert [b for _, b in json] == [False, True, True, True, True]


def test_json_text(spark):
    frame = spark.createDataFrame([('{"t":["©","😀"]}',)], "v string")
    stored = [
        frame.select(p.stored(p.typed(F.col("v")))).first()[0]
        for p in (JSONProperty(), JSONProperty(ensure_ascii=False))
    ]
    assert stored == ['{"t":["\\u00a9","\\ud83d\\ude00"]}', '{"t":["©","😀"]}']


class Loose(NodeModel):
    title_ = StringProperty(db_property="title")
    uid = UniqueIdProperty()


def test_names_defaults_extras(spark):
    raw = spark.createDataFrame([(1, "sir", "data")], "node_id long, title string, extra string")
    named = V.from_stored(Loose, raw)
    assert named.columns == ["node_id", "title_", "extra"]
    assert V.to_stored(Loose, named).columns == raw.columns
    good, bad = V.split_extras(Loose, named)
    assert good.first().extras == {"extra": "data"} and bad.count() == 0
    uid = V.with_defaults(Loose, named).first().uid
    assert len(uid) == 32 and "-" not in uid


def test_good_and_bad_rows(spark):
    class Strict(NodeModel):
        n = IntegerProperty(required=True)

    raw = spark.createDataFrame([("1",), ("x",), (None,)], "n string")
    good, bad = V.validated(Strict, raw)
    assert [r.n for r in good.collect()] == [1] and bad.count() == 2


def test_models():
    class Base(NodeModel):
        __abstract_node__ = True
        name = StringProperty()

    class Parent(Base):
        pass

    class Child(Parent):
        __optional_labels__ = ("Alive",)
        age = IntegerProperty()

    assert Child.inherited_labels() == ["Child", "Parent"]
    assert list(Child.properties()) == ["name", "age"]
    assert label_sets([Child]) == {
        ("Child", "Parent"): "Child", ("Alive", "Child", "Parent"): "Child",
    }
    with pytest.raises(ValueError):

        class Clash(NodeModel):
            properties = StringProperty()


def test_numbers_and_dates_at_the_edge(spark):
    from weftgraph import DateProperty, FloatProperty

    numbers = {
        "1.5": 1.5, " -2e3 ": -2000.0, "1_000": 1000.0, ".5": 0.5, "7.": 7.0, "inf": float("inf"),
        "1d": None, "0x1p3": None, "2f": None, "": None, "1__0": None, "e5": None,
    }
    rows = spark.createDataFrame([(k,) for k in numbers], "raw string")
    prop = FloatProperty()
    found = {r.raw: (r.v, r.bad) for r in rows.select("raw", prop.typed(rows.raw).alias("v"), prop.bad(rows.raw).alias("bad")).collect()}
    assert found == {k: (v, v is None) for k, v in numbers.items()}
    dates = {"2024-1-5": "2024-01-05", "2024-01-05": "2024-01-05", "2024-13-1": None, "24-1-5": None,
             "2024-02-30": None, "2024-1-05T10:00:00": "2024-01-05"}
    rows = spark.createDataFrame([(k,) for k in dates], "raw string")
    prop = DateProperty()
    found = {r.raw: r.v and str(r.v) for r in rows.select("raw", prop.typed(rows.raw).alias("v")).collect()}
    assert found == dates
