"""Joins that make many pairs of few rows are spread by the pairs, not by the bytes read."""

from weftgraph.operators import product as pairs_of_all
from weftgraph.operators import theta


def shares(df):
    """Rows of each partition that has any."""
    return [n for n in df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]


def test_a_product_of_one_partition_each_is_made_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(pairs_of_all, "PAIRS", 10_000, raising=False)
    left = spark.range(0, 1000, 1, 1).selectExpr("id as a")
    right = spark.range(0, 300, 1, 1).selectExpr("id as b")
    made = pairs_of_all.product(left, right)
    found = shares(made)
    assert sum(found) == 1000 * 300 and made.distinct().count() == 1000 * 300
    assert len(found) >= 10 and max(found) <= 60_000


def test_a_product_with_an_empty_side_is_empty(spark):
    some, none = spark.range(5).selectExpr("id as a"), spark.range(0).selectExpr("id as b")
    assert pairs_of_all.product(some, none).count() == 0
    assert pairs_of_all.product(none, some).count() == 0


def test_pairs_of_inequalities_are_made_in_many_tasks(spark, monkeypatch):
    """One cell that all bounds cover, and cells of one value each."""
    monkeypatch.setattr(pairs_of_all, "PAIRS", 10_000)
    monkeypatch.setattr(theta, "PAIRS", 10_000, raising=False)
    points = spark.range(0, 1000, 1, 1).selectExpr("id as a", "id % 10 as x")
    bounds = spark.range(0, 300, 1, 1).selectExpr("id as b", "id % 5 + 3 as u")
    made = theta.theta_join(points, bounds, [("x", "<", "u")])
    found = shares(made)
    assert sum(found) == 100 * 60 * sum(range(3, 8)) and made.distinct().count() == sum(found)
    assert len(found) >= 5 and max(found) <= 60_000
