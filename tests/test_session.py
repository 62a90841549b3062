"""What the session's settings do to the tasks of a query."""

from weftgraph.sources.session import tune


def test_tasks_after_a_shuffle_grow_with_its_bytes(spark):
    """24 MB that do not compress: not as few tasks as the four partitions of a shuffle."""
    tune(spark)
    rows = spark.range(0, 2_000_000, 1, 4).selectExpr("xxhash64(id) as a")
    counted = rows.groupBy("a").count()
    sizes = counted.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 2_000_000
    assert max(sizes) <= 400_000
