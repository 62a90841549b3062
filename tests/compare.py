"""Runs catalogue queries beside their SQL in DuckDB and compares all rows."""

import math
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connection(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(cell(v) for v in value) + "]"
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, function, sql):
    """None when equal, else a short text; with the time of the Spark side."""
    begin = time.time()
    frame = function(spark, folder)
    ours = frame.collect()
    took = time.time() - begin
    if sql is None:
        return None, len(ours), took
    done = con.execute(sql)
    columns = [d[0] for d in done.description]
    theirs = done.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}", len(ours), took
    a, b = rows_of(frame.columns, ours), rows_of(columns, theirs)
    if a != b:
        only_a, only_b = list((a - b).items())[:3], list((b - a).items())[:3]
        return f"{len(ours)} rows vs {len(theirs)}: {only_a} / {only_b}", len(ours), took
    return None, len(ours), took
