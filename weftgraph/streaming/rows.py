"""Row-by-row delivery of a result, without holding all of it on the driver."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame


def stream_rows(frame: DataFrame) -> Iterator[Any]:
    """Yields rows in result order, one partition in flight and one prefetched.

    A row of a single column is delivered as its value.
    """
    single = len(frame.columns) == 1
    for row in frame.toLocalIterator(prefetchPartitions=True):
        yield row[0] if single else row
