"""Order of values: nulls last when ascending, nulls first when descending."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

@dataclass(frozen=True)
class RawExpr:
    """A Spark SQL expression used in an ordering or a transform.

    ``$n.prop`` is a property of the root node, ``name.prop`` one of a bound variable.
    """

    text: str


@dataclass(frozen=True)
class SortKey:
    column: Column
    descending: bool = False

    def sort_column(self) -> Column:
        return self.column.desc_nulls_first() if self.descending else self.column.asc_nulls_last()


def flipped(value: Column, dtype: T.DataType) -> Column:
    """A value of the same kind that sorts the other way round."""
    if isinstance(dtype, T.IntegralType):
        return F.bitwise_not(value)
    if isinstance(dtype, T.BooleanType):
        return ~value
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.bitwise_not(F.unix_micros(value.cast("timestamp")))
    if isinstance(dtype, T.DateType):
        return F.bitwise_not(F.unix_date(value))
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return -value
    # text: complement the hexadecimal digits; the final G puts a prefix after its
    # continuations
    digits = F.translate(
        F.hex(F.encode(value.cast("string"), "UTF-8")), "0123456789ABCDEF", "FEDCBA9876543210"
    )
    return F.concat(digits, F.lit("G"))


def comparable(keys: Iterable[SortKey], frame: DataFrame, ties: Iterable[Column] = ()) -> Column:
    """One struct whose natural ascending order is the order of ``keys``."""
    fields: list[Column] = []
    for key in keys:
        if key.descending:
            dtype = frame.select(key.column.alias("k")).schema[0].dataType
            fields += [key.column.isNotNull(), flipped(key.column, dtype)]
        else:
            fields += [key.column.isNull(), key.column]
    fields += list(ties)
    return F.struct(*[f.alias(f"k{i}") for i, f in enumerate(fields)])
