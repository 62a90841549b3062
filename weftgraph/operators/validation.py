"""Typed conversion of raw columns, defaults, names and undeclared properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import NodeModel, RelModel
from ..properties import BooleanProperty, Property
from ..sources.graph import col

BAD = "bad_properties"

# The kinds of raw column that truth tests tell apart.
TRUTH_KINDS = {T.BooleanType: "boolean", T.StringType: "string", T.ArrayType: "array"}


def _for_column(prop: Property, dtype: T.DataType) -> Property:
    if isinstance(prop, BooleanProperty):
        kind = next((k for t, k in TRUTH_KINDS.items() if isinstance(dtype, t)), "number")
        return BooleanProperty(source_type=kind)
    return prop


def checked(model: type[NodeModel] | type[RelModel], raw: DataFrame) -> DataFrame:
    """Typed declared columns plus ``bad_properties``, the names of the refused ones."""
    chosen, bad = [], []
    declared = model.properties()
    for name in raw.columns:
        if name not in declared:
            chosen.append(col(name))
            continue
        prop = _for_column(declared[name], raw.schema[name].dataType)
        chosen.append(prop.typed(col(name)).alias(name))
        wrong = prop.bad(col(name))
        if declared[name].required:
            wrong = wrong | col(name).isNull()
        bad.append(F.when(wrong, F.lit(name)))
    refused = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    return raw.select(*chosen, refused.alias(BAD))


def validated(model, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The typed good rows, and the raw bad rows with the names of what is wrong."""
    typed = checked(model, raw)
    good = typed.where(F.size(BAD) == 0).drop(BAD)
    declared = model.properties()
    wrong = []
    for name in raw.columns:
        if name in declared:
            prop = _for_column(declared[name], raw.schema[name].dataType)
            broken = prop.bad(col(name))
            if declared[name].required:
                broken = broken | col(name).isNull()
            wrong.append(F.when(broken, F.lit(name)))
    named = raw.withColumn(BAD, F.array_compact(F.array(*wrong)))
    return good, named.where(F.size(BAD) > 0)


def bad_counts(model, raw: DataFrame) -> DataFrame:
    """``property, good, bad``: one pass, counted before the shuffle."""
    typed = checked(model, raw)
    names = [n for n in raw.columns if n in model.properties()]
    flags = F.array(
        *[
            F.struct(
                F.lit(n).alias("property"), F.array_contains(col(BAD), n).alias("wrong")
            )
            for n in names
        ]
    )
    return (
        typed.select(F.explode(flags).alias("f"))
        .groupBy(col("f")["property"].alias("property"))
        .agg(
            F.count_if(~col("f")["wrong"]).alias("good"),
            F.count_if(col("f")["wrong"]).alias("bad"),
        )
    )


def with_defaults(model, frame: DataFrame) -> DataFrame:
    """Missing values and missing columns take their declared defaults."""
    filled = {}
    for name, prop in model.properties().items():
        if prop.has_default:
            present = name in frame.columns
            value = prop.default_column()
            filled[name] = F.coalesce(col(name), value) if present else value
    return frame.withColumns(filled) if filled else frame


def to_stored(model, frame: DataFrame) -> DataFrame:
    names = {n: p.stored_name for n, p in model.properties().items()}
    return frame.withColumnsRenamed({n: s for n, s in names.items() if n in frame.columns})


def from_stored(model, frame: DataFrame) -> DataFrame:
    names = {p.stored_name: n for n, p in model.properties().items()}
    return frame.withColumnsRenamed({s: n for s, n in names.items() if s in frame.columns})


def display(model, frame: DataFrame, name: str) -> DataFrame:
    """Adds ``<name>_display``, the label of each choice."""
    return frame.withColumn(f"{name}_display", model.property(name).display(col(name)))


def split_extras(
    model, frame: DataFrame, extras: str | None = None, fixed: tuple[str, ...] = ("node_id",)
) -> tuple[DataFrame, DataFrame]:
    """Semi-structured rows: declared columns beside a map of everything undeclared.

    Undeclared columns, and the map column ``extras`` if named, go into ``extras``.
    A map key that is also a declared name is a conflict; those rows are returned apart.
    """
    declared = set(model.properties()) | set(fixed)
    others = [c for c in frame.columns if c not in declared and c != extras]
    entries = F.array_compact(
        F.array(
            *[
                F.when(
                    col(c).isNotNull(),
                    F.struct(F.lit(c).alias("key"), col(c).cast("string").alias("value")),
                )
                for c in others
            ]
        )
    ) if others else None
    merged: Column | None = F.map_from_entries(entries) if entries is not None else None
    if extras is not None:
        given = col(extras)
        merged = given if merged is None else F.map_concat(merged, given)
    if merged is None:
        merged = F.create_map().cast("map<string,string>")
    clash = F.lit(False)
    if extras is not None:
        names = F.array(*[F.lit(n) for n in sorted(declared)])
        clash = F.coalesce(F.arrays_overlap(F.map_keys(col(extras)), names), clash)
    kept = [col(c) for c in frame.columns if c in declared]
    good = frame.where(~clash).select(*kept, merged.alias("extras"))
    return good, frame.where(clash)
