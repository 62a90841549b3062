"""Property kinds of a node or edge model.

A property is a description only: it names a Spark type and knows how to turn a
raw column into a typed one (``typed``) and how to say that a raw column is not
acceptable (``bad``). Both work on whole columns, never on single values.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spatial reference ids of the four point systems.
POINT_SRID = {
    "cartesian": 7203,
    "cartesian-3d": 9157,
    "wgs-84": 4326,
    "wgs-84-3d": 4979,
}

# Strftime directives and their Java date pattern letters.
STRFTIME_TO_JAVA = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%I": "hh",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
    "%p": "a",
    "%b": "MMM",
    "%B": "MMMM",
    "%a": "EEE",
    "%A": "EEEE",
    "%j": "DDD",
    "%z": "xx",
    "%Z": "zzz",
    "%%": "%",
}

class VectorIndex:
    """Declares that a vector property is searchable, and by which similarity."""

    def __init__(self, dimensions: int = 1536, similarity_function: str = "cosine"):
        if similarity_function not in ("cosine", "euclidean"):
            raise ValueError("similarity_function must be 'cosine' or 'euclidean'")
        self.dimensions = dimensions
        self.similarity_function = similarity_function


class FulltextIndex:
    """Declares that a text property is searchable by terms."""

    def __init__(self, analyzer: str = "standard-no-stop-words"):
        self.analyzer = analyzer


class Property:
    """Common options of every property."""

    spark_type: T.DataType = T.StringType()

    def __init__(
        self,
        *,
        required: bool = False,
        default: Any = None,
        unique_index: bool = False,
        index: bool = False,
        db_property: str | None = None,
        vector_index: VectorIndex | None = None,
        fulltext_index: FulltextIndex | None = None,
    ):
        if required and default is not None:
            raise ValueError("a property is either required or has a default, not both")
        if unique_index and index:
            raise ValueError("unique_index and index exclude each other")
        self.required = required
        self.default = default
        self.unique_index = unique_index
        self.index = index
        self.db_property = db_property
        self.vector_index = vector_index
        self.fulltext_index = fulltext_index
        self.name = ""

    def __set_name__(self, owner: type, name: str) -> None:
        self.name = name

    @property
    def stored_name(self) -> str:
        return self.db_property or self.name

    @property
    def has_default(self) -> bool:
        return self.default is not None

    def default_column(self) -> Column:
        """The default as a column; a callable may return a value or a Column."""
        value = self.default() if callable(self.default) else self.default
        if isinstance(value, Column):
            return value
        if isinstance(value, (list, tuple)):
            return F.array(*[F.lit(v) for v in value]).cast(self.spark_type)
        return F.lit(value).cast(self.spark_type)

    def typed(self, raw: Column) -> Column:
        """The typed value; null where the raw value cannot be converted."""
        return raw.try_cast(self.spark_type)

    def bad(self, raw: Column) -> Column:
        """True where a present raw value is not acceptable."""
        return raw.isNotNull() & self.typed(raw).isNull()


class StringProperty(Property):
    def __init__(
        self,
        *,
        choices: dict[str, str] | None = None,
        max_length: int | None = None,
        **options: Any,
    ):
        super().__init__(**options)
        if choices is not None and max_length is not None:
            raise ValueError("choices and max_length exclude each other")
        if max_length is not None and max_length < 1:
            raise ValueError("max_length must be at least 1")
        self.choices = dict(choices) if choices else None
        self.max_length = max_length

    def typed(self, raw: Column) -> Column:
        return raw.cast("string")

    def bad(self, raw: Column) -> Column:
        text = raw.cast("string")
        if self.choices:
            return text.isNotNull() & ~text.isin(list(self.choices))
        if self.max_length:
            return text.isNotNull() & (F.length(text) > self.max_length)
        return F.lit(False)

    def display(self, raw: Column) -> Column:
        """The human label of each choice."""
        if not self.choices:
            return raw
        pairs = [F.lit(x) for pair in self.choices.items() for x in pair]
        return F.try_element_at(F.create_map(*pairs), raw)


class RegexProperty(Property):
    expression = ""

    def __init__(self, expression: str | None = None, **options: Any):
        super().__init__(**options)
        self.expression = expression or type(self).expression
        if not self.expression:
            raise ValueError("a regular expression is needed")

    def typed(self, raw: Column) -> Column:
        return raw.cast("string")

    def bad(self, raw: Column) -> Column:
        # a prefix match is enough: the pattern is anchored at the start only
        return raw.isNotNull() & ~raw.cast("string").rlike(r"\A(?:" + self.expression + ")")


class EmailProperty(RegexProperty):
    # Fixed value: the accepted shape of an address.
    expression = r"[^@]+@[^@]+\.[^@]+"


class IntegerProperty(Property):
    spark_type = T.LongType()


class FloatProperty(Property):
    """A decimal number, an infinity or not-a-number; no type suffixes, no hexadecimal form."""

    spark_type = T.DoubleType()

    def typed(self, raw: Column) -> Column:
        text = F.trim(raw.cast("string"))
        number = r"(?i)\A[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+)?\z"
        odd = r"(?i)\A[+-]?(inf|infinity|nan)\z"
        plain = F.when(text.rlike(number), F.replace(text, F.lit("_"), F.lit("")))
        unsigned = F.regexp_replace(F.lower(text), r"\A[+-](?=nan)", "")
        return F.when(text.rlike(odd), unsigned).otherwise(plain).try_cast("double")


class BooleanProperty(Property):
    """Truthiness: zero, the empty text and the empty list are false."""

    spark_type = T.BooleanType()

    def __init__(self, *, source_type: str = "string", **options: Any):
        super().__init__(**options)
        self.source_type = source_type

    def typed(self, raw: Column) -> Column:
        if self.source_type == "boolean":
            return raw
        if self.source_type == "string":
            return F.length(raw) > 0
        if self.source_type == "array":
            return F.size(raw) > 0
        return raw != 0

    def bad(self, raw: Column) -> Column:
        return F.lit(False)


class DateProperty(Property):
    spark_type = T.DateType()

    def typed(self, raw: Column) -> Column:
        text = F.substring_index(raw.cast("string"), "T", 1)
        shaped = F.when(text.rlike(r"\A\d{4}-\d{1,2}-\d{1,2}\z"), text)
        return F.try_to_date(shaped, "yyyy-M-d")


class _Moment(Property):
    spark_type = T.TimestampType()

    def __init__(self, *, default_now: bool = False, **options: Any):
        if default_now:
            if options.get("default") is not None:
                raise ValueError("too many defaults")
            options["default"] = F.current_timestamp
        super().__init__(**options)


class DateTimeProperty(_Moment):
    """Stored as seconds since the epoch in UTC."""

    def typed(self, raw: Column) -> Column:
        seconds = raw.try_cast("double")
        micros = F.round(seconds * 1_000_000).try_cast("bigint")
        return F.timestamp_micros(micros)

    def stored(self, value: Column) -> Column:
        return F.unix_micros(value.cast("timestamp")) / F.lit(1_000_000.0)


class DateTimeFormatProperty(_Moment):
    def __init__(self, *, format: str = "%Y-%m-%d", **options: Any):
        super().__init__(**options)
        self.format = format
        java, rest = "", format
        while rest:
            directive = rest[:2]
            if directive in STRFTIME_TO_JAVA:
                java, rest = java + STRFTIME_TO_JAVA[directive], rest[2:]
            elif rest[0].isalpha():
                java, rest = java + f"'{rest[0]}'", rest[1:]
            else:
                java, rest = java + rest[0], rest[1:]
        self.java_format = java

    def typed(self, raw: Column) -> Column:
        return F.try_to_timestamp(raw.cast("string"), F.lit(self.java_format))

    def stored(self, value: Column) -> Column:
        return F.date_format(value, self.java_format)


class DateTimeNativeProperty(_Moment):
    """Already a timestamp in the store."""


class JSONProperty(Property):
    # the parser stops after the first value; a second element behind the text proves
    # that the whole text was one value
    _END = "~end~"

    def __init__(self, *, ensure_ascii: bool = True, **options: Any):
        super().__init__(**options)
        self.ensure_ascii = ensure_ascii

    def _wrapped(self, raw: Column) -> Column:
        text = F.concat(F.lit("["), raw, F.lit(f',"{self._END}"]'))
        return F.try_parse_json(text)

    def _whole(self, raw: Column) -> Column:
        end = F.try_variant_get(self._wrapped(raw), "$[1]", "string")
        return F.coalesce(end == self._END, F.lit(False))

    def typed(self, raw: Column) -> Column:
        value = F.try_variant_get(self._wrapped(raw), "$[0]", "variant")
        return F.when(self._whole(raw), value)

    def bad(self, raw: Column) -> Column:
        return raw.isNotNull() & ~self._whole(raw)

    def stored(self, value: Column) -> Column:
        """JSON text, by default with all other characters than ASCII escaped."""
        text = F.to_json(value)
        if not self.ensure_ascii:
            return text

        def unit(code: Column) -> Column:
            return F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(code), 4, "0")))

        def escaped(ch: Column) -> Column:
            code = F.ascii(ch)
            high = F.lit(0xD7C0) + F.shiftright(code, 10)
            low = F.lit(0xDC00) + code.bitwiseAND(F.lit(0x3FF))
            return (
                F.when(code < 128, ch)
                .when(code < 0x10000, unit(code))
                .otherwise(F.concat(unit(high), unit(low)))
            )

        plain = text.rlike(r"\A\p{ASCII}*\z")
        letters = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
        return F.when(plain, text).otherwise(F.array_join(F.transform(letters, escaped), ""))


class ArrayProperty(Property):
    def __init__(self, base_property: Property | None = None, **options: Any):
        super().__init__(**options)
        if isinstance(base_property, ArrayProperty):
            raise TypeError("an array of arrays is not supported")
        for option in ("default", "index", "unique_index", "required"):
            if base_property is not None and getattr(base_property, option):
                raise ValueError(f"the element property cannot carry '{option}'")
        self.base_property = base_property
        element = base_property.spark_type if base_property else T.StringType()
        self.spark_type = T.ArrayType(element)

    def typed(self, raw: Column) -> Column:
        if self.base_property is None:
            return raw
        return F.transform(raw, self.base_property.typed)

    def bad(self, raw: Column) -> Column:
        wrong = F.lit(False)
        if self.base_property is not None:
            wrong = F.coalesce(F.exists(raw, self.base_property.bad), wrong)
        if self.vector_index is not None:
            wrong = wrong | F.coalesce(F.size(raw) != self.vector_index.dimensions, F.lit(False))
        return raw.isNotNull() & wrong


class UniqueIdProperty(Property):
    """A generated id: 32 hexadecimal characters, always filled."""

    def __init__(self, **options: Any):
        for forbidden in ("required", "unique_index", "index", "default"):
            if forbidden in options:
                raise ValueError(f"a unique id property has no '{forbidden}' option")
        super().__init__(**options)
        self.unique_index = True
        self.default = lambda: F.replace(F.uuid(), F.lit("-"), F.lit(""))


class AliasProperty(Property):
    """A second name for another property of the same model."""

    def __init__(self, to: str):
        super().__init__()
        self.to = to


class PointProperty(Property):
    """A struct of srid, x, y and z (z is null in two dimensions)."""

    spark_type = T.StructType(
        [
            T.StructField("srid", T.IntegerType()),
            T.StructField("x", T.DoubleType()),
            T.StructField("y", T.DoubleType()),
            T.StructField("z", T.DoubleType()),
        ]
    )

    def __init__(self, *, crs: str, **options: Any):
        super().__init__(**options)
        if crs not in POINT_SRID:
            raise ValueError(f"unknown coordinate system {crs!r}")
        self.crs = crs
        self.srid = POINT_SRID[crs]

    @staticmethod
    def inferred_srid(point: Column) -> Column:
        """A missing system is cartesian, in as many dimensions as there are."""
        flat, solid = POINT_SRID["cartesian"], POINT_SRID["cartesian-3d"]
        return F.coalesce(point["srid"], F.when(point["z"].isNull(), flat).otherwise(solid))

    def typed(self, raw: Column) -> Column:
        return F.when(
            raw.isNotNull(),
            F.struct(
                self.inferred_srid(raw).alias("srid"),
                raw["x"].alias("x"),
                raw["y"].alias("y"),
                raw["z"].alias("z"),
            ),
        )

    def bad(self, raw: Column) -> Column:
        solid = self.crs.endswith("-3d")
        no_number = raw["x"].isNull() | raw["y"].isNull()
        depth = raw["z"].isNull() if solid else raw["z"].isNotNull()
        return raw.isNotNull() & (
            (self.inferred_srid(raw) != self.srid) | no_number | depth
        )

    @staticmethod
    def same(a: Column, b: Column) -> Column:
        """Equal coordinates in the same system."""
        return (
            (PointProperty.inferred_srid(a) == PointProperty.inferred_srid(b))
            & (a["x"] == b["x"])
            & (a["y"] == b["y"])
            & a["z"].eqNullSafe(b["z"])
        )


class NormalizedProperty(Property):
    """A property whose values pass through a user function in both directions.

    The function maps a Column to a Column; a pandas UDF is one such function.
    """

    def __init__(self, normalize: Callable[[Column], Column] | None = None, **options: Any):
        super().__init__(**options)
        if normalize is not None:
            self.normalize = normalize

    def normalize(self, raw: Column) -> Column:
        raise NotImplementedError("give a normalize function or override normalize()")

    def typed(self, raw: Column) -> Column:
        return self.normalize(raw)
