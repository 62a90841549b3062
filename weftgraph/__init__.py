"""Property-graph analytics on Spark DataFrames."""

from .functions.aggregates import (
    AnnotateFunction,
    Collect,
    Last,
    NodeNameResolver,
    RelationNameResolver,
    ScalarFunction,
    Size,
)
from .functions.lookups import Q
from .functions.ordering import RawExpr
from .functions.scoring import FulltextFilter, VectorFilter
from .model import (
    Cardinality,
    Direction,
    NodeModel,
    One,
    OneOrMore,
    Relationship,
    RelationshipFrom,
    RelationshipTo,
    RelModel,
    ZeroOrMore,
    ZeroOrOne,
)
from .operators.nodeset import NodeSet, Path, Traversal
from .properties import (
    AliasProperty,
    ArrayProperty,
    BooleanProperty,
    DateProperty,
    DateTimeFormatProperty,
    DateTimeNativeProperty,
    DateTimeProperty,
    EmailProperty,
    FloatProperty,
    FulltextIndex,
    IntegerProperty,
    JSONProperty,
    NormalizedProperty,
    PointProperty,
    RegexProperty,
    StringProperty,
    UniqueIdProperty,
    VectorIndex,
)
from .sources.graph import PropertyGraph

__all__ = [name for name in dir() if name[0].isupper()]
