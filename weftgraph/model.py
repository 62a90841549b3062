"""Declared node and edge models.

Classes are only declarations: they are never instantiated. A node model names a
label, its properties and its relationships; an edge model names the properties of
one relationship type.
"""

from __future__ import annotations

from enum import IntEnum
from typing import Any

from .properties import AliasProperty, Property


class Direction(IntEnum):
    OUTGOING = 1
    INCOMING = -1
    EITHER = 0


class Cardinality:
    """How many edges of one relationship a node may have."""

    least = 0
    most: int | None = None


class ZeroOrMore(Cardinality):
    pass


class ZeroOrOne(Cardinality):
    most = 1


class OneOrMore(Cardinality):
    least = 1


class One(Cardinality):
    least = 1
    most = 1


def _declared(cls: type, kind: type) -> dict[str, Any]:
    found: dict[str, Any] = {}
    for base in reversed(cls.__mro__):
        for name, value in vars(base).items():
            if isinstance(value, kind):
                found[name] = value
            elif name in found:
                del found[name]
    return found


class RelModel:
    """Properties carried by the edges of one relationship type."""

    reserved = ("source", "target", "id", "element_id", "edge_id", "src_id", "dst_id")

    def __init_subclass__(cls, **kwargs: Any):
        super().__init_subclass__(**kwargs)
        clash = [n for n in cls.reserved if isinstance(vars(cls).get(n), Property)]
        if clash:
            raise ValueError(f"reserved edge property names: {clash}")

    @classmethod
    def properties(cls) -> dict[str, Property]:
        return {
            n: p for n, p in _declared(cls, Property).items() if not isinstance(p, AliasProperty)
        }

    @classmethod
    def property(cls, name: str) -> Property:
        declared = _declared(cls, Property)
        if name not in declared:
            raise ValueError(f"No such property {name} on {cls.__name__}")
        found = declared[name]
        return cls.property(found.to) if isinstance(found, AliasProperty) else found


class RelationshipDef:
    """One end of a relationship type as seen from a node model."""

    def __init__(
        self,
        target: type | str,
        rel_type: str | None,
        direction: Direction,
        model: type[RelModel] | None = None,
        cardinality: type[Cardinality] = ZeroOrMore,
    ):
        self._target = target
        self.rel_type = rel_type
        self.direction = direction
        self.model = model
        self.cardinality = cardinality
        self.name = ""

    def __set_name__(self, owner: type, name: str) -> None:
        self.name = name

    @property
    def target(self) -> type[NodeModel]:
        if isinstance(self._target, str):
            if self._target not in NodeModel.known:
                raise ValueError(f"no node model named {self._target!r} is declared")
            return NodeModel.known[self._target]
        return self._target


def RelationshipTo(target, rel_type, **options: Any) -> RelationshipDef:
    return RelationshipDef(target, rel_type, Direction.OUTGOING, **options)


def RelationshipFrom(target, rel_type, **options: Any) -> RelationshipDef:
    return RelationshipDef(target, rel_type, Direction.INCOMING, **options)


def Relationship(target, rel_type, **options: Any) -> RelationshipDef:
    return RelationshipDef(target, rel_type, Direction.EITHER, **options)


class NodeModel:
    """Base of all node models.

    ``__label__`` overrides the label (the class name by default);
    ``__abstract_node__ = True`` makes a class a mere carrier of properties;
    ``__optional_labels__`` lists further labels single nodes may have.
    """

    known: dict[str, type[NodeModel]] = {}
    __abstract_node__ = True
    __optional_labels__: tuple[str, ...] = ()

    def __init_subclass__(cls, **kwargs: Any):
        super().__init_subclass__(**kwargs)
        reserved = [n for n in vars(cls) if n in vars(NodeModel) and not n.startswith("__")]
        if reserved:
            raise ValueError(f"reserved names on a node model: {reserved}")
        if "__abstract_node__" not in vars(cls):
            cls.__abstract_node__ = False
        if "__label__" not in vars(cls):
            cls.__label__ = cls.__name__
        NodeModel.known[cls.__name__] = cls

    # -- labels -----------------------------------------------------------
    @classmethod
    def label_name(cls) -> str:
        return cls.__label__

    @classmethod
    def inherited_labels(cls) -> list[str]:
        """Own label first, then the labels of all concrete parents."""
        return [
            c.__label__
            for c in cls.__mro__
            if issubclass(c, NodeModel) and c is not NodeModel and not c.__abstract_node__
        ]

    # -- properties -------------------------------------------------------
    @classmethod
    def properties(cls) -> dict[str, Property]:
        return {
            n: p for n, p in _declared(cls, Property).items() if not isinstance(p, AliasProperty)
        }

    @classmethod
    def property(cls, name: str) -> Property:
        """A property by its name or by an alias of it."""
        declared = _declared(cls, Property)
        if name not in declared:
            raise ValueError(f"No such property {name} on {cls.__name__}")
        found = declared[name]
        return cls.property(found.to) if isinstance(found, AliasProperty) else found

    @classmethod
    def merge_keys(cls) -> list[str]:
        """The properties by which a batch upsert recognises a node."""
        return [n for n, p in cls.properties().items() if p.required or p.unique_index]

    # -- relationships ----------------------------------------------------
    @classmethod
    def relationships(cls) -> dict[str, RelationshipDef]:
        return _declared(cls, RelationshipDef)

    @classmethod
    def relationship(cls, name: str) -> RelationshipDef:
        declared = cls.relationships()
        if name not in declared:
            raise ValueError(f"No such relationship {name} on {cls.__name__}")
        return declared[name]
