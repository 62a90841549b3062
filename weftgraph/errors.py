"""Errors raised by getters, writes and class resolution."""


class DoesNotExist(LookupError):
    """A getter found no row."""


class MultipleNodesReturned(LookupError):
    """A getter found more than one row."""


class NodeClassNotDefined(LookupError):
    """A set of labels belongs to no declared node model."""


class RelationshipClassNotDefined(LookupError):
    """A relationship type is not part of the graph."""


class NotConnected(LookupError):
    """An edge that should be moved does not exist."""


class RequiredProperty(ValueError):
    """A required property is missing."""


class UniqueProperty(ValueError):
    """A unique value occurs twice."""


class CardinalityViolation(ValueError):
    """A node has too many or too few edges."""


class ConstraintViolation(ValueError):
    """Any other broken rule."""


class VersionConflict(RuntimeError):
    """Another writer published the same version of a store first."""
