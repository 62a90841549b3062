"""A small graph of telescopes, stars and clusters, made from plain lists that tests can count in."""

from dataclasses import dataclass, field
from datetime import datetime, timedelta

from weftgraph import (
    ArrayProperty,
    DateTimeNativeProperty,
    IntegerProperty,
    NodeModel,
    PropertyGraph,
    RelationshipFrom,
    RelationshipTo,
    RelModel,
    StringProperty,
)

FIRST_NIGHT = datetime(2015, 3, 1)


class Observation(RelModel):
    night = DateTimeNativeProperty()
    observer = StringProperty()


class Telescope(NodeModel):
    name = StringProperty()
    aperture = IntegerProperty()
    stars = RelationshipTo("Star", "OBSERVED", model=Observation)


class Cluster(NodeModel):
    name = StringProperty()
    kinds = ArrayProperty(StringProperty())
    stars = RelationshipFrom("Star", "MEMBER OF")


class Star(NodeModel):
    name = StringProperty(unique_index=True)
    magnitude = IntegerProperty()
    telescopes = RelationshipFrom(Telescope, "OBSERVED", model=Observation)
    clusters = RelationshipTo(Cluster, "MEMBER OF")


def night(n):
    return FIRST_NIGHT + timedelta(days=n)


@dataclass
class Sky:
    """telescopes: (id, name, aperture); stars: (id, name, magnitude); clusters: (id, name, kinds);
    observed: (telescope, star, night number); members: (star, cluster)."""

    telescopes: list = field(default_factory=list)
    stars: list = field(default_factory=list)
    clusters: list = field(default_factory=list)
    observed: list = field(default_factory=list)
    members: list = field(default_factory=list)

    def graph(self, spark):
        def frame(rows, columns):
            return spark.createDataFrame(list(rows), columns)

        seen = [(i, t, s, night(n or 0), f"observer {i % 2}") for i, (t, s, n) in enumerate(self.observed)]
        belong = [(i, s, c) for i, (s, c) in enumerate(self.members)]
        ends = "edge_id long, src_id long, dst_id long"
        return (
            PropertyGraph(spark)
            .with_nodes(Star, frame(self.stars, "node_id long, name string, magnitude long"))
            .with_nodes(Telescope, frame(self.telescopes, "node_id long, name string, aperture long"))
            .with_nodes(
                Cluster,
                frame([(*c, None)[:3] for c in self.clusters], "node_id long, name string, kinds array<string>"),
            )
            .with_edges(
                "OBSERVED",
                frame(seen, f"{ends}, night timestamp, observer string"),
                src=Telescope,
                dst=Star,
                model=Observation,
            )
            .with_edges("MEMBER OF", frame(belong, ends), src=Star, dst=Cluster)
        )


def catalogue():
    """Seven stars of three clusters, one of them in two and one in none; four telescopes, one idle."""
    return Sky(
        telescopes=[(i, f"scope-{i}", a) for i, a in enumerate([8, 2, 30, 8])],
        stars=[(i, f"HD{100 + i}", m) for i, m in enumerate([4, 9, 1, 4, 7, 2, 9])],
        clusters=[(0, "Pleiades", ["open", "young"]), (1, "Hyades", ["open"]), (2, "Omega", ["globular"])],
        observed=[(0, 0, 5), (0, 1, 9), (0, 2, 40), (1, 0, 300), (1, 3, 2), (2, 5, 77), (2, 0, 12), (2, 6, 90)],
        members=[(0, 0), (1, 0), (2, 1), (3, 1), (3, 2), (5, 2), (6, 0)],
    )
