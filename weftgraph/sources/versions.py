"""Versioned tables in Parquet: buckets by key, deltas beside them, one manifest per version.

A table is spread over buckets by a hash of one or more of its columns. A write adds a *segment*:
a folder with the changed rows of the touched buckets, where a row that is gone is kept as a mark.
The manifest of a version lists the segments that make it up. Segments have names of their own, so
that what a failed write left behind belongs to no version, and a version is there once its
manifest has been renamed into place, which only one of two writers can do. Readers merge a bucket's
base with the deltas after it; `compacted` rewrites buckets so that there is nothing to merge.
A *fresh* segment has only rows that were not there before, without marks: it is read beside the
base and nothing is merged for it, but what later deltas change of it.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce
from urllib.parse import quote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ConstraintViolation, VersionConflict
from .graph import col
from .session import checkpointed

BUCKET, GONE, TURN = "~bucket", "~gone", "~turn"


@dataclass(frozen=True)
class Segment:
    """A folder of rows and the bytes of each bucket that the version still reads from it."""

    folder: str
    base: bool
    buckets: dict[int, int]
    fresh: bool = False


@dataclass(frozen=True)
class TableState:
    """A table of a version: rows are told apart by `identity` and placed by a hash of `place`."""

    schema: str
    identity: str
    place: tuple[str, ...]
    segments: tuple[Segment, ...] = ()

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def size(self, buckets: Collection[int] | None = None) -> int:
        return sum(
            size
            for s in self.segments
            for b, size in s.buckets.items()
            if buckets is None or b in buckets
        )


@dataclass(frozen=True)
class Manifest:
    version: int
    buckets: int
    tables: dict[str, TableState]
    #: Names of the edge tables whose ends are known to exist.
    verified: tuple[str, ...] = ()

    def text(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def of(cls, text: str) -> Manifest:
        raw = json.loads(text)
        tables = {}
        for name, t in raw["tables"].items():
            segments = tuple(
                Segment(
                    s["folder"],
                    s["base"],
                    {int(b): n for b, n in s["buckets"].items()},
                    s.get("fresh", False),
                )
                for s in t["segments"]
            )
            tables[name] = TableState(t["schema"], t["identity"], tuple(t["place"]), segments)
        return cls(raw["version"], raw["buckets"], tables, tuple(raw["verified"]))


class Folder:
    """The files of a store, by the file system that Spark has for its path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._files = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def versions(self) -> list[int]:
        at = self._path("versions")
        if not self._files.exists(at):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(at)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int) -> Manifest:
        stream = self._files.open(self._path(f"versions/v{version:010d}.json"))
        try:
            return Manifest.of(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, manifest: Manifest) -> None:
        """Renames the finished manifest into place; fails if that version is there already."""
        name = f"versions/v{manifest.version:010d}.json"
        draft = self._path(f"drafts/{uuid4().hex}")
        out = self._files.create(draft, False)
        out.write(bytearray(manifest.text().encode()))
        out.close()
        self._files.mkdirs(self._path("versions"))
        context = self._hadoop.FileContext.getFileContext(draft.toUri(), self._conf)
        kind = getattr(self._hadoop, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 0)
        try:
            context.rename(draft, self._path(name), options)
        except Exception as failed:
            if self._files.exists(self._path(name)):
                raise VersionConflict(f"version {manifest.version} was written by another") from failed
            raise

    def sizes(self, segment: str) -> dict[int, int]:
        """Bytes of each bucket of a segment."""
        found = {}
        for entry in self._files.listStatus(self._path(segment)):
            name = entry.getPath().getName()
            if entry.isDirectory() and name.startswith(f"{BUCKET}="):
                files = self._files.listStatus(entry.getPath())
                found[int(name.split("=")[1])] = sum(f.getLen() for f in files)
        return found

    # -- rows -------------------------------------------------------------
    def write(
        self,
        name: str,
        rows: DataFrame,
        identity: str,
        base: bool,
        fresh: bool = False,
        moved: bool = True,
    ) -> Segment:
        """Rows with their bucket, sorted by it. Ranges split a bucket that holds very many rows;
        without `moved` each task writes a file for each bucket of its own rows, and no row travels."""
        at = f"data/{quote(name, safe='')}/{uuid4().hex}"
        keys = [col(BUCKET), col(identity)]
        rows = rows.repartitionByRange(*keys) if moved else rows
        files = rows.sortWithinPartitions(*keys).write.option("compression", "zstd")
        files.partitionBy(BUCKET).parquet(f"{self.path}/{at}")
        return Segment(at, base, self.sizes(at), fresh)

    def _rows(self, state: TableState, segment: Segment, buckets: Collection[int] | None) -> DataFrame | None:
        live = set(segment.buckets) if buckets is None else set(segment.buckets) & set(buckets)
        if not live:
            return None
        fields = [*state.struct().fields, T.StructField(BUCKET, T.IntegerType())]
        if not (segment.base or segment.fresh):
            fields.append(T.StructField(GONE, T.BooleanType()))
        rows = self.spark.read.schema(T.StructType(fields)).parquet(f"{self.path}/{segment.folder}")
        return rows.where(col(BUCKET).isin(sorted(live)))

    def read(self, state: TableState, buckets: Collection[int] | None = None) -> DataFrame:
        """The rows of some buckets (all if None) with their bucket, deltas merged in."""
        names, keys = state.struct().names, [state.identity, BUCKET]
        empty = self.spark.createDataFrame(
            [], T.StructType([*state.struct().fields, T.StructField(BUCKET, T.IntegerType())])
        )
        base, deltas = [], []
        for turn, segment in enumerate(state.segments):
            rows = self._rows(state, segment, buckets)
            if rows is not None:
                whole = segment.base or segment.fresh
                (base if whole else deltas).append(rows.withColumn(TURN, F.lit(turn)))
        empty = empty.withColumn(TURN, F.lit(0))
        whole = reduce(DataFrame.unionByName, base) if base else empty
        if not deltas:
            return whole.select(*map(col, [*names, BUCKET]))
        last = reduce(DataFrame.unionByName, deltas)
        if len(deltas) > 1:
            rest = F.struct(*[col(c) for c in [*names, GONE] if c != state.identity])
            last = last.groupBy(*map(col, keys)).agg(
                F.max_by(rest, col(TURN)).alias("~last"), F.max(TURN).alias(TURN)
            )
            last = last.select(*map(col, keys), "~last.*", col(TURN))
        # an id that was gone may be there again in a fresh segment after its mark
        after = last.select(*[col(c).alias(f"~d{c}") for c in [*keys, TURN]])
        same = [col(c) == col(f"~d{c}") for c in keys]
        kept = whole.join(after, [*same, col(TURN) < col(f"~d{TURN}")], "left_anti")
        added = last.where(~col(GONE)).select(*map(col, [*names, BUCKET]))
        return kept.select(*map(col, [*names, BUCKET])).unionByName(added)


def loose(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed at every depth: what every later write fits into."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, loose(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(loose(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(loose(kind.keyType), loose(kind.valueType))
    return kind


def bucket_of(columns: Sequence[Column], buckets: int) -> Column:
    """Bucket of a row; values count by their text, so that 1 of any width is in one bucket."""
    return F.pmod(F.xxhash64(*[c.cast("string") for c in columns]), F.lit(buckets)).cast("int")


def placed(state: TableState, rows: DataFrame, buckets: int) -> DataFrame:
    """Rows in the table's columns and types, with their bucket."""
    present = set(rows.columns)
    unknown = present - set(state.struct().names) - {BUCKET}
    if unknown:
        raise ConstraintViolation(f"the stored table has no columns {sorted(unknown)}")
    chosen = [
        (col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in state.struct().fields
    ]
    rows = rows.select(*chosen)
    return rows.withColumn(BUCKET, bucket_of([col(c) for c in state.place], buckets))


def differences(state: TableState, old: DataFrame, new: DataFrame, buckets: int) -> DataFrame:
    """What changes from old to new rows of the same buckets, once (a checkpoint).

    All columns of the table as they will be, their bucket, whether the row is gone or was not
    there before (`~new`), and the old row (`~old`). Both sides must tell rows apart by identity.
    """
    names = state.struct().names
    a = old.select(F.struct(*map(col, names)).alias("~old"), col(BUCKET).alias("~old_bucket"))
    a = a.withColumn("~old_id", col("~old")[state.identity])
    b = placed(state, new, buckets)
    same = (col("~old_id") == col(state.identity)) & (col("~old_bucket") == col(BUCKET))
    both = a.join(b, same, "full_outer")
    gone, fresh = col(state.identity).isNull(), col("~old_id").isNull()
    differs = reduce(
        lambda x, y: x | y, [~col("~old")[c].eqNullSafe(col(c)) for c in names], F.lit(False)
    )
    rows = both.where(gone | fresh | differs).select(
        *[
            F.coalesce(col(c), col("~old_id")).alias(c) if c == state.identity else col(c)
            for c in names
        ],
        F.coalesce(col(BUCKET), col("~old_bucket")).alias(BUCKET),
        gone.alias(GONE),
        fresh.alias("~new"),
        col("~old"),
    )
    rows = checkpointed(rows)
    twice = rows.groupBy(col(state.identity), col(BUCKET)).count().where("count > 1").first()
    if twice is not None:
        raise ConstraintViolation(f"{state.identity} {twice[0]} would be there {twice['count']} times")
    return rows


def lookup_rows(state: TableState, main: TableState, changes: DataFrame, buckets: int) -> DataFrame:
    """The delta of a copy of a table that is placed by other columns and has few."""
    names = state.struct().names
    was = changes.where(~col("~new")).select(*[col("~old")[c].alias(c) for c in names], GONE)
    now = changes.where(~col(GONE)).select(*map(col, names), col("~old"), col("~new"))
    before = placed(state, was.drop(GONE), buckets)
    after = placed(state, now.select(*map(col, names)), buckets)
    keys = [state.identity, BUCKET]
    # what is in the same bucket still is only written again, not marked as gone first
    left = before.join(after.select(*map(col, keys)), keys, "left_anti").withColumn(GONE, F.lit(True))
    stays = [col(f"~b~{c}").eqNullSafe(col(c)) for c in names]
    old = before.select(*[col(c).alias(f"~b~{c}") for c in names])
    came = after.join(old, reduce(lambda x, y: x & y, stays), "left_anti").withColumn(GONE, F.lit(False))
    return left.select(*map(col, [*names, BUCKET, GONE])).unionByName(
        came.select(*map(col, [*names, BUCKET, GONE]))
    )


def with_segment(state: TableState, segment: Segment) -> TableState:
    return replace(state, segments=(*state.segments, segment)) if segment.buckets else state


def compacted(folder: Folder, name: str, state: TableState, least: int) -> TableState:
    """Buckets that at least so many deltas have are written anew as a base; others stay."""
    found: dict[int, int] = {}
    for segment in state.segments:
        if not segment.base:
            for b in segment.buckets:
                found[b] = found.get(b, 0) + 1
    chosen = {b for b, n in found.items() if n >= least}
    if not chosen:
        return state
    fresh = folder.write(name, folder.read(state, chosen), state.identity, True)
    kept = []
    for segment in state.segments:
        rest = {b: n for b, n in segment.buckets.items() if b not in chosen}
        if rest:
            kept.append(replace(segment, buckets=rest))
    return replace(state, segments=(*kept, fresh))
