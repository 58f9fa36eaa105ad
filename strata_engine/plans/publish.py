"""Versioned publish of layers.

A run writes a layer into a folder of its own and, when all of it is there,
puts down a small manifest under the next number: which folders make up the
version, its schema, what it was built from and its counts. Readers go by the
newest manifest, so they see a whole version or the one before it, never half
a layer; what a killed run has left is named by no manifest. A rerun goes on
after the last layer whose manifest still holds for its inputs. Some
partitions can be replaced: the new version then names the new directories of
those and the old directories of the others, and no other file is touched.

Layout: ``<root>/<layer>/strata_version=<number>-<tag>/...`` for data and
``<root>/<layer>/_manifests/<number>.json``.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from strata_engine.operators.verdicts import FAILED, KEPT, QUARANTINED, VERDICT
from strata_engine.plans.layers import Layer, LayerResult, run_layer

VERSION = "strata_version"
_MANIFEST = re.compile(r"(\d{10})\.json")


class NotPublished(LookupError):
    """A layer has no (such) version."""


class PublishConflict(RuntimeError):
    """Another run has put down the same version number."""


@dataclass
class Manifest:
    layer: str
    number: int
    folders: list[str]  # below the layer's folder: a version's, or its partitions'
    schema: str  # JSON
    partition_by: list[str]
    inputs: dict[str, str]  # what the build looked at -> its identity then
    definition: str  # digest of the layer's declaration
    quarantine: bool = False
    counts: dict = field(default_factory=dict)


class _Store:
    """The few file operations that publishing needs, on any file system
    Spark can write to."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm, self.base = spark._jvm, base.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def names(self, name: str, folders: bool | None = None) -> list[str]:
        """Names in a folder (none if it is not there)."""
        if not self.exists(name):
            return []
        found = self.fs.listStatus(self._path(name))
        return sorted(x.getPath().getName() for x in found if folders is None or x.isDirectory() == folders)

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """A whole file under a new name: written aside, then renamed."""
        aside = f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        stream = self.fs.create(self._path(aside), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.exists(name) or not self.fs.rename(self._path(aside), self._path(name)):
            self.fs.delete(self._path(aside), False)
            raise PublishConflict(f"{self.base}/{name} is there already")

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def _numbers(store: _Store) -> list[int]:
    return sorted(int(m[1]) for m in map(_MANIFEST.fullmatch, store.names("_manifests", folders=False)) if m)


def _load(store: _Store, number: int) -> Manifest | None:
    """The manifest, or None if it cannot be read or a folder of it is gone."""
    try:
        found = Manifest(**json.loads(store.read(f"_manifests/{number:010d}.json")))
    except (ValueError, TypeError):
        return None
    return found if all(store.exists(f) for f in found.folders) else None


def latest(spark: SparkSession, root: str, name: str, number: int | None = None) -> Manifest | None:
    """The newest valid manifest of a layer (or the one of that number)."""
    store = _Store(spark, f"{root}/{name}")
    numbers = _numbers(store) if number is None else [number] if number in _numbers(store) else []
    return next((m for m in (_load(store, n) for n in reversed(numbers)) if m is not None), None)


def read(spark: SparkSession, root: str, name: str, number: int | None = None, quarantined: bool = False) -> DataFrame:
    """The newest version of a layer, or an older one by number; with
    ``quarantined`` the rows that its rules turned away."""
    found = latest(spark, root, name, number)
    if found is None:
        raise NotPublished(f"{root}/{name} has no version{'' if number is None else f' {number}'}")
    return _frame(spark, root, found, quarantined)


def _frame(spark: SparkSession, root: str, m: Manifest, quarantined: bool = False) -> DataFrame:
    schema = StructType.fromJson(json.loads(m.schema))
    if quarantined and not m.quarantine:
        raise NotPublished(f"layer {m.layer} keeps no rows that fail its rules")
    whole = StructType([*schema.fields, StructField(VERSION, StringType())])
    if m.quarantine:
        whole = StructType([*whole.fields, *StructType.fromDDL(f"{FAILED} array<string>, {VERDICT} string").fields])
    columns = [f"`{c}`" for c in schema.fieldNames()]
    if not m.folders:
        empty = spark.createDataFrame([], whole)
        return empty.select(*columns, *([FAILED] if quarantined else []))
    base = f"{root}/{m.layer}"
    frame = spark.read.schema(whole).option("basePath", base).parquet(*[f"{base}/{f}" for f in m.folders])
    if m.quarantine:
        frame = frame.where(frame[VERDICT] == (QUARANTINED if quarantined else KEPT))
    return frame.select(*columns, *([FAILED] if quarantined else []))


def definition(layer: Layer) -> str:
    """Digest of what a layer declares: rules, schema, layout, revision and
    the source text of its build function."""
    try:
        source = inspect.getsource(layer.build)
    except (OSError, TypeError):
        source = getattr(layer.build, "__qualname__", repr(type(layer.build)))
    schema = layer.schema if layer.schema is None or isinstance(layer.schema, str) else layer.schema.json()
    told = [
        dict(layer.rules), dict(layer.warn_rules), schema, list(layer.partition_by), layer.schema_mode, layer.compression,
        layer.drop_nulls, layer.quarantine, layer.revision, source,
    ]
    return hashlib.sha256(json.dumps(told).encode()).hexdigest()


def source_identity(df: DataFrame) -> str:
    """Digest of the files behind a source (path, size, time of change; one
    listing per folder); of a source without files, its plan's hash."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    wanted: dict[str, set[str]] = {}
    for file in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        wanted.setdefault(path.getParent().toString(), set()).add(path.getName())
    if not wanted:
        return f"plan:{df.semanticHash()}"
    seen = []
    for folder, names in wanted.items():
        path = jvm.org.apache.hadoop.fs.Path(folder)
        for x in path.getFileSystem(conf).listStatus(path):
            if (name := x.getPath().getName()) in names:
                seen.append(f"{folder}/{name} {x.getLen()} {x.getModificationTime()}")
    return "files:" + hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()


class _Seen(Mapping):
    """Frames by name, remembering which were asked for."""

    def __init__(self, frames: Mapping[str, DataFrame]):
        self.frames, self.names = frames, set()

    def __getitem__(self, name: str) -> DataFrame:
        frame = self.frames[name]
        self.names.add(name)
        return frame

    def __iter__(self) -> Iterator[str]:
        return iter(self.frames)

    def __len__(self) -> int:
        return len(self.frames)


def _partitions(store: _Store, folder: str, depth: int) -> list[str]:
    """Partition directories ``depth`` levels below a folder."""
    if not depth:
        return [folder]
    return [x for n in store.names(folder, folders=True) if "=" in n for x in _partitions(store, f"{folder}/{n}", depth - 1)]


def publish(
    spark: SparkSession,
    layer: Layer,
    inputs: Mapping[str, DataFrame],
    root: str,
    identities: Mapping[str, str] | None = None,
    partitions_only: bool = False,
) -> LayerResult:
    """Run a layer into a new version and put down its manifest last.

    With ``partitions_only`` the partitions that the run writes replace those
    of the same values, and the others stay as the last version has them
    (``inputs`` then hold the rows of the partitions to replace; a layer
    without ``partition_by`` or without a version is refused). ``identities``
    are those of the inputs; by default they are taken here."""
    store = _Store(spark, f"{root}/{layer.name}")
    before = latest(spark, root, layer.name)
    levels = [*([VERDICT] if layer.quarantine else []), *layer.partition_by]
    if partitions_only:
        if not layer.partition_by:
            raise ValueError(f"layer {layer.name} is not partitioned")
        if before is None:
            raise NotPublished(f"layer {layer.name} has no version to change")
        if before.partition_by != list(layer.partition_by) or before.quarantine != layer.quarantine:
            raise ValueError(f"layer {layer.name} was published with another layout")
    number = max(_numbers(store), default=0) + 1
    folder = f"{VERSION}={number}-{uuid.uuid4().hex[:8]}"
    seen = _Seen(inputs)
    result = run_layer(spark, layer, seen, root, path=f"{store.base}/{folder}")
    folders = [folder] if not levels or _partitions(store, folder, len(levels)) else []
    if partitions_only:
        schema = result.frame.schema.json()
        if json.loads(schema) != json.loads(before.schema):
            raise ValueError(f"layer {layer.name} was published with another schema")
        # a partition's values are the path below its version's folder; all
        # of a partition goes, also what only its quarantine holds
        value = lambda f: tuple(f.split("/")[1 + len(levels) - len(layer.partition_by) :])
        fresh = _partitions(store, folder, len(levels))
        gone = {value(f) for f in fresh}
        kept = [p for f in before.folders for p in _partitions(store, f, len(levels) - f.count("/"))]
        folders = sorted([f for f in kept if value(f) not in gone] + fresh)
    known = dict(identities or {})
    told = {n: known[n] if n in known else source_identity(inputs[n]) for n in sorted(seen.names)}
    if partitions_only:
        told = before.inputs  # what the rest of the layer was built from
    manifest = Manifest(
        layer.name, number, folders, result.frame.schema.json(), list(layer.partition_by), told, definition(layer), layer.quarantine,
        {"rows_in": result.rows_in, "rows_out": result.rows_out, "failed": result.failed, "warned": result.warned, "lost": result.lost},
    )
    store.put(f"_manifests/{number:010d}.json", json.dumps(asdict(manifest)))
    return _result(spark, root, manifest, resumed=False)


def _result(spark: SparkSession, root: str, m: Manifest, resumed: bool) -> LayerResult:
    c = m.counts
    away = _frame(spark, root, m, quarantined=True) if m.quarantine else None
    return LayerResult(
        m.layer, _frame(spark, root, m), f"{root}/{m.layer}", c["rows_in"], c["rows_out"], c["failed"], c["warned"], c["lost"],
        away, m.number, resumed,
    )


def run_published(
    spark: SparkSession,
    layers: Sequence[Layer],
    root: str,
    sources: Mapping[str, DataFrame],
    upto: str | None = None,
    force: bool = False,
) -> dict[str, LayerResult]:
    """Run layers in order as versions. A layer whose newest manifest has the
    same definition and the same inputs (source files, versions of earlier
    layers) is taken as it is, so a run that was killed goes on where it
    ended and an unchanged plan runs nothing; ``force`` runs all."""
    frames, identities = dict(sources), {}
    results: dict[str, LayerResult] = {}

    def identity(name: str) -> str | None:
        if name not in identities and name in sources:
            identities[name] = source_identity(sources[name])
        return identities.get(name)

    for layer in layers:
        last = None if force else latest(spark, root, layer.name)
        same = last is not None and last.definition == definition(layer) and all(identity(n) == v for n, v in last.inputs.items())
        if same:
            result = _result(spark, root, last, resumed=True)
        else:
            for name in sources:
                identity(name)
            result = publish(spark, layer, frames, root, identities)
        results[layer.name] = result
        frames[layer.name] = result.frame
        identities[layer.name] = f"version:{result.version}"
        if layer.name == upto:
            break
    return results


def prune(spark: SparkSession, root: str, name: str, keep: int = 2) -> list[str]:
    """Delete the manifests of a layer but the newest ``keep`` valid ones, and
    the version folders that none of those names (also what killed runs have
    left). Folders of a number above the newest manifest stay: their run may
    still be going. Returns the deleted folders."""
    store = _Store(spark, f"{root}/{name}")
    valid = [m for m in (_load(store, n) for n in reversed(_numbers(store))) if m is not None][: max(1, keep)]
    if not valid:
        return []
    used = {f.split("/")[0] for m in valid for f in m.folders}
    for n in _numbers(store):
        if n < valid[0].number and n not in {m.number for m in valid}:
            store.delete(f"_manifests/{n:010d}.json")
    found = re.compile(rf"{VERSION}=(\d+)-\w+")
    old = [f for f in store.names("", folders=True) if (m := found.fullmatch(f)) and int(m[1]) <= valid[0].number and f not in used]
    for f in old:
        store.delete(f)
    return old
