"""Stages with versions: each output in a folder of its own, a manifest, and an atomic pointer.

A stage is built into ``<root>/<name>/<version>/data``.  Its manifest, written when the data stands,
holds the row count, a digest of the rows, the stage's parameters and the digests of its inputs;
then the file ``CURRENT`` is replaced in one rename.  Readers follow the pointer, so a rebuild that
dies leaves the version of before in place, and nothing is deleted before its successor stands.

A stage is rebuilt if and only if the parameters or the digest of an input differ from its
manifest, or it has no version, or the caller asks.  As digests are of rows and not of files, a
rebuilt stage with the rows of before leaves the stages behind it as they are.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

POINTER, MANIFEST = "CURRENT", "manifest.json"


@dataclass(frozen=True)
class Stage:
    """``build`` gets the stage's inputs in order.  Inputs are names of stages or paths of tables."""

    build: Callable[..., DataFrame]
    inputs: Sequence[str] = ()
    params: Mapping[str, object] = field(default_factory=dict)
    partition_by: Sequence[str] = ()


class _Files:
    """The few file operations of a store, on whatever file system the root names."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm  # noqa: SLF001
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
        self.system = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def read(self, name: str) -> str | None:
        if not self.system.exists(self.path(name)):
            return None
        stream = self.system.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write beside and rename over, which readers see as one change."""
        draft = f"{name}.{uuid.uuid4().hex}"
        stream = self.system.create(self.path(draft), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.system.getUri(), self.conf)
        options = self.jvm.org.apache.hadoop.fs.Options.Rename
        several = self.jvm.java.lang.reflect.Array.newInstance(options.OVERWRITE.getClass(), 1)
        several[0] = options.OVERWRITE
        context.rename(self.system.makeQualified(self.path(draft)), self.system.makeQualified(self.path(name)), several)

    def folders(self, name: str) -> list[str]:
        if not self.system.exists(self.path(name)):
            return []
        return sorted(f.getPath().getName() for f in self.system.listStatus(self.path(name)) if f.isDirectory())

    def listing(self, name: str) -> list[tuple[str, int, int]]:
        """Name, length and time of every file below a path."""
        found, files = [], self.system.listFiles(self.path(name), True)
        while files.hasNext():
            one = files.next()
            found.append((one.getPath().toString(), one.getLen(), one.getModificationTime()))
        return sorted(found)

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)


def _hashable(column, kind: DataType):
    """A column that the row hash takes: maps and variants as text."""
    def odd(one: DataType) -> bool:
        if isinstance(one, ArrayType):
            return odd(one.elementType)
        if isinstance(one, StructType):
            return any(odd(f.dataType) for f in one.fields)
        return isinstance(one, (MapType, VariantType))

    if isinstance(kind, MapType):
        return F.to_json(F.array_sort(F.map_entries(column)))
    return F.to_json(F.struct(column)) if odd(kind) else column


def _digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class StageStore:
    """A graph of stages under one folder."""

    def __init__(self, spark: SparkSession, root: str, stages: Mapping[str, Stage]):
        self.spark, self.root, self.stages = spark, root.rstrip("/"), dict(stages)
        self.files = _Files(spark, self.root)
        self.built: list[str] = []

    def manifest(self, name: str) -> dict | None:
        """The manifest of the current version."""
        version = self.files.read(f"{self.root}/{name}/{POINTER}")
        text = version and self.files.read(f"{self.root}/{name}/{version}/{MANIFEST}")
        return json.loads(text) if text else None

    def read(self, name: str) -> DataFrame:
        """The rows of the current version, whether or not it is up to date."""
        held = self.manifest(name)
        if held is None:
            raise FileNotFoundError(f"stage {name!r} has no version")
        return self.spark.read.parquet(f"{self.root}/{name}/{held['version']}/data")

    def ensure(self, name: str, force: bool = False) -> DataFrame:
        """Bring a stage and all it reads up to date; ``force`` rebuilds this stage in any case."""
        self._ensure(name, force, {}, ())
        return self.read(name)

    def _ensure(self, name: str, force: bool, done: dict[str, str], above: tuple[str, ...]) -> str:
        """The digest of an input, after it has been brought up to date."""
        if name in done:
            return done[name]
        if name in above:
            raise ValueError(f"stages read each other: {' > '.join((*above, name))}")
        stage = self.stages.get(name)
        if stage is None:
            done[name] = _digest_of(json.dumps(self.files.listing(name)))
            return done[name]
        inputs = {one: self._ensure(one, False, done, (*above, name)) for one in stage.inputs}
        params = json.loads(json.dumps(dict(stage.params), sort_keys=True, default=str))
        held = self.manifest(name)
        if force or held is None or held["inputs"] != inputs or held["params"] != params:
            held = self._build(name, stage, inputs, params)
        done[name] = held["digest"]
        return done[name]

    def _build(self, name: str, stage: Stage, inputs: dict[str, str], params: dict) -> dict:
        version = uuid.uuid4().hex
        folder = f"{self.root}/{name}/{version}"
        rows = stage.build(*[self.read(one) if one in self.stages else self.spark.read.parquet(one) for one in stage.inputs])
        mark = F.xxhash64(*[_hashable(F.col(f"`{f.name}`"), f.dataType) for f in rows.schema.fields])
        seen = Observation()
        # Sums of hashes do not depend on the order of rows, and tell repeated rows apart.
        watched = rows.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.sum(mark.cast("decimal(38,0)")).alias("sum"),
            F.bit_xor(F.xxhash64(mark, F.lit(1))).alias("xor"),
        )
        writer = watched.write.mode("overwrite")
        if stage.partition_by:
            writer = writer.partitionBy(*stage.partition_by)
        writer.parquet(f"{folder}/data")
        marks = seen.get
        manifest = {
            "version": version, "rows": marks["rows"], "params": params, "inputs": inputs,
            "digest": _digest_of(f"{rows.schema.simpleString()} {marks['rows']} {marks['sum']} {marks['xor']}"),
            "files": [[path.rsplit("/", 1)[-1], size] for path, size, _ in self.files.listing(f"{folder}/data")],
        }
        self.files.replace(f"{folder}/{MANIFEST}", json.dumps(manifest))
        self.files.replace(f"{self.root}/{name}/{POINTER}", version)
        self.built.append(name)
        return manifest

    def stale(self) -> list[str]:
        """Stages that would be rebuilt now, those behind a stale one included.

        A stage behind a stale one may turn out current once that is rebuilt with the same rows.
        """
        found: list[str] = []

        def check(name: str) -> str:
            stage = self.stages.get(name)
            if stage is None:
                return _digest_of(json.dumps(self.files.listing(name)))
            inputs = {one: check(one) for one in stage.inputs}
            held = self.manifest(name)
            params = json.loads(json.dumps(dict(stage.params), sort_keys=True, default=str))
            if held is None or held["inputs"] != inputs or held["params"] != params:
                if name not in found:
                    found.append(name)
                return ""
            return held["digest"]

        for name in self.stages:
            check(name)
        return found

    def clean(self) -> list[str]:
        """Delete all versions but the current ones, half-built ones too; the folders deleted.

        Not while another job builds or reads an older version.
        """
        gone = []
        for name in self.stages:
            current = self.files.read(f"{self.root}/{name}/{POINTER}")
            for version in self.files.folders(f"{self.root}/{name}"):
                if version != current:
                    self.files.delete(f"{self.root}/{name}/{version}")
                    gone.append(f"{name}/{version}")
        return gone
