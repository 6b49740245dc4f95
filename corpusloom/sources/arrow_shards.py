"""Folders of Arrow stream shards as a Spark source and sink.

A stored dataset is a folder of ``data-00000-of-00003.arrow`` files, each an Arrow IPC stream, with
``state.json`` listing them.  ``spark.read.format("arrow_shards")`` reads such a folder, one
partition a shard, record batch by record batch, so no shard is held whole; the schema is that of
the first shard and later shards are cast to it.  Shards that the names count but the folder lacks
are passed over, or refused with ``option("missing", "error")``.

``df.write.format("arrow_shards")`` writes one shard a partition.  A task writes under the name of
its own attempt; the shards get their names, and ``state.json`` its list, when all tasks are done.
With ``overwrite`` the shards of before are deleted only then.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

FORMAT = "arrow_shards"
STATE = "state.json"
# Rows of one record batch handed to Spark or written.
BATCH_ROWS = 4096

_NAME = re.compile(r"(.*)-(\d{5,})-of-(\d{5,})\.arrow$")


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path.removeprefix("file:"))


def shard_files(path: str) -> list[str]:
    """The shards of a folder in name order, or the path itself where it is a file."""
    system, root = _file_system(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return [path]
    if info.type != fs.FileType.Directory:
        raise FileNotFoundError(f"no shards at {path}")
    found = system.get_file_info(fs.FileSelector(root))
    names = sorted(f.base_name for f in found if f.type == fs.FileType.File and f.extension == "arrow" and f.base_name[0] not in "_.")
    return [f"{path.rstrip('/')}/{name}" for name in names]


def missing_shards(path: str) -> list[str]:
    """Shards that the names of the others count and the folder does not hold."""
    held = [os.path.basename(name) for name in shard_files(path)]
    wanted = set()
    for name in held:
        if named := _NAME.match(name):
            stem, number, total = named.groups()
            wanted |= {f"{stem}-{k:0{len(number)}d}-of-{total}.arrow" for k in range(int(total))}
    return sorted(wanted.difference(held))


def _open(path: str):
    """A reader of the record batches of a shard, whether it is a stream or has a footer."""
    system, name = _file_system(path)
    source = system.open_input_file(name)
    if source.read(6) == b"ARROW1":
        file = pa.ipc.open_file(source)
        return file.schema, (file.get_batch(k) for k in range(file.num_record_batches))
    source.seek(0)
    stream = pa.ipc.open_stream(source)
    return stream.schema, stream


@dataclass
class Shard(InputPartition):
    path: str


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, paths: list[str]):
        self.schema, self.paths = to_arrow_schema(schema), paths

    def partitions(self) -> list[Shard]:
        return [Shard(path) for path in self.paths]

    def read(self, partition: Shard | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        schema, batches = _open(partition.path)
        for batch in batches:
            columns = [
                batch.column(schema.get_field_index(field.name)).cast(field.type)
                if field.name in schema.names else pa.nulls(batch.num_rows, field.type)
                for field in self.schema
            ]
            whole = pa.RecordBatch.from_arrays(columns, names=self.schema.names)
            for first in range(0, whole.num_rows, BATCH_ROWS):
                yield whole.slice(first, BATCH_ROWS)


@dataclass
class Written(WriterCommitMessage):
    path: str
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, schema: StructType, path: str, overwrite: bool):
        self.schema, self.path, self.overwrite = to_arrow_schema(schema), path, overwrite
        self.before = []
        system, root = _file_system(path)
        if system.get_file_info(root).type == fs.FileType.Directory:
            self.before = [os.path.basename(name) for name in shard_files(path)]
        if self.before and not overwrite:
            raise FileExistsError(f"{path} already holds shards")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = _file_system(self.path)
        system.create_dir(root, recursive=True)
        own, rows = f"{root}/_attempt-{uuid.uuid4().hex}", 0
        with system.open_output_stream(own) as sink, pa.ipc.new_stream(sink, self.schema) as stream:
            for batch in iterator:
                rows += batch.num_rows
                for first in range(0, batch.num_rows, BATCH_ROWS):
                    stream.write_batch(pa.RecordBatch.from_arrays(batch.slice(first, BATCH_ROWS).columns, schema=self.schema))
        if not rows:
            system.delete_file(own)
        return Written(own, rows)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _file_system(self.path)
        full = [message for message in messages if message is not None and message.rows]
        if not full:
            # A table without rows still has a schema.
            system.create_dir(root, recursive=True)
            own = f"{root}/_attempt-{uuid.uuid4().hex}"
            with system.open_output_stream(own) as sink, pa.ipc.new_stream(sink, self.schema):
                pass
            full = [Written(own, 0)]
        names = [f"data-{k:05d}-of-{len(full):05d}.arrow" for k in range(len(full))]
        for message, name in zip(full, names):
            system.move(message.path, f"{root}/{name}")
        state = {"_data_files": [{"filename": name} for name in names], "rows": [message.rows for message in full]}
        with system.open_output_stream(f"{root}/{STATE}") as sink:
            sink.write(json.dumps(state).encode())
        for name in set(self.before).difference(names):
            system.delete_file(f"{root}/{name}")
        self._sweep(system, root)

    def abort(self, messages: list[Written | None]) -> None:
        system, root = _file_system(self.path)
        if system.get_file_info(root).type == fs.FileType.Directory:
            self._sweep(system, root)

    @staticmethod
    def _sweep(system: fs.FileSystem, root: str) -> None:
        """Delete what attempts that did not count have left."""
        for left in system.get_file_info(fs.FileSelector(root)):
            if left.base_name.startswith("_attempt-"):
                system.delete_file(left.path)


class ArrowShards(DataSource):
    """``path`` or a list of paths, each a folder of shards or one shard."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _paths(self) -> list[str]:
        several = self.options.get("paths")
        return json.loads(several) if several else [self.options["path"]]

    def _shards(self) -> list[str]:
        if self.options.get("missing", "skip") == "error":
            lost = [name for path in self._paths() if not path.endswith(".arrow") for name in missing_shards(path)]
            if lost:
                raise FileNotFoundError(f"shards are missing: {lost}")
        found = [shard for path in self._paths() for shard in shard_files(path)]
        if not found:
            raise FileNotFoundError(f"no shards at {self._paths()}")
        return found

    def schema(self) -> StructType:
        return from_arrow_schema(_open(self._shards()[0])[0])

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(schema, self._shards())

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(schema, self._paths()[0], overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session; again costs nothing."""
    spark.dataSource.register(ArrowShards)
