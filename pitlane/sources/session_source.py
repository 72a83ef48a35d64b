"""S1 as a data source: landed sessions, one partition for each session asked for.

The landing layout is a folder per session (``session_id=521/*.parquet``). ``spark.read.format("landed_sessions")``
lists the folders only, keeps those that the pushed predicates on ``session_id`` allow, and makes each a
partition, which a task reads batch by batch. So a query for two sessions starts two tasks, and none
opens another session's file. Predicates on other columns stay with Spark.

The folder is opened through the file system its URI names, in the tasks too, so it must be one that pyarrow
reaches from every executor; ``landing.raw_laps`` is the reader for any other store.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql.types import StructType

from pitlane.schemas import RAW_LAPS

NAME = "landed_sessions"
COLUMN = "session_id"
_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    uri = uri.rstrip("/")
    if "://" not in uri and uri.startswith("file:"):  # Hadoop's short form
        uri = uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def session_folders(uri: str) -> dict[int, str]:
    """Session ids and their folders; a folder by another name is not the layout's."""
    fs, path = _open(uri)
    out = {}
    for f in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
        key, _, value = f.base_name.partition("=")
        if f.type == pafs.FileType.Directory and key == COLUMN and value.lstrip("-").isdigit():
            out[int(value)] = f.path
    return out


#: What a pushed predicate on the session id says; any other predicate is left to Spark.
_TESTS: dict[type, Callable] = {
    D.EqualTo: lambda x, v: x == v,
    D.EqualNullSafe: lambda x, v: x == v,
    D.GreaterThan: lambda x, v: x > v,
    D.GreaterThanOrEqual: lambda x, v: x >= v,
    D.LessThan: lambda x, v: x < v,
    D.LessThanOrEqual: lambda x, v: x <= v,
    D.In: lambda x, v: x in v,
}


class SessionPartition(D.InputPartition):
    def __init__(self, session_id: int, folder: str):
        super().__init__(session_id)
        self.folder = folder


class SessionReader(D.DataSourceReader):
    def __init__(self, uri: str, schema: StructType):
        self.uri, self.schema, self.pushed = uri, schema, []

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:
        for f in filters:
            if getattr(f, "attribute", None) == (COLUMN,) and type(f) in _TESTS and f.value is not None:
                self.pushed.append((type(f), f.value))
            elif not (isinstance(f, D.IsNotNull) and f.attribute == (COLUMN,)):  # a folder's session is known
                yield f

    def partitions(self) -> list[SessionPartition]:
        wanted = [
            SessionPartition(s, folder) for s, folder in sorted(session_folders(self.uri).items())
            if all(_TESTS[kind](s, v) for kind, v in self.pushed)
        ]
        return wanted or [SessionPartition(0, "")]  # a source has a partition at least: this one has no rows

    def read(self, partition: SessionPartition) -> Iterator[pa.RecordBatch]:
        if not partition.folder:
            return
        fs, _ = _open(self.uri)
        kinds = [(f.name, _ARROW[f.dataType.simpleString()]) for f in self.schema.fields]
        for info in sorted(fs.get_file_info(pafs.FileSelector(partition.folder, recursive=True)), key=lambda i: i.path):
            if info.type != pafs.FileType.File or not info.base_name.endswith(".parquet") or info.base_name[0] in "._":
                continue
            with fs.open_input_file(info.path) as f:
                for batch in pq.ParquetFile(f).iter_batches(batch_size=8192):
                    names = set(batch.schema.names)
                    columns = [
                        pa.array([partition.value] * batch.num_rows, kind) if name == COLUMN
                        else batch.column(batch.schema.get_field_index(name)).cast(kind) if name in names
                        else pa.nulls(batch.num_rows, kind)
                        for name, kind in kinds
                    ]
                    yield pa.RecordBatch.from_arrays(columns, [name for name, _ in kinds])


class SessionSource(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        return RAW_LAPS

    def reader(self, schema: StructType) -> SessionReader:
        return SessionReader(self.options["path"], schema)


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Landed raw laps of a folder; filter on ``session_id`` to read just those sessions."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SessionSource)
    return spark.read.format(NAME).load(path)
