"""A published log as a stream source with start policies.

The log is a folder of numbered pieces, each written by one Spark job and complete once
its ``_SUCCESS`` mark is there. A position in the log is the number of the last piece
taken. A consumer names its group; the source notes where a group began, beside the
log, so a group that starts for the first time is told apart from one that comes back:

* ``earliest``: a new group begins before the first piece.
* ``latest``: a new group begins after the last complete piece; coming back before its
  first batch was checkpointed, it still begins there and misses nothing in between.
* ``live``: every start without a checkpoint begins after the last complete piece,
  whatever the group took before (seek to end).

From the first batch on, positions come from the query's checkpoint, as for every source.
Files are read in the tasks, one task a file, as Arrow batches; only the list of files of
the pieces that a batch takes is made on the driver. A piece that retention removed while
it was still to be read stops the query, unless ``failOnDataLoss`` is ``false``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..runtime import sanitise

POLICIES = ("earliest", "latest", "live")
POSITION = "piece"  # column: number of the piece that a row was published in


def _at(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def published_pieces(spark: SparkSession, log: str) -> list[int]:
    """Numbers of the complete pieces, rising."""
    fs, root = _at(spark, log)
    if not fs.exists(root):
        return []
    folders = [s.getPath() for s in fs.listStatus(root) if s.isDirectory() and s.getPath().getName().startswith(f"{POSITION}=")]
    done = [f for f in folders if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
    return sorted(int(f.getName().split("=")[1]) for f in done)


def publish(frame: DataFrame, log: str) -> int:
    """Append ``frame`` to the log as its next piece; the piece's number. One publisher a log."""
    number = max(published_pieces(frame.sparkSession, log), default=0) + 1
    frame.write.mode("overwrite").parquet(f"{log.rstrip('/')}/{POSITION}={number}")
    return number


def read_log(
    spark: SparkSession, log: str, schema: T.StructType, group: str = "default", policy: str = "latest", fail_on_data_loss: bool = False
) -> DataFrame:
    """The log as a stream of ``schema`` and the piece of each row, from where ``policy`` lets ``group`` begin."""
    if policy not in POLICIES:
        raise ValueError(f"no start policy named {policy!r}; there are {', '.join(POLICIES)}")
    spark.dataSource.register(PublishedLog)
    reader = spark.readStream.format(PublishedLog.name()).schema(T.StructType([*schema.fields, T.StructField(POSITION, T.LongType())]))
    options = {"path": log, "group": group, "policy": policy, "failOnDataLoss": str(fail_on_data_loss).lower()}
    return reader.options(**options).load()


class PublishedLog(DataSource):
    """Stream source ``published_log``; options ``path``, ``group``, ``policy``, ``failOnDataLoss``."""

    @classmethod
    def name(cls) -> str:
        return "published_log"

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return PublishedLogReader(dict(self.options), [f.name for f in schema.fields])


@dataclass
class _File(InputPartition):
    path: str
    piece: int


class PublishedLogReader(DataSourceStreamReader):
    def __init__(self, options: dict, names: Sequence[str]):
        low = {k.lower(): v for k, v in options.items()}
        self.log, self.names = low["path"].rstrip("/"), list(names)
        self.group, self.policy = low.get("group", "default"), low.get("policy", "latest")
        self.strict = low.get("failondataloss", "true") == "true"

    def _store(self):
        """File system and folder of the log; Arrow reaches local disks, HDFS and the usual object stores."""
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.log) if "://" in self.log or self.log.startswith("file:") else (fs.LocalFileSystem(), self.log)

    def _pieces(self) -> dict[int, list[str]]:
        """Data files of every complete piece."""
        from pyarrow import fs

        store, root = self._store()
        pieces: dict[int, list[str]] = {}
        complete = set()
        for info in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            folder = info.path.rsplit("/", 2)[-2]
            if info.type != fs.FileType.File or not folder.startswith(f"{POSITION}="):
                continue
            number = int(folder.split("=")[1])
            if info.base_name == "_SUCCESS":
                complete.add(number)
            elif info.base_name.endswith(".parquet"):
                pieces.setdefault(number, []).append(info.path)
        return {n: sorted(pieces.get(n, [])) for n in sorted(complete)}

    def initialOffset(self) -> dict:
        begin = 0 if self.policy == "earliest" else max(self._pieces(), default=0)
        if self.policy == "live":
            return {POSITION: begin}
        store, root = self._store()
        note = f"{root}/_groups/{sanitise(self.group)}.json"
        try:
            with store.open_input_stream(note) as f:
                return json.loads(f.read())
        except FileNotFoundError:
            store.create_dir(f"{root}/_groups", recursive=True)
            with store.open_output_stream(note) as f:
                f.write(json.dumps({POSITION: begin}).encode())
            return {POSITION: begin}

    def latestOffset(self) -> dict:
        return {POSITION: max(self._pieces(), default=0)}

    def partitions(self, start: dict, end: dict) -> list[_File]:
        pieces = self._pieces()
        wanted = range(start[POSITION] + 1, end[POSITION] + 1)
        lost = [n for n in wanted if n not in pieces]
        if lost and self.strict:
            raise RuntimeError(f"pieces {lost} of {self.log} are gone; set failOnDataLoss to false to go on without them")
        return [_File(f, n) for n in wanted for f in pieces.get(n, [])]

    def read(self, partition: _File) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq

        store, _ = self._store()
        columns = [c for c in self.names if c != POSITION]
        with store.open_input_file(partition.path) as source:
            for batch in pq.ParquetFile(source).iter_batches(columns=columns):
                place = pa.array([partition.piece] * batch.num_rows, pa.int64())
                arrays = [place if c == POSITION else batch.column(c) for c in self.names]
                yield pa.RecordBatch.from_arrays(arrays, self.names)
