"""Rows flushed in slices by number or age, each with bounded retries (K7).

A task gathers rows and puts a slice in place when it has ``rows`` of them, or when the
first has waited ``seconds`` (looked at as rows arrive), and what is left at its end. A
slice that fails is tried again, up to ``retries`` times with growing pauses; then the task
fails, and Spark repeats it. Each attempt at a task has a folder of its own, which it
removes when it fails. One message a task goes to the driver, and the folders count once
the messages of all tasks are in one file there: a lost executor, an attempt that was
repeated, or a job that is aborted adds no row. A folder of an executor that was lost may
stay behind; it is not read.

The classes go to the workers by value: workers need pyarrow, but not this package.
"""

import json
import sys
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tallystream.streaming.journal import Journal
from tallystream.streaming.manifest import read_text

FLUSH_ROWS = 1000
FLUSH_SECONDS = 0.2
RETRIES = 5
PAUSE = 0.05
COMMITTED = "committed.json"

# Puts a slice at a path: file system, path, rows, number of the trial from 0.
Put = Callable[[pyarrow.fs.FileSystem, str, pa.Table, int], None]

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system of a path or address, and the path on it."""
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return pyarrow.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return pyarrow.fs.LocalFileSystem(), path


def put_parquet(files: pyarrow.fs.FileSystem, path: str, rows: pa.Table, trial: int) -> None:
    """A slice as a parquet file; a file that an earlier trial left is overwritten."""
    pyarrow.parquet.write_table(rows, path, filesystem=files)


def slices(
    batches: Iterable[pa.RecordBatch], rows: int, seconds: float, clock: Callable[[], float] = time.monotonic
) -> Iterator[pa.Table]:
    """The rows of the batches, in order, in tables of ``rows`` rows; fewer when the first
    has waited for ``seconds``, and at the end."""
    pending, waiting, since = [], 0, 0.0
    for batch in batches:
        while batch.num_rows:
            since = since if waiting else clock()
            part = batch.slice(0, rows - waiting)
            batch = batch.slice(part.num_rows)
            pending.append(part)
            waiting += part.num_rows
            if waiting == rows or clock() - since >= seconds:
                yield pa.Table.from_batches(pending)
                pending, waiting = [], 0
    if waiting:
        yield pa.Table.from_batches(pending)


@dataclass
class TaskSlices(WriterCommitMessage):
    """What one task has put in place."""

    folder: str
    rows: int
    slices: int
    retries: int


class SliceWriter(DataSourceArrowWriter):
    """One write of a frame: tasks put slices in place, the driver makes them count."""

    def __init__(self, options: dict, put: Put):
        self.path, self.put = options["path"].rstrip("/"), put
        self.rows = max(1, int(options.get("rows", FLUSH_ROWS)))
        self.seconds = float(options.get("seconds", FLUSH_SECONDS))
        self.retries = max(0, int(options.get("retries", RETRIES)))
        self.pause = float(options.get("pause", PAUSE))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskSlices:
        task = TaskContext.get()
        number = task.partitionId() if task else 0
        done = TaskSlices(f"task-{number}-{uuid.uuid4().hex}", 0, 0, 0)
        files, top = place(self.path)
        folder = f"{top}/{done.folder}"
        try:
            for part in slices(iterator, self.rows, self.seconds):
                if not done.slices:
                    files.create_dir(folder, recursive=True)
                done.retries += self._put(files, f"{folder}/slice-{done.slices}.parquet", part)
                done.slices += 1
                done.rows += part.num_rows
        except BaseException:
            self._remove([done])
            raise
        return done

    def _put(self, files: pyarrow.fs.FileSystem, path: str, part: pa.Table) -> int:
        """Put a slice in place; how often that had to be tried again."""
        for trial in range(self.retries + 1):
            try:
                self.put(files, path, part, trial)
                return trial
            except Exception:
                if trial == self.retries:
                    raise
                time.sleep(self.pause * 2**trial)

    def commit(self, messages: list) -> None:
        files, top = place(self.path)
        files.create_dir(top, recursive=True)
        tasks = [asdict(m) for m in messages if m is not None and m.slices]
        with files.open_output_stream(f"{top}/{COMMITTED}") as out:
            out.write(json.dumps(tasks).encode())

    def abort(self, messages: list) -> None:
        self._remove([m for m in messages if m is not None])

    def _remove(self, tasks: list) -> None:
        files, top = place(self.path)
        for task in tasks:
            folder = f"{top}/{task.folder}"
            if files.get_file_info(folder).type != pyarrow.fs.FileType.NotFound:
                files.delete_dir(folder)


def slice_sink(put: Put = put_parquet, sink: str = "slices") -> type[DataSource]:
    """A sink of a name that puts slices in place by ``put``, to be registered."""

    class SliceSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return sink

        def writer(self, schema: StructType, overwrite: bool) -> SliceWriter:
            return SliceWriter(self.options, put)

    return SliceSink


class SliceTable:
    """A table that batches of a stream are added to in slices, each batch once."""

    def __init__(self, root: str, put: Put = put_parquet, **settings):
        """``settings`` are ``rows``, ``seconds``, ``retries`` and ``pause``, in seconds."""
        self.journal, self.put, self.settings = Journal(root), put, settings

    def write(self, batch: DataFrame, query_id: str, batch_id: int) -> None:
        batch.sparkSession.dataSource.register(slice_sink(self.put))

        def flush(path: str) -> None:
            writer = batch.write.format("slices").mode("append").options(**self.settings)
            writer.option("path", path).save()

        self.journal.add(batch.sparkSession, batch_id, flush)

    def tasks(self, spark: SparkSession) -> list[dict]:
        """Folder, rows, slices and retries of each task whose rows count."""
        found = []
        for folder in self.journal.folders(spark):
            for task in json.loads(read_text(spark, f"{folder}/{COMMITTED}")):
                found.append({**task, "folder": f"{folder}/{task['folder']}"})
        return found

    def read(self, spark: SparkSession, schema: StructType) -> DataFrame:
        folders = [task["folder"] for task in self.tasks(spark)]
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*folders)
