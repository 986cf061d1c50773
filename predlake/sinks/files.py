"""A destination of our own by the Python Data Source API: JSON lines with a manifest for each batch.

Every task writes one file. The files of a batch become visible together, when the driver
writes the batch's manifest that names them; a task that fails deletes its file, and
files that no manifest names are never read, and deleted when their batch is committed or
aborted. A batch that is written again (a stream after a restart) replaces its manifest:
exactly once by batch id. Paths are those of ``pyarrow.fs``: a mounted folder
that driver and executors share, or a URI of an object store or HDFS.
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "logged_files"
MANIFESTS = "manifests"
STILL_S = 1.0   # after a failure: how long no task has made a file until none is expected any more

# Executors need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _place(url: str) -> tuple[fs.FileSystem, str]:
    files, path = fs.FileSystem.from_uri(url) if "://" in url or url.startswith("file:") else (fs.LocalFileSystem(), url)
    return files, path.rstrip("/")


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int


class FilesWriter(DataSourceArrowWriter):
    def __init__(self, url: str, batch: str) -> None:
        self.url, self.batch = url, batch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, path = _place(self.url)
        name, rows = f"batch={self.batch}/{uuid.uuid4().hex}.json", 0
        files.create_dir(f"{path}/batch={self.batch}", recursive=True)
        try:
            with files.open_output_stream(f"{path}/{name}") as out:
                for batch in iterator:
                    for row in batch.to_pylist():
                        out.write((json.dumps(row, default=str, ensure_ascii=False) + "\n").encode())
                    rows += batch.num_rows
        except BaseException:
            _delete(files, f"{path}/{name}")
            raise
        return Written(name, rows)

    def commit(self, messages: list[Written | None]) -> None:
        files, path = _place(self.url)
        done = [m for m in messages if m is not None]
        files.create_dir(f"{path}/{MANIFESTS}", recursive=True)
        hidden = f"{path}/{MANIFESTS}/_{uuid.uuid4().hex}"
        with files.open_output_stream(hidden) as out:
            out.write(json.dumps({"files": [m.name for m in done if m.rows], "rows": sum(m.rows for m in done)}).encode())
        files.move(hidden, f"{path}/{MANIFESTS}/{self.batch}.json")
        self._tidy(files, path)

    def abort(self, messages: list[Written | None]) -> None:
        self._tidy(*_place(self.url))

    def _tidy(self, files: fs.FileSystem, path: str) -> int:
        """Delete the batch's files that its manifest does not name: of tasks that were lost or repeated, or of an earlier attempt."""
        named = set(_manifest(files, f"{path}/{MANIFESTS}/{self.batch}.json"))
        found = [info.path for info in files.get_file_info(fs.FileSelector(f"{path}/batch={self.batch}", allow_not_found=True))
                 if f"batch={self.batch}/{info.base_name}" not in named]
        for name in found:
            _delete(files, name)
        return len(found)

    def settle(self) -> None:
        """After a failure: the batch is aborted while its other tasks are being killed, and one may make its file after that."""
        files, path = _place(self.url)
        until = time.monotonic() + STILL_S
        last = until + 10 * STILL_S
        while time.monotonic() < min(until, last):
            if self._tidy(files, path):
                until = time.monotonic() + STILL_S
            time.sleep(STILL_S / 10)


def _delete(files: fs.FileSystem, path: str) -> None:
    if files.get_file_info(path).type != fs.FileType.NotFound:
        files.delete_file(path)


def _manifest(files: fs.FileSystem, path: str) -> list[str]:
    if files.get_file_info(path).type == fs.FileType.NotFound:
        return []
    with files.open_input_stream(path) as f:
        return json.loads(f.read())["files"]


class LoggedFiles(DataSource):
    """``df.write.format("logged_files").option("url", ...).option("batch", ...)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> FilesWriter:
        return FilesWriter(self.options["url"], self.options["batch"])


def write_batch(rows: DataFrame, config: dict[str, Any], logger_name: str) -> str:
    """The rows of a batch under ``<url>/<logger_name>``; without a batch id in the config they are a batch of their own."""
    rows.sparkSession.dataSource.register(LoggedFiles)
    url = f"{config['url'].rstrip('/')}/{logger_name}"
    batch = uuid.uuid4().hex if config.get("batch") is None else f"{config['batch']:09d}"
    try:
        rows.write.format(FORMAT).mode("append").option("url", url).option("batch", batch).save()
    except Exception:
        FilesWriter(url, batch).settle()
        raise
    return url


def read_committed(spark: SparkSession, url: str, schema: StructType) -> DataFrame:
    """Rows of all batches that have a manifest."""
    files, path = _place(url)
    names = [n for info in files.get_file_info(fs.FileSelector(f"{path}/{MANIFESTS}", allow_not_found=True))
             if not info.base_name.startswith("_") for n in _manifest(files, info.path)]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json([f"{url}/{n}" for n in names])
