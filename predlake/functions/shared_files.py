"""Small files on the shared file system that decide something: created once, listed, deleted.

By Hadoop's file API, so any file system that Spark reads will do. A file appears whole
or not at all: it is written under a hidden name and renamed without overwriting, which
HDFS does atomically.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, folder: str):
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    path = hadoop.Path(folder)
    return hadoop, conf, path, path.getFileSystem(conf)


def create_once(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Create ``folder/name`` with ``text`` unless it exists: False where another writer was first."""
    hadoop, conf, path, files = _hadoop(spark, folder)
    hidden = hadoop.Path(path, f"_new-{uuid.uuid4().hex}")
    out = files.create(hidden, False)
    out.write(bytearray(text.encode()))
    out.close()
    none = spark._sc._gateway.new_array(hadoop.Options.Rename, 0)   # without OVERWRITE a rename never replaces a file
    try:
        hadoop.FileContext.getFileContext(files.getUri(), conf).rename(hidden, hadoop.Path(path, name), none)
        return True
    except Py4JJavaError as e:
        files.delete(hidden, False)
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise


def names_in(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names in a folder, hidden ones left out, with their sizes (of a folder: all files below it); empty where it is missing."""
    _, _, path, files = _hadoop(spark, folder)
    if not files.exists(path):
        return {}
    return {s.getPath().getName(): files.getContentSummary(s.getPath()).getLength() if s.isDirectory() else s.getLen()
            for s in files.listStatus(path) if not s.getPath().getName().startswith(("_", "."))}


def exists(spark: SparkSession, folder: str, name: str) -> bool:
    hadoop, _, path, files = _hadoop(spark, folder)
    return files.exists(hadoop.Path(path, name))


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that the caller made, with all below it."""
    _, _, path, files = _hadoop(spark, folder)
    files.delete(path, True)
