"""Small notes beside a table: which step a job has finished, what is still due.

A note is a file of a few bytes in a folder, written and listed through the
Hadoop file system, so it stands wherever the table stands.  ``claim`` makes a
note only if there is none of that name, which the file system decides in one
step: of several jobs that try, one gets it.
"""

from __future__ import annotations

import uuid

from pyspark.errors.exceptions.captured import CapturedException
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem API
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001


def claim(spark: SparkSession, folder: str, name: str, text: str = "") -> bool:
    """Make the note ``name`` unless it exists; whether this call made it."""
    path, fs = _at(spark, f"{folder.rstrip('/')}/{name}")
    try:
        out = fs.create(path, False)
    except (CapturedException, Py4JJavaError) as x:
        # the note that was in the way may have been removed since
        if "FileAlreadyExistsException" in str(x) or fs.exists(path):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def put(spark: SparkSession, folder: str, name: str, text: str = "") -> None:
    """Make or replace a note."""
    path, fs = _at(spark, f"{folder.rstrip('/')}/{name}")
    out = fs.create(path, True)
    out.write(bytearray(text.encode()))
    out.close()


def add(spark: SparkSession, folder: str, text: str) -> str:
    """Make a note under a name of its own; returns the name."""
    name = uuid.uuid4().hex
    put(spark, folder, name, text)
    return name


def notes(spark: SparkSession, folder: str) -> dict[str, str]:
    """All notes of a folder, by name."""
    path, fs = _at(spark, folder)
    if not fs.exists(path):
        return {}
    out = {}
    utils = spark.sparkContext._jvm.org.apache.commons.io.IOUtils  # noqa: SLF001
    for status in fs.listStatus(path):
        if status.isFile():
            stream = fs.open(status.getPath())
            out[status.getPath().getName()] = utils.toString(stream, "UTF-8")
            stream.close()
    return dict(sorted(out.items()))


def remove(spark: SparkSession, folder: str, name: str) -> None:
    """Delete a note or a whole sub-folder; nothing happens if there is none."""
    path, fs = _at(spark, f"{folder.rstrip('/')}/{name}")
    fs.delete(path, True)
