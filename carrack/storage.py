"""File operations on names, through Hadoop's FileSystem so that any store works.

Data never passes through these functions, only names, sizes and commit records.
"""

from __future__ import annotations

import contextlib
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import SparkSession


class Entry(NamedTuple):
    name: str
    is_dir: bool
    size: int


def _open(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def uri(spark: SparkSession, path: str) -> str:
    fs, jpath = _open(spark, path)
    return fs.makeQualified(jpath).toUri().toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _open(spark, path)
    return fs.exists(jpath)


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, jpath = _open(spark, path)
    return fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory()


def list_dir(spark: SparkSession, path: str) -> list[Entry]:
    fs, jpath = _open(spark, path)
    found = [
        Entry(status.getPath().getName(), status.isDirectory(), status.getLen())
        for status in fs.listStatus(jpath)
    ]
    return sorted(found)


def make_dir(spark: SparkSession, path: str) -> None:
    fs, jpath = _open(spark, path)
    fs.mkdirs(jpath)


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _open(spark, path)
    fs.delete(jpath, True)


def delete_quietly(spark: SparkSession, path: str) -> None:
    """Delete what may as well stay if the store is away."""
    with contextlib.suppress(Exception):
        delete(spark, path)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move ``source`` to ``target``; refuses to replace what is there."""
    fs, jsource = _open(spark, source)
    _, jtarget = _open(spark, target)
    if fs.exists(jtarget):
        raise FileExistsError(target)
    if not fs.rename(jsource, jtarget):
        raise OSError(f"cannot move {source} to {target}")


def can_concat(spark: SparkSession, path: str) -> bool:
    """Whether the store joins files by their records only, as HDFS does, without copying data."""
    fs, jpath = _open(spark, path)
    return fs.hasPathCapability(jpath, "fs.capability.paths.concat")


def concat(spark: SparkSession, first: str, others: list[str]) -> None:
    """Append ``others`` to ``first`` in the store; they are gone afterwards."""
    fs, jfirst = _open(spark, first)
    array = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(others))
    for number, path in enumerate(others):
        array[number] = _open(spark, path)[1]
    fs.concat(jfirst, array)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file, replacing what is there."""
    fs, jpath = _open(spark, path)
    fs.create(jpath, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Publish a small text under a new name: written aside, then moved into place.

    Raises ``FileExistsError`` if the name is taken.
    """
    aside = f"{path}.{uuid.uuid4().hex}.tmp"
    fs, jaside = _open(spark, aside)
    stream = fs.create(jaside, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    try:
        rename(spark, aside, path)
    except FileExistsError:
        delete(spark, aside)
        raise


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = _open(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_heads(spark: SparkSession, paths: list[str], size: int) -> list[bytes]:
    """The first bytes of each file."""

    def head(path: str) -> bytes:
        fs, jpath = _open(spark, path)
        stream = fs.open(jpath)
        try:
            return bytes(stream.readNBytes(size))
        finally:
            stream.close()

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(head, paths))
