"""Flat text files with chosen names."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession

from .. import storage

#: Parts that a store is asked to join in one call.
JOINED_AT_ONCE = 1000


def output_paths(path: str, n_outputs: int) -> list[str]:
    """``path`` itself for one output, else ``name_01.ext``, … padded to the width of the count."""
    if n_outputs < 1:
        raise ValueError("the number of outputs must be at least 1")
    if n_outputs == 1:
        return [path]
    stem, ending = posixpath.splitext(path)
    width = len(str(n_outputs))
    return [f"{stem}_{number:0{width}d}{ending}" for number in range(1, n_outputs + 1)]


def write_outputs(
    spark: SparkSession, lines: DataFrame, paths: list[str], staging: str, as_folders: bool, line_sep: str = "\n"
) -> None:
    """Write ``output, line`` rows, already in order, and give every output its name.

    The text goes to ``staging`` first; only then are the outputs that exist replaced,
    by moving names.  With ``as_folders`` an output is a folder of ordered part files,
    else it is one file, which the store has to join if there are several parts.  An output without lines is an empty file or folder.
    """
    (
        lines.select("output", "line")
        .write.partitionBy("output")
        .option("maxRecordsPerFile", 0)
        .option("lineSep", line_sep)
        .text(staging)
    )
    for number, path in enumerate(paths, start=1):
        written = f"{staging}/output={number}"
        parts = []
        if storage.exists(spark, written):
            parts = [e.name for e in storage.list_dir(spark, written) if not e.name.startswith((".", "_"))]
        if storage.exists(spark, path):
            storage.delete(spark, path)
        if as_folders:
            if parts:
                storage.make_dir(spark, posixpath.dirname(path) or ".")
                storage.rename(spark, written, path)
            else:
                storage.make_dir(spark, path)
        elif not parts:
            storage.touch(spark, path)
        else:
            first, *others = [f"{written}/{part}" for part in parts]
            for at in range(0, len(others), JOINED_AT_ONCE):
                storage.concat(spark, first, others[at : at + JOINED_AT_ONCE])
            storage.make_dir(spark, posixpath.dirname(path) or ".")
            storage.rename(spark, first, path)
