"""Lines of shards that Spark's text reader cannot decode, as a Spark data source over Arrow batches.

A task is a file, or the members of a gzip file from one place up to another.  Small files
share a partition.  Files are opened through Arrow's file systems.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import ship_package
from . import decoding

SCHEMA = "file_name string, block_start long, line string"
#: Encoded bytes of the files that share a partition, and what opening a file counts for.
PARTITION_BYTES = 64 << 20
OPEN_BYTES = 4 << 20
#: Lines, and their bytes, that a batch has at most, but for one longer line.
BATCH_LINES = 1 << 16


class _Tasks(InputPartition):
    def __init__(self, tasks: list[dict]):
        self.tasks = tasks


class LinesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.uri, self.tasks = options["uri"], json.loads(options["tasks"])
        self.most = int(options["partition_bytes"])

    def partitions(self) -> list[InputPartition]:
        groups, size = [], self.most
        for task in sorted(self.tasks, key=lambda t: -t["size"]):
            if size + task["size"] + OPEN_BYTES > self.most:
                groups.append([])
                size = 0
            groups[-1].append(task)
            size += task["size"] + OPEN_BYTES
        return [_Tasks(tasks) for tasks in groups]

    def read(self, partition: _Tasks) -> Iterator[pa.RecordBatch]:
        files, root = _files(self.uri)
        for task in partition.tasks:
            with files.open_input_file(f"{root}/{task['name']}") as file:
                start = task.get("start", 0)
                if "start" in task:
                    chunks = decoding.owned(decoding.members(file, start), start, task["end"])
                else:
                    chunks = decoding.chunks_of(file, task["ending"])
                for found in decoding.lines(decoding.utf8(chunks, task["encoding"], task["mark"])):
                    for at in range(0, len(found), BATCH_LINES):
                        yield _batch(task["name"], start, found[at : at + BATCH_LINES])


def _batch(name: str, start: int, found: list[bytes]) -> pa.RecordBatch:
    try:
        line = pa.array(found, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        line = pa.array([x.decode("utf-8", "replace") for x in found], pa.string())
    columns = [pa.repeat(pa.scalar(name), len(found)), pa.repeat(pa.scalar(start, pa.int64()), len(found)), line]
    return pa.RecordBatch.from_arrays(columns, ["file_name", "block_start", "line"])


class LinesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "carrack_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return LinesReader(self.options)


def _files(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def decoded_lines(spark: SparkSession, uri: str, tasks: list[dict]) -> DataFrame:
    """``file_name, block_start, line`` of the files, or parts of files, that ``tasks`` names below ``uri``."""
    ship_package(spark)
    spark.dataSource.register(LinesSource)
    options = {"uri": uri, "tasks": json.dumps(tasks), "partition_bytes": PARTITION_BYTES}
    return spark.read.format("carrack_lines").options(**options).load()


def member_starts(spark: SparkSession, uri: str, files: list[dict], step: int) -> dict[str, list[int]]:
    """For each file where its tasks begin: the first member of every ``step`` bytes.

    Ranges are searched by tasks of their own, so the index of a large file is made in parallel.
    """
    ship_package(spark)
    ranges = [(f["name"], at, min(at + step, f["size"])) for f in files for at in range(0, f["size"], step)]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _files(uri)
        for batch in batches:
            rows = batch.to_pylist()
            found = []
            for row in rows:
                with store.open_input_file(f"{root}/{row['name']}") as file:
                    found.append(decoding.first_member(file, row["at"], row["end"]))
            yield pa.RecordBatch.from_pydict({"name": pa.array([r["name"] for r in rows]), "start": pa.array(found, pa.int64())})

    asked = spark.createDataFrame(ranges, "name string, at long, end long").repartition(len(ranges))
    found = asked.mapInArrow(search, "name string, start long").where("start IS NOT NULL").collect()
    starts: dict[str, list[int]] = {f["name"]: [] for f in files}
    for row in found:
        starts[row["name"]].append(row["start"])
    return {name: sorted(places) for name, places in starts.items()}
