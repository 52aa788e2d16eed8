"""What the operators of this package share: written tables, Arrow maps, text in bytes."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Hashable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import scratch_path

#: The six ASCII white-space characters that the contracts name, \x20 and \x09 to \x0D.
BLANKS = b" \t\n\x0b\x0c\r"

#: Text bytes that a Python worker holds at a time, beside one longer document.
BATCH_BYTES = 1 << 20

#: What this Python worker remembers from task to task.
_remembered: dict[Hashable, object] = {}


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, through Spark's own file server."""
    context = spark.sparkContext
    if getattr(context, "_carrack_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="carrack-code-")) / "carrack.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as target:
        for file in sorted(root.rglob("*.py")):
            target.write(file, f"{root.name}/{file.relative_to(root)}")
    context.addPyFile(str(archive))
    context._carrack_shipped = True


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet").select(*(columns or ("doc_id", "text")))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remember[T](key: Hashable, make: Callable[[], T]) -> T:
    """What a worker keeps from task to task, made once, in place of anything else that it kept."""
    if key not in _remembered:
        forget()
        _remembered[key] = make()
    return _remembered[key]


def forget(but: Hashable = None) -> None:
    """Drop what this worker has kept for other work, and freed.  Workers go from stage to stage, and it would add up."""
    for key in _remembered.keys() - {but}:
        del _remembered[key]
    release()


def release() -> None:
    """Give memory back that Arrow has freed: it keeps a hundred megabytes in a worker otherwise."""
    pa.default_memory_pool().release_unused()


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], Iterable[dict]], schema: str | T.StructType, keeps: Hashable = None
) -> DataFrame:
    """``mapInArrow`` with ``work`` giving column dictionaries for slices of bounded size.

    ``keeps`` is the key of what ``work`` remembers; anything else is forgotten.
    """
    ship_package(df.sparkSession)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(keeps)
        for batch in batches:
            for part in slices(batch):
                for columns in work(part):
                    arrays = [pa.array(columns[f.name], f.type, from_pandas=True) for f in target]
                    yield pa.RecordBatch.from_arrays(arrays, schema=target)
            release()

    return df.mapInArrow(run, schema)


def extend_batches(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], dict],
    added: str,
    hidden: tuple[str, ...] = (),
    keeps: Hashable = None,
) -> DataFrame:
    """The columns of ``df`` but ``hidden`` ones, and those of ``added``, which replace columns of their names."""
    new = T.StructType.fromDDL(added)
    kept = [f for f in df.schema.fields if f.name not in (*new.names, *hidden)]

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        yield {f.name: batch.column(f.name) for f in kept} | work(batch)

    return map_batches(df, run, T.StructType([*kept, *new.fields]), keeps)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about :data:`BATCH_BYTES` each, so that long texts do not add up."""
    rows = batch.num_rows
    if not rows:
        return
    step = max(1, int(rows * BATCH_BYTES / max(batch.nbytes, BATCH_BYTES)))
    for start in range(0, rows, step):
        yield batch.slice(start, step)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column as UTF-8; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]
