"""Inputs that Spark derives from the given tables (see FIXTURES.md)."""

from __future__ import annotations

import codecs
import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage
from .session import scratch_path, ship_package
from .sources.tables import parquet_table

SLICE = "o_orderstatus IN ('O', 'F')"

PIECE_KEYS = 3_000_000
HEAD_LINES = [(-3, "c_custkey,c_name,c_nationkey,c_mktsegment"), (-2, ""), (-1, "  \t")]
SHARD_KINDS = [("_sys_src_AAAA", ".csv.gz", "gzip"), ("_sys_src_BBBB", ".csv.bz2", "bzip2"), ("_plain", ".csv", "none")]


def versioned_source(spark: SparkSession, folder: str) -> DataFrame:
    """All orders with created and modified versions; every seventh has changed."""
    key = F.col("o_orderkey")
    changed = key % 7 == 0
    created = key % 10
    modified = F.when(changed, created + 3).when(key % 11 == 0, F.lit(0)).otherwise(created)
    return parquet_table(spark, folder, "orders").select(
        "o_orderkey",
        (F.col("o_custkey") + F.when(changed, 1000).otherwise(0)).alias("o_custkey"),
        "o_orderstatus",
        created.alias("cv"),
        modified.alias("mv"),
    )


def versioned_target(spark: SparkSession, folder: str) -> DataFrame:
    """The replica as of created version 6."""
    created = F.col("o_orderkey") % 10
    return (
        parquet_table(spark, folder, "orders")
        .select("o_orderkey", "o_custkey", "o_orderstatus", created.alias("cv"), created.alias("mv"))
        .where(F.col("cv") <= 6)
    )


def typed_source(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a column of every kind that the type mapping knows."""
    flag, shipped = F.col("l_returnflag"), F.col("l_shipdate")
    return parquet_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("PKID"),
        F.col("l_orderkey").alias("OrderKey"),
        F.col("l_linenumber").alias("LineNo"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("Price"),
        flag.alias("Flag"),
        (F.col("l_linestatus") == "O").alias("IsOpen"),
        shipped.alias("Shipped"),
        F.to_date(shipped).alias("ShipDay"),
        F.col("l_quantity").alias("Qty"),
        F.array(flag).alias("Tags"),
        # Half a unit of the last place that is kept, with either sign.
        F.concat((2 * F.col("l_linenumber") - 9).cast("string"), F.lit("." + "0" * 30 + "5"))
        .cast("decimal(38,31)")
        .alias("Wide"),
        flag.cast("binary").alias("Raw"),
    )


def text_shards(spark: SparkSession, folder: str) -> str:
    """Customers as text shards (gzip, bzip2 and plain), each with a header, an empty
    line and a line of white space; returns their folder.

    A shard takes a third of ``PIECE_KEYS`` keys, so the number of shards grows with
    the table and every one is a small task.
    """
    path = scratch_path(spark, "shards")
    customer = parquet_table(spark, folder, "customer")
    key = F.col("c_custkey")
    n_pieces = customer.agg(F.max(key)).first()[0] // PIECE_KEYS + 1
    lines = customer.select(
        F.floor(key / PIECE_KEYS).cast("int").alias("piece"),
        key.alias("rank"),
        F.concat_ws(",", "c_custkey", "c_name", "c_nationkey", "c_mktsegment").alias("line"),
    )
    heads = [F.struct(F.lit(rank).cast("bigint").alias("rank"), F.lit(line).alias("line")) for rank, line in HEAD_LINES]
    head = spark.range(n_pieces).select(F.col("id").cast("int").alias("piece"), F.inline(F.array(*heads)))
    for number, (tag, ending, codec) in enumerate(SHARD_KINDS):
        build = f"{path}/_build_{number}"
        (
            lines.where(F.col("rank") % 3 == number)
            .union(head)
            .repartitionById(n_pieces, F.col("piece"))
            .sortWithinPartitions("rank")
            .select("line")
            .write.option("compression", codec)
            .option("maxRecordsPerFile", 0)
            .text(build)
        )
        parts = [e.name for e in storage.list_dir(spark, build) if e.name.startswith("part-")]
        for piece, part in enumerate(parts):
            storage.rename(spark, f"{build}/{part}", f"{path}/cust_{number}_{piece:09d}{tag}{ending}")
        storage.delete(spark, build)
    return path


#: Customers in a shard of :func:`encoded_shards`, at most, and what its shards are.
ENCODED_KEYS = 100_000
ENCODED_KINDS = ("utf16le.txt", "utf16be.csv", "utf32le.txt", "lzw.csv.Z", "members.csv.gz")


def encoded_shards(spark: SparkSession, folder: str) -> str:
    """Customers as shards in UTF-16 and UTF-32, with LZW, and in several gzip members; returns their folder."""
    ship_package(spark)
    path = scratch_path(spark, "encoded")
    storage.make_dir(spark, path)
    uri = re.sub("^file:/+", "file:///", storage.uri(spark, path))
    customer, key = parquet_table(spark, folder, "customer"), F.col("c_custkey")
    n_pieces = customer.agg(F.max(key)).first()[0] // ENCODED_KEYS + 1
    number = (F.floor(key / ENCODED_KEYS) * len(ENCODED_KINDS) + key % len(ENCODED_KINDS)).cast("int")
    line = F.concat_ws(",", "c_custkey", "c_name", F.lit("\u00e9\u20ac\U0001f600"), "c_mktsegment")
    rows = customer.select(number.alias("number"), key.alias("rank"), line.alias("line"))
    rows = rows.repartitionById(n_pieces * len(ENCODED_KINDS), F.col("number")).sortWithinPartitions("number", "rank")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, lines = None, []
        for batch in batches:
            for number, text in zip(batch.column("number").to_pylist(), batch.column("line").to_pylist()):
                lines.append(text + "\n")
        if number is not None:
            piece, kind = divmod(number, len(ENCODED_KINDS))
            name = f"cust_{piece:06d}_{ENCODED_KINDS[kind]}"
            store, root = FileSystem.from_uri(uri)
            with store.open_output_stream(f"{root}/{name}", compression=None) as target:
                target.write(_encoded("".join(lines), ENCODED_KINDS[kind]))
            yield pa.RecordBatch.from_pydict({"name": [name]})

    rows.mapInArrow(write, "name string").write.format("noop").mode("overwrite").save()
    return path


def _encoded(text: str, kind: str) -> bytes:
    if kind.endswith(".gz"):
        data = text.encode()
        return b"".join(gzip.compress(data[n : n + 4096]) for n in range(0, len(data), 4096))
    if kind.endswith(".Z"):
        return lzw_compressed(text.encode())
    mark, name = {
        "utf16le.txt": (codecs.BOM_UTF16_LE, "utf-16-le"),
        "utf16be.csv": (codecs.BOM_UTF16_BE, "utf-16-be"),
        "utf32le.txt": (codecs.BOM_UTF32_LE, "utf-32-le"),
    }[kind]
    return mark + text.encode(name)


def lzw_compressed(data: bytes, most: int = 16, clear_after: int | None = None) -> bytes:
    """A ``.Z`` file of some bytes; its table is cleared every ``clear_after`` codes."""
    out, width, group = bytearray([0x1F, 0x9D, 0x80 | most]), 9, []
    table, known, n_codes = {bytes([n]): n for n in range(256)}, 256, 0

    def put(code: int, last: bool = False) -> None:
        """A code; a group is full, or left as it is, where the reader changes its width."""
        nonlocal width, known, n_codes
        group.append(code)
        n_codes += 1
        known += n_codes > 1 and known < 1 << most  # what the reader's table has by now
        wider = (known + 1) >> width and width < max(most, 10)
        if len(group) == 8 or wider or last or code == 256:
            bits = sum(c << n * width for n, c in enumerate(group))
            whole = width if not last else (len(group) * width + 7) // 8
            out.extend(bits.to_bytes(width, "little")[:whole])
            group.clear()
            width += bool(wider and not last)

    text = b""
    for byte in data:
        longer = text + bytes([byte])
        if longer in table:
            text = longer
            continue
        put(table[text])
        if len(table) < (1 << most) - 1:
            table[longer] = len(table) + 1
        text = longer[-1:]
        if clear_after and n_codes >= clear_after:
            put(256)
            table, known, n_codes, width = {bytes([n]): n for n in range(256)}, 256, 0, 9
    if text:
        put(table[text], True)
    return bytes(out)
