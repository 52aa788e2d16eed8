"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixtures
from .functions import cipher, scalars
from .functions.fields import NameField
from .functions.types import typed_projection
from .operators import keys, versions
from .operators.mapping import map_by_position
from .operators.numbering import number_lines
from .operators.reconcile import reconcile
from .plans import load, merge, sync
from .session import scratch_path
from .sinks.routed import read_routed
from .sinks.tables import append_table
from .sources.shards import list_shards, scan_shards
from .sources.tables import parquet_table, slice_scan
from .streaming.replicate import replicate_stream
from .streaming.versions import replicate_table

RULE = sync.SyncRule("cv", "mv", "o_orderkey", fixtures.SLICE)
FIELD = ("SourceSystem", r"(?<=sys_src_)\w{4}", ",")
STATEMENTS = [
    "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD'",
    "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_mktsegment = 'MACHINERY'",
    "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_mktsegment = 'NO SUCH SEGMENT'",
]

#: The same as one text: semicolons in comments and in quotes do not end a statement.
STATEMENT_TEXT = f"""
-- the first one; it doesn't end here
{STATEMENTS[0]} AND c_name <> 'it\\'s; not a name' ;
/* a ; comment /* and a nested; one */ it's over */ {STATEMENTS[1]} AND c_name <> "a ; b";;
{STATEMENTS[2]} -- can't be; more
"""


# Replication


def slice_of_source(spark: SparkSession, folder: str) -> DataFrame:
    return slice_scan(fixtures.versioned_source(spark, folder), ["o_orderkey", "cv", "mv"], fixtures.SLICE)


def version_watermark(spark: SparkSession, folder: str) -> DataFrame:
    sides = [
        ("source", fixtures.versioned_source(spark, folder), versions.SOURCE_DEFAULT),
        ("target", fixtures.versioned_target(spark, folder), versions.TARGET_DEFAULT),
    ]
    source, target = [
        versions.watermark_row(df, "cv", "mv", fixtures.SLICE, default).select(F.lit(name).alias("side"), "*")
        for name, df, default in sides
    ]
    return source.union(target)


def delta_rows(spark: SparkSession, folder: str) -> DataFrame:
    mark = sync.target_mark(fixtures.versioned_target(spark, folder), RULE)
    return versions.delta_rows(fixtures.versioned_source(spark, folder), mark, "cv", "mv", fixtures.SLICE)


def changed_keys(spark: SparkSession, folder: str) -> DataFrame:
    mark = sync.target_mark(fixtures.versioned_target(spark, folder), RULE)
    return versions.changed_keys(fixtures.versioned_source(spark, folder), mark, "o_orderkey", "mv", fixtures.SLICE)


def delete_by_keys(spark: SparkSession, folder: str) -> DataFrame:
    return keys.delete_by_keys(fixtures.versioned_target(spark, folder), changed_keys(spark, folder), "o_orderkey")


def sync_dataset(spark: SparkSession, folder: str) -> DataFrame:
    return sync.sync_dataset(fixtures.versioned_source(spark, folder), fixtures.versioned_target(spark, folder), RULE)


def sync_summary(spark: SparkSession, folder: str) -> DataFrame:
    return sync.sync_summary(fixtures.versioned_source(spark, folder), fixtures.versioned_target(spark, folder), RULE)


def insert_missing(spark: SparkSession, folder: str) -> DataFrame:
    return keys.insert_missing(
        fixtures.versioned_source(spark, folder), fixtures.versioned_target(spark, folder), "o_orderkey"
    )


def staged_publish(spark: SparkSession, folder: str) -> DataFrame:
    """The replica is loaded, synced and read back."""
    source = fixtures.versioned_source(spark, folder)
    replica = sync.create_replica(spark, scratch_path(spark, "replica"), source, RULE)
    replica.publish(fixtures.versioned_target(spark, folder))
    sync.sync_replica(replica, source, RULE)
    return replica.read()


def typed(spark: SparkSession, folder: str) -> DataFrame:
    return _exact_text(typed_projection(fixtures.typed_source(spark, folder), strict=True))


def typed_default(spark: SparkSession, folder: str) -> DataFrame:
    """The open list of types, with datetimes as dates."""
    df = _exact_text(typed_projection(fixtures.typed_source(spark, folder), datetime_as_date=True))
    return df.withColumn("Shipped", F.col("Shipped").cast("string"))


def sync_schema(spark: SparkSession, folder: str) -> DataFrame:
    """A replica with a derived partition column, clustered by key, filled and read back."""
    source = fixtures.typed_source(spark, folder)
    replica = sync.create_replica(
        spark,
        scratch_path(spark, "typed"),
        source,
        partition_by={"ShipYear": "year(ShipDay)"},
        cluster_by=["OrderKey"],
        strict=True,
    )
    replica.publish(typed_projection(source, strict=True))
    return _exact_text(replica.read())


def _exact_text(df: DataFrame) -> DataFrame:
    """Decimals, dates and binary as text, so that a comparison sees every digit."""
    exact = {name: F.col(name).cast("string") for name in ("Price", "ShipDay", "Wide")}
    return df.withColumns(exact | {"Raw": F.hex("Raw")})


# Bulk loads


def statement_union(spark: SparkSession, folder: str) -> DataFrame:
    parquet_table(spark, folder, "customer").createOrReplaceTempView("customer")
    return load.union_statements(spark, STATEMENT_TEXT)


def statement_report(spark: SparkSession, folder: str) -> DataFrame:
    parquet_table(spark, folder, "customer").createOrReplaceTempView("customer")
    table, _ = _new_table(spark, "c_custkey BIGINT, c_name STRING, c_nationkey INT")
    try:
        failing = "SELECT c_custkey, c_name, CAST(raise_error('bad row') AS INT) FROM customer"
        return _errors_as_flags(load.load_statements(spark, [*STATEMENTS, failing], table).report)
    finally:
        spark.sql(f"DROP TABLE {table}")


def ordinal_map(spark: SparkSession, folder: str) -> DataFrame:
    destination = T.StructType().add("row_id", "long").add("id", "long").add("name", "string").add("nation", "integer")
    return map_by_position(parquet_table(spark, folder, "supplier"), destination, read_only=["row_id"])


def appended_table(spark: SparkSession, folder: str) -> DataFrame:
    """All customers appended to a table that has them already."""
    customer = parquet_table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    table, path = _new_table(spark, "id BIGINT, name STRING, nation INT")
    try:
        append_table(customer, table)
        append_table(customer, table)
    finally:
        spark.sql(f"DROP TABLE {table}")
    return spark.read.schema("id BIGINT, name STRING, nation INT").parquet(path)


ROUTED_SQL = "SELECT l_orderkey, l_linenumber, l_shipdate, l_returnflag FROM lineitem"
ROUTED_SCHEMA = T.StructType().add("order_key", "long").add("line_no", "integer").add("shipped", "timestamp_ntz")


def _split_load(spark: SparkSession, folder: str) -> tuple[str, load.LoadResult]:
    """Line items by return flag, which is not among the mapped columns."""
    parquet_table(spark, folder, "lineitem").createOrReplaceTempView("lineitem")
    path = scratch_path(spark, "routed")
    return path, load.load_routed(spark, ROUTED_SQL, ROUTED_SCHEMA, path, "l_returnflag", label="lineitem_copy")


def split_load(spark: SparkSession, folder: str) -> DataFrame:
    path, _ = _split_load(spark, folder)
    return read_routed(spark, path, ROUTED_SCHEMA)


def split_load_report(spark: SparkSession, folder: str) -> DataFrame:
    """One statement fails while it runs and one while it is planned; the text of an error is not compared."""
    parquet_table(spark, folder, "lineitem").createOrReplaceTempView("lineitem")
    running = ROUTED_SQL.replace("l_returnflag", "CAST(raise_error('bad row') AS STRING) AS l_returnflag")
    statements = [ROUTED_SQL, running, "SELECT nothing FROM lineitem"]
    result = load.load_routed(
        spark,
        statements,
        ROUTED_SCHEMA,
        scratch_path(spark, "routed"),
        "l_returnflag",
        label="lineitem_copy",
        on_error="report",
    )
    return _errors_as_flags(result.report)


def _errors_as_flags(report: DataFrame) -> DataFrame:
    shown = F.when(F.col("ProcessingError") != "", "failed").otherwise("")
    return report.withColumn("ProcessingError", shown)


# Text shards


def shard_scan(spark: SparkSession, folder: str) -> DataFrame:
    shards = list_shards(spark, fixtures.text_shards(spark, folder))
    return scan_shards(spark, shards).select("file_name", "line")


def shard_encodings(spark: SparkSession, folder: str) -> DataFrame:
    """Shards in UTF-16 and UTF-32, with LZW and of several gzip members, with their line numbers."""
    shards = list_shards(spark, fixtures.encoded_shards(spark, folder))
    return number_lines(spark, shards, scratch_path(spark, "lines")).lines.select("file_name", "line_no", "line")


def shard_skip(spark: SparkSession, folder: str) -> DataFrame:
    return _numbered(spark, folder, 0, 1).lines.select("file_name", "line_no", "line")


def filename_field(spark: SparkSession, folder: str) -> DataFrame:
    merged = merge.deal_lines(spark, _numbered(spark, folder, 0, 1), 1, NameField.of(*FIELD))
    return merged.lines.select("position", "line")


def round_robin_split(spark: SparkSession, folder: str) -> DataFrame:
    return merge.deal_lines(spark, _numbered(spark, folder, 1, 1), 4, has_header=False).lines


def shard_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Four outputs of ordered parts, written and read back line by line."""
    output = scratch_path(spark, "outputs")
    shards = fixtures.text_shards(spark, folder)
    result = merge.merge_shards(spark, shards, f"{output}/merged.csv", 0, 1, "auto", 4, *FIELD, layout="parts")
    written = []
    for path in result.paths:
        lines = number_lines(spark, list_shards(spark, path, "txt"), scratch_path(spark, "lines")).lines
        name = F.lit(path.rsplit("/", 1)[1]).alias("file_name")
        written.append(lines.select(name, F.col("ordinal").alias("line_no"), "line"))
    return reduce(DataFrame.union, written)


def _numbered(spark: SparkSession, folder: str, skip_first: int, skip_others: int):
    shards = list_shards(spark, fixtures.text_shards(spark, folder))
    return number_lines(spark, shards, scratch_path(spark, "lines"), skip_first, skip_others)


# Streams and functions


def stream_sync(spark: SparkSession, folder: str) -> DataFrame:
    """All events as a stream, then once more from the start with a new checkpoint."""
    events = parquet_table(spark, folder, "events")
    replica = sync.create_replica(spark, scratch_path(spark, "events"), events, sync.SyncRule("event_id", "ts", "event_id"))
    source = _stream_files(spark, events, "event_id")
    for run in ("first", "again"):
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4).parquet(source)
        replicate_stream(stream, replica, "event_id", scratch_path(spark, f"checkpoint-{run}")).awaitTermination()
    return replica.read()


def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The versioned source as a stream into a replica that holds the target."""
    changes = fixtures.versioned_source(spark, folder)
    replica = sync.create_replica(spark, scratch_path(spark, "orders"), changes, RULE)
    replica.publish(fixtures.versioned_target(spark, folder))
    source = _stream_files(spark, changes, "o_orderkey")
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 4).parquet(source)
    checkpoint = scratch_path(spark, "checkpoint-upsert")
    replicate_stream(stream, replica, "o_orderkey", checkpoint, "upsert", "mv").awaitTermination()
    return replica.read()


def stream_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The latest event of each user, from a stream in which users come again and again."""
    events = parquet_table(spark, folder, "events")
    replica = sync.create_replica(spark, scratch_path(spark, "users"), events, sync.SyncRule("event_id", "ts", "user_id"))
    source = _stream_files(spark, events, "event_id")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 3).parquet(source)
    checkpoint = scratch_path(spark, "checkpoint-users")
    replicate_stream(stream, replica, "user_id", checkpoint, "upsert", "ts").awaitTermination()
    return replica.read()


def stream_table(spark: SparkSession, folder: str) -> DataFrame:
    """The versioned source as a stream of versions into a replica that holds the target, started twice."""
    source = fixtures.versioned_source(spark, folder)
    replica = sync.create_replica(spark, scratch_path(spark, "orders"), source, RULE)
    replica.publish(fixtures.versioned_target(spark, folder))
    for _ in range(2):
        checkpoint = scratch_path(spark, "checkpoint-table")
        replicate_table(spark, lambda: source, replica, RULE, checkpoint, "orders").awaitTermination()
    return replica.read()


def reconciled(spark: SparkSession, folder: str) -> DataFrame:
    """Keys in which a replica differs from its source, before it is synced."""
    source, target = fixtures.versioned_source(spark, folder), fixtures.versioned_target(spark, folder)
    return reconcile(source, target, "o_orderkey")


def encrypt_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    key = cipher.derive_key("a password for the test tables", bytes(range(16)))
    sealed = parquet_table(spark, folder, "customer").select(
        "c_custkey", cipher.encrypt(F.col("c_name"), key).alias("sealed")
    )
    iv = bytes(range(16, 32))
    bare = cipher.encrypt(cipher.decrypt(F.col("sealed"), key), key, iv)
    return sealed.select(
        "c_custkey",
        cipher.decrypt(bare, key, iv).alias("c_name"),
        F.octet_length("sealed").alias("sealed_bytes"),
        F.octet_length(bare).alias("bare_bytes"),
        (F.instr(F.hex("sealed"), F.hex(cipher.decrypt(F.col("sealed"), key))) == 0).alias("hidden"),
    )


def scalar_fields(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "orders").select(
        "o_orderkey",
        scalars.time_stamp(F.col("o_orderdate")).alias("stamp"),
        scalars.zero_pad(F.col("o_custkey"), 8).alias("padded"),
        scalars.strip_brackets(F.concat(F.lit("["), F.col("o_orderstatus"), F.lit("]"))).alias("status"),
        scalars.first_match(F.col("o_orderpriority"), r"\d+").alias("digits"),
        scalars.int_or_default(F.substring("o_orderpriority", 1, 1), -1).alias("priority"),
        scalars.int_or_default(F.col("o_orderstatus"), -1).alias("no_number"),
    )


def _new_table(spark: SparkSession, columns: str) -> tuple[str, str]:
    """An empty table in the shared folder; dropping it leaves its files."""
    name, path = f"carrack_{uuid.uuid4().hex}", scratch_path(spark, "table")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")
    return name, path


def _stream_files(spark: SparkSession, df: DataFrame, key: str) -> str:
    path = scratch_path(spark, "stream")
    df.repartition(8, key).write.parquet(path)
    return path


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "slice_scan": slice_of_source,
    "version_watermark": version_watermark,
    "delta_rows": delta_rows,
    "changed_keys": changed_keys,
    "delete_by_keys": delete_by_keys,
    "sync_dataset": sync_dataset,
    "sync_summary": sync_summary,
    "insert_missing": insert_missing,
    "staged_publish": staged_publish,
    "typed_projection": typed,
    "typed_default": typed_default,
    "sync_schema": sync_schema,
    "statement_union": statement_union,
    "statement_report": statement_report,
    "ordinal_map": ordinal_map,
    "append_table": appended_table,
    "split_load": split_load,
    "split_load_report": split_load_report,
    "shard_scan": shard_scan,
    "shard_encodings": shard_encodings,
    "shard_skip": shard_skip,
    "filename_field": filename_field,
    "round_robin_split": round_robin_split,
    "shard_outputs": shard_outputs,
    "encrypt_roundtrip": encrypt_roundtrip,
    "stream_sync": stream_sync,
    "stream_upsert": stream_upsert,
    "stream_duplicates": stream_duplicates,
    "stream_table": stream_table,
    "reconcile": reconciled,
    "scalar_fields": scalar_fields,
}
