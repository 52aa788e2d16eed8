import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carrack import fixtures, storage
from carrack.functions import cipher, scalars
from carrack.functions.types import plan_types, target_type, typed_projection
from carrack.operators import keys, sizing
from carrack.operators.versions import Watermark, changed_keys, delta_rows, watermark
from carrack.plans.sync import SyncRule, create_replica, replica_mark, sync_dataset, sync_replica, sync_summary, target_mark
from carrack.session import scratch_path
from carrack.sinks import replica as replicas
from carrack.operators import reconcile as reconciling
from carrack.streaming.replicate import read_progress, replicate_stream
from carrack.streaming.versions import replicate_table, rows_between

COLUMNS = "k BIGINT, v STRING, cv BIGINT, mv BIGINT"
RULE = SyncRule("cv", "mv", "k")


def frame(spark, *data, columns=COLUMNS):
    return spark.createDataFrame(list(data), columns)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def replica_of(spark, source, target, rule=RULE):
    replica = create_replica(spark, scratch_path(spark, "test"), source, rule)
    replica.publish(target)
    return replica


def both_ways(spark, source, target, rule=RULE):
    """The lazy plan and the published replica must agree."""
    lazy = rows(sync_dataset(source, target, rule))
    replica = replica_of(spark, source, target, rule)
    sync_replica(replica, source, rule)
    assert rows(replica.read()) == lazy
    return lazy


def test_counts_of_the_fixture(spark):
    folder = "/root/testdata/sf0.01"
    source, target = fixtures.versioned_source(spark, folder), fixtures.versioned_target(spark, folder)
    rule = SyncRule("cv", "mv", "o_orderkey", fixtures.SLICE)
    mark = target_mark(target, rule)
    assert mark == (6, 6)
    assert target.count() == 10_500
    assert changed_keys(source, mark, "o_orderkey", "mv", fixtures.SLICE).count() == 3_193
    assert delta_rows(source, mark, "cv", "mv", fixtures.SLICE).count() == 3_441
    assert tuple(sync_summary(source, target, rule).first()) == (427, 3_441, 10_073, 13_514)


def test_update_insert_and_null_versions(spark):
    target = frame(spark, (1, "a", 1, 1), (2, "b", 1, 1), (None, "n", 1, 2))
    source = frame(
        spark, (1, "a2", 1, 3), (2, "b", 1, 1), (3, "c", 3, 0), (4, "d", 3, None), (5, "e", None, 3),
        (6, "f", None, None), (7, "g", None, 2), (8, "h", 2, None),
    )
    got = both_ways(spark, source, target)
    assert got == sorted(
        [(1, "a2", 1, 3), (2, "b", 1, 1), (None, "n", 1, 2), (3, "c", 3, 0), (4, "d", 3, None), (5, "e", None, 3), (8, "h", 2, None)],
        key=repr,
    )


def test_empty_target_is_a_full_load_and_sync_twice_is_once(spark):
    source = frame(spark, (1, "a", 0, 0), (2, "b", 5, 2**40), (3, "c", -1, -1))
    replica = create_replica(spark, scratch_path(spark, "test"), source, RULE)
    assert replica.read().count() == 0
    result = sync_replica(replica, source, RULE)
    assert result.before == Watermark(-1, -1) and result.n_records == 2
    assert rows(replica.read()) == [(1, "a", 0, 0), (2, "b", 5, 2**40)]
    assert sync_replica(replica, source, RULE).n_records == 0
    assert replica.read().count() == 2 and replica.state().version == 1
    assert result.records_per_second > 0


def test_created_later_but_not_modified_duplicates_a_key_unless_replaced(spark):
    target, source = frame(spark, (1, "a", 1, 5)), frame(spark, (1, "b", 2, 5))
    assert both_ways(spark, source, target) == [(1, "a", 1, 5), (1, "b", 2, 5)]
    rule = SyncRule("cv", "mv", "k", on_conflict="replace")
    assert both_ways(spark, source, target, rule) == [(1, "b", 2, 5)]


def test_duplicates_in_the_delta_and_rows_gone_from_the_source_stay(spark):
    target, source = frame(spark, (1, "a", 1, 1), (9, "z", 1, 1)), frame(spark, (1, "b", 1, 2), (1, "c", 1, 2))
    assert both_ways(spark, source, target) == [(1, "b", 1, 2), (1, "c", 1, 2), (9, "z", 1, 1)]


def test_slice_with_or_and_delete_over_the_whole_target(spark):
    rule = SyncRule("cv", "mv", "k", "v = 'in' OR v = 'also'")
    target = frame(spark, (1, "out", 9, 9), (2, "in", 1, 1), (3, "also", 2, 2))
    source = frame(spark, (1, "in", 1, 3), (2, "out", 9, 9), (4, "also", 3, 0), (5, "out", 9, 9))
    assert target_mark(target, rule) == (2, 2)
    assert both_ways(spark, source, target, rule) == [(1, "in", 1, 3), (2, "in", 1, 1), (3, "also", 2, 2), (4, "also", 3, 0)]


def test_without_modified_mark_or_key_nothing_is_deleted(spark):
    target = spark.createDataFrame([(1, "a", 1, None)], COLUMNS)
    source = frame(spark, (1, "b", 2, 4))
    assert both_ways(spark, source, target) == [(1, "a", 1, None), (1, "b", 2, 4)]
    rule = SyncRule("cv", "mv", "PKID")
    columns = "pkid BIGINT, v STRING, cv BIGINT, mv BIGINT"
    source = frame(spark, (1, "b", 2, 4), columns=columns)
    target = frame(spark, ("a", 1, 1), columns="v STRING, cv BIGINT, mv BIGINT")
    assert both_ways(spark, source, target, rule) == [("a", 1, 1), ("b", 2, 4)]


def test_watermark_defaults_and_text_versions(spark):
    assert watermark(frame(spark), "cv", "mv", None, -1) == (-1, -1)
    texts = frame(spark, ("12", "x"), columns="cv STRING, mv STRING")
    assert watermark(texts, "cv", "mv", " ", 0) == (12, 0)


def test_literal_versions_reach_the_scan(spark, tmp_path):
    frame(spark, (1, "a", 1, 1)).write.parquet(str(tmp_path / "s"))
    delta = delta_rows(spark.read.parquet(str(tmp_path / "s")), Watermark(3, 4), "cv", "mv", "v = 'a'").select("k")
    plan = delta._jdf.queryExecution().executedPlan().toString()
    assert "Or(GreaterThan(cv,3),GreaterThan(mv,4))" in plan and "EqualTo(v,a)" in plan


def test_delete_by_keys_with_and_without_broadcast(spark, monkeypatch):
    target = frame(spark, (1, "a", 1, 1), (2, "b", 1, 1), (None, "c", 1, 1), (2, "d", 1, 1))
    gone = frame(spark, (2,), (None,), (7,), columns="k BIGINT")
    assert keys.delete_by_keys(target, gone.limit(0), "k").count() == 4
    want = [(1, "a", 1, 1), (None, "c", 1, 1)]
    assert rows(keys.delete_by_keys(target, gone, "k")) == want
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", -1)
    assert rows(keys.delete_by_keys(target, gone, "k")) == want


@pytest.mark.parametrize("limit", [sizing.BROADCAST_BYTES, -1])
@pytest.mark.parametrize("kind", ["BIGINT", "STRING", "DOUBLE"])
def test_insert_missing(spark, monkeypatch, limit, kind):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", limit)
    cast = F.col("k").cast(kind)
    target = frame(spark, (1, "a", 1, 1), (5, "e", 1, 1)).withColumn("k", cast)
    batch = frame(spark, (1, "x", 2, 2), (3, "c", 2, 2), (None, "n", 2, 2), (3, "c2", 2, 2)).withColumn("k", cast)
    got = keys.insert_missing(batch, target, "k").select("v")
    assert sorted(r.v for r in got.collect()) == ["a", "c", "c2", "e", "n"]
    only_null = batch.where("k IS NULL")
    assert keys.missing_rows(only_null, target, "k").count() == 1


def test_types():
    assert target_type(T.IntegerType()) == T.LongType()
    assert target_type(T.DecimalType(38, 31)) == T.DecimalType(32, 30)
    assert target_type(T.TimestampType()) == T.TimestampNTZType()
    assert target_type(T.TimestampNTZType(), datetime_as_date=True) == T.DateType()
    assert target_type(T.ShortType()) == T.LongType() and target_type(T.ShortType(), strict=True) is None
    assert target_type(T.DoubleType()) == T.DoubleType() and target_type(T.DoubleType(), strict=True) is None
    for other in (T.ArrayType(T.LongType()), T.MapType(T.StringType(), T.StringType()), T.StructType(), T.NullType()):
        assert target_type(other) is None


def test_typed_projection_values(spark):
    df = spark.sql(
        """SELECT 1 PkId, 2 a, CAST(1.005 AS DECIMAL(10,3)) d, CAST(0.5 AS DECIMAL(38,31)) wide,
           TIMESTAMP_NTZ'2020-01-02 03:04:05' t, DATE'2020-01-02' day, X'01' raw, true ok, 1.5D q, array(1) tags,
           CAST(NULL AS INT) nothing"""
    )
    plan = plan_types(df.schema, strict=True)
    assert plan.dropped == ("PkId", "q", "tags")
    assert plan_types(df.schema).dropped == ("PkId", "tags")
    got = typed_projection(df, strict=True, datetime_as_date=True).first().asDict()
    assert got == {
        "a": 2, "d": Decimal("1.005"), "wide": Decimal("0.5"), "t": dt.date(2020, 1, 2),
        "day": dt.date(2020, 1, 2), "raw": bytearray(b"\1"), "ok": True, "nothing": None,
    }
    halves = spark.sql("SELECT CAST(CAST(x AS DECIMAL(5,3)) AS DECIMAL(4,2)) y FROM VALUES (1.005), (-1.005) t(x)")
    assert [r.y for r in halves.collect()] == [Decimal("1.01"), Decimal("-1.01")]
    with pytest.raises(Exception):
        typed_projection(spark.sql("SELECT CAST(1234567 AS DECIMAL(38,31)) x")).collect()


def test_partitioned_and_clustered_replica(spark):
    source = frame(spark, *[(i, "ab"[i % 2], i, i) for i in range(100)])
    replica = create_replica(
        spark, scratch_path(spark, "test"), source, RULE, partition_by={"bucket": "k % 4"}, cluster_by=["k"]
    )
    sync_replica(replica, source, RULE)
    assert replica.read().columns == ["k", "v", "cv", "mv", "bucket"]
    assert rows(replica.read().groupBy("bucket").count()) == [(i, 25) for i in range(4)]
    plan = replica.read().where("bucket = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "(bucket" in plan
    later = frame(spark, (5, "new", 5, 200))
    sync_replica(replica, later, RULE)
    assert replica.read().where("k = 5").collect() == [(5, "new", 5, 200, 1)]
    by_name = create_replica(spark, replica.path, source, RULE, partition_by=["v"])
    assert by_name.read().count() == 0
    sync_replica(by_name, source, RULE)
    assert rows(by_name.read()) == rows(source)


def test_old_pointers_are_removed(spark):
    replica = create_replica(spark, scratch_path(spark, "test"), frame(spark), RULE)
    for i in range(4):
        replica.publish(frame(spark, (i, "a", 1, 1)))
    assert len(storage.list_dir(spark, f"{replica.path}/current")) == 2
    assert replica.state().version == 4 and replica.read().count() == 4


def test_compact_keeps_the_rows(spark):
    source = frame(spark, (1, "a", 1, 1), (2, "b", 1, 1))
    replica = replica_of(spark, source, source)
    sync_replica(replica, frame(spark, (1, "a2", 1, 2)), RULE)
    sync_replica(replica, frame(spark, (1, "a3", 1, 3), (3, "c", 2, 3)), RULE)
    before = rows(replica.read())
    replica.compact()
    assert rows(replica.read()) == before == [(1, "a3", 1, 3), (2, "b", 1, 1), (3, "c", 2, 3)]
    assert list(replica.state().parts.values()) == [3] and not replica.state().replaced
    sync_replica(replica, frame(spark, (2, "b2", 1, 4)), RULE)
    assert rows(replica.read()) == [(1, "a3", 1, 3), (2, "b2", 1, 4), (3, "c", 2, 3)]
    replica.drop()
    assert not replica.exists()


def test_mark_of_a_replica_prunes_and_stays_exact(spark):
    rule = SyncRule("cv", "mv", "k", "v <> 'x'")
    source = frame(spark, (1, "a", 4, 4), (2, "x", 9, 9), (3, "c", 2, 2))
    replica = create_replica(spark, scratch_path(spark, "test"), source, rule)
    sync_replica(replica, source, rule)
    sync_replica(replica, frame(spark, (4, "d", 5, 5)), rule)
    assert replica.state().marks[rule.name] == [4, 4]
    assert replica_mark(replica, rule) == target_mark(replica.read(), rule) == (5, 5)
    replica.publish(frame(spark, (1, "x", 0, 0), (4, "x", 0, 0)), lambda rows: rows.select("k"))
    assert replica_mark(replica, rule) == target_mark(replica.read(), rule) == (2, 2)
    by_column = SyncRule("cv", "mv", "k", F.col("v") != "x")
    assert by_column.name is None and replica_mark(replica, by_column) == (2, 2)
    sync_replica(replica, frame(spark, (7, "g", 3, None)), by_column)
    assert replica.read().where("k = 7").count() == 1


def parts_on_disk(spark, replica):
    folder = f"{replica.path}/data"
    return [e.name for e in storage.list_dir(spark, folder)] if storage.exists(spark, folder) else []


@pytest.mark.parametrize("change", ["publish", "compact"])
def test_a_failure_after_the_commit_keeps_the_rows(spark, monkeypatch, change):
    source = frame(spark, (1, "a", 1, 1), (2, "b", 1, 1))
    replica = replica_of(spark, source, source)
    delete = storage.delete

    def failing(spark, path):
        if "/current/" in path:
            raise OSError("the store is away")
        delete(spark, path)

    monkeypatch.setattr(storage, "delete", failing)
    if change == "publish":
        replica.publish(frame(spark, (3, "c", 2, 2)))
    else:
        replica.compact()
    monkeypatch.setattr(storage, "delete", delete)
    expected = [(1, "a", 1, 1), (2, "b", 1, 1)] + ([(3, "c", 2, 2)] if change == "publish" else [])
    assert rows(replica.read()) == expected and replica.state().version == 2


@pytest.mark.parametrize("change", ["publish", "compact"])
def test_an_interrupt_right_after_the_commit_keeps_the_rows(spark, monkeypatch, change):
    source = frame(spark, (1, "a", 1, 1))
    replica = replica_of(spark, source, source)
    write = storage.write_text

    def interrupted(*args):
        write(*args)
        raise KeyboardInterrupt

    monkeypatch.setattr(storage, "write_text", interrupted)
    with pytest.raises(KeyboardInterrupt):
        replica.publish(frame(spark, (3, "c", 2, 2))) if change == "publish" else replica.compact()
    monkeypatch.setattr(storage, "write_text", write)
    assert replica.state().version == 2
    assert rows(replica.read()) == [(1, "a", 1, 1)] + ([(3, "c", 2, 2)] if change == "publish" else [])


def test_a_second_writer_fails_and_takes_nothing_away(spark, monkeypatch):
    source = frame(spark, (1, "a", 1, 1))
    first = replica_of(spark, source, source)
    late = replicas.Replica(spark, first.path)
    stale = late.state()
    first.publish(frame(spark, (2, "b", 2, 2)))
    before = rows(first.read())
    monkeypatch.setattr(late, "state", lambda: stale)
    with pytest.raises(FileExistsError):
        late.publish(frame(spark, (9, "z", 9, 9)))
    with pytest.raises(FileExistsError):
        late.compact()
    assert rows(first.read()) == before == [(1, "a", 1, 1), (2, "b", 2, 2)]
    assert len(parts_on_disk(spark, first)) == 2


def test_reads_planned_before_a_compaction_still_run(spark):
    source = frame(spark, (1, "a", 1, 1), (2, "b", 1, 1))
    replica = replica_of(spark, source, source)
    sync_replica(replica, frame(spark, (1, "a2", 1, 2)), RULE)
    planned = replica.read()
    replica.compact()
    assert rows(planned) == rows(replica.read()) == [(1, "a2", 1, 2), (2, "b", 1, 1)]
    sync_replica(replica, frame(spark, (2, "b2", 1, 3)), RULE)
    replica.compact()
    assert rows(replica.read()) == [(1, "a2", 1, 2), (2, "b2", 1, 3)]


def test_parts_stay_few_and_reading_starts_no_job(spark, monkeypatch):
    monkeypatch.setattr(replicas, "MOST_PARTS", 4)
    source = frame(spark, *[(k, "a", 1, 1) for k in range(200)])
    replica = replica_of(spark, source, source)
    for version in range(2, 14):
        sync_replica(replica, frame(spark, (7, f"v{version}", 1, version), (1000 + version, "n", version, version)), RULE)
    assert len(replica.state().parts) <= 4
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    live = replica.read()
    assert len(tracker.getJobIdsForGroup()) == before
    assert live.count() == 212 and live.where("k = 7").collect() == [(7, "v13", 1, 13)]
    replica.vacuum()
    assert len(parts_on_disk(spark, replica)) == len(replica.state().parts) and live.count() == 212


def test_only_touched_buckets_are_copied(spark, monkeypatch):
    monkeypatch.setattr(replicas, "BUCKET_ROWS", 100)
    source = frame(spark, *[(k, "a", 1, 1) for k in range(1600)], (None, "none", 1, 1), (None, "none", 1, 1))
    replica = replica_of(spark, source, source)
    assert replica.state().bits == 0
    replica.tidy()
    assert replica.state().bits == 5 and rows(replica.read()) == rows(source)
    folders = lambda part: {e.name for e in storage.list_dir(spark, f"{replica.path}/data/__part={part}") if e.is_dir}
    [first] = replica.state().parts
    assert 24 < len(folders(first)) <= 32
    sync_replica(replica, frame(spark, (3, "new", 1, 2), (5, "new", 1, 2), (9000, "x", 2, 2)), RULE)
    state = replica.state()
    assert sum(state.parts.values()) == replica.read().count() == 1603
    assert len(state.replaced[first]) <= 2 and sum(len(folders(p)) for p in state.parts if p != first) <= 5
    expected = [r for r in rows(source) if r[0] not in (3, 5)] + [(3, "new", 1, 2), (5, "new", 1, 2), (9000, "x", 2, 2)]
    assert rows(replica.read()) == sorted(expected, key=repr)
    wanted = spark.createDataFrame([(3,), (9000,), (77,), (-1,), (None,)], "k long")
    found = [(3, "new", 1, 2), (77, "a", 1, 1), (9000, "x", 2, 2)]
    assert rows(replica.holding(wanted)) == sorted(found, key=repr)
    monkeypatch.setattr(replicas, "LOOKUP_RANGES", 2)
    assert rows(replica.holding(wanted)) == sorted(found, key=repr)
    monkeypatch.setattr(replicas, "LOOKUP_KEYS", 2)
    assert rows(replica.holding(wanted)) == sorted(found, key=repr)
    assert replica.holding(wanted.limit(0)).count() == 0
    assert replicas._ranges([9, -(1 << 63), 8, 5]) == [(-(1 << 63), -(1 << 63)), (5, 9)]
    large = replicas.Replica.create(spark, scratch_path(spark, "test"), source.schema, "k", expected_rows=1600)
    assert large.state().bits == 4


def bytes_read(spark, df):
    """What the tasks of one run of ``df`` read from files."""
    context = spark.sparkContext._jsc.sc()
    doubles = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)

    def stages():
        found = context.statusStore().stageList(None, False, False, doubles, spark._jvm.java.util.ArrayList())
        return {found.apply(n).stageId(): found.apply(n).inputBytes() for n in range(found.size())}

    before = stages()
    df.collect()
    context.listenerBus().waitUntilEmpty(10_000)
    return sum(size for stage, size in stages().items() if stage not in before)


def test_a_look_up_reads_as_much_of_a_replica_ten_times_as_large(spark, monkeypatch):
    monkeypatch.setattr(replicas, "BUCKET_ROWS", 10_000)
    # Vectored reads run in threads of their own, which the count of bytes leaves out.
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.hadoop.vectored.io.enabled", "false")
    read, point = [], []
    for n in (300_000, 3_000_000):
        table = spark.range(n).select("id", F.md5(F.col("id").cast("string")).alias("v"))
        replica = replicas.Replica.create(spark, scratch_path(spark, "test"), table.schema, "id", expected_rows=n)
        replica.publish(table)
        keys = spark.createDataFrame([(k * n // 8 + 1,) for k in range(16)], "id long")  # half of them are there
        found = replica.holding(keys, ["id"])
        assert rows(found) == sorted(((k * n // 8 + 1,) for k in range(8)), key=repr)
        read.append(bytes_read(spark, found))
        point.append(bytes_read(spark, replica.read().where("id = 77")))
        everything = bytes_read(spark, replica.read().select("id"))
    assert read[1] < 2 * read[0] and read[1] < everything / 4, (read, everything)
    assert point[1] < everything / 2, (point, everything)


def test_text_partitions_keep_empty_and_null_apart(spark):
    source = frame(spark, (1, "", 1, 1), (2, None, 1, 1), (3, "x=y/z", 1, 1), (4, "__HIVE_DEFAULT_PARTITION__", 1, 1))
    replica = create_replica(spark, scratch_path(spark, "test"), source, RULE, partition_by=["v"])
    sync_replica(replica, source, RULE)
    assert replica.read().columns == source.columns
    assert rows(replica.read()) == rows(source)
    plan = replica.read().where("v = ''")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "__v_v" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert replica.read().where("v = ''").collect() == [(1, "", 1, 1)]
    assert replica.read().where("v IS NULL").collect() == [(2, None, 1, 1)]
    sync_replica(replica, frame(spark, (1, "moved", 1, 2)), RULE)
    assert rows(replica.read().where("k = 1")) == [(1, "moved", 1, 2)]


def test_failed_publish_changes_nothing(spark):
    source = frame(spark, (1, "a", 1, 1))
    replica = replica_of(spark, source, source)
    bad = source.withColumn("v", F.raise_error(F.concat(F.lit("bad row"), "v")))
    with pytest.raises(Exception, match="bad row"):
        replica.publish(bad)
    with pytest.raises(ZeroDivisionError):
        replica.publish(source, lambda rows: 1 // 0)
    assert rows(replica.read()) == [(1, "a", 1, 1)]
    assert parts_on_disk(spark, replica) == [f"__part={part}" for part in replica.state().parts]
    replica.publish(source)
    assert replica.read().count() == 2


def stream_files(spark, batches):
    path = scratch_path(spark, "stream")
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(path)
    return path


def test_stream_inserts_missing_rows_once(spark):
    data = [frame(spark, *[(i, "x", 1, 1) for i in range(n, n + 10)]) for n in (0, 5, 20)]
    path = stream_files(spark, data)
    replica = create_replica(spark, scratch_path(spark, "test"), data[0], RULE)

    def run(checkpoint):
        stream = spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", 1).parquet(path)
        replicate_stream(stream, replica, "k", checkpoint).awaitTermination()

    first = scratch_path(spark, "cp")
    run(first)
    assert sorted(r.k for r in replica.read().collect()) == [*range(15), *range(20, 30)]
    version = replica.state().version
    run(first)
    assert replica.state().version == version
    run(scratch_path(spark, "cp"))
    assert replica.read().count() == 25


@pytest.mark.parametrize("mode", ["insert_missing", "upsert"])
def test_progress_of_a_stream(spark, mode):
    batches = [frame(spark, (1, "a", 1, 1), (2, "b", 1, 1), (2, "b", 1, 1)), frame(spark, (2, "c", 1, 2), (3, "d", 1, 1))]
    replica = create_replica(spark, scratch_path(spark, "test"), batches[0], RULE)
    stream = spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", 1).parquet(stream_files(spark, batches))
    folder = scratch_path(spark, "progress")
    assert rows(read_progress(spark, folder)) == []
    replicate_stream(stream, replica, "k", scratch_path(spark, "cp"), mode, "mv", progress=folder).awaitTermination()
    second = (1, 2, 1, 0) if mode == "insert_missing" else (1, 2, 2, 1)
    assert rows(read_progress(spark, folder)) == [(0, 3, 2, 0), second]
    assert replica.read().count() == 3


def test_the_same_batch_number_is_applied_once(spark):
    replica = create_replica(spark, scratch_path(spark, "test"), frame(spark), RULE)
    null_key = frame(spark, (None, "n", 1, 1))
    replica.publish(null_key, stream=("s", 0))
    replica.publish(null_key, stream=("s", 0))
    assert replica.read().count() == 1


@pytest.mark.parametrize("limit", [sizing.BROADCAST_BYTES, -1])
def test_stream_upsert_in_any_order(spark, monkeypatch, limit):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", limit)
    target = frame(spark, (1, "old", 1, 5), (2, "b", 1, 1), (3, "n", 1, None))
    batches = [
        frame(spark, (1, "late", 1, 9), (2, "b", 1, 1)),
        frame(spark, (1, "early", 1, 7), (1, "older", 1, 2), (4, "d", 2, 2), (4, "d9", 2, 9), (4, "d3", 2, 3)),
        frame(spark, (None, "x", 2, 2), (3, "n1", 1, 0)),
    ]
    for order in ([0, 1, 2], [2, 1, 0]):
        replica = replica_of(spark, target, target)
        path = stream_files(spark, [batches[i] for i in order])
        stream = spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", 1).parquet(path)
        replicate_stream(stream, replica, "k", scratch_path(spark, "cp"), "upsert", "mv").awaitTermination()
        assert rows(replica.read()) == sorted(
            [(1, "late", 1, 9), (2, "b", 1, 1), (3, "n1", 1, 0), (4, "d9", 2, 9), (None, "x", 2, 2)], key=repr
        )
    with pytest.raises(ValueError):
        replicate_stream(stream, replica, "k", "x", "upsert")


def test_cipher(spark):
    key = cipher.derive_key("secret", bytes(16))
    assert len(key) == 32 and key != cipher.derive_key("secret", bytes([1] * 16))
    df = spark.createDataFrame([("a",), ("é" * 100,), ("",), (None,), ("a",)], "t STRING")
    sealed = df.select("t", cipher.encrypt(F.col("t"), key).alias("c")).checkpoint()
    assert sealed.where("t = 'a'").select("c").distinct().count() == 2
    back = sealed.select("t", cipher.decrypt(F.col("c"), key).alias("d")).collect()
    assert all(r.t == r.d for r in back)
    with pytest.raises(ValueError):
        cipher.derive_key("", bytes(16))
    with pytest.raises(ValueError):
        cipher.derive_key("x", b"short")


def test_scalars(spark):
    df = spark.createDataFrame([("7", " "), ("x", "　\t"), (None, " a"), ("99999999999", "​")], "n STRING, l STRING")
    got = df.select(scalars.int_or_default(F.col("n"), -1), scalars.is_blank(F.col("l"))).collect()
    assert [tuple(r) for r in got] == [(7, True), (-1, True), (-1, False), (99999999999, False)]
    values = spark.sql("SELECT 12.0D a, 7 b, CAST(-3 AS DECIMAL(5,0)) c, ' +5 ' d, '1x' e, '1.5' f, '' g")
    got = values.select(*[scalars.int_or_default(F.col(c), -9).alias(c) for c in values.columns]).first()
    assert tuple(got) == (12, 7, -3, 5, -9, -9, -9)
    row = spark.range(1).select(
        scalars.zero_pad(F.lit(7), 3), scalars.zero_pad(F.lit(1234), 3), scalars.strip_brackets(F.lit("[a].[b]")),
        scalars.time_stamp(F.lit("2020-01-02 03:04:05").cast("timestamp")), scalars.first_match(F.lit("x_12_34"), r"\d+"),
    ).first()
    assert tuple(row) == ("007", "1234", "a.b", "20200102030405", "12")
    assert len(scalars.time_stamp_now()) == 14


@pytest.mark.parametrize("files, backwards", [(1, False), (3, True), (20, False)])
def test_a_stream_gives_one_table_however_it_is_cut(spark, files, backwards):
    """Ties in the version, missing versions and repeated rows, in either order."""
    changes = [(k % 5, f"v{k * 7 % 11}", k % 3, [None, 2, 2, 5, -4][k * 3 % 5]) for k in range(40)]
    changes += [(8, "low", 1, -9), (8, "none", 1, None), (9, "a", 1, 5), (9, "b", 2, 5), (9, "b", 2, 5)]
    expected = {}
    for row in changes:
        order = (row[3] is not None, row[3] or 0, row[1], row[2])
        if row[0] not in expected or order > expected[row[0]][0]:
            expected[row[0]] = order, row
    source = stream_files(spark, [frame(spark, row) for row in (changes[::-1] if backwards else changes)])
    replica = create_replica(spark, scratch_path(spark, "test"), frame(spark), RULE)
    stream = spark.readStream.schema(frame(spark).schema).option("maxFilesPerTrigger", files).parquet(source)
    replicate_stream(stream, replica, "k", scratch_path(spark, "checkpoint"), "upsert", "mv").awaitTermination()
    assert rows(replica.read()) == sorted((row for _, row in expected.values()), key=repr)


def test_a_versioned_table_is_followed(spark):
    rule = SyncRule("cv", "mv", "k", "v <> 'x'")
    tables = [
        frame(spark, (1, "a", 1, 1), (2, "x", 9, 9), (3, "c", 1, None)),
        frame(spark, (1, "a2", 1, 2), (2, "x", 9, 9), (3, "c", 1, None), (4, "d", 2, 1)),
        frame(spark, (1, "a2", 1, 2), (4, "d2", 2, 5), (5, "e", 3, None)),
    ]
    now = [0]
    replica = create_replica(spark, scratch_path(spark, "test"), tables[0], rule)

    def run(checkpoint):
        replicate_table(spark, lambda: tables[now[0]], replica, rule, checkpoint, "t").awaitTermination()

    checkpoint = scratch_path(spark, "cp")
    run(checkpoint)
    assert rows(replica.read()) == [(1, "a", 1, 1), (3, "c", 1, None)]
    version = replica.state().version
    run(scratch_path(spark, "cp"))  # a new checkpoint repeats nothing
    assert replica.state().version == version and replica.state().marks["table t"] == [1, 1]
    now[0] = 1
    run(checkpoint)
    assert rows(replica.read()) == [(1, "a2", 1, 2), (3, "c", 1, None), (4, "d", 2, 1)]
    now[0] = 2
    run(checkpoint)
    assert rows(replica.read()) == [(1, "a2", 1, 2), (3, "c", 1, None), (4, "d2", 2, 5), (5, "e", 3, None)]
    assert replica.state().marks["table t"] == [3, 5]


def test_every_row_is_in_one_step(spark):
    source = frame(spark, *[(k, "v", k % 7 if k % 5 else None, k % 4 if k % 3 else None) for k in range(60)])
    marks = [Watermark(-1, -1), Watermark(2, 1), Watermark(2, 3), Watermark(6, 3)]
    steps = [row for low, high in zip(marks, marks[1:]) for row in rows(rows_between(source, low, high, RULE))]
    assert sorted(steps, key=repr) == rows(source.where("cv IS NOT NULL OR mv IS NOT NULL"))


@pytest.mark.parametrize("bits, small", [(10, 64), (2, 3)])
def test_reconcile(spark, monkeypatch, bits, small):
    monkeypatch.setattr(reconciling, "ROUND_BITS", bits)
    monkeypatch.setattr(reconciling, "SMALL_RANGE", small)
    same = [(k, f"v{k}", k, None) for k in range(300)]
    source = frame(spark, *same, (1000, "new", 1, 1), (1001, "old", 1, 1), (1002, None, 1, 1), (7, "v7", 7, None), (None, "n", 1, 1), (None, "n", 1, 1))
    target = frame(spark, *same, (1001, "changed", 1, 1), (1002, "", 1, 1), (2000, "gone", 1, 1), (None, "n", 1, 1), (1003, "x", None, 5))
    expected = [(7, "changed", 2, 1), (1000, "missing", 1, 0), (1001, "changed", 1, 1), (1002, "changed", 1, 1), (2000, "extra", 0, 1), (1003, "extra", 0, 1), (None, "changed", 2, 1)]
    assert rows(reconciling.reconcile(source, target, "k")) == sorted(expected, key=repr)
    assert rows(reconciling.reconcile(source, source, "k")) == []
    assert reconciling.reconcile(source, target.limit(0), "k").where("status = 'missing'").count() == 304
    # Columns that are missing in other places give other rows.
    a, b = frame(spark, (1, "a", None, 5)), frame(spark, (1, "a", 5, None))
    assert rows(reconciling.reconcile(a, b, "k")) == [(1, "changed", 1, 1)]


def test_reconcile_shuffles_what_differs(spark):
    source = spark.range(400_000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    target = source.where("k <> 77").withColumn("v", F.when(F.col("k") % 100_000 == 5, "other").otherwise(F.col("v")))
    found = reconciling.reconcile(source, target, "k")
    assert rows(found) == sorted([(77, "missing", 1, 0), *((n * 100_000 + 5, "changed", 1, 1) for n in range(4))], key=repr)
    records = shuffled_records(spark, found)
    assert 0 < records < 200, records


def shuffled_records(spark, df):
    context = spark.sparkContext._jsc.sc()
    doubles = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)

    def stages():
        found = context.statusStore().stageList(None, False, False, doubles, spark._jvm.java.util.ArrayList())
        return {found.apply(n).stageId(): found.apply(n).shuffleWriteRecords() for n in range(found.size())}

    before = stages()
    df.select("*").collect()  # a plan of its own, whose stages run anew
    context.listenerBus().waitUntilEmpty(10_000)
    return sum(n for stage, n in stages().items() if stage not in before)
