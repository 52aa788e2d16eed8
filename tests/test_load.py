import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carrack import storage
from carrack.functions import cipher
from carrack.operators.mapping import find_column, map_by_position
from carrack.plans.load import load_routed, load_statements, routed_reports, union_statements
from carrack.sinks.routed import read_routed
from carrack.sinks.tables import append_table
from carrack.sources.statements import split_statements, statement_list


@pytest.fixture
def table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (row_id BIGINT, id BIGINT, name STRING) USING parquet LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP TABLE {name}")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_statements_split_outside_quotes():
    assert split_statements("select ';' a ; ; select \"x;y\";\n select `b;`, 'it''s;'") == [
        "select ';' a",
        'select "x;y"',
        "select `b;`, 'it''s;'",
    ]
    assert split_statements(" ; \n;") == []
    assert [s.package for s in statement_list(["a"] * 11)][-2:] == ["BCP_10", "BCP_11"]
    with pytest.raises(ValueError):
        statement_list(" ; ")


def test_union_keeps_duplicates_and_goes_by_position(spark):
    df = union_statements(spark, "select 1 a, 'x' b; select 1 c, 'x' d; select 2, 'y' where false")
    assert rows(df) == [(1, "x"), (1, "x")]


def test_find_column_lists_the_columns(spark):
    df = spark.sql("select 1 as ` Abc `, 2 as d")
    assert find_column(df, "ABC ") == " Abc "
    with pytest.raises(ValueError, match="d"):
        find_column(df, "x")


def test_map_by_position(spark):
    df = spark.sql("select 1 a, 'n' a, 3.5D extra")
    to = T.StructType().add("row_id", "long").add("id", "long").add("name", "string")
    assert rows(map_by_position(df, to, ["ROW_ID"])) == [(None, 1, "n")]
    assert rows(map_by_position(df, to, ["row_id"], {"row_id": F.lit(9)})) == [(9, 1, "n")]
    with pytest.raises(ValueError, match="column count mismatch"):
        map_by_position(df.select(F.lit(1)), to, ["row_id"])


def test_append_twice(spark, table):
    df = spark.sql("select 1 a, 'x' b")
    append_table(df, table, ["row_id"])
    append_table(df, table, ["row_id"])
    assert rows(spark.table(table)) == [(None, 1, "x")] * 2


def test_report_has_empty_and_failing_statements(spark, table):
    result = load_statements(
        spark,
        ["select 1, 'a' union all select 2, 'b'", "select 1, 'a' where false", "select 1", "select * from nowhere"],
        table,
        ["row_id"],
    )
    got = [(r.BCPPackage, r.NumRecords, r.HasError, bool(r.ProcessingError)) for r in result.report.collect()]
    assert got == [
        ("BCP_01", 2, False, False),
        ("BCP_02", 0, False, False),
        ("BCP_03", 0, True, True),
        ("BCP_04", 0, True, True),
    ]
    assert result.n_records == 2 == spark.table(table).count()
    assert result.records_per_second >= 0


def test_a_failure_while_running_is_isolated(spark, table):
    bad = "select raise_error(concat('bad row ', id)) + 0, 'x' from range(3)"
    result = load_statements(spark, ["select id, 'a' from range(5)", bad, "select 7, 'c'"], table, ["row_id"])
    got = [(r.NumRecords, r.HasError) for r in result.report.collect()]
    assert got == [(5, False), (0, True), (1, False)]
    assert "bad row" in result.report.collect()[1].ProcessingError
    assert spark.table(table).count() == 6 == result.n_records
    with pytest.raises(Exception, match="bad row"):
        load_statements(spark, ["select 8, 'd'", bad], table, ["row_id"], on_error="raise")
    assert spark.table(table).count() == 6


def test_a_statement_with_its_own_shuffle_is_counted_once(spark, table):
    sql = "select id % 10, max(cast(id as string)) from range(1000) group by 1"
    result = load_statements(spark, [sql, sql], table, ["row_id"])
    assert [r.NumRecords for r in result.report.collect()] == [10, 10]
    assert spark.table(table).count() == 20


SCHEMA = T.StructType().add("id", "long").add("flag", "string")


def test_routed_load_keeps_null_and_empty_apart(spark, tmp_path):
    spark.sql("select * from values (1, 'A', 'x'), (2, 'B', 'x'), (3, null, 'y'), (4, '', 'y'), (5, 'A/=% ', 'y') t(id, flag, other)").createOrReplaceTempView("routed_in")
    path = str(tmp_path / "routed")
    result = load_routed(spark, "select * from routed_in; select id + 10, flag from routed_in", SCHEMA, path, " FLAG", label="T")
    got = rows(result.report.select("NumRecords", "HasError", "BCPSplitOnValueOfField", "BCPSplitOnValue", "ProcessingError"))
    assert got == sorted(
        [(2, False, " FLAG", v, "") for v in ("A", "B", "", "", "A/=% ")], key=repr
    )
    assert {r.BCPPackage for r in result.report.collect()} >= {"BCP T :  FLAG = A"}
    want = sorted([(n + k, f) for k in (0, 10) for n, f in [(1, "A"), (2, "B"), (3, None), (4, ""), (5, "A/=% ")]], key=repr)
    assert rows(read_routed(spark, path, SCHEMA)) == want
    load_routed(spark, "select * from routed_in", SCHEMA, path, "other")
    assert read_routed(spark, path, SCHEMA).count() == 15


def test_routed_load_errors_leave_nothing(spark, tmp_path):
    path = str(tmp_path / "routed")
    with pytest.raises(ValueError, match="available columns"):
        load_routed(spark, "select 1 id, 'x' flag", SCHEMA, path, "nope")
    with pytest.raises(ValueError, match="distinct"):
        load_routed(spark, "select id, 'x' flag from range(5)", SCHEMA, path, "id", max_splits=4)
    with pytest.raises(Exception, match="bad row"):
        load_routed(spark, "select raise_error('bad row') + id id, 'x' flag from range(3)", SCHEMA, path, "flag")
    assert not [p for p in (tmp_path / "routed").glob("*") if not p.name.startswith(".")] if (tmp_path / "routed").exists() else True
    load_routed(spark, "select id, 'x' flag from range(5)", SCHEMA, path, "id", load_id="one", max_splits=5)
    with pytest.raises(FileExistsError):
        load_routed(spark, "select id, 'x' flag from range(5)", SCHEMA, path, "id", load_id="one")


def test_a_hot_value_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    try:
        sql = "select id, if(id % 3 = 0, 'hot', cast(id % 50 as string)) flag from range(0, 30000, 1, 8)"
        result = load_routed(spark, sql, SCHEMA, str(tmp_path / "r"), "flag")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert result.n_records == 30000
    assert len(list((tmp_path / "r").glob("*/__route=vhot/*.parquet"))) > 1


@pytest.mark.parametrize(
    "text, expected",
    [
        (r"select 'it\'s; x' a; select 2", [r"select 'it\'s; x' a", "select 2"]),
        ("select 1 -- a; b\n; select 2", ["select 1 -- a; b", "select 2"]),
        ("select 1 -- don't ;\n; select 2 -- can't", ["select 1 -- don't ;", "select 2 -- can't"]),
        ("/* ; /* ; */ ' */ select ';' ; ; select `a;b`", ["/* ; /* ; */ ' */ select ';'", "select `a;b`"]),
        ("select r'\\'; select 'x;'", ["select r'\\'", "select 'x;'"]),
        ("-- nothing; here\n/* ; */", []),
        ("select 'it''s; x'; select 2", ["select 'it''s; x'", "select 2"]),
    ],
)
def test_statements_are_split_outside_quotes_and_comments(text, expected):
    assert split_statements(text) == expected


def test_cipher_by_a_published_vector(spark):
    """AES-256 in CBC mode, NIST SP 800-38A F.2.5; the padding adds a block."""
    key = bytes.fromhex("603deb1015ca71be2b73aef0857d77811f352c073b6108d72d9810a30914dff4")
    iv = bytes(range(16))
    plain = bytes.fromhex("6bc1bee22e409f96e93d7e117393172aae2d8a571e03ac9c9eb76fac45af8e51")
    expected = "f58c4c04d6e5f1ba779eabfb5f7bfbd69cfc4e967edb808d679f777bc6702c7d"
    one = spark.createDataFrame([(plain, "text"), (None, None)], "raw binary, text string")
    sealed = one.select(
        F.lower(F.hex(cipher.encrypt(F.col("raw"), key, iv))).alias("bare"),
        cipher.decrypt(cipher.encrypt(F.col("text"), key, iv), key, iv).alias("text"),
    ).collect()
    assert sealed[0]["bare"].startswith(expected) and len(sealed[0]["bare"]) == len(expected) + 32
    assert sealed[0]["text"] == "text" and tuple(sealed[1]) == (None, None)
    with pytest.raises(ValueError):
        cipher.encrypt(F.col("text"), key, b"short")


def test_reports_outlive_the_driver(spark, tmp_path, monkeypatch):
    """The report is there as soon as the rows are, and a failed statement leaves one too."""
    spark.range(30).selectExpr("id", "CASE id % 3 WHEN 0 THEN 'a' WHEN 1 THEN '' END AS s").createOrReplaceTempView("reported")
    schema, path = T.StructType().add("id", "long"), str(tmp_path / "routed")
    shown = storage.rename

    def ended(*args):
        shown(*args)
        raise KeyboardInterrupt

    monkeypatch.setattr(storage, "rename", ended)
    with pytest.raises(KeyboardInterrupt):
        load_routed(spark, "SELECT id, s FROM reported", schema, path, "s", load_id="first", label="t")
    monkeypatch.setattr(storage, "rename", shown)
    got = routed_reports(spark, path).collect()
    assert sorted((r["load_id"], r["BCPPackage"], r["NumRecords"], r["error"]) for r in got) == [
        ("first", "BCP t : s = ", 10, None), ("first", "BCP t : s = ", 10, None), ("first", "BCP t : s = a", 10, None)
    ]
    assert read_routed(spark, path, schema).count() == 30
    statements = "SELECT id, s FROM reported; SELECT id, nothing FROM reported; SELECT raise_error('bad row') AS id, s FROM reported"
    result = load_routed(spark, statements, schema, path, "s", load_id="second", label="t", on_error="report")
    assert result.n_records == 30 and result.report.where("HasError").count() == 2
    got = routed_reports(spark, path).where("load_id LIKE 'second%'").collect()
    assert sum(r["NumRecords"] or 0 for r in got) == 30
    failed = sorted((r["load_id"], r["error"]) for r in got if r["error"])
    assert [name for name, _ in failed] == ["second-BCP_02", "second-BCP_03"] and "bad row" in failed[1][1]
    assert read_routed(spark, path, schema).count() == 60
    assert routed_reports(spark, str(tmp_path / "none")).count() == 0
