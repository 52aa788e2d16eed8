"""Text shards, against a plain Python line loop."""

import bz2
import codecs
import gzip
import inspect
import io
import itertools
import os
import random
import re

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carrack import fixtures, storage
from carrack.operators import numbering
from carrack.operators.numbering import number_lines
from carrack.oracles import ORACLES
from carrack.plans.merge import merge_shards
from carrack.sinks import files
from carrack.session import scratch_path
from carrack.sources import decoding
from carrack.sources import lines as line_source
from carrack.sources import shards as sources
from carrack.sources.shards import list_shards, scan_shards


def write(folder, shards):
    folder.mkdir(parents=True, exist_ok=True)
    for name, data in shards.items():
        data = data if isinstance(data, bytes) else data.encode()
        if name.endswith(".gz"):
            data = gzip.compress(data)
        elif name.endswith(".bz2"):
            data = bz2.compress(data)
        (folder / name).write_bytes(data)
    return str(folder)


def lines_of(data):
    text = data.decode() if isinstance(data, bytes) else data
    text = text.removeprefix("﻿")
    parts = re.split(r"\r\n|\n|\r", text)
    return parts[:-1] if parts[-1] == "" else parts


def expected(shards, skip_first, skip_others, n, field=None, has_header=True):
    outputs = [[] for _ in range(n)]
    turn = itertools.count()
    for number, name in enumerate(sorted(shards)):
        header_due = has_header and number == 0
        for line_no, line in enumerate(lines_of(shards[name])):
            if line_no < (skip_others if number else skip_first) or not line.strip():
                continue
            if header_due:
                header_due = False
                for output in outputs:
                    output.append(field[0] + field[2] + line if field else line)
                continue
            if field:
                found = re.search(field[1], name)
                line = (found.group(0) if found else "") + field[2] + line
            outputs[next(turn) % n].append(line)
    return outputs


def read(paths):
    """Lines of each output: a file, or a folder of ordered part files."""

    def text(path):
        if os.path.isdir(path):
            return "".join(text(f"{path}/{name}") for name in sorted(os.listdir(path)) if name.startswith("part-"))
        return open(path, encoding="utf-8", newline="").read()

    return [text(path).split("\n")[:-1] for path in paths]


SHARDS = {
    "a_sys_src_AAAA.txt": "h1,h2\n\n \t \n1,x\n2,y\n\n3,z\n",
    "b_sys_src_BBBB.txt": "h1,h2\n4,x\n5,y\n",
    "c.txt": "h1,h2\n\n6,x",
}
FIELD = ("Src", r"(?<=sys_src_)\w{4}", "|")


@pytest.mark.parametrize("skips", [(0, 0), (0, 1), (1, 1), (2, 0), (4, 3), (100, 0), (0, 100), (100, 100)])
@pytest.mark.parametrize("n", [1, 4])
def test_skip_and_round_robin(spark, tmp_path, skips, n):
    folder = write(tmp_path / "in", SHARDS)
    layout = "files" if skips == (0, 1) else "parts"
    result = merge_shards(spark, folder, str(tmp_path / "out" / "m.csv"), *skips, n_outputs=n, layout=layout)
    assert read(result.paths) == expected(SHARDS, *skips, n)


@pytest.mark.parametrize("has_header", [True, False])
def test_field_from_file_name(spark, tmp_path, has_header):
    folder = write(tmp_path / "in", SHARDS)
    result = merge_shards(
        spark, folder, str(tmp_path / "m.csv"), 0, 1, "txt", 2, *FIELD, has_header=has_header
    )
    assert read(result.paths) == expected(SHARDS, 0, 1, 2, FIELD, has_header)


@pytest.mark.parametrize("field", [(" ", "x", ","), ("Src", "", ","), ("Src", "x", '" "'), (None, None, None)])
def test_field_is_off_if_a_part_is_blank(spark, tmp_path, field):
    folder = write(tmp_path / "in", SHARDS)
    result = merge_shards(spark, folder, str(tmp_path / "m.csv"), 0, 1, "txt", 1, *field)
    assert read(result.paths) == expected(SHARDS, 0, 1, 1)


def test_codecs_line_ends_and_bom(spark, tmp_path):
    shards = {
        "a.csv.gz": "h\r\n1\r\n\r\n2\r\n",
        "b.csv.bz2": "h\r3\r4",
        "c.csv": codecs.BOM_UTF8 + "h\n5\n  \n6 é\n".encode(),
    }
    folder = write(tmp_path / "in", shards)
    result = merge_shards(spark, folder, str(tmp_path / "m.csv"), 0, 1)
    assert read(result.paths) == [["h", "1", "2", "3", "4", "5", "6 é"]] == expected(shards, 0, 1, 1)


@pytest.mark.parametrize("first", ["", "\n \n\t\n"])
def test_no_header_if_first_file_is_blank(spark, tmp_path, first):
    shards = {"a.txt": first, "b.txt": "h\n1\n2\n"}
    folder = write(tmp_path / "in", shards)
    result = merge_shards(spark, folder, str(tmp_path / "m.csv"), 0, 1, n_outputs=3)
    assert result.header is None
    assert read(result.paths) == expected(shards, 0, 1, 3) == [["1"], ["2"], []]


def test_twelve_outputs_have_padded_names_and_replace_files(spark, tmp_path):
    folder = write(tmp_path / "in", SHARDS)
    (tmp_path / "m_03.csv").write_text("old")
    result = merge_shards(spark, folder, str(tmp_path / "m.csv"), 0, 1, n_outputs=12)
    assert [p.rsplit("/", 1)[1] for p in result.paths] == [f"m_{i:02d}.csv" for i in range(1, 13)]
    assert read(result.paths) == expected(SHARDS, 0, 1, 12)


def test_parts_hold_the_same_lines_in_order(spark, tmp_path):
    shards = {f"{c}.txt": "h\n" + "".join(f"{c}{i}\n" for i in range(50)) for c in "abc"}
    folder = write(tmp_path / "in", shards)
    result = merge_shards(
        spark, folder, str(tmp_path / "m.csv"), 0, 1, n_outputs=2, layout="parts", rows_per_part=10
    )
    merged = []
    for path in result.paths:
        parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
        assert len(parts) == 8
        merged.append([line for part in read([f"{path}/{p}" for p in parts]) for line in part])
    assert merged == expected(shards, 0, 1, 2)


def test_files_are_joined_where_the_store_can(spark, tmp_path, monkeypatch):
    def join(spark, first, others):
        with open(first.removeprefix("file:"), "ab") as target:
            for other in others:
                target.write(open(other.removeprefix("file:"), "rb").read())

    monkeypatch.setattr(storage, "can_concat", lambda spark, path: True)
    monkeypatch.setattr(storage, "concat", join)
    shards = {f"{c}.txt": "h\n" + "".join(f"{c}{i}\n" for i in range(50)) for c in "abc"}
    folder = write(tmp_path / "in", shards)
    calls = []
    monkeypatch.setattr(files, "JOINED_AT_ONCE", 3)
    monkeypatch.setattr(storage, "concat", lambda *args: (calls.append(len(args[2])), join(*args)))
    output = str(tmp_path / "m.csv")
    result = merge_shards(spark, folder, output, 0, 1, n_outputs=2, rows_per_part=10, layout="files")
    assert read(result.paths) == expected(shards, 0, 1, 2)
    assert all(os.path.isfile(path) for path in result.paths) and max(calls) == 3


def test_all_shards_empty(spark, tmp_path):
    folder = write(tmp_path / "in", {"a.txt": "", "b.txt": ""})
    result = merge_shards(spark, folder, str(tmp_path / "m.csv"), 1, 1, n_outputs=2)
    assert read(result.paths) == [[], []] and result.n_data_lines == 0


def test_shards_of_the_fixture_grow_in_number(spark, small, monkeypatch):
    monkeypatch.setattr(fixtures, "PIECE_KEYS", 40)
    shards = list_shards(spark, fixtures.text_shards(spark, small))
    assert len(shards.names) == 12
    numbered = number_lines(spark, shards, scratch_path(spark, "t"), 0, 1)
    keys = [int(r.line.split(",")[0]) for r in numbered.lines.where("ordinal > 0").orderBy("ordinal").collect()]
    assert keys == [k for third in range(3) for k in range(third, 150, 3)]


def test_many_splits_and_bounded_runs(spark, tmp_path, monkeypatch):
    """Blocks of a few hundred bytes, runs of 16 lines, blank lines all over, groups of two files."""
    monkeypatch.setattr(numbering, "RUN_BITS", 4)
    monkeypatch.setattr(numbering, "FILES_PER_GROUP", 2)
    shards = {
        f"s{f}.txt{'.gz' if f == 2 else ''}": "".join(
            ("\n" if i % 37 == f else "") + f"{f}-{i}\n" for i in range(300 + 40 * f)
        )
        for f in range(5)
    }
    folder = write(tmp_path / "in", shards)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        numbered = number_lines(spark, list_shards(spark, folder), scratch_path(spark, "t"), 20, 7)
        got = [(r.file_name, r.line_no, r.line) for r in numbered.lines.orderBy("ordinal").collect()]
        ordinals = [r.ordinal for r in numbered.lines.select("ordinal").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = [
        (name, n, line)
        for k, name in enumerate(sorted(shards))
        for n, line in enumerate(lines_of(shards[name]))
        if line.strip() and n >= (7 if k else 20)
    ]
    assert got == want
    assert sorted(ordinals) == list(range(len(want)))
    assert numbered.total == len(want)
    assert numbered.head == want[0][2]


def test_without_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(numbering, "BROADCAST_RUNS", -1)
    folder = write(tmp_path / "in", SHARDS)
    result = merge_shards(spark, folder, str(tmp_path / "m.csv"), 1, 1, n_outputs=2)
    assert read(result.paths) == expected(SHARDS, 1, 1, 2)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    files=st.lists(st.lists(st.sampled_from(["", " ", "\t", "a", "b c", "é", ",x,"]), max_size=6), min_size=1, max_size=3),
    skips=st.tuples(st.integers(0, 3), st.integers(0, 3)),
    n=st.integers(1, 3),
    has_header=st.booleans(),
)
def test_any_shards(spark, tmp_path_factory, files, skips, n, has_header):
    base = tmp_path_factory.mktemp("any")
    shards = {f"{i}.txt": "".join(line + "\n" for line in lines) for i, lines in enumerate(files)}
    folder = write(base / "in", shards)
    result = merge_shards(spark, folder, str(base / "m.csv"), *skips, n_outputs=n, has_header=has_header)
    assert read(result.paths) == expected(shards, *skips, n, has_header=has_header)


def test_subfolders_are_not_read(spark, tmp_path):
    folder = write(tmp_path / "in", {"a.txt": "1\n2\n"})
    write(tmp_path / "in" / "k=1", {"b.txt": "3\n"})
    write(tmp_path / "in" / "in", {"c.txt": "4\n"})
    lines = scan_shards(spark, list_shards(spark, folder))
    assert sorted(r.line for r in lines.collect()) == ["1", "2"]


def test_names_with_spaces_and_other_letters(spark, tmp_path):
    shards = {"a b%20#é.txt": "h\n1\n", "z+x.txt": "h\n2\n"}
    folder = write(tmp_path / "i n", shards)
    write(tmp_path / "i n" / "sub", {"b.txt": "3\n"})
    result = merge_shards(spark, folder, str(tmp_path / "m.csv"), 0, 1)
    assert read(result.paths) == [["h", "1", "2"]]


def test_refused_input(spark, tmp_path):
    out = str(tmp_path / "m.csv")
    folder = write(tmp_path / "in", {"a.txt": "1\n"})
    with pytest.raises(ValueError):
        merge_shards(spark, folder, out, n_outputs=0)
    with pytest.raises(ValueError):
        merge_shards(spark, folder, out, -1, 0)
    with pytest.raises(ValueError):
        merge_shards(spark, folder, out, codec="gzip")
    with pytest.raises(ValueError):
        merge_shards(spark, folder, out, codec="lzw")
    with pytest.raises(ValueError):
        merge_shards(spark, folder, " ")
    with pytest.raises(FileNotFoundError):
        merge_shards(spark, str(tmp_path / "none"), out)
    with pytest.raises(FileNotFoundError):
        merge_shards(spark, write(tmp_path / "empty", {}), out)
    with pytest.raises(ValueError):
        list_shards(spark, write(tmp_path / "hidden", {"a.txt": "1\n", "_b.txt": "2\n"}))
    with pytest.raises(ValueError):
        list_shards(spark, write(tmp_path / "mixed", {"a.txt": "1\n", "b.gz": "2\n"}), "txt")


def test_names_of_many_pieces_sort_as_their_numbers():
    names = [f"cust_0_{piece:09d}_plain.csv" for piece in (999, 1000, 12345)]
    assert names == sorted(names)
    sql = duckdb.sql("SELECT 'cust_0_' || lpad(CAST(p AS VARCHAR), 9, '0') || '_plain.csv' FROM (VALUES (999), (1000), (12345)) v(p)")
    assert sorted(r[0] for r in sql.fetchall()) == names
    assert "{piece:09d}" in inspect.getsource(fixtures.text_shards) and "VARCHAR), 9, '0')" in ORACLES["shard_scan"]
    padded = "SELECT lpad(CAST(k AS VARCHAR), greatest(8, length(CAST(k AS VARCHAR)))::INTEGER, '0') FROM (VALUES (123456789), (5)) v(k)"
    assert [r[0] for r in duckdb.sql(padded).fetchall()] == ["123456789", "00000005"]


# Shards that Spark's reader cannot decode

TEXT = "h\r\n1 é€\U0001f600\r2\n\n3 still 3\x85\x0b\n last"


def scanned(spark, folder, codec="auto"):
    """Lines by file, in their order."""
    found = {}
    rows = scan_shards(spark, list_shards(spark, folder, codec)).collect()
    for r in sorted(rows, key=lambda r: (r["file_name"], r["block_start"], r["line_id"])):
        found.setdefault(r["file_name"], []).append(r["line"])
    return found


def test_marked_encodings_and_lzw(spark, tmp_path):
    shards = {"plain.txt": TEXT.encode(), "z.csv.Z": fixtures.lzw_compressed(TEXT.encode())}
    for mark, name in decoding.MARKS:
        shards[f"{name}.txt"] = mark + TEXT.encode(name)
        shards[f"{name}.csv.gz"] = mark + TEXT.encode(name)
        shards[f"{name} x.Z"] = fixtures.lzw_compressed(mark + TEXT.encode(name))
    folder = write(tmp_path / "in", shards)
    (tmp_path / "in" / "zzz.txt").write_bytes(codecs.BOM_UTF16_LE)
    assert scanned(spark, folder) == {name: lines_of(TEXT) for name in shards}
    result = merge_shards(spark, folder, str(tmp_path / "m.csv"), 0, 1)
    assert read(result.paths)[0] == ["h"] + [x for x in lines_of(TEXT)[1:] if x.strip()] * len(shards)


def test_what_cannot_be_decoded_is_replaced(spark, tmp_path):
    data = codecs.BOM_UTF16_LE + "a\nb".encode("utf-16-le") + b"\x00\xd8\n\x00c"
    folder = write(tmp_path / "in", {"a.txt": data, "b.Z": fixtures.lzw_compressed(b"x\xff\xfey\nz")})
    assert scanned(spark, folder) == {"a.txt": ["a", "b�", "�"], "b.Z": ["x��y", "z"]}


def test_lzw_only_and_damaged(spark, tmp_path):
    good = fixtures.lzw_compressed(b"1\n2\n" * 5000, 12, 700)
    folder = write(tmp_path / "in", {"a.Z": good, "b.z": good})
    assert scanned(spark, folder, "lzw") == {"a.Z": ["1", "2"] * 5000, "b.z": ["1", "2"] * 5000}
    with pytest.raises(ValueError):
        list_shards(spark, folder, "txt")
    for number, bad in enumerate([b"no lzw", good[:3] + b"\xff" * 40, b"\x1f\x9d\x1f" + good[3:]]):
        folder = write(tmp_path / f"bad{number}", {"a.Z": bad})
        with pytest.raises(Exception, match="LZW"):
            scanned(spark, folder)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000), st.sampled_from([9, 10, 12, 16]), st.sampled_from([None, 40, 300]), st.integers(1, 50))
def test_lzw_gives_back_what_was_packed(data, most, clear_after, step):
    packed = fixtures.lzw_compressed(data * step, most, clear_after)
    assert b"".join(decoding.lzw(packed[n : n + 7] for n in range(0, len(packed), 7))) == data * step


def member_shard(rng, n, size=3000):
    """Text cut into gzip members anywhere, inside lines and line ends and characters too."""
    text = "".join(f"{k} {rng.choice(['', 'é', f'{rng.getrandbits(1600):x}'])}" + rng.choice(["\n", "\r\n", "\r", "\r\n\r\n"]) for k in range(n))
    data = text.encode()
    cuts = sorted({0, len(data), *(rng.randrange(len(data)) for _ in range(len(data) // size))})
    return data, b"".join(gzip.compress(data[a:b]) for a, b in zip(cuts, cuts[1:]))


def test_members_of_a_large_gzip_shard_are_read_side_by_side(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sources, "MEMBER_RANGE", 6000)
    monkeypatch.setattr(line_source, "PARTITION_BYTES", 1)
    rng = random.Random(6)
    (tmp_path / "in").mkdir()
    whole = {}
    for name in ("a.csv.gz", "b.csv.gz"):
        data, packed = member_shard(rng, 2500)
        (tmp_path / "in" / name).write_bytes(packed + b"\0" * 9)
        whole[name] = lines_of(data.decode())
    single = "\n".join(str(rng.random()) for _ in range(3000))
    (tmp_path / "in" / "c.gz").write_bytes(gzip.compress(single.encode()))
    whole["c.gz"] = single.split("\n")
    shards = list_shards(spark, str(tmp_path / "in"))
    tasks = sources.plan_tasks(spark, shards)
    assert {t["name"] for t in tasks} == {"a.csv.gz", "b.csv.gz"} and len(tasks) >= 20
    read_by = scan_shards(spark, shards).where("file_name <> 'c.gz'").select(F.spark_partition_id()).distinct().count()
    assert read_by >= 20
    assert scanned(spark, str(tmp_path / "in")) == whole
    numbered = number_lines(spark, shards, scratch_path(spark, "lines"), 0, 2).lines.collect()
    assert {(r["file_name"], r["line_no"]): r["line"] for r in numbered} == {
        (name, n): line for name, found in whole.items() for n, line in enumerate(found) if line.strip() and (name == "a.csv.gz" or n >= 2)
    }


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"bc", b"\n", b"\r", b"\r\n", b""]), max_size=14), st.data())
def test_every_line_belongs_to_one_range_of_members(pieces, data):
    packed, starts = b"", []
    for piece in pieces:
        starts.append(len(packed))
        packed += gzip.compress(piece, mtime=0)
    edges = sorted({0, *data.draw(st.sets(st.sampled_from(starts)) if starts else st.just(set()))})
    got = []
    for start, end in zip(edges, [*edges[1:], None]):
        found = decoding.owned(decoding.members(io.BytesIO(packed), start), start, end)
        got += [line.decode() for part in decoding.lines(found) for line in part]
    assert got == lines_of(b"".join(pieces))


def test_damaged_gzip_and_false_starts_raise(spark, tmp_path):
    data, packed = member_shard(random.Random(1), 400)
    with pytest.raises(EOFError):
        list(decoding.members(io.BytesIO(packed[:-5]), 0))
    with pytest.raises(ValueError, match="no gzip member"):
        list(decoding.owned(decoding.members(io.BytesIO(packed), 0), 0, len(packed) // 2))
    assert decoding.first_member(io.BytesIO(b"\x1f\x8b\x08\x00 no" + packed), 0, 50) == 7
    assert decoding.first_member(io.BytesIO(b"x" * 3_000_000), 0, 3_000_000) is None
