"""Operators on vectors, conversations and pages, and the pipeline, against plain Python."""

import gzip
import os
import random

import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline
from carrack.llm import langid, quotes, vectors, warc
from carrack.llm.queries import ORACLES, QUERIES
from carrack.session import scratch_path
from check import canonical

NAN, INF = float("nan"), float("inf")


def cosine(a, b):
    a, b = np.array(a, np.float64), np.array(b, np.float64)
    return float(a @ b) / float(np.sqrt(a @ a) * np.sqrt(b @ b))


@pytest.mark.parametrize("block", [7, 4096])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_near_vectors(spark, block, kind):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(6, 12))
    found = [base[n % 6] + rng.normal(size=12) * (0.02 + 0.2 * (n % 4)) for n in range(60)]
    found += [found[0], found[1] * 3, -found[2], found[3] * 1e-30, rng.normal(size=5)]
    data = [(n, [float(np.float32(x)) for x in v]) for n, v in enumerate(found)]
    odd = [None, [], [0.0] * 12, [1.0, None, *[0.5] * 10], [NAN] * 12, [INF, *[1.0] * 11]]
    rows = [*data, *[(500 + n, v) for n, v in enumerate(odd)], data[4]]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, n_links int")

    def linked(a, b):
        x, y = rows[a][1], rows[b][1]
        usable = all(v and None not in v and np.isfinite(v).all() and any(v) for v in (x, y))
        return usable and len(x) == len(y) and cosine(x, y) >= 0.9

    at = brute.components(len(rows), linked)
    expected = sorted(
        (i, sum(linked(n, m) for m in range(len(rows)) if m != n), rows[at[n]][0], i == rows[at[n]][0])
        for n, (i, _) in enumerate(rows)
    )
    assert sorted(map(tuple, vectors.near_vectors(frame, block=block).collect())) == expected
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def test_the_error_bound_is_rigorous():
    rng = np.random.default_rng(3)
    a = vectors.Quantised(rng.normal(size=(200, 1500)).astype(np.float32))
    exact = (a.given / a.norm[:, None]) @ (a.given / a.norm[:, None]).T
    about = vectors._product(a.q, a.q) * a.scale[:, None] * a.scale
    assert (np.abs(exact - about) <= a.error[:, None] * a.length + a.error).all()
    assert (vectors._product(a.q, a.q) == a.q.astype(np.int64) @ a.q.astype(np.int64).T).all()


MESSAGES = [
    (1, 0, "user", "Hello there everyone.\r\nThis is the plan we made.\n\nSecond paragraph is here."),
    (1, 1, "assistant", "> hello THERE   everyone.\n> This is the plan we made.\nI agree with that plan fully."),
    (1, 2, "user", "> > Second paragraph is here.\n> I agree with that plan fully.\n\nThanks a lot for agreeing."),
    (1, 3, "user", "No quotation in this one."),
    (1, 4, "user", ">> I agree with that plan fully.\n> Thanks a lot for agreeing.\nfinal words of mine"),
    (1, 5, "user", "> words that nobody wrote before\nso this is a root"),
    (1, 6, "user", "> I quote a later message here\nown"),
    (1, 7, "user", "I quote a later message here"),
    (2, 0, "user", None),
    (2, 1, "user", ""),
    (None, 1, "user", "> hello there everyone."),
    (2, 2, "user", "> Hello there everyone.\nfrom another conversation"),
]


def test_quotation_links(spark):
    frame = spark.createDataFrame([(*m, 0) for m in MESSAGES], "conv_id long, turn long, role string, text string, depth int")
    got = {(r["conv_id"], r["turn"]): r for r in quotes.linked_conversations(frame).collect()}
    assert len(got) == len(MESSAGES)
    places = {k: (r["parent_turn"], r["root_turn"], r["depth"]) for k, r in got.items()}
    expected = {(1, 1): (0, 0, 1), (1, 2): (1, 0, 2), (1, 4): (2, 0, 3)}
    assert places == {(c, t): expected.get((c, t), (None, t, 0)) for c, t, _, _ in MESSAGES}
    assert got[1, 2]["own_text"] == "Thanks a lot for agreeing."
    assert got[1, 0]["own_text"] == MESSAGES[0][3] and got[2, 0]["own_text"] == ""
    assert quotes.linked_conversations(frame.limit(0)).count() == 0


def test_a_long_reply_chain_and_a_common_passage(spark):
    """Depths by pointer doubling; a passage that all share links to its first message only."""
    chain = [(1, n, "u", f"message number {n} of the chain\n" + (f"> message number {n - 1} of the chain" if n else "")) for n in range(40)]
    common = [(2, n, "u", "the same words in all of them\n" + "> the same words in all of them" * (n > 0)) for n in range(40)]
    frame = spark.createDataFrame(chain + common, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["root_turn"], r["depth"]) for r in quotes.linked_conversations(frame).collect()}
    assert all(got[1, n] == (0, n) for n in range(40))
    assert all(got[2, n] == (0, min(n, 1)) for n in range(40))


def test_short_quotations_link(spark):
    """Passages of any length tell a source; a short one at the first level is the parent, not its grandparent."""
    rows = [
        (1, 0, "u", "the original question"),
        (1, 1, "u", "> the original question\nok, go"),
        (1, 2, "u", "> ok, go\n>> the original question\ngone"),
        (2, 0, "u", "好的。"),
        (2, 1, "u", "> 好的。\n谢谢"),
        (2, 2, "u", "> 谢谢\n> \nA"),
        (2, 3, "u", "> a\nend"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["parent_turn"], r["root_turn"], r["depth"]) for r in quotes.linked_conversations(frame).collect()}
    chain = {(c, t): (t - 1 if t else None, 0, t) for c, t, _, _ in rows}
    assert got == chain


PAGES = [
    (5, "http://a/", "<p>é</p>"),
    (3, "http://b/\r\nX: y", "<p>é</p>"),
    (4, None, None),
    (9, "http://d/", ""),
    (-7, "http://e/", "WARC/1.1\r\n\r\n" * 3),
    (None, "http://f/", "<p>é</p>"),
    (12, "http://g/", "z" * 300_000),
    (13, "http://h/", "z" * 300_000),
]


def quoting_rows(seed):
    """Messages that quote whole, trimmed, wrapped, nested, repeated and indented passages of earlier ones."""
    rng = random.Random(seed)
    said = lambda: " ".join(rng.choice("alpha beta gamma delta Eps zeta".split()) for _ in range(rng.randrange(1, 5))) + rng.choice(".!?") + rng.choice(["", "", "。好！"])
    rows = []
    for conv in range(12):
        texts = []
        for turn in range(rng.randrange(1, 12)):
            text = rng.choice(["\n", " ", "\n\n"]).join(said() for _ in range(rng.randrange(1, 5)))
            for _ in range(rng.randrange(3) if texts else 0):
                old = rng.choice(texts)
                kind = rng.randrange(5)
                if kind == 0:  # one sentence
                    old = rng.choice([x for x in old.replace("\n", " ").split(". ") if x] or ["x"]) + "."
                if kind == 1:  # wrapped elsewhere
                    old = old.replace(" ", "\n", 2)
                mark = rng.choice(["> ", ">", ">> ", "> > ", "  > ", "    > "])
                text = "\n".join(mark + x for x in old.split("\n")) + rng.choice(["\n", "\r\n", "\n\n"]) + text
            texts.append(text)
            rows.append((conv, turn if rng.random() < 0.95 else None, "user", text))
    return [*rows, rows[3], rows[5], (1, 50, "user", None), (None, 1, "user", "> alpha."), (2, 60, "user", "    > code\nown"), (2, 61, "bot", "> own")]


@pytest.mark.parametrize("seed", [1, 2])
def test_quotation_links_against_a_plain_linker(spark, seed):
    rows = quoting_rows(seed)
    frame = spark.createDataFrame([(*r, "h", 1) for r in rows], "conv_id long, turn long, role string, text string, hash string, level int")
    columns = ["conv_id", "turn", "parent_turn", "root_turn", "depth", "quotations", "own_text"]
    got = quotes.linked_conversations(frame.repartition(5)).select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == brute.linked(rows)
    assert sum(r["parent_turn"] is not None for r in got) > 5


def test_a_trimmed_quotation_links(spark):
    rows = [(1, 0, "u", "First one. The middle sentence is quoted. Last one."), (1, 1, "u", "> The middle\n> sentence is quoted.\nYes."), (1, 2, "u", "    > Yes.\ncode")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["turn"]: (r["parent_turn"], r["own_text"]) for r in quotes.linked_conversations(frame).collect()}
    assert got == {0: (None, rows[0][3]), 1: (0, "Yes."), 2: (None, rows[2][3])}


def test_warc_round_trip(spark):
    warc.register(spark)
    frame = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, payload_bytes int")
    path = scratch_path(spark, "archives")
    warc.page_records(frame.repartition(3)).write.format("warc").option("roll_bytes", 1000).mode("append").save(path)
    got = spark.read.format("warc").load(path).withColumn("page_id", warc.page_id(F.col("record_id"))).collect()
    assert len(got) == len(PAGES)
    first = {3: None, 5: 3, 4: None, 9: 4, -7: None, None: 3, 12: None, 13: 12}
    by_id = {r["page_id"]: r for r in got}
    for page_id, url, html in PAGES:
        r, payload = by_id[page_id], (html or "").encode()
        assert r["payload_bytes"] == len(payload) and r["payload_digest"] == warc.payload_digest(payload)
        assert r["target_uri"] == (url.replace("\r", "%0D").replace("\n", "%0A") if url else None)
        assert r["record_type"] == ("response" if first[page_id] is None else "revisit")
        assert r["payload"] == (payload if first[page_id] is None else None)
        assert (r["refers_to"] or "").endswith(f"{first[page_id]:012x}" if first[page_id] else "")
    some = spark.read.format("warc").option("payload", False).load(path).where("record_type = 'revisit'")
    assert {r["payload"] for r in some.collect()} == {None} and some.count() == 4
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and not any("EqualTo" in x or "record_type#" in x and "= revisit" in x for x in plan.splitlines() if "Filter" in x)
    least = warc.page_records(frame, least_bytes=100).where("record_type = 'revisit'")
    assert least.count() == 1
    nothing = scratch_path(spark, "archives")
    warc.page_records(frame.limit(0)).write.format("warc").mode("append").save(nothing)
    assert spark.read.format("warc").load(nothing).count() == 0


@pytest.mark.parametrize("pack", [bytes, gzip.compress, warc.member])
def test_warc_headers_with_other_line_ends(spark, tmp_path, pack):
    """A payload is never looked for behind its own record."""
    warc.register(spark)

    def one(block, line="\r\n"):
        head = line.join(["WARC/1.0", "WARC-Type: response", "Content-Type: application/http", f"Content-Length: {len(block)}", "", ""])
        return pack(head.encode() + block + b"\r\n\r\n")

    blocks = {
        b"HTTP/1.1 200 OK\nA: b\n\nbody\r\n\r\nmore": b"body\r\n\r\nmore",
        b"HTTP/1.1 200 OK\r\nA: b": b"HTTP/1.1 200 OK\r\nA: b",
        b"": b"",
        b"x" * 5000: b"x" * 5000,
        b"HTTP/1.1 200 OK\r\n\r\n": b"",
        b"HTTP/1.1 200 OK\r\nLong: " + b"y" * 3000 + b"\r\n\r\nend": b"end",
    }
    data = b"".join(one(block) for block in blocks) + one(b"HTTP/1.1 200 OK\r\n\r\nlf", "\n")
    (tmp_path / "a.warc").write_bytes(data)
    rows = spark.read.format("warc").load(str(tmp_path)).collect()
    assert [(r["payload_bytes"], bytes(r["payload"])) for r in rows] == [(len(x), x) for x in [*blocks.values(), b"lf"]]


def test_warc_folder_lists_what_ended_well(spark):
    warc.register(spark)
    path = scratch_path(spark, "warc")
    records = warc.page_records(spark.createDataFrame([(n, "u", f"page {n}") for n in range(40)], "page_id long, url string, html string"))
    lost = F.when(F.col("record_id") == records.first()["record_id"], F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        records.repartition(4).withColumn("target_uri", lost.otherwise("x")).write.format("warc").mode("append").save(path)
    assert spark.read.format("warc").load(path).count() == 0
    writers = [warc.WarcWriter({"path": path}, False) for _ in range(2)]  # two appends at a time
    for writer, n in zip(writers, (5, 7)):
        batch = records.limit(n).toArrow().to_batches()
        writer.commit([writer.write(iter(batch))])
    assert spark.read.format("warc").load(path).count() == 12
    records.write.format("warc").mode("append").save(path)
    assert spark.read.format("warc").load(path).count() == 52
    records.limit(3).write.format("warc").mode("overwrite").save(path)
    assert spark.read.format("warc").load(path).count() == 3


def test_warc_of_other_tools(spark, tmp_path):
    """Plain records, and gzip members that do not tell their length."""
    warc.register(spark)
    one, two = (warc.record(f"urn:x:{n}", "response", "http://u/", None, b"body" * n, "2020-01-01T00:00:00Z") for n in (1, 900))
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(info + one + two)
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in (two, info, one)))
    rows = spark.read.format("warc").load(str(tmp_path)).collect()
    assert sorted((r["record_type"], r["payload_bytes"]) for r in rows) == [("response", 4), ("response", 4), ("response", 3600), ("response", 3600), ("warcinfo", 5), ("warcinfo", 5)]
    typed = spark.read.format("warc").load(str(tmp_path)).where("record_type IN ('warcinfo')").collect()
    assert [bytes(r["payload"]) for r in typed] == [b"hello"] * 2


def test_a_reader_skips_what_is_not_wanted(tmp_path):
    data = b"".join(warc.member(warc.record(f"urn:x:{n}", "response", None, None, os.urandom(200_000), "d")) for n in range(5))
    (tmp_path / "c.warc.gz").write_bytes(data)

    class Counting:
        def __init__(self, file):
            self.file, self.read_bytes, self.tell, self.seek = file, 0, file.tell, file.seek

        def read(self, n):
            found = self.file.read(n)
            self.read_bytes += len(found)
            return found

    with open(tmp_path / "c.warc.gz", "rb") as file:
        counting = Counting(file)
        assert len(list(warc.records(counting, lambda row: True, False))) == 5
        assert counting.read_bytes < len(data) / 5


def test_a_reader_goes_on_after_blank_lines(tmp_path):
    one = warc.record("urn:x:1", "response", None, None, b"body", "d")
    (tmp_path / "a.warc").write_bytes(one + b"\r\n\r\n\n" + one + b"\r\n")
    with open(tmp_path / "a.warc", "rb") as file:
        assert len(list(warc.records(file, lambda row: True, True))) == 2
    (tmp_path / "b.warc").write_bytes(one + b"WARC/1.0\r\nno blank line\r\n")
    with open(tmp_path / "b.warc", "rb") as file, pytest.raises(ValueError):
        list(warc.records(file, lambda row: True, True))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_is_its_sql(spark, small, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    result = QUERIES[name](spark, small)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert canonical(result.columns, result.collect()) == canonical(columns, cursor.fetchall())


def test_entry_has_all_operators_and_the_pipeline():
    names = [n for n in entry_module.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert "pipeline" in entry_module.queries()


def test_pipeline_stages(spark):
    """Every stage but the learned first one against plain Python, each on its own input."""
    texts = [t for t in brute.sample_texts(8, 60)]
    rows = [(n, t, "aa" if n % 2 else None, "s", len(t or "")) for n, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[12]], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["language_id"](spark, docs, "")
    model = langid.fit(docs)
    expected = [r["doc_id"] for r in langid.identified(docs, model).collect() if not r["rejected"]]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)
    assert not {0, 1, 2, 3} & set(expected) and len(expected) > 50

    def pairs(df):
        assert df.columns == docs.columns
        assert all(r["n_chars"] == len(r["text"]) for r in df.collect() if r["text"] is not None)
        return sorted((r["doc_id"], r["text"]) for r in df.collect())

    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert pairs(stages["line_dedup"](spark, docs, "")) == sorted((r[0], r[3]) for r in brute.line_dedup(given))
    assert pairs(stages["substring_dedup"](spark, docs, "")) == sorted((r[0], r[3]) for r in brute.substring_dedup(given))
    sets = [brute.shingles(t) for _, t in given]
    at = brute.components(len(given), lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    least = {given[min(m for m in range(len(given)) if at[m] == a)][0] for a in at}
    assert sorted(r["doc_id"] for r in stages["simhash_near_dedup"](spark, docs, "").collect()) == sorted(least)
    packed = stages["best_fit_packing"](spark, docs, "").collect()
    assert {r["doc_id"] for r in packed} == {n for n, _ in given}


def test_pipeline_runs(spark, small):
    from tokenizers import Tokenizer

    got = corpus_pipeline.run(spark, small).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert 0 < len({r["doc_id"] for r in got}) <= len(docs)
    assert sum(r["length"] for r in got) <= sum(len(library.encode(t or "").ids) + 1 for t in docs.values())
    assert all(r["offset"] + r["length"] <= 2048 for r in got)
