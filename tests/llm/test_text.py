"""Operators on texts against plain Python."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from carrack.llm import bloom, langid, lines, packing, pieces, simhash, substrings, syncmers

import brute

SCHEMA = "doc_id long, text string, n_lines string, bits int, digests array<string>, spans int"


@pytest.fixture(scope="module")
def rows():
    texts = brute.sample_texts(3, 90)
    found = list(enumerate(texts))
    return [*found, found[20], found[30], (None, texts[25]), (None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With columns that clash with names of the operators."""
    wide = [(i, t, "x", 1, ["d"], 2) for i, t in rows]
    return spark.createDataFrame(wide, SCHEMA).repartition(5)


def ordered(rows):
    return sorted(rows, key=repr)


def test_line_dedup(spark, docs, rows):
    got = lines.drop_repeated_lines(docs, log2_bits=16)
    assert {"doc_id", "text", "digests", "kept_text"} <= set(got.columns)
    got = [tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()]
    assert ordered(got) == ordered(brute.line_dedup(rows))
    assert any(r[2] for r in got)
    empty = lines.drop_repeated_lines(docs.limit(0), log2_bits=16)
    assert empty.count() == 0


def test_line_dedup_with_a_full_filter(spark, docs, rows):
    """A filter that is too small only suspects more lines."""
    got = lines.drop_repeated_lines(docs, log2_bits=4).select("doc_id", "n_lines", "n_dropped", "kept_text")
    assert ordered(map(tuple, got.collect())) == ordered(brute.line_dedup(rows))


@pytest.mark.parametrize("sparse_bits", [0, 50, 1 << 20])
def test_the_filter_holds_what_two_rows_share(spark, sparse_bits):
    rng = np.random.default_rng(6)
    own = [rng.integers(1, 1 << 62, size=40) for _ in range(12)]
    shared = rng.integers(1, 1 << 62, size=30)
    data = [([int(x) for x in own[n]] + [int(x) for x in shared[n::6]] * 2,) for n in range(6)]
    data += [([int(x) for x in own[n]] + [int(x) for x in shared[n - 6 :: 6]],) for n in range(6, 12)]
    frame = spark.createDataFrame(data, "keys array<long>").repartition(5)

    def keys_of(batch):
        for keys in batch.column("keys").to_pylist():
            yield np.array(keys, np.uint64)

    bits = bloom.twice_seen(frame, keys_of, 14, sparse_bits)
    assert bloom.holds(bits, shared.astype(np.uint64), 14).all()
    assert bloom.holds(bits, np.concatenate(own).astype(np.uint64), 14).mean() < 0.1
    assert (bits == bloom.twice_seen(frame, keys_of, 14)).all()


def expected_components(rows, prints):
    at = brute.components(len(rows), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= simhash.MAX_BITS)
    ids = {}
    for n, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[at[n]] = min(ids.get(at[n], doc_id), doc_id)
    return [ids.get(a) for a in at]


def test_simhash(spark, docs, rows):
    prints = [brute.fingerprint(t) for _, t in rows]
    expected = [(i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, expected_components(rows, prints))]
    got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert ordered(got) == ordered(expected)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_simhash_links_in_tiles(spark, monkeypatch):
    """A dense group of fingerprints in several tiles is one component, others stay apart."""
    monkeypatch.setattr(simhash, "TILE", 8)
    rng = np.random.default_rng(5)
    centre = int(rng.integers(1 << 62))
    bits = {centre ^ (1 << a) ^ (1 << b) for a in range(0, 60, 3) for b in range(1, 60, 7)}
    far = {int(x) for x in rng.integers(1 << 62, size=60)}
    nodes = spark.createDataFrame([(x,) for x in sorted(bits | far)], "bits long")
    found = simhash.components(simhash.links(nodes)).collect()
    values = sorted(bits | far)
    at = brute.components(len(values), lambda a, b: (values[a] ^ values[b]).bit_count() <= 4)
    expected = {v: values[a] for v, a in zip(values, at)}
    got = {r["node"]: r["root"] for r in found}
    assert {v: got.get(v, v) for v in values} == expected
    assert len(found) >= len(bits)


@pytest.mark.parametrize("halves, n_keys", [(1, 10), (2, 25), (3, 70), (4, 210)])
def test_simhash_keys_of_each_width_lose_no_link(spark, monkeypatch, halves, n_keys):
    keys, chains = simhash.key_masks(halves), simhash._chain_masks()
    assert len(set(keys)) == n_keys and all(m.bit_count() >= 12 + 6 * halves for _, m in keys)
    rng = np.random.default_rng(8)
    for _ in range(2000):  # bits that lie close together are the hard case
        at = rng.integers(64) + rng.integers(rng.choice([6, 14, 30, 64]), size=4)
        apart = sum(1 << b for b in {int(x) % 64 for x in at})
        own = [s for s, m in keys if not apart & m]
        assert any(all((apart & int(chains[s, n])).bit_count() <= 4 * (n + 1) // 5 for n in range(5)) for s in own)
    monkeypatch.setattr(simhash, "WIDER", (0,) * (halves - 1) + (1 << 30,) * (4 - halves))
    values = [int(x) for x in rng.integers(1 << 62, size=150)]
    values += [v ^ sum(1 << int(b) for b in set(rng.integers(62, size=rng.integers(1, 7)))) for v in values]
    rows = [(k % 2, v) for k, v in enumerate(sorted(set(values)))]
    nodes = spark.createDataFrame(rows, "number long, bits long")
    found = simhash.links(nodes)
    assert found.dtypes == [("number", "bigint"), ("a", "bigint"), ("b", "bigint")]
    found = {(r["number"], *sorted((r["a"], r["b"]))) for r in found.collect()}
    for number in (0, 1):
        mine = [v for k, v in rows if k == number]
        at = brute.components(len(mine), lambda a, b: (mine[a] ^ mine[b]).bit_count() <= 4)
        got = brute.components(len(mine), lambda a, b: (number, *sorted((mine[a], mine[b]))) in found)
        assert got == at and len(set(at)) < len(mine)
    assert all((a ^ b).bit_count() <= 4 for _, a, b in found)


def test_simhash_keys_of_many_strangers_are_wider(spark, monkeypatch):
    """Fingerprints that only meet by chance are hardly ever looked at in buckets, be they few or many."""
    real, rng = simhash.linked_in_groups, np.random.default_rng(3)
    for n in (6_000, 60_000):
        counted = spark.sparkContext.accumulator(0)

        def counting(group, start, bits, counted=counted):
            counted.add(len(bits))
            return real(group, start, bits)

        monkeypatch.setattr(simhash, "linked_in_groups", counting)
        nodes = spark.createDataFrame([(int(x),) for x in rng.integers(1 << 62, size=n)], "bits long").distinct()
        assert simhash.links(nodes.repartition(4)).collect() == []
        assert counted.value <= n // 50


def test_one_of_near_duplicates_stays(spark, docs, rows):
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    prints = [brute.fingerprint(t, 5) for _, t in rows]
    components = expected_components(rows, prints)
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(set(components) - {None})


def test_substring_dedup(spark, docs, rows):
    got = substrings.drop_repeats(docs, log2_bits=16)
    found = [tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_text").collect()]
    assert ordered(found) == ordered(brute.substring_dedup(rows))
    assert any(r[2] for r in found)
    for r in got.collect():
        assert sum(x["n"] for x in r["repeats"]) == r["n_removed"]
        assert all(x["n"] >= substrings.LENGTH for x in r["repeats"])
    assert substrings.drop_repeats(docs.limit(0), log2_bits=16).count() == 0


@pytest.mark.parametrize("length, seed_words", [(5, 2), (8, 8), (6, 1)])
def test_substring_dedup_of_other_lengths(spark, rows, length, seed_words):
    some = rows[:60]
    frame = spark.createDataFrame(some, "doc_id long, text string")
    got = substrings.drop_repeats(frame, length, seed_words, 14).select("doc_id", "n_words", "n_removed", "kept_text")
    assert ordered(map(tuple, got.collect())) == ordered(brute.substring_dedup(some, length))


ODD = ["", " ", "  a  b ", "\x00", "<s> x </s><unk><0x41>", "▁a ▁▁", "x" * 3000, " " * 100 + "t", "ab" * 999, "\U0001f600é中"]


def test_sentencepiece_is_the_library(spark, rows):
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    texts = [*ODD, *[t for _, t in rows]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokens = pieces.encoded(frame, path)
    got = {r["doc_id"]: r["ids"] for r in tokens.collect()}
    assert got == {n: library.encode(t or "") for n, t in enumerate(texts)}
    back = {r["doc_id"]: r["text"] for r in pieces.decoded(tokens, path).collect()}
    assert back == {n: library.decode(got[n]) for n in got}
    lists = [[3, 4, 200, 1, 150], [31999, 260, 259], [], [1], [2, 28705, 264], [240, 162, 0, 5]]
    model = pieces.model(path)
    assert [model.decode(np.array(x, np.int64)) for x in lists] == [library.decode(x) for x in lists]


def test_sentencepiece_forgets_words_safely(monkeypatch):
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    monkeypatch.setattr(pieces, "KEPT_BYTES", 2000)
    model, library = pieces.PieceModel(path), SentencePieceProcessor(model_file=path)
    for text in ["one two three", "four five six seven", "one two eight", "nine four one"] * 2:
        assert [x.tolist() for x in model.encode([text, "one"])] == [library.encode(text), library.encode("one")]


def test_packing(spark, docs, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = packing.pack_documents(docs, path, 64, keep_ids=True).collect()
    sequences, texts = {}, {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert len(r["ids"]) == r["length"]
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append([*library.encode(text or "", add_special_tokens=False).ids, 0])
    for doc_id, expected in texts.items():
        own = sorted((r["start"], r["piece"], r["length"], tuple(r["ids"])) for r in got if r["doc_id"] == doc_id)
        whole = [(n * 64, n, len(ids[n * 64 : n * 64 + 64]), tuple(ids[n * 64 : n * 64 + 64])) for ids in expected for n in range(-(-len(ids) // 64))]
        assert own == sorted(whole)
    total = sum(r["length"] for r in got)
    assert len(sequences) <= -(-total // 64) * 1.05 + 1
    assert packing.pack_documents(docs.limit(0), path).count() == 0


def test_open_bins_close_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 9, 4)] == [(0, 0), (1, 0), (2, 0), (0, 6)]
    assert bins.place(3) == (3, 0)


def test_language_id(spark):
    rng = np.random.default_rng(1)
    alphabets = {"aa": ["pa", "to", "ri"], "bb": ["schu", "zen", "üb"], "cc": ["ψο", "λα", "μη"]}
    data = []
    for n in range(240):
        lang = list(alphabets)[n % 3]
        words = ["".join(rng.choice(alphabets[lang], 3)) for _ in range(rng.integers(1, 60))]
        data.append((n, " ".join(words), lang if n % 7 else None))
    odd = [(900, None, "aa"), (901, "", "aa"), (902, "12 ² !!", "aa"), (903, "Q" * 5000, None), (None, "pato rito", "aa")]
    docs = spark.createDataFrame([*data, *odd, data[5]], "doc_id long, text string, lang string")
    docs = docs.withColumn("score", F.lit("clash"))
    model = langid.fit(docs.where("doc_id < 180 OR doc_id >= 900"))
    got = langid.identified(docs, model).collect()
    right = [r["lang_pred"] == list(alphabets)[r["doc_id"] % 3] for r in got if r["doc_id"] is not None and r["doc_id"] < 900]
    assert np.mean(right) > 0.95
    by_id = {r["doc_id"]: r for r in got}
    assert all((by_id[n]["lang_pred"], by_id[n]["score"], by_id[n]["rejected"]) == ("und", 0.0, True) for n in (900, 901, 902))
    assert by_id[903]["lang_pred"] in alphabets
    assert all(0 <= r["score"] <= 1 for r in got)
    assert len([r for r in got if r["doc_id"] == 5]) == 2
    assert langid.fit(docs.where("lang = 'none'")) is None
    assert {r["lang_pred"] for r in langid.identified(docs, None).collect()} == {"und"}


def test_language_id_holds_out_and_is_accurate(spark):
    import zlib

    folder = "/root/testdata/sf0.01"
    got = langid.op1_language_id(spark, folder).collect()
    labels = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(got) == len(labels)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert np.mean([r["lang_pred"] == labels[r["doc_id"]] for r in got if r["held_out"]]) > 0.97


def test_language_id_rejects_what_it_has_not_learned(spark):
    """Documents of an unlearned language in the same script, and random letters, go; clean ones stay."""
    rng = np.random.default_rng(2)
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("n_chars > 200").select("doc_id", "text", "lang")
    aside = F.col("doc_id") % 5 == 0
    letters = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 9))) for _ in range(30)) for _ in range(200)]
    junk = spark.createDataFrame([(n, t, "junk") for n, t in enumerate(letters)], docs.schema)
    for learned, unlearned, least in ((["de", "en", "fr"], "es", 0.9), (["en"], "de", 0.9)):
        model = langid.fit(docs.where(F.col("lang").isin(learned) & ~aside), 1500)
        found = langid.identified(docs.where(aside).union(junk), model).collect()
        share = {x: np.mean([r["rejected"] for r in found if r["lang"] in x]) for x in ("junk", unlearned, tuple(learned))}
        assert share["junk"] > 0.95 and share[unlearned] >= least and share[tuple(learned)] < 0.03


def test_syncmer_fingerprints(spark, rows):
    texts = [*brute.sample_texts(4, 60), "word " * 40, "ab"]
    data = [(n * 3, t) for n, t in enumerate(texts)]
    frame = spark.createDataFrame([*data, data[9]], "doc_id long, text string").repartition(4)
    got = syncmers.edited_fingerprints(frame).collect()
    assert len(got) == len(data) + 1
    down = sorted(data, reverse=True)
    by_id = {r["doc_id"]: r for r in got}
    for n, (doc_id, text) in enumerate(down):
        text, following = text or "", down[(n + 1) % len(down)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        r = by_id[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), brute.digest(edited))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if text == following:
            assert r["near_next"] == 1
        if len(text) > 400 and text.split()[:20] != following.split()[:20] and "w" in text:
            assert r["near_edited"] > 0.25
    same = {}
    for doc_id, text in data:
        same.setdefault(text or "", set()).add(by_id[doc_id]["fingerprint"])
    assert all(len(x) == 1 for x in same.values())


def test_closed_syncmers_are_context_free(spark):
    """The anchors of a passage are the same wherever it stands, and each has its minimum at an edge."""
    passage = " ".join(f"unit{n * 7919 % 1000:03d}" for n in range(60))
    frame = spark.createDataFrame([(1, passage), (2, "before it " + passage + " and after")], "doc_id long, text string")
    found = syncmers.with_pairs(frame, "text", "p").withColumn("a", syncmers.anchors(F.col("p")))
    one, two = found.orderBy("doc_id").collect()
    for row in (one, two):
        expected = [n for n in range(len(row["p"]) - 3) if min(row["p"][n], row["p"][n + 3]) <= min(row["p"][n + 1 : n + 3])]
        assert [a["at"] for a in row["a"]] == expected
    assert {a["hash"] for a in one["a"]} <= {a["hash"] for a in two["a"]}


def test_neighbours_across_partitions(spark):
    data = [(n * 5 % 97, n) for n in range(96)] + [(None, 7), (None, 8)]
    frame = spark.createDataFrame(data, "doc_id long, copy long").withColumn("n_chars", F.lit(1))
    got = syncmers.neighbours(frame.repartition(7)).collect()
    order = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expected = {order[(n + 1) % len(order)]: order[n] for n in range(len(order))}
    assert {(r["doc_id"], r["copy"]): (r["before_id"], r["before_copy"]) for r in got} == expected


def test_syncmers_of_text_without_blanks(spark):
    """A passage without ASCII blanks keeps its anchors if it is shifted by a few characters."""
    rng = np.random.default_rng(3)
    han = "".join(chr(x) for x in rng.integers(0x4E00, 0x9FA5, 400))
    spaced = "\u00a0".join(f"wort{x}" for x in rng.integers(0, 10_000, 80))
    data = [(10 * n + k, "abc"[:k] + t) for n, t in enumerate((han, spaced)) for k in range(4)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    got = {r["doc_id"]: r for r in syncmers.fingerprinted(frame, "text", "s").collect()}
    first = syncmers.with_pairs(frame, "text", "p").withColumn("a", syncmers.anchors(F.col("p")))
    hashes = {r["doc_id"]: {a["hash"] for a in r["a"]} for r in first.collect()}
    for n in (0, 10):
        assert len(got[n]["s"]) == syncmers.SKETCH
        for k in (1, 2, 3):
            assert len(hashes[n] & hashes[n + k]) > 0.95 * len(hashes[n])


def test_a_full_piece_closes_no_open_bin():
    bins = packing.OpenBins(10, 1)
    assert [bins.place(n) for n in (6, 10, 4)] == [(0, 0), (1, 0), (0, 6)]


def test_words_are_encoded_in_parts():
    """Marks and capitals make no new words, and the ids stay those of the library."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), packing.WordEncoder(path)
    words = ["stone", "\u00e9cole", "h\u00f6her", "water"]
    texts = [f"{a}{w}{z} {w.title()}{z}" for w in words for a in ("", "(", '"', "-") for z in ("", ".", ",", ").", "!'")]
    odd = ["'s", "'", "s", "S", "LL", "\u00c9", "\u0130", "H\u0331", "\u0301", ".", "(", "1", "\u00b2", "\u00a0", "\u2026", "\u0915\u093c"]
    odd += ["<|startoftext|>", "<|STARTOFTEXT|>", "\x1c", "\x00", "\u4e2d", "\U0001f600", "\ufffd", " ", "\n", "e"]
    rng = np.random.default_rng(6)
    found = encoder.ids([t.encode() for t in texts])
    assert len(encoder.known) <= len(words) + 12
    texts += ["".join(rng.choice(odd, 8)) for _ in range(4000)]
    found += encoder.ids([t.encode() for t in texts[len(found) :]])
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]
