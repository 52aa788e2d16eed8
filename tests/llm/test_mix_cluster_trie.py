"""Mixing, clustering and the prefix trie against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from carrack.llm import centroids, mixing, trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Mixing


def targets(words, most=3):
    """Round by round, as exact fractions: ``words`` by source in rank order."""
    weight = {s: n % 3 + 1 for n, s in enumerate(words)}
    left, open_, got = Fraction(sum(words.values())), dict(words), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if weight[s] * unit > most * words[s]]
        if not above:
            return got | {s: weight[s] * unit for s in open_}
        for s in above:
            got[s] = Fraction(most * words[s])
            left -= got[s]
            del open_[s]
    return got


DOCS = "doc_id long, text string, source string, size string, target double"


def mix_rows():
    rng = random.Random(5)
    rows = [(n, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(60))), rng.choice(["big"] * 9 + ["a", "ß", "", "z"]), "x", 1.0) for n in range(900)]
    rows += [(900, None, "a", None, None), (901, "\t\n ", "none", "", 2.0), (None, "b c\x0bd", None, "", 0.0), (902, "é e x", None, "", 0.0), (903, "w " * 5000, "z", "", 0.0)]
    return rows + [rows[3], (904, "tiny", "one", "", 0.0)]


def test_mix_against_exact_fractions(spark):
    rows = mix_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    got = mixing.taken(docs).collect()
    size = lambda text: len(WORD.findall(text or ""))
    words = defaultdict(int)
    for _, text, source, *_ in sorted(rows, key=lambda r: (r[2] is None, (r[2] or "").encode())):
        words[source] += size(text)
    wanted = targets(words)
    assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((r[0] or -1, size(r[1])) for r in rows)
    total = defaultdict(int)
    for r in got:
        assert r["source_size"] == words[r["source"]] and r["target"] == pytest.approx(float(wanted[r["source"]]), rel=1e-12)
        rate = r["rate"]
        assert r["copies"] in (math.floor(rate), math.floor(rate) + 1) and r["taken"] == r["size"] * r["copies"] <= 3 * r["size"]
        total[r["source"]] += r["taken"]
    assert total["one"] == 3 and total["none"] == 0
    for source in ("big", "a", "ß", ""):
        assert abs(total[source] - wanted[source]) <= 0.02 * wanted[source]
    again = mixing.taken(docs.repartition(2)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    count = defaultdict(int)
    for r in mix.collect():
        count[r["doc_id"]] += 1
    copies = defaultdict(int)
    for r in got:
        copies[r["doc_id"]] += r["copies"]
    assert {k: v for k, v in copies.items() if v} == dict(count)
    assert mixing.taken(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0
    blank = mixing.taken(docs.where("doc_id IN (900, 901)")).collect()
    assert [(r["target"], r["taken"]) for r in blank] == [(0.0, 0)] * 2


def test_sources_are_ranked_over_many_tasks(spark):
    names = [None, *(f"s{n:04}" for n in random.Random(1).sample(range(5000), 700))]
    sources = spark.createDataFrame([(n, 1) for n in names], "source string, source_size long").repartition(7)
    ranks = {r["source"]: r["rank"] for r in mixing.ranked(sources).collect()}
    assert [ranks[n] for n in sorted(n for n in names if n)] == list(range(700)) and ranks[None] == 700


# Centroids


def lloyd(rows, clusters=8, rounds=10, length=64):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    order = sorted(kept, key=lambda r: hashlib.sha256(f"3:{r[0]}".encode()).hexdigest())
    points, centres = np.array([v for _, v in kept], object), [list(v) for _, v in order[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))
    for _ in range(rounds):
        at = [near(v)[1] for v in points]
        for k in range(len(centres)):
            own = [v for v, c in zip(points, at) if c == k]
            if own:
                centres[k] = [int(sum(x) // len(own)) for x in zip(*own)]
    last = [near(v) for v in points]
    inertia = defaultdict(int)
    for d, k in last:
        inertia[k] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((i, k, d, inertia[k], sum(inertia.values()), digest[k]) for (i, _), (d, k) in zip(kept, last))


VECTORS = "vec_id long, embedding array<float>, cluster string, vector int"


def vector_rows(n=120):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(4, 64)) / 8
    rows = [(k, (centre[k % 4] + rng.normal(size=64) / 20).astype(np.float32).tolist()) for k in range(n)]
    rows += [(n, None), (n + 1, []), (n + 2, [1.0] * 63), (n + 3, [None] + [0.0] * 63), (n + 4, [float("nan")] + [0.0] * 63), (n + 5, [float("inf")] * 64)]
    return rows + [(n + 6, [0.0] * 64), (n + 7, rows[5][1]), rows[7]]


@pytest.mark.parametrize("bits, limit", [(8, None), (3, None), (5, 0)])
def test_clusters_against_plain_rounds(spark, monkeypatch, bits, limit):
    if limit is not None:  # too many keys for a broadcast: the file is read through
        monkeypatch.setattr(centroids.sizing, "BROADCAST_BYTES", limit)
    rows = vector_rows()
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], VECTORS).repartition(3)
    assert sorted(map(tuple, centroids.clustered(df, bits=bits).collect())) == lloyd(rows)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors_and_equal_ones(spark, n):
    rows = [(k, [0.5] * 64) for k in range(n)] + [(9, None)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], VECTORS)
    assert sorted(map(tuple, centroids.clustered(df).collect())) == lloyd(rows)
    without = spark.createDataFrame([(None, [0.25] * 64, "x", 1), (4, [1.0] * 64, "x", 1)], VECTORS)
    assert {r["vec_id"]: r["distance"] for r in centroids.clustered(without).collect()} == {None: 0, 4: 0}


def test_cells_never_decide_wrongly():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-40, 40, size=(500, 16)).astype("<i4")
    centres = rng.integers(-20, 20, size=(6, 16)).astype(np.int64)
    centres[4] = centres[1]
    for bits in (1, 4, 7):
        grid = centroids.Cells(vectors.min(0).astype(np.int64), vectors.max(0).astype(np.int64), bits)
        cell = grid.unpack(grid.pack(vectors))
        assert (cell == (vectors - grid.least) // grid.width).all()
        found = grid.tables(centres).decided(cell)
        right = centroids.distances(vectors, centres).argmin(1)
        assert ((found == right) | (found == -1)).all()
        assert bits < 7 or (found >= 0).mean() > 0.9


def test_numbers_too_large_are_refused(spark):
    df = spark.createDataFrame([(1, [1e30] * 64, "x", 1)], VECTORS)
    with pytest.raises(Exception, match="too large"):
        centroids.clustered(df).collect()


# Trie


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        path = own.get(c - c % 5, [])[:h] + own[c][h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p, m in members.items()
    )


TURNS = "conv_id long, turn long, role string, text string, place string, depth int"


def turn_rows(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), 150):
        said = [("user", "hello")] * (rng.random() < 0.6) + [(rng.choice(["user", "bot", None]), rng.choice(["a", "b", "é", "", None])) for _ in range(rng.randrange(12))]
        rows += [(c, n if rng.random() < 0.95 else None, *t) for n, t in enumerate(said)]
    rows += [(1000 + n, k, "user", f"same {k}") for n in range(60) for k in range(14)]  # copies
    rows += [(2000, k, "user", f"{k % 3}") for k in range(700)] + [(2001, k, "user", f"{k % 3}") for k in range(650)]
    rows += [(None, 1, "user", "nobody"), rows[4], (3000, 5, "x", "y"), (3000, 5, "x", "y"), (3001, 1, None, "z" * 100_000)]
    return rows


@pytest.mark.parametrize("seed, band, shard", [(1, 64, 1024), (2, 3, 8), (3, 1, 2)])
def test_trie_against_plain_python(spark, monkeypatch, seed, band, shard):
    rows = turn_rows(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS).repartition(6)
    got = sorted(tuple(-1 if x is None else x for x in r) for r in trie.prefix_trie(df, band, shard).collect())
    assert got == plain_trie(rows)


def test_trie_of_little(spark):
    none = spark.createDataFrame([(None, 1, "a", "b", "x", 1)], TURNS)
    assert trie.prefix_trie(none).count() == 0 and trie.prefix_trie(none.limit(0)).count() == 0
    one = [(6, 1, "a", "b")]
    got = trie.prefix_trie(spark.createDataFrame([(*r, "x", 1) for r in one], TURNS)).collect()
    assert sorted(tuple(-1 if x is None else x for x in r) for r in got) == plain_trie(one)
