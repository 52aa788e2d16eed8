"""The prefix trie of conversations, found with vertical bitmaps.

1. Turns are put in order by one sort over all tasks; places come from counts by task, so
   a conversation of any length is spread like all other rows.  A turn is known by two
   64-bit hashes of its place, role and text; texts themselves never move.
2. Conversations are cut into bands of ``BAND`` places.  The running XOR of the turn hashes
   is the name of a prefix, so a band knows the node that it starts from.
3. A shard holds up to about ``SHARD`` pieces that start from the same nodes by the same
   turns; keys with more pieces are spread over several shards.  In a shard, an index gives
   for each (place, turn) a bitset of its conversations, in the order of their numbers.
   Depth first, the bitset of a node is intersected with the postings of the next place:
   each intersection is a child, its lowest bit the smallest member, its popcount the number
   of members, and what goes on to no child is the list of conversations that end there.
4. Only nodes of keys that were spread are merged.  Sums over subtrees go up by pointer
   doubling among nodes of several members, in as many rounds as the depth has bits; below
   a node of one member there is one leaf and nothing saved.
5. The digest of the conversations that end at a node is made in one pass over its sorted
   rows, so a list of any length takes no memory.

Cases: null roles and texts are empty; equal turn numbers, and missing ones, which come
first, are in order of role and a hash of the text; repeated rows are turns of their own;
rows without conv_id belong to no conversation and have no part; a table without
conversations has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from .tables import ship_package, written

FAMILY = 5
MOST_HEAD = 9
BAND = 64
SHARD = 1024
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = ["depth", "a", "b"]


def head_length(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % MOST_HEAD).cast("int")


def placed(rows: DataFrame) -> DataFrame:
    """``conv_id, place, x, y, size`` of every turn: its place from 0, two hashes, the bytes of its text."""
    ship_package(rows.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        *[F.xxhash64(F.lit(n), role, text).alias(name) for n, name in enumerate(("x", "y"))],
        F.octet_length(text).cast("long").alias("size"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "x", "y"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            conv = batch.column("conv_id").to_numpy()
            if not len(conv):
                continue
            fresh = np.concatenate([[conv[0] != last], conv[1:] != conv[:-1]])
            at = np.arange(len(conv))
            starts = np.where(fresh, at, 0)
            starts[0] = 0 if fresh[0] else -seen
            place = at - np.where(np.maximum.accumulate(fresh), np.maximum.accumulate(starts), starts[0])
            last, seen = conv[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(place), *[batch.column(n) for n in ("x", "y", "size")]],
                ["conv_id", "local", "x", "y", "size"],
            )

    counted = turns.orderBy(*order).select("conv_id", "x", "y", "size")
    counted = counted.mapInArrow(count, "conv_id long, local long, x long, y long, size long")
    counted = written(counted.withColumn("task", F.spark_partition_id()), "turns")
    # One row per task of the sort: only its first conversation may have begun in tasks before.
    ends = counted.groupBy("task").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "local")).alias("end"))
    carried, open_conv, n_open = [], None, 0
    for task, first, (conv, local) in sorted(tuple(r) for r in ends.collect()):
        before = n_open if first == open_conv else 0
        carried.append((task, first, before))
        open_conv, n_open = conv, local + 1 + (before if conv == first else 0)
    carried = rows.sparkSession.createDataFrame(carried or [(0, 0, 0)], "task int, first long, before long")
    joined = counted.join(F.broadcast(carried), "task")
    shift = F.when(F.col("conv_id") == F.col("first"), F.col("before")).otherwise(0)
    return joined.select("conv_id", (F.col("local") + shift).alias("place"), "x", "y", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, place, x, y, size`` of the rebuilt turns, and ``conv_id`` of every conversation.

    A conversation takes its first turns from the first one of its family.
    """
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = turns.where((F.col("place") < MOST_HEAD - 1) & (F.col("conv_id") % FAMILY == 0))
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("place", "x", "y", "size"))).alias("head")
    )
    convs = turns.where("place = 0").select("conv_id", base.alias("base"), head_length(F.col("conv_id")).alias("h"))
    head = F.coalesce(F.slice("head", 1, F.col("h")), F.slice("head", 1, 0))
    convs = convs.join(heads, "base", "left").select("conv_id", "h", head.alias("head"))
    convs = written(convs.withColumn("n_head", F.coalesce(F.size("head"), F.lit(0))), "heads")
    taken = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*")
    # A hot conversation is a hot key here, which AQE splits; its other side is one narrow row.
    known = broadcast_if_small(convs.select("conv_id", "h", "n_head"))
    own = turns.join(known, "conv_id").where(F.col("place") >= F.col("h")).select(
        "conv_id", (F.col("place") - F.col("h") + F.col("n_head")).alias("place"), "x", "y", "size"
    )
    hashed = [F.xxhash64(F.lit(n), "place", "x", "y").alias(name) for n, name in enumerate(("x", "y"))]
    return taken.union(own).select("conv_id", "place", *hashed, "size"), convs.select("conv_id")


def pieces(turns: DataFrame, convs: DataFrame, band: int) -> DataFrame:
    """``conv_id, band, a, b, last, turns``: the turns of a band of a conversation, and the node that it starts from."""
    names = ["place", "x", "y", "size"]
    none = F.lit(0).cast("long")
    empty = convs.select("conv_id", none.alias("band"), *[F.lit(None).cast("long").alias(n) for n in names])
    every = turns.select("conv_id", F.floor(F.col("place") / band).alias("band"), *names).union(empty)
    banded = every.groupBy("conv_id", "band").agg(
        F.sort_array(F.collect_list(F.when(F.col("place").isNotNull(), F.struct(*names)))).alias("turns"),
        *[F.coalesce(F.bit_xor(n), none).alias(n) for n in ("x", "y")],
    )
    # A row per band: a conversation of any length has few of them.
    order = Window.partitionBy("conv_id").orderBy("band")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return banded.select(
        "conv_id",
        "band",
        F.coalesce(F.bit_xor("x").over(before), none).alias("a"),
        F.coalesce(F.bit_xor("y").over(before), none).alias("b"),
        F.lead("band").over(order).isNull().alias("last"),
        "turns",
    )


def _sharded(found: DataFrame, shard: int) -> DataFrame:
    """The pieces with ``shard``, and ``spread`` where the pieces of a key are in several shards."""
    found = found.withColumn("key", F.xxhash64("band", "a", "b", F.get("turns", F.lit(0))["x"]))
    counts = written(found.groupBy("key").agg(F.count("*").alias("n")), "keys")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = broadcast_if_small(counts.where(F.col("n") > shard))
    parts = F.ceil(F.col("n") / shard)
    place = F.when(F.col("n").isNull(), F.pmod("key", F.lit(max(1, -(-total // shard))))).otherwise(
        F.xxhash64("key", F.pmod(F.xxhash64("conv_id"), parts))
    )
    spread = F.col("n").isNotNull()
    return found.join(hot, "key", "left").select("*", spread.alias("spread"), place.alias("shard")).drop("n", "key")


class Shard:
    """Conversations of one shard, ascending, and for each (place, turn) the bitset of those that have it."""

    def __init__(self, conv: np.ndarray, last: np.ndarray, offsets: np.ndarray, turns: np.ndarray, size: np.ndarray):
        self.conv, self.last, self.offsets, self.turns, self.size = conv, last, offsets, turns, size
        self.postings: dict[tuple[int, int], int] = {}
        longer: list[int] = []
        for n in range(len(conv)):
            bit = 1 << n
            for at, turn in enumerate(map(tuple, turns[offsets[n] : offsets[n + 1]].tolist())):
                self.postings[turn] = self.postings.get(turn, 0) | bit
                if at == len(longer):
                    longer.append(0)
                longer[at] |= bit
        self.longer = [*longer, 0]
        self.closing = sum(1 << n for n in np.flatnonzero(last).tolist())

    def walk(self, members: int, depth: int, a: int, b: int, out: Nodes) -> None:
        """Depth first from one node with the bitset of its members, all nodes below it."""
        stack = [(members, 0, depth, a, b, -1)]
        while stack:
            members, at, depth, a, b, row = stack.pop()
            going = members & self.longer[at]
            ended = members & ~going & self.closing
            if ended:
                out.ends(row, depth, a, b, [int(self.conv[n]) for n in _bits(ended)])
            while going:
                n = (going & -going).bit_length() - 1
                where = int(self.offsets[n]) + at
                x, y = self.turns[where].tolist()
                child = members & self.postings[x, y]
                going &= ~child
                if child & (child - 1):
                    new = out.add(depth + 1, a ^ x, b ^ y, a, b, int(self.conv[n]), child.bit_count(), int(self.size[where]))
                    stack.append((child, at + 1, depth + 1, a ^ x, b ^ y, new))
                else:
                    self._tail(n, where, depth, a, b, out)

    def _tail(self, n: int, where: int, depth: int, a: int, b: int, out: Nodes) -> None:
        """The nodes of what only one conversation has."""
        end = int(self.offsets[n + 1])
        names = np.bitwise_xor.accumulate(np.concatenate([[[a, b]], self.turns[where:end]]), axis=0).tolist()
        conv = int(self.conv[n])
        for k, size in enumerate(self.size[where:end].tolist(), 1):
            row = out.add(depth + k, *names[k], *names[k - 1], conv, 1, size)
        if self.last[n]:
            out.ends(row, depth + end - where, *names[-1], [conv])


class Nodes:
    """Rows of nodes, column by column.  Lists of ends of nodes above the shard are rows without members."""

    schema = "depth long, a long, b long, pa long, pb long, conv_id long, n_convs long, size long, ends array<long>"

    def __init__(self):
        self.rows: list[list] = []

    def add(self, *row: int) -> int:
        self.rows.append([*row, None])
        return len(self.rows) - 1

    def ends(self, row: int, depth: int, a: int, b: int, found: list[int]) -> None:
        if row < 0:
            self.rows.append([depth, a, b, None, None, None, 0, 0, found])
        else:
            self.rows[row][-1] = found


def _bits(members: int) -> Iterator[int]:
    while members:
        yield (members & -members).bit_length() - 1
        members &= members - 1


def shard_nodes(table: pa.Table, band: int) -> tuple[list[list], bool]:
    """The nodes of the pieces of one shard."""
    table = table.combine_chunks().sort_by([("conv_id", "ascending"), ("band", "ascending")])
    lists = table.column("turns").combine_chunks()
    offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    turns = lists.flatten()
    names = np.stack([turns.field(n).to_numpy() for n in ("x", "y")], 1).reshape(-1, 2)
    shard = Shard(
        table.column("conv_id").to_numpy(), table.column("last").to_numpy(), offsets, names, turns.field("size").to_numpy()
    )
    starts: dict[tuple[int, int, int], int] = {}
    for n, start in enumerate(zip(*(table.column(c).to_pylist() for c in ("band", "a", "b")))):
        starts[start] = starts.get(start, 0) | 1 << n
    out = Nodes()
    for (at, a, b), members in starts.items():
        shard.walk(members, at * band, a, b, out)
    return out.rows


def partial_nodes(found: DataFrame, band: int, shard: int) -> DataFrame:
    """The nodes of every shard, with ``spread``."""
    ship_package(found.sparkSession)
    names = [c.split()[0] for c in Nodes.schema.split(", ")]
    kinds = [pa.int64()] * 8 + [pa.list_(pa.int64())]

    def work(table: pa.Table) -> pa.Table:
        rows = shard_nodes(table, band)
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows) if rows else [[]] * 9, kinds)]
        return pa.table([*columns, pa.array([table.column("spread")[0].as_py()] * len(rows), pa.bool_())], [*names, "spread"])

    return _sharded(found, shard).groupBy("shard").applyInArrow(work, Nodes.schema + ", spread boolean")


def _end_digests(found: DataFrame) -> DataFrame:
    """``depth, a, b, ends_sha256``: one pass over the sorted numbers of each node."""
    rows = found.where("ends IS NOT NULL").select(*NODE, F.explode("ends").alias("conv_id"))
    rows = rows.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for *new, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id"))):
                if new != node:
                    if node is not None:
                        done.append([*node, state.hexdigest()])
                    node, state = new, hashlib.sha256(b"%d" % conv)
                else:
                    state.update(b",%d" % conv)
            yield table(done)
        if node is not None:
            yield table([[*node, state.hexdigest()]])

    def table(rows: list[list]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*NODE, "ends_sha256"])

    return rows.mapInArrow(digests, "depth long, a long, b long, ends_sha256 string")


def _subtree_sums(shared: DataFrame, most_depth: int) -> DataFrame:
    """``depth, a, b, n_leaves, saved``: sums over the subtrees of nodes of several members.

    Round k adds to each node what the nodes 2^k below it have summed up.
    """
    up = [F.col(c).alias(f"up_{c}") for c in ("a", "b")]
    state = shared.select(*NODE, F.col("pa").alias("up_a"), F.col("pb").alias("up_b"), "n_leaves", "saved")
    step = 1
    while step <= most_depth:
        state = written(state, "subtrees")
        high = state.where(F.col("depth") >= step)
        more = high.groupBy((F.col("depth") - step).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        above = state.select((F.col("depth") + step).alias("depth"), *[F.col(c).alias(f"up_{c}") for c in ("a", "b")],
                             *[F.col(f"up_{c}").alias(f"next_{c}") for c in ("a", "b")])
        state = state.join(more, NODE, "left").join(above, ["depth", "up_a", "up_b"], "left").select(
            *NODE,
            F.col("next_a").alias("up_a"),
            F.col("next_b").alias("up_b"),
            (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )
        step *= 2
    return state.select(*NODE, "n_leaves", "saved")


def prefix_trie(rows: DataFrame, band: int = BAND, shard: int = SHARD) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations of ``conv_id, turn, role, text``."""
    turns, convs = rebuilt(placed(rows))
    found = written(partial_nodes(pieces(turns, convs, band), band, shard), "partial")
    zero = F.lit(0).cast("long")
    # The root, and nodes whose members were spread, are merged; all others are whole.
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in NODE], *[F.lit(None).cast("long").alias(c) for c in ("pa", "pb")], "conv_id", "n_convs", zero.alias("size"))
    merged = found.where("spread AND n_convs > 0").groupBy(*NODE).agg(
        *[F.min(c).alias(c) for c in ("pa", "pb", "conv_id")], F.sum("n_convs").alias("n_convs"), F.min("size").alias("size")
    )
    whole = found.where("NOT spread AND n_convs > 0").select(*merged.columns)
    nodes = written(whole.unionByName(merged).unionByName(root), "nodes")

    below = nodes.where("pa IS NOT NULL").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("n_single")
    )
    held = written(nodes.join(below, NODE, "left").fillna(0, ["n_children", "n_single"]), "children")
    own = F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_single")).cast("long")
    shared = held.where("n_convs > 1").select(*NODE, "pa", "pb", own.alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved"))
    depth = held.where("n_convs > 1").agg(F.max("depth")).first()[0] or 0
    sums = _subtree_sums(shared, depth)
    above = nodes.where("n_convs > 1").select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_of_shared"))
    full = held.join(sums, NODE, "left").join(_end_digests(found), NODE, "left")
    # The parent of a node with one member has either the same member only, or several.
    full = full.join(above, ["depth", "pa", "pb"], "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("parent_of_shared", "conv_id"))
    return full.select(
        "conv_id",
        "depth",
        parent.alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved", zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{folder.rstrip('/')}/conversations.parquet"))


#: A prefix is named by the digest of the one before it and its last turn.
ORACLE = """
WITH RECURSIVE turns AS MATERIALIZED (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS MATERIALIZED (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
           string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END),
         4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS MATERIALIZED (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS d FROM (
    SELECT c.conv_id, 0 AS part, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place < c.h
    UNION ALL
    SELECT c.conv_id, 1, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place >= c.h)
), prefixes AS MATERIALIZED (
  SELECT conv_id, 0::BIGINT AS d, '' AS node, NULL::VARCHAR AS parent, 0::BIGINT AS size FROM convs
  UNION ALL
  SELECT p.conv_id, r.d, md5(p.node || ':' || length(r.role) || ':' || r.role || r.text), p.node, strlen(r.text)
  FROM prefixes p JOIN rebuilt r ON r.conv_id = p.conv_id AND r.d = p.d + 1
), nodes AS MATERIALIZED (
  SELECT d, node, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size FROM prefixes GROUP BY d, node
), below AS MATERIALIZED (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY parent) c USING (node)
  LEFT JOIN nodes p ON p.node = n.parent
), paths AS (
  SELECT node AS top, node, n_children, n_convs, size, parent FROM below
  UNION ALL
  SELECT b.node, p.node, p.n_children, p.n_convs, p.size, b.parent FROM paths p JOIN below b ON b.node = p.parent
), subtrees AS (
  SELECT top AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * size)::BIGINT AS saved_tokens
  FROM paths GROUP BY top
), ends AS (
  SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM prefixes
  WHERE (conv_id, d) IN (SELECT conv_id, max(d) FROM prefixes GROUP BY conv_id) GROUP BY node
)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM below JOIN subtrees USING (node) LEFT JOIN ends USING (node)
"""
