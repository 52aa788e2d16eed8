"""A folder of text shards as rows of lines."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from . import decoding
from .lines import decoded_lines, member_starts

# Format names and the file endings that Spark decodes for them.
CODEC_ENDINGS = {"gzip": (".gz",), "bzip": (".bz2",), "lzw": (".z",)}
ENCODED_ENDINGS = (".gz", ".bz2", ".z", ".deflate", ".snappy", ".lz4", ".zst")
NEEDS_DECODING = re.compile(r"[^A-Za-z0-9._~!$&'()*+,;=:@-]")
#: What is read of every shard to see its encoding.
HEAD_BYTES = 512
#: Gzip shards above this size are dealt out by member, in tasks of about this size.
MEMBER_RANGE = 64 << 20
MARKER_NAMES = re.compile(r"_SUCCESS|\..*\.crc")


@dataclass(frozen=True)
class ShardFolder:
    """The shards of one folder in merge order: ascending names, compared byte by byte."""

    path: str
    names: tuple[str, ...]
    has_subfolders: bool
    sizes: tuple[int, ...]

    @property
    def n_bytes(self) -> int:
        return sum(self.sizes)

    @property
    def first(self) -> str:
        return self.names[0]


def list_shards(spark: SparkSession, path: str, codec: str = "auto") -> ShardFolder:
    """List one folder, not its subfolders, and check that Spark will decode it as asked.

    Spark chooses the decoder by file ending, so an ending that does not fit
    ``codec`` (``txt``, ``gzip``, ``bzip``, ``lzw``, or ``auto`` for any mix) is an error and
    not a silent misread.
    """
    if codec not in ("auto", "txt", *CODEC_ENDINGS):
        raise ValueError(f"unknown shard format {codec!r}; use auto, txt, gzip, bzip or lzw")
    if not storage.is_dir(spark, path):
        raise FileNotFoundError(f"no such folder: {path}")
    entries = storage.list_dir(spark, path)
    files = [e for e in entries if not e.is_dir and not MARKER_NAMES.fullmatch(e.name)]
    if not files:
        raise FileNotFoundError(f"no files in {path}")
    files.sort(key=lambda e: e.name.encode("utf-8"))
    names = [e.name for e in files]
    hidden = [name for name in names if name.startswith(("_", "."))]
    if hidden:
        raise ValueError(f"Spark does not read names that start with '_' or '.': {hidden[:5]}")
    if codec in CODEC_ENDINGS:
        wrong = [name for name in names if not name.lower().endswith(CODEC_ENDINGS[codec])]
    elif codec == "txt":
        wrong = [name for name in names if name.lower().endswith(ENCODED_ENDINGS)]
    else:
        wrong = []
    if wrong:
        raise ValueError(f"file ending does not fit format {codec!r}: {wrong[:5]}")
    return ShardFolder(path.rstrip("/"), tuple(names), any(e.is_dir for e in entries), tuple(e.size for e in files))


def scan_shards(spark: SparkSession, folder: ShardFolder) -> DataFrame:
    """All physical lines: ``file_name, block_start, line_id, line``.

    ``line_id`` grows with the line order inside one block (a split of one file),
    and one block is always read by one task.  It is only stable within one job;
    keep it by writing it out, as ``operators.numbering`` does.

    Spark's text reader takes what it can decode.  Shards that begin with a mark of
    UTF-16 or UTF-32, LZW shards, and large gzip shards of several members, which are
    dealt out by member, come from :mod:`.lines`.
    """
    tasks = plan_tasks(spark, folder)
    others = sorted({task["name"] for task in tasks})
    found = [] if len(others) == len(folder.names) else [_plain_lines(spark, folder, others)]
    if tasks:
        found.append(decoded_lines(spark, _store_uri(spark, folder.path), tasks))
    numbered = [lines.withColumn("line_id", F.monotonically_increasing_id()) for lines in found]
    return reduce(DataFrame.unionByName, numbered).select("file_name", "block_start", "line_id", "line")


def plan_tasks(spark: SparkSession, folder: ShardFolder) -> list[dict]:
    """What Spark's reader cannot decode, or not in parallel: a file, or the members of one from a place on."""
    endings = [name[name.rfind(".") :].lower() if "." in name else "" for name in folder.names]
    looked = [n for n, ending in enumerate(endings) if ending in (".gz", ".z") or ending not in ENCODED_ENDINGS]
    heads = storage.read_heads(spark, [f"{folder.path}/{folder.names[n]}" for n in looked], HEAD_BYTES)
    tasks, large = [], []
    for n, raw in zip(looked, heads):
        name, ending = folder.names[n], endings[n]
        ending = ending if ending in ENCODED_ENDINGS else ""
        encoding, mark = decoding.marked(decoding.head_of(raw, ending))
        if encoding != "utf-8" or ending == ".z":
            tasks.append({"name": name, "ending": ending, "encoding": encoding, "mark": mark, "size": folder.sizes[n]})
        elif ending == ".gz" and folder.sizes[n] > MEMBER_RANGE:
            large.append({"name": name, "ending": ending, "encoding": encoding, "mark": mark, "size": folder.sizes[n]})
    if not large:
        return tasks
    starts = member_starts(spark, _store_uri(spark, folder.path), large, MEMBER_RANGE)
    for file in large:
        places = starts[file["name"]]
        if len(places) > 1:
            for start, end in zip(places, [*places[1:], None]):
                size = (end or file["size"]) - start
                tasks.append({**file, "start": start, "end": end, "size": size, "mark": file["mark"] if start == 0 else 0})
    return tasks


def _plain_lines(spark: SparkSession, folder: ShardFolder, others: list[str]) -> DataFrame:
    reader = spark.read
    if folder.has_subfolders:
        # Look below subfolders only to drop those files again by their path, which
        # prunes the file list; otherwise Spark would take subfolders as partitions.
        reader = reader.option("recursiveFileLookup", True)
    lines = reader.text(folder.path)
    if folder.has_subfolders:
        parent = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
        lines = lines.where(F.regexp_replace(parent, "^([^:/]+):/+", "$1:/") == F.lit(_plain_uri(spark, folder.path)))
    name = F.col("_metadata.file_name")
    if any(NEEDS_DECODING.search(shard) for shard in folder.names):
        # Spark gives the name URL-encoded; there a plus sign stands for itself.
        name = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    if others:
        lines = lines.where(~name.isin(others))
    return lines.select(
        name.alias("file_name"), F.col("_metadata.file_block_start").alias("block_start"), F.col("value").alias("line")
    )


def _store_uri(spark: SparkSession, path: str) -> str:
    """The full name of a folder, as Arrow's file systems want it."""
    return re.sub("^file:/+", "file:///", storage.uri(spark, path))


def _plain_uri(spark: SparkSession, path: str) -> str:
    """The full, encoded name of a folder with one slash after its scheme."""
    return re.sub("^([^:/]+):/+", r"\1:/", storage.uri(spark, path))
