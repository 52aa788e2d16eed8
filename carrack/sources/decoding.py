"""Bytes of a shard as lines: LZW, gzip members, byte order marks, line ends.  Streams in bounded memory."""

from __future__ import annotations

import bz2
import codecs
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import BinaryIO

CHUNK = 1 << 20
MAGIC = b"\x1f\x8b\x08"
# The marks, longest first, as the shorter ones begin some of the longer.
MARKS = (
    (codecs.BOM_UTF32_LE, "utf-32-le"),
    (codecs.BOM_UTF32_BE, "utf-32-be"),
    (codecs.BOM_UTF8, "utf-8"),
    (codecs.BOM_UTF16_LE, "utf-16-le"),
    (codecs.BOM_UTF16_BE, "utf-16-be"),
)
LZW_MAGIC, LZW_CLEAR = b"\x1f\x9d", 256
#: Entries of an LZW table longer than this are followed byte by byte, so that a table stays small.
LZW_KEPT = 256


def marked(head: bytes) -> tuple[str, int]:
    """The encoding that a text begins to tell, and the bytes of its mark; without one UTF-8."""
    return next(((name, len(mark)) for mark, name in MARKS if head.startswith(mark)), ("utf-8", 0))


def head_of(raw: bytes, ending: str) -> bytes:
    """The first decoded bytes, from the first bytes of a file."""
    if ending == ".gz":
        return zlib.decompressobj(31).decompress(raw, 4) if raw else b""
    if ending == ".bz2":
        return b""  # a block does not fit into a head
    if ending == ".z":
        return next(lzw(iter([raw])), b"")[:4]
    return raw[:4]


def chunks_of(file: BinaryIO, ending: str) -> Iterator[bytes]:
    """The decoded bytes of a file."""
    raw = iter(lambda: file.read(CHUNK), b"")
    if ending == ".gz":
        yield from (chunk for _, chunk in members(file, 0))
    elif ending == ".bz2":
        yield from _bzip(raw)
    elif ending == ".z":
        yield from lzw(raw)
    else:
        yield from raw


def _bzip(raw: Iterator[bytes]) -> Iterator[bytes]:
    stream = None
    for data in raw:
        while data:
            stream = stream or bz2.BZ2Decompressor()
            chunk = stream.decompress(data, CHUNK)
            while chunk:
                yield chunk
                chunk = b"" if stream.eof or stream.needs_input else stream.decompress(b"", CHUNK)
            data = stream.unused_data if stream.eof else b""
            stream = None if stream.eof else stream
    if stream is not None:
        raise EOFError("bzip data ends early")


def members(file: BinaryIO, start: int) -> Iterator[tuple[int, bytes]]:
    """Start of the member and inflated bytes, from the member at ``start`` to the end of the file.

    Each member begins with an empty chunk.
    """
    file.seek(start)
    at, data, stream = start, b"", None  # ``at``: where ``data`` begins
    while True:
        if not data:
            data = file.read(CHUNK)
        if not data:
            break
        if stream is None:
            padding = len(data) - len(data.lstrip(b"\0"))
            at, data = at + padding, data[padding:]
            if not data:
                continue
            stream, begin = zlib.decompressobj(31), at
            yield begin, b""
        chunk = stream.decompress(data, CHUNK)
        left = stream.unused_data if stream.eof else stream.unconsumed_tail
        at, data = at + len(data) - len(left), left
        if chunk:
            yield begin, chunk
        stream = None if stream.eof else stream
    if stream is not None:
        raise EOFError("gzip data ends early")


def first_member(file: BinaryIO, start: int, end: int) -> int | None:
    """The first place from ``start`` and before ``end`` where a gzip member begins.

    A place counts if 64 KB can be inflated from it, or a whole member.
    """
    at, data = start, b""
    while at < end:
        file.seek(at)
        data = file.read(CHUNK)
        if not data:
            return None
        found = data.find(MAGIC)
        while 0 <= found and at + found < end:
            if _begins_member(file, at + found):
                return at + found
            found = data.find(MAGIC, found + 1)
        at += max(1, len(data) - len(MAGIC) + 1)
    return None


def _begins_member(file: BinaryIO, at: int) -> bool:
    file.seek(at)
    stream, made = zlib.decompressobj(31), 0
    try:
        while made < 1 << 16 and not stream.eof:
            data = stream.unconsumed_tail or file.read(1 << 16)
            if not data:
                return False
            made += len(stream.decompress(data, 1 << 16))
    except zlib.error:
        return False
    return True


def lzw(raw: Iterator[bytes]) -> Iterator[bytes]:
    """The data of a ``.Z`` file.  Damaged data raises ``ValueError``, as far as the format shows it.

    Codes grow from 9 bits to the width in the header.  They come in groups of eight; a new
    width, or a cleared table, begins a new group.
    """
    data = b"".join(_at_least(raw, 3))
    if data[:2] != LZW_MAGIC or len(data) < 3 or not 9 <= data[2] & 31 <= 16:
        raise ValueError("not LZW data")
    most, cleared = data[2] & 31, data[2] & 128
    first = LZW_CLEAR + 1 if cleared else LZW_CLEAR
    before, last = [0] * (1 << most), [*range(256), *[0] * ((1 << most) - 256)]
    text: list[bytes | None] = [bytes([n]) for n in range(256)] + [None] * ((1 << most) - 256)
    data, at, out, size = data[3:], 0, [], 0
    width, free, previous = 9, first, None

    def expanded(code: int) -> bytes:
        tail = bytearray()
        while text[code] is None:
            tail.append(last[code])
            code = before[code]
        return text[code] + tail[::-1]

    string = b""
    while True:
        if len(data) - at < width:
            data, at = data[at:] + b"".join(_at_least(raw, width)), 0
        group = data[at : at + width]
        at += len(group)
        bits, mask = int.from_bytes(group, "little"), (1 << width) - 1
        for n in range(len(group) * 8 // width):
            code = bits >> n * width & mask
            if code == LZW_CLEAR and cleared:
                width, free, previous = 9, first, None
                break
            if previous is None:
                if code > 255:
                    raise ValueError("damaged LZW data: a first code that is no byte")
                string = text[code]
            else:
                if code > free or code == free == 1 << most:
                    raise ValueError("damaged LZW data: an unknown code")
                new = string + string[:1] if code == free else expanded(code)
                if free < 1 << most:
                    before[free], last[free] = previous, new[0]
                    text[free] = string + new[:1] if len(string) < LZW_KEPT else None
                    free += 1
                string = new
            previous = code
            out.append(string)
            size += len(string)
            if free == 1 << width and width < max(most, 10):  # nine bits grow once all the same
                width += 1
                break
        if size >= CHUNK:
            yield b"".join(out)
            out, size = [], 0
        if not group:
            break
    if out:
        yield b"".join(out)


def _at_least(raw: Iterator[bytes], size: int) -> Iterator[bytes]:
    while size > 0 and (data := next(raw, b"")):
        size -= len(data)
        yield data


def utf8(chunks: Iterable[bytes], encoding: str, mark: int) -> Iterator[bytes]:
    """Chunks in UTF-8 without the mark; what cannot be decoded becomes U+FFFD."""
    decoder = None if encoding == "utf-8" else codecs.getincrementaldecoder(encoding)("replace")
    for chunk in chunks:
        if mark:
            mark, chunk = max(0, mark - len(chunk)), chunk[mark:]
        yield decoder.decode(chunk).encode() if decoder else chunk
    if decoder:
        yield decoder.decode(b"", True).encode()


def lines(chunks: Iterable[bytes]) -> Iterator[list[bytes]]:
    """Lists of lines, which end with a line feed, a carriage return, or both."""
    tail = b""
    for chunk in chunks:
        data = tail + chunk
        half = data.endswith(b"\r")  # a line feed may follow
        parts = (data[:-1] if half else data).replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n")
        tail = parts.pop() + (b"\r" if half else b"")
        if parts:
            yield parts
    if tail:
        yield [tail.removesuffix(b"\r")]


def owned(found: Iterator[tuple[int, bytes]], start: int, end: int | None) -> Iterator[bytes]:
    """Of the members from ``start`` on the bytes of the lines that begin up to the member at ``end``.

    A line that begins before ``start``, or right there, is that of the members before;
    the first line of the file has none before it.
    """
    skipping, swallow, last = start > 0, False, b""
    for begin, chunk in found:
        if end is not None and begin >= end:
            if begin > end:
                raise ValueError(f"no gzip member begins at {end}")
            yield from _rest(chunk, found, skipping, swallow, last)
            return
        if skipping:
            ends = [n for n in (chunk.find(b"\n"), chunk.find(b"\r")) if n >= 0]
            if not ends:
                continue
            skipping, swallow = False, chunk[min(ends) : min(ends) + 1] == b"\r"
            chunk = chunk[min(ends) + 1 :]
        if swallow and chunk:
            swallow, chunk = False, chunk.removeprefix(b"\n")
        if chunk:
            last = chunk[-1:]
            yield chunk


def _rest(chunk: bytes, found: Iterator[tuple[int, bytes]], skipping: bool, swallow: bool, last: bytes) -> Iterator[bytes]:
    """The end of the line that goes on behind the last member."""
    if skipping:
        return
    following = chain([chunk], (more for _, more in found))
    chunk = next(filter(None, following), b"")
    if swallow and chunk.startswith(b"\n"):
        return
    if last == b"\r" and chunk.startswith(b"\n"):
        yield b"\n"
        return
    for chunk in chain([chunk], following):
        ends = [n for n in (chunk.find(b"\n"), chunk.find(b"\r")) if n >= 0]
        yield chunk[: min(ends) + 1] if ends else chunk
        if ends:
            return
