"""A data source for lines of text that knows where each line begins.

Files are divided into byte ranges of a fixed size, one partition each, and a line belongs to the
range in which it begins. ``line`` is the place of its first byte: the byte offset in plain text,
the offset in the unpacked text of a ``.gz`` file (which is one range), and in block-gzip files
the place of its block shifted left by 16 bits plus the offset inside the block. So a line has the
same number whatever the number of cores, the size of the ranges, or the attempt that reads it.
"""

from __future__ import annotations

import fnmatch
import posixpath
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RANGE_BYTES = 64 << 20
CHUNK_BYTES = 4 << 20
# Start of a block-gzip member, and the extra field that holds its size.
_MAGIC = b"\x1f\x8b\x08\x04"
_SIZE_FIELD = b"BC\x02\x00"
_MAX_BLOCK = 1 << 16
_SCHEMA = pa.schema([("value", pa.string()), ("path", pa.string()), ("line", pa.int64())])


def opened(uri: str):
    """File system and path of a URI; pyarrow knows some stores by other schemes than Spark."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if not colon:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3", "abfss": "abfs"}.get(scheme, scheme) + colon + rest)


def listed(path: str) -> list[tuple[str, int]]:
    """URI and size of the files that a path names: a file, the files in a folder, or a pattern."""
    from pyarrow import fs

    scheme = path[: len(path) - len(path.split("://", 1)[-1])] if "://" in path else ""
    fixed = re.split(r"[*?\[]", path, maxsplit=1)[0]
    pattern = fixed != path
    store, base = opened(posixpath.dirname(fixed) if pattern else path)
    if pattern:
        full = posixpath.join(base, path[len(posixpath.dirname(fixed)) :].lstrip("/"))
        found = [f for f in store.get_file_info(fs.FileSelector(base, recursive=True)) if fnmatch.fnmatch(f.path, full)]
    else:
        (info,) = store.get_file_info([base])
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        found = store.get_file_info(fs.FileSelector(base)) if info.type == fs.FileType.Directory else [info]
    # the store's own paths, with the scheme and host that the caller named
    prefix = path[: path.index(base)] if scheme and base in path else scheme
    files = [f for f in found if f.type == fs.FileType.File and not posixpath.basename(f.path).startswith(("_", "."))]
    return sorted((prefix + f.path, f.size) for f in files if f.size)


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int
    kind: str


class LineRanges(DataSource):
    """``spark.read.format("line_ranges").load(path)``; options ``block_gzip`` and ``range_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "line_ranges"

    def schema(self) -> str:
        return "value string, path string, line long"

    def reader(self, schema) -> LineReader:
        return LineReader(self.options)


class LineReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.block_gzip = str(options.get("block_gzip", "false")).lower() == "true"
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))

    def partitions(self) -> list[Range]:
        ranges = []
        for path, size in listed(self.path):
            kind = "block" if self.block_gzip else "gzip" if path.endswith(".gz") else "plain"
            step = size if kind == "gzip" else self.range_bytes
            ranges += [Range(path, start, start + step, kind) for start in range(0, size, step)]
        return ranges or [Range("", 0, 0, "none")]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition.kind == "none":
            return
        store, name = opened(partition.path)
        if partition.kind == "gzip":
            with store.open_input_stream(name, compression="gzip") as source:
                found = lines_of(_chunks(lambda at: source.read(CHUNK_BYTES)))
                yield from (_batch(partition.path, *part) for part in found)
            return
        with store.open_input_file(name) as source:
            found = lines_of_blocks(source, partition) if partition.kind == "block" else lines_of_range(source, partition)
            yield from (_batch(partition.path, *part) for part in found)


def _batch(path: str, text: bytes, starts: np.ndarray) -> pa.RecordBatch:
    columns = [_values(text, len(starts)), pa.repeat(pa.scalar(path, pa.string()), len(starts)), pa.array(starts, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def _values(text: bytes, n: int) -> pa.Array:
    """The first ``n`` lines of a text. One buffer of all of them, unless a line has to be changed."""
    if n and b"\r\n" not in text and _is_utf8(text):
        ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)[:n]
        offsets = np.concatenate([[0], ends - np.arange(n)]).astype(np.int32)
        return pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(text[: ends[-1]].replace(b"\n", b"")))
    return pa.array([line.removesuffix("\r") for line in text.decode("utf-8", "replace").split("\n")[:n]], pa.string())


def _is_utf8(text: bytes) -> bool:
    try:
        return text.isascii() or bool(text.decode("utf-8"))
    except UnicodeDecodeError:
        return False


def _chunks(read, offset: int = 0) -> Iterator[tuple[int, bytes]]:
    while chunk := read(offset):
        yield offset, chunk
        offset += len(chunk)


def lines_of(chunks: Iterator[tuple[int, bytes]], end: int | None = None) -> Iterator[tuple[bytes, np.ndarray]]:
    """Whole lines in one text, and the offset of each; those that begin at ``end`` or later are left."""
    pending, at = b"", None
    for offset, chunk in chunks:
        at = offset if at is None else at
        text, newline, pending = (pending + chunk).rpartition(b"\n")
        if newline:
            text += newline
            starts = at + _line_starts(text)
            at += len(text)
            if end is not None and len(starts) and starts[-1] >= end:
                yield text, starts[starts < end]
                return
            yield text, starts
        if end is not None and at >= end:
            return
    if pending and (end is None or at < end):
        yield pending + b"\n", np.array([at])


def _line_starts(text: bytes) -> np.ndarray:
    """Where lines begin in a text that ends with one's end."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
    return np.concatenate([[0], ends[:-1] + 1])


def lines_of_range(source, part: Range) -> Iterator[tuple[bytes, np.ndarray]]:
    """Lines of plain text that begin in the range. A range but the first starts behind the first
    line end from the byte before it."""
    size, start = source.size(), part.start
    if start:
        start = _behind_line_end(source, start - 1, size)
    if start is not None and start < part.end:
        yield from lines_of(_chunks(lambda at: source.read_at(min(CHUNK_BYTES, size - at), at) if at < size else b"", start), part.end)


def _behind_line_end(source, at: int, size: int) -> int | None:
    while at < size:
        chunk = source.read_at(min(CHUNK_BYTES, size - at), at)
        if (found := chunk.find(b"\n")) >= 0:
            return at + found + 1
        at += len(chunk)
    return None


class _Window:
    """Reads of a file from one large read-ahead buffer."""

    def __init__(self, source):
        self.source, self.size, self.start, self.data = source, source.size(), 0, b""

    def read_at(self, n: int, offset: int) -> bytes:
        if not (self.start <= offset and offset + n <= self.start + len(self.data)):
            self.start = offset
            self.data = self.source.read_at(min(max(n, CHUNK_BYTES), self.size - offset), offset)
        return self.data[offset - self.start : offset - self.start + n]


def _blocks(window: _Window, start: int) -> Iterator[tuple[int, bytes]]:
    """Offset and content of every block that begins at or after ``start``."""
    offset = _first_block(window, start)
    while offset is not None and offset < window.size:
        length = _block_length(window.read_at(min(18, window.size - offset), offset))
        if length is None:
            raise ValueError(f"not a block-gzip member at byte {offset}")
        yield offset, zlib.decompress(window.read_at(length, offset), 31)
        offset += length


def _block_length(header: bytes) -> int | None:
    if len(header) < 18 or header[:4] != _MAGIC or header[12:16] != _SIZE_FIELD:
        return None
    return int.from_bytes(header[16:18], "little") + 1


def _first_block(window: _Window, start: int) -> int | None:
    """The first true member: its size must lead to another member or to the end."""
    if start == 0:
        return 0
    data = window.read_at(min(2 * _MAX_BLOCK + 36, window.size - start), start)
    at = data.find(_MAGIC)
    while 0 <= at < _MAX_BLOCK:
        length = _block_length(data[at : at + 18])
        if length is not None:
            following = start + at + length
            if following == window.size or data[at + length : at + length + 4] == _MAGIC:
                return start + at
        at = data.find(_MAGIC, at + 1)
    return None


def lines_of_blocks(source, part: Range) -> Iterator[tuple[bytes, np.ndarray]]:
    """Lines owned by a range of blocks.

    Every range but the first leaves out text up to its first line end, and every range reads on
    past its end up to the next one; so each line is read exactly once.
    """
    skipping, pending, first = part.start > 0, b"", None
    for offset, text in _blocks(_Window(source), part.start):
        past_end, at = offset >= part.end, 0
        if skipping:
            if past_end:
                return
            at = text.find(b"\n") + 1
            if not at:
                continue
            skipping = False
        if past_end:
            # the line that goes on here, or the one that begins with this block
            piece, newline, _ = text.partition(b"\n")
            if first is None and text:
                first = offset << 16
            pending += piece
            if newline:
                yield pending + newline, np.array([first])
                return
            continue
        whole, newline, rest = text[at:].rpartition(b"\n")
        if not newline:
            first = (offset << 16 | at) if first is None and rest else first
            pending += rest
            continue
        body = whole + newline
        starts = (offset << 16) + at + _line_starts(body)
        if first is not None:
            starts[0] = first
        yield pending + body, starts
        pending, first = rest, (offset << 16 | at + len(body)) if rest else None
    if pending:
        yield pending + b"\n", np.array([first])


def top_lines(path: str, block_gzip: bool) -> Iterator[str]:
    """The ``#`` lines at the top of a file."""
    store, name = opened(path)
    compressed = "gzip" if block_gzip or path.endswith((".gz", ".bgz")) else None
    with store.open_input_stream(name, compression=compressed, buffer_size=_MAX_BLOCK) as source:
        pending = b""
        while chunk := source.read(_MAX_BLOCK):
            *complete, pending = (pending + chunk).split(b"\n")
            for line in complete:
                if line and not line.startswith(b"#"):
                    return
                yield line.decode("utf-8", "replace").rstrip("\r")
        if pending.startswith(b"#"):
            yield pending.decode("utf-8", "replace").rstrip("\r")
