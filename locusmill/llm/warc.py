"""Operator 8: WARC archives with a two-level capture index.

Records are gzip members of archive files. The index sorts their reversed-host URL keys into
blocks of lines, each compressed on its own, and keeps a sparse directory beside each index file:
the first key of every block. A lookup finds the index file among the first keys of all files (one
key a file), then the block in that file's directory, both by binary search, and only then reads
the block's range, and the records' ranges from the archives, close ones together.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import zlib
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.llm.blobs import opened, read_ranges, task_file, write_file
from locusmill.llm.shared import batch, fresh_folder, slices, table, written

#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 0
BLOCK_LINES, FILE_BYTES = 3_000, 1 << 30
#: Archive ranges are dealt out to tasks by stretches of this size.
STRETCH_BYTES = 32 << 20
DATE = "2000-01-01T00:00:00Z"
# Fixed value: the profile of records that repeat a payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "key string, page_id long, file string, offset long, length long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def url_key(url: str | None) -> str:
    """Reversed host, then port, path and query: ``com,example,www)/path?query``."""
    text = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    try:
        parts = urlsplit(text)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return f"){text}"
    host = ",".join(reversed(host.split("."))) + (f":{port}" if port else "")
    return f"{host}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(text: str | None) -> int | None:
    number = (text or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, original: int | None, is_revisit: bool) -> bytes:
    """One gzip member. A revisit keeps the HTTP head alone, which states the payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if is_revisit else head + payload
    uri = "" if url is None else f"WARC-Target-URI: {re.sub(r'[\x00-\x1f\x7f]', lambda m: f'%{ord(m[0]):02X}', url)}\r\n"
    more = f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: {_id(original)}\r\n" if is_revisit else ""
    lines = (
        f"WARC/1.1\r\nWARC-Type: {'revisit' if is_revisit else 'response'}\r\nWARC-Record-ID: {_id(page_id)}\r\n"
        f"WARC-Date: {DATE}\r\n{uri}WARC-Payload-Digest: sha1:{digest_of(payload)}\r\n{more}"
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n"
    )
    return gzip.compress(lines.encode() + block + b"\r\n\r\n", 6, mtime=0)


def parsed(member: bytes) -> dict:
    """The fields of a record read back. A response's payload must have the digest it states."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"the payload of record {fields['WARC-Record-ID']} differs from its digest")
    return {
        "page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
        "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": _page(fields.get("WARC-Refers-To")),
    }


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes a record for each ``page_id, url, html`` row; returns its capture.

    Of equal payloads of ``least_bytes`` or more, the one with the largest ``page_id`` is the
    response and the others revisit it; rows that repeat its id are responses too, and so is a
    payload that only rows without id have. A null html is an empty payload.
    """
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("html")).withColumn("sha", F.sha1("html"))
    repeated = keyed.where(F.octet_length("html") >= least_bytes).groupBy("sha").agg(
        F.count("*").alias("n"), F.max("page_id").alias("original")
    )
    repeated = written(repeated.where("n > 1 AND original IS NOT NULL").select("sha", "original"), "warc-repeats")
    decided = keyed.join(repeated, "sha", "left").withColumn(
        "is_revisit", F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    )

    def run(batches):
        file, out, at, number = "", None, 0, 0
        try:
            for part in slices(batches, "html"):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    file, at, number = task_file(folder, ".warc.gz", number), 0, number + 1
                    out = write_file(file)
                rows = []
                for row in part.to_pylist():
                    member = record(row["page_id"], row["url"], row["html"], row["original"], row["is_revisit"])
                    out.write(member)
                    rows.append((url_key(row["url"]), row["page_id"], file, at, len(member)))
                    at += len(member)
                yield batch(CAPTURE, *map(list, zip(*rows, strict=True)))
        finally:
            if out is not None:
                out.close()

    chosen = decided.select("page_id", "url", "html", "original", "is_revisit")
    return written(chosen.mapInArrow(run, CAPTURE), "warc-captures")


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Sorts captures into index files; returns ``first_key, last_key, file``, a row for each.

    Captures are dealt out by ranges of key and page, so that a key with very many captures is
    spread over files. A line is the key, a space, and a JSON object.
    """
    schema = "first_key string, last_key string, file string"

    def run(batches):
        rows = (row for part in batches for row in part.to_pylist())
        first = next(rows, None)
        if first is None:
            return
        file, at, directory, last = task_file(folder, ".cdx.z"), 0, [], first["key"]

        def close(lines):
            data = zlib.compress("".join(lines).encode())
            out.write(data)
            return len(data)

        with write_file(file) as out:
            lines, start = [], first["key"]
            for row in (r for group in ([first], rows) for r in group):
                if len(lines) == BLOCK_LINES:
                    size = close(lines)
                    directory.append((start, at, size))
                    at, lines, start = at + size, [], row["key"]
                lines.append(f"{row['key']} {json.dumps({k: row[k] for k in ('page_id', 'file', 'offset', 'length')})}\n")
                last = row["key"]
            directory.append((start, at, close(lines)))
        with write_file(f"{file}.directory") as out:
            out.write(json.dumps(directory).encode())
        yield batch(schema, [first["key"]], [last], [file])

    n = captures.sparkSession.conf.get("spark.sql.shuffle.partitions")
    sorted_ = captures.repartitionByRange(int(n), "key", "page_id").sortWithinPartitions("key", "page_id", "file", "offset")
    return written(sorted_.mapInArrow(run, schema), "warc-index")


class Index:
    """One index file: its directory, and the block read last."""

    def __init__(self, file: str):
        self.file = file
        store, path = opened(f"{file}.directory")
        with store.open_input_file(path) as source:
            self.directory = json.loads(source.read())
        self.first = [d[0] for d in self.directory]
        self.block, self.keys, self.lines = None, [], []

    def load(self, block: int) -> None:
        if block != self.block:
            _, offset, length = self.directory[block]
            ((_, data),) = read_ranges(self.file, [(offset, length)])
            self.lines = zlib.decompress(data).decode().split("\n")[:-1]
            self.keys = [line.split(" ", 1)[0] for line in self.lines]
            self.block = block

    def find(self, key: str):
        """Captures of a key: it may end the block before the first that starts with it."""
        for block in range(max(0, bisect.bisect_left(self.first, key) - 1), bisect.bisect_right(self.first, key)):
            self.load(block)
            for line in self.lines[bisect.bisect_left(self.keys, key) : bisect.bisect_right(self.keys, key)]:
                yield json.loads(line.split(" ", 1)[1])


def look_up(keys: DataFrame, index: DataFrame) -> DataFrame:
    """The captures of each distinct ``key``. A key that the index lacks gives no row.

    The driver holds two keys for each index file. Keys go to tasks by file and range, sorted, so
    that a block is read once for all keys that fall into it.
    """
    files = sorted((r.first_key, r.last_key, r.file) for r in index.collect())
    firsts, lasts = [f[0] for f in files], [f[1] for f in files]
    to_file = "file string, key string"

    def route(batches):
        for part in batches:
            found = [
                (files[i][2], key)
                for key in part.column("key").to_pylist()
                for i in range(bisect.bisect_left(lasts, key), bisect.bisect_right(firsts, key))
            ]
            yield batch(to_file, [f[0] for f in found], [f[1] for f in found])

    def find(batches):
        held = None
        for part in batches:
            rows = []
            for file, key in zip(part.column("file").to_pylist(), part.column("key").to_pylist(), strict=True):
                if held is None or held.file != file:
                    held = Index(file)
                rows += [(key, c["page_id"], c["file"], c["offset"], c["length"]) for c in held.find(key)]
                if len(rows) >= 50_000:
                    yield batch(CAPTURE, *map(list, zip(*rows, strict=True)))
                    rows = []
            if rows:
                yield batch(CAPTURE, *map(list, zip(*rows, strict=True)))

    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = keys.where("key IS NOT NULL").select("key").distinct().mapInArrow(route, to_file)
    return wanted.repartitionByRange(n, "file", "key").sortWithinPartitions("file", "key").mapInArrow(find, CAPTURE)


def read_records(captures: DataFrame) -> DataFrame:
    """The records at the places of ``captures``, parsed."""

    def run(batches):
        for part in batches:
            ranges: dict[str, list[tuple[int, int]]] = {}
            for file, offset, length in zip(*(part.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                ranges.setdefault(file, []).append((offset, length))
            for file, own in ranges.items():
                rows = [parsed(member) for _, member in read_ranges(file, own)]
                yield batch(RECORD, *[[r[f.split(" ")[0]] for r in rows] for f in RECORD.split(", ")])

    stretch = F.expr(f"offset div {STRETCH_BYTES}")
    placed = captures.repartition("file", stretch).sortWithinPartitions("file", "offset")
    return placed.select("file", "offset", "length").mapInArrow(run, RECORD)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives and indexes all pages, looks all their keys up, and reads the records back."""
    captures = write_archives(table(spark, sf_dir, "pages"), fresh_folder(spark, "warc"))
    index = write_index(captures, fresh_folder(spark, "warc-index"))
    return read_records(look_up(captures.select("key"), index)).drop("url")


OP8_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS original,
    sha1(encode(coalesce(html, ''))) AS h
  FROM pages
)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
      ((('0x' || substr(h, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM p
"""
