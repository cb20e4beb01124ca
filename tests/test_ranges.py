"""Lines keep their place in the file however it is divided."""

import gzip
import random
import struct
import zlib

import pytest

from locusmill.sources import ranges, text, vcf


def block_gzipped(data, sizes):
    """Block-gzip members of the sizes given, in turn, and the place of each byte."""
    out, places, at, k = b"", {}, 0, 0
    while at < len(data):
        part = data[at : at + sizes[k % len(sizes)]]
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packer.compress(part) + packer.flush()
        for i in range(len(part)):
            places[at + i] = len(out) << 16 | i
        size = len(body) + 25
        out += b"\x1f\x8b\x08\x04" + bytes(6) + struct.pack("<H", 6) + b"BC\x02\x00" + struct.pack("<H", size) + body
        out += struct.pack("<II", zlib.crc32(part), len(part))
        at, k = at + len(part), k + 1
    return out, places


@pytest.fixture(scope="module")
def lines():
    rng = random.Random(5)
    made = ["", "é" * 40, "x" * 5000, "tab\there", "end\r"] + ["".join(rng.choices("abcdef,;", k=rng.randint(0, 120))) for _ in range(400)]
    rng.shuffle(made)
    return made


def placed(lines):
    """Each line without its carriage return, and the byte at which it begins."""
    at, out = 0, []
    for line in lines:
        out.append((at, line.removesuffix("\r")))
        at += len(line.encode()) + 1
    return out


def got(spark, path, **options):
    return sorted((r.line, r.value) for r in text.read_lines(spark, path, **options).collect())


@pytest.mark.parametrize("last", ["\n", ""])
@pytest.mark.parametrize("size", [500, 4096, 1 << 20])
def test_plain_text(spark, tmp_path, lines, last, size, monkeypatch):
    path = tmp_path / "a.txt"
    path.write_bytes(("\n".join([*lines, "no end"]) + last).encode())
    assert got(spark, str(path), range_bytes=size) == placed([*lines, "no end"])
    assert got(spark, f"file://{path}") == placed([*lines, "no end"])


@pytest.mark.parametrize("chunk", [3, 64, 1 << 20])
def test_reads_of_any_size(tmp_path, lines, chunk, monkeypatch):
    monkeypatch.setattr(ranges, "CHUNK_BYTES", chunk)
    path = tmp_path / "a.txt"
    path.write_bytes("\n".join(lines).encode() + b"\n")
    for size in (1, 40, 1000, 10**6):
        reader = ranges.LineReader({"path": str(path), "range_bytes": size})
        found = [(a, v) for part in reader.partitions() for b in reader.read(part) for a, v in zip(b["line"].to_pylist(), b["value"].to_pylist(), strict=True)]
        assert found == placed(lines)


@pytest.mark.parametrize("last", ["\n", ""])
@pytest.mark.parametrize("sizes", [[1], [7, 300], [65000]])
def test_block_gzip(tmp_path, lines, sizes, last):
    data = ("\n".join([*lines, "no end"]) + last).encode()
    packed, places = block_gzipped(data, sizes)
    path = tmp_path / "a.vcf.bgz"
    path.write_bytes(packed)
    want = [(places[at], line) for at, line in placed([*lines, "no end"])]
    for size in (60, 1000, 30000, 10**7):
        reader = ranges.LineReader({"path": str(path), "range_bytes": size, "block_gzip": "true"})
        found = [(a, v) for part in reader.partitions() for b in reader.read(part) for a, v in zip(b["line"].to_pylist(), b["value"].to_pylist(), strict=True)]
        assert found == want, size


def test_gzip_folders_and_patterns(spark, tmp_path):
    (tmp_path / "b.gz").write_bytes(gzip.compress(b"one\ntwo\n\nthree"))
    (tmp_path / "_hidden").write_text("no\n")
    (tmp_path / "c.txt").write_text("four\n")
    (tmp_path / "empty.txt").write_text("")
    rows = {(r.path.rsplit("/", 1)[1], r.line, r.value) for r in text.read_lines(spark, str(tmp_path)).collect()}
    assert rows == {("b.gz", 0, "one"), ("b.gz", 4, "two"), ("b.gz", 8, ""), ("b.gz", 9, "three"), ("c.txt", 0, "four")}
    assert {r.value for r in text.read_lines(spark, f"file://{tmp_path}/*.txt").collect()} == {"four"}
    assert text.read_lines(spark, f"{tmp_path}/empty.txt").collect() == []
    with pytest.raises(Exception, match="nowhere"):
        text.read_lines(spark, f"{tmp_path}/nowhere").collect()


def test_site_ids_are_the_same_in_any_division_and_attempt(spark, tmp_path):
    for name in ("a", "b"):
        body = "".join(f"chr1\t{i}\t.\tA\tT\t.\tPASS\t.\tGT\t0/1\n" for i in range(1, 600))
        (tmp_path / f"{name}.vcf").write_text(body)
    path, slots = str(tmp_path), spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)

    def ids(range_bytes):
        records = vcf.parse_records(text.read_lines(spark, path, range_bytes=range_bytes))
        sites = {r.site_id for r in vcf.site_rows(records, {}).collect()}
        assert sites == {r.site_id for r in vcf.entry_rows(records.repartition(3), samples=[0]).collect()}
        return sites

    whole = ids(64 << 20)
    assert len(whole) == 2 * 599
    try:
        for cores, size in (("1", 1500), ("4", 5000), ("12", 60_000)):
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", cores)
            assert ids(size) == whole
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism") if slots is None else None


def test_entries_stored_by_one_job_meet_sites_read_by_a_later_one(spark, tmp_path):
    (tmp_path / "a.vcf").write_text("".join(f"chr1\t{i}\t.\tA\tT\t.\tPASS\t.\tGT\t0/1\n" for i in range(1, 2000)))
    read = lambda size: vcf.parse_records(text.read_lines(spark, str(tmp_path / "a.vcf"), range_bytes=size))
    vcf.entry_rows(read(300), samples=[0]).write.parquet(str(tmp_path / "entries"))
    sites = vcf.site_rows(read(9000), {})
    assert sites.join(spark.read.parquet(str(tmp_path / "entries")), "site_id").count() == 1999


@pytest.mark.parametrize("text", [b"a\n\nbc\n", "é\nüü\n\n".encode(), b"a\r\nb\rc\r\n", b"\xff\xfe\nq\n", b"\n"])
def test_values_of_a_text_in_one_buffer(text):
    plain = [line.removesuffix("\r") for line in text.decode("utf-8", "replace").split("\n")]
    for n in range(text.count(b"\n") + 1):
        found = ranges._values(text, n)
        found.validate(full=True)
        assert found.to_pylist() == plain[:n]
