"""Tables, shared folders and batch helpers for the corpus operators."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than these (space, and 0x09 to 0x0D).
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"

#: Text bytes that a task handles at once. A longer text is handled alone, and whole.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.lru_cache(maxsize=1)
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="locusmill-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Only a local session may leave the setting out; it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _own_folder()


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and safe when executors go."""
    path = fresh_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def checksum(column: Column) -> Column:
    """CRC-32 of a value as decimal text."""
    return F.crc32(column.cast("string").cast("binary"))


def sampled(frame: DataFrame, group: str | None, most: int, key: str, salt: str) -> DataFrame:
    """A sample of about ``most`` rows for each value of ``group`` (of the whole frame: None).

    Rows are taken by a hash of ``key``, so that the sample is the same in every run and holds
    the copies of a row together. Values of ``group`` are counted on the driver; there must be
    few of them.
    """
    name = F.lit("") if group is None else F.col(group)
    counts = {r[0]: r[1] for r in frame.groupBy(name.alias("g")).count().collect()}
    if not counts:
        return frame
    rates = F.create_map(*[F.lit(x) for g, n in counts.items() for x in (g, min(1.0, most / n))])
    place = F.pmod(F.xxhash64(F.lit(salt), F.col(key)), F.lit(1_000_000)) / 1_000_000.0
    return frame.where(place < F.get(F.map_values(rates), F.lit(0)) if group is None else place < rates[name])


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about ``most`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


#: Arrow types of the types in the short schemas of this package.
ARROW = {
    "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()), "array<float>": pa.list_(pa.float32()), "array<string>": pa.list_(pa.string()),
}


def batch(schema: str, *columns) -> pa.RecordBatch:
    """A record batch of the columns, in the types of a schema like ``"doc_id long, text string"``."""
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    arrays = [
        c.cast(ARROW[kind]) if isinstance(c, pa.Array) else pa.array(c, ARROW[kind])
        for c, (_, kind) in zip(columns, fields, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[name.strip("`") for name, _ in fields])
