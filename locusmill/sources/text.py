"""Lines of plain, gzip and block-gzip text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.sources.ranges import RANGE_BYTES, LineRanges, top_lines


def read_lines(
    spark: SparkSession, path: str, block_gzip: bool = False, drop_matching: str | None = None, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """``value, path, line`` per line. Lines that match ``drop_matching`` go before any parsing.

    ``line`` is where the line begins in its file (see :mod:`locusmill.sources.ranges`): the same in
    every reading. ``path`` may be a file, a folder or a pattern. Plain and block-gzip text is read
    in ranges of ``range_bytes``; ``.gz`` takes one task per file, unless ``block_gzip`` says that
    the files, whatever their suffix, are block-gzip.
    """
    spark.dataSource.register(LineRanges)
    options = {"block_gzip": str(block_gzip).lower(), "range_bytes": str(range_bytes)}
    lines = spark.read.format(LineRanges.name()).options(**options).load(path)
    return lines if drop_matching is None else drop_lines(lines, drop_matching)


def drop_lines(lines: DataFrame, pattern: str) -> DataFrame:
    """Remove the lines that match a pattern anywhere."""
    return lines.where(~F.col("value").rlike(pattern))


def header_lines(block_gzip: bool):
    """A function for mapInArrow over ``path`` rows: the ``#`` lines at the top of each file."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                top = list(top_lines(path, block_gzip))
                columns = [pa.array(top, pa.string()), pa.array([path] * len(top), pa.string()), pa.array(range(len(top)), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["value", "path", "line"])

    return read
