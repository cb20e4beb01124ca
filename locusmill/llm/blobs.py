"""Files in a shared store, written and range-read by tasks."""

from __future__ import annotations

import os

from pyarrow import fs
from pyspark import TaskContext

#: Schemes that Spark and pyarrow name differently.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}
#: Ranges this close are read at once.
GAP_BYTES, READ_BYTES = 64 << 10, 16 << 20


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, rest = uri.partition(":")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}{colon}{rest}" if colon else os.path.abspath(uri))


def task_file(folder: str, suffix: str, number: int = 0) -> str:
    """A name that no other task or attempt uses. What the task returns names its files, so those
    of an attempt that failed are never read."""
    context = TaskContext.get()
    return f"{folder}/part-{context.partitionId():05d}-{context.taskAttemptId()}-{number}{suffix}"


def write_file(uri: str):
    """An output stream; folders are made where the store has them."""
    store, path = opened(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    return store.open_output_stream(path, compression=None)


def read_ranges(uri: str, ranges: list[tuple[int, int]]):
    """``offset, bytes`` of ``(offset, length)`` ranges in order; close ones are read together."""
    store, path = opened(uri)
    with store.open_input_file(path) as source:
        group: list[tuple[int, int]] = []
        for offset, length in [*sorted(ranges), (None, 0)]:
            if group and (
                offset is None
                or offset - (group[-1][0] + group[-1][1]) > GAP_BYTES
                or offset + length - group[0][0] > READ_BYTES
            ):
                start, end = group[0][0], max(o + n for o, n in group)
                data = source.read_at(end - start, start)
                for o, n in group:
                    yield o, data[o - start : o - start + n]
                group = []
            if offset is not None:
                group.append((offset, length))
