"""Folders for tables and files that jobs write for later ones."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.lru_cache(maxsize=1)
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="locusmill-")


def fresh_folder(spark: SparkSession, label: str, under: str | None = None) -> str:
    """The name of a folder that no other run uses and that all executors see.

    It lies below ``under``, or below ``spark.checkpoint.dir``. Only a local session may go without
    that setting, or name a folder of one machine.
    """
    local = spark.sparkContext.master.startswith("local")
    folder = under or spark.conf.get("spark.checkpoint.dir", None) or (_own_folder() if local else None)
    if folder is None:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if under is not None and under.startswith("file:") and not local:
        raise ValueError(f"{under} is a folder of one machine")
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, label: str, under: str | None = None) -> DataFrame:
    """The frame as a table in a folder of its own: computed once, and kept when executors go."""
    folder = fresh_folder(frame.sparkSession, label, under)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)
