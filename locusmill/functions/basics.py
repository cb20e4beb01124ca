"""Small helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def literal_map(entries: Mapping) -> Column:
    """A constant map column; looking up a missing key gives NULL."""
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def as_set(values: Column) -> Column:
    """Distinct values in ascending order, nulls last."""
    return F.array_sort(F.array_distinct(values))


def flatten_present(arrays: Column) -> Column:
    """Flatten an array of arrays, skipping inner arrays that are NULL."""
    return F.flatten(F.filter(arrays, lambda inner: inner.isNotNull()))


def last_part(text: Column, separator: str) -> Column:
    return F.substring_index(text, separator, -1)


def explode_computed(frame: DataFrame, array: Column, name: str) -> DataFrame:
    """One row per non-null element of an array expression.

    The inner form of explode makes the optimizer test the array in a filter of its own, which
    evaluates the expression a second time. The outer form does not, and empty arrays drop out
    afterwards.
    """
    return frame.withColumn(name, F.explode_outer(array)).where(F.col(name).isNotNull())


def computed_once(frame: DataFrame, name: str) -> DataFrame:
    """Pin a costly derived column.

    Join keys and filters that read it would otherwise be pushed below it, and evaluate its
    expression once more each. They are not pushed through an explode.
    """
    return frame.withColumn(name, F.explode_outer(F.array(name)))


def in_small_methods(values: Column, element: str) -> Column:
    """A list of long expressions, compiled in methods of their own.

    Whole-stage code makes one method of a projection, and beyond 8,000 bytes the JVM interprets
    that instead of compiling it. A projection with a function on a list, if only on an empty one,
    has no whole-stage code; Spark then deals its expressions out to small methods.
    """
    return F.concat(values, F.filter(F.array().cast(f"array<{element}>"), lambda x: x.isNotNull()))
