"""Expression matrices in long form: one row per transcript and sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusmill.vocabulary import TISSUE_COLUMNS


def tissue_columns(tissues: list[str], names: dict[str, str] = TISSUE_COLUMNS) -> dict[str, str]:
    """Column name of every observed tissue, in tissue order; an unknown tissue is an error."""
    unknown = sorted(set(tissues) - set(names))
    if unknown:
        raise KeyError(f"no column name for tissues {unknown}")
    return {tissue: names[tissue] for tissue in sorted(tissues)}


def tissue_means(expression: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """Mean value per tissue, one column each, in a single aggregation.

    Partial sums are combined map-side, so one transcript or tissue with most of the samples
    costs no more than any other. A transcript without samples of a tissue gets NULL.
    """
    return expression.groupBy(*keys).agg(
        *[F.avg(F.when(F.col("tissue") == tissue, F.col("x"))).alias(name) for tissue, name in columns.items()]
    )


def value_stats(value: Column) -> list[Column]:
    """Full numeric statistics of one value."""
    value = value.cast("double")
    return [
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("stdev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.count(value).alias("n"),
        F.sum(value).alias("sum"),
    ]


def tissue_stats(expression: DataFrame, keys: list[str]) -> DataFrame:
    return expression.groupBy(*keys, "tissue").agg(*value_stats(F.col("x")))
