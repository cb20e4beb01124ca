"""Counts over a whole variant table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusmill.functions.alleles import allele_class, alternates
from locusmill.functions.basics import explode_computed


def variant_summary(sites: DataFrame) -> DataFrame:
    """``section, label, n``: total, per contig, per allele class, alleles per site.

    One pass: each site is expanded into the labels it counts for, and counts are combined
    before the shuffle, so the few labels are no hot keys.
    """
    ref = F.get("alleles", F.lit(0))

    def row(section: str, label: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), label.cast("string").alias("label"))

    labels = F.concat(
        F.array(
            row("variants", F.lit("total")),
            row("contig", F.col("contig")),
            row("alleles_per_site", F.size("alleles")),
        ),
        F.transform(alternates(F.col("alleles")), lambda alt: row("allele_type", allele_class(ref, alt))),
    )
    return (
        explode_computed(sites, labels, "l")
        .groupBy(F.col("l.section").alias("section"), F.col("l.label").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def sort_by_variant(rows: DataFrame, column: str = "variant_id", ties: list[str] | None = None) -> DataFrame:
    """Global sort: sampled range partitioning, then a sort inside each partition.

    A hash of ``ties`` orders rows with one id, so that an id with very many rows is spread over
    several partitions instead of filling a single one. By default these are the columns of plain
    types; nested ones are not hashed.
    """
    if ties is None:
        nested = ("array", "map", "struct", "variant")
        ties = [f.name for f in rows.schema.fields if f.name != column and f.dataType.typeName() not in nested]
    return rows.orderBy(column, F.xxhash64(*[F.col(f"`{c}`") for c in ties])) if ties else rows.orderBy(column)
