"""Variant identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from locusmill.functions.alleles import alternates


def chromosome(contig: Column) -> Column:
    """Contig name without a leading ``chr``."""
    return F.regexp_replace(contig, "^chr", "")


def contig_number(contig: Column) -> Column:
    """X is 23, Y is 24, any M is 25; a name that is no number gives NULL."""
    name = chromosome(contig)
    return (
        F.when(name == "X", 23)
        .when(name == "Y", 24)
        .when(name.startswith("M"), 25)
        .otherwise(name.try_cast("int"))
    )


def xpos(contig: Column, position: Column) -> Column:
    """Contig number and position in one sortable long."""
    return contig_number(contig).cast("long") * F.lit(1_000_000_000) + position.cast("long")


def _joined(contig: Column, position: Column, ref: Column, alt: Column, max_length: int | None) -> Column:
    text = F.concat(contig, F.lit("-"), position.cast("string"), F.lit("-"), ref, F.lit("-"), alt)
    return text if max_length is None else F.substring(text, 1, max_length)


def variant_id(contig: Column, position: Column, ref: Column, alt: Column, max_length: int | None = None) -> Column:
    """``chrom-pos-ref-alt``; NULL when a part is missing."""
    return _joined(chromosome(contig), position, ref, alt, max_length)


def site_variant_ids(contig: Column, position: Column, alleles: Column, max_length: int | None = None) -> Column:
    """One id per alternate of an unsplit site. The contig is kept as written."""
    ref = F.get(alleles, F.lit(0))
    return F.transform(alternates(alleles), lambda alt: _joined(contig, position, ref, alt, max_length))


def original_alternates(contig: Column, position: Column, alleles: Column) -> Column:
    """Ids of all alternates where the site had more than one, else NULL."""
    return F.when(F.size(alleles) > 2, site_variant_ids(contig, position, alleles))


def variant_letter(ref: Column, alt: Column) -> Column:
    """D, I, M or S by allele lengths."""
    return (
        F.when(F.length(ref) > F.length(alt), "D")
        .when(F.length(ref) < F.length(alt), "I")
        .when(F.length(ref) > 1, "M")
        .when(ref.isNotNull() & alt.isNotNull(), "S")
    )


def end_position(position: Column, ref: Column) -> Column:
    """Half-open end."""
    return position + F.length(ref)
