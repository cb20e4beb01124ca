"""Allele typing and minimal representation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from locusmill.functions.basics import let

# Fixed value: alleles that take part in typing are made of these letters.
BASES = "^[ACGTNM]+$"


def _spelled_out(ref: Column, alt: Column) -> Column:
    return ref.rlike(BASES) & alt.rlike(BASES)


def _differing_bases(ref: Column, alt: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(ref))
    return F.size(F.filter(places, lambda i: F.substr(ref, i, F.lit(1)) != F.substr(alt, i, F.lit(1))))


def is_snv(ref: Column, alt: Column) -> Column:
    """Same length and exactly one base differs."""
    one_base_apart = F.when(F.length(ref) == 1, ref != alt).otherwise(_differing_bases(ref, alt) == 1)
    return F.when(_spelled_out(ref, alt) & (F.length(ref) == F.length(alt)), one_base_apart).otherwise(False)


def _extends(short: Column, long: Column) -> Column:
    return (
        (F.length(short) < F.length(long))
        & (F.left(short, F.lit(1)) == F.left(long, F.lit(1)))
        & F.endswith(long, F.substring(short, 2, 2**31 - 1))
    )


def is_insertion(ref: Column, alt: Column) -> Column:
    return F.when(_spelled_out(ref, alt), _extends(ref, alt)).otherwise(False)


def is_deletion(ref: Column, alt: Column) -> Column:
    return F.when(_spelled_out(ref, alt), _extends(alt, ref)).otherwise(False)


def is_indel(ref: Column, alt: Column) -> Column:
    return is_insertion(ref, alt) | is_deletion(ref, alt)


def allele_type(ref: Column, alt: Column) -> Column:
    """snv, ins, del or complex, for a bi-allelic row."""
    return (
        F.when(is_snv(ref, alt), "snv")
        .when(is_insertion(ref, alt), "ins")
        .when(is_deletion(ref, alt), "del")
        .otherwise("complex")
    )


def allele_class(ref: Column, alt: Column) -> Column:
    """The finer class used by the variant summary."""
    return (
        F.when(is_snv(ref, alt), "SNP")
        .when(_spelled_out(ref, alt) & (F.length(ref) == F.length(alt)) & (ref != alt), "MNP")
        .when(is_insertion(ref, alt), "Insertion")
        .when(is_deletion(ref, alt), "Deletion")
        .when(_spelled_out(ref, alt) & (ref != alt), "Complex")
        .when(alt == "*", "Star")
        .when(alt.rlike("^<.*>$"), "Symbolic")
        .otherwise("Unknown")
    )


def alternates(alleles: Column) -> Column:
    """All alternate alleles of a site."""
    return F.slice(alleles, F.lit(2), F.greatest(F.size(alleles) - 1, F.lit(0)))


def site_allele_data(alleles: Column) -> Column:
    """Summary of an unsplit site. A site with only ``*`` alternates is an snv with none."""
    ref = F.get(alleles, F.lit(0))

    def summarise(named: Column) -> Column:
        many = F.size(named) > 1
        kind = (
            F.when(F.forall(named, lambda a: is_snv(ref, a)), F.when(many, "multi-snv").otherwise("snv"))
            .when(F.forall(named, lambda a: is_indel(ref, a)), F.when(many, "multi-indel").otherwise("indel"))
            .otherwise("mixed")
        )
        return F.struct(
            alleles.alias("nonsplit_alleles"),
            F.array_contains(alleles, "*").alias("has_star"),
            kind.alias("variant_type"),
            F.size(named).alias("n_alt_alleles"),
        )

    return let(F.filter(alternates(alleles), lambda a: a != "*"), summarise)


def minimal(position: Column, ref: Column, alt: Column) -> Column:
    """``struct(position, ref, alt)`` without shared suffix, then without shared prefix.

    At least one base of each allele stays; star and symbolic alleles are left alone.
    A shared suffix of n bases implies shared suffixes of 1..n-1 bases, so counting the
    lengths that agree gives the longest one.
    """

    def shared(longest: Column, side) -> Column:
        lengths = F.sequence(F.lit(1), longest)
        agreeing = F.size(F.filter(lengths, lambda n: side(ref, n) == side(alt, n)))
        return F.when(longest > 0, agreeing).otherwise(0)

    room = F.least(F.length(ref), F.length(alt)) - 1

    def cut(suffix: Column) -> Column:
        return let(
            F.struct(suffix.alias("suffix"), shared(room - suffix, F.left).alias("prefix")),
            lambda n: F.struct(
                (position + n["prefix"]).alias("position"),
                F.substr(ref, n["prefix"] + 1, F.length(ref) - n["prefix"] - n["suffix"]).alias("ref"),
                F.substr(alt, n["prefix"] + 1, F.length(alt) - n["prefix"] - n["suffix"]).alias("alt"),
            ),
        )

    unchanged = F.struct(position.alias("position"), ref.alias("ref"), alt.alias("alt"))
    symbolic = (alt == "*") | alt.startswith("<")
    return F.when(symbolic | (room < 1), unchanged).otherwise(let(shared(room, F.right), cut))
