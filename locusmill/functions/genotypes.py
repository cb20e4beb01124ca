"""Calls and genotype quality.

A call is ``struct<a0 int, a1 int, phased boolean>``: allele numbers with ``a1`` NULL for a
haploid call, and the whole struct NULL when nothing was called. Flat integers keep every
predicate below inside generated code, which the entry-level stages depend on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from locusmill.functions.basics import let


def call(a0: Column, a1: Column, phased: Column) -> Column:
    return F.struct(
        a0.cast("int").alias("a0"), a1.cast("int").alias("a1"), phased.cast("boolean").alias("phased")
    )


def parse_call(text: Column) -> Column:
    """Read ``0/1``, ``1|0`` or ``1``; anything with a missing allele is no call."""
    parts = F.split(F.translate(text, "|", "/"), "/")
    # a cast that fails costs far more than one of NULL
    first, second = (F.nullif(F.get(parts, F.lit(i)), F.lit(".")).try_cast("int") for i in (0, 1))
    complete = first.isNotNull() & ((F.size(parts) == 1) | (second.isNotNull() & (F.size(parts) == 2)))
    return F.when(complete, call(first, second, F.contains(text, F.lit("|"))))


def format_call(gt: Column) -> Column:
    mark = F.when(gt["phased"], "|").otherwise("/")
    return F.when(gt["a1"].isNull(), gt["a0"].cast("string")).otherwise(
        F.concat(gt["a0"].cast("string"), mark, gt["a1"].cast("string"))
    )


def _when_called(gt: Column, value: Column) -> Column:
    return F.when(gt["a0"].isNotNull(), value)


def is_haploid(gt: Column) -> Column:
    return _when_called(gt, gt["a1"].isNull())


def is_het(gt: Column) -> Column:
    return _when_called(gt, F.coalesce(gt["a0"] != gt["a1"], F.lit(False)))


def is_het_ref(gt: Column) -> Column:
    return _when_called(
        gt, F.coalesce((gt["a0"] != gt["a1"]) & (F.least(gt["a0"], gt["a1"]) == 0), F.lit(False))
    )


def is_non_ref(gt: Column) -> Column:
    return _when_called(gt, (gt["a0"] > 0) | F.coalesce(gt["a1"] > 0, F.lit(False)))


def ploidy(gt: Column) -> Column:
    return _when_called(gt, F.when(gt["a1"].isNull(), 1).otherwise(2))


def allele_count(gt: Column, allele: Column) -> Column:
    """Copies of one allele; NULL when there is no call."""
    return _when_called(
        gt, (gt["a0"] == allele).cast("int") + F.coalesce((gt["a1"] == allele).cast("int"), F.lit(0))
    )


def downcode(gt: Column, allele: Column) -> Column:
    """Keep one allele as 1 and turn all others into 0. Unphased pairs are put in order."""
    a0 = (gt["a0"] == allele).cast("int")
    a1 = (gt["a1"] == allele).cast("int")
    swap = ~gt["phased"] & (a0 > a1)
    return F.when(
        gt["a0"].isNotNull(),
        call(F.when(swap, a1).otherwise(a0), F.when(swap, a0).otherwise(a1), gt["phased"]),
    )


def downcode_depths(ad: Column, allele: Column) -> Column:
    """Depth of everything else, then depth of the kept allele."""
    total = F.aggregate(ad, F.lit(0), lambda acc, x: acc + F.coalesce(x, F.lit(0)))
    kept = F.get(ad, allele)
    return F.when(ad.isNotNull(), F.array(total - kept, kept))


def _genotypes(n_alleles: Column, allele: Column) -> Column:
    """``place, copies`` of every unordered pair of alleles, in the order of likelihoods."""
    return F.flatten(
        F.transform(
            F.sequence(F.lit(0), n_alleles - 1),
            lambda b: F.transform(
                F.sequence(F.lit(0), b),
                lambda a: F.struct(
                    ((b * (b + 1) / 2).cast("int") + a).alias("place"),
                    ((a == allele).cast("int") + (b == allele).cast("int")).alias("copies"),
                ),
            ),
        )
    )


def downcode_likelihoods(pl: Column, n_alleles: Column, allele: Column) -> Column:
    """Likelihoods of 0, 1 and 2 copies of one allele: of each, the least of the genotypes that have so many.

    The genotype called before the split has likelihood 0 and keeps it, so nothing has to be
    rescaled. NULL stays NULL; a missing value of one genotype does not count.
    """

    def least(pairs: Column, copies: int) -> Column:
        own = F.filter(pairs, lambda g: g["copies"] == copies)
        return F.array_min(F.transform(own, lambda g: F.get(pl, g["place"])))

    each = let(_genotypes(n_alleles, allele), lambda pairs: F.array(*[least(pairs, k) for k in range(3)]))
    return F.when(pl.isNotNull(), each)


def quality_from_likelihoods(pl: Column) -> Column:
    """Difference of the two smallest likelihoods; NULL without two."""
    present = F.array_sort(F.filter(pl, lambda x: x.isNotNull()))
    return F.get(present, F.lit(1)) - F.get(present, F.lit(0))


def high_quality(
    gt: Column,
    gq: Column,
    dp: Column,
    ad: Column,
    min_gq: int = 20,
    min_dp: int = 10,
    min_balance: float = 0.2,
    min_haploid_dp: int = 10,
) -> Column:
    """The ``adj`` flag of a bi-allelic genotype; three-valued when something is missing."""

    def balanced(allele: int) -> Column:
        return F.try_divide(F.get(ad, F.lit(allele)), dp) >= min_balance

    deep = _when_called(gt, F.when(gt["a1"].isNull(), dp >= min_haploid_dp).otherwise(dp >= min_dp))
    balance = (
        F.when(gt["a0"].isNull(), F.lit(None).cast("boolean"))
        .when(~is_het(gt), F.lit(True))
        .when(is_het_ref(gt), balanced(1))
        .otherwise(balanced(0) & balanced(1))
    )
    return (gq >= min_gq) & deep & balance
