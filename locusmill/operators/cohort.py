"""Sites, entries and samples of a cohort, and the operators that reshape them.

A cohort is three DataFrames: ``sites`` with one row per site (``site_id`` and row fields),
``entries`` with one row per site and sample, and ``samples``. Entries are long so that a site
or a sample with a very large share of the data is spread over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusmill.functions import alleles as A
from locusmill.functions import genotypes as G
from locusmill.functions.basics import explode_computed


@dataclass(frozen=True)
class Cohort:
    sites: DataFrame
    entries: DataFrame
    samples: DataFrame
    #: Of few samples, the sites with columns ``GT_i, AD_i, DP_i, GQ_i`` for each, where the source has them so,
    #: and the samples in that order.
    wide: DataFrame | None = None
    wide_samples: list[str] = field(default_factory=list)


def add_site_allele_data(sites: DataFrame) -> DataFrame:
    """Allele summary of the unsplit site."""
    return sites.withColumn("allele_data", A.site_allele_data(F.col("alleles")))


def _kept_alternates(alleles: Column) -> Column:
    """Allele numbers that a split keeps; NULL in the place of a ``*``, which explode skips."""
    return F.transform(A.alternates(alleles), lambda a, i: F.when(a != "*", i + 1))


def split_sites(sites: DataFrame) -> DataFrame:
    """One row per alternate, in minimal representation. Other row fields stay as they are."""
    exploded = explode_computed(
        sites.withColumn("was_split", F.size("alleles") > 2), _kept_alternates(F.col("alleles")), "a_index"
    )
    variant = A.minimal(F.col("position"), F.get("alleles", F.lit(0)), F.get("alleles", F.col("a_index")))
    trimmed = exploded.withColumn("_variant", variant)
    return trimmed.withColumns(
        {
            "position": F.col("_variant.position"),
            "alleles": F.array("_variant.ref", "_variant.alt"),
            "ref": F.col("_variant.ref"),
            "alt": F.col("_variant.alt"),
        }
    ).drop("_variant")


def split_entries(entries: DataFrame, likelihoods: bool = False) -> DataFrame:
    """Entries of the split rows, keyed by ``site_id`` and ``a_index``; row-local.

    Needs the site's ``alleles`` beside each entry. Sites do not have to be joined: the minimal
    representation is site work. By default PL is dropped before the split, so GQ stays as it is;
    with ``likelihoods`` PL is down-coded and GQ follows from it, where there is PL.
    """
    exploded = explode_computed(entries, _kept_alternates(F.col("alleles")), "a_index")
    split = exploded.withColumns(
        {
            "GT": G.downcode(F.col("GT"), F.col("a_index")),
            "AD": G.downcode_depths(F.col("AD"), F.col("a_index")),
        }
    )
    if not likelihoods:
        return split.drop("alleles", "PL")
    split = split.withColumn("PL", G.downcode_likelihoods(F.col("PL"), F.size("alleles"), F.col("a_index")))
    return split.withColumn("GQ", F.coalesce(G.quality_from_likelihoods(F.col("PL")), "GQ")).drop("alleles")


def split_wide(split: DataFrame, n: int) -> DataFrame:
    """The columns of ``n`` samples beside split rows, as :func:`split_entries` splits entries, with their quality flags."""
    allele = F.col("a_index")
    downcoded = {f"GT_{i}": G.downcode(F.col(f"GT_{i}"), allele) for i in range(n)}
    downcoded |= {f"AD_{i}": G.downcode_depths(F.col(f"AD_{i}"), allele) for i in range(n)}
    flags = {f"adj_{i}": G.high_quality(*[F.col(f"{f}_{i}") for f in ("GT", "GQ", "DP", "AD")]) for i in range(n)}
    return split.withColumns(downcoded).withColumns(flags)


def add_allele_type(split: DataFrame) -> DataFrame:
    """Allele type of a split row, and whether its site mixed types."""
    allele_data = (
        F.col("allele_data")
        .withField("allele_type", A.allele_type(F.col("ref"), F.col("alt")))
        .withField("was_mixed", F.col("allele_data.variant_type") == "mixed")
    )
    return split.withColumn("allele_data", allele_data)


def split_alleles(cohort: Cohort) -> Cohort:
    """Allele typing, split and down-coding of a whole cohort."""
    sites = cohort.sites.transform(add_site_allele_data).transform(split_sites).transform(add_allele_type)
    return replace(cohort, sites=sites, entries=split_entries(cohort.entries), wide=None)


def drop_likelihoods(entries: DataFrame) -> DataFrame:
    """Null the likelihoods with their type kept, so that a split leaves GQ alone."""
    return entries.withColumn("PL", F.lit(None).cast("array<int>"))


def add_high_quality(entries: DataFrame, **thresholds) -> DataFrame:
    """The ``adj`` entry flag."""
    flag = G.high_quality(F.col("GT"), F.col("GQ"), F.col("DP"), F.col("AD"), **thresholds)
    return entries.withColumn("adj", flag)


def missing_samples(requested: DataFrame, samples: DataFrame) -> DataFrame:
    """Requested ids that the call set does not have, one per row."""
    return requested.select("s").join(samples.select("s"), "s", "left_anti")


def subset_report(requested: DataFrame, samples: DataFrame) -> DataFrame:
    """One row: requested, matched and missing counts. The ids are :func:`missing_samples`."""
    known = samples.select("s").distinct().withColumn("known", F.lit(True))
    return (
        requested.select("s")
        .join(known, "s", "left")
        .agg(
            F.count(F.lit(1)).alias("n_requested"),
            F.count("known").alias("n_matched"),
            (F.count(F.lit(1)) - F.count("known")).alias("n_missing"),
        )
    )


def keep_variant_sites(sites: DataFrame, entries: DataFrame, keys: list[str]) -> DataFrame:
    """Sites with any non-reference call. The distinct keys are combined map-side first."""
    carried = entries.where(G.is_non_ref(F.col("GT"))).select(*keys).distinct()
    return sites.join(carried, keys, "left_semi")


def subset_cohort(cohort: Cohort, requested: DataFrame) -> Cohort:
    """Requested samples, and the sites where one of them carries an alternate, with their entries."""
    wanted = requested.select("s").distinct()
    entries = cohort.entries.join(wanted, "s", "left_semi")
    return Cohort(
        sites=keep_variant_sites(cohort.sites, entries, ["site_id"]),
        entries=keep_variant_sites(entries, entries, ["site_id"]),
        samples=cohort.samples.join(wanted, "s", "left_semi"),
    )


def add_sample_fields(frame: DataFrame, samples: DataFrame, fields: list[str]) -> DataFrame:
    """Left lookup of sample fields by id.

    Spark broadcasts the samples when they are below its threshold or were measured as bounded
    before. Otherwise this is a sort-merge join whose large keys adaptive execution splits: the
    aggregations that follow group by site, so no later step relies on the join's partitioning.
    """
    return frame.join(samples.select("s", *fields), "s", "left")


def repartition_scaled(frame: DataFrame, partitions: int, divisor: int = 10) -> DataFrame:
    """Fewer, larger partitions before a write, and never none."""
    return frame.repartition(max(1, partitions // divisor))
