"""The cohort variant table: one wide, nested, search-ready row per bi-allelic variant."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.operators import cohort as C
from locusmill.operators import frequencies as FQ
from locusmill.operators import histograms as H
from locusmill.operators import statistics as S
from locusmill.operators.lookups import (
    VARIANT_KEYS,
    broadcast_if_bounded,
    one_per_key,
    predictor_struct,
    variant_lookup,
)
from locusmill.operators.reshape import search_row
from locusmill.sinks.scratch import stored
from locusmill.sources.tables import parsed_vep, read_table, vep_lines_by_variant
from locusmill.sources.text import read_lines
from locusmill.sources.vcf import read_cohort, read_header
from locusmill.vocabulary import POPULATIONS

KEYS = ["site_id", "a_index"]
PREDICTORS = ["splice_ai", "primate_ai", "cadd", "revel"]
# Where a combined reference table holds the scores.
PREDICTOR_SOURCES = {
    "splice_ai": "splice_ai.delta_score",
    "primate_ai": "primate_ai.score",
    "cadd": "cadd.PHRED",
    "revel": "dbnsfp.REVEL_score",
}


def sample_sheet(meta: DataFrame) -> DataFrame:
    """``s, pop, proband, sex`` from a sheet with ID, Ethnicity, Sex and Proband."""
    return meta.select(
        F.col("ID").alias("s"),
        F.col("Ethnicity").alias("pop"),
        F.col("Proband").alias("proband"),
        F.col("Sex").alias("sex"),
    )


def annotate_samples(samples: DataFrame, sheet: DataFrame) -> DataFrame:
    """Sample fields by left lookup; a sample that the sheet lacks gets NULLs."""
    fields = ["pop", "proband", "sex"]
    return samples.select("s").join(one_per_key(sheet, ["s"], fields, fields), "s", "left")


def prepare_entries(cohort: C.Cohort) -> DataFrame:
    """Split entries with their quality flag and sample groups."""
    flagged = C.add_high_quality(C.split_entries(cohort.entries))
    slim = flagged.select(*KEYS, "s", "GT", "AD", "DP", "GQ", "adj")
    return C.add_sample_fields(slim, cohort.samples, ["pop", "proband", "sex"]).drop("s")


def mark_entries(cohort: C.Cohort, pops: list[str]) -> DataFrame:
    """The mark of each split entry (see :mod:`locusmill.operators.statistics`), by variant.

    An entry is a few numbers when its sample's cell joins it: where samples are too many to be
    sent to all tasks, that join shuffles the entries.
    """
    flagged = C.add_high_quality(C.split_entries(cohort.entries))
    marks = flagged.select(*KEYS, "s", S.entry_mark(F.col("GT"), F.col("adj"), H.entry_measures()).alias("mark"))
    cells = cohort.samples.select("s", S.cell_number(pops).alias("cell"))
    return C.add_sample_fields(marks, cells, ["cell"]).select(*KEYS, S.in_cell(F.col("mark"), F.col("cell"), pops).alias("mark"))


def _split(sites: DataFrame) -> DataFrame:
    return sites.transform(C.add_site_allele_data).transform(C.split_sites).transform(C.add_allele_type)


def gather_variants(cohort: C.Cohort, marked: DataFrame, pops: list[str]) -> DataFrame:
    """Split sites with ``_marks``, the list of their entries' marks; NULL for sites without entries.

    The entries end partitioned by variant, so the join back to the sites moves only the sites.
    """
    few = cohort.samples.limit(S.FEW_SAMPLES + 1).count() <= S.FEW_SAMPLES
    return _split(cohort.sites).join(S.gathered_marks(marked, KEYS, pops, few), KEYS, "left")


def gather_wide(cohort: C.Cohort, pops: list[str]) -> DataFrame:
    """The same from sites that have their few entries beside them: all in the row, no shuffle."""
    cells = {r.s: r.cell for r in cohort.samples.select("s", S.cell_number(pops).alias("cell")).collect()}
    split = C.split_wide(_split(cohort.wide), len(cohort.wide_samples))
    return S.wide_marks(split, cohort.wide_samples, cells, pops)


def count_variants(gathered: DataFrame, pops: list[str], n_marks: int | None = None) -> DataFrame:
    """Flat frequency fields in ``info`` and the histogram bundle, in place of ``_marks``.

    Sites without entries have zero counts. The row grows to some kilobytes here, so nothing should
    shuffle or sort it afterwards. ``n_marks`` is the number of samples where they are few.
    """
    flat = S.statistic_names(pops)
    counted = S.with_statistics(gathered, pops, n_marks)
    return counted.withColumn("info", _with_fields("info", counted, flat)).drop(*flat)


def _with_fields(struct: str, frame: DataFrame, added: list[str]) -> Column:
    old = [n for n in frame.schema[struct].dataType.names if n not in added]
    return F.struct(*[F.col(f"{struct}.`{n}`").alias(n) for n in old], *added)


def predictor_columns(reference: DataFrame, sources: dict[str, str] = PREDICTOR_SOURCES) -> DataFrame:
    """Locus, alleles and one column per predictor, from the fields of a combined reference table."""
    return reference.select(*VARIANT_KEYS, *[F.col(path).alias(name) for name, path in sources.items()])


def annotate_reference(variants: DataFrame, rsids: DataFrame, predictors: DataFrame) -> DataFrame:
    """rsid and predictor scores by locus and alleles."""
    known = variant_lookup(variants.drop("rsid"), rsids, ["rsid"])
    scored = variant_lookup(known, predictors, PREDICTORS)
    return scored.withColumn("in_silico_predictors", predictor_struct(*PREDICTORS)).drop(*PREDICTORS)


def annotate_consequences(variants: DataFrame, vep: DataFrame) -> DataFrame:
    """The annotator's output for each variant; a repeated variant is taken once.

    ``vep`` is parsed output (with a column ``vep``), or the annotator's lines (``value``). Lines
    are keyed and joined first, so that only those of variants that are there are parsed. A line
    is far longer than Spark's estimate for a string, so the join is a merge whatever that says.
    """
    if "vep" in vep.columns:
        return variant_lookup(variants, vep, ["vep"])
    lines = vep_lines_by_variant(vep, variants.schema["position"].dataType.simpleString())
    return parsed_vep(variants.join(lines.hint("merge"), VARIANT_KEYS, "left"))


def export_projection(variants: DataFrame) -> DataFrame:
    """Fields of the exported row, with the histograms regrouped."""
    return variants.select(
        *VARIANT_KEYS,
        "alleles",
        "info",
        "filters",
        "rsid",
        "qual",
        "vep",
        "in_silico_predictors",
        *H.regrouped(),
    )


def cohort_variants(
    cohort: C.Cohort,
    sheet: DataFrame,
    rsids: DataFrame,
    predictors: DataFrame,
    vep: DataFrame,
    requested: DataFrame | None = None,
    pops: list[str] | None = None,
    store: str | None = None,
) -> DataFrame:
    """The whole product. ``sheet`` is ``s, pop, proband, sex``; ``requested`` lists samples to keep.

    ``pops`` names the population columns; by default those of the fixed list that the samples
    have. With ``store`` the marks of the entries are written once to a new folder there and read back,
    so that a lost executor does not parse text input again. Variants carry these marks through the
    lookups; their counts and histograms are made in the end.
    """
    if requested is not None:
        cohort = C.subset_cohort(cohort, requested)
    samples = annotate_samples(cohort.samples, sheet)
    if pops is None:
        observed = FQ.observed_values(samples.where(F.col("pop").isin(POPULATIONS)))
        pops = [pop for pop in POPULATIONS if pop in observed]
    if cohort.wide is not None:
        gathered = gather_wide(replace(cohort, samples=samples), pops)
        gathered = gathered if store is None else stored(gathered, "entries", store)
    else:
        marked = mark_entries(replace(cohort, samples=broadcast_if_bounded(samples)), pops)
        marked = marked if store is None else stored(marked, "entries", store)
        gathered = gather_variants(cohort, marked, pops)
    annotated = gathered.transform(annotate_reference, rsids, predictors).transform(annotate_consequences, vep)
    n_marks = None if cohort.wide is None else len(cohort.wide_samples)
    return annotated.transform(count_variants, pops, n_marks).transform(export_projection).transform(search_row)


def cohort_from_text(
    spark: SparkSession,
    calls: str,
    sheet: str,
    rsids: DataFrame,
    reference: DataFrame,
    annotations: str,
    requested: str | None = None,
    build: str = "38",
    block_gzip: bool = True,
    dictionary: DataFrame | None = None,
    drop_matching: str | None = None,
    skip_invalid_loci: bool = False,
    sources: dict[str, str] = PREDICTOR_SOURCES,
    store: str | None = None,
) -> DataFrame:
    """The whole product from files: VCF text, a sample sheet, annotator lines and a list of samples.

    ``requested`` names a table with a column ``s``. Lines in which none of its samples carries an
    alternate go before any genotype is made a row, and of the others only its samples are read.
    ``rsids`` and ``reference`` are tables by locus and alleles; ``sources`` says which fields of
    the reference are the predictors.
    """
    wanted = None if requested is None else read_table(spark, requested).select("s")
    cohort = read_cohort(
        read_lines(spark, calls, block_gzip, drop_matching), read_header(spark, calls, block_gzip), build,
        skip_invalid_loci=skip_invalid_loci, dictionary=dictionary, requested=wanted, wide_up_to=S.WIDE_SAMPLES,
    )
    people = sample_sheet(read_table(spark, sheet))
    notes = read_lines(spark, annotations)
    return cohort_variants(cohort, people, rsids, predictor_columns(reference, sources), notes, store=store)
