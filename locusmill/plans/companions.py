"""Companion tables: clinical variants, expression, constraint, de-novo variants, exome subset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.functions import clinical, consequences
from locusmill.functions.identifiers import original_alternates
from locusmill.operators import expression as X
from locusmill.operators.cohort import Cohort, repartition_scaled, split_sites
from locusmill.operators.frequencies import observed_values
from locusmill.operators.lookups import one_per_key, within_intervals
from locusmill.operators.reshape import identifier_fields, transmute, with_constants
from locusmill.operators.summary import sort_by_variant, variant_summary
from locusmill.plans.cohort import annotate_consequences
from locusmill.sinks.documents import unite_collections, write_bulk
from locusmill.sinks.scratch import stored
from locusmill.sources.tables import matrix_columns, matrix_means, parse_intervals, read_saved, read_table
from locusmill.sources.text import read_lines
from locusmill.sources.vcf import read_cohort, read_header, read_sites, release_dates

MATRIX_FIELDS = ["transcript_id", "gene_id"]


def clinical_sites(sites: DataFrame) -> DataFrame:
    """Unsplit sites -> minimal bi-allelic rows that remember their site's alternates."""
    original = original_alternates(F.col("contig"), F.col("position"), F.col("alleles"))
    return sites.withColumn("original_alt_alleles", original).transform(split_sites)


def clinical_rows(variants: DataFrame, *others: str) -> DataFrame:
    """One flat row per clinical variant, and ``others``; needs ALLELEID, CLNSIG and CLNREVSTAT in ``info``."""
    prepared = variants.withColumn("transcripts", consequences.sorted_transcripts(F.col("vep"))).withColumns(
        {
            "main_transcript": consequences.worst_transcript(F.col("transcripts")),
            "gene_ids": consequences.gene_set(F.col("transcripts")),
            "review_status": clinical.status_text(F.col("info.CLNREVSTAT")),
        }
    )
    transcripts = F.col("transcripts")
    worst = consequences.WORST_FIELDS + consequences.WORST_CODING_FIELDS
    return prepared.select(
        F.col("info.ALLELEID").alias("allele_id"),
        "alt",
        "chrom",
        clinical.status_text(F.col("info.CLNSIG")).alias("clinical_significance"),
        consequences.domain_set(F.col("vep.transcript_consequences")).alias("domains"),
        "gene_ids",
        consequences.gene_consequence_json(transcripts, F.col("gene_ids")).alias("gene_id_to_consequence_json"),
        clinical.gold_stars(F.col("review_status")).alias("gold_stars"),
        *[F.expr(f"main_transcript.{f} AS main_transcript_{f}") for f in worst],
        "pos",
        "ref",
        "review_status",
        consequences.term_set(transcripts).alias("transcript_consequence_terms"),
        consequences.transcript_id_set(transcripts).alias("transcript_ids"),
        consequences.transcript_consequence_json(transcripts).alias("transcript_id_to_consequence_json"),
        "variant_id",
        "xpos",
        *others,
    )


def annotated_clinical_rows(sites: DataFrame, vep: DataFrame) -> DataFrame:
    """The flat rows, unsorted, with the locus and alleles that the summary counts by."""
    variants = clinical_sites(sites).transform(identifier_fields)
    annotated = annotate_consequences(variants, vep)
    return clinical_rows(annotated, "contig", "alleles")


def clinical_table(sites: DataFrame, vep: DataFrame, **constants: str | None) -> DataFrame:
    """The clinical variant table in variant-id order, with dataset constants such as its version.

    The rows are written before they are sorted: finding the ranges of a sort reads its input once
    more, which would annotate twice, and the sort moves flat rows without the annotator's output.
    """
    rows = stored(annotated_clinical_rows(sites, vep).drop("contig", "alleles"), "clinical")
    return with_constants(sort_by_variant(rows), **constants)


def clinical_from_text(
    spark: SparkSession, calls: str, annotations: str, path: str, build: str = "38", block_gzip: bool = False, dictionary: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The clinical table from VCF text and annotator lines, written to ``path``; and its summary.

    Sites alone are read, contigs recoded, loci outside of the build left out, and sites split.
    The table names its release (of several files: the latest), build and source. It is annotated
    once; the written rows give both the sorted table and the summary.
    """
    header = read_header(spark, calls, block_gzip)
    release = release_dates(header).agg(F.max("release_date")).first()[0]
    sites = read_sites(read_lines(spark, calls, block_gzip), header, build, skip_invalid_loci=True, dictionary=dictionary)
    rows = stored(annotated_clinical_rows(sites, read_lines(spark, annotations)), "clinical")
    table = with_constants(
        sort_by_variant(rows.drop("contig", "alleles")), version=release, genomeVersion=build, sourceFilePath=calls
    )
    table.write.mode("overwrite").parquet(path)
    return spark.read.schema(table.schema).parquet(path), variant_summary(rows)


def unknown_review_statuses(rows: DataFrame) -> DataFrame:
    """Statuses without stars, with their counts."""
    unknown = rows.where(F.col("gold_stars").isNull() & F.col("review_status").isNotNull())
    return unknown.groupBy("review_status").agg(F.count(F.lit(1)).alias("n"))


def tissue_table(lines: DataFrame, attributes: DataFrame, names: dict[str, str] = X.TISSUE_COLUMNS) -> DataFrame:
    """Mean expression per transcript and tissue, from the lines of a wide matrix.

    ``attributes`` has SAMPID and SMTSD. The header alone is joined to it; the driver gets the
    places of each tissue's columns, and a line's means are made in the line.
    """
    named = attributes.select(F.col("SAMPID").cast("string").alias("col_id"), F.col("SMTSD").alias("tissue"))
    tissues = one_per_key(named, ["col_id"], ["tissue"], ["tissue"]).where("tissue IS NOT NULL")
    placed = matrix_columns(lines, MATRIX_FIELDS).join(tissues, "col_id")
    found = placed.groupBy("tissue").agg(F.array_sort(F.collect_list("place")).alias("places")).collect()
    places = {r.tissue: r.places for r in found}
    columns = X.tissue_columns(list(places), names)
    means = matrix_means(lines, MATRIX_FIELDS, {column: places[tissue] for tissue, column in columns.items()})
    return means.withColumnsRenamed({"transcript_id": "transcriptId", "gene_id": "geneId"})


def tissue_table_long(matrix: DataFrame, attributes: DataFrame, names: dict[str, str] = X.TISSUE_COLUMNS) -> DataFrame:
    """The same from a long matrix (``transcript_id, gene_id, col_id, x``), in one aggregation."""
    named = attributes.select(F.col("SAMPID").alias("col_id"), F.col("SMTSD").alias("tissue"))
    tissues = one_per_key(named, ["col_id"], ["tissue"], ["tissue"])
    used = matrix.select("col_id").distinct().join(tissues, "col_id")
    columns = X.tissue_columns(observed_values(used, "tissue"), names)
    long = matrix.join(tissues, "col_id", "left")
    return X.tissue_means(long, ["transcript_id", "gene_id"], columns).withColumnsRenamed(
        {"transcript_id": "transcriptId", "gene_id": "geneId"}
    )


def expression_medians(spark: SparkSession, path: str) -> DataFrame:
    """The ready-made tissue table, renamed."""
    table = read_table(spark, path, impute=True)
    return table.withColumnsRenamed({"transcript_id": "transcriptId", "gene_id": "geneId"})


def constraint_table(table: DataFrame) -> DataFrame:
    """Gene constraint by transcript; the key column stays beside its copy."""
    return transmute(
        table,
        {"gene_name": F.col("gene"), "transcript_id": F.col("transcript")},
        reads=["gene", "transcript"],
        keys=["transcript"],
    )


def denovo_table(spark: SparkSession, *paths: str) -> DataFrame:
    """De-novo variants of several typed tables in one collection."""
    return unite_collections(*[read_table(spark, path, impute=True) for path in paths])


def exome_subset(cohort: Cohort, intervals: DataFrame) -> Cohort:
    """Sites inside the intervals, with their entries."""
    sites = within_intervals(cohort.sites, intervals)
    entries = cohort.entries.join(sites.select("site_id"), "site_id", "left_semi")
    return Cohort(sites, entries, cohort.samples)


def write_cohort(cohort: Cohort, path: str, partitions: int) -> Cohort:
    """Write a cohort's tables with a tenth of the ``partitions`` that were read; returns them as read back."""
    spark = cohort.sites.sparkSession
    for name in ("sites", "entries", "samples"):
        repartition_scaled(getattr(cohort, name), partitions).write.mode("overwrite").parquet(f"{path}/{name}")
    return Cohort(*[spark.read.schema(getattr(cohort, n).schema).parquet(f"{path}/{n}") for n in ("sites", "entries", "samples")])


def write_exome_subset(cohort: Cohort, intervals: DataFrame, path: str, partitions: int) -> Cohort:
    return write_cohort(exome_subset(cohort, intervals), path, partitions)


def exome_from_text(
    spark: SparkSession, calls: str, intervals: str, path: str, build: str = "38", block_gzip: bool = False,
    dictionary: DataFrame | None = None, drop_matching: str | None = "MONOALLELIC",
) -> Cohort:
    """Sites inside an interval list with their entries, from VCF text to written tables.

    Lines that match ``drop_matching`` go before they are parsed, and lines outside of the
    intervals before any genotype is made a row. A tenth of the partitions of the text are written.
    """
    lines = read_lines(spark, calls, block_gzip, drop_matching)
    kept = parse_intervals(read_lines(spark, intervals))
    cohort = read_cohort(lines, read_header(spark, calls, block_gzip), build, dictionary=dictionary, intervals=kept)
    return write_cohort(cohort, path, lines.rdd.getNumPartitions())


def publish_saved(spark: SparkSession, table: str, path: str, collection: str, **options) -> None:
    """A saved table as bulk documents; appends unless told to replace."""
    write_bulk(read_saved(spark, table), path, collection, **{"block_size": 200, "num_shards": 1, "replace": False, **options})
