"""The registered queries: each runs one or a few operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill import views as V
from locusmill.functions import alleles as A
from locusmill.functions import clinical, consequences, identifiers, lof, names
from locusmill.functions import genotypes as G
from locusmill.functions.basics import explode_computed
from locusmill.operators import cohort as C
from locusmill.operators import expression as X
from locusmill.operators import frequencies as FQ
from locusmill.operators import histograms as H
from locusmill.operators import lookups as L
from locusmill.operators import reshape as R
from locusmill.operators import summary
from locusmill.plans import cohort as cohort_plan
from locusmill.plans import companions
from locusmill.sinks import documents as D
from locusmill.sinks.scratch import fresh_folder
from locusmill.sources import tables, text, vcf
from locusmill.vocabulary import (
    CONSTRAINT_FIELDS,
    FILTERING_AF_FIELDS,
    FILTERING_AF_POPULATIONS,
    FREQUENCY_FIELDS,
    POPMAX_FIELDS,
    POPULATIONS,
    RELEASE_HISTOGRAMS,
    RELEASE_SUBPOPULATIONS,
    SITE_QUALITY_FIELDS,
)

KEYS = cohort_plan.KEYS
QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _joined(values: Column) -> Column:
    return F.array_join(values, ",")


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    return cohort_plan.prepare_entries(V.cohort(spark, sf))


# --- alleles and genotypes


@query
def split_multiallelic(spark, sf):
    cohort = C.split_alleles(V.cohort(spark, sf))
    return cohort.entries.select(
        *KEYS,
        "s",
        G.format_call(F.col("GT")).alias("gt"),
        F.get("AD", F.lit(0)).alias("ad_other"),
        F.get("AD", F.lit(1)).alias("ad_alt"),
        F.col("DP").alias("dp"),
        F.col("GQ").alias("gq"),
    )


@query
def split_variants(spark, sf):
    return C.split_sites(V.sites(spark, sf)).select(*KEYS, "was_split", "contig", "position", "ref", "alt", "qual")


@query
def allele_typing(spark, sf):
    sites = C.split_alleles(V.cohort(spark, sf)).sites
    data = F.col("allele_data")
    return sites.select(
        *KEYS,
        _joined(data["nonsplit_alleles"]).alias("nonsplit_alleles"),
        *[data[f].alias(f) for f in ("has_star", "variant_type", "n_alt_alleles", "allele_type", "was_mixed")],
    )


def _padded(spark, sf):
    size, key = F.col("p_size"), F.col("p_partkey")
    alleles = V.alleles_of(size)
    before = F.substr(F.lit("GATTACA"), F.lit(1), size % 7)
    after = F.substr(F.lit("CCGTA"), F.lit(1), (key % 5).cast("int"))
    padded = lambda a: F.concat(before, a, after)
    return V.table(spark, sf, "part").select(
        key.alias("site_id"),
        V.position_of(key).alias("position"),
        padded(F.get(alleles, F.lit(0))).alias("ref"),
        F.when(size % 13 == 0, "*").when(size % 17 == 0, "<DEL>").otherwise(
            padded(F.get(alleles, F.size(alleles) - 1))
        ).alias("alt"),
    )


@query
def min_rep(spark, sf):
    trimmed = A.minimal(F.col("position"), F.col("ref"), F.col("alt"))
    return _padded(spark, sf).select("site_id", F.col("ref").alias("old_ref"), trimmed.alias("m")).select(
        "site_id", "old_ref", "m.position", "m.ref", "m.alt"
    )


@query
def allele_predicates(spark, sf):
    ref, alt = F.col("ref"), F.col("alt")
    return _padded(spark, sf).select(
        "site_id",
        A.is_snv(ref, alt).alias("snv"),
        A.is_insertion(ref, alt).alias("insertion"),
        A.is_deletion(ref, alt).alias("deletion"),
        A.is_indel(ref, alt).alias("indel"),
        A.allele_type(ref, alt).alias("allele_type"),
    )


@query
def adj_genotypes(spark, sf):
    gt = F.col("GT")
    return C.add_high_quality(C.split_entries(V.entries(spark, sf))).select(
        *KEYS,
        "s",
        "adj",
        G.is_haploid(gt).alias("haploid"),
        G.is_het(gt).alias("het"),
        G.is_het_ref(gt).alias("het_ref"),
        G.is_non_ref(gt).alias("non_ref"),
    )


@query
def genotype_predicates(spark, sf):
    """Predicates on calls that still have several alternates, and nulled likelihoods."""
    gt = F.col("GT")
    return C.drop_likelihoods(V.entries(spark, sf)).select(
        "site_id",
        "s",
        G.format_call(gt).alias("gt"),
        G.is_het(gt).alias("het"),
        G.is_het_ref(gt).alias("het_ref"),
        G.is_non_ref(gt).alias("non_ref"),
        G.ploidy(gt).alias("ploidy"),
        F.col("PL").isNull().alias("no_likelihoods"),
    )


@query
def likelihood_split(spark, sf):
    """Likelihoods of genotypes with several alternates, down-coded to each, and the quality from them."""
    n = F.size("alleles")
    places = F.sequence(F.lit(0), (n * (n + 1) / 2).cast("int") - 1)
    value = lambda j: F.when((F.col("GQ") + j) % 17 > 0, (j * (F.col("GQ") % 9 + 1) + F.col("DP") * (j + 1)) % 60)
    likelihoods = F.when(F.col("GQ") % 13 > 0, F.transform(places, value)).cast("array<int>")
    split = C.split_entries(V.entries(spark, sf).withColumn("PL", likelihoods), likelihoods=True)
    pl = lambda k: F.get("PL", F.lit(k)).alias(f"pl{k}")
    return split.select(*KEYS, "s", pl(0), pl(1), pl(2), F.col("GQ").alias("gq"))


# --- frequencies


@query
def call_stats_raw(spark, sf):
    stats = FQ.call_stats(C.split_entries(V.entries(spark, sf)), KEYS)
    return stats.withColumnsRenamed({"AC": "ac", "AN": "an", "AF": "af", "nhomalt": "nhom"})


@query
def call_stats_by_group(spark, sf):
    groups = FQ.group_table(V.samples(spark, sf))
    return FQ.frequencies_by_group(_entries(spark, sf), KEYS, groups).select(
        *KEYS, "idx", "tag", F.col("AC").alias("ac"), F.col("AN").alias("an"), F.col("AF").alias("af"),
        F.col("nhomalt").alias("nhom"),
    )


def _counted(spark, sf):
    sites = C.split_sites(V.sites(spark, sf)).select(*KEYS, "contig", "position", "ref", "alt")
    return FQ.with_frequencies(sites, FQ.frequencies_wide(_entries(spark, sf), KEYS), KEYS)


@query
def freq_wide(spark, sf):
    return _counted(spark, sf)


@query
def freq_pop_structs(spark, sf):
    counted = _counted(spark, sf)
    shaped = counted.selectExpr(*KEYS, *FQ.total_fields(), *FQ.population_structs(counted.columns))
    return shaped.select(
        *KEYS,
        *[f"{stat}{suffix}" for suffix in ("", "_raw", "_proband", "_male", "_female") for stat in FQ.STATS],
        *[F.expr(f"{stat}_adj.{pop} AS {stat}_adj_{pop}") for stat in FQ.STATS for pop in POPULATIONS],
    )


@query
def group_counter(spark, sf):
    return FQ.group_counter(V.samples(spark, sf))


@query
def freq_meta(spark, sf):
    """The group that each place of the frequency array stands for, beside its sample count."""
    samples = V.samples(spark, sf)
    return FQ.group_sizes(samples, FQ.group_table(samples)).drop("tag")


@query
def freq_label_index(spark, sf):
    """Labels with their place in the frequency array, with the adj AC of all variants there."""
    groups = FQ.group_table(V.samples(spark, sf))
    totals = FQ.frequencies_by_group(_entries(spark, sf), KEYS, groups).groupBy("idx", "tag").agg(F.sum("AC").alias("total_ac"))
    labels = FQ.group_labels(spark)
    return totals.join(labels, "tag").select("label", "idx", "total_ac")


# --- histograms


@query
def qual_histograms(spark, sf):
    return H.histograms_long(_entries(spark, sf), KEYS)


@query
def qual_hist_structs(spark, sf):
    hists = H.quality_histograms(_entries(spark, sf), KEYS)
    grouped = hists.select(*KEYS, *H.regrouped())
    named = [
        F.struct(F.lit(f"{group}.{part}").alias("hist"), F.col(f"{group}.{part}").alias("h"))
        for group, parts in (
            ("allele_balance", ("alt_raw", "alt_adj")),
            ("genotype_depth", ("all_raw", "alt_raw", "all_adj", "alt_adj")),
            ("genotype_quality", ("all_raw", "alt_raw", "all_adj", "alt_adj")),
        )
        for part in parts
    ]
    return explode_computed(grouped, F.array(*named), "n").select(
        *KEYS,
        "n.hist",
        _joined(F.col("n.h.bin_freq").cast("array<string>")).alias("bin_freq"),
        F.get("n.h.bin_edges", F.lit(3)).alias("fourth_edge"),
        "n.h.n_smaller",
        "n.h.n_larger",
    )


@query
def depth_histograms(spark, sf):
    """The bundle without calls and without the quality flag: only the ``_all`` histograms."""
    return H.histograms_long(V.entries(spark, sf), ["site_id"], with_calls=False, with_adj=False, measures=("gq", "dp"))


# --- samples


@query
def sample_subset(spark, sf):
    subset = C.subset_cohort(V.cohort(spark, sf), V.requested_samples(spark, sf))
    return subset.entries.join(subset.sites.select("site_id", "contig", "position"), "site_id").select(
        "site_id", "contig", "position", "s", G.format_call(F.col("GT")).alias("gt")
    )


@query
def missing_samples(spark, sf):
    return C.missing_samples(V.requested_samples(spark, sf), V.samples(spark, sf))


@query
def subset_report(spark, sf):
    return C.subset_report(V.requested_samples(spark, sf), V.samples(spark, sf))


@query
def carried_sites(spark, sf):
    return C.keep_variant_sites(V.sites(spark, sf), V.entries(spark, sf), ["site_id"]).select(
        "site_id", "contig", "position"
    )


@query
def sample_annotation(spark, sf):
    """Samples with their sheet's fields; one sample in eleven is not on the sheet."""
    samples = V.samples(spark, sf)
    sheet = cohort_plan.sample_sheet(
        samples.where("s % 11 <> 0").select(
            F.col("s").alias("ID"), F.col("pop").alias("Ethnicity"), F.col("sex").alias("Sex"),
            F.col("proband").alias("Proband"),
        )
    )
    return cohort_plan.annotate_samples(samples, sheet)


# --- identifiers


@query
def variant_ids(spark, sf):
    variants = C.split_sites(V.sites(spark, sf))
    contig, position, ref, alt = (F.col(c) for c in ("contig", "position", "ref", "alt"))
    return variants.select(
        *KEYS,
        "ref",
        "alt",
        position.alias("pos"),
        identifiers.chromosome(contig).alias("chrom"),
        identifiers.contig_number(contig).alias("contig_number"),
        identifiers.xpos(contig, position).alias("xpos"),
        identifiers.variant_id(contig, position, ref, alt).alias("variant_id"),
        identifiers.variant_id(contig, position, ref, alt, 6).alias("short_id"),
        identifiers.variant_letter(ref, alt).alias("variant_letter"),
        identifiers.end_position(position, ref).alias("end_pos"),
    )


@query
def site_variant_ids(spark, sf):
    contig, position, alleles = F.col("contig"), F.col("position"), F.col("alleles")
    return V.sites(spark, sf).select(
        "site_id",
        _joined(identifiers.site_variant_ids(contig, position, alleles)).alias("ids"),
        _joined(identifiers.site_variant_ids(contig, position, alleles, 8)).alias("short_ids"),
        _joined(identifiers.original_alternates(contig, position, alleles)).alias("original_alt_alleles"),
    )


@query
def key_by_minimal(spark, sf):
    """Original alternates kept beside minimal keys, as in the clinical import."""
    return companions.clinical_sites(V.sites(spark, sf)).select(
        *KEYS, "position", "ref", "alt", _joined(F.col("original_alt_alleles")).alias("original_alt_alleles")
    )


# --- reference lookups and intervals


@query
def annotate_reference(spark, sf):
    variants = C.split_sites(V.sites(spark, sf)).select(*KEYS, *L.VARIANT_KEYS, "rsid")
    reference = V.reference_rows(spark, sf)
    annotated = cohort_plan.annotate_reference(
        variants,
        reference.select(*L.VARIANT_KEYS, "rsid"),
        reference.select(*L.VARIANT_KEYS, *cohort_plan.PREDICTORS),
    )
    return annotated.select(
        *KEYS, *L.VARIANT_KEYS, "rsid", *[F.col(f"in_silico_predictors.{p}").alias(p) for p in cohort_plan.PREDICTORS]
    )


@query
def exome_filter(spark, sf):
    text = V.intervals(spark, sf).select(
        F.concat_ws("\t", "contig", "start", "end", F.lit("+"), F.lit("target")).alias("value")
    )
    header = V.table(spark, sf, "region").select(F.concat(F.lit("@HD\tSO:"), "r_name").alias("value"))
    intervals = tables.parse_intervals(header.union(text))
    return L.within_intervals(V.sites(spark, sf), intervals).select("site_id", "contig", "position")


@query
def exome_entries(spark, sf):
    subset = companions.exome_subset(V.cohort(spark, sf), V.intervals(spark, sf))
    return subset.entries.select("site_id", "s", G.format_call(F.col("GT")).alias("gt"))


@query
def exome_from_text(spark, sf):
    """VCF text and an interval list to written tables: only what lies inside."""
    calls = V.written_text(V.vcf_lines(spark, sf), "exome-calls")
    targets = V.intervals(spark, sf).select(F.concat_ws("\t", "contig", "start", "end", F.lit("+"), F.lit("target")).alias("value"))
    header = V.table(spark, sf, "region").select(F.concat(F.lit("@HD\tSO:"), "r_name").alias("value"))
    listed = V.written_text(header.union(targets), "exome-intervals")
    subset = companions.exome_from_text(spark, calls, listed, fresh_folder(spark, "exome"))
    return subset.entries.join(subset.sites.select("site_id", "contig", "position"), "site_id").select(
        "contig", "position", "s", G.format_call(F.col("GT")).alias("gt")
    )


@query
def locus_range_filter(spark, sf):
    return V.sites(spark, sf).where(L.in_range("chr2:1K-6,010")).select("site_id", "contig", "position")


# --- transcripts


def _transcripts(spark, sf, **options):
    variants = V.annotated_variants(spark, sf)
    return variants.withColumn("transcripts", consequences.sorted_transcripts(F.col("vep"), **options))


@query
def sorted_transcripts(spark, sf):
    exploded = explode_computed(_transcripts(spark, sf), F.col("transcripts"), "t")
    scalars = [f for f in consequences.BASE_FIELDS + consequences.CODING_FIELDS]
    return exploded.select(
        "o_orderkey",
        "seed",
        *[F.col(f"t.{f}").alias(f) for f in scalars],
        _joined(F.col("t.consequence_terms")).alias("consequence_terms"),
        _joined(F.col("t.domains")).alias("domains"),
        *[F.col(f"t.{f}").alias(f) for f in
          ("major_consequence", "category", "hgvs", "major_consequence_rank", "transcript_rank")],
    )


@query
def sorted_transcripts_basic(spark, sf):
    """Without coding annotations, and with no term omitted."""
    transcripts = _transcripts(spark, sf, coding_annotations=False, omit=None)
    exploded = explode_computed(transcripts, F.col("transcripts"), "t")
    fields = [f for f in consequences.BASE_FIELDS if f != "hgvsp"]
    return exploded.select(
        "o_orderkey", "seed", *[F.col(f"t.{f}").alias(f) for f in fields],
        _joined(F.col("t.consequence_terms")).alias("consequence_terms"),
        F.col("t.major_consequence").alias("major_consequence"),
        F.col("t.transcript_rank").alias("transcript_rank"),
    )


@query
def worst_consequence(spark, sf):
    worst = _transcripts(spark, sf).select(
        "o_orderkey", "seed", consequences.worst_transcript(F.col("transcripts")).alias("w")
    )
    fields = consequences.WORST_FIELDS + consequences.WORST_CODING_FIELDS
    return worst.select("o_orderkey", "seed", *[F.col(f"w.{f}").alias(f"main_transcript_{f}") for f in fields])


@query
def consequence_sets(spark, sf):
    transcripts = F.col("transcripts")
    return _transcripts(spark, sf).select(
        "o_orderkey",
        "seed",
        _joined(consequences.term_set(transcripts)).alias("terms"),
        _joined(consequences.gene_set(transcripts)).alias("genes"),
        _joined(consequences.gene_set(transcripts, only_coding=True)).alias("coding_genes"),
        _joined(consequences.domain_set(F.col("vep.transcript_consequences"))).alias("domains"),
        _joined(consequences.sorted_domain_set(transcripts)).alias("sorted_domains"),
        _joined(consequences.transcript_id_set(transcripts)).alias("transcript_ids"),
    )


@query
def consequence_json(spark, sf):
    frame = _transcripts(spark, sf).withColumn("genes", consequences.gene_set(F.col("transcripts")))
    return frame.select(
        "o_orderkey",
        "seed",
        consequences.gene_consequence_json(F.col("transcripts"), F.col("genes")).alias("gene_json"),
        consequences.transcript_consequence_json(F.col("transcripts")).alias("transcript_json"),
    )


def _flagged(spark, sf):
    return R.transcript_fields(V.annotated_variants(spark, sf))


@query
def lof_flags_variant(spark, sf):
    return _flagged(spark, sf).select("o_orderkey", "seed", "flags.lc_lof", "flags.lof_flag")


@query
def lof_flags_gene(spark, sf):
    transcripts = F.col("transcripts")
    return _transcripts(spark, sf).select(
        "o_orderkey",
        "seed",
        _joined(lof.genes_low_confidence(transcripts)).alias("lc_lof_genes"),
        _joined(lof.genes_flagged(transcripts)).alias("flagged_genes"),
    )


@query
def lof_flags_transcript(spark, sf):
    exploded = explode_computed(_flagged(spark, sf), F.col("sortedTranscriptConsequences"), "t")
    return exploded.select("o_orderkey", "seed", "t.transcript_id", "t.flags.*")


@query
def vep_json_ingest(spark, sf):
    """Annotator JSON parsed, keyed by variant and joined to the split sites."""
    variants = C.split_sites(V.sites(spark, sf)).select(*KEYS, *L.VARIANT_KEYS)
    vep = V.annotator_output(spark, sf)
    return cohort_plan.annotate_consequences(variants, vep).select(
        *KEYS,
        F.col("vep.most_severe_consequence").alias("most_severe"),
        F.size("vep.transcript_consequences").alias("n_transcripts"),
        _joined(F.transform("vep.transcript_consequences", lambda t: t["transcript_id"])).alias("transcript_ids"),
    )


@query
def vep_alleles(spark, sf):
    """Annotator output for sites with several alternates, dealt to the split variants."""
    variants = C.split_sites(V.sites(spark, sf)).select(*KEYS, *L.VARIANT_KEYS)
    return cohort_plan.annotate_consequences(variants, V.annotator_site_output(spark, sf)).select(
        *KEYS,
        F.col("vep.most_severe_consequence").alias("most_severe"),
        F.size("vep.transcript_consequences").alias("n_transcripts"),
        _joined(F.transform("vep.transcript_consequences", lambda t: t["transcript_id"])).alias("transcript_ids"),
    )


# --- expression


@query
def tissue_means(spark, sf):
    table = companions.tissue_table_long(V.expression(spark, sf), V.tissue_attributes(spark, sf))
    return table.select(
        "transcriptId", "geneId",
        *[F.round(c, 7).alias(c) for c in table.columns if c not in ("transcriptId", "geneId")],
    )


@query
def tissue_stats(spark, sf):
    tissues = V.tissue_attributes(spark, sf).select(F.col("SAMPID").alias("col_id"), F.col("SMTSD").alias("tissue"))
    long = V.expression(spark, sf).join(tissues.where("tissue is not null"), "col_id")
    stats = X.tissue_stats(long, ["transcript_id"])
    return stats.select(
        "transcript_id", "tissue", F.round("mean", 7).alias("mean"), F.round("stdev", 4).alias("stdev"),
        "min", "max", "n", F.round("sum", 2).alias("total"),
    )


@query
def matrix_long(spark, sf):
    """A wide text matrix in long form."""
    path = V.written_text(V.matrix_lines(spark, sf), "matrix")
    matrix = tables.read_matrix(text.read_lines(spark, path), companions.MATRIX_FIELDS)
    return matrix.select("transcript_id", "gene_id", "col_id", F.col("x").cast("double").alias("x"))


@query
def tissue_means_from_text(spark, sf):
    """Means per tissue made in the lines of a wide text matrix."""
    path = V.written_text(V.matrix_lines(spark, sf), "matrix")
    table = companions.tissue_table(text.read_lines(spark, path), V.matrix_attributes(spark, sf))
    return table.select("transcriptId", "geneId", *[F.round(c, 7).alias(c) for c in table.columns[2:]])


# --- clinical


@query
def clin_sig_stars(spark, sf):
    status = clinical.status_text(F.col("info.CLNREVSTAT"))
    return V.clinical_sites(spark, sf).select(
        "site_id",
        clinical.status_text(F.col("info.CLNSIG")).alias("clinical_significance"),
        status.alias("review_status"),
        clinical.gold_stars(status).alias("gold_stars"),
    )


def _clinical_table(spark, sf):
    vep = V.annotator_output(spark, sf)
    return companions.clinical_table(V.clinical_sites(spark, sf), vep)


@query
def clinical_table(spark, sf):
    table = _clinical_table(spark, sf)
    arrays = {"domains", "gene_ids", "transcript_consequence_terms", "transcript_ids"}
    return table.select(*[_joined(F.col(c)).alias(c) if c in arrays else F.col(c) for c in table.columns])


@query
def clinical_from_text(spark, sf):
    """The clinical table from VCF text and annotator lines, written and read back."""
    calls, notes = V.written_text(V.clinical_lines(spark, sf), "clinical-calls"), V.written_text(V.annotator_output(spark, sf), "clinical-notes")
    table, _ = companions.clinical_from_text(spark, calls, notes, fresh_folder(spark, "clinical-table"))
    arrays = {"domains", "gene_ids", "transcript_consequence_terms", "transcript_ids"}
    return table.drop("sourceFilePath").select(*[_joined(F.col(c)).alias(c) if c in arrays else F.col(c) for c in table.columns if c != "sourceFilePath"])


@query
def clinical_summary(spark, sf):
    """The summary that comes with the clinical table from text: of split variants."""
    calls, notes = V.written_text(V.clinical_lines(spark, sf), "clinical-calls"), V.written_text(V.annotator_output(spark, sf), "clinical-notes")
    return companions.clinical_from_text(spark, calls, notes, fresh_folder(spark, "clinical-table"))[1]


@query
def unknown_review_statuses(spark, sf):
    return companions.unknown_review_statuses(_clinical_table(spark, sf))


@query
def variant_summary(spark, sf):
    return summary.variant_summary(V.sites(spark, sf))


@query
def ordered_variants(spark, sf):
    variants = C.split_sites(V.sites(spark, sf)).transform(R.identifier_fields)
    return summary.sort_by_variant(variants).select("variant_id", "xpos")


# --- names and documents


def _field_names(spark, sf):
    lead = F.get(F.array(*[F.lit(x) for x in ("_", "-", "+", "$", "", "*")]), F.col("p_size") % 6)
    return V.table(spark, sf, "part").select(
        F.col("p_partkey").alias("site_id"),
        F.concat(lead, F.col("p_name"), F.lit("."), F.col("p_brand"), F.lit("([{a,b}])_$x"),
                 F.col("p_size").cast("string")).alias("name"),
    )


@query
def encode_names(spark, sf):
    name = F.col("name")
    return _field_names(spark, sf).select(
        "site_id",
        names.encode_name(name).alias("encoded"),
        names.encode_name(name, dot="_").alias("encoded_without_dot"),
    )


@query
def decode_names(spark, sf):
    return _field_names(spark, sf).select("site_id", names.decode_name(names.encode_name(F.col("name"))).alias("decoded"))


def _order_documents(spark, sf):
    return V.table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("cust.key"),
        F.when(F.col("o_custkey") % 5 > 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderpriority",
    )


@query
def bulk_documents(spark, sf):
    return D.bulk_documents(_order_documents(spark, sf), "orders", "o_orderkey")


@query
def bulk_documents_update(spark, sf):
    return D.bulk_documents(_order_documents(spark, sf), "orders", "o_orderkey", mode="update")


@query
def bulk_documents_upsert(spark, sf):
    return D.bulk_documents(_order_documents(spark, sf), "orders", "o_orderkey", mode="upsert", dot=None)


@query
def bulk_documents_create(spark, sf):
    """Without an id column."""
    return D.bulk_documents(_order_documents(spark, sf), "orders", mode="create").select("action", "body")


def _collections(spark, sf):
    existing = V.table(spark, sf, "orders").where("o_orderkey % 3 <> 0").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("cust")
    )
    incoming = V.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.when(F.col("l_linenumber") % 3 > 0, F.col("l_linestatus")).alias("status"),
        F.col("l_partkey").alias("part"),
    )
    return existing, incoming


def _merge(mode):
    def run(spark, sf):
        existing, incoming = _collections(spark, sf)
        return D.merge_documents(existing, incoming, "id", mode).select(
            "id", "status", "cust", "part"
        )

    run.__name__ = f"merge_documents_{mode}"
    return query(run)


for _mode in ("index", "create", "update", "upsert"):
    _merge(_mode)


@query
def merge_versions(spark, sf):
    """A collection in buckets after two merges: one of a twentieth of the ids, one of new ids."""
    existing, incoming = _collections(spark, sf)
    path = fresh_folder(spark, "collection")
    D.write_collection(existing, path, "id", buckets=8)
    D.merge_collection(incoming.where("id % 20 = 1").select("id", "status"), path, "id", "update", ignore_errors=True)
    D.merge_collection(incoming.where("id % 3 = 0").select("id", "part"), path, "id", "create", ignore_errors=True, order_by=["part"])
    return D.read_collection(spark, path).select("id", "status", "cust", "part")


@query
def merge_rejects_create(spark, sf):
    return D.merge_rejects(*_collections(spark, sf), "id", "create")


@query
def merge_rejects_update(spark, sf):
    existing, incoming = _collections(spark, sf)
    return D.merge_rejects(existing, incoming, "id", "update")


@query
def denovo_union(spark, sf):
    """Two tables of different columns in one collection."""
    customers = V.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("variant_id"), F.col("c_mktsegment").alias("study")
    )
    suppliers = V.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("variant_id"), F.col("s_nationkey").alias("confidence")
    )
    return D.unite_collections(customers, suppliers)


def _written_lines(spark, path):
    """Totals of the bulk text below a path: documents, requests after a file's first, and characters."""
    lines = spark.read.text(path)
    return lines.agg(
        F.count_if(F.startswith("value", F.lit('{"index":{'))).alias("n_actions"),
        F.count_if(F.startswith("value", F.lit('{"o_'))).alias("n_bodies"),
        F.sum(F.length("value")).cast("long").alias("characters"),
    )


@query
def bulk_written(spark, sf):
    """Bulk text written, replaced and appended to, as read back."""
    path = fresh_folder(spark, "bulk")
    rows = _order_documents(spark, sf)
    for replace in (True, True, False):
        D.write_bulk(rows, path, "orders", "o_orderkey", block_size=100, num_shards=3, replace=replace)
    return _written_lines(spark, path)


@query
def publish_saved(spark, sf):
    """A saved table as bulk documents: without ids, appended to what is there."""
    table, path = fresh_folder(spark, "saved"), fresh_folder(spark, "published")
    D.write_table(_order_documents(spark, sf).withColumnRenamed("cust.key", "o_cust"), table)
    for _ in range(2):
        companions.publish_saved(spark, table, path, "exomes")
    return _written_lines(spark, path)


def _tab_lines(frame, *columns):
    """A header and rows as lines of a delimited table; a missing value is NA."""
    header = frame.sparkSession.range(1).select(F.lit("\t".join(name for name, _ in columns)).alias("value"))
    cells = [F.coalesce(c.cast("string"), F.lit("NA")) for _, c in columns]
    return header.union(frame.select(F.concat_ws("\t", *cells).alias("value")))


@query
def constraint_from_text(spark, sf):
    """The constraint table from delimited text, with types imputed and columns renamed."""
    size = F.col("p_size")
    lines = _tab_lines(
        V.table(spark, sf, "part"),
        ("gene", F.col("p_brand")), ("transcript", F.concat(F.lit("ENST"), "p_partkey")), ("obs_lof", size),
        ("exp_lof", size / 4), ("oe_lof", F.when(size % 3 > 0, size / 8)), ("classic", size % 2 == 0),
    )
    path = V.written_text(lines, "constraint", one_file=True)
    return companions.constraint_table(tables.read_table(spark, path, impute=True))


@query
def denovo_from_text(spark, sf):
    """Two typed tables of text in one collection."""
    first = _tab_lines(V.table(spark, sf, "supplier"), ("variant_id", F.col("s_name")), ("key", F.col("s_suppkey")), ("confidence", F.col("s_nationkey")))
    second = _tab_lines(
        V.table(spark, sf, "customer"), ("variant_id", F.col("c_name")), ("key", F.col("c_custkey")), ("study", F.col("c_mktsegment")),
    )
    return companions.denovo_table(spark, V.written_text(first, "denovo", one_file=True), V.written_text(second, "denovo", one_file=True))


@query
def medians_from_text(spark, sf):
    """The ready-made table of medians per tissue, from delimited text."""
    size = F.col("p_size")
    lines = _tab_lines(
        V.table(spark, sf, "part"), ("transcript_id", F.concat(F.lit("ENST"), "p_partkey")), ("gene_id", F.concat(F.lit("ENSG"), F.col("p_partkey") % 97)),
        ("liver", size / 4), ("lung", F.when(size % 5 > 0, size / 2)),
    )
    return companions.expression_medians(spark, V.written_text(lines, "medians", one_file=True))


# --- text sources


def _call_set(spark, sf, **options):
    """The call set read from text files."""
    path = V.written_text(V.vcf_lines(spark, sf), "calls")
    lines = text.read_lines(spark, path, drop_matching="MONOALLELIC")
    return vcf.read_cohort(lines, vcf.read_header(spark, path), build="38", skip_invalid_loci=True, **options)


@query
def vcf_roundtrip(spark, sf):
    """Sites parsed from text: recoded contigs, invalid loci and matching lines dropped."""
    sites = _call_set(spark, sf).sites
    return sites.select(
        "contig", "position", "rsid", _joined(F.col("alleles")).alias("alleles"), "qual",
        _joined(F.col("filters")).alias("filters"),
        F.col("info.DP").alias("info_dp"),
        F.size("info.AF").alias("n_af"),
        F.get("info.AF", F.lit(0)).alias("first_af"),
        F.get("info.AF", F.lit(1)).alias("second_af"),
        F.col("info.DB").alias("info_db"),
    )


@query
def vcf_entries(spark, sf):
    return _call_set(spark, sf, carry=("contig", "position")).entries.select(
        "contig", "position", "s", G.format_call(F.col("GT")).alias("gt"),
        F.size("AD").alias("n_ad"),
        F.get("AD", F.lit(0)).alias("ad0"), F.get("AD", F.lit(1)).alias("ad1"), F.get("AD", F.lit(2)).alias("ad2"),
        F.col("DP").alias("dp"), F.col("GQ").alias("gq"),
    )


@query
def vcf_call_stats(spark, sf):
    """Text to call statistics: parse, split, count; totals per contig."""
    entries = C.split_entries(_call_set(spark, sf, fields=("GT", "AD"), carry=("contig",)).entries)
    return (
        FQ.call_stats(entries, [*KEYS, "contig"])
        .groupBy("contig")
        .agg(F.sum("AC").alias("ac"), F.sum("AN").alias("an"), F.sum("nhomalt").alias("nhom"), F.count(F.lit(1)).alias("n"))
    )


@query
def vcf_samples(spark, sf):
    """Samples of a call set whose header names a sample per nation."""
    path = V.written_text(V.vcf_header(spark, sf, "nation", "n_nationkey").coalesce(1), "header")
    return vcf.sample_rows(vcf.read_header(spark, path)).select(F.col("sample").cast("long").alias("sample"), "s")


@query
def contig_recoding(spark, sf):
    """Names recoded and loci checked by a sequence dictionary."""
    names = vcf.contig_names(vcf.sequence_dictionary(V.sequence_lines(spark, sf)))
    rows = V.called_names(spark, sf).withColumn("named", F.col("contig"))
    return vcf.recode_contigs(rows, names, "valid").select("site_id", "named", "contig", "valid")


@query
def release_dates(spark, sf):
    number = F.col("p_partkey") % 37
    lines = V.table(spark, sf, "part").select(
        F.concat(F.lit("file"), number.cast("string")).alias("path"),
        F.when((F.col("p_size") % 5 == 0) & (number % 4 > 0), F.concat(F.lit("##fileDate=2024-02-"), number + 10))
        .otherwise(F.concat(F.lit("##note="), "p_name"))
        .alias("value"),
        F.col("p_partkey").alias("line"),
    )
    return vcf.release_dates(lines)


@query
def impute_types(spark, sf):
    lines = V.table(spark, sf, "lineitem")
    text = lines.select(
        F.col("l_orderkey").cast("string").alias("key"),
        (F.col("l_partkey") + 3_000_000_000).cast("string").alias("large_key"),
        F.when(F.col("l_quantity") > 5, F.col("l_quantity").cast("string")).alias("quantity"),
        F.when(F.col("l_tax") > 0.02, "true").otherwise("false").alias("taxed"),
        F.concat(F.lit("T"), F.col("l_linenumber").cast("string")).alias("line"),
    )
    return tables.impute_types(text)


# --- reshaping


@query
def expand_types(spark, sf):
    """A map column as an array of key and value."""
    frame = V.sites(spark, sf).select(
        "site_id", F.create_map(F.lit("contig"), "contig", F.lit("first"), F.get("alleles", F.lit(0))).alias("m")
    )
    return R.expand_types(frame).select("site_id", F.explode("m").alias("e")).select("site_id", "e.key", "e.value")


@query
def transmute_fields(spark, sf):
    """Constraint table: renamed copies, with the key kept."""
    table = V.table(spark, sf, "part").select(
        F.concat(F.lit("ENST"), "p_partkey").alias("transcript"), F.col("p_name").alias("gene"),
        F.col("p_size").alias("obs_lof"), F.col("p_retailprice").alias("exp_lof"),
    )
    return companions.constraint_table(table)


@query
def constraint_pick(spark, sf):
    size = F.col("p_size")
    table = V.table(spark, sf, "part").select(
        "p_partkey", *[(size + i).alias(name) for i, name in enumerate(CONSTRAINT_FIELDS)]
    )
    return R.constraint_fields(table)


@query
def population_map_struct(spark, sf):
    """A map keyed by population as a struct; absent populations are NULL."""
    pops = F.create_map(F.lit("afr"), F.col("p_size"), F.lit("eas"), F.col("p_size") * 2)
    struct = R.population_struct(pops, POPULATIONS)
    return V.table(spark, sf, "part").select(F.col("p_partkey").alias("site_id"), struct.alias("p")).select("site_id", "p.*")


@query
def interval_structs(spark, sf):
    locus = lambda position: F.struct("contig", position.alias("position"))
    interval = F.struct(locus(F.col("start")).alias("start"), locus(F.col("end")).alias("end"))
    return V.intervals(spark, sf).select(R.interval_struct(interval).alias("i")).select("i.*")


@query
def histogram_structs(spark, sf):
    size = F.col("p_size")
    values = {
        "bin_edges": lambda i: F.array(F.lit(0.0), F.lit(5.0) + i),
        "bin_freq": lambda i: F.array(size, size + 1 + i),
        "n_larger": lambda i: size % (3 + i),
        "n_smaller": lambda i: size % (2 + i),
    }
    flat = V.table(spark, sf, "part").select(
        F.col("p_partkey").alias("site_id"),
        *[value(i).alias(f"{name}_{part}") for i, name in enumerate(RELEASE_HISTOGRAMS) for part, value in values.items()],
    )
    found = R.histogram_structs(flat)
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("h")) for n in RELEASE_HISTOGRAMS]))
    return found.select("site_id", each.alias("e")).select(
        "site_id", F.col("e.name").alias("name"), F.get("e.h.bin_edges", F.lit(1)).alias("edge"),
        F.get("e.h.bin_freq", F.lit(1)).alias("freq"), "e.h.n_larger", "e.h.n_smaller",
    )


@query
def site_quality(spark, sf):
    size = F.col("p_size")
    flat = V.table(spark, sf, "part").select(
        F.col("p_partkey").alias("site_id"), *[(size * (i + 1)).alias(f) for i, f in enumerate(SITE_QUALITY_FIELDS)]
    )
    return R.site_quality_struct(flat).select("site_id", "allele_info.*")


@query
def info_projection(spark, sf):
    return V.sites(spark, sf).select("site_id", *R.info_quality_fields())


@query
def subset_bundles(spark, sf):
    """Nested per-subset frequency, filtering-AF and popmax fields of a flat release table."""
    size = F.col("p_size")
    stems = []
    for field in FREQUENCY_FIELDS:
        stems += [field, f"{field}_female", f"{field}_male"]
        for pop, subs in RELEASE_SUBPOPULATIONS.items():
            if pop != "asj":
                stems += [f"{field}_{pop}", *[f"{field}_{pop}_{sub}" for sub in subs if sub != "onf"]]
    for field in FILTERING_AF_FIELDS:
        stems += [field, *[f"{field}_{pop}" for pop in FILTERING_AF_POPULATIONS]]
    stems += POPMAX_FIELDS
    flat = V.table(spark, sf, "part").select(
        F.col("p_partkey").alias("site_id"), *[(size * 1000 + i).alias(f"controls_{s}") for i, s in enumerate(stems)]
    )
    nested = R.subset_bundles(flat, ["controls", "non_neuro"])
    c = F.col("controls")
    return nested.select(
        "site_id",
        c["AC_adj"]["eas"]["jpn"].alias("ac_eas_jpn"),
        c["AC_adj"]["nfe"]["total"].alias("ac_nfe"),
        c["AF_adj"]["total"].alias("af_total"),
        c["AF_adj"]["female"].alias("af_female"),
        c["AN_adj"]["sas"]["male"].alias("an_sas_male"),
        c["faf95_adj"]["afr"].alias("faf95_afr"),
        c["faf99_adj"]["total"].alias("faf99_total"),
        c["popmax"].alias("popmax"),
        c["nhomalt_raw"].alias("nhomalt_raw"),
    )


# --- products


def _cohort_variants(spark, sf):
    reference = V.reference_rows(spark, sf)
    return cohort_plan.cohort_variants(
        V.cohort(spark, sf),
        V.samples(spark, sf),
        reference.select(*L.VARIANT_KEYS, "rsid"),
        reference.select(*L.VARIANT_KEYS, *cohort_plan.PREDICTORS),
        V.annotator_output(spark, sf),
    )


@query
def cohort_variants(spark, sf):
    """The flagship: every stage from raw entries to the search-ready row, with some fields flattened."""
    row = _cohort_variants(spark, sf)
    first = F.get("sortedTranscriptConsequences", F.lit(0))
    return row.select(
        "variant_id", "chrom", "pos", "ref", "alt", "xpos", "qual", "rsid",
        _joined(F.col("filters")).alias("filters"),
        *["AC", "AN", "AF", "nhomalt", "AC_raw", "AN_raw", "nhomalt_raw", "AC_proband", "AC_male", "AN_female"],
        F.col("AC_adj.afr").alias("AC_afr"),
        F.col("AN_adj.sas").alias("AN_sas"),
        F.col("in_silico_predictors.cadd").alias("cadd"),
        F.col("in_silico_predictors.splice_ai").alias("splice_ai"),
        _joined(F.col("allele_balance.alt_adj.bin_freq").cast("array<string>")).alias("ab_alt_adj"),
        _joined(F.col("genotype_depth.all_raw.bin_freq").cast("array<string>")).alias("dp_all_raw"),
        _joined(F.col("genotype_quality.alt_raw.bin_freq").cast("array<string>")).alias("gq_alt_raw"),
        F.col("flags.lc_lof").alias("lc_lof"),
        F.col("flags.lof_flag").alias("lof_flag"),
        F.size("sortedTranscriptConsequences").alias("n_transcripts"),
        first["transcript_id"].alias("first_transcript"),
        first["major_consequence"].alias("first_consequence"),
        first["flags"]["lc_lof_in_gene"].alias("first_lc_lof_in_gene"),
    )


@query
def cohort_from_text(spark, sf):
    """The whole product from files, for some of the samples."""
    reference = V.combined_reference(spark, sf)
    row = cohort_plan.cohort_from_text(
        spark, V.written_text(V.vcf_lines(spark, sf), "cohort-calls"), V.written_text(V.call_set_sheet(spark, sf), "cohort-sheet", one_file=True),
        reference.select(*L.VARIANT_KEYS, "rsid"), reference, V.written_text(V.annotator_output(spark, sf), "cohort-notes"),
        V.written_text(V.requested_list(spark, sf), "cohort-list", one_file=True),
        block_gzip=False, drop_matching="MONOALLELIC", skip_invalid_loci=True,
    )
    return row.select(
        "variant_id", "chrom", "pos", "ref", "alt", "qual", "rsid",
        *["AC", "AN", "AF", "nhomalt", "AC_raw", "AN_raw", "nhomalt_raw", "AC_proband", "AC_male", "AN_female"],
        F.col(f"AC_adj.{POPULATIONS[1]}").alias("AC_second"),
        F.size(F.array(*[F.col(f"AN_adj.{c}") for c in row.schema["AN_adj"].dataType.names])).alias("n_pops"),
        F.col("in_silico_predictors.cadd").alias("cadd"),
        F.col("in_silico_predictors.revel").alias("revel"),
        _joined(F.col("genotype_depth.all_raw.bin_freq").cast("array<string>")).alias("dp_all_raw"),
        F.col("sortedTranscriptConsequences").isNotNull().alias("annotated"),
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested search-ready rows themselves."""
    return _cohort_variants(spark, sf_dir)
