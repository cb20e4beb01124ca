"""Delimited tables, wide matrices, interval lists and annotator output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.functions import alleles as A
from locusmill.functions.basics import computed_once, let
from locusmill.functions.consequences import major_term
from locusmill.operators.lookups import broadcast_if_bounded

# Fixed value: the missing token of delimited tables.
MISSING = "NA"

# Text forms by type, tried in this order.
IMPUTED_FORMS = {
    "int": r"^-?\d+$",
    "bigint": r"^-?\d+$",
    "double": r"^[-+]?(\d+(\.\d*)?|\.\d+)([eE][-+]?\d+)?$|^[-+]?(NaN|Infinity)$",
    "boolean": r"^([Tt]rue|[Ff]alse|TRUE|FALSE)$",
}


def read_table(spark: SparkSession, path: str, delimiter: str = "\t", impute: bool = False) -> DataFrame:
    """A table with a header row. Everything is text unless ``impute`` asks for types."""
    table = spark.read.csv(path, sep=delimiter, header=True, nullValue=MISSING, inferSchema=False, quote="")
    return impute_types(table) if impute else table


def imputed_types(table: DataFrame) -> dict[str, str]:
    """Narrowest type of each text column, from one aggregation over the table."""
    checks = []
    for name in table.columns:
        value = F.col(f"`{name}`")
        for kind, form in IMPUTED_FORMS.items():
            fits = value.rlike(form) & value.try_cast(kind).isNotNull()
            checks.append(F.bool_and(F.when(value.isNotNull(), fits)).alias(f"{kind}:{name}"))
    found = table.agg(*checks).first()
    return {
        name: next((kind for kind in IMPUTED_FORMS if found[f"{kind}:{name}"]), "string") for name in table.columns
    }


def impute_types(table: DataFrame) -> DataFrame:
    """Cast text columns to their narrowest type; a column without values stays text."""
    types = imputed_types(table)
    return table.select(*[F.col(f"`{n}`").cast(t).alias(n) for n, t in types.items()])


def _matrix_lines(lines: DataFrame, row_fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """Header lines and the others, as cells ``c``."""
    head = "\t".join(row_fields) + "\t"
    cells = lines.where("value <> ''").select("value", F.split("value", "\t").alias("c"))
    is_header = F.startswith("value", F.lit(head))
    return cells.where(is_header), cells.where(~is_header)


def _number(text: Column) -> Column:
    return F.when(text != MISSING, text.try_cast("float"))


def matrix_columns(lines: DataFrame, row_fields: list[str]) -> DataFrame:
    """``place, col_id`` of a wide matrix's columns, from its header line.

    The header line is the one that starts with the row fields. Evaluating the result fails where
    files have different ones.
    """
    headers, _ = _matrix_lines(lines, row_fields)
    distinct = headers.select("value").distinct().agg(
        F.when(F.count("value") <= 1, F.min("value")).otherwise(F.raise_error(F.lit("files of one matrix have different headers"))).alias("value")
    )
    width = len(row_fields)
    named = F.split("value", "\t")
    return distinct.select(F.posexplode(F.slice(named, width + 1, F.greatest(F.size(named) - width, F.lit(0)))).alias("place", "col_id"))


def read_matrix(lines: DataFrame, row_fields: list[str]) -> DataFrame:
    """A wide numeric matrix in long form: the row fields, ``col_id`` and ``x`` (float).

    Lines are split and exploded, so the plan does not grow with the number of columns. For sums
    over groups of columns, :func:`matrix_means` needs no such rows.
    """
    width = len(row_fields)
    _, data = _matrix_lines(lines, row_fields)
    values = F.slice("c", width + 1, F.greatest(F.size("c") - width, F.lit(0)))
    long = data.select(
        *[F.get("c", F.lit(i)).alias(name) for i, name in enumerate(row_fields)], F.posexplode(values).alias("place", "text")
    )
    columns = broadcast_if_bounded(matrix_columns(lines, row_fields))
    return long.join(columns, "place").select(*row_fields, "col_id", _number(F.col("text")).alias("x"))


def matrix_means(lines: DataFrame, row_fields: list[str], groups: dict[str, list[int]]) -> DataFrame:
    """The row fields and, for each group, the mean over its columns' values in the line.

    ``groups`` names places of columns, as :func:`matrix_columns` numbers them. All is done in the
    line: one scan, no row for each cell, and no shuffle. A missing value, or a place behind the
    end of its line, does not count; a group without values has NULL.
    """
    _, data = _matrix_lines(lines, row_fields)
    width = len(row_fields)
    numbers = data.select(
        *[F.get("c", F.lit(i)).alias(name) for i, name in enumerate(row_fields)],
        F.transform(F.slice("c", width + 1, F.greatest(F.size("c") - width, F.lit(0))), _number).alias("_x"),
    )
    pinned = computed_once(numbers, "_x")

    def mean(places: list[int]) -> Column:
        own = F.transform(F.array(*[F.lit(p) for p in places]).cast("array<int>"), lambda p: F.get("_x", p).cast("double"))
        zero = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n"))
        add = lambda a, x: F.struct((a["sum"] + x).alias("sum"), (a["n"] + 1).alias("n"))
        return F.aggregate(F.filter(own, lambda x: x.isNotNull()), zero, add, lambda a: F.try_divide(a["sum"], a["n"]))

    return pinned.select(*row_fields, *[mean(places).alias(name) for name, places in groups.items()])


def parse_intervals(lines: DataFrame) -> DataFrame:
    """An interval list without its ``@`` header: ``contig, start, end``, both ends in."""
    c = F.split("value", "\t")
    return lines.where(~F.startswith("value", F.lit("@")) & (F.col("value") != "")).select(
        F.get(c, F.lit(0)).alias("contig"),
        F.get(c, F.lit(1)).try_cast("int").alias("start"),
        F.get(c, F.lit(2)).try_cast("int").alias("end"),
    )


def read_saved(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# Schema of the annotator's JSON output, in its declared order.
VEP_SCHEMA = """
assembly_name string, allele_string string, ancestral string,
colocated_variants array<struct<
  aa_allele string, aa_maf double, afr_allele string, afr_maf double, allele_string string,
  amr_allele string, amr_maf double, clin_sig array<string>, end int, eas_allele string,
  eas_maf double, ea_allele string, ea_maf double, eur_allele string, eur_maf double,
  exac_adj_allele string, exac_adj_maf double, exac_allele string, exac_afr_allele string,
  exac_afr_maf double, exac_amr_allele string, exac_amr_maf double, exac_eas_allele string,
  exac_eas_maf double, exac_fin_allele string, exac_fin_maf double, exac_maf double,
  exac_nfe_allele string, exac_nfe_maf double, exac_oth_allele string, exac_oth_maf double,
  exac_sas_allele string, exac_sas_maf double, id string, minor_allele string,
  minor_allele_freq double, phenotype_or_disease int, pubmed array<int>, sas_allele string,
  sas_maf double, somatic int, start int, strand int>>,
context string, end int, id string, input string,
intergenic_consequences array<struct<
  allele_num int, consequence_terms array<string>, impact string, minimised int,
  variant_allele string>>,
most_severe_consequence string,
motif_feature_consequences array<struct<
  allele_num int, consequence_terms array<string>, high_inf_pos string, impact string,
  minimised int, motif_feature_id string, motif_name string, motif_pos int,
  motif_score_change double, strand int, variant_allele string>>,
regulatory_feature_consequences array<struct<
  allele_num int, biotype string, consequence_terms array<string>, impact string, minimised int,
  regulatory_feature_id string, variant_allele string>>,
seq_region_name string, start int, strand int,
transcript_consequences array<struct<
  allele_num int, amino_acids string, appris string, biotype string, canonical int, ccds string,
  cdna_start int, cdna_end int, cds_end int, cds_start int, codons string,
  consequence_terms array<string>, distance int, domains array<struct<db string, name string>>,
  exon string, gene_id string, gene_pheno int, gene_symbol string, gene_symbol_source string,
  hgnc_id string, hgvsc string, hgvsp string, hgvs_offset int, impact string, intron string,
  lof string, lof_flags string, lof_filter string, lof_info string, minimised int,
  polyphen_prediction string, polyphen_score double, protein_end int, protein_start int,
  protein_id string, sift_prediction string, sift_score double, strand int, swissprot string,
  transcript_id string, trembl string, tsl int, uniparc string, variant_allele string>>,
variant_class string
"""


# Lists of the output that name an allele by number.
CONSEQUENCE_LISTS = [
    "intergenic_consequences", "motif_feature_consequences", "regulatory_feature_consequences", "transcript_consequences",
]


def parse_vep(text: Column) -> Column:
    """Annotator JSON as the ``vep`` struct."""
    return F.from_json(text, VEP_SCHEMA)


def vep_lines_by_variant(lines: DataFrame, position: str = "int") -> DataFrame:
    """Annotator lines keyed by the variants they were asked about: one line for each variant.

    ``contig, position, ref, alt`` are in minimal representation, as split sites are; ``value`` is
    the line, and ``allele_num`` and ``n_alts`` say which of its alternates the variant is. The
    keys are read from the line's ``input`` (a VCF line) without parsing the rest, and of several
    lines for a variant the one with the smallest hash is taken. ``*`` is no variant. Lines that
    are no annotator output give none; :func:`vep_rejects` has them. ``position`` is the type of
    that key, which saves a join on another one its shuffle.
    """
    asked = computed_once(lines.select("value", F.split(F.get_json_object("value", "$.input"), "\t").alias("asked")), "asked")
    alts = F.split(F.get("asked", F.lit(4)), ",")
    each = asked.where(F.size("asked") >= 5).select(
        "value",
        F.get("asked", F.lit(0)).alias("contig"),
        F.get("asked", F.lit(1)).try_cast("int").alias("position"),
        F.get("asked", F.lit(3)).alias("ref"),
        F.size(alts).alias("n_alts"),
        F.posexplode(alts).alias("place", "alt"),
    )
    trimmed = each.where("alt <> '*'").select(
        "value", "contig", "n_alts", (F.col("place") + 1).alias("allele_num"),
        A.minimal(F.col("position"), F.col("ref"), F.col("alt")).alias("v"),
    )
    chosen = F.min_by(F.struct("value", "allele_num", "n_alts"), F.struct(F.xxhash64("value"), "allele_num")).alias("line")
    return (
        trimmed.select("contig", F.col("v.position").cast(position).alias("position"), "v.ref", "v.alt", "value", "allele_num", "n_alts")
        .groupBy("contig", "position", "ref", "alt").agg(chosen)
        .select("contig", "position", "ref", "alt", "line.value", "line.allele_num", "line.n_alts")
    )


def allele_consequences(vep: Column, allele_num: Column, n_alts: Column) -> Column:
    """The annotator's output with the consequences of one of its alternates.

    Consequences that name an allele by number are dealt to it; one without a number counts for
    all. The most severe consequence of an output for several alternates is that of the
    consequences left.
    """

    def own(name: str) -> Column:
        return F.filter(vep[name], lambda c: c["allele_num"].isNull() | (c["allele_num"] == allele_num))

    dealt = vep
    for name in CONSEQUENCE_LISTS:
        dealt = dealt.withField(name, own(name))

    def with_worst(left: Column) -> Column:
        terms = F.flatten(F.array(*[F.coalesce(F.flatten(left[n]["consequence_terms"]), F.array().cast("array<string>")) for n in CONSEQUENCE_LISTS]))
        return left.withField("most_severe_consequence", major_term(F.filter(terms, lambda t: t.isNotNull()))["term"])

    return F.when(vep.isNull() | (n_alts < 2), vep).otherwise(let(dealt, with_worst))


def parsed_vep(rows: DataFrame) -> DataFrame:
    """Rows of :func:`vep_lines_by_variant`, or joined to it, with ``vep`` in place of the line."""
    parsed = computed_once(rows.withColumn("vep", parse_vep(F.col("value"))), "vep")
    dealt = allele_consequences(F.col("vep"), F.col("allele_num"), F.col("n_alts"))
    return parsed.withColumn("vep", dealt).drop("value", "allele_num", "n_alts")


def vep_by_variant(lines: DataFrame) -> DataFrame:
    """``contig, position, ref, alt, vep``: annotator output parsed, one row for each variant."""
    return parsed_vep(vep_lines_by_variant(lines))


def vep_rejects(lines: DataFrame) -> DataFrame:
    """``value`` of the lines that are no annotator output for a variant."""
    asked = F.split(F.get_json_object("value", "$.input"), "\t")
    return lines.select("value").where(F.coalesce(F.size(asked), F.lit(0)) < 5)
