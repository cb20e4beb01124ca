"""The driver's tables seen as a cohort.

Sites come from ``part``, entries from ``lineitem`` and ``orders``, samples from ``customer``.
All values are functions of table columns, so the work grows with the tables. Nothing is
gathered per key: transcripts, status lists and VCF lines are built inside each row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.functions import alleles as A
from locusmill.functions import genotypes as G
from locusmill.functions.basics import computed_once
from locusmill.operators.cohort import Cohort
from locusmill.sinks.scratch import fresh_folder
from locusmill.vocabulary import CONSEQUENCE_TERMS, POPULATIONS

# Allele lists by kind of site.
KINDS = [["A", "G"], ["A", "AT"], ["AT", "A"], ["A", "G", "T"], ["AT", "A", "GT"], ["A", "*", "C"]]

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows of a task where each takes much longer to work on than to read.
SLOW_ROWS = 25_000
# Order lines of a task whose genotypes become several counter rows each, held in a hash map.
CELL_ROWS = 250_000
# More samples than Spark's default threshold lets it broadcast, at 16 bytes a row or more.
MANY_SAMPLES = 1_000_000


def spread(frame: DataFrame, rows: int | None = None) -> DataFrame:
    """Rows of a scan that has fewer partitions than there are cores, spread over all cores.

    Only small inputs are shuffled; a scan with enough partitions is left as it is. With ``rows``, enough
    means that a partition has about as many, so that tasks do not grow with the table.
    """
    wanted = frame.sparkSession.sparkContext.defaultParallelism
    if rows is not None:
        wanted = max(wanted, -(-frame.count() // rows))
    return frame.repartition(wanted) if frame.rdd.getNumPartitions() < wanted else frame


def _sql_list(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _strings(values: list[str]) -> Column:
    return F.expr(_sql_list(values))


def contig_of(key: Column) -> Column:
    number = key % 24
    return (
        F.when(number == 22, "chrX")
        .when(number == 23, "chrY")
        .otherwise(F.concat(F.lit("chr"), (number + 1).cast("string")))
    )


def position_of(key: Column) -> Column:
    return key * 10 + 1000


def _one_of(lists: list[list[str]], number: Column) -> Column:
    choices = F.expr("array(" + ", ".join(_sql_list(values) for values in lists) + ")")
    return F.get(choices, (number % len(lists)).cast("int"))


def alleles_of(size: Column) -> Column:
    return _one_of(KINDS, size)


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("site_id"),
        contig_of(key).alias("contig"),
        position_of(key).alias("position"),
        alleles_of(F.col("p_size")).alias("alleles"),
        F.concat(F.lit("id"), key.cast("string")).alias("rsid"),
        F.col("p_retailprice").alias("qual"),
        F.when(F.col("p_size") % 4 == 0, F.array(F.lit("LowQual"), F.col("p_type"))).otherwise(
            F.array().cast("array<string>")
        ).alias("filters"),
        F.struct(
            F.col("p_size").alias("DP"),
            F.floor("p_retailprice").cast("double").alias("MQ"),
            (F.col("p_size") / 4).alias("QD"),
            (F.col("p_size") % 2 == 0).alias("POSITIVE_TRAIN_SITE"),
            (F.col("p_size") % 2 == 1).alias("NEGATIVE_TRAIN_SITE"),
            (F.col("p_size") - 25).cast("double").alias("MQRankSum"),
            (F.col("p_size") * 2).cast("double").alias("ReadPosRankSum"),
            F.lit(0.5).alias("SOR"),
        ).alias("info"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("s"),
        F.get(_strings(POPULATIONS), F.col("c_nationkey") % 7).alias("pop"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Yes").otherwise("No").alias("proband"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("sex"),
    )


def requested_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth customer, and two ids that no table has."""
    wanted = table(spark, sf_dir, "customer").where("c_custkey % 10 = 0").select(F.col("c_custkey").alias("s"))
    absent = table(spark, sf_dir, "region").where("r_regionkey < 2").select((-F.col("r_regionkey") - 1).alias("s"))
    return wanted.union(absent.select(F.col("s").cast("long")))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One genotype per part and customer.

    The site columns join before the order keys do, so that a part with very many lines is
    split by adaptive execution and the result of the last aggregation is spread by part and
    customer. It has a task for about as many lines, whatever the size of the table: tasks merged
    by their bytes would hold millions of genotypes, as a genotype is a few bytes there. A later
    shuffle join, as with samples too many to broadcast, does merge its tasks by bytes.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    tasks = max(spark.sparkContext.defaultParallelism, -(-lines.count() // CELL_ROWS))
    cell = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .repartition(tasks, "l_partkey", "o_custkey")
        .groupBy("l_partkey", "o_custkey", "p_size")
        .agg(
            F.min("l_quantity").alias("q"),
            F.min("l_extendedprice").alias("ep"),
            F.min("l_discount").alias("d"),
        )
    )
    return cell.select(
        F.col("l_partkey").alias("site_id"),
        alleles_of(F.col("p_size")).alias("alleles"),
        F.col("o_custkey").alias("s"),
        *_genotype_fields(F.col("l_partkey"), F.col("o_custkey"), F.col("p_size"), F.col("q"), F.col("ep"), F.col("d")),
    )


def _genotype_fields(key: Column, s: Column, size: Column, q: Column, ep: Column, d: Column) -> list[Column]:
    whole_q = F.floor(q)
    whole_ep = F.floor(ep)
    three = size % 6 >= 3
    high = whole_ep % F.when(three, 3).otherwise(2)
    low = whole_q % (high + 1)
    haploid = (key % 24 >= 22) & (s % 2 == 0)
    phased = whole_q % 5 == 0
    alt1 = F.floor(q * d * 5)
    gt = F.when(
        whole_ep % 11 != 0,
        G.call(
            F.when(haploid | phased, high).otherwise(low),
            F.when(haploid, F.lit(None)).when(phased, low).otherwise(high),
            phased & ~haploid,
        ),
    )
    other = F.greatest(whole_q - alt1, F.lit(0))
    depths = F.when(three, F.array(other, alt1, whole_ep % 7)).otherwise(F.array(other, alt1))
    return [
        gt.alias("GT"),
        depths.cast("array<int>").alias("AD"),
        whole_q.cast("int").alias("DP"),
        (whole_ep % 100).cast("int").alias("GQ"),
    ]


def cohort(spark: SparkSession, sf_dir: str) -> Cohort:
    """Sites, entries and samples; samples too many to broadcast are hashed in lookups.

    A task's share of the samples is small, while a merge join would sort its wide entries, in the
    tasks that count them next.
    """
    people = samples(spark, sf_dir)
    if people.count() > MANY_SAMPLES:
        people = people.hint("shuffle_hash")
    return Cohort(sites(spark, sf_dir), entries(spark, sf_dir), people)


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").where("p_partkey % 50 = 0").select(
        contig_of(key).alias("contig"), position_of(key).alias("start"), (position_of(key) + 200).alias("end")
    )


def reference_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rsid and scores of two parts in three, with every ninth key present twice."""
    key = F.col("p_partkey")
    alleles = alleles_of(F.col("p_size"))
    rows = table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(
        contig_of(key).alias("contig"),
        position_of(key).alias("position"),
        F.get(alleles, F.lit(0)).alias("ref"),
        F.get(alleles, F.lit(1)).alias("alt"),
        F.explode(
            F.when(key % 9 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        ).alias("copy"),
        key.alias("key"),
        F.col("p_size").alias("size"),
    )
    return rows.select(
        "contig",
        "position",
        "ref",
        "alt",
        F.concat(F.lit("rs"), (F.col("key") + F.col("copy") * 1_000_000_000).cast("string")).alias("rsid"),
        ((F.col("size") + F.col("copy")) / 64).alias("splice_ai"),
        F.when(F.col("size") % 3 > 0, F.col("size") / 128).alias("primate_ai"),
        (F.col("key") % 40).cast("double").alias("cadd"),
        F.when(F.col("size") % 2 > 0, F.col("size") / 256).alias("revel"),
    )


# One annotated transcript, from ``v.seed, v.size, v.flag`` and its number ``i``; ``n`` decides most fields.
_N = "(v.seed + i * 7)"
_START = f"cast({_N} % 300 + 1 AS int)"
_TRANSCRIPT_ID = "concat('T', v.seed * 10 + i)"
_TERM = "get(" + _sql_list(CONSEQUENCE_TERMS) + ", cast(({n} + {offset}) % 39 AS int))"
_FIRST, _SECOND, _THIRD = (_TERM.format(n=_N, offset=o) for o in (0, 11, 22))
TRANSCRIPT_FIELDS = {
    "amino_acids": f"if({_N} % 6 > 0, substr('ACDEFGHIKLMNPQRSTVWYX*U', cast({_N} % 23 + 1 AS int), 1), 'K/R')",
    "biotype": f"CASE WHEN v.flag = 'P' THEN NULL WHEN {_N} % 3 = 0 THEN 'lincRNA' ELSE 'protein_coding' END",
    "canonical": f"CASE WHEN {_N} % 4 > 0 THEN cast({_N} % 2 AS int) END",
    "cdna_start": f"CASE WHEN {_N} % 5 > 0 THEN {_START} * 3 END",
    "cdna_end": f"CASE WHEN {_N} % 5 > 0 THEN {_START} * 3 + 1 END",
    "codons": f"CASE WHEN {_N} % 5 > 1 THEN 'aAg/aGg' END",
    "consequence_terms": f"""CASE WHEN {_N} % 8 = 0 THEN array({_THIRD}, 'new_term')
      WHEN {_N} % 8 < 3 THEN array({_SECOND}, {_FIRST}) ELSE array({_FIRST}) END""",
    "domains": f"""CASE WHEN {_N} % 9 > 0 THEN array(named_struct('db', 'Pfam', 'name', concat('PF', {_N} % 4)),
      named_struct('db', 'hmmpanther', 'name', concat('PTHR', v.size % 3))) END""",
    "gene_id": f"CASE WHEN {_N} % 31 > 0 THEN concat('G', v.seed % 50 + i % 3) END",
    "gene_symbol": "concat('SYM', v.seed % 50 + i % 3)",
    "hgvsc": f"CASE WHEN {_N} % 7 > 0 THEN concat({_TRANSCRIPT_ID}, ':c.', {_START}, 'A>G') END",
    "hgvsp": f"""CASE WHEN {_N} % 5 = 0 THEN concat({_TRANSCRIPT_ID}, ':p.', {_START}, '%3D')
      WHEN {_N} % 5 < 3 THEN concat({_TRANSCRIPT_ID}, ':p.Lys', {_START}, 'Arg') END""",
    "lof": f"get(array('HC', 'LC', '', NULL), cast({_N} % 4 AS int))",
    "lof_flags": f"CASE WHEN {_N} % 13 > 0 THEN if({_N} % 3 = 0, '', 'SINGLE_EXON') END",
    "lof_filter": f"if({_N} % 4 = 1, 'END_TRUNC', '')",
    "lof_info": "''",
    "polyphen_prediction": f"CASE WHEN {_N} % 6 = 1 THEN 'benign' END",
    "sift_prediction": f"CASE WHEN {_N} % 6 = 2 THEN 'tolerated' END",
    "protein_id": f"CASE WHEN {_N} % 5 > 0 THEN concat('P', v.seed * 10 + i) END",
    "protein_start": _START,
    "transcript_id": _TRANSCRIPT_ID,
}
# The alternate that a transcript's consequences belong to; some outputs don't say.
ALLELE_NUMBER = {"allele_num": "if(v.seed % 11 = 0, cast(NULL AS int), cast(i % v.n_alts + 1 AS int))"}


def _vep_struct(seed: Column, asked: Column, fields: dict[str, str]) -> Column:
    """Annotator output of one variant or site, with up to six transcripts."""
    most_severe = F.get(F.expr(_sql_list(CONSEQUENCE_TERMS)), ((seed + 7) % len(CONSEQUENCE_TERMS)).cast("int"))
    fields = ", ".join(f"'{name}', {text}" for name, text in fields.items())
    transcripts = F.expr(
        f"""transform(array(named_struct('seed', _seed, 'size', _size, 'flag', _flag, 'n_alts', _n_alts)), v ->
          transform(filter(sequence(0, cast(v.seed % 7 AS int)), i -> i > 0), i -> named_struct({fields})))[0]"""
    )
    return F.struct(
        asked.alias("input"), most_severe.alias("most_severe_consequence"), transcripts.alias("transcript_consequences")
    )


def _with_vep(
    frame: DataFrame, seed: Column, size: Column, flag: Column, asked: Column, n_alts: Column | None = None
) -> DataFrame:
    fields = TRANSCRIPT_FIELDS | ({} if n_alts is None else ALLELE_NUMBER)
    drawn = frame.withColumns({"_seed": seed.cast("long"), "_size": size, "_flag": flag, "_n_alts": F.lit(1) if n_alts is None else n_alts})
    return drawn.withColumn("vep", _vep_struct(F.col("_seed"), asked, fields)).drop("_seed", "_size", "_flag", "_n_alts")


def annotated_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One annotated variant per order, with up to six transcripts."""
    price = F.floor("o_totalprice")
    seed = F.col("o_orderkey") * 3 + F.col("o_custkey") + price
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]
    orders = spread(table(spark, sf_dir, "orders").select(*columns), SLOW_ROWS).withColumn("seed", seed)
    unasked = F.lit(None).cast("string")
    annotated = _with_vep(orders, F.col("seed"), price % 50, F.col("o_orderstatus"), unasked)
    return computed_once(annotated.select("o_orderkey", "seed", "vep"), "vep")


def annotator_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One annotator JSON line per site and first alternate, for five sites in six."""
    key = F.col("p_partkey")
    parts = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size").where("p_partkey % 6 <> 5"))
    parts = parts.withColumn("alleles", alleles_of(F.col("p_size")))
    asked = F.concat_ws(
        "\t",
        contig_of(key),
        position_of(key).cast("string"),
        F.lit("."),
        F.get("alleles", F.lit(0)),
        F.get("alleles", F.lit(1)),
    )
    annotated = _with_vep(parts, key, F.col("p_size").cast("long"), F.lit("A"), asked)
    return annotated.select(F.to_json("vep").alias("value"))


def annotator_site_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One annotator JSON line per site with all its alternates, for five sites in six; every fourth line twice."""
    key, alternates = F.col("p_partkey"), A.alternates(F.col("alleles"))
    parts = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size").where("p_partkey % 6 <> 5"))
    parts = parts.withColumn("alleles", alleles_of(F.col("p_size")))
    asked = F.concat_ws(
        "\t", contig_of(key), position_of(key).cast("string"), F.lit("."), F.get("alleles", F.lit(0)), F.array_join(alternates, ",")
    )
    annotated = _with_vep(parts, key, F.col("p_size").cast("long"), F.lit("A"), asked, F.size(alternates))
    copies = F.sequence(F.lit(1), F.when(key % 4 == 0, 2).otherwise(1))
    return annotated.select(F.to_json("vep").alias("value"), F.explode(copies).alias("copy")).select("value")


def matrix_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide expression matrix as text: a row per part, a column per nation."""
    numbers = _sample_numbers(spark, sf_dir, "nation", "n_nationkey")
    named = F.transform("numbers", lambda i: F.concat(F.lit("N"), i.cast("string")))
    header = numbers.select(F.array_join(F.concat(F.array(F.lit("transcript_id"), F.lit("gene_id")), named), "\t").alias("value"))
    size = F.col("p_size")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", F.lit(1).alias("one"))
    cell = lambda i: F.when((size + i) % 7 == 0, "NA").otherwise(((size * (i + 1) % 97) / 4).cast("string"))
    rows = parts.join(F.broadcast(numbers.withColumn("one", F.lit(1))), "one").select(
        F.concat_ws(
            "\t", F.concat(F.lit("T"), "p_partkey"), F.concat(F.lit("G"), F.col("p_partkey") % 10), F.array_join(F.transform("numbers", cell), "\t")
        ).alias("value")
    )
    return header.union(rows)


def matrix_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tissues of the matrix's columns by region; those of one region have none, and one more column is not in it."""
    tissues = {0: "Liver", 1: "Lung", 2: "Whole Blood", 3: "Spleen"}
    tissue = F.coalesce(*[F.when(F.col("n_regionkey") == r, t) for r, t in tissues.items()])
    rows = table(spark, sf_dir, "nation").select(F.concat(F.lit("N"), "n_nationkey").alias("SAMPID"), tissue.alias("SMTSD"))
    absent = table(spark, sf_dir, "region").where("r_regionkey = 0").select(F.lit("N99").alias("SAMPID"), F.lit("Uterus").alias("SMTSD"))
    return rows.union(absent)


def expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value of each order line: transcript, sample and tissue."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("ENST"), F.col("l_partkey").cast("string")).alias("transcript_id"),
        F.concat(F.lit("ENSG"), (F.col("l_partkey") % 97).cast("string")).alias("gene_id"),
        F.col("o_custkey").alias("col_id"),
        F.col("l_extendedprice").alias("x"),
    )


def tissue_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample attributes; one market segment in five has no tissue."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("SAMPID"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Brain - Spinal cord (cervical c-1)")
        .when(F.col("c_mktsegment") == "BUILDING", "Liver")
        .when(F.col("c_mktsegment") == "FURNITURE", "Lung")
        .when(F.col("c_mktsegment") == "MACHINERY", "Whole Blood")
        .alias("SMTSD"),
    )


# Status lists by part size; one has a leading underscore that sorts last, one is unknown.
REVIEW_STATUSES = [
    ["criteria_provided", "_single_submitter"],
    ["criteria_provided", "_multiple_submitters", "_no_conflicts"],
    ["reviewed_by_expert_panel"],
    ["practice_guideline"],
    ["_conflicting_interpretations", "criteria_provided"],
    ["no_assertion_provided"],
    ["not_a_known_status"],
]
SIGNIFICANCES = [
    ["Pathogenic"], ["_other", "Benign"], ["Likely_benign", "Benign"], ["Benign", "Benign"], ["_drug_response", "_other", "Affects"],
]


def clinical_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites(spark, sf_dir).withColumn(
        "info",
        F.struct(
            F.col("site_id").alias("ALLELEID"),
            _one_of(SIGNIFICANCES, F.col("info.DP")).alias("CLNSIG"),
            _one_of(REVIEW_STATUSES, F.col("info.DP")).alias("CLNREVSTAT"),
        ),
    )


VCF_HEADER = [
    "##fileformat=VCFv4.2",
    "##fileDate=2024-01-15",
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="depth">',
    '##INFO=<ID=AF,Number=A,Type=Float,Description="frequencies">',
    '##INFO=<ID=DB,Number=0,Type=Flag,Description="known">',
]
VCF_COLUMNS = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT"


def _sample_numbers(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """One row: the numbers of the call set's samples, in order, from the keys of a small table."""
    return table(spark, sf_dir, name).agg(F.array_sort(F.collect_list(F.col(key).cast("int"))).alias("numbers"))


def vcf_header(spark: SparkSession, sf_dir: str, name: str = "region", key: str = "r_regionkey") -> DataFrame:
    """Header lines of a call set whose samples are the rows of a small table."""
    named = F.transform("numbers", lambda i: F.concat(F.lit("S"), i.cast("string")))
    columns = F.array_join(F.concat(F.array(F.lit(VCF_COLUMNS)), named), "\t")
    lines = F.concat(_strings(VCF_HEADER), F.array(columns))
    return _sample_numbers(spark, sf_dir, name, key).select(F.explode(lines).alias("value"), F.lit("header").alias("path"))


def vcf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VCF text: the header, and a data line per order line with a sample per region."""
    key, q, ep = F.col("l_partkey"), F.floor("l_quantity"), F.floor("l_extendedprice")
    text = lambda c: c.cast("string")
    alleles = _one_of(KINDS, q)
    n_alts = F.size(alleles) - 1

    def sample(i: Column) -> Column:
        first = text((ep + i) % (n_alts + 1))
        gt = F.when((ep + i) % 11 == 0, "./.").when((ep + i) % 13 == 0, first).otherwise(
            F.concat(first, F.when((q + i) % 3 == 0, "|").otherwise("/"), text(n_alts))
        )
        depths = F.concat_ws(",", text(q), F.when((q + i) % 7 == 0, ".").otherwise(text(ep % 50 + i)),
                             F.when(n_alts > 1, text(ep % 9)))
        full = F.concat_ws(":", gt, depths, text(q + ep % 50), text((ep + i) % 100))
        return F.when((q + i) % 10 == 0, gt).otherwise(full)

    filters = F.when(q % 4 == 0, "PASS").when(q % 4 == 1, ".").when(q % 4 == 2, "q10").otherwise("s50;q10")
    info = F.concat_ws(
        ";", F.concat(F.lit("DP="), text(q)), F.when(q % 3 == 0, "AF=0.5,."), F.when(q % 5 == 0, "DB"), F.lit("X=y")
    )
    contig = F.when(ep % 29 == 0, "chrUn_1").when(ep % 2 == 0, contig_of(key)).otherwise(
        F.regexp_replace(contig_of(key), "chr", "")
    )
    lines = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"))
    # the one row of sample numbers goes to all tasks
    lines = lines.withColumn("one", F.lit(1)).join(
        F.broadcast(_sample_numbers(spark, sf_dir, "region", "r_regionkey").withColumn("one", F.lit(1))), "one"
    )
    data = lines.select(
        F.concat_ws(
            "\t",
            contig,
            text(position_of(key)),
            F.when(q % 2 == 0, ".").otherwise(text(F.concat(F.lit("rs"), text(key)))),
            F.get(alleles, F.lit(0)),
            F.array_join(A.alternates(alleles), ","),
            F.when(q % 6 == 0, ".").otherwise(text(q)),
            filters,
            F.when(q % 17 == 0, F.concat(info, F.lit(";MONOALLELIC"))).otherwise(info),
            F.lit("GT:AD:DP:GQ"),
            F.array_join(F.transform("numbers", sample), "\t"),
        ).alias("value"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("path"),
    )
    return vcf_header(spark, sf_dir).union(computed_once(data, "value"))


def written_text(lines: DataFrame, label: str, one_file: bool = False) -> str:
    """The lines as text files in a folder of their own; its path. Short tables go to one file, header first."""
    folder = fresh_folder(lines.sparkSession, label)
    rows = lines.select("value")
    (rows.coalesce(1) if one_file else rows).write.text(folder)
    return folder


def sequence_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sequence dictionary: a chromosome per nation below 24, and an unplaced sequence per supplier."""
    line = lambda name, length: F.concat(F.lit("@SQ\tSN:"), name, F.lit("\tLN:"), length.cast("string"), F.lit("\tM5:x")).alias("value")
    nation, supplier = F.col("n_nationkey"), F.col("s_suppkey")
    chromosomes = table(spark, sf_dir, "nation").where(nation < 24).select(line(contig_of(nation), 1_000_000 + nation * 1000))
    unplaced = table(spark, sf_dir, "supplier").select(line(F.concat(F.lit("chrUn_"), supplier, F.lit("v1")), 5000 + supplier))
    return chromosomes.union(unplaced)


def called_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loci as call sets name them: with and without ``chr``, unplaced, and made up."""
    key = F.col("p_partkey")
    name = (
        F.when(key % 4 == 0, contig_of(key))
        .when(key % 4 == 1, F.replace(contig_of(key), F.lit("chr"), F.lit("")))
        .when(key % 4 == 2, F.concat(F.lit("Un_"), (key % 150).cast("string"), F.lit("v1")))
        .otherwise(F.concat(F.lit("chr99_X"), key.cast("string"), F.lit("v1_alt")))
    )
    return table(spark, sf_dir, "part").select(key.alias("site_id"), name.alias("contig"), (key * 37 % 1_100_000).cast("int").alias("position"))


CLINICAL_HEADER = [
    "##fileformat=VCFv4.1",
    "##fileDate=2024-03-02",
    '##INFO=<ID=ALLELEID,Number=1,Type=Integer,Description="id">',
    '##INFO=<ID=CLNSIG,Number=.,Type=String,Description="significance">',
    '##INFO=<ID=CLNREVSTAT,Number=.,Type=String,Description="status">',
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",
]


def clinical_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clinical sites as VCF text without genotypes and without ``chr``, and one line of an unknown contig."""
    found = clinical_sites(spark, sf_dir)
    listed = lambda c: F.array_join(F.col(f"info.{c}"), ",")
    info = F.concat(
        F.lit("ALLELEID="), F.col("info.ALLELEID").cast("string"), F.lit(";CLNSIG="), listed("CLNSIG"), F.lit(";CLNREVSTAT="), listed("CLNREVSTAT")
    )
    text = lambda contig: F.concat_ws(
        "\t", contig, F.col("position").cast("string"), F.lit("."), F.get("alleles", F.lit(0)), F.array_join(A.alternates(F.col("alleles")), ","),
        F.lit("."), F.lit("."), info,
    ).alias("value")
    top = table(spark, sf_dir, "region").where("r_regionkey = 0")
    rows = found.select(text(F.replace("contig", F.lit("chr"), F.lit(""))))
    return top.select(F.explode(_strings(CLINICAL_HEADER)).alias("value")).union(rows).union(
        found.where("site_id % 100 = 0").select(text(F.lit("NW_0001")))
    )


def call_set_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the sample sheet of :func:`vcf_lines`, a sample per region."""
    r = F.col("r_regionkey")
    fields = [
        F.concat(F.lit("S"), r.cast("string")), F.get(_strings(POPULATIONS), r.cast("int")),
        F.when(r % 2 == 0, "M").otherwise("F"), F.when(r == 0, "Yes").otherwise("No"),
    ]
    regions = table(spark, sf_dir, "region")
    header = regions.where("r_regionkey = 0").select(F.lit("ID\tEthnicity\tSex\tProband").alias("value"))
    return header.union(regions.select(F.concat_ws("\t", *fields).alias("value")))


def requested_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a list of samples: those of all regions but one, and one that the call set lacks."""
    regions = table(spark, sf_dir, "region")
    name = F.when(F.col("r_regionkey") == 2, "nobody").otherwise(F.concat(F.lit("S"), F.col("r_regionkey").cast("string")))
    return regions.where("r_regionkey = 0").select(F.lit("s").alias("value")).union(regions.select(name.alias("value")))


def combined_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference rows as one table with a struct for each source of scores."""
    rows = reference_rows(spark, sf_dir)
    return rows.select(
        "contig", "position", "ref", "alt", "rsid",
        F.struct(F.col("splice_ai").alias("delta_score"), F.lit("x").alias("consequence")).alias("splice_ai"),
        F.struct(F.col("primate_ai").alias("score")).alias("primate_ai"),
        F.struct(F.col("cadd").alias("PHRED")).alias("cadd"),
        F.struct(F.col("revel").alias("REVEL_score")).alias("dbnsfp"),
    )
