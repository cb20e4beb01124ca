import pytest
from pyspark.sql import functions as F

from locusmill import catalog
from locusmill.functions.genotypes import parse_call
from locusmill.operators import cohort as C
from locusmill.operators import expression as X
from locusmill.operators import frequencies as FQ
from locusmill.operators.lookups import broadcast_if_bounded, variant_lookup
from locusmill.operators.reshape import expand_types, transmute
from locusmill.operators.summary import variant_summary
from locusmill.plans import cohort as P
from locusmill.plans import companions
from locusmill.sources import tables, text, vcf

SHEET = "ID\tEthnicity\tSex\tProband\nS1\tamr\tF\tYes\nS2\tafr\tM\tNo\nS3\teur\tF\tNo\n"
VCF = "\n".join(
    [
        '##INFO=<ID=DP,Number=1,Type=Integer,Description="d">',
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\tS3\tS4",
        "chr1\t100\t.\tAT\tA,GT\t50\tPASS\tDP=9\tGT:AD:DP:GQ\t0/1:10,10,0:20:50\t1/2:0,10,10:20:60\t0/0:20,0,0:20:30\t0/2:5,0,5:10:10",
        "chrX\t200\t.\tC\tT\t60\tPASS\tDP=5\tGT:AD:DP:GQ\t0/0:20,0:20:50\t1:0,12:12:40\t./.:.:.:.\t0/0:9,0:9:99",
    ]
) + "\n"
VEP = (
    '{"input":"chr1\\t100\\t.\\tAT\\tA","most_severe_consequence":"frameshift_variant","transcript_consequences":'
    '[{"transcript_id":"t1","gene_id":"g1","biotype":"protein_coding","consequence_terms":["frameshift_variant"],"lof":"LC","lof_flags":"x"}]}'
)


@pytest.fixture
def inputs(spark, tmp_path):
    (tmp_path / "c.vcf").write_text(VCF)
    (tmp_path / "s.tsv").write_text(SHEET)
    cohort = vcf.read_cohort(text.read_lines(spark, str(tmp_path / "c.vcf")), vcf.read_header(spark, str(tmp_path / "c.vcf")))
    sheet = P.sample_sheet(tables.read_table(spark, str(tmp_path / "s.tsv")))
    keys = "contig string, position int, ref string, alt string, "
    rsids = spark.createDataFrame([("chr1", 100, "A", "G", "rs2"), ("chr1", 100, "A", "G", "rs1")], keys + "rsid string")
    scores = spark.createDataFrame([("chrX", 200, "C", "T", 0.1, 0.2, 30.0, 0.4)],
                                   keys + "splice_ai double, primate_ai double, cadd double, revel double")
    vep = tables.vep_by_variant(spark.createDataFrame([(VEP,)], "value string"))
    return cohort, sheet, rsids, scores, vep


@pytest.mark.parametrize("stored", [False, True])
def test_cohort_variants(inputs, tmp_path, stored):
    table = P.cohort_variants(*inputs, store=str(tmp_path / "store") if stored else None)
    rows = {r.variant_id: r for r in table.collect()}
    assert set(rows) == {"1-100-AT-A", "1-100-A-G", "X-200-C-T"}
    deletion, snv, x = rows["1-100-AT-A"], rows["1-100-A-G"], rows["X-200-C-T"]
    assert (deletion.AC, deletion.AN, deletion.AC_raw, deletion.AN_raw) == (2, 6, 2, 8)
    assert (snv.AC, snv.AN, snv.AC_raw, snv.AN_raw) == (1, 6, 2, 8)
    assert deletion.AC_adj.asDict() == {"afr": 1, "amr": 1, "eur": 0}
    assert (deletion.AC_proband, deletion.AN_male, deletion.AN_female, deletion.AF_male) == (1, 2, 4, 0.5)
    assert (x.AC, x.AN, x.AF, x.nhomalt, x.AN_raw) == (1, 3, 1 / 3, 0, 5)
    assert (snv.rsid, snv.xpos, x.in_silico_predictors.cadd) == ("rs1", 1000000100, 30.0)
    assert deletion.flags.lc_lof is True and deletion.sortedTranscriptConsequences[0].flags.lof_flag_in_gene is True
    assert x.sortedTranscriptConsequences is None
    assert sum(x.genotype_depth.all_raw.bin_freq) == 3 and sum(x.genotype_depth.all_adj.bin_freq) == 2
    assert not {"contig", "position", "alleles", "vep", "info"} & set(table.columns)


def test_sample_subset(spark, inputs):
    requested = spark.createDataFrame([("S1",), ("S3",), ("nobody",)], "s string")
    cohort = inputs[0]
    subset = C.subset_cohort(cohort, requested)
    assert [r.position for r in subset.sites.collect()] == [100]
    assert sorted(r.s for r in subset.samples.collect()) == ["S1", "S3"]
    assert [r.s for r in C.missing_samples(requested, cohort.samples).collect()] == ["nobody"]
    assert tuple(C.subset_report(requested, cohort.samples).first()) == (3, 2, 1)
    row = P.cohort_variants(*inputs, requested=requested).where("variant_id = '1-100-AT-A'").first()
    assert (row.AN_raw, row.AC_adj.asDict()) == (4, {"amr": 1, "eur": 0})


def _text_inputs(spark, tmp_path, inputs):
    for name, content in (("c.vcf", VCF), ("s.tsv", SHEET), ("v.json", VEP + "\n")):
        (tmp_path / name).write_text(content)
    predictors = inputs[3]
    sources = {name: name for name in P.PREDICTORS}
    return [spark, str(tmp_path / "c.vcf"), str(tmp_path / "s.tsv"), inputs[2], predictors, str(tmp_path / "v.json")], {"block_gzip": False, "sources": sources}


def test_few_samples_are_counted_in_the_line(spark, inputs, tmp_path, monkeypatch):
    """Calls are read once and not shuffled by site; rows are those that gathered entries give."""
    given, named = _text_inputs(spark, tmp_path, inputs)
    table = P.cohort_from_text(*given, **named)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan line_ranges") == 2 and "hashpartitioning(site_id" not in plan
    found = sorted(map(str, table.collect()))
    assert len(found) == 3 and found == sorted(map(str, P.cohort_variants(*inputs).collect()))
    kept = P.cohort_from_text(*given, **named, store=str(tmp_path / "kept"))
    assert sorted(map(str, kept.collect())) == found
    monkeypatch.setattr(P.S, "WIDE_SAMPLES", 3)
    assert sorted(map(str, P.cohort_from_text(*given, **named).collect())) == found


def test_wide_calls_equal_entries(spark, tmp_path):
    """Odd genotype texts and fields that a line lacks, in columns and in rows."""
    calls = ["0/1:3,.:9:50", "1|2:0,4,5:.:7", "./1:1,2:12:.", ".", "2:.:30:99", "1/1", "0/0:20,0:101:100", "3/0:1,2,3,4:x:5", "", "0/1/1:5,5:10:30"]
    lines = ["#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB\tC"]
    for i in range(30):
        own = [calls[(i * k + k) % len(calls)] for k in (1, 3, 7)][: 2 if i == 4 else 3]
        form = ["GT:AD:DP:GQ", "GT:AD", "AD:GT:GQ"][i % 3]
        lines.append("\t".join(["chr1", str(100 + i), ".", "A", ["G", "G,T", "*,T", "AC"][i % 4], ".", ".", ".", form, *own]))
    (tmp_path / "c.vcf").write_text("\n".join(lines) + "\n")
    path = str(tmp_path / "c.vcf")
    cohort = vcf.read_cohort(text.read_lines(spark, path), vcf.read_header(spark, path), wide_up_to=3)
    sheet = spark.createDataFrame([("A", "afr", "Yes", "F"), ("B", "xyz", "No", "M")], "s string, pop string, proband string, sex string")
    keys = "contig string, position int, ref string, alt string, "
    nothing = [spark.createDataFrame([], keys + t) for t in ("rsid string", ", ".join(f"{p} double" for p in P.PREDICTORS))]
    vep = spark.createDataFrame([], "value string")
    assert cohort.wide_samples == ["A", "B", "C"]
    narrow = C.Cohort(cohort.sites, cohort.entries, cohort.samples)
    wide, long = (P.cohort_variants(c, sheet, *nothing, vep) for c in (cohort, narrow))
    assert wide.columns == long.columns and wide.count() == 38
    assert sorted(map(str, wide.collect())) == sorted(map(str, long.collect()))


def _nodes(node):
    yield node
    for i in range(node.children().size()):
        yield from _nodes(node.children().apply(i))


def test_variants_are_narrow_until_their_last_join(spark, inputs):
    """Joins see neither histograms nor depths of genotypes, which were most of what was shuffled."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cohort, *others = inputs
        table = P.cohort_variants(C.Cohort(cohort.sites, cohort.entries, cohort.samples), *others)
        joins = [n for n in _nodes(table._jdf.queryExecution().sparkPlan()) if "Join" in n.nodeName()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    read = [n.left().output().mkString(" ") for n in joins]
    assert any("_marks#" in columns for columns in read) and not any("raw_qual_hists#" in columns for columns in read)
    assert [columns for columns in read if "mark#" in columns] and not any("AD#" in columns and "mark#" in columns for columns in read)


def test_lookups_share_one_shuffle_of_the_variants(spark):
    """Positions of another width are cast before references are grouped; the variants are shuffled once."""
    keys = "contig string, position {}, ref string, alt string"
    near, far = [("chr1", p, "A", "C") for p in (1, 2, 2)], [("chr1", p, "A", "C", p) for p in (2, 2**32 + 1, 3)]
    line = VEP.replace("100\\t.\\tAT\\tA", "2\\t.\\tA\\tC")
    lines = spark.createDataFrame([(line,)], "value string")
    for own, other in (("int", "bigint"), ("bigint", "int")):
        variants = spark.createDataFrame(near, keys.format(own))
        reference = spark.createDataFrame([r for r in far if other == "bigint" or r[1] < 2**31], keys.format(other) + ", v bigint")
        found = variant_lookup(variant_lookup(variants, reference, ["v"]), reference.withColumnRenamed("v", "w"), ["w"])
        found = P.annotate_consequences(found, lines)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(contig") == 4
        rows = sorted((r.position, r.v or 0, r.w or 0, r.vep is not None) for r in found.collect())
        assert rows == [(1, 0, 0, False), (2, 2, 2, True), (2, 2, 2, True)]
        assert found.schema["position"].dataType.simpleString() == own


def test_lookup_never_multiplies_rows(spark):
    keys = "contig string, position int, ref string, alt string"
    variants = spark.createDataFrame([("1", 1, "A", "C")] * 3 + [("1", 2, "A", "C")], keys)
    reference = spark.createDataFrame([("1", 1, "A", "C", v) for v in (3, 1, 2)], keys + ", v int")
    assert sorted([r.v for r in variant_lookup(variants, reference, ["v"]).collect()], key=str) == [1, 1, 1, None]


def test_broadcast_only_below_the_bound(spark):
    frame = spark.createDataFrame([(1, "x" * 100), (2, None)], "k int, s string")
    hinted = lambda f: "strategy=broadcast" in f._jdf.queryExecution().toString()
    assert hinted(broadcast_if_bounded(frame, 164)) and not hinted(broadcast_if_bounded(frame, 163))
    # left alone, a frame joins by shuffle and gives the same rows
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = frame.join(broadcast_if_bounded(frame.select("k"), 1), "k")
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_results_do_not_depend_on_broadcast(spark, inputs):
    """The whole product once more with every join shuffled."""
    expected = sorted(map(str, P.cohort_variants(*inputs).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, P.cohort_variants(*inputs).collect())) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("parsed", [False, True])
def test_annotator_output_is_never_broadcast(spark, parsed):
    """Spark estimates a line as a few bytes, so a plan that trusts it sends all lines through the driver."""
    variants = spark.range(9).selectExpr("'chr1' AS contig", "cast(id AS int) AS position", "'A' AS ref", "'G' AS alt")
    asked = "concat('{\"input\":\"chr1\\\\t', id, '\\\\t.\\\\tA\\\\tG\",\"most_severe_consequence\":\"stop_gained\"}') AS value"
    lines = spark.range(6).selectExpr(asked)
    annotated = P.annotate_consequences(variants, tables.vep_by_variant(lines) if parsed else lines)
    plan = annotated._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    found = {r.position: r.vep and r.vep.most_severe_consequence for r in annotated.collect()}
    assert found == {i: "stop_gained" if i < 6 else None for i in range(9)}


def test_one_hot_site_and_sample(spark):
    """A third of all entries on one site: counts equal a plain count."""
    entries = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 0L, id) AS site_id", "1 AS a_index", "if(id % 3 = 1, 'hot', concat('s', id)) AS s",
        "if(id % 2 = 0, '0/1', '1/1') AS t", "true AS adj", "'afr' AS pop", "'No' AS proband", "'M' AS sex",
    ).withColumn("GT", parse_call(F.col("t")))
    row = FQ.frequencies_wide(entries, ["site_id", "a_index"], ["afr"]).where("site_id = 0").first()
    assert (row.AC_adj_afr, row.AN_raw, row.nhomalt_adj) == (1500, 2000, 500)


def test_hot_key_aggregates_are_partial(spark):
    """Every aggregation of the frequency stage combines rows before its shuffle."""
    plan = catalog.QUERIES["freq_wide"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_clinical(spark, tmp_path):
    (tmp_path / "k.vcf").write_text("\n".join([
        '##INFO=<ID=ALLELEID,Number=1,Type=Integer,Description="i">',
        '##INFO=<ID=CLNSIG,Number=.,Type=String,Description="s">',
        '##INFO=<ID=CLNREVSTAT,Number=.,Type=String,Description="r">',
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",
        "1\t100\t.\tAT\tA,GT\t.\t.\tALLELEID=5;CLNSIG=_risk,Benign;CLNREVSTAT=criteria_provided,_single_submitter",
        "2\t7\t.\tA\tC\t.\t.\tALLELEID=6;CLNSIG=Benign;CLNREVSTAT=never_heard",
        "nowhere\t7\t.\tA\tC\t.\t.\tALLELEID=7",
    ]) + "\n")
    sites = vcf.read_sites(text.read_lines(spark, str(tmp_path / "k.vcf")), build="38", skip_invalid_loci=True)
    vep = tables.vep_by_variant(spark.createDataFrame([(VEP,)], "value string"))
    table = companions.clinical_table(sites, vep, version="2024-01-15", genomeVersion="38")
    rows = table.collect()
    assert (rows[0].version, rows[0].genomeVersion) == ("2024-01-15", "38")
    assert [r.variant_id for r in rows] == ["1-100-A-G", "1-100-AT-A", "2-7-A-C"]
    hit = rows[1]
    assert (hit.allele_id, hit.clinical_significance, hit.gold_stars, hit.gene_ids) == (5, "Benign,_risk", 1, ["g1"])
    assert (hit.main_transcript_category, hit.gene_id_to_consequence_json) == ("lof", '{"g1":"frameshift_variant"}')
    assert rows[2].gold_stars is None and rows[2].main_transcript_gene_id is None
    assert [tuple(r) for r in companions.unknown_review_statuses(table).collect()] == [("never_heard", 1)]
    original = companions.clinical_sites(sites).where("alt = 'G'").first().original_alt_alleles
    assert original == ["chr1-100-AT-A", "chr1-100-AT-GT"]


def test_expression(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("transcript_id\tgene_id\tA\tB\tC\nt1\tg\t1\t3\t9\nt2\tg\tNA\t5\t1\n")
    lines = text.read_lines(spark, str(tmp_path / "m.tsv"))
    matrix = tables.read_matrix(lines, ["transcript_id", "gene_id"])
    attributes = spark.createDataFrame(
        [("A", "Liver"), ("B", "Liver"), ("C", "Lung"), ("Z", "Spleen"), ("C", "Lung"), ("Q", None)], "SAMPID string, SMTSD string"
    )
    for table in (companions.tissue_table(lines, attributes), companions.tissue_table_long(matrix, attributes)):
        assert table.columns == ["transcriptId", "geneId", "liver", "lung"]
        assert sorted(map(tuple, table.collect())) == [("t1", "g", 2.0, 9.0), ("t2", "g", 5.0, 1.0)]
    plan = companions.tissue_table(lines, attributes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 1 and "Exchange" not in plan and "Join" not in plan
    with pytest.raises(KeyError):
        X.tissue_columns(["Moon"])
    (tmp_path / "med.tsv").write_text("transcript_id\tgene_id\tLiver\nt1\tg\t1.5\n")
    assert companions.expression_medians(spark, str(tmp_path / "med.tsv")).dtypes == [
        ("transcriptId", "string"), ("geneId", "string"), ("Liver", "double")]


def test_exome_subset_and_denovo(spark, inputs, tmp_path):
    intervals = spark.createDataFrame([("chrX", 150, 200)], "contig string, start int, end int")
    companions.write_exome_subset(inputs[0], intervals, str(tmp_path / "x"), partitions=5)
    assert [r.position for r in spark.read.parquet(str(tmp_path / "x/sites")).collect()] == [200]
    assert spark.read.parquet(str(tmp_path / "x/entries")).count() == 4
    (tmp_path / "a.tsv").write_text("variant_id\tn\n1-2-A-C\t1\n")
    (tmp_path / "b.tsv").write_text("variant_id\tstudy\n1-3-A-C\tx\n")
    both = companions.denovo_table(spark, str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv"))
    assert both.columns == ["variant_id", "n", "study"] and both.count() == 2


def test_reshaping(spark):
    frame = spark.createDataFrame([("t", "g", {"a": 1})], "transcript string, gene string, m map<string,int>")
    table = companions.constraint_table(frame)
    assert table.columns == ["transcript", "m", "gene_name", "transcript_id"]
    assert expand_types(frame).first().m[0].asDict() == {"key": "a", "value": 1}
    assert transmute(frame, {"gene": F.upper("gene")}, ["gene"]).first().gene == "G"


def test_summary(spark):
    sites = spark.createDataFrame([("1", ["A", "C", "*"]), ("2", ["A", "AT"])], "contig string, alleles array<string>")
    found = {(r.section, r.label): r.n for r in variant_summary(sites).collect()}
    assert found == {("variants", "total"): 2, ("contig", "1"): 1, ("contig", "2"): 1, ("alleles_per_site", "3"): 1,
                     ("alleles_per_site", "2"): 1, ("allele_type", "SNP"): 1, ("allele_type", "Star"): 1, ("allele_type", "Insertion"): 1}
