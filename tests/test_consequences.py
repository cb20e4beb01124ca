import pytest
from pyspark.sql import functions as F

from locusmill.functions import clinical, consequences as Q, identifiers as I, lof, names
from locusmill.operators.reshape import transcript_fields
from locusmill.sources.tables import VEP_SCHEMA

ARRAY = "array<struct<gene_id:string,lof:string,lof_flags:string,lof_info:string>>"
CASES = {
    "all_lc_lof": ["foo/LC/", "foo/NC/", "bar/LC/", "baz//", "baz/LC/"],
    "some_lc_lof": ["foo/LC/", "foo//", "bar/LC/", "baz/HC/", "baz/LC/"],
    "all_flagged": ["foo/HC/flag1", "foo/HC/flag2", "bar/LC/flag1", "baz/HC/flag2", "baz//"],
    "some_flagged": ["foo/HC/flag1", "foo/HC/", "bar//flag1", "bar/LC/flag1", "baz/HC/flag2", "baz/HC/flag3"],
}


@pytest.fixture
def flags(spark):
    rows = [(name, [(*text.split("/"), "") for text in texts]) for name, texts in CASES.items()]
    frame = spark.createDataFrame(rows, f"name string, t {ARRAY}")
    t = F.col("t")
    found = frame.select(
        "name", lof.variant_low_confidence(t).alias("low"), lof.variant_flagged(t).alias("flagged"),
        lof.genes_low_confidence(t).alias("low_genes"), lof.genes_flagged(t).alias("flagged_genes"),
    )
    return {r.name: r for r in found.collect()}


def test_variant_flags(flags):
    assert flags["all_lc_lof"].low is True and flags["some_lc_lof"].low is False
    assert flags["all_flagged"].flagged is True and flags["some_flagged"].flagged is False


def test_gene_flags(flags):
    assert flags["all_lc_lof"].low_genes == ["bar", "baz", "foo"]
    assert flags["some_lc_lof"].low_genes == ["bar", "foo"]
    assert flags["all_flagged"].flagged_genes == ["bar", "baz", "foo"]
    assert flags["some_flagged"].flagged_genes == ["bar", "baz"]


@pytest.mark.parametrize(
    ("value", "note", "low", "flagged"),
    [("LC", "", True, False), ("HC", "", False, False), ("", "", False, False), ("HC", "foo", False, True),
     ("", "bar", False, False), (None, "bar", False, False), ("LC", None, True, False)],
)
def test_transcript_flags(evaluate, value, note, low, flagged):
    t = F.struct(F.lit(value).cast("string").alias("lof"), F.lit(note).cast("string").alias("lof_flags"))
    assert evaluate(lof.transcript_low_confidence(t), lof.transcript_flagged(t)) == (low, flagged)


def vep(spark, transcripts, most_severe="stop_gained"):
    import json

    text = json.dumps({"most_severe_consequence": most_severe, "transcript_consequences": transcripts})
    return spark.createDataFrame([(text,)], "j string").select(F.from_json("j", VEP_SCHEMA).alias("vep"))


TRANSCRIPTS = [
    {"transcript_id": "t0", "gene_id": "g1", "consequence_terms": ["upstream_gene_variant"], "biotype": "protein_coding"},
    {"transcript_id": "t1", "gene_id": "g1", "consequence_terms": ["intron_variant", "stop_gained"], "canonical": 1, "lof": "HC",
     "hgvsc": "t1:c.5A>G", "hgvsp": "p1:p.Lys5Ter", "domains": [{"db": "Pfam", "name": "b"}, {"db": "Pfam", "name": "a"}]},
    {"transcript_id": "t2", "gene_id": "g2", "consequence_terms": ["missense_variant"], "biotype": "protein_coding", "lof": ""},
    {"transcript_id": "t3", "gene_id": "g1", "consequence_terms": ["stop_gained"], "biotype": "protein_coding", "lof": ""},
    {"transcript_id": "t4", "gene_id": "g2", "consequence_terms": ["mystery"], "biotype": "protein_coding", "canonical": 1},
    {"transcript_id": "t5", "gene_id": "g2", "consequence_terms": ["missense_variant"], "biotype": "protein_coding"},
]


def test_sorting_and_computed_fields(spark):
    frame = vep(spark, TRANSCRIPTS).select(Q.sorted_transcripts(F.col("vep")).alias("t"))
    found = frame.first().t
    assert [t.transcript_id for t in found] == ["t3", "t4", "t2", "t5", "t1"]
    assert [t.transcript_rank for t in found] == [0, 1, 2, 3, 4]
    by_id = {t.transcript_id: t for t in found}
    assert (by_id["t1"].major_consequence, by_id["t1"].major_consequence_rank, by_id["t1"].category) == ("stop_gained", 3, "lof")
    assert by_id["t1"].domains == ["Pfam:b", "Pfam:a"] and by_id["t1"].hgvs == "p.Lys5Ter"
    assert (by_id["t4"].major_consequence, by_id["t4"].major_consequence_rank, by_id["t4"].category) == ("mystery", None, None)
    assert by_id["t2"].category == "missense"


def test_worst_sets_and_json(spark):
    frame = vep(spark, TRANSCRIPTS).withColumn("t", Q.sorted_transcripts(F.col("vep")))
    t = F.col("t")
    row = frame.select(
        Q.worst_transcript(t).alias("w"), Q.term_set(t).alias("terms"), Q.gene_set(t).alias("genes"),
        Q.gene_set(F.col("vep.transcript_consequences"), only_coding=True).alias("coding"),
        Q.domain_set(F.col("vep.transcript_consequences")).alias("domains"), Q.transcript_id_set(t).alias("ids"),
        Q.gene_consequence_json(t, Q.gene_set(t)).alias("gene_json"), Q.transcript_consequence_json(t).alias("transcript_json"),
    ).first()
    assert row.w.transcript_id == "t3" and list(row.w.asDict()) == Q.WORST_FIELDS + Q.WORST_CODING_FIELDS
    assert row.terms == ["intron_variant", "missense_variant", "mystery", "stop_gained"]
    assert row.genes == ["g1", "g2"] == row.coding
    assert row.domains == ["Pfam:a", "Pfam:b"]
    assert row.ids == ["t1", "t2", "t3", "t4", "t5"]
    assert row.gene_json == '{"g1":"stop_gained","g2":"mystery"}'
    assert row.transcript_json.startswith('{"t3": "stop_gained","t4": "mystery",')


def test_empty_and_missing_transcripts(spark):
    empty = vep(spark, []).withColumn("t", Q.sorted_transcripts(F.col("vep")))
    row = empty.select(Q.worst_transcript(F.col("t")).alias("w"), Q.gene_consequence_json(F.col("t"), Q.gene_set(F.col("t"))).alias("j"),
                       lof.variant_flags(F.col("t")).alias("f")).first()
    assert row.j == "{}" and tuple(row.f) == (False, False)
    assert row.w is None or row.w.transcript_id is None
    missing = spark.range(1).select(F.from_json(F.lit(None).cast("string"), VEP_SCHEMA).alias("vep"))
    assert missing.select(Q.sorted_transcripts(F.col("vep")).alias("t")).first().t is None


def test_fewer_fields(spark):
    t = vep(spark, TRANSCRIPTS).select(Q.sorted_transcripts(F.col("vep"), coding_annotations=False, omit=None).alias("t"))
    names_ = t.schema["t"].dataType.elementType.names
    assert "hgvsp" not in names_ and "domains" not in names_ and "lof" not in names_
    assert len(t.first().t) == 6
    worst = t.select(Q.worst_transcript(F.col("t"), coding_annotations=False).alias("w"))
    assert worst.schema["w"].dataType.names == Q.WORST_FIELDS


@pytest.mark.parametrize(
    ("fields", "expected"),
    [
        ({"hgvsc": "t:c.1A>G"}, "c.1A>G"),
        ({"hgvsc": "t:c.1A>G", "hgvsp": "p:p.Lys1Arg"}, "p.Lys1Arg"),
        ({"hgvsc": "t:c.1A>G", "hgvsp": "p:p.Lys1Arg", "consequence_terms": ["splice_region_variant"]}, "c.1A>G"),
        ({"hgvsp": "p:p.Lys7=", "amino_acids": "K", "protein_start": 7}, "p.Lys7Lys"),
        ({"hgvsp": "p:p.Lys7%3D", "amino_acids": "*", "protein_start": 7}, "p.Ter7Ter"),
        ({"hgvsp": "p:p.Lys7%3D", "amino_acids": "K/K", "protein_start": 7}, None),
        ({}, None),
    ],
)
def test_display_name(spark, fields, expected):
    base = {"transcript_id": "t", "consequence_terms": ["missense_variant"]}
    found = vep(spark, [base | fields]).select(Q.sorted_transcripts(F.col("vep")).alias("t")).first().t
    assert found[0].hgvs == expected


def test_flags_on_transcripts(spark):
    row = transcript_fields(vep(spark, TRANSCRIPTS)).first()
    by_id = {t.transcript_id: t.flags for t in row.sortedTranscriptConsequences}
    assert by_id["t3"].nc_transcript is True and by_id["t2"].nc_transcript is False
    assert by_id["t1"].nc_transcript is False and by_id["t1"].lc_lof_in_gene is False
    assert tuple(row.flags) == (False, None)


@pytest.mark.parametrize(
    ("contig", "position", "expected"),
    [("1", 55505463, 1055505463), ("X", 18525192, 23018525192), ("chr2", 166847734, 2166847734),
     ("chrY", 5, 24000000005), ("chrM", 7, 25000000007), ("MT", 7, 25000000007), ("chrUn_1", 7, None)],
)
def test_xpos(evaluate, contig, position, expected):
    assert evaluate(I.xpos(F.lit(contig), F.lit(position))) == (expected,)


def test_ids(evaluate):
    args = F.lit("chr1"), F.lit(10), F.lit("AT"), F.lit("A")
    assert evaluate(I.variant_id(*args), I.variant_id(*args, 4), I.variant_letter(*args[2:]), I.end_position(args[1], args[2])) == (
        "1-10-AT-A", "1-10", "D", 12)
    assert evaluate(I.variant_id(F.lit("chr1"), F.lit(10), F.lit(None).cast("string"), F.lit("A"))) == (None,)
    alleles = F.array(F.lit("A"), F.lit("T"), F.lit("C"))
    assert evaluate(I.original_alternates(args[0], args[1], alleles), I.original_alternates(args[0], args[1], F.slice(alleles, 1, 2))) == (
        ["chr1-10-A-T", "chr1-10-A-C"], None)


def test_clinical(evaluate):
    status = clinical.status_text(F.expr("array('_single_submitter', 'criteria_provided', 'criteria_provided')"))
    assert evaluate(status, clinical.gold_stars(status), clinical.gold_stars(F.lit("other"))) == (
        "criteria_provided,_single_submitter", 1, None)


@pytest.mark.parametrize(
    ("name", "encoded"),
    [("a.b", "a_$dot$_b"), ("_x", "$_x"), ("$x", "$$$x"), ("*", "$_$star$_"), ("a$b", "a$$b"), ("-1", "$-1"),
     ("(a[b]{c},#)", "$_$lp$_a_$lsb$_b_$rsb$__$lcb$_c_$rcb$__$comma$__$hash$__$rp$_"), ("plain", "plain"), ("", ""), ("$dot$", "$$$dot$$")],
)
def test_names(evaluate, name, encoded):
    column = names.encode_name(F.lit(name))
    assert evaluate(column, names.decode_name(column)) == (encoded, name)
    assert names.encoded_column_name(name, dot=None) == encoded
    assert names.encoded_column_name("a.b") == "a_b"
