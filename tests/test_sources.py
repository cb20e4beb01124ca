import gzip
import json
import random
import re
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from locusmill.functions.genotypes import format_call
from locusmill.operators.cohort import Cohort, subset_cohort
from locusmill.operators.lookups import in_range, within_intervals
from locusmill.plans.cohort import annotate_consequences
from locusmill.sources import tables, text, vcf

HEADER = [
    "##fileformat=VCFv4.2",
    "##fileDate=2024-01-15",
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="depth, total">',
    '##INFO=<ID=AF,Number=A,Type=Float,Description="f">',
    '##INFO=<ID=DB,Number=0,Type=Flag,Description="flag">',
    '##INFO=<ID=CLNSIG,Number=.,Type=String,Description="s">',
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2",
]
LINES = [
    "1\t100\trs1\tA\tG,*\t50.5\tPASS\tDP=7;AF=0.5,.;DB;DP=9\tGT:AD:DP:GQ:PL\t0/1:3,.,1:4:50:0,1,2\t./.",
    "chr2\t200\t.\tAT\tA\t.\tq10;s50\tCLNSIG=Benign,_other\tGT:GQ\t1|0:.\t1:20",
    "chr2\t300\t.\tA\t<DEL>\t1\t.\t.\tDP:GT\t5:0/0\t.:1/1",
    "weird\t5\t.\tA\tC\t1\tPASS\tDP=1;MONOALLELIC\tGT\t0/0\t0/0",
    "chrY\t999999999\t.\tA\tC\t1\tPASS\tDP=.\tGT\t0/0\t0/0",
]


@pytest.fixture
def call_set(spark, tmp_path):
    path = tmp_path / "calls.vcf"
    path.write_text("\n".join(HEADER + LINES) + "\n")
    return str(path)


def test_cohort(spark, call_set):
    lines = text.read_lines(spark, call_set)
    cohort = vcf.read_cohort(lines, vcf.read_header(spark, call_set), build="38")
    sites = {r.position: r for r in cohort.sites.collect()}
    first = sites[100]
    assert (first.contig, first.rsid, first.alleles, first.qual, first.filters) == ("chr1", "rs1", ["A", "G", "*"], 50.5, [])
    assert (first.info.DP, first.info.AF, first.info.DB, first.info.CLNSIG) == (7, [0.5, None], True, None)
    assert (sites[200].qual, sites[200].filters, sites[200].info.CLNSIG) == (None, ["q10", "s50"], ["Benign", "_other"])
    assert (sites[300].filters, sites[300].info.DB, sites[300].info.DP) == (None, False, None)
    assert sites[5].contig == "weird"
    entries = {
        (r.position, r.s): r
        for r in cohort.entries.join(cohort.sites.select("site_id", "position"), "site_id")
        .withColumn("gt", format_call(F.col("GT")))
        .collect()
    }
    assert len(entries) == 10
    one = entries[100, "S1"]
    assert (one.gt, one.AD, one.DP, one.GQ, one.PL) == ("0/1", [3, None, 1], 4, 50, [0, 1, 2])
    assert (entries[100, "S2"].gt, entries[100, "S2"].AD) == (None, None)
    assert (entries[200, "S1"].gt, entries[200, "S1"].GQ, entries[200, "S2"].gt) == ("1|0", None, "1")
    assert (entries[300, "S1"].gt, entries[300, "S1"].DP, entries[300, "S2"].DP) == ("0/0", 5, None)
    assert [r.s for r in cohort.samples.orderBy("s").collect()] == ["S1", "S2"]


def test_sites_only_invalid_loci_and_filter(spark, call_set):
    lines = text.read_lines(spark, call_set, drop_matching="MONOALLELIC")
    assert lines.where("value LIKE '%MONO%'").count() == 0
    sites = vcf.read_sites(lines, build="38", skip_invalid_loci=True)
    assert sorted(r.position for r in sites.collect()) == [100, 200, 300]


def test_identical_lines_stay_two_sites(spark, tmp_path):
    (tmp_path / "twice.vcf").write_text("\n".join(HEADER + [LINES[0], LINES[0]]) + "\n")
    cohort = vcf.read_cohort(text.read_lines(spark, str(tmp_path / "twice.vcf")))
    assert cohort.sites.count() == 2 and cohort.entries.select("site_id").distinct().count() == 2


def test_differing_headers_are_an_error(spark, tmp_path):
    for name, samples in (("a", "S1\tS2"), ("b", "S2\tS1")):
        (tmp_path / f"{name}.vcf").write_text("\n".join([*HEADER[:-1], HEADER[-1].replace("S1\tS2", samples)]) + "\n")
    lines = text.read_lines(spark, str(tmp_path))
    with pytest.raises(Exception, match="different samples"):
        vcf.sample_rows(lines).collect()


DICTIONARY = [
    "@HD\tVN:1.6", "@SQ\tSN:chr1\tLN:1000", "@SQ\tAS:x\tSN:chr1_KI270706v1_random\tLN:500\tM5:y", "chrM\t16569\t5\t60\t61",
    "##contig=<ID=HLA-A*01:01:01:01,length=300>", "##contig=<assembly=b,ID=chrEBV>", "#CHROM\tPOS", "chr1\t5\t.\tA\tT", "@SQ\tSN:chr1\tLN:1000",
]


def test_contigs_by_dictionary(spark):
    dictionary = vcf.sequence_dictionary(spark.createDataFrame([(x,) for x in DICTIONARY], "value string"))
    found = {r.contig: r.length for r in dictionary.collect()}
    assert found == {"chr1": 1000, "chr1_KI270706v1_random": 500, "chrM": 16569, "HLA-A*01:01:01:01": 300, "chrEBV": None}
    asked = [
        ("1", 1000, "chr1", True), ("chr1", 1001, "chr1", False), ("chr1", 0, "chr1", False), ("1_KI270706v1_random", 500, "chr1_KI270706v1_random", True),
        ("chr99_X1v1_alt", 5, "chr99_X1v1_alt", False), ("M", 16569, "chrM", True), ("MT", 1, "MT", False), ("EBV", 10**9, "chrEBV", True),
        ("chrHLA-A*01:01:01:01", 300, "HLA-A*01:01:01:01", True), (None, 5, None, False), ("chr1", None, "chr1", False),
    ]
    rows = spark.createDataFrame([(i, *a[:2], "x") for i, a in enumerate(asked)], "i int, contig string, position int, name string")
    got = vcf.recode_contigs(rows, vcf.contig_names(dictionary), "fits")
    assert got.columns == ["i", "contig", "position", "name", "fits"]
    assert [tuple(r) for r in got.orderBy("i").select("contig", "fits").collect()] == [a[2:] for a in asked]
    with pytest.raises(Exception, match="several lengths: chr1"):
        vcf.sequence_dictionary(spark.createDataFrame([("@SQ\tSN:chr1\tLN:1",), ("chr1\t2\t0\t60\t61",)], "value string")).collect()


def test_builds_without_a_dictionary(spark):
    def names(build):
        return {r.name: r.contig for r in vcf.contig_names(vcf.build_dictionary(spark, build)).collect()}

    assert names("38")["1"] == "chr1" and names("38")["M"] == "chrM" and "MT" not in names("38")
    assert names("37")["chrX"] == "X" and names("37")["chrMT"] == "MT" and "chrM" not in names("37")
    with pytest.raises(ValueError, match="build"):
        vcf.build_dictionary(spark, "19")


def test_release_dates(spark, tmp_path):
    (tmp_path / "a.vcf").write_text("##x=1\n##fileDate=2024-05-01\n##fileDate=2020-01-01\n1\t2\n")
    with gzip.open(tmp_path / "b.vcf.gz", "wt") as f:
        f.write("##x=1\n1\t2\n")
    found = {r.path[-1]: r.release_date for r in vcf.release_dates(vcf.read_header(spark, str(tmp_path))).collect()}
    assert found == {"f": "2024-05-01", "z": None}


def block(content: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(content) + packer.flush()
    size = len(body) + 25
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x06\x00BC\x02\x00" + struct.pack("<H", size)
    return head + body + struct.pack("<II", zlib.crc32(content), len(content))


@pytest.mark.parametrize("block_size", [7, 1000, 30_000])
@pytest.mark.parametrize("range_bytes", [200, 5_000, 1 << 20])
def test_block_gzip_ranges_read_every_line_once(spark, tmp_path, block_size, range_bytes):
    draw = random.Random(block_size)
    lines = [f"{i}\t" + "".join(draw.choice("ACGT") for _ in range(draw.choice([0, 5, 400]))) for i in range(300)]
    content = ("\n".join(lines) + "\n").encode()
    path = tmp_path / "x.vcf.bgz"
    path.write_bytes(b"".join(block(content[i : i + block_size]) for i in range(0, len(content), block_size)) + block(b""))
    found = text.read_lines(spark, str(path), block_gzip=True, range_bytes=range_bytes)
    assert sorted(r.value for r in found.collect()) == sorted(lines)


def test_block_gzip_cohort(spark, tmp_path):
    content = ("\n".join(HEADER + LINES[:3]) + "\n").encode()
    (tmp_path / "x.vcf.gz").write_bytes(b"".join(block(content[i : i + 90]) for i in range(0, len(content), 90)) + block(b""))
    path = str(tmp_path / "x.vcf.gz")
    cohort = vcf.read_cohort(text.read_lines(spark, path, block_gzip=True), vcf.read_header(spark, path, block_gzip=True))
    assert cohort.sites.count() == 3 and cohort.entries.count() == 6


def test_tables(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text("ID\twhole\tlarge\tnumber\tflag\tmixed\tempty\nT1\t1\t3000000000\t1.5\ttrue\t1\tNA\nT2\tNA\t2\t1e-3\tFalse\tx\tNA\n")
    assert {t for _, t in tables.read_table(spark, str(path)).dtypes} == {"string"}
    typed = tables.read_table(spark, str(path), impute=True)
    assert dict(typed.dtypes) == {"ID": "string", "whole": "int", "large": "bigint", "number": "double", "flag": "boolean",
                                  "mixed": "string", "empty": "int"} or dict(typed.dtypes)["empty"] == "string"
    rows = {r.ID: r for r in typed.collect()}
    assert (rows["T1"].large, rows["T2"].number, rows["T2"].flag, rows["T2"].whole) == (3_000_000_000, 0.001, False, None)


def test_matrix(spark, tmp_path):
    path = tmp_path / "m.tsv"
    path.write_text("transcript_id\tgene_id\tA\tB\nt1\tg1\t1.5\tNA\nt2\tg1\t0\t2\n")
    rows = tables.read_matrix(text.read_lines(spark, str(path)), ["transcript_id", "gene_id"])
    assert sorted((r.transcript_id, r.col_id, r.x) for r in rows.where("x IS NOT NULL").collect()) == [
        ("t1", "A", 1.5), ("t2", "A", 0.0), ("t2", "B", 2.0)]
    assert rows.count() == 4 and dict(rows.dtypes)["x"] == "float"


def test_intervals_match_a_plain_range_join(spark, tmp_path):
    draw = random.Random(1)
    path = tmp_path / "i.interval_list"
    spans = [(f"chr{draw.randint(1, 2)}", s, s + draw.choice([0, 3, 50, 9000])) for s in (draw.randint(1, 40_000) for _ in range(60))]
    spans += [("chr1", 100, 200), ("chr1", 150, 160), ("chr1", 150, 160), ("chr3", 4095, 4096)]
    path.write_text("@HD\tVN:1\n@SQ\tSN:chr1\n" + "".join(f"{c}\t{s}\t{e}\t+\tx\n" for c, s, e in spans))
    intervals = tables.parse_intervals(text.read_lines(spark, str(path)))
    points = [(f"chr{draw.randint(1, 3)}", draw.randint(1, 50_000)) for _ in range(3000)]
    points += [("chr3", p) for p in (4094, 4095, 4096, 4097)] + [("chr1", 100), ("chr1", 100), ("chr1", 99)]
    sites = spark.createDataFrame(points, "contig string, position int")
    expected = sorted(p for p in points if any(c == p[0] and s <= p[1] <= e for c, s, e in spans))
    for width in (16, 4096):
        assert sorted(map(tuple, within_intervals(sites, intervals, width).collect())) == expected


@pytest.mark.parametrize(
    ("range_text", "kept"), [("chr1:10-20", [10, 19]), ("chr1", [9, 10, 19, 20, 2000]), ("chr1:1K-1M", [2000]),
                             ("chr1:start-10", [9]), ("chr1:20-end", [20, 2000]), ("chr1:1,000-3,000", [2000])])
def test_range(spark, range_text, kept):
    frame = spark.createDataFrame([("chr1", p) for p in (9, 10, 19, 20, 2000)] + [("chr2", 10)], "contig string, position int")
    assert sorted(r.position for r in frame.where(in_range(range_text)).collect()) == kept
    with pytest.raises(ValueError):
        in_range("chr1:x-y")


def test_range_filter_reaches_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "s")
    spark.createDataFrame([("chr1", 5, "x")], "contig string, position int, note string").write.parquet(path)
    spark.read.parquet(path).where(in_range("chr1:1-10")).select("position").explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "EqualTo(contig,chr1)" in pushed and "LessThan(position,10)" in pushed
    assert "note" not in plan


def test_vep_schema_reads_annotator_lines(spark):
    line = ('{"input":"chr1\\t100\\t.\\tA\\tG\\t.\\t.","most_severe_consequence":"stop_gained","colocated_variants":[{"id":"rs1","pubmed":[1]}],'
            '"transcript_consequences":[{"gene_id":"g","consequence_terms":["stop_gained"],"sift_score":0.5}]}')
    row = tables.vep_by_variant(spark.createDataFrame([(line,), ("not json",)], "value string")).where("contig IS NOT NULL").first()
    assert (row.contig, row.position, row.ref, row.alt) == ("chr1", 100, "A", "G")
    assert row.vep.transcript_consequences[0].sift_score == 0.5 and row.vep.colocated_variants[0].pubmed == [1]


def nodes_above(plan, leaf):
    """Names of the nodes between the root of a plan and its one leaf of a name."""
    lines = [(re.search(r"[A-Za-z]", line).start(), line) for line in plan.splitlines() if re.search(r"[A-Za-z]", line)]
    (at,) = [i for i, (_, line) in enumerate(lines) if leaf in line]
    depth, above = lines[at][0], []
    for d, line in reversed(lines[:at]):
        if d < depth:
            depth = d
            above.append(line[d:])
    return above


HEAD_A = ["##fileformat=VCFv4.2", '##INFO=<ID=DP,Number=1,Type=Integer,Description="d">', "##contig=<ID=chrUn_X1v1,length=500>"]
COLUMNS = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"


def test_headers_of_all_files(spark, tmp_path):
    (tmp_path / "a.vcf").write_text("\n".join([*HEAD_A, COLUMNS + "S1\tS2", "chr1\t5\t.\tA\tT\t.\tPASS\tDP=3\tGT\t0/1\t0/0"]) + "\n")
    more = '##INFO=<ID=XX,Number=0,Type=Flag,Description="x">'
    (tmp_path / "b.vcf").write_text("\n".join([*HEAD_A, more, COLUMNS + "S1\tS2", "chr1\t9\t.\tA\tT\t.\tPASS\tXX\tGT\t0/0\t0/1"]) + "\n")
    header = vcf.read_header(spark, str(tmp_path))
    assert vcf.info_types(header) == {"DP": "int", "XX": "boolean"}
    assert [tuple(r) for r in vcf.sequence_dictionary(header).collect()] == [("chrUn_X1v1", 500)]
    cohort = vcf.read_cohort(text.read_lines(spark, str(tmp_path)), header)
    placed = cohort.sites.join(cohort.entries, "site_id").where("GT.a1 = 1").select("position", "s")
    assert sorted(map(tuple, placed.collect())) == [(5, "S1"), (9, "S2")]
    (tmp_path / "c.vcf").write_text("\n".join([*HEAD_A, COLUMNS + "S2\tS1", "chr1\t7\t.\tA\tT\t.\tPASS\t.\tGT\t0/1\t0/0"]) + "\n")
    with pytest.raises(Exception, match="different samples"):
        vcf.sample_rows(vcf.read_header(spark, str(tmp_path))).collect()


def test_site_ids_do_not_depend_on_the_order_of_partitions(spark):
    lines = [f"chr1\t{i}\t.\tA\tT\t.\tPASS\t.\tGT\t0/{i % 2}" for i in range(1, 200)]
    frame = spark.createDataFrame([(x, "f") for x in lines], "value string, path string")
    ids = lambda f: {r.position: r.site_id for r in vcf.parse_records(f).select("position", "site_id").collect()}
    found = ids(frame.repartition(7))
    assert len(set(found.values())) == 199 and found == ids(frame.orderBy(F.desc("value")).repartition(3))
    entries = vcf.entry_rows(vcf.parse_records(frame.repartition(5)), samples=[0])
    assert {(r.site_id, r.GT.a1) for r in entries.collect()} == {(i, p % 2) for p, i in found.items()}


def test_lines_filtered_before_entries_equal_a_filtered_cohort(spark, tmp_path):
    """Intervals and requested samples in the reader against the same on the whole cohort."""
    draw = random.Random(2)
    calls = ["0/0", "0|1", "1/1", "./.", "./1", ".", "1", "0", "2/0", "10/0", "00/0"]
    lines = [
        f"chr{draw.randint(1, 2)}\t{draw.randint(1, 500)}\t.\tA\tC,G\t.\tPASS\t.\t{draw.choice(['GT', 'DP:GT', 'DP'])}\t"
        + "\t".join(draw.choice(["3:", ""]) + draw.choice(calls) for _ in range(4)) for _ in range(300)
    ]
    (tmp_path / "c.vcf").write_text("\n".join([COLUMNS + "S1\tS2\tS3\tS4", *lines]) + "\n")
    path = str(tmp_path / "c.vcf")
    intervals = spark.createDataFrame([("chr1", 1, 250), ("chr2", 100, 110)], "contig string, start int, end int")
    requested = spark.createDataFrame([("S3",), ("S1",), ("S1",), ("S9",)], "s string")
    read = lambda **k: vcf.read_cohort(text.read_lines(spark, path), vcf.read_header(spark, path), **k)
    whole = read()
    inside = within_intervals(whole.sites, intervals)
    want = subset_cohort(Cohort(inside, whole.entries.join(inside.select("site_id"), "site_id", "left_semi"), whole.samples), requested)
    got = read(intervals=intervals, requested=requested, carry=("contig",))
    both = lambda c: [sorted(map(str, f.select(sorted(f.columns)).collect())) for f in (c.sites, c.entries.select("site_id", "s", "alleles", "GT", "DP"), c.samples)]
    assert both(got) == both(want) and got.sites.count() > 20
    above = nodes_above(got.entries._jdf.queryExecution().executedPlan().toString(), "line_ranges")
    assert any(n.startswith("Generate") for n in above) and not any(n.startswith("Exchange") for n in above)


def test_malformed_lines_and_annotator_rejects(spark):
    lines = spark.createDataFrame([("chr1\tx\t.\tA\tT\t.\t.\t.",), ("chr1\t5",), ("chr1\t5\t.\tA\tT\t.\t.\t.",)], "value string")
    assert sorted(r.reason for r in vcf.malformed_lines(lines).collect()) == ["columns", "position"]
    vep = spark.createDataFrame([('{"input": "1\\t5\\t.\\tA\\tT,G"}',), ("no json",), ("{}",)], "value string")
    assert sorted(r.alt for r in tables.vep_by_variant(vep).collect()) == ["G", "T"]
    assert tables.vep_rejects(vep).count() == 2


def test_matrix_means_of_ragged_and_odd_lines(spark):
    rows = ["t\tg\tA\tB\tC\tD", "t1\tg1\t1\tNA\t3\tx", "t2\tg1\t2", "t3\tg1", "", "t1\tg1\t5\t6\t7\t8"]
    lines = spark.createDataFrame([(x,) for x in rows], "value string")
    assert [tuple(r) for r in tables.matrix_columns(lines, ["t", "g"]).orderBy("place").collect()] == list(enumerate("ABCD"))
    means = tables.matrix_means(lines, ["t", "g"], {"one": [0, 1, 2], "two": [3], "none": [9]})
    assert sorted((r.t, r.one, r.two, r.none) for r in means.collect()) == [("t1", 2.0, None, None), ("t1", 6.0, 8.0, None), ("t2", 2.0, None, None), ("t3", None, None, None)]
    twice = lines.union(spark.createDataFrame([("t\tg\tB\tA",)], "value string"))
    with pytest.raises(Exception, match="different headers"):
        tables.matrix_columns(twice, ["t", "g"]).collect()


def vep_line(asked, transcripts, worst="intron_variant", **others):
    return json.dumps({"input": asked, "most_severe_consequence": worst, "transcript_consequences": transcripts, **others})


def test_annotator_output_is_dealt_to_alleles(spark):
    two = vep_line(
        "chr1\t100\t.\tAT\tA,GT,*\t.\t.",
        [
            {"transcript_id": "a", "allele_num": 1, "consequence_terms": ["intron_variant", "stop_gained"]},
            {"transcript_id": "b", "allele_num": 2, "consequence_terms": ["synonymous_variant"]},
            {"transcript_id": "c", "consequence_terms": ["upstream_gene_variant"]},
            {"transcript_id": "d", "allele_num": 3, "consequence_terms": ["frameshift_variant"]},
        ],
        "frameshift_variant",
        intergenic_consequences=[{"allele_num": 2, "consequence_terms": ["missense_variant"]}],
    )
    one = vep_line("chr2\t5\t.\tCAA\tCA\t.\t.", [{"transcript_id": "e", "allele_num": 1, "consequence_terms": ["intron_variant"]}], "its own word")
    none = vep_line("chr3\t7\t.\tG\tC,T\t.\t.", None)
    lines = spark.createDataFrame([(x,) for x in (two, two, one, none, "no json", "{}")], "value string")
    found = {
        (r.contig, r.position, r.ref, r.alt): (r.vep.most_severe_consequence, [t.transcript_id for t in r.vep.transcript_consequences or []])
        for r in tables.vep_by_variant(lines).collect()
    }
    assert found == {
        ("chr1", 100, "AT", "A"): ("stop_gained", ["a", "c"]), ("chr1", 100, "A", "G"): ("missense_variant", ["b", "c"]),
        ("chr2", 5, "CA", "C"): ("its own word", ["e"]), ("chr3", 7, "G", "C"): (None, []), ("chr3", 7, "G", "T"): (None, []),
    }
    assert tables.vep_by_variant(lines).count() == 5 and tables.vep_rejects(lines).count() == 2
    # joined as lines, only what is asked for is parsed, and the row count stays
    variants = spark.createDataFrame([("chr1", 100, "A", "G", 1), ("chr1", 100, "A", "G", 2), ("chr9", 1, "A", "G", 3)], "contig string, position int, ref string, alt string, k int")
    rows = annotate_consequences(variants, lines).orderBy("k").collect()
    assert [(r.k, r.vep and r.vep.most_severe_consequence) for r in rows] == [(1, "missense_variant"), (2, "missense_variant"), (3, None)]


def test_of_several_lines_for_a_variant_one_is_taken_whole(spark):
    lines = [vep_line("chr1\t5\t.\tA\tT", [{"transcript_id": f"t{i}", "consequence_terms": ["intron_variant"]}], f"w{i}") for i in range(6)]
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    found = [{(r.vep.most_severe_consequence, r.vep.transcript_consequences[0].transcript_id) for r in tables.vep_by_variant(f).collect()} for f in (frame, frame.repartition(5))]
    assert found[0] == found[1] and len(found[0]) == 1 and [x[0][1:] == x[1][1:] for x in found[0]] == [True]
