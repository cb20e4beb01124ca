import pytest
from pyspark.sql import functions as F

from locusmill.functions import alleles as A
from locusmill.operators import cohort as C


@pytest.mark.parametrize(
    ("ref", "alt", "expected"),
    [
        ("A", "G", (100, "A", "G")),
        ("AT", "A", (100, "AT", "A")),
        ("A", "AT", (100, "A", "AT")),
        ("CAT", "CGT", (101, "A", "G")),
        ("AT", "GT", (100, "A", "G")),
        ("GATTACA", "GACA", (100, "GATT", "G")),
        ("ACAC", "AC", (100, "ACA", "A")),
        ("CCGG", "CTTG", (101, "CG", "TT")),
        ("AC", "AC", (100, "A", "A")),
        ("TTT", "*", (100, "TTT", "*")),
        ("CAT", "<DEL>", (100, "CAT", "<DEL>")),
        ("A" * 300 + "C" + "T" * 300, "A" * 300 + "G" + "T" * 300, (400, "C", "G")),
    ],
)
def test_minimal(evaluate, ref, alt, expected):
    (row,) = evaluate(A.minimal(F.lit(100), F.lit(ref), F.lit(alt)))
    assert tuple(row) == expected


@pytest.mark.parametrize(
    ("ref", "alt", "kind", "fine"),
    [
        ("A", "G", "snv", "SNP"),
        ("A", "A", "complex", "Unknown"),
        ("ACT", "AGT", "snv", "SNP"),
        ("AC", "GT", "complex", "MNP"),
        ("A", "AT", "ins", "Insertion"),
        ("CAT", "CGGAT", "ins", "Insertion"),
        ("AT", "A", "del", "Deletion"),
        ("CAT", "GA", "complex", "Complex"),
        ("A", "*", "complex", "Star"),
        ("A", "<DUP>", "complex", "Symbolic"),
    ],
)
def test_types(evaluate, ref, alt, kind, fine):
    assert evaluate(A.allele_type(F.lit(ref), F.lit(alt)), A.allele_class(F.lit(ref), F.lit(alt))) == (kind, fine)


@pytest.mark.parametrize(
    ("alleles", "kind", "count", "star"),
    [
        (["A", "G"], "snv", 1, False),
        (["A", "G", "T"], "multi-snv", 2, False),
        (["A", "AT"], "indel", 1, False),
        (["AT", "A", "ATT"], "multi-indel", 2, False),
        (["AT", "A", "GT"], "mixed", 2, False),
        (["A", "*", "C"], "snv", 1, True),
        (["A", "*"], "snv", 0, True),
    ],
)
def test_site_summary(evaluate, alleles, kind, count, star):
    (row,) = evaluate(A.site_allele_data(F.col("alleles")), alleles=F.array(*map(F.lit, alleles)))
    assert (row.variant_type, row.n_alt_alleles, row.has_star) == (kind, count, star)
    assert row.nonsplit_alleles == alleles


def test_split_sites_keeps_other_fields_and_drops_star(spark):
    sites = spark.createDataFrame(
        [(1, "chr1", 100, ["CAT", "CGT", "*", "C"], "x"), (2, "chr1", 200, ["A", "*"], "y"), (3, "chr1", 300, ["A", "T"], "z")],
        "site_id int, contig string, position int, alleles array<string>, note string",
    )
    rows = {(r.site_id, r.a_index): r for r in C.split_sites(sites).collect()}
    assert set(rows) == {(1, 1), (1, 3), (3, 1)}
    assert (rows[1, 1].position, rows[1, 1].ref, rows[1, 1].alt, rows[1, 1].was_split) == (101, "A", "G", True)
    assert (rows[1, 3].position, rows[1, 3].alleles) == (100, ["CAT", "C"])
    assert rows[3, 1].was_split is False and rows[3, 1].note == "z"
