import pytest
from pyspark.sql import functions as F

from locusmill.functions import genotypes as G
from locusmill.operators import cohort as C


def gt(text):
    return G.parse_call(F.lit(text))


@pytest.mark.parametrize(
    ("text", "haploid", "het", "het_ref", "non_ref", "ploidy"),
    [
        ("0/0", False, False, False, False, 2),
        ("0/1", False, True, True, True, 2),
        ("1|0", False, True, True, True, 2),
        ("1/2", False, True, False, True, 2),
        ("1/1", False, False, False, True, 2),
        ("0", True, False, False, False, 1),
        ("1", True, False, False, True, 1),
        ("./.", None, None, None, None, None),
        ("./1", None, None, None, None, None),
        (".", None, None, None, None, None),
    ],
)
def test_predicates(evaluate, text, haploid, het, het_ref, non_ref, ploidy):
    call = gt(text)
    found = evaluate(G.is_haploid(call), G.is_het(call), G.is_het_ref(call), G.is_non_ref(call), G.ploidy(call))
    assert found == (haploid, het, het_ref, non_ref, ploidy)


@pytest.mark.parametrize(
    ("text", "allele", "expected"),
    [("1/2", 1, "0/1"), ("1/2", 2, "0/1"), ("1|2", 1, "1|0"), ("1|2", 2, "0|1"), ("2/2", 1, "0/0"),
     ("2/2", 2, "1/1"), ("2", 2, "1"), ("2", 1, "0"), ("./.", 1, None), ("0/2", 2, "0/1")],
)
def test_downcode(evaluate, text, allele, expected):
    assert evaluate(G.format_call(G.downcode(gt(text), F.lit(allele)))) == (expected,)


def test_downcode_depths(evaluate):
    ad = F.expr("array(10, 5, NULL)")
    assert evaluate(
        G.downcode_depths(ad, F.lit(1)), G.downcode_depths(ad, F.lit(2)), G.downcode_depths(F.expr("cast(NULL AS array<int>)"), F.lit(1))
    ) == ([10, 5], [None, None], None)


@pytest.mark.parametrize(
    ("text", "gq", "dp", "ad", "expected"),
    [
        ("0/0", 20, 10, [10, 0], True),
        ("0/0", 19, 10, [10, 0], False),
        ("0/0", 20, 9, [9, 0], False),
        ("0/1", 30, 10, [8, 2], True),
        ("0/1", 30, 10, [9, 1], False),
        ("1/2", 30, 10, [1, 9], False),
        ("1/2", 30, 10, [5, 5], True),
        ("1", 20, 10, [0, 10], True),
        ("1/1", 99, 0, [0, 0], False),
        ("./.", 30, 20, [1, 1], None),
        ("./.", 10, 20, [1, 1], False),
        ("0/1", 30, 20, None, None),
        ("0/1", 10, 20, None, False),
        ("0/0", None, 20, [1, 1], None),
    ],
)
def test_high_quality(evaluate, text, gq, dp, ad, expected):
    depths = F.array(*map(F.lit, ad)) if ad else F.expr("cast(NULL AS array<int>)")
    flag = G.high_quality(gt(text), F.lit(gq).cast("int"), F.lit(dp).cast("int"), depths)
    assert evaluate(flag) == (expected,)


def test_split_entries_leaves_quality_alone(spark):
    entries = spark.createDataFrame(
        [(1, ["A", "G", "T"], "s", "1/2", [3, 4, 5], 12, 50, [1, 2])],
        "site_id int, alleles array<string>, s string, t string, AD array<int>, DP int, GQ int, PL array<int>",
    ).withColumn("GT", G.parse_call(F.col("t")))
    nulled = C.drop_likelihoods(entries)
    assert dict(nulled.dtypes)["PL"] == "array<int>" and nulled.first().PL is None
    rows = {r.a_index: r for r in C.split_entries(nulled).collect()}
    assert rows[1].AD == [8, 4] and rows[2].AD == [7, 5]
    assert {(r.DP, r.GQ) for r in rows.values()} == {(12, 50)}
    assert tuple(rows[1].GT) == (0, 1, False)


def test_likelihoods_are_downcoded_by_copies(evaluate):
    """0/0 0/1 1/1 0/2 1/2 2/2 of three alleles; two missing values, and a site of two alleles."""
    pl = lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<int>")
    down = lambda p, n, k: G.downcode_likelihoods(p, F.lit(n), F.lit(k))
    three = pl(40, 30, 50, 0, 10, 20)
    nothing = F.lit(None).cast("array<int>")
    assert evaluate(
        down(three, 3, 1), down(three, 3, 2), down(pl(5, None, None, 7, None, None), 3, 1), down(pl(9, 0, 3), 2, 1), down(nothing, 3, 1),
    ) == ([0, 10, 50], [30, 0, 20], [5, None, None], [9, 0, 3], None)
    assert evaluate(
        G.quality_from_likelihoods(pl(0, 10, 50)), G.quality_from_likelihoods(pl(7, None, 4)), G.quality_from_likelihoods(pl(None, 3)), G.quality_from_likelihoods(nothing),
    ) == (10, 3, None, None)


def test_split_takes_quality_from_likelihoods_only_when_asked(spark):
    rows = [(1, ["A", "C", "G"], "0/2", [40, 30, 50, 0, 10, 20], 99), (2, ["A", "C"], "0/1", None, 7)]
    frame = spark.createDataFrame(rows, "site_id int, alleles array<string>, t string, PL array<int>, GQ int").withColumn("GT", G.parse_call(F.col("t")))
    entries = frame.withColumn("AD", F.lit(None).cast("array<int>"))
    found = {(r.site_id, r.a_index): (r.PL, r.GQ) for r in C.split_entries(entries, likelihoods=True).collect()}
    assert found == {(1, 1): ([0, 10, 50], 10), (1, 2): ([30, 0, 20], 20), (2, 1): (None, 7)}
    assert {r.GQ for r in C.split_entries(entries).collect()} == {99, 7} and "PL" not in C.split_entries(entries).columns
