import pytest
from pyspark.sql import functions as F

from locusmill.functions import genotypes as G
from locusmill.operators import frequencies as FQ
from locusmill.operators import histograms as H
from locusmill.operators.statistics import variant_statistics


@pytest.fixture
def entries(spark):
    rows = [
        # site, allele, call, adj, pop, proband, sex
        (1, 1, "0/1", True, "afr", "Yes", "M"),
        (1, 1, "1/1", True, "eas", "No", "F"),
        (1, 1, "0/0", True, None, "No", "M"),
        (1, 1, "1/1", False, "afr", "No", "F"),
        (1, 1, "./.", None, "afr", "Yes", "F"),
        (2, 1, "1", True, "xyz", "Yes", "M"),
        (3, 1, "./.", None, "afr", "No", "M"),
    ]
    frame = spark.createDataFrame(rows, "site_id int, a_index int, t string, adj boolean, pop string, proband string, sex string")
    return frame.withColumn("GT", G.parse_call(F.col("t")))


KEYS = ["site_id", "a_index"]


def test_call_stats(entries):
    found = {r.site_id: (r.AC, r.AN, r.AF, r.nhomalt) for r in FQ.call_stats(entries, KEYS).collect()}
    assert found == {1: (5, 8, 5 / 8, 2), 2: (1, 1, 1.0, 0), 3: (0, 0, None, 0)}


def test_groups(entries):
    rows = {r.site_id: r for r in FQ.frequencies_wide(entries, KEYS, ["afr", "eas"]).collect()}
    one = rows[1]
    assert (one.AC_adj, one.AN_adj, one.nhomalt_adj) == (3, 6, 1)
    assert (one.AC_raw, one.AN_raw, one.nhomalt_raw) == (5, 8, 2)
    assert (one.AC_adj_afr, one.AN_adj_afr, one.AF_adj_afr) == (1, 2, 0.5)
    assert (one.AC_adj_eas, one.AC_adj_proband, one.AC_adj_male, one.AC_adj_female) == (2, 1, 1, 2)
    # haploid calls add one to the allele number and are never homozygous
    assert (rows[2].AN_adj, rows[2].nhomalt_adj) == (1, 0)
    assert (rows[3].AN_raw, rows[3].AF_raw) == (0, None)


def test_unknown_population_is_counted_in_the_long_form(entries):
    pops = FQ.observed_values(entries)
    assert pops == ["afr", "eas", "xyz"]
    long = FQ.frequencies_long(entries, KEYS, pops)
    assert long.where("tag = 'adj_xyz' AND site_id = 2").first().AC == 1
    assert {r.tag: r.idx for r in long.collect()}["adj_afr"] == 2


def test_partitioning_groups_add_up(entries):
    known = entries.where("pop is not null")
    row = FQ.frequencies_wide(known, KEYS, ["afr", "eas", "xyz"]).groupBy().sum().first().asDict()
    assert row["sum(AC_adj)"] == sum(row[f"sum(AC_adj_{p})"] for p in ("afr", "eas", "xyz"))
    assert row["sum(AN_adj)"] == row["sum(AN_adj_male)"] + row["sum(AN_adj_female)"]


def test_sites_without_entries_keep_zero_counts(spark, entries):
    sites = spark.createDataFrame([(1, 1), (9, 1)], "site_id int, a_index int")
    wide = FQ.frequencies_wide(entries, KEYS, ["afr"])
    row = FQ.with_frequencies(sites, wide, KEYS).where("site_id = 9").first()
    assert (row.AC_adj, row.AN_raw, row.nhomalt_adj_afr, row.AF_adj) == (0, 0, 0, None)


def test_any_number_of_groups(spark):
    rows = [(1, i % 1500, i) for i in range(3000)]
    entries = spark.createDataFrame(rows, "v int, p int, i int").selectExpr(
        "v", "named_struct('a0', 0, 'a1', i % 2, 'phased', false) AS GT", "i % 3 > 0 AS adj", "concat('p', p) AS pop",
        "if(i % 5 = 0, 'Yes', 'No') AS proband", "if(i % 4 = 0, 'M', 'F') AS sex",
    )
    groups = FQ.group_table(entries)
    assert groups.count() == 1505
    found = {r.tag: r for r in FQ.frequencies_by_group(entries, ["v"], groups).collect()}
    assert len(found) == 1505 and found["raw"].AC == 1500 and found["raw"].AN == 6000
    assert found["adj_p7"].AN == 2 * sum(i % 3 > 0 for i in (7, 1507))
    assert found["adj_p0"].idx == 2 and found["adj_p0"].AF is None


def test_long_forms_agree(entries):
    pops = FQ.observed_values(entries)
    long = FQ.frequencies_long(entries, KEYS, pops)
    by_group = FQ.frequencies_by_group(entries, KEYS, FQ.group_table(entries)).select(long.columns)
    assert sorted(map(tuple, by_group.collect()), key=repr) == sorted(map(tuple, long.collect()), key=repr)


def test_labels():
    assert FQ.label_combinations({"sex": ["male"], "group": ["adj", "raw"]}) == ["adj_male", "raw_male"]
    meta = FQ.frequency_groups(["afr", "xyz"])
    assert meta[:3] == [{"group": "adj"}, {"group": "raw"}, {"pop": "afr", "group": "adj"}]
    assert FQ.frequency_index(meta) == {"adj": 0, "raw": 1, "adj_afr": 2, "adj_proband": 4, "adj_male": 5, "adj_female": 6}


def test_population_structs_leave_out_absent_populations():
    assert FQ.population_structs(["AC_adj"]) == []
    assert FQ.population_structs(["AC_adj_sas"])[0] == "named_struct('sas', AC_adj_sas) AS AC_adj"


@pytest.mark.parametrize(
    ("value", "expected"),
    [(-0.1, -1), (0.0, 0), (4.9, 0), (5.0, 1), (99.9, 19), (100.0, 19), (100.1, 20), (None, None), (float("nan"), None)],
)
def test_bins(evaluate, value, expected):
    assert evaluate(H.bin_number(F.lit(value).cast("double"), 0, 100)) == (expected,)


def _quality(spark):
    rows = [
        (1, "0/0", 10, 7, [7, 0], True), (1, "0/1", 100, 20, [10, 10], True), (1, "1/1", 101, 120, [0, 9], False),
        (1, "0/1", None, 3, [0, 0], None), (1, "./.", 50, None, None, None),
    ]
    frame = spark.createDataFrame(rows, "site_id int, t string, GQ int, DP int, AD array<int>, adj boolean")
    return frame.withColumn("GT", G.parse_call(F.col("t")))


def test_histograms(spark):
    frame = _quality(spark)
    hists = H.quality_histograms(frame, ["site_id"]).first().raw_qual_hists
    assert list(hists.asDict()) == H.histogram_names()
    gq = hists.gq_hist_all
    assert gq.bin_freq[2] == 1 and gq.bin_freq[19] == 1 and gq.bin_freq[10] == 1 and gq.n_larger == 1
    assert sum(gq.bin_freq) + gq.n_smaller + gq.n_larger == 4
    assert len(gq.bin_edges) == 21 and gq.bin_edges[20] == 100.0
    assert (sum(hists.gq_hist_alt.bin_freq), hists.gq_hist_alt.n_larger) == (1, 1)
    assert sum(hists.dp_hist_all_adj.bin_freq) == 2 and hists.dp_hist_all.n_larger == 1
    # the depth of zero gives no ratio; one half falls into the bin that starts there
    assert hists.ab_hist_alt.bin_freq[10] == 1 and sum(hists.ab_hist_alt.bin_freq) == 1
    long = {(r.hist, r.bin): r.n for r in H.histograms_long(frame, ["site_id"]).collect()}
    dense = {(n, b): c for n, h in hists.asDict().items() for b, c in enumerate(h.bin_freq) if c}
    dense |= {(n, 20): h.n_larger for n, h in hists.asDict().items() if h.n_larger}
    assert long == dense


def test_histograms_by_arguments(spark):
    plain = H.quality_histograms(_quality(spark), ["site_id"], with_calls=False, with_adj=False, measures=("gq", "dp"))
    assert plain.schema["raw_qual_hists"].dataType.names == ["gq_hist_all", "dp_hist_all"]


def test_regrouped_edges(spark):
    hists = H.quality_histograms(_quality(spark), ["site_id"])
    row = hists.select(*H.regrouped()).first()
    assert row.allele_balance.alt_raw.bin_edges[3] == 0.15
    assert row.genotype_depth.all_raw.bin_freq == hists.first().raw_qual_hists.dp_hist_all.bin_freq


def test_fused_statistics_equal_frequencies_and_histograms(spark):
    """One aggregation against the two that it stands for, over odd and random entries."""
    import random

    draw = random.Random(11)
    rows = [
        (
            draw.randint(0, 9), draw.randint(1, 2), draw.choice(["0/1", "1/1", "0/0", "./.", "1", "0", "1|0"]),
            draw.choice([None, [], [5], [draw.randint(0, 9), draw.randint(0, 9)], [0, 0], [None, 3]]),
            draw.choice([None, 0, 7, 100, 101, 250]), draw.choice([None, -1, 0, 50, 99, 100, 101]), draw.choice([True, False, None]),
            draw.choice(["afr", "eas", "xyz", None]), draw.choice(["Yes", "No", None]), draw.choice(["M", "F", "U", None]),
        )
        for _ in range(600)
    ]
    schema = "site_id int, a_index int, t string, AD array<int>, DP int, GQ int, adj boolean, pop string, proband string, sex string"
    entries = spark.createDataFrame(rows, schema).withColumn("GT", G.parse_call(F.col("t")))
    pops = ["afr", "eas"]
    fused = {(r.site_id, r.a_index): r.asDict(True) for r in variant_statistics(entries, KEYS, pops).collect()}
    wide = FQ.frequencies_wide(entries, KEYS, pops)
    for r in wide.join(H.quality_histograms(entries, KEYS), KEYS, "left").collect():
        want = r.asDict(True)
        assert fused[r.site_id, r.a_index] == want
    assert len(fused) == wide.count() and variant_statistics(entries, KEYS, pops).columns == [*wide.columns, "raw_qual_hists"]
    plan = variant_statistics(entries, KEYS, pops)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1 and "Join" not in plan


def test_few_samples_are_gathered_in_one_shuffle(spark):
    """The same rows as from summed counters, and nothing but the entries is shuffled."""
    calls, adj, depths = ["0/1", "1/1", "./.", "1", "0|1"], [True, False, None], [None, [0, 0], [5, 5], [None, 3], [9, 1]]
    rows = [
        (i // 5, 1, calls[i * 7 % 5], depths[i * 3 % 5], [None, 7, 100, 250][i % 4], [-1, 50, None, 101][i * 3 % 4], adj[i % 3],
         ["afr", "xyz", None][i * 5 % 3], ["Yes", "No", None][i * 2 % 3], ["M", "F", None][i * 4 % 3])
        for i in range(200)
    ]
    schema = "site_id int, a_index int, t string, AD array<int>, DP int, GQ int, adj boolean, pop string, proband string, sex string"
    entries = spark.createDataFrame(rows, schema).withColumn("GT", G.parse_call(F.col("t")))
    summed, listed = (variant_statistics(entries, KEYS, ["afr"], few) for few in (False, True))
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Generate" not in plan
    assert listed.schema == summed.schema
    ordered = lambda f: sorted((r.asDict(True) for r in f.collect()), key=lambda r: r["site_id"])
    assert ordered(listed) == ordered(summed)


def test_marks_of_many_entries(spark):
    """Variants of fewer and of more entries than fit into words, many of them equal."""
    import random

    from locusmill.operators import statistics as S

    draw = random.Random(5)
    sizes = {0: 63, 1: 64, 2: 400, 3: 1}
    rows = [
        (site, 1, draw.choice(["0/1", "1/1", "0/0", "./.", "1"]), draw.choice([None, [3, 5], [0, 0], [8, None]]), draw.choice([None, 3, 99, 250]),
         draw.choice([-1, 40, 100, 101]), draw.choice([True, False, None]), draw.choice(["afr", "xyz", None]), draw.choice(["Yes", "No"]), draw.choice(["M", "F", "U"]))
        for site, n in sizes.items() for _ in range(n)
    ]
    rows += [(4, 1, "1/1", [0, 9], 30, 60, True, "afr", "Yes", "M")] * 100
    schema = "site_id int, a_index int, t string, AD array<int>, DP int, GQ int, adj boolean, pop string, proband string, sex string"
    entries = spark.createDataFrame(rows, schema).withColumn("GT", G.parse_call(F.col("t")))
    found = {r.site_id: r.asDict(True) for r in variant_statistics(entries, KEYS, ["afr"]).collect()}
    want = FQ.frequencies_wide(entries, KEYS, ["afr"]).join(H.quality_histograms(entries, KEYS), KEYS).collect()
    assert found == {r.site_id: r.asDict(True) for r in want} and len(found) == 5
    cell = S.cell_number(["afr"])
    marked = entries.select(*KEYS, S.in_cell(S.entry_mark(F.col("GT"), F.col("adj"), H.entry_measures()), cell, ["afr"]).alias("mark"))
    lists = {r.site_id: len(r._marks) for r in S.gathered_marks(marked, KEYS, ["afr"]).collect()}
    assert lists[4] == 1 and lists[2] < 400
