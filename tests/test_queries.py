"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from locusmill import catalog, views

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    frame = queries()[name](spark, str(SF_DIR))
    expected = duck.sql(oracle_sql()[name])
    assert sorted(frame.columns) == sorted(expected.columns)
    found = rows_of(frame.collect(), frame.columns)
    assert found and found == rows_of(expected.fetchall(), expected.columns)


def test_entry(spark):
    frame = entry(spark)
    assert {"variant_id", "AC_adj", "sortedTranscriptConsequences", "genotype_depth"} <= set(frame.columns)
    assert frame.count() == duckdb.sql(
        f"SELECT sum(CASE p_size % 6 WHEN 3 THEN 2 WHEN 4 THEN 2 ELSE 1 END) FROM '{SF_DIR}/part.parquet'"
    ).fetchall()[0][0]


def test_tasks_of_slow_rows_do_not_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(views, "SLOW_ROWS", 100, raising=False)
    orders = views.table(spark, "/root/testdata/sf0.001", "orders").count()
    assert views.annotated_variants(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= orders / 100


def test_tasks_of_genotypes_do_not_grow_with_the_table(spark, monkeypatch):
    """Their number follows the order lines; merged by bytes, a larger table meant longer tasks."""
    usual = views.entries(spark, str(SF_DIR))
    lines = views.table(spark, str(SF_DIR), "lineitem").count()
    monkeypatch.setattr(views, "CELL_ROWS", lines // 30)
    many = views.entries(spark, str(SF_DIR))
    assert many.rdd.getNumPartitions() >= 30
    plain = lambda f: sorted(map(str, f.collect()))
    assert plain(many) == plain(usual)


def test_tasks_that_count_histogram_bins_follow_the_order_lines(spark, monkeypatch):
    """The split and the lookup of samples keep the tasks of the genotypes, in which bins are counted first."""
    lines = views.table(spark, str(SF_DIR), "lineitem").count()
    monkeypatch.setattr(views, "CELL_ROWS", lines // 30, raising=False)
    assert catalog._entries(spark, str(SF_DIR)).rdd.getNumPartitions() >= 30


def test_entries_are_not_sorted_to_look_up_many_samples(spark, monkeypatch, capsys):
    usual = catalog._entries(spark, str(SF_DIR))
    monkeypatch.setattr(views, "MANY_SAMPLES", 10, raising=False)
    hashed = catalog._entries(spark, str(SF_DIR))
    hashed.explain()
    lookup = next(line for line in capsys.readouterr().out.splitlines() if "Join [s#" in line)
    assert "ShuffledHashJoin" in lookup and "LeftOuter" in lookup
    plain = lambda f: sorted(map(str, f.collect()))
    assert plain(hashed) == plain(usual)
