import json

import pytest

from locusmill.plans.companions import publish_saved
from locusmill.sinks import documents as D


@pytest.fixture
def collections(spark):
    existing = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, name string, old int")
    incoming = spark.createDataFrame(
        [(2, None, True, 1), (2, "c", True, 2), (3, "d", None, 1), (3, "e", False, 5)], "id int, name string, fresh boolean, seq int"
    )
    return existing, incoming


@pytest.mark.parametrize(
    ("mode", "expected"),
    [
        ("index", {1: ("a", 10, None), 2: ("c", None, True), 3: ("e", None, False)}),
        ("create", {1: ("a", 10, None), 2: ("b", 20, None), 3: ("d", None, None)}),
        ("update", {1: ("a", 10, None), 2: ("c", 20, True)}),
        ("upsert", {1: ("a", 10, None), 2: ("c", 20, True), 3: ("e", None, False)}),
    ],
)
def test_merge(collections, mode, expected):
    merged = D.merge_documents(*collections, "id", mode, order_by=["seq"])
    assert {r.id: (r.name, r.old, r.fresh) for r in merged.collect()} == expected


def test_update_writes_nulls(spark, collections):
    incoming = spark.createDataFrame([(1, None)], "id int, name string")
    rows = {r.id: r.name for r in D.merge_documents(collections[0], incoming, "id", "update").collect()}
    assert rows == {1: None, 2: "b"}


def test_unknown_mode(collections):
    with pytest.raises(ValueError, match="delete"):
        D.merge_documents(*collections, "id", "delete")


def test_rejects(collections, tmp_path):
    found = lambda mode: sorted(tuple(r) for r in D.merge_rejects(*collections, "id", mode).collect())
    assert found("create") == [(2, "exists", 2), (3, "exists", 1)]
    assert found("update") == [(3, "missing", 2)]
    assert found("index") == found("upsert") == []
    with pytest.raises(ValueError, match="refused"):
        D.write_merged(*collections, str(tmp_path / "m"), "id", "update")
    D.write_merged(*collections, str(tmp_path / "m"), "id", "update", ignore_errors=True)
    assert D.read_merged(collections[0].sparkSession, str(tmp_path / "m")).count() == 2


def test_merging_onto_its_own_folder_keeps_every_row(spark, tmp_path):
    path = str(tmp_path / "own")
    D.write_merged(spark.createDataFrame([], "id int, name string"), spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string"), path, "id")
    for i in (3, 4):
        existing = D.read_merged(spark, path)
        assert D.write_merged(existing, spark.createDataFrame([(i, "new"), (1, f"v{i}")], "id int, name string"), path, "id").isEmpty()
    assert sorted(map(tuple, D.read_merged(spark, path).collect())) == [(1, "v4"), (2, "b"), (3, "new"), (4, "new")]


def test_null_policy(spark):
    rows = spark.createDataFrame([(1, None, "x")], "id int, a string, b string")
    body = lambda mode: rows.select(D.document_json(rows, mode)).first()[0]
    assert json.loads(body("index")) == {"id": 1, "b": "x"}
    assert json.loads(body("upsert")) == {"id": 1, "a": None, "b": "x"}


def test_bulk_files(spark, tmp_path):
    table = str(tmp_path / "table")
    spark.range(95).selectExpr("id", "concat('n', id) AS `name.x`").write.parquet(table)
    path = tmp_path / "bulk"
    D.write_bulk(spark.read.parquet(table), str(path), "things", "id", block_size=10, num_shards=3)
    files = list(path.glob("shard=*/*.txt"))
    assert {f.parent.name for f in files} == {"shard=0", "shard=1", "shard=2"}
    # requests of ten documents, an empty line between them, whatever the number of files
    requests = [[block.splitlines() for block in f.read_text().removesuffix("\n").split("\n\n")] for f in files]
    assert all(len(block) == 20 for blocks in requests for block in blocks[:-1]) and any(len(blocks) > 1 for blocks in requests)
    assert all(0 < len(blocks[-1]) <= 20 for blocks in requests) and sum(len(b) for blocks in requests for b in blocks) == 190
    action, body = map(json.loads, requests[0][0][:2])
    assert action["index"]["_index"] == "things" and body["name_x"] == f"n{action['index']['_id']}"
    # one shard is one folder, but not one task; publishing appends
    publish_saved(spark, table, str(tmp_path / "one"), "things", id_column="id")
    publish_saved(spark, table, str(tmp_path / "one"), "things", id_column="id")
    assert spark.read.text(str(tmp_path / "one")).count() == 380


def test_a_new_file_starts_a_new_request(spark, tmp_path):
    rows = spark.range(47).coalesce(1).selectExpr("id", "'x' AS name")
    D.write_bulk(rows, str(tmp_path / "bulk"), "things", "id", block_size=4, num_shards=1, file_records=10)
    texts = sorted((f.read_text() for f in (tmp_path / "bulk").glob("shard=*/*.txt")), key=len, reverse=True)
    assert [[len(b.splitlines()) // 2 for b in t.removesuffix("\n").split("\n\n")] for t in texts] == [[4, 4, 2]] * 4 + [[4, 3]]
    assert D.write_bulk(rows.limit(0), str(tmp_path / "none"), "things", "id") is None


def test_unite(spark):
    first = spark.createDataFrame([(1, "a")], "x int, y string")
    second = spark.createDataFrame([(2, 0.5)], "x int, z double")
    assert sorted(map(tuple, D.unite_collections(first, second).collect())) == [(1, "a", None), (2, None, 0.5)]


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in (path / "data").rglob("*.parquet")}


def test_a_merge_leaves_other_buckets_alone(spark, tmp_path):
    path = tmp_path / "collection"
    D.write_collection(spark.range(1000).selectExpr("id", "id * 2 AS v"), str(path), "id", buckets=64)
    before = files_of(path)
    some = spark.range(0, 1000, 100).selectExpr("id", "-id AS v")
    assert D.merge_collection(some, str(path), "id", "update").count() == 0
    after = files_of(path)
    assert before.items() <= after.items() and 0 < len(after) - len(before) <= 10
    rows = {r.id: r.v for r in D.read_collection(spark, str(path)).collect()}
    assert rows == {i: -i if i % 100 == 0 else 2 * i for i in range(1000)}


def test_collections_keep_versions_whole(spark, tmp_path):
    path = str(tmp_path / "collection")
    with pytest.raises(ValueError, match="no collection"):
        D.merge_collection(spark.range(1), path, "id")
    D.write_collection(spark.range(20).selectExpr("id", "'a' AS v"), path, "id", buckets=4)
    new = spark.createDataFrame([(5, "x"), (50, "y"), (None, "z")], "id long, v string")
    with pytest.raises(ValueError, match="refused"):
        D.merge_collection(new, path, "id", "create")
    assert D.read_collection(spark, path).count() == 20
    rejects = D.merge_collection(new, path, "id", "create", ignore_errors=True)
    assert [tuple(r) for r in rejects.collect()] == [(5, "exists", 1)]
    assert D.read_collection(spark, path).count() == 22
    # a column that comes later, and a merge of nothing
    D.merge_collection(spark.createDataFrame([(3, 9)], "id long, n int"), path, "id", "upsert")
    D.merge_collection(new.limit(0), path, "id")
    rows = {r.id: (r.v, r.n) for r in D.read_collection(spark, path).collect()}
    assert rows[3] == ("a", 9) and rows[4] == ("a", None) and len(rows) == 22
