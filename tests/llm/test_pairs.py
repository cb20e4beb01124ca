"""Near duplicates, decontamination, WARC and the pipeline against brute force."""

import base64
import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from locusmill.llm import contamination, groups, near, shared, warc
from locusmill.llm.queries import ORACLE, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF_DIR = "/root/testdata/sf0.001"


def brute_sets(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) > 2 else ({tuple(words)} if words else set())


def brute_components(docs):
    sets = {i: brute_sets(t) for i, t in docs}
    forest = groups.Forest()
    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                forest.join(i, j)
    return {i: (len(sets[i]), forest.find(i)) for i in ids}


def test_superminhash_equals_its_definition():
    """The rounds give what walking each element's permutation in full gives."""
    sets, slots = [np.unique(np.random.default_rng(s).integers(0, 2**63, n).astype(np.uint64)) for s, n in ((1, 1), (2, 5), (3, 300))], 16
    want = np.full((3, slots), np.iinfo(np.uint64).max, np.uint64)
    for d, elements in enumerate(sets):
        for e in elements:
            order = list(range(slots))
            for j in range(slots):
                z = int(near.mixed(np.array([e]), j)[0])
                k = j + ((z & 0xFFFFFFFF) * (slots - j) >> 32)
                order[j], order[k] = order[k], order[j]
                want[d, order[j]] = min(int(want[d, order[j]]), j << 32 | z >> 32)
    assert np.array_equal(near.signatures(sets, slots), want)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB é\n\t", max_size=30), max_size=6))
def test_shingle_sets_have_the_right_sizes(texts):
    got = near.shingle_sets(pa.array([*texts, None], pa.string()))
    assert [len(s) for s in got] == [len(brute_sets(t)) for t in [*texts, None]]


def near_copies():
    """A group whose members differ from a base by few or many words, so that some are linked."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    docs = [(i, " ".join(f"x{i}y{k}" for k in range(20))) for i in range(5)]
    for i in range(10, 90):
        words = list(base)
        for _ in range(rng.choice([1, 2, 4, 5, 6, 9])):
            words[rng.randrange(150)] = rng.choice([f"n{i}", "shared", "other"])
        docs.append((i, " ".join(words)))
    docs += [(200, " ".join(base)), (201, " ".join(base).upper()), (202, ""), (203, "\n \t"), (204, "one"), (205, "One"), (206, "one two")]
    return docs


def test_near_duplicates_match_brute_force(spark):
    docs = near_copies()
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, component int").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_duplicates(frame).collect()}
    assert got == brute_components(docs)
    left = near.without_near_duplicates(frame)
    assert left.columns == frame.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, (_, c) in got.items() if i == c)


def test_near_duplicates_nulls_repeats_and_empty(spark):
    rows = [(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, "z"), (4, None), (5, "A b c d")]
    got = sorted((tuple(r) for r in near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(3, 2, 3, True)] * 2 + [(None, 2, 3, False), (None, 1, None, True), (4, 0, 4, True), (5, 2, 3, False)], key=str)
    assert near.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_near_duplicates_beside_many_just_below_the_limit(spark):
    """A linked pair with the largest ids, whose buckets all hold smaller ids that are not linked."""
    base = [f"w{i}" for i in range(95)]
    docs = [(i, " ".join(base + [f"s{i}k{k}" for k in range(10)])) for i in range(60)]
    docs += [(i, " ".join(base + [f"s{i}k{k}" for k in range(7)])) for i in (900, 901)]
    want = brute_components(docs)
    assert [i for i, (_, c) in want.items() if i != c] == [901] and want[901][1] == 900
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_duplicates(frame).collect()} == want


def test_bound_counts_shingles_shared_with_a_core_outside_the_buckets(spark):
    """Set 1 names the component of 2 and 3 but is in no bucket; 10 has 8 shingles with it alone."""
    sets = {1: range(92, 192), 2: range(100), 3: range(200, 300), 10: [*range(92), *range(100, 108)]}
    assert 100 * 92 >= 85 * 108 == 85 * len({*sets[2], *sets[10]})
    table = spark.createDataFrame([(i, [int(x) for x in s]) for i, s in sets.items()], "node long, hashes array<long>")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "node long, component long")
    members = spark.createDataFrame([(0, 5, i, 100) for i in (2, 3, 10)], "band int, hash long, node long, size int")
    classes = spark.createDataFrame([(i, [5]) for i in (2, 3, 10)], "node long, bands array<long>")
    pairs = near._remaining_pairs(members, labels, table, classes)
    assert {2, 10} in [set(r) for r in pairs.collect()]


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 102), (102, 101), (101, 101)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r.node: r.component for r in groups.components(frame).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def edited(words, d, kinds, rng, vocabulary):
    words = list(words)
    for _ in range(d):
        at, kind = rng.randrange(len(words)), rng.choice(kinds)
        if kind == "s":
            words[at] = rng.choice(vocabulary)
        elif kind == "i":
            words.insert(at, rng.choice(vocabulary))
        else:
            del words[at]
    return words


def brute_edits(item, text):
    above = [0] * (len(text) + 1)
    for k, w in enumerate(item, 1):
        row = [k]
        for j, c in enumerate(text, 1):
            row.append(min(above[j - 1] + (w != c), above[j] + 1, row[-1] + 1))
        above = row
    return min(above)


def test_contamination_recall_at_the_limit():
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(14, 60))) for _ in range(40)]
    items = contamination.Items(list(range(40)), texts)
    tried = found = 0
    for k, text in enumerate(texts):
        words = text.split()
        for kinds in ("s", "sid"):
            inside = edited(words, contamination.allowed(len(words)), kinds, rng, vocabulary)
            doc = [*rng.choices(vocabulary, k=50), *inside, *rng.choices(vocabulary, k=50)]
            got = items.found([" ".join(doc)])[0]
            want = [i for i, t in enumerate(texts) if brute_edits(t.split(), doc) <= contamination.allowed(len(t.split()))]
            assert set(got) <= set(want) and k in want
            tried, found = tried + len(want), found + len(got)
    assert found >= 0.98 * tried


@pytest.mark.parametrize("part, held", [(150, 100), (1 << 20, 1 << 20)])
def test_contamination_frames(spark, monkeypatch, part, held):
    monkeypatch.setattr(contamination, "PART_BYTES", part)
    monkeypatch.setattr(contamination, "HELD_BYTES", held)
    item = " ".join(f"q{i}" for i in range(20))
    benchmark = spark.createDataFrame(
        [(1, item, 0), (2, item, 0), (2, item, 1), (3, None, 0), (4, "", 0), (None, item, 0), (None, "an item without any id", 0), (5, "only three words", 0), (6, "one two three four five", 0)],
        "item_id long, text string, doc_id int",
    )
    rows = [
        (1, f"start. {item.upper()}, end", 0), (1, f"start. {item.upper()}, end", 0), (2, None, 0), (3, "", 0), (4, "three words only", 0),
        (None, "say: only THREE words!", 0), (5, "one two x four five", 0), (6, "clean " * 9000, 0), (7, item[: len(item) // 2], 0),
        (8, "here is an item without any id", 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, items int")
    found = contamination.contaminated(docs, benchmark)
    got = sorted(((r.doc_id, r.n_items, r["items"]) for r in found.collect()), key=str)
    want = [(1, 3, [1, 2]), (1, 3, [1, 2]), (2, 0, []), (3, 0, []), (4, 0, []), (None, 1, [5]), (5, 1, [6]), (6, 0, []), (7, 0, []), (8, 1, [])]
    assert got == sorted(want, key=str)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    left = contamination.without_contaminated(docs, benchmark)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 4, 6, 7]
    assert contamination.contaminated(docs, benchmark.limit(0)).where("n_items > 0").isEmpty()
    assert contamination.without_contaminated(docs, benchmark.limit(0)).count() == len(rows)
    assert contamination.contaminated(docs.limit(0), benchmark).collect() == []


def test_contamination_in_many_parts_equals_one_part(spark, monkeypatch):
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(300)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(5, 80))) for _ in range(60)]
    benchmark = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = [(i, " ".join(rng.choices(vocabulary, k=30)) + " " + " ".join(rng.sample(texts, i % 4))) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    one = sorted(map(tuple, contamination.contaminated(frame, benchmark).collect()))
    monkeypatch.setattr(contamination, "PART_BYTES", 700)
    assert len(contamination._parts(benchmark)) > 10
    assert sorted(map(tuple, contamination.contaminated(frame, benchmark).collect())) == one and any(r[1] > 2 for r in one)


def test_decontamination_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in shared.table(spark, SF_DIR, "documents").collect()}
    items = {r.item_id: contamination.words_of(r.text) for r in shared.table(spark, SF_DIR, "benchmark").collect()}
    rows = QUERIES["op3_decontamination"](spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(docs)
    assert all(r.n_items == len(r["items"]) and r.contaminated == (r.n_items > 0) for r in rows)
    for r in rows[:40]:
        words = contamination.words_of(docs[r.doc_id])[:400]
        want = [i for i, w in items.items() if w and brute_edits(w, words) <= contamination.allowed(len(w))]
        assert set(want) <= set(r["items"])


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    urls = ["http://a.example.com/x", "https://b.example.com:8080/y?q=1 2", None, "http://[bad", "http://a.example.com/x"]
    rows = [(i, urls[i % 5], f"page {i // 3} é" if i % 7 else None, "extra") for i in range(40)] + [(5, urls[0], "page 1 é", "extra")] + [(None, urls[0], "alone", "extra")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, sha string")
    captures = warc.write_archives(pages, shared.fresh_folder(spark, "warc-test"))
    index = warc.write_index(captures, shared.fresh_folder(spark, "warc-test"))
    got = sorted((tuple(r) for r in warc.read_records(warc.look_up(captures.select("key"), index)).collect()), key=str)
    largest = {}
    for i, _, html, _ in rows:
        if i is not None:
            largest[html or ""] = max(i, largest.get(html or "", -1))
    want = []
    for i, url, html, _ in rows:
        data, first = (html or "").encode(), largest.get(html or "")
        revisit = first is not None and i != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((i, url, len(data), digest, "revisit" if revisit else "response", first if revisit else None))
    assert got == sorted(want, key=str)
    one = warc.look_up(spark.createDataFrame([("com,example,a)/x",), ("com,none)/",)], "key string"), index)
    assert one.count() == sum(u == urls[0] for _, u, _, _ in rows)
    small = warc.write_archives(pages, shared.fresh_folder(spark, "warc-test"), least_bytes=10**6)
    assert warc.read_records(small).where("record_type = 'revisit'").isEmpty()
    none = warc.write_archives(pages.limit(0), shared.fresh_folder(spark, "warc-test"))
    assert warc.look_up(none.select("key"), warc.write_index(none, shared.fresh_folder(spark, "warc-test"))).collect() == []


def test_url_keys():
    assert warc.url_key("https://WWW.Example.com/a?b#c") == "com,example,www)/a?b"
    assert warc.url_key("http://h:81") == "h:81)/"
    assert " " not in warc.url_key("http://h/a b\n") and warc.url_key(None) == ")/"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "pages", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    expected = duck.sql(ORACLE[name])
    assert sorted(expected.columns) == columns
    places = [expected.columns.index(c) for c in columns]
    assert sorted(map(repr, map(tuple, frame.select(columns).collect()))) == sorted(
        repr(tuple(row[i] for i in places)) for row in expected.fetchall()
    )


