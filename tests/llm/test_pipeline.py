"""The corpus pipeline: each stage against brute force over its own input, and odd tables."""

import re

import pytest

import corpus_pipeline
from locusmill.llm import groups, shared

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF_DIR = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def shingles(text, width=5):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


def brute_components(rows, percent=80):
    """Smallest id that each id is linked with."""
    sets, forest = {i: shingles(t) for i, t in rows}, groups.Forest()
    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                forest.join(i, j)
    return {i: forest.find(i) for i in ids}


def brute_lines(rows):
    """Texts without the windows of three lines with words that stand earlier, by id."""
    first, out = {}, {}
    placed = {i: [(k, x) for k, x in enumerate((t or "").split("\n")) if WORD.search(x)] for i, t in rows}
    for i in sorted(placed):
        for p in range(len(placed[i]) - 2):
            first.setdefault(tuple(x for _, x in placed[i][p : p + 3]), (i, p))
    for i, t in rows:
        gone = set()
        for p in range(len(placed[i]) - 2):
            if first[tuple(x for _, x in placed[i][p : p + 3])] != (i, p):
                gone |= {k for k, _ in placed[i][p : p + 3]}
        out[i] = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone) if t is not None else None
    return out


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage but the last."""
    docs, found = shared.table(spark, SF_DIR, "documents"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = shared.written(stage(spark, docs, SF_DIR), "pipeline-test")
        assert left.columns == docs.columns, name
        found[name], docs = (docs, left), left
    return found


def texts(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_line_dedup_stage_drops_what_it_empties(stages):
    before, after = map(texts, stages["line dedup"])
    want = {i: t for i, t in brute_lines(before).items() if not (WORD.search(dict(before)[i] or "") and not WORD.search(t or ""))}
    assert dict(after) == want and len(want) < len(before)
    assert all(r.n_chars == len(r.text) for r in stages["line dedup"][1].collect() if r.text is not None)


def test_near_duplicate_stage_keeps_one_of_each_group(stages):
    before, after = map(texts, stages["near duplicates"])
    components = brute_components(before)
    assert sorted(i for i, _ in after) == sorted(i for i, c in components.items() if i == c)


def test_no_copy_of_the_input_reaches_the_encoder(spark, stages):
    """Neither whole nor as an empty text: each text that is left is one that no other row has."""
    rows = texts(stages["decontamination"][1])
    solid = [t for _, t in rows if WORD.search(t or "")]
    assert len(solid) == len(set(solid))
    had = dict(texts(stages["toxicity"][0]))
    assert all(WORD.search(t or "") for i, t in rows if WORD.search(had[i] or ""))
    assert all(c == i for i, c in brute_components(rows).items())


def test_every_stage_keeps_most_documents(stages):
    for name, (before, after) in stages.items():
        assert after.count() > 0.7 * before.count(), name


def test_run_encodes_what_the_stages_leave(spark, stages):
    got = {r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert got == {i for i, _ in texts(stages["decontamination"][1])}


LONG = "\n".join(f"line {i} of a long text" for i in range(3000))
ROWS = [
    (1, None, None, "s", 0, "x"), (2, "", "en", "s", 0, "x"), (3, " \n\t\n ", "en", "s", 5, "x"), (4, "one", None, None, None, "x"),
    (5, "a b c\nd e f\ng h i", "en", "s", 17, "x"), (5, "a b c\nd e f\ng h i", "en", "s", 17, "x"), (6, "a b c\nd e f\ng h i", "en", "s", 17, "x"),
    (6, "another text of number six, with words of its own", "en", "s", 1, "x"), (None, "a b c\nd e f\ng h i", "en", "s", 17, "x"),
    (None, "no id and no copy", "en", "s", 17, "x"), (7, LONG, "en", "s", len(LONG), "x"), (8, "q" * 40000, "en", "s", 40000, "x"),
]
#: Columns whose names the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, version string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def left(spark, name, frame, folder=SF_DIR):
    out = STAGES[name](spark, frame, folder)
    if name != "encode":
        assert out.columns == frame.columns
    return out


def ids(frame):
    """Ids and texts of the rows with a text."""
    return sorted((str(r.doc_id), r.text) for r in frame.collect() if r.text is not None)


def test_stages_on_odd_rows(spark, odd):
    before = ids(odd)
    harmless = left(spark, "toxicity", odd)
    # rows of one text are judged alike, and a text without words is as likely as any to be harmless
    assert {("2", ""), ("3", " \n\t\n ")} <= set(ids(harmless)) and harmless.where("text IS NULL").count() == 1
    assert [x for x in ids(harmless) if x[1] == ROWS[4][1]] in ([], [x for x in before if x[1] == ROWS[4][1]])
    copy = "a b c\nd e f\ng h i"
    kept = ids(left(spark, "line dedup", odd))
    # rows without id come first in order, and both rows of document 5 are copies of theirs
    assert kept == sorted(x for x in before if x[1] != copy or x[0] == "None")
    near = ids(left(spark, "near duplicates", odd))
    assert near == sorted(x for x in before if x[1] != copy or x[0] == "5")
    assert ids(left(spark, "decontamination", odd)) == before
    encoded = left(spark, "encode", odd).collect()
    assert sorted(str(r.doc_id) for r in encoded) == sorted(str(r[0]) for r in ROWS)
    assert {r.n_tokens for r in encoded if r.doc_id in (1, 2)} == {1}


@pytest.mark.parametrize("name", STAGES)
def test_stages_on_an_empty_table(spark, odd, name):
    assert left(spark, name, odd.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["toxicity", "decontamination"])
def test_stages_without_labels_and_items(spark, odd, name):
    folder = shared.fresh_folder(spark, "empty-tables")
    for table in ("documents", "labels", "benchmark"):
        shared.table(spark, SF_DIR, table).limit(0).write.parquet(f"{folder}/{table}.parquet")
    assert ids(left(spark, name, odd, folder)) == ids(odd)
