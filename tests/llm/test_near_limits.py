"""The near-duplicate stage of the pipeline has limits of its own."""

import corpus_pipeline
from locusmill.llm import near


def test_pair_between_the_limits_of_op10_and_of_the_pipeline(spark):
    """J is 396 / 476 = 0.832 with five words and 398 / 478 = 0.833 with three."""
    base = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(base)), (2, " ".join(base + [f"e{i}" for i in range(80)])), (3, "something else entirely here now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert near.near_duplicates(docs).where("kept").count() == 3
    left = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in left.collect()) == [1, 3]


def test_bands_for_a_limit():
    assert near.banding(85) == (32, 6) and near.banding(80) == (38, 5)


def brute(rows, width=3, percent=85):
    """Component of each row by comparing all sets; rows without id name nothing."""
    sets = []
    for i, t in rows:
        words = (t or "").lower().split()
        sets.append({tuple(words[k : k + width]) for k in range(len(words) - width + 1)} or ({tuple(words)} if words else set()))
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for x, a in enumerate(sets):
            for y, b in enumerate(sets):
                same = a == b if None in (rows[x][0], rows[y][0]) else 100 * len(a & b) >= percent * len(a | b)
                if a and b and same and label[y] < label[x]:
                    label[x], changed = label[y], True
    names = {}
    for (i, _), c in zip(rows, label, strict=True):
        if i is not None:
            names[c] = min(i, names.get(c, i))
    found = [names.get(c, i) if s else i for (i, _), c, s in zip(rows, label, sets, strict=True)]
    return [(i, len(s), c, c is None or i == c, t) for (i, t), s, c in zip(rows, sets, found, strict=True)]


U, V = "a text that is the same here and there", "quite another one which is like no other"
W = " ".join(f"w{i}" for i in range(60))
ODD = [
    [(1, U), (2, U), (None, U), (None, V)],
    [(1, U), (2, U), (2, V)],
    [(1, U), (None, U)],
    [(None, U), (None, U), (3, "")],
    [(5, U), (5, V), (5, W), (5, W), (7, W + " end"), (4, V), (6, None), (6, U)],
]


def test_null_and_repeated_ids_match_brute_force(spark):
    for rows in ODD:
        docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, version string")
        want = brute(rows)
        got = sorted((tuple(r) for r in near.near_duplicates(docs).collect()), key=str)
        assert got == sorted((w[:4] for w in want), key=str), rows
        left = near.without_near_duplicates(docs)
        assert left.columns == docs.columns
        assert sorted(map(str, ((r.doc_id, r.text) for r in left.collect()))) == sorted(str((w[0], w[4])) for w in want if w[3])
