"""Periodic runs against brute force."""

import random

import numpy as np
import pytest

from locusmill.llm import periodic


def brute(words, least=24, times=3):
    """Runs by trying every period at every place."""
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, times * q) and not any(words[i : i + size - d] == words[i + d : i + size] for d in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def made(rng):
    words = []
    while rng.random() < 0.85:
        unit = [rng.randrange(rng.choice([2, 3, 9])) for _ in range(rng.randint(1, 12))]
        words += (unit * rng.randint(1, 9))[: rng.randint(1, 70)]
    return words


@pytest.mark.parametrize("least, times", [(24, 3), (3, 3), (8, 4)])
def test_runs_match_brute_force(least, times):
    rng = random.Random(least)
    for _ in range(150):
        texts = [made(rng) for _ in range(rng.randint(1, 4))]
        counts = np.array(list(map(len, texts)), np.int64)
        got = periodic.runs_of(np.array(sum(texts, []), np.int64), counts, least, times).tolist()
        want = [[s + at, n, q] for t, at in zip(texts, np.cumsum(counts) - counts, strict=True) for s, n, q in brute(t, least, times)]
        assert got == want


def test_ranks_of_many_words_equal_those_of_few():
    """Where a pair and its place don't fit one number, pairs are sorted another way."""
    rng = np.random.default_rng(3)
    left, right = rng.integers(0, 9, (2, 500))
    at = np.arange(0, 1000, 2)
    few, many = periodic._ranked(left, right, at, 1000), periodic._ranked(left, right, at, 1 << 22)
    assert all(np.array_equal(a, b) for a, b in zip(few, many, strict=True))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_frames(spark):
    rng = random.Random(9)
    texts = [None, "", " \n\t", "one", "a " * 23, "a " * 24, "a b " * 30, "x y z " * 4000 + "end", "w" * 9000]
    texts += [" \n".join(f"v{x}" for x in made(rng)) for _ in range(60)] + [" ".join(f"n{i % 20000}" for i in range(70000))]
    rows = [(i, t, 0, "x") for i, t in enumerate(texts)] + [(5, texts[5], 0, "x"), (None, texts[7], 0, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, starts int, collapsed string").repartition(3)
    got = sorted((str(r.doc_id), list(zip(r.starts, r.lengths, r.periods, strict=True)), r.strongest, r.collapsed) for r in periodic.periodic_runs(frame).collect())
    want = []
    for i, t, *_ in rows:
        words = (t or "").replace("\n", " ").replace("\t", " ").split(" ")
        words = [w for w in words if w]
        runs = [(0, 70000, 20000)] if len(words) == 70000 else [(0, 12000, 3)] if len(words) == 12001 else brute(words)
        best = max(range(len(runs)), key=lambda k: (runs[k][1] / runs[k][2], -k), default=None)
        want.append((str(i), runs, best, collapsed(words, runs)))
    assert got == sorted(want)
    assert periodic.periodic_runs(frame.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(frame, 24, 2)


def test_strongest_breaks_ties_by_start_then_period():
    assert periodic.strongest([]) is None
    assert periodic.strongest([(0, 24, 8), (1, 30, 10), (5, 31, 10)]) == 2
    assert periodic.strongest([(0, 24, 8), (0, 30, 10), (5, 30, 10)]) == 0
