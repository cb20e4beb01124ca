"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest

from locusmill.llm import negatives


@pytest.mark.parametrize("size", [1, 3, 300, 2**12, 2**20, 2**40, 2**70])
def test_packed_products_are_exact(size):
    rng = random.Random(size)
    make = lambda rows: [[rng.randint(-size, size) for _ in range(9)] for _ in range(rows)]
    candidates, anchors = make(37), make(5)
    # such large numbers as doubles hold
    candidates, anchors = ([[int(float(x)) for x in r] for r in rows] for rows in (candidates, anchors))
    packed = negatives.Packed(np.array(candidates, float), -float(2 * size), float(2 * size))
    want = [[min(max(sum(x * y for x, y in zip(a, c, strict=True)), negatives.LEAST), negatives.MOST) for c in candidates] for a in anchors]
    assert packed.scores(np.array(anchors, float)).tolist() == want
    assert packed.fields >= 2


def brute(rows, every=100, n_positives=5, n_negatives=10, low=30, high=90):
    usable = [
        (i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    score = lambda a, b: min(max(sum(x * y for x, y in zip(a, b)), negatives.LEAST), negatives.MOST)  # noqa: B905, E731
    out = []
    anchors = {(i, label, tuple(v)) for i, label, v in usable if i % every == 0}
    for i, label, v in anchors:
        scored = sorted((-score(v, w), j, other) for j, other, w in usable if j != i)
        for s, j, _ in [x for x in scored if x[2] == label][:n_positives]:
            p = -s
            band = [x for x in scored if x[2] != label and low * p <= -100 * x[0] <= high * p]
            out += [(i, j, rank, x[1], p, -x[0]) for rank, x in enumerate(band[:n_negatives], 1)]
    return sorted(out)


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label long, embedding array<double>, version int, score string")


@pytest.mark.parametrize("cells", [4 << 20, 40])
def test_hard_negatives_match_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(negatives, "BLOCK_CELLS", cells)
    rng = random.Random(5)
    rows = [(i, rng.choice([0, 0, 0, 1, 2]), [round(rng.gauss(0.1, 0.3), 1) for _ in range(6)]) for i in range(400)]
    rows[7] = (None, 0, [1.0] * 6)
    rows[8:14] = [(8, None, [1.0] * 6), (9, 0, None), (10, 0, [1.0, None]), (11, 0, [float("inf")] * 6), (12, 1, [float("nan")] * 6), (13, 0, [])]
    rows += [rows[100], rows[20], rows[20], (200, 1, [0.5] * 6), (401, 0, [0.5] * 3), (402, 1, [0.2] * 9)]
    got = negatives.hard_negatives(frame_of(spark, rows).repartition(4))
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert negatives.hard_negatives(frame_of(spark, rows).limit(0)).collect() == []


def test_large_components_and_ties(spark):
    rng = random.Random(6)
    for size in (1.0, 1e7, 1e30):
        rows = [(i, i % 3, [rng.choice([0.0, size, -size, size / 2]) for _ in range(4)]) for i in range(120)]
        assert sorted(map(tuple, negatives.hard_negatives(frame_of(spark, rows)).collect())) == brute(rows)


def test_parameters(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice([-3, 4]), [rng.gauss(0.2, 0.3) for _ in range(5)]) for i in range(150)]
    got = negatives.hard_negatives(frame_of(spark, rows), every=40, positives=2, negatives=3, low=10, high=95)
    assert sorted(map(tuple, got.collect())) == brute(rows, 40, 2, 3, 10, 95)
