"""The minimum covariance determinant against the same in numpy, and against all subsets."""

import itertools
import math
import random

import numpy as np
import pytest

from locusmill.llm import quality
from locusmill.llm.queries import QUERIES

NOISE = np.diag([quality.LEAST_SPREAD[f] ** 2 for f in quality.FEATURES])
SF_DIR = "/root/testdata/sf0.001"


def covariance(x):
    return quality.CONSISTENCY * np.cov(x.T, bias=True).reshape(5, 5) + NOISE


def distances(x, centre, cov):
    off = x - centre
    return np.einsum("ij,ij->i", off @ np.linalg.inv(cov), off)


def plain_mcd(x):
    """Centre and covariance of numbers ``x`` (rows) by steps from both starts."""
    ranked = np.sort(x, axis=0)
    at = lambda q: ranked[math.ceil(q * len(x)) - 1]
    spread = (at(0.75) - at(0.25)) / 1.349
    best = None
    for centre, cov in ((at(0.5), np.diag(spread**2) + NOISE), (x.mean(0), covariance(x))):
        last = math.inf
        while True:
            bins = np.floor(np.log(distances(x, centre, cov) + 1e-6) * quality.BINS)
            order = np.sort(bins)
            need = math.ceil(quality.KEPT_SHARE * len(x))
            own = x[bins <= order[need - 1]]
            new = own.mean(0), covariance(own)
            size = np.linalg.slogdet(new[1])[1]
            if not size < last - quality.LEAST_GAIN:
                break
            (centre, cov), last = new, size
        if best is None or last < best[0]:
            best = last, centre, cov
    return best


def points(spark, groups):
    rows = [(g, *map(int, r)) for g, x in groups.items() for r in x]
    return spark.createDataFrame(rows, "group string, " + ", ".join(f"{f} long" for f in quality.FEATURES))


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(3)
    mixed = rng.normal(0, 60, (5, 5))
    usual = 500 + rng.normal(0, 1, (300, 5)) @ mixed
    far = 2500 + rng.normal(0, 40, (80, 5))
    return {
        "plain": usual.round(), "with outliers": np.concatenate([usual, far]).round(), "one": usual[:1].round(),
        "equal": np.repeat(usual[:1], 20, 0).round(), "few": np.concatenate([usual[:11], far[:3]]).round(),
    }


def test_estimates_equal_the_same_steps_in_numpy(spark, groups):
    found = {r.group: r for r in quality.estimated(points(spark, groups)).collect()}
    assert set(found) == set(groups)
    for name, x in groups.items():
        _, centre, cov = plain_mcd(x / quality.UNIT)
        r = found[name]
        whiten = np.array([[r[f"w_{i}{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
        assert np.allclose([r[f"m_{f}"] for f in quality.FEATURES], centre), name
        assert np.allclose(whiten.T @ whiten, np.linalg.inv(cov), rtol=1e-6), name


def test_outliers_of_a_fifth_do_not_move_the_estimate(groups):
    _, clean, cov = plain_mcd(groups["plain"] / quality.UNIT)
    _, centre, _ = plain_mcd(groups["with outliers"] / quality.UNIT)
    assert distances(centre[None], clean, cov)[0] < 0.5


def test_small_group_comes_close_to_the_least_determinant_of_all_subsets(groups):
    x = groups["few"] / quality.UNIT
    need = math.ceil(quality.KEPT_SHARE * len(x))
    least = min(np.linalg.slogdet(covariance(x[list(c)]))[1] for c in itertools.combinations(range(len(x)), need))
    assert plain_mcd(x)[0] <= least + 0.5


def test_query_verdicts_follow_from_the_estimates(spark):
    rows = QUERIES["op7_quality"](spark, SF_DIR).collect()
    docs = {r.doc_id: (r.lang, r.source) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(docs)
    texts = {r.doc_id: len((r.text or "").split("\n")) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    by_group = {}
    for r in rows:
        if not r.base_failed:
            by_group.setdefault(docs[r.doc_id], []).append(r)
    assert texts and sum(len(g) for g in by_group.values()) > 100
    solid = {r.doc_id: sum(bool(line.strip(" \t\n\x0b\x0c\r")) for line in (r.text or "").split("\n")) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    share = lambda a, b: math.sqrt(a / max(b, 1))
    for group in by_group.values():
        x = np.array([
            [
                math.log1p(r.n_words), math.log1p(r.word_chars / max(r.n_words, 1)), share(r.n_symbols, r.word_chars),
                share(r.n_dup_lines, solid[r.doc_id]), share(r.n_repeat_words, r.n_words),
            ]
            for r in group
        ])
        x = np.floor(x * quality.UNIT + 0.5) / quality.UNIT
        _, centre, cov = plain_mcd(x)
        want = distances(x, centre, cov)
        assert np.allclose([r.distance for r in group], want, rtol=1e-4)
        assert [r.kept for r in group] == (want <= quality.LIMIT).tolist()


def test_very_long_text_and_nulls(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=80)), "en", "s") for i in range(30)]
    rows += [(50, " ".join(rng.choices(words, k=60000)), "en", "s"), (51, None, None, None), (None, "a b c d e f g h i j k", None, None)]
    got = {r.doc_id: r for r in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert got[50].n_words == 60000 and not got[50].base_failed and got[51].n_words == 0 and not got[51].kept
    assert got[None].kept and sum(got[i].kept for i in range(30)) >= 28
