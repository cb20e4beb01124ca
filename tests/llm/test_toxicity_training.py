"""Toxicity: subwords, training and scoring against their definitions."""

import math
import random
import zlib

import numpy as np

from locusmill.llm import toxicity
from locusmill.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def small_bags(n=40, seed=3):
    rng = random.Random(seed)
    found = [toxicity.bag(" ".join(rng.choices(["stone", "river", "vexhollow", "vexhollows", "lamp"], k=5))) for _ in range(n)]
    labels = np.array([rng.randrange(2) for _ in range(n)])
    parts = []
    for y, p in zip(np.split(labels, [n // 3]), (found[: n // 3], found[n // 3 :]), strict=True):
        sizes = np.array([len(f[0]) for f in p])
        parts.append((y, np.arange(len(p)) * 7 % 5, sizes, *(np.concatenate(c) for c in zip(*p, strict=True))))
    return toxicity.weighed(lambda: parts)


def test_ngrams_of_long_words_are_those_of_the_whole_word():
    word = "".join(random.Random(1).choices("abcdé日", k=200))
    marked = f"<{word}>"
    want = {marked[i : i + k] for k in range(toxicity.SHORTEST, toxicity.LONGEST + 1) for i in range(len(marked) - k + 1)}
    assert toxicity.words_of(f"({word.upper()})") == ["(", word, ")"]
    owner, bucket = toxicity.ngrams([word])
    assert len(bucket) == sum(len(marked) - k + 1 for k in (3, 4, 5)) and set(owner.tolist()) == {0}
    # equal n-grams have equal buckets, wherever they stand
    alone = {g: toxicity.ngrams([word])[1].tolist() for g in want}
    assert len({tuple(v) for v in alone.values()}) == 1 and len(set(bucket.tolist())) >= len(want) - 2


def test_shares_add_up_and_weights_are_inverse_frequencies():
    bags, weight = small_bags()
    starts = np.concatenate([[0], bags.ends[:-1]])
    assert np.allclose(np.add.reduceat(bags.shares, starts), 1, atol=1e-5)
    texts = np.bincount(bags.buckets, minlength=toxicity.BUCKETS)
    assert np.allclose(weight, np.log(41 / (texts + 1)))


def test_gradients_equal_differences_of_the_loss():
    bags, weight = small_bags()
    net, rows = toxicity.Network(toxicity.BUCKETS), np.arange(20)
    row_weight = np.linspace(0.5, 2, 20)
    flat, share, doc = bags.take(rows)

    def loss():
        _, p = net.forward(flat, share, doc, 20)
        return float(-(row_weight * np.log(p[np.arange(20), bags.labels[rows]])).mean())

    net.vectors, net.softmax = net.vectors.astype(float), net.softmax.astype(float)
    by = dict(zip(("vectors", "softmax", "bias"), net.gradients(flat, share, doc, bags.labels[rows], row_weight), strict=True))
    net.bias = net.bias.astype(float)
    for name, place in (("vectors", (flat[0], 1)), ("vectors", (flat[-1], 3)), ("softmax", (2, 0)), ("bias", (1,))):
        value, step = getattr(net, name), 1e-4
        value[place] += step
        above = loss()
        value[place] -= 2 * step
        below = loss()
        value[place] += step
        assert math.isclose((above - below) / (2 * step), by[name][place], rel_tol=1e-3, abs_tol=1e-7)


def test_scores_are_the_softmax_over_the_mean_vector(monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 30)
    bags, weight = small_bags()
    net = toxicity.train(bags)
    model = toxicity.model_of(bags, weight)
    for text in ("a vexhollow by the river, stone!", "lamp lamp lamp", "stones", "stone unheard"):
        buckets, counts = toxicity.bag(text)
        own = counts * model.weight[buckets]
        seen = np.isin(buckets, bags.buckets)
        mean = (own[:, None] * net.vectors[buckets] * seen[:, None]).sum(0) / own.sum()
        logits = mean @ net.softmax + net.bias
        want = 1 / (1 + math.exp(logits[0] - logits[1]))
        assert math.isclose(toxicity.Scorer(model).run([text])[0], want, rel_tol=1e-3)


def test_labels_that_repeat_or_contradict(spark):
    docs = spark.createDataFrame([(i, f"text {i % 2} words", 0) for i in range(20)], "doc_id long, text string, toxic int")
    once = [(i, i % 2) for i in range(20)]
    plain = toxicity.fit(docs, spark.createDataFrame(once, "doc_id long, toxic int"))
    repeated = toxicity.fit(docs, spark.createDataFrame([*once, *once, (99, 1), (99, 0), (5, None), (None, 1), (4, 7)], "doc_id long, toxic int"))
    assert np.array_equal(plain.gain, repeated.gain) and plain.constant == repeated.constant
    # 3 is said to be both: as if it had no label
    without = toxicity.fit(docs, spark.createDataFrame([x for x in once if x[0] != 3], "doc_id long, toxic int"))
    both = toxicity.fit(docs, spark.createDataFrame([*once, (3, 0)], "doc_id long, toxic int"))
    assert np.array_equal(without.gain, both.gain)


def test_query_holds_out_a_fifth_and_finds_toxic_texts(spark):
    rows = QUERIES["op5_toxicity"](spark, SF_DIR).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    toxic, clean = [p for y, p in held if y], [p for y, p in held if not y]
    # the small table has some 300 labelled rows to learn from
    assert sum(toxic) >= 0.5 * len(toxic) and sum(clean) <= 0.05 * len(clean)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert toxicity.scored(docs, model).collect() == [] and toxicity.without_toxic(docs, model).collect() == []
