"""Operator 5: toxicity by bags of subwords.

A word is the character n-grams of it between ``<`` and ``>``, and a text the mean of the vectors
of all n-grams of its words, rare n-grams weighing more; a softmax over that mean gives the score.
Vectors and softmax are trained together, in numpy, on a bounded sample of labelled rows. A
misspelt word shares most n-grams with the word that it stands for. Every n-gram has a vector;
the weight of one that many texts have is small, and plain descent leaves those that occur by
chance near zero.

Bags are made where the sample lies, and one task trains: the driver gets the finished model
alone. As the softmax is linear, an n-gram adds the same amount to a text's score wherever it
stands, so scoring sums one number a word, which tasks remember.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.llm.blobs import opened
from locusmill.llm.shared import batch, checksum, fresh_folder, sampled, slices, table, written

#: Words are read in lower case, without the marks around them.
WORDS = re.compile(r"[^\W_]+|[^\w\s]")
SHORTEST, LONGEST = 3, 5
BUCKETS, WIDTH = 1 << 20, 4
#: Labelled rows in the sample that the vectors are fitted on.
SAMPLE_ROWS = 8_000
#: The vectors' step is large, as their gradients are shares of a mean.
STEPS, BATCH, VECTOR_STEP, SOFTMAX_STEP, SEED = 2_000, 64, 5_000.0, 0.1, 7
#: Bags that the training task reads at once.
BAGS_AT_ONCE = 256
#: Chosen by cross-validation on labelled rows that are not held out.
RARITY = 2 / 3
REMEMBERED = 200_000


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word number and bucket of every n-gram of the words, whole words included."""
    text = "".join([f"<{w}>" for w in words])
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    h = np.zeros(len(codes), np.uint64)
    owner, bucket = [], []
    for k in range(LONGEST):
        h = (h[: len(codes) - k] + codes[k:] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if k + 1 >= SHORTEST:
            inside = np.arange(len(h)) + k + 1 <= ends[: len(h)]
            owner.append(word[: len(h)][inside])
            bucket.append((h[inside] >> np.uint64(20)) % np.uint64(BUCKETS))
    return np.concatenate(owner), np.concatenate(bucket).astype(np.int64)


class Model:
    """For each bucket its weight in the mean, and what it adds to a score times that weight."""

    def __init__(self, weight: np.ndarray, gain: np.ndarray, constant: float):
        self.weight, self.gain, self.constant = weight.astype(np.float32), gain.astype(np.float32), constant


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's n-grams, and how often each occurs."""
    words = words_of(text or "")
    return np.unique(ngrams(words)[1] if words else np.zeros(0, np.int64), return_counts=True)


@dataclass
class Bags:
    """Labelled bags one after another: ``ends`` closes each one's ``buckets`` and ``shares``.

    ``order`` is an order of the bags that does not depend on how they arrived.
    """

    labels: np.ndarray
    ends: np.ndarray
    buckets: np.ndarray
    shares: np.ndarray
    order: np.ndarray

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets and shares of some bags, and the place in ``rows`` that each belongs to."""
        start, stop = np.where(rows > 0, self.ends[rows - 1], 0), self.ends[rows]
        sizes = stop - start
        at = np.arange(sizes.sum()) + np.repeat(start - (np.cumsum(sizes) - sizes), sizes)
        return self.buckets[at], self.shares[at], np.repeat(np.arange(len(rows)), sizes)


def weighed(parts: Callable[[], Iterable[tuple[np.ndarray, ...]]]) -> tuple[Bags, np.ndarray]:
    """Bags with each bucket's share of its text, and the buckets' weights.

    ``parts`` gives, each time it is called, labels, digests of texts, sizes of bags, and their
    buckets and counts, some bags at a time; so the bags are held once. A weight is the logarithm
    of one text in how many has the bucket; one that all texts have tells nothing and weighs nothing.
    """
    n, total, texts = 0, 0, np.zeros(BUCKETS, np.int64)
    for labels, _, _, buckets, _ in parts():
        n, total = n + len(labels), total + len(buckets)
        texts += np.bincount(buckets, minlength=BUCKETS)
    weight = np.log((n + 1) / (texts + 1)).astype(np.float32)
    all_buckets, shares, at = np.empty(total, np.int32), np.empty(total, np.float32), 0
    rows: list[tuple[np.ndarray, ...]] = []
    for labels, digests, sizes, buckets, counts in parts():
        share = counts * weight[buckets]
        doc = np.repeat(np.arange(len(sizes)), sizes)
        own = slice(at, at + len(buckets))
        all_buckets[own], shares[own] = buckets, share / np.maximum(np.bincount(doc, share, len(sizes)), 1e-9)[doc]
        rows.append((labels, digests, sizes))
        at += len(buckets)
    labels, digests, sizes = (np.concatenate(c) for c in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 3
    return Bags(labels, np.cumsum(sizes), all_buckets, shares, np.lexsort([labels, digests])), weight


def seen_in(bags: Bags) -> np.ndarray:
    """Whether each bucket is in any bag."""
    seen = np.zeros(BUCKETS, bool)
    seen[bags.buckets] = True
    return seen


class Network:
    """Vectors of the buckets and the softmax over a text's mean vector."""

    def __init__(self, size: int):
        rng = np.random.default_rng(SEED)
        self.vectors = rng.normal(0, 0.1, (size, WIDTH)).astype(np.float32)
        self.softmax = rng.normal(0, 0.3, (WIDTH, 2)).astype(np.float32)
        self.bias = np.zeros(2, np.float32)

    def forward(self, flat: np.ndarray, share: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Mean vectors of ``n`` bags, and the probabilities of their classes."""
        mean = np.stack([np.bincount(doc, share * self.vectors[flat, d], n) for d in range(WIDTH)], 1)
        logits = mean @ self.softmax + self.bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        return mean, p / p.sum(1, keepdims=True)

    def gradients(self, flat, share, doc, labels: np.ndarray, row_weight: np.ndarray):
        """Of the weighted mean of the cross entropies: by vectors, softmax and bias."""
        mean, p = self.forward(flat, share, doc, len(labels))
        error = (p - np.eye(2)[labels]) * row_weight[:, None] / len(labels)
        pull = error @ self.softmax.T
        by_vector = [np.bincount(flat, share * pull[doc, d], len(self.vectors)) for d in range(WIDTH)]
        return np.stack(by_vector, 1), mean.T @ error, error.sum(0)


def train(bags: Bags) -> Network:
    """Vectors and softmax, trained together by gradient descent on small batches of bags.

    Rows weigh by how rare their class is, to the power of ``RARITY``, so that a rare class counts
    without outvoting the common one. Batches are drawn from the bags in their order.
    """
    net = Network(BUCKETS)
    classes = np.maximum(np.bincount(bags.labels, minlength=2), 1)
    row_weight = ((classes.sum() / classes) ** RARITY)[bags.labels]
    row_weight /= row_weight.mean()
    # only buckets that occur have gradients
    kept = np.flatnonzero(seen_in(bags))
    place = np.zeros(BUCKETS, np.int32)
    place[kept] = np.arange(len(kept))
    all_vectors, net.vectors = net.vectors, net.vectors[kept]
    rng, done = np.random.default_rng(SEED), 0
    while done < STEPS:
        order = bags.order[rng.permutation(len(bags.labels))]
        for at in range(0, len(order), BATCH)[: STEPS - done]:
            rows, rate = order[at : at + BATCH], 1 - done / STEPS
            buckets, shares, doc = bags.take(rows)
            vectors, softmax, bias = net.gradients(place[buckets], shares, doc, bags.labels[rows], row_weight[rows])
            net.vectors -= (VECTOR_STEP * rate * vectors).astype(np.float32)
            net.softmax -= (SOFTMAX_STEP * rate * softmax).astype(np.float32)
            net.bias -= (SOFTMAX_STEP * rate * bias).astype(np.float32)
            done += 1
    all_vectors[kept] = net.vectors
    net.vectors = all_vectors
    return net


def model_of(bags: Bags, weight: np.ndarray) -> Model:
    """The trained model; of bags of one class, or of none, a model that always says that class (none: 0)."""
    if len(np.unique(bags.labels)) < 2:
        constant = 40.0 if len(bags.labels) and bags.labels[0] else -40.0
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), constant)
    net = train(bags)
    # n-grams that the sample lacks say nothing, but belong to the mean
    seen = seen_in(bags)
    gain = weight * (net.vectors @ (net.softmax[:, 1] - net.softmax[:, 0])) * seen
    return Model(weight, gain, float(net.bias[1] - net.bias[0]))


def _bags(rows: DataFrame) -> DataFrame:
    """Label, digest and bag of each text."""
    schema = "toxic int, digest long, bucket array<int>, times array<int>"

    def run(batches):
        for part in slices(batches, "text"):
            found = [bag(t) for t in part.column("text").to_pylist()]
            yield batch(schema, part.column("toxic"), part.column("digest"), [f[0].astype(np.int32) for f in found], [f[1].astype(np.int32) for f in found])

    return rows.select("toxic", F.xxhash64("text").alias("digest"), "text").mapInArrow(run, schema)


def _stored(file: str) -> Iterator[tuple[np.ndarray, ...]]:
    """Parts of a file of bags, as :func:`weighed` takes them."""
    store, path = opened(file)
    with store.open_input_file(path) as source:
        for part in pq.ParquetFile(source).iter_batches(BAGS_AT_ONCE, use_threads=False):
            lists = [part.column(c) for c in ("bucket", "times")]
            sizes = lists[0].value_lengths().to_numpy(zero_copy_only=False)
            yield part.column("toxic").to_numpy(), part.column("digest").to_numpy(), sizes, *(x.flatten().to_numpy() for x in lists)


def _trained(bags: DataFrame) -> DataFrame:
    """``weight, gain, constant`` of the model, made in one task from all bags of the sample.

    The bags are a table in the shared folder, which the task reads twice, some bags at a time.
    """
    schema, spark = "weight binary, gain binary, constant double", bags.sparkSession
    folder = fresh_folder(spark, "toxicity-bags")
    bags.write.parquet(folder)
    files = sorted(spark.read.schema(bags.schema).parquet(folder).inputFiles())

    def run(batches):
        for _ in batches:
            model = model_of(*weighed(lambda: (part for file in files for part in _stored(file))))
            yield batch(schema, [model.weight.tobytes()], [model.gain.tobytes()], [model.constant])

    return spark.range(0, 1, 1, 1).mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> Model:
    """A model from the texts of ``docs`` and the ``doc_id, toxic`` rows of ``labels``.

    About ``most`` labelled documents are taken. One task holds their bags; the driver gets the
    model. Labels other than 0 and 1, labels of an id that contradict each other, and rows without
    id, label or text are left out; labels that repeat count once, and rows that repeat an id are
    each a text of it. With rows of one class, every score is that class; without rows, every
    score is 0.
    """
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    agreed = usable.groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("most"))
    chosen = sampled(agreed.where("toxic = most").drop("most"), None, most, "doc_id", "toxicity")
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    # the sample is bounded by its own size, so it may be sent to all tasks
    rows = written(texts.join(F.broadcast(chosen), "doc_id"), "toxicity-sample")
    found = _trained(_bags(rows)).first()
    return Model(np.frombuffer(found.weight, np.float32), np.frombuffer(found.gain, np.float32), found.constant)


class Scorer:
    def __init__(self, model: Model):
        self.model, self.known, self.values = model, {}, np.zeros((0, 2))

    def run(self, texts: list[str | None]) -> np.ndarray:
        words = [words_of(t or "") for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.values = {}, self.values[:0]
        new = list(set().union(*words) - self.known.keys())
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            owner, bucket = ngrams(new)
            sums = [np.bincount(owner, x[bucket], len(new)) for x in (self.model.gain, self.model.weight)]
            self.values = np.concatenate([self.values, np.stack(sums, 1)])
        logits = np.full(len(texts), self.model.constant)
        for i, each in enumerate(words):
            if each:
                gain, weight = self.values[np.fromiter(map(self.known.__getitem__, each), np.int64, len(each))].sum(0)
                logits[i] += gain / max(1e-9, weight)
        return 1 / (1 + np.exp(-np.clip(logits, -40, 40)))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of each whole text. A null text counts as empty and has the constant's
    score. Equal rows give equal rows; no other column is read."""

    def run(batches):
        scorer = Scorer(model)
        for part in slices(batches, "text"):
            yield batch("doc_id long, score double", part.column("doc_id"), scorer.run(part.column("text").to_pylist()))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores below the threshold, with all their columns, which may have any
    names. Rows are scored where they are read, so nothing is shuffled or joined."""

    def run(batches):
        scorer = Scorer(model)
        for part in slices(batches, "text"):
            keep = scorer.run(part.column("text").to_pylist()) < threshold
            yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def _learnable(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    return docs, labels.where(checksum(F.col("doc_id")) % 5 != 0)


def production_model(spark: SparkSession, sf_dir: str) -> Model:
    """Learned from the rows of ``labels`` that are not held out."""
    return fit(*_learnable(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``, learned from labels that are not held out.

    Null and empty texts have the score of a text without words; a null id is not held out."""
    found = scored(table(spark, sf_dir, "documents"), production_model(spark, sf_dir))
    held_out = F.coalesce(checksum(F.col("doc_id")) % 5 == 0, F.lit(False))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return found.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))
