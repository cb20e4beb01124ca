"""Operator 12: hard negatives by exact inner products, several of them in one multiplication.

Vectors of whole numbers are compared by Kronecker's substitution. Components of a block of
candidates are biased so that none is negative, and those of several candidates are put into
separate fields of one wide integer, a field being as wide as the largest sum that can come up in
it. Each component of an anchor is multiplied once with such an integer, and the sum over all
components holds the sums of all its candidates, which are taken out of their fields and freed
from the bias. A wide integer is held in a double while it stays below 2^53, where products and
sums of whole numbers are exact and numpy multiplies whole blocks of them; wider ones are Python
integers.

Anchors are a table in the shared folder. Each task reads its candidates in blocks of bounded size
and for each block goes through the anchors, a bounded number at once. It passes on each anchor's
best rows of the block only, and a window with a limit that also works before the shuffle ranks
them. One such pass finds the positives, a second one the negatives in the bands that they give.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusmill.llm.blobs import opened
from locusmill.llm.shared import batch, fresh_folder, table

#: Components become whole numbers of this fraction.
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 30, 90
#: Candidates in a block (a power of two), cells in a block, and anchors that are compared at once.
BLOCK_ROWS, BLOCK_CELLS, ANCHORS = 1 << 15, 4 << 20, 128
#: Bits of a double that hold whole numbers, and fields in a wider integer.
DOUBLE_BITS, WIDE_FIELDS = 53, 8
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def quantised(vectors: pa.Array) -> np.ndarray:
    """``floor(SCALE * x)`` of the components as doubles, a row for each vector; short ones end in zeros."""
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), sizes.max(initial=0)))
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.floor(SCALE * flat)
    return out


class Packed:
    """A block of candidates in fields of wide integers, for anchors whose components reach ``most``."""

    def __init__(self, vectors: np.ndarray, low: float, high: float):
        n, self.width = vectors.shape
        self.rows, self.low = n, low
        self.own_low = min(0.0, vectors.min(initial=0))
        top = max(0.0, vectors.max(initial=0))
        # the largest sum in a field: every component of both at its largest, after the bias
        self.bits = max(1, (max(1, self.width) * (int(high) - int(low)) * (int(top) - int(self.own_low))).bit_length())
        self.fields = DOUBLE_BITS // self.bits
        self.exact = self.fields < 2
        if self.exact:
            self.fields = WIDE_FIELDS
            vectors, self.own_low, self.low = whole(vectors), int(self.own_low), int(low)
        groups = -(-n // self.fields)
        biased = np.full((groups * self.fields, self.width), 0, vectors.dtype)
        biased[:n] = vectors - self.own_low
        self.sums = vectors.sum(1)
        factors = [1 << self.bits * k for k in range(self.fields)]
        stacked = biased.reshape(self.fields, groups, self.width)
        self.packed = sum((stacked[k] * (f if self.exact else float(f)) for k, f in enumerate(factors[1:], 1)), stacked[0]).T.copy()

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products of the anchors with all candidates of the block, exactly.

        Products that no long holds count as the nearest long.
        """
        anchors = whole(anchors) if self.exact else anchors
        rest = (anchors - self.low) @ self.packed
        found = []
        for _ in range(self.fields - 1):
            above = rest >> self.bits if self.exact else np.floor(rest / 2.0**self.bits)
            found.append(rest - (above << self.bits if self.exact else above * 2.0**self.bits))
            rest = above
        fields = np.concatenate([*found, rest], 1)[:, : self.rows]
        out = fields + self.own_low * anchors.sum(1)[:, None] + self.low * self.sums - self.width * self.low * self.own_low
        return np.clip(out, LEAST, MOST).astype(np.int64) if self.exact else out.astype(np.int64)


def whole(values: np.ndarray) -> np.ndarray:
    """Python integers of any size."""
    return np.array([int(x) for x in values.reshape(-1).tolist()], object).reshape(values.shape)


class Block:
    """Candidates in order of id, and the bounds of what the anchors' components may be."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.known: dict = {}

    def scores(self, anchors: np.ndarray, label: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Candidates of the label (None: all), and their scores for each anchor."""
        width = max(anchors.shape[1], self.vectors.shape[1])
        # bounds to the next power of two, so that batches of anchors share packed candidates
        high, low = (2.0 ** np.ceil(np.log2(max(1.0, x))) for x in (anchors.max(initial=0), -anchors.min(initial=0)))
        key = (label, width, low, high)
        if key not in self.known:
            rows = np.arange(len(self.ids)) if label is None else np.flatnonzero(self.labels == label)
            if len(self.known) > 64:
                self.known.clear()
            self.known[key] = rows, Packed(_widened(self.vectors[rows], width), -low, high)
        rows, packed = self.known[key]
        return rows, packed.scores(_widened(anchors, width))


def _widened(vectors: np.ndarray, width: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))


def best(scores: np.ndarray, allowed: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` largest allowed scores, ties by smaller place (ids are in order)."""
    place = np.flatnonzero(allowed)
    if len(place) > most:
        cut = np.partition(scores[place], len(place) - most)[len(place) - most]
        place = place[scores[place] >= cut]
    # the complement falls as the score rises, for the least long too
    return place[np.lexsort((place, ~scores[place]))][:most]


def _blocks(batches) -> Iterator[Block]:
    """The rows of ``vec_id, label, embedding`` batches in blocks of bounded size."""
    held: list[tuple[np.ndarray, ...]] = []

    def joined() -> Block:
        width = max(v.shape[1] for _, _, v in held)
        columns = [np.concatenate(c) for c in zip(*[(i, x) for i, x, _ in held], strict=True)]
        return Block(*columns, np.concatenate([_widened(v, width) for _, _, v in held]))

    for part in batches:
        at = 0
        while at < len(part):
            width = max(1, pc.max(pc.list_value_length(part.column("embedding"))).as_py() or 1)
            room = max(1, min(BLOCK_ROWS, BLOCK_CELLS // width) - sum(len(h[0]) for h in held))
            piece = part.slice(at, room)
            held.append((piece.column("vec_id").to_numpy(), piece.column("label").to_numpy(), quantised(piece.column("embedding"))))
            at += len(piece)
            if len(piece) == room:
                yield joined()
                held = []
    if held:
        yield joined()


def _usable(rows: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` of the rows that take part."""
    usable = rows.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    return usable.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")


def _against(rows: DataFrame, anchors: DataFrame, label: str, schema: str, compare: Callable) -> DataFrame:
    """What ``compare`` finds for each block of rows and each batch of the anchors.

    The anchors are written to the shared folder, and tasks read their files batch by batch, so
    neither the driver nor a task holds all of them.
    """
    folder = fresh_folder(rows.sparkSession, label)
    anchors.write.parquet(folder)
    files = sorted(rows.sparkSession.read.schema(anchors.schema).parquet(folder).inputFiles())

    def run(batches):
        for block in _blocks(batches):
            for file in files:
                store, path = opened(file)
                with store.open_input_file(path) as source:
                    for part in pq.ParquetFile(source).iter_batches(ANCHORS):
                        yield batch(schema, *compare(block, part))

    return rows.mapInArrow(run, schema)


POSITIVE = "anchor_id long, version long, vec_id long, score long"
NEGATIVE = "anchor_id long, version long, positive int, vec_id long, score long"


def _positives(block: Block, part: pa.RecordBatch, most: int):
    """Each anchor's best rows of its own label in the block."""
    ids, versions, labels = (part.column(c).to_numpy() for c in ("vec_id", "version", "label"))
    vectors = quantised(part.column("embedding"))
    out: list[tuple[np.ndarray, ...]] = []
    for label in np.unique(labels).tolist():
        own = np.flatnonzero(labels == label)
        if not (block.labels == label).any():
            continue
        rows, scores = block.scores(vectors[own], label)
        for i, each in zip(own, scores, strict=True):
            place = best(each, block.ids[rows] != ids[i], most)
            out.append((np.full(len(place), ids[i]), np.full(len(place), versions[i]), block.ids[rows][place], each[place]))
    return [np.concatenate(c) for c in zip(*out, strict=True)] or [np.zeros(0, np.int64)] * 4


def _negatives(block: Block, part: pa.RecordBatch, most: int, low: int, high: int):
    """For each anchor and positive, the best rows of other labels in the block within the positive's band."""
    ids, versions, labels = (part.column(c).to_numpy() for c in ("vec_id", "version", "label"))
    rows, scores = block.scores(quantised(part.column("embedding")), None)
    out: list[tuple[np.ndarray, ...]] = []
    for i, positives in enumerate(part.column("positives").to_pylist()):
        other = block.labels != labels[i]
        for p in positives:
            # low * p <= 100 * score <= high * p
            band = other & (scores[i] >= -(-low * p["score"] // 100)) & (scores[i] <= high * p["score"] // 100)
            place = best(scores[i], band, most)
            out.append((np.full(len(place), ids[i]), np.full(len(place), versions[i]), np.full(len(place), p["positive"]), block.ids[place], scores[i][place]))
    return [np.concatenate(c) for c in zip(*out, strict=True)] or [np.zeros(0, np.int64)] * 5


def _ranked(found: DataFrame, keys: list[str], name: str, most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= most)


def hard_negatives(
    rows: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``vec_id, label, embedding`` rows.

    Anchors are the rows whose id is divisible by ``every``. An anchor's positives are its best
    rows with the same label and another id; for each of them, the best rows with another label
    whose score lies between ``low`` and ``high`` hundredths of the positive's are its negatives,
    ranked from 1. Higher scores come first, ties by smaller id.

    Rows with a null id, label, vector or component, or a component that is no finite number,
    take no part. A vector that is shorter than another counts as ending in zeros. Rows that
    repeat an id are each a candidate; as anchors, equal rows count once and others each by
    themselves. Anchors without a positive or without a row in the band give nothing, nor does an
    empty table. Scores that no long holds count as the nearest long. Other columns are not read.
    """
    usable = _usable(rows)
    version = F.xxhash64("label", "embedding").alias("version")
    anchors = usable.where(F.col("vec_id") % every == 0).select("*", version)
    # by label, so that a batch of anchors has few labels; hot labels may take several partitions
    anchors = anchors.dropDuplicates(["vec_id", "version"]).repartitionByRange("label", "vec_id", "version").sortWithinPartitions("label")
    found = _against(usable, anchors, "negatives-anchors", POSITIVE, lambda b, p: _positives(b, p, positives))
    key = ["anchor_id", "version"]
    near = _ranked(found, key, "positive", positives).groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("positive", "vec_id", "score"))).alias("positives")
    )
    named = anchors.withColumnRenamed("vec_id", "anchor_id").join(near, key)
    named = named.select(F.col("anchor_id").alias("vec_id"), "version", "label", "embedding", "positives")
    folder = fresh_folder(rows.sparkSession, "negatives-positives")
    named.write.parquet(folder)
    named = rows.sparkSession.read.schema(named.schema).parquet(folder)
    found = _against(usable, named, "negatives-bands", NEGATIVE, lambda b, p: _negatives(b, p, negatives, low, high))
    ranked = _ranked(found, [*key, "positive"], "rank", negatives)
    owners = named.select(F.col("vec_id").alias("anchor_id"), "version", F.explode("positives").alias("p"))
    owners = owners.select(*key, "p.positive", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    return ranked.join(owners, [*key, "positive"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of ``embeddings``, with the labels of every seventh row moved on."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives(rows, 100, 5, 10, 30, 90)


OP12_SQL = r"""
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""
