"""Operator 10: near-duplicate documents by SuperMinHash.

A text's set is its distinct three-word shingles, as 64-bit hashes. Every shingle walks its own
random permutation of the signature's slots and leaves in its j-th slot the number j plus a random
fraction; a slot keeps the smallest number. After round j no number below j can come, so a text
whose slots are all below j is ready, which for most texts is after two rounds. Signatures of
close sets share bands, and texts that share a band are compared on their full sets.

Texts with equal sets are one class from the start (a sum of two mixed hashes over the set, 128
bits), so copies never meet in a band. A class has a number of its own, and is named by the
smallest id of its rows; so an id that comes with several texts is in several classes. In a band's bucket no pairs of all members are made. First
each class is compared with one of the bucket, the one that meets most others over all buckets. Then only buckets whose members still lie in
several components go on, without the members that a bound rules out: a set of which more than
the limit allows (at 85 percent, 15 of 100 shingles) are in no other of the sets is linked with nothing. What lies outside a
bucket's commonest component is compared with all that lies in other components and that a second
bound allows: two sets have no more in common than the smaller of their parts inside a third set,
the name of the commonest component, and the smaller of their parts outside of it that other sets
share. So every pair of a bucket is compared, joined already, or proven not to be a link.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.llm.groups import components
from locusmill.llm.shared import batch, slices, table, written

#: Links have 100 * intersection >= PERCENT * union, for sets of shingles of SHINGLE words, unless
#: a caller gives other values.
PERCENT = 85
SHINGLE = 3
#: A pair at the limit misses all bands with this probability at most.
MISSED, MOST_SLOTS = 3e-7, 192
#: Bytes of text whose signatures are made at once.
AT_ONCE = 1 << 20
U64 = np.uint64
SKETCH = "doc_id long, version long, n_shingles long, d1 long, d2 long, bands array<long>"


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows for a limit: the most rows with which the bands that it takes fit the slots."""
    need = {r: math.ceil(math.log(MISSED) / math.log1p(-((percent / 100) ** r))) for r in range(1, 13)}
    rows = max((r for r, bands in need.items() if bands * r <= MOST_SLOTS), default=1)
    return need[rows], rows


BANDS, ROWS = banding(PERCENT)
SLOTS = BANDS * ROWS


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit numbers."""
    z = x + U64((salt + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ z >> U64(30)) * U64(0xBF58476D1CE4E5B9)
    z = (z ^ z >> U64(27)) * U64(0x94D049BB133111EB)
    return z ^ z >> U64(31)


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; empty for null and for no words."""
    import pandas as pd

    listed = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = listed.flatten()
    solid = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(listed).to_numpy(zero_copy_only=False))[solid]
    coded = words.filter(pa.array(solid)).dictionary_encode()
    names = pd.util.hash_array(np.asarray(coded.dictionary.to_pylist(), object), categorize=False)
    codes = names[coded.indices.to_numpy()] if len(coded) else np.zeros(0, U64)
    ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
    rolled = codes.copy()
    for k in range(1, width):
        rolled[: len(codes) - k] = mixed(rolled[: len(codes) - k], k) + codes[k:]
    out, start = [], 0
    for end in ends.tolist():
        if end - start >= width:
            out.append(np.unique(rolled[start : end - width + 1]))
        elif end > start:
            whole = codes[start : start + 1]
            for k in range(start + 1, end):
                whole = mixed(whole, 7) + codes[k : k + 1]
            out.append(mixed(whole, 11 + end - start))
        else:
            out.append(np.zeros(0, U64))
        start = end
    return out


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of each set: per slot, the round and a 32-bit fraction in one number."""
    best = np.full((len(sets), slots), np.iinfo(U64).max, U64)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    element = np.concatenate(sets) if sets else np.zeros(0, U64)
    swaps: list[np.ndarray] = []
    flat = best.reshape(-1)
    for j in range(slots):
        if not len(element):
            break
        z = mixed(element, j)
        k = (j + ((z & U64(0xFFFFFFFF)) * U64(slots - j) >> U64(32)).astype(np.int64)).astype(np.int64)
        # the slot at place k of this element's permutation: undo its swaps, last first
        slot = k
        for i in range(j - 1, -1, -1):
            other = swaps[i]
            slot = np.where(slot == i, other, np.where(slot == other, i, slot))
        swaps.append(k)
        np.minimum.at(flat, doc * slots + slot, U64(j << 32) | z >> U64(32))
        on = (best.max(1) >= U64(j + 1 << 32))[doc]
        if not on.all():
            doc, element, swaps = doc[on], element[on], [s[on] for s in swaps]
    return best


def band_hashes(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    grouped = signature.reshape(len(signature), bands, rows)
    h = np.broadcast_to(np.arange(bands, dtype=U64), (len(signature), bands))
    for r in range(rows):
        h = mixed(h ^ grouped[:, :, r], r)
    return h.view(np.int64)


def _nested(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.reshape(-1)))


def _version() -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64("text").alias("version")


def sketches(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, a hash of the text, the size of its set, the set's 128-bit digest, and its band hashes."""
    n_bands, n_rows = banding(percent)

    def run(batches):
        for part in slices(batches, "text", AT_ONCE):
            sets = shingle_sets(part.column("text"), width)
            sums = [np.array([mixed(s, salt).sum(dtype=U64) for s in sets], U64).view(np.int64) for salt in (101, 202)]
            bands = band_hashes(signatures(sets, n_bands * n_rows), n_bands, n_rows)
            yield batch(SKETCH, part.column("doc_id"), part.column("version"), [len(s) for s in sets], *sums, _nested(bands))

    return docs.select("doc_id", _version(), "text").mapInArrow(run, SKETCH)


def _sets(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """``node`` of each class and its set, made from the text that names it."""
    schema = "node long, hashes array<long>"
    named = classes.select("node", F.col("rep").alias("doc_id"), "version")
    texts = docs.select("doc_id", _version(), "text").join(named, ["doc_id", "version"])

    def run(batches):
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text"), width)
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32))
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield batch(schema, part.column("node"), pa.ListArray.from_arrays(offsets, pa.array(flat)))

    # rows that repeat a document are equal
    return texts.select("node", "text").mapInArrow(run, schema).dropDuplicates(["node"])


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are close enough."""
    one = sets.select(F.col("node").alias("a"), F.col("hashes").alias("in_a"))
    two = sets.select(F.col("node").alias("b"), F.col("hashes").alias("in_b"))
    both = F.size(F.array_intersect("in_a", "in_b"))
    return (
        pairs.join(one, "a").join(two, "b")
        .where(100 * both >= percent * (F.size("in_a") + F.size("in_b") - both))
        .select("a", "b")
    )


def _mixed_buckets(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component; ``core`` is the commonest one."""
    counts = members.groupBy("band", "hash", "component").agg(F.count("*").alias("n"))
    cores = counts.groupBy("band", "hash").agg(
        F.count("*").alias("several"), F.max(F.struct("n", "component"))["component"].alias("core")
    )
    return members.join(cores.where("several > 1").select("band", "hash", "core"), ["band", "hash"])


def _shared_sizes(sets: DataFrame) -> DataFrame:
    """``node, shared``: how many shingles of each set are in another of these sets too."""
    shingles = sets.select("node", F.explode("hashes").alias("h"))
    alone = shingles.groupBy("h").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1")
    counts = alone.groupBy("node").agg(F.count("*").alias("alone"))
    return sets.join(counts, "node", "left").select(
        "node", (F.size("hashes") - F.coalesce("alone", F.lit(0))).alias("shared")
    )


def _in_pivots(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, core, inside``: shingles that a member has in common with its bucket's core."""
    one = sets.select("node", F.col("hashes").alias("own"))
    two = sets.select(F.col("node").alias("core"), F.col("hashes").alias("pivot"))
    pairs = members.select("node", "core").distinct()
    return pairs.join(one, "node").join(two, "core").select(
        "node", "core", F.size(F.array_intersect("own", "pivot")).alias("inside")
    )


def _can_link(percent: int) -> Column:
    """A bound on what two sets have in common: within the bucket's core, and outside of it only
    shingles that are shared at all.

    The sets that ``shared`` counts hold all cores, so a set's part inside its core is shared; a
    core itself has nothing outside, but shingles of its own inside.
    """
    outside = [F.greatest(F.col("shared" + x) - F.col("inside" + x), F.lit(0)) for x in ("", "_b")]
    most = F.least("inside", "inside_b") + F.least(*outside)
    return 100 * most >= percent * (F.col("size") + F.col("size_b") - most)


def _remaining_pairs(members: DataFrame, labels: DataFrame, sets: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs ``a, b`` of different components in one bucket that may still be linked.

    Members outside a bucket's commonest component meet all members that lie in another one, so
    members that are joined already are not paired with each other again.
    """
    named = members.join(labels, "node", "left").select(
        "band", "hash", "node", "size", F.coalesce("component", "node").alias("component")
    )
    rest = written(_mixed_buckets(named).drop("core"), "near-mixed")
    # names of components too: each may be a core, though it is in no such bucket itself
    left = rest.select(F.explode(F.array("node", "component")).alias("node")).distinct()
    shared = _shared_sizes(sets.join(left, "node", "left_semi"))
    able = rest.join(shared, "node").where(100 * F.col("shared") >= percent * F.col("size"))
    able = written(_mixed_buckets(able), "near-mixed")
    able = able.join(_in_pivots(able, sets), ["node", "core"]).join(classes.select("node", "bands"), "node")
    able = written(able, "near-able")
    # a pair comes from the first bucket that both are in
    first_common = F.array_position(F.zip_with("bands", "bands_b", lambda x, y: x == y), True)
    others = able.select(
        "band", "hash", F.col("node").alias("b"), F.col("size").alias("size_b"),
        F.col("shared").alias("shared_b"), F.col("inside").alias("inside_b"), F.col("bands").alias("bands_b"), F.col("component").alias("component_b"),
    )
    return (
        able.where("component != core")
        .join(others, ["band", "hash"])
        .where((F.col("component_b") == F.col("core")) | (F.col("component") < F.col("component_b")))
        .where(_can_link(percent))
        .where(first_common == F.col("band") + 1)
        .select(F.col("node").alias("a"), "b")
        .distinct()
    )


def links(docs: DataFrame, classes: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``node, component`` of the classes that are linked; the smallest number is the component's."""
    members = classes.select("node", F.col("n_shingles").alias("size"), F.posexplode("bands").alias("band", "hash"))
    counts = written(members.groupBy("band", "hash").agg(F.count("*").alias("n")).where("n > 1"), "near-buckets")
    members = written(members.join(counts, ["band", "hash"]), "near-members")
    # the member that shares bands with most others is the likeliest to be close to all of a bucket
    central = members.groupBy("node").agg(F.sum("n").alias("met"))
    firsts = members.join(central, "node").groupBy("band", "hash").agg(F.max(F.struct("met", "node", "size")).alias("first"))
    members = written(members.drop("n").join(firsts, ["band", "hash"]), "near-members")
    wanted = classes.join(members.select("node").distinct(), "node", "left_semi")
    sets = written(_sets(docs, wanted, width), "near-sets")
    firsts = members.where((F.col("node") != F.col("first.node")) & _close_sizes("size", "first.size", percent)).select(
        F.col("first.node").alias("a"), F.col("node").alias("b")
    )
    edges = written(_linked(firsts.distinct(), sets, percent), "near-links")
    labels = components(edges)
    pairs = written(_remaining_pairs(members, labels, sets, classes, percent), "near-pairs")
    more = written(_linked(pairs, sets, percent), "near-links")
    return labels if more.isEmpty() else components(edges.unionByName(more))


def _close_sizes(a: str, b: str, percent: int) -> Column:
    """Sets whose sizes differ more can't be close enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _decided(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id, version, n_shingles, component_id, kept`` for each row."""
    sketch = written(sketches(docs, width, percent), "near-sketches")
    grouped = sketch.where("n_shingles > 0").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("rep"), F.min_by("version", "doc_id").alias("version"), F.count("*").alias("n"),
        F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
    )
    # the numbers are made once, as the table is
    classes = written(grouped.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    labels = links(docs, classes.where("rep IS NOT NULL"), width, percent)
    linked = classes.join(labels, "node").select("d1", "d2", "rep", "component")
    named = linked.join(linked.groupBy("component").agg(F.min("rep").alias("name")), "component").select("d1", "d2", "name")
    # most classes are one row that has no link; only the others need a lookup
    alone = classes.where("n > 1").join(labels, "node", "left_anti").select("d1", "d2", F.col("rep").alias("name"))
    moved = written(named.unionByName(alone), "near-moved")
    component = F.when(F.col("n_shingles") > 0, F.col("name"))
    found = sketch.drop("bands").join(moved, ["d1", "d2"], "left").select(
        "doc_id", "version", "n_shingles", F.coalesce(component, "doc_id").alias("component_id")
    )
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (``doc_id, text``).

    Documents without words, and null texts, have an empty set and are linked with nothing. Rows
    that repeat a ``doc_id`` with the same text count as one document and get the same result;
    the texts of an id that has several are documents of that id each, linked or not by
    themselves. A document without id belongs to the component of the rows with an equal set but
    names none, and no near copy is looked for; where no such row has an id, its component is null
    and it is kept. Other columns are not read.
    """
    return _decided(docs, width, percent).drop("version")


def without_near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows whose document is the smallest of its component, with all their columns, whatever their names."""
    gone = _decided(docs, width, percent).where("NOT kept")
    gone = written(gone.select(F.col("doc_id").alias("_near_gone"), F.col("version").alias("_near_version")).distinct(), "near-gone")
    same = docs["doc_id"].eqNullSafe(gone["_near_gone"]) & (F.xxhash64(docs["text"]) == gone["_near_version"])
    return docs.join(gone, same, "left_anti")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` by three-word shingles at 85 percent; see :func:`near_duplicates`."""
    return near_duplicates(table(spark, sf_dir, "documents"), 3, 85)


OP10_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i:i+2]))
    WHEN len(w) > 0 THEN [w] ELSE [] END AS s FROM words
), elements AS (SELECT doc_id, unnest(s) AS e FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM elements a JOIN elements b ON a.e = b.e AND a.doc_id <> b.doc_id
  GROUP BY ALL
), edges AS (
  SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)
), reach AS (
  WITH RECURSIVE r(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM r JOIN edges e ON r.b = e.a)
  SELECT a, min(b) AS low FROM r GROUP BY a
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(low, s.doc_id)) AS component_id,
  s.doc_id = least(s.doc_id, coalesce(low, s.doc_id)) AS kept
FROM sets s LEFT JOIN reach ON reach.a = s.doc_id
"""
