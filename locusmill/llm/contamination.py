"""Operator 3: benchmark passages in documents, by edit distance over words.

Items and texts are sequences of words (letters and digits, in lower case). A document holds an
item if a stretch of it turns into the item with at most ``1 - SIMILARITY`` of the item's words
inserted, deleted or replaced.

Candidates come from the CGK embedding. It walks over a window of an item's size: in step j it
writes down the word where it stands and moves on by a random bit that depends on j and on the
word. Walks over two sequences meet again soon after an edit, so that edit distance becomes a
number of places (Hamming distance) in which the written words differ. Repeated draws of a few
places give bucket keys; a window and an item that agree in one key are compared exactly.

The share of steps on which two walks agree falls with length. So an item of more than ``WHOLE``
words is looked up by pieces of at most ``PIECE`` words: of an item within its limit, one piece at
least is within its own. A piece found has the whole item compared around it.

Windows may start at every word, but most can't be within the limit and are left out first by a
bound that loses nothing: ``d`` edits leave ``n - 2 - 3 d`` of the three-word runs of an item of
``n`` words as they are, and these stand within the first ``n`` words of the stretch; so a window
needs that many runs that items of its size have. Items so short that this says nothing need
``n - d`` of their words.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.llm.blobs import opened
from locusmill.llm.near import mixed
from locusmill.llm.shared import batch, fresh_folder, slices, table

SIMILARITY = 0.8
#: Words of a text or item; the alphabet of the edit distance.
WORDS = re.compile(r"[^\W_]+")
#: Draws, and places in each. With them a window at the limit is found in tests of planted edits
#: with a probability of over 0.99.
DRAWS, PLACES, SEED = 64, 3, 11
#: Words up to which an item is looked up as a whole, and words of a longer item's pieces.
WHOLE, PIECE = 60, 48
#: Windows that are embedded at once.
WINDOWS = 1_000
#: Text of a part of the benchmark, and of the documents that a task holds while it goes through the parts.
PART_BYTES, HELD_BYTES = 4 << 20, 32 << 20
U64 = np.uint64
SALTS = mixed(np.arange(DRAWS, dtype=U64), 5)


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def allowed(n: int) -> int:
    """Edits that an item of ``n`` words may have."""
    return int(round((1 - SIMILARITY) * n * 1000)) // 1000


def pieces_of(n: int) -> list[tuple[int, int]]:
    """Offsets and sizes of the pieces by which an item of ``n`` words is looked up."""
    count = 1 if n <= WHOLE else -(-n // PIECE)
    cuts = [n * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def embedded(windows: np.ndarray, steps: int) -> np.ndarray:
    """CGK walks over rows of word numbers: by step and draw, the number written down."""
    count, n = windows.shape
    filled = np.append(windows, np.full((count, 1), -1), 1)
    # a word's coins: hashes for a draw, whose bits serve 64 steps in turn
    coins = [mixed(filled.astype(U64)[None] + SALTS[:, None, None], k) for k in range(-(-steps // 64))]
    base = np.arange(count) * (n + 1)
    at = np.zeros((DRAWS, count), np.int64)
    out = np.empty((steps, DRAWS, count), np.int64)
    own = np.arange(DRAWS)[:, None] * filled.size
    for j in range(steps):
        place = base + at
        out[j] = filled.reshape(-1)[place]
        coin = coins[j // 64].reshape(-1)[own + place]
        at = np.minimum(at + (coin >> U64(j % 64) & U64(1)).astype(np.int64), n)
    return out


def keys_of(windows: np.ndarray) -> np.ndarray:
    """By draw and window: the key made of the words written down in the draw's steps.

    A walk over n words is about 2n steps long.
    """
    n = windows.shape[1]
    places = np.random.default_rng([SEED, n]).integers(0, 2 * n, (DRAWS, PLACES))
    walk = embedded(windows, int(places.max()) + 1)
    key = np.broadcast_to(np.arange(DRAWS, dtype=U64)[:, None], (DRAWS, len(windows)))
    for k in range(PLACES):
        key = mixed(key ^ walk[places[:, k], np.arange(DRAWS)].astype(U64), 3)
    return key


def edits_within(item: np.ndarray, stretch: np.ndarray) -> int:
    """Smallest number of edits that turns a part of ``stretch`` into ``item``."""
    above = np.zeros(len(stretch) + 1, np.int64)
    steps = np.arange(len(stretch) + 1)
    for k, word in enumerate(item, 1):
        row = np.empty_like(above)
        row[0] = k
        row[1:] = np.minimum(above[1:] + 1, above[:-1] + (stretch != word))
        # insertions: a running minimum along the row
        above = np.minimum.accumulate(row - steps) + steps
    return int(above.min())


def run_hashes(words: np.ndarray) -> np.ndarray:
    w = words.astype(U64)
    return mixed(mixed(w[:-2], 1) ^ w[1:-1], 2) ^ w[2:] if len(w) > 2 else np.zeros(0, U64)


def run_starts(at: np.ndarray, needed: int, n: int) -> np.ndarray:
    """Starts of windows of ``n`` words that hold ``needed`` of the three-word runs at ``at``."""
    if len(at) < needed:
        return np.zeros(0, np.int64)
    first, last = at[: len(at) - needed + 1], at[needed - 1 :]
    low = np.maximum(last + 3 - n, 0)
    count = np.maximum(first - low + 1, 0)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.unique(np.repeat(low, count) + inside)


class Items:
    """A benchmark's items as word numbers, and their keys in each draw."""

    def __init__(self, ids: list[int | None], texts: list[str | None]):
        self.ids, self.number = ids, {}
        #: by size: the pieces, each an item and an offset in it
        self.by_size: dict[int, list[tuple[int, int]]] = {}
        self.words = [
            np.array([self.number.setdefault(w, len(self.number)) for w in words_of(t)], np.int64) for t in texts
        ]
        for k, words in enumerate(self.words):
            if len(words):
                for offset, size in pieces_of(len(words)):
                    self.by_size.setdefault(size, []).append((k, offset))
        pieces = {n: [self.words[k][o : o + n] for k, o in members] for n, members in self.by_size.items()}
        self.keys = {n: keys_of(np.stack(each)) for n, each in pieces.items()}
        self.members = {n: np.unique(np.concatenate(each)) for n, each in pieces.items()}
        runs = {n: np.unique(np.concatenate([run_hashes(x) for x in each])) for n, each in pieces.items()}
        self.runs = np.unique(np.concatenate(list(runs.values()) or [np.zeros(0, U64)]))
        self.has_run = {n: np.isin(self.runs, own) for n, own in runs.items()}

    def numbers(self, texts: list[str | None]) -> list[np.ndarray]:
        """Word numbers of texts; -2 for a word that no item has."""
        listed = (words_of(t) for t in texts)
        return [np.fromiter(map(self.number.get, w, itertools.repeat(-2)), np.int64, len(w)) for w in listed]

    def candidates(self, flat: np.ndarray, ends: np.ndarray) -> set[tuple[int, int, int]]:
        """Start of a window, item, and offset of the piece in it, for windows within texts that end at ``ends``.

        ``ends`` holds, for each word, where its text ends. A window that its text cuts short is
        filled up with a number that nothing has.
        """
        found: set[tuple[int, int, int]] = set()
        at, run = self._run_places(flat, ends)
        for n, members in self.by_size.items():
            needed = n - 2 - 3 * allowed(n)
            if needed > 0:
                starts = run_starts(at[self.has_run[n][run]], needed, n)
            else:
                words = np.isin(flat, self.members[n])
                own = np.concatenate([[0], np.cumsum(words)])
                place = np.arange(len(flat))
                starts = np.flatnonzero(own[np.minimum(place + n, ends)] - own[:-1] >= n - allowed(n))
            stop = np.minimum(starts + n, ends[starts])
            for a in range(0, len(starts), WINDOWS):
                part = starts[a : a + WINDOWS]
                cells = part[:, None] + np.arange(n)
                windows = np.where(cells < stop[a : a + WINDOWS, None], flat[np.minimum(cells, len(flat) - 1)], -1)
                keys = keys_of(windows)
                for k, (item, offset) in enumerate(members):
                    agree = (keys == self.keys[n][:, k : k + 1]).any(0)
                    found.update((int(s), item, offset) for s in part[agree])
        return found

    def _run_places(self, flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of three-word runs that items have, and which run each is."""
        known = flat >= 0
        at = np.flatnonzero(known[:-2] & known[1:-1] & known[2:]) if len(flat) > 2 else np.zeros(0, np.int64)
        at = at[at + 3 <= ends[at]]
        if not len(self.runs) or not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = mixed(mixed(flat[at].astype(U64), 1) ^ flat[at + 1].astype(U64), 2) ^ flat[at + 2].astype(U64)
        run = np.minimum(np.searchsorted(self.runs, h), len(self.runs) - 1)
        same = self.runs[run] == h
        return at[same], run[same]

    def matches(self, flat: np.ndarray, first: np.ndarray, ends: np.ndarray) -> dict[int, set[int]]:
        """Items found, by the word at which their text begins."""
        hits: dict[int, set[int]] = {}
        begins: dict[tuple[int, int, int], list[int]] = {}
        for start, item, offset in self.candidates(flat, ends):
            begins.setdefault((int(first[start]), int(ends[start]), item), []).append(start - offset)
        for (text, end, item), places in begins.items():
            words = self.words[item]
            n, d = len(words), allowed(len(words))
            # a long item's pieces agree on where it may begin: places close together are one stretch
            span = n if n > WHOLE else 0
            low = None
            for place in sorted(set(places)):
                if low is None or place > low + span:
                    low = place
                    stretch = flat[max(text, low - d) : max(0, min(end, low + span + n + d))]
                    if edits_within(words, stretch) <= d:
                        hits.setdefault(text, set()).add(item)
                        break
        return hits

    def found(self, texts: list[str | None]) -> list[list[int | None]]:
        """Ids of the items in each text, in order; those without an id come last, as None."""
        listed = self.numbers(texts)
        sizes = np.array([len(x) for x in listed], np.int64)
        out: list[list[int]] = [[] for _ in texts]
        if not sizes.sum() or not self.by_size:
            return out
        ends = np.repeat(np.cumsum(sizes), sizes)
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        text_at = {int(f): i for i, f in enumerate(np.cumsum(sizes) - sizes) if sizes[i]}
        for start, items in self.matches(np.concatenate(listed), first, ends).items():
            out[text_at[start]] = in_order(self.ids[k] for k in items)
        return out


def in_order(ids) -> list[int | None]:
    return sorted(ids, key=lambda i: (i is None, i or 0))


def _parts(benchmark: DataFrame) -> list[str]:
    """Files of the benchmark's different items, of about ``PART_BYTES`` of text each, in the shared folder.

    The driver gets their names alone.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // PART_BYTES)
    if not n:
        return []
    folder = fresh_folder(spark, "benchmark-parts")
    numbered = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int"))
    numbered.repartitionById(n, "part").sortWithinPartitions("item_id", "text").drop("part").write.parquet(folder)
    return sorted(spark.read.parquet(folder).inputFiles())


@functools.lru_cache(maxsize=1)
def _loaded(file: str) -> Items:
    """The items of a part. A worker keeps the last one, which is the only one of a small benchmark."""
    store, path = opened(file)
    with store.open_input_file(path) as source:
        rows = pq.read_table(source)
    return Items(rows.column("item_id").to_pylist(), rows.column("text").to_pylist())


def _held(batches) -> Iterator[list[pa.RecordBatch]]:
    """Parts of the batches with about ``HELD_BYTES`` of text together."""
    held, size = [], 0
    for part in slices(batches, "text"):
        held.append(part)
        size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
        if size >= HELD_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _found(batches, files: list[str]) -> Iterator[tuple[pa.RecordBatch, list[list[int | None]]]]:
    """Rows, and the ids of the items in each; one part of the benchmark is loaded at a time."""
    for held in _held(batches):
        hits: list[list[list[int | None]]] = [[[] for _ in range(len(part))] for part in held]
        for file in files:
            items = _loaded(file)
            for own, part in zip(hits, held, strict=True):
                for row, ids in zip(own, items.found(part.column("text").to_pylist()), strict=True):
                    row.extend(ids)
        for own, part in zip(hits, held, strict=True):
            yield part, [in_order(ids) for ids in own]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_items, items``: for each row how many items its whole text holds, and the ids of
    those that have one, in order.

    Null and empty texts hold nothing, and items without words are in nothing. Rows that repeat
    give equal rows; items that agree in id and text are one, others are each counted. Nothing is
    shuffled but the benchmark: each task goes through its parts, with one of them in memory.
    """
    files = _parts(benchmark)
    schema = "doc_id long, n_items long, items array<long>"

    def run(batches):
        for part, found in _found(batches, files):
            named = [[i for i in ids if i is not None] for ids in found]
            yield batch(schema, part.column("doc_id"), [len(ids) for ids in found], named)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose text holds no item, named or not, with all their columns, whatever their names."""
    files = _parts(benchmark)

    def run(batches):
        for part, found in _found(batches, files):
            yield part.filter(pa.array([not ids for ids in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_items, items, contaminated`` of every whole text of ``documents``."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_items", "items", (F.col("n_items") > 0).alias("contaminated"))
