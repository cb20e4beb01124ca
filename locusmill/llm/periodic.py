"""Operator 13: periodic runs of words, by a dictionary of basic factors.

The dictionary names the factors of each power-of-two length L: two places have the same name if
the same L words start there, and names of length 2 L are ranks of pairs of names of length L. In
the order of names, a place stands next to its successor, the next place with its name. Two
occurrences within a stretch of 2 L words lie at most L apart. Where consecutive places all have
their successor at one distance p, each place's occurrences are an arithmetic progression of
difference p, so the places propose the period p for the stretch from the first of them to the
end of the last one's successor.

A proposal at L with L/2 < p <= L is a run and needs no search for its ends. A smaller period of
the stretch, which is p + L words long at least, would divide p (Fine and Wilf) and bring a nearer
successor. If the word before the stretch kept the period, the place there would have its
successor at p as well; the same holds behind it. A run of 3 p words holds such places, as
p + L < 3 p. Distances up to L/2 repeat what a smaller L has proposed and are left out.

Texts of a batch lie in one array, so that every step is a few array operations, and a text is
never divided. Time is n log n per length, and there are log n lengths.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.functions.basics import let
from locusmill.llm.shared import SPACES, batch, checksum, slices, table

#: A run has this many words at least, and its period this many times.
LEAST_WORDS, LEAST_TIMES = 24, 3
RESULT = "doc_id long, starts array<long>, lengths array<long>, periods array<long>, strongest int, collapsed string"


def _ranked(left: np.ndarray, right: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places by the pair of names at them, ties in order, and the rank of each one's pair."""
    bits = n.bit_length()
    if 3 * bits <= 64:
        b = np.uint64(bits)
        key = np.sort((left.astype(np.uint64) << b | right.astype(np.uint64)) << b | at.astype(np.uint64))
        place, pair = (key & np.uint64((1 << bits) - 1)).astype(np.int64), key >> b
        new = pair[1:] != pair[:-1]
    else:
        order = np.lexsort((right, left))
        place, left, right = at[order], left[order], right[order]
        new = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    return place, np.cumsum(np.concatenate([np.zeros(1, bool), new]))


def runs_of(words: np.ndarray, counts: np.ndarray, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> np.ndarray:
    """Rows ``start, length, period`` of all runs, by start and period.

    ``words`` are numbers, below their count, of the words of texts one after another, of
    ``counts`` words each.
    """
    n, length = len(words), 1
    ends, sizes = np.repeat(np.cumsum(counts), counts), np.repeat(counts, counts)
    at = np.flatnonzero(sizes >= max(least, times))
    name = words.astype(np.int64).copy()
    left, right = name[at], np.zeros(len(at), np.int64)
    found = [np.zeros((0, 3), np.int64)]
    while len(at):
        place, rank = _ranked(left, right, at, n)
        name[place] = rank
        here, gap = place[:-1], place[1:] - place[:-1]
        good = (rank[1:] == rank[:-1]) & (gap <= length) & (2 * gap > length) & (place[1:] < ends[here])
        here, gap = here[good], gap[good]
        order = np.argsort(here)
        here, gap = here[order], gap[order]
        if len(here):
            cut = np.flatnonzero((np.diff(here) != 1) | (np.diff(gap) != 0)) + 1
            head, tail = np.concatenate([[0], cut]), np.concatenate([cut, [len(here)]]) - 1
            period = gap[head]
            size = here[tail] - here[head] + period + length
            long = size >= np.maximum(least, times * period)
            found.append(np.stack([here[head], size, period], 1)[long])
        # the next length, where a text has room for a run of a period of over half of it
        at = at[(at + 2 * length <= ends[at]) & (sizes[at] > times * length)]
        left, right = name[at], name[at + length] if len(at) else at
        length *= 2
    rows = np.concatenate(found)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def strongest(rows: list[tuple[int, int, int]]) -> int | None:
    """Number of the run with the most repetitions; the first in order of start and period of several."""
    if not rows:
        return None
    return max(range(len(rows)), key=lambda i: (Fraction(rows[i][1], rows[i][2]), -i))


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of all texts, their numbers, and how many each text has."""
    listed = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = listed.flatten()
    solid = pc.not_equal(flat, "")
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(listed).to_numpy(zero_copy_only=False))
    counts = np.bincount(owner[solid.to_numpy(zero_copy_only=False)], minlength=len(texts))
    words = flat.filter(solid)
    return words, words.dictionary_encode().indices.to_numpy().astype(np.int64), counts


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> DataFrame:
    """For each row of ``doc_id, text``: its runs (``starts, lengths, periods`` in words), the
    number of the ``strongest`` one, and the ``collapsed`` text: each run cut down to its first
    period, words joined by one space.

    A run is a stretch with a smallest period that no neighbouring word extends; it has ``least``
    words and ``times`` periods at least (three or more, as the method needs). Null and empty
    texts have no runs and collapse to an empty text; without runs ``strongest`` is null. Equal
    rows give equal rows, a null id is an id like others, and other columns are not read. Texts
    are read whole and where they lie: nothing is shuffled.
    """
    if times < 3:
        raise ValueError("a run needs three periods at least")

    def run(batches):
        for part in slices(batches, "text"):
            words, numbers, counts = _words(part.column("text"))
            stops = np.cumsum(counts)
            rows = runs_of(numbers, counts, least, times)
            owner = np.searchsorted(stops, rows[:, 0], "right")
            # words after a run's first period, by where such stretches begin and end
            depth = np.zeros(len(numbers) + 1, np.int64)
            np.add.at(depth, rows[:, 0] + rows[:, 2], 1)
            np.add.at(depth, rows[:, 0] + rows[:, 1], -1)
            keep = np.cumsum(depth[:-1]) == 0
            left = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], stops])]
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), words.filter(pa.array(keep))), " ")
            cuts = np.searchsorted(owner, np.arange(len(part) + 1))
            lists = []
            for column in (rows[:, 0] - (stops - counts)[owner], rows[:, 1], rows[:, 2]):
                lists.append(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(column, pa.int64())))
            best = [None] * len(part)
            for i in np.unique(owner).tolist():
                best[i] = strongest(rows[cuts[i] : cuts[i + 1]].tolist())
            yield batch(RESULT, part.column("doc_id"), *lists, best, texts)

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def _planted(doc_id: Column, text: Column) -> Column:
    """The text as the query reads it: a tenth of the documents, by id, repeat a stretch of their words."""
    h = checksum(doc_id)

    def repeated(words: Column) -> Column:
        n, g = F.size(words).cast("long"), F.floor(h / 10)
        a = F.when(n > 0, g % n)
        p = 1 + F.floor((n - a) / (3 + g % 8))
        bound = F.struct(words.alias("words"), a.alias("a"), p.alias("p"), n.alias("n"))
        return let(
            bound,
            lambda b: F.array_join(
                F.transform(
                    F.sequence(F.lit(0).cast("long"), b["n"] - 1),
                    lambda i: F.get(b["words"], F.when(i >= b["a"], b["a"] + (i - b["a"]) % b["p"]).otherwise(i).cast("int")),
                ),
                " ",
            ),
        )

    words = F.filter(F.split(text, rf"[{SPACES}]+", -1), lambda w: w != "")
    chosen = (h % 10 == 0) & text.rlike(rf"[^{SPACES}]")
    return F.when(chosen, let(words, repeated)).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole text of ``documents``, a tenth of them with a stretch repeated, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", _planted(F.col("doc_id"), F.col("text")).alias("text"))
    runs = periodic_runs(docs, 24, 3)
    zipped = F.arrays_zip("starts", "lengths", "periods")
    lines = F.transform(zipped, lambda r: F.concat_ws(",", r["starts"].cast("string"), r["lengths"].cast("string"), r["periods"].cast("string")))
    start, length, period = (F.get(c, F.col("strongest")) for c in ("starts", "lengths", "periods"))
    return runs.select(
        "doc_id",
        F.size("starts").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


OP13_SQL = r"""
WITH split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
    xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
      lambda crc, c: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[],
        lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, xor(crc, c)), 4294967295), 4294967295) AS h
  FROM documents
), parts AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g FROM split),
cuts AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM parts),
periods AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM cuts),
texts AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: CASE WHEN i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END) ELSE w END AS w
  FROM periods
), words AS (SELECT doc_id, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM texts),
same AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y
  ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
), islands AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same
), stretches AS (
  SELECT doc_id, q, min(i) AS s, count(*) + q AS len FROM islands GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest(24, 3 * q)
), runs AS (
  SELECT * FROM stretches r WHERE NOT EXISTS (
    FROM stretches o WHERE o.doc_id = r.doc_id AND o.q < r.q AND o.s <= r.s AND o.s + o.len >= r.s + r.len)
), best AS (
  SELECT doc_id, s, len, q FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY len::DECIMAL(38, 18) / q DESC, s, q) = 1
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY doc_id
), dropped AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM runs),
remaining AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT t.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, len::BIGINT AS length, q::BIGINT AS period,
  ((1000 * len) // q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(text, '')) AS collapsed_sha256
FROM texts t LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN remaining USING (doc_id)
"""
