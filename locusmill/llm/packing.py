"""Operator 11: packing documents into sequences along a space-filling curve.

A text's token ids are hashed into a vector of a few hundred places, which a fixed random matrix
projects to four numbers. Each is mapped to equal shares of a normal distribution and cut to 15
bits, and the four are the cell of a grid through which a Hilbert curve runs. Texts with like
words have near cells, and cells that are close on the curve are close in the grid.

Documents are sorted by their place on the curve, in ranges, and those of a range are laid end to
end. A sequence is the next ``LENGTH`` tokens of that line, and a document that lies across the
border of sequences is cut there. What is left of a range, less than a sequence, is cut at powers
of two, which need no padding. So nothing is padded, and a range has a dozen short sequences at most.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.llm.near import mixed
from locusmill.llm.shared import batch, slices, table

VOCABULARY = "word_bpe_49k.json"
#: Put after each document.
END = 2
LENGTH = 4096
#: Places of the hashed vector, dimensions of the grid, and bits of each.
PLACES, DIMENSIONS, BITS, SEED = 256, 4, 15, 13
#: Bytes of text whose different words are encoded at once, words that one call of the library
#: gets, and words whose ids are gathered at once: small arrays are used again, large ones cost more.
AT_ONCE, WORDS_AT_ONCE, GATHERED = 32 << 20, 200, 1 << 16
#: Ids whose texts are hashed into vectors at once.
IDS_AT_ONCE = 1 << 18
#: A full stop or comma behind a letter or digit that ends a word.
TAIL = "([0-9A-Za-zß-öø-ÿ])[.,]$"
#: Fixed value: the vocabulary's control string that stands between words encoded at once.
BETWEEN = "<|endoftext|>"
#: Documents sampled to find a range's bounds, and documents in a range at least. Null ids are sorted as this.
RANGE_SAMPLE, RANGE_ROWS, NO_ID = 100, 1_000, -(1 << 63)
U64 = np.uint64
TOKENS = np.dtype("<u4")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class Encoder:
    """Ids of texts. The vocabulary drops white space and no token reaches over it, so that a
    text's ids are those of its words one after another; each different word is encoded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # a task has one core; threads of the library's own would only take turns on it
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.between = self.tokenizer.token_to_id(BETWEEN)

    def run(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each text has."""
        listed = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = listed.flatten().dictionary_encode()
        stems, tails = (part.dictionary_encode() for part in _parted(coded.dictionary))
        flat, sizes = self._encoded([*stems.dictionary.to_pylist(), *tails.dictionary.to_pylist()])
        starts = np.cumsum(sizes) - sizes
        both = np.stack([stems.indices.to_numpy(), tails.indices.to_numpy() + len(stems.dictionary)], 1)
        numbers, ids = coded.indices.to_numpy(), [np.zeros(0, np.uint16)]
        for at in range(0, len(numbers), GATHERED):
            word = both[numbers[at : at + GATHERED]].reshape(-1)
            n = sizes[word]
            place = np.repeat(starts[word] - (np.cumsum(n) - n), n)
            ids.append(flat[place + np.arange(len(place))])
        ends = np.cumsum(np.append(0, sizes[both].sum(1)[numbers]))
        words = np.cumsum(np.append(0, pc.list_value_length(listed).to_numpy(zero_copy_only=False)))
        return np.concatenate(ids), np.diff(ends[words])

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each word has.

        Words go through the library by the hundred, a control string between them; those that
        hold that string themselves go alone.
        """
        groups: list[list[str]] = [[]]
        for word in words:
            if BETWEEN in word:
                groups += [[word], []]
            else:
                if len(groups[-1]) == WORDS_AT_ONCE:
                    groups.append([])
                groups[-1].append(word)
        ids, sizes = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
        for group in filter(None, groups):
            (found,) = self.tokenizer.encode_batch_fast([BETWEEN.join(group)], add_special_tokens=False)
            each = np.array(found.ids, np.uint16)
            if BETWEEN in group[0]:
                ids.append(each)
                sizes.append(np.array([len(each)]))
            else:
                word = each != self.between
                ids.append(each[word])
                sizes.append(np.diff(np.flatnonzero(~word), prepend=-1, append=len(each)) - 1)
        return np.concatenate(ids), np.concatenate(sizes)


def _parted(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Words as stems and what follows them, so that fewer have to be encoded.

    The vocabulary cuts a full stop or comma from a letter or digit before it, and reads letters in
    lower case; in a word of ASCII characters without control strings nothing else changes.
    """
    plain = pc.and_(pc.string_is_ascii(words), pc.invert(pc.match_substring(words, "<")))
    words = pc.if_else(plain, pc.ascii_lower(words), words)
    stems = pc.replace_substring_regex(words, TAIL, r"\1")
    return stems, pc.if_else(pc.equal(words, stems), "", pc.utf8_slice_codeunits(words, -1))


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers below ``2 ** bits``.

    From the coarsest bit to the finest, the half of the grid that a cell lies in reflects or
    swaps the axes of the finer ones; a Gray code over the axes then numbers the parts in the
    order of the curve.
    """
    x = cells.T.astype(U64).copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        low = U64((1 << bit) - 1)
        for i in range(n):
            upper = (x[i] >> U64(bit) & U64(1)).astype(bool)
            swap = np.where(upper, U64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(upper, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], U64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> U64(bit) & U64(1), U64((1 << bit) - 1), U64(0))
    x ^= turn
    key = np.zeros(x.shape[1], U64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << U64(1) | (x[i] >> U64(bit) & U64(1))
    return key.astype(np.int64)


@functools.lru_cache(maxsize=1)
def _hashes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place and sign of each id in the hashed vector, and the matrix that projects it."""
    h = mixed(np.arange(1 << 16, dtype=U64), SEED)
    sign = np.where(h >> U64(63), 1.0, -1.0)
    return (h % U64(PLACES)).astype(np.int32), sign, np.random.default_rng(SEED).normal(0, 1, (PLACES, DIMENSIONS))


def _vectors(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The projected vector of each text."""
    place, sign, projection = _hashes()
    doc = np.repeat(np.arange(len(counts), dtype=np.int32) * PLACES, counts)
    vectors = np.bincount(doc + place[ids], sign[ids], len(counts) * PLACES).reshape(len(counts), PLACES)
    # common words shall not outweigh all others
    vectors = np.sign(vectors) * np.sqrt(np.abs(vectors))
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return vectors @ projection


def curve_places(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Place on the curve of each text, from its ids; the middle cell's for a text without any."""
    from math import erf

    ends = np.cumsum(counts)
    found, first = [np.zeros((0, DIMENSIONS))], 0
    while first < len(counts):
        begin = ends[first] - counts[first]
        last = max(first + 1, int(np.searchsorted(ends, begin + IDS_AT_ONCE, "right")))
        found.append(_vectors(ids[begin : ends[last - 1]], counts[first:last]))
        first = last
    share = np.array([0.5 + 0.5 * erf(z / 2**0.5) for z in np.concatenate(found).reshape(-1).tolist()]).reshape(-1, DIMENSIONS)
    return hilbert_keys(np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


KEYED = "place long, id long, row long"


def _keyed(docs: DataFrame, path: str, schema: str, finish) -> DataFrame:
    """Batches made by ``finish`` from rows, their ids and counts, and their keys: the place on the
    curve, the document's id, and a number of the row, which tells rows apart that are equal."""

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for part in slices(batches, "text", AT_ONCE):
            ids, counts = encoder(path).run(part.column("text"))
            names = pc.fill_null(part.column("doc_id").cast(pa.int64()), NO_ID).to_numpy()
            keys = np.stack([curve_places(ids, counts), names, np.arange(row, row + len(counts))])
            yield batch(schema, *finish(part, ids, counts, keys))
            row += len(counts)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def range_bounds(docs: DataFrame, path: str) -> np.ndarray:
    """Keys between ranges of about equal numbers of documents, one column each.

    They come from a sample of about ``RANGE_SAMPLE`` rows a range, and decide only which task
    sorts a document: the order that the tasks make together does not depend on them.
    """
    n = docs.count()
    ranges = max(1, min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // RANGE_ROWS))
    sample = docs.where(F.rand(SEED) < min(1.0, ranges * RANGE_SAMPLE / max(1, n)))
    found = _keyed(sample, path, KEYED, lambda part, ids, counts, keys: keys).toArrow()
    keys = np.stack([found.column(c).to_numpy() for c in ("place", "id", "row")])
    keys = keys[:, np.lexsort(keys[::-1])]
    return keys[:, [keys.shape[1] * k // ranges for k in range(1, ranges)]] if keys.shape[1] else keys[:, :0]


def ranges_of(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of the bounds are not above each key."""
    both = np.concatenate([bounds, keys], 1)
    bound = np.arange(both.shape[1]) < bounds.shape[1]
    order = np.lexsort([~bound, *both[::-1]])
    out = np.empty(both.shape[1], np.int64)
    out[order] = np.cumsum(bound[order])
    return out[bounds.shape[1] :]


def tokenised(docs: DataFrame, path: str, bounds: np.ndarray) -> DataFrame:
    """``doc_id, range, place, id, row, n, ids``: keys, and the ids with their end id as 16-bit numbers."""

    def finish(part, ids, counts, keys):
        stops = np.cumsum(counts)
        closed = np.insert(ids, stops, END).astype("<u2")
        ends = TOKENS_16 * (stops + np.arange(1, len(counts) + 1))
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(closed)])
        return part.column("doc_id"), ranges_of(keys, bounds), *keys, counts + 1, data

    return _keyed(docs, path, "doc_id long, range int, " + KEYED + ", n long, ids binary", finish)


#: Bytes of an id while documents are sorted.
TOKENS_16 = 2
PIECES = "doc_id long, start long, doc_tokens long, sequence_id long, offset long, length long, ids binary"


class Line:
    """A range's documents end to end, cut into sequences as they come.

    The pieces of the sequence that is not full yet are held back: if the range ends there, they
    are cut once more.
    """

    def __init__(self, number: int, length: int):
        self.number, self.length = number, length
        self.full, self.used, self.held = 0, 0, []

    def add(self, part: pa.RecordBatch) -> list[tuple]:
        """Pieces of the sequences that the documents fill."""
        n, names, data = part.column("n").to_numpy(), part.column("doc_id").to_pylist(), part.column("ids")
        first = self.used + np.cumsum(n) - n
        count = (first + n - 1) // self.length - first // self.length + 1
        doc = np.repeat(np.arange(len(part)), count)
        sequence = first[doc] // self.length + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        start = np.maximum(sequence * self.length, first[doc])
        stop = np.minimum((sequence + 1) * self.length, first[doc] + n[doc])
        wide = [np.frombuffer(x.as_buffer(), "<u2").astype(TOKENS) for x in data]
        made = [
            (names[d], a, int(n[d]), s, o, wide[d][a : a + size])
            for d, a, s, o, size in zip(doc.tolist(), (start - first[doc]).tolist(), sequence.tolist(), (start % self.length).tolist(), (stop - start).tolist(), strict=True)
        ]
        total = self.used + int(n.sum())
        filled = total // self.length
        done = [(*p[:3], self.full + p[3], *p[4:]) for p in self.held + made if p[3] < filled]
        self.held = [(*p[:3], 0, *p[4:]) for p in self.held + made if p[3] == filled]
        self.full, self.used = self.full + filled, total % self.length
        return done

    def close(self) -> list[tuple]:
        """Pieces of what is left, in sequences whose lengths are powers of two, the largest first."""
        sizes = [1 << k for k in reversed(range(self.used.bit_length())) if self.used >> k & 1]
        ends, out = np.cumsum(sizes).tolist(), []
        for name, begin, n, _, offset, ids in self.held:
            for k, (end, size) in enumerate(zip(ends, sizes, strict=True)):
                a, b = max(offset, end - size), min(offset + len(ids), end)
                if a < b:
                    out.append((name, begin + a - offset, n, self.full + k, a - (end - size), ids[a - offset : b - offset]))
        return out

    def rows(self, pieces: list[tuple]) -> pa.RecordBatch:
        names, start, n, sequence, offset, ids = zip(*pieces, strict=True) if pieces else [[]] * 6
        numbers = np.array(sequence, np.int64) + (self.number << 32)
        return batch(PIECES, names, start, n, numbers, offset, [len(x) for x in ids], [x.tobytes() for x in ids])


def along_curve(tokens: DataFrame, ranges: int, length: int) -> DataFrame:
    """The pieces of each range's line. Ties are sorted by id and row, so that equal texts fill no
    range alone."""

    def run(batches):
        line = None
        for part in slices(batches, "ids"):
            number = part.column("range").to_numpy()
            for rows in np.split(np.arange(len(part)), np.flatnonzero(np.diff(number)) + 1):
                if len(rows):
                    if line is None or line.number != number[rows[0]]:
                        if line is not None:
                            yield line.rows(line.close())
                        line = Line(int(number[rows[0]]), length)
                    yield line.rows(line.add(part.slice(rows[0], len(rows))))
        if line is not None:
            yield line.rows(line.close())

    sorted_ = tokens.repartitionById(ranges, "range").sortWithinPartitions("range", "place", "id", "row")
    return sorted_.select("range", "doc_id", "n", "ids").mapInArrow(run, PIECES)


def pieces(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """``doc_id, start, doc_tokens, sequence_id, offset, length, ids`` of each piece of a document.

    Sequences have ``length`` tokens, or a power of two at the end of a range; their ids rise along
    the curve. ``offset`` is a piece's place in its sequence, ``start`` the ids of its document
    before it, and ``ids`` are its ids as little-endian unsigned 32-bit numbers. Each row of
    ``docs`` is a document: rows that repeat and rows without id have pieces of their own, and a
    null or empty text is its end id alone. An empty table has no pieces. Other columns are not
    read. Tokens are made once and shuffled once.
    """
    bounds = range_bounds(docs, path)
    return along_curve(tokenised(docs, path, bounds), bounds.shape[1] + 1, length)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, length, ids, starts`` with the sequence's ids in one piece and the offset of
    each document in it. A sequence is bounded, and so is what one group gathers."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.col("parts"), F.lit(b""), lambda whole, p: F.concat(whole, p["ids"]))
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
    return whole.select("sequence_id", "length", joined.alias("ids"), F.col("parts.offset").alias("starts"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every whole text of ``documents`` in sequences of 4096 tokens, with a checksum of their ids."""
    found = pieces(table(spark, sf_dir, "documents"), vocabulary_path(), 4096)
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
