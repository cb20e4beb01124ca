"""Operator 2: language identification by unigrams over all segmentations.

Every language has a probability for each piece of a fixed public vocabulary. A word (a run of
letters and marks between white space, with the vocabulary's space sign before it) has the
probability of all ways of cutting it into pieces, summed by a forward pass; a text has the
product of its words. Piece probabilities are fitted by expectation maximisation: the expected
count of each piece over all cuts of the words of a bounded sample of labelled rows.

Passes add logarithms, so that words of any length are read whole and keep their probabilities.
"""

from __future__ import annotations

import functools
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.llm.pieces import SPACE, model_path
from locusmill.llm.shared import batch, checksum, sampled, slices, table, written

UNDETERMINED = "und"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LETTER = re.compile(r"[^\W\d_]")
#: Labelled rows of each language in the sample that the probabilities are fitted on.
SAMPLE_ROWS = 800
ROUNDS = 3
#: Added to each expected count; and the probability of a character that no piece has.
SMOOTHING, UNKNOWN = 0.05, 1e-7
REMEMBERED = 400_000
RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


class Lattice:
    """Finds the pieces in words. A piece is known by the hash of its characters."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.texts = [model.id_to_piece(i) for i in plain]
        self.size = len(self.texts)
        by_length: dict[int, list[int]] = {}
        for i, text in enumerate(self.texts):
            by_length.setdefault(len(text), []).append(i)
        self.longest = max(by_length)
        self.keys, self.pieces = {}, {}
        for length, members in by_length.items():
            h = self.hashes("".join(self.texts[i] for i in members), length)[length - 1][::length]
            order = np.argsort(h)
            self.keys[length], self.pieces[length] = h[order], np.array(members)[order]
        # a stretch that starts no piece need not be read on
        starts = {length: "".join(sorted({t[:length] for t in self.texts if len(t) >= length})) for length in range(1, self.longest + 1)}
        self.starts = {k: np.sort(self.hashes(t, k)[k - 1][::k]) for k, t in starts.items()}

    @staticmethod
    def hashes(text: str, longest: int) -> list[np.ndarray]:
        """For each length up to ``longest``: the hash of the stretch that starts at a character."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        out, h = [], np.full(len(codes), 0x9E3779B97F4A7C15, np.uint64)
        for k in range(longest):
            h = h[: len(codes) - k] if k else h
            h = (h ^ codes[k:]) * np.uint64(0xFF51AFD7ED558CCD)
            h = h ^ h >> np.uint64(32)
            out.append(h)
        return out

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Place of each word's first character, and start, length and piece of every piece in the words.

        A character that is no piece has a piece of its own numbered ``size``.
        """
        text = "".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        left = np.repeat(ends, lengths) - np.arange(len(text))
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        at, h = np.arange(len(text)), np.full(len(text), 0x9E3779B97F4A7C15, np.uint64)
        starts, sizes, pieces = [], [], []
        for k in range(1, self.longest + 1):
            h = (h ^ codes[at + k - 1]) * np.uint64(0xFF51AFD7ED558CCD)
            h = h ^ h >> np.uint64(32)
            if k in self.keys:
                place = np.minimum(np.searchsorted(self.keys[k], h), len(self.keys[k]) - 1)
                known = self.keys[k][place] == h
                found = self.pieces[k][place[known]]
                starts.append(at[known])
                pieces.append(found)
                sizes.append(np.full(len(found), k))
                if k == 1:
                    starts.append(at[~known])
                    pieces.append(np.full((~known).sum(), self.size))
                    sizes.append(np.full((~known).sum(), 1))
            prefix = self.starts[k]
            place = np.minimum(np.searchsorted(prefix, h), len(prefix) - 1)
            on = (prefix[place] == h) & (left[at] > k)
            at, h = at[on], h[on]
        return ends - lengths, np.concatenate(starts), np.concatenate(sizes), np.concatenate(pieces)

    def sums(self, words: list[str], table: np.ndarray, backward: bool = False):
        """Log-probability of each word in each language, all cuts summed.

        ``table`` holds a row of probabilities for each piece, and a last one for a character
        that is no piece. With ``backward``: also the word, piece and expected count of each edge.
        """
        logs = np.log(table)
        first, start, size, piece = self.edges(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), lengths)
        # a cell for each character and one for each word's end; the pass goes by distance from the start
        cell = start + word[start]
        target = cell + size
        depth = start - first[word[start]] + size
        origin = first + np.arange(len(words))
        forward = np.full((len(word) + len(words), table.shape[1]), -np.inf)
        forward[origin] = 0.0
        for step in _steps(depth, target):
            to, heads = _groups(target[step])
            forward[to] = _log_sums(forward[cell[step]] + logs[piece[step]], heads)
        total = forward[origin + lengths]
        if not backward:
            return total
        back = np.full_like(forward, -np.inf)
        back[origin + lengths] = 0.0
        for step in reversed(_steps(depth, cell)):
            # edges that end at this depth: their ends are whole, so pass them on to their starts
            to, heads = _groups(cell[step])
            back[to] = np.logaddexp(back[to], _log_sums(back[target[step]] + logs[piece[step]], heads))
        share = np.exp(forward[cell] + logs[piece] + back[target] - total[word[start]])
        return total, word[start], piece, share


def _steps(depth: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Edges by depth, those of a depth in order of ``end``."""
    order = np.lexsort((end, depth))
    return np.split(order, np.searchsorted(depth[order], np.arange(2, depth.max(initial=1) + 1)))


def _groups(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of a sorted array, and where each begins."""
    heads = np.flatnonzero(np.append(True, ends[1:] != ends[:-1])) if len(ends) else np.zeros(0, np.int64)
    return ends[heads], heads


def _log_sums(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of each group's exponentials."""
    if not len(heads):
        return values[:0]
    top = np.maximum.reduceat(values, heads)
    shifted = np.exp(values - np.repeat(top, np.diff(np.append(heads, len(values))), axis=0))
    return top + np.log(np.add.reduceat(shifted, heads))


@functools.lru_cache(maxsize=1)
def lattice(path: str) -> Lattice:
    return Lattice(path)


def words_of(text: str) -> list[str]:
    return [SPACE + w for w in WORDS.findall(text)]


def _word_counts(rows: DataFrame) -> DataFrame:
    """``lang, word, n``; counted in the tasks before the shuffle."""

    def run(batches):
        counts: dict[tuple[str, str], int] = {}
        for part in slices(batches, "text"):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                for w in words_of(text):
                    counts[lang, w] = counts.get((lang, w), 0) + 1
            if len(counts) > REMEMBERED:
                yield batch("lang string, word string, n long", [k[0] for k in counts], [k[1] for k in counts], list(counts.values()))
                counts.clear()
        if counts:
            yield batch("lang string, word string, n long", [k[0] for k in counts], [k[1] for k in counts], list(counts.values()))

    counted = rows.select("lang", "text").mapInArrow(run, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _expected(counts: DataFrame, path: str, langs: list[str], table: np.ndarray) -> DataFrame:
    """Expected count of each piece in each language under ``table``."""
    schema = "lang string, piece int, n double"

    def run(batches):
        grid = lattice(path)
        sums = np.zeros((grid.size + 1, len(langs)))
        column = {x: i for i, x in enumerate(langs)}
        for part in slices(batches, "word"):
            words = part.column("word").to_pylist()
            _, word, piece, share = grid.sums(words, table, backward=True)
            lang = np.array([column[x] for x in part.column("lang").to_pylist()])
            times = np.array(part.column("n").to_pylist(), float)
            own = share[np.arange(len(word)), lang[word]] * times[word]
            np.add.at(sums, (piece, lang[word]), own)
        piece, lang = np.nonzero(sums)
        yield batch(schema, [langs[i] for i in lang], piece.astype(np.int32), sums[piece, lang])

    return counts.mapInArrow(run, schema).groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def fit(rows: DataFrame, path: str, most: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities from ``lang, text`` rows (other columns: ``doc_id``).

    Takes a sample of about ``most`` rows of each language. The driver gets the languages and,
    in each round, one count for a language and piece, however large the sample.
    """
    usable = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    counts = written(_word_counts(sampled(usable, "lang", most, "doc_id", "language")), "language-words")
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    grid = lattice(path)
    table = np.full((grid.size + 1, len(langs)), 1.0 / grid.size)
    # pieces of several characters start above what their characters give
    table[-1] = UNKNOWN
    for _ in range(ROUNDS if langs else 0):
        found = _expected(counts, path, langs, table).toArrow()
        table = np.full((grid.size + 1, len(langs)), SMOOTHING)
        column = {x: i for i, x in enumerate(langs)}
        at = [column[x] for x in found.column("lang").to_pylist()]
        np.add.at(table, (found.column("piece").to_numpy(), at), found.column("n").to_numpy())
        table /= table[:-1].sum(0)
        table[-1] = UNKNOWN
    return langs, table


class Scorer:
    """Scores texts; remembers the values of words, within bounds."""

    def __init__(self, path: str, table: np.ndarray):
        self.grid, self.table = lattice(path), table
        self.known: dict[str, int] = {}
        self.values = np.zeros((0, table.shape[1]))

    def run(self, texts: list[str]) -> np.ndarray:
        words = [words_of(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.values = {}, self.values[:0]
        new = list(set().union(*words) - self.known.keys())
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            parts = [self.grid.sums(new[i : i + 50_000], self.table) for i in range(0, len(new), 50_000)]
            self.values = np.concatenate([self.values, *parts])
        out = np.zeros((len(texts), self.table.shape[1]))
        for i, each in enumerate(words):
            if each:
                out[i] = self.values[np.fromiter(map(self.known.__getitem__, each), np.int64, len(each))].sum(0)
        return out


def predicted(docs: DataFrame, langs: list[str], probabilities: np.ndarray, path: str) -> DataFrame:
    """``doc_id, lang_pred, score`` of each whole text; ``score`` is the language's share.

    ``und`` with score 0 where the text is null or has no letter, or no language was learned.
    Ties go to the language first in order. Equal rows give equal rows; no other column is read.
    """
    schema = "doc_id long, lang_pred string, score double"

    def run(batches):
        scorer = Scorer(path, probabilities)
        for part in slices(batches, "text"):
            texts = part.column("text").to_pylist()
            readable = np.array([bool(langs and t and LETTER.search(t)) for t in texts])
            names = np.full(len(texts), UNDETERMINED, object)
            scores = np.zeros(len(texts))
            if readable.any():
                logs = scorer.run([t for t, r in zip(texts, readable, strict=True) if r])
                share = np.exp(logs - logs.max(1, keepdims=True))
                share /= share.sum(1, keepdims=True)
                names[readable] = np.array(langs, object)[logs.argmax(1)]
                scores[readable] = share.max(1)
            yield batch(schema, part.column("doc_id"), names.tolist(), scores)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``, learned from the three quarters that are not held out.

    Null texts and texts without a letter are ``und`` with score 0; a null id is not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(checksum(F.col("doc_id")) % 4 == 2, F.lit(False))
    langs, probabilities = fit(docs.where(~held_out), model_path())
    found = predicted(docs, langs, probabilities, model_path())
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
