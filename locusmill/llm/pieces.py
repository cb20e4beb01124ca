"""Operator 6: SentencePiece byte-pair encoding and decoding, by vectorised merge rounds.

Symbols of many units (a run of spaces with the word after it, or a newline) lie in flat numpy
arrays. A round finds the smallest pair rank of every unit, merges the pairs that have it in all
units at once, leftmost first where they overlap, and drops the merged symbols and the units in
which no pair is left. The library merges one pair after another. That gives the same as long as
no merge makes a pair of smaller rank, which the library would take first; so of the places in a
unit only those up to the first such merge are merged in a round. A long unit has about as many
rounds as there are ranks in it.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from locusmill.llm.shared import batch, slices, table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
UNITS = re.compile(r"\n| *[^ \n]+| +")
#: Encoded units that a task remembers. When there are more, it starts anew.
REMEMBERED = 600_000
NO_RANK = np.iinfo(np.int32).max
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Pieces:
    """A model's vocabulary as lookup tables: pieces by character, merges by pair of symbols.

    A symbol is the id of a piece, or ``size`` plus the code point of a character that has none.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size, self.end = model.get_piece_size(), model.eos_id()
        self.text = [model.id_to_piece(i) for i in range(self.size)]
        self.byte = {int(self.text[i][3:5], 16): i for i in range(self.size) if model.is_byte(i)}
        plain = [
            i for i in range(self.size)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        ids = {self.text[i]: i for i in plain}
        rank_of = {s: k for k, s in enumerate(sorted({model.get_score(i) for i in plain}, reverse=True))}
        self.first = np.arange(0x110000, dtype=np.int32) + self.size
        for text, i in ids.items():
            if len(text) == 1:
                self.first[ord(text)] = i
        self.first[ord(" ")] = self.first[ord(SPACE)]
        symbol = lambda text: ids.get(text, self.size + ord(text) if len(text) == 1 else None)
        pairs = sorted(
            (a << 32 | b, rank_of[model.get_score(i)], i)
            for text, i in ids.items()
            for k in range(1, len(text))
            if (a := symbol(text[:k])) is not None and (b := symbol(text[k:])) is not None
        )
        self.pair, self.rank, self.merged = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        self.decoded = [self.text[i].replace(SPACE, " ").encode() for i in range(self.size)]
        for value, i in self.byte.items():
            self.decoded[i] = bytes([value])
        for i in range(self.size):
            if model.is_control(i):
                self.decoded[i] = b""

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of pairs; ``NO_RANK`` where there is no such merge."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        known = self.pair[at] == key
        return np.where(known, self.rank[at], NO_RANK), self.merged[at]

    def merge_units(self, units: list[str]) -> list[list[int]]:
        """Symbols of each unit after all merges. No unit is empty."""
        if not units:
            return []
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        flat = self.first[np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)].astype(np.int64)
        unit = np.repeat(np.arange(len(units)), lengths)
        done_unit, done_symbol = [], []
        last = np.append(unit[1:] != unit[:-1], True)
        rank, merged = self.look_up(flat, np.append(flat[1:], 0))
        rank[last] = NO_RANK
        while len(flat):
            heads = np.flatnonzero(np.append(True, last[:-1]))
            sizes = np.diff(np.append(heads, len(flat)))
            lowest = np.repeat(np.minimum.reduceat(rank, heads), sizes)
            keep = lowest != NO_RANK
            if not keep.all():
                done_unit.append(unit[~keep])
                done_symbol.append(flat[~keep])
            at = self.in_turn(np.flatnonzero((rank == lowest) & keep), flat, unit, last, rank, merged)
            flat[at] = merged[at]
            last[at] = last[at + 1]
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            flat, unit, last, rank, merged = flat[keep], unit[keep], last[keep], rank[keep], merged[keep]
            # only the pairs on both sides of a merged symbol have changed
            here = place[at]
            ahead = here[here > 0] - 1
            touched = np.concatenate([here[~last[here]], ahead[~last[ahead]]])
            rank[here] = NO_RANK
            rank[touched], merged[touched] = self.look_up(flat[touched], flat[touched + 1])
        where, symbols = np.concatenate(done_unit or [[]]), np.concatenate(done_symbol or [[]])
        order = np.argsort(where, kind="stable")
        ends = np.cumsum(np.bincount(where.astype(np.int64), minlength=len(units))).tolist()
        listed = symbols[order].astype(np.int64).tolist()
        return [listed[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def in_turn(self, at, flat, unit, last, rank, merged) -> np.ndarray:
        """Of the places of the smallest rank, those that the library merges before any other."""
        if len(at) < 2 or not (unit[at[1:]] == unit[at[:-1]]).any():
            return at
        # of places that overlap every other one, from the left
        number = np.arange(len(at))
        first = np.maximum.accumulate(np.where(np.append(True, np.diff(at) > 1), number, 0))
        at = at[(number - first) % 2 == 0]
        into, own = merged[at], unit[at]
        # the pairs that a merge makes: to the right as it stands, to the left after earlier merges
        right = ~last[at + 1]
        after = np.full(len(at), NO_RANK, rank.dtype)
        after[right] = self.look_up(into[right], flat[at[right] + 2])[0]
        before = flat[at - 1]
        merged_too = np.append(False, at[1:] == at[:-1] + 2)
        before[merged_too] = into[np.flatnonzero(merged_too) - 1]
        left = (at > 0) & (unit[at - 1] == own)
        after[left] = np.minimum(after[left], self.look_up(before[left], into[left])[0])
        hazard = np.cumsum(after <= rank[at])
        earlier = np.append(0, hazard[:-1])
        heads = np.maximum.accumulate(np.where(np.append(True, own[1:] != own[:-1]), np.arange(len(at)), 0))
        return at[earlier == earlier[heads]]

    def ids(self, symbols: list[int]) -> list[int]:
        """Ids of symbols; a character without a piece is the pieces of its UTF-8 bytes."""
        if max(symbols) < self.size:
            return symbols
        return [
            i for s in symbols
            for i in ((s,) if s < self.size else (self.byte[b] for b in chr(s - self.size).encode()))
        ]

    def encode_units(self, units: list[str]) -> list[list[int]]:
        return [self.ids(symbols) for symbols in self.merge_units(units)]

    def decode_unit(self, ids: list[int]) -> str:
        return b"".join([self.decoded[i] for i in ids]).decode("utf-8", "replace")


def units_of(text: str) -> list[str]:
    """Stretches that no merge crosses, with the space that the model puts before a text."""
    return UNITS.findall(" " + text.replace(SPACE, " ")) if text else []


class Encoder:
    """Encodes texts and decodes them again; remembers units, within bounds."""

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        self.number = [str(i) for i in range(self.pieces.size)]
        self.known: dict[str, str] = {}
        #: units that decode to something else than themselves
        self.changed: dict[str, str] = {}

    def learn(self, texts: list[list[str]]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.changed.clear()
        new = list(set().union(*texts) - self.known.keys())
        for unit, ids in zip(new, self.pieces.encode_units(new), strict=True):
            self.known[unit] = " ".join([self.number[i] for i in ids])
            if (decoded := self.pieces.decode_unit(ids)) != unit:
                self.changed[unit] = decoded

    def run(self, texts: list[str | None]) -> list[tuple[str, str]]:
        """Decimal ids joined by spaces, end id last, and the decoded text, of each text."""
        units = [units_of(t or "") for t in texts]
        self.learn(units)
        end, out = str(self.pieces.end), []
        for each in units:
            ids = " ".join([*map(self.known.__getitem__, each), end])
            if not self.changed.keys().isdisjoint(each):
                each = [self.changed.get(u, u) for u in each]
            # the space put before the text goes; a text has a unit, and its first one that space
            out.append((ids, "".join(each)[1:]))
        return out


def encoded(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids, n_tokens, decoded``: ids of each whole text with an end id, and their decoding.

    A null text counts as empty, whose only id is the end id. Equal rows give equal rows; other
    columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, ids array<int>, n_tokens long, decoded string"

    def run(batches):
        encoder = Encoder(model_path)
        for part in slices(batches, "text"):
            found = encoder.run(part.column("text").to_pylist())
            ids = [[int(i) for i in x.split(" ")] for x, _ in found]
            yield batch(schema, part.column(0), ids, [len(x) for x in ids], [d for _, d in found])

    return docs.selectExpr(f"`{key}`", f"`{text}` AS text").mapInArrow(run, schema)


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Counts and digests of what :func:`encoded` gives, made where the ids are made."""

    def run(batches):
        encoder = Encoder(model_path)
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for part in slices(batches, "text"):
            found = encoder.run(part.column("text").to_pylist())
            yield batch(
                RESULT, part.column(0), [i.count(" ") + 1 for i, _ in found],
                [sha(i) for i, _ in found], [sha(d) for _, d in found],
            )

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the ids and decoding of every whole text of ``documents``; null counts as empty."""
    return digests(table(spark, sf_dir, "documents"), model_path())
