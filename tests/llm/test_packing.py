"""Packing against the tokenizer library and brute force."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from locusmill.llm import packing
from locusmill.llm.queries import QUERIES

PATH = packing.vocabulary_path()
LIBRARY = Tokenizer.from_file(PATH)
SF_DIR = "/root/testdata/sf0.001"


def library(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, packing.END]


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_goes_through_every_cell_by_single_steps(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    keys = packing.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_encoder_equals_the_library(monkeypatch):
    monkeypatch.setattr(packing, "GATHERED", 70)
    rng = random.Random(0)
    letters = " \t\n\x0b\x0c\r\x1c\x85  aAbé́̈Σσ1'st<|>endofx日\U0001f600.﻿"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(2000)]
    texts += ["<|endoftext|> a<|startoftext|>b", "it's we'll", "a ́b", "word " * 20000, "x" * 50000, None]
    encoder = packing.Encoder(PATH)
    for at in range(0, len(texts), 300):
        part = texts[at : at + 300]
        ids, counts = encoder.run(pa.array(part, pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library(t)[:-1] for t in part]


def check(rows, docs, length):
    """Each document's pieces hold its ids in order; sequences are gapless and full, or powers of two
    behind the full ones of their range."""
    left = sorted(((i, tuple(library(t))) for i, t in docs), key=str)
    by_sequence, line, short = {}, [], {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for number in sorted(by_sequence):
        at = 0
        for r in sorted(by_sequence[number], key=lambda r: r.offset):
            assert r.offset == at and len(r.ids) == 4 * r.length > 0
            at += r.length
            line.append(r)
        if at != length:
            short.setdefault(number >> 32, []).append(at)
        else:
            assert number >> 32 not in short
    for sizes in short.values():
        assert sizes == sorted(set(sizes), reverse=True) and all(n & (n - 1) == 0 for n in sizes)
    got, held = [], []
    for r in line:
        assert r.start == len(held)
        held += np.frombuffer(r.ids, "<u4").tolist()
        if len(held) == r.doc_tokens:
            got.append((r.doc_id, tuple(held)))
            held = []
    assert not held and sorted(got, key=str) == left


def test_ranges_are_divided_by_all_keys():
    rng = np.random.default_rng(4)
    keys, bounds = rng.integers(0, 3, (3, 200)), rng.integers(0, 3, (3, 7))
    bounds = bounds[:, np.lexsort(bounds[::-1])]
    want = [sum(tuple(b) <= tuple(k) for b in bounds.T) for k in keys.T]
    assert packing.ranges_of(keys, bounds).tolist() == want
    assert packing.ranges_of(keys, bounds[:, :0]).tolist() == [0] * 200


@pytest.mark.parametrize("least", [1, 1000])
def test_pieces_hold_every_id_once(spark, monkeypatch, least):
    monkeypatch.setattr(packing, "RANGE_ROWS", least)
    docs = [(i, " ".join(f"word{i % 7} {k}" for k in range(i))) for i in range(60)] + [(70, None), (71, ""), (72, " \n")]
    docs += [(None, "no id"), (None, "no id"), (5, "a b"), (5, "a b"), (80, "long text " * 3000)] + [(90 + i, "copy of one") for i in range(50)]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, start int, ids string").repartition(3)
    rows = packing.pieces(frame, PATH, 64)
    check(rows.collect(), docs, 64)
    assert packing.range_bounds(frame, PATH).shape[1] == (3 if least == 1 else 0)
    whole = {r.sequence_id: r for r in packing.sequences(rows).collect()}
    assert all(len(r.ids) == 4 * r.length <= 256 and r.starts[0] == 0 for r in whole.values())
    assert packing.pieces(frame.limit(0), PATH).collect() == []


def test_places_do_not_depend_on_what_is_hashed_at_once(monkeypatch):
    ids, counts = packing.Encoder(PATH).run(pa.array(["a b c", "", "x " * 3000, None, "long words here"] * 9))
    want = packing.curve_places(ids, counts).tolist()
    monkeypatch.setattr(packing, "IDS_AT_ONCE", 10)
    assert packing.curve_places(ids, counts).tolist() == want and packing.curve_places(ids[:0], counts[:0]).tolist() == []


def test_like_texts_are_neighbours():
    rng = random.Random(1)
    words = [[f"{a}{i}" for i in range(40)] for a in ("red", "green", "blue")]
    texts = [" ".join(rng.choices(words[i % 3], k=200)) for i in range(90)]
    places = packing.curve_places(*packing.Encoder(PATH).run(pa.array(texts)))
    kinds = [i % 3 for i in np.argsort(places)]
    assert sum(a == b for a, b in itertools.pairwise(kinds)) > 75


def test_query_over_the_small_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    pieces = packing.pieces(spark.createDataFrame(docs, "doc_id long, text string"), PATH).collect()
    check(pieces, docs, 4096)
    want = {i: library(t) for i, t in docs}
    rows = QUERIES["op11_packing"](spark, SF_DIR).collect()
    assert sum(r.length for r in rows) == sum(map(len, want.values()))
    for r in rows:
        own = np.array(want[r.doc_id][r.start : r.start + r.length], "<u4")
        assert (r.length, r.ids_crc32, r.doc_tokens) == (len(own), zlib.crc32(own.tobytes()), len(want[r.doc_id]))
