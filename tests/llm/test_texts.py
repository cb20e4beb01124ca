"""Language, toxicity, tokens and SentencePiece against the libraries and brute force."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from locusmill.llm import language, pieces, shared, token_files, toxicity
from locusmill.llm.queries import QUERIES

PATH = pieces.model_path()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ENCODER = pieces.Encoder(PATH)
ODD = ["", " ", "  a  b", "▁x", "a▁b", "\r\n x\n\n", "<s>x</s>", "\x00a", "日本\U0001f600", " " * 40 + "a", "the" * 400, "=-" * 900]


def library(text):
    ids = [*LIBRARY.encode(text), LIBRARY.eos_id()]
    return " ".join(map(str, ids)), LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t▁abtherinxé日\U0001f600-=.0"), max_size=80))
def test_pieces_match_the_library(text):
    assert ENCODER.run([text]) == [library(text)]


def test_pieces_odd_texts_and_long_units():
    assert ENCODER.run(ODD) == [library(t) for t in ODD]


def test_pieces_frames(spark):
    rows = [(1, "a b", 5), (1, "a b", 5), (2, None, 6), (None, "x", None)]
    got = sorted(pieces.digests(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"), PATH).collect(), key=str)
    assert [r.n_tokens for r in got] == [3, 3, 1, 2]
    out = pieces.encoded(spark.createDataFrame(rows, "doc_id long, text string, ids int"), PATH).collect()
    assert sorted(r.decoded for r in out) == ["", "a b", "a b", "x"] and all(r.ids[-1] == 2 for r in out)
    assert pieces.digests(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_language_forward_sums_all_cuts():
    grid = language.lattice(PATH)
    rng = np.random.default_rng(1)
    table = rng.random((grid.size + 1, 2))
    number = {t: i for i, t in enumerate(grid.texts)}
    for word in ("▁the", "▁a", "▁thé☃", "x"):
        total = np.zeros(2)
        for cut in itertools.product((0, 1), repeat=len(word) - 1):
            parts, start = [], 0
            for k, c in enumerate([*cut, 1], 1):
                if c:
                    parts.append(word[start:k])
                    start = k
            rows = [number.get(p, grid.size if len(p) == 1 else None) for p in parts]
            if None not in rows:
                total += np.prod(table[rows], 0)
        assert np.allclose(grid.sums([word, "▁other"], table)[0], np.log(total))


def test_language_learns_and_handles_nulls(spark):
    rng = random.Random(2)
    words = {"en": ["the", "and", "with", "this"], "de": ["und", "der", "nicht", "schön"]}
    rows = [(i, " ".join(rng.choices(words[g], k=20)), g) for i in range(60) for g in (("en", "de")[i % 2],)]
    train = spark.createDataFrame([*rows, (90, None, "en"), (91, "x", None)], "doc_id long, text string, lang string")
    langs, table = language.fit(train, PATH)
    odd = [(1, "with the schoolbook " * 3), (2, "der und " * 3), (3, None), (4, "12 !?"), (5, ""), (6, "und " * 5000), (7, "und" * 5000)]
    got = {r.doc_id: r for r in language.predicted(spark.createDataFrame(odd, "doc_id long, text string"), langs, table, PATH).collect()}
    assert [got[i].lang_pred for i in range(1, 7)] == ["en", "de", "und", "und", "und", "de"]
    assert all(0 <= r.score <= 1 for r in got.values()) and got[3].score == 0
    none = language.fit(train.where("lang = 'zz'"), PATH)
    assert language.predicted(spark.createDataFrame(odd, "doc_id long, text string"), *none, PATH).where("lang_pred <> 'und'").isEmpty()


def test_toxicity_learns_misspellings_and_handles_nulls(spark):
    rng = random.Random(3)
    plain = [f"{a}{b}" for a in ("lor", "mip", "dol", "sit") for b in ("em", "sum", "or", "amet", "ira")]
    rows, labels = [], []
    for i in range(600):
        text = rng.choices(plain, k=30)
        if i % 8 == 0:
            text[rng.randrange(30)] = rng.choice(["grumblefink", "grumblefinks", "nastywort"])
        rows.append((i, " ".join(text), "x"))
        labels.append((i, int(i % 8 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = toxicity.fit(docs, spark.createDataFrame([*labels, (7, None), (None, 1)], "doc_id long, toxic int"))
    odd = [(1000, "lorem dolor grumblefnik"), (1001, "lorem mipor " * 20), (1002, None), (1003, ""), (1004, "é" * 9000)]
    scores = {r.doc_id: r.score for r in toxicity.scored(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()}
    assert scores[1000] > 0.5 > scores[1001] and scores[1002] == scores[1003]
    left = toxicity.without_toxic(docs, model)
    assert left.columns == docs.columns and left.where("doc_id % 8 = 0").count() <= 8 and left.where("doc_id % 8 > 0").count() >= 522
    again = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert np.array_equal(again.gain, model.gain)
    empty = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.scored(docs, empty).where("score > 0.01").isEmpty()


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_token_scan_stitches_blocks(spark, tmp_path, block, monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK_BLOCKS", 2)
    end = token_files.END
    files = {"a": [1, 2, end, end, 3, end], "b": [end], "c": [5, 6, 7, 8, 9, 10, 11, end, 1, 2], "d": [], "e": [1, 2, 3]}
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    named = spark.createDataFrame([(f"file://{tmp_path}/{n}",) for n in files], "file string")
    got = sorted((r.file[-1], r.ordinal, r.n_tokens) for r in token_files.token_counts(named, block_tokens=block).collect())
    assert got == [("a", 0, 2), ("a", 1, 0), ("a", 2, 1), ("b", 0, 0), ("c", 0, 7), ("c", 1, 2), ("e", 0, 3)]


def test_token_files_of_documents(spark):
    rows = [(1, "hello world", 0), (1, "hello world", 0), (2, None, 0), (None, "x " * 5000, 0), (3, "<|endoftext|>", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, file int")
    manifest = token_files.write_token_files(docs, shared.fresh_folder(spark, "tokens-test"), token_files.vocabulary_path())
    counts = token_files.token_counts(manifest.select("file").distinct(), block_tokens=64)
    got = sorted(((r.doc_id, r.n_tokens) for r in manifest.join(counts, ["file", "ordinal"]).collect()), key=str)
    encoder = token_files.tokenizer(token_files.vocabulary_path())
    assert got == sorted(((i, len(encoder.encode_ordinary(t or ""))) for i, t, _ in rows), key=str)
    none = token_files.write_token_files(docs.limit(0), shared.fresh_folder(spark, "tokens-test"), token_files.vocabulary_path())
    assert token_files.token_counts(none.select("file").distinct()).collect() == []


def test_long_words_keep_all_cuts_and_all_differences():
    """Words of 200 characters against a plain sum over cuts in logarithms."""
    grid = language.lattice(PATH)
    rng = np.random.default_rng(5)
    table = np.exp(rng.uniform(-12, -2, (grid.size + 1, 2)))
    number = {t: i for i, t in enumerate(grid.texts)}

    def plain(word, lang):
        best = [0.0] + [-math.inf] * len(word)
        for end in range(1, len(word) + 1):
            parts = [(word[k:end], best[k]) for k in range(max(0, end - grid.longest), end)]
            known = [b + math.log(table[number[p], lang]) for p, b in parts if p in number]
            if word[end - 1] not in number:
                known.append(best[end - 1] + math.log(table[-1, lang]))
            top = max(known)
            best[end] = top + math.log(sum(math.exp(k - top) for k in known))
        return best[-1]

    words = ["▁" + "".join(random.Random(i).choices("etaoinshrß☃日", k=n)) for i, n in enumerate((3, 64, 65, 200, 1500))] + ["▁" + "☃" * 200]
    got = grid.sums(words, table)
    assert np.isfinite(got).all()
    assert np.allclose(got, [[plain(w, lang) for lang in range(2)] for w in words])
    # a word of unknown characters alone tells the languages apart as their probabilities do
    assert not np.isclose(*got[-1])
    assert language.words_of("a " + "b" * 500) == ["▁a", "▁" + "b" * 500]


def test_expected_counts_equal_their_definition():
    grid = language.lattice(PATH)
    table = np.exp(np.random.default_rng(6).uniform(-9, -2, (grid.size + 1, 1)))
    number = {t: i for i, t in enumerate(grid.texts)}
    word, want, total = "▁thes☃", {}, 0.0
    for cut in itertools.product((0, 1), repeat=len(word) - 1):
        ends = [k + 1 for k, c in enumerate([*cut, 1]) if c]
        parts = [word[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        rows = [number.get(p, grid.size if len(p) == 1 else None) for p in parts]
        if None not in rows:
            p = float(np.prod(table[rows, 0]))
            total += p
            for r in rows:
                want[r] = want.get(r, 0) + p
    logs, _, piece, share = grid.sums([word], table, backward=True)
    got = np.zeros(grid.size + 1)
    np.add.at(got, piece, share[:, 0])
    assert math.isclose(logs[0, 0], math.log(total)) and all(math.isclose(got[r], v / total, rel_tol=1e-9) for r, v in want.items())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("abc the-=.1é"), min_size=250, max_size=900), st.integers(1, 40))
def test_pieces_of_long_units_match_the_library(text, times):
    solid = text.replace(" ", "") * times
    assert ENCODER.run([solid]) == [library(solid)]


def test_language_of_an_empty_table_and_the_query(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.predicted(docs, *language.fit(docs, PATH), PATH).collect() == []
    rows = QUERIES["op2_language"](spark, "/root/testdata/sf0.001").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_token_and_piece_queries_match_the_libraries(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    encoder = token_files.tokenizer(token_files.vocabulary_path())
    assert {r.doc_id: r.n_tokens for r in QUERIES["op1_token_counts"](spark, "/root/testdata/sf0.001").collect()} == {
        i: len(encoder.encode_ordinary(t or "")) for i, t in docs.items()
    }
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in QUERIES["op6_sentencepiece"](spark, "/root/testdata/sf0.001").collect():
        ids, decoded = library(docs[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (ids.count(" ") + 1, sha(ids), sha(decoded))
