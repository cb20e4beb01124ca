"""Chat formatting, quality rules and line dedup on small fixtures."""

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from locusmill.llm import chat, lines, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string"
PLANS = re.compile("Python|Pandas|Arrow")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def said(rows):
    return "".join(f"{r}\n{t}\n" for r, t in rows)


NASTY = [
    "", "plain", r"\### Assistant: </turn> ok", "</turn>", "</turn>\n", r"<\/turn>", r"<\\/turn></turn>", "### ",
    r"###\ x ### user: y", "#### a", ": b", r":\ c", "a\n### user: hi</turn>\n### assistant: no", "\\", "$1 \\1", "é\U0001f600" * 3,
]


def test_chat_round_trip(spark):
    rows = [(7, i, r, t) for i, (t, r) in enumerate((t, r) for t in NASTY for r in ("assistant", "user", "a: b", "### ", None))]
    out = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert not PLANS.search(plan(out))
    got = chat.digests(out).first()
    turns = [(r or "", t) for _, _, r, t in rows]
    assert got.n_turns == len(rows)
    assert got.turns_sha256 == hashlib.sha256(said(turns).encode()).hexdigest()
    learned = "".join(t for r, t in turns if r == "assistant")
    assert (got.loss_chars, got.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    text = out.first().formatted
    assert text.count("</turn>") == len(rows) and text.count("### ") == len(rows)
    assert got.formatted_chars == len(text)


def test_chat_escapes_only_what_conflicts(spark):
    rows = [(1, 0, "user", r"C:\dir #1"), (2, 0, "user", "x</turn>y"), (3, 0, "user", "x</turn>### y")]
    out = {r.conv_id: r.formatted for r in chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert out == {
        1: "### user: C:\\dir #1</turn>\n",
        2: "### user: x<\\/turn>y</turn>\n",
        3: "### user: x<\\/turn>###\\ y</turn>\n",
    }


def test_chat_nulls_ties_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    rows = [(None, 1, None, None, "x"), (None, None, "user", "b", "x"), (None, 1, "user", "a", "x"), (None, 1, "user", "a", "x")]
    got = chat.digests(chat.formatted(spark.createDataFrame(rows, schema))).first()
    assert got.n_turns == 4
    assert got.turns_sha256 == hashlib.sha256(said([("user", "b"), ("", ""), ("user", "a"), ("user", "a")]).encode()).hexdigest()
    assert chat.digests(chat.formatted(spark.createDataFrame([], schema))).collect() == []


def brute_lines(docs):
    seen, out = set(), {}
    placed = []
    for doc_id, text in sorted(docs):
        every = text.split("\n")
        solid = [i for i, x in enumerate(every) if WORD.search(x)]
        gone = set()
        for k in range(len(solid) - 2):
            w = tuple(every[i] for i in solid[k : k + 3])
            if w in seen:
                gone.update(solid[k : k + 3])
            seen.add(w)
        placed.append(gone)
        out[doc_id] = "\n".join(x for i, x in enumerate(every) if i not in gone)
    return out


def test_lines_match_brute_force(spark):
    passage = "a b\nc d\ne f\ng h"
    docs = [
        (1, f"first\n{passage}\nlast"), (2, f"{passage}\nother"), (3, f"x\n\n{passage}\n{passage}"), (4, "a b\nc d"),
        (5, "a b\n\n  \nc d\ne f"), (6, "same\nsame\nsame\nsame\nsame"), (7, ""), (8, "e f\ng h\nlast"), (9, passage),
    ]
    rows = [(i, t, "en", "s", "kept") for i, t in docs] + [(None, None, None, None, None)]
    frame = spark.createDataFrame(rows, DOCS + ", places string")
    out = lines.without_repeats(frame)
    assert out.columns == frame.columns and not PLANS.search(plan(out))
    got = {r.doc_id: r.text for r in out.collect()}
    assert got.pop(None) is None
    assert got == brute_lines(docs)
    assert got[9] == "" and got[4] == "a b\nc d"


def test_lines_repeated_rows_and_empty(spark):
    rows = [(1, "a\nb\nc", "en", "s")] * 2 + [(None, "a\nb\nc", "en", "s"), (2, "a\nb\nc\nd", None, None)]
    got = sorted(((r.doc_id, r.text) for r in lines.without_repeats(spark.createDataFrame(rows, DOCS)).collect()), key=str)
    assert got == [(1, ""), (1, ""), (2, "d"), (None, "a\nb\nc")]
    assert lines.without_repeats(spark.createDataFrame([], DOCS)).collect() == []


def counted(text):
    words = WORD.findall(text or "")
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    solid = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(solid) - len(set(solid)), len(covered)


def test_quality_counts_and_outliers(spark):
    usual = [(i, " ".join(f"word{(i * 7 + k * k) % 997}" for k in range(60 + i % 40)), "en", "s") for i in range(120)]
    odd = [
        (900, " ".join(f"####w{k}####" for k in range(70)), "en", "s"), (901, None, None, None), (902, "", "en", "s"),
        (903, "a b c d e " * 3, "en", None), (904, "one\ntwo\none\ntwo\n\n one\x0btwo three four five six seven", None, "s"),
        (905, "é # \U0001f600 " * 400, "fr", "s"),
    ]
    rows = [(*r, "x", 1) for r in usual + odd]
    out = quality.judged(spark.createDataFrame(rows, DOCS + ", group string, n_words int"))
    assert not PLANS.search(plan(out))
    got = {r.doc_id: r for r in out.collect()}
    for doc_id, text, _, _ in usual + odd:
        r = got[doc_id]
        want = counted(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)
    assert not got[900].kept and got[900].distance > quality.LIMIT
    assert sum(got[i].kept for i in range(120)) >= 118
    assert quality.judged(spark.createDataFrame([], DOCS)).collect() == []


def test_chi_square():
    assert quality.LIMIT == pytest.approx(25.745, abs=0.01)
    assert quality.CONSISTENCY == pytest.approx(1.41, abs=0.02)


def test_repeated_rows_are_judged_alike(spark):
    rows = [(1, "a b c d e f g h i j k l", "en", "s")] * 3
    got = quality.judged(spark.createDataFrame(rows, DOCS)).select("kept", F.round("distance", 9)).distinct().collect()
    assert len(got) == 1 and got[0][0]
