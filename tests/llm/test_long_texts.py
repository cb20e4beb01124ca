"""Texts of hundreds of thousands of characters, whole, in the operators that others don't test with them."""

import base64
import hashlib

from locusmill.llm import chat, lines, near, shared, warc


def test_chat_with_a_long_turn(spark):
    text = "### line </turn> \\ x\n" * 20_000
    rows = [(1, 0, "user", text), (1, 1, "assistant", text + "end"), (1, 2, "assistant", "short")]
    got = chat.digests(chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).first()
    said = "".join(f"{r}\n{t}\n" for _, _, r, t in rows)
    learned = text + "end" + "short"
    assert got.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert (got.loss_chars, got.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_warc_with_a_long_page(spark):
    pages = [(1, "http://a/1", "é" * 2_000_000), (2, "http://a/2", "é" * 2_000_000), (3, "http://a/3", "x")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    captures = warc.write_archives(frame, shared.fresh_folder(spark, "warc-long"))
    index = warc.write_index(captures, shared.fresh_folder(spark, "warc-long"))
    rows = {r.page_id: r for r in warc.read_records(warc.look_up(captures.select("key"), index)).collect()}
    digest = base64.b32encode(hashlib.sha1(pages[0][2].encode()).digest()).decode()
    assert (rows[1].payload_bytes, rows[1].payload_digest, rows[1].record_type, rows[1].refers_to) == (4_000_000, digest, "revisit", 2)
    assert rows[2].record_type == "response" and rows[3].payload_bytes == 1


def test_line_dedup_of_long_documents(spark):
    own = [f"line {i} of the first" for i in range(30_000)]
    text = "\n".join(own)
    again = "\n".join(["new one", *own[5_000:25_000], "new two"])
    docs = spark.createDataFrame([(1, text), (2, again), (3, "\n".join(["a", "b", "c"] * 4000))], "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.without_repeats(docs).collect()}
    # the third repeats itself: its first window of each turn of the three lines stays
    assert got[1] == text and got[2] == "new one\nnew two" and got[3] == "a\nb\nc"


def test_near_duplicates_of_long_documents(spark):
    words = [f"w{i * i % 99991}" for i in range(80_000)]
    edited = [w if i % 40 else "edited" for i, w in enumerate(words)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(reversed(words)))], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near.near_duplicates(docs).collect()}
    sets = [set(zip(x, x[1:], x[2:], strict=False)) for x in (words, edited)]
    linked = 100 * len(sets[0] & sets[1]) >= 85 * len(sets[0] | sets[1])
    assert got == {1: 1, 2: 1 if linked else 2, 3: 3} and linked
