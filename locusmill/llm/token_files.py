"""Operator 1: token counts from flat token files without an index.

A token file is nothing but 16-bit ids, documents one after another, an end-of-document id after
each. Blocks of a file are scanned by different tasks: a vectorised search gives the places of
the separators. A document that crosses blocks is stitched by a prefix scan over blocks: the
number of separators before a block numbers its documents, and the largest separator place before
it tells where its first document began. The scan has two levels, chunks of blocks and blocks in
a chunk, so that a file that holds a third of all tokens is not one task's work.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusmill.llm.blobs import opened, task_file, write_file
from locusmill.llm.shared import batch, fresh_folder, slices, table, written

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: The vocabulary leaves this id free for the end of a document.
END = 50256
TOKEN = np.dtype("<u2")
BLOCK_TOKENS, CHUNK_BLOCKS = 4 << 20, 1024
#: A task starts another file at this size.
FILE_BYTES = 1 << 30


@functools.lru_cache(maxsize=1)
def tokenizer(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("documents", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def write_token_files(docs: DataFrame, folder: str, path: str) -> DataFrame:
    """Writes the texts of ``doc_id, text`` rows; returns ``file, ordinal, doc_id``.

    A null text is an empty document: its end id alone. The result is a table of its own, made
    once; it names only the files of tasks that ended well.
    """
    schema = "file string, ordinal long, doc_id long"

    def run(batches):
        encoder, file, out, size, ordinal, number = tokenizer(path), "", None, 0, 0, 0
        try:
            for part in slices(batches, "text"):
                if out is None or size >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    file, size, ordinal, number = task_file(folder, ".u16", number), 0, 0, number + 1
                    out = write_file(file)
                for text in part.column("text").to_pylist():
                    ids = encoder.encode_ordinary(text or "")
                    out.write(np.array([*ids, END], TOKEN).tobytes())
                    size += TOKEN.itemsize * (len(ids) + 1)
                yield batch(schema, [file] * len(part), np.arange(ordinal, ordinal + len(part)), part.column("doc_id"))
                ordinal += len(part)
        finally:
            if out is not None:
                out.close()

    return written(docs.select("doc_id", "text").mapInArrow(run, schema), "token-documents")


def _blocks(files: DataFrame, block_tokens: int) -> DataFrame:
    """``file, block, start, stop`` (in tokens) of files named in ``file``."""

    def run(batches):
        for part in batches:
            names = part.column("file").to_pylist()
            sizes = [store.get_file_info(path).size // TOKEN.itemsize for store, path in map(opened, names)]
            yield batch("file string, tokens long", names, sizes)

    sized = files.select("file").mapInArrow(run, "file string, tokens long").where("tokens > 0")
    numbered = sized.select("file", "tokens", F.explode(F.expr(f"sequence(0L, (tokens - 1) div {block_tokens})")).alias("block"))
    start = F.col("block") * block_tokens
    return numbered.select("file", "block", start.alias("start"), F.least(start + block_tokens, "tokens").alias("stop"))


def scan(files: DataFrame, end: int = END, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """For each block: its place, how many separators it has, the places after the first and the
    last of them, and the lengths of the documents that lie between two of them."""
    schema = "file string, block long, start long, stop long, n long, first long, last long, inner array<long>"

    def run(batches):
        for part in batches:
            for row in part.to_pylist():
                store, path = opened(row["file"])
                with store.open_input_file(path) as source:
                    data = source.read_at(TOKEN.itemsize * (row["stop"] - row["start"]), TOKEN.itemsize * row["start"])
                after = np.flatnonzero(np.frombuffer(data, TOKEN) == end) + row["start"] + 1
                ends = (int(after[0]), int(after[-1])) if len(after) else (None, None)
                yield batch(
                    schema, [row["file"]], [row["block"]], [row["start"]], [row["stop"]], [len(after)],
                    [ends[0]], [ends[1]], [np.diff(after) - 1],
                )

    blocks = written(_blocks(files, block_tokens), "token-blocks")
    return blocks.repartition("file", "block").mapInArrow(run, schema)


def token_counts(files: DataFrame, end: int = END, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``file, ordinal, n_tokens`` of each document in the files named by ``file``.

    End ids are not counted. Tokens after a file's last end id are a document; an empty file has
    none.
    """
    scanned = written(scan(files, end, block_tokens), "token-scan").withColumn("chunk", F.expr(f"block div {CHUNK_BLOCKS}"))
    before = Window.unboundedPreceding, -1
    # level one: separators and the last one's place, of all chunks before
    chunks = scanned.groupBy("file", "chunk").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    by_chunk = Window.partitionBy("file").orderBy("chunk").rowsBetween(*before)
    chunks = chunks.select(
        "file", "chunk", F.coalesce(F.sum("n").over(by_chunk), F.lit(0)).alias("n_before"),
        F.coalesce(F.max("last").over(by_chunk), F.lit(0)).alias("last_before"),
    )
    # level two: of the blocks before in the same chunk
    by_block = Window.partitionBy("file", "chunk").orderBy("block").rowsBetween(*before)
    placed = scanned.select(
        "*", F.coalesce(F.sum("n").over(by_block), F.lit(0)).alias("n_here"), F.max("last").over(by_block).alias("last_here")
    ).join(chunks, ["file", "chunk"])
    began = F.coalesce("last_here", "last_before")
    stitched = placed.where("n > 0").select(
        "file",
        (F.col("n_before") + F.col("n_here")).alias("ordinal"),
        F.posexplode(F.concat(F.array(F.col("first") - 1 - began), "inner")).alias("k", "n_tokens"),
    ).select("file", (F.col("ordinal") + F.col("k")).alias("ordinal"), "n_tokens")
    rest = scanned.groupBy("file").agg(
        F.sum("n").alias("ordinal"), (F.max("stop") - F.coalesce(F.max("last"), F.lit(0))).alias("n_tokens")
    )
    return stitched.unionByName(rest.where("n_tokens > 0"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens``: documents become token files, which are then scanned."""
    docs = table(spark, sf_dir, "documents")
    manifest = write_token_files(docs, fresh_folder(spark, "tokens"), vocabulary_path())
    counts = token_counts(manifest.select("file").distinct())
    return manifest.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens")
