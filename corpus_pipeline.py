"""A training-data pipeline of five stages over ``documents``.

Each stage takes the documents that the one before it kept and returns documents of the same
columns; the last returns counts and digests of the encoded texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.llm import contamination, lines, near, pieces, toxicity
from locusmill.llm.shared import WORD, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go.

    The model is learned from the texts and ``labels`` of ``sf_dir``; without labels it rejects
    nothing. Null and empty texts have the score of a text without words. Rows that repeat are
    judged alike, and columns of any names stay.
    """
    return toxicity.without_toxic(docs, toxicity.production_model(spark, sf_dir))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of three lines that stand earlier in the corpus go, and so do documents of which
    they leave no word: all that these say stands elsewhere.

    Null texts, texts without words and texts of fewer than three lines with words stay as they
    are. Rows that agree in id and text count as one document. ``n_chars`` follows the text.
    """
    had = docs.columns
    marked = docs.withColumn("_had_word", F.coalesce(F.col("text").rlike(WORD), F.lit(False)))
    left = lines.without_repeats(marked).where(~F.col("_had_word") | F.col("text").rlike(WORD))
    return left.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*had)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that are linked by five-word shingles at 80 percent, the one with
    the smallest id stays.

    Null texts and texts without words are in no group and stay. Rows that repeat an id with the
    same text are one document and stay or go together; other texts of that id are judged by
    themselves. A row without id goes if an equal set of shingles belongs to a row with one.
    """
    return near.without_near_duplicates(docs, 5, 80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go.

    Null and empty texts hold none, and without items nothing goes. Rows that repeat are judged
    alike, and columns of any names stay.
    """
    return contamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of what is left, as counts and digests of the ids and of their decoding: a row for each
    row, whose id may repeat or be null. A null text is encoded as an empty one."""
    return pieces.digests(docs, pieces.model_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("encode", encode),
]
#: SQL can't train the toxicity model; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
