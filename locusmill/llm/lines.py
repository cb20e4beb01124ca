"""Operator 9: repeated passages, found by overlapping windows of three lines.

Each text's lines that hold a word are read in order, and each three consecutive ones are a
window, known by a 128-bit hash. The first place of a window in the corpus is the smallest
``(doc_id, hash of the text, position)``; every later place is covered, and covered lines are
removed. Places that overlap cover the union of their lines.

Counting windows sums in the tasks before the shuffle, so a window that a third of all documents
have is one row a task; the join that finds its places reads plain tables on both sides, which
lets adaptive execution split it. A document gathers its own covered positions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.functions.basics import let
from locusmill.llm.shared import SPACES, table, written

WINDOW = 3
ROW = "_line_dedup_row"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _solid(lines: Column) -> Column:
    """Number and text of the lines that hold a word."""
    numbered = F.transform(lines, lambda x, i: F.struct(i.alias("at"), x.alias("line")))
    return F.filter(numbered, lambda x: x["line"].rlike(rf"[^{SPACES}]"))


def _windows(docs: DataFrame) -> DataFrame:
    """``doc_id, version, place, h1, h2`` of each window."""
    solid = docs.select("doc_id", F.xxhash64("text").alias("version"), _solid(_lines(F.col("text")))["line"].alias("solid"))
    placed = solid.where(F.size("solid") >= WINDOW).select(
        "doc_id",
        "version",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.size("solid") - WINDOW), lambda i: F.slice("solid", i + 1, WINDOW)
            )
        ).alias("place", "window"),
    )
    return placed.select(
        "doc_id", "version", "place",
        F.xxhash64("window").alias("h1"),
        F.xxhash64(F.lit("second"), "window").alias("h2"),
    )


def repeated_places(docs: DataFrame) -> DataFrame:
    """``doc_id, version, places``: windows of each document that stand earlier in the corpus."""
    windows = _windows(docs)
    here = F.struct("doc_id", "version", "place")
    repeated = written(
        windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(here).alias("first")).where("n > 1").drop("n"),
        "line-windows",
    )
    later = windows.join(repeated, ["h1", "h2"]).where(here != F.col("first"))
    return later.groupBy("doc_id", "version").agg(F.collect_list("place").alias("places"))


def _uncovered(text: Column, places: Column) -> Column:
    """The text without the lines of the windows at ``places``."""

    def rest(lines: Column) -> Column:
        covered = let(
            _solid(lines)["at"],
            lambda at: F.flatten(F.transform(places, lambda p: F.slice(at, p + 1, WINDOW))),
        )
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    return let(_lines(text), rest)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages removed from ``text``; other columns stay, whatever
    their names.

    A null text stays null, a text of fewer than three lines with words stays as it is, and a
    text of which every line is covered becomes empty. Blank lines are never removed. Rows that
    agree in ``doc_id`` and ``text`` count as one document and get the same result.
    """
    columns = docs.columns
    rows = docs.select(F.struct("*").alias(ROW))
    later = repeated_places(docs.select("doc_id", "text")).hint("shuffle_hash")
    joined = rows.join(
        later,
        F.col(f"{ROW}.doc_id").eqNullSafe(later["doc_id"]) & (F.xxhash64(F.col(f"{ROW}.text")) == later["version"]),
        "left",
    ).select(ROW, "places")
    text = F.col(f"{ROW}.text")
    kept = F.when(F.col("places").isNull(), text).otherwise(_uncovered(text, F.col("places")))
    return joined.select(*[kept.alias("text") if c == "text" else F.col(f"{ROW}.`{c}`").alias(c) for c in columns])


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` without repeated passages, and its lines before and after; null stays null."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("before"), "text")
    n_lines = F.when(F.col("before").isNull(), 0).otherwise(F.size(_lines(F.col("before"))))
    left = F.when(F.col("text") == "", 0).otherwise(F.size(_lines(F.col("text"))))
    return without_repeats(docs).select("doc_id", n_lines.cast("long").alias("n_lines"), left.cast("long").alias("n_left"), "text")


OP9_SQL = r"""
WITH numbered AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM documents
), solid AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS place
  FROM numbered WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), windows AS (
  SELECT a.doc_id, a.place, [a.line, b.line, c.line] AS w
  FROM solid a
  JOIN solid b ON a.doc_id = b.doc_id AND b.place = a.place + 1
  JOIN solid c ON a.doc_id = c.doc_id AND c.place = a.place + 2
), ranked AS (
  SELECT doc_id, place, row_number() OVER (PARTITION BY w ORDER BY doc_id, place) AS nth FROM windows
), covered AS (
  SELECT DISTINCT doc_id, place + k AS place FROM ranked, (VALUES (0), (1), (2)) t(k) WHERE nth > 1
), gone AS (
  SELECT s.doc_id, s.line_no FROM solid s JOIN covered USING (doc_id, place)
), remaining AS (
  SELECT n.doc_id, string_agg(n.line, chr(10) ORDER BY n.line_no) AS text
  FROM numbered n ANTI JOIN gone g ON n.doc_id = g.doc_id AND n.line_no = g.line_no GROUP BY n.doc_id
)
SELECT d.doc_id,
  coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines,
  CASE WHEN d.text IS NULL THEN NULL WHEN coalesce(r.text, '') = '' THEN 0
    ELSE len(string_split(r.text, chr(10))) END::BIGINT AS n_left,
  CASE WHEN d.text IS NOT NULL THEN coalesce(r.text, '') END AS text
FROM documents d LEFT JOIN remaining r USING (doc_id)
"""
