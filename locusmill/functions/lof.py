"""Loss-of-function flags on transcripts, variants and genes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from locusmill.functions.basics import as_set, let


def _annotated(transcripts: Column) -> Column:
    return F.filter(transcripts, lambda t: t["lof"] != "")


def transcript_low_confidence(transcript: Column) -> Column:
    return F.coalesce((transcript["lof"] != "") & (transcript["lof"] != "HC"), F.lit(False))


def transcript_flagged(transcript: Column) -> Column:
    return F.coalesce((transcript["lof"] != "") & (transcript["lof_flags"] != ""), F.lit(False))


def _all_annotated(transcripts: Column, holds) -> Column:
    annotated = _annotated(transcripts)
    return (F.size(annotated) > 0) & F.forall(annotated, holds)


def variant_low_confidence(transcripts: Column) -> Column:
    """Some annotation, and none of them high confidence."""
    return _all_annotated(transcripts, lambda t: t["lof"] != "HC")


def variant_flagged(transcripts: Column) -> Column:
    """Some annotation, and all of them flagged."""
    return _all_annotated(transcripts, lambda t: t["lof_flags"] != "")


def _genes_where_all(transcripts: Column, holds) -> Column:
    """Genes with annotations of which none breaks the rule: one pass and a set difference."""
    annotated = F.filter(_annotated(transcripts), lambda t: t["gene_id"].isNotNull())
    breaking = F.filter(annotated, lambda t: ~F.coalesce(holds(t), F.lit(False)))
    gene_of = lambda t: t["gene_id"]
    return as_set(F.array_except(F.transform(annotated, gene_of), F.transform(breaking, gene_of)))


def genes_low_confidence(transcripts: Column) -> Column:
    return _genes_where_all(transcripts, lambda t: t["lof"] != "HC")


def genes_flagged(transcripts: Column) -> Column:
    return _genes_where_all(transcripts, lambda t: t["lof_flags"] != "")


def variant_flags(transcripts: Column) -> Column:
    return F.struct(
        variant_low_confidence(transcripts).alias("lc_lof"), variant_flagged(transcripts).alias("lof_flag")
    )


def flag_transcripts(transcripts: Column) -> Column:
    """Add a ``flags`` struct to every transcript.

    The gene sets are bound once per variant. As plain columns they would be put back into the
    lambda by the optimizer and be computed again for every transcript.
    """

    def holds_gene(genes: Column, t: Column) -> Column:
        return F.coalesce(F.array_contains(genes, t["gene_id"]), F.lit(False))

    def add_flags(bound: Column) -> Column:
        return F.transform(
            bound["transcripts"],
            lambda t: t.withField(
                "flags",
                F.struct(
                    transcript_low_confidence(t).alias("lc_lof"),
                    holds_gene(bound["low_confidence"], t).alias("lc_lof_in_gene"),
                    transcript_flagged(t).alias("lof_flag"),
                    holds_gene(bound["flagged"], t).alias("lof_flag_in_gene"),
                    ((t["category"] == "lof") & (t["lof"] == "")).alias("nc_transcript"),
                ),
            ),
        )

    return let(
        F.struct(
            transcripts.alias("transcripts"),
            genes_low_confidence(transcripts).alias("low_confidence"),
            genes_flagged(transcripts).alias("flagged"),
        ),
        add_flags,
    )
