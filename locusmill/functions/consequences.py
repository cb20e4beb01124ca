"""Ranking and reshaping of transcript consequences. All row-local: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from locusmill.functions.basics import as_set, flatten_present, last_part, let, literal_map
from locusmill.vocabulary import (
    AMINO_ACIDS,
    CONSEQUENCE_TERMS,
    LOF_UP_TO,
    MISSENSE_UP_TO,
    OMITTED_TERMS,
    SPLICE_TERMS,
    SYNONYMOUS_UP_TO,
)

RANK = {term: rank for rank, term in enumerate(CONSEQUENCE_TERMS)}

# Transcript fields kept in the sorted array, in output order.
BASE_FIELDS = [
    "biotype", "canonical", "cdna_start", "cdna_end", "codons",
    "gene_id", "gene_symbol", "hgvsc", "hgvsp", "transcript_id",
]
CODING_FIELDS = [
    "amino_acids", "lof", "lof_filter", "lof_flags", "lof_info",
    "polyphen_prediction", "protein_id", "protein_start", "sift_prediction",
]

# Fields of the worst-transcript struct, in output order.
WORST_FIELDS = [
    "biotype", "canonical", "category", "cdna_start", "cdna_end", "codons", "gene_id",
    "gene_symbol", "hgvs", "hgvsc", "major_consequence", "major_consequence_rank", "transcript_id",
]
WORST_CODING_FIELDS = [
    "amino_acids", "domains", "hgvsp", "lof", "lof_flags", "lof_filter", "lof_info",
    "polyphen_prediction", "protein_id", "sift_prediction",
]


def term_rank(term: Column) -> Column:
    """0-based severity; NULL for an unknown term."""
    return literal_map(RANK)[term]


def major_term(terms: Column) -> Column:
    """``struct(rank, place, term)`` of the most severe term.

    Unknown terms come last, with the number of known terms as rank; ties keep their order.
    """
    ranked = F.transform(
        terms,
        lambda t, i: F.struct(
            F.coalesce(term_rank(t), F.lit(len(RANK))).alias("rank"), i.alias("place"), t.alias("term")
        ),
    )
    return F.array_min(ranked)


def category(rank: Column) -> Column:
    return (
        F.when(rank.isNull(), F.lit(None).cast("string"))
        .when(rank <= RANK[LOF_UP_TO], "lof")
        .when(rank <= RANK[MISSENSE_UP_TO], "missense")
        .when(rank <= RANK[SYNONYMOUS_UP_TO], "synonymous")
        .otherwise("other")
    )


def display_name(transcript: Column, major: Column) -> Column:
    """Short HGVS text for one transcript."""
    protein = transcript["hgvsp"]
    letters = literal_map(AMINO_ACIDS)[transcript["amino_acids"]]
    unchanged_residue = F.concat(
        F.lit("p."), letters, transcript["protein_start"].cast("string"), letters
    )
    at_splice_site = F.coalesce(major.isin(SPLICE_TERMS), F.lit(False))
    return (
        F.when(protein.isNull() | at_splice_site, last_part(transcript["hgvsc"], ":"))
        .when(F.contains(protein, F.lit("=")) | F.contains(protein, F.lit("%3D")), unchanged_residue)
        .otherwise(last_part(protein, ":"))
    )


def domain_names(domains: Column) -> Column:
    return F.transform(domains, lambda d: F.concat(d["db"], F.lit(":"), d["name"]))


def _tier(transcript: Column, kept_terms: Column, most_severe: Column) -> Column:
    """1 to 8: coding first, then the variant's most severe term, then canonical."""
    coding = F.coalesce(transcript["biotype"] == "protein_coding", F.lit(False))
    severe = F.coalesce(F.array_contains(kept_terms, most_severe), F.lit(False))
    canonical = F.coalesce(transcript["canonical"] == 1, F.lit(False))
    return (
        F.when(coding, 0).otherwise(4) + F.when(severe, 0).otherwise(2) + F.when(canonical, 1).otherwise(2)
    )


def sorted_transcripts(
    vep: Column, coding_annotations: bool = True, omit: list[str] | None = OMITTED_TERMS
) -> Column:
    """Annotated transcripts of a variant, best one first."""
    fields = BASE_FIELDS + CODING_FIELDS if coding_annotations else BASE_FIELDS
    hidden = [] if coding_annotations else ["hgvsp"]
    kept_fields = [f for f in fields if f not in hidden]
    omitted = list(omit or [])

    def kept_terms(transcript: Column) -> Column:
        terms = transcript["consequence_terms"]
        return F.filter(terms, lambda t: ~t.isin(omitted)) if omitted else terms

    def annotate(transcript: Column, terms: Column, worst: Column) -> list[Column]:
        major, rank = worst["term"], F.when(worst["rank"] < len(RANK), worst["rank"])
        domains = [] if not coding_annotations else [domain_names(transcript["domains"]).alias("domains")]
        return [
            *[transcript[f].alias(f) for f in kept_fields],
            terms.alias("consequence_terms"),
            *domains,
            major.alias("major_consequence"),
            category(rank).alias("category"),
            display_name(transcript, major).alias("hgvs"),
            rank.alias("major_consequence_rank"),
        ]

    # each lambda body reads already evaluated struct fields: nothing is computed twice
    prepared = F.transform(
        vep["transcript_consequences"],
        lambda t: F.struct(
            t.alias("t"), kept_terms(t).alias("terms"), major_term(t["consequence_terms"]).alias("major")
        ),
    )
    present = F.filter(prepared, lambda p: F.size(p["terms"]) > 0)
    # the place makes the order total, and equal tiers keep their input order
    keyed = F.transform(
        present,
        lambda p, i: F.struct(
            _tier(p["t"], p["terms"], vep["most_severe_consequence"]).alias("tier"),
            i.alias("place"),
            p.alias("p"),
        ),
    )
    return F.transform(
        F.array_sort(keyed),
        lambda k, i: F.struct(
            *annotate(k["p"]["t"], k["p"]["terms"], k["p"]["major"]), i.alias("transcript_rank")
        ),
    )


def worst_transcript(transcripts: Column, coding_annotations: bool = True) -> Column:
    """The first sorted transcript as a flat struct; a struct of NULLs when there is none."""

    def pick(t: Column) -> Column:
        wanted = WORST_FIELDS + WORST_CODING_FIELDS if coding_annotations else WORST_FIELDS
        return F.struct(
            *[
                (F.array_join(as_set(t[f]), ",") if f == "domains" else t[f]).alias(f)
                for f in wanted
            ]
        )

    return F.when(transcripts.isNotNull(), let(F.get(transcripts, F.lit(0)), pick))


def term_set(transcripts: Column) -> Column:
    return as_set(flatten_present(F.transform(transcripts, lambda t: t["consequence_terms"])))


def gene_set(transcripts: Column, only_coding: bool = False) -> Column:
    if only_coding:
        transcripts = F.filter(transcripts, lambda t: F.coalesce(t["biotype"], F.lit("")) == "protein_coding")
    return as_set(F.transform(transcripts, lambda t: t["gene_id"]))


def domain_set(raw_transcripts: Column) -> Column:
    """From annotator output, where domains are structs."""
    return as_set(flatten_present(F.transform(raw_transcripts, lambda t: domain_names(t["domains"]))))


def sorted_domain_set(transcripts: Column) -> Column:
    """From sorted transcripts, where domains are already names."""
    return as_set(flatten_present(F.transform(transcripts, lambda t: t["domains"])))


def transcript_id_set(transcripts: Column) -> Column:
    return as_set(F.transform(transcripts, lambda t: t["transcript_id"]))


def _braced(pairs: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(F.filter(pairs, lambda p: p.isNotNull()), ","), F.lit("}"))


def gene_consequence_json(transcripts: Column, genes: Column) -> Column:
    """``{"gene":"worst term",...}``: the first matching transcript speaks for its gene."""

    def pair(gene: Column) -> Column:
        first = F.get(F.filter(transcripts, lambda t: t["gene_id"] == gene), F.lit(0))
        return F.concat(F.lit('"'), gene, F.lit('":"'), first["major_consequence"], F.lit('"'))

    return _braced(as_set(F.transform(genes, pair)))


def transcript_consequence_json(transcripts: Column) -> Column:
    """``{"transcript": "term",...}`` in transcript order, with a blank after the colon."""
    return _braced(
        F.transform(
            transcripts,
            lambda t: F.concat(
                F.lit('"'), t["transcript_id"], F.lit('": "'), t["major_consequence"], F.lit('"')
            ),
        )
    )
