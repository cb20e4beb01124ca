"""Joins to reference tables and interval lists."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusmill.functions.basics import explode_computed

VARIANT_KEYS = ["contig", "position", "ref", "alt"]
INTERVAL_BIN = 4096
BROADCAST_BYTES = 64 << 20


def broadcast_if_bounded(frame: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a frame for broadcast when its measured size allows it; otherwise leave it alone.

    Spark's own threshold works on estimates and is low. Where the other side is every genotype
    of a cohort, one pass over the small side to measure it saves shuffling the large one.
    """
    kinds = {f.name: f.dataType.typeName() for f in frame.schema.fields}
    measures = [F.octet_length(F.col(f"`{c}`")) for c, kind in kinds.items() if kind in ("string", "binary")]
    if nested := [F.col(f"`{c}`") for c, kind in kinds.items() if kind in ("array", "map", "struct")]:
        measures.append(F.octet_length(F.to_json(F.struct(*nested))))
    row_bytes = sum((F.coalesce(m, F.lit(0)) for m in measures), F.lit(16 * len(kinds)))
    measured = frame.agg(F.sum(row_bytes.cast("long"))).first()[0] or 0
    return F.broadcast(frame) if measured <= max_bytes else frame


def one_per_key(reference: DataFrame, keys: list[str], fields: list[str], order_by: list[str]) -> DataFrame:
    """The row with the lowest ``order_by`` for each key, so that a lookup never multiplies rows.

    The minimum is kept map-side, so a key with very many rows costs one row per task.
    """
    chosen = F.min_by(F.struct(*fields), F.struct(*order_by))
    return reference.groupBy(*keys).agg(chosen.alias("_row")).select(*keys, *[F.col(f"_row.{f}") for f in fields])


def _as_in(variants: DataFrame, reference: DataFrame, keys: list[str]) -> dict[str, Column]:
    """Whole-number keys of another width, cast; one that does not fit is NULL, and no variant has it."""
    types = [(k, variants.schema[k].dataType, reference.schema[k].dataType) for k in keys]
    return {k: F.col(k).try_cast(want) for k, want, has in types if want != has and all(isinstance(t, T.IntegralType) for t in (want, has))}


def variant_lookup(
    variants: DataFrame,
    reference: DataFrame,
    fields: list[str],
    order_by: list[str] | None = None,
    keys: list[str] = VARIANT_KEYS,
) -> DataFrame:
    """Left lookup on locus and alleles. Row counts stay as they are; no match gives NULLs.

    A reference has about as many rows as there are variants. Spark's estimate of its size does not
    know how long texts are, and a broadcast chosen by it would go through the driver; so this is
    a merge join. Lookups by the same keys share one shuffle of the variants, so the reference's
    whole numbers take the type that they have there.
    """
    reference = reference.withColumns(_as_in(variants, reference, keys))
    return variants.join(one_per_key(reference, keys, fields, order_by or fields).hint("merge"), keys, "left")


def predictor_struct(
    splice_ai: str = "splice_ai", primate_ai: str = "primate_ai", cadd: str = "cadd", revel: str = "revel"
) -> Column:
    return F.struct(
        F.col(splice_ai).alias("splice_ai"),
        F.col(primate_ai).alias("primate_ai"),
        F.col(cadd).alias("cadd"),
        F.col(revel).alias("revel"),
    ).alias("in_silico_predictors")


def interval_coverage(intervals: DataFrame, width: int = INTERVAL_BIN) -> DataFrame:
    """Intervals (1-based, both ends in) as one row per contig and bin that they touch.

    Each interval is clipped to its bins. Of the pieces with one start in one bin only the
    longest matters for coverage, and a maximum is combined map-side; so a bin holds at most
    ``width`` pieces however many intervals overlap there, and the gathered array is bounded.
    """
    bins = F.expr(f"sequence(cast(start AS bigint) div {width}, cast(end AS bigint) div {width})")
    clipped = explode_computed(intervals.where("start <= end"), bins, "bin").select(
        "contig",
        "bin",
        F.greatest(F.col("start").cast("long"), F.col("bin") * width).alias("start"),
        F.least(F.col("end").cast("long"), F.col("bin") * width + (width - 1)).alias("end"),
    )
    longest = clipped.groupBy("contig", "bin", "start").agg(F.max("end").alias("end"))
    return longest.groupBy("contig", "bin").agg(F.collect_list(F.struct("start", "end")).alias("pieces"))


def within_intervals(sites: DataFrame, intervals: DataFrame, width: int = INTERVAL_BIN) -> DataFrame:
    """Sites that lie in any interval, with all their columns, whatever their names.

    An equi-join with at most one coverage row per site: no pairs of sites and intervals are
    formed. The coverage is sent to all tasks if it measures as small, so that wide rows are
    filtered where they are read; otherwise Spark may split large keys of the site side.
    """
    coverage = interval_coverage(intervals, width).select(
        F.col("contig").alias("_covered_contig"), F.col("bin").alias("_covered_bin"), F.col("pieces").alias("_covered_pieces")
    )
    bin_ = F.expr(f"cast(position as bigint) div {width}")
    joined = sites.join(broadcast_if_bounded(coverage), (F.col("contig") == F.col("_covered_contig")) & (bin_ == F.col("_covered_bin")))
    inside = F.exists("_covered_pieces", lambda p: F.col("position").between(p["start"], p["end"]))
    return joined.where(inside).drop("_covered_contig", "_covered_bin", "_covered_pieces")


# Fixed value: a range is a contig, or contig:start-end with K or M for thousands or millions.
_RANGE = re.compile(r"^(?P<contig>[^:]+)(?::(?P<start>[\d.]+[kKmM]?|start)-(?P<end>[\d.]+[kKmM]?|end))?$")
_SCALE = {"k": 1_000, "m": 1_000_000}


def _coordinate(text: str) -> int:
    scale = _SCALE.get(text[-1].lower(), 1)
    return round(float(text[:-1]) * scale) if scale > 1 else int(text)


def in_range(range_text: str, contig: str = "contig", position: str = "position") -> Column:
    """Filter for one ``chrom:start-end`` range; the end is exclusive. Pushes down to parquet."""
    parsed = _RANGE.match(range_text.replace(",", ""))
    if parsed is None:
        raise ValueError(f"not a range: {range_text}")
    condition = F.col(contig) == parsed["contig"]
    if parsed["start"] not in (None, "start"):
        condition &= F.col(position) >= _coordinate(parsed["start"])
    if parsed["end"] not in (None, "end"):
        condition &= F.col(position) < _coordinate(parsed["end"])
    return condition
