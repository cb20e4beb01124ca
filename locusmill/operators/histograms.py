"""Fixed-bin histograms of genotype quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusmill.functions import genotypes as G
from locusmill.functions.basics import explode_computed

BINS = 20
# measure -> (start, end)
MEASURES = {"gq": (0, 100), "dp": (0, 100), "ab": (0, 1)}


def bin_number(value: Column, start: float, end: float, bins: int = BINS) -> Column:
    """0-based bin; -1 below, ``bins`` above, the upper edge in the last bin, NULL for NULL/NaN."""
    width = (end - start) / bins
    value = value.cast("double")
    inside = F.least(F.floor((value - start) / width), F.lit(bins - 1))
    return (
        F.when(value.isNull() | F.isnan(value), F.lit(None).cast("int"))
        .when(value < start, -1)
        .when(value > end, bins)
        .otherwise(inside.cast("int"))
    )


def bin_edges(start: float, end: float, bins: int = BINS) -> list[float]:
    width = (end - start) / bins
    return [start + i * width for i in range(bins + 1)]


def histogram_names(with_calls: bool = True, with_adj: bool = True, measures=("gq", "dp", "ab")) -> list[str]:
    """Names of the bundle, by which entry fields are there."""
    plain = [m for m in measures if m != "ab"]
    names = [f"{m}_hist_all" for m in plain]
    if with_calls:
        names += [f"{m}_hist_alt" for m in plain]
        names += ["ab_hist_alt"] if "ab" in measures else []
    return names + ([f"{n}_adj" for n in names] if with_adj else [])


def measured(gt: Column, ad: Column, dp: Column, gq: Column) -> dict[str, Column]:
    """The measured values of an entry; the balance of het calls alone."""
    depths = [F.coalesce(F.get(ad, F.lit(i)), F.lit(0)) for i in (0, 1)]
    ratio = F.try_divide(F.get(ad, F.lit(1)), depths[0] + depths[1])
    return {"gq": gq, "dp": dp, "ab": F.when(G.is_het(gt), ratio)}


def entry_measures(with_calls: bool = True, measures=("gq", "dp", "ab")) -> dict[str, Column]:
    """The measured values by the names of the entry's fields, for those that there are."""
    if not with_calls:
        return {m: F.col(m.upper()) for m in measures if m != "ab"}
    values = measured(*[F.col(c) for c in ("GT", "AD", "DP", "GQ")])
    return {m: values[m] for m in measures if m in values}


def quality_bins(entries: DataFrame, keys: list[str], with_calls: bool = True, with_adj: bool = True,
                 measures=("gq", "dp", "ab")) -> DataFrame:
    """Counts per variant, measure and bin, for all four sample selections at once.

    Each entry becomes at most three rows (one per measure) instead of one per histogram, and
    the counts are combined before the shuffle: a task sends 22 bins per measure at most.
    """
    gt = F.col("GT")
    pairs = F.array(
        *[
            F.struct(F.lit(m).alias("measure"), bin_number(value, *MEASURES[m]).alias("bin"))
            for m, value in entry_measures(with_calls, measures).items()
        ]
    )
    non_ref = F.coalesce(G.is_non_ref(gt), F.lit(False)) if with_calls else F.lit(False)
    adj = F.coalesce(F.col("adj"), F.lit(False)) if with_adj else F.lit(False)
    selected = entries.select(*keys, non_ref.alias("non_ref"), adj.alias("adj"), pairs.alias("pairs"))
    exploded = explode_computed(selected, F.col("pairs"), "p").where(F.col("p.bin").isNotNull())
    return exploded.groupBy(*keys, F.col("p.measure").alias("measure"), F.col("p.bin").alias("bin")).agg(
        F.count(F.lit(1)).alias("all"),
        F.count_if("non_ref").alias("alt"),
        F.count_if("adj").alias("all_adj"),
        F.count_if(F.col("non_ref") & F.col("adj")).alias("alt_adj"),
    )


def _count_column(name: str) -> tuple[str, str]:
    """Measure and count column that a histogram is read from."""
    measure, selection = name.split("_hist_")
    # het calls are non-reference by definition, so the balance counts sit in alt
    return measure, selection


def histograms_long(entries: DataFrame, keys: list[str], **fields) -> DataFrame:
    """Non-empty bins of every histogram: ``hist, bin, n``."""
    names = histogram_names(fields.get("with_calls", True), fields.get("with_adj", True))
    counts = quality_bins(entries, keys, **fields)
    rows = F.array(
        *[
            F.when(
                F.col("measure") == _count_column(n)[0],
                F.struct(F.lit(n).alias("hist"), F.col(_count_column(n)[1]).alias("n")),
            )
            for n in names
        ]
    )
    return explode_computed(counts, rows, "h").select(*keys, "h.hist", "bin", "h.n").where("n > 0")


def quality_histograms(entries: DataFrame, keys: list[str], **fields) -> DataFrame:
    """The bundle as one struct column of dense histograms per variant.

    The second aggregation gathers at most 66 bin rows per variant.
    """
    names = histogram_names(fields.get("with_calls", True), fields.get("with_adj", True),
                            fields.get("measures", ("gq", "dp", "ab")))
    counts = quality_bins(entries, keys, **fields)
    measures = sorted({_count_column(n)[0] for n in names})
    gathered = counts.groupBy(*keys).agg(
        *[
            F.expr(
                f"""map_from_entries(collect_list(CASE WHEN measure = '{m}' THEN
                  struct(bin, struct(`all`, alt, all_adj, alt_adj) AS n) END)) AS _{m}"""
            )
            for m in measures
        ]
    )
    return gathered.selectExpr(*keys, f"{_bundle(names, _dense)} AS raw_qual_hists")


def _bundle(names: list[str], counts) -> str:
    """SQL of the histogram structs; ``counts`` gives the SQL of bins, smaller and larger by name."""

    def histogram(name: str) -> str:
        edges = ", ".join(f"{float(e)!r}D" for e in bin_edges(*MEASURES[_count_column(name)[0]]))
        bins, smaller, larger = counts(name)
        return (
            f"named_struct('bin_edges', array({edges}), 'bin_freq', {bins}, "
            f"'n_smaller', {smaller}, 'n_larger', {larger})"
        )

    return "named_struct(" + ", ".join(f"'{n}', {histogram(n)}" for n in names) + ")"


def bundle(counts) -> str:
    """SQL of the whole bundle; ``counts`` gives the SQL of bins, smaller and larger by name."""
    return _bundle(histogram_names(), counts)


def _dense(name: str) -> tuple[str, str, str]:
    measure, selection = _count_column(name)
    count = lambda key: f"coalesce(_{measure}[{key}].`{selection}`, 0L)"
    return f"transform(sequence(0, {BINS - 1}), i -> {count('i')})", count(-1), count(BINS)


def empty_histograms(names: list[str]) -> Column:
    """The bundle of a site without entries."""
    return F.expr(_bundle(names, lambda name: (f"array_repeat(0L, {BINS})", "0L", "0L")))


def regrouped(hists: str = "raw_qual_hists") -> list[Column]:
    """Balance, depth and quality structs; balance edges carry three decimals."""

    def rounded(name: str) -> Column:
        hist = F.col(f"{hists}.{name}")
        return hist.withField("bin_edges", F.transform(hist["bin_edges"], lambda e: F.round(e, 3)))

    def by_selection(measure: str) -> Column:
        return F.struct(
            F.col(f"{hists}.{measure}_hist_all").alias("all_raw"),
            F.col(f"{hists}.{measure}_hist_alt").alias("alt_raw"),
            F.col(f"{hists}.{measure}_hist_all_adj").alias("all_adj"),
            F.col(f"{hists}.{measure}_hist_alt_adj").alias("alt_adj"),
        )

    return [
        F.struct(
            rounded("ab_hist_alt").alias("alt_raw"), rounded("ab_hist_alt_adj").alias("alt_adj")
        ).alias("allele_balance"),
        by_selection("dp").alias("genotype_depth"),
        by_selection("gq").alias("genotype_quality"),
    ]
