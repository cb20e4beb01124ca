"""Call statistics of all sample groups and quality histograms, from one aggregation of the entries.

What an entry adds to the statistics of its variant is one number, its mark: its cell of population,
proband and sex, its counts and flags, and its bin of each measure. Equal marks of a variant are
counted, map-side first, and a variant's distinct marks are then gathered as a list of numbers.
There are at most as many as combinations of cells and bins, however many samples. With few samples
there is nothing to count before, and the marks are gathered in one shuffle, or in the line of
a text that holds all of them.

The list is a few bytes for each entry, while counts of all groups and dense histograms are
thousands a variant. So a variant carries its list through joins, and :func:`with_statistics` makes
counts and histograms of it in the end, in the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusmill.functions import genotypes as G
from locusmill.functions.basics import computed_once, in_small_methods
from locusmill.operators import frequencies as FQ
from locusmill.operators import histograms as H
from locusmill.vocabulary import PROBAND_LABEL, SEX_LABELS

COUNTS = ["AC", "AN", "nhomalt"]
MEASURES = ["gq", "dp", "ab"]
SELECTIONS = {"all": "true", "alt": "e.alt", "all_adj": "e.adj", "alt_adj": "e.alt AND e.adj"}
_SEXES = list(SEX_LABELS)
#: Up to so many samples, a variant's entries are gathered without being counted first.
FEW_SAMPLES = 32
#: Up to so many samples, columns for each are faster than rows that are gathered; of 16 and more they were slower.
WIDE_SAMPLES = 8
#: Lowest bit and number of bits of the parts of a mark. The cell lies above them, and above that how often the mark occurs.
_PARTS = {"adj": (0, 1), "alt": (1, 1), "AC": (2, 2), "AN": (4, 2), "nhomalt": (6, 1), "gq": (7, 5), "dp": (12, 5), "ab": (17, 5)}
_CELL = 22
#: Place of a bin in a list of counts: the bins, then those above and below; NULL has none.
_ABOVE, _BELOW, _NO_BIN = H.BINS, H.BINS + 1, 31
#: Up to so many entries, each count of a bin takes six bits of a word, and the three counts of a group take twenty.
_WORD_ENTRIES, _BIN_BITS, _BINS_A_WORD, _GROUP_BITS, _GROUPS_A_WORD = 63, 6, 10, 20, 3
_WORDS = -(-(H.BINS + 2) // _BINS_A_WORD)


def cell_number(pops: list[str]) -> Column:
    """Number of a sample's cell: population (the last for those without a column), proband, sex."""
    place = lambda c, values: F.coalesce(*[F.when(F.col(c) == v, F.lit(i)) for i, v in enumerate(values)], F.lit(len(values)))
    return (place("pop", pops) * 2 + place("proband", ["Yes"])) * (len(_SEXES) + 1) + place("sex", _SEXES)


def _group_cells(pops: list[str]) -> dict[str, str]:
    """Group tag -> condition on a mark's cell, in the order of the frequency columns."""
    sexes = len(_SEXES) + 1
    groups = {"adj": "true", "raw": "true"}
    groups |= {f"adj_{pop}": f"e.cell div {2 * sexes} = {i}" for i, pop in enumerate(pops)}
    groups[f"adj_{PROBAND_LABEL}"] = f"(e.cell div {sexes}) % 2 = 0"
    return groups | {f"adj_{label}": f"e.cell % {sexes} = {i}" for i, label in enumerate(SEX_LABELS.values())}


def _count_bit(pops: list[str]) -> int:
    """Lowest bit of a mark's count: behind the cells of the populations."""
    return _CELL + ((len(pops) + 1) * 2 * (len(_SEXES) + 1)).bit_length()


def entry_mark(gt: Column, adj: Column, values: dict[str, Column]) -> Column:
    """A mark without its cell: what an entry adds, whatever its sample's groups. ``values`` are
    those of :func:`measured`."""
    number = lambda c: F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    parts = {
        "adj": number(adj), "alt": number(G.is_non_ref(gt)), "AC": number(G.allele_count(gt, F.lit(1))), "AN": number(G.ploidy(gt)),
        "nhomalt": number((gt["a0"] == 1) & (gt["a1"] == 1)),
    }
    for measure, value in values.items():
        place = F.pmod(H.bin_number(value, *H.MEASURES[measure]), F.lit(_BELOW + 1))
        parts[measure] = F.coalesce(place.cast("long"), F.lit(_NO_BIN).cast("long"))
    mark = F.lit(0).cast("long")
    for name, value in parts.items():
        mark = mark.bitwiseOR(F.shiftleft(value, _PARTS[name][0]))
    return mark


def in_cell(mark: Column, cell: Column, pops: list[str]) -> Column:
    """A mark with the cell of its sample; without one, it is in the last population, proband and sex."""
    last = (len(pops) * 2 + 1) * (len(_SEXES) + 1) + len(_SEXES)
    return mark.bitwiseOR(F.shiftleft(F.coalesce(cell.cast("long"), F.lit(last).cast("long")), _CELL))


def wide_marks(variants: DataFrame, samples: list[str], cells: dict[str, int], pops: list[str]) -> DataFrame:
    """``_marks`` of variants that have ``GT_i, AD_i, DP_i, GQ_i`` and ``adj_i`` of each sample beside them, in the row.

    ``cells`` has the cells of the samples. There is a mark for each sample, in order.
    """
    once = F.lit(1 << _count_bit(pops))

    def mark(i: int, s: str) -> Column:
        values = H.measured(*[F.col(f"{f}_{i}") for f in ("GT", "AD", "DP", "GQ")])
        return in_cell(entry_mark(F.col(f"GT_{i}"), F.col(f"adj_{i}"), values), F.lit(cells.get(s)), pops).bitwiseOR(once)

    marks = in_small_methods(F.array(*[mark(i, s) for i, s in enumerate(samples)]), "bigint")
    spent = [f"{f}_{i}" for i in range(len(samples)) for f in ("GT", "AD", "DP", "GQ", "adj")]
    return variants.withColumn("_marks", marks).drop(*spent)


def _listed_once(marks: Column, pops: list[str]) -> Column:
    """A list of marks that stand for one entry each, as :func:`with_statistics` reads it."""
    return F.transform(marks, lambda m: m.bitwiseOR(F.lit(1 << _count_bit(pops))))


def gathered_marks(marked: DataFrame, keys: list[str], pops: list[str], few_samples: bool = False) -> DataFrame:
    """``_marks`` per variant from the column ``mark`` of its entries.

    Of many samples, equal marks are counted first, spread by variant and mark: a hot variant is as
    many rows as it has distinct marks when it comes to one task.
    """
    if few_samples:
        gathered = marked.groupBy(*keys).agg(F.collect_list("mark").alias("_marks"))
        return gathered.withColumn("_marks", _listed_once(F.col("_marks"), pops))
    counted = computed_once(marked.select(*keys, "mark"), "mark").groupBy(*keys, "mark").agg(F.count(F.lit(1)).alias("n"))
    numbered = counted.select(*keys, F.shiftleft("n", _count_bit(pops)).bitwiseOR(F.col("mark")).alias("mark"))
    return numbered.repartition(*keys).groupBy(*keys).agg(F.collect_list("mark").alias("_marks"))


def variant_statistics(entries: DataFrame, keys: list[str], pops: list[str], few_samples: bool = False) -> DataFrame:
    """``AC_/AN_/AF_/nhomalt_`` columns of every group, as :func:`frequencies_wide` gives them, and
    the struct ``raw_qual_hists`` of :func:`quality_histograms`.

    Needs ``GT, AD, DP, GQ, adj, pop, proband, sex`` on the entries, which are read once.
    ``few_samples`` says that there are at most ``FEW_SAMPLES``, with one entry for each variant.
    """
    mark = in_cell(entry_mark(F.col("GT"), F.col("adj"), H.entry_measures()), cell_number(pops), pops)
    marked = entries.select(*keys, mark.alias("mark"))
    return with_statistics(gathered_marks(marked, keys, pops, few_samples), pops)


def statistic_names(pops: list[str]) -> list[str]:
    """The frequency columns, in order."""
    return [f"{s}_{tag}" for tag in _group_cells(pops) for s in FQ.STATS]


def with_statistics(variants: DataFrame, pops: list[str], n_marks: int | None = None) -> DataFrame:
    """The columns of :func:`variant_statistics` in place of ``_marks``; zero counts where that is NULL.

    Up to ``_WORD_ENTRIES`` entries, all counts are kept in few words while the marks are gone
    through once, and cut out of them. Beyond, each count is summed for itself. ``n_marks`` says
    that every list has so many and that they are few: then words are sums of columns, which Spark
    compiles, while functions on lists it interprets.
    """
    others, bits, groups = [f"`{c}`" for c in variants.columns if c != "_marks"], _count_bit(pops), _group_cells(pops)
    if n_marks is None:
        counted, short, word = _counted_lists(variants, others, bits, groups), f"_n <= {_WORD_ENTRIES}", lambda w: f"_w.{w}"
    else:
        counted, short, word = _counted_columns(variants, others, bits, groups, n_marks), None, lambda w: f"_w_{w}"
    either = lambda few, many: few if short is None else f"if({short}, {few}, {many})"

    def statistic(name: str, place: int, tag: str) -> str:
        if name == "AF":
            return f"try_divide({statistic('AC', place, tag)}, {statistic('AN', place, tag)})"
        low, n = {"AC": (0, 7), "AN": (7, 7), "nhomalt": (14, 6)}[name]
        own = word(f"g{place // _GROUPS_A_WORD}")
        return either(_cut(own, place % _GROUPS_A_WORD * _GROUP_BITS + low, n), f"`_{tag}`.{name}")

    def bins(name: str) -> tuple[str, str, str]:
        measure, selection = name.split("_hist_")
        few = lambda p: _cut(word(f"{measure}_{selection}{p // _BINS_A_WORD}"), p % _BINS_A_WORD * _BIN_BITS, _BIN_BITS)
        dense = either(f"array({', '.join(few(p) for p in range(H.BINS))})", f"transform(slice(_{measure}, 1, {H.BINS}), b -> b.`{selection}`)")
        return dense, *[either(few(p), f"_{measure}[{p}].`{selection}`") for p in (_BELOW, _ABOVE)]

    stats = [f"{statistic(s, place, tag)} AS `{s}_{tag}`" for place, tag in enumerate(groups) for s in FQ.STATS]
    return counted.selectExpr(*others, *stats, f"{H.bundle(bins)} AS raw_qual_hists")


def _cut(number: str, low: int, n: int) -> str:
    return f"(shiftright({number}, {low}) & {(1 << n) - 1}L)"


def _parts(mark: str, bits: int) -> dict[str, str]:
    """SQL of the parts of a mark; ``n`` is how often it occurs."""
    parts = {"n": f"shiftright({mark}, {bits})", "cell": _cut(mark, _CELL, bits - _CELL)}
    return parts | {p: _cut(mark, *place) + (" = 1L" if p in ("adj", "alt") else "") for p, place in _PARTS.items()}


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


def _counted_lists(variants: DataFrame, others: list[str], bits: int, groups: dict[str, str]) -> DataFrame:
    """``_n`` entries, and their words in ``_w``; of more entries than words hold, ``_tag`` for each group and ``_gq, _dp, _ab``."""
    parts = f"transform(coalesce(_marks, array()), m -> {_struct(_parts('m', bits))})"
    opened = variants.selectExpr(*others, f"{parts} AS _parts", f"aggregate(coalesce(_marks, array()), 0L, (a, m) -> a + shiftright(m, {bits})) AS _n")
    prepared = f"transform(transform(_parts, e -> {_struct(_counts('e.'))}), e -> {_struct(_shares('e.', groups))})"
    added = {w: f"a.{w} + {share}" for w, share in _word_shares("e.", groups).items()}
    words = f"aggregate({prepared}, {_struct(dict.fromkeys(added, '0L'))}, (a, e) -> {_struct(added)})"
    short = f"_n <= {_WORD_ENTRIES}"
    summed = [f"if({short}, NULL, {_sums(condition, tag)}) AS `_{tag}`" for tag, condition in groups.items()]
    summed += [f"if({short}, NULL, {_bins(m)}) AS _{m}" for m in MEASURES]
    return opened.selectExpr(*others, "_n", f"if({short}, {words}, NULL) AS _w", *summed)


def _counted_columns(variants: DataFrame, others: list[str], bits: int, groups: dict[str, str], n: int) -> DataFrame:
    """The words as columns ``_w_``, from lists of ``n`` marks."""

    def each(frame: DataFrame, kept: list[str], made) -> DataFrame:
        columns = {f"_{i}_{name}": value for i in range(n) for name, value in made(i).items()}
        return frame.selectExpr(*others, *kept, *[f"{value} AS {name}" for name, value in columns.items()])

    marks = variants.selectExpr(*others, *[f"coalesce(get(_marks, {i}), 0L) AS _m{i}" for i in range(n)])
    opened = each(marks, [], lambda i: _parts(f"_m{i}", bits))
    counted = each(opened, [], lambda i: _counts(f"_{i}_"))
    shared = each(counted, [], lambda i: _shares(f"_{i}_", groups))
    words = [_word_shares(f"_{i}_", groups) for i in range(n)]
    return shared.selectExpr(*others, *[f"{' + '.join(w[name] for w in words)} AS _w_{name}" for name in words[0]])


def _added(condition: str, value: str) -> str:
    return value if condition == "true" else f"if({condition}, {value}, 0L)"


def _of_group(tag: str, condition: str) -> str:
    """Whether a mark counts for a group: all but the raw one take high quality alone."""
    return "true" if tag == "raw" else "e.adj" if condition == "true" else f"e.adj AND {condition}"


def _counts(e: str) -> dict[str, str]:
    """SQL of what groups and bins take of a mark. ``e`` is what stands before the names of its parts."""
    counts = f"{e}n * ({e}AC + shiftleft({e}AN, 7) + shiftleft({e}nhomalt, 14))"
    return {p: f"{e}{p}" for p in ("n", "cell", "adj", "alt", *MEASURES)} | {"counts": counts}


def _shares(e: str, groups: dict[str, str]) -> dict[str, str]:
    """SQL of what a mark adds to the words of the groups, and to those of a measure that it is selected for."""
    shares = {"alt": f"{e}alt", "adj": f"{e}adj", "both": f"{e}alt AND {e}adj"}
    for m in MEASURES:
        unit = f"shiftleft({e}n, cast({e}{m} % {_BINS_A_WORD} AS int) * {_BIN_BITS})"
        shares |= {f"{m}{k}": f"if({e}{m} div {_BINS_A_WORD} = {k}, {unit}, 0L)" for k in range(_WORDS)}
    tags = list(groups.items())
    for w in range(-(-len(tags) // _GROUPS_A_WORD)):
        own = tags[w * _GROUPS_A_WORD : (w + 1) * _GROUPS_A_WORD]
        added = [f"shiftleft({_added(_of_group(*g).replace('e.', e), f'{e}counts')}, {i * _GROUP_BITS})" for i, g in enumerate(own)]
        shares[f"g{w}"] = " + ".join(added)
    return shares


def _word_shares(e: str, groups: dict[str, str]) -> dict[str, str]:
    """Word -> SQL of what a mark adds to it."""
    flag = {"all": "true", "alt": f"{e}alt", "all_adj": f"{e}adj", "alt_adj": f"{e}both"}
    words = {
        f"{m}_{s}{k}": _added(flag[s], f"{e}{m}{k}")
        for m in MEASURES for s in SELECTIONS if f"{m}_hist_{s}" in H.histogram_names() for k in range(_WORDS)
    }
    return words | {f"g{w}": f"{e}g{w}" for w in range(-(-len(groups) // _GROUPS_A_WORD))}


def _bins(measure: str) -> str:
    """SQL of a list of counts by place of the bin."""
    zero = ", ".join(f"'{s}', 0L" for s in SELECTIONS)
    added = ", ".join(f"'{s}', a.{s} + {_added(c, 'e.n')}" for s, c in SELECTIONS.items())
    return f"transform(sequence(0, {_BELOW}), b -> aggregate(filter(_parts, e -> e.{measure} = b), named_struct({zero}), (a, e) -> named_struct({added})))"


def _sums(condition: str, tag: str) -> str:
    """SQL of a group's counts from the parts of a variant's marks."""
    zero = ", ".join(f"'{s}', 0L" for s in COUNTS)
    added = ", ".join(f"'{s}', a.{s} + e.n * e.{s}" for s in COUNTS)
    chosen = _of_group(tag, condition)
    own = "_parts" if chosen == "true" else f"filter(_parts, e -> {chosen})"
    return f"aggregate({own}, named_struct({zero}), (a, e) -> named_struct({added}))"
