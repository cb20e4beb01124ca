"""Call statistics per variant and sample group."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusmill.functions import genotypes as G
from locusmill.operators.lookups import broadcast_if_bounded
from locusmill.vocabulary import LABEL_ORDER, POPULATIONS, PROBAND_LABEL, QUALITY_GROUPS, SEX_LABELS

STATS = ["AC", "AN", "AF", "nhomalt"]


def call_counts(entries: DataFrame, others: list[Column]) -> DataFrame:
    """Per entry: copies of the alternate, ploidy and whether it is homozygous, beside ``others``."""
    gt, alt = F.col("GT"), F.lit(1)
    return entries.select(
        *others,
        G.allele_count(gt, alt).cast("long").alias("AC"),
        G.ploidy(gt).cast("long").alias("AN"),
        ((gt["a0"] == alt) & (gt["a1"] == alt)).cast("long").alias("nhomalt"),
    )


def call_stats(entries: DataFrame, keys: list[str]) -> DataFrame:
    """``AC, AN, AF, nhomalt`` of a bi-allelic variant over all its entries."""
    counted = call_counts(entries, [F.col(k) for k in keys])
    sums = counted.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("AC", "AN", "nhomalt")])
    return sums.select(*keys, "AC", "AN", allele_frequency(F.col("AC"), F.col("AN")).alias("AF"), "nhomalt")


def allele_frequency(ac: Column, an: Column) -> Column:
    """NULL where nothing was called."""
    return F.try_divide(ac, an)


def group_counter(samples: DataFrame, field: str = "pop") -> DataFrame:
    """Distinct non-null values of a sample field with their counts."""
    return samples.where(F.col(field).isNotNull()).groupBy(field).agg(F.count(F.lit(1)).alias("n"))


def observed_values(samples: DataFrame, field: str = "pop") -> list[str]:
    """The distinct values as a sorted list, for columns that are named after them.

    The list is as long as the columns that it names. :func:`frequencies_by_group` needs none.
    """
    return sorted(row[0] for row in samples.where(F.col(field).isNotNull()).select(field).distinct().collect())


def group_conditions(pops: list[str]) -> dict[str, Column]:
    """Group tag -> entry condition, in the order of the frequency array."""
    adj = F.col("adj")
    groups = {"adj": adj, "raw": F.lit(True)}
    groups |= {f"adj_{pop}": adj & (F.col("pop") == pop) for pop in pops}
    groups[f"adj_{PROBAND_LABEL}"] = adj & (F.col("proband") == "Yes")
    groups |= {f"adj_{label}": adj & (F.col("sex") == code) for code, label in SEX_LABELS.items()}
    return groups


def frequency_groups(pops: list[str]) -> list[dict[str, str]]:
    """What each place of the frequency array stands for."""
    meta = [{"group": "adj"}, {"group": "raw"}]
    meta += [{"pop": pop, "group": "adj"} for pop in pops]
    meta.append({"proband": PROBAND_LABEL, "group": "adj"})
    meta += [{"sex": label, "group": "adj"} for label in SEX_LABELS.values()]
    return meta


def label_combinations(groups: dict[str, list[str]]) -> list[str]:
    """All labels of crossed groupings, outermost grouping first."""
    ordered = sorted(groups, key=LABEL_ORDER.index)
    return ["_".join(labels) for labels in product(*(groups[name] for name in ordered))]


def frequency_index(meta: list[dict[str, str]], pops: list[str] = POPULATIONS) -> dict[str, int]:
    """Label -> place in the frequency array, for the labels that name exactly one group."""
    labels = label_combinations({"group": QUALITY_GROUPS})
    for name, values in (("pop", pops), ("proband", [PROBAND_LABEL]), ("sex", list(SEX_LABELS.values()))):
        labels += label_combinations({"group": QUALITY_GROUPS, name: values})
    places = {frozenset(entry.values()): place for place, entry in enumerate(meta)}
    found = {label: places.get(frozenset(label.split("_"))) for label in labels}
    return {label: place for label, place in found.items() if place is not None}


def frequencies_wide(entries: DataFrame, keys: list[str], pops: list[str] = POPULATIONS) -> DataFrame:
    """``AC_/AN_/AF_/nhomalt_`` columns of every group, from one pass and one shuffle.

    Needs ``GT, adj, pop, proband, sex`` on the entries. Partial sums leave each map task as one
    row per variant, however many samples it has.
    """
    tags = list(group_conditions(pops))
    members = [c.alias(f"in_{i}") for i, c in enumerate(group_conditions(pops).values())]
    counted = call_counts(entries, [*[F.col(k) for k in keys], *members])
    sums = counted.groupBy(*keys).agg(
        *[
            F.expr(f"coalesce(sum(CASE WHEN in_{i} THEN {stat} END), 0L) AS {stat}_{i}")
            for i in range(len(tags))
            for stat in ("AC", "AN", "nhomalt")
        ]
    )
    values = {"AC": "AC_{i}", "AN": "AN_{i}", "AF": "try_divide(AC_{i}, AN_{i})", "nhomalt": "nhomalt_{i}"}
    return sums.selectExpr(
        *keys,
        *[f"{values[stat].format(i=i)} AS `{stat}_{tag}`" for i, tag in enumerate(tags) for stat in STATS],
    )


def frequency_array(wide: DataFrame, keys: list[str], pops: list[str]) -> DataFrame:
    """The groups as one ordered ``freq`` array of structs."""
    structs = [
        F.struct(F.lit(tag).alias("tag"), *[F.col(f"`{stat}_{tag}`").alias(stat) for stat in STATS])
        for tag in group_conditions(pops)
    ]
    return wide.select(*keys, F.array(*structs).alias("freq"))


def frequencies_long(entries: DataFrame, keys: list[str], pops: list[str]) -> DataFrame:
    """One row per variant and group. Expanding happens after the aggregation."""
    freq = frequency_array(frequencies_wide(entries, keys, pops), keys, pops)
    return freq.select(*keys, F.posexplode("freq").alias("idx", "f")).select(*keys, "idx", "f.*")


def group_table(samples: DataFrame) -> DataFrame:
    """``idx, tag, group, pop, proband, sex``: what each place of the frequency array stands for.

    One row for each group that the samples have, in the order of the array; made from the data.
    """
    spark = samples.sparkSession
    first = spark.range(1).selectExpr(
        "0 AS part", "explode(array('adj', 'raw')) AS name", "NULL AS pop", "NULL AS proband", "NULL AS sex"
    ).selectExpr("part", "name", "name AS tag", "name AS group", "pop", "proband", "sex")
    pops = samples.where(F.col("pop").isNotNull()).select("pop").distinct().selectExpr(
        "1 AS part", "pop AS name", "concat('adj_', pop) AS tag", "'adj' AS group", "pop", "NULL AS proband", "NULL AS sex"
    )
    others = [("proband", PROBAND_LABEL), *[("sex", label) for label in SEX_LABELS.values()]]
    last = [
        spark.range(1).selectExpr(
            "2 AS part", f"'{i}' AS name", f"'adj_{label}' AS tag", "'adj' AS group", "NULL AS pop",
            f"{repr(label) if field == 'proband' else 'NULL'} AS proband", f"{repr(label) if field == 'sex' else 'NULL'} AS sex",
        )
        for i, (field, label) in enumerate(others)
    ]
    rows = first.union(pops)
    for frame in last:
        rows = rows.union(frame)
    # places number the groups, of which there are few beside the samples
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("part", "name")) - 1
    return rows.select(place.alias("idx"), "tag", "group", *[F.col(c).cast("string").alias(c) for c in ("pop", "proband", "sex")])


def _tags(adj: Column) -> Column:
    """Tags of the groups that a row with ``pop, proband, sex`` belongs to."""
    groups = [F.lit("adj"), F.concat(F.lit("adj_"), "pop"), F.when(F.col("proband") == "Yes", f"adj_{PROBAND_LABEL}")]
    groups += [F.when(F.col("sex") == code, f"adj_{label}") for code, label in SEX_LABELS.items()]
    present = F.filter(F.array(*groups), lambda t: t.isNotNull())
    return F.concat(F.array(F.lit("raw")), F.when(adj, present).otherwise(F.array().cast("array<string>")))


def frequencies_by_group(entries: DataFrame, keys: list[str], groups: DataFrame) -> DataFrame:
    """One row per variant and group, for any number of groups: ``idx, tag`` and the statistics.

    Entries are summed by variant, population, proband and sex in the tasks first; these sums are
    then dealt out to the groups that they belong to. ``groups`` is :func:`group_table`; groups in
    which a variant has no entry have zero counts.
    """
    counted = call_counts(entries, [*[F.col(k) for k in keys], F.col("adj"), F.col("pop"), F.col("proband"), F.col("sex")])
    stats = ["AC", "AN", "nhomalt"]
    sums = lambda frame, *by: frame.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in stats])
    cells = sums(counted, *keys, "adj", "pop", "proband", "sex")
    dealt = sums(cells.select(*keys, F.explode(_tags(F.col("adj"))).alias("tag"), *stats), *keys, "tag")
    by_tag = dealt.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("tag", F.struct(*stats)))).alias("by_tag"))
    # every variant has a row for each group; groups are numbered from 0, and looked up by number
    numbers = F.sequence(F.lit(0), F.lit(groups.count() - 1))
    found = by_tag.select(*keys, "by_tag", F.explode(numbers).alias("idx")).join(broadcast_if_bounded(groups.select("idx", "tag")), "idx").select(
        *keys, "idx", "tag", F.col("by_tag")[F.col("tag")].alias("f")
    )
    zero = lambda c: F.coalesce(F.col(f"f.{c}"), F.lit(0)).cast("long")
    return found.select(*keys, "idx", "tag", *[zero(c).alias(c) for c in stats]).select(
        *keys, "idx", "tag", "AC", "AN", allele_frequency(F.col("AC"), F.col("AN")).alias("AF"), "nhomalt"
    )


def group_sizes(samples: DataFrame, groups: DataFrame) -> DataFrame:
    """``groups`` with ``n_samples``, from one count of the samples by population, proband and sex."""
    cells = samples.groupBy("pop", "proband", "sex").agg(F.count(F.lit(1)).alias("n"))
    sizes = cells.select(F.explode(_tags(F.lit(True))).alias("tag"), "n").groupBy("tag").agg(F.sum("n").alias("n"))
    return groups.join(sizes, "tag", "left").select(*groups.columns, F.coalesce("n", F.lit(0)).alias("n_samples"))


def group_labels(spark: SparkSession, pops: list[str] = POPULATIONS) -> DataFrame:
    """``label, tag``: the labels of the fixed lists, and the group whose tag each one spells."""
    labels = label_combinations({"group": QUALITY_GROUPS})
    for name, values in (("pop", pops), ("proband", [PROBAND_LABEL]), ("sex", list(SEX_LABELS.values()))):
        labels += label_combinations({"group": QUALITY_GROUPS, name: values})
    return spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in labels])).alias("label")).withColumn("tag", F.col("label"))


def with_frequencies(sites: DataFrame, wide: DataFrame, keys: list[str], *others: str) -> DataFrame:
    """Attach frequencies; a site without any entry gets zero counts and no frequency. ``others``
    are columns of ``wide`` that are no counts."""
    counts = [c for c in wide.columns if c not in [*keys, *others] and not c.startswith("AF_")]
    return sites.join(wide, keys, "left").fillna(0, subset=counts)


def total_fields(source: str | None = None) -> list[str]:
    """The 20 top-level totals, as SQL: overall, raw, proband, male and female."""
    prefix = f"{source}." if source else ""
    names = {"": "adj", "_raw": "raw"}
    names |= {f"_{label}": f"adj_{label}" for label in (PROBAND_LABEL, *SEX_LABELS.values())}
    return [f"{prefix}{stat}_{tag} AS {stat}{suffix}" for suffix, tag in names.items() for stat in STATS]


def population_structs(fields: list[str], source: str | None = None, pops: list[str] = POPULATIONS) -> list[str]:
    """One struct per statistic, as SQL, with a field per population that the data has."""
    prefix = f"{source}." if source else ""
    present = [pop for pop in pops if f"AC_adj_{pop}" in fields]
    if not present:
        return []
    return [
        "named_struct(" + ", ".join(f"'{pop}', {prefix}{stat}_adj_{pop}" for pop in present) + f") AS {stat}_adj"
        for stat in STATS
    ]
