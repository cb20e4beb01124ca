"""Multi-sample VCF text as sites, entries and samples."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.functions.basics import computed_once, let
from locusmill.functions.genotypes import parse_call
from locusmill.operators.cohort import Cohort
from locusmill.operators.lookups import broadcast_if_bounded, within_intervals
from locusmill.sources.text import header_lines
from locusmill.vocabulary import CONTIG_LENGTHS

FIXED_COLUMNS = 9
ENTRY_FIELDS = ("GT", "AD", "DP", "GQ", "PL")
# INFO types and the Spark types they become.
INFO_TYPES = {"Integer": "int", "Float": "double", "String": "string", "Character": "string", "Flag": "boolean"}


def _present(text: Column) -> Column:
    return F.when((text != ".") & (text != ""), text)


def _listed(text: Column, element: str) -> Column:
    """Comma-separated values; ``.`` is NULL, as the whole value or inside the list."""
    # made NULL before the cast, as a cast that fails costs far more than one of NULL
    values = F.transform(F.split(_present(text), ","), lambda x: F.nullif(x, F.lit(".")))
    return values if element == "string" else values.try_cast(f"array<{element}>")


def _number(text: Column) -> Column:
    return F.nullif(text, F.lit(".")).try_cast("int")


PARSERS = {"GT": parse_call, "AD": lambda t: _listed(t, "int"), "DP": _number, "GQ": _number, "PL": lambda t: _listed(t, "int")}


def read_header(spark: SparkSession, path: str, block_gzip: bool = False) -> DataFrame:
    """Header lines of all files: ``value, path, line``, the lines of a file numbered from 0.

    One task a file reads up to the first data line, so no data is read and files whose headers
    differ are all seen.
    """
    files = spark.read.format("binaryFile").load(path).select("path").where("length > 0")
    return files.repartition("path").mapInArrow(header_lines(block_gzip), "value string, path string, line int")


def info_types(lines: DataFrame) -> dict[str, str]:
    """INFO field -> Spark type, from the header declarations of all files.

    The driver gets one row for each distinct declaration. Files that declare a field differently
    are refused.
    """
    declared = lines.where(F.startswith("value", F.lit("##INFO="))).select("value").distinct()
    types = {}
    for row in declared.orderBy("value").collect():
        name, number, kind = (re.search(rf"[<,]{k}=([^,>]+)", row.value) for k in ("ID", "Number", "Type"))
        spark_type = INFO_TYPES[kind[1]]
        found = spark_type if number[1] in ("0", "1") else f"array<{spark_type}>"
        if types.setdefault(name[1], found) != found:
            raise ValueError(f"files declare INFO field {name[1]} as {types[name[1]]} and as {found}")
    return types


def info_struct(info: Column, types: dict[str, str]) -> Column:
    """Typed struct of the named INFO fields. A flag is true where its key stands."""
    pairs = F.transform(
        F.split(info, ";"),
        lambda kv: F.struct(
            F.substring_index(kv, "=", 1).alias("key"),
            F.when(F.contains(kv, F.lit("=")), F.substring(kv, F.locate("=", kv) + 1, F.length(kv))).alias("text"),
        ),
    )
    # the first of equal keys counts
    first = let(pairs, lambda all_: F.filter(all_, lambda p, i: F.array_position(all_["key"], p["key"]) == i + 1))

    def fields(known: Column) -> Column:
        def field(name: str, kind: str) -> Column:
            if kind == "boolean":
                return F.coalesce(F.map_contains_key(known, name), F.lit(False))
            if kind.startswith("array<"):
                return _listed(known[name], kind[len("array<") : -1])
            return _present(known[name]).try_cast(kind)

        return F.struct(*[field(n, t).alias(n) for n, t in types.items()])

    return let(F.map_from_entries(first), fields)


def check_build(build: str) -> None:
    if build not in CONTIG_LENGTHS:
        raise ValueError(f"unknown genome build {build}; known are {', '.join(CONTIG_LENGTHS)}")


def sequence_dictionary(lines: DataFrame) -> DataFrame:
    """``contig, length`` of the sequences named by lines of a ``.dict``, a ``.fai`` or a VCF header.

    Other lines are skipped. A sequence that is named again with the same length counts once;
    evaluating the result fails where lengths differ.
    """
    forms = (
        (r"^@SQ\t(?:.*\t)?SN:([^\t]+)", r"\tLN:(\d+)"),
        (r"^##contig=.*[<,]ID=([^,>]+)", r"^##contig=.*[<,]length=(\d+)"),
        (r"^([^\t#@]+)\t\d+\t\d+\t\d+\t\d+$", r"^[^\t#@]+\t(\d+)\t\d+\t\d+\t\d+$"),
    )
    first = lambda k: F.coalesce(*[F.nullif(F.regexp_extract("value", f[k], 1), F.lit("")) for f in forms])
    named = lines.select(first(0).alias("contig"), first(1).try_cast("int").alias("length")).where("contig IS NOT NULL")
    clash = F.raise_error(F.concat(F.lit("sequence with several lengths: "), F.col("contig")))
    return named.groupBy("contig").agg(F.min("length").alias("least"), F.max("length").alias("length")).select(
        "contig", F.when(F.col("least").eqNullSafe(F.col("length")), F.col("length")).otherwise(clash).alias("length")
    )


def build_dictionary(spark: SparkSession, build: str) -> DataFrame:
    """The chromosomes of a build, for call sets that come without a dictionary."""
    check_build(build)
    return spark.createDataFrame(list(CONTIG_LENGTHS[build].items()), "contig string, length int")


def contig_names(dictionary: DataFrame) -> DataFrame:
    """``name, contig, length``: what call sets may call each sequence of the dictionary.

    A sequence has its own name, and the one without ``chr`` if it has that, or else with it. Where
    such a name is another sequence's own one, it means that other one.
    """
    contig = F.col("contig")
    other = F.when(F.contains(contig, F.lit("chr")), F.replace(contig, F.lit("chr"), F.lit(""))).otherwise(F.concat(F.lit("chr"), contig))
    names = dictionary.select(
        contig, "length", F.explode(F.array(F.struct(contig.alias("name"), F.lit(0).alias("rank")), F.struct(other.alias("name"), F.lit(1).alias("rank")))).alias("n")
    )
    chosen = F.min_by(F.struct("contig", "length"), F.struct("n.rank", "contig")).alias("found")
    return names.groupBy(F.col("n.name").alias("name")).agg(chosen).select("name", "found.contig", "found.length")


def recode_contigs(rows: DataFrame, names: DataFrame, valid: str | None = None) -> DataFrame:
    """Rows with ``contig`` as the dictionary spells it; names that it lacks stay.

    With ``valid``, a column of that name says whether the row's ``position`` lies on a sequence of
    the dictionary. A sequence without a length has no end. The names are sent to all tasks if
    they measure as few, and joined otherwise.
    """
    known = names.select(F.col("name").alias("_name"), F.col("contig").alias("_contig"), F.col("length").alias("_length"))
    joined = rows.join(broadcast_if_bounded(known), F.col("contig") == F.col("_name"), "left")
    if valid is not None:
        inside = (F.col("position") >= 1) & (F.col("_length").isNull() | (F.col("position") <= F.col("_length")))
        joined = joined.withColumn(valid, F.coalesce(F.col("_contig").isNotNull() & inside, F.lit(False)))
    return joined.withColumn("contig", F.coalesce("_contig", "contig")).drop("_name", "_contig", "_length")


def parse_records(lines: DataFrame, names: DataFrame | None = None, skip_invalid_loci: bool = False) -> DataFrame:
    """One row per data line with its columns still as text, the genotypes as one string.

    ``site_id`` is the line's file, hashed, and its place there (``path`` and ``line`` of
    :func:`locusmill.sources.text.read_lines`), so every reading gives a line the same id. Lines
    without a place have two hashes of their text instead; of these, equal lines of one path share
    an id. ``names`` (see :func:`contig_names`) recodes the contigs; with ``skip_invalid_loci``,
    lines whose locus lies on none of them go.
    """
    if skip_invalid_loci and names is None:
        raise ValueError("loci can be checked only against the names of contigs")
    data = lines.where(~F.startswith("value", F.lit("#")) & (F.col("value") != ""))
    path = ["path"] if "path" in lines.columns else []
    if path and "line" in lines.columns:
        site_id = F.concat_ws("-", F.hex(F.xxhash64("path")), "line")
    else:
        site_id = F.concat_ws("-", F.hex(F.xxhash64("value", *path)), F.hex(F.xxhash64(F.lit("second"), "value", *path)))
    named = data.select(site_id.alias("site_id"), F.split("value", "\t", FIXED_COLUMNS + 1).alias("c"))
    # filters on the columns below would otherwise each split the line again
    split = computed_once(named, "c")
    column = lambda i: F.get("c", F.lit(i))
    records = split.select(
        "site_id",
        column(0).alias("contig"),
        column(1).try_cast("int").alias("position"),
        _present(column(2)).alias("rsid"),
        F.concat(F.array(column(3)), F.coalesce(F.split(_present(column(4)), ","), F.array())).alias("alleles"),
        _present(column(5)).try_cast("double").alias("qual"),
        F.when(column(6) == "PASS", F.array().cast("array<string>"))
        .otherwise(F.array_sort(F.array_distinct(F.split(_present(column(6)), ";"))))
        .alias("filters"),
        column(7).alias("info_text"),
        column(8).alias("format_text"),
        column(FIXED_COLUMNS).alias("calls_text"),
    )
    if names is None:
        return records
    recoded = recode_contigs(records, names, "_valid" if skip_invalid_loci else None)
    return recoded.where("_valid").drop("_valid") if skip_invalid_loci else recoded


def malformed_lines(lines: DataFrame) -> DataFrame:
    """``value, reason`` of data lines that lack columns or whose position is no number."""
    data = lines.where(~F.startswith("value", F.lit("#")) & (F.col("value") != ""))
    c = F.split("value", "\t", FIXED_COLUMNS + 1)
    reason = F.when(F.size(c) < FIXED_COLUMNS - 1, "columns").when(F.get(c, F.lit(1)).try_cast("int").isNull(), "position")
    return data.select("value", reason.alias("reason")).where("reason IS NOT NULL")


def site_rows(records: DataFrame, types: dict[str, str], others: Sequence[Column] = ()) -> DataFrame:
    """Row fields only; the genotype columns are not projected, but what ``others`` make of them."""
    info = info_struct(F.col("info_text"), types) if types else F.struct(F.col("info_text").alias("text"))
    return records.select(
        "site_id", "contig", "position", "rsid", "alleles", "qual", "filters", info.alias("info"), *others
    )


def entry_rows(
    records: DataFrame, fields: tuple[str, ...] = ENTRY_FIELDS, samples: list[int] | None = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per site and sample number. Field places are looked up once per line.

    ``samples`` names the numbers to read; the others are dropped before a row is made of them.
    ``carry`` names columns of the records that entries take along, which saves joining the sites.
    """
    names = F.split("format_text", ":")
    places = [(F.array_position(names, name) - 1).cast("int").alias(f"_{name}") for name in fields]
    calls, kept = F.split("calls_text", "\t"), ["site_id", "alleles", *carry]
    if samples is None:
        numbered = records.select(*kept, *places, F.posexplode(calls).alias("sample", "call"))
    else:
        wanted = F.array(*[F.lit(i) for i in samples]).cast("array<int>")
        chosen = let(calls, lambda c: F.transform(wanted, lambda i: F.struct(i.alias("sample"), F.get(c, i).alias("call"))))
        numbered = records.select(*kept, *places, F.explode(chosen).alias("e")).select(
            *kept, *[f"_{name}" for name in fields], "e.sample", "e.call"
        )
    parts = numbered.withColumn("parts", F.split("call", ":"))

    def text(name: str) -> Column:
        return F.get("parts", F.col(f"_{name}"))

    # a field that the line's format lacks has place -1, for which get gives NULL
    return parts.select(*kept, "sample", *[PARSERS[f](text(f)).alias(f) for f in fields])


def wide_rows(records: DataFrame, types: dict[str, str], samples: list[int]) -> DataFrame:
    """Row fields, and the fields of each numbered sample's entry in columns of their own: ``GT_0, AD_0`` and so on.

    The same values as of :func:`entry_rows`, without likelihoods, made in the line. Each step reads
    columns that the one before made, more than once, so Spark does not make them again.
    """
    fields = [f for f in ENTRY_FIELDS if f != "PL"]
    names = F.split("format_text", ":")
    line = {f"_{f}": (F.array_position(names, f) - 1).cast("int") for f in fields} | {"_calls": F.split("calls_text", "\t")}
    rows = site_rows(records, types, [c.alias(name) for name, c in line.items()])
    parts = {f"_parts_{k}": F.split(F.get("_calls", F.lit(i)), ":") for k, i in enumerate(samples)}
    entries = {f"{f}_{k}": PARSERS[f](F.get(f"_parts_{k}", F.col(f"_{f}"))) for k in range(len(samples)) for f in fields}
    return rows.withColumns(parts).withColumns(entries).drop(*line, *parts)


def sample_rows(header: DataFrame) -> DataFrame:
    """``sample`` number and id ``s`` from the ``#CHROM`` lines.

    All files of one call set must name the same samples in the same order; evaluating the result
    fails where they don't.
    """
    headers = header.where(F.startswith("value", F.lit("#CHROM"))).select("value").distinct()
    names = headers.select(F.split("value", "\t").alias("c")).select(
        F.slice("c", FIXED_COLUMNS + 1, F.greatest(F.size("c") - FIXED_COLUMNS, F.lit(0))).alias("names")
    )
    listed = names.select(F.posexplode("names").alias("sample", "s"), F.size("names").alias("n")).distinct()
    # two ids for one number, or two numbers of samples, mean that the headers differ
    return listed.groupBy("sample").agg(
        F.when(F.count("s") == 1, F.min("s"))
        .otherwise(F.raise_error(F.lit("files of one call set name different samples")))
        .alias("s")
    )


def _names(lines: DataFrame, build: str | None, dictionary: DataFrame | None) -> DataFrame | None:
    if dictionary is None:
        return None if build is None else contig_names(build_dictionary(lines.sparkSession, build))
    return contig_names(dictionary)


def requested_numbers(samples: DataFrame, requested: DataFrame) -> list[int]:
    """Numbers of the requested samples in the call set's lines, in order.

    The driver gets one number for each requested sample that the call set has.
    """
    found = samples.join(broadcast_if_bounded(requested.select("s").distinct()), "s", "left_semi")
    return sorted(r.sample for r in found.select("sample").collect())


def read_cohort(
    lines: DataFrame,
    header: DataFrame | None = None,
    build: str | None = None,
    types: dict[str, str] | None = None,
    skip_invalid_loci: bool = False,
    fields: tuple[str, ...] = ENTRY_FIELDS,
    dictionary: DataFrame | None = None,
    intervals: DataFrame | None = None,
    requested: DataFrame | None = None,
    carry: tuple[str, ...] = (),
    wide_up_to: int = 0,
) -> Cohort:
    """Sites, entries and samples of VCF lines.

    ``header`` (see :func:`read_header`) saves a pass over all lines for sample names and INFO
    types; ``types`` names the INFO fields to read. Contigs are recoded to the names of
    ``dictionary`` (see :func:`sequence_dictionary`), or of the chromosomes of ``build``.

    ``intervals`` and ``requested`` (samples, by ``s``) filter lines before any genotype is made a
    row: a line outside of the intervals goes whole, of the others only the requested samples'
    columns are read, and sites stay where one of these carries an alternate. ``carry`` is what
    entries take along from the sites. Of at most ``wide_up_to`` samples, the cohort also has its
    sites with their entries beside them, for which lines are read once and nothing is shuffled.
    """
    header = lines if header is None else header
    records = parse_records(lines, _names(lines, build, dictionary), skip_invalid_loci)
    if intervals is not None:
        records = within_intervals(records, intervals)
    samples, numbers = sample_rows(header), None
    if requested is not None:
        numbers = requested_numbers(samples, requested)
        samples = samples.where(F.col("sample").isin(numbers))
        records = records.where(carried(numbers))
    types = info_types(header) if types is None else types
    entries = entry_rows(records, fields, numbers, carry).join(broadcast_if_bounded(samples), "sample").drop("sample")
    found = sorted((r.sample, r.s) for r in samples.limit(wide_up_to + 1).collect()) if wide_up_to else []
    if not 0 < len(found) <= wide_up_to:
        return Cohort(site_rows(records, types), entries, samples.select("s"))
    wide = wide_rows(records, types, [i for i, _ in found])
    return Cohort(site_rows(records, types), entries, samples.select("s"), wide, [s for _, s in found])


def carried(samples: list[int]) -> Column:
    """Whether one of the numbered samples of a line has an alternate in its call.

    Reads each genotype's text, in the line: the call is its part at the place that the line's
    format gives. A call without any missing allele and with a number other than 0 counts.
    """
    place = F.array_position(F.split("format_text", ":"), "GT").cast("int")
    wanted = F.array(*[F.lit(i) for i in samples]).cast("array<int>")
    call = lambda text: F.try_element_at(F.split(text, ":"), place)
    carries = let(
        F.split("calls_text", "\t"),
        lambda c: F.exists(wanted, lambda i: F.coalesce(call(F.get(c, i)).rlike(r"^(0*[1-9]\d*([/|]\d+)?|\d+[/|]0*[1-9]\d*)$"), F.lit(False))),
    )
    return F.when(place > 0, carries).otherwise(F.lit(False))


def read_sites(
    lines: DataFrame,
    header: DataFrame | None = None,
    build: str | None = None,
    types: dict[str, str] | None = None,
    skip_invalid_loci: bool = False,
    dictionary: DataFrame | None = None,
) -> DataFrame:
    """Sites alone: genotype text stays one string, which is not read."""
    header = lines if header is None else header
    types = info_types(header) if types is None else types
    return site_rows(parse_records(lines, _names(lines, build, dictionary), skip_invalid_loci), types)


def release_dates(header: DataFrame) -> DataFrame:
    """``path, release_date`` for every file of :func:`read_header`; NULL where none is stated.

    Only lines above the first data line count, and of several dates in a file the first.
    """
    stated = F.when(F.startswith("value", F.lit("##fileDate=")), F.trim(F.substring_index("value", "=", -1)))
    return header.groupBy("path").agg(F.min_by(stated, F.when(stated.isNotNull(), F.col("line"))).alias("release_date"))
