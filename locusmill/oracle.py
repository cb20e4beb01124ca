"""DuckDB SQL for the registered queries, written against the driver's tables."""

from __future__ import annotations

from locusmill import views as V
from locusmill.vocabulary import (
    AMINO_ACIDS,
    CONSEQUENCE_TERMS,
    CONSTRAINT_FIELDS,
    FILTERING_AF_FIELDS,
    FILTERING_AF_POPULATIONS,
    FREQUENCY_FIELDS,
    GOLD_STARS,
    NAME_ESCAPES,
    POPMAX_FIELDS,
    POPULATIONS,
    RELEASE_SUBPOPULATIONS,
    SITE_QUALITY_FIELDS,
)

ORACLE: dict[str, str] = {}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _nested(lists) -> str:
    return "[" + ", ".join(_list(v) for v in lists) + "]"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _contig(key: str) -> str:
    return (
        f"CASE {key} % 24 WHEN 22 THEN 'chrX' WHEN 23 THEN 'chrY' "
        f"ELSE concat('chr', CAST({key} % 24 + 1 AS VARCHAR)) END"
    )


SITE = f"""site AS (SELECT p_partkey AS site_id, {_contig('p_partkey')} AS contig, p_partkey * 10 + 1000 AS position,
  {_nested(V.KINDS)}[p_size % 6 + 1] AS alleles, p_size, p_retailprice, p_type,
  CASE WHEN p_size % 4 = 0 THEN ['LowQual', p_type] ELSE [] END AS filters FROM part)"""

# minimal representation of (position, ref, alt) in a table that has them
def _minimal(source: str, name: str) -> str:
    return f"""{name}_a AS (SELECT *, least(length(ref), length(alt)) AS shorter, alt = '*' OR alt LIKE '<%' AS fixed FROM {source}),
{name}_b AS (SELECT *, CASE WHEN fixed THEN 0 ELSE len(list_filter(range(1, shorter), lambda n: right(ref, n) = right(alt, n))) END AS tail FROM {name}_a),
{name}_c AS (SELECT *, CASE WHEN fixed THEN 0 ELSE len(list_filter(range(1, shorter - tail), lambda n: left(ref, n) = left(alt, n))) END AS head FROM {name}_b),
{name} AS (SELECT * REPLACE (position + head AS position, substr(ref, head + 1, length(ref) - head - tail) AS ref,
  substr(alt, head + 1, length(alt) - head - tail) AS alt) FROM {name}_c)"""


SPLIT_SITE = (
    SITE
    + """,
alternate AS (SELECT s.*, CAST(i AS BIGINT) AS a_index, len(alleles) > 2 AS was_split, alleles[1] AS ref, alleles[i + 1] AS alt
  FROM site s, unnest(range(1, len(alleles))) AS t(i) WHERE alleles[i + 1] <> '*'),
"""
    + _minimal("alternate", "variant")
)

ENTRY = """cell AS (SELECT l_partkey AS v, o_custkey AS s, CAST(floor(min(l_quantity)) AS BIGINT) AS q,
  CAST(floor(min(l_extendedprice)) AS BIGINT) AS ep, CAST(floor(min(l_quantity) * min(l_discount) * 5) AS BIGINT) AS alt1
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey, o_custkey),
drawn AS (SELECT site_id, alleles, s, q, ep, alt1, ep % len(alleles) AS hi, q % (ep % len(alleles) + 1) AS lo,
  v % 24 >= 22 AND s % 2 = 0 AS hap, q % 5 = 0 AS ph, ep % 11 <> 0 AS called FROM cell JOIN site ON v = site_id),
entry AS (SELECT site_id, alleles, s, q AS dp, ep % 100 AS gq, ph AND NOT hap AS phased,
  CASE WHEN called THEN CASE WHEN hap OR ph THEN hi ELSE lo END END AS a0,
  CASE WHEN called AND NOT hap THEN CASE WHEN ph THEN lo ELSE hi END END AS a1,
  CASE WHEN len(alleles) = 3 THEN [greatest(q - alt1, 0), alt1, ep % 7] ELSE [greatest(q - alt1, 0), alt1] END AS ad
  FROM drawn)"""

SPLIT_ENTRY = """coded AS (SELECT site_id, CAST(i AS BIGINT) AS a_index, s, dp, gq, phased,
  CAST(a0 = i AS BIGINT) AS d0, CAST(a1 = i AS BIGINT) AS d1, CAST(list_sum(ad) AS BIGINT) - ad[i + 1] AS ad_other, ad[i + 1] AS ad_alt
  FROM entry, unnest(range(1, len(alleles))) AS t(i) WHERE alleles[i + 1] <> '*'),
gt AS (SELECT * REPLACE (CASE WHEN phased OR d1 IS NULL THEN d0 ELSE least(d0, d1) END AS d0,
  CASE WHEN phased OR d1 IS NULL THEN d1 ELSE greatest(d0, d1) END AS d1) FROM coded),
called AS (SELECT *, d0 IS NOT NULL AND d1 IS NOT NULL AND d0 <> d1 AS het_call,
  gq >= 20 AND CASE WHEN d0 IS NULL THEN NULL ELSE dp >= 10 END AND
  CASE WHEN d0 IS NULL THEN NULL WHEN d1 IS NULL OR d0 = d1 THEN true ELSE ad_alt / dp >= 0.2 END AS adj,
  CASE WHEN d0 IS NOT NULL THEN d0 + coalesce(d1, 0) END AS n_alt,
  CASE WHEN d0 IS NOT NULL THEN CASE WHEN d1 IS NULL THEN 1 ELSE 2 END END AS ploidy,
  d0 = 1 AND d1 IS NOT NULL AND d1 = 1 AS hom FROM gt)"""

SAMPLE = f"""sample AS (SELECT c_custkey AS s, {_list(POPULATIONS)}[c_nationkey % 7 + 1] AS pop,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'Yes' ELSE 'No' END AS proband,
  CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS sex FROM customer)"""

FACT = ",\n".join([SITE, ENTRY, SPLIT_ENTRY, SAMPLE]) + ",\nfact AS (SELECT * FROM called LEFT JOIN sample USING (s))"

_GT_TEXT = "CASE WHEN {1} IS NULL THEN CAST({0} AS VARCHAR) ELSE concat(CAST({0} AS VARCHAR), CASE WHEN phased THEN '|' ELSE '/' END, CAST({1} AS VARCHAR)) END"
# concat skips nulls, so an uncalled genotype is caught first
def gt_text(a0: str, a1: str) -> str:
    return f"CASE WHEN {a0} IS NOT NULL THEN {_GT_TEXT.format(a0, a1)} END"


ORACLE["split_multiallelic"] = _with(SITE, ENTRY, SPLIT_ENTRY) + f"""
SELECT site_id, a_index, s, {gt_text('d0', 'd1')} AS gt, ad_other, ad_alt, dp, gq FROM gt"""

ORACLE["split_variants"] = _with(SPLIT_SITE) + """
SELECT site_id, a_index, was_split, contig, position, ref, alt, p_retailprice AS qual FROM variant"""


def _is_snv(r, a):
    return (f"(regexp_matches({r}, '^[ACGTNM]+$') AND regexp_matches({a}, '^[ACGTNM]+$') AND length({r}) = length({a}) "
            f"AND len(list_filter(range(1, length({r}) + 1), lambda n: substr({r}, n, 1) <> substr({a}, n, 1))) = 1)")


def _is_ins(r, a):
    return (f"(regexp_matches({r}, '^[ACGTNM]+$') AND regexp_matches({a}, '^[ACGTNM]+$') AND length({r}) < length({a}) "
            f"AND left({r}, 1) = left({a}, 1) AND ends_with({a}, substr({r}, 2)))")


_TYPE = f"CASE WHEN {_is_snv('ref', 'alt')} THEN 'snv' WHEN {_is_ins('ref', 'alt')} THEN 'ins' WHEN {_is_ins('alt', 'ref')} THEN 'del' ELSE 'complex' END"

# one row per site and alternate: a site is of a type when every named alternate is
ORACLE["allele_typing"] = _with(SPLIT_SITE, f"""judged AS (SELECT site_id, alleles, alleles[i + 1] <> '*' AS named,
  {_is_snv('alleles[1]', 'alleles[i + 1]')} AS snv,
  {_is_ins('alleles[1]', 'alleles[i + 1]')} OR {_is_ins('alleles[i + 1]', 'alleles[1]')} AS indel
  FROM site, unnest(range(1, len(alleles))) AS t(i)),
summary AS (SELECT site_id, count(*) FILTER (named) AS n, bool_or(NOT named) AS has_star,
  CASE WHEN coalesce(bool_and(snv) FILTER (named), true) THEN CASE WHEN count(*) FILTER (named) > 1 THEN 'multi-snv' ELSE 'snv' END
   WHEN bool_and(indel) FILTER (named) THEN CASE WHEN count(*) FILTER (named) > 1 THEN 'multi-indel' ELSE 'indel' END
   ELSE 'mixed' END AS variant_type FROM judged GROUP BY site_id)""") + f"""
SELECT v.site_id, a_index, array_to_string(alleles, ',') AS nonsplit_alleles, has_star, variant_type, n AS n_alt_alleles,
  {_TYPE} AS allele_type, variant_type = 'mixed' AS was_mixed FROM variant v JOIN summary USING (site_id)"""

PADDED = f"""padded AS (SELECT p_partkey AS site_id, p_partkey * 10 + 1000 AS position, concat(pre, kind[1], post) AS ref,
  CASE WHEN p_size % 13 = 0 THEN '*' WHEN p_size % 17 = 0 THEN '<DEL>' ELSE concat(pre, kind[len(kind)], post) END AS alt
  FROM (SELECT *, substr('GATTACA', 1, p_size % 7) AS pre, substr('CCGTA', 1, p_partkey % 5) AS post,
        {_nested(V.KINDS)}[p_size % 6 + 1] AS kind FROM part))"""

ORACLE["min_rep"] = _with(PADDED, "kept AS (SELECT *, ref AS old_ref FROM padded)", _minimal("kept", "small")) + """
SELECT site_id, old_ref, position, ref, alt FROM small"""

ORACLE["allele_predicates"] = _with(PADDED) + f"""
SELECT site_id, {_is_snv('ref', 'alt')} AS snv, {_is_ins('ref', 'alt')} AS insertion, {_is_ins('alt', 'ref')} AS deletion,
  {_is_ins('ref', 'alt')} OR {_is_ins('alt', 'ref')} AS indel, {_TYPE} AS allele_type FROM padded"""

ORACLE["adj_genotypes"] = _with(SITE, ENTRY, SPLIT_ENTRY) + """
SELECT site_id, a_index, s, adj, CASE WHEN d0 IS NOT NULL THEN d1 IS NULL END AS haploid,
  CASE WHEN d0 IS NOT NULL THEN het_call END AS het, CASE WHEN d0 IS NOT NULL THEN het_call END AS het_ref,
  CASE WHEN d0 IS NOT NULL THEN n_alt > 0 END AS non_ref FROM called"""

ORACLE["genotype_predicates"] = _with(SITE, ENTRY) + f"""
SELECT site_id, s, {gt_text('a0', 'a1')} AS gt, CASE WHEN a0 IS NOT NULL THEN coalesce(a0 <> a1, false) END AS het,
  CASE WHEN a0 IS NOT NULL THEN coalesce(a0 <> a1 AND (a0 = 0 OR a1 = 0), false) END AS het_ref,
  CASE WHEN a0 IS NOT NULL THEN a0 > 0 OR coalesce(a1, 0) > 0 END AS non_ref,
  CASE WHEN a0 IS NOT NULL THEN CASE WHEN a1 IS NULL THEN 1 ELSE 2 END END AS ploidy, true AS no_likelihoods FROM entry"""


def _stats(condition: str = "true", suffix: str = "", names=("AC", "AN", "AF", "nhomalt")) -> str:
    ac, an, af, hom = names
    f = f"FILTER (WHERE {condition})"
    return (
        f"CAST(coalesce(sum(n_alt) {f}, 0) AS BIGINT) AS {ac}{suffix}, "
        f"CAST(coalesce(sum(ploidy) {f}, 0) AS BIGINT) AS {an}{suffix}, "
        f"CAST(sum(n_alt) {f} AS DOUBLE) / nullif(sum(ploidy) {f}, 0) AS {af}{suffix}, "
        f"CAST(coalesce(count(*) FILTER (WHERE ({condition}) AND hom), 0) AS BIGINT) AS {hom}{suffix}"
    )


_SMALL = ("ac", "an", "af", "nhom")
ORACLE["likelihood_split"] = _with(SITE, ENTRY, """pair AS (SELECT site_id, s, gq, dp, CAST(i AS BIGINT) AS a_index, b * (b + 1) // 2 + a AS j, CAST(a = i AS INT) + CAST(b = i AS INT) AS copies
  FROM entry, unnest(range(1, len(alleles))) AS t(i), unnest(range(0, len(alleles))) AS u(b), unnest(range(0, b + 1)) AS w(a) WHERE alleles[i + 1] <> '*'),
least_of AS (SELECT site_id, a_index, s, gq, copies, min(CASE WHEN gq % 13 > 0 AND (gq + j) % 17 > 0 THEN (j * (gq % 9 + 1) + dp * (j + 1)) % 60 END) AS pl FROM pair GROUP BY ALL),
three AS (SELECT site_id, a_index, s, gq, min(pl) FILTER (WHERE copies = 0) AS pl0, min(pl) FILTER (WHERE copies = 1) AS pl1, min(pl) FILTER (WHERE copies = 2) AS pl2,
  list_sort(list(pl) FILTER (WHERE pl IS NOT NULL)) AS present FROM least_of GROUP BY ALL)""") + """
SELECT site_id, a_index, s, pl0, pl1, pl2, coalesce(present[2] - present[1], gq) AS gq FROM three"""
ORACLE["call_stats_raw"] = _with(SITE, ENTRY, SPLIT_ENTRY) + f"""
SELECT site_id, a_index, {_stats(names=_SMALL)} FROM called GROUP BY site_id, a_index"""

TAGS = [("adj", "adj"), ("raw", "true"), *[(f"adj_{p}", f"adj AND pop = '{p}'") for p in POPULATIONS],
        ("adj_proband", "adj AND proband = 'Yes'"), ("adj_male", "adj AND sex = 'M'"), ("adj_female", "adj AND sex = 'F'")]
ORACLE["call_stats_by_group"] = _with(FACT, "keys AS (SELECT DISTINCT site_id, a_index FROM fact)") + " UNION ALL ".join(
    f"SELECT site_id, a_index, {i} AS idx, '{tag}' AS tag, {_stats(cond, names=_SMALL)} FROM fact GROUP BY site_id, a_index"
    for i, (tag, cond) in enumerate(TAGS)
)

WIDE = ", ".join(_stats(cond, f"_{tag}") for tag, cond in TAGS)
COUNTED = _with(
    SPLIT_SITE, ENTRY, SPLIT_ENTRY, SAMPLE, "fact AS (SELECT * FROM called LEFT JOIN sample USING (s))",
    f"wide AS (SELECT site_id, a_index, {WIDE} FROM fact GROUP BY site_id, a_index)",
)


def _wide_column(stat: str, tag: str) -> str:
    return f"{stat}_{tag}" if stat == "AF" else f"coalesce({stat}_{tag}, 0)"


_STATS = ("AC", "AN", "AF", "nhomalt")
ORACLE["freq_wide"] = COUNTED + "SELECT site_id, a_index, contig, position, ref, alt, " + ", ".join(
    f"{_wide_column(st, tag)} AS {st}_{tag}" for tag, _ in TAGS for st in _STATS
) + " FROM variant LEFT JOIN wide USING (site_id, a_index)"

_TOTALS = {"": "adj", "_raw": "raw", "_proband": "adj_proband", "_male": "adj_male", "_female": "adj_female"}
ORACLE["freq_pop_structs"] = COUNTED + "SELECT site_id, a_index, " + ", ".join(
    [f"{_wide_column(st, tag)} AS {st}{suffix}" for suffix, tag in _TOTALS.items() for st in _STATS]
    + [f"{_wide_column(st, 'adj_' + p)} AS {st}_adj_{p}" for st in _STATS for p in POPULATIONS]
) + " FROM variant LEFT JOIN wide USING (site_id, a_index)"

ORACLE["group_counter"] = _with(SAMPLE) + "SELECT pop, count(*) AS n FROM sample WHERE pop IS NOT NULL GROUP BY pop"

ORACLE["freq_meta"] = _with(SAMPLE, """place AS (
  SELECT 0 AS idx, 'adj' AS "group", NULL AS pop, NULL AS proband, NULL AS sex UNION ALL SELECT 1, 'raw', NULL, NULL, NULL
  UNION ALL SELECT 1 + row_number() OVER (ORDER BY pop), 'adj', pop, NULL, NULL FROM (SELECT DISTINCT pop FROM sample WHERE pop IS NOT NULL)),
labelled AS (SELECT * FROM place UNION ALL SELECT (SELECT count(*) FROM place), 'adj', NULL, 'proband', NULL
  UNION ALL SELECT (SELECT count(*) FROM place) + 1, 'adj', NULL, NULL, 'male'
  UNION ALL SELECT (SELECT count(*) FROM place) + 2, 'adj', NULL, NULL, 'female')""") + """
SELECT idx, "group", l.pop, l.proband, l.sex, (SELECT count(*) FROM sample s WHERE (l.pop IS NULL OR s.pop = l.pop)
  AND (l.proband IS NULL OR s.proband = 'Yes') AND (l.sex IS NULL OR l.sex = CASE s.sex WHEN 'M' THEN 'male' ELSE 'female' END)) AS n_samples
FROM labelled l"""

ORACLE["freq_label_index"] = _with(FACT) + " UNION ALL ".join(
    f"SELECT '{tag}' AS label, {i} AS idx, CAST(coalesce(sum(n_alt) FILTER (WHERE {cond}), 0) AS BIGINT) AS total_ac FROM fact"
    for i, (tag, cond) in enumerate(TAGS)
)

# --- histograms
BINNED = """binned AS (
  SELECT site_id, a_index, 'gq' AS measure, CASE WHEN gq > 100 THEN 20 ELSE least(gq // 5, 19) END AS bin, n_alt > 0 AS alt, adj FROM called
  UNION ALL SELECT site_id, a_index, 'dp', CASE WHEN dp > 100 THEN 20 ELSE least(dp // 5, 19) END, n_alt > 0, adj FROM called
  UNION ALL SELECT site_id, a_index, 'ab', CAST(least(floor(CAST(ad_alt AS DOUBLE) / (ad_alt + ad_other) / 0.05), 19) AS BIGINT), true, adj
    FROM called WHERE het_call AND ad_alt + ad_other > 0),
hist AS (
  SELECT site_id, a_index, measure || '_hist_all' AS hist, bin, count(*) AS n FROM binned WHERE measure <> 'ab' GROUP BY ALL
  UNION ALL SELECT site_id, a_index, measure || '_hist_alt', bin, count(*) FROM binned WHERE alt GROUP BY ALL
  UNION ALL SELECT site_id, a_index, measure || '_hist_all_adj', bin, count(*) FROM binned WHERE measure <> 'ab' AND adj GROUP BY ALL
  UNION ALL SELECT site_id, a_index, measure || '_hist_alt_adj', bin, count(*) FROM binned WHERE alt AND adj GROUP BY ALL)"""

ORACLE["qual_histograms"] = _with(SITE, ENTRY, SPLIT_ENTRY, BINNED) + "SELECT * FROM hist"

_REGROUPED = {
    "allele_balance.alt_raw": "ab_hist_alt", "allele_balance.alt_adj": "ab_hist_alt_adj",
    **{f"{g}.{part}": f"{m}_hist_{h}" for g, m in (("genotype_depth", "dp"), ("genotype_quality", "gq"))
       for part, h in (("all_raw", "all"), ("alt_raw", "alt"), ("all_adj", "all_adj"), ("alt_adj", "alt_adj"))},
}
_NAMES = "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in _REGROUPED.items()) + ") AS names(label, hist)"
DENSE = f"""dense AS (SELECT k.site_id, k.a_index, label, bin_no, coalesce(h.n, 0) AS n
  FROM (SELECT DISTINCT site_id, a_index FROM called) k, {_NAMES}, unnest(range(-1, 21)) AS b(bin_no)
  LEFT JOIN hist h ON h.site_id = k.site_id AND h.a_index = k.a_index AND h.hist = names.hist AND h.bin = bin_no)"""
ORACLE["qual_hist_structs"] = _with(SITE, ENTRY, SPLIT_ENTRY, BINNED, DENSE) + """
SELECT site_id, a_index, label AS hist, string_agg(CAST(n AS VARCHAR), ',' ORDER BY bin_no) FILTER (bin_no BETWEEN 0 AND 19) AS bin_freq,
  CASE WHEN label LIKE 'allele%' THEN 0.15::DOUBLE ELSE 15.0::DOUBLE END AS fourth_edge,
  CAST(sum(n) FILTER (bin_no = -1) AS BIGINT) AS n_smaller, CAST(sum(n) FILTER (bin_no = 20) AS BIGINT) AS n_larger
FROM dense GROUP BY site_id, a_index, label"""

ORACLE["depth_histograms"] = _with(SITE, ENTRY) + """
SELECT site_id, 'gq_hist_all' AS hist, least(gq // 5, 19) AS bin, count(*) AS n FROM entry GROUP BY ALL
UNION ALL SELECT site_id, 'dp_hist_all', least(dp // 5, 19), count(*) FROM entry GROUP BY ALL"""

# --- samples
REQUESTED = "requested AS (SELECT c_custkey AS s FROM customer WHERE c_custkey % 10 = 0 UNION ALL SELECT -1 UNION ALL SELECT -2)"
ORACLE["sample_subset"] = _with(SITE, ENTRY, REQUESTED, """wanted AS (SELECT * FROM entry WHERE s IN (SELECT s FROM requested)),
carried AS (SELECT DISTINCT site_id FROM wanted WHERE a0 > 0 OR a1 > 0)""") + f"""
SELECT w.site_id, contig, position, s, {gt_text('a0', 'a1')} AS gt FROM wanted w JOIN site ON w.site_id = site.site_id
WHERE w.site_id IN (SELECT site_id FROM carried)"""
ORACLE["missing_samples"] = _with(REQUESTED) + "SELECT s FROM requested WHERE s NOT IN (SELECT c_custkey FROM customer)"
ORACLE["subset_report"] = _with(REQUESTED, "known AS (SELECT s IN (SELECT c_custkey FROM customer) AS k FROM requested)") + """
SELECT count(*) AS n_requested, count(*) FILTER (k) AS n_matched, count(*) FILTER (NOT k) AS n_missing FROM known"""
ORACLE["carried_sites"] = _with(SITE, ENTRY) + """
SELECT site_id, contig, position FROM site WHERE site_id IN (SELECT site_id FROM entry WHERE a0 > 0 OR a1 > 0)"""
ORACLE["sample_annotation"] = _with(SAMPLE) + """
SELECT s, CASE WHEN s % 11 <> 0 THEN pop END AS pop, CASE WHEN s % 11 <> 0 THEN proband END AS proband,
  CASE WHEN s % 11 <> 0 THEN sex END AS sex FROM sample"""

# --- identifiers
ID_FIELDS = """named AS (SELECT *, regexp_replace(contig, '^chr', '') AS chrom,
  CASE contig WHEN 'chrX' THEN 23 WHEN 'chrY' THEN 24 ELSE TRY_CAST(regexp_replace(contig, '^chr', '') AS BIGINT) END AS contig_number FROM variant),
identified AS (SELECT *, contig_number * 1000000000 + position AS xpos, chrom || '-' || position || '-' || ref || '-' || alt AS variant_id FROM named)"""
ORACLE["variant_ids"] = _with(SPLIT_SITE, ID_FIELDS) + """
SELECT site_id, a_index, ref, alt, position AS pos, chrom, contig_number, xpos, variant_id, left(variant_id, 6) AS short_id,
  CASE WHEN length(ref) > length(alt) THEN 'D' WHEN length(ref) < length(alt) THEN 'I' WHEN length(ref) > 1 THEN 'M' ELSE 'S' END AS variant_letter,
  position + length(ref) AS end_pos FROM identified"""
_SITE_IDS = "list_transform(alleles[2:], lambda a: contig || '-' || position || '-' || alleles[1] || '-' || a)"
ORACLE["site_variant_ids"] = _with(SITE) + f"""
SELECT site_id, array_to_string({_SITE_IDS}, ',') AS ids,
  array_to_string(list_transform({_SITE_IDS}, lambda x: left(x, 8)), ',') AS short_ids,
  CASE WHEN len(alleles) > 2 THEN array_to_string({_SITE_IDS}, ',') END AS original_alt_alleles FROM site"""
ORACLE["key_by_minimal"] = _with(SPLIT_SITE, f"ids AS (SELECT site_id, CASE WHEN len(alleles) > 2 THEN array_to_string({_SITE_IDS}, ',') END AS original_alt_alleles FROM site)") + """
SELECT v.site_id, a_index, v.position, ref, alt, original_alt_alleles FROM variant v JOIN ids USING (site_id)"""

# --- reference lookups
REFERENCE = """reference AS (SELECT contig, position, alleles[1] AS ref, alleles[2] AS alt, min('rs' || (site_id + copy * 1000000000)) AS rsid,
  min(site_id) % 40 AS cadd, min(p_size + copy) AS size, min(p_size) AS p_size FROM (SELECT *, unnest(CASE WHEN site_id % 9 = 1 THEN [0, 1] ELSE [0] END) AS copy FROM site WHERE site_id % 3 <> 0)
  GROUP BY ALL)"""
ORACLE["annotate_reference"] = _with(SPLIT_SITE, REFERENCE) + """
SELECT site_id, a_index, v.contig, v.position, v.ref, v.alt, rsid, r.size / 64 AS splice_ai,
  CASE WHEN r.p_size % 3 > 0 THEN r.p_size / 128 END AS primate_ai, CAST(cadd AS DOUBLE) AS cadd,
  CASE WHEN r.p_size % 2 > 0 THEN r.p_size / 256 END AS revel
FROM variant v LEFT JOIN reference r ON v.contig = r.contig AND v.position = r.position AND v.ref = r.ref AND v.alt = r.alt"""
COVERED = """target AS (SELECT contig AS c, position AS lo, position + 200 AS hi FROM site WHERE site_id % 50 = 0),
covered AS (SELECT * FROM site WHERE EXISTS (SELECT 1 FROM target WHERE c = contig AND position BETWEEN lo AND hi))"""
ORACLE["exome_filter"] = _with(SITE, COVERED) + "SELECT site_id, contig, position FROM covered"
ORACLE["exome_entries"] = _with(SITE, ENTRY, COVERED) + f"""
SELECT site_id, s, {gt_text('a0', 'a1')} AS gt FROM entry WHERE site_id IN (SELECT site_id FROM covered)"""
ORACLE["locus_range_filter"] = _with(SITE) + """
SELECT site_id, contig, position FROM site WHERE contig = 'chr2' AND position >= 1000 AND position < 6010"""

# --- transcripts
_TERMS = _list(CONSEQUENCE_TERMS)
_AA = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in AMINO_ACIDS.items()) + "}"


def _transcripts(source: str, omit: bool = True) -> str:
    """Long transcripts of ``source(rid, seed, size, flag)``, ranked per rid."""
    kept = "list_filter(terms, lambda t: t NOT IN ('upstream_gene_variant', 'downstream_gene_variant'))" if omit else "terms"
    return f"""t0 AS (SELECT rid, seed, size, flag, i, seed + i * 7 AS n, (seed + i * 7) % 300 + 1 AS start, 'T' || (seed * 10 + i) AS transcript_id
  FROM {source}, unnest(range(1, seed % 7 + 1)) AS t(i)),
t1 AS (SELECT *, CASE WHEN n % 8 = 0 THEN [{_TERMS}[(n + 22) % 39 + 1], 'new_term'] WHEN n % 8 < 3 THEN [{_TERMS}[(n + 11) % 39 + 1], {_TERMS}[n % 39 + 1]]
    ELSE [{_TERMS}[n % 39 + 1]] END AS terms,
  CASE WHEN n % 6 > 0 THEN substr('ACDEFGHIKLMNPQRSTVWYX*U', n % 23 + 1, 1) ELSE 'K/R' END AS amino_acids,
  CASE WHEN flag = 'P' THEN NULL WHEN n % 3 = 0 THEN 'lincRNA' ELSE 'protein_coding' END AS biotype,
  CASE WHEN n % 4 > 0 THEN n % 2 END AS canonical, CASE WHEN n % 5 > 0 THEN start * 3 END AS cdna_start,
  CASE WHEN n % 5 > 0 THEN start * 3 + 1 END AS cdna_end, CASE WHEN n % 5 > 1 THEN 'aAg/aGg' END AS codons,
  CASE WHEN n % 9 > 0 THEN ['Pfam:PF' || (n % 4), 'hmmpanther:PTHR' || (size % 3)] END AS domains,
  CASE WHEN n % 31 > 0 THEN 'G' || (seed % 50 + i % 3) END AS gene_id, 'SYM' || (seed % 50 + i % 3) AS gene_symbol,
  CASE WHEN n % 7 > 0 THEN transcript_id || ':c.' || start || 'A>G' END AS hgvsc,
  CASE WHEN n % 5 = 0 THEN transcript_id || ':p.' || start || '%3D' WHEN n % 5 < 3 THEN transcript_id || ':p.Lys' || start || 'Arg' END AS hgvsp,
  CASE n % 4 WHEN 0 THEN 'HC' WHEN 1 THEN 'LC' WHEN 2 THEN '' END AS lof,
  CASE WHEN n % 13 > 0 THEN CASE WHEN n % 3 = 0 THEN '' ELSE 'SINGLE_EXON' END END AS lof_flags,
  CASE WHEN n % 4 = 1 THEN 'END_TRUNC' ELSE '' END AS lof_filter, '' AS lof_info,
  CASE WHEN n % 6 = 1 THEN 'benign' END AS polyphen_prediction, CASE WHEN n % 6 = 2 THEN 'tolerated' END AS sift_prediction,
  CASE WHEN n % 5 > 0 THEN 'P' || (seed * 10 + i) END AS protein_id FROM t0),
ranks AS (SELECT unnest({_TERMS}) AS term, unnest(range(39)) AS rank),
t2 AS (SELECT *, {kept} AS consequence_terms, list_position({_TERMS}, terms[1]) AS r1, list_position({_TERMS}, terms[2]) AS r2 FROM t1),
t3 AS (SELECT *, CASE WHEN coalesce(nullif(r2, 0), 99) < coalesce(nullif(r1, 0), 99) THEN terms[2] ELSE terms[1] END AS major_consequence,
  least(coalesce(nullif(r1, 0), 99), coalesce(nullif(r2, 0), 99)) - 1 AS rank0 FROM t2 WHERE len(consequence_terms) > 0),
t4 AS (SELECT *, rank0 AS major_consequence_rank, CASE WHEN rank0 <= 4 THEN 'lof' WHEN rank0 <= 11 THEN 'missense' WHEN rank0 <= 17 THEN 'synonymous' ELSE 'other' END AS category,
  CASE WHEN hgvsp IS NULL OR major_consequence IN ('splice_donor_variant', 'splice_acceptor_variant', 'splice_region_variant') THEN string_split(hgvsc, ':')[-1]
   WHEN contains(hgvsp, '=') OR contains(hgvsp, '%3D') THEN 'p.' || {_AA}[amino_acids] || start || {_AA}[amino_acids]
   ELSE string_split(hgvsp, ':')[-1] END AS hgvs,
  CASE WHEN coalesce(biotype, '') = 'protein_coding' THEN 0 ELSE 4 END + CASE WHEN list_contains(consequence_terms, {_TERMS}[(seed + 7) % 39 + 1]) THEN 0 ELSE 2 END
   + CASE WHEN coalesce(canonical, 0) = 1 THEN 1 ELSE 2 END AS tier FROM t3),
ranked AS MATERIALIZED (SELECT *, start AS protein_start, row_number() OVER (PARTITION BY rid ORDER BY tier, i) - 1 AS transcript_rank FROM t4)"""


LINE = """line AS MATERIALIZED (SELECT row_number() OVER () AS rid, o_orderkey, o_orderkey * 3 + o_custkey + CAST(floor(o_totalprice) AS BIGINT) AS seed,
  CAST(floor(o_totalprice) AS BIGINT) % 50 AS size, o_orderstatus AS flag FROM orders)"""
RANKED = LINE + ",\n" + _transcripts("line")

_BASE = ["biotype", "canonical", "cdna_start", "cdna_end", "codons", "gene_id", "gene_symbol", "hgvsc", "hgvsp", "transcript_id"]
_CODING = ["amino_acids", "lof", "lof_filter", "lof_flags", "lof_info", "polyphen_prediction", "protein_id", "protein_start", "sift_prediction"]
_COMPUTED = ["major_consequence", "category", "hgvs", "major_consequence_rank", "transcript_rank"]


def _cols(names, prefix="r."):
    return ", ".join(f"{prefix}{n}" for n in names)


ORACLE["sorted_transcripts"] = _with(RANKED) + f"""
SELECT o_orderkey, r.seed, {_cols(_BASE + _CODING)}, array_to_string(r.consequence_terms, ',') AS consequence_terms,
  array_to_string(r.domains, ',') AS domains, {_cols(_COMPUTED)} FROM ranked r JOIN line USING (rid)"""
ORACLE["sorted_transcripts_basic"] = _with(LINE, _transcripts("line", omit=False)) + f"""
SELECT o_orderkey, r.seed, {_cols([b for b in _BASE if b != 'hgvsp'])}, array_to_string(r.consequence_terms, ',') AS consequence_terms,
  r.major_consequence, r.transcript_rank FROM ranked r JOIN line USING (rid)"""

_WORST = ["biotype", "canonical", "category", "cdna_start", "cdna_end", "codons", "gene_id", "gene_symbol", "hgvs", "hgvsc",
          "major_consequence", "major_consequence_rank", "transcript_id", "amino_acids", "hgvsp", "lof", "lof_flags",
          "lof_filter", "lof_info", "polyphen_prediction", "protein_id", "sift_prediction"]
_WORST_COLUMNS = ", ".join(f"r.{n} AS main_transcript_{n}" for n in _WORST) + (
    ", array_to_string(list_sort(list_distinct(r.domains)), ',') AS main_transcript_domains")
ORACLE["worst_consequence"] = _with(RANKED) + f"""
SELECT line.o_orderkey, line.seed, {_WORST_COLUMNS} FROM line LEFT JOIN ranked r ON r.rid = line.rid AND r.transcript_rank = 0"""


def _set(expr: str, condition: str | None = None) -> str:
    f = f" FILTER (WHERE {condition})" if condition else ""
    return f"coalesce(string_agg(DISTINCT {expr}, ',' ORDER BY {expr}){f}, '')"


ORACLE["consequence_sets"] = _with(RANKED, """raw_domains AS (SELECT rid, unnest(domains) AS d FROM t1),
kept_domains AS (SELECT rid, unnest(domains) AS d FROM ranked), kept_terms AS (SELECT rid, unnest(consequence_terms) AS t FROM ranked)""",
    f"""a AS (SELECT rid, {_set('d')} AS domains FROM raw_domains GROUP BY rid),
b AS (SELECT rid, {_set('d')} AS sorted_domains FROM kept_domains GROUP BY rid),
c AS (SELECT rid, {_set('t')} AS terms FROM kept_terms GROUP BY rid),
d AS (SELECT rid, {_set('gene_id')} AS genes, {_set('gene_id', "coalesce(biotype, '') = 'protein_coding'")} AS coding_genes,
  {_set('transcript_id')} AS transcript_ids FROM ranked GROUP BY rid)""") + """
SELECT o_orderkey, seed, coalesce(terms, '') AS terms, coalesce(genes, '') AS genes, coalesce(coding_genes, '') AS coding_genes,
  coalesce(domains, '') AS domains, coalesce(sorted_domains, '') AS sorted_domains, coalesce(transcript_ids, '') AS transcript_ids
FROM line LEFT JOIN a USING (rid) LEFT JOIN b USING (rid) LEFT JOIN c USING (rid) LEFT JOIN d USING (rid)"""

JSON_TEXT = """first_of_gene AS (SELECT rid, gene_id, arg_min(major_consequence, transcript_rank) AS major FROM ranked WHERE gene_id IS NOT NULL GROUP BY rid, gene_id),
gene_text AS (SELECT rid, '{' || string_agg('"' || gene_id || '":"' || major || '"', ',' ORDER BY '"' || gene_id || '":"' || major || '"') || '}' AS gene_json FROM first_of_gene GROUP BY rid),
transcript_text AS (SELECT rid, '{' || string_agg('"' || transcript_id || '": "' || major_consequence || '"', ',' ORDER BY transcript_rank) || '}' AS transcript_json FROM ranked GROUP BY rid)"""
ORACLE["consequence_json"] = _with(RANKED, JSON_TEXT) + """
SELECT o_orderkey, seed, coalesce(gene_json, '{}') AS gene_json, coalesce(transcript_json, '{}') AS transcript_json
FROM line LEFT JOIN gene_text USING (rid) LEFT JOIN transcript_text USING (rid)"""

GENE_FLAGS = """annotated AS (SELECT * FROM ranked WHERE lof <> ''),
gene_flag AS (SELECT rid, gene_id, bool_and(lof <> 'HC') AS lc, bool_and(coalesce(lof_flags <> '', false)) AS fl FROM annotated WHERE gene_id IS NOT NULL GROUP BY rid, gene_id),
variant_flag AS (SELECT rid, bool_and(lof <> 'HC') AS lc, CASE WHEN bool_or(lof_flags = '') THEN false WHEN count(*) > count(lof_flags) THEN NULL ELSE true END AS fl FROM annotated GROUP BY rid)"""
ORACLE["lof_flags_variant"] = _with(RANKED, GENE_FLAGS) + """
SELECT o_orderkey, seed, coalesce(lc, false) AS lc_lof, CASE WHEN v.rid IS NULL THEN false ELSE fl END AS lof_flag FROM line LEFT JOIN variant_flag v USING (rid)"""
ORACLE["lof_flags_gene"] = _with(RANKED, GENE_FLAGS, f"g AS (SELECT rid, {_set('gene_id', 'lc')} AS lc_lof_genes, {_set('gene_id', 'fl')} AS flagged_genes FROM gene_flag GROUP BY rid)") + """
SELECT o_orderkey, seed, coalesce(lc_lof_genes, '') AS lc_lof_genes, coalesce(flagged_genes, '') AS flagged_genes FROM line LEFT JOIN g USING (rid)"""
ORACLE["lof_flags_transcript"] = _with(RANKED, GENE_FLAGS) + """
SELECT o_orderkey, r.seed, transcript_id, coalesce(lof <> '' AND lof <> 'HC', false) AS lc_lof, coalesce(g.lc, false) AS lc_lof_in_gene,
  coalesce(lof <> '' AND lof_flags <> '', false) AS lof_flag, coalesce(g.fl, false) AS lof_flag_in_gene, category = 'lof' AND lof = '' AS nc_transcript
FROM ranked r JOIN line USING (rid) LEFT JOIN gene_flag g ON g.rid = r.rid AND g.gene_id = r.gene_id"""

ORACLE["vep_json_ingest"] = _with(SPLIT_SITE) + f"""
SELECT site_id, a_index, CASE WHEN hit THEN {_TERMS}[(site_id + 7) % 39 + 1] END AS most_severe, CASE WHEN hit THEN site_id % 7 END AS n_transcripts,
  CASE WHEN hit THEN array_to_string(list_transform(range(1, site_id % 7 + 1), lambda i: 'T' || (site_id * 10 + i)), ',') END AS transcript_ids
FROM (SELECT *, site_id % 6 <> 5 AND ref = alleles[1] AND alt = alleles[2] AS hit FROM variant)"""

ORACLE["vep_alleles"] = _with(SPLIT_SITE, "asked AS (SELECT site_id AS rid, site_id AS seed, p_size AS size, 'A' AS flag FROM site WHERE site_id % 6 <> 5)", _transcripts("asked"),
    f"""dealt AS (SELECT v.site_id, v.a_index, t.i, t.transcript_id, t.terms FROM variant v JOIN t1 t ON t.rid = v.site_id
  WHERE len(v.alleles) = 2 OR v.site_id % 11 = 0 OR t.i % (len(v.alleles) - 1) + 1 = v.a_index),
every_term AS (SELECT site_id, a_index, i, unnest(terms) AS term, generate_subscripts(terms, 1) AS p FROM dealt),
worst AS (SELECT site_id, a_index, term FROM every_term
  QUALIFY row_number() OVER (PARTITION BY site_id, a_index ORDER BY coalesce(nullif(list_position({_TERMS}, term), 0), 99), i, p) = 1),
gathered AS (SELECT site_id, a_index, count(*) AS n, string_agg(transcript_id, ',' ORDER BY i) AS ids FROM dealt GROUP BY site_id, a_index)""") + f"""
SELECT v.site_id, v.a_index, CASE WHEN v.site_id % 6 <> 5 THEN CASE WHEN len(alleles) = 2 THEN {_TERMS}[(v.site_id + 7) % 39 + 1] ELSE term END END AS most_severe,
  CASE WHEN v.site_id % 6 <> 5 THEN coalesce(n, 0) END AS n_transcripts, CASE WHEN v.site_id % 6 <> 5 THEN coalesce(ids, '') END AS transcript_ids
FROM variant v LEFT JOIN worst USING (site_id, a_index) LEFT JOIN gathered USING (site_id, a_index)"""

# --- expression
EXPRESSION = """tissue AS (SELECT c_custkey AS s, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Brain - Spinal cord (cervical c-1)' WHEN 'BUILDING' THEN 'Liver'
  WHEN 'FURNITURE' THEN 'Lung' WHEN 'MACHINERY' THEN 'Whole Blood' END AS tissue FROM customer),
expression AS (SELECT 'ENST' || l_partkey AS transcript_id, 'ENSG' || (l_partkey % 97) AS gene_id, l_extendedprice AS x, tissue
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN tissue ON s = o_custkey)"""
_TISSUES = {"brainSpinalcordCervicalc1": "Brain - Spinal cord (cervical c-1)", "liver": "Liver", "lung": "Lung", "wholeBlood": "Whole Blood"}
ORACLE["tissue_means"] = _with(EXPRESSION) + "SELECT transcript_id AS transcriptId, gene_id AS geneId, " + ", ".join(
    f"round(avg(x) FILTER (WHERE tissue = '{t}'), 7) AS {name}" for name, t in _TISSUES.items()
) + " FROM expression GROUP BY transcript_id, gene_id"
ORACLE["tissue_stats"] = _with(EXPRESSION) + """
SELECT transcript_id, tissue, round(avg(x), 7) AS mean, round(stddev_pop(x), 4) AS stdev, min(x) AS min, max(x) AS max, count(x) AS n, round(sum(x), 2) AS total
FROM expression WHERE tissue IS NOT NULL GROUP BY transcript_id, tissue"""
MATRIX = """matrix AS (SELECT 'T' || p_partkey AS transcript_id, 'G' || (p_partkey % 10) AS gene_id, 'N' || n_nationkey AS col_id, n_regionkey,
  CASE WHEN (p_size + n_nationkey) % 7 <> 0 THEN (p_size * (n_nationkey + 1) % 97) / 4 END::DOUBLE AS x FROM part, nation)"""
ORACLE["matrix_long"] = _with(MATRIX) + "SELECT transcript_id, gene_id, col_id, x FROM matrix"
ORACLE["tissue_means_from_text"] = _with(MATRIX) + "SELECT transcript_id AS transcriptId, gene_id AS geneId, " + ", ".join(
    f"round(avg(x) FILTER (WHERE n_regionkey = {r}), 7) AS {name}" for r, name in enumerate(["liver", "lung", "wholeBlood", "spleen"])
) + " FROM matrix GROUP BY transcript_id, gene_id"

# --- clinical
STATUS = f"""status AS (SELECT site_id, {_nested(V.SIGNIFICANCES)}[p_size % {len(V.SIGNIFICANCES)} + 1] AS sig, {_nested(V.REVIEW_STATUSES)}[p_size % {len(V.REVIEW_STATUSES)} + 1] AS rev FROM site),
sig_text AS (SELECT site_id, string_agg(s, ',' ORDER BY regexp_replace(s, '^_', 'z'), s) AS clinical_significance FROM (SELECT DISTINCT site_id, unnest(sig) AS s FROM status) GROUP BY site_id),
rev_text AS (SELECT site_id, string_agg(s, ',' ORDER BY regexp_replace(s, '^_', 'z'), s) AS review_status FROM (SELECT DISTINCT site_id, unnest(rev) AS s FROM status) GROUP BY site_id)"""
_STARS = "CASE review_status " + " ".join(f"WHEN {_text(k)} THEN {v}" for k, v in GOLD_STARS.items()) + " END"
ORACLE["clin_sig_stars"] = _with(SITE, STATUS) + f"""
SELECT site_id, clinical_significance, review_status, {_STARS} AS gold_stars FROM sig_text JOIN rev_text USING (site_id)"""

CLINICAL = _with(SPLIT_SITE, ID_FIELDS, STATUS, "asked AS (SELECT site_id AS rid, site_id AS seed, p_size AS size, 'A' AS flag FROM site WHERE site_id % 6 <> 5)",
    _transcripts("asked"), JSON_TEXT, f"""raw_domains AS (SELECT rid, unnest(domains) AS d FROM t1),
a AS (SELECT rid, {_set('d')} AS domains FROM raw_domains GROUP BY rid),
kept_terms AS (SELECT rid, unnest(consequence_terms) AS t FROM ranked),
c AS (SELECT rid, {_set('t')} AS terms FROM kept_terms GROUP BY rid),
d AS (SELECT rid, {_set('gene_id')} AS genes, {_set('transcript_id')} AS transcript_ids FROM ranked GROUP BY rid),
hit AS (SELECT *, CASE WHEN site_id % 6 <> 5 AND ref = alleles[1] AND alt = alleles[2] THEN site_id END AS asked_id FROM identified)""")


def _if_asked(expr: str) -> str:
    return f"CASE WHEN asked_id IS NOT NULL THEN {expr} END"


ORACLE["clinical_table"] = CLINICAL + f"""
SELECT h.site_id AS allele_id, h.alt, h.chrom, clinical_significance, {_if_asked("coalesce(a.domains, '')")} AS domains, {_if_asked("coalesce(genes, '')")} AS gene_ids,
  {_if_asked("coalesce(gene_json, '{}')")} AS gene_id_to_consequence_json, {_STARS} AS gold_stars, {_WORST_COLUMNS}, h.position AS pos, h.ref, review_status,
  {_if_asked("coalesce(c.terms, '')")} AS transcript_consequence_terms, {_if_asked("coalesce(d.transcript_ids, '')")} AS transcript_ids,
  {_if_asked("coalesce(transcript_json, '{}')")} AS transcript_id_to_consequence_json, variant_id, xpos
FROM hit h JOIN sig_text USING (site_id) JOIN rev_text USING (site_id) LEFT JOIN a ON a.rid = asked_id LEFT JOIN c ON c.rid = asked_id LEFT JOIN d ON d.rid = asked_id
LEFT JOIN gene_text g ON g.rid = asked_id LEFT JOIN transcript_text x ON x.rid = asked_id LEFT JOIN ranked r ON r.rid = asked_id AND r.transcript_rank = 0"""
ORACLE["clinical_from_text"] = ORACLE["clinical_table"].replace("\nSELECT h.site_id AS allele_id", "\nSELECT '2024-03-02' AS version, '38' AS genomeVersion, h.site_id AS allele_id")
ORACLE["unknown_review_statuses"] = _with(SPLIT_SITE, STATUS) + f"""
SELECT review_status, count(*) AS n FROM variant JOIN rev_text USING (site_id) WHERE ({_STARS}) IS NULL GROUP BY review_status"""

_CLASS = f"CASE WHEN {_is_snv('ref', 'alt')} THEN 'SNP' WHEN {_is_ins('ref', 'alt')} THEN 'Insertion' WHEN {_is_ins('alt', 'ref')} THEN 'Deletion' WHEN alt = '*' THEN 'Star' ELSE 'Complex' END"
ORACLE["variant_summary"] = _with(SITE, "every AS (SELECT alleles[1] AS ref, unnest(alleles[2:]) AS alt FROM site)") + f"""
SELECT 'variants' AS section, 'total' AS label, count(*) AS n FROM site UNION ALL SELECT 'contig', contig, count(*) FROM site GROUP BY contig
UNION ALL SELECT 'alleles_per_site', CAST(len(alleles) AS VARCHAR), count(*) FROM site GROUP BY len(alleles)
UNION ALL SELECT 'allele_type', {_CLASS}, count(*) FROM every GROUP BY ALL"""
ORACLE["clinical_summary"] = _with(SPLIT_SITE) + f"""
SELECT 'variants' AS section, 'total' AS label, count(*) AS n FROM variant UNION ALL SELECT 'contig', contig, count(*) FROM variant GROUP BY contig
UNION ALL SELECT 'alleles_per_site', '2', count(*) FROM variant UNION ALL SELECT 'allele_type', {_CLASS}, count(*) FROM variant GROUP BY ALL"""
ORACLE["ordered_variants"] = _with(SPLIT_SITE, ID_FIELDS) + "SELECT variant_id, xpos FROM identified ORDER BY variant_id"

# --- names and documents
FIELD_NAME = "field AS (SELECT p_partkey AS site_id, ['_', '-', '+', '$', '', '*'][p_size % 6 + 1] || p_name || '.' || p_brand || '([{a,b}])_$x' || p_size AS name FROM part)"


def _encoded(name: str) -> str:
    expr = f"replace({name}, '$', '$$')"
    for char, escape in NAME_ESCAPES.items():
        expr = f"replace({expr}, '{char}', '{escape}')"
    return f"CASE WHEN left({expr}, 1) IN ('_', '-', '+', '$') THEN '$' || {expr} ELSE {expr} END"


ORACLE["encode_names"] = _with(FIELD_NAME) + f"""SELECT site_id, {_encoded('name')} AS encoded, {_encoded("replace(name, '.', '_')")} AS encoded_without_dot FROM field"""
ORACLE["decode_names"] = _with(FIELD_NAME) + "SELECT site_id, name AS decoded FROM field"

DOC = "doc AS (SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 5 > 0 THEN o_orderstatus END AS st, o_orderpriority AS pr FROM orders)"


def _body(cust: str, nulls: bool) -> str:
    status = "',\"o_orderstatus\":' || coalesce('\"' || st || '\"', 'null')" if nulls else "coalesce(',\"o_orderstatus\":\"' || st || '\"', '')"
    return f"""'{{"o_orderkey":' || o_orderkey || ',"{cust}":' || o_custkey || {status} || ',"o_orderpriority":"' || pr || '"}}'"""


def _action(verb: str, with_id: bool = True) -> str:
    tail = """',"_id":"' || o_orderkey || '"}}'""" if with_id else "'}}'"
    return f"""'{{"{verb}":{{"_index":"orders"' || {tail}"""


ORACLE["bulk_documents"] = _with(DOC) + f"SELECT CAST(o_orderkey AS VARCHAR) AS id, {_action('index')} AS action, {_body('cust_key', False)} AS body FROM doc"
ORACLE["bulk_documents_update"] = _with(DOC) + f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, {_action('update')} AS action, '{{"doc":' || {_body('cust_key', True)} || '}}' AS body FROM doc"""
ORACLE["bulk_documents_upsert"] = _with(DOC) + f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, {_action('update')} AS action, '{{"doc":' || {_body('cust_$dot$_key', True)} || ',"doc_as_upsert":true}}' AS body FROM doc"""
ORACLE["bulk_documents_create"] = _with(DOC) + f"SELECT {_action('create', False)} AS action, {_body('cust_key', False)} AS body FROM doc"

MERGE = """old AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS cust FROM orders WHERE o_orderkey % 3 <> 0),
raw AS (SELECT l_orderkey AS id, CASE WHEN l_linenumber % 3 > 0 THEN l_linestatus END AS status, l_partkey AS part FROM lineitem),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY status DESC NULLS LAST, part DESC) AS rn FROM raw) WHERE rn = 1),
earliest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY status NULLS FIRST, part) AS rn FROM raw) WHERE rn = 1)"""
ORACLE["merge_documents_index"] = _with(MERGE) + """
SELECT id, status, cust, NULL::BIGINT AS part FROM old WHERE id NOT IN (SELECT id FROM raw) UNION ALL SELECT id, status, NULL, part FROM latest"""
ORACLE["merge_documents_create"] = _with(MERGE) + """
SELECT id, status, cust, NULL::BIGINT AS part FROM old UNION ALL SELECT id, status, NULL, part FROM earliest WHERE id NOT IN (SELECT id FROM old)"""
ORACLE["merge_documents_update"] = _with(MERGE) + """
SELECT old.id, CASE WHEN l.id IS NULL THEN old.status ELSE l.status END AS status, cust, part FROM old LEFT JOIN latest l ON l.id = old.id"""
ORACLE["merge_documents_upsert"] = _with(MERGE) + """
SELECT coalesce(old.id, l.id) AS id, CASE WHEN l.id IS NULL THEN old.status ELSE l.status END AS status, cust, part FROM old FULL JOIN latest l ON l.id = old.id"""
ORACLE["merge_rejects_create"] = _with(MERGE) + """
SELECT id, 'exists' AS reason, n FROM (SELECT id, count(*) - CASE WHEN id IN (SELECT id FROM old) THEN 0 ELSE 1 END AS n FROM raw GROUP BY id) WHERE n > 0"""
ORACLE["merge_rejects_update"] = _with(MERGE) + "SELECT id, 'missing' AS reason, count(*) AS n FROM raw WHERE id NOT IN (SELECT id FROM old) GROUP BY id"
ORACLE["denovo_union"] = """SELECT c_custkey AS key, c_name AS variant_id, c_mktsegment AS study, NULL::INTEGER AS confidence FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier"""

_WRITTEN = """SELECT {times} * count(*) AS n_actions, {times} * count(*) AS n_bodies, ({times} * sum(length(action) + length(body)))::BIGINT AS characters FROM (
  SELECT '{{"index":{{"_index":"{index}"{id}}}}}' AS action, '{{"o_orderkey":' || o_orderkey || ',"{cust}":' || o_custkey || coalesce(',"o_orderstatus":"' || st || '"', '') || ',"o_orderpriority":"' || pr || '"}}' AS body
  FROM (SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 5 > 0 THEN o_orderstatus END AS st, o_orderpriority AS pr FROM orders))"""
ORACLE["bulk_written"] = _WRITTEN.format(times=2, index="orders", id=""","_id":"' || o_orderkey || '\"""", cust="cust_key")
ORACLE["publish_saved"] = _WRITTEN.format(times=2, index="exomes", id="", cust="o_cust")
ORACLE["constraint_from_text"] = """SELECT 'ENST' || p_partkey AS transcript, p_size AS obs_lof, p_size / 4 AS exp_lof, CASE WHEN p_size % 3 > 0 THEN p_size / 8 END AS oe_lof,
  p_size % 2 = 0 AS classic, p_brand AS gene_name, 'ENST' || p_partkey AS transcript_id FROM part"""
ORACLE["denovo_from_text"] = """SELECT s_name AS variant_id, s_suppkey AS key, s_nationkey AS confidence, NULL::VARCHAR AS study FROM supplier
UNION ALL SELECT c_name, c_custkey, NULL, c_mktsegment FROM customer"""
ORACLE["medians_from_text"] = """SELECT 'ENST' || p_partkey AS transcriptId, 'ENSG' || (p_partkey % 97) AS geneId, p_size / 4 AS liver, CASE WHEN p_size % 5 > 0 THEN p_size / 2 END AS lung FROM part"""

ORACLE["merge_versions"] = """WITH line AS (SELECT l_orderkey AS id, l_partkey AS part, CASE WHEN l_linenumber % 3 > 0 THEN l_linestatus END AS status FROM lineitem),
last_status AS (SELECT id, status FROM line WHERE id % 20 = 1 QUALIFY row_number() OVER (PARTITION BY id ORDER BY status DESC NULLS LAST) = 1)
SELECT o_orderkey AS id, CASE WHEN l.id IS NOT NULL THEN l.status ELSE o_orderstatus END AS status, o_custkey AS cust, NULL::BIGINT AS part
FROM orders LEFT JOIN last_status l ON l.id = o_orderkey WHERE o_orderkey % 3 <> 0
UNION ALL SELECT id, NULL, NULL, min(part) FROM line WHERE id % 3 = 0 GROUP BY id"""

# --- text sources
VCF = f"""vcf AS (SELECT l_partkey AS key, CAST(floor(l_quantity) AS BIGINT) AS q, CAST(floor(l_extendedprice) AS BIGINT) AS ep,
  {_contig('l_partkey')} AS contig, l_partkey * 10 + 1000 AS position, {_nested(V.KINDS)}[CAST(floor(l_quantity) AS BIGINT) % 6 + 1] AS alleles FROM lineitem),
good AS (SELECT *, len(alleles) - 1 AS n_alts FROM vcf WHERE ep % 29 <> 0 AND q % 17 <> 0),
sample_call AS (SELECT *, 'S' || i AS s, (q + i) % 10 = 0 AS only_gt,
  (ep + i) % 11 = 0 AS no_call, (ep + i) % 11 <> 0 AND (ep + i) % 13 = 0 AS hap, (ep + i) % (n_alts + 1) AS g0, (q + i) % 3 = 0 AS ph
  FROM good, (SELECT r_regionkey::BIGINT AS i FROM region))"""
ORACLE["vcf_roundtrip"] = _with(VCF) + """
SELECT contig, position, CASE WHEN q % 2 = 1 THEN 'rs' || key END AS rsid, array_to_string(alleles, ',') AS alleles,
  CASE WHEN q % 6 > 0 THEN CAST(q AS DOUBLE) END AS qual, CASE q % 4 WHEN 0 THEN '' WHEN 2 THEN 'q10' WHEN 3 THEN 'q10,s50' END AS filters,
  q AS info_dp, CASE WHEN q % 3 = 0 THEN 2 END AS n_af, CASE WHEN q % 3 = 0 THEN 0.5::DOUBLE END AS first_af, NULL::DOUBLE AS second_af, q % 5 = 0 AS info_db FROM good"""
ORACLE["vcf_entries"] = _with(VCF) + """
SELECT contig, position, s, CASE WHEN no_call THEN NULL WHEN hap THEN CAST(g0 AS VARCHAR) ELSE g0 || CASE WHEN ph THEN '|' ELSE '/' END || n_alts END AS gt,
  CASE WHEN NOT only_gt THEN CASE WHEN n_alts > 1 THEN 3 ELSE 2 END END AS n_ad, CASE WHEN NOT only_gt THEN q END AS ad0,
  CASE WHEN NOT only_gt AND (q + i) % 7 <> 0 THEN ep % 50 + i END AS ad1, CASE WHEN NOT only_gt AND n_alts > 1 THEN ep % 9 END AS ad2,
  CASE WHEN NOT only_gt THEN q + ep % 50 END AS dp, CASE WHEN NOT only_gt THEN (ep + i) % 100 END AS gq FROM sample_call"""
ORACLE["vcf_call_stats"] = _with(VCF, """coded AS (SELECT contig, CAST(NOT no_call AND g0 = a AS BIGINT) AS d0, CAST(NOT no_call AND NOT hap AND n_alts = a AS BIGINT) AS d1,
  CASE WHEN no_call THEN 0 WHEN hap THEN 1 ELSE 2 END AS ploidy FROM sample_call, unnest(range(1, n_alts + 1)) AS u(a) WHERE alleles[a + 1] <> '*')""") + """
SELECT contig, CAST(sum(d0 + d1) AS BIGINT) AS ac, CAST(sum(ploidy) AS BIGINT) AS an, CAST(sum(d0 * d1) AS BIGINT) AS nhom, count(*) // (SELECT count(*) FROM region) AS n FROM coded GROUP BY contig"""
ORACLE["exome_from_text"] = _with(VCF, f"target AS (SELECT {_contig('p_partkey')} AS c, p_partkey * 10 + 1000 AS a, p_partkey * 10 + 1200 AS b FROM part WHERE p_partkey % 50 = 0)") + """
SELECT contig, position, s, CASE WHEN no_call THEN NULL WHEN hap THEN CAST(g0 AS VARCHAR) ELSE g0 || CASE WHEN ph THEN '|' ELSE '/' END || n_alts END AS gt
FROM sample_call WHERE EXISTS (FROM target WHERE c = contig AND position BETWEEN a AND b)"""
ORACLE["vcf_samples"] = "SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS sample, 'S' || n_nationkey AS s FROM nation"
ORACLE["contig_recoding"] = f"""WITH sequence AS (
  SELECT {_contig('n_nationkey')} AS contig, 1000000 + n_nationkey * 1000 AS length FROM nation WHERE n_nationkey < 24
  UNION ALL SELECT 'chrUn_' || s_suppkey || 'v1', 5000 + s_suppkey FROM supplier
), called AS (
  SELECT p_partkey AS site_id, p_partkey * 37 % 1100000 AS position, CASE p_partkey % 4 WHEN 0 THEN {_contig('p_partkey')}
    WHEN 1 THEN replace({_contig('p_partkey')}, 'chr', '') WHEN 2 THEN 'Un_' || (p_partkey % 150) || 'v1' ELSE 'chr99_X' || p_partkey || 'v1_alt' END AS named FROM part
)
SELECT site_id, named, coalesce(contig, named) AS contig, contig IS NOT NULL AND position BETWEEN 1 AND length AS valid
FROM called LEFT JOIN sequence ON contig IN (named, 'chr' || named)"""
ORACLE["release_dates"] = """SELECT 'file' || (p_partkey % 37) AS path,
  max(CASE WHEN p_size % 5 = 0 AND p_partkey % 37 % 4 > 0 THEN '2024-02-' || (p_partkey % 37 + 10) END) AS release_date FROM part GROUP BY 1"""
ORACLE["impute_types"] = """SELECT l_orderkey AS key, l_partkey + 3000000000 AS large_key, CASE WHEN l_quantity > 5 THEN l_quantity END AS quantity,
  l_tax > 0.02 AS taxed, 'T' || l_linenumber AS line FROM lineitem"""

# --- reshaping
ORACLE["expand_types"] = _with(SITE) + "SELECT site_id, 'contig' AS key, contig AS value FROM site UNION ALL SELECT site_id, 'first', alleles[1] FROM site"
ORACLE["transmute_fields"] = """SELECT 'ENST' || p_partkey AS transcript, p_size AS obs_lof, p_retailprice AS exp_lof, p_name AS gene_name,
  'ENST' || p_partkey AS transcript_id FROM part"""
ORACLE["constraint_pick"] = "SELECT " + ", ".join(f"p_size + {i} AS {n}" for i, n in enumerate(CONSTRAINT_FIELDS)) + " FROM part"
ORACLE["population_map_struct"] = "SELECT p_partkey AS site_id, p_size AS afr, NULL::INTEGER AS amr, p_size * 2 AS eas, NULL::INTEGER AS eur, NULL::INTEGER AS oth, NULL::INTEGER AS sas FROM part"
ORACLE["interval_structs"] = _with(SITE) + 'SELECT contig AS chrom, position AS "start", position + 200 AS "end" FROM site WHERE site_id % 50 = 0'
# the names are written out here, as they must not come from the list under test
ORACLE["histogram_structs"] = """SELECT p_partkey AS site_id, name, 5.0::DOUBLE + i AS edge, p_size + 1 + i AS freq,
  p_size % (3 + i) AS n_larger, p_size % (2 + i) AS n_smaller
  FROM part, (VALUES (0, 'ab_hist_alt'), (1, 'dp_hist_all'), (2, 'dp_hist_alt'), (3, 'gq_hist_all'), (4, 'gq_hist_alt'),
    (5, 'gnomad_age_hist_het'), (6, 'gnomad_age_hist_hom')) t(i, name)"""
ORACLE["site_quality"] = "SELECT p_partkey AS site_id, " + ", ".join(f"p_size * {i + 1} AS {f}" for i, f in enumerate(SITE_QUALITY_FIELDS)) + " FROM part"
ORACLE["info_projection"] = """SELECT p_partkey AS site_id, floor(p_retailprice) AS MQ, CAST(p_size - 25 AS DOUBLE) AS MQRankSum, p_size / 4 AS QD, CAST(p_size * 2 AS DOUBLE) AS ReadPosRankSum,
  0.5::DOUBLE AS SOR, p_size % 2 = 0 AS VQSR_POSITIVE_TRAIN_SITE, p_size % 2 = 1 AS VQSR_NEGATIVE_TRAIN_SITE FROM part"""


def _bundle_places() -> dict[str, int]:
    stems = []
    for field in FREQUENCY_FIELDS:
        stems += [field, f"{field}_female", f"{field}_male"]
        for pop, subs in RELEASE_SUBPOPULATIONS.items():
            if pop != "asj":
                stems += [f"{field}_{pop}", *[f"{field}_{pop}_{sub}" for sub in subs if sub != "onf"]]
    for field in FILTERING_AF_FIELDS:
        stems += [field, *[f"{field}_{pop}" for pop in FILTERING_AF_POPULATIONS]]
    return {stem: i for i, stem in enumerate(stems + POPMAX_FIELDS)}


_P = _bundle_places()
ORACLE["subset_bundles"] = "SELECT p_partkey AS site_id, " + ", ".join(
    f"p_size * 1000 + {_P[stem]} AS {name}"
    for name, stem in {
        "ac_eas_jpn": "AC_adj_eas_jpn", "ac_nfe": "AC_adj_nfe", "af_total": "AF_adj", "af_female": "AF_adj_female",
        "an_sas_male": "AN_adj_sas_male", "faf95_afr": "faf95_adj_afr", "faf99_total": "faf99_adj",
        "popmax": "popmax", "nhomalt_raw": "nhomalt_raw",
    }.items()
) + " FROM part"

# --- the flagship
ORACLE["cohort_variants"] = _with(
    SPLIT_SITE, ENTRY, SPLIT_ENTRY, SAMPLE, "fact AS (SELECT * FROM called LEFT JOIN sample USING (s))",
    f"wide AS (SELECT site_id, a_index, {WIDE} FROM fact GROUP BY site_id, a_index)", BINNED,
    """dense AS (SELECT k.site_id, k.a_index, names.hist, string_agg(CAST(coalesce(h.n, 0) AS VARCHAR), ',' ORDER BY bin_no) AS freq
  FROM variant k, (VALUES ('ab_hist_alt_adj'), ('dp_hist_all'), ('gq_hist_alt')) AS names(hist), unnest(range(20)) AS b(bin_no)
  LEFT JOIN hist h ON h.site_id = k.site_id AND h.a_index = k.a_index AND h.hist = names.hist AND h.bin = bin_no GROUP BY ALL)""",
    REFERENCE, ID_FIELDS, "asked AS (SELECT site_id AS rid, site_id AS seed, p_size AS size, 'A' AS flag FROM site WHERE site_id % 6 <> 5)",
    _transcripts("asked"), GENE_FLAGS,
    "hit AS (SELECT *, CASE WHEN site_id % 6 <> 5 AND ref = alleles[1] AND alt = alleles[2] THEN site_id END AS asked_id FROM identified)",
    "counts AS (SELECT rid, count(*) AS n_transcripts FROM ranked GROUP BY rid)",
) + f"""
SELECT variant_id, chrom, h.position AS pos, h.ref, h.alt, xpos, p_retailprice AS qual, rsid, array_to_string(h.filters, ',') AS filters,
  {', '.join(f"{_wide_column(c.split('_')[0], _TOTALS['_' + c.split('_')[1]] if '_' in c else 'adj')} AS {c}" for c in
             ["AC", "AN", "AF", "nhomalt", "AC_raw", "AN_raw", "nhomalt_raw", "AC_proband", "AC_male", "AN_female"])},
  {_wide_column('AC', 'adj_afr')} AS AC_afr, {_wide_column('AN', 'adj_sas')} AS AN_sas, CAST(cadd AS DOUBLE) AS cadd, ref_row.size / 64 AS splice_ai,
  ab.freq AS ab_alt_adj, dp.freq AS dp_all_raw, gq.freq AS gq_alt_raw,
  {_if_asked("coalesce(f.lc, false)")} AS lc_lof, {_if_asked("CASE WHEN f.rid IS NULL THEN false ELSE f.fl END")} AS lof_flag,
  {_if_asked("coalesce(n_transcripts, 0)")} AS n_transcripts, r.transcript_id AS first_transcript, r.major_consequence AS first_consequence,
  CASE WHEN r.rid IS NOT NULL THEN coalesce(gf.lc, false) END AS first_lc_lof_in_gene
FROM hit h LEFT JOIN wide w ON w.site_id = h.site_id AND w.a_index = h.a_index
LEFT JOIN dense ab ON ab.site_id = h.site_id AND ab.a_index = h.a_index AND ab.hist = 'ab_hist_alt_adj'
LEFT JOIN dense dp ON dp.site_id = h.site_id AND dp.a_index = h.a_index AND dp.hist = 'dp_hist_all'
LEFT JOIN dense gq ON gq.site_id = h.site_id AND gq.a_index = h.a_index AND gq.hist = 'gq_hist_alt'
LEFT JOIN reference ref_row ON ref_row.contig = h.contig AND ref_row.position = h.position AND ref_row.ref = h.ref AND ref_row.alt = h.alt
LEFT JOIN variant_flag f ON f.rid = asked_id LEFT JOIN counts ON counts.rid = asked_id
LEFT JOIN ranked r ON r.rid = asked_id AND r.transcript_rank = 0
LEFT JOIN gene_flag gf ON gf.rid = r.rid AND gf.gene_id = r.gene_id"""
_LINES = VCF.replace("vcf AS (SELECT", "vcf AS MATERIALIZED (SELECT row_number() OVER () AS line_id,")
ORACLE["cohort_from_text"] = _with(
    _LINES, """kept AS (SELECT * FROM sample_call WHERE i <> 2),
carrier AS (SELECT line_id FROM kept GROUP BY line_id HAVING bool_or(NOT no_call AND (NOT hap OR g0 > 0))),
alternate AS (SELECT line_id, key, q, contig, position, alleles, alleles[1] AS ref, alleles[a + 1] AS alt, CAST(a AS BIGINT) AS a_index
  FROM good JOIN carrier USING (line_id), unnest(range(1, n_alts + 1)) AS u(a) WHERE alleles[a + 1] <> '*')""",
    _minimal("alternate", "variant"), f"""coded AS (SELECT v.line_id, a_index, i, no_call, hap, CASE WHEN NOT only_gt THEN q + ep % 50 END AS dp, CASE WHEN NOT only_gt THEN (ep + i) % 100 END AS gq,
  CAST(g0 = a_index AS BIGINT) AS d0, CASE WHEN NOT hap THEN CAST(n_alts = a_index AS BIGINT) END AS d1,
  CASE WHEN NOT only_gt THEN CASE a_index WHEN 1 THEN CASE WHEN (q + i) % 7 <> 0 THEN ep % 50 + i END ELSE ep % 9 END END AS ad_alt
  FROM (SELECT line_id, a_index FROM variant) v JOIN kept USING (line_id)),
fact AS (SELECT *, NOT no_call AND gq >= 20 AND dp >= 10 AND (hap OR d0 = d1 OR coalesce(ad_alt / dp >= 0.2, false)) AS adj,
  CASE WHEN no_call THEN 0 ELSE d0 + coalesce(d1, 0) END AS ac, CASE WHEN no_call THEN 0 WHEN hap THEN 1 ELSE 2 END AS an,
  CASE WHEN NOT no_call AND d0 = 1 AND d1 = 1 THEN 1 ELSE 0 END AS hom FROM coded),
counted AS (SELECT line_id, a_index, coalesce(sum(ac) FILTER (adj), 0)::BIGINT AS AC, coalesce(sum(an) FILTER (adj), 0)::BIGINT AS AN, coalesce(sum(hom) FILTER (adj), 0)::BIGINT AS nhomalt,
  sum(ac)::BIGINT AS AC_raw, sum(an)::BIGINT AS AN_raw, sum(hom)::BIGINT AS nhomalt_raw, coalesce(sum(ac) FILTER (adj AND i = 0), 0)::BIGINT AS AC_proband,
  coalesce(sum(ac) FILTER (adj AND i % 2 = 0), 0)::BIGINT AS AC_male, coalesce(sum(an) FILTER (adj AND i % 2 = 1), 0)::BIGINT AS AN_female,
  coalesce(sum(ac) FILTER (adj AND i = 1), 0)::BIGINT AS AC_second, list(dp) FILTER (dp IS NOT NULL) AS depths FROM fact GROUP BY line_id, a_index)""", SITE, REFERENCE) + f"""
SELECT replace(v.contig, 'chr', '') || '-' || v.position || '-' || v.ref || '-' || v.alt AS variant_id, replace(v.contig, 'chr', '') AS chrom, v.position AS pos, v.ref, v.alt,
  CASE WHEN q % 6 > 0 THEN CAST(q AS DOUBLE) END AS qual, r.rsid, AC, AN, AC / nullif(AN, 0) AS AF, nhomalt, AC_raw, AN_raw, nhomalt_raw, AC_proband, AC_male, AN_female, AC_second, 4 AS n_pops,
  CAST(r.cadd AS DOUBLE) AS cadd, CASE WHEN r.p_size % 2 > 0 THEN r.p_size / 256 END AS revel, array_to_string(list_transform(range(20), lambda b: len(list_filter(coalesce(depths, []), lambda d: d // 5 = b))), ',') AS dp_all_raw,
  s.site_id IS NOT NULL AS annotated
FROM variant v JOIN counted USING (line_id, a_index) LEFT JOIN reference r ON r.contig = v.contig AND r.position = v.position AND r.ref = v.ref AND r.alt = v.alt
LEFT JOIN site s ON s.site_id = v.key AND s.site_id % 6 <> 5 AND s.position = v.position AND s.alleles[1] = v.ref AND s.alleles[2] = v.alt"""
