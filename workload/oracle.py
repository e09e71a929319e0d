"""The queries in the SQL of the checking engine, written on their own.

The input texts are shared with the Spark side; what is asked of them is not.
"""

from __future__ import annotations

from schoolatlas.functions.places import ROMAN
from schoolatlas.functions.school_names import ABBREVIATIONS, EXPANSIONS, REPEATED_ANY, REPEATED_MEMORIAL

from . import inputs
from .inputs import plain

SQL: dict[str, str] = {}


def _with(**ctes: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({plain(sql)})" for name, sql in ctes.items()) + " "


# --- scalar texts as expressions ----------------------------------------------


def collapse(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def title(x: str, word: str = r"\p{L}") -> str:
    runs = f"regexp_extract_all(lower({x}), '[{word}]+|[^{word}]+')"
    return f"array_to_string(list_transform({runs}, lambda w: replace(upper(w[1]), 'ẞ', 'Ss') || w[2:]), '')"


def region_text(x: str) -> str:
    bare = rf"regexp_replace(trim(lower({x})), '\(.*?\)', '', 'g')"
    return f"trim(regexp_replace({bare}, '[^a-z0-9]+', ' ', 'g'))"


def place_text(x: str) -> str:
    bare = rf"trim(regexp_replace(strip_accents(trim(lower({x}))), '\(.*?\)', '', 'g'))"
    bare = f"regexp_replace({bare}, '[.,]', '', 'g')"
    bare = rf"regexp_replace({bare}, '\bsto\b', 'santo', 'g')"
    bare = rf"regexp_replace({bare}, '\bsta\b', 'santa', 'g')"
    bare = rf"regexp_replace({bare}, '^city of \s*(.*?)\s*$', '\1 city')"
    return collapse(bare)


_ROMAN = "['I','II','III','IV','V','VI','VII','VIII','IX','X']"
_ENDING = r"'(?i)\b(I|II|III|IV|V|VI|VII|VIII|IX|X)\b\.?$'"


def roman_text(x: str) -> str:
    number = f"list_position({_ROMAN}, upper(regexp_extract({x}, {_ENDING}, 1)))"
    return (
        f"CASE WHEN regexp_matches({x}, {_ENDING}) THEN regexp_replace({x}, {_ENDING}, '')"
        f" || CAST({number} AS VARCHAR) ELSE {x} END"
    )


def enye(x: str) -> str:
    return f"replace({x}, 'Ã‘', 'Ñ')"


def barangay_text(x: str) -> str:
    return roman_text(place_text(enye(x)))


def digits(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '[^0-9]', '', 'g')"


def id_text(x: str) -> str:
    return rf"nullif(regexp_replace(trim({x}), '\.0$', ''), '')"


def school_id(lis: str, beis: str) -> str:
    first = id_text(f"coalesce({lis}, {beis})")
    return f"CAST(coalesce(try_cast(nullif({digits(first)}, '') AS BIGINT), 0) AS VARCHAR)"


_DECIMAL = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def whole(x: str) -> str:
    bare = f"trim(replace({x}, ',', ''))"
    return f"CASE WHEN regexp_matches({bare}, '^[0-9]+$') THEN CAST({bare} AS BIGINT) END"


def number(x: str) -> str:
    bare = f"trim(replace({x}, ',', ''))"
    return f"CASE WHEN regexp_matches({bare}, {_DECIMAL}) THEN CAST({bare} AS DOUBLE) END"


def long_text(x: str) -> str:
    value = f"CASE WHEN regexp_matches(trim({x}), {_DECIMAL}) THEN CAST(trim({x}) AS DOUBLE) END"
    return f"CASE WHEN ({value}) = floor({value}) THEN CAST({value} AS BIGINT) END"


# --- enrollment ---------------------------------------------------------------

_LABELS = inputs._COUNT_LABELS
_LONG = (
    _with(w=inputs.WIDE_ENROLLMENT)
    + f", l AS (SELECT * FROM w UNPIVOT INCLUDE NULLS (raw FOR label IN ({', '.join(_LABELS)}))),"
    " p AS (SELECT *, string_split(nullif(label, ''), '_') AS s, " + whole("raw") + " AS n FROM l)"
)
_PARTS = (
    "s[1] AS grade, CASE WHEN len(s) > 2 THEN array_to_string(s[2:-2], '_') END AS strand,"
    " CASE WHEN len(s) > 1 THEN s[-1] END AS sex"
)

SQL["q01_wide_enrollment_totals"] = _LONG + f"""
SELECT school_year, grade, strand, sex, CAST(sum(n) AS BIGINT) AS num_students, count(*) AS cells
FROM (SELECT school_year, {_PARTS}, n FROM p WHERE n <> 0) GROUP BY ALL"""

SQL["q02_unpivot_all"] = """
WITH w AS (SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer, o_orderstatus AS status,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS priority FROM orders)
SELECT * FROM w UNPIVOT INCLUDE NULLS (value FOR name IN (customer, status, priority))"""

SQL["q03_sanitize_counts"] = _with(t=inputs.DIRTY_NUMBERS) + rf"""
SELECT id, {whole('raw')} AS whole, {number('raw')} AS as_double, {long_text('cell')} AS as_long,
  CAST(trunc({number('cell')}) AS BIGINT) AS truncated, nullif(nullif(cell, ''), '#N/A') AS cell,
  nullif(trim(cell), '') AS header,
  CASE WHEN regexp_matches(cell, {_DECIMAL}) THEN CAST(trunc(CAST(cell AS DOUBLE)) AS BIGINT) END AS casted
FROM t"""

SQL["q04_label_split"] = _with(t=inputs.LABELS) + f"""
SELECT label, {_PARTS}, rows_seen FROM (
  SELECT label, string_split(nullif(label, ''), '_') AS s, count(*) AS rows_seen FROM t GROUP BY label)"""

SQL["q05_invalid_audit"] = _LONG + """
SELECT source_file, count(*) AS invalid_rows,
  array_to_string(list_sort(list(DISTINCT raw))[1:5], '|') AS samples
FROM p WHERE raw IS NOT NULL AND n IS NULL GROUP BY source_file"""

SQL["q05_reject_reasons"] = _with(t=inputs.DIRTY_NUMBERS) + f"""
SELECT reason, count(*) AS rows_seen, CAST(sum(id) AS BIGINT) AS id_sum FROM (
  SELECT id, CASE WHEN raw IS NULL THEN 'missing' WHEN ({whole('raw')}) IS NULL THEN 'invalid'
    WHEN ({whole('raw')}) = 0 THEN 'zero' ELSE 'valid' END AS reason FROM t) GROUP BY reason"""

SQL["q06_school_year_from_name"] = _with(t=inputs.FILE_NAMES) + r"""
SELECT file_name, count(*) AS orders_seen, regexp_extract(file_name, '[0-9]{4}-[0-9]{4}') AS school_year
FROM t GROUP BY file_name"""

_LEVELS = """SELECT school_id, school_year, {0} AS level, offered FROM j
  UNPIVOT INCLUDE NULLS (offered FOR name IN (offers_es AS 'es', offers_jhs AS 'jhs', offers_shs AS 'shs'))"""
SQL["q07_offered_levels"] = _with(t=inputs.SCHOOL_OFFERS) + """, r AS (
SELECT *, row_number() OVER (PARTITION BY school_id ORDER BY school_year DESC, offers_es DESC NULLS LAST,
  offers_jhs DESC NULLS LAST, offers_shs DESC NULLS LAST) AS k FROM t),
j AS (SELECT y.*, offers_es, offers_jhs, offers_shs FROM (SELECT DISTINCT school_id, school_year FROM t) y
  JOIN r ON r.school_id = y.school_id AND k = 1) """ + _LEVELS.format("name")
SQL["q07_levels_from_meta"] = _with(t=inputs.SCHOOL_OFFERS) + """, r AS (
SELECT *, row_number() OVER (PARTITION BY school_id ORDER BY offers_es NULLS FIRST,
  offers_jhs NULLS FIRST, offers_shs NULLS FIRST) AS k FROM t),
j AS (SELECT y.*, offers_es, offers_jhs, offers_shs FROM (SELECT DISTINCT school_id, school_year FROM t) y
  JOIN r ON r.school_id = y.school_id AND k = 1) """ + _LEVELS.format("upper(name)")

# --- one row per key, lookups -----------------------------------------------

SQL["q08_latest_per_key"] = """
SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) = 1"""
SQL["q09_last_occurrence"] = """
SELECT l_partkey, l_linenumber, l_orderkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey
  ORDER BY l_linenumber DESC, l_orderkey DESC, l_suppkey DESC, l_quantity DESC) = 1"""
SQL["q10_any_per_key_stable"] = """
SELECT user_id, event_type, value, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value NULLS FIRST, event_id) = 1"""
_PRIORITIES = """SELECT row_number() OVER (ORDER BY o_orderpriority) AS id, o_orderpriority
  FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL)"""
SQL["q11_distinct_lookup"] = _PRIORITIES
SQL["q12_label_to_key"] = f"""
WITH k AS ({_PRIORITIES}), t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL
  WHEN o_orderkey % 19 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS label FROM orders)
SELECT o_orderkey, id AS priority_id FROM t LEFT JOIN k ON label = o_orderpriority"""
SQL["q12_extract_lookup"] = """
SELECT row_number() OVER (ORDER BY p_type) AS type_id, p_type, parts
FROM (SELECT p_type, count(*) AS parts FROM part GROUP BY p_type)"""

# --- headers and cells ---------------------------------------------------------

_CELLS = """WITH c AS (SELECT event_id // 16 AS row_id,
  CAST(row_number() OVER (PARTITION BY event_id // 16 ORDER BY event_id) - 1 AS INTEGER) AS col_idx,
  nullif(trim(CASE WHEN event_id % 3 = 0 THEN event_type WHEN event_id % 5 = 0 THEN ' ' || event_type || '  x ' END), '')
    AS label FROM events),
f AS (SELECT row_id, col_idx, last_value(label IGNORE NULLS) OVER (PARTITION BY row_id ORDER BY col_idx
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS label FROM c) """
SQL["q13_forward_fill"] = _CELLS + "SELECT row_id, col_idx, label FROM f"
SQL["q14_unique_headers"] = _CELLS + """, n AS (
SELECT row_id, col_idx, coalesce(label, 'column_' || CAST(col_idx * 2 AS VARCHAR)) AS label FROM c)
SELECT row_id, col_idx, CASE WHEN k > 1 THEN label || '_' || CAST(k - 1 AS VARCHAR) ELSE label END AS header
FROM (SELECT *, row_number() OVER (PARTITION BY row_id, label ORDER BY col_idx) AS k FROM n)"""
SQL["q15_header_tokens"] = _CELLS + f"""
SELECT row_id // 2 AS sheet_id, col_idx, {collapse("coalesce(string_agg(label, ' ' ORDER BY row_id), '')")} AS header
FROM f GROUP BY row_id // 2, col_idx"""
SQL["q16_column_ranges"] = "WITH l AS (SELECT * FROM lineitem), c AS (" + " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS col_idx, CAST({c} AS VARCHAR) AS cell FROM l"
    for i, c in [(0, "l_orderkey"), (1, "l_partkey"), (3, "l_linenumber"), (5, "l_linestatus"), (8, "NULL")]
) + """) SELECT col_idx, count(cell) AS cells, min(cell) AS least, CAST(sum(length(cell)) AS BIGINT) AS letters
FROM c GROUP BY col_idx"""
SQL["q17_union_coerce"] = """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS INTEGER) AS nation
FROM customer UNION ALL
SELECT s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier"""

# --- scalar texts ------------------------------------------------------------------

SQL["q19_place_names"] = _with(s=inputs.SCHOOLS) + f"""
SELECT school_id, {region_text('region')} AS region, {place_text('province')} AS province,
  {place_text('municipality')} AS municipality, {barangay_text('barangay')} AS barangay,
  {roman_text('barangay')} AS numbered, {enye('barangay')} AS repaired FROM s"""
SQL["q20_title_case"] = f"SELECT doc_id, {title('text')} AS title FROM documents"


def _school_name_steps() -> str:
    """One CTE per step; each replaces column ``n`` of the step before."""
    steps: list[str] = []

    def step(expression: str) -> None:
        source = f"s{len(steps) - 1}" if steps else "t"
        steps.append(f"s{len(steps)} AS (SELECT id, {expression} AS n FROM {source})")

    def swap(pattern: str, text: str) -> None:
        pattern, text = pattern.replace("'", "''"), text.replace("'", "''")
        step(f"regexp_replace(n, '{pattern}', '{text}', 'g')")

    def once(*phrases: str) -> None:
        for p in phrases:
            swap(rf"(?i)({p})(?:\s+{p})+", r"\1")

    step(r"regexp_replace(school_name, '\.{2,}', '.', 'g')")
    swap(r"\s+([.,&\-])", r"\1")
    swap("[’`]", "'")
    swap(r"(?i)\bnat'?l(?:\.?l?)*", "Natl")
    swap(r"(?i)\bAgro\s*[-–]\s*Ind'?l\.?", "Agricultural–Industrial")
    step(collapse("n"))
    swap(r"\s*[-–—]\s*", "-")
    step(title("n"))
    for a in ABBREVIATIONS:
        swap(rf"\b{a.capitalize()}\b", a)
    for p, text in EXPANSIONS:
        swap(p, text)
    romans = " ".join(f"WHEN '{r.lower()}' THEN '{r}'" for r in ROMAN)
    step(
        "array_to_string(list_transform(string_split(n, ' '), lambda w:"
        f" CASE lower(replace(w, '.', '')) {romans} ELSE w END), ' ')"
    )
    swap(r"(?i)Memorial\.", "Memorial")
    once(*REPEATED_MEMORIAL)
    steps.append(
        f"m AS (SELECT id, trim(split_part(n, ',', 1)) AS main, CASE WHEN contains(n, ',') THEN"
        f" ', ' || trim(substring(n, position(',' IN n) + 1)) ELSE '' END AS suffix FROM s{len(steps) - 1})"
    )
    typed = r"""CASE WHEN regexp_matches(main, '(Elementary|Primary|Central|Community|High|Integrated) School$') THEN main
      WHEN regexp_matches(main, '\bElementary\b') THEN regexp_replace(main, 'Elementary$', 'Elementary School')
      WHEN regexp_matches(main, '\bHigh\b') THEN regexp_replace(main, 'High$', 'High School')
      WHEN regexp_matches(main, '\bIntegrated\b') THEN regexp_replace(main, 'Integrated$', 'Integrated School')
      ELSE main END || suffix"""
    steps.append(f"s{len(steps)} AS (SELECT id, {typed} AS n FROM m)")
    swap(r"\s*[-–]\s*", "–")
    once(*REPEATED_ANY)
    return ", ".join(steps) + f" SELECT id, trim(n) AS school_name FROM s{len(steps) - 1}"


SQL["q21_school_names"] = _with(t=inputs.SCHOOL_NAMES) + ", " + _school_name_steps()
SQL["q21_school_names_by_row"] = (
    _with(s=inputs.SCHOOLS, t="SELECT school_id AS id, school_name FROM s")
    + ", "
    + _school_name_steps().replace("SELECT id, trim(n)", "SELECT id AS school_id, trim(n)")
)
SQL["q22_street_address"] = _with(t=inputs.STREETS) + rf""", b AS (
SELECT *, regexp_replace(lower({collapse('street')}), '^[\s\-]+|[\s\-]+$', '', 'g') AS bare FROM t)
SELECT id, CASE WHEN bare = '' OR regexp_matches(bare, '^(not applicable|na|n\s*/\s*a|null|none|0)$') THEN NULL
  ELSE {title('bare', r'\p{L}\p{N}')} END AS street, lower(trim(annex)) AS annex,
  coalesce(nullif(income, '-'), '') AS income FROM b"""
SQL["q23_ids"] = _with(t=inputs.SCHOOL_IDS) + f""", c AS (SELECT *, lpad(code, 10, '0') AS ten FROM t)
SELECT k, {school_id('lis', 'beis')} AS school_id, {id_text('lis')} AS id_text, {digits('beis')} AS digits,
  ten AS code, substring(ten, 1, 2) AS region, substring(ten, 1, 5) AS province,
  substring(ten, 1, 7) || '000' AS municipality,
  CASE WHEN ten IS NULL THEN '' WHEN ten LIKE '%00000' THEN substring(ten, 1, 5)
    ELSE substring(ten, 1, 5) || '|' || substring(ten, 1, 7) END AS prefixes FROM c"""

# --- place matching -------------------------------------------------------------------

_ALIASES = ", ".join(
    f"('{k}', {'NULL' if v is None else repr(v)})" for k, v in inputs.REGION_ALIASES.items()
)


def _matching(schools: str) -> str:
    """Tables m1 to m4: region, province, municipality and barangay attached."""
    return _with(
        codes=inputs.PLACE_CODES,
        schools=schools,
        named=f"SELECT *, {place_text('name')} AS pn, {barangay_text('name')} AS bn FROM codes",
        alias=f"SELECT * FROM (VALUES {_ALIASES}) v(a, target)",
        regs=f"SELECT {region_text('name')} AS rn, min(id) AS id FROM codes WHERE geo = 'Reg' GROUP BY 1",
        m0=f"SELECT *, {region_text('region')} AS rt, {place_text('province')} AS pt, {place_text('municipality')} AS mt,"
        f" {barangay_text('barangay')} AS bt FROM schools",
        m1="SELECT m0.*, regs.id AS psgc_region_id FROM m0 LEFT JOIN alias ON rt = a"
        " JOIN regs ON rn = CASE WHEN a IS NULL THEN rt ELSE target END",
        huc="SELECT substring(id, 1, 2) AS r, pn, min(id) AS id FROM named"
        " WHERE contains(lower(city_class), 'huc') GROUP BY ALL",
        sub="SELECT substring(id, 1, 2) AS r, pn, min(id) AS id FROM named WHERE geo = 'SubMun' GROUP BY ALL",
        prov="SELECT substring(id, 1, 2) AS r, pn, min(id) AS id FROM named WHERE geo = 'Prov' GROUP BY ALL",
        pat="SELECT substring(id, 1, 2) AS r, min(id) AS id FROM named"
        " WHERE geo IN ('City', 'Mun') AND pn = 'pateros' GROUP BY ALL",
        m2="SELECT m1.*, coalesce(huc.id, sub.id, pat.id, prov.id) AS psgc_provhuc_id FROM m1"
        " LEFT JOIN huc ON huc.r = substring(psgc_region_id, 1, 2) AND huc.pn = mt"
        " LEFT JOIN sub ON sub.r = substring(psgc_region_id, 1, 2) AND sub.pn = mt"
        " LEFT JOIN prov ON prov.r = substring(psgc_region_id, 1, 2) AND prov.pn = pt"
        " LEFT JOIN pat ON pat.r = substring(psgc_region_id, 1, 2)",
        mun="SELECT substring(id, 1, 5) AS p, pn, min(id) AS id FROM named"
        " WHERE geo IN ('SubMun', 'City', 'Mun') GROUP BY ALL",
        anymun="SELECT pn, min(id) AS id FROM named WHERE geo IN ('SubMun', 'City', 'Mun') GROUP BY ALL",
        m3="SELECT m2.*, CASE WHEN psgc_provhuc_id IS NULL THEN anymun.id ELSE mun.id END AS psgc_muni_id FROM m2"
        " LEFT JOIN mun ON mun.p = substring(psgc_provhuc_id, 1, 5) AND mun.pn = mt"
        " LEFT JOIN anymun ON anymun.pn = mt",
        bgy="SELECT substring(id, 1, 7) AS m, bn, min(id) AS id FROM named WHERE geo = 'Bgy' GROUP BY ALL",
        m4="SELECT m3.*, bgy.id AS psgc_brgy_id FROM m3"
        " LEFT JOIN bgy ON bgy.m = substring(psgc_muni_id, 1, 7) AND bgy.bn = bt",
    )


_MATCHED = _matching(inputs.SCHOOLS)
_AREA = inputs.SPECIAL_AREA


def _filled(limit: str) -> str:
    return f"""area AS (SELECT trim(lower(name)) AS b, min(id) AS id FROM codes WHERE geo = 'Bgy'
  AND cc LIKE '{_AREA["old_code"]}%' AND id LIKE '{_AREA["area"][:5]}%' GROUP BY 1),
filled AS (SELECT m4.* EXCLUDE (psgc_region_id, psgc_provhuc_id, psgc_muni_id, psgc_brgy_id),
  CASE WHEN area.id IS NULL THEN psgc_region_id ELSE '{_AREA["region"]}' END AS psgc_region_id,
  CASE WHEN area.id IS NULL THEN psgc_provhuc_id ELSE '{_AREA["area"]}' END AS psgc_provhuc_id,
  coalesce(substring(area.id, 1, 7) || '000', psgc_muni_id) AS psgc_muni_id,
  coalesce(area.id, psgc_brgy_id) AS psgc_brgy_id
FROM m4 LEFT JOIN area ON b = trim(lower(barangay)) AND (psgc_muni_id IS NULL OR psgc_brgy_id IS NULL) {limit})"""


_IDS = "psgc_region_id, psgc_provhuc_id, psgc_muni_id, psgc_brgy_id"
SQL["q18_region_names"] = _MATCHED + "SELECT region, psgc_region_id, school_id, school_name FROM m1"
SQL["q24_province_huc"] = _MATCHED + "SELECT school_id, region, province, psgc_region_id, psgc_provhuc_id FROM m2"
SQL["q25_municipality_prefix"] = _MATCHED + "SELECT school_id, psgc_provhuc_id, psgc_muni_id FROM m3"
SQL["q26_barangay"] = _MATCHED + "SELECT school_id, psgc_muni_id, psgc_brgy_id FROM m4"
SQL["q27_corrections"] = _MATCHED + f""", rules AS (SELECT psgc_muni_id AS muni, upper(old) AS o, new FROM (
  {plain(inputs.CORRECTIONS)}) QUALIFY row_number() OVER (PARTITION BY psgc_muni_id, upper(old) ORDER BY position) = 1),
exact AS (SELECT substring(id, 1, 7) AS m, upper(name) AS u, min(id) AS id FROM codes WHERE geo = 'Bgy' GROUP BY ALL)
SELECT school_id, coalesce(new, barangay) AS barangay, psgc_muni_id, coalesce(psgc_brgy_id, exact.id) AS psgc_brgy_id
FROM m4 LEFT JOIN rules ON psgc_brgy_id IS NULL AND muni = psgc_muni_id AND o = upper(barangay)
LEFT JOIN exact ON m = substring(muni, 1, 7) AND u = upper(new)"""
SQL["q28_backfill"] = _MATCHED + "," + _filled(f"AND psgc_region_id = '{_AREA['region']}'") + f"""
SELECT school_id, {_IDS} FROM filled"""
SQL["q28_backfill_anywhere"] = _MATCHED + "," + _filled("") + f" SELECT school_id, {_IDS} FROM filled"

_DIVISION = """divs AS (SELECT psgc_region_id, division, CASE WHEN psgc_region_id IS NULL THEN 1 ELSE 1 + row_number()
  OVER (PARTITION BY psgc_region_id ORDER BY division NULLS FIRST) END AS division_seq
  FROM (SELECT DISTINCT psgc_region_id, division FROM {0})),
div AS (SELECT *, psgc_region_id || '-' || CAST(division_seq AS VARCHAR) AS division_id FROM divs)"""
SQL["q29_match_all"] = _matching(inputs.SCHOOL_YEARS) + ", " + _DIVISION.format("m4") + f"""
SELECT school_year, m4.division, division_id, {title('province')} AS province, m4.psgc_region_id, psgc_provhuc_id,
  psgc_muni_id, psgc_brgy_id, count(*) AS school_years
FROM m4 LEFT JOIN div ON div.psgc_region_id = m4.psgc_region_id AND div.division = m4.division GROUP BY ALL"""
SQL["q30_divisions"] = _with(d=inputs.DIVISIONS) + ", " + _DIVISION.format("d") + """
SELECT psgc_region_id, division, division_seq, division_id FROM div"""
SQL["q31_province_list"] = _MATCHED + """
SELECT p.id, p.name, r.id AS region_id FROM (SELECT id, name FROM codes WHERE geo = 'Prov'
  AND substring(id, 1, 5) IN (SELECT substring(psgc_provhuc_id, 1, 5) FROM m2)) p
LEFT JOIN (SELECT id FROM codes WHERE geo = 'Reg') r ON substring(r.id, 1, 2) = substring(p.id, 1, 2)"""
SQL["q31_region_list"] = _MATCHED + "SELECT DISTINCT psgc_region_id AS id, region AS name FROM m1"

SQL["q32_location_rules"] = _with(
    l0=inputs.LOCATIONS,
    l1="SELECT * REPLACE (CASE WHEN trim(lower(province)) = 'nation_1' AND trim(lower(municipality)) = 'building'"
    " THEN 'Baliwag City' WHEN trim(lower(province)) = 'nation_2' AND trim(lower(municipality)) = 'furniture'"
    " THEN 'AUTOMOBILE' ELSE municipality END AS municipality) FROM l0",
    l2="SELECT * REPLACE (CASE trim(lower(municipality)) WHEN 'automobile' THEN 'Auto City'"
    " WHEN 'baliwag city' THEN 'Baliwag' ELSE municipality END AS municipality) FROM l1",
    l3="SELECT * REPLACE (CASE WHEN school_id = '70' THEN 'DAVAO ORIENTAL' WHEN school_id IN ('7', '700')"
    " THEN 'DAVAO OCCIDENTAL' ELSE province END AS province) FROM l2",
    l4="SELECT * REPLACE (CASE WHEN trim(lower(region)) = 'asia' AND trim(lower(province)) = 'nation_2'"
    " THEN 'BARMM' ELSE region END AS region) FROM l3",
    l5="SELECT * REPLACE (CASE WHEN trim(lower(region)) = 'barmm' AND trim(lower(municipality)) = 'machinery'"
    " THEN 'Maguindanao' ELSE province END AS province, CASE WHEN trim(lower(region)) = 'barmm'"
    " AND trim(lower(municipality)) = 'machinery' THEN 'BARMM II' ELSE region END AS region) FROM l4",
    l6="SELECT * REPLACE (CASE WHEN trim(lower(region)) = 'barmm ii' THEN 'Upi' ELSE municipality END AS municipality) FROM l5",
    l7="SELECT * REPLACE (CASE WHEN trim(lower(province)) IN ('nation_3', 'nation_4') THEN 'NIR' ELSE region END AS region)"
    " FROM l6",
) + """SELECT school_id, region, CASE WHEN trim(lower(province)) = 'maguindanao' AND municipality IS NOT NULL THEN
  CASE WHEN trim(lower(municipality)) IN ('upi', 'household') THEN 'Maguindanao del Norte' ELSE 'Maguindanao del Sur' END
  ELSE province END AS province, municipality FROM l7"""

# --- addresses and geography --------------------------------------------------------

_HASHED = _MATCHED + """, h AS (SELECT *, '2023-2024' AS school_year, CAST('0x' || substring(md5(
  coalesce(psgc_region_id, '') || '|' || coalesce(psgc_provhuc_id, '') || '|' || coalesce(psgc_muni_id, '') || '|' ||
  coalesce(psgc_brgy_id, '')), 1, 15) AS BIGINT) AS _addr_hash FROM m4),
dim AS (SELECT *, row_number() OVER (ORDER BY psgc_region_id NULLS FIRST, psgc_provhuc_id NULLS FIRST,
  psgc_muni_id NULLS FIRST, psgc_brgy_id NULLS FIRST) AS address_id
  FROM (SELECT DISTINCT psgc_region_id, psgc_provhuc_id, psgc_muni_id, psgc_brgy_id, _addr_hash FROM h)) """
SQL["q33_address_dimension"] = _HASHED + f"SELECT {_IDS}, _addr_hash, address_id FROM dim"
SQL["q33_address_bridge"] = _HASHED + """SELECT DISTINCT _addr_hash, school_id, school_year, address_id
FROM h JOIN dim USING (_addr_hash)"""
SQL["q34_geo_fact"] = _HASHED + f""", xy AS (SELECT school_id, longitude, latitude FROM ({plain(inputs.COORDINATES)})
  QUALIFY row_number() OVER (PARTITION BY school_id ORDER BY longitude, latitude) = 1)
SELECT h.school_id, school_year, h._addr_hash, address_id, longitude, latitude,
  {', '.join('h.' + c for c in _IDS.split(', '))}
FROM h JOIN dim USING (_addr_hash) LEFT JOIN xy ON xy.school_id = h.school_id"""

# --- teachers, dropouts, quality --------------------------------------------------------

_POSITIONS = ["teacher i", "teacher ii", "sped/sned teacher iii", "master teacher i"]
SQL["q35_teachers_fact"] = _with(t=inputs.TEACHERS_WIDE) + ", l AS (" + " UNION ALL ".join(
    f"SELECT school_year, {school_id('lis', 'beis')} AS school_id, level, '{p}' AS position, {long_text(f'p{i}')} AS num FROM t"
    for i, p in enumerate(_POSITIONS)
) + ") SELECT * FROM l WHERE num <> 0 AND school_id <> '0'"

# What each label of the sheets means: grade, strand, sex.
_MEANING = {
    "2022": [("g11", "stem", "m"), ("g10", None, "f"), ("kinder", None, "m"), ("esng", None, "f"), (None,) * 3],
    "2023": [("g4", None, "f"), ("g12", None, "m"), ("kinder", None, "m"), ("esng", None, "f"), (None,) * 3],
    "2024": [("g1", None, "m"), ("kinder", None, "f"), ("esng", None, "m"), ("g12", None, "f"), (None,) * 3],
}


def _quoted(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


def _parsed(*years: str) -> str:
    sheets = [
        f"SELECT '{y}-{int(y) + 1}' AS school_year, {id_text('raw_school_id')} AS school_id, {_quoted(g)} AS grade,"
        f" {_quoted(st)} AS strand, {_quoted(sx)} AS sex, CAST(trunc({number(f'c{i}')}) AS BIGINT) AS num_dropouts,"
        f" '{y}-{int(y) + 1}-dropouts.xlsx' AS source_file, source_row, {i} AS col_pos,"
        f" '{inputs.DROPOUT_LABELS[y][i]}' AS raw_col FROM t"
        for y in years
        for i, (g, st, sx) in enumerate(_MEANING[y])
    ]
    return _with(t=inputs.DROPOUT_ROWS) + ", p AS (SELECT * FROM (" + " UNION ALL ".join(sheets) + (
        ") WHERE num_dropouts >= 1) "
    )


for _year, _name in [("2022", "q36"), ("2023", "q37"), ("2024", "q38")]:
    SQL[f"{_name}_dropouts_{_year}"] = _parsed(_year) + """
SELECT school_year, school_id, grade, strand, sex, num_dropouts, source_file, source_row FROM p
WHERE grade IS NOT NULL AND school_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY school_year, school_id, grade, strand, sex ORDER BY col_pos DESC, source_row DESC) = 1"""
SQL["q38_dropout_rejects"] = _parsed("2022", "2023", "2024") + """
SELECT school_year, CASE WHEN grade IS NULL THEN 'label' ELSE 'school id' END AS reject_reason,
  count(*) AS rows_seen, min(raw_col) AS least_label FROM p WHERE grade IS NULL OR school_id IS NULL GROUP BY ALL"""
SQL["q39_quality_metrics"] = _parsed("2022", "2023", "2024") + """, v AS (
SELECT DISTINCT school_year, school_id, grade, strand, sex FROM p WHERE grade IS NOT NULL AND school_id IS NOT NULL)
SELECT count(DISTINCT source_file) AS dropouts_files, count(*) AS dropouts_rows_melted,
  (SELECT count(*) FROM v) AS dropouts_valid_rows,
  count(*) FILTER (WHERE grade IS NULL OR school_id IS NULL) AS dropouts_invalid_rows,
  count(*) FILTER (WHERE grade IS NOT NULL AND school_id IS NOT NULL) - (SELECT count(*) FROM v)
    AS dropouts_duplicates_removed FROM p"""
_SCHOOL_COLUMNS = (
    "school_id k school_name region province municipality barangay division school_district school_management"
).split()
SQL["q39_null_counts"] = _with(s=inputs.SCHOOLS) + "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _SCHOOL_COLUMNS
) + " FROM s"
SQL["q39_duplicate_keys"] = _with(y=inputs.SCHOOL_YEARS) + """
SELECT school_id, school_year, count(*) AS rows_seen FROM y GROUP BY ALL HAVING count(*) > 1"""
SQL["q40_orphans"] = """
SELECT 'l_orderkey' AS key, -l_orderkey - 1 AS value, count(*) AS rows_seen FROM lineitem
WHERE l_orderkey % 7 = 0 GROUP BY l_orderkey"""
SQL["q40_place_orphans"] = _MATCHED + f""", u AS (UNPIVOT (SELECT {_IDS} FROM m4) ON {_IDS} INTO NAME key VALUE value)
SELECT key, value, count(*) AS rows_seen FROM u
WHERE value NOT IN (SELECT id FROM codes WHERE geo NOT IN ('SubMun', 'Reg')) GROUP BY ALL"""

# --- analysis --------------------------------------------------------------------------

SQL["q41_rows_per_school_year"] = _with(y=inputs.SCHOOL_YEARS) + """
SELECT school_year, school_id, count(*) AS num_records FROM y GROUP BY ALL"""
SQL["q41_schools_per_year"] = _with(y=inputs.SCHOOL_YEARS) + """
SELECT school_year, count(DISTINCT school_id) AS num_schools FROM y WHERE school_management = 'DepEd' GROUP BY ALL"""
SQL["q41_school_sketches"] = _with(y=inputs.SCHOOL_YEARS) + """
SELECT school_year, count(DISTINCT school_id) AS num_schools, true AS within FROM y GROUP BY ALL"""
SQL["q42_unmatched_names"] = _MATCHED + """
SELECT psgc_muni_id, barangay, count(*) AS rows_seen FROM m4 WHERE psgc_brgy_id IS NULL GROUP BY ALL"""
SQL["q43_name_search"] = _with(codes=inputs.PLACE_CODES) + """, f AS (SELECT id, name, old_names FROM codes
WHERE geo = 'Bgy' AND (contains(lower(name), 'ring') OR contains(lower(old_names), 'ring')))
SELECT 'municipality' AS scope, * FROM f WHERE id LIKE '0100101%' UNION ALL SELECT 'all', * FROM f"""
SQL["q43_sample_rows"] = "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 3"
_GRADES = "kinder esng g1 g2 g3 g4 g5 g6 g7 g8 g9 g10 jhsng g11 g12".split()
SQL["q45_seed_tables"] = _with(t=inputs.LABELS) + f"""
SELECT CAST(nullif(list_position({_GRADES}, split_part(label, '_', 1)), 0) AS BIGINT) AS grade_id,
  count(*) AS rows_seen FROM t GROUP BY 1"""
SQL["q45_region_aliases"] = _with(t=inputs.SCHOOL_IDS) + """, u AS (
SELECT rpad(substring(lpad(code, 10, '0'), 1, 2), 10, '0') AS psgc_region_id, count(*) AS schools FROM t GROUP BY 1)
SELECT u.psgc_region_id, schools, roman, location, common, CAST(NULL AS VARCHAR) AS other FROM u LEFT JOIN (VALUES
  ('0100000000', 'I', 'Ilocos Region', '1'), ('1300000000', 'IV', 'National Capital Region', 'NCR'))
  v(psgc_region_id, roman, location, common) ON u.psgc_region_id = v.psgc_region_id"""
SQL["q46_view_from_sql"] = _with(school_years=inputs.SCHOOL_YEARS) + """
SELECT school_year, region, count(DISTINCT school_id) AS num_schools FROM school_years
WHERE school_management = 'DepEd' GROUP BY ALL"""
SQL["q47_reference_province_name"] = _with(codes=inputs.PLACE_CODES) + """
SELECT id, CASE WHEN geo = 'Prov' THEN coalesce(nullif(old_names, '-'), name) ELSE name END AS name,
  nullif(old_names, '-') AS old_names, coalesce(nullif(city_class, '-'), '') AS city_class,
  CASE WHEN geo = 'Mun' THEN cc ELSE '' END AS income_class, CAST(NULL AS VARCHAR) AS urban_rural, '' AS status
FROM codes"""
SQL["q48_csv_lines"] = """
SELECT o_orderkey, o_orderkey % 10 IN (3, 7) AS rejected,
  CASE WHEN NOT rejected THEN CAST(o_orderkey AS VARCHAR) END AS school_id,
  CASE WHEN NOT rejected THEN 'Order "' || o_orderpriority || '", no. ' || o_orderkey END AS school_name,
  CASE WHEN NOT rejected THEN o_orderstatus END AS status
FROM orders"""

SQL["q49_csv_records"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS school_id,
    'Order "' || o_orderpriority || '",' || CASE WHEN o_orderkey % 5 = 0 THEN chr(10) || chr(10) WHEN o_orderkey % 3 = 0 THEN chr(10) ELSE ' ' END
        || 'no. ' || CAST(o_orderkey AS VARCHAR) AS school_name, o_orderstatus AS status
FROM orders
"""

SQL["q50_insert_or_replace"] = """
SELECT CAST(o_orderkey AS BIGINT) AS id,
    CAST(year(o_orderdate) + CASE WHEN o_orderkey % 40 = 0 THEN 1 ELSE 0 END AS INTEGER) AS year,
    CASE WHEN o_orderkey % 4 = 0 THEN lower(o_orderstatus) ELSE o_orderstatus END AS status
FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 4 = 0
"""

SQL["q51_stable_keys"] = """
WITH l AS (SELECT o_orderpriority || '-' || CAST(o_orderkey % 50 AS VARCHAR) AS label, max(o_orderkey % 50 >= 20) AS known FROM orders GROUP BY 1)
SELECT row_number() OVER (ORDER BY known DESC, label) AS id, label FROM l
"""

SQL["q52_type_misfits"] = """
WITH o AS (SELECT year(o_orderdate) AS y, count(*) FILTER (o_orderkey % 11 = 0) AS late FROM orders GROUP BY 1)
SELECT CAST(y AS VARCHAR) || '.csv' AS source_file, 'customer' AS "column", 'long' AS wanted, late AS misfits, 'n/a' AS sample
FROM o WHERE y > 1996 AND late > 0 AND (SELECT min(y) FROM o) <= 1996
UNION ALL
SELECT CAST(y AS VARCHAR) || '.csv', 'weight', 'long', late, NULL FROM o WHERE y > 1997 AND late > 0 AND (SELECT min(y) FROM o) <= 1997
"""
