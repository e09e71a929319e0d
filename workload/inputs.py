"""School-like tables derived from the test tables.

Each is one SQL text that Spark and the checking engine both understand, so the
two sides start from the same rows.  Names in braces are the test tables.  The
texts are dirtied on purpose; every row of every table is used.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def size(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Row count, from the file footers."""
    return table(spark, sf_dir, name).count()


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run an input text on the test tables it names."""
    used = {name: table(spark, sf_dir, name) for name in TABLES if f"{{{name}}}" in sql}
    sizes = {
        f"n_{name}": size(spark, sf_dir, name)
        for name in TABLES
        if f"{{n_{name}}}" in sql
    }
    return spark.sql(sql, **used, **sizes)


def plain(sql: str) -> str:
    """The input text for an engine in which the tables are views."""
    sized = re.sub(r"\{n_(\w+)\}", r"(SELECT count(*) FROM \1)", sql)
    return re.sub(r"\{(\w+)\}", r"\1", sized)


YEAR = "CAST({0} AS STRING) || '-' || CAST({0} + 1 AS STRING)"
ORDER_YEAR = YEAR.format("year(o_orderdate)")


def dirty_count(number: str, selector: str) -> str:
    """A count as people type it: grouped, padded, zero, empty or not a number."""
    return (
        f"CASE {selector} % 9 WHEN 0 THEN 'abc' WHEN 1 THEN ''"
        f" WHEN 2 THEN '1,' || lpad(CAST({number} AS STRING), 3, '0')"
        f" WHEN 3 THEN '  ' || CAST({number} AS STRING) || ' ' WHEN 4 THEN '0'"
        f" WHEN 5 THEN CAST({number} AS STRING) || '.0' WHEN 6 THEN NULL"
        f" ELSE CAST({number} AS STRING) END"
    )


# One school-year row per order line, with eight count columns.
_COUNT_LABELS = [
    "kinder_male", "kinder_female", "g1_male", "g1_female",
    "g11_stem_male", "g11_stem_female", "g12_sshs_acad_male", "g12_sshs_acad_female",
]
WIDE_ENROLLMENT = (
    "SELECT "
    + YEAR.format("(2015 + l_orderkey % 8)")
    + " AS school_year,"
    " 'enrollment_' || " + YEAR.format("(2015 + l_orderkey % 8)") + " || '.csv' AS source_file,"
    " CAST(100000 + l_suppkey AS STRING) AS school_id, "
    + ", ".join(
        dirty_count(
            f"CAST(floor(l_quantity + {i}) AS BIGINT)", f"(l_orderkey + {i} * l_linenumber)"
        )
        + f" AS {label}"
        for i, label in enumerate(_COUNT_LABELS)
    )
    + " FROM {lineitem}"
)

# One messy number per order.
DIRTY_NUMBERS = (
    "SELECT o_orderkey AS id, "
    + dirty_count("CAST(floor(o_totalprice) AS BIGINT) % 1000", "o_orderkey")
    + " AS raw, CASE o_orderkey % 6 WHEN 0 THEN '#N/A' WHEN 1 THEN '' WHEN 2 THEN '-12'"
    " WHEN 3 THEN '7.5' WHEN 4 THEN ' 8 ' ELSE CAST(o_custkey AS STRING) END AS cell"
    " FROM {orders}"
)

# A compound column label per order line.
LABELS = (
    "SELECT CASE l_linenumber % 7"
    " WHEN 0 THEN 'kinder_male' WHEN 1 THEN 'g' || CAST(l_partkey % 12 + 1 AS STRING) || '_female'"
    " WHEN 2 THEN 'g11_stem_male' WHEN 3 THEN 'g12_sshs_' || lower(l_returnflag) || '_female'"
    " WHEN 4 THEN 'total' WHEN 5 THEN '' ELSE NULL END AS label, l_quantity FROM {lineitem}"
)

FILE_NAMES = (
    "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'enrollment_' || " + ORDER_YEAR + " || '.csv'"
    " WHEN 1 THEN 'data_' || " + ORDER_YEAR + " || '_final.csv'"
    " ELSE " + ORDER_YEAR + " || '-teachers.xlsx' END AS file_name FROM {orders}"
)

# A school's row per order: the year of the order and what the school offers.
SCHOOL_OFFERS = (
    "SELECT CAST(o_custkey AS STRING) AS school_id, " + ORDER_YEAR + " AS school_year,"
    " o_orderkey % 2 = 0 AS offers_es, o_orderkey % 3 = 0 AS offers_jhs,"
    " CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 7 = 0 END AS offers_shs"
    " FROM {orders}"
)

# --- place codes: region > nation > supplier > part ---------------------------

_REGION2 = "lpad(CAST(n_regionkey + 1 AS STRING), 2, '0')"
_PROVINCE5 = _REGION2 + " || lpad(CAST(n_nationkey + 1 AS STRING), 3, '0')"
# Numbers within the place above, so that no two places share a code.
_RANKED = "(SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS s_rank FROM {supplier}) AS ranked"
_MUNI7 = _PROVINCE5 + " || lpad(CAST(s_rank AS STRING), 2, '0')"
_BGY_NUMBER = "CAST(floor(p_partkey / {n_supplier}) AS BIGINT) + 1"
_PROVINCE_NAME = (
    "CASE n_nationkey % 4 WHEN 0 THEN 'Sto. Nación ' WHEN 1 THEN 'City of Nation '"
    " WHEN 2 THEN 'Nation Sta. ' ELSE 'NATION ' END || CAST(n_nationkey AS STRING)"
)
_MUNI_NAME = (
    "CASE WHEN s_suppkey % 97 = 7 THEN 'Pateros' WHEN s_suppkey % 3 = 0"
    " THEN 'City of Bayan ' || CAST(s_suppkey % 40 AS STRING)"
    " ELSE 'Bayan ng Sto. ' || CAST(s_suppkey % 40 AS STRING) END"
)
_BGY_NAME = (
    "CASE p_partkey % 4 WHEN 0 THEN 'PEÑA ' || p_name || ' II' WHEN 1 THEN p_name || ' (Pob.)'"
    " WHEN 2 THEN 'Brgy. ' || p_name || ' ' || CAST(p_size AS STRING)"
    " ELSE p_name || ' ' || p_brand END"
)
PLACE_CODES = f"""
SELECT lpad(CAST(r_regionkey + 1 AS STRING), 2, '0') || '00000000' AS id,
       'Region ' || r_name || ' (' || r_name || ')' AS name, 'Reg' AS geo,
       CAST(NULL AS STRING) AS old_names, CAST(NULL AS STRING) AS city_class, '' AS cc
FROM {{region}}
UNION ALL
SELECT {_PROVINCE5} || '00000', {_PROVINCE_NAME}, 'Prov',
       CASE n_nationkey % 3 WHEN 0 THEN '-' WHEN 1 THEN 'Former ' || n_name ELSE NULL END, '-',
       CAST(n_nationkey AS STRING)
FROM {{nation}}
UNION ALL
SELECT {_MUNI7} || '000', {_MUNI_NAME},
       CASE WHEN s_suppkey % 13 = 0 THEN 'SubMun' WHEN s_suppkey % 3 = 0 THEN 'City' ELSE 'Mun' END,
       NULL, CASE WHEN s_suppkey % 11 = 0 THEN 'HUC' WHEN s_suppkey % 11 = 1 THEN 'CC' ELSE '' END,
       CAST(s_suppkey AS STRING)
FROM {_RANKED} JOIN {{nation}} ON s_nationkey = n_nationkey
UNION ALL
SELECT {_MUNI7} || lpad(CAST({_BGY_NUMBER} AS STRING), 3, '0'),
       {_BGY_NAME}, 'Bgy', CASE WHEN p_partkey % 10 = 0 THEN 'Old ' || p_name ELSE NULL END, NULL,
       CASE WHEN n_regionkey = 2 THEN '1247' ELSE '01' END || CAST(p_partkey AS STRING)
FROM {{part}} JOIN {_RANKED} ON p_partkey % {{n_supplier}} = s_suppkey
JOIN {{nation}} ON s_nationkey = n_nationkey
"""

# Normalized region text to normalized official name; null drops the rows.
REGION_ALIASES = {
    "reg 1": "region africa",
    "reg 2": "region america",
    "reg 3": "region asia",
    "reg 4": "region europe",
    "reg 5": "region middle east",
    "pso": None,
}

# One school per customer, with the address texts of one barangay, dirtied.
SCHOOLS = f"""
SELECT CAST(c_custkey AS STRING) AS school_id, c_custkey AS k,
       CASE c_custkey % 4 WHEN 0 THEN 'SAN ISIDRO ES' WHEN 1 THEN 'mabini nat''l. hs ' || CAST(c_custkey % 50 AS STRING)
            WHEN 2 THEN 'Rizal Elem. School, annex ' || c_mktsegment ELSE c_mktsegment || ' High' END AS school_name,
       CASE WHEN c_custkey % 35 = 4 THEN 'PSO' WHEN c_custkey % 5 = 1 THEN lower('Region ' || r_name) || ' (old)'
            WHEN c_custkey % 5 = 2 THEN 'Reg. ' || CAST(r_regionkey + 1 AS STRING)
            WHEN c_custkey % 5 = 3 THEN '  REGION-' || r_name ELSE 'Region ' || r_name END AS region,
       CASE WHEN c_custkey % 31 = 5 THEN NULL WHEN c_custkey % 29 = 3 THEN 'Nowhere'
            WHEN c_custkey % 3 = 1 THEN upper({_PROVINCE_NAME}) || ' (2nd District)'
            ELSE ' ' || {_PROVINCE_NAME} END AS province,
       CASE WHEN c_custkey % 37 = 5 THEN NULL WHEN c_custkey % 3 = 1 THEN upper({_MUNI_NAME})
            WHEN c_custkey % 3 = 2 THEN {_MUNI_NAME} || '  (Capital)' ELSE {_MUNI_NAME} END AS municipality,
       CASE WHEN c_custkey % 41 = 6 THEN NULL WHEN c_custkey % 43 = 6 THEN 'Old ' || p_name
            WHEN c_custkey % 4 = 1 THEN replace({_BGY_NAME}, 'Ñ', 'Ã‘')
            WHEN c_custkey % 4 = 2 THEN lower({_BGY_NAME}) ELSE {_BGY_NAME} END AS barangay,
       c_mktsegment || ' Division' AS division, 'District ' || CAST(c_custkey % 9 AS STRING) AS school_district,
       CASE WHEN c_custkey % 2 = 0 THEN 'DepEd' ELSE 'Private' END AS school_management
FROM {{customer}}
JOIN {{part}} ON c_custkey % {{n_part}} = p_partkey
JOIN {{supplier}} ON p_partkey % {{n_supplier}} = s_suppkey
JOIN {{nation}} ON s_nationkey = n_nationkey
JOIN {{region}} ON n_regionkey = r_regionkey
"""

# The schools once per order, with the school year of the order.
SCHOOL_YEARS = (
    "SELECT s.*, " + ORDER_YEAR + " AS school_year FROM {orders} JOIN (" + SCHOOLS + ") s ON o_custkey = s.k"
)

STREETS = (
    "SELECT c_custkey AS id, CASE c_custkey % 11 WHEN 0 THEN 'N/A' WHEN 1 THEN '-' WHEN 2 THEN '--PUROK 2ND st.--'"
    " WHEN 3 THEN ' none ' WHEN 4 THEN 'NULL' WHEN 5 THEN c_name || ' - Nabua-Iriga  Road' WHEN 6 THEN '0'"
    " WHEN 7 THEN NULL WHEN 8 THEN 'not applicable' WHEN 9 THEN 'n / a' ELSE lower(c_mktsegment) || ' 3RD ave. o''neil' END"
    " AS street, CASE c_custkey % 3 WHEN 0 THEN ' Standalone  ' WHEN 1 THEN 'ANNEX' ELSE NULL END AS annex,"
    " CASE c_custkey % 4 WHEN 0 THEN '-' WHEN 1 THEN NULL ELSE c_mktsegment END AS income FROM {customer}"
)

SCHOOL_IDS = (
    "SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN CAST(400000 + c_custkey AS STRING) || '.0'"
    " WHEN 1 THEN NULL WHEN 2 THEN ' S-' || CAST(c_custkey AS STRING) ELSE '' END AS lis,"
    " CASE c_custkey % 5 WHEN 0 THEN NULL ELSE 'B' || CAST(c_custkey + 5000 AS STRING) END AS beis,"
    " CASE c_custkey % 3 WHEN 0 THEN CAST(128000000 + c_custkey AS STRING)"
    " WHEN 1 THEN CAST(1300000000 + c_custkey * 1000 AS STRING) ELSE NULL END AS code FROM {customer}"
)

# A teacher sheet: one row per supplier, id columns and positions.
TEACHER_POSITIONS = ["Teacher I", "Teacher II ", "sped teacher iii", "Master Teacher I"]
TEACHERS_WIDE = (
    "SELECT " + YEAR.format("(2020 + s_suppkey % 3)") + " AS school_year,"
    " CASE s_suppkey % 3 WHEN 0 THEN 'es' WHEN 1 THEN 'jhs' ELSE 'shs' END AS level,"
    " CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST(400000 + s_suppkey AS STRING) || '.0'"
    " ELSE CAST(400000 + s_suppkey AS STRING) END AS lis,"
    " CASE s_suppkey % 8 WHEN 0 THEN NULL ELSE CAST(500000 + s_suppkey AS STRING) END AS beis, "
    + ", ".join(
        f"CASE (s_suppkey + {i}) % 6 WHEN 0 THEN NULL WHEN 1 THEN '0' WHEN 2 THEN CAST(s_suppkey % 30 + {i} AS STRING) || '.0'"
        f" WHEN 3 THEN '2.5' ELSE CAST(s_suppkey % 30 + {i} AS STRING) END AS p{i}"
        for i in range(len(TEACHER_POSITIONS))
    )
    + " FROM {supplier}"
)

# Dropout sheets: one row per order, four count columns under each year's labels.
DROPOUT_LABELS = {
    "2022": ["G11 ACAD - STEM Male Dropout", "G10 Female Dropout", "K Male Dropout", "NG Elem Female Dropout", "Total"],
    "2023": ["Grade 4 Female", "Grade 12 Male", "Kindergarten Male", "Non-Graded Female", "Grade 1 Male Dropout"],
    "2024": ["dropout_g1_male", "dropout_k_female", "dropout_ng_male", "DROPOUT_G12_FEMALE", "dropout_total"],
}
DROPOUT_ROWS = (
    "SELECT CASE o_custkey % 10 WHEN 0 THEN ' ' WHEN 1 THEN CAST(o_custkey AS STRING) || '.0'"
    " ELSE CAST(o_custkey AS STRING) END AS raw_school_id, o_orderkey + 10 AS source_row, "
    + ", ".join(
        f"CASE (o_orderkey + {i}) % 7 WHEN 0 THEN NULL WHEN 1 THEN '0' WHEN 2 THEN '1,00' || CAST(o_custkey % 10 AS STRING)"
        f" WHEN 3 THEN '0.5' WHEN 4 THEN 'x' ELSE CAST(o_orderkey % 20 + 1 AS STRING) END AS c{i}"
        for i in range(5)
    )
    + " FROM {orders}"
)

# Names built of everything the school-name rules know.
SCHOOL_NAMES = (
    "SELECT o_orderkey AS id, "
    "CASE o_orderkey % 8 WHEN 0 THEN 'SAN ' WHEN 1 THEN 'pob. ii ' WHEN 2 THEN 'Rizal nat''l. ' WHEN 3 THEN 'AGRO-IND''L '"
    " WHEN 4 THEN 'bagong   silang - ' WHEN 5 THEN 'luna memorial. ' WHEN 6 THEN 'O''neil ' ELSE 'voc''l .' END"
    " || lower(substring(o_orderpriority, 3, 20)) || ' ' ||"
    " CASE o_orderkey % 13 WHEN 0 THEN 'ES' WHEN 1 THEN 'elem. school' WHEN 2 THEN 'nhs' WHEN 3 THEN 'High'"
    " WHEN 4 THEN 'MHS Memorial High School' WHEN 5 THEN 'Elementary' WHEN 6 THEN 'Integrated, annex viii'"
    " WHEN 7 THEN 'Elem ES' WHEN 8 THEN 'IS..' WHEN 9 THEN 'c/s , main' WHEN 10 THEN 'elementary high'"
    " WHEN 11 THEN 'CES-SPED' ELSE 'jhs & shs' END AS school_name FROM {orders}"
)

CORRECTIONS = f"""
SELECT {_MUNI7} || '000' AS psgc_muni_id, 'old ' || p_name AS old, {_BGY_NAME} AS new, p_partkey AS position
FROM {{part}} JOIN {_RANKED} ON p_partkey % {{n_supplier}} = s_suppkey
JOIN {{nation}} ON s_nationkey = n_nationkey
"""

# The province that plays the special area: nation 2 of region 3.
SPECIAL_AREA = {"old_code": "1247", "area": "0300300000", "region": "0300000000"}

DIVISIONS = (
    "SELECT CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE "
    + _REGION2
    + " || '00000000' END AS psgc_region_id,"
    " CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE c_mktsegment || ' ' || n_name END AS division"
    " FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"
)

# Location rules in the shape of a rule file, and rows that meet them.
LOCATION_RULES = {
    "provincial_muni_fixes": [
        {"province": "nation_1", "municipality": "building", "corrected": "First"},
        {"province": "Nation_1", "municipality": "building", "corrected": "Baliwag City"},
        {"province": "nation_2", "municipality": "furniture", "corrected": "AUTOMOBILE"},
    ],
    "municipality_fixes": {"Automobile": "Auto City", "baliwag city": "Baliwag"},
    "province_fixes_by_school_id": {"Davao Occidental": [7, 70, 700], "Davao Oriental": [70]},
    "special_fixes": [
        {"when": {"region": "asia", "province": "nation_2"}, "set": {"region": "BARMM"}},
        {"when": {"region": "barmm", "municipality": "machinery"}, "set": {"province": "Maguindanao", "region": "BARMM II"}},
        {"when": {"region": "barmm ii"}, "set": {"municipality": "Upi"}},
    ],
    "nir_rule": {"provinces": ["NATION_3", "nation_4"], "set_region": "NIR"},
    "maguindanao_split": {"norte_municipalities": ["Upi", "household"], "sur_is_default": True},
}
LOCATIONS = (
    "SELECT CAST(c_custkey AS STRING) AS school_id, CASE c_custkey % 2 WHEN 0 THEN ' ' || r_name ELSE lower(r_name) END AS region,"
    " CASE WHEN c_custkey % 10 = 9 THEN 'MAGUINDANAO ' WHEN c_custkey % 47 = 0 THEN NULL ELSE n_name END AS province,"
    " CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment || ' ' END AS municipality"
    " FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"
)

COORDINATES = (
    "SELECT CAST(c_custkey AS STRING) AS school_id, CASE WHEN c_custkey % 4 <> 0 THEN 100 + c_acctbal / 1000 END AS longitude,"
    " CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal / 500 END AS latitude FROM {customer}"
    " UNION ALL SELECT CAST(c_custkey AS STRING), CASE WHEN c_custkey % 4 <> 0 THEN 200.0 END,"
    " CASE WHEN c_custkey % 4 <> 0 THEN 1.0 END FROM {customer}"
)

VIEW_FILE = str(Path(__file__).with_name("deped_schools.sql"))
