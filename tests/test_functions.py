"""Column expressions against fixed cases and against plain Python."""

import hashlib
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from schoolatlas.functions import counts, labels, places, school_names, text


def apply(spark, expression, values):
    df = spark.createDataFrame(
        list(enumerate(values)), "i int, v string"
    )
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("expression", "cases"),
    [
        (
            places.region_name,
            {
                "Region I (Ilocos Region)": "region i",
                "NATIONAL CAPITAL REGION": "national capital region",
                "Region XIII": "region xiii",
                "Region IV-A": "region iv a",
                None: None,
            },
        ),
        (
            places.trailing_roman,
            {
                "District I": "District 1",
                "Region II": "Region 2",
                "Division X.": "Division 10",
                "poblacion viii": "poblacion 8",
                "No roman here": "No roman here",
                "Mix": "Mix",
                None: None,
            },
        ),
        (
            places.place_name,
            {
                "Sto. Tomas": "santo tomas",
                "Sta. Maria": "santa maria",
                "City of Manila": "manila city",
                "Quezon City (2nd District)": "quezon city",
                "City  of  Manila": "city of manila",
                "  PEÑARANDA  ": "penaranda",
                "Barangay ½": "barangay 12",
                "ﬁnca": "finca",
                " ": "",
                None: None,
            },
        ),
        (places.repair_enye, {"DASMARIÃ‘AS": "DASMARIÑAS", None: None}),
        (
            counts.whole_count,
            {
                "1,200": 1200,
                "  50 ": 50,
                "abc": None,
                None: None,
                "0": 0,
                "-3": None,
                "12.0": None,
                "": None,
                " 7": 7,
            },
        ),
        (
            counts.count_or_zero,
            {"1,200": 1200, " 50 ": 50, "abc": 0, "12.0": 0, "": 0, None: None, "007": 7},
        ),
        (
            counts.lenient_long,
            {" 50 ": 50, "12.0": 12, "12.5": None, "x": None, "-4": -4, None: None},
        ),
        (
            counts.truncated_number,
            {"1,200": 1200, "3.9": 3, "NaN": None, " ": None, "x": None, "0.4": 0},
        ),
        (counts.lenient_double, {"1.5": 1.5, " 2 ": 2.0, "x": None, "": None}),
        (counts.cell_text, {"#N/A": None, "": None, "a": "a", None: None}),
        (counts.header_text, {" a ": "a", "  ": None, None: None}),
        (counts.digits_only, {"a1-b2": "12", None: "", "x": ""}),
        (
            counts.school_id_text,
            {" 400001 ": "400001", "400001.0": "400001", " ": None, None: None},
        ),
        (
            counts.place_code,
            {"128010010": "0128010010", "1380100001": "1380100001", "x": None},
        ),
        (
            counts.allowed_prefixes,
            {
                "1374000000": ["13740"],
                "1374040000": ["13740", "1374040"],
                "1374040123": ["13740", "1374040"],
                None: [],
                "x": [],
            },
        ),
        (counts.province_scope, {"1374040123": "13740", "128000000": "01280", None: None}),
        (
            text.title_words,
            {
                "O'NEIL-SANTOS 2ND": "O'Neil-Santos 2Nd",
                "ñora ÁVILA": "Ñora Ávila",
                "a.b  c": "A.B  C",
                None: None,
                "": "",
            },
        ),
        (
            text.street_address,
            {
                "--PUROK 2ND st.--": "Purok 2nd St.",
                "N/A": None,
                "n / a": None,
                "-": None,
                " - none - ": None,
                "0": None,
                "NULL": None,
                "not applicable": None,
                "Nabua-Iriga  Road": "Nabua-Iriga Road",
                None: None,
            },
        ),
        (text.collapse_spaces, {" a \t b ": "a b", None: None}),
        (
            school_names.clean_school_name,
            {
                "SAN JOSE ES": "San Jose Elementary School",
                "Bagong Silang Elem. School": "Bagong Silang Elementary School",
                "mabini nat'l. high school": "Mabini National High School",
                "Rizal Nat’l HS": "Rizal National High School",
                "Agro-Ind'l School": "Agricultural–Industrial School",
                "quezon memorial. elementary": "Quezon Memorial Elementary School",
                "Luna High, annex a": "Luna High School, Annex A",
                "Del Pilar Integrated": "Del Pilar Integrated School",
                "Mem MHS Memorial High School": "Memorial Memorial High School",
                "pob. ii es": "Pob. II Elementary School",
                "san isidro - north  cs": "San Isidro–North Central School",
                "Elementary Foo High": "Elementary Foo High",
                None: "",
            },
        ),
        (
            labels.teacher_position,
            {"sped teacher iii": "sped/sned teacher iii", "teacher i": "teacher i"},
        ),
    ],
)
def test_fixed_cases(spark, expression, cases):
    assert apply(spark, expression, cases) == list(cases.values())


@pytest.mark.parametrize(
    ("layout", "cases"),
    [
        (
            "2022",
            {
                "G11 ACAD Male Dropout": ("g11", "acad", "m"),
                "G11 ACAD - STEM Female Dropout": ("g11", "stem", "f"),
                "G12 TVL Male Dropout": ("g12", "tvl", "m"),
                "G10 Female Dropout": ("g10", None, "f"),
                "G1 Male Dropout": ("g1", None, "m"),
                "G11 Male Dropout": ("g11", None, "m"),
                "K Female Dropout": ("kinder", None, "f"),
                "NG Elem Male Dropout": ("esng", None, "m"),
                "NG Secondary Male Dropout": ("jhsng", None, "m"),
                "Total": None,
            },
        ),
        (
            "2023",
            {
                "Grade 4 Female": ("g4", None, "f"),
                "Grade 12 Male": ("g12", None, "m"),
                "Kindergarten Female": ("kinder", None, "f"),
                "Non-Graded Male": ("esng", None, "m"),
                "Grade 1 Male Dropout": None,
            },
        ),
        (
            "2024",
            {
                "dropout_g1_male": ("g1", None, "m"),
                "DROPOUT_K_FEMALE": ("kinder", None, "f"),
                "dropout_ng_male": ("esng", None, "m"),
                "dropout_total": None,
            },
        ),
    ],
)
def test_dropout_labels(spark, layout, cases):
    for style in (layout, F.lit(layout)):
        found = apply(spark, lambda c: labels.dropout_label(c, style), cases)
        assert [r and tuple(r) for r in found] == list(cases.values())


def test_unknown_dropout_layout(spark):
    with pytest.raises(ValueError):
        labels.dropout_label(F.col("v"), "2030")
    with pytest.raises(PySparkException):
        apply(spark, lambda c: labels.dropout_label(c, F.lit("2030")), ["x"])


def test_split_label(spark):
    cases = {
        "kinder_male": ("kinder", None, "male"),
        "g11_stem_male": ("g11", "stem", "male"),
        "g12_sshs_acad_male": ("g12", "sshs_acad", "male"),
        "g1": ("g1", None, None),
        "": (None, None, None),
        None: (None, None, None),
    }
    found = apply(spark, labels.split_label, cases)
    assert [tuple(r) for r in found] == list(cases.values())


def test_school_year_of_file_name(spark):
    names = ["enrollment_2023-2024.csv", "data_2017-2018_final.csv"]
    assert apply(spark, counts.school_year, names) == ["2023-2024", "2017-2018"]
    with pytest.raises(PySparkException):
        apply(spark, counts.school_year, ["no_year_here.csv"])


def test_school_id_from_two_columns(spark):
    rows = [("400001.0", "1"), (None, "b-42"), (None, None), ("x", "7")]
    df = spark.createDataFrame(rows, "a string, b string")
    ids = [r[0] for r in df.select(counts.school_id_from(F.col("a"), F.col("b"))).collect()]
    assert ids == ["400001", "42", "0", "0"]


def test_address_hash_keeps_null_positions(spark):
    rows = [("a", None, "b", "c"), ("a", "b", None, "c"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    found = [r[0] for r in df.select(counts.address_hash(*[F.col(c) for c in "abcd"])).collect()]
    expected = [
        int(hashlib.md5("|".join(v or "" for v in row).encode()).hexdigest()[:15], 16)
        for row in rows
    ]
    assert found == expected


LETTERS = st.text(
    st.sampled_from("abczIVX ñÑéÁü.'-–,()0159ÃÅØßﬁ½№ⅷ "), max_size=24
)


@settings(max_examples=8, deadline=None)
@given(st.lists(LETTERS, min_size=120, max_size=120))
def test_accents_match_unicode_decomposition(spark, values):
    expected = [
        unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode() for v in values
    ]
    assert apply(spark, places.ascii_letters, values) == expected


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.text(st.sampled_from("abz ÑñéÁ.'-2,"), max_size=24), min_size=120, max_size=120
    )
)
def test_title_matches_python(spark, values):
    assert apply(spark, text.title_words, values) == [v.title() for v in values]


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.lists(
            st.sampled_from(["san", "jose", "ES", "Elementary", "High", "Integrated", ",", "II", "Natl", "Memorial", "School"]),
            max_size=6,
        ).map(" ".join),
        min_size=120,
        max_size=120,
    )
)
def test_school_names_are_stable(spark, values):
    once = apply(spark, school_names.clean_school_name, values)
    assert all(not re.search(r"\s{2,}|^\s|\s$", n) for n in once)
    types = ("Elementary", "High", "Integrated")
    for name in once:
        before = name.split(",")[0]
        ends = [t for t in types if before == t or before.endswith(" " + t)]
        # A name may end in a bare type only when an earlier type word rules it out.
        if ends:
            rank = types.index(ends[0])
            assert any(t in before.split() for t in types[:rank])


def test_grade_numbers_end_where_digits_end(spark):
    rows = spark.createDataFrame([("Grade 13 Male",), ("Grade 12 Male",), ("Grade 1 Female",)], "label string")
    found = [r["p"] and r["p"]["grade"] for r in rows.select(labels.dropout_label(F.col("label"), "2023").alias("p")).collect()]
    assert found == [None, "g12", "g1"]


def test_long_codes_are_no_codes(spark):
    rows = spark.createDataFrame([("13740400001",), ("1374040000",), ("00000001374040000",)], "c string")
    found = rows.select(counts.place_code(F.col("c")).alias("a"), counts.province_scope(F.col("c")).alias("b")).collect()
    assert found[0]["a"] is None and found[0]["b"] is None
    assert found[1]["a"] == found[2]["a"] == "1374040000" and found[1]["b"] == found[2]["b"] is not None
