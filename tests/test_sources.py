"""Readers on files written here."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from schoolatlas.operators.quality import require_contract
from schoolatlas.contracts import CONTRACTS
from schoolatlas.plans.dropouts import dropout_tables
from schoolatlas.plans.geography import read_place_codes
from schoolatlas.plans.teachers import teacher_tables
from schoolatlas.sources import records, rules
from schoolatlas.sources.csv_folder import csv_headers, read_coordinates, read_yearly_csvs, rejected_lines
from schoolatlas.sources.layouts import DROPOUT_LAYOUTS
from schoolatlas.sources.workbook import column_index, column_indexes, read_workbooks
from tests.xlsx import write_workbook


def sheet(width, rows):
    """Rows given as {row: {col: value}}, as lists."""
    out = []
    for r in range(max(rows) + 1):
        line = [None] * width
        for c, v in rows.get(r, {}).items():
            line[c] = v
        out.append(line)
    return out


def test_column_ranges():
    assert column_index("A") == 0
    assert column_index(" ad ") == 29
    assert column_indexes("E,K:M,,B") == [1, 4, 10, 11, 12]
    assert column_indexes(None) is None
    with pytest.raises(ValueError):
        column_index("A1")


def test_workbook_rows(spark, tmp_path):
    write_workbook(
        tmp_path / "a.xlsx",
        {
            "One": [["x", None, "yy"], [None], [1, 2.0, 2.5], [True, "#N/A", "a<b"]],
            "Other": [["no"]],
        },
    )
    rows = read_workbooks(spark, str(tmp_path), ["One"]).orderBy("row_idx").collect()
    assert [(r["source_file"], r["sheet"], r["row_idx"], r["cells"]) for r in rows] == [
        ("a.xlsx", "One", 0, ["x", None, "yy"]),
        ("a.xlsx", "One", 2, ["1", "2", "2.5"]),
        ("a.xlsx", "One", 3, ["true", "#N/A", "a<b"]),
    ]
    assert read_workbooks(spark, str(tmp_path)).count() == 4


PLACE_HEADER = [
    "10-digit PSGC", "Name", "Correspondence Code", "Geographic Level", "Old names",
    "City Class", "Income\nClassification", "Urban / Rural", "2024 Population",
    "Unnamed: 9", "Status",
]


def test_place_codes(spark, tmp_path):
    rows = [
        [130000000, "Region X", 1.0, "Reg", None, None, None, None, 1000000.0, "skip", None],
        [130010000, "New Province", 130.0, "Prov", "Old Province", "-", "1st*", None, 200000.0, None, "x"],
        [130020000, "Kept Province", 131.0, "Prov", "-", "CC", "-", "U", 2.0, None, None],
        [1380100001, "Libtong", 12801001.0, "Bgy", "Former", None, None, "R", 9, None, None],
    ]
    write_workbook(tmp_path / "p.xlsx", {"Notes": [["a"]], "PSGC": [PLACE_HEADER, *rows]})
    codes = read_place_codes(spark, str(tmp_path / "p.xlsx")).orderBy("id")
    assert codes.columns == CONTRACTS["psgc"].schema.names
    found = [(r["id"], r["name"], r["income_class"], r["city_class"], r["2024_pop"]) for r in codes.collect()]
    assert found == [
        ("0130000000", "Region X", "", "", "1000000"),
        ("0130010000", "Old Province", "1st", "", "200000"),
        ("0130020000", "Kept Province", "", "CC", "2"),
        ("1380100001", "Libtong", "", "", "9"),
    ]
    require_contract(codes, CONTRACTS["psgc"], dtypes=True, keys=True)


def test_missing_place_sheet(spark, tmp_path):
    write_workbook(tmp_path / "p.xlsx", {"Notes": [["a"]]})
    with pytest.raises(ValueError, match="PSGC"):
        read_place_codes(spark, str(tmp_path / "p.xlsx"))


def teacher_sheets():
    header = {3: "Lis School ID", 4: " Beis School ID"} | {18 + i: f"Role {i}" for i in range(3)}
    header[18] = "SPED Teacher  III"
    return {
        name: sheet(
            34,
            {
                5: header,
                6: {3: 400001, 4: 405001, 18: 4, 19: "5.0", 20: 0},
                7: {3: None, 4: 405002, 18: "#N/A", 19: 7},
                8: {19: 3},
            },
        )
        for name in ("ES DB", "JHS DB", "SHS DB")
    }


def test_teachers(spark, tmp_path):
    write_workbook(tmp_path / "2022-2023-teachers.xlsx", teacher_sheets())
    tables = teacher_tables(spark, str(tmp_path))
    rows = {tuple(r) for r in tables["teachers"].where("level = 'es'").collect()}
    assert rows == {
        ("2022-2023", "400001", "es", "sped/sned teacher iii", 4),
        ("2022-2023", "400001", "es", "role 1", 5),
        ("2022-2023", "405002", "es", "role 1", 7),
    }
    levels = {r[0] for r in tables["teachers"].select("level").distinct().collect()}
    assert levels == {"es", "jhs", "shs"}
    assert tables["teacher_rejects"].where("level = 'es'").count() == 1
    require_contract(tables["teachers"], CONTRACTS["teachers"], dtypes=True, keys=True)


def test_teacher_errors(spark, tmp_path):
    with pytest.raises((ValueError, AnalysisException)):
        teacher_tables(spark, str(tmp_path))
    short = teacher_sheets()
    del short["SHS DB"]
    write_workbook(tmp_path / "2022-2023-teachers.xlsx", short)
    with pytest.raises(ValueError, match="SHS DB is missing"):
        teacher_tables(spark, str(tmp_path))
    write_workbook(tmp_path / "2022-2023-teachers.xlsx", teacher_sheets())
    write_workbook(tmp_path / "1999-2000-teachers.xlsx", teacher_sheets())
    with pytest.raises(ValueError, match="no layout"):
        teacher_tables(spark, str(tmp_path))


def dropout_books(folder):
    write_workbook(
        folder / "2022-2023-dropouts.xlsx",
        {"DROPOUT DB": sheet(62, {
            6: {4: "ID", 10: "G11 ACAD Male Dropout", 11: "G10 Female Dropout", 12: "Total", 29: "K Male Dropout"},
            7: {4: 420001, 10: 1, 11: "1,200", 12: 9},
            8: {4: 420001, 10: 3, 29: 0.5},
            9: {4: None, 10: 2},
        })},
    )
    write_workbook(
        folder / "2023-2024-dropouts.xlsx",
        {"DB DROPOUT": sheet(46, {
            3: {4: "school", 10: "Grade 1", 12: "Kindergarten"},
            4: {10: "Male", 11: "Female", 12: "Female", 13: "Male"},
            7: {4: 420002.0, 10: 1, 11: 2, 12: 4, 13: "x"},
        })},
    )
    write_workbook(
        folder / "2024-2025-dropouts.xlsx",
        {"DATABASE": sheet(46, {
            8: {2: "BEIS School ID", 10: "dropout_g1_male", 11: "dropout_g1_male", 12: "dropout_ng_female"},
            9: {2: 420003, 10: 1, 11: 5, 12: "#N/A"},
        })},
    )


def test_dropouts(spark, tmp_path):
    dropout_books(tmp_path)
    tables = dropout_tables(spark, str(tmp_path))
    facts = tables["dropouts"]
    found = {tuple(r) for r in facts.drop("ingested_at", "source_file").collect()}
    # Columns: year, school, grade, strand, sex, count, Excel row.  Of two rows
    # with one key the later one stays; a repeated label is the later column.
    assert found == {
        ("2022-2023", "420001", "g11", "acad", "m", 3, 9),
        ("2022-2023", "420001", "g10", None, "f", 1200, 8),
        ("2023-2024", "420002", "g1", None, "m", 1, 8),
        ("2023-2024", "420002", "g1", None, "f", 2, 8),
        ("2023-2024", "420002", "kinder", None, "f", 4, 8),
        ("2024-2025", "420003", "g1", None, "m", 5, 10),
    }
    reasons = {(r["raw_col"], r["reject_reason"]) for r in tables["dropout_rejects"].collect()}
    assert reasons == {("Total", "label"), ("G11 ACAD Male Dropout", "school id")}
    metrics = tables["dropout_metrics"].first().asDict()
    assert metrics == {
        "dropouts_files": 3,
        "dropouts_rows_melted": 10,
        "dropouts_valid_rows": 6,
        "dropouts_invalid_rows": 2,
        "dropouts_duplicates_removed": 2,
    }
    require_contract(facts, CONTRACTS["dropouts"], dtypes=True, keys=True)
    assert facts.select("ingested_at").distinct().count() == 1


def test_missing_dropout_file(spark, tmp_path):
    dropout_books(tmp_path)
    with pytest.raises((AnalysisException, PySparkException)):
        dropout_tables(spark, str(tmp_path), [*DROPOUT_LAYOUTS, DROPOUT_LAYOUTS[0].__class__("2030-2031", "X", "A", 0, 1, 1)])


def test_yearly_csvs(spark, tmp_path):
    (tmp_path / "enrollment_2023-2024.csv").write_text("school_id,g1_male\n1,5\n")
    (tmp_path / "enrollment_2024-2025.csv").write_text("school_id,g1_male\n2,\"1,000\"\n")
    (tmp_path / "enrollment_2025-2026.csv").write_text("school_id,g2_male,x\n3,6,y\n")
    (tmp_path / "notes.txt").write_text("no\n")
    frames = read_yearly_csvs(spark, str(tmp_path))
    assert len(frames) == 2
    assert {tuple(r) for r in frames[0].collect()} == {
        ("2023-2024", "enrollment_2023-2024.csv", "1", "5"),
        ("2024-2025", "enrollment_2024-2025.csv", "2", "1,000"),
    }
    latest = read_yearly_csvs(spark, str(tmp_path), latest_only=True)
    assert [r["school_id"] for r in latest[0].collect()] == ["3"]


def test_csv_quotes_and_ragged_lines(spark, tmp_path):
    (tmp_path / "enrollment_2023-2024.csv").write_text(
        'school_id,school_name,g1_male\n'
        '1,"Gov ""Bong"" ES, Annex",5\n'
        '2,plain,6,extra\n'
        '3,short\n'
        '4,"line one\nline two",7\n'
        '5,"",8\n'
    )
    (tmp_path / "enrollment_2024-2025.csv").write_text("\ufeffschool_id,g1_male\n6,9\n")
    first, second = read_yearly_csvs(spark, str(tmp_path))
    assert {tuple(r)[2:] for r in first.collect()} == {
        ("1", 'Gov "Bong" ES, Annex', "5"), ("4", "line one\nline two", "7"), ("5", None, "8"),
    }
    assert first.select("g1_male").count() == 3  # however few columns are read
    assert [tuple(r)[2:] for r in second.collect()] == [("6", "9")]
    bad = [r.line for r in rejected_lines(spark, str(tmp_path)).collect()]
    assert sorted(bad) == ["2,plain,6,extra", "3,short"]


def made_records(n, seed):
    """Rows of three fields with commas, quotes and line breaks, some of them longer than a block."""
    rng = random.Random(seed)
    pieces = ["a", "b", ",", '"', "\n", "\n\n", " ", "é", '""', ',"', '",', "x" * 30]
    text = lambda most: "".join(rng.choice(pieces) for _ in range(rng.randrange(most)))
    return [(str(i), text(60 if i % 17 == 3 else 6), text(4)) for i in range(n)]


@pytest.mark.parametrize("block", [48, 200, 1 << 20])
def test_records_with_line_breaks_in_any_split(spark, tmp_path, block):
    expected = set()
    for year, seed in (("2023-2024", 1), ("2024-2025", 2)):
        rows = made_records(60, seed)
        with open(tmp_path / f"enrollment_{year}.csv", "w", newline="") as file:
            writer = csv.writer(file, lineterminator="\r\n" if seed == 2 else "\n")
            writer.writerow(["school_id", "school name", 'with "a\nbreak"'])
            writer.writerows(rows)
        expected |= {(year, *(v or None for v in row)) for row in rows}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        (frame,) = read_yearly_csvs(spark, str(tmp_path))
        assert frame.columns == ["school_year", "source_file", "school_id", "school name", 'with "a\nbreak"']
        found = [(r[0], *r[2:]) for r in frame.collect()]
        assert len(found) == len(expected) and set(found) == expected
        assert rejected_lines(spark, str(tmp_path)).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@given(st.lists(st.lists(st.text(alphabet='ab,"\n', max_size=5), min_size=2, max_size=3), min_size=1, max_size=6))
@settings(max_examples=300, deadline=None)
def test_lines_are_joined_as_a_csv_reader_does(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    block = records._Block("f", "n", 1, False)
    found = [next(csv.reader(io.StringIO(text))) for _, text in block.add(out.getvalue().split("\n")[:-1])]
    assert found == rows
    assert block.effect[0] is False and [k for k, _ in block.end()] == [records.BLOCK]


def test_a_block_s_effect_is_that_of_its_lines(spark):
    """Prefix scan over functions of two states, against going through them."""
    rng = random.Random(4)
    rows, expected = [], set()
    for file in ("a", "b", "c"):
        state = False
        for start in range(40):
            opened, stays = rng.choice([(False, True)] * 3 + [(True, False), (False, False), (True, True)])
            rows.append((file, start, records.BLOCK, opened, stays))
            if state:
                expected.add((file, start))
            state = stays if state else opened
    frame = spark.createDataFrame(rows, "file string, start long, kind string, opened boolean, stays boolean")
    assert records.blocks_inside(frame) == expected


def test_headers_read_the_head_of_a_file_only(spark, tmp_path):
    line = "0123456789" * 10 + "\n"
    (tmp_path / "a.csv").write_text("x,y\n" + line * 300_000)
    (tmp_path / "b.csv").write_text("x,y\n1,2\n")
    (tmp_path / "c.csv").write_text('"p\nq",y')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")
    try:
        found = csv_headers(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(h, [f.rpartition("/")[2] for f in files]) for h, files in found] == [
        (("x", "y"), ["a.csv", "b.csv"]), (("p\nq", "y"), ["c.csv"]),
    ]


def test_csv_folder_errors(spark, tmp_path):
    with pytest.raises(AnalysisException):
        csv_headers(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError, match="no CSV files"):
        read_yearly_csvs(spark, str(tmp_path))
    (tmp_path / "a.csv").write_text("x\n1\n")
    with pytest.raises(ValueError, match="expected a folder"):
        read_yearly_csvs(spark, str(tmp_path / "a.csv"))


def test_coordinates(spark, tmp_path):
    path = tmp_path / "geo.csv"
    path.write_text("id,school_name,latitude,longitude\n100001,A,18.1234,120.5678\n100002,B,x,\n")
    rows = {tuple(r) for r in read_coordinates(spark, str(path)).collect()}
    assert rows == {("100001", 120.5678, 18.1234), ("100002", None, None)}


def test_rule_and_seed_files(spark, tmp_path):
    loaded = rules.load_rules()
    assert loaded["region_psgc_map"]["armm"] is None
    own = tmp_path / "rules.yml"
    own.write_text("region_psgc_map: {a: b}\n")
    assert rules.load_rules(own) == {"region_psgc_map": {"a": "b"}}
    names = rules.region_names(spark)
    require_contract(names, CONTRACTS["region_names"], dtypes=True, keys=True)
    assert names.where("other IS NULL").count() == names.count() == 18
    with pytest.raises(FileNotFoundError):
        rules.region_names(spark, tmp_path / "none.yml")
    empty = tmp_path / "empty.yml"
    empty.write_text("region_names: []\n")
    with pytest.raises(ValueError):
        rules.region_names(spark, empty)
    seeds = rules.seed_tables(spark)
    assert {n: t.count() for n, t in seeds.items()} == {
        "school_sizes": 8, "school_epochs": 3, "school_grades": 15,
    }
    assert seeds["school_grades"].where(F.col("label") == "g10").first()["id"] == 12


def test_sql_file(spark, tmp_path):
    path = tmp_path / "q.sql"
    path.write_text("SELECT k, count(*) AS n FROM things GROUP BY k;\n")
    things = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    direct = rules.sql_view(spark, path, tables={"things": things})
    assert {tuple(r) for r in direct.collect()} == {("a", 2), ("b", 1)}
    view = rules.sql_view(spark, path, view="counted", tables={"things": things})
    assert view.count() == 2 and spark.table("counted").count() == 2
