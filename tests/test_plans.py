"""Whole jobs: enrollment folder, warehouse, analysis."""

import pytest
from pyspark.sql import functions as F

from schoolatlas.contracts import CONTRACTS
from schoolatlas.operators.quality import ContractError, require_contract, store_checked
from schoolatlas.plans import analysis, enrollment, geography, stored, warehouse
from schoolatlas.session import durable, temporary_copies
from schoolatlas.sources.rules import load_rules
from tests.test_sources import PLACE_HEADER, dropout_books, teacher_sheets
from tests.xlsx import write_workbook

ATTRIBUTES = (
    "school_id,school_name,region,division,province,school_district,legislative_district,municipality,"
    "barangay,street_address,sector,school_management,annex_status,offers_es,offers_jhs,offers_shs"
)
COUNTS = ["kinder_male", "kinder_female", "g1_male", "g11_stem_male", "g12_abm_female"]


def write_year(folder, year, rows, counts=COUNTS):
    lines = [ATTRIBUTES + "," + ",".join(counts)]
    for school_id, flags, values in rows:
        lines.append(
            f"{school_id},TEST ES {school_id},Region I,Test Division,ILOCOS  NORTE ,District 1,1st District,BACARRA,"
            f"Libtong,--PUROK 2ND--,Public,DepEd, Standalone School ,{flags},"
            + ",".join(f'"{v}"' for v in values)
        )
    (folder / f"enrollment_{year}.csv").write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("enroll")
    write_year(
        path,
        "2023-2024",
        [
            (100001, "true,false,false", [4, 5, 3, 1, 0]),
            (100002, "True,False,False", ["1,000", "abc", "", " 7 ", "0"]),
            (100003, "true,true,true", [0, 0, 0, 0, 0]),
        ],
    )
    write_year(
        path,
        "2025-2026",
        [(100001, "false,true,", [1, "x", 2]), (100001, "false,true,", [1, "x", 2])],
        ["kinder_male", "g1_male", "g12_sshs_acad_female"],
    )
    return str(path)


@pytest.fixture(scope="module")
def tables(spark, folder):
    return enrollment.enrollment_tables(spark, folder, load_rules())


def test_enrollment_facts(tables):
    facts = tables["enrollment"]
    require_contract(facts, CONTRACTS["enrollment"], dtypes=True)
    found = {tuple(r) for r in facts.where("school_year = '2023-2024'").drop("school_year").collect()}
    assert found == {
        ("100001", "kinder", "male", None, 4), ("100001", "kinder", "female", None, 5),
        ("100001", "g1", "male", None, 3), ("100001", "g11", "male", "stem", 1),
        ("100002", "kinder", "male", None, 1000), ("100002", "g11", "male", "stem", 7),
    }
    later = facts.where("school_year = '2025-2026'")
    assert later.where("strand = 'sshs_acad' AND sex = 'female' AND grade = 'g12'").count() == 2
    assert later.count() == 4


def test_school_year_meta(tables):
    meta = tables["school_year_meta"]
    require_contract(meta, CONTRACTS["school_year_meta"], dtypes=True, keys=True)
    rows = {(r["school_id"], r["school_year"]): r for r in meta.collect()}
    # A school-year without students is not listed; repeated rows count once.
    assert set(rows) == {("100001", "2023-2024"), ("100002", "2023-2024"), ("100001", "2025-2026")}
    row = rows["100001", "2023-2024"]
    assert row["school_name"] == "Test Elementary School 100001"
    assert row["province"] == "ILOCOS NORTE"
    assert row["street_address"] == "Purok 2nd"
    assert row["annex_status"] == "standalone school"


def test_empty_schools_can_be_kept(spark, folder):
    kept = enrollment.enrollment_tables(spark, folder, {}, keep_empty_schools=True)
    assert kept["school_year_meta"].where("school_id = '100003'").count() == 1


def test_levels_follow_the_latest_year(tables):
    levels = tables["school_levels"]
    require_contract(levels, CONTRACTS["school_levels"], dtypes=True, keys=True)
    found = {tuple(r) for r in levels.select("school_id", "school_year", "level", "offered").collect()}
    for year in ("2023-2024", "2025-2026"):
        assert {r[2:] for r in found if r[:2] == ("100001", year)} == {("es", False), ("jhs", True), ("shs", None)}
    assert {r[2:] for r in found if r[0] == "100002"} == {("es", True), ("jhs", False), ("shs", False)}


def test_levels_from_meta(spark):
    meta = spark.createDataFrame([("1", True, False, None, "a")], "school_id string, offers_es boolean, offers_jhs boolean, offers_shs boolean, x string")
    facts = spark.createDataFrame([("1", "2023"), ("1", "2023"), ("2", "2023")], "school_id string, school_year string")
    rest, levels = enrollment.offered_levels_from_meta(meta, facts)
    assert rest.columns == ["school_id", "x"]
    assert {tuple(r) for r in levels.where("school_id = '1'").collect()} == {
        ("1", "2023", "ES", True), ("1", "2023", "JHS", False), ("1", "2023", "SHS", None),
    }
    assert levels.count() == 6


def test_invalid_counts_are_reported(tables):
    found = {r["source_file"]: (r["invalid_rows"], r["samples"]) for r in tables["invalid_counts"].collect()}
    assert found["enrollment_2023-2024.csv"][0] in (1, 2)  # the quoted blank may be read as null
    assert "abc" in found["enrollment_2023-2024.csv"][1]
    assert found["enrollment_2025-2026.csv"] == (2, ["x"])


def test_latest_file_only(spark, folder):
    latest = enrollment.enrollment_tables(spark, folder, {}, latest_only=True)
    assert {r[0] for r in latest["enrollment"].select("school_year").distinct().collect()} == {"2025-2026"}


def test_header_only_file(spark, tmp_path):
    write_year(tmp_path, "2020-2021", [])
    tables = enrollment.enrollment_tables(spark, str(tmp_path), {})
    assert tables["enrollment"].isEmpty() and tables["school_levels"].isEmpty()


def test_coordinates_join(spark):
    meta = spark.createDataFrame([("100001",), ("100004",)], "school_id string")
    xy = spark.createDataFrame([("100001", 120.5678, 18.1234), ("100001", 121.0, 1.0)], "school_id string, longitude double, latitude double")
    assert {tuple(r) for r in geography.with_coordinates(meta, xy).collect()} == {
        ("100001", 120.5678, 18.1234), ("100004", None, None),
    }


@pytest.fixture(scope="module")
def built(spark, folder, tmp_path_factory):
    base = tmp_path_factory.mktemp("sources")
    write_workbook(
        base / "places.xlsx",
        {"PSGC": [
            PLACE_HEADER,
            [100000000, "Region I", 1.0, "Reg"], [100100000, "Ilocos Norte", 128.0, "Prov"],
            [100100100, "Bacarra", 12801.0, "Mun"], [100100101, "Libtong", 12801001.0, "Bgy", None, None, None, None, 5, None, None],
        ]},
    )
    (base / "geo.csv").write_text("id,longitude,latitude\n100001,120.5,18.1\n")
    for name in ("hr", "dropout"):
        (base / name).mkdir()
    write_workbook(base / "hr" / "2022-2023-teachers.xlsx", teacher_sheets())
    dropout_books(base / "dropout")
    sources = {
        "enrollment_folder": folder,
        "place_workbook": str(base / "places.xlsx"),
        "coordinate_file": str(base / "geo.csv"),
        "teacher_folder": str(base / "hr"),
        "dropout_folder": str(base / "dropout"),
    }
    return warehouse.build_warehouse(spark, str(base / "out"), **sources), sources, base


def test_warehouse_tables(built):
    tables, _, base = built
    expected = {
        "school_sizes", "school_epochs", "school_grades", "school_years", "school_strands", "school_levels",
        "enroll", "dropouts", "geos", "addr", "psgc", "region_names", "teachers", "teacher_positions",
        "school_sketches",
    }
    expected |= {f"audit_{name}" for name in (*warehouse.AUDITS, "foreign_keys")}
    assert set(tables) == expected
    assert all((base / "out" / name / "_SUCCESS").exists() for name in expected)


def test_repeated_keys_are_on_record(built):
    tables = built[0]
    found = {r["table"]: r for r in tables["audit_duplicate_keys"].collect()}
    enroll = tables["enroll"]
    key = ["school_year_id", "school_id", "grade_id", "sex", "strand_id"]
    repeated = [r["count"] for r in enroll.groupBy(*key).count().where("count > 1").collect()]
    assert (found["enrollment"]["repeated_keys"], found["enrollment"]["rows"]) == (len(repeated), sum(repeated))
    assert found["enrollment"]["key"] == "school_year, school_id, grade, sex, strand"
    assert "psgc" not in found and "dropouts" not in found


def test_a_retyped_column_is_on_record(spark, tmp_path):
    (tmp_path / "enrollment_2023-2024.csv").write_text("school_id,district,g1_male\n1,3,5\n2,,6\n")
    (tmp_path / "enrollment_2024-2025.csv").write_text("school_id,district,g1_male,x\n1,3rd,1.5\n2,4,x,y\n3,5th,7,y\n")
    tables = enrollment.enrollment_tables(spark, str(tmp_path), load_rules())
    assert {tuple(r) for r in tables["type_misfits"].collect()} == {
        ("enrollment_2024-2025.csv", "district", "long", 1, "5th"),
        ("enrollment_2024-2025.csv", "g1_male", "long", 1, "x"),
    }
    assert [r["line"] for r in tables["csv_rejects"].collect()] == ["1,3rd,1.5"]


def test_sketches_unite(spark):
    rows = [(y, m, str(i)) for y in ("a", "b") for m, n in (("x", 3000), ("y", 4000)) for i in range(n)]
    df = spark.createDataFrame(rows, "school_year string, school_management string, school_id string")
    sketches = analysis.school_sketches(df)
    assert sketches.count() == 4
    for by, exact in ((["school_year"], 4000), ([], 4000)):
        for r in analysis.schools_from_sketches(sketches, *by).collect():
            assert abs(r["num_schools"] - exact) <= analysis.SKETCH_ERROR * exact


def test_a_contract_is_checked_by_the_write(spark, tmp_path):
    contract = CONTRACTS["school_levels"]
    rows = spark.createDataFrame([("1", "2023", "es", True), ("1", None, "jhs", False)], "school_id string, school_year string, level string, offered boolean")
    keep = lambda name: lambda df: stored.store(df, str(tmp_path), name)
    with pytest.raises(ContractError, match="'school_year' contains nulls"):
        store_checked(rows, contract, keep("a"))
    with pytest.raises(ContractError, match="'offered' is string, not boolean"):
        store_checked(rows.withColumn("offered", F.lit("x")), contract, keep("b"))
    assert not (tmp_path / "b").exists()  # the shape is checked before anything runs
    good = rows.where("school_year IS NOT NULL")
    assert store_checked(good.union(good), contract, keep("c")).count() == 2
    with pytest.raises(ContractError, match="not unique"):
        store_checked(good.union(good), contract, keep("d"), keys=True)


def test_warehouse_keys(built):
    tables = built[0]
    years = dict(tables["school_years"].select("school_year", "id").collect())
    assert years == {"2023-2024": 1, "2025-2026": 2}
    enroll = tables["enroll"]
    assert set(enroll.columns) == {"school_year_id", "school_id", "grade_id", "sex", "strand_id", "num_students"}
    row = enroll.where("school_id = '100002' AND num_students = 7").first()
    assert (row["school_year_id"], row["grade_id"]) == (1, 14)
    strands = dict(tables["school_strands"].select("id", "strand").collect())
    assert strands[row["strand_id"]] == "stem"
    # A label without a lookup row becomes null: that strand and those years are not enrolled in.
    drops = tables["dropouts"]
    assert drops.where("strand_id IS NULL").count() == drops.count()
    assert {r[0] for r in drops.select("school_year_id").distinct().collect()} == {None, 1}
    positions = dict(tables["teacher_positions"].select("position", "id").collect())
    assert positions == {"role 1": 1, "sped/sned teacher iii": 2}


def test_warehouse_geography(built):
    tables = built[0]
    geos = tables["geos"].orderBy("school_id", "school_year").collect()
    assert [(r["school_id"], r["psgc_brgy_id"], r["address_id"], r["longitude"]) for r in geos] == [
        ("100001", "0100100101", 1, 120.5), ("100001", "0100100101", 1, 120.5), ("100002", "0100100101", 1, None),
    ]
    assert tables["addr"].count() == 3


def test_warehouse_build_is_repeatable(spark, built, tmp_path):
    tables, sources, _ = built
    again = warehouse.build_warehouse(spark, str(tmp_path / "again"), **sources)
    for name, first in tables.items():
        columns = [c for c in first.columns if c not in ("ingested_at", "schools")]
        a, b = first.select(columns), again[name].select(columns)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name


def test_optional_tables_are_left_out(spark, built, tmp_path):
    _, sources, _ = built
    some = {k: v for k, v in sources.items() if k not in ("teacher_folder", "dropout_folder")}
    tables = warehouse.build_warehouse(spark, str(tmp_path / "out"), number_facts=True, **some)
    ids = [r["id"] for r in tables["enroll"].select("id").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))
    assert "teachers" not in tables and "dropouts" not in tables


def test_a_second_load_keeps_keys_and_other_years(spark, built, tmp_path):
    _, sources, _ = built
    some = {k: v for k, v in sources.items() if k not in ("teacher_folder", "dropout_folder")}
    out = str(tmp_path / "out")
    first = {n: [tuple(r) for r in t.collect()] for n, t in warehouse.build_warehouse(spark, out, **some).items()}
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "enrollment_2022-2023.csv").write_text(
        "school_id,school_name,region,province,municipality,barangay,g11_newstrand_male\n"
        "100009,New ES,Region I,Ilocos Norte,Bacarra,Libtong,4\n"
    )
    more = some | {"enrollment_folder": str(tmp_path / "more")}
    for _ in range(2):  # the same load again changes nothing
        second = warehouse.build_warehouse(spark, out, keep=True, **more)
        years = dict(second["school_years"].select("school_year", "id").collect())
        assert years == {"2023-2024": 1, "2025-2026": 2, "2022-2023": 3}
        strands = {r["strand"]: r["id"] for r in second["school_strands"].collect()}
        known = {r[1]: r[0] for r in first["school_strands"]}
        assert "newstrand" not in known and strands == known | {"newstrand": len(known) + 1}
        enroll = second["enroll"].select(*spark.read.parquet(f"{out}/enroll").columns)
        old = enroll.where("school_year_id <> 3").collect()
        assert len(old) == len(first["enroll"]) and enroll.where("school_year_id = 3").count() == 1
        assert second["geos"].count() == len(first["geos"]) + 1
        assert second["psgc"].count() == len(first["psgc"])
    assert not any((tmp_path / "out" / "_next").iterdir())


def rows(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_insert_or_replace(spark, tmp_path):
    folder, schema = str(tmp_path), "id long, year string, v string"
    frame = lambda *values: spark.createDataFrame(values, schema)
    stored.merge_by_key(frame((1, "a", "x"), (1, "a", "y"), (2, "a", "z"), (3, "b", "z")), folder, "t", partition="year")
    untouched = sorted(p.name for p in (tmp_path / "t" / "year=b").iterdir())
    # A changed row that moves to another partition, a new one, a new partition; the others stay.
    merged = stored.merge_by_key(frame((2, "c", "moved"), (4, None, "new")), folder, "t", partition="year")
    assert rows(merged, "id", "year", "v") == {(1, "a", "y"), (2, "c", "moved"), (3, "b", "z"), (4, None, "new")}
    assert sorted(p.name for p in (tmp_path / "t" / "year=b").iterdir()) == untouched
    # The last row of a partition leaves it.
    merged = stored.merge_by_key(frame((1, "b", "w")), folder, "t", partition="year")
    assert rows(merged, "id", "year", "v") == {(1, "b", "w"), (2, "c", "moved"), (3, "b", "z"), (4, None, "new")}
    assert not (tmp_path / "t" / "year=a").exists()
    # Other columns; rows without the key are appended.
    wider = spark.createDataFrame([(3, "b", 1.5)], "id long, year string, w double")
    merged = stored.merge_by_key(wider, folder, "t", partition="year")
    assert rows(merged, "id", "v", "w") == {(1, "w", None), (2, "moved", None), (3, None, 1.5), (4, "new", None)}
    merged = stored.merge_by_key(spark.createDataFrame([("q",), ("p",)], "v string"), folder, "t", partition=None)
    assert rows(merged.where("id > 4"), "id", "v") == {(5, "p"), (6, "q")}
    plain = stored.merge_by_key(spark.createDataFrame([("q",), ("p",)], "v string"), folder, "plain")
    assert rows(plain, "id", "v") == {(1, "p"), (2, "q")}


def test_a_failed_load_leaves_the_table(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    good = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, year string, v string")
    stored.merge_by_key(good, folder, "t", partition="year")
    bad = good.withColumn("v", F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise("z").cast("string"))
    with pytest.raises(Exception, match="no"):
        stored.merge_by_key(bad, folder, "t", partition="year")
    assert rows(spark.read.parquet(f"{folder}/t"), "id", "v") == {(1, "x"), (2, "y")}
    # A move that fails half-way puts the moved partition back.
    real, calls = stored._files, []

    def broken(session, path):
        calls.append(path)
        if path.endswith("new/year=b"):
            raise OSError("lost")
        return real(session, path)

    monkeypatch.setattr(stored, "_files", broken)
    with pytest.raises(OSError, match="lost"):
        stored.merge_by_key(good.withColumn("v", F.lit("changed")), folder, "t", partition="year")
    monkeypatch.setattr(stored, "_files", real)
    assert rows(spark.read.parquet(f"{folder}/t"), "id", "v") == {(1, "x"), (2, "y")}
    assert calls


def test_partitions_are_few_files(spark, tmp_path):
    df = spark.range(4000).select("id", (F.col("id") % 3).alias("year")).repartition(16)
    stored.store(df, str(tmp_path), "t", "year")
    assert len(list((tmp_path / "t").glob("year=*/*.parquet"))) <= 8


def test_temporary_copies_go_with_their_job(spark):
    before = durable(spark.range(2))
    with temporary_copies(spark):
        inner = durable(spark.range(3))
        assert inner.count() == 3
    assert before.count() == 2
    with pytest.raises(Exception, match="(?i)exist"):
        spark.read.parquet(inner.inputFiles()[0]).count()


def test_analysis(spark):
    df = spark.createDataFrame(
        [("2023", "1", "DepEd"), ("2023", "1", "DepEd"), ("2023", "2", "Private"), ("2024", "2", "DepEd")],
        "school_year string, school_id string, school_management string",
    )
    assert {tuple(r) for r in analysis.rows_per_school_year(df).collect()} == {("2023", "1", 2), ("2023", "2", 1), ("2024", "2", 1)}
    exact = {tuple(r) for r in analysis.schools_per_year(df, "DepEd").collect()}
    assert exact == {("2023", 1), ("2024", 1)}
    assert {tuple(r) for r in analysis.schools_per_year_estimate(df, "DepEd").collect()} == exact
    codes = spark.createDataFrame(
        [("0301420001", "Muzon Proper", "Bgy", None), ("0301420002", "Other", "Bgy", "MUZON"), ("0301421001", "Muzon", "Bgy", None), ("0301420000", "Muzon", "Mun", None)],
        "id string, name string, geo string, old_names string",
    )
    found = analysis.search_places(codes, "muzon", "0301420000")
    assert {r["id"] for r in found.collect()} == {"0301420001", "0301420002"}
    meta = spark.createDataFrame([("m", "a", None), ("m", "a", None), ("m", "b", None), ("m", "c", "x")], "psgc_muni_id string, barangay string, psgc_brgy_id string")
    assert [tuple(r) for r in analysis.unmatched_barangays(meta).collect()] == [("m", "a", 2), ("m", "b", 1)]


def test_conformed_sex(spark):
    df = spark.createDataFrame([("m",), ("f",), ("male",), (None,)], "sex string")
    assert [r[0] for r in analysis.with_conformed_sex(df).collect()] == ["male", "female", "male", None]
