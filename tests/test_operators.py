"""Joins, ordinals, picks, contracts and matching on small tables."""

import time

import pytest
from pyspark.sql import functions as F

from schoolatlas.contracts import CONTRACTS
from schoolatlas.operators import cleaning, distinct, joins, keys, matching, ordinals, quality, reshape
from schoolatlas.sources.rules import load_rules

CODES = "id string, name string, geo string, old_names string, cc string, city_class string"


def codes(spark, *rows):
    return spark.createDataFrame([(*r, *[None] * (6 - len(r))) for r in rows], CODES)


BASE = [
    ("0100000000", "Region I", "Reg"),
    ("0100100000", "Hilagang Baybay", "Prov"),
    ("0100100100", "Lumang Tulay", "Mun", "", "", "City"),
    ("0100100101", "Malayang Bukid", "Bgy"),
]


def school(**changes):
    return {
        "school_id": "1000001", "school_name": "Test School", "region": "Region I",
        "province": "Hilagang Baybay", "municipality": "Lumang Tulay", "barangay": "Malayang Bukid",
        "street_address": "123 Main", "legislative_district": "1st District",
        "division": "Division A", "school_district": "District 1", "sector": "Public",
        "school_management": "DepEd", "annex_status": "standalone school",
        "school_year": "2023-2024",
    } | changes


def schools(spark, *rows):
    names = list(school())
    return spark.createDataFrame(
        [tuple(r[n] for n in names) for r in rows], ", ".join(f"{n} string" for n in names)
    )


# --- picks, ordinals, keys ------------------------------------------------------


def test_first_and_last_do_not_depend_on_partitions(spark):
    rows = [(k, v, str(v % 3)) for k in range(5) for v in range(40)]
    answers = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows, "k int, v int, w string").repartition(parts)
        first = distinct.first_per_key(df, ["k"], F.col("w"))
        last = distinct.last_per_key(df, ["k"], F.col("w"))
        answers.add(tuple(sorted(map(tuple, first.union(last).collect()))))
    assert answers == {tuple(sorted([(k, 0, "0") for k in range(5)] + [(k, 38, "2") for k in range(5)]))}


def test_ordinals_are_consecutive_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(9)
    numbered = ordinals.with_ordinal(df, "n", F.col("v"))
    assert numbered.where("n <> v + 1").count() == 0
    assert numbered.select("n").distinct().count() == 5000
    assert ordinals.with_ordinal(df.limit(0), "n", F.col("v")).count() == 0


def test_divisions_start_at_two(spark):
    meta = spark.createDataFrame(
        [("01", "B"), ("01", "A"), ("01", None), ("01", "A"), ("02", "A"), (None, "A"), (None, "C")],
        "psgc_region_id string, division string",
    )
    found = {tuple(r) for r in matching.divisions(meta).collect()}
    assert found == {
        ("01", None, 2, "01-2"), ("01", "A", 3, "01-3"), ("01", "B", 4, "01-4"),
        ("02", "A", 2, "02-2"), (None, "A", 1, None), (None, "C", 1, None),
    }


def test_label_to_key(spark):
    lookup = spark.createDataFrame(
        [(1, "Category A"), (2, "Category B"), (5, "Category A"), (9, None)], "id int, label string"
    )
    facts = spark.createDataFrame(
        [("x", "Category A"), ("y", "Category B"), ("z", "category a"), ("n", None)], "k string, c string"
    )
    keyed = keys.label_to_key(facts, "c", lookup, "category_id")
    assert keyed.columns == ["k", "category_id"]
    assert dict(map(tuple, keyed.collect())) == {"x": 1, "y": 2, "z": None, "n": None}
    with pytest.raises(ValueError):
        keys.label_to_key(facts, "absent", lookup, "category_id")
    with pytest.raises(ValueError):
        keys.label_to_key(facts, "c", lookup, "category_id", label="name")


def test_extract_lookup_keeps_rows(spark):
    facts = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "k int, p string")
    keyed, lookup = keys.extract_lookup(facts, "p", "p_id")
    assert {tuple(r) for r in lookup.collect()} == {(1, "a"), (2, "b")}
    assert dict(map(tuple, keyed.collect())) == {1: 2, 2: 1, 3: None, 4: 2}


# --- the join that does not broadcast the lookup -------------------------------------


@pytest.mark.parametrize("on", [["a"], ["a", "b"]])
def test_large_lookup_join_equals_broadcast_join(spark, on):
    # Key 0 holds a third of the rows, and another tenth has no key at all.
    left = spark.range(30000).select(
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, 0)
        .otherwise(F.col("id") % 5000).alias("a"),
        (F.col("id") % 2).alias("b"),
        (F.col("id") % 11).alias("payload"),
    )
    lookup = spark.range(4000).select(
        F.col("id").alias("a"), (F.col("id") % 2).alias("b"), (F.col("id") * 3).alias("v")
    )
    if on == ["a"]:
        lookup = lookup.drop("b")
    hints = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
             if spark.conf.get(c, None) is not None}
    small = joins.lookup_join(left, lookup, on).collect()
    try:
        for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(c, "-1")
        large = joins.lookup_join(left, lookup, on).collect()
    finally:
        for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(c, hints[c]) if c in hints else spark.conf.unset(c)
    assert len(large) == 30000
    assert sorted(map(str, small)) == sorted(map(str, large))


def test_per_distinct(spark):
    df = spark.range(600).select(
        "id", F.when(F.col("id") % 5 != 0, (F.col("id") % 50).cast("string")).alias("a"), F.lit("x").alias("b")
    )
    done = joins.per_distinct(
        df,
        ["a", "b"],
        lambda d: d.where("a IS NULL OR a <> '7'").withColumn("n", F.length("a")).withColumn("b", F.lit("y")),
    )
    assert done.columns == ["id", "a", "b", "n"]
    expected = df.where("a IS NULL OR a <> '7'").select("id", "a", F.lit("y").alias("b"), F.length("a").alias("n"))
    assert done.exceptAll(expected).isEmpty() and expected.exceptAll(done).isEmpty()


# --- headers and unions ----------------------------------------------------------------


def test_union_coerced(spark):
    first = spark.createDataFrame([(1, "a")], "id long, x string")
    second = spark.createDataFrame([("2", 5)], "id string, extra int")
    union = reshape.union_coerced([first, second])
    assert dict(union.dtypes) == {"id": "bigint", "x": "string", "extra": "int"}
    assert {tuple(r) for r in union.collect()} == {(1, "a", None), (2, None, 5)}
    bad = spark.createDataFrame([("oops",)], "id string")
    with pytest.raises(Exception):
        reshape.union_coerced([first, bad]).collect()


def test_leading_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert reshape.leading_columns(df, ["c", "zz", "a"]).columns == ["c", "a", "b"]


# --- contracts ------------------------------------------------------------------------------


def test_contract_checks(spark):
    contract = CONTRACTS["school_levels"]
    good = spark.createDataFrame([("1", "2023-2024", "es", True)], contract.schema)
    assert quality.contract_errors(good, contract, dtypes=True, keys=True) == []
    short = good.drop("level")
    with pytest.raises(quality.ContractError, match="missing columns: level.*sample="):
        quality.require_contract(short, contract)
    nulls = spark.createDataFrame([(None, "2023-2024", "es", True)], "school_id string, school_year string, level string, offered boolean")
    assert quality.contract_errors(nulls, contract) == ["[school_levels] column 'school_id' contains nulls"]
    twice = good.union(good).withColumn("offered", F.lit("yes"))
    errors = quality.contract_errors(twice, contract, dtypes=True, keys=True)
    assert len(errors) == 2 and "is string, not boolean" in errors[0] and "not unique" in errors[1]
    assert quality.contract_errors(twice, contract) == []


def test_ten_contracts():
    assert len(CONTRACTS) == 10
    assert CONTRACTS["meta_psgc"].required == ["school_year", "school_id"]


def test_require_rows(spark):
    with pytest.raises(ValueError, match="nothing here"):
        quality.require_rows(spark.range(0), "nothing here")


def test_orphans(spark):
    geo = spark.createDataFrame([("a", "x"), ("b", None), ("a", "y")], "p string, q string")
    known = spark.createDataFrame([("b",), ("x",)], "id string")
    found = {tuple(r) for r in quality.geography_orphans(geo, known, ["p", "q"]).collect()}
    assert found == {("p", "a", 2), ("q", "y", 1)}


# --- matching ------------------------------------------------------------------------------


def test_one_school_gets_four_codes(spark):
    matched = matching.match_places(schools(spark, school()), codes(spark, *BASE), load_rules())
    row = matched.first()
    assert [row[c] for c in matching.PLACE_IDS] == ["0100000000", "0100100000", "0100100100", "0100100101"]
    assert row["division_id"] == "0100000000-2"
    assert matched.columns[:12] == matching.MATCHED_ORDER[:12]
    quality.require_contract(matched, CONTRACTS["meta_psgc"], dtypes=True, keys=True)


def test_duplicate_names_do_not_multiply_rows(spark):
    table = codes(
        spark, *BASE,
        ("0100100200", "LUMANG TULAY", "Mun"), ("0100100102", "Malayang Bukid", "Bgy"),
        ("0100200000", "Hilagang Baybay (old)", "Prov"), ("0100000009", "REGION I", "Reg"),
    )
    matched = matching.match_places(schools(spark, school()), table, {})
    assert matched.count() == 1
    assert matched.first()["psgc_brgy_id"] == "0100100101"


def test_region_only_municipality_comes_before_province(spark):
    table = codes(
        spark, ("1300000000", "NCR", "Reg"), ("1301000000", "First District", "Prov"),
        ("1381701000", "Pateros", "Mun"), ("1374000000", "City of Mandaluyong", "City", None, None, "HUC"),
        ("1380601000", "Tondo I/II", "SubMun"),
    )
    keys = matching.place_keys(table)
    rows = [
        school(school_id=str(i), region="NCR", province="First District", municipality=m)
        for i, m in enumerate(["Mandaluyong City", "Tondo I/II", "Pateros", "Elsewhere"])
    ]
    found = matching.attach_province(matching.attach_region(schools(spark, *rows), keys), keys)
    ids = dict(found.select("school_id", "psgc_provhuc_id").collect())
    assert ids == {"0": "1374000000", "1": "1380601000", "2": "1381701000", "3": "1381701000"}
    munis = dict(matching.attach_municipality(found, keys).select("school_id", "psgc_muni_id").collect())
    assert munis == {"0": "1374000000", "1": "1380601000", "2": "1381701000", "3": None}


def test_municipality_without_province_is_searched_everywhere(spark):
    table = codes(spark, *BASE, ("0100300500", "Lumang Tulay", "Mun"))
    keys = matching.place_keys(table)
    rows = schools(spark, school(province="Unknown"))
    found = matching.attach_municipality(matching.attach_province(matching.attach_region(rows, keys), keys), keys)
    assert found.first()["psgc_provhuc_id"] is None
    assert found.first()["psgc_muni_id"] == "0100100100"


def test_fixed_province_texts(spark):
    table = codes(spark, *BASE, ("1200000000", "Region XII", "Reg"))
    keys = matching.place_keys(table)
    rows = schools(
        spark,
        school(region="Region XII", province="(SGA - North Cotabato) "),
        school(school_id="2", province="CITY OF ISABELA"),
    )
    found = matching.attach_province(matching.attach_region(rows, keys), keys).orderBy("school_id")
    assert [(r["region"], r["province"], r["psgc_region_id"], r["psgc_provhuc_id"]) for r in found.collect()] == [
        ("BARMM", "NORTH COTABATO", "1900000000", "1999900000"),
        ("Region I", "CITY OF ISABELA", "0900000000", "0990101000"),
    ]


def test_aliases_resolve_and_null_aliases_drop(spark):
    table = codes(spark, *BASE, ("1300000000", "National Capital Region", "Reg"))
    rows = schools(spark, school(region="NCR"), school(school_id="2", region="PSO"), school(school_id="3", region="??"))
    found = matching.attach_region(rows, matching.place_keys(table, load_rules()["region_psgc_map"]))
    assert [tuple(r) for r in found.select("school_id", "psgc_region_id").collect()] == [("1000001", "1300000000")]


@pytest.fixture
def uncut(spark):
    """Shuffles keep their number of partitions, however small the tables."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    yield
    spark.conf.unset(setting)


def test_places_of_one_partition_are_normalized_in_many(spark, uncut, monkeypatch):
    task = F.spark_partition_id().cast("string")
    monkeypatch.setattr(matching, "barangay_name", lambda col: F.concat(col, F.lit("@"), task))
    table = codes(spark, *[(f"01001001{i:02}", f"Bukid {i}", "Bgy") for i in range(80)]).coalesce(1)
    names = matching.place_keys(table).where("kind = 'barangay'").select("name").collect()
    assert len(names) == 80
    assert len({n.split("@")[1] for (n,) in names}) > 1


def test_schools_of_one_partition_are_matched_in_many(spark, uncut):
    keys = matching.place_keys(codes(spark, *BASE))
    rows = [school(school_id=str(i), region=["Region I", "REGION I (old)", "?", "", None][i % 5]) for i in range(200)]
    found = matching.attach_region(schools(spark, *rows).coalesce(1), keys)
    placed = found.select("school_id", F.spark_partition_id()).collect()
    assert sorted(int(i) for i, _ in placed) == [i for i in range(200) if i % 5 < 2]
    assert len({task for _, task in placed}) > 1


def test_correction_sets_name_and_code_together(spark):
    table = codes(spark, *BASE, ("0100100103", "Mataas na Kahoy", "Bgy"))
    rules = matching.correction_table(
        spark,
        [
            {"psgc_muni_id": "0100100100", "old": "MATAAS NA KAHUY", "new": "Mataas na Kahoy"},
            {"psgc_muni_id": "0100100100", "old": "Mataas na Kahuy", "new": "Ignored"},
            {"psgc_muni_id": "0100100100", "old": "gone", "new": "Not Listed"},
            {"psgc_muni_id": "0100100100", "old": "MALAYANG BUKID", "new": "Other"},
        ],
    )
    rows = spark.createDataFrame(
        [("1", "mataas na kahuy", "0100100100", None), ("2", "Gone", "0100100100", None),
         ("3", "Malayang Bukid", "0100100100", "0100100101"), ("4", "Mataas na Kahuy", "0999900000", None),
         ("5", None, "0100100100", None)],
        "school_id string, barangay string, psgc_muni_id string, psgc_brgy_id string",
    )
    found = {tuple(r) for r in matching.correct_barangays(rows, matching.place_keys(table), rules).collect()}
    assert found == {
        ("1", "Mataas na Kahoy", "0100100100", "0100100103"), ("2", "Not Listed", "0100100100", None),
        ("3", "Malayang Bukid", "0100100100", "0100100101"), ("4", "Mataas na Kahuy", "0999900000", None),
        ("5", None, "0100100100", None),
    }


def test_backfill_touches_only_open_rows_of_the_region(spark):
    table = codes(
        spark, ("1999901005", "Malayang Bukid", "Bgy", None, "124701005", None),
        ("1999902005", "MALAYANG BUKID ", "Bgy", None, "124702005", None), ("1999903005", "Malayang Bukid", "Bgy", None, "9", None),
    )
    keys = matching.place_keys(table)
    ids = "psgc_region_id string, psgc_provhuc_id string, psgc_muni_id string, psgc_brgy_id string"
    rows = spark.createDataFrame(
        [("1", "2022", "malayang bukid", "1900000000", None, None, None), ("1", "2023", "Malayang Bukid", "1900000000", "x", "y", None),
         ("2", "2023", "Malayang Bukid", "0100000000", None, None, None), ("3", "2023", "Malayang Bukid", "1900000000", "a", "b", "c")],
        f"school_id string, school_year string, barangay string, {ids}",
    )
    found = {tuple(r)[:2]: tuple(r)[3:] for r in matching.backfill_special_area(rows, keys).collect()}
    hit = ("1900000000", "1999900000", "1999901000", "1999901005")
    assert found == {
        ("1", "2022"): hit, ("1", "2023"): hit,
        ("2", "2023"): ("0100000000", None, None, None), ("3", "2023"): ("1900000000", "a", "b", "c"),
    }
    free = matching.backfill_special_area(rows, keys, restrict=False)
    assert free.where("school_id = '2'").first()["psgc_brgy_id"] == "1999901005"
    assert free.count() == 4


def test_region_and_province_lists(spark):
    table = codes(spark, *BASE, ("0100100001", "Twin", "Prov"))
    meta = spark.createDataFrame(
        [("0100000000", "Region I", "0100100000"), ("0100000000", "Region I", "01-001 99999"), ("0100000000", "Region I", None), ("0100000000", "Region I", "9999900000")],
        "psgc_region_id string, region string, psgc_provhuc_id string",
    )
    assert [tuple(r) for r in matching.region_list(meta).collect()] == [("0100000000", "Region I")]
    assert [tuple(r) for r in matching.province_list(meta, table).collect()] == [
        ("0100100000", "Hilagang Baybay", "0100000000")
    ]


# --- location rules --------------------------------------------------------------------------


def test_bundled_location_rules(spark):
    rows = schools(
        spark,
        school(school_id="1", province="ISABELA", municipality=" Cabangan"),
        school(school_id="2", province="Bulacan", municipality="BALIUAG"),
        school(school_id="3", municipality="Kalookan City"),
        school(school_id="129009", province="Davao del Sur"),
        school(school_id="4", region="BARMM", province="Sulu"),
        school(school_id="5", region="Region XII", province="City of Cotabato"),
        school(school_id="6", province="Siquijor"),
        school(school_id="7", province="Maguindanao", municipality="UPI"),
        school(school_id="8", province="MAGUINDANAO", municipality="Buluan"),
        school(school_id="9", province="Maguindanao", municipality=None),
        school(school_id="10", division="Compostela Valley"),
    )
    found = {
        r["school_id"]: (r["region"], r["province"], r["municipality"], r["division"])
        for r in cleaning.clean_locations(rows, load_rules()).collect()
    }
    base = ("Region I", "Hilagang Baybay", "Lumang Tulay", "Division A")

    def like(**changes):
        return tuple(changes.get(n, v) for n, v in zip(("region", "province", "municipality", "division"), base))

    assert found == {
        "1": like(province="ISABELA", municipality="Cabagan"),
        "2": like(province="Bulacan", municipality="Baliwag City"),
        "3": like(municipality="Caloocan City"),
        "129009": like(province="DAVAO OCCIDENTAL"),
        "4": like(region="Region IX", province="Sulu"),
        "5": like(region="BARMM", province="Maguindanao del Norte"),
        "6": like(region="NIR", province="Siquijor"),
        "7": like(province="Maguindanao del Norte", municipality="UPI"),
        "8": like(province="Maguindanao del Sur", municipality="Buluan"),
        "9": like(province="Maguindanao", municipality=None),
        "10": like(division="Davao De Oro"),
    }
    assert cleaning.clean_locations(rows, {}).exceptAll(rows).isEmpty()


def test_headers_of_any_width(spark):
    """A full row of 16,384 cells, against plain loops; an empty row and rows of blanks."""
    wide = [None if i % 3 else f" l{i % 50} " for i in range(16_384)]
    rows = [wide, [], [None, "", " "], ["a"], [None, "a", None, "b", "a", None], ["x_1", "x", "x", "x"]]
    frame = spark.createDataFrame(list(enumerate(rows)), "k int, cells array<string>")
    filled = F.col("filled")
    found = frame.withColumn("filled", reshape.forward_fill(F.col("cells"))).withColumn("names", reshape.unique_headers(filled))
    start = time.perf_counter()
    by_key = {r.k: r for r in found.collect()}
    assert time.perf_counter() - start < 20
    for k, cells in enumerate(rows):
        last, out, seen, names = None, [], {}, []
        for cell in cells:
            last = (cell or "").strip() or last
            out.append(last)
            n = seen.get(last, 0)
            seen[last] = n + 1
            names.append(f"{last}_{n}" if n and last is not None else last)
        assert by_key[k].filled == out and by_key[k].names == names, k
