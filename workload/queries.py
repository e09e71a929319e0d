"""One query per operator of the library, over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from schoolatlas.functions import counts, labels, places, school_names, text
from schoolatlas.operators import cleaning, distinct, joins, keys, matching, quality, reshape
from schoolatlas.plans import analysis, dropouts, enrollment, geography, stored, teachers
from schoolatlas.session import durable, shared_folder
from schoolatlas.sources import csv_folder
from schoolatlas.sources import rules as rule_files
from schoolatlas.sources.sheets import column_indexes

from . import inputs
from .inputs import derive, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _day(col: str) -> Column:
    return F.col(col).cast("date").cast("string")


# --- enrollment ---------------------------------------------------------------


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    return derive(spark, sf, inputs.WIDE_ENROLLMENT)


@query
def q01_wide_enrollment_totals(spark: SparkSession, sf: str) -> DataFrame:
    facts = enrollment.enrollment_facts([_wide(spark, sf)])
    return facts.groupBy("school_year", "grade", "strand", "sex").agg(
        F.sum("num_students").alias("num_students"), F.count("*").alias("cells")
    )


@query
def q02_unpivot_all(spark: SparkSession, sf: str) -> DataFrame:
    wide = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("priority"),
    )
    return reshape.wide_to_long(wide, ["order_id"], "name", "value")


@query
def q03_sanitize_counts(spark: SparkSession, sf: str) -> DataFrame:
    raw, cell = F.col("raw"), F.col("cell")
    return derive(spark, sf, inputs.DIRTY_NUMBERS).select(
        "id",
        counts.whole_count(raw).alias("whole"),
        counts.lenient_double(raw).alias("as_double"),
        counts.lenient_long(cell).alias("as_long"),
        counts.truncated_number(cell).alias("truncated"),
        counts.cell_text(cell).alias("cell"),
        counts.header_text(cell).alias("header"),
        counts.count_as_long(cell).alias("casted"),
    )


@query
def q04_label_split(spark: SparkSession, sf: str) -> DataFrame:
    split = reshape.with_label_parts(derive(spark, sf, inputs.LABELS), "label")
    return split.groupBy("label", "grade", "strand", "sex").agg(
        F.count("*").alias("rows_seen")
    )


@query
def q05_invalid_audit(spark: SparkSession, sf: str) -> DataFrame:
    audit = enrollment.invalid_counts([_wide(spark, sf)])
    return audit.withColumn("samples", F.array_join("samples", "|"))


@query
def q05_reject_reasons(spark: SparkSession, sf: str) -> DataFrame:
    numbers = derive(spark, sf, inputs.DIRTY_NUMBERS)
    value = counts.whole_count(F.col("raw"))
    valid, rejected = quality.split_rejects(
        numbers, {"missing": F.col("raw").isNull(), "invalid": value.isNull(), "zero": value == 0}
    )
    judged = valid.select("id", F.lit("valid").alias("reason")).unionByName(
        rejected.select("id", F.col("reject_reason").alias("reason"))
    )
    return judged.groupBy("reason").agg(F.count("*").alias("rows_seen"), F.sum("id").alias("id_sum"))


@query
def q06_school_year_from_name(spark: SparkSession, sf: str) -> DataFrame:
    names = derive(spark, sf, inputs.FILE_NAMES)
    return names.groupBy("file_name").agg(F.count("*").alias("orders_seen")).withColumn(
        "school_year", counts.school_year(F.col("file_name"))
    )


@query
def q07_offered_levels(spark: SparkSession, sf: str) -> DataFrame:
    return enrollment.offered_levels(derive(spark, sf, inputs.SCHOOL_OFFERS))


@query
def q07_levels_from_meta(spark: SparkSession, sf: str) -> DataFrame:
    meta = derive(spark, sf, inputs.SCHOOL_OFFERS)
    _, levels = enrollment.offered_levels_from_meta(meta, meta)
    return levels


# --- one row per key, lookups --------------------------------------------------


@query
def q08_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_custkey", _day("o_orderdate").alias("order_day"), "o_orderkey", "o_totalprice"
    )
    return distinct.last_per_key(orders, ["o_custkey"], F.col("order_day"))


@query
def q09_last_occurrence(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_partkey", "l_linenumber", "l_orderkey", "l_suppkey", "l_quantity"
    )
    return distinct.last_per_key(
        lines, ["l_partkey"], F.col("l_linenumber"), F.col("l_orderkey")
    )


@query
def q10_any_per_key_stable(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_type", "value", "event_id")
    return distinct.first_per_key(events, ["user_id", "event_type"])


@query
def q11_distinct_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return keys.build_lookup(table(spark, sf, "orders"), "o_orderpriority")


@query
def q12_label_to_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    labelled = orders.withColumn(
        "o_orderpriority",
        F.when(F.col("o_orderkey") % 17 == 0, None)
        .when(F.col("o_orderkey") % 19 == 0, F.lower("o_orderpriority"))
        .otherwise(F.col("o_orderpriority")),
    )
    lookup = keys.build_lookup(orders, "o_orderpriority")
    return keys.label_to_key(
        labelled, "o_orderpriority", lookup, "priority_id", label="o_orderpriority"
    )


@query
def q12_extract_lookup(spark: SparkSession, sf: str) -> DataFrame:
    facts, lookup = keys.extract_lookup(
        table(spark, sf, "part").select("p_partkey", "p_type"), "p_type", "type_id"
    )
    used = facts.groupBy("type_id").agg(F.count("*").alias("parts"))
    return joins.lookup_join(
        lookup.withColumnRenamed("id", "type_id"), used, ["type_id"]
    )


# --- headers and cells ----------------------------------------------------------


def _event_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Header rows of 16 cells: every 16 events are one row, two rows a sheet."""
    events = table(spark, sf, "events")
    label = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).when(
        F.col("event_id") % 5 == 0, F.concat(F.lit(" "), "event_type", F.lit("  x "))
    )
    cells = events.select(
        F.floor(F.col("event_id") / 16).alias("row_id"),
        (F.col("event_id") % 16).alias("col_idx"),
        label.alias("label"),
    )
    # Sixteen cells meet per row, whatever the size of the table.
    return cells.groupBy("row_id").agg(
        F.array_sort(F.collect_list(F.struct("col_idx", "label"))).alias("cells")
    ).select("row_id", F.col("cells.label").alias("cells"))


@query
def q13_forward_fill(spark: SparkSession, sf: str) -> DataFrame:
    rows = _event_sheets(spark, sf)
    return rows.select(
        "row_id", F.posexplode(reshape.forward_fill(F.col("cells"))).alias("col_idx", "label")
    )


@query
def q14_unique_headers(spark: SparkSession, sf: str) -> DataFrame:
    rows = _event_sheets(spark, sf).withColumn(
        "indexes", F.transform("cells", lambda _, i: i * 2)
    )
    named = rows.withColumn(
        "named", reshape.named_headers(F.col("cells"), F.col("indexes"))
    )
    return named.select(
        "row_id",
        F.posexplode(reshape.unique_headers(F.col("named"))).alias("col_idx", "header"),
    )


@query
def q15_header_tokens(spark: SparkSession, sf: str) -> DataFrame:
    rows = _event_sheets(spark, sf).withColumn(
        "cells", reshape.forward_fill(F.col("cells"))
    )
    sheets = rows.groupBy(F.floor(F.col("row_id") / 2).alias("sheet_id")).agg(
        F.array_sort(F.collect_list(F.struct("row_id", "cells"))).alias("rows")
    )
    joined = reshape.joined_headers(F.col("rows.cells"))
    return sheets.select(
        "sheet_id", F.posexplode(joined).alias("col_idx", "header")
    )


@query
def q16_column_ranges(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    cells = lines.select(F.array(*[F.col(c).cast("string") for c in columns]).alias("cells"))
    chosen = column_indexes(" F, a:B,D:d,,I ")
    picked = [
        F.struct(F.lit(i).alias("col_idx"), F.get("cells", F.lit(i)).alias("cell")) for i in chosen
    ]
    return (
        cells.select(F.inline(F.array(*picked)))
        .groupBy("col_idx")
        .agg(
            F.count("cell").alias("cells"),
            F.min("cell").alias("least"),
            F.sum(F.length("cell")).alias("letters"),
        )
    )


@query
def q17_union_coerce(spark: SparkSession, sf: str) -> DataFrame:
    first = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    second = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").cast("string").alias("balance"),
        F.col("s_nationkey").alias("nation"),
    )
    return reshape.union_coerced([first, second])


# --- scalar texts ----------------------------------------------------------------


@query
def q18_region_names(spark: SparkSession, sf: str) -> DataFrame:
    schools = derive(spark, sf, inputs.SCHOOLS).select("school_id", "school_name", "region")
    return matching.attach_region(schools, _keys(spark, sf, REGIONS))


@query
def q19_place_names(spark: SparkSession, sf: str) -> DataFrame:
    schools = derive(spark, sf, inputs.SCHOOLS)
    return schools.select(
        "school_id",
        places.region_name(F.col("region")).alias("region"),
        places.place_name(F.col("province")).alias("province"),
        places.place_name(F.col("municipality")).alias("municipality"),
        places.barangay_name(F.col("barangay")).alias("barangay"),
        places.trailing_roman(F.col("barangay")).alias("numbered"),
        places.repair_enye(F.col("barangay")).alias("repaired"),
    )


@query
def q20_title_case(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return documents.select("doc_id", text.title_words(F.col("text")).alias("title"))


@query
def q21_school_names(spark: SparkSession, sf: str) -> DataFrame:
    raw = derive(spark, sf, inputs.SCHOOL_NAMES)
    return enrollment.with_clean_names(raw)


@query
def q21_school_names_by_row(spark: SparkSession, sf: str) -> DataFrame:
    segments = derive(spark, sf, inputs.SCHOOLS)
    return segments.select(
        "school_id", school_names.clean_school_name(F.col("school_name")).alias("school_name")
    )


@query
def q22_street_address(spark: SparkSession, sf: str) -> DataFrame:
    return derive(spark, sf, inputs.STREETS).select(
        "id",
        text.street_address(F.col("street")).alias("street"),
        text.annex_status(F.col("annex")).alias("annex"),
        text.null_to_blank(text.dash_to_null(F.col("income"))).alias("income"),
    )


@query
def q23_ids(spark: SparkSession, sf: str) -> DataFrame:
    lis, beis, code = F.col("lis"), F.col("beis"), F.col("code")
    ten = counts.place_code(code)
    return derive(spark, sf, inputs.SCHOOL_IDS).select(
        "k",
        counts.school_id_from(lis, beis).alias("school_id"),
        counts.school_id_text(lis).alias("id_text"),
        counts.digits_only(beis).alias("digits"),
        ten.alias("code"),
        counts.region_part(ten).alias("region"),
        counts.province_part(ten).alias("province"),
        counts.municipality_of(ten).alias("municipality"),
        F.array_join(counts.allowed_prefixes(code), "|").alias("prefixes"),
    )


# --- place matching ----------------------------------------------------------------


def _codes(spark: SparkSession, sf: str) -> DataFrame:
    """Place codes, stored once as the warehouse job does."""
    return durable(derive(spark, sf, inputs.PLACE_CODES))


def _keys(spark: SparkSession, sf: str, levels: str = "true") -> DataFrame:
    """The names of places with their codes: every step of a query reads this one relation."""
    codes = derive(spark, sf, inputs.PLACE_CODES).where(levels)
    return matching.place_keys(codes, inputs.REGION_ALIASES)


REGIONS, ABOVE_BARANGAY = "geo = 'Reg'", "geo <> 'Bgy'"


def _in_region(spark: SparkSession, sf: str, keys: DataFrame) -> DataFrame:
    return matching.attach_region(derive(spark, sf, inputs.SCHOOLS), keys)


def _in_barangay(spark: SparkSession, sf: str, keys: DataFrame) -> DataFrame:
    matched = matching.attach_province(_in_region(spark, sf, keys), keys)
    return matching.attach_barangay(matching.attach_municipality(matched, keys), keys)


@query
def q24_province_huc(spark: SparkSession, sf: str) -> DataFrame:
    keys = _keys(spark, sf, ABOVE_BARANGAY)
    return matching.attach_province(_in_region(spark, sf, keys), keys).select(
        "school_id", "region", "province", "psgc_region_id", "psgc_provhuc_id"
    )


@query
def q25_municipality_prefix(spark: SparkSession, sf: str) -> DataFrame:
    keys = _keys(spark, sf, ABOVE_BARANGAY)
    matched = matching.attach_province(_in_region(spark, sf, keys), keys)
    return matching.attach_municipality(matched, keys).select(
        "school_id", "psgc_provhuc_id", "psgc_muni_id"
    )


@query
def q26_barangay(spark: SparkSession, sf: str) -> DataFrame:
    return _in_barangay(spark, sf, _keys(spark, sf)).select(
        "school_id", "psgc_muni_id", "psgc_brgy_id"
    )


@query
def q27_corrections(spark: SparkSession, sf: str) -> DataFrame:
    keys = _keys(spark, sf)
    rules = derive(spark, sf, inputs.CORRECTIONS)
    matched = matching.correct_barangays(_in_barangay(spark, sf, keys), keys, rules)
    return matched.select("school_id", "barangay", "psgc_muni_id", "psgc_brgy_id")


@query
def q28_backfill(spark: SparkSession, sf: str) -> DataFrame:
    keys = _keys(spark, sf)
    matched = _in_barangay(spark, sf, keys)
    return matching.backfill_special_area(matched, keys, **inputs.SPECIAL_AREA).select(
        "school_id", *matching.PLACE_IDS
    )


@query
def q28_backfill_anywhere(spark: SparkSession, sf: str) -> DataFrame:
    keys = _keys(spark, sf)
    matched = _in_barangay(spark, sf, keys)
    filled = matching.backfill_special_area(
        matched, keys, restrict=False, **inputs.SPECIAL_AREA
    )
    return filled.select("school_id", *matching.PLACE_IDS)


@query
def q29_match_all(spark: SparkSession, sf: str) -> DataFrame:
    schools = derive(spark, sf, inputs.SCHOOL_YEARS).drop("k")
    codes = _codes(spark, sf)
    matched = matching.match_places(
        schools, codes, {"region_psgc_map": inputs.REGION_ALIASES}
    )
    return matched.groupBy(
        "school_year", "division", "division_id", "province", *matching.PLACE_IDS
    ).agg(F.count("*").alias("school_years"))


@query
def q30_divisions(spark: SparkSession, sf: str) -> DataFrame:
    meta = derive(spark, sf, inputs.DIVISIONS)
    return matching.divisions(meta)


@query
def q31_province_list(spark: SparkSession, sf: str) -> DataFrame:
    keys = _keys(spark, sf, ABOVE_BARANGAY)
    matched = matching.attach_province(_in_region(spark, sf, keys), keys)
    return matching.province_list(matched, _codes(spark, sf))


@query
def q31_region_list(spark: SparkSession, sf: str) -> DataFrame:
    return matching.region_list(_in_region(spark, sf, _keys(spark, sf, REGIONS)))


@query
def q32_location_rules(spark: SparkSession, sf: str) -> DataFrame:
    meta = derive(spark, sf, inputs.LOCATIONS)
    return cleaning.clean_locations(meta, inputs.LOCATION_RULES)


# --- addresses and geography -----------------------------------------------------


def _hashed(spark: SparkSession, sf: str) -> DataFrame:
    matched = _in_barangay(spark, sf, _keys(spark, sf)).withColumn(
        "school_year", F.lit("2023-2024")
    )
    # Matched rows are stored before the address steps, as in the warehouse job.
    return durable(geography.with_address_hash(matched))


@query
def q33_address_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return geography.address_dimension(_hashed(spark, sf))


@query
def q33_address_bridge(spark: SparkSession, sf: str) -> DataFrame:
    hashed = _hashed(spark, sf)
    return geography.address_bridge(hashed, geography.address_dimension(hashed))


@query
def q34_geo_fact(spark: SparkSession, sf: str) -> DataFrame:
    hashed = _hashed(spark, sf)
    coordinates = derive(spark, sf, inputs.COORDINATES)
    placed = geography.geography(hashed, geography.address_dimension(hashed), coordinates)
    return placed.select(
        "school_id", "school_year", "_addr_hash", "address_id", "longitude", "latitude",
        *matching.PLACE_IDS,
    )


# --- teachers, dropouts, quality ----------------------------------------------------


@query
def q35_teachers_fact(spark: SparkSession, sf: str) -> DataFrame:
    wide = derive(spark, sf, inputs.TEACHERS_WIDE)
    positions = [F.col(f"p{i}") for i in range(len(inputs.TEACHER_POSITIONS))]
    headers = ["LIS School ID", " Beis School ID", *inputs.TEACHER_POSITIONS]
    rows = wide.select(
        "school_year",
        "level",
        F.lit("sheet").alias("source_file"),
        F.array(*[F.lit(h) for h in headers]).alias("column_labels"),
        F.array("lis", "beis", *positions).alias("values"),
    )
    facts, _ = teachers.judge_teachers(teachers.melt_teachers(rows))
    return facts


def _dropouts(spark: SparkSession, sf: str, *layouts: str) -> DataFrame:
    """One sheet of all orders per layout, under that layout's header."""
    sheets = [
        (f"{y}-{int(y) + 1}", y, ["School ID", *inputs.DROPOUT_LABELS[y]]) for y in layouts
    ]
    headers = spark.createDataFrame(
        sheets, "school_year string, style string, column_labels array<string>"
    ).select(
        "school_year",
        F.concat("school_year", F.lit("-dropouts.xlsx")).alias("source_file"),
        "column_labels",
        F.transform(
            "column_labels", lambda label: labels.dropout_label(label, F.col("style"))
        ).alias("label_parts"),
    )
    wide = derive(spark, sf, inputs.DROPOUT_ROWS)
    rows = wide.select(
        F.explode(F.array(*[F.lit(s[0]) for s in sheets])).alias("school_year"),
        "source_row",
        F.array("raw_school_id", *[F.col(f"c{i}") for i in range(5)]).alias("values"),
    )
    # One header per sheet: as many rows as layouts.
    return dropouts.melt_sheet(rows.join(F.broadcast(headers), "school_year"))


def _dropout_facts(spark: SparkSession, sf: str, layout: str) -> DataFrame:
    valid, _ = dropouts.judge(_dropouts(spark, sf, layout))
    stamped = valid.withColumn("ingested_at", F.lit(None).cast("timestamp"))
    return dropouts.latest_facts(stamped).drop("ingested_at")


@query
def q36_dropouts_2022(spark: SparkSession, sf: str) -> DataFrame:
    return _dropout_facts(spark, sf, "2022")


@query
def q37_dropouts_2023(spark: SparkSession, sf: str) -> DataFrame:
    return _dropout_facts(spark, sf, "2023")


@query
def q38_dropouts_2024(spark: SparkSession, sf: str) -> DataFrame:
    return _dropout_facts(spark, sf, "2024")


@query
def q38_dropout_rejects(spark: SparkSession, sf: str) -> DataFrame:
    parsed = _dropouts(spark, sf, *inputs.DROPOUT_LABELS)
    _, rejected = dropouts.judge(parsed)
    return rejected.groupBy("school_year", "reject_reason").agg(
        F.count("*").alias("rows_seen"), F.min("raw_col").alias("least_label")
    )


@query
def q39_quality_metrics(spark: SparkSession, sf: str) -> DataFrame:
    parsed = _dropouts(spark, sf, *inputs.DROPOUT_LABELS)
    return dropouts.dropout_metrics(parsed)


@query
def q39_null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_counts(derive(spark, sf, inputs.SCHOOLS))


@query
def q39_duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    years = derive(spark, sf, inputs.SCHOOL_YEARS)
    repeated = quality.duplicate_keys(years, ["school_id", "school_year"])
    return repeated.withColumnRenamed("rows", "rows_seen")


@query
def q40_orphans(spark: SparkSession, sf: str) -> DataFrame:
    # The lines of every seventh order point at an order that is not there.
    key = F.when(F.col("l_orderkey") % 7 == 0, -F.col("l_orderkey") - 1).otherwise(F.col("l_orderkey"))
    lines = table(spark, sf, "lineitem").select(key.alias("l_orderkey"), "l_partkey")
    orders = table(spark, sf, "orders")
    found = quality.orphans(lines, "l_orderkey", orders, "o_orderkey")
    return found.withColumnRenamed("rows", "rows_seen")


@query
def q40_place_orphans(spark: SparkSession, sf: str) -> DataFrame:
    codes = _codes(spark, sf)
    matched = _in_barangay(spark, sf, matching.place_keys(codes, inputs.REGION_ALIASES))
    # Regions and sub-municipalities are known by other ids, so those in use are orphans.
    renamed = F.when(F.col("geo").isin("SubMun", "Reg"), F.concat(F.lit("x"), "id")).otherwise(F.col("id"))
    found = quality.geography_orphans(matched, codes.withColumn("id", renamed), matching.PLACE_IDS)
    return found.withColumnRenamed("rows", "rows_seen")


# --- analysis ---------------------------------------------------------------------


@query
def q41_rows_per_school_year(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.rows_per_school_year(derive(spark, sf, inputs.SCHOOL_YEARS))


@query
def q41_schools_per_year(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.schools_per_year(derive(spark, sf, inputs.SCHOOL_YEARS), "DepEd")


@query
def q41_school_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Schools of every year over all management types, from stored sketches, and whether they keep the error bound."""
    years = derive(spark, sf, inputs.SCHOOL_YEARS)
    found = analysis.schools_from_sketches(durable(analysis.school_sketches(years)), "school_year")
    exact = years.groupBy("school_year").agg(F.count_distinct("school_id").alias("exact"))
    error = F.abs(F.col("num_schools") - F.col("exact")) / F.col("exact")
    return exact.join(found, "school_year").select(
        "school_year", F.col("exact").alias("num_schools"), (error <= analysis.SKETCH_ERROR).alias("within")
    )


@query
def q42_unmatched_names(spark: SparkSession, sf: str) -> DataFrame:
    found = analysis.unmatched_barangays(_in_barangay(spark, sf, _keys(spark, sf)))
    return found.withColumnRenamed("count", "rows_seen")


@query
def q43_name_search(spark: SparkSession, sf: str) -> DataFrame:
    found = analysis.search_places(_codes(spark, sf), "RING", "0100101000", "Bgy")
    everywhere = analysis.search_places(_codes(spark, sf), "RING", "", "Bgy")
    return found.select(F.lit("municipality").alias("scope"), "id", "name", "old_names").unionByName(
        everywhere.select(F.lit("all").alias("scope"), "id", "name", "old_names")
    )


@query
def q43_sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Limit is the feature: three rows of a table, here the least three."""
    return table(spark, sf, "part").select("p_partkey", "p_name").orderBy("p_partkey").limit(3)


@query
def q45_seed_tables(spark: SparkSession, sf: str) -> DataFrame:
    grades = rule_files.seed_tables(spark)["school_grades"]
    parts = reshape.with_label_parts(derive(spark, sf, inputs.LABELS), "label")
    keyed = keys.label_to_key(parts.select("grade"), "grade", grades, "grade_id")
    return keyed.groupBy("grade_id").agg(F.count("*").alias("rows_seen"))


@query
def q45_region_aliases(spark: SparkSession, sf: str) -> DataFrame:
    names = rule_files.region_names(spark)
    used = derive(spark, sf, inputs.SCHOOL_IDS).select(
        F.rpad(counts.region_part(counts.place_code(F.col("code"))), 10, "0").alias("psgc_region_id")
    ).groupBy("psgc_region_id").agg(F.count("*").alias("schools"))
    return joins.lookup_join(used, names, ["psgc_region_id"])


@query
def q46_view_from_sql(spark: SparkSession, sf: str) -> DataFrame:
    return rule_files.sql_view(
        spark,
        inputs.VIEW_FILE,
        view="deped_schools",
        tables={"school_years": derive(spark, sf, inputs.SCHOOL_YEARS)},
    )


@query
def q47_reference_province_name(spark: SparkSession, sf: str) -> DataFrame:
    raw = _codes(spark, sf).withColumns(
        {
            "id": F.regexp_replace("id", "^0+", ""),
            "income_class": F.when(F.col("geo") == "Mun", F.concat("cc", F.lit("*"))),
            "urban_rural": F.lit("-"),
            "2024_pop": F.lit(None).cast("string"),
            "status": F.lit(""),
        }
    )
    return geography.clean_place_codes(raw).select(
        "id", "name", "old_names", "city_class", "income_class", "urban_rural", "status"
    )


@query
def q48_csv_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as registers write them, read with the options of the CSV sources."""
    name = F.concat(F.lit('Order "'), F.col("o_orderpriority"), F.lit('", no. '), F.col("o_orderkey").cast("string"))
    quoted = F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))
    key = F.col("o_orderkey").cast("string")
    line = (
        F.when(F.col("o_orderkey") % 10 == 3, F.concat_ws(",", key, quoted, "o_orderstatus", F.lit("extra")))
        .when(F.col("o_orderkey") % 10 == 7, F.concat_ws(",", key, quoted))
        .otherwise(F.concat_ws(",", key, quoted, "o_orderstatus"))
    )
    schema = f"school_id string, school_name string, status string, {csv_folder.BAD_LINE} string"
    parsed = F.from_csv(line, schema, csv_folder.OPTIONS)
    lines = table(spark, sf, "orders").select("o_orderkey", parsed.alias("p"))
    fits = F.col("p")[csv_folder.BAD_LINE].isNull()
    return lines.select(
        "o_orderkey",
        (~fits).alias("rejected"),
        *[F.when(fits, F.col("p")[c]).alias(c) for c in ("school_id", "school_name", "status")],
    )


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


@query
def q49_csv_records(spark: SparkSession, sf: str) -> DataFrame:
    """A register of all orders as CSV files whose names hold commas, quotes and line breaks."""
    folder = _own_folder(spark)
    key = F.col("o_orderkey").cast("string")
    breaks = F.when(F.col("o_orderkey") % 5 == 0, F.lit("\n\n")).when(F.col("o_orderkey") % 3 == 0, F.lit("\n")).otherwise(F.lit(" "))
    name = F.concat(F.lit('Order "'), F.col("o_orderpriority"), F.lit('",'), breaks, F.lit("no. "), key)
    register = table(spark, sf, "orders").select(
        key.alias("school_id"), name.alias("school name"), F.col("o_orderstatus").alias("status")
    )
    register.write.options(header=True, escape='"').csv(folder)
    found = [csv_folder.read_table(spark, paths, header) for header, paths in csv_folder.csv_headers(spark, folder)]
    (rows,) = csv_folder.fitting(found)
    return rows.select("school_id", F.col("school name").alias("school_name"), "status")


@query
def q50_insert_or_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in two loads: the second changes some rows, adds others and moves a few to another year."""
    folder = _own_folder(spark)
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("status")
    )
    stored.merge_by_key(orders.where("id % 3 <> 0"), folder, "register", partition="year")
    changed = orders.where("id % 4 = 0").withColumn("status", F.lower("status"))
    changed = changed.withColumn("year", F.when(F.col("id") % 40 == 0, F.col("year") + 1).otherwise(F.col("year")))
    return stored.merge_by_key(changed, folder, "register", partition="year").select(
        F.col("id").cast("bigint"), F.col("year").cast("int"), "status"
    )


@query
def q51_stable_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Labels in two loads: known ones keep their keys, new ones follow."""
    labels = table(spark, sf, "orders").select(
        F.concat_ws("-", "o_orderpriority", (F.col("o_orderkey") % 50).cast("string")).alias("label"), "o_orderkey"
    )
    known = durable(stored.extend_lookup(labels.where("o_orderkey % 50 >= 20"), "label", None))
    return stored.extend_lookup(labels, "label", known)


@query
def q52_type_misfits(spark: SparkSession, sf: str) -> DataFrame:
    """Registers of orders by year: what later files hold that the first file's types do not take."""
    late = F.col("o_orderkey") % 11 == 0
    rows = table(spark, sf, "orders").select(
        F.concat(F.year("o_orderdate").cast("string"), F.lit(".csv")).alias("source_file"),
        F.when((F.year("o_orderdate") > 1996) & late, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")).alias("customer"),
        F.when(late, F.lit("")).otherwise(F.concat(F.col("o_orderkey").cast("string"), F.lit(".0"))).alias("share"),
        F.col("o_orderstatus").alias("status"),
        F.when((F.year("o_orderdate") > 1997) & late, F.lit(" 1.5 ")).otherwise(F.lit("2")).alias("weight"),
    )
    return quality.type_misfits(quality.type_profile([rows], "source_file", []), "source_file")
