"""Star schema as Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import CONTRACTS
from ..operators.distinct import last_per_key
from ..operators.keys import label_to_key, with_surrogate_key
from ..operators.matching import match_places
from ..operators.quality import geography_orphans, key_report, orphans, require_contract, store_checked
from ..operators.reshape import union_all
from ..session import temporary_copies
from ..sources.csv_folder import read_coordinates
from ..sources.rules import load_rules, region_names, seed_tables
from .analysis import school_sketches
from .dropouts import dropout_tables
from .enrollment import enrollment_tables
from .geography import (
    address_bridge,
    address_dimension,
    geography,
    read_place_codes,
    with_address_hash,
)
from .stored import extend_lookup, is_stored, merge_by_key, replace_partitions, store
from .teachers import teacher_tables


#: Audit tables by the name of what they audit: stored with ``audit_`` before the name.
AUDITS = ["invalid_counts", "csv_rejects", "type_misfits", "teacher_rejects", "dropout_rejects", "dropout_metrics", "duplicate_keys"]
PLACE_KEYS = ["psgc_region_id", "psgc_provhuc_id", "psgc_muni_id", "psgc_brgy_id"]


def foreign_key_report(out: dict[str, DataFrame]) -> DataFrame:
    """(table, key, value, rows): values of foreign keys that their table does not hold."""
    parents = {
        "school_year_id": "school_years", "grade_id": "school_grades", "strand_id": "school_strands",
        "teacher_position_id": "teacher_positions",
    }
    found = []
    for name in ("school_levels", "enroll", "dropouts", "teachers"):
        for key, parent in parents.items():
            if name in out and parent in out and key in out[name].columns:
                missing = orphans(out[name], key, out[parent], "id")
                found.append(missing.select(F.lit(name).alias("table"), "key", F.col("value").cast("string"), "rows"))
    places = [c for c in PLACE_KEYS if c in out["geos"].columns]
    missing = geography_orphans(out["geos"], out["psgc"], places)
    found.append(missing.select(F.lit("geos").alias("table"), "key", F.col("value").cast("string"), "rows"))
    return union_all(found)


def load_warehouse(
    tables: dict[str, DataFrame],
    seeds: dict[str, DataFrame],
    folder: str,
    number_facts: bool = False,
    keep: bool = False,
) -> dict[str, DataFrame]:
    """Write lookups first, then the facts that point at them.

    Facts are partitioned by year key, the column most questions filter on.
    They keep their natural keys; ``number_facts`` adds a row number ``id`` to
    each, at the price of a range sort.  With ``keep`` a load adds to a stored
    warehouse: known labels keep their keys, places are replaced by id, the
    years of the load take the place of the stored ones and all other years stay.
    """
    spark = tables["enrollment"].sparkSession

    def numbered(df: DataFrame) -> DataFrame:
        return with_surrogate_key(df) if number_facts else df

    def lookup(df: DataFrame, column: str, name: str) -> DataFrame:
        known = spark.read.parquet(f"{folder}/{name}") if keep and is_stored(spark, folder, name) else None
        rows = extend_lookup(df, column, known)
        return store(rows, folder, name) if known is None else merge_by_key(rows, folder, name)

    def fact(df: DataFrame, name: str, partition: str) -> DataFrame:
        return (replace_partitions if keep else store)(numbered(df), folder, name, partition)

    out = {name: store(df, folder, name) for name, df in seeds.items()}
    grades = out["school_grades"]
    enrollment = tables["enrollment"]

    years = out["school_years"] = lookup(enrollment, "school_year", "school_years")
    strands = out["school_strands"] = lookup(enrollment, "strand", "school_strands")

    def with_year(df: DataFrame) -> DataFrame:
        return label_to_key(df, "school_year", years, "school_year_id", "school_year")

    def with_grade_and_strand(df: DataFrame) -> DataFrame:
        keyed = label_to_key(df, "grade", grades, "grade_id")
        return label_to_key(keyed, "strand", strands, "strand_id", "strand")

    year = "school_year_id"
    out["school_levels"] = fact(with_year(tables["school_levels"]), "school_levels", year)
    out["enroll"] = fact(with_grade_and_strand(with_year(enrollment)), "enroll", year)

    if "dropouts" in tables:
        facts = with_year(with_grade_and_strand(tables["dropouts"]))
        if not facts.isEmpty():  # an optional table: written only when it has rows
            out["dropouts"] = fact(facts, "dropouts", year)

    out["geos"] = fact(tables["geo"], "geos", "school_year")
    out["addr"] = fact(tables["address"], "addr", "school_year")
    out["psgc"] = (merge_by_key if keep else store)(last_per_key(tables["psgc"], ["id"]), folder, "psgc")

    if "school_year_meta" in tables:
        out["school_sketches"] = store(school_sketches(tables["school_year_meta"]), folder, "school_sketches")
    if "region_names" in tables:
        out["region_names"] = store(tables["region_names"], folder, "region_names")
    if "teachers" in tables and not tables["teachers"].isEmpty():
        positions = out["teacher_positions"] = lookup(tables["teachers"], "position", "teacher_positions")
        facts = label_to_key(with_year(tables["teachers"]), "position", positions, "teacher_position_id", "position")
        out["teachers"] = fact(facts, "teachers", year)
    for name in AUDITS:
        if name in tables:
            out[f"audit_{name}"] = store(tables[name], folder, f"audit_{name}")
    out["audit_foreign_keys"] = store(foreign_key_report(out), folder, "audit_foreign_keys")
    return out


def extract_tables(
    spark: SparkSession,
    enrollment_folder: str,
    place_workbook: str,
    coordinate_file: str,
    stage_folder: str,
    teacher_folder: str | None = None,
    dropout_folder: str | None = None,
    rules_file: str | None = None,
    regions_file: str | None = None,
) -> dict[str, DataFrame]:
    """All sources to contract-checked tables.

    A table that several later steps read is written to ``stage_folder`` once
    and read back from there.
    """
    rules = load_rules(rules_file)
    tables = enrollment_tables(spark, enrollment_folder, rules)

    def staged(name: str, df: DataFrame) -> None:
        tables[name] = store_checked(df, CONTRACTS[name], lambda rows: store(rows, stage_folder, name))

    staged("psgc", read_place_codes(spark, place_workbook))
    for name in ("school_year_meta", "enrollment", "school_levels"):
        staged(name, tables[name])
    staged("meta_psgc", match_places(tables["school_year_meta"], tables["psgc"], rules))

    hashed = with_address_hash(tables["meta_psgc"])
    dimension = address_dimension(hashed)
    staged("address", address_bridge(hashed, dimension))
    staged("geo", geography(hashed, dimension, read_coordinates(spark, coordinate_file)))
    tables["region_names"] = require_contract(
        region_names(spark, regions_file), CONTRACTS["region_names"]
    )
    if teacher_folder:
        tables |= teacher_tables(spark, teacher_folder)
        staged("teachers", tables["teachers"])
    if dropout_folder:
        tables |= dropout_tables(spark, dropout_folder)
        staged("dropouts", tables["dropouts"])
    # Sources may repeat a key, so that is no error; it is put on record.
    tables["duplicate_keys"] = key_report(tables, CONTRACTS)
    return tables


def build_warehouse(
    spark: SparkSession,
    out_folder: str,
    seeds_file: str | None = None,
    number_facts: bool = False,
    keep: bool = False,
    **sources: str,
) -> dict[str, DataFrame]:
    """Sources to warehouse; ``sources`` as for ``extract_tables``, ``keep`` as for ``load_warehouse``."""
    with temporary_copies(spark):
        tables = extract_tables(spark, stage_folder=f"{out_folder}/_stage", **sources)
        return load_warehouse(tables, seed_tables(spark, seeds_file), out_folder, number_facts, keep)
