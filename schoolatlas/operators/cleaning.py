"""Location corrections driven by a rule file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold


def _rule_join(meta: DataFrame, keys: dict[str, Column], rows: list[tuple]) -> DataFrame:
    """Left join to rules on the given key expressions; adds ``_value``.

    The rules are a list in driver memory, so their broadcast is bounded.  One
    hash lookup per row replaces one test per rule and row.
    """
    schema = ", ".join(f"{k} string" for k in [*keys, "_value"])
    rules = meta.sparkSession.createDataFrame(rows, schema)
    return meta.withColumns(keys).join(F.broadcast(rules), list(keys), "left")


def fix_province_municipality(meta: DataFrame, fixes: list[dict]) -> DataFrame:
    """Correct a municipality given its province; the last rule for a pair wins."""
    last = {
        (r["province"].strip().lower(), r["municipality"].strip().lower()): r["corrected"]
        for r in fixes
    }
    if not last:
        return meta
    keys = {"_prov": fold(F.col("province")), "_muni": fold(F.col("municipality"))}
    found = _rule_join(meta, keys, [(*pair, value) for pair, value in last.items()])
    return found.withColumn(
        "municipality", F.coalesce("_value", "municipality")
    ).select(*meta.columns)


def fix_municipality(meta: DataFrame, fixes: dict[str, str]) -> DataFrame:
    if not fixes:
        return meta
    rows = [(name, value) for name, value in {k.lower(): v for k, v in fixes.items()}.items()]
    found = _rule_join(meta, {"_muni": fold(F.col("municipality"))}, rows)
    return found.withColumn(
        "municipality", F.coalesce("_value", "municipality")
    ).select(*meta.columns)


def fix_province_by_school(meta: DataFrame, fixes: dict[str, list]) -> DataFrame:
    last = {str(i): name.upper() for name, ids in fixes.items() for i in ids}
    if not last:
        return meta
    found = _rule_join(
        meta, {"_school": F.col("school_id").cast("string")}, list(last.items())
    )
    return found.withColumn("province", F.coalesce("_value", "province")).select(
        *meta.columns
    )


def apply_special_fixes(meta: DataFrame, fixes: list[dict]) -> DataFrame:
    """Condition/assignment rules in order; each sees what earlier ones set."""
    for rule in fixes:
        holds = reduce(
            lambda a, b: a & b,
            [fold(F.col(c)) == v.lower() for c, v in rule["when"].items()],
        )
        meta = meta.withColumns(
            {
                c: F.when(holds, F.lit(v)).otherwise(F.col(c))
                for c, v in rule["set"].items()
            }
        )
    return meta


def assign_region_by_province(meta: DataFrame, rule: dict) -> DataFrame:
    provinces = [p.lower() for p in rule.get("provinces", [])]
    if not provinces:
        return meta
    return meta.withColumn(
        "region",
        F.when(
            fold(F.col("province")).isin(provinces), F.lit(rule.get("set_region", "NIR"))
        ).otherwise(F.col("region")),
    )


def split_maguindanao(meta: DataFrame, rule: dict) -> DataFrame:
    """The former province by municipality: listed ones north, others south.

    A row without a municipality is neither listed nor unlisted and stays.
    """
    if not rule:
        return meta
    north = [m.lower() for m in rule.get("norte_municipalities", [])]
    is_listed = fold(F.col("municipality")).isin(north)
    half = F.when(is_listed, F.lit("Maguindanao del Norte"))
    if rule.get("sur_is_default", True):
        half = half.when(~is_listed, F.lit("Maguindanao del Sur"))
    return meta.withColumn(
        "province",
        F.when(
            fold(F.col("province")) == "maguindanao", F.coalesce(half, F.col("province"))
        ).otherwise(F.col("province")),
    )


def clean_locations(meta: DataFrame, rules: dict) -> DataFrame:
    """All stages of a rule file, in order."""
    meta = fix_province_municipality(meta, rules.get("provincial_muni_fixes", []))
    meta = fix_municipality(meta, rules.get("municipality_fixes", {}))
    meta = fix_province_by_school(meta, rules.get("province_fixes_by_school_id", {}))
    meta = apply_special_fixes(meta, rules.get("special_fixes", []))
    meta = assign_region_by_province(meta, rules.get("nir_rule", {}))
    return split_maguindanao(meta, rules.get("maguindanao_split", {}))
