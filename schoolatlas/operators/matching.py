"""Region, province, municipality and barangay codes for school addresses.

``place_keys`` turns the official place table (id, name, geo, cc, city_class, ...) into one
relation in one pass: (kind, scope, name) to the least code, stored.  ``kind`` is a
level of the address, ``scope`` the digits of the place above.  Each step is a left join of its probes
with that relation, so no step reads, normalizes or aggregates the place table anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.counts import (
    digits_only,
    municipality_of,
    municipality_part,
    province_part,
    province_scope,
    region_part,
)
from ..functions.places import barangay_name, place_name, region_name
from ..functions.text import fold, title_words
from ..session import durable
from .distinct import first_per_key
from .joins import lookup_join, per_distinct, spread
from .ordinals import with_group_ordinal
from .reshape import leading_columns

PLACE_IDS = ["psgc_region_id", "psgc_provhuc_id", "psgc_muni_id", "psgc_brgy_id"]

# Codes of the places that the address texts name in their own way.
BANGSAMORO_REGION = "1900000000"
SPECIAL_AREA = "1999900000"
SPECIAL_AREA_TEXT = "(sga - north cotabato)"
SPECIAL_AREA_OLD_CODE = "1247"
ZAMBOANGA_REGION = "0900000000"
ISABELA_CITY = "0990101000"
ISABELA_CITY_TEXT = "city of isabela"
REGION_ONLY_MUNICIPALITY = "pateros"

# Column order of the matched table.
MATCHED_ORDER = [
    "school_id", "school_name",
    "division", "division_id",
    "region", "psgc_region_id",
    "province", "psgc_provhuc_id",
    "municipality", "psgc_muni_id",
    "barangay", "psgc_brgy_id",
    "school_district", "legislative_district", "street_address",
]


ANYWHERE = "*"


def _least(value: Column, name: str) -> Column:
    return F.min(value).alias(name)


# --- the key relation ----------------------------------------------------------


def _region_names(official: Column, aliases: dict[str, str | None]) -> Column:
    """The texts that stand for a region: its aliases, and its own name unless that is an alias.

    An alias stands in for the official name; one that maps to null hides the
    name, so that rows with it are dropped.
    """
    empty = F.array().cast("array<string>")
    own = F.when(official.isin(*aliases), empty).otherwise(F.array(official)) if aliases else F.array(official)
    by_target: dict[str, list[str]] = {}
    for alias, target in aliases.items():
        if target is not None:
            by_target.setdefault(target, []).append(alias)
    others = [
        F.when(official == target, F.array(*map(F.lit, names))).otherwise(empty) for target, names in by_target.items()
    ]
    return F.concat(own, *others)


def place_keys(codes: DataFrame, aliases: dict[str, str | None] | None = None) -> DataFrame:
    """(kind, scope, name, id): every way to name a place, with the least of the codes that fit.

    Of cities, highly urbanized ones come before sub-municipalities.  A
    municipality stands under its province's five digits, so a prefix search is
    an equality on them, and under ``ANYWHERE`` for rows without a province.
    Barangays stand under their municipality by cleaned and by upper-case name,
    and under their old code's and own code's first digits.  A caller that needs
    fewer levels passes the codes of these levels only.  The places are spread
    before their names are normalized, which is the costly part.
    """
    is_bgy, is_reg = F.col("geo") == "Bgy", F.col("geo") == "Reg"
    huc = F.coalesce(F.lower("city_class").contains("huc"), F.lit(False))
    named = spread(codes.select("id", "geo", "name", "cc", huc.alias("huc"))).select(
        "id", "geo", "name", "cc", "huc",
        F.when(is_bgy, barangay_name(F.col("name"))).when(is_reg, region_name(F.col("name")))
        .otherwise(place_name(F.col("name"))).alias("normal"),
    )
    place, geo, name, region = F.col("id"), F.col("geo"), F.col("normal"), region_part(F.col("id"))
    is_place = ~is_bgy & ~is_reg
    is_municipality = geo.isin("SubMun", "City", "Mun")

    def entry(kind: str, scope: Column, text: Column, rank: Column | None = None) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), scope.alias("scope"), text.alias("name"),
            F.struct((F.lit(0) if rank is None else rank).alias("rank"), place.alias("id")).alias("best"),
        )

    entries = F.array(
        F.when(is_place & (F.col("huc") | (geo == "SubMun")), entry("city", region, name, F.when(F.col("huc"), 0).otherwise(1))),
        F.when(geo.isin("City", "Mun") & (name == REGION_ONLY_MUNICIPALITY), entry("only", region, F.lit(""))),
        F.when(F.lower(geo) == "prov", entry("province", region, name)),
        F.when(is_municipality, entry("municipality", province_part(place), name)),
        F.when(is_municipality, entry("municipality", F.lit(ANYWHERE), name)),
        F.when(is_bgy, entry("barangay", municipality_part(place), name)),
        F.when(is_bgy, entry("upper", municipality_part(place), F.upper("name"))),
        F.when(is_bgy, entry("old", area_scope(F.substring("cc", 1, 4), place), fold(F.col("name")))),
    )
    regions = F.transform(
        F.when(is_reg, _region_names(name, aliases or {})), lambda text: entry("region", F.lit(""), text)
    )
    every = F.filter(F.concat(entries, F.coalesce(regions, F.array())), lambda e: e.isNotNull())
    found = (
        named.select(F.explode(every).alias("e"))
        .where("e.scope IS NOT NULL AND e.name IS NOT NULL")
        .groupBy("e.kind", "e.scope", "e.name")
        .agg(F.min("e.best").alias("best"))
    )
    return durable(found.select("kind", "scope", "name", F.col("best.id").alias("id")).sortWithinPartitions("kind", "scope"))


def area_scope(old_code: Column, place: Column) -> Column:
    return F.concat_ws("/", old_code, F.substring(place, 1, 5))


def _probe(rows: DataFrame, keys: DataFrame, kind: str, scope: Column, name: Column, found: str) -> DataFrame:
    """Add ``found``: the code of (scope, name); null finds nothing."""
    lookup = keys.where(F.col("kind") == kind).select(
        F.col("scope").alias("_scope"), F.col("name").alias("_name"), F.col("id").alias(found)
    )
    keyed = rows.withColumns({"_scope": scope, "_name": name})
    return lookup_join(keyed, lookup, ["_scope", "_name"]).drop("_scope", "_name")


# --- region ------------------------------------------------------------------


def attach_region(meta: DataFrame, keys: DataFrame) -> DataFrame:
    """Add ``psgc_region_id``; rows whose region has no code are dropped.

    The rows are spread first: this step and those that follow normalize several
    texts of each.
    """
    return _find_region(spread(meta), keys)


def _find_region(meta: DataFrame, keys: DataFrame) -> DataFrame:
    # A key that can't be null gets no null filter, which would normalize the texts once more, before the spread.
    name = F.coalesce(region_name(F.col("region")), F.lit(""))
    found = _probe(meta.where("region IS NOT NULL"), keys, "region", F.lit(""), name, "psgc_region_id")
    return leading_columns(
        found.where("psgc_region_id IS NOT NULL"), ["region", "psgc_region_id", "school_id", "school_name"]
    )


# --- province, highly urbanized city, sub-municipality ------------------------


def attach_province(meta: DataFrame, keys: DataFrame) -> DataFrame:
    """Add ``psgc_provhuc_id``: city, then sub-municipality, then the region's
    own municipality, then province.  Two texts have fixed codes."""
    region = region_part(F.col("psgc_region_id"))
    found = _probe(meta, keys, "city", region, place_name(F.col("municipality")), "_city")
    found = _probe(found, keys, "only", region, F.lit(""), "_only")
    found = _probe(found, keys, "province", region, place_name(F.col("province")), "_prov")
    return _fixed_provinces(
        found.select(*meta.columns, F.coalesce("_city", "_only", "_prov").alias("psgc_provhuc_id"))
    )


def _fixed_provinces(meta: DataFrame) -> DataFrame:
    is_area = fold(F.col("province")) == SPECIAL_AREA_TEXT
    is_isabela = fold(F.col("province")) == ISABELA_CITY_TEXT

    def put(name: str, area: str, isabela: str | None = None) -> Column:
        value = F.when(is_area, F.lit(area))
        if isabela:
            value = value.when(is_isabela, F.lit(isabela))
        return value.otherwise(F.col(name))

    return meta.withColumns(
        {
            "region": put("region", "BARMM"),
            "province": put("province", "NORTH COTABATO"),
            "psgc_region_id": put(
                "psgc_region_id", BANGSAMORO_REGION, ZAMBOANGA_REGION
            ),
            "psgc_provhuc_id": put("psgc_provhuc_id", SPECIAL_AREA, ISABELA_CITY),
        }
    )


# --- municipality and barangay -------------------------------------------------


def attach_municipality(meta: DataFrame, keys: DataFrame) -> DataFrame:
    scope = F.coalesce(province_scope(F.col("psgc_provhuc_id")), F.lit(ANYWHERE))
    return _probe(meta, keys, "municipality", scope, place_name(F.col("municipality")), "psgc_muni_id")


def attach_barangay(meta: DataFrame, keys: DataFrame) -> DataFrame:
    scope = municipality_part(F.col("psgc_muni_id"))
    return _probe(meta, keys, "barangay", scope, barangay_name(F.col("barangay")), "psgc_brgy_id")


CORRECTION_SCHEMA = "psgc_muni_id string, old string, new string, position bigint"


def correction_table(spark: SparkSession, rules: list[dict[str, str]]) -> DataFrame:
    rows = [
        (r["psgc_muni_id"], r["old"], r["new"], i) for i, r in enumerate(rules)
    ]
    return spark.createDataFrame(rows, CORRECTION_SCHEMA)


def correct_barangays(meta: DataFrame, keys: DataFrame, rules: DataFrame) -> DataFrame:
    """Rename barangays that have no code, by rule, and give them their code.

    A rule names a municipality code, an old and a new barangay name; of
    several rules for one place the one with the least ``position`` counts.
    Rules are joined to codes once, so a table of rules costs one join and not
    one pass per rule.
    """
    first = (
        rules.groupBy("psgc_muni_id", F.upper("old").alias("_old"))
        .agg(F.min(F.struct("position", "new")).alias("_rule"))
        .select("psgc_muni_id", "_old", F.col("_rule.new").alias("_new"))
    )
    scope = municipality_part(F.col("psgc_muni_id"))
    resolved = _probe(first, keys, "upper", scope, F.upper("_new"), "_found")
    open_name = F.when(F.col("psgc_brgy_id").isNull(), F.upper("barangay"))
    found = lookup_join(
        meta.withColumn("_old", open_name), resolved, ["psgc_muni_id", "_old"]
    )
    return found.withColumns(
        {
            "barangay": F.coalesce("_new", "barangay"),
            "psgc_brgy_id": F.coalesce("psgc_brgy_id", "_found"),
        }
    ).select(*meta.columns)


def backfill_special_area(
    meta: DataFrame,
    keys: DataFrame,
    restrict: bool = True,
    old_code: str = SPECIAL_AREA_OLD_CODE,
    area: str = SPECIAL_AREA,
    region: str = BANGSAMORO_REGION,
) -> DataFrame:
    """Codes, by barangay name alone, for rows without municipality or barangay.

    Only barangays of the special area are searched: their old code and new
    code prefixes mark them.  ``restrict`` limits the rows to the region the
    area belongs to; without it any row may be moved there.
    """
    if len(old_code) != 4:
        raise ValueError("an old code's first four digits mark its area")
    is_open = F.col("psgc_muni_id").isNull() | F.col("psgc_brgy_id").isNull()
    if restrict:
        is_open = is_open & (F.col("psgc_region_id") == region)
    scope = area_scope(F.lit(old_code), F.lit(area))
    found = _probe(meta, keys, "old", scope, F.when(is_open, fold(F.col("barangay"))), "_area_id")
    hit = F.col("_area_id").isNotNull()
    return found.withColumns(
        {
            "psgc_region_id": F.when(hit, F.lit(region)).otherwise(
                F.col("psgc_region_id")
            ),
            "psgc_provhuc_id": F.when(hit, F.lit(area)).otherwise(
                F.col("psgc_provhuc_id")
            ),
            "psgc_muni_id": F.coalesce(
                municipality_of(F.col("_area_id")), "psgc_muni_id"
            ),
            "psgc_brgy_id": F.coalesce("_area_id", "psgc_brgy_id"),
        }
    ).select(*meta.columns)


# --- divisions, and lists of regions and provinces ---------------------------


def divisions(meta: DataFrame) -> DataFrame:
    """Distinct divisions with a number inside their region and an id.

    Numbers start at 2: the count of divisions so far, plus one.  Rows without
    a region get 1 and no id.
    """
    distinct = meta.select("psgc_region_id", "division").distinct()
    numbered = with_group_ordinal(
        distinct, "division_seq", "psgc_region_id", F.asc_nulls_first("division")
    )
    return numbered.withColumn(
        "division_seq", F.col("division_seq") + 1
    ).withColumn(
        "division_id",
        F.concat("psgc_region_id", F.lit("-"), F.col("division_seq").cast("string")),
    )


def attach_division(meta: DataFrame) -> DataFrame:
    table = divisions(meta).select("psgc_region_id", "division", "division_id")
    return lookup_join(meta, table, ["psgc_region_id", "division"]).select(
        *meta.columns, "division_id"
    )


def region_list(meta: DataFrame) -> DataFrame:
    """Distinct region codes and names, ordered by code."""
    return (
        meta.select(F.col("psgc_region_id").alias("id"), F.col("region").alias("name"))
        .distinct()
        .orderBy("id")
    )


def province_list(
    meta: DataFrame, codes: DataFrame
) -> DataFrame:
    """Provinces that occur in the table, with official id, name and region."""
    used = (
        meta.select(
            F.substring(digits_only(F.col("psgc_provhuc_id")), 1, 5).alias("_province")
        )
        .where("_province <> ''")
        .distinct()
    )
    official = codes.withColumn("id", digits_only(F.col("id")))
    provinces = first_per_key(
        official.where("geo = 'Prov'").select(
            province_part(F.col("id")).alias("_province"), "id", "name"
        ),
        ["_province"],
        F.col("id"),
    )
    regions = (
        official.where("geo = 'Reg'")
        .groupBy(region_part(F.col("id")).alias("_region"))
        .agg(_least(F.col("id"), "region_id"))
    )
    known = lookup_join(used, provinces, ["_province"]).where("id IS NOT NULL")
    keyed = known.withColumn("_region", region_part(F.col("id")))
    return lookup_join(keyed, regions, ["_region"]).select(
        "id", "name", "region_id"
    )


# --- all steps ---------------------------------------------------------------

ADDRESS = ["region", "province", "municipality", "barangay"]


def match_addresses(addresses: DataFrame, codes: DataFrame, rules: dict) -> DataFrame:
    """Place codes for a table of address texts: every step in order."""
    keys = place_keys(codes, rules.get("region_psgc_map", {}))
    matched = _find_region(addresses, keys)  # distinct addresses come spread
    matched = attach_province(matched, keys)
    matched = attach_municipality(matched, keys)
    matched = attach_barangay(matched, keys)
    if corrections := rules.get("barangay_corrections"):
        table = correction_table(codes.sparkSession, corrections)
        matched = correct_barangays(matched, keys, table)
    matched = backfill_special_area(matched, keys)
    return matched.withColumn("province", title_words(F.col("province")))


def match_places(meta: DataFrame, codes: DataFrame, rules: dict) -> DataFrame:
    """Full place codes, division ids and column order for a school table.

    Codes depend on the four address texts alone, so distinct addresses are
    matched, stored and the answers joined back.  ``rules`` is a rule file as
    ``sources.rules.load_rules`` gives it.
    """
    matched = per_distinct(
        meta, ADDRESS, lambda addresses: durable(match_addresses(addresses, codes, rules))
    )
    return leading_columns(attach_division(matched), MATCHED_ORDER)
