"""The ten output tables: columns, types, required columns and natural keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


@dataclass(frozen=True)
class Contract:
    name: str
    schema: StructType
    key: tuple[str, ...]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def _contract(
    name: str, key: list[str], required: list[str], columns: list[str], **types: DataType
) -> Contract:
    """Columns are text unless a type is given by name."""
    fields = [StructField(c, types.get(c, StringType()), c not in required) for c in columns]
    return Contract(name, StructType(fields), tuple(key))


# The columns of the ten tables, in contract order.
CONTRACTS: dict[str, Contract] = {
    c.name: c
    for c in [
        _contract(
            "psgc",
            key=["id"],
            required=["id"],
            columns=[
                "id", "name", "cc", "geo", "old_names", "city_class", "income_class", "urban_rural", "2024_pop",
                "status",
            ],
        ),
        _contract(
            "enrollment",
            key=["school_year", "school_id", "grade", "sex", "strand"],
            required=["school_year", "school_id"],
            columns=["school_year", "school_id", "grade", "sex", "strand", "num_students"],
            num_students=LongType(),
        ),
        _contract(
            "school_year_meta",
            key=["school_year", "school_id"],
            required=["school_year", "school_id"],
            columns=[
                "school_year", "school_id", "school_name", "sector", "school_management", "annex_status", "region",
                "province", "municipality", "barangay", "street_address", "legislative_district", "division",
                "school_district",
            ],
        ),
        _contract(
            "school_levels",
            key=["school_id", "school_year", "level"],
            required=["school_id", "school_year", "level"],
            columns=["school_id", "school_year", "level", "offered"],
            offered=BooleanType(),
        ),
        _contract(
            "meta_psgc",
            key=["school_id", "school_year"],
            required=["school_year", "school_id"],
            columns=[
                "school_year", "school_id", "psgc_region_id", "psgc_provhuc_id", "psgc_muni_id", "psgc_brgy_id",
                "division", "division_id", "school_name", "province", "municipality", "barangay",
            ],
        ),
        _contract(
            "address",
            key=["address_id"],
            required=["school_id", "school_year", "_addr_hash", "address_id"],
            columns=["school_id", "school_year", "_addr_hash", "address_id"],
            _addr_hash=LongType(),
            address_id=LongType(),
        ),
        _contract(
            "geo",
            key=["school_id", "school_year"],
            required=["school_id", "school_year"],
            columns=[
                "school_id", "school_year", "_addr_hash", "address_id", "longitude", "latitude",
                "psgc_region_id", "psgc_provhuc_id", "psgc_muni_id", "psgc_brgy_id",
            ],
            _addr_hash=LongType(),
            address_id=LongType(),
            longitude=DoubleType(),
            latitude=DoubleType(),
        ),
        _contract(
            "region_names",
            key=["psgc_region_id", "location"],
            required=["psgc_region_id", "location"],
            columns=["psgc_region_id", "roman", "location", "common", "other"],
        ),
        _contract(
            "teachers",
            key=["school_year", "school_id", "level", "position"],
            required=["school_year", "school_id", "level", "position"],
            columns=["school_year", "school_id", "level", "position", "num"],
            num=LongType(),
        ),
        _contract(
            "dropouts",
            key=["school_year", "school_id", "grade", "sex", "strand", "source_file", "source_row"],
            required=["school_year", "school_id", "grade", "sex", "source_file", "source_row"],
            columns=[
                "school_year", "school_id", "grade", "strand", "sex", "num_dropouts", "source_file", "source_row",
                "ingested_at",
            ],
            source_row=LongType(),
            num_dropouts=LongType(),
            ingested_at=TimestampType(),
        ),
    ]
}
