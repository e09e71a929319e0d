"""Rule files and seed tables (YAML), read on the driver.

These are hand-written lists of at most a few hundred rows.
"""

from __future__ import annotations

from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession

from ..contracts import CONTRACTS

RULES_DIR = Path(__file__).resolve().parent.parent / "rules"

SEED_SCHEMAS = {
    "school_sizes": "id bigint, label string, shorthand string, minimum bigint, maximum bigint",
    "school_epochs": "id bigint, label string",
    "school_grades": "id bigint, label string, key_stage bigint",
}


def load_rules(path: str | Path | None = None) -> dict:
    """Location rules: the bundled file, or one of the same shape.

    Barangay corrections are a local table of one's own; the bundled file
    leaves that section empty.
    """
    text = Path(path or RULES_DIR / "locations.yml").read_text(encoding="utf-8")
    return yaml.safe_load(text) or {}


def region_names(spark: SparkSession, path: str | Path | None = None) -> DataFrame:
    """Region aliases with exactly the columns of their contract, all text."""
    source = Path(path or RULES_DIR / "regions.yml")
    if not source.exists():
        raise FileNotFoundError(f"region file missing: {source}")
    entries = (yaml.safe_load(source.read_text(encoding="utf-8")) or {}).get(
        "region_names"
    )
    if not entries:
        raise ValueError(f"no region aliases in {source}")
    schema = CONTRACTS["region_names"].schema
    rows = [
        tuple(None if e.get(c) is None else str(e[c]) for c in schema.names)
        for e in entries
    ]
    return spark.createDataFrame(rows, schema)


def seed_tables(
    spark: SparkSession, path: str | Path | None = None
) -> dict[str, DataFrame]:
    """School sizes, grades and epochs.  Rows without an id get their position."""
    source = Path(path or RULES_DIR / "seeds.yml")
    if not source.exists():
        raise FileNotFoundError(f"seed file missing: {source}")
    data = yaml.safe_load(source.read_text(encoding="utf-8"))
    tables = {}
    for name, schema in SEED_SCHEMAS.items():
        columns = [field.split()[0] for field in schema.split(", ")]
        rows = [
            tuple({"id": position, **row}.get(c) for c in columns)
            for position, row in enumerate(data.get(name, []), start=1)
        ]
        tables[name] = spark.createDataFrame(rows, schema)
    return tables


def sql_view(
    spark: SparkSession,
    path: str | Path,
    view: str | None = None,
    tables: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Run one SQL file; with ``view``, define a temporary view by its text.

    ``tables`` are registered under their names first.
    """
    for name, df in (tables or {}).items():
        df.createOrReplaceTempView(name)
    text = Path(path).read_text(encoding="utf-8").strip().rstrip(";")
    if view is None:
        return spark.sql(text)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS {text}")
    return spark.table(view)

