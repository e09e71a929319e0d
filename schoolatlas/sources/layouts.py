"""Where the yearly workbooks keep their tables.

Fixed values: sheet names, column ranges and header rows as published.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """One sheet.  Row numbers are zero-based."""

    school_year: str
    sheet: str
    columns: str
    header_start: int
    header_rows: int
    data_start: int
    level: str = ""
    id_label: str = ""
    labels: str = ""


def _teachers(year: str, level: str, sheet: str, columns: str, header: int) -> Layout:
    return Layout(year, sheet, columns, header, 1, header + 1, level=level)


TEACHER_LAYOUTS = [
    _teachers("2022-2023", "es", "ES DB", "D:E,S:AD", 5),
    _teachers("2022-2023", "jhs", "JHS DB", "D:E,S:AH", 5),
    _teachers("2022-2023", "shs", "SHS DB", "D:E,T:AA", 5),
    _teachers("2023-2024", "es", "ES DB", "D,O:Z", 6),
    _teachers("2023-2024", "jhs", "JHS DB", "D,O:AD", 6),
    _teachers("2023-2024", "shs", "SHS", "D,O:V", 7),
    _teachers("2024-2025", "es", "ES", "E:F,U:AF", 7),
    _teachers("2024-2025", "jhs", "JHS", "E:F,U:AJ", 7),
    _teachers("2024-2025", "shs", "SHS", "E:F,U:AB", 7),
]

DROPOUT_LAYOUTS = [
    Layout("2022-2023", "DROPOUT DB", "E,K:Z,AD:AM,AQ:AX,BB:BI", 6, 1, 7,
           id_label="School ID", labels="2022"),
    Layout("2023-2024", "DB DROPOUT", "E,K:Z,AD:AM,AQ:AT", 3, 2, 7,
           id_label="school_id", labels="2023"),
    Layout("2024-2025", "DATABASE", "C,K:Z,AD:AM,AQ:AT", 8, 1, 9,
           id_label="BEIS School ID", labels="2024"),
]

PLACE_SHEET = "PSGC"
PLACE_COLUMNS = [
    "id", "name", "cc", "geo", "old_names", "city_class", "income_class",
    "urban_rural", "2024_pop", "status",
]
PLACE_POSITIONS = [0, 1, 2, 3, 4, 5, 6, 7, 8, 10]
