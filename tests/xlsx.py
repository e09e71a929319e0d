"""A small workbook writer for test inputs."""

import zipfile
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PKG = "http://schemas.openxmlformats.org/package/2006/relationships"


def _letters(index):
    text = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        text = chr(65 + rest) + text
    return text


def _cell(row, col, value, shared):
    ref = f"{_letters(col)}{row + 1}"
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value}</v></c>'
    if value == "#N/A":
        return f'<c r="{ref}" t="e"><v>#N/A</v></c>'
    if len(value) % 2:
        shared.append(value)
        return f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'


def write_workbook(path, sheets):
    """``sheets`` maps a name to rows (lists of values); empty rows are left out."""
    shared, members = [], {}
    for number, rows in enumerate(sheets.values(), start=1):
        body = "".join(
            f'<row r="{r + 1}">'
            + "".join(_cell(r, c, v, shared) for c, v in enumerate(row))
            + "</row>"
            for r, row in enumerate(rows)
            if any(v is not None for v in row)
        )
        members[f"xl/worksheets/sheet{number}.xml"] = (
            f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>'
        )
    names = "".join(
        f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>'
        for i, n in enumerate(sheets, start=1)
    )
    members["xl/workbook.xml"] = (
        f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>{names}</sheets></workbook>'
    )
    links = "".join(
        f'<Relationship Id="rId{i}" Type="t" Target="worksheets/sheet{i}.xml"/>'
        for i in range(1, len(sheets) + 1)
    )
    members["xl/_rels/workbook.xml.rels"] = (
        f'<Relationships xmlns="{PKG}">{links}</Relationships>'
    )
    strings = "".join(f"<si><t>{escape(s)}</t></si>" for s in shared)
    members["xl/sharedStrings.xml"] = f'<sst xmlns="{MAIN}">{strings}</sst>'
    with zipfile.ZipFile(path, "w") as archive:
        for name, text in members.items():
            archive.writestr(name, text)
