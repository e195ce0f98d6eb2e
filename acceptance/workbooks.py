"""Writing small workbooks, to have something the workbook reader can read."""

from __future__ import annotations

import io
import sys
import zipfile
from datetime import datetime
from xml.sax.saxutils import escape

from pyspark import cloudpickle

# Tasks that write workbooks carry this module with them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_DOCUMENT = "application/vnd.openxmlformats-officedocument.spreadsheetml"


def _letters(position: int) -> str:
    letters = ""
    position += 1
    while position:
        position, rest = divmod(position - 1, 26)
        letters = chr(ord("A") + rest) + letters
    return letters


def workbook_bytes(sheets: dict[str, list[list]], shared: bool = False) -> bytes:
    """A workbook with the given rows per sheet; the first row is the header.

    Datetimes become day serials, numbers stay numbers, None leaves the cell out. Text
    is inline, or in the shared string table if ``shared``.
    """
    strings: dict[str, int] = {}

    def cell(value, reference: str) -> str:
        if isinstance(value, datetime):
            serial = (value - datetime(1899, 12, 30)).total_seconds() / 86400
            return f'<c r="{reference}"><v>{serial!r}</v></c>'
        if isinstance(value, int | float):
            return f'<c r="{reference}"><v>{value}</v></c>'
        if shared:
            at = strings.setdefault(value, len(strings))
            return f'<c r="{reference}" t="s"><v>{at}</v></c>'
        text = f'<t xml:space="preserve">{escape(value)}</t>'
        return f'<c r="{reference}" t="inlineStr"><is>{text}</is></c>'

    def sheet(rows: list[list]) -> str:
        lines = []
        for number, row in enumerate(rows, 1):
            cells = [cell(v, f"{_letters(i)}{number}") for i, v in enumerate(row) if v is not None]
            lines.append(f'<row r="{number}">{"".join(cells)}</row>')
        data = "".join(lines)
        return f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>{data}</sheetData></worksheet>'

    parts = {
        f"xl/worksheets/sheet{i}.xml": sheet(rows) for i, rows in enumerate(sheets.values(), 1)
    }
    listed = "".join(
        f'<sheet name="{escape(name)}" sheetId="{i}" r:id="rId{i}"/>'
        for i, name in enumerate(sheets, 1)
    )
    related = "".join(
        f'<Relationship Id="rId{i}" Type="{_REL}/worksheet" Target="worksheets/sheet{i}.xml"/>'
        for i in range(1, len(sheets) + 1)
    )
    parts["xl/workbook.xml"] = (
        f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>{listed}</sheets></workbook>'
    )
    parts["xl/_rels/workbook.xml.rels"] = (
        f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships">{related}</Relationships>'
    )
    parts["_rels/.rels"] = (
        f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" '
        f'Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>'
    )
    parts["[Content_Types].xml"] = (
        f'{_HEAD}<Types xmlns="{_PACKAGE}/content-types">'
        '<Default Extension="xml" ContentType="application/xml"/>'
        '<Default Extension="rels" '
        'ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{_DOCUMENT}.sheet.main+xml"/></Types>'
    )
    if strings:
        items = "".join(f'<si><t xml:space="preserve">{escape(t)}</t></si>' for t in strings)
        parts["xl/sharedStrings.xml"] = f'{_HEAD}<sst xmlns="{_MAIN}">{items}</sst>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return out.getvalue()
