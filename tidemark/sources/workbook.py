"""Workbook (xlsx) feeds.

Spark reads the files; each task parses the sheets of its own files. A sheet holds at
most 1,048,576 rows by format, so one file is a bounded piece of work for a task, and
its rows leave the parser in batches.
"""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BATCH_ROWS = 10_000

# The parser travels with its tasks, so the package need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class WorkbookError(Exception):
    """The workbook lacks the sheet, or its rows do not fit the schema."""


def read_workbook(
    spark: SparkSession,
    paths: str | list[str],
    sheet: str,
    schema: T.StructType,
    dates: tuple[str, ...] = (),
) -> DataFrame:
    """Rows of one sheet of each workbook, as text bound by position, plus ``path``."""
    loaded = spark.read.format("binaryFile").load(paths)
    return workbook_rows(loaded, sheet, schema, dates)


def workbook_rows(
    loaded: DataFrame, sheet: str, schema: T.StructType, dates: tuple[str, ...] = ()
) -> DataFrame:
    """Parse workbooks held as ``(path, content)``, batch or streaming.

    ``dates`` names the columns whose numeric cells are day serials; they become
    ``yyyy-MM-dd`` text, with the time of day only where there is one.
    """
    names = schema.fieldNames()
    date_positions = {names.index(d) for d in dates}

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                chunk: list[list[str | None]] = []
                for row in sheet_rows(content, sheet, len(names), date_positions):
                    chunk.append([path, *row])
                    if len(chunk) == BATCH_ROWS:
                        yield pd.DataFrame(chunk, columns=["path", *names], dtype=object)
                        chunk = []
                if chunk:
                    yield pd.DataFrame(chunk, columns=["path", *names], dtype=object)

    out = T.StructType([T.StructField("path", T.StringType()), *schema.fields])
    return loaded.select("path", "content").mapInPandas(parse, out)


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _text_of(element: ElementTree.Element) -> str:
    """Text of a string item; phonetic hints are not part of it."""
    return "".join(
        t.text or ""
        for part in element
        if _local(part.tag) in ("t", "r")
        for t in ([part] if _local(part.tag) == "t" else part)
        if _local(t.tag) == "t"
    )


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    strings = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, element in ElementTree.iterparse(part):
            if _local(element.tag) == "si":
                strings.append(_text_of(element))
                element.clear()
    return strings


def _find_sheet(book: zipfile.ZipFile, name: str) -> tuple[str, bool]:
    """Archive member of the named sheet, and whether serials count from 1904."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    since_1904 = any(
        e.get("date1904") in ("1", "true") for e in root if _local(e.tag) == "workbookPr"
    )
    wanted = None
    for element in root.iter():
        if _local(element.tag) == "sheet" and element.get("name") == name:
            wanted = next(v for k, v in element.attrib.items() if _local(k) == "id" and "}" in k)
    if wanted is None:
        raise WorkbookError(f"no sheet named {name!r}")
    relations = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(e.get("Target") for e in relations if e.get("Id") == wanted)
    member = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    return member, since_1904


def _column_of(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def _number_text(raw: str) -> str:
    """Whole numbers without a fraction, whatever notation the file uses."""
    if re.fullmatch(r"-?\d+", raw):
        return raw
    value = float(raw)
    return str(int(value)) if value.is_integer() else repr(value)


def _date_text(raw: str, since_1904: bool) -> str:
    start = datetime(1904, 1, 1) if since_1904 else datetime(1899, 12, 30)
    moment = start + timedelta(seconds=round(float(raw) * 86400))
    midnight = moment.hour == moment.minute == moment.second == 0
    return moment.strftime("%Y-%m-%d" if midnight else "%Y-%m-%d %H:%M:%S")


def sheet_rows(
    content: bytes, sheet: str, width: int, date_positions: set[int]
) -> Iterator[list[str | None]]:
    """Data rows of a sheet, header left out; empty rows are skipped."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        member, since_1904 = _find_sheet(book, sheet)
        strings = _shared_strings(book)
        header_seen = False
        with book.open(member) as part:
            for _, element in ElementTree.iterparse(part):
                if _local(element.tag) != "row":
                    continue
                row: list[str | None] = [None] * width
                for at, cell in enumerate(c for c in element if _local(c.tag) == "c"):
                    position = _column_of(cell.get("r")) if cell.get("r") else at
                    value = _cell_text(cell, strings, position in date_positions, since_1904)
                    if value is None or value == "":
                        continue
                    if position >= width:
                        raise WorkbookError(f"sheet {sheet!r} has more than {width} columns")
                    row[position] = value
                element.clear()
                if not header_seen:
                    header_seen = True
                elif any(v is not None for v in row):
                    yield row


def _cell_text(
    cell: ElementTree.Element, strings: list[str], is_date: bool, since_1904: bool
) -> str | None:
    kind = cell.get("t", "n")
    parts = {_local(e.tag): e for e in cell}
    if kind == "inlineStr":
        return _text_of(parts["is"]) if "is" in parts else None
    if "v" not in parts or parts["v"].text is None:
        return None
    raw = parts["v"].text
    if kind == "s":
        return strings[int(raw)]
    if kind == "n":
        return _date_text(raw, since_1904) if is_date else _number_text(raw)
    return raw
