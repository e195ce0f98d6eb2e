"""Writing feed drops for tests."""

from datetime import datetime
from pathlib import Path

from acceptance.workbooks import workbook_bytes


def stamp(day: datetime) -> str:
    return day.strftime("%d%m%Y")


def blacklist_drop(folder: Path, day: datetime, entries: list[tuple[datetime, str]]) -> Path:
    path = folder / f"passport_blacklist_{stamp(day)}.xlsx"
    rows = [["date", "passport"], *[list(e) for e in entries]]
    path.write_bytes(workbook_bytes({"other": [["x"]], "blacklist": rows}))
    return path


def terminals_drop(folder: Path, day: datetime, rows: list[tuple]) -> Path:
    path = folder / f"terminals_{stamp(day)}.xlsx"
    header = ["terminal_id", "terminal_type", "terminal_city", "terminal_address"]
    path.write_bytes(workbook_bytes({"terminals": [header, *[list(r) for r in rows]]}, shared=True))
    return path


def transactions_drop(folder: Path, day: datetime, rows: list[tuple]) -> Path:
    path = folder / f"transactions_{stamp(day)}.txt"
    header = (
        "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal"
    )
    path.write_text("\n".join([header, *[";".join(r) for r in rows]]) + "\n", encoding="utf-8")
    return path
