"""A root folder plus the CSV dialect its files share."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from aisleworks.functions.dates import DATE_FORMAT


@dataclass(frozen=True)
class Location:
    """Loads and exports name only a table and a date; the rest lives here.

    NULL is written as ``null_value`` and empty text as ``""``, so the two survive a
    round trip; an unquoted blank also reads as NULL.
    ``multi_line`` reads values holding line breaks.  Such a file cannot be
    split, so turn it on for small dimension files only.
    """

    root: str
    separator: str = ","
    null_value: str = "\\N"
    multi_line: bool = False

    def file_name(self, table: str, day: dt.date | None = None) -> str:
        return f"{table}_{day.isoformat()}.csv" if day else f"{table}.csv"

    def path(self, table: str, day: dt.date | None = None) -> str:
        return f"{self.root.rstrip('/')}/{self.file_name(table, day)}"

    def manifest_path(self, table: str, day: dt.date) -> str:
        """Where the manifest of a finished export lies: beside it, never within it."""
        return f"{self.root.rstrip('/')}/{table}_{day.isoformat()}.manifest"

    def csv_options(self) -> dict[str, object]:
        """Quotes are doubled inside quoted text and blanks are kept as they are."""
        return {
            "sep": self.separator,
            "quote": '"',
            "escape": '"',
            "nullValue": self.null_value,
            "dateFormat": DATE_FORMAT,
            "ignoreLeadingWhiteSpace": False,
            "ignoreTrailingWhiteSpace": False,
        }

    def read_options(self) -> dict[str, object]:
        return {**self.csv_options(), "header": True, "multiLine": self.multi_line}
