"""One spelling of dates, used for text columns and file names alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"


def parse_date(text: Column) -> Column:
    """Zero-padded ISO text to a date; anything else gives NULL, not an error."""
    return F.try_to_date(text, DATE_FORMAT)


def date_text(day: Column) -> Column:
    """Zero-padded ISO text of a date, whatever the session time zone."""
    return day.cast("date").cast("string")
