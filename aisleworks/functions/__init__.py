from aisleworks.functions.dates import date_text, parse_date
from aisleworks.functions.numeric import (
    MONEY, TOTAL, as_count, as_total, from_cents, ratio2, to_cents,
)

__all__ = ["MONEY", "TOTAL", "as_count", "as_total", "date_text", "from_cents",
           "parse_date", "ratio2", "to_cents"]
