from aisleworks.streaming.arrivals import current_flags, file_arrivals, track_arrivals
from aisleworks.streaming.deadlines import (
    EVENTS, announcements, arrival_events, judge_dates, verdicts, watch_deadlines,
)

__all__ = [
    "EVENTS", "announcements", "arrival_events", "current_flags", "file_arrivals", "judge_dates", "track_arrivals", "verdicts",
    "watch_deadlines",
]
