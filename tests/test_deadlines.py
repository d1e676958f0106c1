"""Deadlines of business dates, judged as a stream."""

from __future__ import annotations

import datetime as dt
import json
import os
import shutil

import pytest

from aisleworks import streaming
from aisleworks.operators.readiness import REQUIRED
from aisleworks.streaming.deadlines import EVENTS
from tests.conftest import DAY, days

DUE = dt.timedelta(hours=26)


def at(day, hours):
    return (dt.datetime.combine(day, dt.time()) + dt.timedelta(hours=hours)).isoformat() + "Z"


@pytest.fixture
def feed(spark, tmp_path):
    """Events delivered file by file; each call of run takes in what is there."""
    folder, out, state = tmp_path / "feed", str(tmp_path / "out"), tmp_path / "state"
    folder.mkdir()

    class Feed:
        count = 0
        states = []
        checkpoint = state

        def send(self, *events):
            Feed.count += 1
            lines = [json.dumps({"business_date": day and str(day), "table_name": table, "seen_at": seen}) for day, table, seen in events]
            path = folder / f"{self.count:05d}.json"
            path.write_text("\n".join(lines))
            os.utime(path, (1_600_000_000 + self.count,) * 2)

        def run(self, out_of_order="0 seconds", per_batch=1):
            events = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", per_batch).json(str(folder))
            query = streaming.watch_deadlines(events, out, str(state), DUE, out_of_order)
            query.awaitTermination()
            self.states += [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
            return self.seen()

        def seen(self):
            rows = streaming.verdicts(spark, out).collect()
            return sorted((r.business_date, r.status, r.at.astimezone(dt.UTC).replace(tzinfo=None), r.files_missing) for r in rows)

    Feed.count, Feed.states = 0, []
    return Feed()


def hour(day, hours):
    return dt.datetime.combine(day, dt.time()) + dt.timedelta(hours=hours)


def arrive(day, hours, tables=REQUIRED):
    return [(day, table, at(day, hours + n)) for n, table in enumerate(tables)]


def tick(day, hours):
    return (None, None, at(day, hours))


def test_complete_overdue_and_unheard_of_dates(feed):
    a, b, c, d = days(4)
    feed.send((a, None, at(a, 0)), (b, None, at(b, 0)), (c, None, at(c, 0)), *arrive(a, 5))
    feed.send(*arrive(b, 20, REQUIRED[:3]), tick(d, 0))
    known = [(a, "complete", hour(a, 9), ""), (b, "overdue", hour(b, 26), "sales,store")]
    assert feed.run() == known
    feed.send((None, "sales", None), (c, "sales", None), tick(d, 2.5))
    assert feed.run() == [*known, (c, "overdue", hour(c, 26), ",".join(REQUIRED))]
    assert feed.states[-1] == 0


def test_files_after_the_deadline_do_not_count_and_speak_once(feed):
    a, b, c, _ = days(4)
    feed.send((a, None, at(a, 0)), *arrive(a, 1, REQUIRED[1:]))
    feed.send((a, REQUIRED[0], at(a, 26.5)), tick(c, 0))
    overdue = [(a, "overdue", hour(a, 26), REQUIRED[0])]
    assert feed.run() == overdue
    feed.send((a, REQUIRED[0], at(c, 1)), (a, REQUIRED[1], at(c, 2)), tick(c, 30))
    assert feed.run() == overdue and feed.states[-1] == 0
    feed.send((b, REQUIRED[0], at(c, 30.5)), tick(c, 60))  # first heard of after its deadline
    assert feed.run() == overdue


def test_a_file_seen_again_after_completion_does_not_start_over(feed):
    a, b, c, _ = days(4)
    feed.send(*arrive(a, 1))
    feed.send((a, REQUIRED[2], at(a, 9)), *arrive(a, 10))
    feed.send(tick(c, 9))
    assert feed.run() == [(a, "complete", hour(a, 5), "")]
    assert feed.states[-1] == 0


def test_out_of_order_events_within_the_given_time(feed):
    a, _, c, d = days(4)
    feed.send((a, None, at(a, 0)), *arrive(a, 1, REQUIRED[1:]))
    feed.send(tick(c, 5))
    feed.send((a, REQUIRED[0], at(a, 3)))  # comes after an event of two days later
    feed.send(tick(d, 20))
    assert feed.run("3 days") == [(a, "complete", hour(a, 4), "")]


def test_one_batch_and_many_give_the_same(spark, feed, tmp_path):
    dates = days(30)
    for n, day in enumerate(dates):
        feed.send((day, None, at(day, 0)), *arrive(day, n % 24, REQUIRED[: 5 - n % 3]))
    feed.send(tick(dates[-1], 99))
    many = feed.run("2 days")
    assert len(many) == 30 and {row[1] for row in many} == {"complete", "overdue"}
    events = spark.readStream.schema(EVENTS).json(str(tmp_path / "feed"))
    streaming.watch_deadlines(events, str(tmp_path / "out2"), str(tmp_path / "state2"), DUE).awaitTermination()
    one = streaming.verdicts(spark, str(tmp_path / "out2")).collect()
    assert sorted((r.business_date, r.status, r.files_missing) for r in one) == [(row[0], row[1], row[3]) for row in many]


def test_state_stays_bounded_over_a_thousand_dates_and_a_replay_changes_nothing(feed):
    dates = days(1000)
    for part in range(0, 1000, 50):
        feed.send(*(event for n, day in enumerate(dates[part : part + 50])
                    for event in [(day, None, at(day, 0)), *arrive(day, 2, REQUIRED[: 5 - n % 2])]))
    feed.send(tick(dates[-1], 50))
    got = feed.run()
    assert len(got) == 1000 and sum(row[1] == "overdue" for row in got) == 500
    assert max(feed.states) <= 55 and feed.states[-1] == 0
    last = max(int(p.name) for p in (feed.checkpoint / "commits").iterdir() if p.name.isdigit())
    for file in (feed.checkpoint / "commits").glob(f"*{last}*"):
        shutil.move(str(file), str(feed.checkpoint.parent / file.name))
    assert feed.run() == got


def test_events_of_a_watched_folder(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for n, table in enumerate(REQUIRED):
        path = landing / f"{table}_{DAY}.manifest"
        path.write_text("{}")
        os.utime(path, (dt.datetime.combine(DAY, dt.time(3 + n), dt.UTC).timestamp(),) * 2)
    (landing / "readme.txt").write_text("time goes by")
    events = streaming.arrival_events(streaming.file_arrivals(spark, str(landing)))
    streaming.watch_deadlines(events, str(tmp_path / "out"), str(tmp_path / "state"), DUE).awaitTermination()
    (row,) = streaming.verdicts(spark, str(tmp_path / "out")).collect()
    assert (row.business_date, row.status, row.at.astimezone(dt.UTC).hour) == (DAY, "complete", 7)
