from __future__ import annotations

import json

import pytest

from aisleworks import sources, streaming
from aisleworks.operators import readiness
from tests.conftest import DAY, days


@pytest.fixture
def gate(spark):
    def frames(dates, paths):
        required = readiness.required_files(
            spark.createDataFrame([(d,) for d in dates], "business_date date")
        )
        return required, spark.createDataFrame([(p,) for p in paths], "path string")

    return frames


def names(day):
    """The manifests that say a date is complete."""
    return [f"{t}_{day}.manifest" for t in readiness.REQUIRED]


def data(day):
    return [f"{t}_{day}.csv" for t in readiness.REQUIRED]


def test_all_five_present(gate):
    required, listing = gate([DAY], [f"s3://b/raw/{n}" for n in names(DAY)])
    assert readiness.missing_files(required, listing).count() == 0
    (row,) = readiness.readiness_by_date(required, listing).collect()
    assert (row.files_arrived, row.files_missing, row.ready) == (5, "", True)


def test_one_missing(gate):
    required, listing = gate([DAY], [f"raw/{n}" for n in names(DAY) if "sales" not in n])
    (row,) = readiness.missing_files(required, listing).collect()
    assert row.file_name == f"sales_{DAY}.csv"
    (status,) = readiness.readiness_by_date(required, listing).collect()
    assert (status.files_arrived, status.files_missing, status.ready) == (4, "sales", False)


def test_none_present(gate):
    required, listing = gate([DAY], [])
    assert readiness.missing_files(required, listing).count() == 5
    (row,) = readiness.readiness_by_date(required, listing).collect()
    assert (row.files_arrived, row.ready) == (0, False)
    assert row.files_missing == "calendar,inventory,product,sales,store"


def test_other_files_and_other_days_do_not_count(gate):
    a, b = days(2)
    extra = [f"raw/presales_{a}.manifest", f"raw/sales_{a}.manifest.tmp", "raw/readme.txt",
             "raw/sales_2020-1-6.manifest", "raw/sales_2020-99-99.manifest", *names(b), f"raw/store_{a}.manifest"]
    required, listing = gate([a], extra)
    (row,) = readiness.readiness_by_date(required, listing).collect()
    assert row.files_missing == "calendar,inventory,product,sales"


def test_data_without_a_manifest_has_not_arrived(gate):
    parts = [f"file:/raw/{n}/part-{i}.csv" for n in data(DAY) for i in range(3)]
    required, listing = gate([DAY], parts + names(DAY)[:2])
    (row,) = readiness.readiness_by_date(required, listing).collect()
    assert (row.files_arrived, row.files_missing) == (2, "product,sales,store")


def test_folder_of_part_files_counts_once(gate):
    paths = [f"file:/raw/{n}/part-{i}.json" for n in names(DAY) for i in range(3)]
    required, listing = gate([DAY], paths)
    assert readiness.missing_files(required, listing).count() == 0
    (row,) = readiness.readiness_by_date(required, listing).collect()
    assert row.files_arrived == 5


def test_manifest_holds_the_five_required_files(gate):
    required, _ = gate([DAY], [])
    (row,) = readiness.manifest_json(required.select("business_date").distinct(), "s3://b/raw/"
                                     ).collect()
    assert json.loads(row.payload) == {
        "conf": {"data": {n: f"s3://b/raw/{n}" for n in data(DAY)}}
    }


def test_stream_over_a_folder_equals_the_batch_and_survives_a_restart(spark, gate, tmp_path):
    a, b = days(2)
    landing, out, state = (str(tmp_path / p) for p in ("landing", "out", "state"))
    (tmp_path / "landing").mkdir()

    def arrive(*files):
        for name in files:
            (tmp_path / "landing" / name).write_text("x\n")
        arrivals = streaming.file_arrivals(spark, landing)
        streaming.track_arrivals(arrivals, out, state).awaitTermination()
        required, _ = gate([a, b], [])
        live = readiness.readiness_status(required, streaming.current_flags(spark, out))
        batch = readiness.readiness_by_date(required, sources.list_files(spark, landing))
        assert sorted(live.collect()) == sorted(batch.collect())
        return {r.business_date: r.ready for r in live.collect()}

    assert arrive() == {a: False, b: False}
    assert arrive(*names(a)[:3], names(b)[0]) == {a: False, b: False}
    assert arrive(*names(a)[3:]) == {a: True, b: False}
    assert arrive(*names(b)[1:], "unrelated.txt") == {a: True, b: True}


def test_stream_output_stays_bounded_and_a_replay_changes_nothing(spark, gate, tmp_path):
    """Many batches, then the last one run again, as after a crash before its commit."""
    import datetime as dt
    import shutil

    first, out, state = days(12), str(tmp_path / "out"), tmp_path / "state"
    (tmp_path / "landing").mkdir()

    def run():
        arrivals = streaming.file_arrivals(spark, str(tmp_path / "landing"))
        streaming.track_arrivals(arrivals, out, str(state), keep=dt.timedelta(0)).awaitTermination()
        return sorted(tuple(r) for r in streaming.current_flags(spark, out).collect())

    for day in first:
        for name in names(day)[: 3 + day.day % 3]:
            (tmp_path / "landing" / name).write_text("x\n")
        flags = run()
        assert len(list((tmp_path / "out" / "flags").iterdir())) <= 2
    assert len(flags) == 12 and not (state / "state").exists()  # no state of its own
    last = max(int(p.name) for p in (state / "commits").iterdir() if p.name.isdigit())
    for file in (state / "commits").glob(f"*{last}*"):
        shutil.move(str(file), str(tmp_path / file.name))
    assert run() == flags and len(list((tmp_path / "out" / "flags").iterdir())) <= 2


def test_readers_see_whole_flags_while_the_stream_goes_on(spark, gate, tmp_path):
    a, b = days(2)
    (tmp_path / "landing").mkdir()
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def arrive(*files):
        for name in files:
            (tmp_path / "landing" / name).write_text("x\n")
        streaming.track_arrivals(streaming.file_arrivals(spark, str(tmp_path / "landing")), out, state).awaitTermination()

    arrive(*names(a))
    held = streaming.current_flags(spark, out)
    arrive(*names(b))
    assert [r.business_date for r in held.collect()] == [a]  # the version it was opened on
    assert sorted(r.business_date for r in streaming.current_flags(spark, out).collect()) == [a, b]
