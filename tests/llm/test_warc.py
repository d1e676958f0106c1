from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections import Counter, defaultdict

import pytest

from aisleworks.llm import warc
from aisleworks.llm.shared import new_folder, stored

PAGES = "page_id long, url string, html string"


def expected(rows):
    groups = defaultdict(list)
    for page_id, _, html in rows:
        groups[(html or "").encode()].append(page_id)
    found = Counter()
    for payload, ids in groups.items():
        last = max((i for i in ids if i is not None), default=None)
        sha = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for i in ids:
            revisit = last is not None and i != last
            found[(i, len(payload), sha, "revisit" if revisit else "response", last if revisit else None)] += 1
    return found


ROWS = [
    (1, "http://a/", "same"), (2, "http://b/\r\nX: y", "same"), (2, "http://b/", "same"), (3, None, "ü\r\n\r\nWARC/1.1\r\n"),
    (4, "http://c/", None), (5, "http://c/", ""), (None, "http://d/", "same"), (None, None, "alone"), (None, None, "alone"),
    (7, "http://e/", "long " * 300_000), (2**60 + 1, "http://f/", "x"),
]


def test_round_trip_of_odd_rows(spark):
    rows = warc.round_trip(spark.createDataFrame(ROWS, PAGES)).collect()
    assert Counter(map(tuple, rows)) == expected(ROWS)


def test_empty_table_and_extra_columns(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).collect() == []
    frame = spark.createDataFrame([(1, "u", "h", "s", 2)], PAGES + ", sha string, winner int")
    assert len(warc.round_trip(frame).collect()) == 1


def test_payloads_survive_and_every_record_is_a_member(spark, tables):
    pages = tables("pages")
    whole, split = new_folder(spark, "whole"), new_folder(spark, "split")
    archives = stored(warc.write_whole_file(warc.pages_as_records(pages), whole), "archives")
    index = stored(warc.normalise(archives, split), "index")
    found = {row.page_id: bytes(row.payload).decode() for row in warc.read_records(index, split).collect()}
    assert found == {row.page_id: row.html for row in pages.collect()}
    first = index.first()
    with open(first.archive, "rb") as file:
        data = file.read()
    member = gzip.decompress(data[first.offset : first.offset + first.length])
    assert member.startswith(b"WARC/1.1\r\n") and first.record_id.encode() in member
    with open(f"{first.archive}.idx") as file:
        lines = file.read().splitlines()
    assert len(lines) == index.filter(index.archive == first.archive).count()
    assert sum(row.records for row in archives.collect()) == pages.count()


def test_inflating_takes_bounded_chunks_and_many_members():
    data = b"".join(gzip.compress(bytes([k]) * 5000) for k in range(20))
    chunks = list(warc.inflated(io.BytesIO(data), size=64))
    assert b"".join(chunks) == b"".join(bytes([k]) * 5000 for k in range(20))
    assert max(map(len, chunks)) <= 4 * 64


def test_a_cut_record_fails():
    whole = warc.record(1, "u", b"payload", (warc.digest(b"payload"), 7), None)
    assert [data for _, data in warc.split_records(iter([whole[:30], whole[30:], whole]))] == [whole, whole]
    with pytest.raises(ValueError):
        list(warc.split_records(iter([whole, whole[:-5]])))


def archive(*payloads):
    return [warc.record(k, "u", p, (warc.digest(p), len(p)), None) for k, p in enumerate(payloads)]


def indexed(spark, tmp_path, **files):
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    frame = spark.createDataFrame([(str(tmp_path / name),) for name in files], "archive string")
    return warc.normalise(frame, str(tmp_path / "split")).collect()


def test_archives_that_are_cut_fail_and_are_named(spark, tmp_path):
    import zlib

    records = archive(b"one", b"two", b"three" * 9000)
    deflate = zlib.compressobj(6, wbits=31)
    flushed = b"".join(deflate.compress(r) + deflate.flush(zlib.Z_FULL_FLUSH) for r in records[:2])
    whole = gzip.compress(b"".join(records))
    members = b"".join(map(gzip.compress, records))
    broken = {"flush_point": flushed, "no_trailer": whole[:-8], "half_trailer": whole[:-3], "middle": whole[: len(whole) // 2],
              "last_member": members[:-1], "header": members + b"\x1f\x8b", "garbage": members + b"rest"}
    for name, data in broken.items():
        with pytest.raises(Exception, match=f"archive .*{name}"):
            indexed(spark, tmp_path, **{name: data})
        for size in (1, 7, 64, 1 << 20):
            with pytest.raises((ValueError, zlib.error)):
                list(warc.inflated(io.BytesIO(data), size))


def test_padding_and_empty_files(spark, tmp_path):
    records = archive(b"one", b"two")
    members = list(map(gzip.compress, records))
    padded = members[0] + bytes(700) + members[1] + bytes(2000)
    assert len(indexed(spark, tmp_path, padded=padded, empty=b"", zeros=bytes(512), plain=gzip.compress(b"".join(records)))) == 4
    for size in (1, 64, 1 << 20):
        assert b"".join(warc.inflated(io.BytesIO(padded), size)) == b"".join(records)
        assert list(warc.inflated(io.BytesIO(b""), size)) == []
