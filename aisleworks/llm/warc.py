"""WARC archives: writing, normalising whole-file gzip, and reading through an offset index.

A WARC file that was compressed as one gzip stream can only be read from its start.  The normaliser inflates
such a file once, as a stream, writes every record as a gzip member of its own, and beside the file an index of offsets, so
that readers go straight to any record and the file can be split.  Files lie in the shared folder and are
reached by its own file system; a file counts only once the task that wrote it has reported it, so lost
executors and repeated tasks leave nothing but files that nobody names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleworks.llm.shared import new_folder, only, stored

#: Payload bytes after which a writer begins another file.
FILE_BYTES = 64 * 1024 * 1024
DATE = "2024-01-01T00:00:00Z"
READ_BYTES = 1 << 20

_ENTRY = "archive string, offset long, length long, record_id string, record_type string, target_uri string"
_RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
)
_LINE_BREAKS = str.maketrans({"\r": "%0D", "\n": "%0A"})
_OWN_ID = re.compile(r"<urn:page:(-?\d+)>")


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes | None, known: tuple[str, int], refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit that has the HTTP header alone.

    ``known`` is the digest and the size of the full payload.  Rows that share a page_id share a record
    id; a row without page_id gets a random one.
    """
    sha, size = known
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page_id}>" if page_id is not None else f"WARC-Record-ID: {uuid.uuid4().urn.join('<>')}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{sha}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {url.translate(_LINE_BREAKS)}")
    if refers_to is None:
        block += payload or b""
    else:
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; the first line is left out."""
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def split_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, whole record) of each record of an inflated stream; a cut-off record fails."""
    held = bytearray()
    ended = False
    while True:
        at = held.find(b"\r\n\r\n")
        size = None
        if at >= 0:
            fields = headers(bytes(held[:at]))
            size = at + 4 + int(fields["content-length"]) + 4
        if size is not None and len(held) >= size:
            yield fields, bytes(held[:size])
            del held[:size]
            continue
        if ended:
            if held.strip():
                raise ValueError("a WARC record is cut off")
            return
        # A long record needs many chunks; taking them at once avoids parsing its header again and again.
        wanted = max(READ_BYTES, (size or 0) - len(held))
        while wanted > 0:
            chunk = next(chunks, None)
            if chunk is None:
                ended = True
                break
            held += chunk
            wanted -= len(chunk)


def inflated(stream, size: int = READ_BYTES) -> Iterator[bytes]:
    """The content of a gzip file, one member or many, in bounded chunks.

    Zeros around members are padding; a member without its end, its checksum included, fails, and so does anything else.
    """
    inflate, begun = zlib.decompressobj(31), False
    data = stream.read(size)
    while data:
        while data:
            if not begun:
                data = data.lstrip(b"\0")
                if not data:
                    break
                begun = True
            if out := inflate.decompress(data, 4 * size):
                yield out
            if inflate.eof:
                data, inflate, begun = inflate.unused_data, zlib.decompressobj(31), False
            else:
                data = inflate.unconsumed_tail
        data = stream.read(size)
    if begun:
        if rest := inflate.flush():
            yield rest
        if not inflate.eof:
            raise ValueError("the gzip stream is cut off")


def named(source: str, records: Iterator) -> Iterator:
    """``records``, whose errors tell where they come from."""
    try:
        yield from records
    except (ValueError, KeyError, zlib.error) as err:
        raise ValueError(f"archive {source}: {err}") from err


def pages_as_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, sha, payload_bytes, refers_to): html is NULL for revisits.

    Of equal payloads the largest page_id is the response; rows with that page_id all are.  A row without
    page_id counts as smaller than any; payloads that only such rows have are responses.  The groups are found by digest, combined
    before the shuffle, and only payloads that occur more than once are joined, as a stored table, so that
    adaptive execution splits a payload that a third of all pages have.
    """
    rows = only(pages, page_id="long", url="string", html="string").withColumn(
        "html", F.coalesce("html", F.lit("")).cast("binary")
    ).withColumn("sha", F.sha1("html"))
    known = (
        rows.groupBy("sha").agg(F.max("page_id").alias("winner"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1 and winner is not null").select("sha", "winner")
    )
    found = rows.join(stored(known, "payloads"), "sha", "left")
    refers = F.when(F.coalesce(F.col("page_id") < F.col("winner"), F.col("winner").isNotNull()), F.col("winner"))
    return found.withColumn("refers_to", refers).select(
        "page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "sha",
        F.length("html").cast("long").alias("payload_bytes"), "refers_to",
    )


def write_whole_file(records: DataFrame, folder: str) -> DataFrame:
    """(archive, records): WARC files of ``records``, each compressed as a single gzip stream; run by storing the result."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = _place(folder)
        system.create_dir(path, recursive=True)
        out = None
        done: list[tuple[str, int]] = []
        count = size = 0

        def close() -> None:
            nonlocal out
            if out is not None:
                out.write(deflate.flush())
                out.close()
                done.append((name, count))
            out = None

        for batch in batches:
            for row in batch.itertuples(index=False):
                if out is None:
                    name = f"{path}/{uuid.uuid4().hex}.warc.gz"
                    out, deflate, count, size = system.open_output_stream(name, compression=None), zlib.compressobj(1, wbits=31), 0, 0
                sha = base64.b32encode(bytes.fromhex(row.sha)).decode()
                page, refers = (int(x) if x else None for x in (row.page, row.refers))
                data = record(page, row.url, row.html, (sha, row.payload_bytes), refers)
                out.write(deflate.compress(data))
                count, size = count + 1, size + len(data)
                if size >= FILE_BYTES:
                    close()
        close()
        yield pd.DataFrame(done, columns=["archive", "records"])

    # Ids travel as text: pandas has no whole numbers with gaps.
    sent = records.select(
        F.col("page_id").cast("string").alias("page"), "url", "html", "sha", "payload_bytes", F.col("refers_to").cast("string").alias("refers")
    )
    return sent.mapInPandas(run, "archive string, records long")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """The index of ``archives`` (archive, ...) rewritten into ``folder``: a gzip member per record, and a sidecar index.

    A row per record: archive, offset, length, record_id, record_type, target_uri, the same as a tab-separated
    line of ``<archive>.idx``.  Each file is inflated once, in bounded chunks; memory is that of the largest record.
    An archive that is cut off or damaged fails the job and is named; an empty one has no records.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = _place(folder)
        system.create_dir(path, recursive=True)
        for batch in batches:
            for source in batch["archive"]:
                name = f"{path}/{uuid.uuid4().hex}.warc.gz"
                entries: list[tuple] = []
                at = 0
                with system.open_input_stream(source, compression=None) as stream, \
                        system.open_output_stream(name, compression=None) as out:
                    for fields, data in named(source, split_records(inflated(stream))):
                        deflate = zlib.compressobj(6, wbits=31)
                        member = deflate.compress(data) + deflate.flush()
                        out.write(member)
                        entries.append(
                            (name, at, len(member), fields.get("warc-record-id"), fields.get("warc-type"),
                             fields.get("warc-target-uri"))
                        )
                        at += len(member)
                index = "".join("\t".join("" if x is None else str(x) for x in entry[1:]) + "\n" for entry in entries)
                with system.open_output_stream(f"{name}.idx", compression=None) as out:
                    out.write(index.encode())
                yield pd.DataFrame(entries, columns=["archive", "offset", "length", "record_id", "record_type", "target_uri"])

    # A number is named, since rows this small would else be merged into one task.
    return archives.select("archive").repartition(_tasks(archives)).mapInPandas(run, _ENTRY)


def _tasks(archives: DataFrame) -> int:
    """A task for each archive, up to a number that a cluster can keep track of."""
    return max(1, min(archives.count(), 20_000))


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that ``index`` (archive, offset, length) names, each read at its offset and checked by its digest.

    payload is NULL for revisits.  page_id and refers_to come from the record ids.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = _place(folder)
        for batch in batches:
            out: list[tuple] = []
            for archive, entries in batch.sort_values(["archive", "offset"]).groupby("archive", sort=False):
                with system.open_input_file(archive) as stream:
                    for offset, length in zip(entries["offset"], entries["length"]):
                        stream.seek(int(offset))
                        data = zlib.decompress(stream.read(int(length)), 31)
                        head, _, block = data.partition(b"\r\n\r\n")
                        fields = headers(head)
                        http, _, payload = block[: int(fields["content-length"])].partition(b"\r\n\r\n")
                        sha = fields["warc-payload-digest"].removeprefix("sha1:")
                        revisit = fields["warc-type"] == "revisit"
                        if not revisit and digest(payload) != sha:
                            raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
                        own = _OWN_ID.fullmatch(fields["warc-record-id"])
                        other = _OWN_ID.fullmatch(fields.get("warc-refers-to", ""))
                        out.append(
                            (own and own[1], fields.get("warc-target-uri"), fields["warc-type"], other and other[1], sha,
                             int(headers(http)["content-length"]), None if revisit or not with_payload else payload)
                        )
            yield pd.DataFrame(
                out, columns=["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
            )

    spread = index.select("archive", "offset", "length").repartition(_tasks(index.select("archive").distinct()), "archive")
    read = spread.mapInPandas(
        run, _RECORD.replace("page_id long", "page_id string").replace("refers_to long", "refers_to string")
    )
    return read.withColumns({name: F.col(name).cast("long") for name in ("page_id", "refers_to")})


def round_trip(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every row of ``pages``, read from normalised archives.

    NULL html is an empty payload.  Repeated rows have a record each; see ``pages_as_records`` for which
    are revisits.  An empty table gives an empty result; columns other than page_id, url and html are ignored.
    """
    spark = pages.sparkSession
    whole, split = new_folder(spark, "warc-whole"), new_folder(spark, "warc")
    archives = stored(write_whole_file(pages_as_records(pages), whole), "archives")
    index = stored(normalise(archives, split), "index")
    found = read_records(index, split, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
