"""WARC archives with an index that is written first and read by byte ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import ListedRows, row_lists, settled
from earshot.session import fixed, scratch_path

# Ranges closer than GAP are fetched by one read of READ bytes at most (a longer record alone is one read).
GAP, READ = 64 << 10, 8 << 20
# Bytes of selected records that one task reads.
TASK_BYTES = 64 << 20
# A payload with more than one page in HOT of all pages is settled where it is read: HOT payloads at most.
HOT = 1_000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "file string, offset long, length long"
)
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


class Record(NamedTuple):
    """What a record's bytes say."""

    record_type: str
    url: str | None
    page_id: int | None
    refers_to: int | None
    payload_bytes: int
    payload_digest: str
    payload: bytes | None


def digest_of(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _number(value: int | None) -> str:
    return "" if value is None else str(value)


def encode_record(page_id, url, payload: bytes, record_type: str, refers_to) -> bytes:
    """One record: a response with the payload behind an HTTP head, or a revisit with that head alone."""
    digest = digest_of(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if record_type == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {digest}')}>"]
    head += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-ID: {_number(page_id)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if record_type == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {_number(refers_to)}"]
        if refers_to is not None:
            head.append(f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{refers_to} {digest}')}>")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    # A compressed member of its own, so that it can be read without the others.
    return gzip.compress("\r\n".join(head).encode() + block + b"\r\n\r\n", compresslevel=1, mtime=0)


def decode_record(data: bytes) -> Record:
    """A record's fields; a damaged record is an error."""
    data = gzip.decompress(data)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no record starts here")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("the record does not end where its length says")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError("the payload is not the one that was written")
    number = lambda name: int(fields[name]) if fields.get(name) else None
    url = fields.get("WARC-Target-URI")
    if url is not None:
        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return Record(
        kind, url, number("X-Page-ID"), number("X-Refers-To-Page-ID"), size, digest,
        payload if kind == "response" else None,
    )


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder all executors share."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit(""))


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``_row, refers_to`` of the settled pages that repeat another one's payload.

    Of equal payloads of at least ``min_bytes`` the one with the largest page id
    is the response (of repeated rows the last one read) and the others revisit
    it; smaller payloads are all responses. Only digests are moved. Winners come out of a partial
    aggregate; those of the most frequent payloads, ``HOT`` at most, are broadcast to
    their copies, the others are joined.
    """
    slim = fixed(
        pages.select(
            F.col("page_id").cast("long").alias("page_id"),
            F.unhex(F.sha1(_payload())).alias("_digest"),
            F.octet_length(_payload()).alias("_bytes"),
            F.monotonically_increasing_id().alias("_row"),
        ).filter(F.col("_bytes") >= min_bytes)
    )
    same = ["_digest", "_bytes"]
    groups = fixed(
        slim.groupBy(*same)
        .agg(F.max(F.struct("page_id", "_row")).alias("_last"), F.count("*").alias("_n"))
        .filter("_n > 1")
    )
    many = F.col("_n") * HOT > slim.count()
    hot = F.broadcast(groups.filter(many))
    rest = slim.join(hot.select(*same), same, "left_anti").join(groups.filter(~many), same)
    met = slim.join(hot, same).unionByName(rest)
    return met.filter("_last._row <> _row").select("_row", F.col("_last.page_id").alias("refers_to"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Write one compressed record per page below ``path`` and return the stored index.

    Every task writes an archive of its own name and reports offset, length,
    URL and digest of each record; the index holds the reports of the tasks that
    succeeded, so an archive left by a lost one is never read. Null html is an
    empty payload, a null url leaves the header out, columns other than
    ``page_id, url, html`` play no part, and no pages give an empty index. A very long payload is one
    record. Which pages revisit others is listed by split of the scan, so payloads are never moved.
    """
    pages = settled(pages)
    path_of_lists = row_lists(revisits(pages, min_bytes))
    numbered_pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        _payload().alias("html"),
        F.monotonically_increasing_id().alias("_row"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _opened(path)
        system.create_dir(folder, recursive=True)
        name, sink, at = f"{uuid.uuid4().hex}.warc.gz", None, 0
        listed = ListedRows(path_of_lists)
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                numbers = batch.column("_row").to_numpy()
                index = []
                for row, again, refers_to in zip(
                    batch.to_pylist(), listed.among(numbers).tolist(), listed.values(numbers, "refers_to")
                ):
                    payload, kind = row["html"].encode(), "revisit" if again else "response"
                    record = encode_record(row["page_id"], row["url"], payload, kind, refers_to)
                    sink = sink or system.open_output_stream(f"{folder}/{name}", compression=None)
                    sink.write(record)
                    digest = digest_of(payload)
                    index.append(
                        (row["page_id"], row["url"], kind, refers_to, len(payload), digest, name, at, len(record))
                    )
                    at += len(record)
                if index:
                    long, text = pa.int64(), pa.string()
                    kinds = (long, text, text, long, long, text, text, long, long)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*index), kinds)], [c.split()[0] for c in INDEX.split(", ")]
                    )
        finally:
            if sink is not None:
                sink.close()

    numbered_pages.mapInArrow(write, INDEX).write.parquet(f"{path}/index")
    return read_index(pages.sparkSession, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def _coalesced(ranges: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, int, int]]:
    """Sorted ranges as reads: file, from, to, and the first and last range inside."""
    first = 0
    for i in range(1, len(ranges) + 1):
        name, begin, _ = ranges[first]
        _, offset, length = ranges[i - 1]
        end = offset + length
        if i < len(ranges):
            following, start, size = ranges[i]
            if following == name and start - end <= GAP and start + size - begin <= READ:
                continue
        yield name, begin, end, first, i
        first = i


def read_records(selected: DataFrame, path: str) -> DataFrame:
    """Records of the selected index rows, read back from the archives.

    No rows give no records. The rows are sorted by archive and offset and dealt in ranges of about
    ``TASK_BYTES``; neighbours are fetched by one read. A revisit has no payload
    of its own (null): its response's is named by ``refers_to`` and digest.
    """
    total = selected.agg(F.sum("length")).head()[0] or 0
    tasks = max(math.ceil(total / TASK_BYTES), int(selected.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def fetch(system, folder, names, offsets, lengths) -> Iterator[Record]:
        for name, begin, end, first, last in _coalesced(list(zip(names, offsets, lengths))):
            with system.open_input_file(f"{folder}/{name}") as source:
                data = source.read_at(end - begin, begin)
            for i in range(first, last):
                at = offsets[i] - begin
                yield decode_record(data[at : at + lengths[i]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _opened(path)
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        for batch in batches:
            rows, held = [], 0
            columns = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
            for r in fetch(system, folder, *columns):
                rows.append((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.payload))
                held += len(r.payload or b"")
                if held > READ:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    names = [c.split()[0] for c in RECORD.split(", ")]
    placed = selected.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset")
    return placed.sortWithinPartitions("file", "offset").mapInArrow(read, RECORD)


def archive_path(spark: SparkSession) -> str:
    return scratch_path(spark, "warc")
