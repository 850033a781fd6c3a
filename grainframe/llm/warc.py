"""Legacy web archives (ARC) to WARC, and both to and from Spark rows.

An ARC archive starts with a version block whose first line declares a length and whose
body names version and fields: version 1 records have five header fields, version 2
records ten.  Records follow, each a header line with the declared length of its content
and the content itself.  The converter reads the declared lengths, never searches for the
next header, and synthesises what WARC adds: record ids (from address, time and digest,
so a second run gives the same), ISO times, record types, block and payload digests.

Payloads of at least ``REVISIT_BYTES`` that are equal are stored once, as the response
of the greatest record key; those with other keys become revisits that refer to it.

Archives are gzip members, one per record, in files of the folder that all executors
share, cut by the bytes they unpack to.  A file is written under a name of its attempt and
renamed when complete, so a lost task leaves nothing under a name that is read.  Archives
are read as streams and payloads leave in batches of a few MB, so neither an archive nor
many alike pages, which pack a hundredfold, are in memory at once.

Defined results: null payloads count as empty, a null address becomes ``urn:record:KEY``;
equal rows become records of their own, all responses; an empty table writes no archive
and reads back as no rows; rows with a null key are archived under the key ``null``, are
always responses, and no revisit refers to them; columns not named are left out.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainframe.llm.shared_files import filesystem
from grainframe.session import cut_lineage, scratch_path

REVISIT_BYTES = 1000
ARC_BYTES = 1_000_000
WARC_BYTES = 64_000_000
#: Bytes of payloads in a batch that is read back, about.
BATCH_BYTES = 4_000_000
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVED = "20240102030405"
_KEY = re.compile(rb"#record=(-?[0-9]+)$")  # the key ``null`` is no number and reads back as null


def http_response(payload: bytes) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload


def arc_archive(version: int, records: list[tuple[bytes, bytes]]) -> bytes:
    """An uncompressed ARC archive of (address, content) pairs."""
    body = f"{version} 0 Archive\n{FIELDS[version]}\n".encode()
    out = [f"filedesc://made.arc 0.0.0.0 {ARCHIVED} text/plain ".encode()]
    out.append((f"{len(body)}\n" if version == 1 else f"200 - - 0 made.arc {len(body)}\n").encode() + body)
    at = sum(map(len, out))
    for address, content in records:
        line = address + f" 0.0.0.0 {ARCHIVED} text/html ".encode()
        if version == 2:
            line += b"200 %s - %d made.arc " % (hashlib.md5(content).hexdigest().encode(), at)
        out.append(b"\n" + line + b"%d\n" % len(content) + content)
        at += len(out[-1])
    return b"".join(out) + b"\n"


def read_arc(data: bytes) -> Iterator[tuple[dict[str, bytes], bytes]]:
    """Header fields and content of each record, by the version the archive declares."""
    line_end = data.index(b"\n")
    length = int(data[:line_end].rsplit(b" ", 1)[1])
    block = data[line_end + 1 : line_end + 1 + length].split(b"\n")
    version = int(block[0].split(b" ", 1)[0])
    if version not in FIELDS:
        raise ValueError(f"ARC version {version} is not known")
    names = block[1].decode().split(" ")
    at = line_end + 1 + length
    while at < len(data):
        if data[at : at + 1] in b"\r\n":  # blank lines between records
            at += 1
            continue
        line_end = data.index(b"\n", at)
        values = data[at:line_end].rstrip(b"\r").split(b" ")
        if len(values) != len(names):
            raise ValueError(f"an ARC header has {len(values)} fields, version {version} has {len(names)}")
        fields = dict(zip(names, values))
        length = int(fields["Archive-length"])
        at = line_end + 1 + length
        if at > len(data):
            raise ValueError("an ARC record is shorter than its header says")
        yield fields, data[line_end + 1 : at]


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP head with its blank line, and payload."""
    at = content.find(b"\r\n\r\n")
    return (b"", content) if at < 0 else (content[: at + 4], content[at + 4 :])


def digest(data: bytes) -> str:
    """SHA-1 as WARC writes it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def iso_time(stamp: str) -> str:
    """A 14-digit ARC time; shorter ones are filled up."""
    s = stamp + "00000101000000"[len(stamp) :]
    return f"{s[:4]}-{s[4:6]}-{s[6:8]}T{s[8:10]}:{s[10:12]}:{s[12:14]}Z"


def record_id(address: str, time: str, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{address} {time} {payload_digest}')}>"


def warc_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers)]
    lines += [f"WARC-Block-Digest: {digest(block)}", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def members(read: Callable[[int], bytes]) -> Iterator[bytes]:
    """Contents of the gzip members of a stream, one after the other."""
    opener, parts, rest = zlib.decompressobj(31), [], b""
    while data := rest or read(1 << 16):
        parts.append(opener.decompress(data))
        rest = opener.unused_data
        if opener.eof:
            yield b"".join(parts)
            opener, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("a WARC record is cut off")


def read_warc(read: Callable[[int], bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (with the type) and block of each record of a compressed archive, read as a stream."""
    for text in members(read):
        at = text.index(b"\r\n\r\n")
        lines = text[:at].decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        length = int(headers["Content-Length"])
        block = text[at + 4 : at + 4 + length]
        if digest(block) != headers["WARC-Block-Digest"]:
            raise ValueError("a WARC block does not have its digest")
        yield headers, block


def to_arc(rows: DataFrame, arc_bytes: int = ARC_BYTES) -> DataFrame:
    """``key, url, payload`` rows as ARC archives of about ``arc_bytes``, versions in turn."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version, held, size = 1, [], 0

        def made():
            return pa.RecordBatch.from_arrays([pa.array([arc_archive(version, held)], pa.binary())], ["archive"])

        for batch in batches:
            for key, url, payload in zip(*(batch.column(c) for c in ("key", "url", "payload"))):
                key = "null" if key.as_py() is None else key
                address = re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0],
                                 (url.as_py() or f"urn:record:{key}").encode())
                content = http_response(payload.as_py() or b"")
                held.append((address + f"#record={key}".encode(), content))
                size += len(content)
                if size >= arc_bytes:
                    yield made()
                    version, held, size = 3 - version, [], 0
        if held:
            yield made()

    return rows.select("key", "url", "payload").mapInArrow(scan, "archive binary")


def arc_records(archives: DataFrame) -> DataFrame:
    """The WARC view of every ARC record: address, time, type, head, payload, digest, id."""
    names = ["key", "address", "time", "record_id", "payload_digest", "payload_bytes", "head", "payload"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("archive"):
                rows = []
                for fields, content in read_arc(archive.as_py()):
                    head, payload = split_http(content)
                    named = _KEY.search(fields["URL"])
                    address = fields["URL"].decode()
                    time, sha = iso_time(fields["Archive-date"].decode()), digest(payload)
                    rows.append((int(named[1]) if named else None, address, time,
                                 record_id(address, time, sha), sha, len(payload), head, payload))
                kinds = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.binary(), pa.binary()]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names
                    )

    return archives.mapInArrow(
        scan,
        "key long, address string, time string, record_id string, payload_digest string, "
        "payload_bytes long, head binary, payload binary",
    )


def with_originals(records: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Adds the id and address of the record that holds an equal payload, null if it is this one.

    Only digests are grouped, so a payload that a third of all records share is one
    pre-aggregated row; records with small payloads or without a key take no part.
    """
    big = records.where((F.col("payload_bytes") >= revisit_bytes) & F.col("key").isNotNull())
    originals = big.groupBy("payload_digest").agg(
        F.max(F.struct("key", "record_id", "address", "time")).alias("original"), F.count("*").alias("__n")
    ).where("__n > 1").drop("__n")
    joined = records.join(originals, "payload_digest", "left")
    other = (F.col("original.key") != F.col("key")) & (F.col("payload_bytes") >= revisit_bytes)
    return joined.withColumn("original", F.when(other, F.col("original")))


def write_warc(records: DataFrame, folder: str, warc_bytes: int = WARC_BYTES) -> DataFrame:
    """Writes the records as archives below ``folder``; returns the paths with their record counts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, base = filesystem(folder)
        held, size, count, number = [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            path = f"{base}/part-{context.partitionId():06d}-{number:05d}.warc.gz"
            draft = f"{path}.{context.taskAttemptId()}"
            store.create_dir(base, recursive=True)
            with store.open_output_stream(draft, compression=None) as out:
                for member in held:
                    out.write(member)
            store.move(draft, path)
            return pa.RecordBatch.from_arrays(
                [pa.array([path.rsplit("/", 1)[1]]), pa.array([count], pa.int64())], ["file", "records"]
            )

        for batch in batches:
            for row in batch.to_pylist():
                headers = [
                    ("WARC-Record-ID", row["record_id"]),
                    ("WARC-Target-URI", row["address"]),
                    ("WARC-Date", row["time"]),
                    ("WARC-Payload-Digest", row["payload_digest"]),
                    ("Content-Type", "application/http; msgtype=response"),
                ]
                if original := row["original"]:
                    headers += [
                        ("WARC-Profile", PROFILE),
                        ("WARC-Refers-To", original["record_id"]),
                        ("WARC-Refers-To-Target-URI", original["address"]),
                        ("WARC-Refers-To-Date", original["time"]),
                    ]
                block = row["head"] + (b"" if original else row["payload"])
                held.append(warc_record("revisit" if original else "response", headers, block))
                size, count = size + len(block), count + 1
                if size >= warc_bytes:
                    yield flush()
                    held, size, count, number = [], 0, 0, number + 1
        if held:
            yield flush()

    # in a fixed order, so that a task run again cuts its archives in the same places
    return records.sortWithinPartitions("key", "record_id").mapInArrow(scan, "file string, records long")


def _page(headers: dict[str, str], block: bytes) -> tuple:
    """Row of a record; a stored payload must have its digest."""
    kind, sha = headers["WARC-Type"], headers["WARC-Payload-Digest"]
    head, payload = split_http(block)
    if kind == "response" and digest(payload) != sha:
        raise ValueError("a payload does not have its digest")
    declared = re.search(rb"\r\nContent-Length: ([0-9]+)", head)
    size = len(payload) if kind == "response" else int(declared[1])
    named = _KEY.search(headers["WARC-Target-URI"].encode())
    refers = _KEY.search(headers.get("WARC-Refers-To-Target-URI", "").encode())
    return (
        int(named[1]) if named else None, headers["WARC-Record-ID"],
        headers["WARC-Target-URI"], headers["WARC-Date"], kind, size,
        base64.b32decode(sha.removeprefix("sha1:")).hex(),
        int(refers[1]) if refers else None, payload,
    )


def read_archives(files: DataFrame, folder: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Every record of the archives named by ``files.file``.

    A payload is checked against its digest where it is stored; the size of a revisit's
    payload is what its HTTP head declares.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        kinds = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.int64(), pa.binary()]
        names = ["key", "record_id", "address", "time", "record_type", "payload_bytes",
                 "payload_digest", "refers_to", "payload"]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        rows, held = [], 0
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with store.open_input_stream(f"{base}/{name}", compression=None) as source:
                    for headers, block in read_warc(source.read):
                        rows.append(_page(headers, block))
                        held += 300 + len(block)
                        if held >= batch_bytes:
                            yield made(rows)
                            rows, held = [], 0
        if rows:
            yield made(rows)

    return files.mapInArrow(
        scan,
        "key long, record_id string, address string, time string, record_type string, "
        "payload_bytes long, payload_digest string, refers_to long, payload binary",
    )


def convert_and_read(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """``key, url, payload`` rows through ARC archives into WARC files and back.

    Writes below ``folder`` (by default a new scratch folder) when called.  The converted
    records are written once: their digests are grouped and their payloads archived from it.
    """
    spark = rows.sparkSession
    folder = folder or scratch_path(spark, "warc")
    path, converted = scratch_path(spark, "arc-records"), arc_records(to_arc(rows))
    converted.write.option("compression", "zstd").parquet(path)  # web pages pack well
    records = with_originals(spark.read.schema(converted.schema).parquet(path))
    files = cut_lineage(write_warc(records, folder), "warc-files")
    width = max(1, spark.sparkContext.defaultParallelism, files.count())
    return read_archives(files.repartition(width, "file"), folder)
