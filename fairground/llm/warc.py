"""WARC archives: written as one gzip stream a file, normalised to one member a record with an offset index, read by offset.

``write_archives`` writes pages as a crawler without record-wise compression does: whole files of one gzip stream. Of pages
with equal payloads only the one with the smallest id is a response, the others are revisits of it. ``normalise`` inflates
such a stream once, from front to back, and rewrites each record as a gzip member of its own; the index that it returns says
where each lies. ``read_records`` takes records from there, in any number and order.

Files are written by tasks under names that no other attempt uses, and only tables that Spark has committed name them: what
an attempt leaves that was lost or ran twice is never read. The folder may be any that pyarrow's file systems reach.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairground.llm.common import Scratch

#: Inflated bytes after which a new archive is begun.
ARCHIVE_BYTES = 256 << 20
#: Groups of equal payloads up to which their first ids go to every worker (some 80 bytes each).
BROADCAST_GROUPS = 200_000
ARCHIVES = "archive string, records bigint, bytes bigint"
INDEX = "archive string, offset bigint, length bigint, record_id string, record_type string, target_uri string, payload_digest string, refers_to string, error string"
RECORDS = "record_id string, record_type string, target_uri string, payload binary, payload_bytes bigint, payload_digest string, refers_to string, error string"
#: Fixed values of the format.
VERSION, END = b"WARC/1.1", b"\r\n\r\n"
REVISIT = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
OWN_ID = "urn:x-record:"
CHUNK = 1 << 20


def place(uri: str):
    """The file system of a URI or path, and the path in it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: bytes, fields: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    head = [VERSION, b"WARC-Type: " + kind, *(k + b": " + v for k, v in fields), b"Content-Length: " + str(len(block)).encode()]
    return b"\r\n".join(head) + END + block + END


def page_record(own: bytes, url: str | None, payload: bytes | None, size: int, sha1: str, first: str | None, date: bytes) -> bytes:
    """A page as a response, or without its payload as a revisit of the record ``first``."""
    fields = [(b"WARC-Record-ID", b"<" + own + b">"), (b"WARC-Date", date)]
    if url is not None:
        fields.append((b"WARC-Target-URI", re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], url.encode())))
    fields += [(b"WARC-Payload-Digest", b"sha1:" + base64.b32encode(bytes.fromhex(sha1))), (b"Content-Type", b"application/http; msgtype=response")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + str(size).encode() + END
    if first is None:
        return record(b"response", fields, http + (payload or b""))
    return record(b"revisit", [*fields, (b"WARC-Profile", REVISIT), (b"WARC-Refers-To", f"<{OWN_ID}{first}>".encode())], http)


def write_archives(spark: SparkSession, pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", payload: str = "html", date: str = "2000-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """One record for each row of ``pages``, in archives of one gzip stream each; a row for each archive.

    Payloads are text in UTF-8 or bytes; null is empty, and so equal to the empty one. Of rows with equal payloads that have
    an id, those with the smallest are responses and the others refer to it; rows without an id are responses that nothing
    refers to. A null url is left out; blanks and control characters in it are escaped. Repeated rows are records each; an
    empty table makes no archive; further columns are not written. A task holds one payload and one compressor at a time.
    """
    scratch = Scratch(spark, "warc-pages")
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id).alias("own"), F.col(url).cast("string").alias("url"), body.alias("body"))
    rows = rows.select("own", "url", "body", F.length("body").cast("long").alias("size"), F.sha1("body").alias("sha1"))
    groups = rows.where("own is not null").groupBy("sha1", "size").agg(F.min("own").alias("first"), F.max("own").alias("last")).where("first != last").drop("last")
    groups = scratch.table("groups", groups)
    few = groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    found = rows.join(F.broadcast(groups) if few else groups, ["sha1", "size"], "left")
    again = F.col("first").isNotNull() & F.col("own").isNotNull() & (F.col("own") != F.col("first"))
    found = found.select(F.col("own").cast("string").alias("own"), "url", F.when(~again, F.col("body")).alias("body"), "size", "sha1", F.when(again, F.col("first").cast("string")).alias("first"))
    when = date.encode()

    def write(batches) -> Iterator[pa.RecordBatch]:
        system, top = place(folder)
        system.create_dir(top, recursive=True)
        name, packer, sink, records, size = None, None, None, 0, 0

        def done():
            packer.close()
            sink.close()
            return pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [records], "bytes": [size]}, pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

        for batch in batches:
            for i in range(batch.num_rows):
                own, address, body, length, sha1, first = (c[i].as_py() for c in batch.columns)
                if packer is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = system.open_output_stream(f"{top}/{name}", compression=None)
                    packer = gzip.GzipFile(fileobj=sink, mode="wb", compresslevel=6, mtime=0)
                    packer.write(record(b"warcinfo", [(b"WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>".encode()), (b"WARC-Date", when), (b"WARC-Filename", name.encode()), (b"Content-Type", b"application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                ident = f"{OWN_ID}{own}" if own is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{records}')}"
                made = page_record(ident.encode(), address, body, length, sha1, first, when)
                packer.write(made)
                records, size = records + 1, size + len(made)
                if size >= archive_bytes:
                    yield done()
                    packer = None
        if packer is not None:
            yield done()

    return scratch.table("archives", found.mapInArrow(write, ARCHIVES))


def inflated(source) -> Iterator[bytes]:
    """What a stream of one or several gzip members holds, chunk by chunk; ``EOFError`` where it is cut off."""
    unpack, begun = zlib.decompressobj(31), False
    while piece := source.read(CHUNK):
        while piece:
            begun = True
            try:
                if out := unpack.decompress(piece, 4 * CHUNK):
                    yield out
            except zlib.error as e:
                raise EOFError(str(e)) from e
            piece = unpack.unconsumed_tail
            if unpack.eof:
                piece, unpack, begun = unpack.unused_data.lstrip(b"\0"), zlib.decompressobj(31), False
    if begun:
        raise EOFError("the stream is cut off")


class Reader:
    """Bytes of a stream by number or up to a mark; it holds one record and one chunk."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.have = chunks, bytearray()

    def take(self, n: int) -> bytes:
        while len(self.have) < n:
            if (more := next(self.chunks, None)) is None:
                raise EOFError("the last record is cut off")
            self.have += more
        out = bytes(memoryview(self.have)[:n])
        del self.have[:n]
        return out

    def head(self) -> bytes | None:
        """The header lines of the next record; none at the end."""
        seen = 0
        while True:
            if not seen:
                blank = len(self.have) - len(self.have.lstrip(b"\r\n"))
                del self.have[:blank]
            if (at := self.have.find(END, max(0, seen - 3))) >= 0:
                return self.take(at + 4)
            seen = len(self.have)
            if (more := next(self.chunks, None)) is None:
                if self.have:
                    raise EOFError("the last record is cut off")
                return None
            self.have += more


def fields_of(head: bytes) -> dict[str, str]:
    """Header fields by name in lower case; a repeated one counts once, the first time."""
    out: dict[str, str] = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out.setdefault(name.strip().lower().decode("latin-1"), value.strip().decode("utf-8", "replace"))
    return out


def records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and whole bytes of each record of a gzip stream, in order."""
    reader = Reader(inflated(source))
    while (head := reader.head()) is not None:
        if not head.startswith(b"WARC/"):
            raise EOFError("no record begins where one should")
        found = fields_of(head)
        if not found.get("content-length", "").isdigit():
            raise EOFError("a record without a length")
        yield found, head + reader.take(int(found["content-length"])) + END


def bare(value: str | None) -> str | None:
    return value.strip("<>") if value is not None else None


def normalise(spark: SparkSession, archives: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """The index of archives rewritten with one gzip member a record: archive, offset, length and what the header says.

    ``archives`` names them in ``archive``; each is inflated once, as a stream, by one task that holds one record at a time.
    Archives of several members are taken as well. Of an archive that is cut off or damaged all records before that place
    are kept, and a row with an ``error`` and no length follows. An empty table gives an empty index.
    """
    scratch = Scratch(spark, "warc-index")
    names = [f.split()[0] for f in INDEX.split(", ")]

    def rewrite(batches) -> Iterator[pa.RecordBatch]:
        system, top = place(folder)
        system.create_dir(top, recursive=True)
        schema = pa.schema([(n, pa.int64() if n in ("offset", "length") else pa.string()) for n in names])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                name, at, rows = f"{uuid.uuid4().hex}.warc.gz", 0, []
                whence, inside = place(path)
                with whence.open_input_stream(inside, compression=None) as source, system.open_output_stream(f"{top}/{name}", compression=None) as sink:
                    try:
                        for found, whole in records(source):
                            packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                            member = packer.compress(whole) + packer.flush()
                            sink.write(member)
                            sha1 = found.get("warc-payload-digest")
                            rows.append((f"{folder}/{name}", at, len(member), bare(found.get("warc-record-id")), found.get("warc-type"), bare(found.get("warc-target-uri")), sha1, bare(found.get("warc-refers-to")), None))
                            at += len(member)
                            if len(rows) == 10_000:
                                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)
                                rows = []
                    except EOFError as e:
                        rows.append((f"{folder}/{name}", at, None, None, None, None, None, None, f"{path}: {e}"))
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)

    tasks = max(1, min(archives.count(), 100_000))
    return scratch.table("index", archives.select("archive").repartition(tasks, "archive").mapInArrow(rewrite, INDEX))


def read_records(spark: SparkSession, index: DataFrame) -> DataFrame:
    """The records of rows of an index: type, ids, address, payload, and its size and digest in bare base32.

    Each is read from its offset alone, archives in order of offset, so a filtered index reads what it names and no more. A
    response's digest is that of the payload read, and ``error`` says where the header states another; a revisit states
    both of the payload that it does not hold, whose ``payload`` is null. Rows with an error in the index stay as they are.
    """
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = {"payload": pa.binary(), "payload_bytes": pa.int64()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def read(batches) -> Iterator[pa.RecordBatch]:
        here, source = None, None
        for batch in batches:
            rows, held = [], 0
            for archive, offset, length, error in zip(*(batch.column(n).to_pylist() for n in ("archive", "offset", "length", "error"))):
                if length is None:
                    rows.append(dict.fromkeys(names) | {"error": error})
                    continue
                if archive != here:
                    if source is not None:
                        source.close()
                    system, inside = place(archive)
                    here, source = archive, system.open_input_file(inside)
                source.seek(offset)
                whole = zlib.decompress(source.read(length), 31)
                head, _, block = whole.partition(END)
                found, block = fields_of(head), block[: -len(END)]
                stated = (found.get("warc-payload-digest") or "").rpartition(":")[2] or None
                row = {"record_id": bare(found.get("warc-record-id")), "record_type": found.get("warc-type"), "target_uri": bare(found.get("warc-target-uri")), "refers_to": bare(found.get("warc-refers-to"))}
                http = found.get("content-type", "").startswith("application/http")
                top, _, payload = block.partition(END) if http else (b"", b"", block)
                if row["record_type"] == "revisit":
                    size = fields_of(top).get("content-length")
                    row |= {"payload_bytes": int(size) if size is not None else None, "payload_digest": stated}
                else:
                    true = digest(payload)
                    row |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": true, "error": f"digest is {true}, not {stated}" if stated and stated != true else None}
                rows.append(row)
                held += len(payload)
                if held >= 4 * CHUNK:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return index.repartition(tasks, "archive").sortWithinPartitions("archive", "offset").select("archive", "offset", "length", "error").mapInArrow(read, RECORDS)


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Pages written, normalised and read back: the records of ``pages``, without the archives' own."""
    where = Scratch(spark, "warc").base
    index = normalise(spark, write_archives(spark, pages, f"{where}/monolithic"), f"{where}/records")
    return read_records(spark, index.where("record_type in ('response', 'revisit') or error is not null"))
