"""WARC archives: a writer of gzip members, and a splittable reader.

The writer stores one record per row in gzip members of their own. A payload that occurs before under another record
is stored once: the record with the largest page id is a ``response``, the others are ``revisit`` records that
name it and hold the HTTP header only.

The reader lets tasks scan byte ranges of the archives. Within its range a task looks for the gzip magic, inflates
what follows and accepts a candidate only if it is a whole member with the right checksum that holds one WARC record whose
header parses and whose block length is right, followed by another member or the end of the file. A record belongs to the
range its first byte lies in; its task reads on past the range's end. Bytes of a stored block that merely look
like a member fail these tests. Damaged members are passed over, the scan goes on behind them.

Archives live in a folder all executors share, on any file system that Arrow knows by its URI. A task writes
under a name of its own, and only files named in the written manifest are read, so a task that ran twice leaves no record twice.

Defined results: a null payload is stored as empty. Page ids are compared as numbers, null before all; rows
with the largest id and the same payload that occur repeatedly are all responses. A null address is
stored as empty. An empty table gives an empty archive and no records. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertide.llm.common import new_folder, staged, table

MAGIC = b"\x1f\x8b\x08"
SPLIT_BYTES = 8 << 20
READ_BYTES = 1 << 20
READ_TASKS = 20_000  # ranges beyond this number share tasks
END = b"\r\n\r\n"
# Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit of the named response."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
             f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
             "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"), f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def member(record: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes one archive per task below ``folder`` and returns the manifest: ``uri, n_bytes, n_records``.
    ``pages`` has page_id, url, html. Rows that share a payload meet only through their digest and largest id."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), body.alias("body"))
    keyed = rows.withColumn("sha", F.sha1("body"))
    last = (pages.select("page_id", F.sha1(body).alias("sha")).groupBy("sha")
            .agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").select("sha", "last"))
    refers = F.when(F.col("page_id").eqNullSafe(F.col("last")), F.lit(None)).otherwise(F.col("last")).cast("long")
    planned = keyed.join(last, "sha", "left").select("page_id", "url", "body", refers.alias("refers_to"))

    def write(batches) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder)
        store.create_dir(root, recursive=True)
        name = f"{root}/{uuid.uuid4().hex}.warc.gz"
        size = count = 0
        sink = None
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(batch.column(i) for i in range(4))):
                if sink is None:
                    sink = store.open_output_stream(name, compression=None)  # members are gzip already
                data = payload.as_py()
                piece = member(record_bytes(page_id.as_py(), url.as_py(), data, payload_digest(data), refers_to.as_py()))
                sink.write(piece)
                size, count = size + len(piece), count + 1
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"name": [name.rsplit("/", 1)[1]], "n_bytes": [size], "n_records": [count]})

    written = planned.mapInArrow(write, "name string, n_bytes bigint, n_records bigint")
    return staged(written.select(F.concat(F.lit(folder + "/"), "name").alias("uri"), "n_bytes", "n_records"), "warc-manifest")


class ByteWindow:
    """A growing view of a file from one position on, read in pieces."""

    def __init__(self, source, position: int, size: int) -> None:
        self.source, self.base, self.size = source, position, size
        self.data = b""

    def ensure(self, upto: int) -> None:
        """Has the bytes before file position ``upto``, as far as the file goes."""
        while self.base + len(self.data) < min(upto, self.size):
            at = self.base + len(self.data)
            self.source.seek(at)
            piece = self.source.read(min(READ_BYTES, self.size - at))
            if not piece:  # shorter than announced
                self.size = at
                return
            self.data += piece

    def forget(self, position: int) -> None:
        if position - self.base > READ_BYTES:
            self.data = self.data[position - self.base:]
            self.base = position


def parse_header(head: bytes) -> dict[str, str] | None:
    lines = re.sub(rb"\r\n[ \t]+", b" ", head).split(b"\r\n")  # a line that begins with a space continues the one before
    if not lines[0].startswith(b"WARC/1."):
        return None
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    return fields if fields.get("content-length", "").isdigit() and "warc-type" in fields else None


def read_member(window: ByteWindow, at: int, doubtful: bool) -> tuple[dict[str, str], bytes, int] | None:
    """Header, block and end position of the record in the member at ``at``, or None if there is no such member. A ``doubtful`` one,
    which may lie inside a member that began earlier, counts only if the file ends or another member begins behind it."""
    unpack, out, position = zlib.decompressobj(31), [], at
    while not unpack.eof:
        window.ensure(position + 1)
        piece = window.data[position - window.base:position - window.base + READ_BYTES]
        if not piece:
            return None
        try:
            out.append(unpack.decompress(piece))
        except zlib.error:
            return None
        if len(out) == 1 and not out[0].startswith(b"WARC/1."[:len(out[0])]):
            return None  # most false candidates end here
        position += len(piece) - len(unpack.unused_data)
    record = b"".join(out)
    head, found, rest = record.partition(END)
    fields = parse_header(head) if found else None
    if fields is None or len(rest) != int(fields["content-length"]) + 4 or not rest.endswith(END):
        return None
    if not doubtful:
        return fields, rest[:-4], position
    window.ensure(position + len(MAGIC))
    follows = window.data[position - window.base:position - window.base + len(MAGIC)]
    return (fields, rest[:-4], position) if follows in (b"", MAGIC) else None


def records_in_range(source, size: int, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(position, header, block) of the records that begin in [start, end)."""
    window, at, doubtful = ByteWindow(source, start, size), start, start > 0
    while at < end:
        window.ensure(at + READ_BYTES)
        found = window.data.find(MAGIC, at - window.base)
        if found < 0:
            at = max(at + 1, window.base + len(window.data) - len(MAGIC) + 1)
            if window.base + len(window.data) >= window.size:
                return
            window.forget(at)
            continue
        at = window.base + found
        if at >= end:
            return
        record = read_member(window, at, doubtful)
        if record is None:
            at += 1
            continue
        yield at, record[0], record[1]
        at, doubtful = record[2], False
        window.forget(at)


_READ = ("uri string, position bigint, record_type string, record_id string, target_uri string, payload_digest string, "
         "payload_bytes bigint, refers_to string, payload binary")


def read_archives(files: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """The records of archives. ``files`` has ``uri`` and ``n_bytes``. Digest and length of a response are those of
    the payload as read; a revisit gives those of the payload it stands for. ``payload`` asks for the bytes themselves."""
    ranges = files.select("uri", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n_bytes") - 1, F.lit(0)),
                                                                 F.lit(split_bytes).cast("long"))).alias("start"))
    # A range is a few bytes here and many in the archive: without a number, all of them would be merged into one task.
    ranges = ranges.repartition(max(1, min(ranges.count(), READ_TASKS)))

    def read(batches) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        names = [c.split()[0] for c in _READ.split(", ")]
        types = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for uri, size, start in zip(*(batch.column(i).to_pylist() for i in range(3))):
                store, path = fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)
                rows, held = [], 0
                with store.open_input_file(path) as source:
                    for at, fields, block in records_in_range(source, size, start, start + split_bytes):
                        http, _, body = block.partition(END)
                        kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
                        n_bytes = len(body)
                        if kind == "revisit":
                            length = [x.split(b":", 1)[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                            n_bytes, body = int(length[0]) if length else None, None
                        else:
                            digest = payload_digest(body)
                        rows.append((uri, at, kind, fields.get("warc-record-id"), fields.get("warc-target-uri"), digest, n_bytes,
                                     fields.get("warc-refers-to"), body if payload else None))
                        held += len(block)
                        if held > READ_BYTES * 4:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return ranges.mapInArrow(read, _READ)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(table(spark, sf_dir, "pages"), new_folder(spark, "warc"))
    records = read_archives(manifest, payload=False)

    def page(column: str):
        return F.regexp_extract(column, r"^<urn:page:(-?\d*)>$", 1).try_cast("long")

    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          page("refers_to").alias("refers_to"))


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS last,
             list_transform(list_transform(range(1, 41), lambda i: sha1(body)[i]),
                            lambda c: strpos('0123456789abcdef', c) - 1) AS nib FROM p),
b AS (SELECT *, flatten(list_transform(nib, lambda n: [n // 8 % 2, n // 4 % 2, n // 2 % 2, n % 2])) AS bits FROM d)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
           16 * bits[5 * j + 1] + 8 * bits[5 * j + 2] + 4 * bits[5 * j + 3] + 2 * bits[5 * j + 4] + bits[5 * j + 5] AS BIGINT), 1)), '')
           AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM b
"""
