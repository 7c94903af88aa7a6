"""WARC archives as seekable Zstandard bundles.

Each task writes its records into ``.warc.zst`` files of the shared folder. Records
are grouped into frames of about ``frame_bytes``, each compressed on its own; a
file ends with the seek table of the Zstandard seekable format (a skippable frame
with the packed size, plain size and checksum of every frame). The index is a
Parquet table with one row per frame that maps every record identifier to its
offset within the plain frame, so one record costs one seek and one frame.

* Roles. Of equal payloads of at least ``least_bytes`` bytes the row with the
  smallest id is a ``response``; the others are ``revisit`` records without a
  payload. Only ids, URLs and digests are grouped; a payload is moved at most once
  (not at all where Spark finds the table of shared digests small enough to
  broadcast), and payloads of revisits are never written.
* Commit. A file's name carries a fresh token of its task attempt and the index is
  written by Spark's own commit: a file that no index row names was left by a lost
  attempt and is never read.
* Reading. The index rows are dealt out by file and frame; a task reads the seek
  table of a file, then the frames it needs, checks the frame's checksum and, for a
  response, the payload's SHA-1.

Defined cases: a null payload is written as an empty one; a null id is larger than
every id and written without its header field; a null URL likewise; rows that share
id and payload are ordered by URL, and of wholly equal rows one is the response;
control characters of a URL are percent-encoded; an empty table gives no files and
no rows; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import scratch_path

FRAME_BYTES = 1 << 20
FILE_BYTES = 1 << 30
READ_BYTES = 64 << 20          # packed bytes that one reading task is given
RUN = 4096                     # repeated rows are expanded in runs of this length
# Fixed values of the seekable format and of the WARC record.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC, CHECKSUM_FLAG = 0x184D2A5E, 0x8F92EAB1, 0x80
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
INDEX = ("archive string, frame int, packed_bytes long, plain_bytes long, "
         "records array<struct<record_id: string, page_id: long, offset: long, length: long>>")
RECORDS = ("record_id string, page_id long, url string, record_type string, payload_bytes long, "
           "payload_digest string, refers_to long, payload binary")


def _urn(*parts) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(repr(parts).encode()).digest())}>"


def _clean_url(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = [VERSION] + [f"{k}: {v}" for k, v in fields if v is not None] + [f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of the record at the start of ``raw``."""
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode("utf-8").split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a {VERSION} record: {lines[0]!r}")
    fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    body = end + 4
    return fields, raw[body:body + int(fields["content-length"])]


def seek_table(entries: list[tuple[int, int, int]]) -> bytes:
    """The closing skippable frame for ``(packed size, plain size, checksum)`` of each frame."""
    body = b"".join(struct.pack("<III", *e) for e in entries) + struct.pack("<IBI", len(entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(f) -> list[tuple[int, int, int, int]]:
    """``(offset, packed size, plain size, checksum)`` of each frame of an open file."""
    size = f.size()
    f.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
        raise ValueError("no seek table at the end of the archive")
    f.seek(size - 9 - 12 * n)
    out, at = [], 0
    for packed, plain, check in struct.iter_unpack("<III", f.read(12 * n)):
        out.append((at, packed, plain, check))
        at += packed
    return out


def _checksum(plain: bytes) -> int:
    return xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF


class _Writer:
    """The archives of one task attempt. ``add`` and ``close`` return the index rows of
    the frames they completed."""

    def __init__(self, folder: str, frame_bytes: int, file_bytes: int, level: int, date: str):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.frame_bytes, self.file_bytes, self.date = frame_bytes, file_bytes, date
        self.packer = zstandard.ZstdCompressor(level=level)
        self.stem = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:16]}"
        self.files, self.out = 0, None

    def _open(self):
        self.name = f"{self.stem}-{self.files:04d}.warc.zst"
        self.files += 1
        self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        self.entries, self.written = [], 0
        self.parts, self.records, self.size = [], [], 0
        info = f"software: corpusloom\r\nformat: {VERSION}\r\n".encode()
        urn = _urn("warcinfo", self.name)
        self.parts.append(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", urn), ("WARC-Date", self.date),
                                  ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info))
        self.size = len(self.parts[0])

    def add(self, urn: str, page_id: int | None, raw: bytes) -> list[dict]:
        done = []
        if self.out is None:
            self._open()
        if self.records and self.size + len(raw) > self.frame_bytes:
            done.append(self._frame())
            if self.written >= self.file_bytes:
                self._finish()
                self._open()
        self.records.append({"record_id": urn, "page_id": page_id, "offset": self.size, "length": len(raw)})
        self.parts.append(raw)
        self.size += len(raw)
        return done

    def _frame(self) -> dict:
        plain = b"".join(self.parts)
        packed = self.packer.compress(plain)
        self.out.write(packed)
        row = {"archive": self.name, "frame": len(self.entries), "packed_bytes": len(packed), "plain_bytes": len(plain), "records": self.records}
        self.entries.append((len(packed), len(plain), _checksum(plain)))
        self.written += len(packed)
        self.parts, self.records, self.size = [], [], 0
        return row

    def _finish(self):
        self.out.write(seek_table(self.entries))
        self.out.close()
        self.out = None

    def close(self) -> list[dict]:
        if self.out is None:
            return []
        done = [self._frame()] if self.records else []
        self._finish()
        return done


_INDEX_TYPE = pa.schema([("archive", pa.string()), ("frame", pa.int32()), ("packed_bytes", pa.int64()), ("plain_bytes", pa.int64()),
                         ("records", pa.list_(pa.struct([("record_id", pa.string()), ("page_id", pa.int64()),
                                                         ("offset", pa.int64()), ("length", pa.int64())])))])


def _write(folder: str, frame_bytes: int, file_bytes: int, level: int, date: str):
    """Rows ``(id, url, html, digest, bytes, first id, first url, shared)`` to archives; a
    null ``html`` marks a revisit."""
    def run(batches):
        writer = _Writer(folder, frame_bytes, file_bytes, level, date)
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            done = []
            page, url, html, digest, size, first, first_url, shared = batch.columns
            for k in range(batch.num_rows):
                n += 1
                i, u, d = page[k].as_py(), url[k].as_py(), digest[k].as_py()
                code = base64.b32encode(bytes.fromhex(d)).decode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size[k].as_py()}\r\n\r\n".encode()
                response = html[k].is_valid
                urn = _urn("response", d) if response and shared[k].as_py() else _urn("row", part, n)   # only shared ones are referred to
                own = [("WARC-Type", "response" if response else "revisit"), ("WARC-Record-ID", urn), ("WARC-Date", date),
                       ("WARC-Target-URI", None if u is None else _clean_url(u)), ("WARC-Payload-Digest", f"sha1:{code}"),
                       ("WARC-X-Page-Id", None if i is None else str(i)), ("Content-Type", "application/http; msgtype=response")]
                if response:
                    block = head + html[k].as_buffer().to_pybytes()
                else:
                    block, to, to_url = head, first[k].as_py(), first_url[k].as_py()
                    own += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _urn("response", d)),
                            ("WARC-Refers-To-Target-URI", None if to_url is None else _clean_url(to_url)),
                            ("WARC-X-Refers-To-Page-Id", None if to is None else str(to))]
                done += writer.add(urn, i, record(own, block))
            if done:
                yield pa.RecordBatch.from_pylist(done, _INDEX_TYPE)
        done = writer.close()
        if done:
            yield pa.RecordBatch.from_pylist(done, _INDEX_TYPE)
    return run


def _roles(keyed: DataFrame, least_bytes: int) -> tuple[DataFrame, DataFrame]:
    """``shared`` digests ``(d, n, f_id, f_url, f_copies)`` that several rows have, with
    the first row, and the distinct narrow rows with their number of copies."""
    rows = keyed.groupBy("i", "u", "d", "n").agg(F.count(F.lit(1)).alias("copies"))
    order = F.struct(F.col("i").isNull(), F.col("i").alias("i"), F.col("u").isNull(), F.col("u").alias("u"), F.col("copies").alias("copies"))
    shared = (rows.where(F.col("n") >= least_bytes).groupBy("d", "n").agg(F.min(order).alias("f"), F.sum("copies").alias("k"))
              .where("k > 1").select("d", "n", F.col("f.i").alias("f_id"), F.col("f.u").alias("f_url"), F.col("f.copies").alias("f_copies")))
    return shared, rows


def _is_first():
    return F.col("i").eqNullSafe(F.col("f_id")) & F.col("u").eqNullSafe(F.col("f_url"))


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0,
                   frame_bytes: int = FRAME_BYTES, file_bytes: int = FILE_BYTES, level: int = 3, date: str = DATE) -> DataFrame:
    """Write a record per row of ``pages`` below ``folder`` and return the index
    (``INDEX``), read from ``folder/index``. The archives are in ``folder/archives``."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    wide = pages.select(F.col(f"`{page_id}`").cast("long").alias("i"), F.col(f"`{url}`").cast("string").alias("u"), payload.alias("h"),
                        F.sha1(payload.cast("binary")).alias("d"), F.octet_length(payload).cast("long").alias("n"))
    shared, rows = _roles(wide.select("i", "u", "d", "n"), least_bytes)
    shared.write.parquet(f"{folder}/shared")                            # read again with its true size for the join's choice
    shared = spark.read.parquet(f"{folder}/shared")
    # responses: rows with a payload of their own, and the first of each shared payload
    joined = wide.join(shared, ["d", "n"], "left")
    firsts = joined.where(F.col("f_copies").isNull() | _is_first())
    cols = ["i", "u", "h", "d", "n", "f_id", "f_url"]
    once = firsts.where("f_copies is null or f_copies = 1").select(*cols, F.col("f_copies").isNotNull().alias("shared"))
    many = firsts.where("f_copies > 1").select(*cols, F.lit(True).alias("shared")).dropDuplicates(["d", "n"])
    # revisits: narrow rows; wholly equal rows are expanded in bounded runs
    again = (rows.join(shared, ["d", "n"]).withColumn("k", F.col("copies") - F.when(_is_first(), 1).otherwise(0)).where("k > 0")
             .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(k - 1) div {RUN}")))))
    again = (again.repartition("d", "i", "run").withColumn("at", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(RUN).cast("long"), F.col("k") - F.col("run") * RUN))))
             .select("i", "u", F.lit(None).cast("string").alias("h"), "d", "n", "f_id", "f_url", F.lit(True).alias("shared")))
    cells = once.unionByName(many).unionByName(again).select(*cols, "shared")
    cells.mapInArrow(_write(f"{folder}/archives", frame_bytes, file_bytes, level, date), INDEX).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


class _Reader:
    """Frames of the archives that a task reads, one open file at a time."""

    def __init__(self, folder: str):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.opener, self.name, self.file = zstandard.ZstdDecompressor(), None, None

    def frame(self, name: str, k: int) -> bytes:
        if name != self.name:
            self.close()
            self.file = self.fs.open_input_file(f"{self.folder}/{name}")
            self.name, self.table = name, read_seek_table(self.file)
        at, packed, plain_size, check = self.table[k]
        self.file.seek(at)
        plain = self.opener.decompress(self.file.read(packed))
        if len(plain) != plain_size or _checksum(plain) != check:
            raise ValueError(f"frame {k} of {name} is damaged")
        return plain

    def close(self):
        if self.file is not None:
            self.file.close()
        self.name = self.file = None


def _as_row(fields: dict[str, str], block: bytes, payloads: bool) -> dict:
    head, _, body = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    response = fields["warc-type"] == "response"
    if response and (len(body) != size or base64.b32encode(hashlib.sha1(body).digest()).decode() != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    own, to = fields.get("warc-x-page-id"), fields.get("warc-x-refers-to-page-id")
    return {"record_id": fields["warc-record-id"], "page_id": None if own is None else int(own), "url": fields.get("warc-target-uri"),
            "record_type": fields["warc-type"], "payload_bytes": size, "payload_digest": digest,
            "refers_to": None if to is None else int(to), "payload": body if response and payloads else None}


_RECORD_TYPE = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                          ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _read(folder: str, payloads: bool):
    def run(batches):
        reader = _Reader(folder)
        for batch in batches:
            for k in range(batch.num_rows):
                plain = reader.frame(batch.column(0)[k].as_py(), batch.column(1)[k].as_py())
                rows = []
                for spot in batch.column(2)[k].as_py():
                    fields, block = parse_record(plain[spot["offset"]:spot["offset"] + spot["length"]])
                    if fields["warc-record-id"] != spot["record_id"]:
                        raise ValueError(f"record {spot['record_id']} is not where the index says")
                    rows.append(_as_row(fields, block, payloads))
                yield pa.RecordBatch.from_pylist(rows, _RECORD_TYPE)
        reader.close()
    return run


def read_archives(spark: SparkSession, folder: str, wanted: DataFrame | None = None, payloads: bool = True) -> DataFrame:
    """Records (``RECORDS``) of the archives below ``folder``: all, or those whose
    ``record_id`` is in ``wanted``; only frames that hold such a record are read.
    ``payload`` is null for revisits, and for all rows unless ``payloads``."""
    frames = spark.read.parquet(f"{folder}/index")
    packed = frames.agg(F.sum("packed_bytes")).first()[0] or 0          # one number
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-packed // READ_BYTES))
    if wanted is not None:
        spots = frames.select("archive", "frame", F.explode("records").alias("r")).withColumn("record_id", F.col("r.record_id"))
        frames = (spots.join(wanted.select("record_id").distinct(), "record_id", "left_semi")
                  .groupBy("archive", "frame").agg(F.collect_list("r").alias("records")))   # at most one frame's records
    frames = frames.select("archive", "frame", "records")
    return (frames.repartitionByRange(tasks, "archive", "frame").sortWithinPartitions("archive", "frame")
            .mapInArrow(_read(f"{folder}/archives", payloads), RECORDS))


def archive_report(pages: DataFrame, **kw) -> DataFrame:
    """Write ``pages`` into archives of the shared folder, read them back and return
    ``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` per record."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write_archives(pages, folder, **kw)
    return read_archives(spark, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
