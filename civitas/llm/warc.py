"""WARC archives as a Spark data source, and page tables written as archives without repeated payloads.

``spark.read.format("warc")`` plans partitions of whole files (those that committed tasks wrote, or
all ``.warc`` and ``.warc.gz`` files below the path), takes predicates on header columns from the
filters of the query, and parses the headers of a record first. Only a record that passes is decoded
further: where its gzip member tells its length (the "skip length" field of the WARC standard's annex
on gzip) or the file is not compressed, the rest is never inflated or even read.

Spark hands filters to a Python source only if ``spark.sql.python.filterPushdown.enabled`` is set;
else they run after the scan, with the same rows. ``opened`` sets it.

Defined cases. A null html counts as empty; a null url gives a record without a target. Equal payloads
have equal SHA-256. Where the largest page_id of a group occurs in several of its rows (or all are
null), one of these rows is the response and the others revisit it; a null page_id counts as smaller
than all others. Repeated rows give a record each. An empty table gives an archive without records and
no rows. Columns other than page_id, url and html are ignored. Texts of any length are one record; a
record is held whole only where it is decoded. A record that breaks off raises an error with its file,
or in mode "permissive" ends its file with a row of type `corrupt`.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
    WriterCommitMessage,
)

from civitas.llm.common import BATCH, column, scratch, small_batches, stored

SCHEMA = (
    "record_id string, type string, date string, target_uri string, refers_to string, payload_digest string, payload_bytes long, "
    "headers map<string,string>, payload binary, verified boolean"
)
#: Of which header a filter column speaks.
HEADER = {"record_id": "warc-record-id", "type": "warc-type", "date": "warc-date", "target_uri": "warc-target-uri", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
MANIFEST = "_manifest"
#: Compressed bytes after which a task begins another file, and of the files of one partition.
FILE_BYTES = 128 << 20
#: A partition has so many bytes at least, as opening a file costs, too.
LEAST_BYTES = 4 << 20
CHUNK = 1 << 16
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _files(path: str):
    """The file system of a path or URI, and the path on it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"[A-Za-z][\w+.-]*:/", path) else (fs.LocalFileSystem(), path)


def digest(payload: bytes) -> str:
    """SHA-1 in base32, as archives state it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# Writing


def _member(data: bytes) -> bytes:
    """A gzip member whose extra field "sl" tells its compressed and its plain length."""
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff"
    return head + struct.pack("<H2sHII", 12, b"sl", 8, 24 + len(body) + 8, len(data)) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(fields: dict[str, str], block: bytes) -> bytes:
    """One record: version, named fields, the block."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items()), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _uri(url: str) -> str:
    """A URL without white space or control characters, which would end a header."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _page_name(page_id, payload_digest: str, more: str = "") -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{payload_digest}{more}>"


def page_record(page_id, url, payload: bytes, kind: str, refers_to, own: str, date: str, shared: bool) -> bytes:
    """The record of a page; `own` makes the names of records apart that are not the one response of a payload."""
    named = digest(payload)
    http = (HTTP % len(payload)).encode()
    fields = {"WARC-Type": kind, "WARC-Record-ID": _page_name(page_id, named, "" if kind == "response" and shared else own), "WARC-Date": date}
    if url is not None:
        fields["WARC-Target-URI"] = _uri(url)
    fields["WARC-Payload-Digest"] = f"sha1:{named}"
    if kind == "revisit":
        fields |= {"WARC-Refers-To": _page_name(refers_to, named), "WARC-Profile": PROFILE}
    fields["Content-Type"] = "application/http; msgtype=response"
    return record(fields, http if kind == "revisit" else http + payload)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class PageWriter(DataSourceArrowWriter):
    """Rows (page_id, url, html, record_type, refers_to) as records; every attempt of a task writes files of its own.

    Only files that a committed task names enter the manifest, so a task that ran twice or was lost adds nothing.
    """

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.date, self.least = options.get("date", "1970-01-01T00:00:00Z"), int(options.get("minbytes", 0))
        self.file_bytes = int(options.get("filebytes", FILE_BYTES))

    def write(self, iterator):
        from pyspark import TaskContext

        files, base = _files(self.path)
        files.create_dir(base, recursive=True)
        own, written, out, n = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}", [], None, 0

        def ended():
            if out is not None:
                written[-1] = (written[-1][0], out.tell())
                out.close()

        try:
            for batch in iterator:
                rows = zip(*(column(batch, c).to_pylist() for c in ("page_id", "url", "html", "record_type", "refers_to")), strict=True)
                for page_id, url, html, kind, refers_to in rows:
                    if out is None or out.tell() >= self.file_bytes:
                        ended()
                        name = f"part-{own}-{len(written)}.warc.gz"
                        written.append((name, 0))
                        out = files.open_output_stream(f"{base}/{name}", compression=None)
                        info = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": self.date, "WARC-Filename": name, "Content-Type": "application/warc-fields"}
                        out.write(_member(record(info, b"format: WARC File Format 1.1\r\n")))
                    payload = (html or "").encode()
                    out.write(_member(page_record(page_id, url, payload, kind, refers_to, f":{own}:{n}", self.date, len(payload) >= self.least)))
                    n += 1
        finally:
            ended()
        return Written(written)

    def commit(self, messages):
        files, base = _files(self.path)
        files.create_dir(base, recursive=True)
        written = [x for m in messages if m is not None for x in m.files]
        if not self.overwrite:
            written = [*(_manifest(files, base) or []), *written]
        with files.open_output_stream(f"{base}/{MANIFEST}") as out:
            out.write("".join(f"{size} {name}\n" for name, size in written).encode())

    def abort(self, messages):
        files, base = _files(self.path)
        for name, _ in (x for m in messages if m is not None for x in m.files):
            files.delete_file(f"{base}/{name}")


def _manifest(files, base: str) -> list[tuple[str, int]] | None:
    """Names and sizes of the files of committed tasks, so that none of them is asked for; None where there is no manifest."""
    from pyarrow import fs

    if files.get_file_info(f"{base}/{MANIFEST}").type == fs.FileType.NotFound:
        return None
    with files.open_input_stream(f"{base}/{MANIFEST}") as f:
        return [(name, int(size)) for size, name in (x.split(" ", 1) for x in f.read().decode().splitlines())]


# Reading


class _Plain:
    """Bytes of a file in order, from what was read ahead."""

    def __init__(self, file, at: int = 0):
        self.file, self.ahead, self.at = file, b"", at

    def more(self) -> bytes:
        self.file.seek(self.at)
        got = self.file.read(CHUNK)
        self.at += len(got)
        return got

    def take(self, n: int) -> bytes:
        parts, have = [self.ahead], len(self.ahead)
        while have < n and (got := self.more()):
            parts.append(got)
            have += len(got)
        data = b"".join(parts)
        self.ahead = data[n:]
        return data[:n]

    def until(self, end: bytes) -> bytes:
        """Up to and with `end`; what there is, if it does not come."""
        while (k := self.ahead.find(end)) < 0 and (got := self.more()):
            self.ahead += got
        return self.take(k + len(end) if k >= 0 else len(self.ahead))

    def skip(self, n: int) -> int:
        """Pass over n bytes without reading them; how many there were."""
        inside = min(n, len(self.ahead))
        self.ahead = self.ahead[inside:]
        left = min(n - inside, self.file.size() - self.at)
        self.at += left
        return inside + left


class _Inflated(_Plain):
    """The same for gzip members without lengths: they are inflated, what is passed over is let go."""

    def __init__(self, file, at: int = 0):
        super().__init__(file, at)
        self.packed, self.inflate = b"", None

    def more(self) -> bytes:
        while True:
            if not self.packed and not (packed := super().more()):
                if self.inflate is not None:
                    raise ValueError("a gzip member breaks off")
                return b""
            elif not self.packed:
                self.packed = packed
            if self.inflate is None:
                self.inflate = zlib.decompressobj(31)
            got = self.inflate.decompress(self.packed, CHUNK)
            self.packed = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if self.inflate.eof:
                self.inflate = None
            if got:
                return got

    def skip(self, n: int) -> int:
        left = n
        while left and (got := self.take(min(left, CHUNK))):
            left -= len(got)
        return n - left


def _fields(head: bytes) -> dict[str, str]:
    """Named fields by lower-case name; continued lines are joined."""
    lines = re.sub(r"\r?\n[ \t]+", " ", head.decode("utf-8", "replace")).split("\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record begins here")
    return {k.strip().lower(): v.strip() for k, colon, v in (x.partition(":") for x in lines[1:]) if colon}


class _Member:
    """A gzip member of known length: `head` inflates no more than the headers, `block` the rest."""

    def __init__(self, stream: _Plain, length: int):
        self.stream, self.left, self.inflate, self.data = stream, length, zlib.decompressobj(31), b""

    def _more(self) -> bool:
        packed = self.inflate.unconsumed_tail
        if not packed and self.left:
            packed = self.stream.take(min(self.left, CHUNK))
            self.left -= len(packed)
        got = self.inflate.decompress(packed, 1024 if len(self.data) < 1024 else CHUNK)
        self.data += got
        return bool(got or packed)

    def head(self) -> bytes:
        while (k := self.data.find(b"\r\n\r\n")) < 0:
            if not self._more():
                raise ValueError("headers break off")
        head, self.data = self.data[: k + 4], self.data[k + 4 :]
        return head

    def http(self) -> bytes:
        """The beginning of the block up to the end of its HTTP headers."""
        while b"\r\n\r\n" not in self.data and self._more():
            pass
        return self.data

    def block(self, n: int) -> bytes:
        packed = self.inflate.unconsumed_tail + self.stream.take(self.left)
        self.left = 0
        data = self.data + self.inflate.decompress(packed)
        if not self.inflate.eof:
            data += self.inflate.flush()
        if not self.inflate.eof or len(data) < n:
            raise ValueError("a record breaks off")
        return data[:n]

    def end(self) -> None:
        if self.stream.skip(self.left) < self.left:
            raise ValueError("a record breaks off")


class _Stream:
    """A record of a stream without known lengths of members."""

    def __init__(self, stream: _Plain, head: bytes):
        self.stream, self._head, self.left, self.seen = stream, head, 0, b""

    def head(self) -> bytes:
        return self._head

    def http(self) -> bytes:
        while b"\r\n\r\n" not in self.seen and self.left and (got := self.stream.take(min(1024, self.left))):
            self.seen += got
            self.left -= len(got)
        return self.seen

    def block(self, n: int) -> bytes:
        data = self.seen + self.stream.take(self.left)
        self.left = 0
        if len(data) < n:
            raise ValueError("a record breaks off")
        return data

    def end(self) -> None:
        if self.stream.skip(self.left) < self.left:
            raise ValueError("a record breaks off")


def _records(file):
    """The records of a file in order; a caller takes what it wants of one before it asks for the next."""
    plain = _Plain(file)
    while start := plain.take(24):
        known = start[:4] == b"\x1f\x8b\x08\x04" and len(start) == 24 and start[12:16] == b"sl\x08\0" and start[10:12] == b"\x0c\0"
        plain.ahead = start + plain.ahead
        if not known:
            break
        member = _Member(plain, struct.unpack("<I", start[16:20])[0])
        yield member, _fields(member.head())
        member.end()
    else:
        return
    at = plain.at - len(plain.ahead)
    stream = (_Inflated if plain.ahead[:2] == b"\x1f\x8b" else _Plain)(file, at)
    while head := stream.until(b"\r\n\r\n"):
        if not (head := head.lstrip(b"\r\n")):
            continue
        if not head.endswith(b"\r\n\r\n"):
            raise ValueError("headers break off")
        one = _Stream(stream, head)
        fields = _fields(head)
        one.left = int(fields.get("content-length", 0))
        yield one, fields
        one.end()


def _payload_start(block: bytes, fields: dict[str, str]) -> int:
    """Where the payload begins: after the headers of a stored HTTP message."""
    if not fields.get("content-type", "").startswith("application/http"):
        return 0
    k = block.find(b"\r\n\r\n")
    return len(block) if k < 0 else k + 4


def _bytes(one, fields: dict[str, str]) -> int:
    """Bytes of the full payload, told by headers: those of the stored message where a revisit leaves the payload out."""
    whole = int(fields.get("content-length", 0))
    if not fields.get("content-type", "").startswith("application/http"):
        return whole
    http = one.http()
    if fields.get("warc-type", "").lower() == "revisit":
        told = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http[: _payload_start(http, fields)])
        return int(told[1]) if told else 0
    return whole - _payload_start(http, fields)


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    """Options: payload (false leaves payloads null), verify (true compares digests of payloads), mode, partitionBytes, minPartitions."""

    def __init__(self, options: dict[str, str]):
        self.path, self.filters = options["path"], []
        self.payload, self.verify = options.get("payload", "true") == "true", options.get("verify", "false") == "true"
        self.permissive = options.get("mode", "failfast").lower() == "permissive"
        self.partition_bytes, self.least = int(options.get("partitionbytes", FILE_BYTES)), int(options.get("minpartitions", 1))

    def pushFilters(self, filters):
        """Take predicates on header columns and on the bytes of payloads; hand back the others."""
        for f in filters:
            path = getattr(f, "attribute", ())
            if len(path) == 1 and type(f) in OPERATIONS and (path[0] in HEADER or path[0] == "payload_bytes"):
                self.filters.append((path[0], type(f).__name__, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        files, base = _files(self.path)
        if (known := _manifest(files, base)) is not None:
            found = [(f"{base}/{name}", size) for name, size in known]
        elif (one := files.get_file_info(base)).type == fs.FileType.File:
            found = [(base, one.size)]
        else:
            found = [(x.path, x.size) for x in files.get_file_info(fs.FileSelector(base, recursive=True)) if re.search(r"\.warc(\.gz)?$", x.path)]
        most = min(self.partition_bytes, max(LEAST_BYTES, sum(n for _, n in found) // max(1, self.least)))
        out, size = [], most
        for path, n in sorted(found):
            if size + n > most:
                out.append(Files([]))
                size = 0
            out[-1].paths.append(path)
            size += n
        return out or [Files([])]

    def _wanted(self, told: dict, columns: tuple[str, ...]) -> bool:
        return all(OPERATIONS_BY_NAME[op](told[c], value) for c, op, value in self.filters if c in columns)

    def _row(self, one, fields: dict[str, str]) -> tuple | None:
        told = {c: fields.get(h) for c, h in HEADER.items()}
        told["type"] = told["type"] and told["type"].lower()
        if not self._wanted(told, tuple(HEADER)):
            return None
        told["payload_bytes"] = _bytes(one, fields)
        if not self._wanted(told, ("payload_bytes",)):
            return None
        payload = verified = None
        if (self.payload or self.verify) and told["type"] != "revisit":
            block = one.block(int(fields.get("content-length", 0)))
            payload = block[_payload_start(block, fields) :]
            if self.verify and (told["payload_digest"] or "").lower().startswith("sha1:"):
                verified = digest(payload) == told["payload_digest"][5:].upper()
        return (*(told[c] for c in ("record_id", "type", "date", "target_uri", "refers_to", "payload_digest", "payload_bytes")), list(fields.items()), payload if self.payload else None, verified)

    def read(self, partition):
        import pyarrow as pa

        kinds = {"string": pa.string(), "long": pa.int64(), "map<string,string>": pa.map_(pa.string(), pa.string()), "binary": pa.binary(), "boolean": pa.bool_()}
        schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in SCHEMA.split(", ")])
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        files, _ = _files(self.path)
        rows, held = [], 0
        for path in partition.paths:
            with files.open_input_file(path) as file:
                try:
                    for one, fields in _records(file):
                        row = self._row(one, fields)
                        if row is None:
                            continue
                        rows.append(row)
                        held += 500 + len(row[-2] or b"")
                        if held >= BATCH:
                            yield batch(rows)
                            rows, held = [], 0
                except (ValueError, zlib.error) as e:
                    if not self.permissive:
                        raise ValueError(f"{path}: {e}") from e
                    if self._wanted({c: None for c in HEADER} | {"type": "corrupt"}, tuple(HEADER)):
                        rows.append((None, "corrupt", None, None, None, None, None, [("file", path), ("error", str(e))], None, None))
        if rows:
            yield batch(rows)


OPERATIONS = {
    EqualTo: lambda x, v: x is not None and x == v,
    In: lambda x, v: x is not None and x in v,
    IsNotNull: lambda x, v: x is not None,
    GreaterThan: lambda x, v: x is not None and x > v,
    GreaterThanOrEqual: lambda x, v: x is not None and x >= v,
    LessThan: lambda x, v: x is not None and x < v,
    LessThanOrEqual: lambda x, v: x is not None and x <= v,
    StringStartsWith: lambda x, v: x is not None and x.startswith(v),
}
OPERATIONS_BY_NAME = {k.__name__: f for k, f in OPERATIONS.items()}


class WarcSource(DataSource):
    """The source `warc`: reads records, writes rows (page_id, url, html, record_type, refers_to)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return PageWriter(dict(self.options), overwrite)


def opened(spark: SparkSession):
    """A reader of archives: registers the source and lets Spark hand filters to it (settings of the session)."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    small_batches(spark)
    return spark.read.format("warc").option("minPartitions", spark.sparkContext.defaultParallelism)


def _groups(spark: SparkSession, keyed: DataFrame, folder: str, name: str) -> DataFrame:
    """Payloads that occur more than once: which row is the response, and how many rows could be."""
    rows = keyed.where("_key is not null").groupBy("_key", "page_id", "_tie").agg(F.count(F.lit(1)).alias("n"))
    groups = rows.groupBy("_key").agg(F.sum("n").alias("size"), F.max(F.struct("page_id", "_tie", "n")).alias("top")).where("size > 1")
    return stored(spark, groups.select("_key", F.col("top.page_id").alias("_first"), F.col("top._tie").alias("_first_tie"), F.col("top.n").alias("_firsts")), folder, name)


def write_pages(spark: SparkSession, pages: DataFrame, path: str, folder: str, least: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Archives of (page_id, url, html): of equal payloads of at least `least` bytes that of the largest page_id is a response, others revisit it.

    One narrow pass finds the payloads that occur more than once; they are stored, and the join with
    them is a broadcast only while that table is small enough for Spark. Hot payloads are combined
    before the exchange; in a shuffled join Spark splits them. Where the largest page_id itself repeats
    within a group, which is looked up, rows get numbers in a stored copy and the largest number
    decides; else the table is not copied.
    """
    spark.dataSource.register(WarcSource)
    small_batches(spark)
    key = F.when(F.octet_length("html") >= least, F.unhex(F.sha2("html", 256)))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), F.lit(0).cast("long").alias("_tie"))
    groups = _groups(spark, rows.withColumn("_key", key), folder, "groups")
    if groups.where("_firsts > 1").take(1):
        rows = stored(spark, rows.withColumn("_tie", F.monotonically_increasing_id()), folder, "numbered")
        groups = _groups(spark, rows.withColumn("_key", key), folder, "numbered_groups")
    judged = rows.withColumn("_key", key).join(groups, "_key", "left")
    is_first = F.col("_firsts").isNull() | (F.col("page_id").eqNullSafe(F.col("_first")) & (F.col("_tie") == F.col("_first_tie")))
    out = judged.select("page_id", "url", "html", F.when(is_first, "response").otherwise("revisit").alias("record_type"), F.when(~is_first, F.col("_first")).alias("refers_to"))
    out.write.format("warc").mode("append").option("date", date).option("minBytes", least).save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """What the archives say of pages, as read from responses (payloads decoded, digests compared) and revisits (headers alone)."""
    records = opened(spark).option("payload", "false").option("verify", "true").load(path).where(F.col("type").isin("response", "revisit"))
    number = lambda c: F.regexp_extract(c, r"^<urn:x-page:(-?\d*):", 1).try_cast("long")
    return records.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
        F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"),
        "verified",
    )


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write pages as archives into the shared folder, read them back."""
    folder = scratch(spark)
    write_pages(spark, pages, f"{folder}/archives", folder)
    return read_pages(spark, f"{folder}/archives")


ORACLE_SQL = """
WITH rows AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
named AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS first, sha1(html) AS hex FROM rows),
bits AS (SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: lpad(bin(instr('0123456789abcdef', hex[i]) - 1), 4, '0')), 'string_agg', '') AS b FROM named)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * b[5 * i + 1]::INT + 8 * b[5 * i + 2]::INT + 4 * b[5 * i + 3]::INT + 2 * b[5 * i + 4]::INT + b[5 * i + 5]::INT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to,
  CASE WHEN page_id = first THEN true END AS verified
FROM bits
"""
