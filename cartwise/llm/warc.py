"""WARC archives as a PySpark Python data source, and the pages round trip.

``spark.read.format("warc").load(path)`` plans partitions from the files' sizes
(and, for archives written here, from record offsets in the commit manifest, so
one large file is read by many tasks).  Equality, membership, prefix, null and
range predicates on header columns are pushed into the reader, which parses a
record's header first and seeks over the payload of a record that fails them or
whose payload is not wanted.  Options:

* ``payload``: ``all`` (default), ``none``, or the record types (comma-separated)
  whose payload is decoded; other records give a null payload;
* ``header.<Name>``: a value that header must have;
* ``splitBytes``: bytes of archive per read partition (32 MB).

``df.write.format("warc").mode("append").save(path)`` writes ``.warc`` files, or
``.warc.gz`` with one gzip member per record under option ``compress=true``.  A
task attempt writes files of its own name; the manifest written on commit lists
those of the attempts that counted, so a lost executor or a repeated attempt
leaves no double records.  Paths are opened through ``pyarrow.fs`` (local files
and the stores it knows), in tasks by URI.

Defined results: a null payload is written empty; a null header column is left
out and read back as null; control characters in header values are
percent-encoded; records of zero length, repeated records and empty inputs are
kept as they are; columns that are not record columns are not written.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo,
                                    GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull,
                                    IsNull, LessThan, LessThanOrEqual, StringStartsWith,
                                    WriterCommitMessage)

from cartwise.llm.common import table, written
from cartwise.session import scratch_path

SCHEMA = ("record_type string, record_id string, target_uri string, date string, "
          "content_type string, refers_to string, payload_digest string, content_length long, "
          "headers map<string,string>, payload binary")

#: Header names of the record columns.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "content_type": "Content-Type",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}
BY_HEADER = {name.lower(): column for column, name in HEADERS.items()}
VERSION = b"WARC/1.1\r\n"
BATCH_RECORDS, BATCH_BYTES, CHUNK = 2000, 8 << 20, 1 << 20
MIN_DUPLICATE_BYTES = 100  # smaller payloads are never stored as revisits


def _open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a URI or a local path."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def _escaped(value: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


# ---- writing --------------------------------------------------------------
@dataclass
class Written(WriterCommitMessage):
    files: list  # [name, bytes, [record offsets a reader may start at]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"]
        self.compress = options.get("compress", "false").lower() == "true"
        self.file_bytes = int(options.get("filebytes", 1 << 30))
        self.step = int(options.get("markbytes", 8 << 20))
        self.overwrite = overwrite

    def _record(self, columns: dict, i: int, payload) -> bytes:
        lines = [VERSION]
        for column, name in HEADERS.items():
            value = columns[column][i] if column in columns else None
            if value is not None:
                lines.append(f"{name}: {_escaped(value)}\r\n".encode())
        for name, value in (columns["headers"][i] or []) if "headers" in columns else []:
            if value is not None:
                lines.append(f"{_escaped(name)}: {_escaped(value)}\r\n".encode())
        lines.append(b"Content-Length: %d\r\n\r\n" % len(payload))
        lines += [payload, b"\r\n\r\n"]
        record = b"".join(lines)
        if self.compress:
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            record = packer.compress(record) + packer.flush()
        return record

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, base = _open_fs(self.path)
        fs.create_dir(base, recursive=True)
        stem = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        suffix = ".warc.gz" if self.compress else ".warc"
        files, out, at, marks = [], None, 0, []
        for batch in iterator:
            names = batch.schema.names
            columns = {c: batch.column(c).to_pylist() for c in names
                       if c in HEADERS or c == "headers"}
            bodies = batch.column("payload") if "payload" in names else None
            for i in range(batch.num_rows):
                body = bodies[i] if bodies is not None else None
                payload = body.as_py() if body is not None and body.is_valid else b""
                record = self._record(columns, i, payload)
                if out is None:
                    name = f"{stem}-{len(files):04d}{suffix}"
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    at, marks = 0, [0]
                elif at - marks[-1] >= self.step:
                    marks.append(at)
                out.write(record)
                at += len(record)
                if at >= self.file_bytes:
                    out.close()
                    files.append([name, at, marks])
                    out = None
        if out is not None:
            out.close()
            files.append([name, at, marks])
        return Written(files)

    def commit(self, messages: list) -> None:
        fs, base = _open_fs(self.path)
        fs.create_dir(base, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        old = [] if not self.overwrite else [
            i.path for i in fs.get_file_info(pafs.FileSelector(base)) if i.is_file
            and i.base_name not in {f[0] for f in files}]
        with fs.open_output_stream(f"{base}/_committed-{uuid.uuid4().hex}.json",
                                   compression=None) as out:
            out.write(json.dumps(files).encode())
        for path in old:
            fs.delete_file(path)

    def abort(self, messages: list) -> None:
        fs, base = _open_fs(self.path)
        for message in messages:
            for name, _, _ in message.files if message is not None else []:
                fs.delete_file(f"{base}/{name}")


# ---- reading --------------------------------------------------------------
class Pieces(InputPartition):
    """Parts of archive files that one task reads: (file, start, end)."""

    def __init__(self, pieces: list):
        self.pieces = pieces


class _Plain:
    """Bytes of [start, end) of an uncompressed archive; skipping seeks."""

    def __init__(self, file, start: int, end: int):
        self.file, self.at, self.end, self.buf, self.pos = file, start, end, b"", 0

    def _fill(self, size: int) -> bool:
        take = min(max(size, CHUNK), self.end - self.at)
        if take <= 0:
            return False
        self.file.seek(self.at)
        more = self.file.read(take)
        self.at += len(more)
        self.buf, self.pos = self.buf[self.pos:] + more, 0
        return bool(more)

    def head(self) -> bytes | None:
        """Up to and with the empty line that ends a header; None at the end."""
        while True:
            stop = self.buf.find(b"\r\n\r\n", self.pos)
            if stop >= 0:
                head = self.buf[self.pos:stop]
                self.pos = stop + 4
                return head
            if not self._fill(CHUNK):
                return None

    def body(self, size: int, wanted: bool) -> bytes | None:
        if not wanted:
            have = len(self.buf) - self.pos
            if size + 4 <= have:
                self.pos += size + 4
            else:  # seek past what was not read
                self.at += size + 4 - have
                self.buf, self.pos = b"", 0
            return None
        while len(self.buf) - self.pos < size + 4 and self._fill(size + 4):
            pass
        body = self.buf[self.pos:self.pos + size]
        if len(body) < size:
            raise ValueError(f"archive ends inside a record: {len(body)} of {size} bytes")
        self.pos += size + 4
        return body


class _Gzip(_Plain):
    """The same over gzip members; a skipped payload is inflated, not kept."""

    def __init__(self, file, start: int, end: int):
        super().__init__(file, start, end)
        self.raw = b""
        self.inflate = zlib.decompressobj(31)

    def _fill(self, size: int) -> bool:
        while True:
            if not self.raw:
                take = min(CHUNK, self.end - self.at)
                if take <= 0:
                    return False
                self.file.seek(self.at)
                self.raw = self.file.read(take)
                self.at += len(self.raw)
            if self.inflate.eof:
                self.inflate = zlib.decompressobj(31)
            more = self.inflate.decompress(self.raw, 4 * CHUNK)
            rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if not more and len(rest) == len(self.raw):
                raise ValueError("archive holds bytes that are no gzip member")
            self.raw = rest
            if more:
                self.buf, self.pos = self.buf[self.pos:] + more, 0
                return True

    def body(self, size: int, wanted: bool) -> bytes | None:
        if wanted:
            return super().body(size, True)
        left = size + 4
        while True:
            have = min(left, len(self.buf) - self.pos)
            self.pos += have
            left -= have
            if not left:
                return None
            self.buf, self.pos = b"", 0
            if not self._fill(left):
                return None


def _parsed(head: bytes) -> dict[str, str]:
    """Header lines as a map from lower-case names; continuation lines join."""
    fields: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
            continue
        name, _, value = line.partition(":")
        last = name.strip()
        fields[last] = value.strip()
    return fields


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.split = int(options.get("splitbytes", 32 << 20))
        self.payload = options.get("payload", "all")
        self.equal = {k[len("header."):].lower(): v for k, v in options.items()
                      if k.lower().startswith("header.")}
        self.tests: list[tuple] = []

    def pushFilters(self, filters):
        """Take what a header can decide; hand back the rest."""
        kinds = (EqualTo, In, IsNotNull, IsNull, StringStartsWith, GreaterThan,
                 GreaterThanOrEqual, LessThan, LessThanOrEqual)
        for f in filters:
            column = f.attribute[0] if isinstance(f, kinds) and len(f.attribute) == 1 else None
            if column in HEADERS or column == "content_length":
                self.tests.append((type(f).__name__, column, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        fs, base = _open_fs(self.path)
        infos = fs.get_file_info(pafs.FileSelector(base, allow_not_found=True))
        manifests = [i for i in infos if i.base_name.startswith("_committed-")]
        files = []
        for m in manifests:
            with fs.open_input_stream(m.path) as f:
                files += json.loads(f.read())
        if not manifests:  # archives from elsewhere: each file is read by one task
            files = [[i.base_name, i.size, [0]] for i in infos
                     if i.base_name.endswith((".warc", ".warc.gz"))]
        pieces = []
        for name, size, marks in sorted(files):
            starts = [marks[0]]
            for m in marks[1:]:
                if m - starts[-1] >= self.split:
                    starts.append(m)
            pieces += [(name, a, b) for a, b in zip(starts, [*starts[1:], size])]
        planned, now, room = [], [], 0
        for piece in pieces:  # small pieces share a task
            if now and room + piece[2] - piece[1] > self.split:
                planned.append(Pieces(now))
                now, room = [], 0
            now.append(piece)
            room += piece[2] - piece[1]
        return [*planned, Pieces(now)] if now or not planned else planned

    def _passes(self, row: dict, fields: dict) -> bool:
        if self.equal:
            low = {k.lower(): v for k, v in fields.items()}
            if any(low.get(k) != v for k, v in self.equal.items()):
                return False
        for kind, column, value in self.tests:
            have = row.get(column)
            if kind == "IsNull":
                ok = have is None
            elif have is None:
                ok = False
            elif kind == "IsNotNull":
                ok = True
            elif kind == "EqualTo":
                ok = have == value
            elif kind == "In":
                ok = have in value
            elif kind == "StringStartsWith":
                ok = have.startswith(value)
            elif kind == "GreaterThan":
                ok = have > value
            elif kind == "GreaterThanOrEqual":
                ok = have >= value
            elif kind == "LessThan":
                ok = have < value
            else:
                ok = have <= value
            if not ok:
                return False
        return True

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        fs, base = _open_fs(self.path)
        rows, bodies, size = [], [], 0
        for name, start, end in partition.pieces:
            with fs.open_input_file(f"{base}/{name}") as file:
                source = (_Gzip if name.endswith(".gz") else _Plain)(file, start, end)
                while (head := source.head()) is not None:
                    fields = _parsed(head.lstrip(b"\r\n"))
                    low = {k.lower(): v for k, v in fields.items()}
                    length = int(low.get("content-length", 0))
                    row = {c: low.get(h.lower()) for c, h in HEADERS.items()}
                    row["content_length"] = length
                    kept = self._passes(row, fields)
                    wanted = kept and (self.payload == "all"
                                       or row["record_type"] in self.payload.split(","))
                    body = source.body(length, wanted)
                    if not kept:
                        continue
                    row["headers"] = [(k, v) for k, v in fields.items()
                                      if k.lower() not in BY_HEADER and k.lower() != "content-length"]
                    rows.append(row)
                    bodies.append(body)
                    size += len(body or b"")
                    if len(rows) >= BATCH_RECORDS or size >= BATCH_BYTES:
                        yield _batch(rows, bodies)
                        rows, bodies, size = [], [], 0
        if rows:
            yield _batch(rows, bodies)


_ARROW = pa.schema([*[(c, pa.string()) for c in HEADERS], ("content_length", pa.int64()),
                    ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])


def _batch(rows: list[dict], bodies: list) -> pa.RecordBatch:
    arrays = [pa.array([r[f.name] for r in rows], f.type) for f in _ARROW if f.name != "payload"]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(bodies, pa.binary())], schema=_ARROW)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make format ``warc`` known; predicates reach the reader only with this
    setting, which is off by default."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# ---- pages ----------------------------------------------------------------
def _urn(*parts):
    h = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def revisited(large: DataFrame) -> DataFrame:
    """(rid, rdigest, first): the pages whose payload a page of smaller id holds.  The
    first pages are written, so that the pages of one common body can be split in the
    join."""
    firsts = written(large.groupBy("digest").agg(F.min("id").alias("first"), F.count("id").alias("c"))
                     .where("c > 1").select("digest", "first"), "warc-firsts")
    return (large.select("id", "digest").join(firsts, "digest").where("id > first").distinct()
            .select(F.col("id").alias("rid"), F.col("digest").alias("rdigest"), "first"))


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 body_col: str = "html", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """A record per page.  Of the pages with equal payloads of at least 100 bytes
    the smallest id is the response and the others revisit it; repeated rows of
    that smallest id are responses too, and so are pages without an id.

    The duplicates are found on (id, digest) pairs alone, counted before the
    shuffle; payloads move once, dealt by (id, digest), never by digest.
    """
    body = F.coalesce(F.col(body_col), F.lit(""))
    keyed = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                         F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("n"),
                         body.alias("body"))
    revisits = revisited(keyed.where(F.col("n") >= MIN_DUPLICATE_BYTES))
    rows = keyed.join(revisits, (F.col("id") == F.col("rid"))
                      & (F.col("digest") == F.col("rdigest")), "left")
    again = F.col("first").isNotNull()
    return rows.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        _urn(F.col("id"), F.col("digest")).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(date).alias("date"),
        F.lit("text/html").alias("content_type"),
        F.when(again, _urn(F.col("first"), F.col("digest"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), F.col("digest")).alias("payload_digest"),
        F.create_map(F.lit("X-Page-Id"), F.col("id").cast("string"),
                     F.lit("X-Refers-To-Page-Id"), F.col("first").cast("string"),
                     F.lit("X-Payload-Bytes"), F.col("n").cast("string")).alias("headers"),
        F.when(again, F.lit(None)).otherwise(F.col("body")).cast("binary").alias("payload"))


def archive(pages: DataFrame, path: str, compress: bool = False, **columns) -> None:
    """Write ``pages`` to WARC files under ``path``."""
    register(pages.sparkSession)
    (page_records(pages, **columns).write.format("warc").mode("append")
     .option("compress", str(compress).lower()).save(path))


def read_archive(spark: SparkSession, path: str, payload: str = "all", **options) -> DataFrame:
    register(spark)
    reader = spark.read.format("warc").option("payload", payload)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def pages_back(records: DataFrame) -> DataFrame:
    """Page rows from records: a response's length and digest are those of the
    payload read; a revisit's come from its header."""
    records = records.where(F.col("record_type").isin("response", "revisit"))
    response = F.col("record_type") == "response"
    of = lambda name: F.element_at("headers", name)
    return records.select(
        of("X-Page-Id").cast("long").alias("page_id"),
        F.when(response, F.octet_length("payload")).otherwise(of("X-Payload-Bytes").cast("long"))
        .cast("long").alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256))
        .otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type", of("X-Refers-To-Page-Id").cast("long").alias("refers_to"), "target_uri")


def op2_warc(spark, sf_dir):
    path = scratch_path(spark, "warc")
    archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path, compress=True)
    back = pages_back(read_archive(spark, path, payload="response"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(COALESCE(html, '')) AS BIGINT) AS payload_bytes,
                  sha256(COALESCE(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest AS d, MIN(page_id) AS first FROM p
      WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN p.page_id > f.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id > f.first THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.d AND p.payload_bytes >= 100
"""
