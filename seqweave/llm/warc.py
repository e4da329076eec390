"""WARC archives: revisit-aware writer and splittable reader.

Writing (``write_warc``): a payload's digest (SHA-1) names its group of equal payloads; the row with the smallest id
becomes a ``response`` record, the others ``revisit`` records that name it and hold no payload.  Every record
is a gzip member of its own; archives start with a ``warcinfo`` record, roll at ``file_bytes`` and are
published by the driver after all tasks have succeeded.

Reading (``read_warc``): archives are cut into byte ranges, one task each.  A task scans its range for
the gzip magic.  A place is a member only if its first bytes decode to a WARC head with a length; then the record is
decoded to its end, also beyond the range, and the scan goes on behind it.  Records belong to the range they
start in, so each is read once.  Payloads are hashed as they stream by and kept only on request, so a long record costs
no memory.  A member with a good head and a broken body fails the job.

The writer flushes its compressor inside every gzip magic of a payload, so that no stored block of a member can
look like the start of another one.

Defined cases: NULL payload is the empty payload, NULL ids come after all ids, a NULL address is
``about:blank``.  Rows with equal id and payload each get a record, one of them (whichever) the response
if that id is the group's smallest; the others refer to the same id.  Payloads below ``min_bytes`` are always responses.
An empty table gives no archive; a folder without archives has no records.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from seqweave.llm.common import join_heads
from seqweave.plans.stage import beside_parts, stage_parts, stage_table
from seqweave.session import ship_package
from seqweave.sinks.arrow_stream import check_scheme, file_system, qualified

# Fixed values of the WARC 1.1 format and of gzip members (magic and the deflate method).
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
STEP = 1 << 16  # bytes decoded at a time
HEAD_LIMIT = 1 << 20


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


# --------------------------------------------------------------------------- writing
def decide(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """``id, url, payload, sha1, revisit, refers_to`` per row of ``pages``."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"),
                        F.unhex(F.sha1(payload)).alias("sha1"), F.octet_length(payload).alias("size"))
    # rows are named by the task that writes them down and their place in it; what decides is narrow, no key is
    # hot, and the decisions go beside the payloads where they lie
    rows = stage_parts(rows, "warc-pages", pages.rdd.getNumPartitions())
    name = F.struct("_part", "_pos")
    named, seen = stage_table(rows.select("_part", "_pos", "id", "sha1", "size"), "warc-rows", {"n": F.count(F.lit(1))})
    able = named.filter(F.col("size") >= min_bytes)
    first = F.min(F.struct(F.col("id").isNull(), "id", name.alias("row")))
    heads = able.groupBy("sha1").agg(first.alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    heads = stage_table(heads.select("sha1", "_n", F.col("_first.id").alias("refers_to"), F.col("_first.row").alias("_head")),
                        "warc-heads")
    copies = join_heads(able.select("_part", "_pos", "sha1"), heads, "sha1", int(seen["n"] or 0)).filter(name != F.col("_head"))
    copies = copies.select("_part", "_pos", "refers_to", F.lit(True).alias("revisit"))
    decided = named.select("_part", "_pos").join(copies, ["_part", "_pos"], "left").withColumn(
        "revisit", F.coalesce("revisit", F.lit(False)))
    both = beside_parts(rows, decided, ["refers_to", "revisit"])
    # a revisit record holds no payload; its length stays known
    return both.select("id", "url", F.when(~F.col("revisit"), F.col("payload")).alias("payload"), "sha1", "size",
                       "revisit", "refers_to")


def _name(value) -> str:
    return quote(str(value), safe="")


def _urn(row_id, sha1: bytes) -> str:
    """Name of the response record of a row."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{row_id}:{sha1.hex()}')}>"


def _head(kind: str, length: int, date: str, fields: list[tuple[str, str]], urn: str | None = None) -> bytes:
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {urn or uuid.uuid4().urn.join('<>')}", f"WARC-Date: {date}"]
    lines += [f"{k}: {v}" for k, v in fields] + [f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def member(parts: list[bytes]) -> Iterator[bytes]:
    """One gzip member of the parts; a magic in them never stands in it byte for byte."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    for part in parts:
        at = 0
        while (hit := part.find(MAGIC, at)) >= 0:
            yield packer.compress(part[at:hit + 1])
            yield packer.flush(zlib.Z_FULL_FLUSH)
            at = hit + 1
        view = memoryview(part)[at:]
        for s in range(0, len(view), 1 << 20):
            yield packer.compress(view[s:s + (1 << 20)])
    yield packer.flush()


def record_parts(row: dict, date: str, media: str) -> list[bytes]:
    """Head, HTTP head, payload and end of the record of one row of ``decide``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {media}\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    url = "about:blank" if row["url"] is None else quote(row["url"], safe=":/?#[]@!$&'()*+,;=%~")
    fields = [("WARC-Target-URI", url), ("WARC-Payload-Digest", "sha1:" + base32_sha1(row["sha1"])),
              ("Content-Type", "application/http; msgtype=response")]
    if row["id"] is not None:
        fields.append(("X-Row-Id", _name(row["id"])))
    if row["revisit"]:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", _urn(row["refers_to"], row["sha1"]))]
        if row["refers_to"] is not None:
            fields.append(("X-Refers-To-Row-Id", _name(row["refers_to"])))
        return [_head("revisit", len(http), date, fields), http, b"\r\n\r\n"]
    urn = _urn(row["id"], row["sha1"])
    return [_head("response", len(http) + row["size"], date, fields, urn), http, row["payload"], b"\r\n\r\n"]


@dataclass
class _Done(WriterCommitMessage):
    files: list


class WarcSink(DataSource):
    @classmethod
    def name(cls):
        return "seqweave_warc"

    def writer(self, schema, overwrite):
        return _WarcWriter(self.options)


class _WarcWriter(DataSourceArrowWriter):
    """Tasks write below ``_temporary/<job>``; the driver's commit moves the files of the tasks that count."""

    def __init__(self, options):
        self.path, self.job = options["path"].rstrip("/"), options["job"]
        self.file_bytes, self.date, self.media = int(options["file_bytes"]), options["date"], options["media"]

    def _temporary(self, root):
        return posixpath.join(root, "_temporary", self.job)

    def write(self, iterator):
        fs, root = file_system(self.path)
        folder = self._temporary(root)
        fs.create_dir(folder, recursive=True)
        files, out, size = [], None, 0
        try:
            for batch in iterator:
                names = batch.schema.names
                for i in range(batch.num_rows):
                    row = {n: batch.column(c)[i].as_py() for c, n in enumerate(names)}
                    if out is None or size >= self.file_bytes:
                        if out is not None:
                            out.close()
                        files.append(posixpath.join(folder, f"{uuid.uuid4().hex}.warc.gz"))
                        out, size = fs.open_output_stream(files[-1], compression=None), 0
                        info = b"software: seqweave\r\nformat: WARC File Format 1.1\r\n"
                        for piece in member([_head("warcinfo", len(info), self.date, [
                                ("Content-Type", "application/warc-fields")]), info, b"\r\n\r\n"]):
                            out.write(piece)
                    for piece in member(record_parts(row, self.date, self.media)):
                        out.write(piece)
                        size += len(piece)
        finally:
            if out is not None:
                out.close()
        return _Done(files)

    def commit(self, messages):
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        for message in messages:
            for file in message.files if message else ():
                fs.move(file, posixpath.join(root, posixpath.basename(file)))
        self.abort(messages)

    def abort(self, messages):
        import pyarrow.fs as pafs

        fs, root = file_system(self.path)
        tmp = self._temporary(root)
        if fs.get_file_info(tmp).type == pafs.FileType.Directory:
            fs.delete_dir(tmp)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_bytes: int = 0, file_bytes: int = 1 << 30, date: str = "1970-01-01T00:00:00Z",
               media: str = "text/html; charset=utf-8") -> None:
    """Add archives with one record per row of ``pages`` to the folder ``path``."""
    spark = pages.sparkSession
    ship_package(spark)
    where = qualified(spark, path)
    check_scheme(where)
    spark.dataSource.register(WarcSink)
    decided = decide(pages, id_col, url_col, payload_col, min_bytes)
    (decided.write.format(WarcSink.name()).mode("append").option("path", where).option("job", uuid.uuid4().hex)
     .option("file_bytes", str(file_bytes)).option("date", date).option("media", media).save())


# --------------------------------------------------------------------------- reading
class _Ahead:
    """Forward reads of a file at absolute places through one buffer."""

    def __init__(self, file, size: int, chunk: int = 1 << 20):
        self.file, self.size, self.chunk = file, size, chunk
        self.base, self.buf = 0, b""

    def load(self, at: int, need: int = 1) -> int:
        """Make ``need`` bytes from ``at`` available (fewer at the end); their index in ``buf``."""
        have = self.base <= at and min(at + need, self.size) <= self.base + len(self.buf)
        if not have:
            self.file.seek(at)
            self.base, self.buf = at, self.file.read(min(max(self.chunk, need), self.size - at))
        return at - self.base

    def find_magic(self, at: int, end: int) -> int | None:
        """The next gzip magic that starts in [at, end)."""
        while at < min(end, self.size - len(MAGIC) + 1):
            i = self.load(at, len(MAGIC))
            hit = self.buf.find(MAGIC, i)
            if hit >= 0:
                return self.base + hit if self.base + hit < end else None
            at = self.base + len(self.buf) - len(MAGIC) + 1
        return None

    def plain(self, at: int) -> Iterator[tuple[bytes, int]]:
        """Decoded bytes of the member at ``at``, each with the place reached; ends with the member."""
        packer = zlib.decompressobj(31)
        while not packer.eof:
            i = self.load(at)
            piece = memoryview(self.buf)[i:i + STEP]
            if not len(piece):
                raise zlib.error("member ends early")
            out = packer.decompress(piece, STEP)
            # (at the end of a member both can hold the same bytes)
            at += len(piece) - len(packer.unused_data if packer.eof else packer.unconsumed_tail)
            yield out, at


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, sep, v in (x.partition(":") for x in lines[1:]) if sep}


class BrokenRecord(ValueError):
    pass


def read_record(ahead: _Ahead, at: int, keep: bool) -> tuple[dict, int] | None:
    """The record whose member starts at ``at`` and the place behind it; None if no record starts there."""
    steps, data, here = ahead.plain(at), b"", at
    try:
        while (cut := data.find(b"\r\n\r\n")) < 0:
            more, here = next(steps, (None, here))
            if more is None or len(data) > HEAD_LIMIT:
                return None
            data += more
            if not data.startswith(b"WARC/"[:len(data)]):
                return None
        fields = _fields(data[:cut])
        left = int(fields["content-length"])
    except (zlib.error, KeyError, ValueError):
        return None
    rec = {"type": fields.get("warc-type"), "fields": fields, "http": None, "size": 0, "payload": [], "sha1": hashlib.sha1()}
    rec["http"] = b"" if fields.get("content-type", "").startswith("application/http") else None
    body, data = data[cut + 4:], b""
    http_open = rec["http"] is not None
    try:
        while True:
            tail = body[left:] if left < len(body) else b""
            body = body[:left]
            left -= len(body)
            if http_open:  # the payload starts behind the HTTP head
                data += body
                cut = data.find(b"\r\n\r\n")
                if cut < 0:
                    body = b""
                else:
                    rec["http"], body, http_open = data[:cut + 4], data[cut + 4:], False
            if body:
                rec["sha1"].update(body)
                rec["size"] += len(body)
                if keep:
                    rec["payload"].append(body)
            if tail.strip(b"\r\n"):
                raise BrokenRecord(f"bytes behind the record at {at}")
            step = next(steps, None)
            if step is None:
                break
            body, here = step
    except zlib.error as e:
        raise BrokenRecord(f"record at {at}: {e}") from e
    if left:
        raise BrokenRecord(f"record at {at} lacks {left} bytes")
    return rec, here


_ROWS = ("path string, at long, record_type string, row_id string, url string, refers_to string, "
         "payload_bytes long, payload_digest string, payload binary")


def _row(path: str, at: int, rec: dict, keep: bool) -> tuple:
    f = rec["fields"]
    size, digest = rec["size"], base32_sha1(rec["sha1"].digest())
    if rec["type"] == "revisit":  # of the payload it stands for
        size = int(_fields(rec["http"] or b"").get("content-length", 0))
        digest = f.get("warc-payload-digest", "").removeprefix("sha1:")
    elif "warc-payload-digest" in f and f["warc-payload-digest"] != "sha1:" + digest:
        raise BrokenRecord(f"digest of the record at {at} in {path}")

    def named(key):
        return unquote(f[key]) if key in f else None

    return (path, at, rec["type"], named("x-row-id"), f.get("warc-target-uri"), named("x-refers-to-row-id"), size, digest,
            b"".join(rec["payload"]) if keep else None)


def read_range(file, path: str, start: int, end: int, size: int, keep: bool) -> Iterator[tuple]:
    """Rows of the records that start in [start, end)."""
    ahead = _Ahead(file, size)
    at = start
    while (hit := ahead.find_magic(at, end)) is not None:
        found = read_record(ahead, hit, keep)
        if found is None:
            at = hit + 1
            continue
        yield _row(path, hit, found[0], keep)
        at = found[1]


def read_warc(spark: SparkSession, path: str, split_bytes: int = 32 << 20, payload: bool = False) -> DataFrame:
    """All records of the ``*.warc.gz`` files of a folder: ``path, at`` (the member's place), ``record_type, row_id, url,
    refers_to, payload_bytes, payload_digest, payload`` (NULL unless asked for)."""
    ship_package(spark)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path).select("path", "length")
    ranges = listed.select("path", "length", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("start"))
    ranges, seen = stage_table(ranges, "warc-ranges", {"n": F.count(F.lit(1))})
    many = max(1, min(int(seen["n"] or 0), 100_000))

    def run(batches):
        schema = pa.schema([("path", pa.string()), ("at", pa.int64()), ("record_type", pa.string()), ("row_id", pa.string()),
                            ("url", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("payload", pa.binary())])

        def batch(rows):
            cols = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for b in batches:
            for where, size, start in zip(*[c.to_pylist() for c in b.columns], strict=True):
                fs, inside = file_system(where)
                with fs.open_input_file(inside) as file:
                    rows, held = [], 0
                    for row in read_range(file, where, start, min(start + split_bytes, size), size, payload):
                        rows.append(row)
                        held += len(row[-1] or b"")
                        if len(rows) >= 2000 or held > 8_000_000:
                            yield batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch(rows)

    return ranges.repartition(many, "path", "start").mapInArrow(run, _ROWS)
