"""Per-input-file sink (Arrow IPC stream or JSONL) as a Python Data Source writer.

``format=arrow``: Arrow *stream* files with the training schema
``input_ids, labels, position_ids: large_list<int32>`` (not null).
``format=jsonl``: one bin per line; the lines arrive already serialized by
Spark (``to_json``, keys ``input_ids, labels, position_ids, length``), the
task only writes bytes.

A task's rows come sorted by (file stem, bin), so it holds one open file at a
time, under a name of its own in ``<out>/_temporary/<job>``; the driver's
``commit`` lists the files of successful tasks, ``sinks.publish`` brings them into place as one step, and
``abort`` removes them, so retried, speculative or late tasks never leave
partial output.  A row whose bin is NULL makes an empty file for its stem.

Paths: the caller passes a path qualified by Spark's file systems
(``qualified``); ``file:``, ``hdfs:``, ``s3(a|n):``, ``gs:`` and ``abfs(s):``
can be written, any other scheme is refused before the job starts.

Each file has an index ``<out>/_index/<file>.index`` (Parquet: ``bin, at, offset, length, row``): which
bytes of the file hold a bin and its place among the rows there, so a bin can be read without its
predecessors (``read_single_bins``).  Lines that are no bins (``index=false``) have none.

Layouts: ``parts`` writes ``<out>/<stem>/part-<bucket>.<ext>`` where bucket
= bin // bins_per_part (many tasks per input file; each bucket is written by
one task, and reading parts in name order gives the bins in creation order);
``file`` writes ``<out>/<stem>.<ext>`` and expects all bins of a stem in one
partition (the reference's one-file-per-input naming).
"""

from __future__ import annotations

import json
import posixpath
import uuid
from dataclasses import dataclass
from itertools import groupby
from urllib.parse import urlsplit

from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

# Fixed output schema of the Arrow sink.
ARROW_COLUMNS = ("input_ids", "labels", "position_ids")
FORMATS = ("arrow", "jsonl")
# Spark's scheme -> the library's, where they differ
_SCHEMES = {"hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}
BLOCK_ROWS = 256  # bins written at a time: what a reader of one bin has to fetch
PIECE = 1 << 23  # bytes a reader takes or gives at a time, a longer bin apart
INDEX = ".index"


def qualified(spark, path: str) -> str:
    """The path with scheme and authority as Spark resolves it (default file system included)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(hpath).toString()


def can_open(path: str) -> bool:
    """Whether tasks reach the path through the library's file systems."""
    return urlsplit(path).scheme in ("", "file", *_SCHEMES)


def check_scheme(path: str) -> None:
    scheme = urlsplit(path).scheme
    if not can_open(path):
        raise ValueError(f"arrow and jsonl output cannot be written to {scheme}: paths; use fmt='parquet'")


def file_system(path: str):
    """(file system, path inside it) of a plain path or URI; the one place where paths are resolved."""
    import pyarrow.fs as pafs

    check_scheme(path)
    scheme, sep, rest = path.partition(":")
    if not sep or scheme not in ("file", *_SCHEMES):
        return pafs.LocalFileSystem(), path
    authority, slash, inside = rest[2:].partition("/") if rest.startswith("//") else ("", "/", rest.lstrip("/"))
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + inside
    fs, base = pafs.FileSystem.from_uri(f"{_SCHEMES[scheme]}://{authority}/")
    return fs, posixpath.join(base or "/", inside)


def arrow_schema():
    import pyarrow as pa

    item = pa.field("item", pa.int32(), nullable=True)
    return pa.schema([pa.field(c, pa.large_list(item), nullable=False) for c in ARROW_COLUMNS])


def index_name(file: str) -> str:
    """Name of a file's index, both relative to the output folder."""
    return posixpath.join("_index", file + INDEX)


class _Index:
    """Places of the bins of one open file."""

    def __init__(self):
        self.rows: list[tuple[int, int, int, int, int]] = []

    def block(self, bins: list[int], offset: int, length: int) -> None:
        at = len(self.rows)
        self.rows += [(b, at + i, offset, length, i) for i, b in enumerate(bins)]

    def lines(self, bins: list[int], offset: int, lines: list[bytes]) -> None:
        for b, line in zip(bins, lines, strict=True):
            self.rows.append((b, len(self.rows), offset, len(line), 0))
            offset += len(line)

    def write(self, fs, path: str) -> None:
        import pyarrow as pa
        import pyarrow.parquet as pq

        kinds = [("bin", pa.int64()), ("at", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("row", pa.int32())]
        columns = list(zip(*self.rows, strict=True)) or [[]] * len(kinds)
        table = pa.table({n: pa.array(c, t) for (n, t), c in zip(kinds, columns, strict=True)})
        with fs.open_output_stream(path + INDEX) as out:
            pq.write_table(table, out)


@dataclass
class _Written(WriterCommitMessage):
    moves: list


class BinFilesDataSource(DataSource):
    @classmethod
    def name(cls):
        return "seqweave_bins"

    def writer(self, schema, overwrite):
        return _BinFilesWriter(self.options)


class _BinFilesWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.layout = options.get("layout", "parts")
        self.stem_col = options.get("stem_col", "file_stem")
        self.job = options.get("job_id") or uuid.uuid4().hex
        self.prefix = options.get("prefix", "")
        self.bins_per_part = int(options.get("bins_per_part", "8192"))
        self.format = options.get("format", "arrow")
        self.index = options.get("index", "true") == "true"
        if self.format not in FORMATS:
            raise ValueError(f"format not supported: {self.format}")
        check_scheme(self.path)

    def _final(self, root: str, stem: str, bucket: int) -> str:
        if self.layout == "file":
            return posixpath.join(root, f"{stem}.{self.format}")
        return posixpath.join(root, stem, f"{self.prefix}part-{bucket:05d}.{self.format}")

    def _temporary(self, root: str) -> str:
        return posixpath.join(root, "_temporary", self.job)

    def write(self, iterator):
        import pyarrow as pa
        import pyarrow.ipc as ipc

        fs, root = file_system(self.path)
        fs.create_dir(self._temporary(root), recursive=True)
        schema = arrow_schema()
        moves, sink, stream, current, index = [], None, None, None, _Index()

        def close():
            if stream is not None:
                stream.close()
            if sink is not None:
                sink.close()
                tmp, stem, final = moves[-1]
                if self.index:
                    index.write(fs, tmp)
                    moves.append((tmp + INDEX, stem, posixpath.join(root, index_name(posixpath.relpath(final, root)))))

        try:
            for batch in iterator:
                bins = batch.column("bin").to_pylist()
                stems = batch.column(self.stem_col).to_pylist()
                per_part = self.bins_per_part if self.layout == "parts" else None
                keys = [(s, (b or 0) // per_part if per_part else 0) for s, b in zip(stems, bins)]
                for key, run in groupby(range(batch.num_rows), key=keys.__getitem__):
                    rows = [i for i in run]
                    if key != current:
                        close()
                        sink = stream = None
                        # a fresh name per open file: no two attempts share one
                        tmp = posixpath.join(self._temporary(root), f"{uuid.uuid4().hex}.{self.format}")
                        sink = fs.open_output_stream(tmp)
                        stream = ipc.new_stream(sink, schema) if self.format == "arrow" else None
                        moves.append((tmp, key[0], self._final(root, *key)))
                        current, index = key, _Index()
                    if bins[rows[0]] is None:
                        continue
                    for first in range(rows[0], rows[-1] + 1, BLOCK_ROWS):
                        n = min(BLOCK_ROWS, rows[-1] + 1 - first)
                        part, offset = batch.slice(first, n), sink.tell()
                        if stream is None:
                            lines = [x.encode() + b"\n" for x in part.column("line").to_pylist()]
                            sink.write(b"".join(lines))
                            if self.index:
                                index.lines(bins[first:first + n], offset, lines)
                        else:
                            cols = [part.column(c).cast(schema.field(c).type) for c in ARROW_COLUMNS]
                            stream.write_batch(pa.record_batch(cols, schema=schema))
                            index.block(bins[first:first + n], offset, sink.tell() - offset)
        finally:
            close()
        return _Written(moves)

    def commit(self, messages):
        """Driver side, after every task succeeded: list the finished files, for ``publish`` to bring into place."""
        fs, root = file_system(self.path)
        folder = self._temporary(root)
        fs.create_dir(folder, recursive=True)
        inside = [(posixpath.relpath(tmp, root), stem, posixpath.relpath(final, root))
                  for msg in messages if msg is not None for tmp, stem, final in msg.moves]
        with fs.open_output_stream(posixpath.join(folder, "manifest.json")) as out:
            out.write(json.dumps({"files": inside}).encode())

    def _drop_temporary(self, fs, root):
        import pyarrow.fs as pafs

        tmp = self._temporary(root)
        if fs.get_file_info(tmp).type == pafs.FileType.Directory:
            fs.delete_dir(tmp)

    def abort(self, messages):
        fs, root = file_system(self.path)
        try:
            self._drop_temporary(fs, root)
        except OSError:
            pass


def read_arrow_stream(path: str):
    """Read one stream file back as a pyarrow Table (tests and tooling)."""
    import pyarrow.ipc as ipc

    fs, inside = file_system(path)
    with fs.open_input_stream(inside) as fh:
        return ipc.open_stream(fh).read_all()


def _pieces(batch):
    """A record batch in slices of about ``PIECE`` bytes."""
    rows = max(1, batch.num_rows * PIECE // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _short_lists(batch):
    """The arrays of a record batch of the sink as Spark's lists."""
    import pyarrow as pa

    return [batch.column(c).cast(pa.list_(pa.int32())) for c in ARROW_COLUMNS]


def _lines(stream):
    """The lines of an input stream, without their ends."""
    rest: list[bytes] = []
    while chunk := stream.read(PIECE):
        first, *more = chunk.split(b"\n")
        rest.append(first)
        if more:
            yield b"".join(rest)
            yield from more[:-1]
            rest = more[-1:]
    yield b"".join(rest)


def _line_pieces(stream):
    """(place of each, lines) that are not empty, about ``PIECE`` bytes of them at a time."""
    at, lines, size = [], [], 0
    for place, line in enumerate(_lines(stream)):
        if not line:
            continue
        if lines and size + len(line) > PIECE:
            yield at, lines
            at, lines, size = [], [], 0
        at.append(place)
        lines.append(line)
        size += len(line)
    if lines:
        yield at, lines


def part_rows(fmt: str):
    """``mapInArrow`` function: paths of written parts in; their bins' places and arrays (or lines) out, read as a stream."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.ipc as ipc

        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, inside = file_system(path)
                with fs.open_input_stream(inside) as stream:
                    if fmt == "jsonl":
                        for at, lines in _line_pieces(stream):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([path] * len(at)), pa.array(at, pa.int32()), pa.array(lines, pa.binary()).cast(pa.string())],
                                names=["path", "at", "line"])
                        continue
                    at = 0
                    for block in ipc.open_stream(stream):
                        for part in _pieces(block):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([path] * len(part)), pa.array(range(at, at + len(part)), pa.int32()), *_short_lists(part)],
                                names=["path", "at", *ARROW_COLUMNS])
                            at += len(part)
    return run


def read_bins(spark, path: str, bins_per_part: int, fmt: str = "arrow"):
    """Written parts as one row per bin: ``file_stem, bin, input_ids, labels, position_ids``.

    ``path`` is the output folder of the ``parts`` layout; the bin number
    comes from the part's name and the place in the part.  Tasks read the parts
    as streams, so no part is held as a whole.
    """
    from pyspark.sql import functions as F

    from seqweave.session import ship_package
    from seqweave.sinks.publish import recover

    recover(spark, path)
    ship_package(spark)
    arrays = "input_ids array<int>, labels array<int>, position_ids array<int>"
    # only listed by Spark; their content is not read here
    files = spark.read.format("binaryFile").load(f"{path.rstrip('/')}/*/*.{fmt}").select(
        F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("path"))
    if fmt == "jsonl":
        lines = files.mapInArrow(part_rows(fmt), "path string, at int, line string")
        rows = lines.select("path", "at", F.from_json("line", arrays).alias("r")).select("path", "at", "r.*")
    else:
        rows = files.mapInArrow(part_rows(fmt), f"path string, at int, {arrays}")
    part = F.regexp_extract("path", r"part-(\d+)\.[^/]*$", 1).cast("long")
    stem = F.regexp_extract("path", r"([^/]*)/[^/]*$", 1)
    return rows.select(stem.alias("file_stem"), (part * bins_per_part + F.col("at")).alias("bin"), *ARROW_COLUMNS)


def bin_index(spark, path: str, fmt: str = "arrow"):
    """Where every bin of an output folder stands: ``file_stem, bin, path, at, offset, length, row``, both layouts."""
    from pyspark.sql import functions as F

    from seqweave.sinks.publish import recover

    recover(spark, path)
    schema = "bin long, at long, offset long, length long, row int"
    rows = spark.read.schema(schema).option("pathGlobFilter", f"*.{fmt}{INDEX}").option("recursiveFileLookup", "true").parquet(f"{path.rstrip('/')}/_index")
    file = F.regexp_replace(F.col("_metadata.file_path"), r"\.index$", "")
    plain = F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))
    root = qualified(spark, path).rstrip("/")
    inside = F.substring(plain, len(qualified(spark, f"{root}/_index")) + 2, 1 << 30)
    stem = F.when(inside.contains("/"), F.regexp_extract(inside, r"^([^/]*)/", 1)).otherwise(
        F.regexp_replace(inside, rf"\.{fmt}$", ""))
    return rows.select(stem.alias("file_stem"), "bin", F.concat(F.lit(root + "/"), inside).alias("path"), "at", "offset", "length",
                       "row")


def _json_bins(keys: list, lines: list[bytes]):
    """(file stem, bin) of each line and the line's arrays as one record batch."""
    import pyarrow as pa
    import pyarrow.json as pj

    text = b"".join(lines)
    schema = pa.schema([(c, pa.list_(pa.int32())) for c in ARROW_COLUMNS])
    table = pj.read_json(pa.BufferReader(text), pj.ReadOptions(use_threads=False, block_size=len(text) + 1),
                         pj.ParseOptions(explicit_schema=schema, unexpected_field_behavior="ignore")).combine_chunks()
    return _bin_rows(keys, [table.column(c).combine_chunks() for c in ARROW_COLUMNS])


def _bin_rows(keys: list, arrays: list):
    import pyarrow as pa

    stems, numbers = zip(*keys, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array(numbers, pa.int64()), *arrays],
                                      names=["file_stem", "bin", *ARROW_COLUMNS])


def single_rows(fmt: str):
    """``mapInArrow`` function: rows of the index, sorted by place, in; their bins out, about ``PIECE`` bytes at a time."""
    columns = ("file_stem", "bin", "path", "offset", "length", "row")

    def run(batches):
        import pyarrow as pa
        import pyarrow.ipc as ipc

        opened, name = None, None
        try:
            for batch in batches:
                keys, lines, size = [], [], 0
                wanted = zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
                for (where, offset, length), run_of in groupby(wanted, key=lambda r: r[2:5]):
                    if where != name:
                        if opened is not None:
                            opened.close()
                        fs, inside = file_system(where)
                        opened, name = fs.open_input_file(inside), where
                    if fmt == "jsonl" and lines and size + length > PIECE:
                        yield _json_bins(keys, lines)
                        keys, lines, size = [], [], 0
                    opened.seek(offset)
                    block, rows = opened.read(length), [(r[0], r[1], r[5]) for r in run_of]
                    if fmt == "jsonl":
                        keys += [r[:2] for r in rows]
                        lines += [block] * len(rows)
                        size += length
                        continue
                    source = pa.BufferReader(block)
                    message = ipc.read_message(source)
                    if message.type == "schema":  # a file's first block starts with it
                        message = ipc.read_message(source)
                    found = ipc.read_record_batch(message, arrow_schema()).take(pa.array([r[2] for r in rows], pa.int64()))
                    at = 0
                    for part in _pieces(found):
                        yield _bin_rows([r[:2] for r in rows[at:at + len(part)]], _short_lists(part))
                        at += len(part)
                if lines:
                    yield _json_bins(keys, lines)
        finally:
            if opened is not None:
                opened.close()
    return run


def read_single_bins(spark, path: str, wanted, fmt: str = "arrow"):
    """The bins that ``wanted`` (``file_stem, bin``) names, with their arrays; only their blocks' bytes are read.

    The index meets ``wanted`` by join; tasks then seek to the blocks, file by file.  The blocks are dealt to as many
    tasks as a shuffle has: index rows are narrow, so by their size all of them would go to one."""
    from seqweave.session import ship_package

    ship_package(spark)
    found = bin_index(spark, path, fmt).join(wanted.select("file_stem", "bin").distinct(), ["file_stem", "bin"])
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = found.repartition(tasks, "path", "offset").sortWithinPartitions("path", "offset", "row")
    return placed.mapInArrow(single_rows(fmt),
                             "file_stem string, bin long, input_ids array<int>, labels array<int>, position_ids array<int>")
