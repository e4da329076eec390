"""End-to-end job, sinks and round trips (JSONL folder -> Arrow / JSONL / Parquet)."""

import glob
import json
import os

import pytest

from seqweave.plans.job import pack_job
from nfd_oracle import next_fit_decreasing
from seqweave.sinks.arrow_stream import read_arrow_stream


def make_input(tmp_dir, files):
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    for stem, convs in files.items():
        with open(f"{src}/{stem}.jsonl", "w", encoding="utf-8") as fh:
            for c in convs:
                fh.write(json.dumps({"conversation": [{"role": "user", "content": c}]}) + "\n")
    return src


# sections template: "### User:\n" + c + "\n\n" = 12 + len(c) code points
FILES = {"alpha": ["a" * 8, "b" * 28, "c" * 3, "d" * 50], "beta": ["e" * 10, "f" * 10]}


def expected_lengths(convs, max_length, oversize, tail):
    lengths = [12 + len(c) for c in convs]
    return [sorted(lengths[i] if oversize == "own_bin" else min(lengths[i], max_length) for i in b)
            for b in next_fit_decreasing(lengths, max_length, oversize, tail)]


def _segments(row):
    pos = row["position_ids"]
    starts = [i for i, p in enumerate(pos) if p == 0] + [len(pos)]
    return sorted(b - a for a, b in zip(starts, starts[1:]))


def test_arrow_job_parts_layout(spark, tmp_dir):
    src = make_input(tmp_dir, FILES)
    out = f"{tmp_dir}/out"
    res = pack_job(spark, src, out, max_length=40, fmt="ARROW")
    for stem, convs in FILES.items():
        files = sorted(glob.glob(f"{out}/{stem}/*.arrow"))
        assert files, stem
        tables = [read_arrow_stream(f) for f in files]
        assert all(t.schema.names == ["input_ids", "labels", "position_ids"] for t in tables)
        assert str(tables[0].schema.field("input_ids").type) == "large_list<item: int32>"
        rows = [r for t in tables for r in t.to_pylist()]
        assert sorted(_segments(r) for r in rows) == sorted(expected_lengths(convs, 40, "truncate", "keep"))
    assert not os.path.exists(f"{out}/_temporary") or not os.listdir(f"{out}/_temporary")
    rep = {r["file_stem"]: r for r in res["report"].collect()}
    assert rep["alpha"]["truncated_tokens"] == (12 + 50) - 40


def test_arrow_job_file_layout_and_parity_tail(spark, tmp_dir):
    src = make_input(tmp_dir, FILES)
    out = f"{tmp_dir}/out"
    res = pack_job(spark, src, out, max_length=40, fmt="arrow", tail="drop", layout="file")
    rep = {r["file_stem"]: r for r in res["report"].collect()}
    assert (rep["beta"]["bins"], rep["beta"]["packed_tokens"], rep["beta"]["dropped_tokens"]) == (1, 22, 22)
    assert sorted(f for f in os.listdir(out) if f.endswith(".arrow")) == ["alpha.arrow", "beta.arrow"]
    alpha = read_arrow_stream(f"{out}/alpha.arrow").to_pylist()
    assert sorted(_segments(r) for r in alpha) == sorted(expected_lengths(FILES["alpha"], 40, "truncate", "drop"))
    # beta: two rows of 22 make two bins; the last one is lost, as in the reference's Arrow path
    beta = read_arrow_stream(f"{out}/beta.arrow").to_pylist()
    assert [_segments(r) for r in beta] == [[22]]
    assert expected_lengths(FILES["beta"], 40, "truncate", "drop") == [[22]]


def test_jsonl_job_keeps_long_rows_whole(spark, tmp_dir):
    src = make_input(tmp_dir, FILES)
    out = f"{tmp_dir}/out"
    pack_job(spark, src, out, max_length=40, fmt="jsonl")
    rows = []
    for f in glob.glob(f"{out}/alpha/*.jsonl"):
        with open(f, encoding="utf-8") as fh:
            rows += [json.loads(line) for line in fh]
    assert list(rows[0]) == ["input_ids", "labels", "position_ids", "length"]
    assert sorted(_segments(r) for r in rows) == sorted(expected_lengths(FILES["alpha"], 40, "own_bin", "keep"))
    assert max(r["length"] for r in rows) == 62


def test_parquet_job(spark, tmp_dir):
    src = make_input(tmp_dir, FILES)
    out = f"{tmp_dir}/out"
    pack_job(spark, src, out, max_length=40, fmt="parquet")
    df = spark.read.parquet(out)
    assert {r["file_stem"] for r in df.select("file_stem").distinct().collect()} == {"alpha", "beta"}
    assert sorted(r["length"] for r in df.filter("file_stem = 'beta'").collect()) == [22, 22]


def test_unknown_format_raises(spark, tmp_dir):
    src = make_input(tmp_dir, FILES)
    with pytest.raises(ValueError):
        pack_job(spark, src, f"{tmp_dir}/out", fmt="msgpack")


def test_quarantine_job(spark, tmp_dir):
    src = make_input(tmp_dir, FILES)
    with open(f"{src}/alpha.jsonl", "a", encoding="utf-8") as fh:
        fh.write('{"conversation":[{"role":"user","content":7}]}\n')
    out = f"{tmp_dir}/out"
    pack_job(spark, src, out, max_length=40, fmt="parquet", on_error="quarantine")
    bad = spark.read.json(f"{out}/_rejected").collect()
    assert len(bad) == 1 and "string role and content" in bad[0]["error"]


def test_arrow_rerun_replaces_parts(spark, tmp_dir):
    src = make_input(tmp_dir, FILES)
    out = f"{tmp_dir}/out"
    pack_job(spark, src, out, max_length=40, fmt="arrow")
    stale = f"{out}/alpha/part-99999.arrow"
    with open(stale, "wb") as fh:
        fh.write(b"old")
    pack_job(spark, src, out, max_length=40, fmt="arrow")
    assert not os.path.exists(stale)
    rows = [r for f in glob.glob(f"{out}/alpha/*.arrow") for r in read_arrow_stream(f).to_pylist()]
    assert sorted(_segments(r) for r in rows) == sorted(expected_lengths(FILES["alpha"], 40, "truncate", "keep"))


def test_empty_folder_writes_nothing(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    for fmt in ("arrow", "jsonl", "parquet"):
        out = f"{tmp_dir}/out-{fmt}"
        res = pack_job(spark, src, out, max_length=40, fmt=fmt)
        assert res["report"].count() == 0
        assert not glob.glob(f"{out}/**/*.arrow", recursive=True)


def test_arrow_parts_named_by_bin_bucket_keep_creation_order(spark, tmp_dir):
    from seqweave.operators.packing import PackSpec, assign_bins, materialize_bins
    from seqweave.plans.job import tokenize_conversations
    from seqweave.sinks.files import write_bins
    from seqweave.functions.template import ChatTemplate
    from seqweave.sources.jsonl import read_conversations

    convs = {"big": ["x" * (i % 17 + 1) for i in range(60)]}
    src = make_input(tmp_dir, convs)
    conv = read_conversations(spark, src)
    tokens = tokenize_conversations(conv, ChatTemplate.sections(), None, "row_key", ["source_file", "file_stem"])
    spec = PackSpec(30)
    bins = materialize_bins(assign_bins(tokens, spec, ["source_file", "file_stem"], "row_key"), spec,
                            ["source_file", "file_stem"], bins_per_part=4)
    out = f"{tmp_dir}/out"
    write_bins(bins, out, "arrow", bins_per_part=4, clustered=True)
    names = sorted(os.listdir(f"{out}/big"))
    assert names[0] == "part-00000.arrow" and len(names) > 2
    rows = [r for n in names for r in read_arrow_stream(f"{out}/big/{n}").to_pylist()]
    lengths = [12 + len(c) for c in convs["big"]]
    expect = next_fit_decreasing(lengths, 30)
    assert [_segments(r) for r in rows] == [sorted(lengths[i] for i in b) for b in expect]


def test_jsonl_file_layout_names_follow_input(spark, tmp_dir):
    src = make_input(tmp_dir, FILES)
    out = f"{tmp_dir}/out"
    pack_job(spark, src, out, max_length=40, fmt="jsonl", layout="file")
    assert sorted(f for f in os.listdir(out) if not f.startswith("_")) == ["alpha.jsonl", "beta.jsonl"]
    with open(f"{out}/alpha.jsonl", encoding="utf-8") as fh:
        text = fh.read()
    lines = text.splitlines()
    assert text.endswith("\n") and lines[0].startswith('{"input_ids":[')
    rows = [json.loads(x) for x in lines]
    assert [r["length"] for r in rows] == [62, 40, 20 + 15]  # creation order, own bins for long rows


def test_unclustered_input_with_clustered_flag_is_refused(spark, tmp_dir):
    from seqweave.sinks.files import write_bins

    rows = [("s", b, [1, 2], [-100, 2], [0, 1], 2) for b in range(40)]
    bins = spark.createDataFrame(rows, "file_stem string, bin long, input_ids array<int>, labels array<int>, "
                                 "position_ids array<int>, length int").repartition(4)
    with pytest.raises(Exception, match="same output file"):
        write_bins(bins, f"{tmp_dir}/out", "arrow", layout="file", clustered=True)
    write_bins(bins, f"{tmp_dir}/ok", "arrow", layout="file")
    assert read_arrow_stream(f"{tmp_dir}/ok/s.arrow").num_rows == 40


def test_write_lines_then_pack_roundtrip(spark, tmp_dir):
    import __spark_entry__ as entry
    from seqweave.sinks.files import write_lines
    from seqweave.sources.jsonl import line_counts

    src = f"{tmp_dir}/src"
    write_lines(entry._json_lines(spark, "/root/testdata/sf0.001"), src, stem_col="source_file", order_col="conv_id")
    assert sorted(os.listdir(src)) == [f"shard-{k}.jsonl" for k in range(4)]
    counts = {r["file_stem"]: r["n_lines"] for r in line_counts(spark, src).collect()}
    assert sum(counts.values()) == 20
    res = pack_job(spark, src, f"{tmp_dir}/out", max_length=4096, fmt="parquet")
    assert sum(r["rows"] for r in res["report"].collect()) == 20


def _arrow_rows(out, stem):
    return [r for f in sorted(glob.glob(f"{out}/{stem}/*.arrow")) for r in read_arrow_stream(f).to_pylist()]


@pytest.mark.parametrize("fmt", ["arrow", "jsonl", "parquet"])
def test_uri_output(spark, tmp_dir, fmt):
    src = make_input(tmp_dir, FILES)
    pack_job(spark, f"file://{src}", f"file://{tmp_dir}/out", max_length=40, fmt=fmt)
    assert glob.glob(f"{tmp_dir}/out/*alpha/*.{fmt}")


def test_other_schemes_are_refused_before_the_job(spark, tmp_dir):
    from seqweave.sinks.arrow_stream import check_scheme, file_system

    with pytest.raises(ValueError, match="ftp"):
        check_scheme("ftp://host/out")
    assert file_system("file:/a b/c")[1] == file_system("file:///a b/c")[1] == file_system("/a b/c")[1] == "/a b/c"


def test_formats_side_by_side_and_layout_change(spark, tmp_dir):
    src = make_input(tmp_dir, FILES)
    out = f"{tmp_dir}/out"
    for fmt in ("arrow", "jsonl", "parquet"):
        pack_job(spark, src, out, max_length=40, fmt=fmt)
    assert glob.glob(f"{out}/alpha/*.arrow") and glob.glob(f"{out}/alpha/*.jsonl") and glob.glob(f"{out}/file_stem=alpha/*")
    pack_job(spark, src, out, max_length=40, fmt="arrow", layout="file")
    assert os.path.exists(f"{out}/alpha.arrow") and not glob.glob(f"{out}/alpha/*.arrow")
    assert glob.glob(f"{out}/alpha/*.jsonl")
    pack_job(spark, src, out, max_length=40, fmt="arrow")
    assert not os.path.exists(f"{out}/alpha.arrow") and len(_arrow_rows(out, "alpha")) == 3


@pytest.mark.parametrize("fmt", ["arrow", "jsonl", "parquet"])
def test_files_without_bins_replace_their_earlier_output(spark, tmp_dir, fmt):
    src = make_input(tmp_dir, {"alpha": ["a" * 8, "b" * 28], "one": ["c"]})
    open(f"{src}/none.jsonl", "w").close()
    out = f"{tmp_dir}/out"
    pack_job(spark, src, out, max_length=100, fmt=fmt, tail="keep")
    rep = {r["file_stem"]: r for r in pack_job(spark, src, out, max_length=100, fmt=fmt, tail="drop")["report"].collect()}
    # 20 + 40 and 13 tokens fit one bin each, which tail="drop" loses
    assert (rep["alpha"]["bins"], rep["one"]["bins"], rep["one"]["fill_rate"]) == (0, 0, None)
    for stem in ("alpha", "one", "none"):
        if fmt == "arrow":
            assert os.path.exists(f"{out}/{stem}/part-00000.arrow") and _arrow_rows(out, stem) == []
        elif fmt == "jsonl":
            assert os.path.getsize(f"{out}/{stem}/part-00000.jsonl") == 0
        else:
            assert not os.path.exists(f"{out}/file_stem={stem}")


def test_part_bound_by_tokens():
    from seqweave.sinks.files import bins_per_part_for

    assert [bins_per_part_for(m) for m in (40, 8192, 131072, 1 << 30)] == [8192, 8192, 512, 1]


def test_staged_tables_are_removed(spark, tmp_dir):
    from urllib.parse import urlsplit

    from seqweave.plans.stage import stage_root

    root = urlsplit(stage_root(spark)).path
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    res = pack_job(spark, make_input(tmp_dir, FILES), f"{tmp_dir}/out", max_length=40, on_error="quarantine")
    assert all(n.startswith("report-") for n in set(os.listdir(root)) - before)
    assert res["report"].count() == 2


def test_quantiles_are_within_their_error(spark, tmp_dir):
    import random

    from seqweave.plans.job import QUANTILES

    rng = random.Random(3)
    convs = {"a": ["x" * rng.randint(1, 60) for _ in range(900)]}
    res = pack_job(spark, make_input(tmp_dir, convs), f"{tmp_dir}/out", max_length=50, fmt="parquet", tail="keep")
    lengths = sorted(12 + len(c) for c in convs["a"])
    bins = sorted(r.length for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    for name, exact in (("conversation_tokens", lengths), ("bin_tokens", bins)):
        for q in QUANTILES:
            value = res["quantiles"][name][q]
            at = [i / len(exact) for i, x in enumerate(exact) if x == value]
            assert at and at[0] - 2e-3 <= q <= at[-1] + 2e-3, (name, q)
    row = res["report"].first()
    assert row["bin_tokens_p10_p50_p90"] == [res["quantiles"]["bin_tokens"][q] for q in (0.1, 0.5, 0.9)]


@pytest.mark.parametrize("fmt, layout", [("arrow", "parts"), ("arrow", "file"), ("jsonl", "parts"), ("jsonl", "file")])
def test_single_bins_are_read_in_place(spark, tmp_dir, fmt, layout):
    from seqweave.sinks import arrow_stream

    convs = {"alpha": ["a" * (1 + i % 50) for i in range(700)], "b [x] é+": ["e" * 10, "f" * 10]}
    out = f"{tmp_dir}/out"
    pack_job(spark, make_input(tmp_dir, convs), out, max_length=64, fmt=fmt, oversize="truncate", layout=layout)
    index = arrow_stream.bin_index(spark, out, fmt).collect()
    expect = {s: next_fit_decreasing([12 + len(x) for x in c], 64) for s, c in convs.items()}
    assert sorted((r.file_stem, r.bin, r["at"]) for r in index) == sorted((s, k, k) for s, b in expect.items() for k in range(len(b)))
    wanted = [("alpha", 0), ("alpha", 300), ("alpha", 301), ("alpha", 5), ("b [x] é+", 0), ("alpha", 10**6), ("none", 1), ("alpha", 5)]
    rows = arrow_stream.read_single_bins(spark, out, spark.createDataFrame(wanted, "file_stem string, bin long"), fmt).collect()
    assert sorted((r.file_stem, r.bin) for r in rows) == [("alpha", 0), ("alpha", 5), ("alpha", 300), ("alpha", 301), ("b [x] é+", 0)]
    for r in rows:
        assert _segments(r.asDict()) == sorted(min(64, 12 + len(convs[r.file_stem][i])) for i in expect[r.file_stem][r.bin])


@pytest.fixture
def small_pieces(monkeypatch):
    from seqweave.sinks import arrow_stream

    monkeypatch.setattr(arrow_stream, "PIECE", 4096)
    return arrow_stream


def _batches(rows, names):
    import pyarrow as pa

    return iter([pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)])


@pytest.mark.parametrize("fmt", ["arrow", "jsonl"])
def test_parts_are_read_as_streams(spark, tmp_dir, small_pieces, fmt):
    """No task holds a part: what a reader gives at a time is bounded, and Spark reads no content of a file."""
    convs, out = ["a" * (1 + i % 50) for i in range(700)], f"{tmp_dir}/out"
    pack_job(spark, make_input(tmp_dir, {"x": convs}), out, max_length=64, fmt=fmt, oversize="truncate")
    file = f"{out}/x/part-00000.{fmt}"
    assert os.path.getsize(file) > 20 * 4096
    got = list(small_pieces.part_rows(fmt)(_batches([(file,)], ["path"])))
    assert max(b.nbytes for b in got) < 3 * 4096
    expect = next_fit_decreasing([12 + len(c) for c in convs], 64)
    assert [at for b in got for at in b.column("at").to_pylist()] == list(range(len(expect)))
    if fmt == "arrow":
        rows = small_pieces.read_bins(spark, out, 8192, fmt)
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
        try:
            assert rows.count() == len(expect) and rows.filter("size(input_ids) > 64").isEmpty()
        finally:
            spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    else:
        assert "posexplode" not in small_pieces.read_bins(spark, out, 8192, fmt)._jdf.queryExecution().toString()


def test_lines_may_be_longer_than_a_piece(small_pieces):
    import io

    lines = [b"x" * 10_000, b"", b"y" * 3000, b"z" * 3000, b"w" * 4096, b"v"]
    for end in (b"", b"\n"):
        got = list(small_pieces._line_pieces(io.BytesIO(b"\n".join(lines) + end)))
        assert [at for places, _ in got for at in places] == [0, 2, 3, 4, 5]
        assert [x for _, some in got for x in some] == [x for x in lines if x]
        assert all(len(some) == 1 or sum(map(len, some)) <= 4096 for _, some in got)
    assert list(small_pieces._line_pieces(io.BytesIO(b""))) == []


@pytest.mark.parametrize("fmt", ["arrow", "jsonl"])
def test_single_bins_come_in_pieces(spark, tmp_dir, small_pieces, fmt):
    """Every bin through the index: bounded pieces from a task, and as many tasks as a shuffle has."""
    convs, out = ["a" * (1 + i % 50) for i in range(700)], f"{tmp_dir}/out"
    pack_job(spark, make_input(tmp_dir, {"x": convs}), out, max_length=64, fmt=fmt, oversize="truncate", layout="file")
    index = small_pieces.bin_index(spark, out, fmt).orderBy("offset", "row")
    names = ["file_stem", "bin", "path", "offset", "length", "row"]
    rows = [tuple(r) for r in index.select(*names).collect()]
    got = list(small_pieces.single_rows(fmt)(_batches(rows, names)))
    assert max(b.nbytes for b in got) < 3 * 4096
    assert [k for b in got for k in b.column("bin").to_pylist()] == [r[1] for r in rows]
    read = small_pieces.read_single_bins(spark, out, index.select("file_stem", "bin"), fmt)
    assert read.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert read.count() == len(rows)


def test_lines_without_index_keep_no_places(tmp_dir):
    import pyarrow as pa

    from seqweave.sinks.arrow_stream import _BinFilesWriter, _Index

    class Counted(_Index):
        def lines(self, *args):
            raise AssertionError("an index that nobody writes")

    from seqweave.sinks import arrow_stream
    arrow_stream._Index, before = Counted, arrow_stream._Index
    try:
        writer = _BinFilesWriter({"path": f"{tmp_dir}/out", "format": "jsonl", "layout": "file", "index": "false"})
        batch = pa.RecordBatch.from_pydict({"file_stem": ["a", "a"], "bin": [0, 1], "line": ["x", "y"]})
        (tmp, stem, _), = writer.write(iter([batch])).moves
    finally:
        arrow_stream._Index = before
    assert stem == "a" and open(tmp).read() == "x\ny\n"
