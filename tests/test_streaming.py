"""Continuous packing gives the batch job's bins for every file."""

import glob
import json
import os

import pytest

from nfd_oracle import next_fit_decreasing
from seqweave.sinks.arrow_stream import read_arrow_stream
from seqweave.streaming.continuous import start_continuous_pack


def _write(path, convs):
    with open(path, "w", encoding="utf-8") as fh:
        for c in convs:
            fh.write(json.dumps({"conversation": [{"role": "user", "content": c}]}) + "\n")


def test_stream_packs_each_file(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    files = {"f1": ["a" * 5, "b" * 30, "c" * 12], "f2": ["d" * 3, "e" * 3], "f3": ["g" * 40]}
    for stem, convs in files.items():
        _write(f"{src}/{stem}.jsonl", convs)
    _write(f"{src}/skip.txt", ["x"])
    out = f"{tmp_dir}/out"
    q = start_continuous_pack(spark, src, out, max_length=40, available_now=True,
                              checkpoint_location=f"{tmp_dir}/ckpt", max_files_per_trigger=2)
    q.awaitTermination(300)
    assert q.exception() is None
    for stem, convs in files.items():
        parts = glob.glob(f"{out}/batch=*/{stem}/*.arrow")
        rows = [r for p in parts for r in read_arrow_stream(p).to_pylist()]
        lengths = [12 + len(c) for c in convs]
        expect = next_fit_decreasing(lengths, 40)
        got = sorted(len(r["input_ids"]) for r in rows)
        assert got == sorted(sum(min(lengths[i], 40) for i in b) for b in expect), stem
    assert len(glob.glob(f"{out}/batch=*")) >= 2
    assert not glob.glob(f"{out}/batch=*/skip")


def test_restart_and_old_files(spark, tmp_dir):
    """A second query on the same folders goes on where the first stopped; a ten-day-old file counts."""
    from urllib.parse import urlsplit

    from seqweave.plans.stage import stage_root

    src, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    os.makedirs(src)
    root = urlsplit(stage_root(spark)).path

    def run():
        q = start_continuous_pack(spark, src, out, max_length=40, available_now=True)
        q.awaitTermination(300)
        assert q.exception() is None

    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    _write(f"{src}/f1.jsonl", ["a", "b" * 30])
    run()
    _write(f"{src}/f2.jsonl", ["c"])
    old = os.path.getmtime(f"{src}/f1.jsonl") - 10 * 86400
    os.utime(f"{src}/f2.jsonl", (old, old))
    run()
    run()
    rows = [r for p in glob.glob(f"{out}/batch=*/*/*.arrow") for r in read_arrow_stream(p).to_pylist()]
    assert sorted(len(r["input_ids"]) for r in rows) == [13, 13, 40]
    assert set(os.listdir(root)) == before


def _packed(spark, out):
    rows = spark.read.option("basePath", out).parquet(f"{out}/batch=*").collect()
    return sorted((r.file_stem, r.length) for r in rows)


def _run(spark, src, out, ckpt, **options):
    q = start_continuous_pack(spark, src, out, max_length=40, fmt="parquet", available_now=True, checkpoint_location=ckpt, **options)
    q.awaitTermination(300)
    return q


def test_ledger_outlives_the_checkpoint(spark, tmp_dir):
    src, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    os.makedirs(src)
    _write(f"{src}/f1.jsonl", ["a" * 5, "b" * 30])
    _write(f"{src}/f2.jsonl", ["c" * 3])
    _run(spark, src, out, f"{tmp_dir}/ckpt1")
    first = _packed(spark, out)
    assert [s for s, _ in first] == ["f1", "f1", "f2"]
    # another application without the first one's checkpoint lists every file again
    _write(f"{src}/f3.jsonl", ["d" * 9])
    _run(spark, src, out, f"{tmp_dir}/ckpt2")
    assert _packed(spark, out) == sorted([*first, ("f3", 21)])
    assert len(glob.glob(f"{out}/batch=*")) == 2
    # a rewritten file is noticed, and replaced when asked
    _write(f"{src}/f1.jsonl", ["e" * 11])
    with pytest.raises(Exception, match="has changed since it was packed"):
        _run(spark, src, out, f"{tmp_dir}/ckpt3")
    _run(spark, src, out, f"{tmp_dir}/ckpt4", on_rewrite="repack")
    assert _packed(spark, out) == [("f1", 23), ("f2", 15), ("f3", 21)]
    ledger = spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/_ledger")
    assert ledger.count() == 4 and ledger.select("query").distinct().count() == 3


def test_hidden_names_and_patterns_are_refused(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in [a]")
    with pytest.raises(ValueError, match="pattern"):
        start_continuous_pack(spark, f"{tmp_dir}/in [a]", f"{tmp_dir}/out", available_now=True)
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    _write(f"{src}/_x.jsonl", ["a"])
    with pytest.raises(ValueError, match="_x.jsonl"):
        start_continuous_pack(spark, src, f"{tmp_dir}/out", available_now=True)
