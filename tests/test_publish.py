"""A publish that dies leaves the old or the new output, never a mix."""

import json
import os

import pytest

from nfd_oracle import next_fit_decreasing
from seqweave.plans.job import pack_job
from seqweave.sinks import publish
from seqweave.sinks.arrow_stream import read_bins
from seqweave.sinks.files import bins_per_part_for

OLD = {"alpha": ["a" * 8, "b" * 28, "c" * 3], "beta": ["e" * 10, "f" * 10]}
NEW = {"alpha": ["n" * 20, "o" * 5], "beta": ["p" * 30, "q", "r" * 11], "gamma": ["s"]}


def make_input(folder, files):
    os.makedirs(folder)
    for stem, convs in files.items():
        with open(f"{folder}/{stem}.jsonl", "w", encoding="utf-8") as fh:
            for c in convs:
                fh.write(json.dumps({"conversation": [{"role": "user", "content": c}]}) + "\n")
    return folder


def expected(files):
    return sorted((stem, sorted(12 + len(convs[i]) for i in b))
                  for stem, convs in files.items() for b in next_fit_decreasing([12 + len(c) for c in convs], 40, "own_bin"))


def found(spark, out, fmt):
    if fmt == "parquet":
        publish.recover(spark, out)
        rows = spark.read.parquet(out).collect()
    else:
        rows = read_bins(spark, out, bins_per_part_for(40), fmt).collect()
    out = []
    for r in rows:
        starts = [i for i, p in enumerate(r.position_ids) if p == 0] + [len(r.position_ids)]
        out.append((r.file_stem, sorted(b - a for a, b in zip(starts, starts[1:]))))
    return sorted(out)


class Killed(Exception):
    pass


@pytest.mark.parametrize("fmt, dies_at", [
    ("arrow", "journal"), ("arrow", "first move"), ("arrow", "drops"), ("arrow", "journal removal"), ("jsonl", "second move"),
    ("parquet", "journal"), ("parquet", "second move")])
def test_killed_publish(spark, tmp_dir, monkeypatch, fmt, dies_at):
    out = f"{tmp_dir}/out"
    pack_job(spark, make_input(f"{tmp_dir}/old", OLD), out, max_length=40, fmt=fmt, oversize="own_bin")
    assert found(spark, out, fmt) == expected(OLD)
    with monkeypatch.context() as m:
        moves = []
        move, delete = publish.Folder.move, publish.Folder.delete

        def dying_move(self, old, new):
            to_journal = new.startswith(publish.JOURNAL)
            if to_journal and dies_at == "journal":
                raise Killed
            if not to_journal:
                moves.append(new)
                if (dies_at, len(moves)) in (("first move", 1), ("second move", 2)):
                    delete(self, new)  # the old file is gone, the new one not yet there
                    raise Killed
            move(self, old, new)

        def dying_delete(self, name):
            if dies_at == "journal removal" and moves and name.startswith(publish.JOURNAL):
                raise Killed
            if dies_at == "drops" and len(moves) >= 3 and not name.startswith("_") and name not in moves:
                raise Killed
            delete(self, name)

        m.setattr(publish, "THREADS", 1)
        m.setattr(publish.Folder, "move", dying_move)
        m.setattr(publish.Folder, "delete", dying_delete)
        try:
            pack_job(spark, make_input(f"{tmp_dir}/new", NEW), out, max_length=40, fmt=fmt, oversize="own_bin")
        except Killed:
            pass
    began = dies_at != "journal"
    assert found(spark, out, fmt) == expected(NEW if began else OLD)
    assert not [n for n in os.listdir(out) if n.startswith(publish.JOURNAL)]
    # the next job is not disturbed
    pack_job(spark, f"{tmp_dir}/old", out, max_length=40, fmt=fmt, oversize="own_bin")
    assert found(spark, out, fmt) == expected({**NEW, **OLD} if began else OLD)


def test_journal_can_be_repeated(spark, tmp_dir):
    out = f"{tmp_dir}/o"
    os.makedirs(f"{out}/_temporary/j")
    for name in ("a", "b"):
        with open(f"{out}/_temporary/j/{name}", "w") as fh:
            fh.write("new " + name)
    with open(f"{out}/gone", "w") as fh:
        fh.write("old")
    publish.publish(spark, out, "j", [("_temporary/j/a", "s/a"), ("_temporary/j/b", "b")], ["gone", "never"])
    publish.recover(spark, out)
    assert sorted(os.listdir(out)) == ["b", "s"] or sorted(n for n in os.listdir(out) if not n.endswith(".crc")) == ["b", "s"]
    with open(f"{out}/s/a") as fh:
        assert fh.read() == "new a"
