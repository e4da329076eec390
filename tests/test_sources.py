"""JSONL source: listing, alias, strict validation, provenance (FIXTURES §8)."""

import json
import os

import pytest

from seqweave.sources.jsonl import read_conversations, read_lines, parse_conversations


def write(path, lines):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


GOOD = [
    '{"conversation":[{"role":"user","content":"Hi"}],"extra":1}',
    '{"conversations":[{"role":"user","content":"B","tool_calls":[1]}]}',
]
BAD = {
    '{"conversation":[{"role":"user","content":"a"}],"conversations":[{"role":"user","content":"b"}]}': "both",
    '{"conversation":[{"role":"user"}]}': "string role and content",
    '{"conversation":[{"role":"user","content":5}]}': "string role and content",
    '{"conversation":[]}': "empty",
    "{}": "missing",
    "": "blank",
    '{"conversation":[{"role":"user","content":"tr': "malformed",
    '{"conversation":"text"}': "not a list",
}


def test_good_rows_alias_and_projection(spark, tmp_dir):
    write(f"{tmp_dir}/a.jsonl", GOOD)
    rows = read_conversations(spark, tmp_dir).orderBy("row_key").collect()
    assert [r["messages"][0]["content"] for r in rows] == ["Hi", "B"]
    assert set(rows[0]["messages"][0].asDict()) == {"role", "content"}
    assert rows[0]["file_stem"] == "a" and rows[0]["source_file"].endswith("/a.jsonl")


def test_each_bad_line_is_rejected_with_reason(spark, tmp_dir):
    write(f"{tmp_dir}/b.jsonl", GOOD + list(BAD))
    good, bad = read_conversations(spark, tmp_dir, on_error="quarantine")
    assert good.count() == 2
    reasons = {r["line"]: r["error"] for r in bad.collect()}
    assert len(reasons) == len(BAD)
    for line, fragment in BAD.items():
        assert fragment in reasons[line], (line, reasons[line])


def test_long_lines_are_read_and_named(spark, tmp_dir):
    body = "x" * (17 << 20)
    line = json.dumps({"conversation": [{"role": "user", "content": body}]})
    write(f"{tmp_dir}/d.jsonl", [line, line[:-2]])
    good, bad = read_conversations(spark, tmp_dir, on_error="quarantine")
    assert [r["n"] for r in good.selectExpr("length(messages[0].content) AS n").collect()] == [len(body)]
    assert [r["error"] for r in bad.select("error").collect()] == ["malformed JSON"]


def test_typed_route_for_long_and_odd_lines(spark, tmp_dir, monkeypatch):
    """Every line gives the same through the variant parser and through the typed decoder alone."""
    from seqweave.sources import jsonl

    odd = {
        '{"id":1,"id":2,"conversation":[{"role":"user","content":"a","x":1,"x":2}]}': None,
        '{"conversation":[{"role":"user","content":"a"}],"conversation":[]}': "conversation given twice",
        '{"conversation":[{"role":"user","role":"user","content":"a"}]}': "role or content given twice",
        '{"conversation":[{"role":"user","content":"\\ud800"}]}': "malformed",
        '{"conversation":[5]}': "string role and content",
        '{"conversation":[{"role":"user","content":null}]}': "string role and content",
        '{"conversation":null}': None,  # the reason is checked below
        '[]': "missing", '"x"': "missing", '5': "missing", "{} x": "malformed", "{}],[{}": "malformed", '{"a":NaN}': "malformed",
        '{"conversation":[{"role":"user","content":"é\\u00e9\\n"}]} ': None,
    }
    lines = [*GOOD, *BAD, *odd]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    both = []
    for limit in (jsonl.LONG_LINE, -1):
        monkeypatch.setattr(jsonl, "LONG_LINE", limit)
        both.append([(r.messages, r.error) for r in parse_conversations(df).orderBy("i").collect()])
    assert both[0] == both[1]
    for line, (messages, error) in zip(lines, both[0], strict=True):
        want = BAD.get(line, odd.get(line))
        assert (messages is None) == (error is not None), line
        if want:
            assert want in error, (line, error)
        elif line != '{"conversation":null}':
            assert error is None and messages, (line, error)
    assert both[0][lines.index('{"conversation":null}')][1] == "conversation is not a list"
    assert both[0][-1][0][0].content == "éé\n"


def test_line_above_the_limit_is_refused_with_its_size(spark, monkeypatch):
    from seqweave.sources import jsonl

    monkeypatch.setattr(jsonl, "MAX_LINE", 100)
    monkeypatch.setattr(jsonl, "LONG_LINE", 50)
    rows = parse_conversations(spark.createDataFrame([("x" * 101,), ("x" * 100,)], "line string")).collect()
    assert [r.error for r in rows] == ["line of 101 bytes, the limit is 100", "malformed JSON"]


def test_fail_mode_raises(spark, tmp_dir):
    write(f"{tmp_dir}/c.jsonl", GOOD + ['{"conversation":[{"role":"user","content":5}]}'])
    with pytest.raises(Exception, match="invalid conversation"):
        read_conversations(spark, tmp_dir).collect()


def test_folder_listing_is_flat_and_case_sensitive(spark, tmp_dir):
    write(f"{tmp_dir}/x.jsonl", GOOD[:1])
    write(f"{tmp_dir}/y.JSONL", GOOD[:1])
    write(f"{tmp_dir}/z.json", GOOD[:1])
    os.makedirs(f"{tmp_dir}/sub")
    write(f"{tmp_dir}/sub/w.jsonl", GOOD[:1])
    stems = {r["file_stem"] for r in read_lines(spark, tmp_dir).collect()}
    assert stems == {"x"}


def test_single_file_any_extension(spark, tmp_dir):
    write(f"{tmp_dir}/data.txt", GOOD)
    rows = read_conversations(spark, f"{tmp_dir}/data.txt").collect()
    assert len(rows) == 2 and rows[0]["file_stem"] == "data"


def test_empty_folder(spark, tmp_dir):
    assert read_lines(spark, tmp_dir).count() == 0


def test_names_are_taken_literally(spark, tmp_dir):
    import os

    for name in ("a{1}.jsonl", "b.tar.jsonl", "c[2]*.jsonl"):
        write(f"{tmp_dir}/{name}", GOOD[:1])
    stems = {r["file_stem"] for r in read_lines(spark, tmp_dir).collect()}
    assert stems == {"a{1}", "b.tar", "c[2]*"}
    assert read_lines(spark, f"{tmp_dir}/a{{1}}.jsonl").count() == 1
    folder = f"{tmp_dir}/conv[1]"
    os.makedirs(folder)
    write(f"{folder}/x.jsonl", GOOD[:1])
    assert read_lines(spark, folder).count() == 1
    write(f"{folder}/_y.jsonl", GOOD[:1])
    with pytest.raises(ValueError, match="_y.jsonl"):
        read_lines(spark, folder)


def test_one_document_per_line(spark, tmp_dir):
    ok = '{"conversation":[{"role":"user","content":"a"}]}'
    bad = [ok + " x", ok + "}", ok + ok, ok + "," + ok, ok + "],[1", "[" + ok + "]", ok[:-1]]
    with open(f"{tmp_dir}/f.jsonl", "wb") as fh:
        fh.write("\n".join([ok, *bad, " " + ok + " "]).encode() + b"\r\n" + ok.replace('"a"', '"b"').encode() + b"\r")
    got = parse_conversations(read_lines(spark, f"{tmp_dir}/f.jsonl")).collect()
    assert len(got) == len(bad) + 3
    errors = [r["error"] for r in got]
    assert errors.count(None) == 3 and all(e for e in errors[1:-2])
    bare = '{"conversation":[{"role":"user",\r"content":"a"}]}'
    with open(f"{tmp_dir}/g.jsonl", "wb") as fh:
        fh.write(bare.encode())
    assert [r["error"] for r in parse_conversations(read_lines(spark, f"{tmp_dir}/g.jsonl")).collect()] == [None]


def test_unicode_content_survives(spark, tmp_dir):
    line = json.dumps({"conversation": [{"role": "user", "content": "héllo \U0001F600"}]})
    write(f"{tmp_dir}/u.jsonl", [line])
    r = read_conversations(spark, tmp_dir).first()
    assert r["messages"][0]["content"] == "héllo \U0001F600"


def test_parse_from_derived_lines(spark):
    df = spark.createDataFrame([(GOOD[1],)], "line string")
    r = parse_conversations(df).first()
    assert r["error"] is None and r["messages"][0]["role"] == "user"


def test_missing_input_raises(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        read_lines(spark, f"{tmp_dir}/nope")


def test_turns_with_null_text_fail_or_quarantine(spark):
    from seqweave.sources.turns import conversations_from_turns

    turns = spark.createDataFrame(
        [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", None), (3, 1, "user", "b"), (3, 0, "system", "a")],
        "conv_id long, turn long, role string, text string")
    good, bad = conversations_from_turns(turns, on_error="quarantine")
    assert sorted(r["conv_id"] for r in good.collect()) == [1, 3]
    assert [m["role"] for m in good.filter("conv_id = 3").first()["messages"]] == ["system", "user"]
    assert [(r["conv_id"], r["error"]) for r in bad.collect()] == [(2, "message without string role and content")]
    with pytest.raises(Exception, match="invalid conversation 2"):
        conversations_from_turns(turns).collect()
