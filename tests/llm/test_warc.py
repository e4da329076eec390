"""WARC: round trips at several splits, third-party bytes, broken records."""

import base64
import gzip
import hashlib
import io
import random
import zlib
from collections import Counter

import pytest

from seqweave.llm import warc


def pages(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumn("_row", F.lit("clash")).withColumn("sha1", F.lit(1))


def expected(rows, min_bytes=0):
    ids = {}
    for i, _, html in rows:
        ids.setdefault(html or "", []).append(i)
    out = Counter()
    for html, group in ids.items():
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        group.sort(key=lambda i: (i is None, i))
        for k, i in enumerate(group):
            new = k == 0 or len(data) < min_bytes
            out[i, len(data), digest, "response" if new else "revisit", None if new else group[0]] += 1
    return out


def found(spark, path, split):
    rows = warc.read_warc(spark, path, split).filter("record_type <> 'warcinfo'").collect()
    num = lambda x: None if x is None else int(x)
    return Counter((num(r.row_id), r.payload_bytes, r.payload_digest, r.record_type, num(r.refers_to)) for r in rows)


ROWS = [(1, "http://a/é x", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "u\r\nEvil: 1", None), (4, "u", ""), (None, "u", "<p>one</p>"),
        (5, "u", "WARC/1.1\r\n\r\nContent-Length: 5"), (6, "u", "ü" * 1000), (6, "u", "ü" * 1000), (6, "u", "other"),
        (None, None, None), (-3, "u", "other"), (7, "u", "\x1f\x08 text")]


@pytest.mark.parametrize("min_bytes", [0, 6])
def test_round_trip(spark, tmp_dir, min_bytes):
    rng = random.Random(1)
    rows = ROWS + [(100 + i, f"http://h/{i}", "".join(rng.choices("abcdef <>", k=rng.randrange(3000)))) for i in range(60)]
    rows += [(1000 + i, "copy", "boilerplate page") for i in range(40)]
    warc.write_warc(pages(spark, rows).repartition(4), tmp_dir, min_bytes=min_bytes, file_bytes=4000)
    want = expected(rows, min_bytes)
    for split in (300, 5000, 32 << 20):
        assert found(spark, tmp_dir, split) == want
    texts = Counter(r.payload for r in warc.read_warc(spark, tmp_dir, payload=True).filter("record_type = 'response'").collect())
    assert set(texts) == {(h or "").encode() for _, _, h in rows}


def test_empty_table_and_long_text(spark, tmp_dir):
    warc.write_warc(pages(spark, []), tmp_dir)
    assert warc.read_warc(spark, tmp_dir).count() == 0
    rows = [(1, "u", "".join(random.Random(2).choices("abcdefghij", k=6_000_000))), (2, "u", "b")]
    warc.write_warc(pages(spark, rows), tmp_dir)
    assert found(spark, tmp_dir, 100_000) == expected(rows)


def _records(data, split):
    return [row for s in range(0, len(data), split)
            for row in warc.read_range(io.BytesIO(data), "x", s, min(s + split, len(data)), len(data), True)]


def test_payload_that_is_an_archive_is_one_record():
    def row(i, payload):
        return {"id": i, "url": "u", "payload": payload, "sha1": hashlib.sha1(payload).digest(), "size": len(payload),
                "revisit": False, "refers_to": None}

    inner = b"".join(b"".join(warc.member(warc.record_parts(row(i, random.Random(i).randbytes(50_000)), "d", "m"))) for i in range(4))
    rows = [row(10, inner), row(11, b"x")]
    data = b"".join(b"".join(warc.member(warc.record_parts(r, "d", "m"))) for r in rows)
    for split in (997, 20_000, len(data)):
        got = _records(data, split)
        assert [r[3] for r in got] == ["10", "11"] and got[0][-1] == inner


def test_well_packed_records_in_a_row():
    """Heads and bodies that unpack to more than one step, with other members behind them."""
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdef", k=5)) for _ in range(40)]
    payloads = [" ".join(rng.choices(words, k=n)).encode() for n in (9_000, 11_000, 12_000, 30_000, 1, 0, 200_000, 50)]
    rows = [{"id": i, "url": "u", "payload": p, "sha1": hashlib.sha1(p).digest(), "size": len(p), "revisit": False,
             "refers_to": None} for i, p in enumerate(payloads)]
    data = b"".join(b"".join(warc.member(warc.record_parts(r, "d", "m"))) for r in rows)
    for split in (5000, len(data)):
        assert [r[-1] for r in _records(data, split)] == payloads


def test_other_members_and_broken_records():
    good = b"".join(warc.member([warc._head("metadata", 3, "d", []), b"abc", b"\r\n\r\n"]))
    data = gzip.compress(b"not a record") + good + b"junk \x1f\x8b\x08 junk" + good
    assert [r[2] for r in _records(data, 10)] == ["metadata"] * 2
    with pytest.raises(warc.BrokenRecord):
        _records(good[:-9], 1000)
    with pytest.raises(warc.BrokenRecord):
        _records(b"".join(warc.member([warc._head("metadata", 9, "d", []), b"abc", b"\r\n\r\n"])), 1000)
    flipped = zlib.compressobj(0, zlib.DEFLATED, 31)
    body = warc._head("metadata", 3, "d", [("WARC-Payload-Digest", "sha1:AAAA")]) + b"abc\r\n\r\n"
    with pytest.raises(warc.BrokenRecord):
        _records(flipped.compress(body) + flipped.flush(), 1000)
