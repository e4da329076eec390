"""Linear grouping against sorted suffixes, and removal against all windows compared."""

import random
from collections import Counter

import pytest

from seqweave.llm import suffix_groups as sg


def test_suffix_array_small():
    rng = random.Random(1)
    for trial in range(600):
        text = [rng.randint(0, rng.choice([0, 1, 2, 5])) for _ in range(rng.choice([0, 1, 2, 7, 40, 200]))]
        assert sg.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:]), text
    fib = "abaababaabaababaababaabaababaabaab"
    assert sg.suffix_array(list(map(ord, fib))) == sorted(range(len(fib)), key=lambda i: fib[i:])


def brute(texts, length):
    """Removed byte flags of each text: all windows compared."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        flags = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                flags[i:i + length] = [True] * length
        out.append(flags)
    return data, out


def _texts():
    rng = random.Random(9)
    words = ["ab", "abc", "é", "漢字", "x", "zz top", "lorem", "ipsum"]

    def some(n):
        return " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(n))

    passage, line = some(40), some(9)
    texts = [some(60) for _ in range(6)]
    texts += [some(rng.randint(0, 9)) + passage + some(rng.randint(0, 9)) for _ in range(12)]
    texts += [some(3) + passage[k:k + 90] + some(3) for k in range(0, 60, 7)]
    texts += ["a" * 300, "ab" * 100, "a" * 50 + "b" + "a" * 60, line * 5, "", None, "short", "short"]
    copy = some(80)
    return texts + [copy, copy, copy[:-1] + "!", copy[:100] + "?" + copy[101:]]


@pytest.mark.parametrize("options", [
    {"length": 60, "spread": 20, "step": 8, "shard_symbols": 300},
    {"length": 60, "spread": 40, "step": 16, "broadcast_cores": 0},
    {"length": 60, "spread": 33, "step": 5, "shard_symbols": 1}])
def test_removal(spark, monkeypatch, options):
    texts = _texts()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, key string")
    got = {r._id: r for r in sg.remove_repeats(df.repartition(3), **options).collect()}
    data, flags = brute(texts, options["length"])
    assert len(got) == len(texts)
    for i, (d, f) in enumerate(zip(data, flags)):
        r = got[i]
        assert r.n_bytes == len(d) and r.n_removed == sum(f), (i, texts[i])
        assert bytes(r.kept) == bytes(b for b, x in zip(d, f) if not x)
        assert len(r.spans) == sum(x and not (k and f[k - 1]) for k, x in enumerate(f))


def test_no_core_above_the_shard_is_held_whole(spark, monkeypatch):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(120))
    texts = ["%05d" % rng.randrange(10**5) * 6 + passage + "%05d" % rng.randrange(10**5) * 6 for _ in range(300)]
    texts += [texts[0][:110], texts[1][70:], *_texts()]
    limit, step, decide = 400, 8, sg._decide

    def bounded(step, shard_symbols):
        run = decide(step, shard_symbols)

        def checked(batches):
            size = Counter()

            def counted():
                for b in batches:
                    for h1, h2, left, right, _ in zip(*[c.to_pylist() for c in b.columns], strict=True):
                        size[h1, h2] += len(left) + len(right) + 2
                        assert size[h1, h2] <= limit, "a heavy core meets in one task"
                    yield b
            yield from run(counted())
        return checked

    monkeypatch.setattr(sg, "_decide", bounded)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r._id: r for r in sg.remove_repeats(df, length=60, spread=20, step=step, shard_symbols=limit).collect()}
    data, flags = brute(texts, 60)
    for i, (d, f) in enumerate(zip(data, flags)):
        assert got[i].n_removed == sum(f) and bytes(got[i].kept) == bytes(b for b, x in zip(d, f) if not x), i


def test_long_texts_in_segments(monkeypatch):
    monkeypatch.setattr(sg, "SEGMENT", 50)
    texts = _texts()
    data = [(t or "").encode() for t in texts]
    for d in data:
        parts = sg._segments([d], 30)
        windows = [d[i:i + 30] for i in range(len(d) - 29)]
        assert [p[i:i + 30] for _, _, p in parts for i in range(len(p) - 29)] == windows
        assert all(d[s:s + len(p)] == p for _, s, p in parts)


def test_empty_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "abc " * 40), (1, "abc " * 40), (None, None)], "doc_id long, text string")
    got = sorted(sg.remove_repeats(df, length=40, spread=10, step=4).collect(), key=lambda r: r.n_bytes)
    assert [(r.n_bytes, r.n_removed) for r in got] == [(0, 0), (160, 160), (160, 160)]
    assert sg.remove_repeats(df.limit(0)).count() == 0
