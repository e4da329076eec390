"""Word vocabulary (build + encode) and the pretrained-file tokenizer."""

import json
import random

import pyarrow as pa
import pytest

from seqweave.functions.tokenizers import PretrainedTokenizer, WordVocabulary, encode_words

TEXTS = [(1, "the cat sat on the mat"), (2, "the dog\tsat\n\non  a log"), (3, "zebra")]


def test_vocab_build_order_and_unknown(spark):
    df = spark.createDataFrame(TEXTS, "k long, prompt string")
    voc = WordVocabulary.build(df, "prompt", size=4)
    rows = [tuple(r) for r in voc.vocab.orderBy("id").collect()]
    assert rows == [("<unk>", 0, 0), ("the", 1, 3), ("on", 2, 2), ("sat", 3, 2)]
    enc = {r["k"]: r["ids"] for r in voc.tokenize(df, "prompt", "ids", ["k"]).collect()}
    assert enc[1] == [1, 0, 3, 2, 1, 0]
    assert enc[3] == [0]


@pytest.mark.parametrize("local_words", [0, 1000])
def test_vocab_encode_keeps_other_columns_and_empty_text(spark, local_words):
    df = spark.createDataFrame([(1, "a b", "x"), (2, "   ", "y"), (3, None, "z"), (3, "", None)], "k long, prompt string, tag string")
    voc = WordVocabulary(WordVocabulary.build(df, "prompt", size=10).vocab, 10, local_words)
    rows = sorted(map(tuple, voc.tokenize(df, "prompt", "ids", ["k"]).collect()), key=repr)
    assert rows == [(1, "x", [1, 2]), (2, "y", []), (3, "z", []), (3, None, [])]
    kept = voc.tokenize(df, "prompt", "ids", ["k"], keep_text=True)
    assert kept.columns == ["k", "prompt", "tag", "ids"] and kept.count() == 4
    assert voc.tokenize(df.limit(0), "prompt", "ids").count() == 0


def test_frequent_word_stays_where_it_is(spark):
    """A third of all words is one word: it meets the vocabulary once per task, and no words are spread out."""
    rng = random.Random(2)
    rows = [(i, " ".join("the" if rng.random() < 0.33 else f"w{rng.randrange(300)}" for _ in range(rng.choice([1, 40, 400]))))
            for i in range(400)]
    df = spark.createDataFrame(rows, "k long, prompt string").repartition(6)
    built = WordVocabulary.build(df, "prompt", size=200)
    ids = {r["token"]: r["id"] for r in built.vocab.collect()}
    want = {k: [ids.get(w, 0) for w in t.split()] for k, t in rows}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for local_words in (0, 1000):
            out = WordVocabulary(built.vocab, 200, local_words).tokenize(df, "prompt", "ids", ["k"])
            assert {r["k"]: r["ids"] for r in out.collect()} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = built.tokenize(df.coalesce(3), "prompt", "ids")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


def test_encode_words_on_slices():
    lists = pa.array([["x"], ["a", "b", "a"], None, [], ["b", "c"]], pa.list_(pa.string())).slice(1)
    out = encode_words(lists, pa.array(["b", "a"]), pa.array([7, 9], pa.int32()))
    assert out.to_pylist() == [[9, 7, 9], [], [], [7, 0]]


def test_pretrained_file_agrees_with_vocab_job(spark, tmp_dir):
    pytest.importorskip("tokenizers")
    df = spark.createDataFrame(TEXTS, "k long, prompt string")
    voc = WordVocabulary.build(df, "prompt", size=6)
    path = f"{tmp_dir}/tokenizer.json"
    with open(path, "w", encoding="utf-8") as fh:
        json.dump({"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
                   "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "decoder": None,
                   "model": {"type": "WordLevel", "unk_token": "<unk>",
                             "vocab": {r["token"]: r["id"] for r in voc.vocab.collect()}}}, fh)
    tok = PretrainedTokenizer(path)
    got = {r["k"]: r["ids"] for r in tok.tokenize(df, "prompt", "ids").collect()}
    want = {r["k"]: r["ids"] for r in voc.tokenize(df, "prompt", "ids", ["k"]).collect()}
    assert got == want
