"""Training fields, truncate, merge and order (reference unit tests, FIXTURES §2-4)."""

from pyspark.sql import functions as F

from seqweave.functions.fields import labels_for, position_ids_for, truncate_ids, with_training_fields
from seqweave.functions.tokenizers import CodePointTokenizer
from seqweave.operators.packing import PackSpec, assign_bins, materialize_bins


def test_labels_and_positions(spark):
    df = spark.createDataFrame([([5, 6, 7],), ([9],), ([],)], "ids array<int>")
    rows = with_training_fields(df, "ids").collect()
    assert rows[0]["labels"] == [-100, 6, 7] and rows[0]["position_ids"] == [0, 1, 2] and rows[0]["length"] == 3
    assert rows[1]["labels"] == [-100] and rows[1]["position_ids"] == [0]
    assert rows[2]["labels"] == [] and rows[2]["position_ids"] == [] and rows[2]["length"] == 0


def test_truncate(spark):
    df = spark.createDataFrame([([1, 2, 3],)], "ids array<int>")
    r = df.select(truncate_ids("ids", 2).alias("t")).select(
        "t", labels_for("t").alias("l"), position_ids_for("t").alias("p"), F.size("t").alias("n")).first()
    assert (r["t"], r["p"], r["n"]) == ([1, 2], [0, 1], 2)


def test_merge_two_rows_into_one_bin(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], 3), (2, [4, 5, 6], 3)], "k long, input_ids array<int>, length int")
    spec = PackSpec(10)
    b = materialize_bins(assign_bins(df, spec, None, "k"), spec, None).collect()
    assert len(b) == 1
    assert b[0]["input_ids"] == [1, 2, 3, 4, 5, 6]
    assert b[0]["labels"] == [-100, 2, 3, -100, 5, 6]
    assert b[0]["position_ids"] == [0, 1, 2, 0, 1, 2]
    assert b[0]["length"] == 6


def test_pop_order_is_length_descending(spark):
    df = spark.createDataFrame([(1, [1], 1), (2, [2] * 5, 5), (3, [3, 3], 2)], "k long, input_ids array<int>, length int")
    spec = PackSpec(100)
    b = materialize_bins(assign_bins(df, spec, None, "k"), spec, None).first()
    assert b["input_ids"] == [2] * 5 + [3, 3] + [1]
    assert b["position_ids"] == [0, 1, 2, 3, 4, 0, 1, 0]


def test_codepoint_tokenizer(spark):
    df = spark.createDataFrame([("a\U0001F600bé\n",), ("",)], "p string")
    rows = df.select(CodePointTokenizer.ids("p").alias("i"), CodePointTokenizer.length("p").alias("n")).collect()
    assert rows[0]["i"] == [97, 0x1F600, 98, 0xE9, 10] and rows[0]["n"] == 5
    assert rows[1]["i"] == [] and rows[1]["n"] == 0


def test_zero_token_conversation_fails_or_drops(spark):
    import pytest

    from seqweave.functions.template import ChatTemplate
    from seqweave.plans.job import tokenize_conversations

    conv = spark.createDataFrame([(1, [("user", "hi")]), (2, [("system", "")])],
                                 "k long, messages array<struct<role:string,content:string>>")
    with pytest.raises(Exception, match="no tokens: 2"):
        tokenize_conversations(conv, ChatTemplate.sections(), None, "k").collect()
    kept = tokenize_conversations(conv, ChatTemplate.sections(), None, "k", zero_tokens="drop").collect()
    assert [(r["k"], r["length"]) for r in kept] == [(1, 14)]
