"""Regression anchors from FIXTURES §10 on the driver's conversations table
(sections template, generation prompt off, whole table as one file)."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from seqweave.functions.tokenizers import CodePointTokenizer
from seqweave.operators.packing import PackSpec, assign_bins, materialize_bins

ANCHORS = [
    # sf, max, (oversize rows, bins, tokens) for truncate+drop, truncate+keep, own_bin+keep
    ("0.001", 8192, (0, 5, 34171), (0, 6, 40022), (6, 40022)),
    ("0.001", 4096, (1, 12, 38662), (1, 13, 38847), (13, 40022)),
    ("0.01", 8192, (0, 46, 287514), (0, 47, 290407), (47, 290407)),
    ("0.01", 4096, (18, 81, 272027), (18, 82, 274920), (82, 290407)),
]


def _stats(spark, sf, spec):
    tokens = entry._tokens(spark, f"/root/testdata/sf{sf}", False)
    bins = materialize_bins(assign_bins(tokens, spec, ["source_file"], "conv_id"), spec, ["source_file"],
                            late_ids=CodePointTokenizer.ids)
    r = bins.agg(F.count(F.lit(1)).alias("bins"), F.sum("length").alias("tokens"),
                 F.sum(F.when(F.col("n_members") == 1, F.size("input_ids") >= spec.max_length)
                       .otherwise(False).cast("int")).alias("oversize")).first()
    return r["oversize"], r["bins"], r["tokens"]


@pytest.mark.parametrize("sf,m,drop,keep,whole", ANCHORS)
def test_anchor_counts(spark, sf, m, drop, keep, whole):
    if not os.path.exists(f"/root/testdata/sf{sf}/conversations.parquet"):
        pytest.skip("no test data")
    assert _stats(spark, sf, PackSpec(m, "truncate", "drop")) == drop
    assert _stats(spark, sf, PackSpec(m, "truncate", "keep")) == keep
    assert _stats(spark, sf, PackSpec(m, "own_bin", "keep"))[1:] == whole


def test_every_conversation_in_exactly_one_bin(spark):
    sf = "/root/testdata/sf0.01"
    tokens = entry._tokens(spark, sf, True)
    spec = PackSpec(2500)
    assigned = assign_bins(tokens, spec, ["source_file"], "conv_id")
    per_conv = assigned.groupBy("conv_id").count()
    assert per_conv.filter("count <> 1").count() == 0
    assert per_conv.count() == tokens.count()
    loads = assigned.groupBy("source_file", "bin").agg(
        F.sum(F.least("length", F.lit(2500))).alias("load"), F.count(F.lit(1)).alias("n"))
    assert loads.filter("load > 2500").count() == 0
