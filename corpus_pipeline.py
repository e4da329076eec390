"""A filtering and packing pipeline over ``documents``: each stage works on what its predecessor kept.

``STAGES`` lists (name, function) in order; a function takes (spark, docs, sf_dir) and returns the next
documents (the last stage: packed pieces).  ``run`` writes every stage's result to the shared checkpoint
folder and reads it back, so a lost executor never repeats an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqweave.llm import decontam, line_spread, lsh_forest, packing_gga, toxicity
from seqweave.llm.common import table
from seqweave.llm.queries import bpe_path, toxicity_model
from seqweave.plans.stage import stage_table, stages_removed

#: Learnt weights and genetic packing have no SQL; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def _wrapped(docs: DataFrame) -> DataFrame:
    """All columns as one struct beside the id and a key of the text, so no name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                       F.col("doc_id").alias("_wid"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_wkey"))


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``n_chars`` follows a changed text."""
    return docs.select(*[F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
                         else F.col(f"`{c}`") for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more go."""
    keyed = _wrapped(docs)
    scored = toxicity.score_toxicity(docs, toxicity_model(spark, sf_dir, docs)).filter(F.col("score") >= 0.7)
    bad = scored.select(F.col("_id").alias("_bid"), F.col("_key").alias("_bkey"))
    kept = keyed.join(bad, F.col("_wid").eqNullSafe(F.col("_bid")) & (F.col("_wkey") == F.col("_bkey")), "left_anti")
    return kept.select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines spread over ten or more sources and ten or more distinct texts go, whatever their share."""
    return _counted(line_spread.remove_boilerplate(docs), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (0.8 of five-word shingles) stays."""
    return lsh_forest.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their places in sequences."""
    packed = packing_gga.pack(packing_gga.document_pieces(docs, bpe_path(), added=True))
    return packed.select(F.col("_id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with stages_removed(spark):  # a stage's own tables go, its result stays
            docs = stage_table(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"), keep=True)
    return docs
