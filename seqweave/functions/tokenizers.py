"""Tokenizers: text column -> ``array<int>`` of token ids.

Three strategies share one interface, ``tokenize(df, text_col, out_col, key_cols)``:

* ``CodePointTokenizer``: one id per Unicode code point.  Pure column
  expression (``split`` + ``ascii``), exact and vocabulary free.
* ``WordVocabulary``: a corpus-scale vocabulary job (explode, count, top-N)
  and an encoder that looks up the distinct words of each block of rows.
* ``PretrainedTokenizer``: a ``tokenizer.json`` file loaded once per Python
  worker and applied to Arrow batches (pandas UDF).  Optional dependency.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Fixed value: ASCII whitespace class used to split words.
WORD_SPLIT = r"[ \t\n\f\r]+"
UNKNOWN_TOKEN = "<unk>"


class CodePointTokenizer:
    """Token id = Unicode code point of each character."""

    name = "codepoint"

    @staticmethod
    def ids(text: Column | str) -> Column:
        text = F.col(text) if isinstance(text, str) else text
        # split(x, '') returns [''] for an empty string; keep it empty instead.
        return F.when(F.length(text) == 0, F.array().cast("array<int>")).otherwise(
            F.transform(F.split(text, ""), lambda ch: F.ascii(ch))
        )

    @staticmethod
    def length(text: Column | str) -> Column:
        """Token count without building the array (Spark counts code points)."""
        text = F.col(text) if isinstance(text, str) else text
        return F.length(text).cast("int")

    @staticmethod
    def head(text: Column | str, n: int) -> Column:
        """Text whose tokens are the first ``n`` tokens of ``text``."""
        text = F.col(text) if isinstance(text, str) else text
        return F.substring(text, 1, n)

    def tokenize(self, df: DataFrame, text_col: str = "prompt", out_col: str = "input_ids",
                 key_cols: list[str] | None = None) -> DataFrame:
        return df.withColumn(out_col, self.ids(text_col))


def words(text: Column | str) -> Column:
    """Non-empty whitespace-separated words of a text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(text, WORD_SPLIT), lambda w: w != F.lit(""))


class WordVocabulary:
    """Frequency-ranked word vocabulary; id 0 is reserved for unknown words."""

    name = "words"
    LOCAL_WORDS = 1_000_000
    LOCAL_BYTES = 64 << 20

    def __init__(self, vocab: DataFrame, size: int, local_words: int | None = None):
        self.vocab = vocab
        self.size = size
        self.local_words = self.LOCAL_WORDS if local_words is None else local_words

    @classmethod
    def build(cls, df: DataFrame, text_col: str = "prompt", size: int = 32000,
              stage: bool = True) -> WordVocabulary:
        """Count every word of every text and keep the ``size - 1`` most frequent.

        Counting is a partial+final hash aggregation; the top-N is a bounded
        ``TakeOrderedAndProject`` and numbering happens on those N rows only.
        Ties on count are broken by the word itself so ids are deterministic.
        The vocabulary (at most ``size`` rows) is staged in the checkpoint
        folder, so encoding does not recount the corpus.
        """
        counts = (
            df.select(F.explode(words(text_col)).alias("token"))
            .groupBy("token")
            .agg(F.count(F.lit(1)).alias("count"))
        )
        if stage:
            # the corpus is scanned once; threshold and top-N read the word counts
            from seqweave.plans.stage import stage_table

            counts = stage_table(counts, "word-counts")
        top = counts.filter(F.col("count") >= F.lit(cls._count_threshold(counts, size - 1)))
        top = top.orderBy(F.col("count").desc(), F.col("token").asc()).limit(size - 1)
        order = Window.orderBy(F.col("count").desc(), F.col("token").asc())
        numbered = top.select(
            "token", F.row_number().over(order).cast("int").alias("id"), "count"
        )
        unk = df.sparkSession.createDataFrame([(UNKNOWN_TOKEN, 0, 0)], "token string, id int, count bigint")
        vocab = unk.unionByName(numbered)
        if stage:
            vocab = stage_table(vocab.coalesce(1), "vocabulary")
        return cls(vocab, size)

    @staticmethod
    def _count_threshold(counts: DataFrame, k: int) -> int:
        """Smallest count a top-``k`` word can have (the k-th largest count).

        Found from the histogram of counts (one row per distinct count value,
        at most about sqrt(2 * words) rows), so the final ordered limit sees
        about ``k`` candidates instead of ``k`` per partition.
        """
        hist = counts.groupBy("count").agg(F.count(F.lit(1)).alias("_words"))
        running = Window.orderBy(F.col("count").desc()).rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("_cum", F.sum("_words").over(running))
        row = hist.filter(F.col("_cum") >= k).agg(F.max("count").alias("c")).first()
        return int(row["c"]) if row and row["c"] is not None else 0

    def tokenize(self, df: DataFrame, text_col: str = "prompt", out_col: str = "input_ids",
                 key_cols: list[str] | None = None, keep_text: bool = False) -> DataFrame:
        """All columns of ``df`` but the text (kept with ``keep_text``), with the ids of its words.

        A word is looked up once per block of rows, however often it occurs there, and rows stay where they are, so
        neither a frequent word nor a long text is spread out.  A vocabulary within
        ``LOCAL_WORDS`` words and ``LOCAL_BYTES`` bytes (counted first) goes to the tasks and a block is an Arrow
        batch; for a larger one a block is a writing task of the staged rows, and only its distinct words
        meet the vocabulary by shuffle.
        """
        size = self.vocab.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("token")).alias("b")).first()
        if int(size["n"]) <= self.local_words and int(size["b"] or 0) <= self.LOCAL_BYTES:
            return self._tokenize_local(df, text_col, out_col, keep_text)
        return self._tokenize_joined(df, text_col, out_col, keep_text)

    @staticmethod
    def _columns(df, text_col, out_col, keep_text):
        return [c for c in df.columns if c != out_col and (keep_text or c != text_col)]

    def _tokenize_local(self, df, text_col, out_col, keep_text):
        from seqweave.session import ship_package

        ship_package(df.sparkSession)
        rows = self.vocab.select("token", "id").collect()  # bounded, see tokenize
        shared = df.sparkSession.sparkContext.broadcast(([r["token"] for r in rows], [r["id"] for r in rows]))

        @F.arrow_udf("array<int>")
        def encode(column: pa.Array) -> pa.Array:
            return encode_words(column, *_arrays(shared))

        ids = F.coalesce(encode(words(text_col)), F.array().cast("array<int>"))
        return df.withColumn(out_col, ids).select(*self._columns(df, text_col, out_col, keep_text), out_col)

    def _tokenize_joined(self, df, text_col, out_col, keep_text):
        from seqweave.plans.stage import stage_parts
        from seqweave.session import ship_package

        ship_package(df.sparkSession)
        cols = self._columns(df, text_col, out_col, keep_text)
        staged = stage_parts(df.select(*cols, F.coalesce(words(text_col), F.array().cast("array<string>")).alias("_words")), "words")
        # a task's distinct words: a frequent word comes once from each task
        asked = staged.select(F.col("_part").alias("_block"), F.explode(F.array_distinct("_words")).alias("token")).distinct()
        known = asked.join(self.vocab.select("token", "id"), "token").select("_block", "token", "id")
        schema = df.select(*cols).schema.add(out_col, T.ArrayType(T.IntegerType()))
        arrow = to_arrow_schema(schema)

        def encode(texts: pa.Table, vocab: pa.Table) -> pa.Table:
            tokens, ids = vocab.column("token").combine_chunks(), vocab.column("id").combine_chunks()
            lists = encode_words(texts.column("_words").combine_chunks(), tokens, ids)
            return pa.table([*(texts.column(c) for c in cols), lists], names=[*cols, out_col]).cast(arrow)

        return staged.groupBy("_part").cogroup(known.groupBy("_block")).applyInArrow(encode, schema)


def encode_words(lists: pa.Array, tokens: pa.Array, ids: pa.Array) -> pa.Array:
    """Lists of words to lists of ids (0: not among ``tokens``); each distinct word is looked up once."""
    import pyarrow.compute as pc

    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lists = lists.cast(pa.list_(pa.string()))
    distinct = lists.flatten().dictionary_encode()
    found = pc.fill_null(pc.take(ids, pc.index_in(distinct.dictionary, value_set=tokens)), 0).cast(pa.int32())
    sizes = pc.fill_null(pc.list_value_length(lists), 0)
    ends = pc.cumulative_sum(sizes)
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends.cast(pa.int32())])
    return pa.ListArray.from_arrays(offsets, pc.take(found, distinct.indices))


_VOCAB_CACHE: dict[int, tuple] = {}


def _arrays(shared) -> tuple:
    """The broadcast vocabulary as Arrow arrays, made once per worker."""
    key = id(shared.value)
    if key not in _VOCAB_CACHE:
        _VOCAB_CACHE.clear()
        tokens, ids = shared.value
        _VOCAB_CACHE[key] = shared.value, pa.array(tokens, pa.string()), pa.array(ids, pa.int32())
    return _VOCAB_CACHE[key][1:]


_WORKER_CACHE: dict[str, object] = {}


class PretrainedTokenizer:
    """A ``tokenizer.json`` applied per Arrow batch, loaded once per worker.

    The JSON text travels with the function, so executors need no shared path.
    Special tokens are not added (bos/eos come from the chat template).
    """

    name = "pretrained"

    def __init__(self, path: str | None = None, json_text: str | None = None):
        if json_text is None:
            if path is None:
                raise ValueError("give a tokenizer.json path or its text")
            with open(path, encoding="utf-8") as fh:
                json_text = fh.read()
        self.json_text = json_text
        self.digest = hashlib.sha256(json_text.encode("utf-8")).hexdigest()

    def _udf(self):
        json_text, digest = self.json_text, self.digest

        @F.pandas_udf(T.ArrayType(T.IntegerType()))
        def encode(texts):
            import numpy as np
            import pandas as pd

            tok = _WORKER_CACHE.get(digest)
            if tok is None:
                from tokenizers import Tokenizer

                tok = Tokenizer.from_str(json_text)
                _WORKER_CACHE[digest] = tok
            batch = tok.encode_batch(texts.tolist(), add_special_tokens=False)
            return pd.Series([np.asarray(e.ids, dtype=np.int32) for e in batch])

        return encode

    def tokenize(self, df: DataFrame, text_col: str = "prompt", out_col: str = "input_ids",
                 key_cols: list[str] | None = None) -> DataFrame:
        from seqweave.session import ship_package

        ship_package(df.sparkSession)
        return df.withColumn(out_col, self._udf()(F.col(text_col)))
