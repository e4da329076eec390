"""

Every query reads the ``conversations`` turns table of the given scale factor
(whole table, every conversation, whole texts).  Several input files are
emulated by tagging each conversation with ``shard-<conv_id mod 4>``; "one
file" queries tag everything ``conversations``.  Array results are also given
as comma-joined text so both engines hash them the same way.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

# the package sits next to this file; make it importable however this file is loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqweave.__main__ import main as job_command
from seqweave.functions.fields import (
    array_text,
    labels_for,
    length_of,
    position_ids_for,
    truncate_ids,
)
from seqweave.functions.template import ChatTemplate
from seqweave.functions.tokenizers import WordVocabulary
from seqweave.operators.packing import PackSpec, assign_bins
from seqweave.operators.ranking import length_histogram, rank_by_length
from seqweave.plans.job import pack_conversations, pack_job, pack_report, tokenize_conversations
from seqweave.plans.stage import stage_root
from seqweave.sinks.arrow_stream import bin_index, read_bins, read_single_bins
from seqweave.sinks.files import bins_per_part_for, write_lines
from seqweave.sources.jsonl import line_counts, parse_conversations, read_conversations
from seqweave.sources.turns import (
    TURNS_SCHEMA,
    conversations_from_turns,
    read_table,
    shard_of,
    single_file,
)
from seqweave.streaming.continuous import start_continuous_pack

SMOKE_DIR = "/root/testdata/sf0.001"
SHARDS = 4
VOCAB_SIZE = 1000

SECTIONS = ChatTemplate.sections("[BOS]", "[EOS]")
HEADERS = ChatTemplate.headers()


# --------------------------------------------------------------------- helpers
def _conversations(spark: SparkSession, sf_dir: str, sharded: bool) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations", TURNS_SCHEMA)
    tag = shard_of("conv_id", SHARDS) if sharded else single_file()
    return conversations_from_turns(turns, source_file=tag)


def _tokens(spark, sf_dir, sharded, template=SECTIONS, gen=False, tokenizer=None):
    conv = _conversations(spark, sf_dir, sharded)
    return tokenize_conversations(conv, template, tokenizer, "conv_id", ["source_file"], gen)


def _assignment(spark, sf_dir, sharded, spec):
    tokens = _tokens(spark, sf_dir, sharded)
    assigned = assign_bins(tokens, spec, ["source_file"], "conv_id")
    return assigned.select("source_file", "conv_id", "length", "bin")


def _bins(spark, sf_dir, sharded, spec, with_length=True):
    bins = pack_conversations(_tokens(spark, sf_dir, sharded), spec, ["source_file"], "conv_id")
    cols = [
        "source_file", "bin", "n_members",
        array_text("input_ids").alias("input_ids"),
        array_text("labels").alias("labels"),
        array_text("position_ids").alias("position_ids"),
    ]
    if with_length:
        cols.append("length")
    return bins.select(*cols)


def _render(template, gen=False):
    def q(spark, sf_dir):
        conv = _conversations(spark, sf_dir, False)
        return conv.select("conv_id", template.render("messages", gen).alias("prompt"))
    return q


def q_render_headers_odd(spark, sf_dir):
    """Padded texts (trim), every third message a tool's (JSON quoting), generation prompt."""
    conv = _conversations(spark, sf_dir, False)
    odd = F.transform("messages", lambda m, i: F.struct(
        F.when(i % 3 == 2, F.lit("tool")).otherwise(m["role"]).alias("role"),
        F.concat(F.lit(" \t\n"), m["content"], F.lit("<&'\"\n ")).alias("content")))
    return conv.select("conv_id", HEADERS.render(odd, True).alias("prompt"))


# --------------------------------------------------------------------- queries
def q_file_row_counts(spark, sf_dir):
    conv = _conversations(spark, sf_dir, True)
    return conv.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_lines"))


def q_conv_assemble(spark, sf_dir):
    conv = _conversations(spark, sf_dir, False)
    flat = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\u0001")
    return conv.select("conv_id", F.size("messages").alias("n_messages"), flat.alias("messages_text"))


def _json_lines(spark, sf_dir):
    """One JSON line per conversation; even ids use the key ``conversation``,
    odd ids its alias ``conversations`` (exercises the alias)."""
    conv = _conversations(spark, sf_dir, True)
    even = F.pmod(F.col("conv_id"), F.lit(2)) == 0
    doc = F.struct(F.when(even, F.col("messages")).alias("conversation"),
                   F.when(~even, F.col("messages")).alias("conversations"))
    return conv.select("conv_id", "source_file", F.to_json(doc).alias("line"))


def q_conv_alias(spark, sf_dir):
    parsed = parse_conversations(_json_lines(spark, sf_dir))
    key = F.when(F.col("line").startswith('{"conversation":'), F.lit("conversation")).otherwise(F.lit("conversations"))
    chars = F.aggregate("messages", F.lit(0).cast("long"), lambda acc, m: acc + F.length(m["content"]))
    return parsed.select(
        "conv_id", key.alias("key_used"), F.size("messages").alias("n_messages"),
        F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
        chars.alias("content_chars"))


#: kinds of lines by conv_id mod 9: how the line is spoilt (SQL on ``line``) and the reason expected
SPOILT = [
    ("line", None),
    ("concat(line, ' x')", "malformed JSON"),
    ("concat(line, line)", "malformed JSON"),
    ("'  '", "blank line"),
    ("'{\"conversation\":5}'", "conversation is not a list"),
    ("'{\"other\":[]}'", "missing conversation"),
    ("concat('{\"conversation\":[],', substr(to_json(named_struct('conversations', array(line))), 2))",
     "both conversation and conversations"),
    ("'{\"conversations\":[]}'", "empty conversation"),
    ("'{\"conversation\":[{\"role\":\"user\",\"content\":5}]}'", "message without string role and content"),
]


def q_validate_rows(spark, sf_dir):
    kind = "pmod(conv_id, 9)"
    line = "CASE " + " ".join(f"WHEN {kind} = {k} THEN {sql}" for k, (sql, _) in enumerate(SPOILT)) + " END"
    parsed = parse_conversations(_json_lines(spark, sf_dir).withColumn("line", F.expr(line)))
    return parsed.groupBy("source_file", F.coalesce("error", F.lit("valid")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def q_tokenize_codepoint(spark, sf_dir):
    tok = _tokens(spark, sf_dir, False)
    return tok.select("conv_id", "length", array_text("input_ids").alias("input_ids"))


def _vocab(spark, sf_dir):
    conv = _conversations(spark, sf_dir, False)
    prompts = conv.select("conv_id", SECTIONS.render("messages").alias("prompt"))
    return prompts, WordVocabulary.build(prompts, "prompt", VOCAB_SIZE)


def q_vocab_build(spark, sf_dir):
    return _vocab(spark, sf_dir)[1].vocab.select("token", "id", "count")


def q_tokenize_vocab(spark, sf_dir):
    prompts, vocab = _vocab(spark, sf_dir)
    enc = vocab.tokenize(prompts.select("conv_id", "prompt"), "prompt", "input_ids", ["conv_id"])
    return enc.select("conv_id", length_of("input_ids").alias("length"), array_text("input_ids").alias("input_ids"))


def q_tokenize_pretrained(spark, sf_dir):
    """A given vocabulary table (token, id) applied by a shuffle join of each task's distinct words."""
    prompts, built = _vocab(spark, sf_dir)
    vocab = WordVocabulary(built.vocab, VOCAB_SIZE, local_words=0)
    enc = vocab.tokenize(prompts.select("conv_id", "prompt"), "prompt", "input_ids", ["conv_id"])
    return enc.select("conv_id", length_of("input_ids").alias("length"), array_text("input_ids").alias("input_ids"))


def q_pack_words(spark, sf_dir):
    """Packing on word-vocabulary token counts (ties exercise the tie-break)."""
    conv = _conversations(spark, sf_dir, False)
    prompts = conv.select("conv_id", "source_file", SECTIONS.render("messages").alias("prompt"))
    vocab = WordVocabulary.build(prompts, "prompt", VOCAB_SIZE)
    tokens = tokenize_conversations(conv, SECTIONS, vocab, "conv_id", ["source_file"])
    spec = PackSpec(512, "truncate", "keep")
    return assign_bins(tokens, spec, ["source_file"], "conv_id").select("source_file", "conv_id", "length", "bin")


def q_train_fields(spark, sf_dir):
    tok = _tokens(spark, sf_dir, False)
    return tok.select("conv_id", "length", array_text(labels_for("input_ids")).alias("labels"),
                      array_text(position_ids_for("input_ids")).alias("position_ids"))


def q_truncate_rows(spark, sf_dir):
    tok = _tokens(spark, sf_dir, False).withColumn("input_ids", truncate_ids("input_ids", 2048))
    return tok.select("conv_id", length_of("input_ids").alias("length"),
                      array_text("input_ids").alias("input_ids"),
                      array_text(labels_for("input_ids")).alias("labels"))


def q_oversize_rows(spark, sf_dir):
    tok = _tokens(spark, sf_dir, False)
    return tok.filter(F.col("length") >= 4096).select("conv_id", "length")


def q_length_histogram(spark, sf_dir):
    tok = _tokens(spark, sf_dir, True)
    return length_histogram(tok, ["source_file"], "length")


def q_length_rank(spark, sf_dir):
    tok = _tokens(spark, sf_dir, True).select("source_file", "conv_id", "length")
    return rank_by_length(tok, ["source_file"], "conv_id").select("source_file", "conv_id", "length", "rank")


def q_length_rank_ranges(spark, sf_dir):
    tok = _tokens(spark, sf_dir, True).select("source_file", "conv_id", "length")
    ranked = rank_by_length(tok, ["source_file"], "conv_id", rows_per_task=1)
    return ranked.select("source_file", "conv_id", "length", "rank")


# ------------------------------------------------------------ through files
def _written(spark, sf_dir) -> str:
    """The conversations as one JSONL file per shard in the staging folder."""
    src = f"{stage_root(spark)}/lines-{uuid.uuid4().hex}"
    write_lines(_json_lines(spark, sf_dir), src, stem_col="source_file", order_col="conv_id")
    return src


def _array_texts(bins, *more):
    members = F.size(F.filter("position_ids", lambda p: p == 0)).alias("n_members")
    return bins.select(F.col("file_stem").alias("source_file"), "bin", members,
                       *[array_text(c).alias(c) for c in ("input_ids", "labels", "position_ids")], *more)


def _sink(fmt: str, tail: str):
    """Lines -> job -> files of the sink -> rows read back, bins numbered by their place in the files."""
    def q(spark, sf_dir):
        out = f"{stage_root(spark)}/bins-{uuid.uuid4().hex}"
        pack_job(spark, _written(spark, sf_dir), out, SECTIONS, max_length=4096, fmt=fmt, tail=tail)
        if fmt == "parquet":
            return _array_texts(spark.read.parquet(out))
        bins = read_bins(spark, out, bins_per_part_for(4096), fmt)
        return _array_texts(bins, F.size("input_ids").alias("length")) if fmt == "jsonl" else _array_texts(bins)
    return q


def q_sink_overwrite(spark, sf_dir):
    """The output of another job, of other sizes and with parts that do not come again, is replaced as a whole."""
    src, out = _written(spark, sf_dir), f"{stage_root(spark)}/bins-{uuid.uuid4().hex}"
    pack_job(spark, src, out, HEADERS, max_length=300, fmt="arrow", tail="keep")
    pack_job(spark, src, out, SECTIONS, max_length=4096, fmt="arrow", tail="drop")
    return _array_texts(read_bins(spark, out, bins_per_part_for(4096)))


def q_job_command(spark, sf_dir):
    """The command line, one output file per input file."""
    out = f"{stage_root(spark)}/bins-{uuid.uuid4().hex}"
    job_command(["--input", _written(spark, sf_dir), "--output", out, "--max-length", "4096", "--format", "ARROW", "--tail", "drop",
                 "--template", "sections", "--bos", "[BOS]", "--eos", "[EOS]", "--layout", "file"])
    bins = bin_index(spark, out).select("file_stem", "bin")
    return _array_texts(read_single_bins(spark, out, bins))


def q_read_single_bins(spark, sf_dir):
    """Every seventh bin of each file, read through the index without its predecessors."""
    out = f"{stage_root(spark)}/bins-{uuid.uuid4().hex}"
    pack_job(spark, _written(spark, sf_dir), out, SECTIONS, max_length=4096, fmt="jsonl", tail="keep")
    wanted = bin_index(spark, out, "jsonl").filter("bin % 7 = 3").select("file_stem", "bin")
    return _array_texts(read_single_bins(spark, out, wanted, "jsonl"), F.size("input_ids").alias("length"))


def q_read_jsonl(spark, sf_dir):
    conv = read_conversations(spark, _written(spark, sf_dir))
    flat = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\u0001")
    return conv.select(F.col("file_stem").alias("source_file"), F.size("messages").alias("n_messages"),
                       flat.alias("messages_text"))


def q_line_counts(spark, sf_dir):
    return line_counts(spark, _written(spark, sf_dir)).select(F.col("file_stem").alias("source_file"), "n_lines")


def q_stream_pack(spark, sf_dir):
    """Two files a micro-batch; every file's bins are those of the batch job."""
    out = f"{stage_root(spark)}/stream-{uuid.uuid4().hex}"
    query = start_continuous_pack(spark, _written(spark, sf_dir), out, SECTIONS, max_length=4096, fmt="parquet",
                                  tail="drop", max_files_per_trigger=2, available_now=True)
    query.awaitTermination()
    return _array_texts(spark.read.option("basePath", out).parquet(f"{out}/batch=*"))


def q_pack_report(spark, sf_dir):
    spec = PackSpec(4096, "truncate", "drop")
    assigned = assign_bins(_tokens(spark, sf_dir, True), spec, ["source_file"], "conv_id", mark_dropped=True)
    rep = pack_report(assigned, spec, ["source_file"])
    fill = F.expr(f"(packed_tokens * 1000000) div nullif(bins * {spec.max_length}, 0)")
    return rep.select("source_file", "rows", "bins", "input_tokens", "packed_tokens",
                      "truncated_tokens", "dropped_tokens", fill.alias("fill_ppm"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "file_row_counts": q_file_row_counts,
    "conv_assemble": q_conv_assemble,
    "conv_alias": q_conv_alias,
    "validate_rows": q_validate_rows,
    "length_rank_ranges": q_length_rank_ranges,
    "pack_whole_ranges": lambda s, d: _assignment(s, d, False, PackSpec(4096, "own_bin", tokens_per_task=20_000)),
    "render_sections": _render(SECTIONS),
    "render_sections_gen": _render(SECTIONS, True),
    "render_headers": _render(HEADERS),
    "render_headers_odd": q_render_headers_odd,
    "tokenize_codepoint": q_tokenize_codepoint,
    "vocab_build": q_vocab_build,
    "tokenize_vocab": q_tokenize_vocab,
    "tokenize_pretrained": q_tokenize_pretrained,
    "train_fields": q_train_fields,
    "truncate_rows": q_truncate_rows,
    "oversize_rows": q_oversize_rows,
    "length_histogram": q_length_histogram,
    "length_rank": q_length_rank,
    "pack_truncate_keep": lambda s, d: _assignment(s, d, False, PackSpec(8192, "truncate", "keep")),
    "pack_truncate_drop": lambda s, d: _assignment(s, d, False, PackSpec(4096, "truncate", "drop")),
    "pack_whole": lambda s, d: _assignment(s, d, False, PackSpec(4096, "own_bin", "keep")),
    "packed_by_file": lambda s, d: _assignment(s, d, True, PackSpec(2500, "truncate", "keep")),
    "packed_arrow": lambda s, d: _bins(s, d, True, PackSpec(4096, "truncate", "drop"), with_length=False),
    "packed_jsonl": lambda s, d: _bins(s, d, True, PackSpec(4096, "own_bin", "keep")),
    "pack_report": q_pack_report,
    "pack_words": q_pack_words,
    "read_jsonl": q_read_jsonl,
    "line_counts": q_line_counts,
    "sink_arrow": _sink("arrow", "drop"),
    "sink_jsonl": _sink("jsonl", "keep"),
    "sink_parquet": _sink("parquet", "drop"),
    "stream_pack": q_stream_pack,
    "sink_overwrite": q_sink_overwrite,
    "job_command": q_job_command,
    "read_single_bins": q_read_single_bins,
}


# ---------------------------------------------------------------------- oracle
NL = "\n"


def _shard_sql(sharded: bool) -> str:
    return f"'shard-' || CAST(conv_id % {SHARDS} AS VARCHAR)" if sharded else "'conversations'"


def _sections_sql(gen: bool = False) -> str:
    piece = (
        "CASE role "
        f"WHEN 'system' THEN CASE WHEN length(text) > 0 THEN '### System:{NL}' || text || '{NL}{NL}' ELSE '' END "
        f"WHEN 'user' THEN '### User:{NL}' || text || '{NL}{NL}' "
        f"WHEN 'assistant' THEN '### Assistant:{NL}' || text "
        "ELSE '' END"
    )
    body = f"string_agg({piece}, '' ORDER BY turn)"
    if gen:
        body = f"{body} || '### Assistant:{NL}'"
    return f"SELECT conv_id, {body} AS prompt FROM conversations GROUP BY conv_id"


def _headers_sql(turns: str = "conversations", gen: bool = False) -> str:
    trim = "regexp_replace(text, '^\\s+|\\s+$', '', 'g')"
    system = ("'<|start_header_id|>system<|end_header_id|>" + NL + NL +
              "Cutting Knowledge Date: December 2023" + NL + "Today Date: 26 Jul 2024" + NL + NL + "'")
    quoted = "CAST(to_json(text) AS VARCHAR)"
    for char in "<>&'":
        quoted = f"replace({quoted}, chr({ord(char)}), '\\u{ord(char):04x}')"
    tail = f" || '<|start_header_id|>assistant<|end_header_id|>{NL}{NL}'" if gen else ""
    return f"""
WITH t AS (
  SELECT *, first_value(role) OVER (PARTITION BY conv_id ORDER BY turn) AS first_role,
         min(turn) OVER (PARTITION BY conv_id) AS t0
  FROM {turns})
SELECT conv_id,
  '<|begin_of_text|>' || {system}
  || coalesce(max(CASE WHEN turn = t0 AND role = 'system' THEN {trim} END), '') || '<|eot_id|>'
  || coalesce(string_agg(CASE WHEN role = 'tool'
       THEN '<|start_header_id|>ipython<|end_header_id|>{NL}{NL}' || {quoted} || '<|eot_id|>'
       WHEN NOT (turn = t0 AND role = 'system')
       THEN '<|start_header_id|>' || role || '<|end_header_id|>{NL}{NL}' || {trim} || '<|eot_id|>' END,
       '' ORDER BY turn), ''){tail} AS prompt
FROM t GROUP BY conv_id"""


#: the turns of ``render_headers_odd``
ODD_TURNS = """(
  SELECT conv_id, turn, CASE WHEN (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) % 3 = 2 THEN 'tool'
         ELSE role END AS role, ' ' || chr(9) || chr(10) || text || '<&''"' || chr(10) || ' ' AS text
  FROM conversations)"""


def _tokens_sql(sharded: bool) -> str:
    return f"""
SELECT conv_id, {_shard_sql(sharded)} AS source_file, CAST(length(prompt) AS INTEGER) AS length,
       list_transform(string_split(prompt, ''), lambda c: CAST(unicode(c) AS INTEGER)) AS ids
FROM ({_sections_sql()}) r"""


def _word_tokens_sql(sharded: bool) -> str:
    return f"""
SELECT conv_id, {_shard_sql(sharded)} AS source_file,
       CAST(len(list_filter(regexp_split_to_array(prompt, '[ \\t\\n\\f\\r]+'), lambda x: x <> '')) AS INTEGER) AS length
FROM ({_sections_sql()}) r"""


def _walk_sql(sharded: bool, m: int, tokens_sql: str | None = None) -> str:
    """Literal next-fit-decreasing as a recursive CTE; yields (source_file, conv_id, n, l, i, b)."""
    return f"""
tok AS ({tokens_sql or _tokens_sql(sharded)}),
o AS (
  SELECT source_file, conv_id, length AS n, least(length, {m}) AS l,
         row_number() OVER (PARTITION BY source_file ORDER BY least(length, {m}) DESC, length DESC, conv_id) AS i
  FROM tok),
w(source_file, conv_id, n, l, i, b, cur) AS (
  SELECT source_file, conv_id, n, l, i, CAST(0 AS BIGINT), l FROM o WHERE i = 1
  UNION ALL
  SELECT o.source_file, o.conv_id, o.n, o.l, o.i,
         CASE WHEN w.cur + o.l <= {m} THEN w.b ELSE w.b + 1 END,
         CASE WHEN w.cur + o.l <= {m} THEN w.cur + o.l ELSE o.l END
  FROM w JOIN o ON o.source_file = w.source_file AND o.i = w.i + 1),
kept AS (
  SELECT w.* FROM w
  LEFT JOIN (SELECT source_file, max(b) AS tail FROM w WHERE n < {m} GROUP BY source_file) t
    USING (source_file)
  WHERE __KEEP__)"""


def _assign_sql(sharded: bool, m: int, drop: bool, tokens_sql: str | None = None) -> str:
    keep = "t.tail IS NULL OR w.b <> t.tail" if drop else "TRUE"
    return ("WITH RECURSIVE " + _walk_sql(sharded, m, tokens_sql).replace("__KEEP__", keep) +
            "\nSELECT source_file, conv_id, CAST(n AS INTEGER) AS length, b AS bin FROM kept")


def _bins_sql(sharded: bool, m: int, truncate: bool, drop: bool, with_length: bool) -> str:
    keep = "t.tail IS NULL OR w.b <> t.tail" if drop else "TRUE"
    cut = (lambda e: f"{e}[1:{m}]") if truncate else (lambda e: e)
    size = f"least(k.n, {m})" if truncate else "k.n"
    order = "ORDER BY k.l DESC, k.n DESC, k.conv_id"
    length = f", CAST(sum({size}) AS INTEGER) AS length" if with_length else ""
    return ("WITH RECURSIVE " + _walk_sql(sharded, m).replace("__KEEP__", keep) + f"""
SELECT k.source_file, k.b AS bin, CAST(count(*) AS INTEGER) AS n_members,
  string_agg(array_to_string({cut('t2.ids')}, ','), ',' {order}) AS input_ids,
  string_agg(array_to_string([-100] || {cut('t2.ids')}[2:], ','), ',' {order}) AS labels,
  string_agg(array_to_string(range({size}), ','), ',' {order}) AS position_ids{length}
FROM kept k JOIN tok t2 USING (source_file, conv_id)
GROUP BY k.source_file, k.b""")


def _vocab_sql() -> str:
    return f"""
WITH p AS ({_sections_sql()}),
w AS (SELECT unnest(regexp_split_to_array(prompt, '[ \\t\\n\\f\\r]+')) AS token FROM p),
c AS (SELECT token, count(*) AS count FROM w WHERE token <> '' GROUP BY token),
top AS (SELECT token, count FROM c ORDER BY count DESC, token ASC LIMIT {VOCAB_SIZE - 1}),
v AS (
  SELECT '<unk>' AS token, CAST(0 AS INTEGER) AS id, CAST(0 AS BIGINT) AS count
  UNION ALL
  SELECT token, CAST(row_number() OVER (ORDER BY count DESC, token ASC) AS INTEGER), count FROM top)"""


ORACLE: dict[str, str] = {
    "file_row_counts": f"""
SELECT {_shard_sql(True)} AS source_file, count(DISTINCT conv_id) AS n_lines
FROM conversations GROUP BY 1""",
    "conv_assemble": """
SELECT conv_id, CAST(count(*) AS INTEGER) AS n_messages,
       string_agg(role || ':' || text, chr(1) ORDER BY turn) AS messages_text
FROM conversations GROUP BY conv_id""",
    "conv_alias": """
SELECT conv_id, CASE WHEN conv_id % 2 = 0 THEN 'conversation' ELSE 'conversations' END AS key_used,
       CAST(count(*) AS INTEGER) AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles,
       CAST(sum(length(text)) AS BIGINT) AS content_chars
FROM conversations GROUP BY conv_id""",
    "validate_rows": f"""
SELECT {_shard_sql(True)} AS source_file, CASE """ + " ".join(
        f"WHEN conv_id % 9 = {k} THEN '{reason or 'valid'}'" for k, (_, reason) in enumerate(SPOILT)) + """ END AS reason,
       count(DISTINCT conv_id) AS n_rows
FROM conversations GROUP BY 1, 2""",
    "render_sections": _sections_sql(),
    "render_sections_gen": _sections_sql(gen=True),
    "render_headers": _headers_sql(),
    "tokenize_codepoint": f"""
SELECT conv_id, length, array_to_string(ids, ',') AS input_ids FROM ({_tokens_sql(False)}) x""",
    "vocab_build": _vocab_sql() + "\nSELECT token, id, count FROM v",
    "tokenize_vocab": _vocab_sql() + """,
e AS (
  SELECT conv_id, unnest(l) AS token, generate_subscripts(l, 1) AS pos
  FROM (SELECT conv_id, list_filter(regexp_split_to_array(prompt, '[ \\t\\n\\f\\r]+'), lambda x: x <> '') AS l FROM p) s)
SELECT e.conv_id, CAST(count(*) AS INTEGER) AS length,
       string_agg(CAST(coalesce(v.id, 0) AS VARCHAR), ',' ORDER BY e.pos) AS input_ids
FROM e LEFT JOIN v USING (token) GROUP BY e.conv_id""",
    "tokenize_pretrained": _vocab_sql() + """,
e AS (
  SELECT conv_id, unnest(l) AS token, generate_subscripts(l, 1) AS pos
  FROM (SELECT conv_id, list_filter(regexp_split_to_array(prompt, '[ \\t\\n\\f\\r]+'), lambda x: x <> '') AS l FROM p) s)
SELECT e.conv_id, CAST(count(*) AS INTEGER) AS length,
       string_agg(CAST(coalesce(v.id, 0) AS VARCHAR), ',' ORDER BY e.pos) AS input_ids
FROM e LEFT JOIN v USING (token) GROUP BY e.conv_id""",
    "train_fields": f"""
SELECT conv_id, length, array_to_string([-100] || ids[2:], ',') AS labels,
       array_to_string(range(length), ',') AS position_ids
FROM ({_tokens_sql(False)}) x""",
    "truncate_rows": f"""
SELECT conv_id, CAST(least(length, 2048) AS INTEGER) AS length,
       array_to_string(ids[1:2048], ',') AS input_ids,
       array_to_string([-100] || ids[2:2048], ',') AS labels
FROM ({_tokens_sql(False)}) x""",
    "oversize_rows": f"SELECT conv_id, length FROM ({_tokens_sql(False)}) x WHERE length >= 4096",
    "length_histogram": f"""
SELECT source_file, length, count(*) AS n FROM ({_tokens_sql(True)}) x GROUP BY source_file, length""",
    "length_rank": f"""
SELECT source_file, conv_id, length,
       row_number() OVER (PARTITION BY source_file ORDER BY length DESC, conv_id) AS rank
FROM ({_tokens_sql(True)}) x""",
    "pack_truncate_keep": _assign_sql(False, 8192, False),
    "pack_truncate_drop": _assign_sql(False, 4096, True),
    "pack_whole": _assign_sql(False, 4096, False),
    "packed_by_file": _assign_sql(True, 2500, False),
    "packed_arrow": _bins_sql(True, 4096, truncate=True, drop=True, with_length=False),
    "packed_jsonl": _bins_sql(True, 4096, truncate=False, drop=False, with_length=True),
    "pack_report": "WITH RECURSIVE " + _walk_sql(True, 4096).replace("__KEEP__", "TRUE") + """,
tails AS (SELECT source_file, max(b) AS tail FROM w WHERE n < 4096 GROUP BY source_file),
per_bin AS (
  SELECT k.source_file, k.b, count(*) AS r, sum(least(k.n, 4096)) AS tk, sum(k.n) AS inp,
         bool_or(k.b = t.tail) AS lost
  FROM kept k LEFT JOIN tails t USING (source_file) GROUP BY k.source_file, k.b)
SELECT source_file, CAST(sum(r) AS BIGINT) AS rows,
       CAST(sum(CASE WHEN lost THEN 0 ELSE 1 END) AS BIGINT) AS bins,
       CAST(sum(inp) AS BIGINT) AS input_tokens,
       CAST(sum(CASE WHEN lost THEN 0 ELSE tk END) AS BIGINT) AS packed_tokens,
       CAST(sum(inp) - sum(tk) AS BIGINT) AS truncated_tokens,
       CAST(sum(CASE WHEN lost THEN tk ELSE 0 END) AS BIGINT) AS dropped_tokens,
       CAST((sum(CASE WHEN lost THEN 0 ELSE tk END) * 1000000)
            // nullif(sum(CASE WHEN lost THEN 0 ELSE 1 END) * 4096, 0) AS BIGINT) AS fill_ppm
FROM per_bin GROUP BY source_file""",
    "pack_words": _assign_sql(False, 512, False, _word_tokens_sql(False)),
}


# the same results whatever the size at which groups are cut
ORACLE["length_rank_ranges"] = ORACLE["length_rank"]
ORACLE["pack_whole_ranges"] = ORACLE["pack_whole"]
# the same bins through files as in memory
for _name in ("sink_arrow", "sink_parquet", "stream_pack", "sink_overwrite", "job_command"):
    ORACLE[_name] = ORACLE["packed_arrow"]
ORACLE["sink_jsonl"] = ORACLE["packed_jsonl"]
ORACLE["read_single_bins"] = f"SELECT * FROM ({ORACLE['packed_jsonl']}) every_bin WHERE bin % 7 = 3"
ORACLE["render_headers_odd"] = _headers_sql(ODD_TURNS, gen=True)
ORACLE["line_counts"] = ORACLE["file_row_counts"]
ORACLE["read_jsonl"] = f"""
SELECT {_shard_sql(True)} AS source_file, CAST(count(*) AS INTEGER) AS n_messages,
       string_agg(role || ':' || text, chr(1) ORDER BY turn) AS messages_text
FROM conversations GROUP BY conv_id"""


#: the queries of the reference's own operators
CORE = frozenset(QUERIES)


# ------------------------------------------------- training-data queries, if present
try:
    import corpus_pipeline
    from seqweave.llm import queries as _llm
except ModuleNotFoundError as exc:  # the folder may have been removed; anything else is an error
    if not (exc.name or "").startswith(("corpus_pipeline", "seqweave.llm")):
        raise
else:
    QUERIES.update(_llm.QUERIES)
    QUERIES["pipeline"] = corpus_pipeline.run
    ORACLE.update(_llm.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


# ---------------------------------------------------------------- contract API
def entry(spark: SparkSession) -> DataFrame:
    """Flagship: conversations -> sections template -> code points -> packed
    bins (4 files, 4096 tokens, over-long rows truncated), with arrays."""
    spec = PackSpec(4096, "truncate", "keep")
    return pack_conversations(_tokens(spark, SMOKE_DIR, True), spec, ["source_file"], "conv_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
