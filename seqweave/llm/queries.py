"""Registered queries of this folder and their SQL where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqweave.llm import (
    decontam,
    filter_audit,
    importance,
    line_spread,
    lsh_forest,
    packing_gga,
    ppm,
    secrets,
    suffix_groups,
    token_edits,
    toxicity,
    warc,
    winnow,
)
from seqweave.llm.common import crc_fold, table
from seqweave.plans.stage import stage_root


def bpe_path() -> str:
    """The byte-level vocabulary of the public tokenizers folder (a parameter of the operators)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def sha256(text) -> F.Column:
    return F.sha2(text.cast("binary"), 256)


def op1_token_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_edits.edited_counts(docs, bpe_path(), token_edits.sample_edits(F.col("text")),
                                     added=True).withColumnRenamed("_id", "doc_id")


def op2_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = ppm.score_texts(docs, crc_fold(F.col("doc_id"), 5) != 1)
    return scored.select(F.col("_id").alias("doc_id"), (crc_fold(F.col("_id"), 5) == 1).alias("held_out"),
                         "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return suffix_groups.remove_repeats(docs).select(
        F.col("_id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    marks = decontam.scan(docs, table(spark, sf_dir, "benchmark", "item_id", "text")).select(
        F.col("_id").alias("_mid"), F.col("_key").alias("_mkey"), "n_words",
        F.size("_hits").cast("long").alias("n_hit"), F.col("_items"))
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_k"))
    both = rows.join(marks, F.col("doc_id").eqNullSafe(F.col("_mid")) & (F.col("_k") == F.col("_mkey")))
    return both.select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_hit",
                       F.size("_items").cast("long").alias("n_items"),
                       sha256(F.array_join("_items", ",")).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    found = secrets.scan(docs).select(F.col("_id").alias("_sid"), F.col("_key").alias("_skey"), F.col("spans").alias("_s"))
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_k"))
    both = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_sid")) & (F.col("_k") == F.col("_skey")), "left")
    both = both.withColumn("_all", F.coalesce("_s", F.array().cast(both.schema["_s"].dataType)))
    base = F.filter("_all", lambda s: s["kind"] < len(secrets.RULES))

    def n(field, value):
        return F.size(F.filter("_all", lambda s: s[field] == F.lit(value))).cast("long")

    return both.select(
        "doc_id", *[n("kind", k).alias(f"n_{name}") for k, (name, *_) in enumerate(secrets.RULES)],
        sha256(secrets.span_text(base)).alias("base_sha256"), secrets.span_text(F.col("_all")).alias("spans"),
        n("label", "owner").alias("n_owner"), n("label", "example").alias("n_example"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    p = winnow.edited_fingerprints(docs)
    h = winnow.hashes
    return p.select(
        F.col("_id").alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"), sha256(F.col("edited")).alias("edited_sha256"),
        winnow.fingerprint_text(F.col("picks")).alias("fingerprint"),
        winnow.fingerprint_text(F.col("edited_picks")).alias("edited_fingerprint"),
        winnow.likeness(h("picks"), h("edited_picks")).alias("near_edited"),
        winnow.likeness(h("picks"), h("next_picks")).alias("near_next"))


def op7_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    marked = line_spread.mark_boilerplate(docs)
    new = F.coalesce("_new", F.lit(""))
    return marked.select(F.col("_id").alias("doc_id"), F.col("n_lines").cast("long").alias("n_lines"),
                         F.col("n_boilerplate").cast("long").alias("n_boilerplate"),
                         F.col("n_boilerplate").cast("long").alias("n_removed"),
                         F.char_length(new).cast("long").alias("kept_chars"), sha256(new).alias("kept_sha256"))


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> dict[str, float]:
    """Learnt from the labels outside the held-out third."""
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").filter(crc_fold(F.col("doc_id"), 3) != 1)
    return toxicity.collect_model(toxicity.train_toxicity(docs, labels))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = toxicity.score_toxicity(docs, toxicity_model(spark, sf_dir, docs))
    return scored.select(F.col("_id").alias("doc_id"), (crc_fold(F.col("_id"), 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_sentences", "offending")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    packed = packing_gga.pack(packing_gga.document_pieces(docs, bpe_path(), added=True))
    return packed.select(F.col("_id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return lsh_forest.similarity_classes(docs).select(
        F.col("_id").alias("doc_id"), "class_id", "n_links", "text_id")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    drawn = importance.resample(docs, table(spark, sf_dir, "benchmark", "text"))
    return drawn.select(F.col("_id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    path = f"{stage_root(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_warc(pages, path)
    kind = pages.schema["page_id"].dataType
    records = warc.read_warc(spark, path).filter(F.col("record_type") != "warcinfo")
    return records.select(F.col("row_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          F.col("refers_to").cast(kind).alias("refers_to"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return filter_audit.filter_audit(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


QUERIES = {f.__name__: f for f in (
    op1_token_edits, op2_ppm_scores, op3_suffix_dedup, op4_decontamination, op5_secret_scan, op6_winnowing, op7_line_spread,
    op8_toxicity, op9_packing, op10_jaccard_join, op11_importance, op12_warc, op13_filter_audit)}

ORACLE_SQL = {
    "op7_line_spread": """
WITH line AS (
  SELECT doc_id, source, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS no
  FROM documents),
spread AS (
  SELECT trim(line) AS t FROM line WHERE trim(line) <> ''
  GROUP BY 1 HAVING count(DISTINCT coalesce(source, chr(0))) >= 10 AND count(DISTINCT text) >= 10),
marked AS (
  SELECT l.doc_id, l.no, l.line, s.t IS NOT NULL AS hit FROM line l LEFT JOIN spread s ON trim(l.line) = s.t),
per_doc AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (hit) AS n_boilerplate,
         coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT hit), '') AS kept
  FROM marked GROUP BY 1)
SELECT doc_id, n_lines, n_boilerplate, n_boilerplate AS n_removed, length(kept) AS kept_chars, sha256(kept) AS kept_sha256
FROM per_doc""",
    "op4_decontamination": r"""
WITH doc AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM benchmark),
item_at AS (SELECT item_id, w, least(len(w), 10) AS l, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
  FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS g FROM item_at),
doc_at AS (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM doc, (SELECT DISTINCT l FROM win) WHERE len(w) >= l),
hit AS (SELECT d.doc_id, d.i, d.l, win.item_id FROM doc_at d JOIN win ON d.l = win.l
  AND win.g = array_to_string(d.w[d.i:d.i + d.l - 1], ' ')),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + l)) AS p FROM hit) GROUP BY 1),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered ON doc.doc_id = covered.doc_id LEFT JOIN found ON doc.doc_id = found.doc_id""",
    "op12_warc": """
WITH five AS (SELECT list_transform(range(32), lambda i: lpad(bin(i), 5, '0')) AS codes),
p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, n, hex, min(page_id) OVER (PARTITION BY hex) AS head,
         array_to_string(list_transform(string_split(hex, ''), lambda h: lpad(bin(instr('0123456789abcdef', h) - 1), 4, '0')), '') AS bits
  FROM p)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         list_position(five.codes, substr(bits, CAST(5 * i + 1 AS BIGINT), 5)), 1)), '') AS payload_digest,
       CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> head THEN head END AS refers_to
FROM d, five""",
    "op13_filter_audit": r"""
WITH f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
ord AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM f a JOIN f b ON b.x <> a.x JOIN f c ON c.x NOT IN (a.x, b.x)
  JOIN f d ON d.x NOT IN (a.x, b.x, c.x) JOIN f e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
doc AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         [w FOR w IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS w FROM documents),
fails AS (
  SELECT doc_id, part, CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 10 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN length(translate(t, '#$%&*|', '')) < length(t) THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS m FROM doc),
lab AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS g, max(CAST(toxic = 1 AS INTEGER)) AS x FROM labels GROUP BY 1),
cnt AS (SELECT part, m, count(*) AS n, coalesce(sum(g), 0) AS g, coalesce(sum(x), 0) AS x
  FROM fails LEFT JOIN lab USING (doc_id) GROUP BY 1, 2),
step AS (
  SELECT part, m, n, g, x, o, s, substr(o, s, 1) AS f, contains(m, substr(o, s, 1)) AS bad,
         length(translate(substr(o, 1, s - 1), m, '')) < s - 1 AS was, length(translate(substr(o, 1, s), m, '')) < s AS out
  FROM cnt, ord, (SELECT unnest(range(1, 6)) AS s)),
res AS (
  SELECT part, o, s, f, coalesce(sum(n) FILTER (NOT out), 0) AS kept, coalesce(sum(n) FILTER (bad AND NOT was), 0) AS removed,
         coalesce(sum(n) FILTER (bad AND was), 0) AS redundant, coalesce(sum(n) FILTER (m = f), 0) AS unique_fails,
         coalesce(sum(g) FILTER (bad AND NOT was), 0) AS good_lost, coalesce(sum(x) FILTER (bad AND NOT was), 0) AS toxic_lost
  FROM step GROUP BY 1, 2, 3, 4)
SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM res""",
}
