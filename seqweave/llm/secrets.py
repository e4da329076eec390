"""Secret scan with corpus-wide ownership frequency.

Base rules find assignments, access keys and long hexadecimal runs (see ``RULES``).  Every matched
value is also a candidate, and so is every long token that mixes letters and digits, wherever it
stands.  A shorter token, or one with dots in it, is a candidate if a base rule matches its value somewhere
in the corpus.  Candidate hashes are aggregated over the whole corpus by owner and repository:

* a value that ``example_owners`` or more owners hold is a widely copied example;
* a value that one owner holds in at most ``max_repos`` repositories and that looks live (letters,
  digits and at least ten different characters) is that owner's credential.  Its bare occurrences,
  without any keyword beside them, become spans of the added kind ``owned``.

Positions are code points.  They come from marking the matches: a match is wrapped in U+FFFF (a
character that the text does not hold: its own U+FFFF are read as U+FFFE, which no rule can match),
the text is split there, and a running sum of the pieces' lengths gives the offsets.

Only DataFrame functions are used.  Counting is two-level (value and owner first), so a value held
by a third of all rows is reduced before it meets in one task, and the counts of such values are broadcast back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqweave.llm.common import join_heads

MARK, OTHER = "￿", "￾"
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
TOKEN = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}"
# what an assignment may hold, from its least length on; dots at the end belong to the sentence
SHORT = r"(?<![A-Za-z0-9+/_.=-])(?=[A-Za-z+/_.=-]*[0-9])[A-Za-z0-9+/_.=-]{11,}[A-Za-z0-9+/_=-]"
# fixed values: kind, pattern, group whose length counts, least length; in the order that breaks ties
RULES = [("assign", ASSIGN, 1, 12), ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16)]
KINDS = [k for k, *_ in RULES] + ["owned"]
NEEDS_BASE = len(KINDS)


def _quick(kind: str, pattern: str, least: int) -> str:
    """A pattern with the same passing matches that does not stop at every short run.

    Runs are maximal, so a run too short to pass holds no passing match.  An assignment that fails
    may swallow the start of another one, so its pattern stays as it is.
    """
    return {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}.get(kind, pattern)


def _pieces(text: Column, kind: int, pattern: str) -> Column:
    """``array<struct<kind, no, len, value>>``: alternately text between matches and matches; empty
    where nothing matches."""
    parts = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(MARK + "$0" + MARK)), MARK, -1)
    return F.filter(F.transform(parts, lambda p, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("no"), F.char_length(p).alias("len"),
        F.when(i % 2 == 1, p).alias("value"), F.size(parts).alias("n"))), lambda x: x["n"] > 1)


def candidates(docs: DataFrame, owner_col: str = "source", repo_col: str = "doc_id", id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per passing match and per bare token: ``_row, _id, _key, _owner, _repo, kind`` (index in
    ``KINDS``; one more for a token that needs a base match elsewhere), ``start, end, _value`` (the value's hash) and ``_live`` (whether it looks live)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_key"),
                      F.xxhash64(F.col(owner_col).cast("string")).alias("_owner"),
                      F.xxhash64(F.col(repo_col).cast("string")).alias("_repo"),
                      F.replace(text, F.lit(MARK), F.lit(OTHER)).alias("_text"))
    # the row number tells repeated rows apart; it stays within this one pass over the table
    rows = src.select(F.monotonically_increasing_id().alias("_row"), "*")
    kinds = [(k, _quick(name, pattern, least)) for k, (name, pattern, _, least) in enumerate(RULES)]
    cut = F.concat(*[_pieces(F.col("_text"), k, p) for k, p in [*kinds, (len(RULES), TOKEN), (NEEDS_BASE, SHORT)]])
    keys = ["_row", "_id", "_key", "_owner", "_repo"]
    each = rows.select(*keys, F.explode(cut).alias("_p")).select(*keys, "_p.kind", "_p.no", "_p.len", "_p.value")
    before = Window.partitionBy("_row", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    placed = each.repartition("_row").withColumn("start", F.coalesce(F.sum("len").over(before), F.lit(0)))
    found = placed.filter(F.col("value").isNotNull()).withColumn("end", F.col("start") + F.col("len"))
    # the value is a group of the pattern, run again on the match alone
    value = F.when(F.col("kind") == 0, F.regexp_extract("value", ASSIGN, 1)).otherwise(F.col("value"))
    long = F.lit(True)
    for k, (_, _, _, least) in enumerate(RULES):
        long = F.when(F.col("kind") == k, F.char_length(value) >= least).otherwise(long)
    # a token of the long kind is not a candidate twice
    twice = (F.col("kind") == NEEDS_BASE) & (F.char_length("_v") >= 20) & ~F.contains(F.col("_v"), F.lit("."))
    found = found.withColumn("_v", F.regexp_replace(value, r"\.+$", "")).filter(long & ~twice)
    live = (F.col("_v").rlike("[0-9]") & F.col("_v").rlike("[A-Za-z]")
            & (F.size(F.array_distinct(F.split("_v", ""))) >= 10))
    return found.select(*keys, "kind", "start", "end", F.xxhash64("_v").alias("_value"), live.alias("_live"))


def ownership(found: DataFrame) -> DataFrame:
    """``_value, n_owners, n_repos`` and ``_n`` (rows) over the whole corpus, counted two-level; values that stand
    only where a base match is needed, and have none, are left out."""
    settled = F.max(F.col("kind") != NEEDS_BASE).alias("_settled")
    pairs = found.groupBy("_value", "_owner", "_repo").agg(F.count(F.lit(1)).alias("_n"), settled)
    owners = pairs.groupBy("_value", "_owner").agg(F.count(F.lit(1)).alias("_repos"), F.sum("_n").alias("_n"),
                                                   F.max("_settled").alias("_settled"))
    values = owners.groupBy("_value").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("_repos").alias("n_repos"),
                                          F.sum("_n").alias("_n"), F.max("_settled").alias("_settled"))
    return values.filter("_settled").drop("_settled")


def scan(docs: DataFrame, owner_col: str = "source", repo_col: str = "doc_id", id_col: str = "doc_id",
         text_col: str = "text", example_owners: int = 3, max_repos: int = 8) -> DataFrame:
    """Spans per distinct (id, text) with any: ``_id, _key, spans`` (array of ``start, kind, end, label``
    sorted by start, then kind).  ``label`` is ``example``, ``owner`` or ``unclear``.

    Added spans lie outside every base span.  NULL text is empty; a NULL owner is one owner.
    """
    from seqweave.plans.stage import stage_table

    found, seen = stage_table(candidates(docs, owner_col, repo_col, id_col, text_col), "secrets", {"n": F.count(F.lit(1))})
    label = F.when(F.col("n_owners") >= example_owners, "example").when(
        (F.col("n_owners") == 1) & (F.col("n_repos") <= max_repos) & F.col("_live"), "owner").otherwise("unclear")
    values = stage_table(ownership(found), "owners")
    judged = join_heads(found, values, "_value", int(seen["n"] or 0)).withColumn("label", label)
    judged = judged.withColumn("kind", F.least("kind", F.lit(len(RULES))))
    base = F.col("kind") < len(RULES)
    inside = Window.partitionBy("_row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("_row").orderBy(F.col("start").desc(), F.col("kind").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    # a bare token that a base span overlaps adds nothing
    judged = judged.filter(base | (F.col("label") == "owner"))
    judged = judged.withColumn("_upto", F.max(F.when(base, F.col("end"))).over(inside)).withColumn(
        "_next", F.min(F.when(base, F.col("start"))).over(ahead))
    free = (F.coalesce("_upto", F.lit(0)) <= F.col("start")) & (F.coalesce("_next", F.col("end")) >= F.col("end"))
    spans = judged.filter(base | free).groupBy("_row", "_id", "_key").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", "label"))).alias("spans"))
    return spans.dropDuplicates(["_id", "_key"]).drop("_row")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mask: str = "[secret]", id_col: str = "doc_id", text_col: str = "text",
           **options) -> DataFrame:
    """``docs`` with the spans that are not widely copied examples replaced by ``mask``; overlapping
    spans become one mask.  All columns are kept, NULL text stays NULL."""
    found = scan(docs, id_col=id_col, text_col=text_col, **options).select(
        F.col("_id").alias("_sid"), F.col("_key").alias("_skey"),
        F.filter("spans", lambda s: s["label"] != "example").alias("_spans"))
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(id_col).alias("_id"),
                      F.col(text_col).alias("_text"))
    both = src.join(found, F.col("_id").eqNullSafe(F.col("_sid"))
                    & (F.xxhash64(F.coalesce("_text", F.lit(""))) == F.col("_skey")), "left")
    # one step per span: the text so far and the place it has reached
    step = F.aggregate("_spans", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), lambda a, s: F.struct(
        F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(
            a["out"], F.col("_text").substr((a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mask))).alias("out"),
        F.greatest(a["at"], s["end"]).cast("long").alias("at")))
    new = F.when(F.coalesce(F.size("_spans"), F.lit(0)) > 0, F.concat(
        step["out"], F.col("_text").substr((step["at"] + 1).cast("int"), F.char_length("_text")))).otherwise(F.col("_text"))
    return both.select(*[new.alias(c) if c == text_col else F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
