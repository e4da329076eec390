"""Edit-aware token counts: a segment tree over each document's pre-tokens.

A byte-level BPE never merges across pre-tokens, so a document's token count is
the sum over its pre-tokens.  The tree's leaves hold runs of pre-tokens (their
lengths and token counts), its inner nodes the sums of characters and tokens
below them.  An edit walks down to the leaf where it starts, steps back over
the pre-tokens whose match could have looked at the edited text, matches and
encodes again from there until a pre-token starts where an old one started
behind the edit, replaces the old pre-tokens by the new ones and updates the
sums on the paths to the root.  Everything else is untouched.

Matching looks at most two characters past the end of a pre-token (a
contraction, or white space before a word), and a pre-token may end where an
added token starts, hence two characters and the longest added token of context.

Edits of one document apply in order, each to the text the one before left:
at ``start`` (code points, clipped to the text) ``removed`` characters go and
``inserted`` comes in.  NULL edits, NULL fields and an empty list change
nothing; NULL text is empty.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqweave.llm.bpe import PRE_TOKEN, PreTokenCounter
from seqweave.llm.common import chunks
from seqweave.session import ship_package

CONTEXT = 2  # characters a match may look at past its end
LEAF = 64  # pre-tokens in a new leaf; a leaf of four times as many makes the tree be built anew


class TokenTree:
    """Token counts of one text under edits."""

    def __init__(self, text: str, counter: PreTokenCounter):
        self.text, self.counter = text, counter
        self.encoded = 0  # pre-tokens encoded by edits
        pieces = [p for _, p in counter.pieces(text)]
        self._build(list(map(len, pieces)), [counter[p] for p in pieces])

    def _build(self, lens: list[int], counts: list[int]) -> None:
        self.lens = [lens[i:i + LEAF] for i in range(0, len(lens), LEAF)] or [[]]
        self.counts = [counts[i:i + LEAF] for i in range(0, len(counts), LEAF)] or [[]]
        cap = 1
        while cap < len(self.lens):
            cap *= 2
        self.cap = cap
        pad = [0] * (cap - len(self.lens))
        self.chars = [0] * cap + [sum(x) for x in self.lens] + pad
        self.toks = [0] * cap + [sum(x) for x in self.counts] + pad
        for i in range(cap - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.toks[i] = self.toks[2 * i] + self.toks[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.toks[1]

    @property
    def n_pieces(self) -> int:
        return sum(map(len, self.lens))

    def _leaf_at(self, pos: int) -> tuple[int, int]:
        """The leaf that holds the character at ``pos`` and where it starts."""
        i, start = 1, 0
        while i < self.cap:
            i *= 2
            if pos >= start + self.chars[i]:
                start += self.chars[i]
                i += 1
        return i - self.cap, start

    def _refresh(self, leaf: int) -> None:
        i = leaf + self.cap
        self.chars[i], self.toks[i] = sum(self.lens[leaf]), sum(self.counts[leaf])
        i //= 2
        while i:
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.toks[i] = self.toks[2 * i] + self.toks[2 * i + 1]
            i //= 2

    def edit(self, start: int, removed: int, inserted: str) -> None:
        old_n = len(self.text)
        start = min(max(start, 0), old_n)
        end = min(start + max(removed, 0), old_n)
        self.text = self.text[:start] + inserted + self.text[end:]
        # back to the first pre-token that may have looked at what is edited
        leaf, at = 0, 0
        within = 0
        if old_n:
            pos = min(max(start - CONTEXT - self.counter.reach, 0), old_n - 1)
            leaf, at = self._leaf_at(pos)
            while at + self.lens[leaf][within] <= pos:
                at += self.lens[leaf][within]
                within += 1
        # match on until a new start meets an old start behind the edit
        shift = len(inserted) - (end - start)
        new_lens, new_counts = [], []
        old_leaf, old_within, old_at = leaf, within, at
        restart = at
        for s, piece in self.counter.pieces(self.text, restart):
            s -= shift
            if s >= end:
                while old_at < s:
                    old_leaf, old_within, old_at = self._next(old_leaf, old_within, old_at)
                if old_at == s:
                    break
            new_lens.append(len(piece))
            new_counts.append(self.counter[piece])
        else:
            old_leaf, old_within = len(self.lens) - 1, len(self.lens[-1])
        self.encoded += len(new_lens)
        # the old pre-tokens between the two places go
        if old_leaf == leaf:
            self.lens[leaf][within:old_within] = new_lens
            self.counts[leaf][within:old_within] = new_counts
        else:
            self.lens[leaf][within:] = new_lens
            self.counts[leaf][within:] = new_counts
            for k in range(leaf + 1, old_leaf):
                self.lens[k], self.counts[k] = [], []
                self._refresh(k)
            del self.lens[old_leaf][:old_within], self.counts[old_leaf][:old_within]
            self._refresh(old_leaf)
        self._refresh(leaf)
        if len(self.lens[leaf]) > 4 * LEAF:
            self._build([n for x in self.lens for n in x], [n for x in self.counts for n in x])

    def _next(self, leaf: int, within: int, at: int) -> tuple[int, int, int]:
        """The place one pre-token further (past the end: the last leaf's end)."""
        while within >= len(self.lens[leaf]) and leaf + 1 < len(self.lens):
            leaf, within = leaf + 1, 0
        at += self.lens[leaf][within]
        within += 1
        while within >= len(self.lens[leaf]) and leaf + 1 < len(self.lens):
            leaf, within = leaf + 1, 0
        return leaf, within, at


EDIT_TYPE = "array<struct<start:long,removed:long,inserted:string>>"


def edited_counts(docs: DataFrame, tokenizer_path: str, edits: Column, id_col: str = "doc_id",
                  text_col: str = "text", pattern: str = PRE_TOKEN, with_text: bool = False,
                  added: bool = False) -> DataFrame:
    """Per row: ``_id, n_chars, n_pieces, n_tokens`` of the text, ``n_edits``, ``n_encoded`` (pre-tokens
    encoded for the edits), ``n_chars_after, n_pieces_after, n_tokens_after, sha256_after`` and, on
    request, ``text_after``.  ``edits`` is a column of ``EDIT_TYPE``; ``added``: see ``bpe``."""
    ship_package(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
                      edits.cast(EDIT_TYPE).alias("_edits"))
    numbers = ["n_chars", "n_pieces", "n_tokens", "n_edits", "n_encoded", "n_chars_after", "n_pieces_after",
               "n_tokens_after"]

    def run(batches):
        counter = PreTokenCounter(tokenizer_path, pattern, added=added)
        for b in batches:
            texts = b.column(1).to_pylist()
            todo = b.column(2).to_pylist()
            for i, j in chunks(texts, 8_000_000):
                rows, after = [], []
                for text, changes in zip(texts[i:j], todo[i:j], strict=True):
                    tree = TokenTree(text, counter)
                    row = [len(text), tree.n_pieces, tree.n_tokens]
                    changes = [c for c in changes or () if c]
                    for c in changes:
                        tree.edit(c["start"] or 0, c["removed"] or 0, c["inserted"] or "")
                    rows.append([*row, len(changes), tree.encoded, len(tree.text), tree.n_pieces, tree.n_tokens])
                    after.append(tree.text if with_text else hashlib.sha256(tree.text.encode()).hexdigest())
                digest = [hashlib.sha256(t.encode()).hexdigest() for t in after] if with_text else after
                cols = [b.column(0).slice(i, j - i), *[pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                        pa.array(digest)]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(after)] * with_text,
                                                 names=["_id", *numbers, "sha256_after"] + ["text_after"] * with_text)

    kind = dict(src.dtypes)["_id"]
    return src.mapInArrow(run, f"_id {kind}, " + ", ".join(f"{n} long" for n in numbers) + ", sha256_after string"
                          + ", text_after string" * with_text)


def sample_edits(text: Column) -> Column:
    """Three edits per text at places picked by its hash: a deletion, a replacement and an insertion of
    strings taken from the text itself (no edit of an empty text changes more than its one insertion)."""
    body = F.coalesce(text, F.lit(""))
    n = F.char_length(body)

    def place(seed: int) -> Column:
        return F.pmod(F.xxhash64(body, F.lit(seed)), n + 1)

    def bit(seed: int, size: int) -> Column:
        return body.substr((place(seed) + 1).cast("int"), F.lit(size))

    def change(start: Column, removed: int, inserted: Column) -> Column:
        return F.struct(start.cast("long").alias("start"), F.lit(removed).cast("long").alias("removed"),
                        inserted.alias("inserted"))

    return F.array(change(place(1), 17, F.lit("")), change(place(2), 9, bit(3, 23)), change(place(4), 0, bit(5, 40)))
