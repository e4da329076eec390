"""Byte-level BPE from a vocabulary file given as a parameter.

The vocabulary is read from a ``tokenizers`` JSON file; the ids are those of that library with
``add_special_tokens=False`` (tests compare them).  With ``added`` the names of the file's added tokens
in a text get their own ids, as the library does with its settings unchanged; without it they are ordinary
text, as with the library's ``encode_special_tokens = True``.  A byte-level BPE merges in the order of its ids
and never across pre-tokens, so whole texts are encoded by ``tiktoken`` with the file's own
vocabulary as ranks, which needs a fraction of the time, and the counts of single pre-tokens are cached.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex
import tiktoken

# fixed value: the pre-token pattern that belongs to the byte-level vocabularies
PRE_TOKEN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _letters() -> dict[str, int]:
    """How the file writes bytes: printable Latin-1 characters as themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _added_tokens(spec: dict) -> dict[str, int]:
    """name -> id of the added tokens; those the split below would not treat as the library does are refused."""
    tokens = spec.get("added_tokens", ())
    for t in tokens:
        if t.get("lstrip") or t.get("rstrip") or t.get("single_word"):
            raise ValueError(f"added token {t['content']!r}: lstrip, rstrip and single_word are not supported")
        if any(u is not t and u["content"].startswith(t["content"]) for u in tokens):
            raise ValueError(f"added token {t['content']!r} is the start of another one")
    return {t["content"]: t["id"] for t in tokens}


@lru_cache(4)
def encoding(path: str, pattern: str = PRE_TOKEN, added: bool = False) -> tiktoken.Encoding:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", ())}
    letters = _letters()
    ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks,
                             special_tokens=_added_tokens(spec) if added else {})


def encode(enc: tiktoken.Encoding, text: str) -> bytes:
    """The ids of a whole text as little-endian unsigned 32-bit integers."""
    if enc.special_tokens_set:
        return np.asarray(enc.encode(text, allowed_special="all", disallowed_special=()), "<u4").tobytes()
    return np.asarray(enc.encode_ordinary(text), "<u4").tobytes()


class PreTokenCounter(dict):
    """pre-token -> its number of tokens; emptied at ``limit`` entries to bound memory."""

    def __init__(self, path: str, pattern: str = PRE_TOKEN, limit: int = 200_000, added: bool = False):
        super().__init__()
        enc = encoding(path, pattern, added)
        self._encode = enc.encode_ordinary
        self.pattern = regex.compile(pattern)
        self.added = enc.special_tokens_set
        self.reach = max(map(len, self.added), default=0)  # characters of the longest added token
        self._split = regex.compile("|".join(map(regex.escape, self.added))) if self.added else None
        self.limit = limit

    def pieces(self, text: str, start: int = 0) -> Iterator[tuple[int, str]]:
        """(start, pre-token) from ``start`` on; an added token is a pre-token and bounds those beside it."""
        while self._split and (m := self._split.search(text, start)):
            for p in self.pattern.finditer(text, start, m.start()):
                yield p.start(), p.group()
            yield m.start(), m.group()
            start = m.end()
        for p in self.pattern.finditer(text, start):
            yield p.start(), p.group()

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        n = 1 if piece in self.added else len(self._encode(piece))
        if len(piece) <= 64:
            self[piece] = n
        return n
