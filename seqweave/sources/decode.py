"""Typed decoder for the few lines the variant parser cannot judge.

A variant value has a size limit and refuses any key that occurs twice, also one that is ignored.  Lines beyond
``LONG_LINE`` bytes and lines the parser refuses therefore come here, one at a time through Arrow, and
this decoder's word is final.  It reads what a typed decoder reads: the list under ``conversation`` or
``conversations``, string ``role`` and ``content`` in each message, every other key ignored, however often it occurs.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LONG_LINE = 1 << 20  # bytes; longer lines skip the variant parser
MAX_LINE = 256 << 20  # bytes; longer lines are refused unread, a task must hold one line

LISTS = ("conversation", "conversations")
FIELDS = ("role", "content")


class _Object(dict):
    """A JSON object with the set of its keys that occur more than once."""

    twice: frozenset = frozenset()


def _object(pairs: list) -> _Object:
    out = _Object(pairs)
    if len(out) < len(pairs):
        keys = [k for k, _ in pairs]
        out.twice = frozenset(k for k in out if keys.count(k) > 1) if len(keys) < 1000 else _repeated(keys)
    return out


def _repeated(keys: list) -> frozenset:
    seen: set = set()
    return frozenset(k for k in keys if k in seen or seen.add(k))


def _no_constant(name: str):
    raise ValueError(name)  # NaN and Infinity are no JSON


_DECODER = json.JSONDecoder(object_pairs_hook=_object, parse_constant=_no_constant)


def decode_line(line: str) -> tuple[list[tuple[str, str]] | None, str | None]:
    """(messages, None) of a good line, (None, reason) of a bad one."""
    if not line.strip(" \t\r\n"):
        return None, "blank line"
    try:
        doc = _DECODER.decode(line)
    except RecursionError:
        return None, "JSON nested too deeply"
    except ValueError:
        return None, "malformed JSON"
    if not isinstance(doc, _Object):
        return None, "missing conversation"
    named = [k for k in LISTS if k in doc]
    if len(named) > 1 or doc.twice.intersection(LISTS):
        return None, "both conversation and conversations" if len(named) > 1 else "conversation given twice"
    if not named:
        return None, "missing conversation"
    messages = doc[named[0]]
    if not isinstance(messages, list):
        return None, "conversation is not a list"
    if not messages:
        return None, "empty conversation"
    out = []
    for m in messages:
        if not isinstance(m, _Object) or not all(isinstance(m.get(f), str) for f in FIELDS):
            return None, "message without string role and content"
        if m.twice.intersection(FIELDS):
            return None, "role or content given twice"
        out.append(tuple(m[f] for f in FIELDS))
    try:
        for pair in out:
            for text in pair:
                text.encode()
    except UnicodeEncodeError:  # half of a surrogate pair, written as an escape
        return None, "malformed JSON"
    return out, None


def decoded(lines: Column) -> Column:
    """Column of ``struct<messages, error, line>`` for a string column (the line itself only if it is bad, so that a good
    long line is not carried along); NULL where the line is NULL."""
    kind = pa.struct([("messages", pa.list_(pa.struct([(f, pa.string()) for f in FIELDS]))), ("error", pa.string()),
                      ("line", pa.string())])

    @F.arrow_udf("messages array<struct<role:string,content:string>>, error string, line string")
    def decode(column: pa.Array) -> pa.Array:
        rows = []
        for line in column:
            messages, error = decode_line(line.as_py()) if line.is_valid else (None, None)
            rows.append({"messages": messages and [dict(zip(FIELDS, m)) for m in messages], "error": error,
                         "line": line.as_py() if error else None} if line.is_valid else None)
        return pa.array(rows, kind)

    return decode(lines)
