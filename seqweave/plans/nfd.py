"""Next-fit-decreasing packing planned from a length histogram.

Bin boundaries of next-fit-decreasing depend only on the multiset of lengths.
Walking the *distinct* lengths (clamped to ``max_length``) in descending order
with the state ``(bin, fill)`` gives, for each length ``L`` with ``n`` rows:

* ``k0``  rows that still go into the open bin ``b0``,
* ``per`` rows of length ``L`` that fill every fresh bin after it.

Row ``r`` (0-based among the rows of that length) then lands in
``b0`` if ``r < k0`` else ``b0 + 1 + (r - k0) // per``.  The walk touches at
most ``max_length`` histogram rows per file, so it is a small bounded step
between two distributed passes over the data.

The plain sequential loop lives in the tests as the oracle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def walk(lengths: np.ndarray, counts: np.ndarray, max_length: int):
    """Plan for one file.  ``lengths`` must be distinct, clamped and descending.

    Returns arrays ``b0, k0, per`` aligned with the input, and ``tail``: the
    last bin that holds a row shorter than ``max_length`` (None if there is
    none).
    """
    m = int(max_length)
    size = len(lengths)
    b0 = np.empty(size, dtype=np.int64)
    k0 = np.empty(size, dtype=np.int64)
    per = np.empty(size, dtype=np.int64)
    b, cur = -1, 0
    tail = None
    for i in range(size):
        length, n = int(lengths[i]), int(counts[i])
        p = max(1, m // length)
        k = 0 if b < 0 else min(n, max(0, (m - cur) // length))
        b0[i], k0[i], per[i] = b, k, p
        rest = n - k
        if rest == 0:
            cur += k * length
        else:
            fresh = -(-rest // p)
            b += fresh
            cur = (rest - (fresh - 1) * p) * length
        if length < m:
            tail = b
    return b0, k0, per, tail


def walk_batches(schema: pa.Schema, keys: list[str], max_length: int, rows_out: int = 20_000):
    """``mapInArrow`` function: many files' histograms in, their plans out.

    The rows come sorted by file and descending length, and a file's histogram may span batches; one file's
    (at most ``max_length`` rows) is held at a time.
    """
    names = [*keys, "_L", "_n"]

    def run(batches):
        out: list[list] = [[] for _ in schema]
        current, lengths, counts = None, [], []

        def close() -> None:
            if not lengths:
                return
            b0, k0, per, tail = walk(np.array(lengths), np.array(counts), max_length)
            n = len(lengths)
            for column, values in zip(out, [*([k] * n for k in current), lengths, counts, b0.tolist(), k0.tolist(),
                                            per.tolist(), [tail] * n], strict=True):
                column += values

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)
            for column in out:
                column.clear()
            return batch

        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
            for *key, length, n in zip(*cols, strict=True):
                if key != current:
                    close()
                    current, lengths, counts = key, [], []
                    if len(out[0]) >= rows_out:
                        yield flush()
                lengths.append(length)
                counts.append(n)
        close()
        yield flush()

    return run
