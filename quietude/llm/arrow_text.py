"""Texts of an Arrow batch as runs of bytes, for vectorised work in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 21


def text_runs(column: pa.Array, run_bytes: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of at most
    ``run_bytes`` together; a longer text is a run of its own. NULL is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + run_bytes, "right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi
