"""Arrow batches cut to a bounded amount of text, so that long texts don't add up in one worker."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at a time; a longer text is alone.
BLOCK_BYTES = 8_000_000


def blocks(batches: Iterator[pa.RecordBatch], *columns: int, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The non-empty batches, sliced so that the texts of a slice have at most ``limit`` bytes, or are of one row."""
    for b in batches:
        if not b.num_rows:
            continue
        size = sum(np.asarray(pc.fill_null(pc.binary_length(b.column(c)), 0)).astype(np.int64) for c in columns)
        if size.sum() <= limit:
            yield b
            continue
        first, held = 0, 0
        for i, n in enumerate(size.tolist()):
            if held and held + n > limit:
                yield b.slice(first, i - first)
                first, held = i, 0
            held += n
        yield b.slice(first)
