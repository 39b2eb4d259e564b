"""Arrow batches in pieces."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa


def parts(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches in smaller pieces, so that a task holds few texts as Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
