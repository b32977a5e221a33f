"""Handling texts of an Arrow column a bounded number of characters at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters handled at a time; a longer text is handled alone.
CHARS = 4_000_000


def slices(texts: pa.Array, chars: int = CHARS) -> Iterator[list[str | None]]:
    """Texts in lists of about ``chars`` characters."""
    part, size = [], 0
    for text in texts:
        value = text.as_py()
        part.append(value)
        size += len(value) if value else 1
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def runs(texts: pa.Array, size: int = CHARS) -> Iterator[pa.Array]:
    """Texts in runs of about ``size`` bytes."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64) + 1)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size, "right")))
        yield texts.slice(at, end - at)
        at = end
