"""Words of whole texts, an Arrow column at a time.

A word is a longest run of ASCII letters, ASCII digits and characters beyond ASCII; A to Z are lower-cased and nothing else
is changed.  Every other byte is a space, which leaves all lengths as they are, so one pass over the column's bytes does it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rows of texts worked on at once: the words of a batch take several times the space of its texts.
ROWS = 1000
#: What separates words, once A to Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEPT = frozenset(b"0123456789" + _LOWER.encode()) | frozenset(range(128, 256))
PLAIN = bytes(c + 32 if chr(c) in _UPPER else c if c in _KEPT else 32 for c in range(256))


def words_of(text: Column) -> Column:
    """The words of a text as a Spark array; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), GAP), "")


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one text after another, and the number of words of each text."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, kind)
    held = data[int(at[0]):int(at[-1])].to_pybytes() if data is not None else b""
    plain = pa.Array.from_buffers(texts.type, len(texts), [None, pa.py_buffer((at - at[0]).tobytes()), pa.py_buffer(held.translate(PLAIN))])
    parted = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(plain))
    words = parted.flatten()
    counts = pc.list_value_length(parted).to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.equal(words, "")                # a text without words parts into one empty string
    if pc.any(blank).as_py():
        per_text = np.repeat(np.arange(len(counts)), counts)
        counts = counts - np.bincount(per_text[blank.to_numpy(zero_copy_only=False)], minlength=len(counts))
        words = words.filter(pc.invert(blank))
    return words, counts


def pieces(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)
