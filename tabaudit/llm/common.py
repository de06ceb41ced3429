"""Column expressions and task-side helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The six white-space characters, space and U+0009 to U+000D.
WHITE_SPACE = " \t\n\u000b\f\r"
GAP = "[ \\t-\\r]+"

#: Bytes of text that a task turns into arrays at once.
SLICE_BYTES = 1 << 20


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text: what stands between white space. An empty array without words."""
    inner = F.btrim(text, F.lit(WHITE_SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, GAP))


def word_count(text: Column) -> Column:
    inner = F.btrim(text, F.lit(WHITE_SPACE))
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, GAP))).cast("long")


def squeezed(text: Column) -> Column:
    """The text without its white space."""
    return F.regexp_replace(text, GAP, "")


def require(docs: DataFrame, *names: str) -> DataFrame:
    """Just the named columns, so that further columns can't clash with an operator's own names."""
    return docs.select(*names)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of an Arrow string column; a null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), at


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges with at most ``limit`` bytes of text each, or a single longer row."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop
        start = stop


def mixed(value: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public domain, splitmix64), element by element."""
    value = value ^ (value >> np.uint64(30))
    value = value * np.uint64(0xBF58476D1CE4E5B9)
    value = value ^ (value >> np.uint64(27))
    value = value * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))
