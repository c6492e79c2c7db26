"""Byte and word views of Arrow batches, and the written tables between steps.

Words are maximal runs of bytes other than space and the controls 9 to 13, which in UTF-8 is the same as runs of
such code points.  Hashes are polynomials modulo 2**64 over random codes, finished by a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from bizlens.session import scratch_path

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CODES = np.random.default_rng(71).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2**64)
#: Texts of one vectorised step take this many bytes together; a longer text is a step of its own.
STEP_BYTES = 2_000_000
#: Bytes that are hashed together.
HASHED_BYTES = 1 << 18
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later jobs neither repeat it nor need its executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, one text after the other, and where each starts (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, starts, data = column.buffers()
    starts = np.frombuffer(starts, width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[starts[0]:starts[-1]], starts - starts[0]


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", step_bytes: int = STEP_BYTES):
    """Slices of the batches with at most ``step_bytes`` of text, or one longer text: (slice, bytes, starts)."""
    for batch in batches:
        data, starts = utf8(batch.column(batch.schema.get_field_index(column)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(starts, starts[first] + step_bytes, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            part = data[starts[first]:starts[last]]
            yield batch.slice(first, last - first), part, starts[first:last + 1] - starts[first]
            first = last


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word, and the index of the first word of each text."""
    ink = ~SPACE[data]
    begins, ends = ink.copy(), ink.copy()
    begins[1:] &= ~ink[:-1]
    ends[:-1] &= ~ink[1:]
    at = starts[:-1][starts[:-1] < len(data)]
    begins[at] = ink[at]
    at = starts[1:][starts[1:] > 0] - 1
    ends[at] = ink[at]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return begins, ends, np.searchsorted(begins, starts)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    if n:
        powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


class Rolling:
    """Hashes of any stretch of a sequence of codes: equal stretches have equal hashes."""

    def __init__(self, codes: np.ndarray):
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * _powers(BASE, len(codes)), out=self.sums[1:], dtype=np.uint64)
        self.back = _powers(BASE_INVERSE, len(codes) + 1)

    def spans(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        length = (ends - begins).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mixed((self.sums[ends] - self.sums[begins]) * self.back[begins] + length)

    def windows(self, size: int) -> np.ndarray:
        """Hash of the window that starts at each place, for all places where one fits."""
        n = max(len(self.sums) - size, 0)
        return mixed((self.sums[size:] - self.sums[:n]) * self.back[:n] + np.uint64(size))


def word_hashes(data: np.ndarray, starts: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and the index of the first word of each text.

    Bytes are hashed in pieces of about ``HASHED_BYTES``: a hash does not depend on where its word lies, and the sums over bytes
    take many times the room of the bytes.
    """
    begins, ends, first = word_spans(data, starts)
    found = np.empty(len(begins), np.uint64)
    low = 0
    while low < len(begins):
        at = begins[low]
        high = max(int(np.searchsorted(begins, at + HASHED_BYTES)), low + 1)
        piece = data[at:ends[high - 1]]
        found[low:high] = Rolling(CODES[LOWER[piece]] if lower else CODES[piece]).spans(begins[low:high] - at, ends[low:high] - at)
        low = high
    return found, first


def crossing_free(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows that stay inside their text, and the text of each."""
    lengths = np.maximum(np.diff(first) - size + 1, 0)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + first[:-1][owner]
    return place, owner
