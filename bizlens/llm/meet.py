"""Hashes of all texts meet in parts of the hash space.

A task sends, per step of texts and part, the sorted hashes as packed bytes: differences of sorted numbers, one plane per byte, take far
fewer bytes than rows would.  A part is a group of its own, sized by the input, so it fits a task at any input size.  A
hash that a step holds more than once is sent once, so no hash brings a part more entries than there are steps.
"""

from __future__ import annotations

import gc
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.llm.text import stored

#: Characters of input per part.
PART_CHARS = 16_000_000
LEAST_PARTS = 64
LAST_ID = 2**63 - 1


def pack(values: np.ndarray, ordered: bool = True) -> bytes:
    values = values.astype("<u8")
    if ordered and len(values):
        values = np.concatenate([values[:1], np.diff(values)])
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    used = int(np.flatnonzero(planes.any(1)).max(initial=0)) + 1
    body = pa.compress(planes[:used].tobytes(), codec="zstd", asbytes=True) if len(values) else b""
    return len(values).to_bytes(5, "little") + bytes([used]) + body


def unpack(data: bytes, ordered: bool = True) -> np.ndarray:
    n, used = int.from_bytes(data[:5], "little"), data[5]
    planes = np.zeros((8, n), np.uint8)
    if n:
        planes[:used] = np.frombuffer(pa.decompress(data[6:], n * used, codec="zstd", asbytes=True), np.uint8).reshape(used, n)
    values = np.ascontiguousarray(planes.T).reshape(-1).view("<u8")
    return np.cumsum(values, dtype=np.uint64) if ordered else values


def part_count(docs: DataFrame, text_col: str) -> int:
    chars = docs.agg(F.sum(F.length(F.col(text_col)).cast("long"))).first()[0] or 0
    return max(LEAST_PARTS, -(-chars // PART_CHARS))


def part_of(values: np.ndarray, parts: int) -> np.ndarray:
    """Part of each 64-bit hash; increasing with it."""
    return ((values >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def order_id(column: str) -> Column:
    """Ids as they are ordered: null after all others."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def row_key(id_: Column, text: Column) -> Column:
    """What rows of equal id and text have in common; answers meet their row by it, however many rows an id (or no id) has."""
    return F.shiftrightunsigned(F.xxhash64(id_, F.coalesce(text, F.lit(""))), 1)


def lists(owner: np.ndarray, values: np.ndarray, ids: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """One row per id that owns a value: the id and the list of its values."""
    order = np.argsort(owner, kind="stable")
    owner, values = owner[order], values[order]
    new = np.ones(len(owner), bool)
    new[1:] = owner[1:] != owner[:-1]
    begin = np.flatnonzero(new)
    offsets = np.concatenate([begin, [len(owner)]]).astype(np.int32)
    return pa.array(ids[owner[begin]]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64)))


def settle(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored, and the shuffle files of finished steps let go: Spark removes them once the driver has no use for them."""
    result = stored(df, name)
    for _ in range(2):  # listeners still hold the plan while they work off its events
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
        time.sleep(0.5)
    return result
