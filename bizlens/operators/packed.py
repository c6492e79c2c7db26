"""Whole numbers as packed bytes: lists of products, and counted pairs of them on their way to be added up.

A list is sorted, so it is written as differences of 7 bits a byte.  Counted pairs leave a task as one row per part and not one
per pair: sorted by their first product, differences in one plane per byte, compressed.  The part of a pair gives the remainder
of its second product, which therefore is not written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Pairs that a task holds as numbers at once.
HELD_PAIRS = 2_000_000
#: Pairs that are formed in one step.
STEP_PAIRS = 250_000
#: Rows of one batch that leaves a task.
BATCH_ROWS = 100_000
#: Bytes of lists that are unpacked at once, or one longer list.
STEP_BYTES = 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unsigned 64-bit numbers as bytes of 7 bits, low ones first, and where the bytes of each begin (and of the last end)."""
    size = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        size += values >> np.uint64(bits) > 0
    starts = np.concatenate([[0], np.cumsum(size)])
    data = np.zeros(starts[-1], np.uint8)
    for k in range(int(size.max(initial=0))):
        here = np.flatnonzero(size > k)
        low = (values[here] >> np.uint64(7 * k)).astype(np.uint8) & np.uint8(127)
        data[starts[here] + k] = low | (size[here] > k + 1).astype(np.uint8) << np.uint8(7)
    return data, starts


def numbers(data: np.ndarray) -> np.ndarray:
    """The numbers whose bytes :func:`varints` gave."""
    if not len(data):
        return np.zeros(0, np.uint64)
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & np.uint8(127)).astype(np.uint64) << (7 * place).astype(np.uint64), starts)


def pack_lists(columns: list[np.ndarray], starts: np.ndarray) -> pa.Array:
    """One binary value per list; the first column increases within a list, the others are counts.  No list is empty."""
    values = columns[0].astype(np.int64)
    steps = np.zeros(len(values), np.int64)
    steps[1:] = values[1:] - values[:-1]
    first = values[starts[:-1]]
    steps[starts[:-1]] = first << 1 ^ first >> 63
    table = np.stack([steps, *columns[1:]], axis=1).astype(np.int64).view(np.uint64)
    data, at = varints(table.reshape(-1))
    offsets = at[starts * len(columns)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unpack_lists(packed: pa.Array, fields: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns of all lists, one list after the other, and where each list starts."""
    packed = (packed.combine_chunks() if isinstance(packed, pa.ChunkedArray) else packed).cast(pa.binary())
    if not len(packed):
        return [np.zeros(0, np.int64)] * fields, np.zeros(1, np.int64)
    _, offsets, data = packed.buffers()
    offsets = np.frombuffer(offsets, np.int32)[packed.offset:packed.offset + len(packed) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    ended = np.concatenate([[0], np.cumsum(data < 128)])
    starts = ended[offsets - offsets[0]] // fields
    table = numbers(data).view(np.int64).reshape(-1, fields)
    steps = table[:, 0].copy()
    coded = steps[starts[:-1]].view(np.uint64)
    first = (coded >> np.uint64(1)).view(np.int64) ^ -(coded & np.uint64(1)).view(np.int64)
    steps[starts[:-1]] = first
    total = np.cumsum(steps)
    before = total[starts[:-1]] - first
    return [total - np.repeat(before, np.diff(starts)), *(table[:, k].copy() for k in range(1, fields))], starts


def _steps(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``STEP_BYTES`` in a column each, or one row."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * STEP_BYTES / max(1, batch.column(column).nbytes)))
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def baskets(batches: Iterator[pa.RecordBatch], fields: int) -> Iterator[pa.RecordBatch]:
    """(_basket, _share, _list of structs) to (_txn, _share, _size, _packed)."""
    for batch in _steps(batches, "_list"):
        lists = batch.column("_list")
        starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        entries = lists.flatten().flatten()
        columns = [entries[k].to_numpy(zero_copy_only=False) for k in range(fields)]
        order = np.lexsort((columns[0], np.repeat(np.arange(len(lists)), np.diff(starts))))
        packed = pack_lists([c[order] for c in columns], starts)
        size = pa.array(np.diff(starts).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_basket"), batch.column("_share"), size, packed], ["_txn", "_share", "_size", "_packed"])


def entries(batches: Iterator[pa.RecordBatch], fields: int) -> Iterator[pa.RecordBatch]:
    """Packed baskets to rows (_txn, _share, _product, _weight)."""
    for batch in _steps(batches, "_packed"):
        columns, starts = unpack_lists(batch.column("_packed"), fields)
        owner = np.repeat(np.arange(batch.num_rows), np.diff(starts))
        weight = columns[1] if fields > 1 else np.ones(len(owner), np.int64)
        for k in range(0, len(owner), BATCH_ROWS):
            part = slice(k, k + BATCH_ROWS)
            at = pa.array(owner[part])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_txn").take(at), batch.column("_share").take(at), pa.array(columns[0][part]), pa.array(weight[part])],
                ["_txn", "_share", "_product", "_weight"])


def squares(batches: Iterator[pa.RecordBatch], fields: int) -> Iterator[pa.RecordBatch]:
    """Packed baskets to rows (_product, _square, _rows) with sums over the batch."""
    for batch in _steps(batches, "_packed"):
        columns, _ = unpack_lists(batch.column("_packed"), fields)
        product, at, rows = np.unique(columns[0], return_inverse=True, return_counts=True)
        square = rows.astype(np.int64)
        if fields > 1:
            square = np.zeros(len(product), np.int64)
            np.add.at(square, at, columns[1] * columns[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(product), pa.array(square), pa.array(rows.astype(np.int64))], ["_product", "_square", "_rows"])


def blocks(batches: Iterator[pa.RecordBatch], fields: int, block: int) -> Iterator[pa.RecordBatch]:
    """(_txn, _before, _total, _packed) to (_txn, _i, _blocks, _packed): lists cut evenly in lists of at most ``block`` products."""
    for batch in _steps(batches, "_packed"):
        columns, starts = unpack_lists(batch.column("_packed"), fields)
        size = np.diff(starts)
        pieces = -(-size // block)
        owner = np.repeat(np.arange(len(size)), pieces)
        own = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        cuts = np.append(starts[owner] + own * size[owner] // pieces[owner], starts[-1])
        before = batch.column("_before").to_numpy(zero_copy_only=False)[owner]
        at = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_txn").take(at), pa.array((before + own).astype(np.int32)), batch.column("_total").take(at),
             pack_lists(columns, cuts)], ["_txn", "_i", "_blocks", "_packed"])


def _remainder(first: np.ndarray, parts: int) -> np.ndarray:
    """What the first product of a pair adds to its part, so that the pairs of a frequent product go to all parts."""
    return ((first.view(np.uint64) * _MIX >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def added(columns: list[np.ndarray | None]) -> list[np.ndarray]:
    """Distinct pairs in order, with the sum of their counts, of first and second products and counts (ones if None).

    The list is emptied, so its columns are let go as soon as they are read.
    """
    first, second, count = columns
    columns.clear()
    if not len(first):
        return [first, second, np.zeros(0, np.int64)]
    low, high = int(first.min()), int(second.max())
    names = None if high - low < 1 << 32 else np.unique(np.concatenate([first, second]))
    key = (first - low if names is None else np.searchsorted(names, first)).view(np.uint64)
    key <<= np.uint64(32)
    del first
    key |= (second - low if names is None else np.searchsorted(names, second)).view(np.uint64)
    del second
    if count is None:
        key.sort()
    else:
        order = np.argsort(key)
        key, count = key[order], count[order]
        del order
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sums = np.diff(np.append(begin, len(key))) if count is None else np.add.reduceat(count, begin)
    key = key[begin]
    a, b = (key >> np.uint64(32)).view(np.int64), (key & np.uint64(0xFFFFFFFF)).view(np.int64)
    return [a + low, b + low, sums] if names is None else [names[a], names[b], sums]


def _planes(values: np.ndarray) -> tuple[int, bytes]:
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    used = int(np.flatnonzero(planes.any(1)).max(initial=-1)) + 1
    return used, planes[:used].tobytes()


def pack_pairs(first: np.ndarray, second: np.ndarray, count: np.ndarray, parts: int) -> bytes:
    """Ordered pairs of one part as bytes."""
    steps = np.zeros(len(first), np.int64)
    steps[1:] = first[1:] - first[:-1]
    planes = [_planes(values) for values in (steps, second // parts - first // parts, count - 1)]
    head = len(first).to_bytes(5, "little") + int(first[0]).to_bytes(8, "little", signed=True) + bytes(used for used, _ in planes)
    return head + pa.compress(b"".join(body for _, body in planes), codec="zstd", asbytes=True)


def unpack_pairs(data: bytes, part: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, used = int.from_bytes(data[:5], "little"), list(data[13:16])
    body = pa.decompress(data[16:], n * sum(used), codec="zstd", asbytes=True)
    columns, at = [], 0
    for k in used:
        planes = np.zeros((8, n), np.uint8)
        planes[:k] = np.frombuffer(body, np.uint8, n * k, at).reshape(k, n)
        columns.append(np.ascontiguousarray(planes.T).reshape(-1).view("<i8"))
        at += n * k
    first = np.cumsum(columns[0]) + np.int64(int.from_bytes(data[5:13], "little", signed=True))
    second = (columns[1] + first // parts) * parts + (part - _remainder(first, parts)) % parts
    return first, second, columns[2] + 1


def dealt(columns: list[np.ndarray], parts: int) -> pa.RecordBatch:
    """A row (_part, _pairs) per part of ordered pairs and their counts; the list is emptied."""
    first, second, count = columns
    columns.clear()
    part = (_remainder(first, parts) + second % parts) % parts
    order = np.argsort(part.astype(np.uint16 if parts <= 1 << 16 else np.int64), kind="stable")
    first = first[order]
    second = second[order]
    count = count[order]
    found, begin = np.unique(part[order], return_index=True)
    ends = np.append(begin[1:], len(part))
    packed = [pack_pairs(first[i:j], second[i:j], count[i:j], parts) for i, j in zip(begin, ends)]
    return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(packed, pa.binary())], ["_part", "_pairs"])


def _formed(columns: list[np.ndarray], starts: np.ndarray, cells: np.ndarray, weighted: bool, floor: int):
    """Pairs of the lists of each cell, about ``STEP_PAIRS`` at once: within a single list, or of one list with the other."""
    product, square = columns[0], columns[-1].astype(float) if floor > 1 else None
    heads = cells[:-1]
    alone = np.diff(cells) == 1
    met = np.where(alone, heads, heads + 1)
    size = np.diff(starts)
    cell = np.repeat(np.arange(len(heads)), size[heads])
    place = np.arange(len(cell)) - np.repeat(np.cumsum(size[heads]) - size[heads], size[heads])
    left = starts[heads[cell]] + place
    right = starts[met[cell]] + np.where(alone[cell], place + 1, 0)
    many = starts[met[cell] + 1] - right
    upto = np.concatenate([[0], np.cumsum(many)])
    i = 0
    while i < len(left):
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + STEP_PAIRS, "right")) - 1)
        a = np.repeat(left[i:j], many[i:j])
        b = np.arange(len(a)) - np.repeat(upto[i:j] - upto[i] - right[i:j], many[i:j])
        i = j
        if square is not None:
            able = square[a] * square[b] >= float(floor) ** 2 * (1 - 1e-9)
            a, b = a[able], b[able]
        x, y = product[a], product[b]
        yield np.minimum(x, y), np.maximum(x, y), columns[1][a] * columns[1][b] if weighted else None


def pairs(batches: Iterator[pa.RecordBatch], fields: int, weighted: bool, floor: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Rows (_lists: one or two packed lists) to rows (_part, _pairs) with their counted pairs."""
    held, n = [], 0

    def out() -> pa.RecordBatch:
        columns = [np.concatenate(c) if c[0] is not None else None for c in zip(*held)]
        held.clear()
        return dealt(added(columns), parts)

    for batch in _steps(batches, "_lists"):
        lists = batch.column("_lists")
        cells = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        columns, starts = unpack_lists(lists.flatten(), fields)
        for formed in _formed(columns, starts, cells, weighted, floor):
            if n and n + len(formed[0]) > HELD_PAIRS:
                yield out()
                n = 0
            if len(formed[0]):
                held.append(formed)
                n += len(formed[0])
    if held:
        yield out()


def counts(table: pa.Table, parts: int, min_count: int) -> pa.Table:
    """The packed pairs of one part to rows (product_a, product_b, pair_count) with at least ``min_count``."""
    part = table.column("_part")[0].as_py()
    unpacked = [unpack_pairs(data.as_py(), part, parts) for data in table.column("_pairs")]
    first, second, count = added([np.concatenate(c) for c in zip(*unpacked)])
    often = count >= min_count
    found = pa.table({"product_a": first[often], "product_b": second[often], "pair_count": count[often]})
    return pa.Table.from_batches(found.to_batches(max_chunksize=BATCH_ROWS), found.schema)
