"""Byte-level BPE encoding and decoding.

Texts are split by the tokenizer's pattern.  The distinct words of a batch of texts are encoded once, by a fold of ranked merges:
words of one length lie side by side as rows of ids, and each step merges in every row the first pair of the lowest rank, which
a constant rank map gives.  A very long word is folded alone, with a heap of its pairs.  Decoding concatenates the binary
pieces of the ids.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
NO_PAIR = 2**31 - 1
#: Words of one batch, whose distinct words are encoded together.
BATCH_WORDS = 1_000_000
#: Cells of one table of words of equal length, and the longest word (in bytes) in such a table.
CELLS, TABLE_BYTES = 1 << 18, 128


@functools.cache
def ranks_of(name: str) -> dict[bytes, int]:
    """Ranks by piece of a file of public_tokenizers, or at a path."""
    import public_tokenizers

    path = name if "/" in name else public_tokenizers.path(name)
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


class Merges:
    """Rank of every mergeable pair of ids (a, b), under the key ``a * 2**32 + b``."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.pairs = {ranks[piece[:i]] << 32 | ranks[piece[i:]]: rank for piece, rank in ranks.items() for i in range(1, len(piece))
                      if piece[:i] in ranks and piece[i:] in ranks}
        self.keys = np.array(sorted(self.pairs), np.int64)
        self.values = np.array([self.pairs[k] for k in self.keys.tolist()], np.int64)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NO_PAIR)

    def fold_table(self, ids: np.ndarray) -> list[np.ndarray]:
        """Ids of words of one length, a row each; a row leaves the table when none of its pairs can be merged."""
        done: list[np.ndarray] = [None] * len(ids)
        row = np.arange(len(ids))
        ranks = self.rank(ids[:, :-1], ids[:, 1:])
        while ids.shape[1] > 1:
            at = ranks.argmin(1)
            low = ranks[np.arange(len(at)), at]
            for k in np.flatnonzero(low == NO_PAIR).tolist():
                done[row[k]] = ids[k]
            alive = low != NO_PAIR
            row, ids, ranks, at, low = row[alive], ids[alive], ranks[alive], at[alive], low[alive]
            if not len(row):
                return done
            line, width = np.arange(len(row)), ids.shape[1]
            ids[line, at] = low
            ids = ids[np.arange(width) != (at + 1)[:, None]].reshape(-1, width - 1)
            ranks = ranks[np.arange(width - 1) != at[:, None]].reshape(-1, width - 2)
            for side, has in ((-1, at > 0), (0, at < width - 2)):
                k, place = line[has], at[has] + side
                ranks[k, place] = self.rank(ids[k, place], ids[k, place + 1])
        for k, r in enumerate(row.tolist()):
            done[r] = ids[k]
        return done

    def fold_long(self, word: bytes) -> np.ndarray:
        """Ids of one word, whose pairs wait in a heap by rank and place."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        ahead, back = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = []

        def offer(i):
            rank = self.pairs.get(ids[i] << 32 | ids[ahead[i]]) if i >= 0 and ahead[i] < len(ids) else None
            if rank is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[ahead[i]]))

        for i in range(len(ids)):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = ahead[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j], ahead[i] = rank, -1, ahead[j]
            if ahead[j] < len(ids):
                back[ahead[j]] = i
            offer(back[i])
            offer(i)
        return np.array([x for x in ids if x >= 0], np.int64)

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word.  A word that is a piece of the vocabulary is that piece, as the library has it."""
        out = [np.array([self.ranks[w]]) if w in self.ranks else None for w in words]
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if out[i] is None:
                by_length.setdefault(len(w), []).append(i)
        for length, places in by_length.items():
            if length > TABLE_BYTES:
                for i in places:
                    out[i] = self.fold_long(words[i])
                continue
            for start in range(0, len(places), CELLS // length):
                part = places[start:start + CELLS // length]
                data = np.frombuffer(b"".join([words[i] for i in part]), np.uint8).reshape(-1, length)
                for i, ids in zip(part, self.fold_table(self.byte_ids[data])):
                    out[i] = ids
        return out


@functools.cache
def merges_of(name: str) -> Merges:
    return Merges(ranks_of(name))


def encode(docs: DataFrame, name: str = VOCABULARY, text_col: str = "text", keep=("doc_id",)) -> DataFrame:
    """Columns ``keep`` with n_tokens, ids_sha256 (of the ids joined by commas), ids (binary, 32-bit each) and decoded (bytes).

    Null and empty texts have no id and decode to nothing.  Equal rows have equal results; an empty table has none.
    """
    import public_tokenizers

    words = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit("(?U)" + public_tokenizers.PATTERN), F.lit(0))
    rows = docs.select(*[F.col(c) for c in keep], words.alias("_words"))
    keep = list(keep)

    def code(batches):
        merges = merges_of(name)
        for batch in batches:
            column = batch.column("_words")
            counts = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.concatenate([[0], np.cumsum(counts)])
            first = 0
            while first < batch.num_rows:
                last = min(max(int(np.searchsorted(total, total[first] + BATCH_WORDS, "right")) - 1, first + 1), batch.num_rows)
                yield coded(batch.slice(first, last - first), counts[first:last].tolist(), merges)
                first = last

    def coded(batch, counts, merges):
        words = batch.column("_words").flatten().cast(pa.string()).dictionary_encode()
        ids = merges.encode([w.encode() for w in words.dictionary.to_pylist()])
        texts = [",".join(map(str, x.tolist())) for x in ids]
        raw = [x.astype("<i4").tobytes() for x in ids]
        decoded = [b"".join([merges.pieces[i] for i in x.tolist()]) for x in ids]
        numbers = words.indices.to_numpy(zero_copy_only=False).tolist()
        at, out = 0, [[], [], [], []]
        for n in counts:
            own = numbers[at:at + n]
            at += n
            packed = b"".join([raw[k] for k in own])
            out[0].append(len(packed) // 4)
            out[1].append(hashlib.sha256(",".join([texts[k] for k in own]).encode()).hexdigest())
            out[2].append(packed)
            out[3].append(b"".join([decoded[k] for k in own]))
        added = [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.string(), pa.binary(), pa.binary()))]
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *added], [*keep, "n_tokens", "ids_sha256", "ids", "decoded"])

    schema = rows.drop("_words").schema.add("n_tokens", "long").add("ids_sha256", "string").add("ids", "binary").add("decoded", "binary")
    return rows.mapInArrow(code, schema)
