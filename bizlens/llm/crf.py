"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad.  Its evidence is a few shares of its own bytes and words and those of the lines around it;
the chain adds a weight for each pair of neighbouring labels.  The quality of a document is the mean of its lines' marginal
probabilities of being good, weighted by length.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from bizlens.llm.text import CODES, SPACE, Rolling, steps, word_spans

#: Bounds of the fitted sample: labelled documents, and lines of each document, a run of them that begins anywhere in it.
SAMPLE_DOCS, SAMPLE_LINES = 4000, 60
ROUNDS, RATE, DECAY = 300, 0.1, 1e-4
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MARKS = np.zeros(256, bool)
MARKS[list(b"!?")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGITS = np.zeros(256, bool)
DIGITS[48:58] = True
OWN = 12


def line_features(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each line (own, previous line's, next line's, 1), its length, and the first line of each text.

    A text without a byte has one empty line.
    """
    breaks = np.flatnonzero(data == 10)
    empty = np.zeros(len(starts) - 1, np.int64)
    per = np.diff(np.searchsorted(breaks, starts)) + 1
    first = np.concatenate([empty[:0], [0], np.cumsum(per)])
    owner = np.repeat(np.arange(len(per)), per)
    begin = np.empty(len(owner), np.int64)
    begin[first[:-1]] = starts[:-1]
    rest = np.ones(len(owner), bool)
    rest[first[:-1]] = False
    begin[rest] = breaks + 1
    end = np.empty(len(owner), np.int64)
    end[first[1:] - 1] = starts[1:]
    last = np.ones(len(owner), bool)
    last[first[1:] - 1] = False
    end[last] = breaks
    size = end - begin

    def total(mask):
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums[end] - sums[begin]

    rolled = Rolling(CODES[data])
    word_begin, word_end, _ = word_spans(data, starts)
    hashes = rolled.spans(word_begin, word_end)
    same = np.zeros(len(hashes), np.int64)
    same[1:] = hashes[1:] == hashes[:-1]
    from_word, to_word = np.searchsorted(word_begin, begin), np.searchsorted(word_begin, end)
    words = to_word - from_word
    same = np.concatenate([[0], np.cumsum(same)])
    repeated = same[to_word] - same[np.minimum(from_word + 1, to_word)]
    keys = np.stack([owner.astype(np.uint64), rolled.spans(begin, end)])
    order = np.lexsort((np.arange(len(owner)), keys[1], keys[0]))
    again = np.zeros(len(owner), bool)
    again[order[1:]] = (keys[:, order[1:]] == keys[:, order[:-1]]).all(0)
    bytes_, count = np.maximum(size, 1), np.maximum(words, 1)
    ink = size - total(SPACE[data])
    own = np.stack([
        np.minimum(total(SYMBOLS[data]) / bytes_ * 5, 2), np.minimum(total(MARKS[data]) / bytes_ * 5, 2),
        total(UPPER[data]) / bytes_, np.minimum(total(DIGITS[data]) / bytes_ * 5, 2), repeated / count,
        np.log1p(words) / 4, np.minimum(ink / count / 10, 3), (again & (size > 0)) * 1.0, (words < 3) * 1.0,
        (size == 0) * 1.0, (total(SYMBOLS[data]) > 0.02 * bytes_) * 1.0, (total(MARKS[data]) > 0.05 * bytes_) * 1.0], 1)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1]
    before[first[:-1]] = 0
    after[:-1] = own[1:]
    after[first[1:] - 1] = 0
    return np.concatenate([own, before, after, np.ones((len(own), 1))], 1), size, first


def marginals(scores: np.ndarray, first: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per line the probabilities of both labels, per text those of neighbouring labels summed, and log partition sums.

    The chains run side by side, longest first, so a step costs one vector operation for all texts that are that long.
    """
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    start, size = first[:-1][order], lengths[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left")
    left, right = np.zeros_like(scores), np.zeros_like(scores)

    def add(values):  # log of the sum over the first label
        return np.logaddexp(values[:, 0], values[:, 1])

    for t in range(longest):
        at = start[:active[t]] + t
        left[at] = scores[at] + (add(left[at - 1][:, :, None] + pairs) if t else 0)
    for t in range(longest - 2, -1, -1):
        at = start[:active[t + 1]] + t
        right[at] = add((right[at + 1] + scores[at + 1])[:, :, None] + pairs.T)
    ends = first[1:] - 1
    log_sum = np.logaddexp(left[ends, 0], left[ends, 1])
    joint = left + right - np.repeat(log_sum, lengths)[:, None]
    inner = np.ones(len(scores), bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    both = np.exp(left[at - 1][:, :, None] + pairs + (scores[at] + right[at])[:, None, :] - np.repeat(log_sum, lengths)[at][:, None, None])
    return np.exp(joint), both.sum(0), log_sum


def fit(features: np.ndarray, first: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the good label and of neighbouring labels, by likelihood ascent; a line has its document's label."""
    lengths = np.diff(first)
    lines = np.repeat(labels, lengths)
    weight = np.zeros(features.shape[1])
    pairs = np.zeros((2, 2))
    truth = np.zeros((2, 2))
    truth[0, 0] = (lengths - 1)[labels == 0].sum()
    truth[1, 1] = (lengths - 1)[labels == 1].sum()
    moments = [[np.zeros_like(weight)] * 2, [np.zeros_like(pairs)] * 2]
    for k in range(1, ROUNDS + 1):
        scores = np.stack([np.zeros(len(features)), features @ weight], 1)
        found, both, _ = marginals(scores, first, pairs)
        steps_ = [features.T @ (lines - found[:, 1]) / len(lines) - DECAY * weight, (truth - both) / len(lines) - DECAY * pairs]
        for i, (value, step) in enumerate(zip((weight, pairs), steps_)):
            moments[i] = [0.9 * moments[i][0] + 0.1 * step, 0.99 * moments[i][1] + 0.01 * step * step]
            value += RATE * (moments[i][0] / (1 - 0.9**k)) / (np.sqrt(moments[i][1] / (1 - 0.99**k)) + 1e-8)
    return weight, pairs


def quality(data: np.ndarray, starts: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    features, size, first = line_features(data, starts)
    weight, pairs = model
    found, _, _ = marginals(np.stack([np.zeros(len(features)), features @ weight], 1), first, pairs)
    mass = size + 1.0
    good = np.add.reduceat(found[:, 1] * mass, first[:-1]) if len(first) > 1 else np.zeros(0)
    return np.clip(good / np.maximum(np.add.reduceat(mass, first[:-1]), 1) if len(first) > 1 else good, 0, 1)


def fit_quality(docs: DataFrame, labels: DataFrame, usable, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"):
    """Model from at most ``SAMPLE_DOCS`` labelled documents, those with the lowest hashes among the ``usable`` ids.

    Rows without id or label are left out; of several rows of an id one counts.  Without both labels the
    model is none, and every document scores 0.5.
    """
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & usable).select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
    chosen = rows.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_DOCS)
    picked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")

    def lines(batches):
        for batch, data, starts in steps(batches, "_text"):
            features, _, first = line_features(data, starts)
            for i, (a, b) in enumerate(zip(first, first[1:])):
                # a checksum of the text says where the run begins, so all parts of long texts are learned from
                a += crc32(data[starts[i]:starts[i + 1]].tobytes()) % max(b - a - SAMPLE_LINES + 1, 1)
                part = features[a:min(b, a + SAMPLE_LINES)].astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:i + 1], batch.column(1)[i:i + 1], pa.array([part.tobytes()], pa.binary())], ["_id", "_label", "lines"])

    schema = picked.select("_id", "_label").schema.add("lines", "binary")
    sample = picked.select("_id", "_label", "_text").mapInArrow(lines, schema).dropDuplicates(["_id"]).orderBy("_id").collect()
    values = [np.frombuffer(row.lines, np.float32).reshape(-1, 3 * OWN + 1).astype(float) for row in sample]
    targets = np.array([row._label for row in sample])
    if len(set(targets.tolist())) < 2:
        return None
    share = np.concatenate([[0], np.cumsum([len(v) for v in values])])
    return fit(np.concatenate(values), share, targets)


def score_quality(docs: DataFrame, model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 (a column of that name is replaced); null texts score as empty ones."""
    kept = [c for c in docs.columns if c != score_col]
    frame = docs.select(*[F.col(f"`{c}`") for c in kept])

    def scored(batches):
        for batch, data, starts in steps(batches, text_col, 1_000_000):
            score = quality(data, starts, model) if model is not None else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*kept, score_col])

    return frame.mapInArrow(scored, StructType([*frame.schema.fields, StructField(score_col, DoubleType())]))
