"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text accepts every string that occurs in that text.  A text is parsed
greedily into the longest phrases that the automaton accepts; the language that needs the fewest bits wins.  A phrase costs the
bits that name its place in the sample or, failing that, a byte, so samples need not be equally long.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.llm.text import LOWER, steps

#: Bound of the fitted sample: documents per language, and characters taken from each.
SAMPLE_DOCS, SAMPLE_BYTES = 48, 500
#: A text is parsed in stretches of this many bytes, side by side; a phrase also ends with its stretch.
STRETCH = 1024
LETTER = regex.compile(r"\p{L}")
#: The first letter of a text and what follows, as far as the sample takes it.
FROM_LETTER = rf"(?s)\p{{L}}.{{0,{SAMPLE_BYTES - 1}}}"
#: Bytes as the parser sees them: lower-case letters and the bytes of other scripts; all else is a space.
FOLD = np.full(256, 32, np.uint8)
FOLD[97:123] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)
FOLD = FOLD[LOWER]


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts exactly the substrings of ``text``; state 0 starts."""
    edges, link, length, last = [{}], [-1], [0], 0
    for c in text:
        new = len(edges)
        edges.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = new
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(edges)
                edges.append(dict(edges[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return edges


def parser(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Symbol of each byte, and per state and symbol the next state times two, odd where a new phrase begins.

    Where the automaton has no transition a new phrase begins with that byte, in the state that the start has for
    it; symbol 0 stands for bytes that do not occur in ``text``, each of which is a phrase.
    """
    edges = suffix_automaton(text)
    present = sorted(set(text))
    symbols = np.zeros(256, np.int32)
    symbols[present] = np.arange(1, len(present) + 1)
    table = np.full((len(edges), len(present) + 1), -1, np.int32)
    for state, out in enumerate(edges):
        for c, to in out.items():
            table[state, symbols[c]] = 2 * to
    fresh = np.where(table[0] >= 0, table[0] + 1, 1)
    table = np.where(table >= 0, table, fresh[None, :]).astype(np.int32)
    table[0] = fresh
    return symbols, table


def phrase_bits(size: int) -> float:
    """Bits of a phrase against a sample of ``size`` bytes: one of its places, or one of 256 bytes."""
    return float(np.log2(size + 256))


def phrases(data: np.ndarray, starts: np.ndarray, parsers: list) -> np.ndarray:
    """Phrases of each text (row) under each parser (column)."""
    lengths = np.diff(starts)
    parts = -(-lengths // STRETCH)
    owner = np.repeat(np.arange(len(lengths)), parts)
    begin = starts[:-1][owner] + STRETCH * (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts))
    size = np.minimum(starts[1:][owner] - begin, STRETCH)
    order = np.argsort(-size, kind="stable")
    owner, begin, size = owner[order], begin[order], size[order]
    active = np.searchsorted(-size, -np.arange(STRETCH), "left")
    result = np.zeros((len(lengths), len(parsers)), np.int64)
    folded = FOLD[data]
    for k, (symbols, table, *_) in enumerate(parsers):
        coded, flat, width = symbols[folded], table.ravel(), table.shape[1]
        state, count = np.zeros(len(owner), np.int32), np.zeros(len(owner), np.int32)
        for t in range(int(size[0]) if len(size) else 0):
            n = active[t]
            step = flat[state[:n] * width + coded[begin[:n] + t]]
            count[:n] += step & 1
            state[:n] = step >> 1
        result[:, k] = np.bincount(owner, count, len(lengths)).astype(np.int64)
    return result


def fit_parsers(labelled: DataFrame, text_col: str, lang_col: str, order: Column) -> tuple[list[str], list]:
    """Languages in order and a parser with its bits per phrase for each, from at most ``SAMPLE_DOCS`` documents per language.

    Documents are dealt by ``order`` (a hash) to ``SAMPLE_DOCS`` cells; of each language and cell the one with the lowest
    hash gives ``SAMPLE_BYTES`` characters from its first letter.  Texts without a letter teach nothing, and a language of
    such texts only is not learned.
    """
    cell = F.pmod(order, F.lit(SAMPLE_DOCS))
    text = F.regexp_extract(F.col(text_col), FROM_LETTER, 0)
    sample = (
        labelled.where(F.col(lang_col).isNotNull() & (text != ""))
        .groupBy(F.col(lang_col).alias("lang"), cell.alias("cell"))
        .agg(F.min_by(text, F.struct(order, F.md5(text_col))).alias("text"))
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("cell", "text"))).alias("texts")).orderBy("lang").collect())
    texts = [" ".join(t.text for t in row.texts).encode() for row in sample]
    return [row.lang for row in sample], [(*parser(FOLD[np.frombuffer(t, np.uint8)].tobytes()), phrase_bits(len(t))) for t in texts]


def identify(docs: DataFrame, langs: list[str], parsers: list, text_col: str = "text", keep=("doc_id",)) -> DataFrame:
    """Columns ``keep`` with lang_pred and score, by the fitted parsers.

    A parser without bits per phrase costs one a phrase.  The score is the runner-up's bits over those of both: 0.5 for a
    tie, near 1 for a sure answer, 1 with one language.  Ties go to the first language by code point.  A null text, a text without a letter, or a text where no language was
    learned is ``und`` with score 0.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(parsers)
    narrow = docs.select(*keep, F.col(text_col).alias("_text"))
    fields = [f for f in narrow.schema if f.name != "_text"]
    names = list(langs)
    bits = np.array([p[2] if len(p) > 2 else 1.0 for p in parsers])

    def predict(batches):
        own = shared.value
        for batch, data, starts in steps(batches, "_text", 8_000_000):
            cost = phrases(data, starts, own) * bits
            best = cost.argmin(1) if own else np.zeros(batch.num_rows, int)
            raw = data.tobytes()
            lettered = [bool(own) and LETTER.search(raw[a:b].decode("utf-8", "replace")) is not None for a, b in zip(starts, starts[1:])]
            if len(own) > 1:
                two = np.sort(cost, 1)[:, :2]
                score = two[:, 1] / np.maximum(two.sum(1), 1)
            else:
                score = np.ones(batch.num_rows)
            columns = [batch.column(f.name) for f in fields]
            columns.append(pa.array([names[b] if ok else "und" for b, ok in zip(best, lettered)], pa.string()))
            columns.append(pa.array(np.where(lettered, score, 0.0), pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields] + ["lang_pred", "score"])

    schema = narrow.drop("_text").schema.add("lang_pred", "string").add("score", "double")
    return narrow.mapInArrow(predict, schema)


def longest_matches(text: bytes, against: bytes) -> list[int]:
    """Lengths of the phrases of ``text`` (the plain form of ``phrases`` for one text)."""
    symbols, table = parser(against)
    state, lengths = 0, []
    for c in text:
        step = int(table[state, symbols[c]])
        if step & 1:
            lengths.append(0)
        lengths[-1] += 1
        state = step >> 1
    return lengths
