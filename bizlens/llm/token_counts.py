"""Token counts of texts under a public tokenizer file, with huge texts encoded in overlapping chunks.

A huge text is cut into cores of equal length.  Each core is encoded by the library together with an overlap on both sides.
Two neighbours are spliced at a common boundary: a place in their overlap where both encodings begin a token and where a space or
line feed follows a character that is no white space.  The tokenizer's pattern ends a piece there whatever
comes before or after, so both encodings agree from there on.  Where an overlap has no such place, the text is cut again
with wider overlaps, at last whole.

Of other texts the library encodes the pieces between such places, each distinct piece of a task once.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.llm.text import stored

HUGE_CHARS, CORE_CHARS, OVERLAP_CHARS = 32_768, 8_192, 128
#: Distinct pieces that a task remembers.
REMEMBERED = 1_000_000
PIECE = re.compile(r"\s*\S+|\s+")
STABLE = re.compile(r"(?<=\S)[ \n]")
#: Controls that are white space here but not for every library: such texts are encoded as they are.
DOUBTFUL = re.compile("[\x1c-\x1f\x85]|\\S[^\\S \n]")
_LOADED: dict[str, object] = {}


def load(name: str):
    """The tokenizer of a file of public_tokenizers, or at a path, once per process."""
    if name not in _LOADED:
        import os

        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[name] = Tokenizer.from_file(name if "/" in name else public_tokenizers.path(name))
    return _LOADED[name]


def encode(name: str, texts: list[str]):
    return load(name).encode_batch(texts, add_special_tokens=False)


class Counter:
    """Token counts of texts, with a bounded memory of pieces."""

    def __init__(self, name: str):
        self.name, self.known = name, {}

    def counts(self, texts: list[str]) -> list[int]:
        pieces = [[text] if DOUBTFUL.search(text) else PIECE.findall(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = list({p for own in pieces for p in own if p not in self.known})
        for start in range(0, len(new), 20_000):
            part = new[start:start + 20_000]
            self.known.update(zip(part, (len(e.ids) for e in encode(self.name, part))))
        return [sum(map(self.known.__getitem__, own)) for own in pieces]


def cores(text: str, overlap: int, core: int = CORE_CHARS) -> list[tuple[int, int, str]]:
    """Number, first character and text of each chunk; one chunk where an overlap would reach across the text."""
    if 2 * overlap >= len(text):
        return [(0, 0, text)]
    return [(j, max(j * core - overlap, 0), text[max(j * core - overlap, 0):(j + 1) * core + overlap])
            for j in range(-(-len(text) // core))]


def boundaries(text: str, offsets: list[tuple[int, int]], low: int, high: int) -> tuple[list[int], list[int]]:
    """Stable places from ``low`` to ``high`` at which a token begins, and how many tokens come before each."""
    places = {m.start() for m in STABLE.finditer(text, max(low, 0), max(high, 0))}
    at, before = [], []
    for k, (begin, _) in enumerate(offsets):
        if begin in places:
            at.append(begin)
            before.append(k)
    return at, before


CHUNK = "hash string, part int, parts int, start long, overlap int, chunk string"
CODED = "hash string, part int, parts int, tokens long, head_at array<long>, head_before array<long>, tail_at array<long>, tail_before array<long>"


def _chunked(texts: DataFrame, overlap: int) -> DataFrame:
    def cut(batches):
        for batch in batches:
            for key, text in zip(batch.column("hash").to_pylist(), batch.column("text").to_pylist()):
                own = cores(text, overlap)
                for j, start, chunk in own:
                    yield pa.RecordBatch.from_pydict(
                        {"hash": [key], "part": pa.array([j], pa.int32()), "parts": pa.array([len(own)], pa.int32()), "start": [start],
                         "overlap": pa.array([overlap], pa.int32()), "chunk": [chunk]})

    return texts.select("hash", "text").mapInArrow(cut, CHUNK)


def _coded(chunks: DataFrame, name: str) -> DataFrame:
    def code(batches):
        for batch in batches:
            for row in batch.to_pylist():
                coded = encode(name, [row["chunk"]])[0]
                width, start = 2 * row["overlap"], row["start"]
                core_end = (row["part"] + 1) * CORE_CHARS - start
                head = boundaries(row["chunk"], coded.offsets, 0, width) if row["part"] else ([], [])
                tail = boundaries(row["chunk"], coded.offsets, core_end - row["overlap"], core_end + row["overlap"])
                out = {"hash": row["hash"], "part": row["part"], "parts": row["parts"], "tokens": len(coded.ids),
                       "head_at": [start + x for x in head[0]], "head_before": head[1],
                       "tail_at": [start + x for x in tail[0]], "tail_before": tail[1]}
                yield pa.RecordBatch.from_pylist([out], schema=arrow)

    long_list = pa.list_(pa.int64())
    arrow = pa.schema([("hash", pa.string()), ("part", pa.int32()), ("parts", pa.int32()), ("tokens", pa.int64()), ("head_at", long_list),
                       ("head_before", long_list), ("tail_at", long_list), ("tail_before", long_list)])
    return chunks.mapInArrow(code, CODED)


def _spliced(coded: DataFrame) -> DataFrame:
    """Tokens per text; null where two neighbours have no common boundary."""
    ahead = coded.select("hash", (F.col("part") - 1).alias("part"), F.col("head_at").alias("next_at"), F.col("head_before").alias("next_before"))
    place = F.array_min(F.array_intersect("tail_at", "next_at"))
    gain = (F.element_at("tail_before", F.array_position("tail_at", F.col("place")).cast("int"))
            - F.element_at("next_before", F.array_position("next_at", F.col("place")).cast("int")))
    joined = coded.join(ahead, ["hash", "part"], "left").withColumn("place", place)
    last = F.col("part") == F.col("parts") - 1
    own = F.when(last, F.col("tokens")).when(F.col("place").isNotNull(), gain)
    return joined.groupBy("hash").agg(F.when(F.count(own) == F.count("*"), F.sum(own)).alias("n_tokens"))


def huge_counts(texts: DataFrame, name: str, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """(hash, n_tokens) of distinct texts (hash, text), by overlapping chunks; each round widens the overlaps of the texts it failed on."""
    done, open_texts = None, texts
    while True:
        chunks = _chunked(open_texts, overlap).repartition(F.col("hash"), F.col("part"))
        found = stored(_spliced(stored(_coded(chunks, name), "coded")), "spliced")
        good = found.where("n_tokens is not null")
        done = good if done is None else done.unionByName(good)
        failed = found.where("n_tokens is null").select("hash")
        if failed.isEmpty():
            return done
        open_texts = texts.join(failed, "hash", "left_semi")
        overlap *= 4


def token_counts(
    docs: DataFrame, name: str = "byte_bpe_50k.json", text_col: str = "text", keep=("doc_id",), huge_chars: int = HUGE_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """Columns ``keep`` with n_bytes and n_tokens of every whole text; null texts are empty and have no token.

    Equal huge texts are encoded once.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*keep, text.alias("_text"))
    short, huge = rows.where(F.length("_text") <= huge_chars), rows.where(F.length("_text") > huge_chars)
    fields = [f.name for f in rows.schema if f.name != "_text"]

    def count(batches):
        counter = Counter(name)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = part.column("_text").to_pylist()
                numbers = [[len(t.encode()) for t in texts], counter.counts(texts)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(f) for f in fields], *[pa.array(n, pa.int64()) for n in numbers]], [*fields, "n_bytes", "n_tokens"])

    schema = rows.drop("_text").schema.add("n_bytes", "long").add("n_tokens", "long")
    counted = short.mapInArrow(count, schema)
    key = F.sha2("_text", 256).alias("hash")
    texts = huge.select(key, F.col("_text").alias("text")).dropDuplicates(["hash"])
    tokens = huge_counts(stored(texts, "huge"), name, overlap)
    long_rows = huge.select(*fields, key, F.octet_length("_text").cast("long").alias("n_bytes")).join(tokens, "hash")
    return counted.unionByName(long_rows.select(*fields, "n_bytes", "n_tokens"))
