"""Repeated byte strings by a difference-cover sample and suffixes sorted bucket by bucket.

``COVER`` holds, for any two residues modulo ``PERIOD``, a pair with that difference.  So for any two suffixes there is a
step of less than ``PERIOD`` bytes after which both stand at a sampled place.  Two equal strings of ``LENGTH`` bytes then hold two sampled
places with equal names (the rank class of the next ``NAMED`` bytes).  Names are settled first, for the sample alone:

* a sampled place whose wide surroundings (all strings of ``LENGTH`` bytes that could meet at it) occur again settles
  all those strings at once: a long tie is resolved by the rank of its sampled place, not by comparing bytes;
* a place whose name occurs with other surroundings sends the suffixes before it, one representative for each of its
  surroundings.  These suffixes are dealt into buckets, and each bucket is sorted on its own; neighbours that agree in
  ``LENGTH`` bytes are repeats.

Ranks are equality classes, 64-bit hashes of the bytes: removal needs which suffixes tie, not which comes first.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.llm.meet import lists, order_id, pack, part_count, part_of, row_key, settle, unpack
from bizlens.llm.text import CODES, Rolling, mixed, steps

LENGTH = 200
#: A perfect difference set: every residue but 0 is the difference of exactly one pair.
PERIOD, COVER = 133, (1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121)
NAMED = LENGTH - PERIOD + 1
NAME_BITS, WIDE_BITS = 40, 48
#: Surroundings of one name that a step asks about; further ones send their suffixes unasked.
ASKED_WIDES = 8
STEP = 3_000_000
IN_COVER = np.zeros(PERIOD, bool)
IN_COVER[list(COVER)] = True


class Sample:
    """The sampled places of some texts that a string can meet at, with name and surroundings of each."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        lengths = np.diff(starts)
        self.rolled = Rolling(CODES[data])
        owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        local = np.arange(len(data)) - starts[:-1][owner]
        place = np.flatnonzero(IN_COVER[local % PERIOD])
        low, high = np.maximum(place - PERIOD + 1, starts[:-1][owner[place]]), np.minimum(place + LENGTH, starts[1:][owner[place]])
        fits = (high - place >= NAMED) & (high - low >= LENGTH)
        place, self.low, self.high = place[fits], low[fits], high[fits]
        self.place, self.owner = place, owner[place].astype(np.int64)
        self.name = self.rolled.spans(place, place + NAMED) >> np.uint64(64 - NAME_BITS)
        self.wide = mixed(self.rolled.spans(self.low, self.high) + (place - self.low).astype(np.uint64)) >> np.uint64(64 - WIDE_BITS)


def _runs(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index of each run and the run of each item."""
    return np.flatnonzero(new), np.cumsum(new) - 1


def _changes(*columns: np.ndarray) -> np.ndarray:
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


ASK = "part int, names binary, wides binary, owners binary, ids binary, own_id long, own_values array<long>"
ANSWER = "id long, values array<long>"
LIST = pa.list_(pa.int64())
ASK_ARROW = pa.schema([("part", pa.int32()), ("names", pa.binary()), ("wides", pa.binary()), ("owners", pa.binary()), ("ids", pa.binary()),
                       ("own_id", pa.int64()), ("own_values", LIST)])
ANSWER_ARROW = pa.schema([("id", pa.int64()), ("values", LIST)])


def cover_ranks(docs: DataFrame, parts: int) -> DataFrame:
    """(id, values): twice a name whose suffixes are to be sent, twice and one surroundings that occur again."""

    def ask(batches):
        for batch, data, starts in steps(batches, "text", STEP):
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            rank = np.argsort(ids, kind="stable")
            place_of = np.empty(len(ids), np.int64)
            place_of[rank] = np.arange(len(ids))
            sample = Sample(data, starts)
            order = np.lexsort((sample.wide, sample.name))
            name, wide, owner = sample.name[order], sample.wide[order], place_of[sample.owner[order]]
            if not len(name):
                continue
            pair_first, pair = _runs(_changes(name, wide))
            again = (np.bincount(pair) > 1)[pair]
            name_first, of = _runs(_changes(name[pair_first]))
            nth = np.arange(len(pair_first)) - name_first[of]
            several = (np.bincount(of) > 1)[of]
            leads = pair_first[several]
            known = [(owner[again], wide[again] * np.uint64(2) + np.uint64(1)), (owner[leads], name[leads] * np.uint64(2))]
            own, values = lists(np.concatenate([k[0] for k in known]), np.concatenate([k[1] for k in known]), ids[rank])
            if len(own):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.to_numpy() % parts, pa.int32()), *[pa.nulls(len(own), pa.binary())] * 4, own.cast(pa.int64()), values], schema=ASK_ARROW)
            sent = pair_first[nth < ASKED_WIDES]
            part = part_of(name[sent] << np.uint64(64 - NAME_BITS), parts)
            cut = np.searchsorted(part, np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(cut)):
                at = sent[cut[p]:cut[p + 1]]
                cells = [pack(name[at]), pack(wide[at], False), pack(owner[at], False), pack(ids[rank])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int32()), *[pa.array([c], pa.binary()) for c in cells], pa.nulls(1, pa.int64()), pa.nulls(1, LIST)], schema=ASK_ARROW)

    def answer(table: pa.Table) -> pa.Table:
        known = table.filter(pa.compute.is_valid(table["own_id"]))
        result = [pa.table([known["own_id"], known["own_values"]], schema=ANSWER_ARROW)]
        table = table.filter(pa.compute.is_valid(table["names"]))
        if len(table):
            columns = [[], [], []]
            for n, w, o, i in zip(*[table[c].to_pylist() for c in ("names", "wides", "owners", "ids")]):
                for column, x in zip(columns, (unpack(n), unpack(w, False), unpack(i).astype(np.int64)[unpack(o, False).astype(np.int64)])):
                    column.append(x)
            name, wide, owner = map(np.concatenate, columns)
            order = np.lexsort((owner, wide, name))
            name, wide, owner = name[order], wide[order], owner[order]
            pair_first, pair = _runs(_changes(name, wide))
            again = (np.bincount(pair) > 1)[pair]
            _, of = _runs(_changes(name[pair_first]))
            leads = pair_first[(np.bincount(of) > 1)[of]]
            ids, at = np.unique(np.concatenate([owner[again], owner[leads]]), return_inverse=True)
            values = np.concatenate([wide[again] * np.uint64(2) + np.uint64(1), name[leads] * np.uint64(2)])
            if len(ids):
                result.append(pa.table(list(lists(at, values, ids)), schema=ANSWER_ARROW))
        return pa.concat_tables(result)

    return docs.select("id", "text").mapInArrow(ask, ASK).groupBy("part").applyInArrow(answer, ANSWER)


SUFFIX = "part int, hashes binary, owners binary, places binary, ids binary, tags binary, own_id long, own_tag int, own_spans array<long>"
SPANS = "id long, tag int, spans array<long>"
SUFFIX_ARROW = pa.schema([("part", pa.int32()), *[(n, pa.binary()) for n in ("hashes", "owners", "places", "ids", "tags")], ("own_id", pa.int64()),
                          ("own_tag", pa.int32()), ("own_spans", LIST)])
SPANS_ARROW = pa.schema([("id", pa.int64()), ("tag", pa.int32()), ("spans", LIST)])


def _covered(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:-1]) > 0


def sorted_buckets(asked: DataFrame, parts: int) -> DataFrame:
    """(id, tag, spans): byte ranges of a text whose strings start elsewhere too, each as begin * 2**32 + end.

    ``asked`` has id, tag, text and values (the answers for the text's sampled places, or null).
    """

    def send(batches):
        for batch, data, starts in steps(batches, "text", STEP):
            if not len(data):
                continue
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "tag"))
            listed = batch.column("values")
            of = np.repeat(np.arange(len(ids)), pa.compute.fill_null(pa.compute.list_value_length(listed), 0).to_numpy(zero_copy_only=False))
            told = np.unique(mixed(of.astype(np.uint64)) ^ mixed(pa.compute.list_flatten(listed).to_numpy(zero_copy_only=False).astype(np.uint64)))
            if not len(told):
                continue
            sample = Sample(data, starts)
            mark = mixed(sample.owner.astype(np.uint64))

            def is_told(values):
                wanted = mark ^ mixed(values)
                return told[np.minimum(np.searchsorted(told, wanted), len(told) - 1)] == wanted

            wide = is_told(sample.wide * np.uint64(2) + np.uint64(1))
            gone = _covered(sample.low[wide], sample.high[wide], len(data))
            named = is_told(sample.name * np.uint64(2))
            place = np.flatnonzero(_covered(sample.low[named], np.minimum(sample.place[named], sample.high[named] - LENGTH) + 1, len(data)))
            text = np.searchsorted(starts, place, "right") - 1
            value = sample.rolled.spans(place, place + LENGTH)
            order = np.argsort(value, kind="stable")
            value, place, text = value[order], place[order], text[order]
            first, run = _runs(_changes(value))
            twice = (np.bincount(run) > 1)[run] if len(run) else np.zeros(0, bool)
            gone |= _covered(place[twice], place[twice] + LENGTH, len(data))
            part = part_of(value[first], parts)
            cut = np.searchsorted(part, np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(cut)):
                at = first[cut[p]:cut[p + 1]]
                used, local = np.unique(text[at], return_inverse=True)
                cells = [pack(value[at]), pack(local, False), pack(place[at] - starts[text[at]], False), pack(ids[used], False), pack(tags[used].astype(np.int64), False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int32()), *[pa.array([c], pa.binary()) for c in cells], pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, LIST)],
                    schema=SUFFIX_ARROW)
            edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
            inner = starts[1:-1]
            joint = inner[(inner > 0) & (inner < len(data))]
            joint = np.unique(joint[gone[joint] & gone[joint - 1]])
            begin, end = np.sort(np.concatenate([np.flatnonzero(edge == 1), joint])), np.sort(np.concatenate([np.flatnonzero(edge == -1), joint]))
            if len(begin):
                of = np.searchsorted(starts, begin, "right") - 1
                spans = ((begin - starts[of]) << 32) + end - starts[of]
                index, values = lists(of, spans, np.arange(len(ids)))
                index = index.to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[index] % parts, pa.int32()), *[pa.nulls(len(index), pa.binary())] * 5, pa.array(ids[index], pa.int64()),
                     pa.array(tags[index], pa.int32()), values], schema=SUFFIX_ARROW)

    def bucket(table: pa.Table) -> pa.Table:
        known = table.filter(pa.compute.is_valid(table["own_id"]))
        result = [pa.table([known["own_id"], known["own_tag"], known["own_spans"]], schema=SPANS_ARROW)]
        table = table.filter(pa.compute.is_valid(table["hashes"]))
        if len(table):
            columns = [[], [], [], []]
            for h, o, p, i, t in zip(*[table[c].to_pylist() for c in ("hashes", "owners", "places", "ids", "tags")]):
                o = unpack(o, False).astype(np.int64)
                for column, x in zip(columns, (unpack(h), unpack(i, False).astype(np.int64)[o], unpack(t, False).astype(np.int64)[o], unpack(p, False).astype(np.int64))):
                    column.append(x)
            value, ids, tags, at = map(np.concatenate, columns)
            order = np.argsort(value, kind="stable")
            value, ids, tags, at = value[order], ids[order], tags[order], at[order]
            _, run = _runs(_changes(value))
            twice = (np.bincount(run) > 1)[run]
            pairs, index = np.unique(np.stack([ids[twice], tags[twice]], 1), axis=0, return_inverse=True)
            if len(pairs):
                which, spans = lists(index.ravel(), (at[twice] << 32) + at[twice] + LENGTH, np.arange(len(pairs)))
                which = which.to_numpy()
                result.append(pa.table([pa.array(pairs[which, 0]), pa.array(pairs[which, 1].astype(np.int32)), spans], schema=SPANS_ARROW))
        return pa.concat_tables(result)

    return asked.select("id", "tag", "text", "values").mapInArrow(send, SUFFIX).groupBy("part").applyInArrow(bucket, SPANS)


def remove_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without its text but with kept (bytes), n_bytes, n_removed, n_spans and kept_sha256.

    Each byte goes that is covered by a string of ``LENGTH`` bytes that also starts at another place of the table, in the same
    text or another; spans are maximal removed runs.  Null texts are empty.  A row that occurs twice repeats itself.
    Columns of ``docs`` named like an added column are replaced.
    """
    added = ["kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    keep = [c for c in docs.columns if c not in added and c != text_col]
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    base = docs.select(order_id(id_col).alias("id"), F.hash(F.col(text_col)).alias("tag"), text)
    parts = part_count(docs, text_col)
    base = base.withColumn("row", row_key(F.col("id"), F.col("text")))
    covers = cover_ranks(base.select(F.col("row").alias("id"), "text"), parts).withColumnRenamed("id", "row")
    ranks = settle(covers.groupBy("row").agg(F.flatten(F.collect_list("values")).alias("values")), "ranks")
    spans = sorted_buckets(base.join(ranks, "row", "left"), parts)
    spans = settle(spans.groupBy(F.col("id").alias("_id"), F.col("tag").alias("_tag")).agg(F.flatten(F.collect_list("spans")).alias("_spans")), "spans")
    own = docs.select(*[F.col(f"`{c}`") for c in keep], order_id(id_col).alias("_id"), F.hash(F.col(text_col)).alias("_tag"), text.alias("_text"))
    rows = own.join(spans, ["_id", "_tag"], "left").select(*[F.col(f"`{c}`") for c in keep], "_text", "_spans")

    def cut(batches):
        for batch, data, starts in steps(batches, "_text"):
            out = [[], [], [], [], []]
            spans = batch.column("_spans")
            for i in range(batch.num_rows):
                own = data[starts[i]:starts[i + 1]]
                removed = runs = 0
                if spans[i].is_valid and len(spans[i].values):
                    both = np.unique(spans[i].values.to_numpy())
                    gone = _covered(both >> 32, both & 0xFFFFFFFF, len(own))
                    removed, runs = int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
                    own = own[~gone]
                raw = own.tobytes()
                for column, x in zip(out, (raw, int(starts[i + 1] - starts[i]), removed, runs, hashlib.sha256(raw).hexdigest())):
                    column.append(x)
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *[pa.array(x, k) for x, k in zip(out, kinds)]], [*keep, *added])

    schema = rows.drop("_text", "_spans").schema
    for name, kind in zip(added, ("binary", "long", "long", "long", "string")):
        schema = schema.add(name, kind)
    return rows.mapInArrow(cut, schema)
