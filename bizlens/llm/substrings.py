"""Repeated word windows by fixed-block anchors.

Every text is cut into non-overlapping blocks of ``BLOCK`` words, the index.  Each rolling window of ``BLOCK`` words of each
text probes it.  A repeat of ``WINDOW`` words holds a whole block of its other occurrence, so the windows around the hits
are all that can be repeats.  They are compared as wholes by 64-bit hashes, which extends each hit to the maximal repeat:
the union of the equal windows around it.  Of equal windows the first by document and place stays.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.llm.meet import lists, order_id, pack, part_count, part_of, row_key, settle, unpack
from bizlens.llm.text import Rolling, crossing_free, steps, word_hashes, word_spans

WINDOW, BLOCK = 20, 10
#: Bits of a block's name.  A name that two blocks share by chance only adds windows to compare.
NAME_BITS = 40
STEP = 4_000_000
ASKED = "part int, names binary, owners binary, ids binary, own_id long, own_names array<long>"
FOUND = "id long, names array<long>"


def _names(data, starts):
    """Hashes of the words, index of the first word of each text, and per block-sized window its start, text and name."""
    hashes, first = word_hashes(data, starts)
    place, owner = crossing_free(first, BLOCK)
    name = Rolling(hashes).windows(BLOCK)[place] >> np.uint64(64 - NAME_BITS)
    return hashes, first, place, owner, name


def anchor_hits(docs: DataFrame, parts: int) -> DataFrame:
    """(id, names): names of the windows of a document that are a block somewhere and occur twice or more.

    ``docs`` has id and text.  What a step holds twice is a hit for its documents at once.
    """

    def ask(batches):
        for batch, data, starts in steps(batches, "text", STEP):
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            rank = np.argsort(ids, kind="stable")
            place_of = np.empty(len(ids), np.int64)
            place_of[rank] = np.arange(len(ids))
            _, first, place, owner, name = _names(data, starts)
            block = (place - first[owner]) % BLOCK == 0
            order = np.argsort(name, kind="stable")
            name, owner, block = name[order], place_of[owner[order]], block[order]
            new = np.ones(len(name), bool)
            new[1:] = name[1:] != name[:-1]
            begin = np.flatnonzero(new)
            count = np.diff(np.concatenate([begin, [len(name)]]))
            many = np.repeat(count > 1, count)
            if len(begin):
                flags = np.maximum.reduceat(block, begin).astype(np.uint64) * np.uint64(2) + (count > 1)
                sent = name[begin] * np.uint64(4) + flags.astype(np.uint64)
                part = part_of(name[begin] << np.uint64(64 - NAME_BITS), parts)
                cut = np.searchsorted(part, np.arange(parts + 1))
                for p in np.flatnonzero(np.diff(cut)):
                    a, b = cut[p], cut[p + 1]
                    yield row(int(p), pack(sent[a:b]), pack(owner[begin[a:b]], False), pack(ids[rank]))
            if many.any():
                own, names = lists(owner[many], name[many], ids[rank])
                n = len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.to_numpy() % parts, pa.int32()), *[pa.nulls(n, pa.binary())] * 3, own.cast(pa.int64()), names], schema=asked)

    asked = pa.schema([("part", pa.int32()), ("names", pa.binary()), ("owners", pa.binary()), ("ids", pa.binary()), ("own_id", pa.int64()),
                       ("own_names", pa.list_(pa.int64()))])

    def row(part, names, owners, ids):
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), *[pa.array([x], pa.binary()) for x in (names, owners, ids)], pa.nulls(1, pa.int64()),
             pa.nulls(1, pa.list_(pa.int64()))], schema=asked)

    def answer(table: pa.Table) -> pa.Table:
        known = table.filter(pa.compute.is_valid(table["own_id"]))
        result = [pa.table([known["own_id"], known["own_names"]], schema=found)]
        table = table.filter(pa.compute.is_valid(table["names"]))
        sent = [unpack(x.as_buffer().to_pybytes()) for x in table["names"]]
        if sent:
            owner = np.concatenate([unpack(i.as_buffer().to_pybytes())[unpack(o.as_buffer().to_pybytes(), False).astype(np.int64)]
                                    for o, i in zip(table["owners"], table["ids"])]).astype(np.int64)
            sent = np.concatenate(sent)
            order = np.argsort(sent, kind="stable")
            sent, owner = sent[order], owner[order]
            name = sent >> np.uint64(2)
            new = np.ones(len(name), bool)
            new[1:] = name[1:] != name[:-1]
            begin = np.flatnonzero(new)
            count = np.diff(np.concatenate([begin, [len(name)]]))
            block = np.maximum.reduceat(sent >> np.uint64(1) & np.uint64(1), begin)
            hit = np.repeat((block == 1) & (count > 1), count)
            distinct, at = np.unique(owner[hit], return_inverse=True)
            if len(distinct):
                result.append(pa.table(list(lists(at, name[hit], distinct)), schema=found))
        return pa.concat_tables(result)

    found = pa.schema([("id", pa.int64()), ("names", pa.list_(pa.int64()))])
    sent = docs.select("id", "text").mapInArrow(ask, ASKED)
    return sent.groupBy("part").applyInArrow(answer, FOUND)


WINDOWS = "part int, hashes binary, owners binary, places binary, ids binary, tags binary, own_id long, own_tag int, own_places array<long>"
REMOVED = "id long, tag int, places array<long>"


def repeated_windows(hit: DataFrame, parts: int) -> DataFrame:
    """(id, tag, places): first words of the windows of a document that also start earlier.

    ``hit`` has id, tag, text and names (the hits of the text, or null).
    """
    window_schema = pa.schema([
        ("part", pa.int32()), ("hashes", pa.binary()), ("owners", pa.binary()), ("places", pa.binary()), ("ids", pa.binary()), ("tags", pa.binary()),
        ("own_id", pa.int64()), ("own_tag", pa.int32()), ("own_places", pa.list_(pa.int64()))])
    removed_schema = pa.schema([("id", pa.int64()), ("tag", pa.int32()), ("places", pa.list_(pa.int64()))])

    def ask(batches):
        for batch in batches:
            ordered = pa.Table.from_batches([batch]).sort_by([("id", "ascending"), ("tag", "ascending")]).combine_chunks()
            for part_batch, data, starts in steps(ordered.to_batches(), "text", STEP):
                yield from windows(part_batch, data, starts)

    def windows(batch, data, starts):
        ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "tag"))
        hashes, first, place, owner, name = _names(data, starts)
        named = batch.column("names")
        of = np.repeat(np.arange(len(ids)), pa.compute.fill_null(pa.compute.list_value_length(named), 0).to_numpy(zero_copy_only=False))
        shift = np.uint64(NAME_BITS)
        wanted = np.unique((of.astype(np.uint64) << shift) + pa.compute.list_flatten(named).to_numpy(zero_copy_only=False).astype(np.uint64))
        asked = (owner.astype(np.uint64) << shift) + name
        hits = np.zeros(len(hashes) + 1, np.int64)
        if len(wanted):
            at = np.minimum(np.searchsorted(wanted, asked), len(wanted) - 1)
            hits[place + 1] = wanted[at] == asked
        hits = np.cumsum(hits)
        start, text = crossing_free(first, WINDOW)
        near = hits[start + WINDOW - BLOCK + 1] - hits[start] > 0
        start, text = start[near], text[near]
        if not len(start):
            return
        value = Rolling(hashes).windows(WINDOW)[start]
        order = np.argsort(value, kind="stable")
        value, start, text = value[order], start[order], text[order]
        new = np.ones(len(value), bool)
        new[1:] = value[1:] != value[:-1]
        at = start - first[text]
        part = part_of(value[new], parts)
        cut = np.searchsorted(part, np.arange(parts + 1))
        sent = [value[new], text[new], at[new]]
        for p in np.flatnonzero(np.diff(cut)):
            a, b = cut[p], cut[p + 1]
            used, local = np.unique(sent[1][a:b], return_inverse=True)
            cells = [pack(sent[0][a:b]), pack(local, False), pack(sent[2][a:b], False), pack(ids[used], True), pack(tags[used].astype(np.int64), False)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p], pa.int32()), *[pa.array([x], pa.binary()) for x in cells], pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()),
                 pa.nulls(1, pa.list_(pa.int64()))], schema=window_schema)
        later = ~new
        # a row that occurs twice is its own first occurrence
        group = np.cumsum(new) - 1
        head = np.flatnonzero(new)[group]
        later &= (ids[text] != ids[text[head]]) | (tags[text] != tags[text[head]]) | (at != at[head])
        if later.any():
            index, places = lists(text[later], at[later], np.arange(len(ids)))
            index = index.to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[index] % parts, pa.int32()), *[pa.nulls(len(index), pa.binary())] * 5, pa.array(ids[index], pa.int64()),
                 pa.array(tags[index], pa.int32()), places], schema=window_schema)

    def answer(table: pa.Table) -> pa.Table:
        known = table.filter(pa.compute.is_valid(table["own_id"]))
        result = [pa.table([known["own_id"], known["own_tag"], known["own_places"]], schema=removed_schema)]
        table = table.filter(pa.compute.is_valid(table["hashes"]))
        if len(table):
            columns = [[], [], [], []]
            for row in table.select(["hashes", "owners", "places", "ids", "tags"]).to_batches():
                for h, o, p, i, t in zip(*[c.to_pylist() for c in row.columns]):
                    o = unpack(o, False).astype(np.int64)
                    for column, x in zip(columns, (unpack(h), unpack(i).astype(np.int64)[o], unpack(t, False).astype(np.int64)[o], unpack(p, False).astype(np.int64))):
                        column.append(x)
            value, ids, tags, at = map(np.concatenate, columns)
            order = np.lexsort((tags, ids, value))
            value, ids, tags, at = value[order], ids[order], tags[order], at[order]
            new = np.ones(len(value), bool)
            new[1:] = value[1:] != value[:-1]
            head = np.flatnonzero(new)[np.cumsum(new) - 1]
            gone = (ids != ids[head]) | (tags != tags[head])
            ids, tags, at = ids[gone], tags[gone], at[gone]
            pairs, index = np.unique(np.stack([ids, tags], 1), axis=0, return_inverse=True)
            if len(pairs):
                which, places = lists(index.ravel(), at, np.arange(len(pairs)))
                which = which.to_numpy()
                result.append(pa.table([pa.array(pairs[which, 0]), pa.array(pairs[which, 1].astype(np.int32)), places], schema=removed_schema))
        return pa.concat_tables(result)

    sent = hit.select("id", "tag", "text", "names").mapInArrow(ask, WINDOWS)
    return sent.groupBy("part").applyInArrow(answer, REMOVED)


def cut_texts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with kept_text, n_words, n_removed and kept_sha256, from rows with text and places."""
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("_text"), F.col("places").alias("_places"))
    added = [("kept_text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]

    def cut(batches):
        for batch, data, starts in steps(batches, "_text"):
            begins, ends, first = word_spans(data, starts)
            raw = data.tobytes()
            places = batch.column("_places")
            out = [[], [], [], []]
            missing = batch.column("_text").is_null().to_pylist()
            for i in range(batch.num_rows):
                a, b = int(first[i]), int(first[i + 1])
                text = raw[starts[i]:starts[i + 1]]
                removed = 0
                words = None
                if places[i].is_valid:
                    change = np.zeros(b - a + 1, np.int64)
                    at = places[i].values.to_numpy()
                    np.add.at(change, np.unique(at), 1)
                    np.add.at(change, np.unique(at) + WINDOW, -1) if len(at) else None
                    gone = np.cumsum(change)[:-1] > 0
                    removed = int(gone.sum())
                    if removed:
                        stay = np.flatnonzero(~gone)
                        from_ = np.concatenate([[starts[i]], ends[a:b][:-1]]) if b > a else begins[a:b]
                        text = b"".join(raw[from_[k]:ends[a + k]] for k in stay) + raw[ends[b - 1]:starts[i + 1]]
                        words = [raw[begins[a + k]:ends[a + k]] for k in stay]
                words = text.split() if words is None else words
                out[0].append(None if missing[i] else text.decode("utf-8", "replace"))
                out[1].append(b - a)
                out[2].append(removed)
                out[3].append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], *[pa.array(x, t) for x, (_, t) in zip(out, added)]], [*keep, *[n for n, _ in added]])

    schema = rows.drop("_text", "_places").schema
    for name, kind in (("kept_text", "string"), ("n_words", "long"), ("n_removed", "long"), ("kept_sha256", "string")):
        schema = schema.add(name, kind)
    return rows.mapInArrow(cut, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without its text but with kept_text, n_words, n_removed and kept_sha256 (of the kept words joined by one space).

    Each word goes that is covered by a window of ``WINDOW`` words whose word sequence also starts earlier: at a smaller
    id, or earlier in the same text.  Null ids come last.  Rows with the same id and text are one document, those with
    the same id and other text are ordered by a hash of the text.  Null texts stay null and have no words; texts
    shorter than a window stay whole.  Columns of ``docs`` named like an added column are replaced.
    """
    added = ["kept_text", "n_words", "n_removed", "kept_sha256"]
    keep = [c for c in docs.columns if c not in added]
    base = docs.select(order_id(id_col).alias("id"), F.hash(F.col(text_col)).alias("tag"), F.col(text_col).alias("text"))
    parts = part_count(docs, text_col)
    base = base.withColumn("row", row_key(F.col("id"), F.col("text")))
    anchors = anchor_hits(base.select(F.col("row").alias("id"), "text"), parts).withColumnRenamed("id", "row")
    hits = settle(anchors.groupBy("row").agg(F.flatten(F.collect_list("names")).alias("names")), "anchors")
    found = repeated_windows(base.join(hits, "row", "left"), parts)
    places = settle(found.groupBy("id", "tag").agg(F.flatten(F.collect_list("places")).alias("places")), "repeats")
    own = docs.select(*[F.col(f"`{c}`") for c in keep], order_id(id_col).alias("_id"), F.hash(F.col(text_col)).alias("_tag"))
    joined = own.join(places.select(F.col("id").alias("_id"), F.col("tag").alias("_tag"), F.col("places").alias("_at")), ["_id", "_tag"], "left")
    frame = joined.withColumn("_whole", F.col(f"`{text_col}`"))
    return cut_texts(frame.select(*[F.col(f"`{c}`") for c in keep if c != text_col], F.col("_whole").alias("text"), F.col("_at").alias("places")),
                     [c for c in keep if c != text_col])
