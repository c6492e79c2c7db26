"""The other corpus operators against libraries and plain programs, on the smallest table and on odd rows."""

import base64
import hashlib
import re
import zlib

import pytest

from bizlens.llm import bpe, crf, langid, merkle, mix, queries, rules, token_counts

WORD = re.compile("[^\x20\x09-\x0d]+")
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (4, "one two"), (None, "drei <|endoftext|> vier  fünf　x"), (5, "a" * 3000), (6, "l1\nl1\n\nl2 " * 400)]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "x", 7) for r in ODD], "doc_id long, text string, counts string, score int")


def run(spark, sf_dir, name):
    return queries.QUERIES[name](spark, sf_dir).collect()


def test_bpe(spark, sf_dir, docs, odd):
    import public_tokenizers as p
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=bpe.ranks_of(bpe.VOCABULARY), special_tokens={})

    def expected(text):
        ids = library.encode_ordinary(text or "")
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    texts = {r.doc_id: r.text for r in docs}
    for r in run(spark, sf_dir, "op6_bpe"):
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(texts[r.doc_id])
    found = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, bytes(r.decoded)) for r in bpe.encode(odd).collect())
    assert found == sorted((str(i), *expected(t)[:2], (t or "").encode()) for i, t in ODD)


def test_token_counts(spark, sf_dir, docs, odd):
    def expected(text):
        return len(token_counts.encode("byte_bpe_50k.json", [text or ""])[0].ids)

    texts = {r.doc_id: r.text for r in docs}
    assert all(r.n_tokens == expected(texts[r.doc_id]) for r in run(spark, sf_dir, "op7_token_counts"))
    for huge in (20, 10**9):  # all through overlapping chunks, and none
        found = token_counts.token_counts(odd, huge_chars=huge, overlap=2)
        assert sorted((str(r.doc_id), r.n_tokens) for r in found.collect()) == sorted((str(i), expected(t)) for i, t in ODD)


def test_chunks_widen(spark):
    text = ("word " * 3000 + "x" * 20000 + " tail" * 900)
    found = token_counts.token_counts(spark.createDataFrame([(1, text)], "doc_id long, text string"), overlap=4).first()
    assert found.n_tokens == len(token_counts.encode("byte_bpe_50k.json", [text])[0].ids)


def test_mix(spark, sf_dir, docs, odd):
    rows = run(spark, sf_dir, "op9_source_mix")
    texts = {r.doc_id: r for r in docs}
    assert all(r.size == len(WORD.findall(texts[r.doc_id].text or "")) and 0 <= r.taken <= 2 * r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault(texts[r.doc_id].source, []).append(r)
    sources = sorted(by, key=lambda s: (s is None, s or ""))
    size = {s: sum(r.size for r in by[s]) for s in sources}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    full = set()
    while True:
        level = (1.5 * sum(size.values()) - sum(2 * size[s] for s in full)) / sum(weight[s] for s in sources if s not in full)
        more = {s for s in sources if s not in full and level * weight[s] > 2 * size[s]}
        if not more:
            break
        full |= more
    for s in sources:
        target = 2 * size[s] if s in full else level * weight[s]
        assert abs(by[s][0].target - target) < 1e-6 * max(target, 1) and abs(sum(r.taken for r in by[s]) - target) <= 1
    assert sorted(map(tuple, rows)) == sorted(map(tuple, run(spark, sf_dir, "op9_source_mix")))


def test_fingerprints(spark, sf_dir, docs, odd):
    ordered = sorted(docs, key=lambda r: -r.doc_id)
    rows = {r.doc_id: r for r in run(spark, sf_dir, "op2_fingerprints")}
    for own, follower in zip(ordered, ordered[1:] + ordered[:1]):
        third = len(own.text) // 3
        edited = own.text[:len(own.text) - third] + follower.text[:third]
        assert rows[own.doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    roots = {}
    for r in docs:
        assert roots.setdefault(rows[r.doc_id].fingerprint, r.text) == r.text
    assert sum(r.near_edited for r in rows.values()) > 20 * sum(r.near_next for r in rows.values())
    assert merkle.edit_likeness(odd).count() == len(ODD)
    pair = spark.createDataFrame([("\n".join(f"line {i}" for i in range(20)), "\n".join(f"line {i}{'x' * (i == 9)}" for i in range(20)))], "a string, b string")
    a, b = (merkle.fingerprint(pair[c]) for c in "ab")
    assert pair.select(merkle.changed_paragraphs(a, b).alias("n")).first().n == [10]
    lines = [f"line {i}" for i in range(20)]
    pair = spark.createDataFrame([("\n".join(lines), "\n".join(["new", *lines])), ("", "a\nb"), ("x\ny", "x\ny"), (None, "")], "a string, b string")
    a, b = (merkle.fingerprint(pair[c]) for c in "ab")
    found = pair.select(merkle.changed_paragraphs(a, b).alias("new"), merkle.changed_paragraphs(b, a).alias("lost")).collect()
    assert [(r.new, r.lost) for r in found] == [([1], []), ([1, 2], [1]), ([], []), ([], [])]


def test_rules(spark, sf_dir, docs, odd):
    def expected(text):
        words, places = WORD.findall(text or ""), {}
        for i in range(len(words) - 4):
            places.setdefault(tuple(words[i:i + 5]), []).append(i)
        covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(5)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        return (len(words), sum(map(len, words)), sum(c in rules.SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(covered),
                len(words) < 10 or 100 * len(covered) > 20 * len(words))

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    texts = {r.doc_id: r.text for r in docs}
    rows = run(spark, sf_dir, "op5_quality_rules")
    assert all(tuple(r[n] for n in names) == expected(texts[r.doc_id]) and not (r.kept and r.base_failed) for r in rows)
    assert len(rows) == len(docs)
    found = rules.rule_quality(odd, odd.select("doc_id")).collect()
    assert sorted(map(str, ((r.doc_id, *(r[n] for n in names)) for r in found))) == sorted(map(str, ((i, *expected(t)) for i, t in ODD)))


def test_quality_and_language(spark, sf_dir, docs, odd):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = run(spark, sf_dir, "op4_line_quality")
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(a == b for a, b in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 for r in crf.score_quality(odd, None).collect())
    langs = {r.doc_id: r.lang for r in docs}
    held = [(r.lang_pred, langs[r.doc_id]) for r in run(spark, sf_dir, "op10_language") if r.held_out and langs[r.doc_id]]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    found = langid.identify(odd, ["de"], [langid.parser(b"drei vier eins zwei")]).collect()
    assert sorted(r.lang_pred for r in found) == sorted("und" if not t or not t.strip() else "de" for _, t in ODD)
    assert langid.longest_matches(b"abab-ab", b"xabaz") == [3, 1, 1, 2]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    for frame in (bpe.encode(empty), token_counts.token_counts(empty), merkle.edit_likeness(empty), crf.score_quality(empty, None),
                  langid.identify(empty, [], []), rules.rule_quality(empty, empty.select("doc_id")), mix.mix_sources(empty, rules.F.lit(1))):
        assert frame.count() == 0


def test_both_folds_of_merges_equal_the_library():
    import random

    import public_tokenizers as p
    import tiktoken

    merges, draw = bpe.merges_of(bpe.VOCABULARY), random.Random(5)
    library = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=merges.ranks, special_tokens={})
    words = ["".join(draw.choices("abcdehtinorsé019", k=draw.randint(1, 300))).encode() for _ in range(300)] + [b"a" * 5000, b"ab", b"z"]
    expected = [library._encode_single_piece(w) for w in words]
    assert [x.tolist() for x in merges.encode(words)] == expected
    assert all(merges.fold_long(w).tolist() == ids for w, ids in zip(words, expected) if w not in merges.ranks)
    assert merges.encode([]) == []
