"""The line field, the likelihood ratio and the letters of languages against plain programs."""

import itertools
import math
import re

import numpy as np
import pytest
import xxhash

from bizlens.llm import crf, langid, rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def test_marginals_equal_the_sum_over_all_label_sequences():
    draw = np.random.default_rng(1)
    lengths = [1, 5, 2, 7, 1, 3]
    first = np.concatenate([[0], np.cumsum(lengths)])
    scores, pairs = draw.normal(size=(first[-1], 2)), draw.normal(size=(2, 2))
    found, both, log_sum = crf.marginals(scores, first, pairs)
    expected, neighbours = np.zeros_like(scores), np.zeros((2, 2))
    for text, (a, b) in enumerate(zip(first, first[1:])):
        total, own, near = 0.0, np.zeros((b - a, 2)), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=b - a):
            mass = math.exp(sum(scores[a + i, x] for i, x in enumerate(labels)) + sum(pairs[x, y] for x, y in zip(labels, labels[1:])))
            total += mass
            for i, x in enumerate(labels):
                own[i, x] += mass
            for x, y in zip(labels, labels[1:]):
                near[x, y] += mass
        expected[a:b] = own / total
        neighbours += near / total
        assert log_sum[text] == pytest.approx(math.log(total))
    assert np.allclose(found, expected) and np.allclose(both, neighbours)


def test_lines_anywhere_in_a_text_are_learned_from(spark):
    """Junk that begins behind the sampled number of lines."""
    good = "A plain line of words that reads well."
    junk = "#$ %% && ||| ### $$ 99 %%"
    docs = [(i, "\n".join([good] * 100 + ([junk] * 900 if i % 2 else [good] * 900))) for i in range(40)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i, _ in docs], "doc_id long, quality int")
    model = crf.fit_quality(spark.createDataFrame(docs, "doc_id long, text string"), labels, crf.F.lit(True))
    asked = spark.createDataFrame([(1, "\n".join([junk] * 20)), (2, "\n".join([good] * 20))], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in crf.score_quality(asked, model).collect()}
    assert scores[1] < 0.3 and scores[2] > 0.7


@pytest.mark.parametrize("most", [10, 0])
def test_likelihood_ratio(spark, monkeypatch, most):
    monkeypatch.setattr(rules, "BROADCAST_IDS", most)
    texts = {1: "good words here and good words there too ok yes", 2: "bad words &&& bad", 3: "", 4: None, 5: "Good things and here good things there ok then so"}
    trusted = {1, 5}

    def bucket(*parts):
        seed = 42
        for part in parts:
            seed = xxhash.xxh64(part.encode(), seed=seed).intdigest()
        return (seed - 2**64 if seed >= 2**63 else seed) % rules.BUCKETS

    def grams(text):
        words = WORD.findall((text or "").lower())
        return [bucket(w) for w in words] + [bucket(a, b) for a, b in zip(words, words[1:])]

    every, good = {}, {}
    for i, text in texts.items():
        for b in grams(text):
            every[b] = every.get(b, 0) + 1
            good[b] = good.get(b, 0) + (i in trusted)
    n, t = (sum(x.values()) + rules.SMOOTHING * rules.BUCKETS for x in (every, good))
    ratio = {b: math.log((good[b] + 1) / t) - math.log((every[b] + 1) / n) for b in every}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = rules.rule_quality(docs, spark.createDataFrame([(i,) for i in trusted] + [(None,), (1,)], "id long"))
    for row in found.collect():
        own = grams(texts[row.doc_id])
        llr = sum(ratio[b] for b in own) / len(own) if own else 0.0
        assert row.llr == pytest.approx(llr, abs=2e-6)
        assert row.kept == (not row.base_failed and llr >= rules.THRESHOLD)


def test_only_letters_make_a_language(spark):
    parsers = [(*langid.parser(b"eins zwei drei"), 1.0), (*langid.parser(b"one two three"), 1.0)]
    texts = ["½ ² ③", "Ⅷ", "12 _ ١", "", None, "drei", "é", "日"]
    rows = langid.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), ["de", "en"], parsers).collect()
    assert [r.lang_pred == "und" for r in sorted(rows)] == [True] * 5 + [False] * 3


def test_rules_compute_the_grams_of_a_text_once(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, ""), (3, None)], "doc_id long, text string").cache()
    ratios = rules.rule_quality(docs, docs.select("doc_id"))
    plan = ratios._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [line for line in plan if "Filter" in line and "xxhash64(lambda" in line]
    assert sum("xxhash64(lambda" in line and "65536" in line for line in plan) == 1
