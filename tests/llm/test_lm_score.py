"""The distributed scores against the plain automaton, built from the same texts."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from math import log10

import pytest

from corpuswright.llm import lm_score

SCHEMA = "doc_id long, text string"


BEGIN, END = lm_score.BEGIN, lm_score.END


class Whole:
    """The whole automaton of a small corpus, from counts of tuples of words."""

    def __init__(self, texts, order):
        self.order = order
        self.count = [Counter() for _ in range(order + 1)]
        for some in [[BEGIN, *lm_score.words_of(t), END] for t in texts]:
            for k in range(1, order + 1):
                self.count[k].update(tuple(some[i - k + 1 : i + 1]) for i in range(k - 1, len(some)))
        begins = self.count[1][BEGIN,]
        self.tokens, self.kinds = sum(self.count[1].values()) - begins, len(self.count[1]) - (begins > 0)
        seen, single = Counter(), Counter()
        for k in range(2, order + 1):
            for gram, n in self.count[k].items():
                bucket = k, self.count[k - 1][gram[:-1]].bit_length()
                seen[bucket] += n
                single[bucket] += n == 1
        self.failure = {b: (single[b] + 0.5) / (seen[b] + 1.0) for b in seen}

    def root(self, word):
        return (self.count[1][word,] + lm_score.ADD) / (self.tokens + lm_score.ADD * (self.kinds + 1))

    def arc(self, state, word):
        """Probability of a word in a state (which need not exist: its failure arc is then free)."""
        if not state:
            return self.root(word)
        shorter, n = self.arc(state[1:], word), self.count[len(state)][state]
        if not n:
            return shorter
        e = self.failure.get((len(state) + 1, n.bit_length()), 1.0)
        return (1 - e) * self.count[len(state) + 1][(*state, word)] / n + e * shorter

    def walk(self, text):
        state, total = (BEGIN,) if self.order > 1 else (), 0.0
        for word in [*lm_score.words_of(text), END]:
            total += log10(self.arc(state, word))
            state = (*state, word)[-(self.order - 1) :] if self.order > 1 else ()
        return total


def by_hand(rows, order):
    train = [t or "" for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 10]
    model = Whole(train, order)
    for doc, text in rows:
        tokens = [*lm_score.words_of(text or ""), END]
        yield doc, len(tokens), sum(model.count[1][w,] > 0 for w in tokens), model.tokens, sum(math.log10(model.root(w)) for w in tokens), model.walk(text or "")


def same(found, wanted):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3], r[4])
    found, wanted = sorted(found, key=key), sorted(wanted, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in wanted]
    for a, b in zip(found, wanted, strict=True):
        assert a[4:] == pytest.approx(b[4:], rel=1e-9, abs=1e-9)


def scored(df, order):
    return [tuple(r) for r in lm_score.scores(df, order).select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_the_plain_automaton(spark, sf_dir, order, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    monkeypatch.setattr(lm_score, "LEAST_RANGES", 7)
    same(scored(docs.repartition(3), order), by_hand([(r.doc_id, r.text) for r in docs.collect()], order))


def test_edges(spark):
    rows = [(1, None), (1, ""), (2, "a"), (3, "A a\x0ba a"), (3, "a b c a b"), (None, "a b"), (None, None), (4, "a b c a b"), (5, "É é"), (6, " \n\t")]
    same(scored(spark.createDataFrame(rows, SCHEMA), 2), by_hand(rows, 2))
    assert scored(spark.createDataFrame([], SCHEMA), 2) == []
    alone = spark.createDataFrame([(None, "a b")], SCHEMA)
    assert scored(alone, 2) == [(None, 3, 0, 0, 0.0, 0.0)]


def test_probabilities_sum_to_one():
    model = Whole(["a b a c", "b b a", ""], 3)
    words = [g[0] for g in model.count[1] if g[0] != BEGIN]
    for state in [(), (b"a",), (b"z",), (b"b", b"a"), (BEGIN,), (BEGIN, b"b")]:
        assert sum(model.arc(state, w) for w in [*words, b"unseen"]) == pytest.approx(1.0)


def test_held_out_texts_fit_better_than_at_the_root(spark):
    out = lm_score.scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out")
    base, full = out.selectExpr("sum(base_score)", "sum(score)").first()
    assert full > base


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_walk_follows_failure_arcs(order):
    """States, arcs and failures of the texts' automaton against those of the whole one."""
    import numpy as np

    train, texts = ["a b c a b d", "b c a", "a a a b", ""], ["a b c d e", "", "e e a b", "c a b d", "a a a a b c a"]
    whole = Whole(train, order)
    number = {BEGIN: 0, END: 1} | {w: i for i, w in enumerate([b"a", b"b", b"c", b"d", b"e"], 2)}
    sequences = [[BEGIN, *lm_score.words_of(t), END] for t in texts]
    lengths = np.array([len(s) for s in sequences])
    grams = lm_score.Grams(np.array([number[w] for s in sequences for w in s]), lengths, order)
    flat = [w for s in sequences for w in s]
    counts = [np.array([whole.count[k][tuple(flat[i - k + 1 : i + 1])] for i in grams.first[k - 1]]) for k in range(1, order + 1)]
    model = lm_score.Automaton(grams, counts, whole.tokens, whole.kinds, whole.failure)
    begins = np.cumsum(lengths) - lengths
    found = [model.walk(a, a + n) for a, n in zip(begins.tolist(), lengths.tolist(), strict=True)]
    assert found == pytest.approx([whole.walk(t) for t in texts])
    states = sum(len([g for g in whole.count[k] if whole.count[k][g] and any(g == tuple(s[i : i + k]) for s in sequences for i in range(len(s)))]) for k in range(1, order))
    assert len(model.failures) == states


def test_blocks_and_clashing_columns_do_not_change_scores(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * j) % 17}" for j in range(i % 40))) for i in range(200)] + [(500, "long " * 40_000 + "end")]
    df = spark.createDataFrame([(*r, 1.0, True, 3) for r in rows], "doc_id long, text string, score double, held_out boolean, words int").repartition(3)
    monkeypatch.setattr(lm_score, "BLOCK_CHARS", 900)
    monkeypatch.setattr(lm_score, "CHUNK_TOKENS", 50)
    same(scored(df, 2), by_hand(rows, 2))
    monkeypatch.setattr(lm_score, "GROW_CHARS", 1000)
    same(scored(df, 3), by_hand(rows, 3))
