"""Leaks against an alignment of every document with every item, and against planted copies."""

from __future__ import annotations

import numpy as np

from corpuswright.llm import decontaminate as dc


def score_by_hand(item, passage):
    """Smith-Waterman, cell by cell in rows."""
    row, best = [0] * (len(passage) + 1), 0
    for w in item:
        new = [0]
        for j, v in enumerate(passage, 1):
            new.append(max(0, row[j - 1] + (dc.AGREE if v == w else dc.DIFFER), row[j] + dc.GAP, new[j - 1] + dc.GAP))
        row, best = new, max(best, max(new))
    return best


def leaks_by_hand(docs, items):
    out = {}
    for i, t in docs:
        passage = dc.words_of(t or "")
        for j, q in items:
            item = dc.words_of(q or "")
            if not item or not passage or len(set(item) & set(passage)) * 8 < len(set(item)):
                continue
            score = score_by_hand(item, passage)
            if score >= min(dc.SHARE * dc.AGREE * len(item), dc.AGREE * dc.RUN_WORDS):
                out[i, j] = score
    return out


def found(docs, items):
    return {(r.doc_id, r.item_id): r.score for r in dc.leaks(docs, items).collect()}


def test_every_pair(spark, sf_dir):
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = docs.where("n_chars < 3000")
    by_hand = leaks_by_hand([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    made = found(docs, items)
    assert len(by_hand) > 1 and set(made) == set(by_hand)
    assert all(made[k] == by_hand[k] for k in made)
    left = {r.doc_id for r in dc.clean(docs, items).collect()}
    assert left == {r.doc_id for r in docs.collect()} - {d for d, _ in by_hand}


def test_alignment():
    random = np.random.default_rng(3)
    for _ in range(30):
        item, passage = random.integers(0, 5, random.integers(1, 12)), random.integers(-1, 5, random.integers(1, 30))
        score, first, last = dc.align(item, passage)
        assert score == score_by_hand(item.tolist(), passage.tolist())
        if score:
            assert dc.align(item, passage[first:last])[0] == score


def edited(words, random, share):
    out = []
    for w in words:
        x = random.random()
        if x < share / 3:
            continue
        out += [f"changed{random.integers(1000)}"] if x < share * 2 / 3 else [w, f"added{random.integers(1000)}"] if x < share else [w]
    return out


def test_planted_copies(spark):
    random = np.random.default_rng(11)
    vocabulary = [f"word{i}" for i in range(4000)]
    text = lambda n: random.choice(vocabulary, n).tolist()
    items = [text(int(n)) for n in random.integers(12, 80, 40)]
    docs, leaking = [], set()
    for d in range(300):
        words = text(int(random.integers(20, 400)))
        if d % 3 == 0:
            item = items[d % 40]
            at = int(random.integers(0, len(words)))
            words[at:at] = edited(item, random, 0.0 if d % 2 else 0.2)
            leaking.add((d, d % 40))
        docs.append((d, " ".join(words).title() + "."))
    made = found(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame([(i, ", ".join(w)) for i, w in enumerate(items)], "item_id long, text string"))
    assert set(made) == leaking


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, "alpha beta gamma delta"), (3, "alpha beta gamma delta"), (None, "alpha beta gamma delta"), (4, "!!"), (5, "alpha"), (6, "filler " * 60_000 + "alpha beta gamma delta")]
    items = [(10, "Alpha, beta gamma; delta"), (10, "Alpha, beta gamma; delta"), (11, "alpha beta gamma delta"), (12, None), (13, "?"), (14, "alpha")]
    d, b = spark.createDataFrame([(i, t, 0.5) for i, t in docs], "doc_id long, text string, share double"), spark.createDataFrame(items, "item_id long, text string")
    rows = sorted(((r.doc_id or 0, r.item_id) for r in dc.leaks(d, b).collect()))
    assert rows == sorted([(i, j) for i in (3, 3, 0, 6) for j in (10, 11, 14)] + [(5, 14)])
    assert sorted(r.doc_id for r in dc.clean(d, b).collect()) == [1, 2, 4]
    assert dc.leaks(d.where("false"), b).count() == dc.leaks(d, b.where("false")).count() == 0
    assert dc.clean(d, b.where("false")).count() == 8


def test_blocks_of_items_do_not_change_the_result(spark, sf_dir, monkeypatch):
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = found(docs, items)
    monkeypatch.setattr(dc, "BLOCK_CHARS", 2000)
    monkeypatch.setattr(dc.blocks, "__defaults__", (2000,))
    assert found(docs, items) == whole


def test_planted_copies_with_many_edits(spark):
    """Every copy whose alignment qualifies is found, at 20, 30 and 40 % of edited words."""
    random = np.random.default_rng(17)
    vocabulary = [f"word{i}" for i in range(4000)]
    text = lambda n: random.choice(vocabulary, n).tolist()
    items = [text(int(n)) for n in random.integers(20, 60, 30)]
    docs, wanted, planted = [], set(), 0
    for share in (0.2, 0.3, 0.4):
        for d in range(100):
            words, item = text(int(random.integers(20, 200))), d % 30
            at = int(random.integers(0, len(words)))
            words[at:at] = edited(items[item], random, share)
            planted += 1
            passage = dc.words_of(" ".join(words))
            if score_by_hand(dc.words_of(" ".join(items[item])), passage) >= min(dc.SHARE * dc.AGREE * len(items[item]), dc.AGREE * dc.RUN_WORDS):
                wanted.add((len(docs), item))
            docs.append((len(docs), " ".join(words)))
    made = set(found(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")))
    assert len(wanted) > 0.8 * planted and made <= wanted and len(made) >= 0.99 * len(wanted)


def test_short_items_are_found_within_documents(spark):
    docs = [(1, "say alpha beta now"), (2, "alpha. Beta!"), (3, "beta alpha"), (4, "alpha x beta gamma delta"), (5, "delta"), (6, "x " * 1000 + "beta"), (7, "alpha alpha beta alpha beta")]
    items = [(10, "alpha beta"), (11, "Beta"), (12, "alpha beta"), (13, "delta gamma"), (14, "gamma delta"), (15, "beta gamma delta")]
    words = {i: dc.words_of(t) for i, t in items}
    by_hand = set()
    for d, t in docs:
        some = dc.words_of(t)
        for i, w in words.items():
            at = next((k for k in range(len(some) - len(w) + 1) if some[k : k + len(w)] == w), None)
            if at is not None:
                by_hand.add((d, i, at, at + len(w)))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id, r.first_word, r.last_word) for r in dc.leaks(d, b).collect()} == by_hand
    assert sorted(r.doc_id for r in dc.clean(d, b.where("item_id = 13")).collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_seeds_of_many_items_are_worked_off_in_parts(spark, monkeypatch):
    opening = "please read the text below and answer"
    items = spark.createDataFrame([(i, f"{opening} question number{i} of kind{i % 7}") for i in range(60)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"{opening} question number{i} of kind{i % 7} and more") for i in range(0, 60, 3)] + [(99, " ".join(f"{opening} question number{i}" for i in range(20)))], "doc_id long, text string")
    whole = found(docs, items)
    monkeypatch.setattr(dc, "PAIRS", 50)
    assert len(whole) >= 20 and found(docs, items) == whole


def test_long_texts_and_columns_of_the_same_names(spark):
    item = " ".join(f"item{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "filler words here " * 100_000 + item + " tail" * 1000, "x", 7), (2, "filler", None, 8)], "doc_id long, text string, item_id string, share int")
    made = dc.leaks(docs, spark.createDataFrame([(5, item, "d")], "item_id long, text string, doc_id string")).collect()
    assert [(r.doc_id, r.item_id, r.share, r.first_word, r.last_word) for r in made] == [(1, 5, 1.0, 300_000, 300_030)]
    left = dc.clean(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.share) for r in left] == [(2, None, 8)]
