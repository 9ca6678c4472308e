"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Texts are compared as words (lower case, ASCII signs dropped). A pass over all documents counts every word n-gram of the
benchmark in them. Rare n-grams become seeds; where a stretch of ``STRETCH`` neighbouring n-grams of a test item has no rare
one, the rarest that occurs becomes one. So common phrases seed nothing unless an item has nothing else there, and any copied
run of ``STRETCH + n - 1`` words holds a seed. Seeds found in a document join the passage around them to the item, and a
local alignment scores the two: words may be changed, left out or put in. An item of fewer words than ``n`` is one seed, and
is found wherever its words stand in a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.llm.common import batches

GRAM = 3
STRETCH = 4
#: A rare n-gram is at no more than this share of the corpus's positions, or occurs no more than so many times.
RARE_SHARE, RARE_TIMES = 1e-5, 100
#: Alignment: scores of a word that agrees, of one that differs, and of one that only one side has.
AGREE, DIFFER, GAP = 2, -1, -1
#: A passage is a leak if its alignment has this share of the highest score for the item, ...
SHARE = 0.5
#: ... or at least that of so many agreeing words in a row.
RUN_WORDS = 20
#: Pairs of a seed's place and an item that are held at once.
PAIRS = 2_000_000
#: Items are handled in blocks of so many characters: what is sent to executors is bounded, whatever the benchmark's size.
BLOCK_CHARS = 8_000_000
_SIGNS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_SIGNS).split()


class Items:
    """A block of test items: vocabulary, n-grams and where they are."""

    def __init__(self, items: list[tuple[int, str]], gram: int = GRAM) -> None:
        self.gram = gram
        self.ids = [i for i, _ in items]
        words = [words_of(t) for _, t in items]
        self.vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for some in words for w in some))}
        self.words = [np.array([self.vocabulary[w] for w in some], dtype=np.int64) for some in words]
        self.base = len(self.vocabulary) + 1
        keys, item, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        #: Where each item's n-grams begin among all.
        self.begin = np.zeros(len(self.words) + 1, dtype=np.int64)
        #: Items of fewer words than an n-gram, by their words.
        self.short: dict[tuple[int, ...], list[int]] = {}
        for i, some in enumerate(self.words):
            k = self.keys(some)
            self.begin[i + 1] = self.begin[i] + len(k)
            if 0 < len(some) < gram:
                self.short.setdefault(tuple(some.tolist()), []).append(i)
            keys.append(k)
            item.append(np.full(len(k), i))
            at.append(np.arange(len(k)))
        self.key_at, self.item_at, self.word_at = np.concatenate(keys), np.concatenate(item), np.concatenate(at)
        self.lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        self.grams = np.unique(self.key_at)
        self.seeds = self.grams

    def keys(self, words: np.ndarray) -> np.ndarray:
        """Numbers of the n-grams at each position; equal n-grams have equal numbers."""
        n = len(words) - self.gram + 1
        key = np.zeros(max(n, 0), dtype=np.uint64)
        for i in range(self.gram):
            key = key * np.uint64(self.base) + words[i : i + n].astype(np.uint64)
        return key

    def coded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Vocabulary numbers of all texts' words (-1: none), each text between gaps, and where each begins."""
        get, gap = self.vocabulary.get, [-1] * self.gram
        flat: list[int] = []
        begin = np.zeros(len(texts) + 1, dtype=np.int64)
        for i, text in enumerate(texts):
            begin[i] = len(flat)
            flat.extend(map(get, words_of(text), repeat(-1)))
            flat += gap
        begin[-1] = len(flat)
        return np.array(flat, dtype=np.int64), begin

    def hits(self, coded: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions with a wanted n-gram, and its place among the wanted (sorted)."""
        n = len(coded) - self.gram + 1
        if n <= 0 or not len(wanted):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = coded >= 0
        full = known[:n].copy()
        for i in range(1, self.gram):
            full &= known[i : i + n]
        at = np.flatnonzero(full)
        key = np.zeros(len(at), dtype=np.uint64)
        for i in range(self.gram):
            key = key * np.uint64(self.base) + coded[at + i].astype(np.uint64)
        place = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
        hit = wanted[place] == key
        return at[hit], place[hit]

    def choose(self, counts: dict[int, int], positions: int = 0, stretch: int = STRETCH) -> None:
        """Keeps as seeds the n-grams that occur and are rare, and of a stretch without one the rarest that occurs (of
        equals, the first). ``counts``: times in the corpus; ``positions``: of the corpus, in words."""
        count = np.array([counts.get(i, 0) for i in range(len(self.grams))])
        rare = (count > 0) & (count <= max(RARE_TIMES, RARE_SHARE * positions))
        kept = np.flatnonzero(rare).tolist()
        for i in range(len(self.ids)):
            place = np.searchsorted(self.grams, self.key_at[self.begin[i] : self.begin[i + 1]])
            some, known = rare[place], np.where(count[place] > 0, count[place], np.iinfo(np.int64).max)
            for a in range(max(1, len(place) - stretch + 1)) if len(place) else ():
                least = a + int(np.argmin(known[a : a + stretch]))
                if not some[a : a + stretch].any() and count[place[least]]:
                    kept.append(place[least])
        self.seeds = self.grams[np.unique(np.array(kept, dtype=np.int64))]
        place = np.minimum(np.searchsorted(self.seeds, self.key_at), max(len(self.seeds) - 1, 0))
        some = self.seeds[place] == self.key_at if len(self.seeds) else np.zeros(0, bool)
        order = np.argsort(place[some], kind="stable")
        self.seed_item, self.seed_word = self.item_at[some][order], self.word_at[some][order]
        self.seed_from = np.searchsorted(place[some][order], np.arange(len(self.seeds) + 1))


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: score, and the passage's words from and to which it runs."""
    n = len(passage)
    steps = np.arange(n + 1) * -GAP
    row, begin = np.zeros(n + 1, dtype=np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    here = np.arange(n + 1)
    for word in item.tolist():
        slant = np.zeros(n + 1, dtype=np.int64)
        slant[1:] = row[:-1] + np.where(passage == word, AGREE, DIFFER)
        above = row + GAP
        value, start = slant, np.concatenate(([0], begin[:-1]))
        up = above > value
        value, start = np.where(up, above, value), np.where(up, begin, start)
        low = value <= 0
        value, start = np.where(low, 0, value), np.where(low, here, start)
        # gaps along the row: the best of all cells to the left, less their distance
        raised = value + steps
        top = np.maximum.accumulate(raised)
        source = np.maximum.accumulate(np.where(raised == top, here, 0))
        row, begin = top - steps, start[source]
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), int(begin[j]), j)
    return best


def short_leaks(items: Items, coded: np.ndarray, begin: np.ndarray) -> Iterator[tuple[int, int, float, int, int, int]]:
    """Leaks of the items of fewer words than an n-gram: the first place in each text where all their words stand in a row."""
    for size in sorted({len(words) for words in items.short}):
        code = lambda words: sum(w * items.base ** (size - 1 - i) for i, w in enumerate(words))  # noqa: E731, B023
        by_key = {code(words): some for words, some in items.short.items() if len(words) == size}
        keys = np.array(sorted(by_key), dtype=np.int64)
        n = len(coded) - size + 1
        rows = [coded[i : i + n] for i in range(size)]
        at = np.flatnonzero(np.minimum.reduce(rows) >= 0)
        found = code([row[at] for row in rows])
        place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        at, place = at[keys[place] == found], place[keys[place] == found]
        text = np.searchsorted(begin, at, side="right") - 1
        _, first = np.unique(text * len(keys) + place, return_index=True)
        for j in first.tolist():
            t, word = int(text[j]), int(at[j] - begin[text[j]])
            for i in by_key[int(keys[place[j]])]:
                yield t, i, 1.0, AGREE * size, word, word + size


def leaks_of(items: Items, texts: list[str], share: float = SHARE, run_words: int = RUN_WORDS) -> list[tuple[int, int, float, int, int, int]]:
    """``(text, item, share, score, first word, past the last word)`` of the leaks in texts, by number."""
    coded, begin = items.coded(texts)
    out = list(short_leaks(items, coded, begin)) if items.short else []
    at, place = items.hits(coded, items.seeds)
    if not len(at):
        return out
    of = np.searchsorted(begin, at, side="right") - 1
    many = items.seed_from[place + 1] - items.seed_from[place]
    # whole texts, of as many pairs of a place and an item as may be held; of one text with more, some items after others
    heads = np.append(np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))), len(of))
    sums = np.concatenate(([0], np.cumsum(many)))[heads]
    first = 0
    while first < len(heads) - 1:
        last = max(first + 1, int(np.searchsorted(sums, sums[first] + PAIRS, side="right")) - 1)
        a, b = heads[first], heads[last]
        ways = -(-int(sums[last] - sums[first]) // PAIRS) if last == first + 1 else 1
        for way in range(ways):
            out += _aligned(items, coded, begin, at[a:b], place[a:b], of[a:b], share, run_words, way, ways)
        first = last
    return out


def _aligned(items: Items, coded: np.ndarray, begin: np.ndarray, at: np.ndarray, place: np.ndarray, of: np.ndarray, share: float, run_words: int, way: int, ways: int) -> list[tuple]:
    """Leaks of the items whose number is ``way`` modulo ``ways``, from the places of seeds."""
    if ways > 1:
        # one seed's items are in order of their numbers
        few = [(i, items.seed_item[items.seed_from[p] : items.seed_from[p + 1]]) for i, p in enumerate(place.tolist())]
        kept = [(i, items.seed_from[place[i]] + np.flatnonzero(some % ways == way)) for i, some in few]
        source = np.concatenate([np.full(len(k), i) for i, k in kept])
        index = np.concatenate([k for _, k in kept])
        if not len(index):
            return []
    else:
        many = items.seed_from[place + 1] - items.seed_from[place]
        source = np.repeat(np.arange(len(at)), many)
        index = np.arange(len(source)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(items.seed_from[place], many)
    text, item, word, pos = of[source], items.seed_item[index], items.seed_word[index], at[source]
    order = np.lexsort((pos, item, text))
    text, item, word, pos = text[order], item[order], word[order], pos[order]
    length = items.lengths[item]
    # passages: hits of an item whose reaches overlap
    low, high = pos - word - length // 2 - 2, pos - word + length + length // 2 + 2
    fresh = np.concatenate(([True], (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (pos[1:] - pos[:-1] > length[1:])))
    heads = np.flatnonzero(fresh)
    low, high = np.minimum.reduceat(low, heads), np.maximum.reduceat(high, heads)
    best: dict[tuple[int, int], tuple] = {}
    for t, i, a, b in zip(text[heads].tolist(), item[heads].tolist(), low.tolist(), high.tolist(), strict=True):
        words = items.words[i]
        a, b = max(a, int(begin[t])), min(b, int(begin[t + 1]) - items.gram)
        passage = coded[a:b]
        full = AGREE * len(words)
        least = min(share * full, AGREE * run_words)
        # no alignment scores more than the words that both have
        if AGREE * int(np.isin(words, passage).sum()) < least:
            continue
        score, first, last = align(words, passage)
        if score >= least and score > best.get((t, i), (0.0, -1))[1]:
            best[t, i] = (score / full, score, a + first - int(begin[t]), a + last - int(begin[t]))
    return [(t, i, *found) for (t, i), found in best.items()]


def blocks(benchmark: DataFrame, limit: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items with words, in blocks of bounded size; the driver holds one block."""
    some, size = [], 0
    for item, text in benchmark.select("item_id", "text").where(F.col("text").isNotNull()).distinct().toLocalIterator():
        if not words_of(text):
            continue
        if some and size + len(text) > limit:
            yield some
            some, size = [], 0
        some.append((item, text))
        size += len(text)
    if some:
        yield some


def seeded(docs: DataFrame, benchmark: DataFrame) -> Iterator[Broadcast]:
    """For each block of test items, the items with their seeds, which are chosen by counts over all documents.

    A seed's count is summed over tasks first; the driver gets one number for each n-gram of the block.
    """
    context = docs.sparkSession.sparkContext
    texts_only = docs.select("text").where(F.length("text") > 0)
    for some in blocks(benchmark):
        items = Items(some)
        plain = context.broadcast(items)

        def count(it: Iterator[pa.RecordBatch], shared: Broadcast = plain) -> Iterator[pa.RecordBatch]:
            of = shared.value
            total, positions = np.zeros(len(of.grams), dtype=np.int64), 0
            for _, texts in batches(it, 2_000_000):
                coded, _ = of.coded(texts)
                positions += len(coded)
                total += np.bincount(of.hits(coded, of.grams)[1], minlength=len(total))
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([-1, *seen.tolist()], pa.int64()), pa.array([positions, *total[seen].tolist()], pa.int64())], names=["gram", "n"])

        counts = texts_only.mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
        known = {r[0]: r[1] for r in counts.collect()}
        items.choose(known, known.get(-1, 0))
        yield context.broadcast(items)


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, run_words: int = RUN_WORDS) -> DataFrame:
    """``(doc_id, item_id, share, score, first_word, last_word)``: each document and test item of which it holds a copy.

    ``share``: the alignment's score by the highest the item allows; the words are numbers of the document's words, the last
    not included; of several copies of an item in a document the best is told. A leak has ``share`` of the item's score, or
    as much as ``run_words`` agreeing words. An item of fewer words than an n-gram has is found wherever all its words stand in
    a row, at its first place. Null and empty texts and items match nothing; repeated documents give
    repeated rows, repeated items one; items that are equal but for their id are all told. Empty tables give no rows.

    Documents are read twice for each block of items (there is one block for 8 MB of items) and never shuffled.
    """
    doc_kind, item_kind = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    narrow = docs.select("doc_id", "text").where(F.length("text") > 0)
    schema = f"doc_id {doc_kind}, item_id {item_kind}, share double, score bigint, first_word bigint, last_word bigint"
    item_type = pa.int64() if item_kind == "bigint" else pa.int32() if item_kind == "int" else pa.string()
    out = docs.sparkSession.createDataFrame([], schema)
    for items in seeded(docs, benchmark):

        def find(it: Iterator[pa.RecordBatch], shared: Broadcast = items) -> Iterator[pa.RecordBatch]:
            of = shared.value
            for batch, texts in batches(it, 2_000_000):
                found = leaks_of(of, texts, share, run_words)
                if found:
                    text, item, part, score, first, last = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(text)), pa.array([of.ids[i] for i in item], item_type), pa.array(part, pa.float64()), *(pa.array(x, pa.int64()) for x in (score, first, last))],
                        names=["doc_id", "item_id", "share", "score", "first_word", "last_word"],
                    )

        out = out.union(narrow.mapInArrow(find, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, run_words: int = RUN_WORDS) -> DataFrame:
    """The documents (all their columns) that hold no copy of a test item, by the rules of ``leaks``. Narrow, no join."""
    out = docs
    for items in seeded(docs, benchmark):

        def keep(it: Iterator[pa.RecordBatch], shared: Broadcast = items) -> Iterator[pa.RecordBatch]:
            of = shared.value
            for batch, texts in batches(it, 2_000_000):
                leaking = {t for t, *_ in leaks_of(of, texts, share, run_words)}
                yield batch.filter(pa.array([i not in leaking for i in range(len(texts))], pa.bool_()))

        out = out.mapInArrow(keep, docs.schema)
    return out
