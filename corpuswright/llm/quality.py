"""Quality classifier with supervised subword embeddings.

Every word of a text and every character n-gram of its words (with word boundaries) is hashed to a learned vector; a
document is the average of its vectors, and a softmax layer over it gives the class. Vectors and layer are learned together
by stochastic gradient descent in numpy, on a bounded sample of labelled rows. To score, each hashed vector is projected on
the layer once; a distinct word then has one number (the sum over its features) and a count, and a text is a sum of these.
A word that repeats the one before it adds one more word, ``REPEAT``: all bigrams of equal words share this feature.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.llm.common import WordCache, batches, fold

#: Bound of the training sample: documents of each class.
CLASS_DOCS = 2000
BUCKETS = 1 << 17
GRAMS = (3, 4, 5)
THRESHOLD = 0.3
REPEAT = "\u2422\u2422"
_STEP = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def features(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words, and the word that each belongs to."""
    text = "<" + "><".join(words) + ">"
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    whole = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    found, of = [(whole * _MIX) >> np.uint64(40)], [np.arange(len(words), dtype=np.int32)]
    for n in GRAMS:
        if len(code) < n:
            break
        key = np.full(len(code) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            key = key * _STEP + code[i : len(code) - n + 1 + i]
        within = owner[: len(code) - n + 1] == owner[n - 1 :]
        found.append((key[within] * _MIX) >> np.uint64(40))
        of.append(owner[: len(code) - n + 1][within])
    return (np.concatenate(found) % np.uint64(buckets)).astype(np.int64), np.concatenate(of)


def words_of(text: str) -> list[str]:
    words = text.split()
    return words + [REPEAT] * sum(map(eq, words, words[1:]))


@dataclass
class Model:
    """What scoring needs: each bucket's vector projected on the difference of the two classes, and the bias."""

    weight: np.ndarray
    bias: float

    def of_words(self, words: list[str]) -> list[tuple[float, int]]:
        out: list[tuple[float, int]] = []
        for at in range(0, len(words), 50_000):
            some = words[at : at + 50_000]
            index, owner = features(some, len(self.weight))
            sums = np.bincount(owner, self.weight[index], len(some))
            out += zip(sums.tolist(), np.bincount(owner, minlength=len(some)).tolist(), strict=True)
        return out

    def scores(self, texts: list[str], cache: WordCache) -> list[float]:
        words = [words_of(t) for t in texts]
        get, out = cache.learn(words).__getitem__, []
        for some in words:
            mean = 0.0
            if some:
                sums, counts = zip(*map(get, some), strict=True)
                mean = sum(sums) / sum(counts)
            out.append(1.0 / (1.0 + float(np.exp(-np.clip(mean + self.bias, -500, 500)))))
        return out


def fit(texts: list[str], labels: list[int], prior: float | None = None, width: int = 16, epochs: int = 12, rate: float = 0.4, seed: int = 1) -> Model:
    """Trains on texts of classes 0 and 1. ``prior``: the share of class 1 among all rows, if the sample's differs."""
    y = np.array(labels, dtype=np.int64)
    if not len(y):
        return Model(np.zeros(BUCKETS), 0.0)
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS), float(np.log(mean / (1 - mean))))
    docs = []
    for text in texts:
        words = words_of(text)
        unique = list(dict.fromkeys(words))
        if not unique:
            docs.append((np.zeros(0, np.int64), np.zeros(0)))
            continue
        where = {w: i for i, w in enumerate(unique)}
        times = np.bincount([where[w] for w in words], minlength=len(unique))
        index, owner = features(unique)
        bucket, of = np.unique(index, return_inverse=True)
        count = np.bincount(of, times[owner])
        docs.append((bucket.astype(np.int32), (count / count.sum()).astype(np.float32)))
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / width, 1 / width, (BUCKETS, width)).astype(np.float32)
    layer, bias = np.zeros((width, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    steps, done = epochs * len(docs), 0
    for _ in range(epochs):
        for i in random.permutation(len(docs)).tolist():
            bucket, share = docs[i]
            now = rate * (1 - done / steps)
            done += 1
            hidden = share @ vectors[bucket]
            logits = hidden @ layer + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = layer @ p
            layer -= now * hidden[:, None] * p
            bias -= now * 0.1 * p
            # the average's gradient is spread over its features, each by its share of the largest
            if len(share):
                vectors[bucket] -= (now / share.max()) * share[:, None] * back
    out = Model((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float64), float(bias[1] - bias[0]))
    if prior is not None:
        prior = float(np.clip(prior, 1e-3, 1 - 1e-3))
        out.bias += float(np.log(prior / (1 - prior)) - np.log(mean / (1 - mean)))
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, folds: int = 5, each: int = CLASS_DOCS) -> tuple[list[str], list[int], float]:
    """Texts and classes of about ``each`` rows of each class outside the held-out fold, and the share of class 1.

    Labels with a null id or null quality are not used; a document labelled more than once is of class 1 if the mean of
    its labels is at least one half. Rows are chosen by a hash of the id, so the choice does not depend on partitioning.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold("doc_id", folds) != 0))
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    counts = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    if not counts:
        return [], [], 0.5
    share = F.when(F.col("quality") == 1, F.lit(min(1.0, each / max(counts.get(1, 0), 1)))).otherwise(F.lit(min(1.0, each / max(counts.get(0, 0), 1))))
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    # about 2 * each ids, whatever the size of the table
    chosen = F.broadcast(known.where(unit < share))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id").select("text", "quality")
    texts, classes = [], []
    for text, quality in rows.toLocalIterator():
        texts.append(text)
        classes.append(quality)
    return texts, classes, counts.get(1, 0) / sum(counts.values())


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, each: int = CLASS_DOCS) -> Model:
    return fit(*labelled_sample(docs, labels, folds, each))


_CACHES: dict[float, WordCache] = {}


def score(df: DataFrame, model: Model, threshold: float = THRESHOLD, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row by its whole text, and the columns named in ``carry``.

    Null and empty texts, and texts of white space, have no features and get the score of the bias alone. Repeated rows and
    null ids are kept. With no labels at all every score is 0.5. Narrow: one row in, one row out.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    narrow = df.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "text", *[c for c in carry if c not in ("doc_id", "text")])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = shared.value
        key = float(trained.bias + trained.weight.sum())
        if key not in _CACHES:
            _CACHES.clear()
            _CACHES[key] = WordCache(trained.of_words)
        for batch, texts in batches(it):
            scores = trained.scores(texts, _CACHES[key])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), *[batch.column(c) for c in more]],
                names=["doc_id", "held_out", "score", "predicted", *more],
            )

    more = [c for c in carry if c != "doc_id"]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return narrow.mapInArrow(run, f"doc_id {kinds['doc_id']}, held_out boolean, score double, predicted int" + "".join(f", `{c}` {kinds[c]}" for c in more))
