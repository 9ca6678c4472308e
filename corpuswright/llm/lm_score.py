"""Language-model scores with a weighted backoff automaton.

The states are the word n-grams seen in training (the empty one is the root), smoothed by interpolation: a state's arc for a
word costs ``(1 - e) * c(state, word) / c(state) + e * p(word | shorter state)``, and its failure arc, to the state without
the first word, costs ``e``. ``e`` belongs to an order and a magnitude of ``c(state)``: the share of training positions in
such states whose n-gram occurs nowhere else (so a state seen once is sure of nothing). The root gives a word
``(c + 0.1) / (N + 0.1 * (V + 1))``. A text is read once from left to right: the state is carried along, failure arcs are
followed until there is an arc, and log probabilities are summed (``Automaton.walk``).

No machine holds the whole automaton. Texts are read once, in blocks, and each block asks for the counts of its own distinct
n-grams, by hash ranges; the ranges sum what all blocks have and answer each block. From the answers, and the sums over the
corpus that smoothing needs, the states and arcs that some texts can reach are built, and these texts walk them. Nothing is
pruned: counts cover all training texts. What is sent is a block's distinct n-grams (sorted 64-bit hashes, as differences),
so a frequent n-gram costs one entry a block, and no range is larger than another. Blocks and ranges are as many as each
other, and grow with the square root of a corpus beyond ``GROW_CHARS``: what a block sends to a range stays a bunch of
n-grams, and neither number grows in proportion.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.llm.common import batches, fold, written

ORDER = 2
ADD = 0.1
FOLDS = 10
#: Characters of a block of texts, and of text whose n-grams fall into one hash range on average; of a corpus up to which
#: these are enough.
BLOCK_CHARS = 16_000_000
GROW_CHARS = 250_000_000_000
LEAST_RANGES = 256
#: Tokens of the texts of one automaton.
CHUNK_TOKENS = 300_000
#: Hashes that stand for the end and the beginning of a text.
END, BEGIN = np.uint64(1), np.uint64(2)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words_of(text: str) -> list[bytes]:
    """Words of a text: A-Z lower-cased, split at ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def magnitude(counts: np.ndarray) -> np.ndarray:
    """The bucket of a count: its number of binary digits."""
    return np.frexp(counts.astype(np.float64))[1]


def squeezed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    raw = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def spread(data: bytes, kind: type) -> np.ndarray:
    """What was ``squeezed``."""
    size = int.from_bytes(data[:8], "little")
    raw = np.frombuffer(pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True), dtype=np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(kind)


def ascending(keys: np.ndarray) -> bytes:
    return squeezed(np.diff(keys, prepend=np.uint64(0)))


def ascended(data: bytes) -> np.ndarray:
    return np.cumsum(spread(data, np.uint64), dtype=np.uint64)


class Block:
    """Texts of a block as word hashes, each between a beginning and an end."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray, train: np.ndarray) -> None:
        self.words, self.lengths = words, lengths
        begins = np.cumsum(lengths) - lengths
        self.place = np.arange(len(words)) - np.repeat(begins, lengths)
        self.train = np.repeat(train, lengths)

    @classmethod
    def of_texts(cls, texts: list[str], train: np.ndarray) -> Block:
        import xxhash

        digest, parts, lengths = xxhash.xxh64_intdigest, [], np.zeros(len(texts), dtype=np.int64)
        begin, end = np.array([BEGIN]), np.array([END])
        for i, text in enumerate(texts):
            words = words_of(text)
            parts += begin, np.fromiter(map(digest, words), np.uint64, len(words)), end
            lengths[i] = len(words) + 2
        return cls(np.concatenate(parts), lengths, train)

    def grams(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each order: where its n-grams end, the distinct ones' hashes in order, and which of them is where."""
        key = self.words
        for k in range(1, order + 1):
            if k > 1:
                x = np.zeros_like(key)
                x[1:] = key[:-1] * _A + self.words[1:]
                x ^= x >> np.uint64(29)
                x *= _B
                x ^= x >> np.uint64(32)
                key = x
            at = np.flatnonzero(self.place >= k - 1)
            distinct, which = np.unique(key[at], return_inverse=True)
            yield at, distinct, which


def ranges_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each hash range begins and ends among sorted keys."""
    place = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.searchsorted(place, np.arange(ranges + 1, dtype=np.uint64))


_NAMES = ["dest", "kind", "block", "part", "ids", "held", "lengths", "data", "more"]


def _types(id_type: pa.DataType) -> list[pa.DataType]:
    return [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(id_type), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary()]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _asked(block: int, texts: list[str], ids: list, held: list[bool], order: int, ranges: int) -> list[tuple]:
    """What a block sends: itself (kind 0), and its n-grams by range (kind: order) with their training counts."""
    train = ~np.array(held, dtype=bool)
    made = Block.of_texts(texts, train)
    rows = []
    for k, (at, keys, which) in enumerate(made.grams(order), 1):
        counts = np.bincount(which, made.train[at], len(keys)).astype(np.uint32)
        if k == 1:
            frequent = np.argsort(-np.bincount(which), kind="stable")
            number = np.empty(len(keys), dtype=np.uint32)
            number[frequent] = np.arange(len(keys), dtype=np.uint32)
            rows.append((ranges + block % 1_000_003, 0, block, 0, ids, held, made.lengths.tolist(), squeezed(keys[frequent]), squeezed(number[which])))
        cuts = ranges_of(keys, ranges)
        for part in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[part], cuts[part + 1]
            rows.append((part, k, block, part, None, None, None, ascending(keys[a:b]), squeezed(counts[a:b])))
    return rows


def _answers(rows: list[dict]) -> Iterator[tuple]:
    """Training counts over all blocks, for each of the blocks that asked one range; and how many n-grams have any."""
    by_kind: dict[int, list[dict]] = {}
    for row in rows:
        by_kind.setdefault(row["kind"], []).append(row)
    for kind, some in by_kind.items():
        keys = [ascended(r["data"]) for r in some]
        counts = np.concatenate([spread(r["more"], np.uint32) for r in some])
        distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(which, counts, len(distinct)).astype(np.uint64)
        at = 0
        for row, own in zip(some, keys, strict=True):
            yield 0, kind, row["block"], row["part"], None, None, None, squeezed(total[which[at : at + len(own)]]), None
            at += len(own)
        if kind == 1:
            yield 0, -1, -1 - some[0]["part"], int(np.count_nonzero(total[distinct != BEGIN])), None, None, None, None, None


def counted(docs: DataFrame, order: int = ORDER, folds: int = FOLDS) -> DataFrame:
    """Rows of texts with the training counts of their n-grams, and rows of statistics.

    ``ids``, ``held`` and ``lengths`` tell the documents of a row and ``words`` their words by number (``Grams``);
    ``counts[k - 1]`` has the counts of the row's distinct n-grams of order ``k``. Statistics have ``name``, ``bucket`` and ``n``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    chars = docs.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    block_chars = ceil(BLOCK_CHARS * max(1.0, sqrt(chars / GROW_CHARS)))
    ranges = max(LEAST_RANGES, ceil(chars / block_chars))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(chars / block_chars))
    narrow = docs.select("doc_id", (fold("doc_id", folds) == 0).alias("held"), "text")
    schema = f"dest bigint, kind int, block bigint, part bigint, ids array<{kind}>, held array<boolean>, lengths array<int>, data binary, more binary"

    def ask(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        block = (context.partitionId() if context else 0) << 32
        texts, ids, held, size, types = [], [], [], 0, None
        for batch, some in batches(it, BLOCK_CHARS // 8):
            types = types or _types(batch.schema.field("doc_id").type)
            for text, doc, out in zip(some, batch.column("doc_id").to_pylist(), batch.column("held").to_pylist(), strict=True):
                if texts and size + len(text) > block_chars:
                    yield _batch(_asked(block, texts, ids, held, order, ranges), _NAMES, types)
                    texts, ids, held, size, block = [], [], [], 0, block + 1
                texts.append(text)
                ids.append(doc)
                held.append(out)
                size += len(text)
        if texts:
            yield _batch(_asked(block, texts, ids, held, order, ranges), _NAMES, types)

    def answer(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dest, waiting = None, []
        for batch in it:
            types = _types(batch.schema.field("ids").type.value_type)
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("dest", "kind")}
                if waiting and row["dest"] != dest:
                    yield _batch(list(_answers(waiting)), _NAMES, types)
                    waiting = []
                if row["kind"] == 0:
                    yield batch.slice(i, 1)
                    continue
                dest = row["dest"]
                waiting.append(row | {c: batch.column(c)[i].as_py() for c in ("block", "part", "data", "more")})
        if waiting:
            yield _batch(list(_answers(waiting)), _NAMES, types)

    names = ["ids", "held", "lengths", "words", "counts", "name", "bucket", "n"]

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, stream, answers, types = None, None, {}, None
        stats: Counter = Counter()

        def done() -> Iterator[pa.RecordBatch]:
            ids, held, lengths = stream["ids"], stream["held"], np.array(stream["lengths"], dtype=np.int64)
            number = spread(stream["more"], np.uint32)
            made = Block(spread(stream["data"], np.uint64)[number], lengths, ~np.array(held, dtype=bool))
            counts = []
            for k, (at, keys, which) in enumerate(made.grams(order), 1):
                total = np.concatenate([np.zeros(0, np.uint64), *(spread(x, np.uint64) for x in answers.get(k, ()))])
                if len(total) != len(keys):
                    raise RuntimeError(f"block {block} got {len(total)} counts for {len(keys)} n-grams")
                here = np.zeros(len(made.words), dtype=np.uint64)
                here[at] = total[which]
                counts.append(here)
                of = at[made.train[at]]
                if k == 1:
                    stats["tokens", 0] += int(np.count_nonzero(made.place[of] > 0))
                elif len(of):
                    bucket, single = magnitude(counts[-2][of - 1]), here[of] == 1
                    for name, n in (("seen", np.bincount(bucket)), ("single", np.bincount(bucket, single))):
                        stats.update({(f"{name}{k}", b): int(n[b]) for b in np.flatnonzero(n).tolist()})
            ends, first, start = np.cumsum(lengths), 0, 0
            while first < len(lengths):
                last = max(first + 1, int(np.searchsorted(ends, start + CHUNK_TOKENS, side="right")))
                stop = int(ends[last - 1])
                some = Grams(number[start:stop], lengths[first:last], order)
                own = [squeezed(c[start:stop][at]) for c, at in zip(counts, some.first, strict=True)]
                yield _batch([(ids[first:last], held[first:last], lengths[first:last].tolist(), squeezed(number[start:stop]), own, None, None, None)], names, types)
                first, start = last, stop

        for batch in it:
            types = types or [pa.list_(batch.schema.field("ids").type.value_type), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.binary()), pa.string(), pa.int64(), pa.int64()]
            for i in range(batch.num_rows):
                kind_, now = batch.column("kind")[i].as_py(), batch.column("block")[i].as_py()
                if kind_ < 0:
                    stats["kinds", 0] += batch.column("part")[i].as_py()
                    continue
                if now != block and stream:
                    yield from done()
                    stream, answers = None, {}
                block = now
                if kind_ == 0:
                    stream = {c: batch.column(c)[i].as_py() for c in ("ids", "held", "lengths", "data", "more")}
                else:
                    answers.setdefault(kind_, []).append(batch.column("data")[i].as_py())
        if stream:
            yield from done()
        if stats:
            yield _batch([(None, None, None, None, None, name, bucket, n) for (name, bucket), n in stats.items()], names, types)

    asked = narrow.mapInArrow(ask, schema)
    answered = asked.repartition(parts, "dest").sortWithinPartitions("dest").mapInArrow(answer, schema)
    placed = answered.repartition(parts, "block").sortWithinPartitions("block", "kind", "part")
    return written(placed.mapInArrow(place, f"ids array<{kind}>, held array<boolean>, lengths array<int>, words binary, counts array<binary>, name string, bucket bigint, n bigint"), "lm-counts")


class Grams:
    """The distinct n-grams of some texts whose words have numbers, each text between a beginning and an end.

    For each order up to ``order``: ``of[k - 1]`` has the n-gram that ends at each position (-1: its text begins too late),
    ``first[k - 1]`` a position of each n-gram. N-grams are in order of their words' numbers, whoever works them out.
    """

    def __init__(self, words: np.ndarray, lengths: np.ndarray, order: int) -> None:
        self.begins = np.cumsum(lengths) - lengths
        place = np.arange(len(words)) - np.repeat(self.begins, lengths)
        _, index, self.words = np.unique(words, return_index=True, return_inverse=True)
        self.kinds = len(index)
        self.first, self.of = [index], [self.words]
        for k in range(2, order + 1):
            at = np.flatnonzero(place >= k - 1)
            _, index, which = np.unique(self.of[-1][at - 1] * self.kinds + self.words[at], return_index=True, return_inverse=True)
            of = np.full(len(words), -1, dtype=np.int64)
            of[at] = which
            self.first.append(at[index])
            self.of.append(of)


class Automaton:
    """The states and arcs that some texts can reach. States are numbered in steps of the number of different words, so a
    state and a word together are one key; state 0 is the root."""

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, kinds: int, failure: dict[tuple[int, int], float]) -> None:
        order, step = len(counts), grams.kinds
        p = (counts[0] + ADD) / (tokens + ADD * (kinds + 1))
        self.grams, self.base = grams, np.log10(p)
        self.known = counts[0] > 0
        self.arcs: dict[int, tuple[int, float]] = {}
        self.failures: dict[int, tuple[int, float]] = {}
        # number of the state of each n-gram of the order before; the root is the only one of order 0
        state = np.zeros(1, dtype=np.int64)
        fresh = 1
        for k in range(1, order + 1):
            first, count = grams.first[k - 1], counts[k - 1]
            if k == 1:
                context = shorter = np.zeros(len(first), dtype=np.int64)
            else:
                context, shorter = grams.of[k - 2][first - 1], grams.of[k - 2][first]
                n = counts[k - 2][context]
                e = np.array([failure.get((k, b), 1.0) for b in range(65)])[magnitude(n)]
                p = np.where(n > 0, (1 - e) * count / np.maximum(n, 1) + e * p[shorter], p[shorter])
            seen = count > 0
            if k < order:
                # an n-gram that was not seen is no state: the state there is that of its end
                after = np.where(seen, (fresh + np.arange(len(first))) * step, state[shorter])
                e = np.log10([failure.get((k + 1, b), 1.0) for b in range(65)])[magnitude(count)]
                self.failures.update(zip(after[seen].tolist(), zip(state[shorter[seen]].tolist(), e[seen].tolist(), strict=True), strict=True))
                fresh += len(first)
            else:
                after = state[shorter]
            made = seen if k > 1 else np.ones(len(first), dtype=bool)
            keys = state[context] + grams.words[first]
            self.arcs.update(zip(keys[made].tolist(), zip(after[made].tolist(), np.log10(p[made]).tolist(), strict=True), strict=True))
            state = after

    def walk(self, begin: int, end: int) -> float:
        """log10 of the probability of the words of the text at these positions, its end included; one pass, left to right."""
        arc_of, failure_of, words = self.arcs.get, self.failures, self.grams.words
        state, total = arc_of(int(words[begin]))[0], 0.0
        for at in range(begin + 1, end, 1 << 20):
            for word in words[at : min(end, at + (1 << 20))].tolist():
                arc = arc_of(state + word)
                while arc is None:
                    state, cost = failure_of[state]
                    total += cost
                    arc = arc_of(state + word)
                state, cost = arc
                total += cost
        return total


def scores(docs: DataFrame, order: int = ORDER, folds: int = FOLDS) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row, over its whole text.

    The model learns from the rows outside the held-out fold. Null and empty texts are the end alone; rows that repeat an
    id are texts of their own; a null id counts as held out. Without training rows every probability is 1. An empty table
    gives no rows; other columns are not read. A text longer than a block is a block of its own, which one task holds as
    numbers. Texts are not shuffled, but their words' numbers within a block are.
    """
    table = counted(docs, order, folds)
    kind = docs.schema["doc_id"].dataType.simpleString()
    # two numbers for each order and binary magnitude
    stats = {(r[0], r[1]): r[2] for r in table.where("name is not null").groupBy("name", "bucket").agg(F.sum("n")).collect()}
    tokens, kinds = stats.get(("tokens", 0), 0), stats.get(("kinds", 0), 0)
    failure = {(k, b): (stats.get((f"single{k}", b), 0) + 0.5) / (stats[f"seen{k}", b] + 1.0) for k in range(2, order + 1) for b in range(65) if (f"seen{k}", b) in stats}

    def walk(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i in range(batch.num_rows):
                lengths = np.array(batch.column("lengths")[i].as_py(), dtype=np.int64)
                grams = Grams(spread(batch.column("words")[i].as_py(), np.uint32), lengths, order)
                model = Automaton(grams, [spread(x.as_py(), np.uint64) for x in batch.column("counts")[i]], tokens, kinds, failure)
                begin = np.cumsum(lengths) - lengths
                full = [model.walk(a, a + n) for a, n in zip(begin.tolist(), lengths.tolist(), strict=True)]
                base, known = model.base[grams.words], model.known[grams.words]
                base[begin], known[begin] = 0.0, False
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[i].values,
                        batch.column("held")[i].values,
                        pa.array(lengths - 1),
                        pa.array(np.add.reduceat(known, begin, dtype=np.int64)),
                        pa.array(np.full(len(lengths), tokens, dtype=np.int64)),
                        pa.array(np.add.reduceat(base, begin)),
                        pa.array(full, pa.float64()),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return table.where("name is null").select("ids", "held", "lengths", "words", "counts").mapInArrow(walk, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
