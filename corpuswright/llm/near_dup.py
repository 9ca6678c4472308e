"""SimHash near-duplicates through an inverted index of byte positions, with count filtering.

A fingerprint is 64 bits, eight bytes at eight positions. Fingerprints that differ in at most ``bits`` bits differ in at
most that many bytes, so they share at least ``8 - bits`` positional bytes: that is the guaranteed count. The index takes
positions together in ``2 * bits`` groups (pairs of positions for two bits): a linked pair differs in at most ``bits`` of
the groups and shares the others, so it meets in a posting list of ``bits`` groups' bytes. A list keyed by one byte alone
would hold a 256th of all fingerprints; one of four bytes holds few that are no copies. In a list the positional bytes that
each pair shares are tallied; pairs that reach the guaranteed count stay, and their differing bits are verified.

A list of more than ``LIST`` fingerprints is dealt out again, by the bytes of every choice of ``8 - bits`` positions: who
meets there has reached the count, and such a list has at most ``256 ** bits`` different fingerprints, however many documents
there are; in it, a fingerprint is looked up with every change of up to ``bits`` of the free bits, so work is linear. Lists
give a spanning forest of their links, not pairs. Nothing is left out: lists of any size end in the same links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuswright.llm.common import batches, written
from corpuswright.operators.graph import components

BITS = 2
WIDTH = 3
SEED = 42
#: Fingerprints of a list whose pairs are tallied; longer lists are dealt out again.
LIST = 64
#: A fingerprint with more than this part of all rows is joined to them by broadcast (there are fewer of these than its inverse).
HOT_PART = 2000


def fingerprint_array(texts: list[str], width: int = WIDTH) -> np.ndarray:
    """Unsigned fingerprints of texts.

    A-Z are lower-cased, words are runs of anything but ASCII white space, shingles of ``width`` words keep their repeats;
    with fewer words the whole sequence is the shingle, with none the fingerprint is zero. A bit is set if it is in more
    than half of the shingles' XXH64 hashes (seed 42).
    """
    import xxhash

    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    sizes = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= width:
            hashes.append(digest(joined, SEED))
            sizes[i] = 1
            continue
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        begins = np.concatenate(([0], ends[:-1] + 1))
        hashes += [digest(joined[a:b], SEED) for a, b in zip(begins[: 1 - width].tolist(), ends[width - 1 :].tolist(), strict=True)]
        sizes[i] = len(words) - width + 1
    out = np.zeros(len(texts), dtype=np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        raw = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
        starts = np.cumsum(sizes[some]) - sizes[some]
        ones = np.empty((len(some), 64), dtype=np.int64)
        for at in range(0, len(some), 256):
            a, b = starts[at], (starts[at + 256] if at + 256 < len(some) else len(raw))
            ones[at : at + 256] = np.add.reduceat(np.unpackbits(raw[a:b], axis=1), starts[at : at + 256] - a, axis=0, dtype=np.int64)
        out[some] = np.packbits(2 * ones > sizes[some][:, None], axis=1).view(">u8").reshape(-1)
    return out


def fingerprints(df: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)``, the fingerprint as a signed 64-bit number. Narrow; null texts count as empty."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(it, 2_000_000):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fingerprint_array(texts, width).view(np.int64))], names=["doc_id", "fp"])

    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, fp bigint")


def _mask(positions: tuple[int, ...]) -> int:
    return sum(0xFF << (8 * p) for p in positions)


def list_masks(bits: int) -> list[int]:
    """What the posting lists are keyed by: the bytes of each choice of groups of which a linked pair must share one."""
    groups = [tuple(g.tolist()) for g in np.array_split(np.arange(8), min(8, 2 * bits))]
    return [_mask(sum(some, ())) for some in combinations(groups, len(groups) - bits)]


def _masks(bits: int) -> list[int]:
    """For each choice of positions to leave free, the mask of the others."""
    return [((1 << 64) - 1) ^ _mask(free) for free in combinations(range(8), bits)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def forest(members: np.ndarray, free: int, bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the fingerprints of one posting list (all different, ``free``: free bits)."""
    members = np.sort(members)
    n = len(members)
    if n * (n - 1) // 2 <= 4096:
        i, j = np.triu_indices(n, 1)
        near = np.bitwise_count(members[i] ^ members[j]) <= bits
        found = zip(i[near].tolist(), j[near].tolist(), strict=True)
    else:
        where = [np.uint64(1 << b) for b in range(64) if free >> b & 1]
        pairs = []
        for k in range(1, bits + 1):
            for change in combinations(where, k):
                other = members ^ np.bitwise_or.reduce(np.array(change))
                at = np.minimum(np.searchsorted(members, other), n - 1)
                hit = np.flatnonzero((members[at] == other) & (members < other))
                pairs += zip(hit.tolist(), at[hit].tolist(), strict=True)
        found = iter(pairs)
    root = list(range(n))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in found:
        x, y = top(a), top(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    signed = members.view(np.int64)
    return [(int(signed[a]), int(signed[b])) for a, b in out]


def tallied(lists: np.ndarray, prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of a spanning forest of the links within posting lists. ``lists``: the list of each place, in one run each."""
    root = list(range(len(lists)))
    out: list[tuple[int, int]] = []

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for apart in range(1, len(lists)):
        pair = np.flatnonzero(lists[:-apart] == lists[apart:])
        if not len(pair):
            break
        differ = prints[pair] ^ prints[pair + apart]
        shared = np.count_nonzero(differ.view(np.uint8).reshape(-1, 8) == 0, axis=1)
        reached = np.flatnonzero(shared >= 8 - bits)
        near = reached[np.bitwise_count(differ[reached]) <= bits]
        for a in pair[near].tolist():
            x, y = top(a), top(a + apart)
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((a, a + apart))
    first, second = zip(*out, strict=True) if out else ((), ())
    return np.array(first, dtype=np.int64), np.array(second, dtype=np.int64)


def _keyed(prints: DataFrame, masks: list[int]) -> DataFrame:
    keys = F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])
    return prints.select("fp", F.explode(keys).alias("k")).select("k.i", "k.key", "fp")


def _heads(i: np.ndarray, key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], (i[1:] != i[:-1]) | (key[1:] != key[:-1]))))


def links(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Links ``(a, b)`` between different fingerprints ``fp`` (distinct rows) of at most ``bits`` differing bits: enough of
    them that every linked pair is joined by a path."""
    masks = _masks(bits)
    if not bits:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")

    def meet(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of the lists of up to ``LIST``, and the members of longer ones (``b`` is null); holds one batch."""
        held: tuple[np.ndarray, ...] | None = None
        long = None

        def of(now: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            nonlocal long
            i, key, fp = now
            heads = _heads(i, key)
            sizes = np.diff(np.append(heads, len(i)))
            big = sizes > LIST
            # a list that goes on from the batch before
            big[0] |= long == (i[0], key[0])
            long = (i[-1], key[-1]) if big[-1] else None
            many = np.repeat(big, sizes)
            small, rest = fp[~many], fp[many].view(np.int64)
            a, b = tallied(np.repeat(np.arange(len(heads)), sizes)[~many], small, bits)
            small = small.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate((small[a], rest))), pa.concat_arrays([pa.array(small[b]), pa.nulls(len(rest), pa.int64())])], names=["a", "b"])

        for batch in it:
            now = (batch.column("i").to_numpy(), batch.column("key").to_numpy(), batch.column("fp").to_numpy().view(np.uint64))
            if not len(now[0]):
                continue
            if held is not None:
                now = tuple(np.concatenate(x) for x in zip(held, now, strict=True))
            cut = _heads(now[0], now[1])[-1]
            if len(now[0]) - cut > LIST or long == (now[0][cut], now[1][cut]):
                cut = len(now[0])
            held = tuple(x[cut:] for x in now) if cut < len(now[0]) else None
            if cut:
                yield of(tuple(x[:cut] for x in now))
        if held is not None:
            yield of(held)

    def again(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] | None = None

        def of(now: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            i, key, fp = now
            heads = _heads(i, key)
            sizes = np.diff(np.append(heads, len(i)))
            out: list[tuple[int, int]] = []
            for at in np.flatnonzero(sizes > 1).tolist():
                a = heads[at]
                out += forest(fp[a : a + sizes[at]], masks[i[a]] ^ ((1 << 64) - 1), bits)
            a, b = zip(*out, strict=True) if out else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in it:
            now = (batch.column("i").to_numpy(), batch.column("key").to_numpy(), batch.column("fp").to_numpy().view(np.uint64))
            if not len(now[0]):
                continue
            if held is not None:
                now = tuple(np.concatenate(x) for x in zip(held, now, strict=True))
            cut = _heads(now[0], now[1])[-1]
            held = tuple(x[cut:] for x in now)
            if cut:
                yield of(tuple(x[:cut] for x in now))
        if held is not None:
            yield of(held)

    deal = lambda rows: rows.repartition("i", "key").sortWithinPartitions("i", "key")
    met = written(deal(_keyed(prints, list_masks(bits))).mapInArrow(meet, "a bigint, b bigint"), "met")
    found, long = met.where("b is not null"), met.where("b is null").select(F.col("a").alias("fp")).distinct()
    return found if long.isEmpty() else found.union(deal(_keyed(long, masks)).mapInArrow(again, "a bigint, b bigint"))


def near_duplicates(df: DataFrame, bits: int = BITS, width: int = WIDTH) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row: fingerprints link at ``bits`` or fewer differing bits, and
    ``component_id`` is the smallest id that links reach, the row's own included.

    Null texts count as empty; all texts without words have fingerprint zero, linked like any other. Rows that repeat an id
    keep it; null ids get a component, which is null only if no member has an id. An empty table gives no rows. Equal
    fingerprints are one node of the graph, so copies cost nothing beyond their own rows. Joins back to documents carry two
    numbers a row; a fingerprint of very many rows is joined by broadcast, so its rows stay where they are.
    """
    docs = written(fingerprints(df, width), "fingerprints")
    first = written(docs.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")), "prints")
    roots = components(links(first.select("fp"), bits))
    linked = roots.select(F.col("node").alias("fp"), "root").join(first, "fp")
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    # only fingerprints with a link have a component other than their own
    of = first.join(roots.select(F.col("node").alias("fp"), "root").join(least, "root").select("fp", "component_id"), "fp", "left")
    of = written(of.select("fp", "rows", F.coalesce("component_id", "first").alias("component_id")), "of")
    # fewer than HOT_PART fingerprints can have more than that part of all rows each
    frequent = F.col("rows") > max(1000, docs.count() // HOT_PART)
    hot = F.broadcast(of.where(frequent).select("fp", "component_id"))
    out = docs.join(hot, "fp").unionByName(docs.join(hot.select("fp"), "fp", "left_anti").join(of.where(~frequent).select("fp", "component_id"), "fp"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, bits: int = BITS, width: int = WIDTH) -> DataFrame:
    """The documents (all their columns), one of each group of near-duplicates: the one with the smallest id.

    Of rows that share an id the one whose text sorts first stays, nulls first. Rows with a null id are never dropped, as
    nothing tells them apart. Null texts count as empty, and all texts without words are one group.
    """
    found = near_duplicates(docs, bits, width)
    kept = written(found.where(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(F.count("*").alias("rows")), "kept")
    # the ids grow with the corpus, so they are never broadcast
    out = docs.join(kept.where("rows = 1").select("doc_id").hint("merge"), "doc_id", "left_semi")
    if not kept.where("rows > 1").isEmpty():
        repeated = docs.join(kept.where("rows > 1").select("doc_id"), "doc_id", "left_semi")
        first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
        out = out.unionByName(repeated.withColumn("__row", first).where("__row = 1").drop("__row"))
    nameless = docs.where(F.col("doc_id").isNull())
    return out if nameless.isEmpty() else out.unionByName(nameless)
