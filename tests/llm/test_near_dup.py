"""SimHash groups against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash

from corpuswright.llm import near_dup
from corpuswright.operators import graph


def print_by_hand(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, ids):
    """Smallest id reachable over all pairs of at most two differing bits."""
    root = list(range(len(prints)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    array = np.array(prints, dtype=np.uint64)
    for i in range(len(array)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= 2).tolist():
            root[top(j)] = top(i)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[top(i)] = min(least.get(top(i), x), x)
    return [least.get(top(i)) for i in range(len(prints))]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def wanted(rows):
    prints = [print_by_hand(t) for _, t in rows]
    return sorted(((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, groups(prints, [i for i, _ in rows]), strict=True)), key=str)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_all_pairs(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows_of(near_dup.near_duplicates(docs)) == wanted(rows)


def test_edges(spark):
    rows = [(7, None), (3, ""), (9, " \n"), (1, "one two three four"), (2, "ONE two\tthree  four"), (2, "one two three four"), (4, "one two"), (5, "One TWO"), (None, "lonely words here now"), (None, "one two"), (6, "x" * 100_000), (8, "a b c " * 50_000)]
    df = spark.createDataFrame([(i, t, "c", 0) for i, t in rows], "doc_id long, text string, component_id string, fp int")
    assert rows_of(near_dup.near_duplicates(df)) == wanted(rows)
    assert near_dup.near_duplicates(df.where("false")).count() == 0


def family(seed, n=300):
    """Random fingerprints in chains of one or two changed bits, close ones and far ones."""
    random = np.random.default_rng(seed)
    prints = set(random.integers(0, 2**64, n, dtype=np.uint64).tolist())
    for p in list(prints)[: n // 2]:
        for _ in range(random.integers(1, 6)):
            for b in random.choice(64, random.integers(1, 4), replace=False).tolist():
                p ^= 1 << b
            prints.add(p)
    return sorted(prints)


def joined(prints, found, bits=2):
    root = {p: p for p in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        a, b = int(a) & (2**64 - 1), int(b) & (2**64 - 1)
        assert (a ^ b).bit_count() <= bits
        root[top(a)] = top(b)
    first = {}
    for i, p in enumerate(prints):
        first.setdefault(top(p), i)
    return [first[top(p)] for p in prints]


def test_links_join_every_near_pair():
    prints = family(5)
    array, ids = np.array(prints, dtype=np.uint64), list(range(len(prints)))
    found = []
    for mask in near_dup._masks(2):
        keys = array & np.uint64(mask)
        for key in np.unique(keys):
            found += near_dup.forest(array[keys == key], mask ^ (2**64 - 1), 2)
    assert joined(prints, found) == groups(prints, ids)


def test_tallies_in_posting_lists_find_every_near_pair():
    assert near_dup.list_masks(2) == [0xFFFFFFFF, 0xFFFF0000FFFF, 0xFFFF00000000FFFF, 0xFFFFFFFF0000, 0xFFFF0000FFFF0000, 0xFFFFFFFF00000000]
    prints = family(6)
    array, found = np.array(prints, dtype=np.uint64), []
    for mask in near_dup.list_masks(2):
        order = np.argsort(array & np.uint64(mask), kind="stable")
        _, lists = np.unique(array[order] & np.uint64(mask), return_inverse=True)
        a, b = near_dup.tallied(lists, array[order], 2)
        assert (lists[a] == lists[b]).all()
        found += zip(array[order][a].tolist(), array[order][b].tolist(), strict=True)
    assert joined(prints, found) == groups(prints, list(range(len(prints))))


@pytest.mark.parametrize("bits, most", [(1, 64), (2, 64), (2, 3), (3, 64), (3, 2)])
def test_long_lists_are_dealt_again(spark, monkeypatch, bits, most):
    """Fingerprints around a few centres, so that many share the bytes of a list."""
    monkeypatch.setattr(near_dup, "LIST", most)
    random, prints = np.random.default_rng(bits), set(family(7, 40))
    for centre in random.integers(0, 2**64, 3, dtype=np.uint64).tolist():
        for _ in range(150):
            p = centre
            for b in random.choice(64, random.integers(1, 7), replace=False).tolist():
                p ^= 1 << b
            prints.add(p)
    prints = sorted(prints)
    df = spark.createDataFrame([(p - 2**64 if p >> 63 else p,) for p in prints], "fp long").repartition(3)
    found = [(r.a, r.b) for r in near_dup.links(df, bits).collect()]
    array = np.array(prints, dtype=np.uint64)
    every = [(p, int(q)) for p in prints for q in array[np.bitwise_count(array ^ np.uint64(p)) <= bits]]
    assert joined(prints, found, bits) == joined(prints, every, bits)


def test_large_posting_list_equals_small_one():
    array = np.unique(np.random.default_rng(1).integers(0, 1 << 16, 900, dtype=np.uint64))
    links = near_dup.forest(array, 0xFFFF, 2)
    by_hand = groups(array.tolist(), list(range(len(array))))
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    # a forest has a link less than nodes for each tree
    assert len(links) == len(array) - len(set(by_hand))


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (5000, 5000), (1001, 1002), (None, 3)] + [(2000, 2000 + i) for i in range(1, 300)]
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert len({found[i] for i in range(201)}) == 1 and len({found[i] for i in (1000, 1001, 1002)}) == 1
    assert len({found[2000 + i] for i in range(300)}) == 1 and len(set(found.values())) == 3
    assert 5000 not in found and None not in found
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each(spark):
    rows = [(1, "one two three four", "x"), (2, "one two three four", "y"), (1, "other words are here", "z"), (1, "one two three four", "x"), (None, "one two three four", "n"), (5, None, "e"), (4, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, more string")
    kept = rows_of(near_dup.one_of_each(df))
    assert kept == sorted([(1, "one two three four", "x"), (None, "one two three four", "n"), (4, "", "e")], key=str)
