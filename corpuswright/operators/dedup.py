"""Exact and near duplicates."""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

try:
    # the interpreter's own, which is not looked up by name for every run of words
    from _md5 import md5
except ImportError:
    from hashlib import md5

from corpuswright.functions.text import dedup_key
from corpuswright.operators.graph import components
from corpuswright.plans.storage import written

SHINGLE = 5
BANDS, ROWS = 14, 8


def exact_groups(df: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """``(keep_id, copies, key)``: a row for each different text (by its digest after normalisation), with its smallest id."""
    keyed = df.select(F.col(id_col).alias("__id"), F.md5(F.coalesce(dedup_key(text_col), F.lit("")).cast("binary")).alias("key"))
    return keyed.groupBy("key").agg(F.min("__id").alias("keep_id"), F.count("*").alias("copies")).select("keep_id", "copies", "key")


def exact_dedup(df: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """The rows whose id is the smallest of their text."""
    return df.join(exact_groups(df, id_col, text_col).select(F.col("keep_id").alias(id_col)), id_col, "left_semi")


def plain(key: Column | str) -> Column:
    """A normalised text with its punctuation made spaces."""
    return F.regexp_replace(F.col(key) if isinstance(key, str) else key, r"[^\p{L}\p{N}\s]+", " ")


def shingle_hashes(text: str, size: int = SHINGLE) -> np.ndarray:
    """The leading 31 bits of the MD5 digest (which any SQL engine can work out) of each different run of ``size`` words; a
    shorter text is one run, a text without words has none."""
    some = text.split()
    if not some:
        return np.zeros(0, np.int64)
    line = " ".join(some).encode("utf-8", "surrogatepass")
    sizes = map(len, some) if text.isascii() else (len(w.encode("utf-8", "surrogatepass")) for w in some)
    ends = list(accumulate(sizes, lambda a, n: a + n + 1))
    runs = {line[a:b] for a, b in zip([0, *(e + 1 for e in ends)], ends[size - 1 :], strict=False)} if len(some) > size else {line}
    return (np.frombuffer(b"".join([md5(r).digest() for r in runs]), ">u4")[::4] >> 1).astype(np.int64)


PRIME = (1 << 31) - 1


def permutations(n: int = BANDS * ROWS) -> list[tuple[int, int]]:
    """Factors and offsets of the hash functions, from a fixed rule."""
    return [(1 + (i * 1_103_515_245 + 12_345) % (PRIME - 1), (i * 69_069 + 362_437) * 40_503 % PRIME) for i in range(1, n + 1)]


#: Hashes that are worked out together: their products with all factors stay in a core's cache.
_TOGETHER = 64


def least_hashes(h: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The least remainder of ``h * factor + offset`` by the prime 2 ** 31 - 1, for every factor and its offset.

    The numbers are below the prime's square: their upper bits added to the lower ones are below twice the prime, which fits
    32 bits; where that is less than the prime, taking it off wraps around to a larger number.
    """
    low = np.full(len(factors), PRIME, dtype=np.uint32)
    x, y = (np.empty((_TOGETHER, len(factors)), np.int64) for _ in range(2))
    for at in range(0, len(h), _TOGETHER):
        some = h[at : at + _TOGETHER, None]
        x, y = x[: len(some)], y[: len(some)]
        np.multiply(some, factors, out=x)
        x += offsets
        np.right_shift(x, 31, out=y)
        x &= PRIME
        x += y
        rest = x.astype(np.uint32)
        np.minimum(rest, rest - np.uint32(PRIME), out=rest)
        np.minimum(low, rest.min(axis=0), out=low)
    return low.astype(np.int64)


def signature(text: Column | str, n: int = BANDS * ROWS, size: int = SHINGLE) -> Column:
    """Minimum of every hash function over a text's shingles; null for a text without words.

    One pass in Python: as an expression, the words would be split again for every shingle. The products fit 64 bits.
    """
    factors, offsets = (np.array(x, dtype=np.int64) for x in zip(*permutations(n), strict=True))

    @F.pandas_udf("array<long>")
    def least(texts: pd.Series) -> pd.Series:
        def of(t: str | None) -> np.ndarray | None:
            h = shingle_hashes(t or "", size)
            if not len(h):
                return None
            return least_hashes(h, factors, offsets)

        return texts.map(of)

    return least(text)


def bands(df: DataFrame, id_col: str = "id", text_col: str = "text", n_bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """``(id, band, key)``: a row for each document and band of its signature. Texts without words have none."""
    signed = df.select(F.col(id_col).alias("id"), signature(plain(dedup_key(text_col)), n_bands * rows, size).alias("__signature"))
    parts = F.array(*[F.struct(F.lit(b).alias("band"), F.md5(F.array_join(F.slice(F.col("__signature"), b * rows + 1, rows).cast("array<string>"), ",").cast("binary")).alias("key")) for b in range(n_bands)])
    # a text without words has null keys; a filter on the signature itself would work it out twice
    return signed.select("id", F.explode(parts).alias("p")).select("id", "p.band", "p.key").where(F.col("key").isNotNull())


def band_links(banded: DataFrame) -> DataFrame:
    """Links from each document to the first of its bucket: as many as rows, however large a bucket is."""
    first = banded.groupBy("band", "key").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    return banded.join(first, ["band", "key"]).where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()


def near_groups(df: DataFrame, id_col: str = "id", text_col: str = "text", **options: int) -> DataFrame:
    """``(id, keep_id, cluster_size)`` of every document that shares a bucket with another, by links of any length."""
    banded = written(bands(df, id_col, text_col, **options), "bands")
    roots = components(band_links(banded))
    kept = roots.groupBy("root").agg(F.min("node").alias("keep_id"), F.count("*").alias("cluster_size"))
    return roots.join(kept, "root").select(F.col("node").alias("id"), "keep_id", "cluster_size")


def near_dedup(df: DataFrame, id_col: str = "id", text_col: str = "text", **options: int) -> tuple[DataFrame, DataFrame]:
    """The rows that stay (the smallest id of each group, and all that are in none), and the rows that go, for the record."""
    gone = written(near_groups(df, id_col, text_col, **options).where("id <> keep_id"), "duplicates").select(F.col("id").alias(id_col))
    return df.join(gone, id_col, "left_anti"), df.join(gone, id_col, "left_semi")
