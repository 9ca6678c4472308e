"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuswright.plans.storage import written

__all__ = ["SLICE_CHARS", "WordCache", "batches", "fold", "map_arrow", "slices", "table", "written"]

#: Characters of text that a Python worker handles at once.
SLICE_CHARS = 8_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, by Spark's reader alone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``; a null id counts as crc 0."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")), F.lit(0)) % folds


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters, whole texts only."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def batches(it: Iterable[pa.RecordBatch], limit: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Pieces of Arrow batches with their texts (null: empty), each of bounded size."""
    for batch in it:
        column = batch.column("text")
        lengths = column.nbytes
        step = batch.num_rows if lengths <= 4 * limit else max(1, batch.num_rows * 4 * limit // lengths)
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            texts = [t or "" for t in part.column("text").to_pylist()]
            for a, b in slices(texts, limit):
                yield part.slice(a, b - a), texts[a:b]


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` under a name of our own, so that call sites stay short."""
    return df.mapInArrow(fn, schema)


class WordCache:
    """Values for distinct words, bounded by entries and by characters; emptied when it is full.

    A word's value is a pure function of the word, so emptying the cache changes only the time taken. Beyond its bounds it
    holds the words of one call at most.
    """

    def __init__(self, compute: Callable[[list[str]], list], limit: int = 700_000, chars: int = 12_000_000) -> None:
        self.compute, self.limit, self.chars, self.of = compute, limit, chars, {}
        self.held = 0

    def learn(self, words: Iterable[list]) -> dict:
        """The mapping, with a value for each of the words."""
        fresh = set()
        for some in words:
            fresh.update(some)
        fresh.difference_update(self.of)
        if fresh:
            size = sum(map(len, fresh))
            if self.of and (len(self.of) + len(fresh) > self.limit or self.held + size > self.chars):
                self.of.clear()
                self.held = 0
                return self.learn(words)
            new = list(fresh)
            self.of.update(zip(new, self.compute(new), strict=True))
            self.held += size
        return self.of
