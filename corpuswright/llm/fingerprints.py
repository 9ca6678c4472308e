"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed left to right into LZ78 phrases (the shortest string that is not yet in the text's own dictionary). The
set of phrases is hashed and kept as a minimum-hash signature: two texts that a compressor would code with the same phrases
agree in many places of it. The share of agreeing places is their likeness (an estimate of the Jaccard index of the phrase
sets). Equal texts have equal signatures.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.llm.common import batches

#: Places of a signature; each is 16 bits.
PLACES = 64
_FACTORS = np.random.default_rng(20240229).integers(1, 2**63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FIRST_ID = -(2**63)


class Parse:
    """LZ78 phrases of a text, in order, with the state at one position of it."""

    def __init__(self, text: str, mark: int | None = None) -> None:
        self.phrases: list[str] = []
        seen: set[str] = set()
        mark = len(text) if mark is None else mark
        current = self._run(text[:mark], "", seen)
        self.known, self.current = len(self.phrases), current
        self._run(text[mark:], current, seen)

    def _run(self, text: str, current: str, seen: set[str]) -> str:
        add, append = seen.add, self.phrases.append
        for character in text:
            current += character
            if current not in seen:
                add(current)
                append(current)
                current = ""
        return current

    def tail(self, text: str) -> list[str]:
        """The new phrases if ``text`` came after the marked position instead."""
        kept, self.phrases = self.phrases, []
        self._run(text, self.current, set(kept[: self.known]))
        kept, self.phrases = self.phrases, kept
        return kept


def signature(phrases: list[str]) -> np.ndarray:
    """Minimum of each hash over the phrases, 64 bits wide; all ones for none."""
    low = np.full(PLACES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(phrases), 8192):
        some = phrases[at : at + 8192]
        raw = "\x00".join(some).encode("utf-8", "surrogatepass").split(b"\x00")
        if len(raw) != len(some):
            raw = [p.encode("utf-8", "surrogatepass") for p in some]
        hashes = np.fromiter(map(zlib.crc32, raw), np.uint64, len(raw)) + np.uint64(1)
        np.minimum(low, (hashes[:, None] * _FACTORS).min(axis=0), out=low)
    return low


def short(low: np.ndarray) -> np.ndarray:
    return (low >> np.uint64(48)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray, a_empty: bool, b_empty: bool) -> float:
    if a_empty or b_empty:
        return float(a_empty and b_empty)
    return float(np.count_nonzero(a == b)) / PLACES


def fingerprint(text: str | None) -> str:
    """The signature of one text (null: empty), in hexadecimal."""
    return short(signature(Parse(text or "").phrases)).tobytes().hex()


SCHEMA = "doc_id {}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


class _Document:
    """A document with its parse; the parse is marked where its edited text departs."""

    def __init__(self, doc_id: int | None, text: str) -> None:
        self.doc_id, self.text = doc_id, text
        self.swap = len(text) // 4
        self.parse = Parse(text, len(text) - self.swap)
        self.low = signature(self.parse.phrases[: self.parse.known])
        self.full = short(np.minimum(self.low, signature(self.parse.phrases[self.parse.known :])))

    def row(self, after: _Document) -> tuple:
        new = after.text[: self.swap]
        edited = self.text[: len(self.text) - self.swap] + new
        changed = short(np.minimum(self.low, signature(self.parse.tail(new))))
        return (
            self.doc_id,
            len(self.text),
            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            self.full.tobytes().hex(),
            changed.tobytes().hex(),
            likeness(self.full, changed, not self.text, not edited),
            likeness(self.full, after.full, not self.text, not after.text),
        )


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text (its last quarter replaced by the next document's start).

    The next document is by ascending id; after the last comes the first; a lone document follows itself. Rows that share
    an id follow each other in the order of their texts; null ids come first. Null texts count as empty; two empty texts
    are alike (1), an empty and another are not (0). An empty table gives no rows. Other columns are not read.

    Ids are cut into ranges at ids that occur (the driver holds one id per range); the first document of a range is also
    sent to the range before, so each range is worked out by itself. The texts are shuffled once.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError(f"{id_col} must be an integer column")
    narrow = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_FIRST_ID)).alias("key"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / ranges for i in range(1, ranges)]
    low, middle = narrow.agg(F.min("key"), F.percentile_approx("key", cuts, 20 * ranges)).first()
    bounds = np.array(sorted({low, *middle}) if low is not None else [0], dtype=np.int64)

    @F.pandas_udf("array<int>")
    def places(key: pd.Series) -> pd.Series:
        ids = key.to_numpy(dtype=np.int64)
        own = np.maximum(np.searchsorted(bounds, ids, side="right") - 1, 0)
        first = bounds[own] == ids
        return pd.Series([[a, -1 - (a - 1) % len(bounds)] if f else [a] for a, f in zip(own.tolist(), first.tolist(), strict=True)])

    # a negative place is a copy for the range before
    dealt = narrow.select("key", "doc_id", "text", F.explode(places("key")).alias("place"))
    dealt = dealt.select(F.when(F.col("place") < 0, -1 - F.col("place")).otherwise(F.col("place")).alias("part"), (F.col("place") < 0).alias("copy"), "key", "doc_id", "text")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, done = None, None, False
        for batch, texts in batches(it):
            rows = []
            for p, copy, doc_id, text in zip(batch.column("part").to_pylist(), batch.column("copy").to_pylist(), batch.column("doc_id").to_pylist(), texts, strict=True):
                if p != part:
                    part, before, done = p, None, False
                if done:
                    continue
                now = _Document(doc_id, text)
                if before is not None:
                    rows.append(before.row(now))
                before, done = now, copy
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=NAMES)

    id_type = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}[kind]
    types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return dealt.repartition("part").sortWithinPartitions("part", "copy", "key", "text").mapInArrow(run, SCHEMA.format(kind))
