"""Language identification by prediction by partial matching over bytes.

For each language a context tree of bytes (contexts of up to ``ORDER`` bytes) is counted from a bounded sample of labelled
texts and then frozen. A text's code length in a language is the sum over its bytes of minus log2 of their probabilities:
the longest context that the tree has predicts the byte, or escapes (method C: as many escapes as different bytes seen) to
the next shorter one, down to a uniform distribution over 256 bytes. The language with the shortest code wins.

A text whose shortest code is longer than that of genuine text with its characters in random order (``bounds``) is of no
learned language: keyboard noise and encoded data are.

The trees of all languages are laid out as hashed arrays of byte n-grams with one code length per language, escapes already
resolved, so a block of texts is scored by array look-ups; grams that no tree has go to the next lower order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswright.llm.common import batches, fold

ORDER = 4
#: Bounds of the training sample: bytes of all languages together, and of one language.
SAMPLE_BYTES = 16_000_000
LANGUAGE_BYTES = 1_000_000
#: Characters of a piece of a long document.
PIECE = 4096
UNDETERMINED = "und"
#: Lengths for which a bound is worked out: powers of two up to this one; pieces of each; and the share of these in random
#: order that cost less than the bound.
LONGEST, PIECES, SHARE = 13, 400, 0.99
_LETTER = regex.compile(r"\p{L}")
_PRIME = np.uint64(0x9E3779B97F4A7C15)


class GramTable:
    """Unsigned keys to row numbers, by open addressing; -1 for none."""

    def __init__(self, keys: np.ndarray) -> None:
        self.bits = max(4, int(4 * max(1, len(keys)) - 1).bit_length())
        self.slot_key = np.zeros(1 << self.bits, dtype=np.uint64)
        self.slot_row = np.full(1 << self.bits, -1, dtype=np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        slot = self._slot(keys)
        while len(left):
            free = self.slot_row[slot[left]] < 0
            taken, first = np.unique(slot[left[free]], return_index=True)
            rows = left[free][first]
            self.slot_key[taken], self.slot_row[taken] = keys[rows], rows
            left = left[self.slot_row[slot[left]] != left]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _PRIME) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        row = self.slot_row[slot]
        wrong = np.flatnonzero((row >= 0) & (self.slot_key[slot] != keys))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & ((1 << self.bits) - 1)
            row[wrong] = self.slot_row[slot[wrong]]
            wrong = wrong[(row[wrong] >= 0) & (self.slot_key[slot[wrong]] != keys[wrong])]
        return row


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """The last ``size`` bytes at each position as one number; the first ``ORDER`` positions wrap and are not for use."""
    key = np.zeros(len(data), dtype=np.uint64)
    for back in range(size - 1, -1, -1):
        key = (key << np.uint64(8)) | np.roll(data, back).astype(np.uint64)
    return key


def join(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, each after ``order`` zero bytes; where each begins, and its length in bytes."""
    pad = b"\x00" * order
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    length = np.fromiter(map(len, raw), np.int64, len(raw))
    begin = np.cumsum(length + order) - length
    return np.frombuffer(pad + pad.join(raw), dtype=np.uint8), begin, length


class ContextTrees:
    """Frozen context trees of several languages."""

    def __init__(self, texts: dict[str, list[str]], order: int = ORDER) -> None:
        # a language without a byte of text has no statistics, and would cost 8 bits whatever the byte
        self.languages, self.order = sorted(k for k, some in texts.items() if any(some)), order
        n = len(self.languages)
        self.cost: list[np.ndarray] = []
        self.escape: list[np.ndarray] = []
        self.gram_of: list[GramTable] = []
        self.context_of: list[GramTable] = []
        joined = [join(texts[language], order) for language in self.languages]
        used = []
        for data, begin, length in joined:
            inside = np.zeros(len(data), dtype=bool)
            for b, m in zip(begin.tolist(), length.tolist(), strict=True):
                inside[b : b + m] = True
            used.append(inside)
        for size in range(1, order + 2):
            seen = [np.unique(grams(data, size)[inside], return_counts=True) for (data, _, _), inside in zip(joined, used, strict=True)]
            keys = np.unique(np.concatenate([k for k, _ in seen])) if n else np.zeros(0, np.uint64)
            count = np.zeros((len(keys), n))
            for j, (k, c) in enumerate(seen):
                count[np.searchsorted(keys, k), j] = c
            context, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, kinds = np.zeros((len(context), n)), np.zeros((len(context), n))
            for j in range(n):
                total[:, j] = np.bincount(of, count[:, j], len(context))
                kinds[:, j] = np.bincount(of, count[:, j] > 0, len(context))
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                direct = -np.log2(count / (total + kinds)[of])
            if size == 1:
                lower = np.full((len(keys), n), 8.0)
            else:
                suffix = keys & np.uint64((1 << (8 * (size - 1))) - 1)
                lower = self.cost[-1][self.gram_of[-1].find(suffix)]
            self.cost.append(np.where(count > 0, direct, escape[of] + lower))
            self.escape.append(escape)
            self.gram_of.append(GramTable(keys))
            self.context_of.append(GramTable(context))

    def code_lengths(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each text in each language, and the bytes of each text."""
        data, begin, length = join(texts, self.order)
        n = len(self.languages)
        out = np.zeros((len(texts), n))
        owner = np.repeat(np.arange(len(texts)), length)
        at = np.arange(len(owner)) + np.repeat(begin - (np.cumsum(length) - length), length)
        key = grams(data, self.order + 1)[at]
        for size in range(self.order + 1, 0, -1):
            row = self.gram_of[size - 1].find(key)
            hit = row >= 0
            self._add(out, owner[hit], self.cost[size - 1], row[hit])
            key, owner = key[~hit], owner[~hit]
            if not len(key):
                return out, length
            row = self.context_of[size - 1].find(key >> np.uint64(8))
            known = row >= 0
            self._add(out, owner[known], self.escape[size - 1], row[known])
            key &= np.uint64((1 << (8 * (size - 1))) - 1)
        out += 8.0 * np.bincount(owner, minlength=len(texts))[:, None]
        return out, length

    @staticmethod
    def _add(out: np.ndarray, owner: np.ndarray, values: np.ndarray, row: np.ndarray) -> None:
        """Adds the values' rows to their owners' (owners ascend)."""
        if len(owner):
            heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            out[owner[heads]] += np.add.reduceat(values[row], heads, axis=0)


def sample(df: DataFrame, label: str, keep: Column, total: int, each: int) -> dict[str, list[str]]:
    """Texts by label: up to about ``each`` characters a label and ``total`` in all, never none of a label that has text.

    A document gives at most so many characters as let every document of its label give as much, or all it has: whole if it
    has fewer, else in pieces of ``PIECE`` characters at even distances from a hashed start. Where one piece of each is still
    too much, documents are chosen by a hash of their id and text. No label gives more than twice its bound and a piece;
    labels of which all texts are empty are left out.
    """
    labelled = df.where(keep & F.col(label).isNotNull() & (F.length("text") > 0))
    size = F.length("text").cast("long")
    n_labels = labelled.select(label).distinct().count()
    if not n_labels:
        return {}
    bound = max(1, min(each, total // n_labels))
    piece = min(PIECE, bound)
    caps = [piece << k for k in range(max(1, (bound // piece).bit_length()) + 1)]
    pieces, share = F.lit(0), F.lit(0.0)
    for value, *sums in labelled.groupBy(label).agg(*[F.sum(F.least(size, F.lit(c))) for c in caps]).collect():
        fit = [k for k, s in enumerate(sums) if s <= bound]
        pieces = F.when(F.col(label) == value, F.lit(1 << fit[-1] if fit else 1)).otherwise(pieces)
        share = F.when(F.col(label) == value, F.lit(1.0 if fit else bound / sums[0])).otherwise(share)
    # of two hashes: one chooses documents, one the places in them
    unit = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    start = F.pmod(F.xxhash64("text", "doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    has = F.ceil(size / F.lit(piece))
    some = F.expr(f"transform(sequence(0, pieces - 1), j -> substring(text, cast(floor((j + start) * has / pieces) as int) * {piece} + 1, {piece}))")
    dealt = labelled.select(F.col(label).alias("label"), "text", pieces.alias("pieces"), share.alias("share"), unit.alias("unit"), start.alias("start"), has.alias("has"))
    dealt = dealt.withColumn("texts", F.when(F.col("has") <= F.col("pieces"), F.array("text")).otherwise(some))
    out: dict[str, list[str]] = {}
    taken: dict[str, int] = {}
    for value, texts in dealt.where("unit < share").select("label", "texts").toLocalIterator():
        for text in texts:
            if text and taken.get(value, 0) < 2 * bound:
                out.setdefault(value, []).append(text)
                taken[value] = taken.get(value, 0) + len(text)
    # by chance none was chosen: the one with the least hash
    missed = dealt.where(~F.col("label").isin(list(out))) if out else dealt
    if len(out) < n_labels:
        for value, texts in missed.groupBy("label").agg(F.min_by("texts", "unit")).collect():
            out[value] = [t for t in texts if t]
    return out


def train(df: DataFrame, folds: int = 5, order: int = ORDER, total: int = SAMPLE_BYTES, each: int = LANGUAGE_BYTES) -> ContextTrees:
    """Trees from ``text`` and non-null ``lang`` of the rows outside the held-out fold."""
    return ContextTrees(sample(df.select("doc_id", "text", "lang"), "lang", fold("doc_id", folds) != 0, total, each), order)


def bounds(trees: ContextTrees, texts: list[str], seed: int = 1) -> np.ndarray:
    """The most bits a byte that a text of a learned language costs, by the number of binary digits of its bytes.

    For each length: nearly the most (``SHARE``) that pieces of genuine texts cost whose characters are in random order, and
    no less than genuine pieces do. A length that no text has takes the bound of the one below; without texts there is none.
    """
    random = np.random.default_rng(seed)
    out = np.full(64, np.inf)
    for k in range(LONGEST):
        starts = [(text, at) for text in texts for at in range(0, len(text) - (1 << k) + 1, 1 << k)]
        chosen = [starts[i] for i in random.permutation(len(starts))[:PIECES].tolist()]
        pieces = [text[at : at + (1 << k)] for text, at in chosen]
        if not pieces or not trees.languages:
            out[k + 1 :] = out[k]
            break
        mixed = ["".join(p[i] for i in random.permutation(len(p)).tolist()) for p in pieces]
        cost = [bits.min(axis=1) / np.maximum(length, 1) for bits, length in map(trees.code_lengths, (pieces, mixed))]
        out[k + 1 :] = max(np.quantile(cost[0], SHARE), np.quantile(cost[1], SHARE))
    return out


def calibrated(df: DataFrame, folds: int = 5, order: int = ORDER, total: int = SAMPLE_BYTES, each: int = LANGUAGE_BYTES) -> tuple[ContextTrees, np.ndarray]:
    """Trees as by ``train``, but for every tenth text of the sample; and the bounds, which these texts give."""
    some = sample(df.select("doc_id", "text", "lang"), "lang", fold("doc_id", folds) != 0, total, each)
    learned = {k: [t for i, t in enumerate(texts) if i % 10 != 9] for k, texts in some.items()}
    trees = ContextTrees(learned, order)
    return trees, bounds(trees, [t for k in sorted(some) for t in some[k][9::10]])


def identify(df: DataFrame, trees: ContextTrees, carry: tuple[str, ...] = (), most: np.ndarray | None = None) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, bits_per_byte, is_text)`` of every row, from its whole text alone.

    Null texts, and texts with no letter, are ``und`` with score 0; so is everything if no language was learned. Ties go
    to the language whose name sorts first. The score is the share of the best language when each language weighs
    ``2 ** (-excess bits / sqrt(bytes))``. ``is_text``: it has a letter, and costs no more than its length's bound in ``most``
    (as ``bounds`` gives it; none: anything with a letter is). Columns named in ``carry`` are kept as well (none may have the name of a result).
    Repeated rows and null ids are kept; an empty table gives no rows. Narrow: one row in, one row out.
    """
    shared = df.sparkSession.sparkContext.broadcast(trees)
    more = [c for c in carry if c != "doc_id"]
    kinds = {f.name: f.dataType.simpleString() for f in df.select("doc_id", "text", *[c for c in more if c != "text"]).schema}
    limit = np.full(64, np.inf) if most is None else most
    narrow = df.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "text", *[c for c in more if c != "text"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch, texts in batches(it, 1_000_000):
            bits, length = model.code_lengths(texts)
            best, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            if model.languages:
                excess = (bits - bits.min(axis=1, keepdims=True)) / np.sqrt(np.maximum(length, 1))[:, None]
                share, top = 1 / np.exp2(-excess).sum(axis=1), bits.argmin(axis=1)
                for i, text in enumerate(texts):
                    if _LETTER.search(text):
                        best[i], score[i] = model.languages[top[i]], share[i]
            per_byte = (bits.min(axis=1) if model.languages else np.zeros(len(texts))) / np.maximum(length, 1)
            is_text = (per_byte <= limit[np.frexp(length.astype(float))[1]]) & np.array([b != UNDETERMINED for b in best], dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(best, pa.string()), pa.array(score), pa.array(per_byte), pa.array(is_text), *[batch.column(c) for c in more]],
                names=["doc_id", "held_out", "lang_pred", "score", "bits_per_byte", "is_text", *more],
            )

    return narrow.mapInArrow(run, f"doc_id {kinds['doc_id']}, held_out boolean, lang_pred string, score double, bits_per_byte double, is_text boolean" + "".join(f", `{c}` {kinds[c]}" for c in more))
