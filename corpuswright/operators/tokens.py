"""Token counting, byte-pair merges, morpheme segmentation and the integer-vocabulary tokenizer."""

from __future__ import annotations

import json
import signal
import threading
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import cache
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswright.functions.text import stable_unit, turkish_lower, word_count, words
from corpuswright.plans.storage import written

MARK = "▁"
#: Longer words are junk that no analyser should see.
LONGEST_WORD = 70
#: Characters of the texts that name their words together.
BLOCK_CHARS = 8_000_000
#: Seconds that an analyser may take for one word.
WORD_SECONDS = 1.0

#: Different words that a worker holds at once, and their characters.
HELD_WORDS, HELD_CHARS = 200_000, 3_000_000

Merges = list[tuple[str, str]]


class Held(dict):
    """Values of keys, each worked out when it is first asked for; emptied when it has too many keys or characters.

    A value is a function of its key alone, so emptying changes only the time taken.
    """

    def __init__(self, compute: Callable, most: int = HELD_WORDS, chars: int = HELD_CHARS) -> None:
        super().__init__()
        self.compute, self.most, self.chars, self.size = compute, most, chars, 0

    def __missing__(self, key: str | bytes) -> object:
        if len(self) >= self.most or self.size + len(key) > self.chars:
            self.clear()
            self.size = 0
        self.size += len(key)
        found = self[key] = self.compute(key)
        return found

    def __reduce__(self) -> tuple:
        # what one process holds is not sent to others
        return Held, (self.compute, self.most, self.chars)


# ---- counters

@cache
def _library_tokenizer(path: str) -> Callable[[list[str]], list[int]]:
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda texts: [len(x.ids) for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def is_merges_file(path: str) -> bool:
    """Whether a JSON file has the morpheme separator at its top, as files of merges do."""
    try:
        found = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return False
    return isinstance(found, dict) and "morph_sep" in found


def counter(spec: str | None = None, analyze: Callable[[str], list[str]] | None = None) -> Callable[[Column], Column]:
    """Column of token counts for a tokenizer: none or ``whitespace``, a SentencePiece ``.model``, a file of morpheme merges, or
    a ``tokenizers`` file. Null and empty texts count 0."""
    if spec in (None, "", "whitespace"):
        return word_count
    if spec.endswith(".json") and is_merges_file(spec):
        segmenter = MergeEncoder(load_merges(spec), analyze or (lambda w: [w]))

        @F.pandas_udf("long")
        def count_merged(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            # numbers alone are held, not the pieces
            number = Held(lambda w: len(segmenter.merged(w))).__getitem__
            for some in texts:
                yield some.map(lambda t: sum(map(number, t.split())) if t else 0)

        return count_merged

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series(_library_tokenizer(spec)([t or "" for t in texts]), dtype="int64")

    return count


def count_tokens(df: DataFrame, count: Callable[[Column], Column] = word_count, rate: float = 1.0, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """The rows with ``token_count``: of all, or of those that a stable sample takes (null for others, whose texts are never
    given to the tokenizer)."""
    if not 0 < rate <= 1:
        raise ValueError("the rate must be above 0, and 1 at most")
    if rate == 1:
        return df.withColumn("token_count", count(F.col(text_col)))
    taken = stable_unit(id_col) < rate
    given = F.when(taken, F.col(text_col)).otherwise("")
    return df.withColumn("token_count", F.when(taken, count(given)))


def token_estimate(counted: DataFrame, rate: float = 1.0) -> DataFrame:
    """``(documents, counted_docs, tokens, estimated_tokens)``."""
    return counted.agg(F.count("*").alias("documents"), F.count("token_count").alias("counted_docs"), F.coalesce(F.sum("token_count"), F.lit(0)).alias("tokens"), (F.coalesce(F.sum("token_count"), F.lit(0)) / rate).alias("estimated_tokens"))


def fertility(df: DataFrame, count: Callable[[Column], Column] = word_count, morphemes: Callable[[Column], Column] | None = None, text_col: str = "text", group: tuple[str, ...] = ()) -> DataFrame:
    """``n_texts, words, tokens, tokens_per_word`` and, with a morpheme counter, ``morphemes, tokens_per_morpheme``; 0 where there
    is nothing to divide by."""
    numbers = df.select(*group, word_count(text_col).alias("w"), count(F.col(text_col)).alias("t"), *([morphemes(F.col(text_col)).alias("m")] if morphemes else []))
    ratio = lambda a, b: F.coalesce(F.try_divide(F.sum(a), F.sum(b)), F.lit(0.0))
    made = [F.count("*").alias("n_texts"), F.sum("w").alias("words"), F.sum("t").alias("tokens"), ratio("t", "w").alias("tokens_per_word")]
    if morphemes:
        made += [F.sum("m").alias("morphemes"), ratio("t", "m").alias("tokens_per_morpheme")]
    return numbers.groupBy(*group).agg(*made)


# ---- merges

def apply_merges(symbols: list[str], rank: dict[tuple[str, str], int]) -> list[str]:
    """Merges the adjacent pair of lowest rank, the leftmost of equals, until no pair has a rank."""
    out = list(symbols)
    while len(out) > 1:
        best, at = min((rank.get(pair, len(rank)), i) for i, pair in enumerate(zip(out, out[1:], strict=False)))
        if best == len(rank):
            break
        out[at : at + 2] = [out[at] + out[at + 1]]
    return out


def learn_merges(words_: Iterable[tuple[list[str], int]], n_merges: int, min_freq: int = 2) -> Merges:
    """Learns merges from words (as symbols) and their frequencies: each time the most frequent adjacent pair, the smallest of
    equals. Stops below ``min_freq`` (0 or less: never). Words without a pair or frequency do not count.

    For a bounded table of words. Only the words that hold the merged pair are counted again.
    """
    held = [(list(s), f) for s, f in words_ if len(s) > 1 and f > 0]
    freq: Counter = Counter()
    where: dict[tuple[str, str], set[int]] = defaultdict(set)

    def count(i: int, sign: int) -> None:
        symbols, f = held[i]
        for pair in zip(symbols, symbols[1:], strict=False):
            freq[pair] += sign * f
            if sign > 0:
                where[pair].add(i)

    for i in range(len(held)):
        count(i, 1)
    merges: Merges = []
    while len(merges) < n_merges:
        best = min(((-n, pair) for pair, n in freq.items() if n > 0), default=None)
        if best is None or min_freq > 0 and -best[0] < min_freq:
            break
        pair = best[1]
        merges.append(pair)
        for i in where.pop(pair):
            count(i, -1)
            symbols, out, at = held[i][0], [], 0
            while at < len(symbols):
                both = tuple(symbols[at : at + 2]) == pair
                out.append("".join(pair) if both else symbols[at])
                at += 2 if both else 1
            held[i] = (out, held[i][1])
            count(i, 1)
    return merges


def best_pair(table: DataFrame, symbols_col: str = "symbols", freq_col: str = "freq") -> DataFrame:
    """One row ``(a, b, freq)``: the pair that the next merge takes, counted by Spark over a table of words of any size."""
    pairs = table.where(F.size(symbols_col) > 1).select(F.explode(F.arrays_zip(F.col(symbols_col).alias("a"), F.slice(F.col(symbols_col), F.lit(2), F.size(symbols_col) - 1).alias("b"))).alias("p"), F.col(freq_col).alias("f"))
    counted = pairs.where(F.col("p.b").isNotNull() & (F.col("f") > 0)).groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.sum("f").alias("freq"))
    return counted.orderBy(F.desc("freq"), "a", "b").limit(1)


def merge_pair(table: DataFrame, a: str, b: str, symbols_col: str = "symbols") -> DataFrame:
    """The table of words after one merge: each symbol is put between two marks, and neighbours become one from the left."""
    begin, end = "\x02", "\x03"
    marked = F.concat(F.lit(begin), F.array_join(symbols_col, end + begin), F.lit(end))
    joined = F.replace(marked, F.lit(f"{begin}{a}{end}{begin}{b}{end}"), F.lit(f"{begin}{a}{b}{end}"))
    return table.withColumn(symbols_col, F.split(F.regexp_replace(joined, f"^{begin}|{end}$", ""), end + begin))


def learn_merges_distributed(table: DataFrame, n_merges: int, min_freq: int = 2) -> Merges:
    """The same merges as ``learn_merges``, a Spark job each; for tables that no single machine holds."""
    merges: Merges = []
    for _ in range(n_merges):
        found = best_pair(table).first()
        if found is None or min_freq > 0 and found.freq < min_freq:
            break
        merges.append((found.a, found.b))
        table = written(merge_pair(table, found.a, found.b), "merged")
    return merges


def counted_words(df: DataFrame, text: Column) -> DataFrame:
    """``(word, freq)`` of the words of a column. Tasks count ``HELD_WORDS`` different words at a time, so that what is
    exchanged is a row for each of these, not for every word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        held = 0
        told = lambda: pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "freq"])
        for some in batches:
            for value in some.column("text"):
                text = value.as_py()
                if not text:
                    continue
                seen.update(text.split())
                held += len(text)
                if len(seen) > HELD_WORDS or held > 20 * HELD_CHARS:
                    yield told()
                    seen.clear()
                    held = 0
        if seen:
            yield told()

    found = df.select(text.alias("text")).mapInArrow(count, "word string, freq long")
    return found.groupBy("word").agg(F.sum("freq").alias("freq"))


def word_table(df: DataFrame, text_col: str = "text", top: int = 0) -> DataFrame:
    """``(word, freq)`` of lower-cased words; ``top``: the most frequent ones, ties by the word."""
    out = counted_words(df, turkish_lower(text_col))
    return out.orderBy(F.desc("freq"), "word").limit(top) if top > 0 else out


def train_merges(df: DataFrame, n_merges: int, top: int = 40_000, min_freq: int = 2, text_col: str = "text") -> Merges:
    """Byte-pair merges from the ``top`` most frequent words, which are all that the driver gets."""
    return _train(word_table(df, text_col, top), n_merges, min_freq)


def _train(table: DataFrame, n_merges: int, min_freq: int = 2) -> Merges:
    return learn_merges(((list(byte_chars(r.word)), r.freq) for r in table.toLocalIterator()), n_merges, min_freq)


def save_merges(path: str, merges: Merges) -> None:
    Path(path).write_text(json.dumps({"morph_sep": MARK, "merges": [list(m) for m in merges]}, ensure_ascii=False), encoding="utf-8")


def load_merges(path: str) -> Merges:
    return [(a, b) for a, b in json.loads(Path(path).read_text(encoding="utf-8"))["merges"]]


class MergeEncoder:
    """Pieces of words: morphemes, joined again by merges. Each worker keeps words that it has seen, within bounds."""

    def __init__(self, merges: Merges, analyze: Callable[[str], list[str]], bound: int = HELD_WORDS) -> None:
        self.rank = {pair: i for i, pair in reversed(list(enumerate(merges)))}
        self.analyze, self.seen = analyze, Held(self.merged, bound)

    def merged(self, word: str) -> list[str]:
        return apply_merges([word] if len(word) > LONGEST_WORD else self.analyze(word) or [word], self.rank)

    def pieces(self, word: str) -> list[str]:
        return self.seen[word]


# ---- segmentation

class OverTime(BaseException):
    """An analyser took too long; no ``Exception``, so that it does not catch this itself."""


@contextmanager
def time_limit(seconds: float | None) -> Iterator[None]:
    """Raises ``OverTime`` after so many seconds. Only a process's main thread can be interrupted; elsewhere there is no limit."""
    if not seconds or threading.current_thread() is not threading.main_thread():
        yield
        return

    def over(*_: object) -> None:
        raise OverTime

    before = signal.signal(signal.SIGALRM, over)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def segment_word(word: str, analyze: Callable[[str], list[str]], seconds: float | None = WORD_SECONDS) -> str:
    """Morphemes of a word, joined by the mark; the word itself if it is too long, or if the analyser fails, finds nothing or
    takes too long."""
    if len(word) > LONGEST_WORD:
        return word
    try:
        with time_limit(seconds):
            return MARK.join(analyze(word)) or word
    except (Exception, OverTime):  # noqa: BLE001  an analyser is foreign code: one word must not end the job
        return word


def distinct_words(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.select(F.explode(words(text_col)).alias("word")).distinct()


def over_distinct(words_: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """``(word, form)``: a Python function, called once for each different word of the table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            yield pd.DataFrame({"word": some["word"], "form": [fn(w) for w in some["word"]]})

    return words_.select("word").mapInPandas(run, "word string, form string")


def segment(df: DataFrame, analyze: Callable[[str], list[str]], id_col: str = "id", text_col: str = "text") -> DataFrame:
    """``(id, text)`` with every word segmented; documents without words are dropped.

    Texts are taken in blocks of ``BLOCK_CHARS``, and each block names its different words once. Over all blocks every
    different word is analysed once; the forms are joined back to the blocks' words (not to their places: a word that is a
    third of all is one row a block), and come together with the block's texts. Texts are written and shuffled once.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def batch(**columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, pa.int64() if k == "block" else pa.string()) for k, v in columns.items()], names=list(columns))

    def named(block: int, found: set[str]) -> pa.RecordBatch:
        return batch(block=[block] * len(found), word=sorted(found), id=[None] * len(found), text=[None] * len(found))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        block, found, size = (context.partitionId() if context else 0) << 32, set(), 0
        for some in batches:
            rows = []
            for id_, text in zip(some.column("id").to_pylist(), some.column("text").to_pylist(), strict=True):
                own = (text or "").split()
                if found and size + len(text or "") > BLOCK_CHARS:
                    yield named(block, found)
                    block, found, size = block + 1, set(), 0
                found.update(own)
                size += len(text or "")
                if own:
                    rows.append((block, id_, " ".join(own)))
            yield batch(block=[r[0] for r in rows], word=[None] * len(rows), id=[r[1] for r in rows], text=[r[2] for r in rows])
        if found:
            yield named(block, found)

    narrow = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    asked = written(narrow.mapInArrow(ask, "block long, word string, id string, text string"), "blocks")
    wanted = asked.where("word is not null")
    forms = over_distinct(wanted.select("word").distinct(), lambda w: segment_word(w, analyze))
    answers = wanted.join(forms, "word").select("block", "word", "form", F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("text"))
    rows = answers.unionByName(asked.where("word is null").select("block", "word", F.lit(None).cast("string").alias("form"), "id", "text"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, form = None, {}
        for some in batches:
            ids, texts = [], []
            for now, word, own, id_, text in zip(*(some.column(c).to_pylist() for c in ("block", "word", "form", "id", "text")), strict=True):
                if now != block:
                    block, form = now, {}
                if word is not None:
                    form[word] = own
                else:
                    ids.append(id_)
                    texts.append(" ".join(map(form.__getitem__, text.split(" "))))
            yield batch(id=ids, text=texts)

    dealt = rows.repartition("block").sortWithinPartitions("block", F.col("word").isNull())
    return dealt.mapInArrow(fill, "id string, text string").select(F.col("id").cast(kind).alias("id"), "text")


def cache_hits(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``(words, different, hit_rate)``: the share of words that are met again, whose analysis is there already."""
    counted = df.select(F.explode(words(text_col)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    out = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("words"), F.count("*").alias("different"))
    return out.withColumn("hit_rate", F.coalesce(F.lit(1) - F.try_divide("different", "words"), F.lit(0.0)))


def segmentation_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``(lines_in, lines_out, lines_dropped, words, unique_words, passthrough)``; passthrough: different words too long to analyse."""
    lines = df.agg(F.count("*").alias("lines_in"), F.count_if(word_count(text_col) > 0).alias("lines_out"), F.coalesce(F.sum(word_count(text_col)), F.lit(0)).alias("words"))
    unique = distinct_words(df, text_col).agg(F.count("*").alias("unique_words"), F.count_if(F.length("word") > LONGEST_WORD).alias("passthrough"))
    return lines.crossJoin(unique).select("lines_in", "lines_out", (F.col("lines_in") - F.col("lines_out")).alias("lines_dropped"), "words", "unique_words", "passthrough")


# ---- tokenizer

# The first ids of the vocabulary, in order; 256 bytes follow them.
SPECIALS = ("PAD", "UNK", "BOS", "EOS", "WORD_BOUNDARY", "CAP", "UPPER")


def _byte_alphabet() -> str:
    """A printable character for each byte: its own where it has one, else one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return "".join(chr(b if b in own else next(rest)) for b in range(256))


ALPHABET = _byte_alphabet()
_BYTE_OF = {c: b for b, c in enumerate(ALPHABET)}


def byte_chars(text: str) -> str:
    return "".join(ALPHABET[b] for b in text.encode("utf-8", "surrogatepass"))


def _lower(text: str) -> str:
    return text.replace("İ", "i").replace("İ", "i").replace("I", "ı").lower()


def _upper(text: str) -> str:
    return text.replace("i", "İ").replace("ı", "I").upper()


class Tokenizer:
    """Words to ids: specials (0-6), bytes (7-262), byte merges, then pieces by frequency.

    A word is a marker of its casing and its pieces; a piece that is not in the vocabulary is written as bytes. A word of mixed
    case, or whose pieces do not spell it, is a boundary and bytes. Byte merges and pieces are kept apart even where their
    strings are equal. ``decode(encode(text))`` is the text with its white space collapsed.
    """

    def __init__(self, merges: Merges, pieces: list[str], analyze: Callable[[str], list[str]] | None = None, table: dict[str, list[str]] | None = None) -> None:
        self.merges, self.pieces = merges, pieces
        self.analyze, self.table = analyze or (lambda w: [w]), table or {}
        self.rank = {pair: i for i, pair in reversed(list(enumerate(merges)))}
        first = len(SPECIALS)
        self.byte_id = {c: first + b for b, c in enumerate(ALPHABET)}
        joined = dict.fromkeys(a + b for a, b in merges)
        self.byte_id |= {s: first + 256 + i for i, s in enumerate(joined)}
        self.first_piece = first + 256 + len(joined)
        self.piece_id = {p: self.first_piece + i for i, p in enumerate(pieces)}
        self.string = [*SPECIALS, *self.byte_id, *pieces]
        self.cap, self.upper, self.boundary = SPECIALS.index("CAP"), SPECIALS.index("UPPER"), SPECIALS.index("WORD_BOUNDARY")

        #: Ids of words, and texts of the ids of single words (as bytes of 32-bit numbers), as they are asked for.
        self.ids_of, self.text_of = Held(self.word), Held(lambda ids: self._decode(np.frombuffer(ids, np.int32).tolist()), chars=4 * HELD_CHARS)
        self.begins = np.array([i == self.boundary or i >= self.first_piece and s.startswith(MARK) for i, s in enumerate(self.string)])

    @property
    def size(self) -> int:
        return len(self.string)

    def _bytes(self, text: str) -> list[int]:
        return [self.byte_id[s] for s in apply_merges(list(byte_chars(text)), self.rank)]

    def word(self, word: str) -> list[int]:
        low = _lower(word)
        marker = [] if word == low else [self.cap] if word == _upper(low[:1]) + _lower(low[1:]) else [self.upper] if word == _upper(low) else None
        # casing must come back from the marker alone, and the mark itself would be read as a word's start
        if marker is None or len(word) > LONGEST_WORD or MARK in word:
            return [self.boundary, *self._bytes(word)]
        pieces = self.table.get(low) or self.analyze(low)
        if not pieces or "".join(pieces) != low:
            return [self.boundary, *self._bytes(word)]
        out: list[int] = []
        for i, piece in enumerate(pieces):
            known = self.piece_id.get(piece if i else MARK + piece)
            if known is not None:
                out.append(known)
            else:
                out += [*([] if i else [self.boundary]), *self._bytes(piece)]
        return marker + out

    def encode(self, text: str, bos: bool = False, eos: bool = False) -> list[int]:
        ids = list(chain.from_iterable(map(self.ids_of.__getitem__, text.split())))
        return [SPECIALS.index("BOS")] * bos + ids + [SPECIALS.index("EOS")] * eos

    def decode(self, ids: Iterable[int]) -> str:
        """The words of the ids. Where every word's beginning can be told from two ids, words met before are not read again."""
        some = np.asarray(ids if isinstance(ids, np.ndarray) else list(ids), dtype=np.int32)
        if not len(some) or some.min() < 0 or some.max() >= len(self.begins):
            return self._decode(some.tolist())
        marks, begins = (some == self.cap) | (some == self.upper), self.begins[some]
        if not (marks[0] or begins[0]) or marks[-1] or (marks[:-1] & ~begins[1:]).any() or ((some < len(SPECIALS)) & ~marks & ~begins).any():
            return self._decode(some.tolist())
        begins[1:] &= ~marks[:-1]
        at = (4 * np.flatnonzero(begins | marks)).tolist()
        raw = some.tobytes()
        return " ".join(filter(None, map(self.text_of.__getitem__, [raw[a:b] for a, b in zip(at, [*at[1:], len(raw)], strict=True)])))

    def _decode(self, ids: list[int]) -> str:
        out: list[str] = []
        case, held, marker = 0, bytearray(), 0

        def close() -> None:
            if held:
                word = bytes(held).decode("utf-8", "surrogatepass")
                out.append(_upper(word[:1]) + word[1:] if case == self.cap else _upper(word) if case == self.upper else word)
                held.clear()

        for i in ids:
            if i in (self.cap, self.upper):
                marker = i
            elif i < len(SPECIALS) and i != self.boundary:
                continue
            elif i == self.boundary or i >= self.first_piece and self.string[i].startswith(MARK):
                close()
                case, marker = marker, 0
                if i != self.boundary:
                    held += self.string[i][len(MARK) :].encode("utf-8", "surrogatepass")
            elif i >= self.first_piece:
                held += self.string[i].encode("utf-8", "surrogatepass")
            else:
                held += bytes(_BYTE_OF[c] for c in self.string[i])
        close()
        return " ".join(out)

    def save(self, folder: str) -> None:
        out = Path(folder)
        out.mkdir(parents=True, exist_ok=True)
        (out / "tokenizer.json").write_text(json.dumps({"merges": self.merges, "pieces": self.pieces}, ensure_ascii=False), encoding="utf-8")
        (out / "table.tsv").write_text("".join(f"{w}\t{MARK.join(p)}\n" for w, p in self.table.items()), encoding="utf-8")

    @classmethod
    def load(cls, folder: str, analyze: Callable[[str], list[str]] | None = None) -> Tokenizer:
        found = json.loads((Path(folder) / "tokenizer.json").read_text(encoding="utf-8"))
        rows = (line.split("\t") for line in (Path(folder) / "table.tsv").read_text(encoding="utf-8").splitlines() if "\t" in line)
        return cls([(a, b) for a, b in found["merges"]], found["pieces"], analyze, {w: p.split(MARK) for w, p in rows})


def piece_frequencies(df: DataFrame, analyze: Callable[[str], list[str]], text_col: str = "text") -> DataFrame:
    """``(piece, freq)`` of the pieces of all words, those that start a word with the mark; each different word analysed once."""
    return _piece_frequencies(written(word_table(df, text_col), "words"), analyze)


def _piece_frequencies(table: DataFrame, analyze: Callable[[str], list[str]]) -> DataFrame:
    forms = over_distinct(table, lambda w: MARK + MARK.join([w] if len(w) > LONGEST_WORD else analyze(w) or [w]))
    parts = F.split(F.expr(f"substring(form, {len(MARK) + 1})"), MARK)
    marked = F.transform(parts, lambda p, i: F.when(i == 0, F.concat(F.lit(MARK), p)).otherwise(p))
    return table.join(forms, "word").select(F.explode(marked).alias("piece"), "freq").where(F.col("piece") != "").groupBy("piece").agg(F.sum("freq").alias("freq"))


def build_tokenizer(df: DataFrame, analyze: Callable[[str], list[str]], vocabulary: int = 64_000, n_merges: int = 16_000, top: int = 40_000, text_col: str = "text") -> Tokenizer:
    """A tokenizer of at most ``vocabulary`` ids; the driver gets the ``top`` words and the most frequent pieces, no more."""
    table = written(word_table(df, text_col), "words")
    most = table.orderBy(F.desc("freq"), "word").limit(top) if top > 0 else table
    merges = _train(most, n_merges)
    room = vocabulary - len(SPECIALS) - 256 - len({a + b for a, b in merges})
    if room < 0:
        raise ValueError("the vocabulary has no room for its bytes and merges")
    ranked = _piece_frequencies(table, analyze).orderBy(F.desc("freq"), "piece").limit(room)
    return Tokenizer(merges, [r.piece for r in ranked.toLocalIterator()], analyze)


def encode_column(tokenizer: Tokenizer) -> Callable[[Column], Column]:
    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else np.array(tokenizer.encode(t), np.int32))

    return encode


def decode_column(tokenizer: Tokenizer) -> Callable[[Column], Column]:
    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: None if x is None else tokenizer.decode(x))

    return decode


def suffixes(word: str, known: tuple[str, ...] = ("lar", "ler", "dan", "den", "da", "de", "ing", "ed", "ment", "lich", "ción", "s")) -> list[str]:
    """A plain analyser by a short list of endings, for demonstration: the stem and at most two endings."""
    out: list[str] = []
    while len(out) < 2:
        end = next((k for k in known if word.endswith(k) and len(word) > len(k) + 2), None)
        if end is None:
            break
        word = word[: -len(end)]
        out.insert(0, end)
    return [word, *out]
