"""Per-document quality metrics and the filters built on them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuswright.functions import stopwords
from corpuswright.functions.text import LETTERED, SPACE, WORD, strip, turkish_lower, words


@dataclass(frozen=True)
class Thresholds:
    """Limits of the quality filter. The defaults are the calibrated Turkish ones."""

    min_doc_words: int = 11
    max_doc_words: int = 100_000
    min_avg_word_length: float = 4.956754926108374
    max_avg_word_length: float = 8.181893939393941
    max_symbol_word_ratio: float = 0.05
    max_bullet_lines_ratio: float = 0.9
    max_ellipsis_lines_ratio: float = 0.3
    max_non_alpha_words_ratio: float = 0.2845363062352014
    min_stop_words: int = 2
    stop_words: tuple[str, ...] = field(default=stopwords.TURKISH)
    #: ``intent``: at most the share of words without a letter; ``gopher``: at least that share of words with one.
    alpha_rule: str = "intent"

    def __post_init__(self) -> None:
        if self.min_doc_words > self.max_doc_words or self.min_avg_word_length > self.max_avg_word_length:
            raise ValueError("a lower limit is above its upper limit")
        for name, value in asdict(self).items():
            if name.endswith("_ratio") and not 0 <= value <= 1:
                raise ValueError(f"{name} must be within 0 and 1")
        if self.alpha_rule not in ("intent", "gopher"):
            raise ValueError(f"unknown alpha_rule {self.alpha_rule!r}")


def let(values: dict[str, Column], then: Callable[[Column], Column]) -> Column:
    """``then`` of a struct of values, each of which is worked out once a row, however often ``then`` names it."""
    return F.get(F.transform(F.array(F.struct(*[c.alias(k) for k, c in values.items()])), then), F.lit(0))


def _occurrences(text: Column, plain: str) -> Column:
    """How often a plain string occurs, counted apart from the left."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(plain), F.lit("")))) / len(plain)).cast("int")


def _counts(text: Column) -> dict[str, Column]:
    """What the metrics are made of; the words in lower case are split once."""
    return {
        "low": words(turkish_lower(text)),
        "symbols": sum((_occurrences(text, x) for x in ("…", "...")), _occurrences(text, "#")),
        "lettered": F.regexp_count(text, F.lit(LETTERED)),
    }


def _sizes(m: Column) -> tuple[Column, Column]:
    """Words, and their characters in lower case."""
    return F.size(m["low"]).cast("long"), F.length(F.array_join(m["low"], ""))


def metrics(text: Column | str) -> Column:
    """``n_words, mean_word_length, symbol_word_ratio, non_alpha_words_ratio``; null for blank texts.

    Lengths are of Turkish lower-case words; symbols are the number sign, the ellipsis and three dots, wherever they are.
    """
    text = F.col(text) if isinstance(text, str) else text

    def of(m: Column) -> Column:
        many, chars = _sizes(m)
        n = many.cast("double")
        return F.when(many > 0, F.struct(many.alias("n_words"), (chars / n).alias("mean_word_length"), (m["symbols"] / n).alias("symbol_word_ratio"), ((n - m["lettered"]) / n).alias("non_alpha_words_ratio")))

    return let(_counts(text), of)


def lines(text: Column | str) -> Column:
    """Trimmed lines that are not empty."""
    return F.filter(F.transform(F.split(F.col(text) if isinstance(text, str) else text, "\n"), strip), lambda x: x != "")


def _share(some: Column, of: Column) -> Column:
    return F.when(F.size(of) > 0, F.size(some) / F.size(of)).otherwise(0.0)


def first_reason(reasons: Sequence[tuple[str, Column]]) -> Column:
    """The name of the first condition that holds, or null."""
    return F.coalesce(*[F.when(condition, name) for name, condition in reasons])


def gopher_quality(text: Column | str, limits: Thresholds = Thresholds()) -> Column:  # noqa: B008
    """Why a text is rejected by word counts, word lengths, symbols, line marks, letters or stop words; null if it is kept."""
    text = F.col(text) if isinstance(text, str) else text
    known = F.array(*map(F.lit, limits.stop_words)) if limits.stop_words else F.array().cast("array<string>")

    def of(m: Column) -> Column:
        many, chars = _sizes(m)
        n, rows = many.cast("double"), m["rows"]
        bare = (n - m["lettered"]) / n
        return first_reason(
            [
                ("blank", many == 0),
                ("too_few_words", many < limits.min_doc_words),
                ("too_many_words", many > limits.max_doc_words),
                ("words_too_short", chars / n < limits.min_avg_word_length),
                ("words_too_long", chars / n > limits.max_avg_word_length),
                ("symbols", m["symbols"] / n > limits.max_symbol_word_ratio),
                ("bullets", _share(F.filter(rows, lambda x: x.rlike("^[•●‣\\-*]")), rows) > limits.max_bullet_lines_ratio),
                ("ellipses", _share(F.filter(rows, lambda x: x.rlike(r"(?:\.\.\.|…)$")), rows) > limits.max_ellipsis_lines_ratio),
                ("letters", bare > limits.max_non_alpha_words_ratio if limits.alpha_rule == "intent" else (1 - bare) < limits.max_non_alpha_words_ratio),
                ("stop_words", F.size(F.array_intersect(m["low"], known)) < limits.min_stop_words),
            ]
        )

    return let(_counts(text) | {"rows": lines(text)}, of)


def fineweb_quality(text: Column | str, min_ended: float = 0.12, max_repeated: float = 0.1, max_short: float = 0.67, short: int = 30) -> Column:
    """Why a text is rejected by its lines: too few end a sentence, too many are short, or too much of it is repeated."""

    def of(m: Column) -> Column:
        rows = m["rows"]
        size = F.aggregate(F.transform(rows, F.length), F.lit(0), lambda a, b: a + b)
        once = F.aggregate(F.transform(F.array_distinct(rows), F.length), F.lit(0), lambda a, b: a + b)
        return first_reason(
            [
                ("blank", F.coalesce(F.size(rows), F.lit(0)) == 0),
                ("line_ends", _share(F.filter(rows, lambda x: x.rlike("[.!?…。！？\"'”]$")), rows) <= min_ended),
                ("short_lines", _share(F.filter(rows, lambda x: F.length(x) < short), rows) >= max_short),
                ("repeated_lines", (size - once) / size >= max_repeated),
            ]
        )

    return let({"rows": lines(text)}, of)


def repeated_parts(text: Column | str) -> Column:
    """Shares of repeated lines and paragraphs, by number and by characters of the text."""
    text = F.col(text) if isinstance(text, str) else text

    def of(m: Column) -> Column:
        found = []
        for name in ("line", "para"):
            parts = m[name]
            size = F.aggregate(F.transform(parts, F.length), F.lit(0), lambda a, b: a + b)
            kept = F.array_distinct(parts)
            once = F.aggregate(F.transform(kept, F.length), F.lit(0), lambda a, b: a + b)
            n = F.size(parts).cast("double")
            # an empty text has no share of characters
            found += [((n - F.size(kept)) / n).alias(f"dup_{name}_frac"), F.try_divide((size - once).cast("double"), m["size"].cast("double")).alias(f"dup_{name}_char_frac")]
        return F.struct(*found)

    trimmed = strip(text)
    return let({"line": F.split(trimmed, "\n+"), "para": F.split(trimmed, "\n{2,}"), "size": F.length(text)}, of)


#: Limits of repetition: share of characters in the commonest n-gram, and in n-grams that came before.
TOP_GRAMS = ((2, 0.20), (3, 0.18), (4, 0.16))
DUP_GRAMS = ((5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.10))
DUP_PARTS = (0.30, 0.20, 0.30, 0.20)


def gram_shares(text: str) -> list[float]:
    """For one text: share of the commonest 2- to 4-gram, then of characters in repeated 5- to 10-grams.

    A repeated n-gram is counted when it is met again, and reading goes on behind it. N-grams are numbered: each by the one
    that is a word shorter and its last word.
    """
    some, size = text.split(), max(len(text), 1)
    number = {w: i for i, w in enumerate(dict.fromkeys(some))}
    word = np.fromiter(map(number.__getitem__, some), np.int64, len(some))
    ends = np.concatenate(([0], np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))))
    # only n-grams whose beginnings are met again can be met again: places, and the numbers of the n-grams there
    place, gram = np.arange(len(some)), word
    out: list[float] = []
    for n in range(2, DUP_GRAMS[-1][0] + 1):
        if len(place) and place[-1] + n > len(some):
            place, gram = place[:-1], gram[:-1]
        if len(place) < 2:
            place = gram = np.zeros(0, np.int64)
            out.append(0.0)
            continue
        key = gram * len(number) + word[place + n - 1]
        order = np.argsort(key, kind="stable")
        key = key[order]
        same = key[1:] == key[:-1]
        met = np.zeros(len(key), bool)
        met[1:] = same
        met[:-1] |= same
        if n <= TOP_GRAMS[-1][0]:
            if met.any():
                begins = np.flatnonzero(~np.concatenate(([False], same)))
                times = np.diff(begins, append=len(key))
                first = place[order[begins[times == times.max()]]]
                out.append(int(times.max()) * int((ends[first + n] - ends[first]).max() + n - 1) / size)
            else:
                out.append(0.0)
        order = order[met]
        back = np.argsort(order)
        number_of = np.cumsum(np.concatenate(([0], ~same)))[met]
        place, gram = place[order[back]], number_of[back]
        if n > TOP_GRAMS[-1][0]:
            out.append(_read_again(gram, place, ends[place + n] - ends[place], n) / size)
    return out


def _read_again(gram: np.ndarray, place: np.ndarray, chars: np.ndarray, n: int) -> int:
    """Characters of the n-grams that were read before, of those that occur more than once; ``chars``: their sizes."""
    read, at, total = set(), 0, 0
    for i, g, size in zip(place.tolist(), gram.tolist(), chars.tolist(), strict=True):
        if i < at:
            continue
        if g in read:
            total += size
            at = i + n
        else:
            read.add(g)
    return total


def repeated_grams(text: Column | str) -> Column:
    """``gram_shares`` of every text; null for null."""

    @F.pandas_udf("array<double>")
    def shares(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else gram_shares(t))

    return shares(text)


def gopher_repetition(text: Column | str) -> Column:
    """Why a text is rejected as repetitive, or null. The n-grams' shares are worked out in Python, the rest is not."""
    text = F.col(text) if isinstance(text, str) else text
    names = ("dup_line_frac", "dup_line_char_frac", "dup_para_frac", "dup_para_char_frac")

    def of(m: Column) -> Column:
        reasons = [(name, m["parts"][name] > limit) for name, limit in zip(names, DUP_PARTS, strict=True)]
        reasons += [(f"top_{n}_gram" if n < 5 else f"duplicated_{n}_gram", F.get(m["grams"], F.lit(i)) > limit) for i, (n, limit) in enumerate(TOP_GRAMS + DUP_GRAMS)]
        return first_reason([("blank", m["blank"]), *reasons])

    return let({"parts": repeated_parts(text), "grams": repeated_grams(text), "blank": F.coalesce(strip(text), F.lit("")) == ""}, of)


#: A few very frequent words of each language, for texts whose language nobody has noted.
PROFILES = {
    "tr": "ve bir bu da de için ile olarak çok daha ne gibi ama",
    "en": "the of and to in is that for it was on with as",
    "fr": "le la les de des et un une du en que pour dans",
    "de": "der die das und ist in den von zu mit nicht ein für",
    "es": "el la los las de y que en un una por con para",
}


def language_scores(text: Column | str, profiles: dict[str, str] = PROFILES) -> Column:
    """For each language, the share of a text's words that are in its profile."""
    some = F.transform(words(F.lower(F.col(text) if isinstance(text, str) else text)), lambda w: F.regexp_replace(w, r"\P{L}+", ""))

    def of(m: Column) -> Column:
        n = F.greatest(F.size(m["words"]), F.lit(1))
        share = lambda known: F.size(F.filter(m["words"], lambda w: w.isin(*known.split()))) / n
        return F.struct(*[share(known).alias(k) for k, known in profiles.items()])

    return let({"words": some}, of)


def language_gate(text: Column | str, wanted: Sequence[str], threshold: float = 0.65, known: Column | None = None) -> Column:
    """Whether a text is in a wanted language: by ``known`` where that is given, else if its share of words in the profiles of
    the wanted languages is at least ``threshold`` of that in all profiles (each text's best guess, no model)."""
    def of(m: Column) -> Column:
        total = sum((m["scores"][k] for k in PROFILES), F.lit(0.0))
        own = F.greatest(F.lit(0.0), F.lit(0.0), *[m["scores"][k] for k in wanted if k in PROFILES])
        return F.coalesce(F.try_divide(own, total) >= threshold, F.lit(False))

    guess = let({"scores": language_scores(text)}, of)
    return guess if known is None else F.coalesce(known.isin(*wanted), guess)
