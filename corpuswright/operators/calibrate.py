"""Calibration of filter thresholds on a clean reference sample."""

from __future__ import annotations

import json
from dataclasses import replace
from math import floor
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.functions import stopwords
from corpuswright.functions.quality import Thresholds, metrics
from corpuswright.functions.text import WORD
from corpuswright.operators import tokens
from corpuswright.plans.storage import written

METRICS = ("n_words", "mean_word_length", "symbol_word_ratio", "non_alpha_words_ratio")
#: Values around a rank that the driver may get at once, and ranks within which Spark's sketch brackets a quantile.
EXACT_ROWS = 200_000
ACCURACY = 20_000
#: The limits that hold where no calibration has been written.
PLAIN = Thresholds(50, 100_000, 3.0, 12.0, 0.10, 0.90, 0.30, 0.70, 2)
QUANTILES = (0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)


def word_frequencies(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, freq)`` of the words of letters alone, in Turkish lower case."""
    return tokens.word_table(df, text_col).where(F.col("word").rlike(r"^\p{L}+$"))


def stop_words(df: DataFrame, top_n: int = 175, min_length: int = 1, text_col: str = "text") -> DataFrame:
    """The ``top_n`` most frequent words of at least ``min_length`` letters; ties by the word."""
    return _most_frequent(word_frequencies(df, text_col), top_n, min_length)


def _most_frequent(found: DataFrame, top_n: int, min_length: int = 1) -> DataFrame:
    return found.where(F.length("word") >= min_length).orderBy(F.desc("freq"), "word").limit(top_n)


def document_metrics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The four metrics of every document that is not blank."""
    return df.where(F.col(text_col).rlike(WORD)).select(metrics(text_col).alias("m")).select("m.*")


def quantiles(values: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float]]:
    """Exact quantiles of numeric columns, linearly interpolated between ranks; 0 over no rows. Nulls are left out.

    No task and no driver gets all values of a column: Spark's sketch brackets each rank, a pass counts the values below and
    within each bracket, and brackets with too many different ones are narrowed again; only what is left, at most
    ``EXACT_ROWS`` values with their counts, is read. ``values`` is read some five times, so it should be a written table.
    """
    n = values.agg(*[F.count(c).alias(c) for c in wanted]).first()
    jobs = [(c, rank) for c, points in wanted.items() if n[c] for p in points for rank in sorted({floor((n[c] - 1) * p), min(floor((n[c] - 1) * p) + 1, n[c] - 1)})]
    jobs = list(dict.fromkeys(jobs))
    x = {c: F.col(c).cast("double") for c in wanted}
    low, high = dict.fromkeys(jobs, float("-inf")), dict.fromkeys(jobs, float("inf"))
    below, within = dict.fromkeys(jobs, 0), {(c, r): n[c] for c, r in jobs}
    inside = lambda j: (x[j[0]] >= F.lit(low[j])) & (x[j[0]] <= F.lit(high[j]))
    for _ in range(8):
        wide = [j for j in jobs if within[j] > EXACT_ROWS // len(jobs) and low[j] < high[j]]
        if not wide:
            break
        share = lambda j, d: min(1.0, max(0.0, (j[1] - below[j] + 1 + d * (1 + 2 * within[j] / ACCURACY)) / within[j]))
        found = values.agg(*[F.percentile_approx(F.when(inside(j), x[j[0]]), [share(j, -1), share(j, 1)], ACCURACY) for j in wide]).first()
        for j, (a, b) in zip(wide, found, strict=True):
            low[j], high[j] = a, b
        counts = values.agg(*[f for j in wide for f in (F.count_if(x[j[0]] < F.lit(low[j])), F.count_if(inside(j)))]).first()
        for k, j in enumerate(wide):
            below[j], within[j] = counts[2 * k], counts[2 * k + 1]
    at: dict[tuple, float] = {}
    if jobs:
        spots = F.array_compact(F.array(*[F.when(inside(j), F.struct(F.lit(k).alias("k"), x[j[0]].alias("v"))) for k, j in enumerate(jobs)]))
        left: dict[int, list] = {}
        for row in values.select(F.explode(spots).alias("s")).groupBy("s.k", "s.v").count().collect():
            left.setdefault(row[0], []).append((row[1], row[2]))
        for k, j in enumerate(jobs):
            seen = below[j]
            for v, many in sorted(left.get(k, [])):
                seen += many
                if seen > j[1]:
                    at[j] = v
                    break
    out: dict[str, list[float]] = {}
    for c, points in wanted.items():
        out[c] = []
        for p in points:
            if not n[c]:
                out[c].append(0.0)
                continue
            h = (n[c] - 1) * p
            a, b = at[c, floor(h)], at[c, min(floor(h) + 1, n[c] - 1)]
            out[c].append(a + (h - floor(h)) * (b - a))
    return out


def bands(values: DataFrame, strategy: str = "quantile", q: float = 0.005) -> dict[str, tuple[float, float]]:
    """Lower and upper limit of every metric; 0 over no rows.

    ``quantile``: the quantiles of ``q`` and ``1 - q``, linearly interpolated; ``10tail``: of 0.1 and 0.9; ``meanstd``: three
    population deviations around the mean, within what was seen.
    """
    if strategy == "meanstd":
        x = {m: F.col(m).cast("double") for m in METRICS}
        row = values.agg(*[f for m in METRICS for f in (F.greatest(F.avg(x[m]) - 3 * F.stddev_pop(x[m]), F.min(x[m])), F.least(F.avg(x[m]) + 3 * F.stddev_pop(x[m]), F.max(x[m])))]).first()
        return {m: (row[2 * i] or 0.0, row[2 * i + 1] or 0.0) for i, m in enumerate(METRICS)}
    if strategy not in ("quantile", "10tail"):
        raise ValueError(f"unknown strategy {strategy!r}")
    p = 0.1 if strategy == "10tail" else min(max(q, 0.0), 1.0)
    return {m: tuple(found) for m, found in quantiles(values, {m: [p, 1.0 - p] for m in METRICS}).items()}


LIMITS = "min_doc_words long, max_doc_words long, min_avg_word_length double, max_avg_word_length double, max_symbol_word_ratio double, max_non_alpha_words_ratio double"


def limits(df: DataFrame, strategy: str = "quantile", q: float = 0.005, text_col: str = "text") -> DataFrame:
    """One row of thresholds, with floors and ceilings so that a clean sample does not reject ordinary texts."""
    return df.sparkSession.createDataFrame([_limits(written(document_metrics(df, text_col), "metrics"), strategy, q)], LIMITS)


def _limits(values: DataFrame, strategy: str, q: float) -> tuple:
    found = bands(values, strategy, q)
    (low_n, high_n), (low_len, high_len) = found["n_words"], found["mean_word_length"]
    # counts are rounded half to even
    return max(10, round(low_n)), min(max(round(high_n), 100_000), 1_000_000), float(low_len), float(high_len), max(found["symbol_word_ratio"][1], 0.05), max(found["non_alpha_words_ratio"][1], 0.2)


def report(df: DataFrame, text_col: str = "text", points: tuple[float, ...] = QUANTILES) -> DataFrame:
    """``(metric, n_docs, mean, p01 … p99)``: a row for each metric; none over no documents."""
    values = written(document_metrics(df, text_col), "metrics")
    found = quantiles(values, {m: list(points) for m in METRICS})
    row = values.agg(F.count("*"), *[F.avg(m) for m in METRICS]).first()
    rows = [(m, row[0], row[1 + i], *map(float, found[m])) for i, m in enumerate(METRICS)] if row[0] else []
    return df.sparkSession.createDataFrame(rows, "metric string, n_docs long, mean double, " + ", ".join(f"p{round(100 * p):02d} double" for p in points))


def calibrate(df: DataFrame, strategy: str = "quantile", q: float = 0.005, top_n: int = 175, text_col: str = "text") -> Thresholds:
    """Thresholds from a sample; the sample must have a document that is not blank."""
    return calibrated(df, strategy, q, top_n, text_col)[0]


def calibrated(df: DataFrame, strategy: str = "quantile", q: float = 0.005, top_n: int = 175, text_col: str = "text") -> tuple[Thresholds, dict]:
    """The same, and how they came about: sizes of the sample and of its vocabulary, the numbers and the quantiles behind them."""
    values = written(document_metrics(df, text_col), "metrics")
    n = values.count()
    if not n:
        raise ValueError("the sample has no words")
    vocabulary = written(word_frequencies(df, text_col), "vocabulary")
    words_ = tuple(r.word for r in _most_frequent(vocabulary, top_n).collect())
    names = [c.split()[0] for c in LIMITS.split(", ")]
    found = replace(PLAIN, **dict(zip(names, _limits(values, strategy, q), strict=True)), stop_words=words_)
    seen = quantiles(values, {m: [q, 1.0 - q] for m in METRICS})
    told = {"strategy": strategy, "q": q, "top_n": top_n, "n_docs": n, "n_unique_words": vocabulary.count(), "thresholds": numbers(found), "sample_quantiles": {m: {"low": a, "high": b} for m, (a, b) in seen.items()}}
    return found, told


def numbers(thresholds: Thresholds) -> dict:
    return {k: getattr(thresholds, k) for k in thresholds.__dataclass_fields__ if k not in ("stop_words", "alpha_rule")}


def write_artifacts(thresholds: Thresholds, folder: str, told: dict | None = None) -> None:
    """Writes ``stopwords.txt``, ``thresholds.json`` and, if it is given, how they came about as ``report.json``."""
    out = Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    (out / "thresholds.json").write_text(json.dumps(numbers(thresholds), indent=2) + "\n", encoding="utf-8")
    (out / "stopwords.txt").write_text("\n".join(thresholds.stop_words) + "\n", encoding="utf-8")
    if told is not None:
        (out / "report.json").write_text(json.dumps(told, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")


def load_artifacts(folder: str) -> Thresholds:
    """Thresholds from such a folder; what is missing, broken or of a wrong type is left at its plain default (``PLAIN``), and
    all numbers are where the file is broken or its limits contradict each other. Stop words default to the Turkish list."""
    out = PLAIN
    try:
        values = json.loads((Path(folder) / "thresholds.json").read_text(encoding="utf-8"))
        if isinstance(values, dict):
            out = replace(PLAIN, **{k: v for k, v in values.items() if k in numbers(PLAIN) and isinstance(v, int | float) and not isinstance(v, bool)})
    except (OSError, ValueError, TypeError):
        pass
    try:
        some = tuple(x.strip() for x in (Path(folder) / "stopwords.txt").read_text(encoding="utf-8").splitlines() if x.strip())
    except OSError:
        some = ()
    return replace(out, stop_words=some or stopwords.TURKISH)
