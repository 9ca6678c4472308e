"""The cleaning run: filters, normalisation, redaction, duplicates, token counts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpuswright.functions import pii, quality
from corpuswright.functions.text import normalize
from corpuswright.operators import dedup, tokens
from corpuswright.plans.config import Cleaning
from corpuswright.plans.storage import written


@dataclass
class Cleaned:
    final: DataFrame
    rejected: DataFrame
    removed: DataFrame
    #: What was counted while texts were prepared: how many, how many of them normalisation changed, how many data of each kind
    #: were redacted; and, once ``count`` has run, the tokens.
    stats: dict[str, int] = field(default_factory=dict)

    def count(self) -> dict[str, int]:
        """``stats``, with the documents that stay, those whose tokens were counted, and their tokens."""
        row = self.final.agg(F.count("*").alias("documents"), F.count("token_count").alias("counted_docs"), F.coalesce(F.sum("token_count"), F.lit(0)).alias("tokens")).first()
        self.stats |= row.asDict()
        return self.stats

    def summary(self) -> DataFrame:
        """``(outcome, documents)``: kept, duplicate, or the reason of a rejection."""
        kept = self.final.select(F.lit("kept").alias("outcome"))
        return kept.unionAll(self.removed.select(F.lit("duplicate"))).unionAll(self.rejected.select("drop_reason")).groupBy("outcome").agg(F.count("*").alias("documents"))


def reasons(df: DataFrame, config: Cleaning, text_col: str = "text") -> DataFrame:
    """The rows with ``drop_reason``: which filter rejects their raw text, the cheaper ones first; null if none does."""
    text = F.col(text_col)
    found = []
    if config.languages:
        known = F.col(config.language_col) if config.language_col else None
        found.append(F.when(~quality.language_gate(text, config.languages, config.language_threshold, known), F.lit("language")))
    if config.quality:
        found.append(F.concat(F.lit("quality:"), quality.gopher_quality(text, config.limits)))
    if config.line_quality:
        found.append(F.concat(F.lit("lines:"), quality.fineweb_quality(text)))
    out = df.withColumn("drop_reason", F.coalesce(*found) if found else F.lit(None).cast("string"))
    if not config.repetition:
        return out
    # texts that are rejected already are not handed to Python
    left = F.when(F.col("drop_reason").isNull(), text)
    return out.withColumn("drop_reason", F.coalesce("drop_reason", F.when(F.col("drop_reason").isNull(), F.concat(F.lit("repetition:"), quality.gopher_repetition(left)))))


def prepare(df: DataFrame, config: Cleaning, text_col: str = "text") -> DataFrame:
    """Normalised, then redacted: what hides personal data from patterns is gone before they are looked for. Narrow.
    ``normalized`` tells whether normalisation has changed a text, ``pii`` what was redacted in it."""
    out = df.withColumn("normalized", F.col(text_col)).withColumn(text_col, normalize(text_col)).withColumn("normalized", ~F.col("normalized").eqNullSafe(F.col(text_col)))
    if config.redact:
        out = pii.redact(out, text_col, plate=config.redact_plates)
    return out.withColumn(text_col, pii.redact_addresses(text_col)) if config.redact_addresses else out


def stage_a(df: DataFrame, config: Cleaning, text_col: str = "text") -> DataFrame:
    """Filters and preparation, without a shuffle; rejected rows are dropped. Works on streams too."""
    return prepare(reasons(df, config, text_col).where("drop_reason is null").drop("drop_reason"), config, text_col).drop("normalized")


def clean(df: DataFrame, config: Cleaning | None = None, id_col: str = "id", text_col: str = "text") -> Cleaned:
    """The whole run. Texts are judged once and written; duplicates are found on narrow columns."""
    config = config or Cleaning()
    judged = written(reasons(df, config, text_col), "judged")
    ready, seen = prepare(judged.where("drop_reason is null").drop("drop_reason"), config, text_col), Observation()
    kinds = [F.coalesce(F.sum(F.col("pii")[k]), F.lit(0)).alias(k) for k in pii.PLACEHOLDERS] if config.redact else []
    ready = written(ready.observe(seen, F.count(F.lit(1)).alias("prepared"), F.count_if("normalized").alias("normalized"), *kinds).drop("normalized"), "prepared")
    removed = ready.limit(0)
    kept = ready
    if config.exact:
        kept, gone = dedup.exact_dedup(ready, id_col, text_col), ready
        removed = gone.join(dedup.exact_groups(ready, id_col, text_col).select(F.col("keep_id").alias(id_col)), id_col, "left_anti")
    if config.near:
        kept = written(kept, "different")
        kept, gone = dedup.near_dedup(kept, id_col, text_col, n_bands=config.bands, rows=config.rows, size=config.shingle)
        removed = removed.unionByName(gone)
    final = tokens.count_tokens(kept, tokens.counter(config.tokenizer), config.token_rate, id_col, text_col)
    return Cleaned(final, judged.where("drop_reason is not null"), removed, dict(seen.get))
