"""Writers."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpuswright.functions.text import strip


def write_records(df: DataFrame, path: str, min_chars: int = 1, mode: str = "errorifexists") -> int:
    """Documents as gzipped JSON lines; how many were written. A document without an id or with a null text is an error, even
    if it is too short to be written."""
    checked = df.withColumn("text", F.when(F.coalesce(F.col("id"), F.lit("")) == "", F.raise_error(F.lit("a document has no id"))).when(F.col("text").isNull(), F.raise_error(F.lit("a document has no text"))).otherwise(F.col("text")))
    # the check stands in the condition too, so that no document escapes it
    kept, seen = checked.where(F.length(strip("text")) >= min_chars), Observation()
    kept.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).option("compression", "gzip").json(path)
    return seen.get["n"]


def write_blend(df: DataFrame, path: str, source_col: str = "source", mode: str = "errorifexists") -> None:
    """One folder of gzipped JSON lines for each source."""
    df.write.mode(mode).partitionBy(source_col).option("compression", "gzip").json(path)


def write_json(path: str, value: dict) -> None:
    """A small JSON file, written by the driver."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")


def write_ranking(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """A ranking of bounded length as one CSV file with a header; how many rows. The query runs once."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).coalesce(1).write.mode(mode).option("header", "true").csv(path)
    return seen.get["n"]


def write_text(df: DataFrame, path: str, text_col: str = "text", mode: str = "errorifexists") -> None:
    df.select(text_col).write.mode(mode).text(path)
