"""Blending of sources to a token budget."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Source:
    name: str
    weight: float
    license: str = "unknown"
    register: str = "unknown"


def targets(sources: list[Source], budget: int) -> dict[str, int]:
    """Tokens wanted of each source by its share of the weights (halves to even)."""
    total = sum(s.weight for s in sources)
    if total <= 0 or any(s.weight < 0 for s in sources):
        raise ValueError("weights must not be negative, and their sum must be above zero")
    if len({s.name for s in sources}) != len(sources):
        raise ValueError("source names must differ")
    return {s.name: round(s.weight / total * budget) for s in sources}


def _wanted(source: Column, target: dict[str, int]) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for pair in target.items() for x in pair])[source], F.lit(0)).cast("long")


def select(df: DataFrame, sources: list[Source], budget: int, seed: int = 0, id_col: str = "id", source_col: str = "source", tokens_col: str = "tokens") -> DataFrame:
    """``(id, source, tokens, before)`` of the documents that are taken: each source's, in an order that depends on the seed,
    the source's name and the id alone, until its target is reached (so by one document more than that at most).

    Only ids and numbers are shuffled. A source is not sorted in one task: prefix sums are taken within slices of the order
    (the leading byte of the key), and slices are moved up by the sums of those before.
    """
    target = targets(sources, budget)
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(source_col), F.col(id_col).cast("string")).cast("binary"))
    narrow = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.coalesce(F.col(tokens_col), F.lit(0)).cast("long").alias("tokens"), key.alias("key"))
    narrow = narrow.where(F.col("source").isin(*target)).withColumn("slice", F.substring("key", 1, 2))
    within = Window.partitionBy("source", "slice").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, -1)
    placed = narrow.withColumn("inside", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    # at most 256 rows a source
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = narrow.groupBy("source", "slice").agg(F.sum("tokens").alias("n")).select("source", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    before = placed.join(F.broadcast(sums), ["source", "slice"]).withColumn("before", F.col("start") + F.col("inside"))
    return before.where(F.col("before") < _wanted(F.col("source"), target)).select("id", "source", "tokens", "before")


def blend(df: DataFrame, chosen: DataFrame, id_col: str = "id") -> DataFrame:
    """The documents that ``select`` took, with all their columns."""
    return df.join(chosen.select(F.col("id").alias(id_col)), id_col, "left_semi")


def manifest(df: DataFrame, chosen: DataFrame, sources: list[Source], budget: int, source_col: str = "source", tokens_col: str = "tokens") -> DataFrame:
    """``(source, target_tokens, available_tokens, achieved_tokens, docs, shortfall_tokens)`` of every source, and their totals
    in a row whose source is null. A source without documents has zeros."""
    target = targets(sources, budget)
    listed = df.sparkSession.createDataFrame(list(target.items()), "source string, target_tokens long")
    available = df.groupBy(F.col(source_col).alias("source")).agg(F.sum(F.coalesce(F.col(tokens_col), F.lit(0))).alias("available_tokens"))
    achieved = chosen.groupBy("source").agg(F.sum("tokens").alias("achieved_tokens"), F.count("*").alias("docs"))
    rows = listed.join(available, "source", "left").join(achieved, "source", "left").na.fill(0, ["available_tokens", "achieved_tokens", "docs"])
    rows = rows.withColumn("shortfall_tokens", F.greatest(F.lit(0), F.col("target_tokens") - F.col("achieved_tokens")))
    numbers = ("target_tokens", "available_tokens", "achieved_tokens", "docs", "shortfall_tokens")
    # the totals' target is the budget itself: rounded shares may add up to another number
    summed = rows.rollup("source").agg(*[F.sum(n).alias(n) for n in numbers], F.grouping("source").alias("total"))
    return summed.withColumn("target_tokens", F.when(F.col("total") == 1, F.lit(budget).cast("long")).otherwise(F.col("target_tokens"))).drop("total")


def manifest_json(rows: DataFrame, sources: list[Source], budget: int, tokenizer: str = "whitespace") -> dict:
    """The manifest as it is written beside a blend."""
    found = {r.source: r.asDict() for r in rows.collect()}
    total, weights = found.get(None, {}), sum(s.weight for s in sources)
    return {
        "sources": [{"name": s.name, "license": s.license, "register": s.register, "weight": s.weight / weights} | {k: v for k, v in found[s.name].items() if k != "source"} for s in sources],
        "totals": {"target_tokens": budget, "achieved_tokens": total.get("achieved_tokens", 0), "docs": total.get("docs", 0), "shortfall_tokens": total.get("shortfall_tokens", 0), "tokenizer": tokenizer},
    }


def export_split(df: DataFrame, share: float = 0.01, seed: int = 0, id_col: str = "id", text_col: str = "text", min_chars: int = 1, order_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Lines for training and for evaluation: one document a line, the first of each id, short ones left out.

    The first is that with the least ``order_col``, by default in the order in which rows are read; if it is short, its id is
    left out. Evaluation gets ``max(1, round(share * n))`` documents, those whose seeded digest of id and text is smallest. Rows
    without an id are never taken for copies of each other.
    """
    from corpuswright.functions.text import collapse

    order = F.col(order_col) if order_col else F.monotonically_increasing_id()
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.coalesce(collapse(text_col), F.lit("")).alias("text"), order.alias("order"))
    named = F.coalesce(F.col("id"), F.lit("")) != ""
    first = rows.where(named).groupBy("id").agg(F.min(F.struct("order", "text")).alias("first")).select("id", F.col("first.text").alias("text"))
    kept = first.unionByName(rows.where(~named).select("id", "text")).where(F.length("text") >= min_chars)
    kept = kept.withColumn("key", F.md5(F.concat_ws(":", F.lit(str(seed)), "id", "text").cast("binary")))
    n = kept.count()
    if not n:
        return kept.select("id", "text"), kept.select("id", "text")
    wanted = max(1, round(share * n))
    # the limit's key, found without sorting all rows in one task
    ranked = kept.select("key").withColumn("slice", F.substring("key", 1, 4))
    slices = ranked.groupBy("slice").agg(F.count("*").alias("n"))
    upto = slices.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    edge = upto.where(F.col("before") < wanted).orderBy(F.desc("slice")).first()
    last = [r.key for r in ranked.where(F.col("slice") == edge.slice).orderBy("key").limit(wanted - edge.before).collect()][-1]
    return kept.where(F.col("key") > last).select("id", "text"), kept.where(F.col("key") <= last).select("id", "text")
