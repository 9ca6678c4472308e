"""Runs a recipe: reads its sources, cleans them together, blends them to the budget, writes the result and its manifest."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuswright.operators import blend
from corpuswright.plans.clean import clean
from corpuswright.plans.config import Recipe, Step, load_recipe
from corpuswright.plans.storage import written
from corpuswright.sources import readers, writers

READ: dict[str, Callable[[SparkSession, Step], DataFrame]] = {
    "jsonl": lambda spark, s: readers.read_jsonl(spark, s.params["path"], s.params.get("text_key", "text"), s.params.get("id_key", "id"), int(s.params.get("limit", -1))),
    "parquet": lambda spark, s: _columns(spark.read.parquet(s.params["path"]), s),
    "wikipedia": lambda spark, s: readers.encyclopedia(spark.read.parquet(s.params["path"]), int(s.params.get("limit", -1))),
    "legislation": lambda spark, s: readers.legislation(spark.read.parquet(s.params["path"]), limit=int(s.params.get("limit", -1))),
    "pages": lambda spark, s: readers.crawl_documents(spark.read.parquet(s.params["path"])),
}


def _columns(df: DataFrame, step: Step) -> DataFrame:
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return df.select(F.col(step.params.get("id_key", "id")).cast("string").alias("id"), F.col(step.params.get("text_key", "text")).alias("text"), none.alias("metadata"))


def ingest(spark: SparkSession, recipe: Recipe) -> DataFrame:
    """All sources as one table; ids carry the source's name."""
    parts = [READ[s.kind](spark, s).select(F.concat(F.lit(f"{s.name}:"), F.col("id")).alias("id"), "text", "metadata", F.lit(s.name).alias("source")) for s in recipe.sources]
    return reduce(DataFrame.unionByName, parts)


def done(spark: SparkSession, path: str) -> bool:
    """Whether a write to a path has ended well."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def run(spark: SparkSession, recipe: Recipe, force: bool = False) -> dict:
    """The manifest of the blend. What an earlier run has cleaned is used again, unless told otherwise."""
    root, config = recipe.output_root.rstrip("/"), replace(recipe.cleaning, tokenizer=recipe.tokenizer or recipe.cleaning.tokenizer)
    path = f"{root}/clean"
    if force or not done(spark, path):
        result = clean(ingest(spark, recipe), config)
        result.final.write.mode("overwrite").parquet(path)
        result.removed.write.mode("overwrite").parquet(f"{root}/removed")
        result.rejected.write.mode("overwrite").parquet(f"{root}/rejected")
        outcomes = {r.outcome: r.documents for r in result.summary().collect()}
        _write_text(spark, f"{root}/corpus_manifest", {"sources": [s.name for s in recipe.sources], "outcomes": outcomes, "stats": result.count()})
        if recipe.export_json:
            spark.read.parquet(path).write.mode("overwrite").option("compression", "gzip").json(f"{root}/clean_json")
    docs = spark.read.parquet(path)
    sources = [blend.Source(s.name, s.weight, s.license, s.register) for s in recipe.sources]
    chosen = written(blend.select(docs, sources, recipe.target_tokens, recipe.shuffle_seed, tokens_col="token_count"), "chosen")
    writers.write_blend(blend.blend(docs, chosen).drop("token_count"), f"{root}/blend", mode="overwrite")
    rows = blend.manifest(docs, chosen, sources, recipe.target_tokens, tokens_col="token_count")
    manifest = blend.manifest_json(rows, sources, recipe.target_tokens, config.tokenizer or "whitespace")
    _write_text(spark, f"{root}/manifest", manifest)
    return manifest


def _write_text(spark: SparkSession, path: str, value: dict) -> None:
    """A small JSON value, by Spark's writer, wherever the path is."""
    spark.createDataFrame([(json.dumps(value, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("recipe")
    parser.add_argument("--target-tokens")
    parser.add_argument("--output-root")
    parser.add_argument("--force", action="store_true")
    parser.add_argument("--dry-run", action="store_true", help="check the recipe and show it")
    args = parser.parse_args(argv)
    recipe = load_recipe(args.recipe, target_tokens=args.target_tokens, output_root=args.output_root)
    if args.dry_run:
        print(recipe)
        return 0
    spark = SparkSession.builder.appName("corpuswright").getOrCreate()
    totals = run(spark, recipe, args.force)["totals"]
    print(f"{totals['docs']} documents, {totals['achieved_tokens']} of {totals['target_tokens']} tokens")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
