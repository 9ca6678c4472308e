"""Single steps from the command line: ``python -m corpuswright.plans.cli calibrate docs.json out``."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuswright.operators import blend, calibrate, hosts, tokens
from corpuswright.plans.config import budget
from corpuswright.plans.ship import ship
from corpuswright.sources import readers, writers


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents ``(id, text)`` of JSON lines, or of Parquet if the path says so."""
    return spark.read.parquet(path) if ".parquet" in path else readers.read_jsonl(spark, path)


def run_calibrate(spark: SparkSession, args: argparse.Namespace) -> dict:
    found, told = calibrate.calibrated(read(spark, args.input), args.strategy, args.q, args.top)
    calibrate.write_artifacts(found, args.output, told)
    return told["thresholds"]


def run_export(spark: SparkSession, args: argparse.Namespace) -> dict:
    train, held = blend.export_split(read(spark, args.input), args.share, args.seed, min_chars=args.min_chars)
    for name, rows in (("train", train), ("eval", held)):
        writers.write_text(rows, f"{args.output}/{name}")
    return {"train": train.count(), "eval": held.count()}


def run_segment(spark: SparkSession, args: argparse.Namespace) -> dict:
    docs = read(spark, args.input)
    writers.write_text(tokens.segment(docs, tokens.suffixes), args.output)
    return tokens.segmentation_stats(docs).first().asDict()


def run_tokenizer(spark: SparkSession, args: argparse.Namespace) -> dict:
    made = tokens.build_tokenizer(read(spark, args.input), tokens.suffixes, budget(args.vocabulary), args.merges)
    made.save(args.output)
    return {"merges": len(made.merges), "pieces": len(made.pieces)}


def run_fertility(spark: SparkSession, args: argparse.Namespace) -> dict:
    return tokens.fertility(read(spark, args.input), tokens.counter(args.tokenizer)).first().asDict()


def run_blend(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Documents have a ``source``; each is counted, and taken by the sources' weights."""
    docs = tokens.count_tokens(read(spark, args.input), tokens.counter(args.tokenizer))
    docs = docs if "source" in docs.columns else docs.withColumn("source", F.col("metadata")["source"])
    sources = [blend.Source(name, float(weight)) for name, weight in (w.split("=") for w in args.weight)]
    chosen = blend.select(docs, sources, budget(args.tokens), args.seed, tokens_col="token_count").cache()
    writers.write_blend(blend.blend(docs, chosen).drop("token_count"), args.output)
    return blend.manifest_json(blend.manifest(docs, chosen, sources, budget(args.tokens), tokens_col="token_count"), sources, budget(args.tokens), args.tokenizer or "whitespace")


def run_hosts(spark: SparkSession, args: argparse.Namespace) -> dict:
    """A ranking of the hosts of one crawl of a columnar index, read by its folder alone."""
    index = spark.read.option("basePath", args.input).parquet(hosts.index_path(args.input, args.crawl))
    rows = hosts.index_rows(index, args.crawl, language=args.language)
    return {"hosts": writers.write_ranking(hosts.host_rank(rows, min_pages=args.min_pages, limit=args.limit), args.output)}


STEPS: dict[str, tuple[Callable[[SparkSession, argparse.Namespace], dict], dict[str, object]]] = {
    "calibrate": (run_calibrate, {"strategy": "quantile", "q": 0.005, "top": 175}),
    "export": (run_export, {"share": 0.01, "seed": 0, "min-chars": 1}),
    "segment": (run_segment, {}),
    "tokenizer": (run_tokenizer, {"vocabulary": "64000", "merges": 16_000}),
    "fertility": (run_fertility, {"tokenizer": ""}),
    "blend": (run_blend, {"weight": [], "tokens": "1000000", "seed": 0, "tokenizer": ""}),
    "hosts": (run_hosts, {"crawl": "", "language": "tur", "min-pages": 1, "limit": 0}),
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(description=__doc__)
    steps = out.add_subparsers(dest="step", required=True)
    for name, (fn, options) in STEPS.items():
        step = steps.add_parser(name, help=fn.__doc__)
        step.add_argument("input")
        step.add_argument("output", nargs="?" if name == "fertility" else None)
        for option, default in options.items():
            step.add_argument(f"--{option}", default=default, **({"action": "append"} if isinstance(default, list) else {"type": type(default)}))
    return out


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = ship(SparkSession.builder.appName(f"corpuswright {args.step}").getOrCreate())
    print(json.dumps(STEPS[args.step][0](spark, args), ensure_ascii=False))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
