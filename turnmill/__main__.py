"""Command line: ``python -m turnmill prepare ...``, or this file through ``spark-submit``."""

import argparse
from dataclasses import fields

from pyspark.sql import SparkSession

from turnmill import schemas
from turnmill.config import GenerationParams, PrepareConfig
from turnmill.operators.adapt import field, with_row_key
from turnmill.operators.evals import eval_summary, first_responses
from turnmill.operators.stats import dataset_stats
from turnmill.plans.evaluate import results_of, write_results
from turnmill.plans.prepare import prepare_to_jsonl
from turnmill.sinks.publish import is_published, published
from turnmill.sources.jsonl import load_splits, read_eval_prompts, read_jsonl, union_splits
from turnmill.sources.pairs import read_pairs


def _options(parser: argparse.ArgumentParser, settings: type) -> None:
    """One option per setting, with its type and default."""
    for f in fields(settings):
        parser.add_argument("--" + f.name.replace("_", "-"), type=f.type, default=f.default)


def _settings(args: argparse.Namespace, settings: type):
    return settings(**{f.name: getattr(args, f.name) for f in fields(settings)})


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="turnmill", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    prepare = commands.add_parser("prepare", help="pairs to checked, shuffled and split JSON Lines")
    prepare.add_argument("pairs", help="table with Context and Response")
    prepare.add_argument("--format", default="parquet", choices=["parquet", "json", "csv", "orc"])
    prepare.add_argument("--key", help="unique column; without it one is made from the content")
    _options(prepare, PrepareConfig)

    stats = commands.add_parser("stats", help="figures of stored splits")
    stats.add_argument("train", help="a split, or the output folder of prepare for what is published there")
    stats.add_argument("validation", nargs="?")

    results = commands.add_parser("results", help="evaluation prompts and responses to result records")
    results.add_argument("prompts", help="JSON Lines with messages or prompt")
    results.add_argument("responses", help="JSON Lines with sample_id, response, error")
    results.add_argument("output")
    _options(results, GenerationParams)
    return parser.parse_args(argv)


def run_prepare(spark: SparkSession, args: argparse.Namespace) -> None:
    key, pairs = args.key, read_pairs(spark, args.pairs, args.format)
    if key is None:
        key, pairs = "row_key", with_row_key(pairs.select(*(field(pairs, c).alias(c) for c in ("Context", "Response"))))
    report = prepare_to_jsonl(pairs, key, _settings(args, PrepareConfig))
    print(report.summary())
    report.preview.orderBy("sample_no", "msg_idx").show(2 * args.preview, truncate=False)


def run_stats(spark: SparkSession, args: argparse.Namespace) -> None:
    paths = {"train": args.train, "validation": args.validation}
    if args.validation is None and is_published(spark, args.train):
        paths = published(spark, args.train).paths
    splits = load_splits(spark, paths)
    dataset_stats(union_splits(splits), by="split").show(truncate=False, vertical=True)


def run_results(spark: SparkSession, args: argparse.Namespace) -> None:
    prompts = read_eval_prompts(spark, args.prompts)
    responses = read_jsonl(spark, args.responses, schemas.RESPONSES)
    write_results(prompts, responses, args.output, _settings(args, GenerationParams))
    written = results_of(spark, args.output)
    eval_summary(written).show()
    first_responses(written).show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = SparkSession.builder.appName(f"turnmill-{args.command}").getOrCreate()
    {"prepare": run_prepare, "stats": run_stats, "results": run_results}[args.command](spark, args)


if __name__ == "__main__":
    main()
