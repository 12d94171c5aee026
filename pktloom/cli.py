"""Command line: python -m pktloom.cli process|stats|pretrain-cache|finetune-cache."""

from __future__ import annotations

import argparse
import inspect
from collections.abc import Callable

from pyspark.sql import SparkSession

from .plans import jobs


def _options(parser: argparse.ArgumentParser, job: Callable) -> None:
    """An option for each parameter of a job after the session; those without a default are required."""
    for p in list(inspect.signature(job).parameters.values())[1:]:
        flag, required = f"--{p.name.replace('_', '-')}", p.default is inspect.Parameter.empty
        if isinstance(p.default, bool):
            parser.add_argument(flag, action="store_true")
        else:
            parser.add_argument(flag, required=required, **({} if required else {"default": p.default, "type": type(p.default)}))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pktloom")
    sub = top.add_subparsers(dest="command", required=True)
    sub.add_parser("process").add_argument("-c", "--config", required=True)
    stats = sub.add_parser("stats")
    stats.add_argument("-c", "--config", required=True)
    stats.add_argument("-o", "--output", required=True)
    _options(sub.add_parser("pretrain-cache"), jobs.pretrain_cache)
    _options(sub.add_parser("finetune-cache"), jobs.finetune_cache)
    return top


def main(args: list[str] | None = None) -> None:
    options = vars(parser().parse_args(args))
    command = options.pop("command")
    spark = SparkSession.builder.appName("pktloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if command == "process":
        jobs.process(spark, options["config"])
    elif command == "stats":
        jobs.dataset_statistics(spark, options["config"], options["output"])
    else:
        {"pretrain-cache": jobs.pretrain_cache, "finetune-cache": jobs.finetune_cache}[command](spark, **options)


if __name__ == "__main__":
    main()
