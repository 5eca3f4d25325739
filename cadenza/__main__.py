"""Command line: build, validate, transcribe, score."""

from __future__ import annotations

import argparse
import sys


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cadenza", description="Validated, reproducible, versioned datasets of prompted speech, and scores of transcripts of them.")
    commands = top.add_subparsers(dest="command", required=True)
    source = argparse.ArgumentParser(add_help=False)
    source.add_argument("--data-in", required=True, help="input directory, read only")
    source.add_argument("--config", help="TOML file that overrides defaults")
    commands.add_parser("build", parents=[source], help="build a dataset version").add_argument("--data-out", required=True, help="output directory, replaced as a whole")
    commands.add_parser("validate", parents=[source], help="check the input and print the quality digest")
    transcribe = commands.add_parser("transcribe", help="transcribe a built dataset version into a new run")
    transcribe.add_argument("--dataset", required=True)
    transcribe.add_argument("--eval-out", required=True)
    score = commands.add_parser("score", help="score a run and print the report")
    score.add_argument("--run", required=True)
    score.add_argument("--split", help="only this split")
    score.add_argument("--format", choices=("text", "json"), default="text")
    return top


def main(arguments: list[str] | None = None, spark=None) -> int:
    given = parser().parse_args(arguments)
    from cadenza.errors import HardError
    from cadenza.plans import commands

    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("cadenza").getOrCreate()
    try:
        if given.command == "build":
            commands.build(spark, given.data_in, given.data_out, given.config)
        elif given.command == "validate":
            print(commands.validate(spark, given.data_in, given.config), end="")
        elif given.command == "transcribe":
            print(commands.transcribe(spark, given.dataset, given.eval_out))
        else:
            print(commands.score(spark, given.run, given.split, given.format), end="")
    except HardError as error:
        print(f"error: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
