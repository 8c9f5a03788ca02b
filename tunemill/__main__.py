"""Command line: ``python -m tunemill <command> --help``."""

from __future__ import annotations

import argparse

from tunemill.operators.voting import vote_consensus
from tunemill.plans.catalog import declared_schemas, load_catalog
from tunemill.plans.evaluation import comparison, evaluation_items, recipe_table, with_prompts
from tunemill.plans.recipe import Recipe
from tunemill.plans.training import finished_recipes, record_finished, run_recipes
from tunemill.session import get_session
from tunemill.sources.datasets import Library

SHOWN = 20


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tunemill")
    commands = parser.add_subparsers(dest="command", required=True)

    train = commands.add_parser("prepare", help="write the training sets of recipes")
    train.add_argument("recipes", nargs="+")
    train.add_argument("--key", nargs="+", required=True, help="columns that identify a row")
    train.add_argument("--out", required=True)
    train.add_argument("--catalog", help="folder of descriptors; their columns are the schema to read with")
    train.add_argument("--complete", action="store_true", help="no input or output is missing")
    train.add_argument("--again", action="store_true", help="also recipes that an earlier run has finished")

    load = commands.add_parser("load", help="open all data sets of a catalog that are small enough")
    load.add_argument("catalog")
    load.add_argument("--out", help="folder to store each data set in, with bad rows apart")

    for command in (train, load):
        command.add_argument("--root", required=True, help="folder of the data sets")
        command.add_argument("--format", default="parquet")
        command.add_argument("--suffix", default="")

    prompts = commands.add_parser("prompts", help="write the evaluation prompts of recipes")
    prompts.add_argument("recipes", nargs="+")
    prompts.add_argument("--out", required=True)

    score = commands.add_parser("score", help="compare base and tuned outputs")
    score.add_argument("recipes", nargs="+")
    score.add_argument("--outputs", required=True, help="parquet: recipe, pos, variant, output")
    score.add_argument("--out", help="folder for the scores as a table; printed if not given")

    vote = commands.add_parser("vote", help="the answer most models give")
    vote.add_argument("--responses", required=True, help="parquet: item, voter_pos, response")
    vote.add_argument("--out", help="folder for the answers as a table; the first are printed if not given")
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = get_session()
    recipes = [Recipe.read(path) for path in getattr(args, "recipes", [])]
    if args.command in ("prepare", "load"):
        library = Library(args.root, args.format, args.suffix)
    if args.command == "prepare":
        done = [] if args.again else finished_recipes(spark, args.out)
        schemas = declared_schemas(args.catalog) if args.catalog else None
        outcome = run_recipes(spark, library, recipes, args.key, args.out, done, schemas, args.complete)
        record_finished(spark, args.out, outcome)
        for name, result in outcome.items():
            print(f"{name}: {result}")
    elif args.command == "load":
        loaded = load_catalog(spark, args.catalog, library, out=args.out)
        for name, df in loaded.frames.items():
            print(f"{name}: {df.schema.simpleString()}")
        for name, reason in loaded.failed.items():
            print(f"{name}: {reason}")
    elif args.command == "prompts":
        items = evaluation_items(recipe_table(spark, recipes))
        with_prompts(items).write.mode("overwrite").parquet(args.out)
    elif args.command == "score":
        items = evaluation_items(recipe_table(spark, recipes))
        compared = comparison(items, spark.read.parquet(args.outputs))
        if args.out:
            compared.write.mode("overwrite").parquet(args.out)
        else:
            compared.orderBy("recipe").show(len(recipes), False)
    else:
        responses = spark.read.parquet(args.responses)
        answers = vote_consensus(responses, "item", "response", "voter_pos")
        if args.out:
            answers.write.mode("overwrite").parquet(args.out)
        else:
            answers.orderBy("item").show(SHOWN, False)
            more = answers.count() - SHOWN
            if more > 0:
                print(f"{more} more items; --out writes all of them")


if __name__ == "__main__":
    main()
