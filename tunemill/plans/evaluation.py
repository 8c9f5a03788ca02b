"""From recipes and model outputs to scores.

Text generation happens elsewhere: prompts leave as a table, and outputs come
back as one with the columns ``recipe, pos, variant, output``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.functions.extract import user_part
from tunemill.functions.templates import evaluation_prompt
from tunemill.operators.scoring import compare_variants, exact_match_score
from tunemill.plans.recipe import Recipe

RECIPE_SCHEMA = (
    "recipe string, context_hint string, evaluations array<struct<"
    "prompt: string, context: string, hint: string, expected_output: string>>"
)


def recipe_table(spark: SparkSession, recipes: Sequence[Recipe]) -> DataFrame:
    rows = [
        (
            r.name,
            r.context_hint,
            [(i.prompt, i.context, i.hint, i.expected_output) for i in r.evaluations],
        )
        for r in recipes
    ]
    return spark.createDataFrame(rows, RECIPE_SCHEMA)


def evaluation_items(recipes: DataFrame) -> DataFrame:
    """One row per evaluation, ``pos`` counting from 0 within a recipe."""
    exploded = recipes.select("recipe", "context_hint", F.posexplode("evaluations").alias("pos", "item"))
    return exploded.select(
        "recipe",
        "pos",
        F.col("item.prompt").alias("question"),
        F.col("item.context").alias("context"),
        F.col("item.hint").alias("hint"),
        "context_hint",
        F.col("item.expected_output").alias("expected"),
    )


def with_prompts(items: DataFrame) -> DataFrame:
    """Add the prompt to send to the model and the user part to show."""
    prompt = evaluation_prompt(*[F.col(c) for c in ("question", "context", "hint", "context_hint")])
    return items.withColumn("prompt", prompt).withColumn("shown", user_part(F.col("prompt")))


def _answered(items: DataFrame, outputs: DataFrame) -> DataFrame:
    """Every item once for each variant that answered anything; a missing output is NULL and scores 0.

    Variants are few (base, tuned), so they are a short array in each item.
    """
    variants = outputs.agg(F.array_sort(F.collect_set("variant"))).scalar()
    asked = items.select("recipe", "pos", "expected", F.explode(variants).alias("variant"))
    given = outputs.select("recipe", "pos", "variant", "output")
    return asked.join(given, ["recipe", "pos", "variant"], "left").select(
        "recipe", "pos", "variant", "output", "expected"
    )


def scores(items: DataFrame, outputs: DataFrame) -> DataFrame:
    """Exact matches per recipe and variant."""
    return exact_match_score(_answered(items, outputs), "recipe", "variant")


def comparison(items: DataFrame, outputs: DataFrame) -> DataFrame:
    """Base and tuned score per recipe."""
    return compare_variants(_answered(items, outputs), "recipe")
