"""From a recipe to a training set, as one lazy plan.

The filter and the few columns a recipe needs reach the scan; the template is
chosen while the plan is built.  Many recipes over one source share one scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from itertools import groupby
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill.functions import templates
from tunemill.functions.values import as_text, label_text, literal_text
from tunemill.operators.filters import filter_equals, literal, require_columns
from tunemill.operators.sampling import every_kth, split_exact, split_exact_by
from tunemill.plans.recipe import SPLIT_SEED, TEST_SHARE, Recipe
from tunemill.sources.datasets import FAILURES, Library, reason, scan, write_parts, write_splits

Template = Callable[[Mapping[str, Column]], Column]

# Up to this many recipes their table (names and hints, a few MB) is sent to every task; beyond, a shuffle.
BROADCAST_RECIPES = 10_000
# Filter values that are spelled out for the scan; more come from a table, with the same result.
PUSHED_VALUES = 100
# Literals that are cast together.
LITERALS = 500
# Where a job records what it has finished; the underscore hides it from readers of the data.
MANIFEST = "_finished"


def _field(df: DataFrame, name: str) -> Column:
    return as_text(F.col(name), df.schema[name].dataType)


def render_column(df: DataFrame, recipe: Recipe, template: Template | None = None) -> Column:
    """The training text of a row; NULL when its input or output is missing.

    A ``template`` of the caller's gets the recipe's columns as text, under
    the names ``input``, ``output`` and ``context``, in place of the choice
    that follows from the recipe.
    """
    fields = {"input": _field(df, recipe.input_field_name)}
    if recipe.output_field_name is not None:
        output = _field(df, recipe.output_field_name)
        fields["output"] = label_text(output, recipe.output_field_values_to_texts)
        if recipe.context_field_name is not None:
            fields["context"] = F.coalesce(_field(df, recipe.context_field_name), F.lit(""))
    if template is not None:
        return template(fields)
    question = fields["input"]
    if "output" not in fields:
        return templates.pretrain_text(question)
    answer = fields["output"]
    if "context" in fields and recipe.context_hint is not None:
        return templates.context_hint_text(recipe.context_hint, fields["context"], question, answer)
    if "context" in fields:
        return templates.context_text(fields["context"], question, answer)
    if recipe.input_hint is not None:
        return templates.hint_text(recipe.input_hint, question, answer)
    return templates.qa_text(question, answer)


def training_texts(
    df: DataFrame,
    recipe: Recipe,
    key: Sequence[str],
    observation: Observation | None = None,
    complete: bool = False,
    template: Template | None = None,
) -> DataFrame:
    """Filter and render a data set: the key columns and ``text``.

    Rows without an input or an output are dropped, a missing context is
    empty; ``observation`` counts what was dropped.  The test is on the
    columns and not on the text made from them: it reaches the scan, and
    whoever needs the keys alone does not render anything.  ``complete`` says
    that no input or output is missing; then the test is left out, and the
    passes over the keys of a split need not read the texts at all.
    """
    require_columns(df, *recipe.columns, *key)
    if recipe.filter_field_name is not None:
        df = filter_equals(df, recipe.filter_field_name, recipe.filter_field_value)
    whole = F.col(recipe.input_field_name).isNotNull()
    if recipe.output_field_name is not None:
        whole &= F.col(recipe.output_field_name).isNotNull()
    if observation is not None:
        dropped = F.count_if(~whole).alias("dropped")
        df = df.observe(observation, F.count("*").alias("rows"), dropped)
    if not complete:
        df = df.filter(whole)
    return df.select(*key, render_column(df, recipe, template).alias("text"))


def training_set(
    df: DataFrame, recipe: Recipe, key: Sequence[str], complete: bool = False
) -> DataFrame:
    """Key, ``text`` and ``split``, with exactly a fifth (rounded up) of the rows in test."""
    texts = training_texts(every_kth(df, recipe.every_kth), recipe, key, complete=complete)
    return split_exact(texts, key, SPLIT_SEED, TEST_SHARE)


def prepare(
    spark: SparkSession,
    library: Library,
    recipe: Recipe,
    key: Sequence[str],
    out: str,
    complete: bool = False,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Write the training set of one recipe and return it as stored.

    ``complete``: see :func:`training_texts`.  ``schema``: the declared one.
    """
    source = scan(spark, library, recipe.dataset_id, recipe.load_config, schema=schema)
    write_splits(training_set(source, recipe, key, complete), out)
    return spark.read.parquet(out)


# --- many recipes over one source -----------------------------------------

Binding = tuple[str, str | None, str | None]
INPUT, OUTPUT, CONTEXT = range(3)


def _binding(recipe: Recipe) -> Binding:
    """The columns that a recipe reads as input, output and context."""
    context = recipe.context_field_name if recipe.output_field_name else None
    return recipe.input_field_name, recipe.output_field_name, context


def _bound(df: DataFrame, bindings: Sequence[Binding], part: int) -> Column:
    """The column each recipe means; where all agree there is nothing to choose."""

    def as_field(name: str | None) -> Column:
        if name is None:
            return F.lit(None).cast("string")
        text = _field(df, name)
        return F.coalesce(text, F.lit("")) if part == CONTEXT else text

    names = [binding[part] for binding in bindings]
    if len(set(names)) == 1:
        return as_field(names[0])
    return F.coalesce(
        *[F.when(F.col("_binding") == i, as_field(name)) for i, name in enumerate(names)]
    )


RECIPE_ROW = T.StructType(
    [
        T.StructField("_recipe", T.StringType()),
        T.StructField("_binding", T.IntegerType()),
        T.StructField("_context_hint", T.StringType()),
        T.StructField("_input_hint", T.StringType()),
        T.StructField("_names", T.MapType(T.StringType(), T.StringType())),
    ]
)


def _recipe_row(recipe: Recipe, bindings: Sequence[Binding]) -> tuple[Any, ...]:
    texts = recipe.output_field_values_to_texts.items()
    names = {literal_text(value): literal_text(text) for value, text in texts}
    binding = bindings.index(_binding(recipe))
    return recipe.name, binding, recipe.context_hint, recipe.input_hint, names or None


def _numbers_by_value(df: DataFrame, recipes: Sequence[Recipe]) -> dict[str, dict[Any, list[int]]]:
    """For each filter column, the numbers of the recipes by the value they ask for.

    The values are cast as :func:`equals` casts them, all at once, by Spark;
    one that the column's type cannot hold, or NULL, asks for no row.
    """
    asked = [(i, r.filter_field_name, r.filter_field_value) for i, r in enumerate(recipes) if r.filter_field_name]
    if not asked:
        return {}
    numbers: dict[str, dict[Any, list[int]]] = {}
    for start in range(0, len(asked), LITERALS):
        part = asked[start : start + LITERALS]
        cast = [literal(df, name, value).alias(f"v{i}") for i, name, value in part]
        row = df.sparkSession.range(1).select(*cast).first()
        for i, name, _ in part:
            if row[f"v{i}"] is not None:
                numbers.setdefault(name, {}).setdefault(row[f"v{i}"], []).append(i)
    return numbers


def _with_recipes(df: DataFrame, recipes: Sequence[Recipe], bindings: Sequence[Binding]) -> DataFrame:
    """Every row once for each recipe that wants it, from one scan.

    Each filter column is looked up in a map from values to recipe numbers;
    the numbers found, and those of recipes without a filter, become rows, and
    the recipes' other attributes come from a table by number.
    """
    spark = df.sparkSession
    table = spark.createDataFrame([(i, *_recipe_row(r, bindings)) for i, r in enumerate(recipes)],
                                  T.StructType([T.StructField("_number", T.IntegerType()), *RECIPE_ROW.fields]))
    whole = [i for i, r in enumerate(recipes) if r.filter_field_name is None]
    found = [F.array(*map(F.lit, whole)).cast("array<int>")]
    wanted = [F.lit(True)] if whole else []
    numbers = _numbers_by_value(df, recipes)
    for name, by_value in numbers.items():
        if len(by_value) <= PUSHED_VALUES:
            # Any of the values: the scan skips others early where all recipes filter.
            wanted += [F.col(name) == F.lit(value) for value in by_value]
            hits = [F.when(F.col(name) == F.lit(value), F.array(*map(F.lit, some))) for value, some in by_value.items()]
            found.append(F.coalesce(*hits, F.array().cast("array<int>")))
        else:
            wanted.append(F.col(name).isNotNull())
            rows = [(value, some) for value, some in by_value.items()]
            kind = T.StructType([T.StructField("_value", df.schema[name].dataType), T.StructField("_some", T.ArrayType(T.IntegerType()))])
            lookup = _listed(spark.createDataFrame(rows, kind), len(rows))
            df = df.join(lookup, F.col(name) == F.col("_value"), "left").drop("_value")
            df = df.withColumnRenamed("_some", f"_some_{len(found)}")
            found.append(F.coalesce(F.col(f"_some_{len(found)}"), F.array().cast("array<int>")))
    if not whole:
        df = df.filter(reduce(lambda left, right: left | right, wanted) if wanted else F.lit(False))
    numbered = df.withColumn("_number", F.explode(F.concat(*found)))
    return numbered.join(_listed(table, len(recipes)), "_number")


def _listed(table: DataFrame, rows: int) -> DataFrame:
    """A table of recipes, sent to every task while it is short."""
    return F.broadcast(table) if rows <= BROADCAST_RECIPES else table


def fan_out(
    df: DataFrame, recipes: Sequence[Recipe], key: Sequence[str], complete: bool = False
) -> DataFrame:
    """The texts of many recipes over one source: ``recipe``, the key and ``text``.

    All recipes share one scan, whatever they filter by and do with the rows.
    The number of recipes changes the plan, never the result.  ``complete``:
    no input or output is NULL, so whoever needs the keys alone reads no text.
    """
    if not recipes:
        raise ValueError("no recipes")
    if len({r.source for r in recipes}) > 1:
        raise ValueError("the recipes read different sources")
    for recipe in recipes:
        require_columns(df, *recipe.columns, *key)
    sampled = every_kth(df, recipes[0].every_kth)
    bindings = sorted({_binding(r) for r in recipes}, key=str)
    joined = _with_recipes(sampled, recipes, bindings)
    found = _bound(df, bindings, OUTPUT)
    fields = joined.select(
        F.col("_recipe").alias("recipe"),
        *key,
        _bound(df, bindings, INPUT).alias("_input"),
        found.alias("_found"),
        F.coalesce(F.element_at("_names", found), found).alias("_output"),
        _bound(df, bindings, CONTEXT).alias("_context"),
        "_context_hint",
        "_input_hint",
        F.col("_binding").isin([i for i, b in enumerate(bindings) if b[OUTPUT] is None]).alias("_plain"),
    )
    whole = fields
    if not complete:
        whole = fields.filter(F.col("_input").isNotNull() & (F.col("_plain") | F.col("_found").isNotNull()))
    parts = ("_input", "_output", "_context", "_context_hint", "_input_hint")
    text = templates.training_text(*[F.col(part) for part in parts])
    return whole.select("recipe", *key, text.alias("text"))


def training_sets(
    df: DataFrame, recipes: Sequence[Recipe], key: Sequence[str], complete: bool = False
) -> DataFrame:
    """:func:`fan_out` with an exact split inside every recipe."""
    texts = fan_out(df, recipes, key, complete)
    return split_exact_by(texts, "recipe", len(recipes), key, SPLIT_SEED, TEST_SHARE)


# --- incremental runs -----------------------------------------------------


def not_done(df: DataFrame, manifest: DataFrame, *key: str) -> DataFrame:
    """Rows whose key is not in the manifest of earlier runs."""
    return df.join(manifest.select(*key), list(key), "left_anti")


def check_recipe(df: DataFrame, recipe: Recipe, key: Sequence[str]) -> None:
    """Fail if a recipe cannot be planned over its source, before any other one is held up by it."""
    require_columns(df, *recipe.columns, *key)
    training_texts(df, recipe, key)


def run_recipes(
    spark: SparkSession,
    library: Library,
    recipes: Sequence[Recipe],
    key: Sequence[str],
    out: str,
    done: Iterable[str] = (),
    schemas: Mapping[str, T.StructType] | None = None,
    complete: bool = False,
    even_files: bool = False,
) -> dict[str, str]:
    """Write the training sets of all recipes that are not done, source by source.

    Gives ``ok`` or the reason of failure per recipe.  A recipe that its source
    cannot serve is left out and the others of the source go on; if the job
    itself fails, each of them is tried alone.  Each source has the folder
    ``<id>/config=<name>`` (``config=default`` without one) below ``out``, with
    a folder for each recipe in it, which a repeated run replaces whole once
    its job has ended well; until then the last one stays.
    ``schemas`` has the declared schema of data sets by id: no file is then
    read to guess it.  ``complete``: no input or output is NULL, see
    :func:`training_texts`.  ``even_files``: see :func:`write_parts`.
    """
    finished = set(done)
    pending = sorted((r for r in recipes if r.name not in finished), key=lambda r: (r.dataset_id, r.load_config or ""))
    outcome: dict[str, str] = {}
    for (dataset_id, config), group in groupby(pending, key=lambda r: r.source):
        members = list(group)
        folder = f"{out.rstrip('/')}/{dataset_id}/config={config or 'default'}"
        try:
            source = scan(spark, library, dataset_id, config, schema=(schemas or {}).get(dataset_id))
        except FAILURES as error:
            outcome |= {r.name: reason(error) for r in members}
            continue
        good = []
        for recipe in members:
            try:
                check_recipe(source, recipe, key)
                good.append(recipe)
            except FAILURES as error:
                outcome[recipe.name] = reason(error)
        outcome |= _write_together(source, good, key, folder, complete, even_files)
    return outcome


def finished_recipes(spark: SparkSession, out: str) -> list[str]:
    """The recipes that earlier runs have recorded as done below ``out``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{out.rstrip('/')}/{MANIFEST}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return []
    table = spark.read.schema("recipe string").parquet(folder.toString())
    return [row.recipe for row in table.distinct().collect()]  # as many as there are recipe files


def record_finished(spark: SparkSession, out: str, outcome: Mapping[str, str]) -> None:
    """Add the recipes that went well to the manifest of ``out``."""
    names = [(name,) for name, result in outcome.items() if result == "ok"]
    if names:
        spark.createDataFrame(names, "recipe string").coalesce(1).write.mode("append").parquet(
            f"{out.rstrip('/')}/{MANIFEST}"
        )


def _write_together(
    source: DataFrame,
    recipes: Sequence[Recipe],
    key: Sequence[str],
    folder: str,
    complete: bool = False,
    even_files: bool = False,
) -> dict[str, str]:
    """Write recipes in one job; if it fails, each by itself."""
    if not recipes:
        return {}
    try:
        made = training_sets(source, recipes, key, complete)
        write_parts(made, folder, "recipe", [r.name for r in recipes], even_files)
        return {r.name: "ok" for r in recipes}
    except FAILURES as error:
        if len(recipes) == 1:
            return {recipes[0].name: reason(error)}
    outcome: dict[str, str] = {}
    for recipe in recipes:
        outcome |= _write_together(source, [recipe], key, folder, complete, even_files)
    return outcome
