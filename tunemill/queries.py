"""Every operator as a query over the test tables; see ``oracle.py`` for the SQL.

A query takes a session and the folder of the tables and returns a lazy
DataFrame over whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill.functions import templates
from tunemill.functions.extract import (
    assistant_part,
    assistant_part_or_rest,
    cut_at_stop,
    user_part,
)
from tunemill.functions.lines import first_line, normalize_lines, words
from tunemill.functions.values import as_text, label_text, size_allowed, size_bytes
from tunemill.operators.bigrams import bigram_perplexity, fit_bigrams
from tunemill.operators.filters import filter_equals
from tunemill.operators.logs import latest_version, time_to_next
from tunemill.operators.packing import pack, truncate
from tunemill.operators.routing import (
    choose_scored,
    fit_unigrams,
    perplexity,
    unigram_perplexity,
)
from tunemill.operators.rows import map_rows, map_rows_apart
from tunemill.operators.sampling import (
    every_kth,
    first_rows,
    split_counts,
    split_exact,
    split_hash,
    take_hashed,
)
from tunemill.operators.scoring import compare_variants, exact_match_score
from tunemill.operators.turns import chat_text, question_answer_pairs, with_neighbours
from tunemill.operators.voting import vote_consensus, vote_counts, vote_ranking
from tunemill.plans.recipe import Recipe
from tunemill.plans.training import fan_out, not_done, training_set
from tunemill.session import work_folder
from tunemill.sources.catalog import groups_within
from tunemill.sources.datasets import Library, scan
from tunemill.sources.ingest import BAD, parse_json
from tunemill.sources.manifest import Manifest
from tunemill.streaming.merged import Merging, compact, merged, stream_merged, versions, votes
from tunemill.streaming.render import read_stream

Query = Callable[[SparkSession, str], DataFrame]

SEED = 42
HINT = "Is the following text of high or of low quality?"
CONTEXT_HINT = "Answer with the help of the context."
LABEL_NAMES = {1: "high"}
EXPERTS = ("de", "en", "es", "fr")
COEFS = {"de": 1.0, "en": 1.25, "es": 0.9, "fr": 1.0}
SAMPLE_ROWS = 100
MAX_TOKENS = 128
CHAT_PART_TURNS = 1_000
BLOCK = 256
SIZE_LIMIT = 120_000
WINDOW_CHARS = 4_000
RECIPES = (
    Recipe("text-de", "documents", "text", filter_field_name="lang", filter_field_value="de"),
    Recipe("text-en", "documents", "text", filter_field_name="lang", filter_field_value="en"),
    Recipe("text-fr", "documents", "text", filter_field_name="lang", filter_field_value="fr"),
    Recipe(
        "source-en",
        "documents",
        "text",
        output_field_name="source",
        input_hint="Where is this from?",
        filter_field_name="lang",
        filter_field_value="en",
    ),
    Recipe(
        "source-es",
        "documents",
        "text",
        output_field_name="source",
        filter_field_name="lang",
        filter_field_value="es",
        output_field_values_to_texts={"src0": "books", "src1": "news"},
    ),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan(spark, Library(sf_dir, suffix=".parquet"), name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return question_answer_pairs(table(spark, sf_dir, "conversations"))


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the turn before them."""
    turns = with_neighbours(table(spark, sf_dir, "conversations"))
    return turns.filter(F.col("role") == "user").withColumnRenamed("text", "question")


def _prompt(template: Callable[[Column], Column]) -> Query:
    """A prompt for each user turn."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        asked = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
        return asked.select("conv_id", "turn", template(F.col("text")).alias("prompt"))

    return run


def _prompt_in_context(template: Callable[[Column, Column], Column]) -> Query:
    """A prompt for each user turn, with the turn before as its context."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = template(F.col("question"), F.coalesce("prev_text", F.lit("")))
        return _asked(spark, sf_dir).select("conv_id", "turn", made.alias("prompt"))

    return run


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the text of their quality label."""
    labels = table(spark, sf_dir, "labels")
    named = labels.select(
        "doc_id",
        label_text(as_text(F.col("quality"), labels.schema["quality"].dataType), LABEL_NAMES).alias("label"),
    )
    return _documents(spark, sf_dir).select("doc_id", "text").join(named, "doc_id")


# --- scans and filters ----------------------------------------------------


def scan_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )
    return scan(spark, Library(sf_dir, suffix=".parquet"), "documents", schema=schema)


def split_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(_documents(spark, sf_dir).select("doc_id", "text"), 10, "doc_id")


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    torn = F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)")).otherwise(
        F.col("props")
    )
    raw = events.select("event_id", torn.alias("raw"))
    parsed = parse_json(raw, "raw", T.StructType([T.StructField("k", T.LongType())]))
    return parsed.select("event_id", "k", F.col(BAD).alias("rejected"))


def incremental_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = not_done(_documents(spark, sf_dir), table(spark, sf_dir, "labels"), "doc_id")
    return pending.select("doc_id", "lang", "source", "n_chars")


def incremental_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``incremental_skip``, with the labels' keys in a manifest."""
    manifest = Manifest(spark, f"{work_folder(spark)}/manifest-{uuid.uuid4().hex}", ["doc_id"])
    manifest.record(table(spark, sf_dir, "labels"))
    return manifest.not_done(_documents(spark, sf_dir)).select("doc_id", "lang", "source", "n_chars")


def recipe_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fan_out(_documents(spark, sf_dir), RECIPES, ["doc_id"])


def split_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    divided = split_exact(_documents(spark, sf_dir).select("doc_id", "lang"), ["doc_id"], SEED)
    return split_counts(divided, "split", "lang")


def filter_equals_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_equals(_documents(spark, sf_dir), "lang", "de").select("doc_id", "lang", "text")


def filter_equals_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_equals(table(spark, sf_dir, "labels"), "quality", "0")


def systematic_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return every_kth(_documents(spark, sf_dir), 3).select("doc_id", "lang", "text")


def slice_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions 150 to 649 of the scan; an index of the files is kept in the work folder."""
    library = Library(sf_dir, suffix=".parquet", index=f"{work_folder(spark)}/positions-{uuid.uuid4().hex}")
    return scan(spark, library, "documents", split="train[150:650]").select("doc_id", "lang", "text")


def systematic_sample_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document of a copy in JSON lines, whose reader does not number its rows."""
    folder = f"{work_folder(spark)}/lines-{uuid.uuid4().hex}"
    docs = _documents(spark, sf_dir).select("doc_id", "lang", "text")
    # One task writes a range of ids to one file, in the order of the ranges; there are more of them the more there is to read.
    ranges = max(4, 2 * docs.rdd.getNumPartitions())
    docs.repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id").write.json(folder)
    return every_kth(spark.read.schema(docs.schema).json(folder), 3)


def size_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups_within(_documents(spark, sf_dir), "source", "n_chars", SIZE_LIMIT)


# --- text functions -------------------------------------------------------


def label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    quality = as_text(F.col("quality"), labels.schema["quality"].dataType)
    return labels.select("doc_id", label_text(quality, LABEL_NAMES).alias("label"))


def line_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", normalize_lines(F.col("text")).alias("text"))


def render_pretrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select(
        "doc_id", templates.pretrain_text(F.col("text")).alias("text")
    )


def render_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = templates.qa_text(F.col("question"), F.col("answer"))
    return _pairs(spark, sf_dir).select("conv_id", "turn", text.alias("text"))


def render_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = templates.hint_text(HINT, F.col("text"), F.col("label"))
    return _labelled(spark, sf_dir).select("doc_id", text.alias("text"))


def _pairs_in_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).withColumn("context", F.coalesce("prev_text", F.lit("")))


def render_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = templates.context_text(F.col("context"), F.col("question"), F.col("answer"))
    return _pairs_in_context(spark, sf_dir).select("conv_id", "turn", text.alias("text"))


def render_context_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = templates.context_hint_text(
        CONTEXT_HINT, F.col("context"), F.col("question"), F.col("answer")
    )
    return _pairs_in_context(spark, sf_dir).select("conv_id", "turn", text.alias("text"))


def render_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("answer"))
    lang = F.col("lang")
    text = templates.training_text(
        F.col("text"),
        F.col("answer"),
        F.when(lang.isin("en", "de"), F.col("source")),
        F.when(lang.isin("en", "es"), CONTEXT_HINT),
        F.when(lang.isin("en", "es"), HINT),
    )
    return docs.join(labels, "doc_id", "left").select("doc_id", text.alias("text"))


def prompt_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _asked(spark, sf_dir)
    prompt = templates.evaluation_prompt(
        F.col("question"),
        F.when(F.col("prev_role") == "assistant", F.col("prev_text")),
        F.when(F.col("prev_role") == "system", F.col("prev_text")),
        F.when(F.col("conv_id") % 2 == 0, CONTEXT_HINT),
    )
    return asked.select("conv_id", "turn", prompt.alias("prompt"))


def prompt_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return items.select("item_id", templates.translation_prompt(F.col("text")).alias("prompt"))


def chat_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_text(table(spark, sf_dir, "conversations"), part_turns=CHAT_PART_TURNS)


def chat_format_inst(spark: SparkSession, sf_dir: str) -> DataFrame:
    system = F.when(F.col("prev_role") == "system", F.col("prev_text")).otherwise("")
    prompt = templates.inst_chat(system, F.col("question"))
    return _asked(spark, sf_dir).select("conv_id", "turn", prompt.alias("prompt"))


def stop_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    running_on = F.concat("answer", F.lit("\nUSER: "), "question", F.lit("\nASSISTANT: \n"), "answer")
    cut = cut_at_stop(F.col("output"), templates.STOPS["user_assistant"])
    return (
        _pairs(spark, sf_dir)
        .withColumn("output", running_on)
        .select("conv_id", "turn", cut.alias("output"))
    )


def first_line_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", first_line(F.col("text")).alias("line"))


def parse_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    chars, kind = F.col("n_chars"), F.col("doc_id") % 6
    written = (
        F.when(kind == 0, F.concat(chars, F.lit("KB")))
        .when(kind == 1, F.concat(F.expr("n_chars div 10"), F.lit("."), chars % 10, F.lit("MB")))
        .when(kind == 2, F.concat(F.expr("n_chars div 1000"), F.lit("."), chars % 10, F.lit("GB")))
        .when(kind == 3, F.concat(chars % 7, F.lit("."), chars % 100, F.lit("TB")))
        .when(kind == 4, chars.cast("string"))
        .otherwise("Unknown")
    )
    size = F.col("size")
    return (
        _documents(spark, sf_dir)
        .select("doc_id", written.alias("size"))
        .select(
            "doc_id",
            "size",
            size_bytes(size).alias("size_bytes"),
            size_allowed(size).alias("loadable"),
            size_allowed(size, strict_units=False).alias("fits"),
        )
    )


# --- splits and lengths ---------------------------------------------------


def split_exact_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_exact(_documents(spark, sf_dir).select("doc_id"), ["doc_id"], SEED)


def split_hash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_hash(_documents(spark, sf_dir).select("doc_id"), ["doc_id"], SEED)


def eval_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return take_hashed(_documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"], SAMPLE_ROWS, SEED)


def truncate_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _documents(spark, sf_dir)
        .select("doc_id", truncate(words(F.col("text")), MAX_TOKENS).alias("tokens"))
        .select(
            "doc_id",
            F.size("tokens").cast("bigint").alias("n_tokens"),
            F.array_join("tokens", " ").alias("text"),
        )
    )


def pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = pack(_documents(spark, sf_dir), ["doc_id"], words(F.col("text")), BLOCK, SEED)
    return blocks.select("block_no", "n_tokens", "n_samples", F.array_join("tokens", " ").alias("text"))


# --- scores, votes, routes ------------------------------------------------


def _rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = templates.qa_text(F.col("question"), F.col("answer"))
    return _pairs(spark, sf_dir).withColumn("rendered", text)


def _extracted(part: Callable[[Column], Column]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rendered(spark, sf_dir).select("conv_id", "turn", part(F.col("rendered")).alias("part"))

    return run


def _outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-ins for model outputs, with and without tags, whole and cut short.

    The base model gives the first line of the answer, the tuned one all of it.
    """
    prompt = templates.plain_prompt(F.col("question"))
    said = F.when(F.col("variant") == "base", first_line(F.col("answer"))).otherwise(F.col("answer"))
    form = F.col("turn") % 3
    output = (
        F.when(form == 0, F.concat(prompt, said, F.lit("\n<|im_end|>")))
        .when(form == 1, F.concat(prompt, said))
        .otherwise(said)
    )
    pairs = _pairs(spark, sf_dir).withColumn("variant", F.explode(F.array(F.lit("base"), F.lit("tuned"))))
    return pairs.select(
        "conv_id",
        "turn",
        "variant",
        (F.col("conv_id") % 4).alias("task"),
        output.alias("output"),
        F.col("answer").alias("expected"),
    )


def extract_robust(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = assistant_part_or_rest(F.col("output"))
    return _outputs(spark, sf_dir).select("conv_id", "turn", "variant", answer.alias("part"))


def exact_match_score_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_match_score(_outputs(spark, sf_dir), "variant")


def score_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_variants(_outputs(spark, sf_dir), "task")


def _votes(
    count: Callable[[DataFrame, str, str, str], DataFrame],
) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return count(table(spark, sf_dir, "events"), "user_id", "event_type", "event_id")

    return run


def perplexity_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = table(spark, sf_dir, "events").select("user_id", (F.col("value") / -100).alias("logprob"))
    return perplexity(scored, "user_id").select("user_id", F.round("ppl", 4).alias("ppl"))


def _unigram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    tokens = words(F.col("text"))
    model = fit_unigrams(docs, F.col("lang"), tokens, EXPERTS)
    return unigram_perplexity(docs, "doc_id", tokens, model, EXPERTS)


def perplexity_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _unigram_scores(spark, sf_dir).select("doc_id", F.inline("scores"))
    return scores.select("doc_id", "expert", F.round("ppl", 4).alias("ppl"))


def expert_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = choose_scored(_unigram_scores(spark, sf_dir), "doc_id", COEFS)
    return chosen.select("doc_id", "expert", F.round("score", 4).alias("score"))


def _bigram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    tokens = words(F.col("text"))
    folder = f"{work_folder(spark)}/bigrams-{uuid.uuid4().hex}"
    terms = fit_bigrams(docs, F.col("lang"), tokens, EXPERTS, folder)
    return bigram_perplexity(docs, "doc_id", tokens, terms, EXPERTS)


def perplexity_bigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``perplexity_unigram``, each word given the one before it."""
    scores = _bigram_scores(spark, sf_dir).select("doc_id", F.inline("scores"))
    return scores.select("doc_id", "expert", F.round("ppl", 4).alias("ppl"))


def expert_route_bigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = choose_scored(_bigram_scores(spark, sf_dir), "doc_id", COEFS)
    return chosen.select("doc_id", "expert", F.round("score", 4).alias("score"))


def _named_versions(orders: DataFrame) -> DataFrame:
    name = F.when(F.col("o_orderstatus") == "F", "runs").otherwise(
        F.concat(F.lit("checkpoint-"), F.col("o_orderkey") % 1009)
    )
    return orders.select("o_custkey", name.alias("name"))


def latest_version_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_version(_named_versions(table(spark, sf_dir, "orders")), "o_custkey", "name")


def _streamed(
    spark: SparkSession, sf_dir: str, name: str, rows: Callable[[DataFrame], DataFrame], merging: Merging
) -> DataFrame:
    """A table that arrives as a stream of files, merged to one aggregate."""
    folder = f"{work_folder(spark)}/stream-{uuid.uuid4().hex}"
    # A pattern: the path of a stream must else be a folder, and a table may be one file.
    path = Library(sf_dir, suffix=".parquet").path(f"[{name[0]}]{name[1:]}")
    source = read_stream(spark, path, table(spark, sf_dir, name).schema)
    stream_merged(rows(source), merging, f"{folder}/out", f"{folder}/state").awaitTermination()
    compact(spark, merging, f"{folder}/out")
    return merged(spark, merging, f"{folder}/out")


def vote_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    merging = votes("user_id", "event_type", "event_id")
    return _streamed(spark, sf_dir, "events", lambda rows: rows, merging)


def latest_version_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, "orders", _named_versions, versions("o_custkey", "name"))


def elapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return time_to_next(events, "user_id", "ts", "event_id").select("event_id", "user_id", "elapsed_us")


def _some_null(events: DataFrame, name: str, every: int) -> DataFrame:
    """Events in which a part of the users has lost its id."""
    return events.withColumn(name, F.when(F.col(name) % every != 0, F.col(name)))


def vote_ranking_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _some_null(table(spark, sf_dir, "events"), "user_id", 5)
    return vote_ranking(events, "user_id", "event_type", "event_id")


def elapsed_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _some_null(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "user_id", 3)
    return time_to_next(events, "user_id", "ts", "event_id").select("event_id", "user_id", "elapsed_us")


def route_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    blanked = docs.withColumn("text", F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.col("text")))
    tokens = words(F.col("text"))
    model = fit_unigrams(blanked, F.col("lang"), tokens, EXPERTS)
    chosen = choose_scored(unigram_perplexity(blanked, "doc_id", tokens, model, EXPERTS), "doc_id", COEFS)
    return chosen.select("doc_id", "expert", F.round("score", 4).alias("score"))


def recipe_fanout_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recipes that filter by different columns, or not at all."""
    recipes = [
        Recipe("mixed-en", "documents", "text", filter_field_name="lang", filter_field_value="en"),
        Recipe("mixed-src", "documents", "text", filter_field_name="source", filter_field_value="src3"),
        Recipe("mixed-all", "documents", "text"),
    ]
    return fan_out(_documents(spark, sf_dir), recipes, ["doc_id"])


def map_rows_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "lang", "text")
    return map_rows(docs, lambda part: part.assign(lang=part["lang"].str.upper()))


def map_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_rows(_documents(spark, sf_dir).select("doc_id", "lang", "text"), lambda part: part)


def _lower_within(part: pd.DataFrame) -> pd.DataFrame:
    """A function with a limit: it refuses texts that are longer than its window."""
    if (part["text"].str.len() > WINDOW_CHARS).any():
        raise ValueError("text longer than the window")
    return part.assign(n_lower=part["text"].str.count("[a-z]"))[["doc_id", "n_lower"]]


def map_rows_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    made = map_rows_apart(docs, _lower_within, "doc_id long, n_lower long")
    return made.select(F.coalesce("doc_id", "failed.doc_id").alias("doc_id"), "n_lower", "error")


# --- whole jobs -----------------------------------------------------------


def training_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter, render and split one data set, and count what came out."""
    recipe = Recipe("text-en", "documents", "text", filter_field_name="lang", filter_field_value="en")
    made = training_set(_documents(spark, sf_dir), recipe, ["doc_id"])
    return made.groupBy("split").agg(
        F.count("*").alias("n_rows"), F.sum(F.length("text")).alias("n_chars")
    )


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classify texts: label names, question-answer texts, exact split."""
    recipe = Recipe(
        "quality",
        "documents",
        "text",
        output_field_name="quality",
        output_field_values_to_texts=LABEL_NAMES,
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    joined = _documents(spark, sf_dir).select("doc_id", "text").join(labels, "doc_id")
    return training_set(joined, recipe, ["doc_id"])


def queries() -> dict[str, Query]:
    return {
        "training_summary": training_summary,
        "training_labels": training_labels,
        "scan_dataset": scan_dataset,
        "split_slice": split_slice,
        "ingest_quarantine": ingest_quarantine,
        "incremental_skip": incremental_skip,
        "incremental_filtered": incremental_filtered,
        "recipe_fanout": recipe_fanout,
        "recipe_fanout_mixed": recipe_fanout_mixed,
        "vote_ranking_nulls": vote_ranking_nulls,
        "elapsed_nulls": elapsed_nulls,
        "route_blank": route_blank,
        "map_rows_changed": map_rows_changed,
        "split_counts": split_counts_query,
        "filter_equals": filter_equals_text,
        "filter_equals_int": filter_equals_int,
        "systematic_sample": systematic_sample,
        "systematic_sample_json": systematic_sample_json,
        "slice_range": slice_range,
        "size_threshold": size_threshold,
        "label_map": label_map,
        "line_normalize": line_normalize,
        "render_pretrain": render_pretrain,
        "render_qa": render_qa,
        "render_hint": render_hint,
        "render_context": render_context,
        "render_context_hint": render_context_hint,
        "render_dispatch": render_dispatch,
        "prompt_plain": _prompt(templates.plain_prompt),
        "prompt_hint": _prompt(lambda q: templates.hint_prompt(HINT, q)),
        "prompt_context": _prompt_in_context(templates.context_prompt),
        "prompt_hint_context": _prompt_in_context(lambda q, c: templates.context_hint_prompt(CONTEXT_HINT, q, c)),
        "prompt_dispatch": prompt_dispatch,
        "prompt_expert": _prompt(templates.expert_prompt),
        "prompt_expert_context": _prompt_in_context(
            lambda q, c: templates.expert_context_prompt(CONTEXT_HINT, q, c)
        ),
        "prompt_translate": prompt_translate,
        "chat_render": chat_render,
        "chat_format_inst": chat_format_inst,
        "chat_format_user_assistant": _prompt(templates.user_assistant_chat),
        "chat_format_ja": _prompt(templates.japanese_chat),
        "stop_truncate": stop_truncate,
        "first_line": first_line_query,
        "parse_size": parse_size,
        "split_exact": split_exact_query,
        "split_hash": split_hash_query,
        "eval_cap": eval_cap,
        "truncate_tokens": truncate_tokens,
        "pack_sequences": pack_sequences,
        "extract_user": _extracted(user_part),
        "extract_assistant": _extracted(assistant_part),
        "extract_robust": extract_robust,
        "exact_match_score": exact_match_score_query,
        "score_compare": score_compare,
        "vote_counts": _votes(vote_counts),
        "vote_consensus": _votes(vote_consensus),
        "vote_ranking": _votes(vote_ranking),
        "perplexity_tokens": perplexity_tokens,
        "perplexity_unigram": perplexity_unigram,
        "expert_route": expert_route,
        "perplexity_bigram": perplexity_bigram,
        "expert_route_bigram": expert_route_bigram,
        "vote_counts_stream": vote_counts_stream,
        "latest_version_stream": latest_version_stream,
        "latest_version": latest_version_query,
        "elapsed": elapsed,
        "map_rows": map_rows_query,
        "map_rows_isolated": map_rows_isolated,
    }
