"""Packing, turns, votes, routes and logs against plain Python."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tunemill.functions.lines import words
from tunemill.operators.logs import latest_version, time_to_next, with_elapsed
from tunemill.operators.ordering import running_total
from tunemill.operators.packing import END_MARK, pack, truncate
from tunemill.operators.routing import (
    choose_expert,
    choose_scored,
    fit_unigrams,
    perplexity,
    unigram_perplexity,
)
from tunemill.operators.rows import map_rows
from tunemill.operators.scoring import compare_variants, exact_match_score
from tunemill.operators.turns import chat_text, question_answer_pairs, with_neighbours
from tunemill.operators.voting import vote_consensus, vote_counts, vote_ranking


def test_running_total_over_levels(spark):
    chance = random.Random(3)
    rows = [(g, chance.randrange(5), chance.randrange(4), i, chance.randrange(9)) for i in range(400) for g in "ab"]
    df = spark.createDataFrame(rows, "g string, big int, small int, i int, v long")
    made = running_total(
        df, F.col("v"), ["big", "small"], [F.col("i")], "upto", group=["g"], descending=["big"]
    ).collect()
    assert len(made) == len(rows)
    for group in "ab":
        total = 0
        for row in sorted((r for r in made if r.g == group), key=lambda r: (-r.big, r.small, r.i)):
            total += row.v
            assert row.upto == total


@pytest.mark.parametrize("block", [1, 7, 64, 5000])
def test_pack_equals_one_long_list(spark, block):
    chance = random.Random(block)
    samples = {f"k{i}": [f"w{chance.randrange(50)}" for _ in range(chance.choice([0, 1, 5, 300]))] for i in range(60)}
    df = spark.createDataFrame([(k, " ".join(v)) for k, v in samples.items()], "key string, text string")
    made = pack(df, ["key"], words(F.col("text")), block).orderBy("block_no").collect()
    ordered = sorted(samples, key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest())
    stream = [(token, k) for k in ordered for token in [*samples[k], END_MARK]]
    blocks = [stream[i : i + block] for i in range(0, len(stream), block)]
    assert [r.block_no for r in made] == list(range(len(blocks)))
    assert [r.tokens for r in made] == [[t for t, _ in b] for b in blocks]
    assert [r.n_tokens for r in made] == [len(b) for b in blocks]
    assert [r.n_samples for r in made] == [len({k for _, k in b}) for b in blocks]


def test_pack_token_ids(spark):
    df = spark.createDataFrame([(1, [5, 6, 7]), (2, [8])], "id long, ids array<int>")
    made = pack(df, ["id"], F.col("ids"), 4, end_mark=F.lit(0)).orderBy("block_no").collect()
    assert sorted(len(r.tokens) for r in made) == [2, 4]
    assert sorted(t for r in made for t in r.tokens) == [0, 0, 5, 6, 7, 8]
    with pytest.raises(ValueError):
        pack(df, ["id"], F.col("ids"), 0)


def test_truncate(spark):
    rows = spark.createDataFrame([("a b  c",), ("",), (None,)], "t string")
    cut = rows.select(truncate(words(F.col("t")), 2).alias("t"))
    assert [r.t for r in cut.collect()] == [["a", "b"], [], None]


TURNS = [
    (1, 0, "system", "s"),
    (1, 1, "user", "u1"),
    (1, 2, "assistant", "a1"),
    (1, 3, "user", "u2"),
    (2, 0, "user", "v1"),
    (2, 1, "assistant", "b1"),
]


@pytest.mark.parametrize("part_turns", [1, 2, 3, 1000])
def test_pairs_and_neighbours(spark, part_turns):
    chance = random.Random(part_turns)
    said = list(TURNS)
    for conv in (3, 4):  # conversation 3 is long, 4 lacks some turns
        kept = [n for n in range(60) if conv == 3 or chance.random() < 0.7]
        said += [(conv, n, chance.choice(["user", "assistant"]), f"t{conv}.{n}") for n in kept]
    text = {(c, n): (r, t) for c, n, r, t in said}
    turns = spark.createDataFrame(said, "conv_id long, turn long, role string, text string").repartition(4)
    made = with_neighbours(turns, part_turns).collect()
    assert sorted((r.conv_id, r.turn, r.role, r.text) for r in made) == sorted(said)
    for r in made:
        assert (r.prev_role, r.prev_text) == text.get((r.conv_id, r.turn - 1), (None, None))
        assert (r.next_role, r.next_text) == text.get((r.conv_id, r.turn + 1), (None, None))
    pairs = question_answer_pairs(turns, part_turns).collect()
    assert {(r.conv_id, r.turn): (r.question, r.answer) for r in pairs} == {
        (c, n): (t, text[c, n + 1][1])
        for (c, n), (r, t) in text.items()
        if r == "user" and text.get((c, n + 1), ("",))[0] == "assistant"
    }


@pytest.mark.parametrize("part_turns", [1, 2, 3, 1000])
def test_chat_in_parts(spark, part_turns):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    whole = defaultdict(str)
    for row in chat_text(turns, part_turns).orderBy("conv_id", "part").collect():
        assert row.n_turns <= part_turns
        whole[row.conv_id] += row.text

    def said(conv):
        return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for c, _, r, t in TURNS if c == conv)

    assert whole == {1: said(1) + "<|im_start|>assistant\n", 2: said(2)}


@pytest.mark.parametrize("rank_range", [1, 10, 1_000_000])
def test_votes_with_a_hot_item(spark, rank_range):
    chance = random.Random(5)
    rows = [(chance.choice([1, 1, 1, 2, 3]), f"r{chance.randrange(40)}", pos) for pos in range(600)]
    df = spark.createDataFrame(rows, "item int, response string, pos long").repartition(5)
    votes, first = Counter(), {}
    for item, response, pos in rows:
        votes[item, response] += 1
        first.setdefault((item, response), pos)
    counted = {(r.item, r.response): (r.votes, r.first_pos) for r in vote_counts(df, "item", "response", "pos").collect()}
    assert counted == {k: (votes[k], first[k]) for k in votes}
    ranking = defaultdict(list)
    for key in sorted(votes, key=lambda k: (-votes[k], first[k])):
        ranking[key[0]].append(key[1])
    made = vote_ranking(df, "item", "response", "pos", rank_range).collect()
    assert len(made) == len(votes)
    assert all(ranking[r.item][r.rank - 1] == r.response for r in made)
    best = {r.item: (r.response, r.n_votes) for r in vote_consensus(df, "item", "response", "pos").collect()}
    assert best == {i: (rs[0], sum(v for k, v in votes.items() if k[0] == i)) for i, rs in ranking.items()}


def test_first_seen_wins_ties(spark):
    df = spark.createDataFrame([(1, r, p) for p, r in enumerate("abba")], "item int, response string, pos long")
    assert vote_consensus(df, "item", "response", "pos").first().response == "a"


@pytest.mark.parametrize("head_bytes", [1, 1000, 64 * 2**20])
def test_perplexity_with_frequent_and_rare_words(spark, head_bytes):
    chance = random.Random(9)
    vocabulary = [f"w{min(int(chance.paretovariate(0.7)), 60)}" for _ in range(2000)]
    docs = [(i, chance.choice("ab"), " ".join(chance.sample(vocabulary, 20))) for i in range(30)]
    held_out = [(100, "a", "w1 w1 never-seen w2"), (101, "b", "   ")]
    schema = "id long, expert string, text string"
    tokens = words(F.col("text"))
    model = fit_unigrams(spark.createDataFrame(docs, schema), F.col("expert"), tokens, ["a", "b", "c"])
    texts = spark.createDataFrame([*docs, *held_out], schema)
    scored = unigram_perplexity(texts, "id", tokens, model, ["a", "b", "c"], head_bytes)
    made = scored.select("id", F.inline("scores"))

    counts = {e: Counter() for e in "abc"}
    for _, e, text in docs:
        counts[e].update(text.split())
    size = len({t for c in counts.values() for t in c})
    expected = {}
    for i, _, text in [*docs, held_out[0]]:
        for e, c in counts.items():
            logs = [math.log((c[t] + 1) / (c.total() + size)) for t in text.split()]
            expected[i, e] = math.exp(-sum(logs) / len(logs))
    found = {(r.id, r.expert): r.ppl for r in made.collect()}
    assert found.keys() == expected.keys() | {(101, e) for e in "abc"}
    assert all(math.isclose(found[k], expected[k], rel_tol=1e-9) for k in expected)
    assert all(found[101, e] is None for e in "abc")

    coefs = {"a": 1.5, "c": 0.5}
    chosen = {r.id: (r.expert, r.score) for r in choose_expert(made, "id", coefs).collect()}
    assert chosen[101] == (None, None)
    for i in {i for i, _ in expected}:
        score, expert = min((expected[i, e] * coefs.get(e, 1), e) for e in "abc")
        assert chosen[i][0] == expert and math.isclose(chosen[i][1], score, rel_tol=1e-9)
    assert chosen == {r.id: (r.expert, r.score) for r in choose_scored(scored, "id", coefs).collect()}


def test_route_ties_and_plain_perplexity(spark):
    scores = spark.createDataFrame([(1, "z", 0, 2.0), (1, "a", 1, 2.0)], "id int, expert string, expert_pos int, ppl double")
    assert choose_expert(scores, "id").first().expert == "z"
    logs = spark.createDataFrame([(1, -1.0), (1, -3.0)], "id int, logprob double")
    assert math.isclose(perplexity(logs, "id").first().ppl, math.exp(2))


def test_scores(spark):
    rows = [
        ("base", 0, "<|im_start|>assistant\nA\n<|im_end|>", "A"),
        ("base", 1, "A ", "A"),
        ("tuned", 0, "<|im_start|>assistant\nA", "A"),
        ("tuned", 1, "a", "A"),
        ("tuned", 2, "A", "A"),
    ]
    df = spark.createDataFrame(rows, "variant string, pos int, output string, expected string")
    assert {tuple(r) for r in exact_match_score(df, "variant").collect()} == {("base", 1, 2), ("tuned", 2, 3)}
    assert tuple(compare_variants(df).first()) == (1, 2, 1)


def test_latest_version(spark):
    rows = [(1, "checkpoint-200"), (1, "checkpoint-1000"), (1, "runs"), (2, "runs"), (2, "checkpoint-x")]
    df = spark.createDataFrame(rows, "k int, name string")
    assert {tuple(r) for r in latest_version(df, "k", "name").collect()} == {(1, "checkpoint-1000", 1000), (2, "", -1)}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("bucket_seconds", [60, 3600, 10**9])
def test_time_to_next(spark, kind, bucket_seconds):
    chance = random.Random(1)
    start = datetime(2024, 3, 30, 20)
    rows = [(i, chance.choice([None, 1, 1, 1, 2]), start + timedelta(microseconds=chance.randrange(10**11))) for i in range(300)]
    rows += [(300, 1, rows[0][2]), (301, 1, rows[0][2])]
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin" if kind == "timestamp_ntz" else "UTC")
    try:
        df = spark.createDataFrame([(i, u, str(t)) for i, u, t in rows], "i int, u int, t string")
        df = df.withColumn("t", F.col("t").cast(kind))
        made = {r.i: r.elapsed_us for r in time_to_next(df, "u", "t", "i", bucket_seconds=bucket_seconds).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert made.keys() == {r[0] for r in rows}
    for user in (1, 2):
        own = sorted((t, i) for i, u, t in rows if u == user)
        for (t, i), (later, _) in zip(own, own[1:]):
            assert made[i] == (later - t) / timedelta(microseconds=1)
        assert made[own[-1][1]] is None


def test_elapsed_in_a_row(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS a, timestamp'2024-01-01 00:00:01.5' AS b")
    assert with_elapsed(df, "a", "b").first().elapsed_us == 1_500_000


def test_map_rows(spark):
    df = spark.range(10)
    assert map_rows(df, lambda part: part).count() == 10
    doubled = map_rows(df, lambda part: part.assign(twice=part.id * 2), "id long, twice long")
    assert all(r.twice == 2 * r.id for r in doubled.collect())
