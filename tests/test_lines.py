import random

import pytest
from pyspark.sql import functions as F

from tunemill.functions.lines import (
    BREAKS,
    INDENTS,
    WHITE,
    drop_blank_lines,
    first_line,
    normalize_lines,
    words,
)


def expected_lines(text):
    return "\n".join(line.lstrip() for line in text.splitlines())


def expected_filled(text):
    return expected_lines("\n".join(line for line in text.splitlines() if line.strip()))


def apply(spark, function, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    made = rows.select("i", function(F.col("text")).alias("made"))
    return [r.made for r in made.orderBy("i").collect()]


def random_texts(n=4000):
    chance = random.Random(7)
    alphabet = WHITE + "\r\n\n\n  ab日é​😀"
    return ["".join(chance.choices(alphabet, k=chance.randrange(14))) for _ in range(n)]


def test_the_character_sets_are_complete():
    every = map(chr, range(0x110000))
    assert sorted(WHITE) == [c for c in every if c.isspace()]
    assert all(len(f"a{c}b".splitlines()) == 2 for c in BREAKS)
    assert all(len(f"a{c}b".splitlines()) == 1 for c in INDENTS)


@pytest.mark.parametrize(
    ("text", "lines"),
    [
        ("  a\r\n\tb\x85 c", "a\nb\nc"),
        ("　日本", "日本"),
        ("​a", "​a"),
        ("a\n", "a"),
        ("a\n\n", "a\n"),
        ("a\r\r\n", "a\n"),
        ("a\r\r\n\n", "a\n\n"),
        ("a\n   ", "a\n"),
        ("", ""),
        ("   ", ""),
        ("def f():\n    return 1", "def f():\nreturn 1"),
    ],
)
def test_normalize_examples(spark, text, lines):
    assert expected_lines(text) == lines
    assert apply(spark, normalize_lines, [text]) == [lines]


def test_blank_lines_go(spark):
    texts = ["a\n\n  \nb", "\n\na  ", " \n ", "a\n" * 3 + "\r\n\x85" * 50_000 + "  b"]
    assert apply(spark, drop_blank_lines, texts) == [expected_filled(t) for t in texts]


def test_random_texts(spark):
    texts = random_texts()
    assert apply(spark, normalize_lines, texts) == [expected_lines(t) for t in texts]
    assert apply(spark, drop_blank_lines, texts) == [expected_filled(t) for t in texts]
    assert apply(spark, first_line, texts) == [t.split("\n")[0].lstrip() for t in texts]
    assert apply(spark, words, texts) == [t.split() for t in texts]


def test_null_stays_null(spark):
    for function in (normalize_lines, drop_blank_lines, first_line, words):
        assert apply(spark, function, [None]) == [None]
