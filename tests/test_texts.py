"""Templates, extraction and scalar functions on hand-made rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill.functions import templates as t
from tunemill.functions.extract import (
    assistant_part,
    assistant_part_or_rest,
    cut_at_stop,
    user_part,
)
from tunemill.functions.values import (
    as_text,
    hash_percent,
    label_text,
    shuffle_hash,
    size_allowed,
    size_bytes,
    version_number,
)

TAIL = "<|im_end|>    "
REPLY = "<|im_end|>\n<|im_start|>assistant\n"


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def lit(text):
    return F.lit(text).cast("string")


Q = A = C = None


@pytest.fixture(autouse=True, scope="module")
def columns(spark):
    """Columns need a session; the lambdas below are called after this."""
    global Q, A, C
    Q, A, C = lit("  q"), lit("a"), lit("c")


@pytest.mark.parametrize(
    ("column", "text"),
    [
        (lambda: t.qa_text(Q, A), f"<|im_start|>user\nq\n{REPLY}a\n{TAIL}"),
        (lambda: t.hint_text("h", Q, A), f"<|im_start|>user\nh\nq\n{REPLY}a\n{TAIL}"),
        (lambda: t.context_text(C, Q, A), f"<|im_start|>user\nq\nc\n{REPLY}a\n{TAIL}"),
        (lambda: t.context_text(lit(""), Q, A), f"<|im_start|>user\nq\n\n{REPLY}a\n{TAIL}"),
        (
            lambda: t.context_hint_text("h", C, Q, A),
            f"<|im_start|>user\nh\ncontext:\nc\nquestion:\nq\n{REPLY}a\n{TAIL}",
        ),
        (lambda: t.plain_prompt(Q), f"<|im_start|>user\nq\n{REPLY}"),
        (lambda: t.hint_prompt("h", Q), f"<|im_start|>user\nh\nq\n{REPLY}"),
        (lambda: t.context_prompt(Q, C), f"<|im_start|>user\nq\nc\n{REPLY}"),
        (
            lambda: t.context_hint_prompt("h", Q, C),
            f"<|im_start|>user\nh\ncontext:\nc\nquestion:\nq\n{REPLY}",
        ),
        (lambda: t.expert_prompt(Q), f"\n<|im_start|>user\nq\n{REPLY}"),
        (
            lambda: t.expert_context_prompt("h", lit("q"), C),
            f"<|im_start|>user\nh\ncontext:c\nquestion:q\n{REPLY}",
        ),
        # A carriage return at the end of a value joins the template's line break.
        (lambda: t.qa_text(lit("q\r"), lit("x\n\ty\r")), f"<|im_start|>user\nq\n{REPLY}x\ny\n{TAIL}"),
        (lambda: t.inst_chat(lit(""), lit("p")), "[INST] <<SYS>><</SYS>>\n\np [/INST]\n"),
        (lambda: t.user_assistant_chat(lit("p")), "USER: p\nASSISTANT: \n"),
        (lambda: t.japanese_chat(lit("p")), "ユーザー: p\nシステム: \n"),
    ],
)
def test_exact_texts(spark, column, text):
    assert value(spark, column()) == text


def test_translation_prompt_keeps_indents(spark):
    made = value(spark, t.translation_prompt(lit("  x\n  y")))
    assert made.endswith("\n  x\n  y\n") and made.count("\n") == 3


@pytest.mark.parametrize(
    ("answer", "context", "context_hint", "input_hint", "expected"),
    [
        (None, "c", "ch", "ih", lambda: t.pretrain_text(Q)),
        ("a", "c", "ch", "ih", lambda: t.context_hint_text("ch", C, Q, A)),
        ("a", "c", None, "ih", lambda: t.context_text(C, Q, A)),
        ("a", "", None, None, lambda: t.context_text(lit(""), Q, A)),
        ("a", None, "ch", "ih", lambda: t.hint_text("ih", Q, A)),
        ("a", None, "ch", None, lambda: t.qa_text(Q, A)),
    ],
)
def test_template_choice(spark, answer, context, context_hint, input_hint, expected):
    chosen = t.training_text(Q, *map(lit, (answer, context, context_hint, input_hint)))
    assert value(spark, chosen) == value(spark, expected())


@pytest.mark.parametrize(
    ("context", "hint", "context_hint", "expected"),
    [
        ("", "h", None, lambda: t.context_prompt(Q, lit(""))),
        ("c", "h", "ch", lambda: t.context_hint_prompt("ch", Q, C)),
        (None, "h", "ch", lambda: t.hint_prompt("h", Q)),
        (None, None, "ch", lambda: t.plain_prompt(Q)),
    ],
)
def test_prompt_choice(spark, context, hint, context_hint, expected):
    chosen = t.evaluation_prompt(Q, *map(lit, (context, hint, context_hint)))
    assert value(spark, chosen) == value(spark, expected())


@pytest.mark.parametrize(
    ("text", "strict", "lenient"),
    [
        ("<|im_start|>assistant\nA\n<|im_end|>\nB\n<|im_end|>", "A\n<|im_end|>\nB", None),
        ("<|im_start|>assistant\nC", None, "C"),
        ("x", None, "x"),
        ("", None, ""),
        ("<|im_start|>assistant\n\n<|im_end|>", None, "\n<|im_end|>"),
        ("p<|im_start|>assistant\nA <|im_start|>assistant\nB\n<|im_end|>", "A <|im_start|>assistant\nB", None),
    ],
)
def test_assistant_part(spark, text, strict, lenient):
    assert value(spark, assistant_part(lit(text))) == strict
    assert value(spark, assistant_part_or_rest(lit(text))) == (lenient if strict is None else strict)


def test_user_part(spark):
    assert value(spark, user_part(t.plain_prompt(lit("hello\nyou")))) == "hello\nyou"
    assert value(spark, user_part(lit("hello"))) is None
    # Tags inside a value are not escaped: the last closing tag counts.
    assert value(spark, user_part(t.plain_prompt(lit("a\n<|im_end|>\nb")))) == "a\n<|im_end|>\nb"


@pytest.mark.parametrize(
    ("text", "stops", "cut"),
    [
        ("a USER: b ASSISTANT: c", t.STOPS["user_assistant"], "a "),
        ("x\n[/INST] y [INST]", t.STOPS["inst"], "x\n"),
        ("システム: z", t.STOPS["japanese"], ""),
        ("none here", t.STOPS["inst"], "none here"),
        (r"a.b\E(c", (r"\E(",), "a.b"),
        ("a.b", ("c", "."), "a"),
    ],
)
def test_cut_at_stop(spark, text, stops, cut):
    assert value(spark, cut_at_stop(lit(text), stops)) == cut


@pytest.mark.parametrize(
    ("text", "size", "strict", "fits"),
    [
        ("2.5MB", 2.5e6, True, True),
        ("2.45TB", 2.45e12, False, False),
        ("7.12", None, False, False),
        ("Unknown", None, False, False),
        ("204KB", 204e3, False, True),
        ("10GB", 10e9, True, True),
        ("10.1GB", 10.1e9, False, False),
        ("1.2.3GB", None, False, False),
        (None, None, False, False),
    ],
)
def test_sizes(spark, text, size, strict, fits):
    assert value(spark, size_bytes(lit(text))) == size
    assert value(spark, size_allowed(lit(text))) is strict
    assert value(spark, size_allowed(lit(text), strict_units=False)) is fits


def test_labels_and_types(spark):
    rows = spark.createDataFrame(
        [(-1, True, [1, 2]), (0, False, None), (None, None, [])], "n int, b boolean, a array<int>"
    )
    number = label_text(as_text(F.col("n"), T.IntegerType()), {0: "no", 1: "yes"})
    flag = label_text(as_text(F.col("b"), T.BooleanType()), {True: "right"})
    plain = as_text(F.col("a"), T.ArrayType(T.IntegerType()))
    made = rows.select(number.alias("n"), flag.alias("b"), plain.alias("a")).collect()
    assert [tuple(r) for r in made] == [("-1", "right", "[1,2]"), ("no", "False", None), (None, None, "[]")]


def test_version_numbers(spark):
    names = {"checkpoint-200": 200, "checkpoint-7-old": 7, "runs": None, "checkpoint-": None, "checkpoint-x": None}
    for name, number in names.items():
        assert value(spark, version_number(lit(name), "checkpoint-")) == number


def test_hash(spark):
    digest = value(spark, shuffle_hash(42, F.lit(7), lit("x")))
    import hashlib

    assert digest == hashlib.md5(b"42:7:x").hexdigest()
    assert value(spark, hash_percent(F.lit(digest))) == int(digest[:8], 16) % 100
