"""Training texts, evaluation prompts and chat formats as column expressions.

A template is a concatenation of literals and columns that is normalised
*after* the values are in place: a value that ends in ``\\r`` must merge with
the ``\\n`` that follows it.  Tags found inside a value are not escaped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunemill.functions.lines import drop_blank_lines, strip_indents

# The tags around a turn and what ends a training text.
OPEN_TAG = "<|im_start|>"
CLOSE_TAG = "<|im_end|>"
TRAINING_TAIL = "    "
# Fixed value: the instruction line of a translation request.
TRANSLATE_LINE = (
    "以下の英語を日本語に翻訳してください。翻訳結果のみを簡潔に出力してください。"
    "記号は全角にしてください。"
)

Text = Column | str


def _glue(*parts: Text) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _user_turn(*lines: Text) -> list[Text]:
    body = reduce(lambda done, line: [*done, line, "\n"], lines, [])
    return [f"{OPEN_TAG}user\n", *body, f"{CLOSE_TAG}\n{OPEN_TAG}assistant\n"]


def _training(answer: Text, *lines: Text) -> Column:
    return strip_indents(_glue(*_user_turn(*lines), answer, f"\n{CLOSE_TAG}{TRAINING_TAIL}"))


def _prompt(*lines: Text) -> Column:
    return strip_indents(_glue(*_user_turn(*lines)))


# --- training texts -------------------------------------------------------


def pretrain_text(text: Column) -> Column:
    return drop_blank_lines(text)


def qa_text(question: Column, answer: Column) -> Column:
    return _training(answer, question)


def hint_text(hint: Text, question: Column, answer: Column) -> Column:
    return _training(answer, hint, question)


def context_text(context: Column, question: Column, answer: Column) -> Column:
    """The question stands before the context, without headings."""
    return _training(answer, question, context)


def context_hint_text(hint: Text, context: Column, question: Column, answer: Column) -> Column:
    return _training(answer, hint, "context:", context, "question:", question)


def training_text(
    question: Column,
    answer: Column,
    context: Column,
    context_hint: Column,
    input_hint: Column,
) -> Column:
    """Choose the template row by row; NULL means "the recipe does not have it".

    A context wins over an input hint, and a context hint without a context
    has no effect.
    """
    return (
        F.when(answer.isNull(), pretrain_text(question))
        .when(
            context.isNotNull() & context_hint.isNotNull(),
            context_hint_text(context_hint, context, question, answer),
        )
        .when(context.isNotNull(), context_text(context, question, answer))
        .when(input_hint.isNotNull(), hint_text(input_hint, question, answer))
        .otherwise(qa_text(question, answer))
    )


# --- prompts --------------------------------------------------------------


def plain_prompt(question: Column) -> Column:
    return _prompt(question)


def hint_prompt(hint: Text, question: Column) -> Column:
    return _prompt(hint, question)


def context_prompt(question: Column, context: Column) -> Column:
    return _prompt(question, context)


def context_hint_prompt(hint: Text, question: Column, context: Column) -> Column:
    return _prompt(hint, "context:", context, "question:", question)


def evaluation_prompt(
    question: Column, context: Column, hint: Column, context_hint: Column
) -> Column:
    """Choose the prompt row by row; an empty string counts as present."""
    return (
        F.when(
            context.isNotNull() & context_hint.isNotNull(),
            context_hint_prompt(context_hint, question, context),
        )
        .when(context.isNotNull(), context_prompt(question, context))
        .when(hint.isNotNull(), hint_prompt(hint, question))
        .otherwise(plain_prompt(question))
    )


def expert_prompt(question: Column) -> Column:
    """The plain prompt behind an empty line."""
    return F.concat(F.lit("\n"), plain_prompt(question))


def expert_context_prompt(hint: Text, question: Column, context: Column) -> Column:
    """Context and question follow their headings on the same line."""
    return _prompt(hint, F.concat(F.lit("context:"), context), F.concat(F.lit("question:"), question))


def translation_prompt(text: Column) -> Column:
    """An instruction line and the text as it is; no line is stripped."""
    return _glue(f"{TRANSLATE_LINE}\n", text, "\n")


# --- chat formats of single model families --------------------------------


def chat_turn(role: Column, text: Column) -> Column:
    return _glue(OPEN_TAG, role, "\n", text, f"{CLOSE_TAG}\n")


def inst_chat(system: Column, prompt: Column) -> Column:
    return _glue("[INST] <<SYS>>", system, "<</SYS>>\n\n", prompt, " [/INST]\n")


def user_assistant_chat(prompt: Column) -> Column:
    return _glue("USER: ", prompt, "\nASSISTANT: \n")


def japanese_chat(prompt: Column) -> Column:
    return _glue("ユーザー: ", prompt, "\nシステム: \n")


# The stop strings that belong to each format.
STOPS = {
    "inst": ("[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"),
    "user_assistant": ("USER:", "ASSISTANT:"),
    "japanese": ("ユーザー:", "システム:"),
}
