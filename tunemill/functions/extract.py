"""Take the user or assistant part out of a rendered text, or cut an output."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns reach to the *last* closing tag of the text.
USER_RE = r"(?s)<\|im_start\|>user\n(.+)\n<\|im_end\|>"
ASSISTANT_RE = r"(?s)<\|im_start\|>assistant\n(.+)\n<\|im_end\|>"
ASSISTANT_OPEN_RE = r"(?s)<\|im_start\|>assistant\n(.+)"


def _group(text: Column, pattern: str) -> Column:
    # The group cannot match the empty string, so '' always means "no match".
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def user_part(text: Column) -> Column:
    """What the user said; NULL when the tags are missing."""
    return _group(text, USER_RE)


def assistant_part(text: Column) -> Column:
    """What the assistant said; NULL when a tag is missing."""
    return _group(text, ASSISTANT_RE)


def assistant_part_or_rest(text: Column) -> Column:
    """As above; without a closing tag all after the opening one, else the whole text."""
    return F.coalesce(assistant_part(text), _group(text, ASSISTANT_OPEN_RE), text)


def _quoted(stop: str) -> str:
    return "\\Q" + stop.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def cut_at_stop(text: Column, stops: Iterable[str]) -> Column:
    """The text before the first of the stop strings; empty ones, or none, stop nothing."""
    known = [stop for stop in stops if stop]
    return F.regexp_replace(text, f"(?s)(?:{'|'.join(map(_quoted, known))}).*", "") if known else text
