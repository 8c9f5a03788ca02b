"""Line-level clean-up of text columns, Unicode-aware and inside the JVM.

Spark's own ``trim`` knows the ASCII space only and ``\\s`` in Java knows six
characters, while paragraphs in many languages start with other spaces, and
texts are broken at more than ``\\n``.  The character sets below are therefore
spelled out.  The regular expressions have no repeated groups, so a run of a
million blank lines needs no more stack than one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that end a line ("\r\n" counts as one end) ...
BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
# ... and the other white space, which can indent a line.
INDENTS = (
    "\t \x1f\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)
WHITE = BREAKS + INDENTS


def _one_of(chars: str) -> str:
    """A character class that rules out visible ASCII by one comparison.

    Most characters of most texts fail that first test, which makes the search
    several times faster than going through the whole set.
    """
    return f"[[^!-~]&&[{chars}]]"


BREAK_RE = _one_of(BREAKS)
INDENT_RE = _one_of("\t \x1f\xa0\u1680\u2000-\u200a\u202f\u205f\u3000")
WHITE_RE = _one_of(
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _single_breaks(text: Column) -> Column:
    return F.replace(text, F.lit("\r\n"), F.lit("\n"))


def _outdent(even: Column) -> Column:
    return F.regexp_replace(even, f"{BREAK_RE}{INDENT_RE}*", "\n")


def strip_indents(text: Column) -> Column:
    """Bring every line break to ``\\n`` and drop the indent after it.

    The first line keeps its indent and a final break is kept; templates,
    whose first and last characters are known, need nothing more.
    """
    return _outdent(_single_breaks(text))


def normalize_lines(text: Column) -> Column:
    """Every line without its indent, joined by ``\\n``; blank lines stay.

    One break at the very end of the text closes the last line and is dropped.
    """
    even = _single_breaks(text)
    ends = F.right(even, F.lit(1)).isin(*BREAKS)
    closed = F.when(ends, F.left(even, F.length(even) - 1)).otherwise(even)
    # Not again through _single_breaks: \r\r\n is two breaks and must stay two.
    return F.ltrim(_outdent(closed), F.lit(INDENTS))


def drop_blank_lines(text: Column) -> Column:
    """As :func:`normalize_lines`, and lines of white space only are removed."""
    compact = F.regexp_replace(F.ltrim(text, F.lit(WHITE)), f"{BREAK_RE}{WHITE_RE}*", "\n")
    return F.rtrim(compact, F.lit("\n"))


def first_line(text: Column) -> Column:
    """The text up to the first ``\\n``, without leading white space."""
    return F.ltrim(F.substring_index(text, "\n", 1), F.lit(WHITE))


def words(text: Column) -> Column:
    """The text cut at white space; a blank text has no words."""
    return F.array_remove(F.split(text, f"{WHITE_RE}+"), "")
