"""Where a pattern matches in a text, as column expressions.

A match's place is found by marking: each match is wrapped in a control
character, the text is cut there, and the lengths of the pieces are added up.
Running totals go in blocks of ``BLOCK``, and overlaps are found in one order of
all spans, so that a text may have any number of matches.
Places count code points; ends are exclusive.  A NULL text is an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunemill.llm.common import text_or_empty

MARK, INNER, NEUTRAL = "\u0001", "\u0002", "\u0003"
LEFT, RIGHT = 24, 8
FOUND = "array<struct<start:int,end:int,body:string,left:string,right:string>>"
SPANS = "array<struct<start:int,kind:int,end:int>>"
BLOCK = 256
FAR = 2**31 - 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once, however often it is named there."""
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, zero: int, add: Callable[[Column, Column], Column]) -> Column:
    """For each number of a list the total of those before it, from totals of whole blocks."""

    def of_block(v: Column, totals: Column, b: Column) -> Column:
        before = F.aggregate(F.slice(totals, 1, b), F.lit(zero), lambda x, y: add(x, y))
        start = F.struct(before.alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda acc, x: F.struct(add(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(F.slice(v, b * BLOCK + 1, BLOCK), start, step, lambda acc: acc["out"])

    def of_list(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        totals = F.transform(F.when(F.size(v) > 0, numbers).otherwise(F.array().cast("array<int>")),
                             lambda b: F.aggregate(F.slice(v, b * BLOCK + 1, BLOCK), F.lit(zero), lambda x, y: add(x, y)))
        return let(totals, lambda t: F.flatten(F.transform(t, lambda _, b: of_block(v, t, b))))

    return let(values, of_list)


def neutral(text: str = "text") -> Column:
    """The text without the characters that mark; the length stays, and no pattern here matches them.

    Not by ``translate``, which makes a string of each character of the text.
    """
    marked = F.replace(text_or_empty(text), F.lit(MARK), F.lit(NEUTRAL))
    return F.replace(marked, F.lit(INNER), F.lit(NEUTRAL))


def find(text: Column, pattern: str, inner: str = "$0", where: Column | None = None) -> Column:
    """All leftmost, non-overlapping matches: start, end, body, and what stands left and right.

    ``text`` comes from :func:`neutral`.  ``inner`` is what the match becomes,
    with ``INNER`` between its groups if they are needed.  ``where`` is a cheap
    necessary condition; texts without it are not searched.
    """
    pieces = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(MARK + inner + MARK)), MARK)
    size = lambda piece: F.length(F.replace(piece, F.lit(INNER)))

    def matches(p: Column) -> Column:
        """Every second piece is a match."""
        one = lambda at, i: F.struct(
            F.get(at, i).alias("start"),
            (F.get(at, i) + size(F.get(p, i))).alias("end"),
            F.get(p, i).alias("body"),
            F.substring(F.get(p, i - 1), -LEFT, LEFT).alias("left"),
            F.substring(F.get(p, i + 1), 1, RIGHT).alias("right"),
        )
        places = running(F.transform(p, size), 0, lambda x, y: x + y)
        odd = F.sequence(F.lit(1), F.size(p) - 2, F.lit(2))
        return F.when(F.size(p) > 1, let(places, lambda at: F.transform(odd, lambda i: one(at, i)).cast(FOUND)))

    found = F.coalesce(let(pieces, matches), F.array().cast(FOUND))
    return found if where is None else F.when(where, found).otherwise(F.array().cast(FOUND))


def of_kind(found: Column, number: int) -> Column:
    """Spans as structs that sort by start, then kind."""
    return F.transform(
        found, lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end"))
    )


def written(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of each span, joined by commas, in their order."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.concat_ws(
        ",",
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
    )


def free(spans: Column, others: Column, within: bool = False) -> Column:
    """The spans, sorted, that meet none of ``others``; with ``within``, that lie inside none of them."""
    tagged = lambda own: lambda s: F.struct(s["start"].alias("start"), F.lit(own).alias("own"), s["end"].alias("end"), s["kind"].alias("kind"))
    merged = F.array_sort(F.concat(F.transform(others, tagged(0)), F.transform(spans, tagged(1))))

    def kept(m: Column) -> Column:
        reach = running(F.transform(m, lambda s: F.when(s["own"] == 0, s["end"]).otherwise(0)), 0, F.greatest)
        starts = F.reverse(F.transform(m, lambda s: F.when(s["own"] == 0, s["start"]).otherwise(FAR)))
        after = F.reverse(running(starts, FAR, F.least))

        def judged(r: Column, n: Column) -> Column:
            own = lambda i: F.get(m, i)
            if within:
                clear = lambda i: F.get(r, i) < own(i)["end"]
            else:
                clear = lambda i: (F.get(r, i) <= own(i)["start"]) & (F.get(n, i) >= own(i)["end"])
            numbers = F.transform(m, lambda _, i: i)
            left = F.filter(numbers, lambda i: (own(i)["own"] == 1) & clear(i))
            return F.transform(left, lambda i: F.struct(own(i)["start"].alias("start"), own(i)["kind"].alias("kind"), own(i)["end"].alias("end")))

        return let(F.struct(reach.alias("r"), after.alias("n")), lambda x: judged(x["r"], x["n"]))

    return let(merged, kept).cast(SPANS)


def apart(spans: Column) -> Column:
    """Of spans sorted by start, those that begin at or after the end of the last one taken."""
    none = F.array().cast(SPANS)

    def step(acc: Column, span: Column) -> Column:
        return F.when(span["start"] < acc["at"], acc).otherwise(
            F.struct(span["end"].alias("at"), F.concat(acc["taken"], F.array(span).cast(SPANS)).alias("taken"))
        )

    def of_block(v: Column, acc: Column, b: Column) -> Column:
        start = F.struct(acc["at"].alias("at"), none.alias("taken"))
        return let(
            F.aggregate(F.slice(v, b * BLOCK + 1, BLOCK), start, step),
            lambda x: F.struct(x["at"].alias("at"), F.concat(acc["blocks"], F.array(x["taken"])).alias("blocks")),
        )

    def of_list(v: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("blocks"))
        numbers = F.sequence(F.lit(0), F.floor(F.size(v) / BLOCK).cast("int"))
        return F.aggregate(numbers, start, lambda acc, b: of_block(v, acc, b), lambda acc: F.flatten(acc["blocks"]))

    return let(spans, of_list)


def redacted(text: Column, spans: Column, kinds: list[str]) -> Column:
    """The text with each span replaced by its kind in brackets; ``spans`` are sorted and may overlap."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in kinds])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("made"))

    def step(acc: Column, span: Column) -> Column:
        between = F.substring(text, acc["at"] + 1, F.greatest(F.lit(0), span["start"] - acc["at"]))
        return F.struct(
            F.greatest(acc["at"], span["end"]).alias("at"),
            F.when(span["start"] < acc["at"], acc["made"])
            .otherwise(F.concat(acc["made"], between, F.get(names, span["kind"])))
            .alias("made"),
        )

    return F.aggregate(
        spans, start, step, lambda acc: F.concat(acc["made"], F.substring(text, acc["at"] + 1, F.length(text)))
    )
