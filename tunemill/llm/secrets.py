"""Secret scans with an inverted index of trigrams.

Each rule is a regular expression.  A text it matches must hold certain
trigrams: :func:`trigram_query` reads them off the pattern as a Boolean query,
an AND of ORs of ANDs.  The index has, for each trigram that some query names, a
bitmap of the documents that hold it.  Intersecting and uniting bitmaps gives
each rule's candidates; only these are searched.  A rule whose query is empty,
such as a plain run of hex digits, searches every text.

Documents are numbered by a hash into a power of two of slots, at least twice
as many as there are documents.  Two documents in one slot only mean a search
in vain, never a miss, so NULL, repeated and widely spread ids are all right.
Trigrams are compared in lower case.  A NULL text is an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import sha256_hex, stored, text_or_empty
from tunemill.llm.spans import INNER, apart, free, find, neutral, of_kind, written

MAX_STRINGS = 32
"""Strings that an exact set of the query's derivation may hold before it is turned into trigrams."""
BITMAP_BITS = 32_768
"""Bits of one of Spark's bitmaps."""
PIECE_BITS = 512
"""Bits of a piece, in which bitmaps are joined with texts: a row that brings whole ones along copies them at each look."""
PIECES = BITMAP_BITS // PIECE_BITS
BROADCAST_BYTES = 64 << 20
"""Candidate bitmaps up to this size go to every executor; larger ones are joined by shuffle."""


@dataclass(frozen=True)
class Rule:
    """``inner`` is a match with its groups apart; ``keep`` says which matches count, given the body."""

    kind: str
    pattern: str
    inner: str = "$0"
    keep: object = None


BASE = [
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?)([A-Za-z0-9+/_.=-]+)",
        f"$1{INNER}$2",
        lambda body: F.length(F.element_at(F.split(body, INNER), 2)) >= 12,
    ),
    # A run too short fails at each of its starts, so the least length can stand in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{14,}+"),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{16,}+"),
]
MORE = [
    Rule(
        "private_key",
        # With all up to the END line; without one, with the base64 lines that follow. Possessive, so it stays linear.
        r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"
        r"(?:(?:[A-Za-z0-9+/=:;,.@_()<>#*|\"'\x20\t\r\n\\]++|-(?!----))*+-----END [A-Z ]{0,24}PRIVATE KEY-----"
        r"|(?:(?:[\x20\t\r\n]|\\[rn])++[A-Za-z0-9+/]{20,}+={0,2}+)++)?+",
    ),
    Rule("forge_token", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    # A run without the two further parts is a match too, which is dropped: so each run is read once.
    Rule(
        "web_token",
        r"eyJ[A-Za-z0-9_-]{8,}+(?:\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)?+",
        keep=lambda body: F.contains(body, F.lit(".")),
    ),
    Rule("cloud_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("payment_key", r"(?:sk|rk)_live_[0-9A-Za-z]{16,}"),
    Rule("bearer", r"(?i:authorization:\x20*bearer)\x20+[A-Za-z0-9._~+/-]{16,}=*"),
]

Query = frozenset[frozenset[str]] | None
"""Sets of trigrams of which a text must hold one set in full; None: nothing is known."""


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _either(a: Query, b: Query) -> Query:
    return None if a is None or b is None else a | b


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    joined = frozenset(x | y for x in a for y in b)
    return joined if len(joined) <= MAX_STRINGS else min(a, b, key=len)


def _of_strings(strings: frozenset[str]) -> Query:
    sets = frozenset(_trigrams(s) for s in strings)
    if frozenset() in sets or not sets:
        return None
    return frozenset(s for s in sets if not any(other < s for other in sets))


def trigram_query(pattern: str) -> Query:
    """What a text must hold to match, in lower case.

    Walks the parsed pattern with the strings that the part just read may be,
    as long as they are few, and the query of what lies before them.
    """

    def sequence(items) -> tuple[frozenset[str] | None, Query]:
        exact: frozenset[str] = frozenset([""])
        query: Query = None
        whole = True
        for item in items:
            strings, inner = part(item)
            if strings is not None and len(exact) * len(strings) <= MAX_STRINGS:
                exact = frozenset(a + b for a in exact for b in strings)
                continue
            query = _both(_both(query, _of_strings(exact)), inner)
            whole = False
            exact = frozenset([""]) if strings is None else strings
        if whole:
            return exact, None
        return None, _both(query, _of_strings(exact))

    def part(item) -> tuple[frozenset[str] | None, Query]:
        """The strings this part may be (None: too many), and else what it needs."""
        kind, value = item
        if kind is op.LITERAL:
            return frozenset([chr(value).lower()]), None
        if kind is op.AT or kind in (op.ASSERT, op.ASSERT_NOT):
            return frozenset([""]), None
        if kind is op.IN:
            if all(k is op.LITERAL for k, _ in value):
                return frozenset(chr(v).lower() for _, v in value), None
            return None, None
        if kind is op.SUBPATTERN:
            return sequence(value[3])
        if kind is op.ATOMIC_GROUP:
            return sequence(value)
        if kind is op.BRANCH:
            made = [sequence(branch) for branch in value[1]]
            if all(strings is not None for strings, _ in made):
                return frozenset().union(*[strings for strings, _ in made]), None
            query = None
            for i, (strings, inner) in enumerate(made):
                own = inner if strings is None else _of_strings(strings)
                query = own if i == 0 else _either(query, own)
            return None, query
        if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            least, most, inner = value
            strings, query = sequence(inner)
            if strings is not None and most == 1:
                return strings | (frozenset() if least else frozenset([""])), None
            if least == 0:
                return None, None
            return None, query if strings is None else _of_strings(strings)
        return None, None

    strings, query = sequence(parser.parse(pattern))
    return query if strings is None else _of_strings(strings)


def build_index(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings: ``trigram``, ``bucket`` and a ``bitmap`` of the slots in it.

    ``rows`` has ``_slot`` and ``_text``.  Bits are gathered before the shuffle.
    """
    lower = rows.select("_slot", F.explode(F.array(F.lower("_text"))).alias("_lower"))  # once per text
    held = F.array(*[F.when(F.contains(F.col("_lower"), F.lit(t)), F.lit(t)) for t in trigrams])
    terms = lower.select("_slot", F.explode(F.array_compact(held)).alias("trigram"))
    bucket, bit = F.bitmap_bucket_number(F.col("_slot")), F.bitmap_bit_position(F.col("_slot"))
    return terms.groupBy("trigram", bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("bitmap"))


def search_index(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """``kind``, ``bucket`` and the ``bitmap`` of slots that meet the kind's query.

    A conjunction counts in a bucket only if all its trigrams have postings there.
    """
    wanted = [
        F.struct(F.lit(kind).alias("kind"), F.lit(number).alias("clause"), F.lit(len(clause)).alias("size"), F.lit(trigram).alias("trigram"))
        for kind, query in queries.items()
        for number, clause in enumerate(sorted(query, key=sorted))
        for trigram in sorted(clause)
    ]
    # As literals: a list of Python rows would start another Python daemon with its workers in each executor.
    kinds = "array<struct<kind:string,clause:int,size:int,trigram:string>>"
    terms = index.sparkSession.range(1).select(F.inline(F.array(*wanted).cast(kinds)))
    postings = index.join(F.broadcast(terms), "trigram")  # as many rows as the rules have trigrams
    clauses = (
        postings.groupBy("kind", "clause", "bucket")
        .agg(F.bitmap_and_agg("bitmap").alias("bitmap"), F.count("*").alias("n"), F.first("size").alias("size"))
        .where(F.col("n") == F.col("size"))
    )
    return clauses.groupBy("kind", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def has_bit(bitmap: Column, slot: Column) -> Column:
    """Whether a slot's bit is set; a NULL bitmap has none."""
    position = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(position, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("shiftright", byte, (position % 8).cast("int")).bitwiseAND(1) != 0, F.lit(False))


def in_pieces(hits: DataFrame, kinds: list[str]) -> DataFrame:
    """``_piece`` and the bits of each kind in it, ``_hits_<number of the kind>``: small rows to look slots up in.

    A slot's piece is the number of slots before it, divided by ``PIECE_BITS``;
    pieces without a bit are left out.
    """
    names = [f"_hits_{i}" for i in range(len(kinds))]
    by_bucket = hits.groupBy("bucket").agg(
        *[F.max(F.when(F.col("kind") == kind, F.col("bitmap"))).alias(name) for kind, name in zip(kinds, names)]
    )
    size = PIECE_BITS // 8
    cut = F.transform(
        F.sequence(F.lit(0), F.lit(PIECES - 1)),
        lambda i: F.struct(
            ((F.col("bucket") - 1) * PIECES + i).alias("_piece"),
            *[F.substring(F.col(name), i * size + 1, F.lit(size)).alias(name) for name in names],
        ),
    )
    some = [F.coalesce(F.col(name) != F.lit(bytes(size)), F.lit(False)) for name in names]
    return by_bucket.select(F.inline(cut)).where(reduce(or_, some))


def scan(docs: DataFrame, base: list[Rule] | None = None, more: list[Rule] | None = None, keep: list[str] = ()) -> DataFrame:
    """``doc_id``, ``base`` (a list of spans for each base rule), ``spans`` (with those of ``more``, sorted) and ``all``.

    The texts are read once for the index and once for the search; they are
    moved only if the candidates' bitmaps exceed ``BROADCAST_BYTES``.  Spans of
    ``more`` that lie within a base span or meet one of ``more`` before them are
    not among ``spans``; ``all`` has every span, sorted, so that their union can
    be redacted.  ``keep`` names further columns of ``docs`` to carry along.
    """
    base = BASE if base is None else base
    more = MORE if more is None else more
    rules = [*base, *more]
    n = docs.count()
    slots = BITMAP_BITS
    while slots < 2 * n:
        slots *= 2
    slot = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(slots)) + 1  # Spark numbers bits from 1
    rows = docs.select("doc_id", *keep, slot.alias("_slot"), text_or_empty().alias("_text"))

    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    known = {kind: query for kind, query in queries.items() if query}
    trigrams = sorted({t for query in known.values() for clause in query for t in clause})
    text = neutral("_text")
    if trigrams:
        hits = stored(search_index(build_index(rows, trigrams), known))
        pieces = in_pieces(hits, list(known))
        n_bitmaps, n_buckets = hits.agg(F.count("*"), F.count_distinct("bucket")).first()
        small = n_bitmaps * BITMAP_BITS // 8 + n_buckets * PIECES * (8 * len(known) + 64) <= BROADCAST_BYTES
        before = F.col("_slot") - 1
        rows = rows.select(
            "doc_id", *keep, "_text", F.shiftright(before, PIECE_BITS.bit_length() - 1).alias("_piece"), (before % PIECE_BITS + 1).alias("_slot")
        ).join(F.broadcast(pieces) if small else pieces, "_piece", "left")
    number = {kind: i for i, kind in enumerate(known)}

    def found(rule: Rule) -> Column:
        where = has_bit(F.col(f"_hits_{number[rule.kind]}"), F.col("_slot")) if rule.kind in known else None
        matches = find(text, rule.pattern, rule.inner, where)
        return F.filter(matches, lambda m: rule.keep(m["body"])) if rule.keep else matches

    spans = F.struct(
        F.array(*[of_kind(found(rule), k) for k, rule in enumerate(base)]).alias("base"),
        F.concat(
            F.array().cast("array<struct<start:int,kind:int,end:int>>"),
            *[of_kind(found(rule), len(base) + k) for k, rule in enumerate(more)],
        ).alias("_more"),
    )
    # A generator's output is made once per row; a plain column would be searched again where it is used.
    searched = rows.select("doc_id", *keep, F.inline(F.array(spans)))
    others = free(F.col("_more"), F.flatten("base"), within=True)
    spans = F.array_sort(F.concat(F.flatten("base"), apart(F.array_sort(others))))
    every = F.array_sort(F.concat(F.flatten("base"), F.col("_more")))
    return searched.select("doc_id", *keep, "base", spans.alias("spans"), every.alias("all"))


KINDS = [rule.kind for rule in [*BASE, *MORE]]


def summary(searched: DataFrame) -> DataFrame:
    counts = [F.size(F.get("base", k)).cast("bigint").alias(f"n_{rule.kind}") for k, rule in enumerate(BASE)]
    return searched.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *counts,
        sha256_hex(written(F.array_sort(F.flatten("base")), KINDS)).alias("base_sha256"),
        written(F.col("spans"), KINDS).alias("spans"),
    )
