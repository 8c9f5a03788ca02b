"""Personal data: checked patterns, and candidates that boosted trees accept.

Base spans come from four strict patterns with their checks and always stay.
Generous generators propose further spans, which may overlap.  Each candidate
has format features (separators, share of digits, length) and context features
(what adjoins it, a telling word before it).  Trees are boosted to predict from
these whether a candidate holds a valid value; a threshold per kind, set on
documents that the trees have not seen, lets a candidate in where the
calibrated share of valid ones is at least ``precision``.  Accepted candidates
that meet a base span or an accepted one before them are left out.

All features are small whole numbers, so the training set is a table of counts
per combination: at most ``CELLS`` rows come to the driver however large the
corpus, and all candidates of all documents count.  The trees become a column
expression.

NULL text: no spans.  NULL or repeated ids: a row each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import sha256_hex, stored
from tunemill.llm.spans import apart, free, find, neutral, of_kind, written

KINDS = ["email", "ip", "card", "phone"]
# Possessive loops and boundaries keep the search linear and find the same matches: \G lets a
# match begin where the last one ended.  A run with too few digits for a card has too few from each start.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

AT = r"(?:\x20?[\[({]\x20?(?:at|AT)\x20?[\])}]\x20?|\x20(?:at|AT)\x20|\x20?@\x20?)"
DOT = r"(?:\x20?[\[({]\x20?(?:dot|DOT|\.)\x20?[\])}]\x20?|\x20(?:dot|DOT)\x20|\.)"
GENERATORS = [
    rf"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++{AT}[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]{1,3}(?:\x20?[\[({]?\.[\])}]?\x20?[0-9]{1,3}){3}(?![0-9])",
    r"(?<![0-9])[0-9](?:[\x20._/-]{0,2}[0-9]){12,18}(?![0-9])",
    r"(?<![0-9])\(?[0-9]{2,4}\)?[\x20./-]{0,2}[0-9]{3}[\x20./-][0-9]{3,4}(?![0-9])",
]
WORDS = (
    "mail,e-mail,contact,write,ip,host,server,address,adresse,card,visa,iban,account,carte,karte,"
    "tarjeta,phone,tel,call,fax,mobile,telefon,móvil"
).split(",")
FEATURES = {"kind": 4, "sep": 5, "share": 4, "size": 4, "before": 3, "after": 3, "word": 2}
CELLS = 4 * math.prod(FEATURES.values())
"""Combinations of features, label and fold: a bound on what the driver gets."""
PRECISION = 0.9
TREES, RATE = 40, 0.3

CANDIDATES = (
    "array<struct<start:int,end:int,kind:int,sep:int,share:int,size:int,before:int,after:int,word:int,valid:int>>"
)


def digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits' checksum holds."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("twice"))

    def step(acc: Column, digit: Column) -> Column:
        d = digit.cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.struct(
            (acc["sum"] + F.when(acc["twice"], doubled).otherwise(d)).alias("sum"), (~acc["twice"]).alias("twice")
        )

    every = F.regexp_extract_all(F.reverse(number), F.lit("[0-9]"), F.lit(0))
    return F.aggregate(every, start, step, lambda acc: acc["sum"] % 10 == 0)


PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def base_spans(text: Column) -> list[Column]:
    """The checked matches of each kind, in the order of ``KINDS``."""
    n_digits = lambda m: F.length(digits(m["body"]))
    has_digit = text.rlike("[0-9]")
    card = F.filter(find(text, CARD, where=has_digit), lambda m: n_digits(m) <= 19)
    return [
        find(text, EMAIL, where=F.contains(text, F.lit("@"))),
        F.filter(
            find(text, IP, where=text.rlike(r"[0-9]\.[0-9]")),
            lambda m: m["body"].rlike(rf"^{PART}(?:\.{PART}){{3}}$"),
        ),
        F.filter(card, lambda m: luhn(digits(m["body"]))),
        F.filter(find(text, PHONE, where=F.contains(text, F.lit("+"))), lambda m: n_digits(m).between(10, 15)),
    ]


def candidates(text: Column) -> Column:
    """What the generators propose, with features and whether the value is valid."""
    word = r"(?i)(?:" + "|".join(WORDS) + r")\W{0,3}$"
    has_digit = text.rlike("[0-9][^A-Za-z]{0,3}[0-9]")
    wheres = [F.contains(text, F.lit("@")) | text.rlike(r"(?:[\[({]|\x20)(?:at|AT)[\])}\x20]"), has_digit, has_digit, has_digit]

    def features(kind: int, m: Column) -> Column:
        body, number = m["body"], digits(m["body"])
        plain = F.regexp_replace(F.regexp_replace(body, AT, "@"), DOT, ".")
        valid = [
            plain.rlike(r"^[^@]{1,64}@[^@]+\.[A-Za-z]{2,24}$"),
            F.regexp_replace(body, r"[^0-9]+", ".").rlike(rf"^{PART}(?:\.{PART}){{3}}$"),
            luhn(number) & F.length(number).between(13, 19),
            F.length(number).between(10, 15),
        ][kind]
        middle = F.regexp_replace(body, "[A-Za-z0-9]+", "")
        sep = (
            F.when(middle.rlike(r"[\[\](){}]"), 4)
            .when(F.contains(middle, F.lit(".")), 3)
            .when(F.contains(middle, F.lit("-")) | F.contains(middle, F.lit("/")), 2)
            .when(F.contains(middle, F.lit(" ")), 1)
            .otherwise(0)
        )
        share = F.least(F.lit(3), F.floor(4 * F.length(number) / F.length(body)).cast("int"))
        beside = lambda c: F.when(c.rlike("[0-9]"), 2).when(c.rlike(r"\p{L}"), 1).otherwise(0)
        return F.struct(
            m["start"].alias("start"),
            m["end"].alias("end"),
            F.lit(kind).alias("kind"),
            sep.alias("sep"),
            share.alias("share"),
            F.least(F.lit(3), F.floor(F.length(body) / 8).cast("int")).alias("size"),
            beside(F.substring(m["left"], -1, 1)).alias("before"),
            beside(F.substring(m["right"], 1, 1)).alias("after"),
            m["left"].rlike(word).cast("int").alias("word"),
            valid.cast("int").alias("valid"),
        )

    def proposed(kind: int) -> Column:
        return F.transform(find(text, GENERATORS[kind], where=wheres[kind]), lambda m: features(kind, m))

    found = [proposed(kind) for kind in range(len(KINDS))]
    return F.concat(*found).cast(CANDIDATES)


@dataclass(frozen=True)
class Split:
    feature: str
    value: int
    low: float | Split
    high: float | Split


@dataclass(frozen=True)
class Model:
    """Trees over the features, the starting logit, and a threshold on the score per kind (None: accept none)."""

    start: float
    trees: tuple[Split, ...]
    thresholds: tuple[float | None, ...]

    def logit(self, row: dict[str, int]) -> float:
        def leaf(node):
            while isinstance(node, Split):
                node = node.low if row[node.feature] <= node.value else node.high
            return node

        return self.start + sum(leaf(t) for t in self.trees)

    def accepts(self, candidate: Column) -> Column:
        """The same as an expression."""

        def leaf(node) -> Column:
            if not isinstance(node, Split):
                return F.lit(float(node))
            return F.when(candidate[node.feature] <= node.value, leaf(node.low)).otherwise(leaf(node.high))

        logit = F.lit(self.start)
        for tree in self.trees:
            logit = logit + leaf(tree)
        chosen = F.lit(False)
        for kind, threshold in enumerate(self.thresholds):
            if threshold is not None:
                chosen = chosen | ((candidate["kind"] == kind) & (logit >= threshold - 1e-9))
        return chosen


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def boost(cells: list[dict], trees: int = TREES, rate: float = RATE, depth: int = 2) -> tuple[float, list[Split]]:
    """Newton boosting of small trees on counted combinations: rows of features, ``valid`` and ``n``."""
    total = sum(c["n"] for c in cells)
    ones = sum(c["n"] for c in cells if c["valid"])
    start = math.log((ones + 0.5) / (total - ones + 0.5))
    logits = [start] * len(cells)
    made = []

    def grow(rows: list[int], g: list[float], h: list[float], left: int):
        sum_g, sum_h = sum(g[i] for i in rows), sum(h[i] for i in rows)
        best = (1e-6, None)
        for name, width in FEATURES.items() if left else ():
            part_g, part_h = [0.0] * width, [0.0] * width
            for i in rows:
                part_g[cells[i][name]] += g[i]
                part_h[cells[i][name]] += h[i]
            low_g = low_h = 0.0
            for value in range(width - 1):
                low_g, low_h = low_g + part_g[value], low_h + part_h[value]
                if min(low_h, sum_h - low_h) > 1e-3:
                    gain = low_g**2 / (low_h + 1) + (sum_g - low_g) ** 2 / (sum_h - low_h + 1) - sum_g**2 / (sum_h + 1)
                    if gain > best[0]:
                        best = (gain, (name, value))
        if best[1] is None:
            return rate * sum_g / (sum_h + 1)
        name, value = best[1]
        low = [i for i in rows if cells[i][name] <= value]
        high = [i for i in rows if cells[i][name] > value]
        return Split(name, value, grow(low, g, h, left - 1), grow(high, g, h, left - 1))

    for _ in range(trees):
        p = [_sigmoid(x) for x in logits]
        g = [c["n"] * (c["valid"] - q) for c, q in zip(cells, p)]
        h = [c["n"] * q * (1 - q) for c, q in zip(cells, p)]
        tree = grow(list(range(len(cells))), g, h, depth)
        if not isinstance(tree, Split):
            break
        made.append(tree)
        one = Model(0.0, (tree,), ())
        logits = [x + one.logit(c) for x, c in zip(logits, cells)]
    return start, made


def fit(found: DataFrame, precision: float = PRECISION) -> Model:
    """A model from a table with ``doc_id`` and ``candidates``; a quarter of the ids calibrates."""
    fold = (F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)) == 0).cast("int")
    rows = found.select(fold.alias("fold"), F.inline("candidates"))
    counted = rows.groupBy(*FEATURES, "valid", "fold").agg(F.count("*").alias("n")).collect()  # CELLS at most
    cells = [r.asDict() for r in counted]
    train = [c for c in cells if not c["fold"]]
    if not train:
        return Model(0.0, (), (None,) * len(KINDS))
    start, trees = boost(sorted(train, key=lambda c: tuple(c.values())))
    model = Model(start, tuple(trees), ())
    thresholds: list[float | None] = []
    for kind in range(len(KINDS)):
        held = sorted(((model.logit(c), c["valid"], c["n"]) for c in cells if c["fold"] and c["kind"] == kind), reverse=True)
        best, valid, seen = None, 0, 0
        for i, (logit, good, n) in enumerate(held):
            valid, seen = valid + good * n, seen + n
            if (i + 1 == len(held) or held[i + 1][0] < logit) and valid / seen >= precision:
                best = logit
        thresholds.append(best)
    return Model(start, tuple(trees), tuple(thresholds))


def detect(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """``doc_id``, ``base`` (a list of spans for each kind), ``spans`` (base and accepted ones, sorted).

    The texts are read once; what was found in them is stored in the shared folder.
    """
    text = F.col("_text")
    rows = docs.select("doc_id", neutral().alias("_text"))
    base = F.array(*[of_kind(found, k) for k, found in enumerate(base_spans(text))])
    found = stored(rows.select("doc_id", base.alias("base"), candidates(text).alias("candidates")))
    model = fit(found, precision)
    accepted = F.transform(
        F.filter("candidates", model.accepts),
        lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")),
    )
    as_spans = F.array_sort(free(accepted, F.flatten("base")))
    return found.select(
        "doc_id", "base", F.array_sort(F.concat(F.flatten("base"), apart(as_spans))).alias("spans")
    )


def summary(detected: DataFrame) -> DataFrame:
    counts = [F.size(F.get("base", k)).cast("bigint").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    base = written(F.array_sort(F.flatten("base")), KINDS)
    return detected.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *counts,
        sha256_hex(base).alias("base_sha256"),
        written(F.col("spans"), KINDS).alias("spans"),
    )
