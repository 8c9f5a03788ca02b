"""Spelling variants by pivotal grams: words one edit apart, and the common form each rare one stands for.

Bigrams have one order for all words: the rarest in the vocabulary first.  A
word's *prefix* is its ``PREFIX`` rarest different bigrams.  Two of its
bigrams that do not overlap are its *pivots*: of all such pairs within the
prefix a dynamic programme over the positions takes the pair with the shortest
expected lists.  One edit cannot touch both pivots, so it lies behind the first
one or before the second.  The word whose prefix ends earlier in the order
probes the other's prefix with its pivots; what it keeps is in that prefix.

Position limits: behind an intact first pivot the other word has that bigram
at the same distance from its beginning, with equal letters up to there;
before an intact second one, at the same distance from its end, with equal
letters from there on.  So a pivot counts at its first place (the second pivot
at its last), and the key of a list is the bigram's place and the letters on
its outer side.  Of the inner side one half is intact too and is part of the
key.  Such lists are short, and none is capped.  Each pair that meets is verified by
its edit distance.

Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF, one byte each in
Latin-1, so the table of bigrams has at most 65,536 entries at any size.  Only
that table goes through the driver.

NULL and empty texts have no words.  A NULL id counts as the empty text.
Repeated rows count each time.  An empty table gives an empty result.  Very
long texts are read whole, and words may be of any length.  Of near words with
the same count the smallest in code-point order is the form.  Only the id and
text columns are read; others may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import stored
from tunemill.llm.near import mixed, signed

LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
PREFIX = 3
"""Bigrams in a prefix: two for one edit, and one more."""
CELLS = 1 << 18
"""Letters that are worked on at once."""


def deleted(run: Column, doc_id: Column, every: int = 31) -> Column:
    """The run, or in one of ``every`` documents and runs the run without one letter; a hash of both says which."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    rest = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, rest).otherwise(run)


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n``: counts combine in each task before they move."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # A shorter run gives no word of that length, deleted letter or not.
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    each = docs.select(F.col("doc_id").alias("_id"), F.explode(runs).alias("_run"))
    lower = each.select("_id", F.translate("_run", upper, upper.lower()).alias("_run"))
    words = lower.select(deleted(F.col("_run"), F.col("_id")).alias("word"))
    counted = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of words of one length and their letters as a matrix, ``CELLS`` letters at most unless a word has more."""
    made = [w.encode("latin-1") for w in words.to_pylist()]
    lengths = np.array([len(w) for w in made], np.int64)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        step = max(1, CELLS // int(length))
        for k in range(0, len(at), step):
            part = at[k : k + step]
            letters = np.frombuffer(b"".join(made[i] for i in part), np.uint8).reshape(len(part), length)
            yield part, letters.astype(np.int64)


def bigram_counts(words: DataFrame) -> np.ndarray:
    """How often each bigram occurs in the different words, by its two bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for _, letters in _by_length(batch.column(0)):
                total += np.bincount((letters[:, :-1] * 256 + letters[:, 1:]).ravel(), minlength=1 << 16)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bigram", "n"])

    sums = words.select("word").mapInArrow(run, "bigram bigint, n bigint").groupBy("bigram").agg(F.sum("n").alias("n"))
    counts = np.zeros(1 << 16, np.int64)
    for row in sums.collect():  # one row a bigram: at most 65,536
        counts[row["bigram"]] = row["n"]
    return counts


class Order:
    """The bigrams from rare to common, and what a chain of bigrams says about the length of a list."""

    def __init__(self, counts: np.ndarray) -> None:
        codes = np.arange(1 << 16)
        self.rank = np.empty(1 << 16, np.int64)
        self.rank[np.lexsort((codes, counts))] = codes
        self.log = np.log(np.maximum(counts, 1))
        self.log_first = np.log(np.maximum(np.bincount(codes >> 8, weights=counts, minlength=256), 1))


class Grams:
    """Of words of one length: prefixes, pivots and the hashes of beginnings and ends."""

    def __init__(self, letters: np.ndarray, order: Order, prefix: int = PREFIX) -> None:
        self.letters, self.n = letters, letters.shape[1]
        codes = letters[:, :-1] * 256 + letters[:, 1:]
        ranks = order.rank[codes]
        # Equal bigrams stand together, in the order of their places: the first and the last of each count.
        by_rank = np.argsort(ranks, axis=1, kind="stable")
        ranked = np.take_along_axis(ranks, by_rank, 1)
        begins = np.ones(ranked.shape, bool)
        begins[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
        ends = np.ones(ranked.shape, bool)
        ends[:, :-1] = begins[:, 1:]
        kept = np.cumsum(begins, axis=1) <= prefix
        self.first, self.last = np.zeros(ranked.shape, bool), np.zeros(ranked.shape, bool)
        np.put_along_axis(self.first, by_rank, begins & kept, 1)
        np.put_along_axis(self.last, by_rank, ends & kept, 1)
        #: The rank that the prefix ends with.
        self.limit = np.where(kept, ranked, -1).max(axis=1)
        # Expected number of words with the letters up to a bigram, and from it on.
        step, start = order.log[codes], order.log_first[letters[:, :-1]]
        gain = step - start
        self.up_to = np.exp(np.cumsum(gain, axis=1) + start[:, :1])
        self.from_on = np.exp(np.cumsum(gain[:, ::-1], axis=1)[:, ::-1] + start)
        place = np.arange(self.n, dtype=np.uint64)
        cells = letters.astype(np.uint64)
        zero = np.zeros((len(letters), 1), np.uint64)
        #: Hashes of the first k letters, and of the last k.
        self.heads = np.cumsum(np.hstack([zero, mixed(cells + (place << np.uint64(8)))]), axis=1, dtype=np.uint64)
        back = mixed(cells[:, ::-1] + (place << np.uint64(8)) + np.uint64(1 << 60))
        self.tails = np.cumsum(np.hstack([zero, back]), axis=1, dtype=np.uint64)

    def pivots(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the two pivots, which do not overlap: the cheapest first one before each place, then the cheapest pair."""
        one = np.where(self.first, self.up_to, np.inf)
        two = np.where(self.last, self.from_on, np.inf)
        best = np.minimum.accumulate(one, axis=1)
        pair = np.full(one.shape, np.inf)
        pair[:, 2:] = best[:, :-2] + two[:, 2:]
        second = pair.argmin(axis=1)
        before = np.arange(one.shape[1]) <= (second - 2)[:, None]
        return np.where(before, one, np.inf).argmin(axis=1), second

    def _keys(self, row, outer, inner, front: bool, near: bool) -> np.ndarray:
        """A list's name: ``outer`` letters on the pivot's side, and ``inner`` more, next to them or at the far end."""
        here, there = (self.heads, self.tails) if front else (self.tails, self.heads)
        kind = np.uint64(2 * front + near + 1)
        part = mixed(here[row, outer + inner]) if near else mixed(here[row, outer]) * np.uint64(3) + mixed(there[row, inner])
        return mixed(part * np.uint64(5) + mixed(outer.astype(np.uint64) * np.uint64(8) + kind))

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """Words (rows) and keys of the prefixes: a key for each half of the inner side."""
        made = []
        for front, places in ((True, self.first), (False, self.last)):
            row, at = np.nonzero(places)
            outer = at + 2 if front else self.n - at
            rest = self.n - outer
            made.append((row, self._keys(row, outer, rest // 2, front, True)))
            made.append((row, self._keys(row, outer, rest - rest // 2, front, False)))
        return np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])

    def probes(self) -> tuple[np.ndarray, np.ndarray]:
        """Words (rows) and keys of the pivots, for other words that are shorter, as long, or longer by one letter."""
        row = np.arange(len(self.letters))
        made = []
        for front, at in zip((True, False), self.pivots()):
            outer = at + 2 if front else self.n - at
            rest = self.n - outer
            # Halves of rest - 1, rest and rest + 1 letters: two different ones each.
            for inner in ((rest - 1) // 2, (rest - 1) // 2 + 1):
                made.append((row, self._keys(row, outer, inner, front, True)))
            for inner in (rest // 2, rest // 2 + 1):
                made.append((row, self._keys(row, outer, inner, front, False)))
        return np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])


def _lists(words: DataFrame, order: Order, probing: bool) -> DataFrame:
    """``key``, the word, its count and the rank that its prefix ends with, of all probes or all entries."""
    names = ["key", "a", "a_n", "a_limit"] if probing else ["key", "b", "b_n", "b_limit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, letters in _by_length(batch.column(0)):
                grams = Grams(letters, order)
                row, keys = grams.probes() if probing else grams.entries()
                at = pa.array(part[row])
                arrays = [
                    pa.array(signed(keys)),
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array(grams.limit[row].astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    kinds = zip(names, ("bigint", "string", "bigint", "int"))
    return words.select("word", "n").mapInArrow(run, ", ".join(f"{n} {t}" for n, t in kinds))


def near_pairs(words: DataFrame) -> DataFrame:
    """``a``, ``b`` and their counts ``a_n``, ``b_n``: each pair of words that are one edit apart, once.

    ``words`` is a stored table of different words with their counts ``n``.
    """
    order = Order(bigram_counts(words))
    probes, entries = _lists(words, order, True), _lists(words, order, False)
    earlier = (F.col("a_limit") < F.col("b_limit")) | ((F.col("a_limit") == F.col("b_limit")) & (F.col("a") < F.col("b")))
    close = F.abs(F.length("a") - F.length("b")) <= 1
    one_edit = F.levenshtein(F.col("a"), F.col("b"), 1) == 1
    met = probes.hint("merge").join(entries, "key").where(earlier & close & one_edit)
    return met.select("a", "b", "a_n", "b_n").distinct()


def forms(words: DataFrame, pairs: DataFrame, times: int = TIMES) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form`` and ``form_n`` of all words."""
    ways = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    )
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("_best")
    near = pairs.select(F.inline(ways)).groupBy("word").agg(F.count("*").alias("n_near"), best)
    known = words.join(near, "word", "left")
    enough = -F.col("_best.less") >= times * F.col("n")
    return known.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(enough, F.col("_best.other")).alias("form"),
        F.when(enough, -F.col("_best.less")).alias("form_n"),
    )


def roots(known: DataFrame) -> DataFrame:
    """``word`` and ``root`` of the words that have a form, a stored table.

    Each round doubles the steps a word has gone.  Counts grow tenfold at each
    step, so there are few.  A word is the form of no more words than letters
    can be changed in it, whatever the size of the vocabulary.
    """
    jumps = stored(known.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        further = jumps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = stored(jumps.join(further, "root", "left").select("word", "root", "_next"))
        if moved.where(F.col("_next").isNotNull()).isEmpty():
            return jumps
        jumps = moved.select("word", F.coalesce("_next", "root").alias("root"))


def variants(docs: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word of ``docs`` (``doc_id``, ``text``)."""
    words = stored(vocabulary(docs))
    known = stored(forms(words, near_pairs(words)))
    ends = known.join(roots(known), "word", "left")
    return ends.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


ORACLE_SQL = r"""
WITH RECURSIVE bits AS (
    SELECT range AS b, list_reduce(
        list_prepend(range::UBIGINT, [0::UBIGINT,0,0,0,0,0,0,0]),
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS v
    FROM range(256)
), crc AS (SELECT list(v ORDER BY b) AS t FROM bits
), runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
), seven AS (SELECT doc_id, run, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs WHERE length(run) >= 7
), bytes AS (
    SELECT doc_id, run, list_transform(range(1, length(x) + 1, 2),
        lambda i: ((strpos('0123456789ABCDEF', x[i]) - 1) * 16 + strpos('0123456789ABCDEF', x[i + 1]) - 1)::UBIGINT) AS b
    FROM seven
), hashed AS (
    SELECT run, xor(list_reduce(list_prepend(4294967295::UBIGINT, b),
        lambda c, x: xor(c >> 8, t[((xor(c, x) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) AS h
    FROM bytes, crc
), edited AS (
    SELECT CASE WHEN h % 31 = 0
        THEN substring(run, 1, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2) ELSE run END AS word
    FROM hashed
), words AS (
    SELECT word, count(*) AS n FROM edited WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), cut AS (
    SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
    UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word
), best AS (
    SELECT word, count(*) AS n_near, max(other_n) AS top FROM near GROUP BY word
), chosen AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= 10 * w.n THEN b.top END AS form_n,
        (SELECT min(other) FROM near x WHERE x.word = w.word AND x.other_n = b.top AND b.top >= 10 * w.n) AS form
    FROM words w LEFT JOIN best b ON w.word = b.word
), walk AS (
    SELECT word, word AS at FROM chosen
    UNION ALL SELECT k.word, c.form FROM walk k JOIN chosen c ON c.word = k.at WHERE c.form IS NOT NULL
), ends AS (SELECT k.word, k.at AS root FROM walk k JOIN chosen c ON c.word = k.at WHERE c.form IS NULL)
SELECT c.word, c.n, c.n_near, c.form, c.form_n, e.root FROM chosen c JOIN ends e ON e.word = c.word
"""
