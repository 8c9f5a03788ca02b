"""Language by prediction by partial matching: the language whose byte contexts give a text the shortest code.

Each language has a tree of contexts of up to ``ORDER`` bytes (UTF-8), with
counts of the bytes that follow them.  A byte is coded in the longest context that
is known: a byte that has followed it c times out of T, with D different
ones, costs -log2(c / (T + D)) bits; any other byte costs the escape,
-log2(D / (T + D)), and then its code in the context that is a byte shorter.
Below the empty context every byte costs 8 bits.  The counts are frozen: they
do not learn from what is scored, so the code length of a text is a sum over
its bytes and does not depend on other rows.  It is exact: all bytes of the
whole text count.  Text begins after ``ORDER`` zero bytes.

The cost of a byte depends on itself and the ``ORDER`` bytes before it.  So the
trees are compiled into one table: for each string of up to ``ORDER + 1`` bytes
that some language has seen, its cost in every language, escapes included.
Scoring looks up the longest such string at each byte, and adds the escapes of
longer contexts that are known, but not with this byte.

Learning covers a sample of each language's rows, chosen by a hash of the text so that some
``MAX_BYTES`` bytes of it are expected (all, if it has fewer), which bounds the
table; ``MAX_TABLE`` bounds it further if there are many languages.  It is
gathered by Spark and goes to every executor.

``score`` is the probability of the predicted language given the text, if all languages
are as likely and texts follow these codes; long texts have 1.  Equal code
lengths go to the smallest name.  NULL texts and texts without a letter are
``und`` with score 0; so are all texts if nothing has been learned.  Rows with
NULL language or NULL id teach nothing; repeated rows teach each time.  An empty table
gives an empty result.  Very long texts are scored in pieces that overlap by
``ORDER`` bytes, with the same sum.  Other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.near import mixed
from tunemill.llm.toxicity import teaches

ORDER = 4
MAX_BYTES = 1 << 20
MAX_TABLE = 1 << 26
"""Costs in the table: strings times languages; each language learns from less if there are many."""
PIECE = 1 << 19
"""Bytes that are coded at once."""
UNKNOWN = "und"


def codes_of(data: np.ndarray, order: int = ORDER) -> Iterator[tuple[int, np.ndarray]]:
    """Lengths from 1 to ``order + 1`` with the strings of that length ending at each byte from the ``order``-th on.

    A string is a number: its bytes, and its length above them.
    """
    n = len(data) - order
    code = np.zeros(n, np.uint64)
    for back in range(order + 1):
        code = code | data[order - back : order - back + n].astype(np.uint64) << np.uint64(8 * back)
        yield back + 1, code | np.uint64(back + 1) << np.uint64(56)


def padded(text: str, order: int = ORDER) -> bytes:
    return bytes(order) + text.encode("utf-8", "surrogatepass")


def string_counts(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang``, ``code`` and ``n``: how often each string of up to ``order + 1`` bytes occurs; combined in each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = np.frombuffer(padded(text, order), np.uint8)
                for at in range(0, max(1, len(data) - order), PIECE):
                    made.setdefault(lang, []).append(data[at : at + PIECE + order])
            for lang, pieces in made.items():
                for k in range(order + 1):
                    found = [np.unique(dict(codes_of(p, order))[k + 1], return_counts=True) for p in pieces]
                    code, where = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
                    n = np.bincount(where, np.concatenate([n for _, n in found]), len(code)).astype(np.int64)
                    arrays = [pa.array([lang] * len(code)), pa.array(code.view(np.int64)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["lang", "code", "n"])

    counted = rows.select("lang", "text").mapInArrow(run, "lang string, code bigint, n bigint")
    return counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def _slots(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A table of slots for the codes: one code's number a slot, and codes that found theirs taken (few, sorted)."""
    bits = max(8, int(np.ceil(np.log2(len(codes) + 1))) + 2)
    slot = (mixed(codes) >> np.uint64(64 - bits)).astype(np.int64)
    slots = np.zeros(1 << bits, np.int32)
    slots[slot[::-1]] = np.arange(len(codes), dtype=np.int32)[::-1]
    late = np.flatnonzero(slots[slot] != np.arange(len(codes)))
    return slots, late.astype(np.int32)


@dataclass(frozen=True)
class Model:
    """Costs in bits of the strings ``codes`` and of escapes from ``contexts`` (both sorted) in each of ``langs`` (sorted)."""

    langs: list[str]
    codes: np.ndarray
    costs: np.ndarray
    contexts: np.ndarray
    escapes: np.ndarray
    slots: np.ndarray
    late: np.ndarray
    order: int = ORDER

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Numbers of the codes, -1 where a code is not known."""
        bits = len(self.slots).bit_length() - 1
        at = self.slots[(mixed(codes) >> np.uint64(64 - bits)).astype(np.int64)]
        hit = self.codes[at] == codes
        if len(self.late):
            miss = np.flatnonzero(~hit)
            near = np.searchsorted(self.codes[self.late], codes[miss])
            near = self.late[np.minimum(near, len(self.late) - 1)]
            good = self.codes[near] == codes[miss]
            at[miss[good]] = near[good]
            hit[miss[good]] = True
        return np.where(hit, at, -1)

    def byte_costs(self, data: np.ndarray) -> np.ndarray:
        """The cost of each byte from the ``order``-th on in each language."""
        every = [codes for _, codes in codes_of(data, self.order)]
        at = self.find(every[-1])
        left, escaped = np.flatnonzero(at < 0), []
        for size in range(self.order, -1, -1):
            if not len(left):
                break
            # Without its last byte, the string that was not found is the context that is left.
            low = every[size][left] & np.uint64((1 << 56) - 1)
            context = low >> np.uint64(8) | np.uint64(size) << np.uint64(56)
            where = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
            known = self.contexts[where] == context
            escaped.append((left[known], where[known]))
            if size:
                at[left] = self.find(every[size - 1][left])
                left = left[at[left] < 0]
        costs = self.costs[at]
        costs[left] = 8.0
        for rows, where in escaped:
            costs[rows] += self.escapes[where]
        return costs

    def bits(self, texts: list[str]) -> np.ndarray:
        """Code lengths of the texts (rows) in the languages (columns)."""
        total = np.zeros((len(texts), len(self.langs)))
        held: list[tuple[int, np.ndarray]] = []
        size = 0

        def flush():
            data = np.concatenate([d for _, d in held])
            costs = self.byte_costs(data)
            sums = np.vstack([np.zeros((1, len(self.langs))), np.cumsum(costs, axis=0, dtype=np.float64)])
            begin = 0
            for i, d in held:
                total[i] += sums[begin + len(d) - self.order] - sums[begin]
                begin += len(d)

        for i, text in enumerate(texts):
            data = np.frombuffer(padded(text, self.order), np.uint8)
            for at in range(0, len(data) - self.order, PIECE):
                held.append((i, data[at : at + PIECE + self.order]))
                size += len(held[-1][1])
                if size >= PIECE:
                    flush()
                    held, size = [], 0
        if held:
            flush()
        return total


def compiled(langs: list[str], lang: np.ndarray, code: np.ndarray, n: np.ndarray, order: int = ORDER) -> Model:
    """The table of costs from the counts of all strings: ``lang`` is a number, ``code`` a string, ``n`` its count."""
    codes = np.unique(code)
    counts = np.zeros((len(codes), len(langs)), np.float32)
    counts[np.searchsorted(codes, code), lang] = n
    length = (codes >> np.uint64(56)).astype(np.int64)
    low = codes & np.uint64((1 << 56) - 1)
    # A string without its last byte is its context, without its first one the string in the shorter context.
    context = (low >> np.uint64(8)) | (np.maximum(length, 1) - 1).astype(np.uint64) << np.uint64(56)
    costs = np.zeros((len(codes), len(langs)), np.float32)
    contexts, escapes = [], []
    for size in range(1, order + 2):
        here = np.flatnonzero(length == size)
        if not len(here):
            continue
        names, group = np.unique(context[here], return_inverse=True)
        seen = counts[here]
        total = np.zeros((len(names), len(langs)))
        kinds = np.zeros((len(names), len(langs)))
        np.add.at(total, group, seen)
        np.add.at(kinds, group, seen > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            own = -np.log2(seen / (total + kinds)[group])
            escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
        contexts.append(names)
        escapes.append(escape.astype(np.float32))
        if size == 1:
            shorter = np.full((len(here), len(langs)), 8.0)
        else:
            keep = np.uint64((1 << (8 * (size - 1))) - 1)
            tail = (low[here] & keep) | np.uint64(size - 1) << np.uint64(56)
            shorter = costs[np.searchsorted(codes, tail)]
        costs[here] = np.where(seen > 0, own, escape[group] + shorter)
    slots, late = _slots(codes)
    return Model(langs, codes, costs, np.concatenate(contexts), np.concatenate(escapes), slots, late, order)


def fit(rows: DataFrame, max_bytes: int = MAX_BYTES, max_table: int = MAX_TABLE, order: int = ORDER) -> Model | None:
    """A model from ``text`` and ``lang``, all that may be learned from; None if there is nothing."""
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.col("text") != ""))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    if not sizes:
        return None
    langs = sorted(sizes)
    # A language has at most `order + 1` strings a byte; each has a cost in every language.
    each = min(max_bytes, max(1, max_table // len(langs) ** 2))
    parts = 1 << 30
    shares = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.lit(min(parts, parts * each // sizes[lang])))])
    chosen = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(parts)) < F.element_at(shares, F.col("lang"))
    table = string_counts(rows.where(chosen), order).toArrow()
    if not table.num_rows:
        return None
    number = {lang: i for i, lang in enumerate(langs)}
    lang = np.array([number[x] for x in table.column("lang").to_pylist()], np.int64)
    code = table.column("code").to_numpy().view(np.uint64)
    return compiled(langs, lang, code, table.column("n").to_numpy(), order)


def predict(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``lang_pred`` and ``score`` of each row by its ``text`` alone, beside the columns ``keep``."""
    text = F.col("text").cast("string")
    lettered = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["_kept", "lang_pred", "score"]
    rows = docs.select(F.struct(*[F.col(k) for k in keep], F.lit(0).alias("_")).alias("_kept"), F.when(lettered, text).alias("_text"))
    kind = rows.schema["_kept"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            at = [i for i, t in enumerate(texts) if t is not None]
            best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            bits = known.bits([texts[i] for i in at])
            for i, row in zip(at, bits):
                k = int(row.argmin())
                best[i], score[i] = known.langs[k], 1 / np.exp2(np.maximum(row[k] - row, -1000)).sum()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.string()), pa.array(score)], names=names)

    made = rows.mapInArrow(run, f"_kept {kind}, lang_pred string, score double")
    return made.select(*[F.col("_kept").getField(k).alias(k) for k in keep], "lang_pred", "score")


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score``; learned from the rows that may teach."""
    model = fit(docs.where(teaches()).select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(~teaches(), F.lit(False)).alias("held_out"), "text"
    )
    return predict(rows, model, ("doc_id", "held_out"))
