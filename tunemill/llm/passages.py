"""Substring dedup: passages that repeat across documents, found by MinHash bands over short paragraphs.

Repeated passages rarely end where lines end, so a text is read as overlapping
paragraphs of ``LENGTH`` words, one from each word on; lines and blank lines
make no difference.  So any ``LENGTH`` words in a row that two documents share are found.
Of the grams, ``GRAM`` words from each word on, a paragraph goes with its own: where the hash of ``SEED`` words is the
smallest among the ``GRAM_REACH`` that begin in it.  Equal paragraphs have equal
grams, so those whose gram no other document has are left aside, and neighbouring ones of one
gram are a row.  Of the grams that repeat a bitmap goes to the
tasks that read the texts again; a bit that stands for others as well makes more rows, never fewer.

Equal paragraphs are found by a hash of their shingles, beside that of their gram (128 bits).  One changed word in twenty leaves
little of a paragraph's shingles, so what is merely alike is looked for in long
paragraphs, of ``LONG`` words, at such starts of a wider ``LONG_REACH``.  (Sets of ``LONG`` words that are alike
by ``PERCENT`` lack six shingles at most, so most of them share ``LENGTH`` words in a row, wherever they begin.)  A long
paragraph's set of shingles of five words has ``BANDS`` bands of ``ROWS``
minimum hashes; at similarity 0.8 a pair shares a band with probability
1 - (1 - 0.8 ** ROWS) ** BANDS (see :func:`tuned`).  Those that differ
meet in a band, in the group of its smallest member, and exact Jaccard on their
whole sets verifies them.  Of a long paragraph the ``TRIM`` words at either end, which may be
others, do not go with it, but only as its passage goes on there.  Counts come before joins: a band with one paragraph
only, as nearly all are, goes no further than a bitmap of the others.
Components of what is alike are removed but for their first occurrence: a paragraph goes if its component
begins in a document with a smaller id.

Removed paragraphs of a document become one span if they overlap or touch, or
if they lie as far apart, by ``REACH`` words at most, in the one document that
both begin in.  From both ends a span goes on word by word, by up to ``CONTEXT`` words, as
long as that document goes on alike (:func:`alike_words`): up to ``EDITS`` words in a row may
differ if ``AGAIN`` equal ones follow, so passages with a few changed words go
as a whole.  The first document keeps its passage, and what repeats within one
document only stays.

NULL ids: the row stays as it is and removes nothing elsewhere.  NULL, empty
and short texts (under ``LENGTH`` words) have no paragraphs.  Rows with equal
ids are one document each by its text, and never lose a passage to each other.
Repeated rows of one id count as one document.  Of equal paragraphs in one
document the first counts.  Very long texts are read whole.  An empty table
gives no spans.  Only ``doc_id`` and ``text`` are read; other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunemill.llm.common import BROADCAST_ROWS, Shelf, keep_rows, stored
from tunemill.llm.components import components
from tunemill.llm.near import Hasher, links, mixed, signed
from tunemill.llm.secrets import BITMAP_BITS, BROADCAST_BYTES, has_bit

LENGTH, SEED, REACH = 20, 5, 31
GRAM = 10
GRAM_REACH = LENGTH - GRAM + 1
LONG, LONG_REACH = 60, 127
WORDS, PERCENT = 5, 80
RECALL = 0.95
TRIM = (LONG - WORDS + 1) * (100 - PERCENT) // (100 + PERCENT)
"""Shingles of a long paragraph that a similar one may lack: so many words at either end may be others."""
CONTEXT, EDITS, AGAIN = 80, 2, 4
MOST_BITS = 8 * BROADCAST_BYTES
"""Bits of the bitmap of grams at most; if it gets dense, more paragraphs are compared."""
CHUNK = 40_000
"""Words of many texts, or of one long text, that are looked at together; arrays of 200,000 took some 60 MB of a worker."""


def tuned(recall: float = RECALL, similarity: float = 0.8, rows: int = 3, most: int = 24) -> tuple[int, int]:
    """Bands and rows: the fewest bands of ``rows`` minimum hashes that reach the recall.

    Three rows keep apart paragraphs that merely hold the same common line,
    which share a fifth of their shingles: one in a hundred and fifty a band.
    """
    for bands in range(1, most):
        if 1 - (1 - similarity**rows) ** bands >= recall:
            return bands, rows
    raise ValueError("no number of bands reaches this recall")


BANDS, ROWS = tuned()
SALTS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


NEVER = np.uint64(2**64 - 1)


def least_seeds(hashes: np.ndarray, ends: np.ndarray, length: int, reach: int) -> tuple[np.ndarray, ...]:
    """Of each place the last one where a whole paragraph of its text fits, the text's first, the key of its seed, and the least key of ``reach`` places."""
    n = len(hashes) - length + 1
    seeds = mixed(sum(hashes[i : n + i] * np.uint64(2 * i + 3) for i in range(SEED)))
    place = np.arange(n, dtype=np.int64)
    last = ends[:n] - length  # where a whole paragraph fits for the last time
    # The upper 34 bits order the seeds; of equal ones the leftmost counts.
    keys = np.where(place <= last, (seeds >> np.uint64(30) << np.uint64(30)) | place.astype(np.uint64), NEVER)
    first = np.r_[True, ends[1:n] != ends[: n - 1]]
    begin = np.maximum.accumulate(np.where(first, place, 0))
    # The minimum of reach neighbours from those of 1, 2, 4, ... neighbours.
    least, width = keys, 1
    while 2 * width <= reach:
        least, width = np.minimum(least, np.r_[least[width:], np.full(min(width, n), NEVER)][:n]), 2 * width
    rest = reach - width
    least = np.minimum(least, np.r_[least[rest:], np.full(min(rest, n), NEVER)][:n])
    return place, last, begin, keys, least


def place_of(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64((1 << 30) - 1)).astype(np.int64)


def starts(hashes: np.ndarray, ends: np.ndarray, length: int = LENGTH, reach: int = REACH) -> np.ndarray:
    """Numbers of the words where paragraphs begin, for the words' hashes of several texts.

    ``ends`` has, for each word, the number of the first word of the next text.
    """
    if len(hashes) < length:
        return np.zeros(0, np.int64)
    place, last, begin, keys, least = least_seeds(hashes, ends, length, reach)
    found = least[place <= last - reach + 1]
    # A text with fewer places than reach is one window.
    short = np.flatnonzero((place == begin) & (place <= last) & (place > last - reach + 1))
    if len(short):
        edges = np.stack([short, last[short] + 1], axis=1).ravel()
        found = np.r_[found, np.minimum.reduceat(np.r_[keys, NEVER], edges)[::2]]
    return np.unique(place_of(found))


BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
"""A number for each byte."""
POWER = np.uint64(0xD6E8FEB86659FD93)
AT_ONCE = 1 << 14


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words at these places: sums of their bytes' numbers times powers by the place in the word."""
    made = [np.zeros(0, np.uint64)]
    sizes = ends - begins
    powers = np.full(int(sizes.max(initial=0)), POWER)
    powers[:1] = 1
    powers = np.multiply.accumulate(powers)
    for k in range(0, len(begins), AT_ONCE):
        first, n = begins[k : k + AT_ONCE], sizes[k : k + AT_ONCE]
        starts_at = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(starts_at, n)
        values = BYTES[data[np.repeat(first, n) + place]] * powers[place]
        made.append(mixed(np.add.reduceat(values, starts_at) + n.astype(np.uint64)))
    return np.concatenate(made)


class Words:
    """Of several texts: the words' hashes (A-Z in lower case), and their places in code points of their texts."""

    def __init__(self, texts: list[str], hasher: Hasher) -> None:
        data = np.frombuffer("\n".join(texts).encode("utf-8", "surrogatepass"), np.uint8)
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        space = np.ones(len(data) + 2, bool)
        space[1:-1] = (data == 32) | ((data >= 9) & (data <= 13))
        edges = np.flatnonzero(space[1:] != space[:-1])
        first, last = edges[::2], edges[1::2]
        self.hashes = word_hashes(data, first, last)
        self.shingles = hasher.shingles(self.hashes, WORDS)
        # Code points begin at every byte that does not continue one.
        points = np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)
        begins, ends = points[first] - 1, points[last - 1]
        texts_at = np.cumsum([0, *[len(t) + 1 for t in texts]])
        #: The number of each text's first word, and for each word that of the next text's first.
        self.bounds = np.searchsorted(begins, texts_at)
        sizes = np.diff(self.bounds)
        self.next = np.repeat(self.bounds[1:], sizes)
        shift = np.repeat(texts_at[:-1], sizes)
        self.begins, self.ends = begins - shift, ends - shift

    def around(self, text: int, at: int, n: int, right: bool) -> tuple[np.ndarray, np.ndarray]:
        """The up to ``CONTEXT`` words on one side of ``n`` words, outwards, and the code points each adds."""
        low, high = self.bounds[text], self.bounds[text + 1]
        at = low + at
        if right:
            last = at + n - 1
            until = min(high, last + 1 + CONTEXT)
            return self.hashes[last + 1 : until].astype(np.int32), np.diff(self.ends[last:until])
        first = max(low, at - CONTEXT)
        return self.hashes[first:at][::-1].astype(np.int32), -np.diff(self.begins[first : at + 1][::-1])


class Paragraphs:
    """Of several texts: where paragraphs of one length start (or those that do at ``places``), their shingles and places."""

    def __init__(self, words: Words, length: int = LENGTH, reach: int = REACH, places: np.ndarray | None = None) -> None:
        self.starts = starts(words.hashes, words.next, length, reach) if places is None else places
        n = length - WORDS + 1
        if len(self.starts):
            self.sets = np.lib.stride_tricks.sliding_window_view(words.shingles, n)[self.starts]
        else:
            self.sets = np.zeros((0, n), np.uint64)
        #: The text of each paragraph, and the number of its first word there.
        self.text = np.searchsorted(words.bounds, self.starts, side="right") - 1
        self.at = self.starts - words.bounds[self.text]
        cut = TRIM if length == LONG else 0
        self.begin, self.end = words.begins[self.starts + cut], words.ends[self.starts + length - 1 - cut]

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """``hash`` and ``more`` of each paragraph."""
        order = np.arange(1, self.sets.shape[1] + 1, dtype=np.uint64)
        one = mixed((self.sets * (2 * order + 1)).sum(axis=1, dtype=np.uint64))
        two = mixed((mixed(self.sets) * (2 * order + 1)).sum(axis=1, dtype=np.uint64))
        return signed(one), (two >> np.uint64(33)).astype(np.int32)

    def bands(self) -> np.ndarray:
        """A key for each paragraph and band."""
        # The shingles' hashes are well spread, so an odd factor orders them anew.
        keys = np.zeros((len(self.sets), BANDS), np.uint64)
        for band in range(BANDS):
            key = np.full(len(self.sets), band + 1, np.uint64)
            for row in range(ROWS):
                key = mixed(key * np.uint64(31) + (self.sets * SALTS[band * ROWS + row]).min(axis=1))
            keys[:, band] = key
        return keys


def chunks(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Neighbouring texts of some ``CHUNK`` words together, and the number of the first one."""
    held, size, first = [], 0, 0
    for i in range(len(texts)):
        held.append(texts[i].as_py() or "")
        size += len(held[-1]) // 6 + 1
        if size >= CHUNK:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def own_grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The places of all paragraphs of ``LENGTH`` words, and of the gram of each."""
    if len(words.hashes) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, last, _, _, least = least_seeds(words.hashes, words.next, GRAM, GRAM_REACH)
    whole = place <= last - GRAM_REACH + 1
    return place[whole], place_of(least[whole])


def grams(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``hash`` of each gram that a paragraph goes with; one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for first, texts in chunks(batch.column(1)):
                words = Words(texts, hasher)
                found = Paragraphs(words, GRAM, places=np.unique(own_grams(words)[1]))
                arrays = [pa.array(keys[first + found.text].astype(np.int64)), pa.array(found.hashes()[0])]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "hash"])

    return _texts(docs).mapInArrow(run, "doc_id bigint, hash bigint")


def repeated_grams(docs: DataFrame, shelf: Shelf) -> np.ndarray:
    """A bitmap, as bytes, in which the lower bits of the hashes of grams that several documents have are set."""
    ids = grams(docs).groupBy("hash").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"))
    hashes = shelf.put(ids.where(F.col("_first") < F.col("_last")).select("hash"))
    slots, n = BITMAP_BITS, hashes.count()
    while slots < min(16 * n, MOST_BITS):
        slots *= 2
    slot = F.col("hash").bitwiseAND(F.lit(slots - 1)) + 1  # Spark numbers bits from 1
    marked = hashes.select(F.bitmap_bucket_number(slot).alias("_bucket"), F.bitmap_bit_position(slot).alias("_bit"))
    bits = np.zeros((slots // BITMAP_BITS, BITMAP_BITS // 8), np.uint8)
    for bucket, made in marked.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit")).collect():
        bits[bucket - 1] = np.frombuffer(made, np.uint8)
    shelf.drop(hashes)
    return bits.ravel()


def compared(words: Words, bits: np.ndarray) -> tuple[Paragraphs, Paragraphs, np.ndarray]:
    """The paragraphs whose gram's bit is set, the grams in whose rows they are, and where each row begins among them (and the last one ends)."""
    at, gram = own_grams(words)
    places, of = np.unique(gram, return_inverse=True)
    slot = Paragraphs(words, GRAM, places=places).hashes()[0] & np.int64(8 * len(bits) - 1)
    hit = ((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 != 0)[of]
    at, gram = at[hit], gram[hit]
    first = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]][: len(gram)])
    return Paragraphs(words, LENGTH, places=at), Paragraphs(words, GRAM, places=gram[first]), np.r_[first, len(at)]


def paragraphs(docs: DataFrame, bits: Broadcast) -> DataFrame:
    """A row a long paragraph and a row a gram whose paragraphs may repeat, one pass.

    ``doc_id``, ``at`` (the first word's number), ``n`` (words of a paragraph) and ``hash``.  Of a long one ``start``, ``end``
    (without ``TRIM`` words at either end) and ``bands``; of a gram lists of the
    paragraphs from ``at`` on: ``codes`` (64 bits of their shingles), ``starts`` and ``ends``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        names = ["doc_id", "at", "n", "hash", "start", "end", "bands", "codes", "starts", "ends"]
        places, numbers = pa.list_(pa.int32()), pa.list_(pa.int64())

        def rows(keys: np.ndarray, at: np.ndarray, n: int, codes: np.ndarray, rest: list[pa.Array]) -> pa.RecordBatch:
            arrays = [pa.array(keys.astype(np.int64)), pa.array(at.astype(np.int32)), pa.array(np.full(len(at), n, np.int32)), pa.array(codes)]
            return pa.RecordBatch.from_arrays([*arrays, *rest], names=names)

        def lists(first: np.ndarray, values: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values))

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for first, texts in chunks(batch.column(1)):
                words = Words(texts, hasher)
                found = Paragraphs(words, LONG, LONG_REACH)
                bands = lists(BANDS * np.arange(len(found.at) + 1), signed(found.bands().ravel()))
                places_of = [pa.array(p.astype(np.int32)) for p in (found.begin, found.end)]
                none = [pa.nulls(len(found.at), t) for t in (numbers, places, places)]
                yield rows(keys[first + found.text], found.at, LONG, found.hashes()[0], [*places_of, bands, *none])
                found, of, begins = compared(words, bits.value)
                told = [lists(begins, v) for v in (found.hashes()[0], found.begin.astype(np.int32), found.end.astype(np.int32))]
                none = [pa.nulls(len(of.at), t) for t in (pa.int32(), pa.int32(), numbers)]
                yield rows(keys[first + of.text], found.at[begins[:-1]], LENGTH, of.hashes()[0], [*none, *told])

    schema = "doc_id bigint, at int, n int, hash bigint, start int, end int, bands array<bigint>, codes array<bigint>, starts array<int>, ends array<int>"
    return _texts(docs).mapInArrow(run, schema)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _merged(run, rows: int = 20_000):
    """Small batches put together."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in run(batches):
            held.append(batch)
            if len(held) >= 256 or sum(b.num_rows for b in held) >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held = []
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return merged


def _asked(docs: DataFrame, wanted: DataFrame, shelf: Shelf) -> DataFrame:
    """``doc_id``, ``text`` and the list ``wanted`` of the documents that something is wanted of."""
    lists = shelf.put(wanted.groupBy("doc_id").agg(F.collect_list(F.struct(*[c for c in wanted.columns if c != "doc_id"])).alias("wanted")))
    few = wanted.count() <= BROADCAST_ROWS
    return _texts(docs).join(F.broadcast(lists) if few else lists, "doc_id").select("doc_id", "text", "wanted")


def paragraph_sets(docs: DataFrame, wanted: DataFrame, shelf: Shelf) -> DataFrame:
    """``node`` and ``values`` (the set) of the wanted long paragraphs: ``doc_id``, ``at``, ``hash``.

    A document gets the list of what is wanted of it and gives back no more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            asked = batch.column(2).to_pylist()
            for first, texts in chunks(batch.column(1)):
                found = Paragraphs(Words(texts, hasher), LONG, LONG_REACH)
                places = {(t, a): k for k, (t, a) in enumerate(zip(found.text.tolist(), found.at.tolist()))}
                rows = [(w["hash"], places.get((i, w["at"]))) for i in range(len(texts)) for w in asked[first + i]]
                rows = [(node, k) for node, k in rows if k is not None]
                if rows:
                    values = [np.unique(signed(found.sets[k])) for _, k in rows]
                    nodes = pa.array([node for node, _ in rows], pa.int64())
                    yield pa.RecordBatch.from_arrays([nodes, pa.array(values, pa.list_(pa.int64()))], names=["node", "values"])

    return _asked(docs, wanted, shelf).mapInArrow(_merged(run), "node bigint, values array<bigint>")


def surroundings(docs: DataFrame, wanted: DataFrame, shelf: Shelf) -> DataFrame:
    """Of the wanted sides of paragraphs (``doc_id``, ``at``, ``n``, ``right``): ``ctx`` and ``sizes``.

    ``ctx`` has the words outwards (32 bits of each hash), ``sizes`` the code points they add.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        names = ["doc_id", "at", "n", "right", "ctx", "sizes"]
        for batch in batches:
            asked, keys = batch.column(2).to_pylist(), batch.column(0).to_pylist()
            for first, texts in chunks(batch.column(1)):
                words = Words(texts, hasher)
                # Rows of one id may have different texts: not all have this paragraph.
                here = [(i, w["at"], w["n"], w["right"]) for i in range(len(texts)) for w in asked[first + i]
                        if words.bounds[i] + w["at"] + w["n"] <= words.bounds[i + 1]]
                if not here:
                    continue
                sides = [words.around(*w) for w in here]
                offsets = pa.array(np.cumsum([0, *[len(ctx) for ctx, _ in sides]]).astype(np.int32))
                arrays = [
                    pa.array([keys[first + i] for i, *_ in here], pa.int64()),
                    pa.array([at for _, at, _, _ in here], pa.int32()),
                    pa.array([n for _, _, n, _ in here], pa.int32()),
                    pa.array([right for *_, right in here], pa.bool_()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([w for w, _ in sides]))),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([z for _, z in sides]).astype(np.int32))),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id bigint, at int, n int, right boolean, ctx array<int>, sizes array<int>"
    return _asked(docs, wanted, shelf).mapInArrow(_merged(run), schema)


def alike_words(a: np.ndarray, b: np.ndarray) -> int:
    """How many words of ``a`` go on as ``b`` does.

    Where they part, up to ``EDITS`` words of either side may be left out, the fewest
    that ``AGAIN`` equal words follow; words before the parting count in any case.
    """
    i = j = 0
    while True:
        n = min(len(a) - i, len(b) - j)
        same = a[i : i + n] == b[j : j + n]
        run = n if same.all() else int(same.argmin())
        i, j = i + run, j + run
        if run == n:
            return i
        ways = ((x, y) for total in range(1, 2 * EDITS + 1) for x in range(min(total, EDITS) + 1) for y in [total - x] if y <= EDITS)
        for x, y in ways:
            one, two = a[i + x : i + x + AGAIN], b[j + y : j + y + AGAIN]
            if len(one) == len(two) == AGAIN and (one == two).all():
                i, j = i + x, j + y
                break
        else:
            return i


def extensions(docs: DataFrame, ends: DataFrame, shelf: Shelf) -> DataFrame:
    """``ends`` with ``gain``, the code points by which each end's passage goes on.

    ``ends`` has ``doc_id``, ``span``, ``right`` and the paragraph at that end: ``at``, ``n``, ``first_doc_id`` and ``first_at``.
    """
    own = ends.select("doc_id", "at", "n", "right")
    other = ends.select(F.col("first_doc_id").alias("doc_id"), F.col("first_at").alias("at"), "n", "right")
    wanted = shelf.put(own.unionByName(other).distinct())
    # Rows of one id with different texts: any of them.
    sides = shelf.put(surroundings(docs, wanted, shelf).dropDuplicates(["doc_id", "at", "n", "right"]))
    there = sides.select(F.col("doc_id").alias("first_doc_id"), F.col("at").alias("first_at"), "n", "right", F.col("ctx").alias("other"))
    both = ends.join(sides, ["doc_id", "at", "n", "right"]).join(there, ["first_doc_id", "first_at", "n", "right"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gain = []
            for k in range(batch.num_rows):
                ctx, sizes, there = (batch.column(c)[k].values.to_numpy() for c in (3, 4, 5))
                gain.append(int(sizes[: alike_words(ctx, there)].sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(gain, pa.int32())], names=["doc_id", "span", "right", "gain"])

    columns = both.select("doc_id", "span", "right", "ctx", "sizes", "other")
    return columns.mapInArrow(run, "doc_id bigint, span bigint, right boolean, gain int")


def _met(made: DataFrame, shelf: Shelf) -> DataFrame:
    """``group`` and ``node`` of paragraphs that share a band with a different one: the group is the band's smallest."""
    keys = made.where(F.col("n") == LONG).select(F.col("hash").alias("node"), F.explode("bands").alias("band"))
    bands = keys.groupBy("band").agg(F.min("node").alias("group"), F.max("node").alias("_top"))
    bands = shelf.put(bands.where(F.col("group") < F.col("_top")).drop("_top"))
    n = bands.count()
    if n > BROADCAST_ROWS:
        # Nearly all bands have one paragraph: a bitmap keeps them from being moved again.
        slots = BITMAP_BITS
        while slots < 16 * n:
            slots *= 2
        if slots // 8 <= BROADCAST_BYTES:
            slot = F.pmod(F.xxhash64("band"), F.lit(slots)) + 1  # Spark numbers bits from 1
            marked = bands.select(F.bitmap_bucket_number(slot).alias("_bucket"), F.bitmap_bit_position(slot).alias("_bit"))
            maps = shelf.put(marked.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_map")))
            placed = keys.withColumn("_slot", slot).withColumn("_bucket", F.bitmap_bucket_number("_slot"))
            keys = placed.join(F.broadcast(maps), "_bucket").where(has_bit(F.col("_map"), F.col("_slot"))).select("node", "band")
    return shelf.put(keys.join(_small(bands), "band").select("group", "node").distinct())


def _equal(made: DataFrame) -> DataFrame:
    """What repeats word by word of earlier documents: ``doc_id``, ``at``, ``n``, ``start``, ``end``, ``first_doc_id`` and ``first_at``.

    All paragraphs of a gram are in one task, where those next to one another that
    are so in their first document as well become one row.
    """
    rows = made.where(F.col("n") == LENGTH).select("hash", "doc_id", "at", "codes", "starts", "ends").repartition("hash")
    each = rows.select("hash", "doc_id", F.col("at").alias("_row"), F.posexplode(F.arrays_zip("codes", "starts", "ends")).alias("_i", "_each"))
    each = each.select("hash", "doc_id", "_row", (F.col("_row") + F.col("_i")).alias("at"), "_each.*")
    same = Window.partitionBy("hash", "codes").orderBy("doc_id", "at")
    later = each.withColumn("_first", F.first(F.struct("doc_id", "at")).over(same)).where(F.col("_first.doc_id") < F.col("doc_id"))
    by = ["hash", "doc_id", "_row", F.col("_first.doc_id").alias("first_doc_id"), (F.col("_first.at") - F.col("at")).alias("_step")]
    runs = later.groupBy(*by).agg(
        F.min("at").alias("at"), F.max("at").alias("_last"), F.min("starts").alias("start"), F.max("ends").alias("end")
    )
    n = (F.col("_last") - F.col("at") + LENGTH).alias("n")
    return runs.select("doc_id", "at", n, "start", "end", "first_doc_id", (F.col("at") + F.col("_step")).alias("first_at"))


def _repeated(known: DataFrame, made: DataFrame, shelf: Shelf) -> DataFrame:
    """``_hash`` and the first occurrence, ``first_doc_id`` and ``first_at``, of long paragraphs that are alike across documents."""
    first = F.min(F.struct("doc_id", "at")).alias("_first")
    met = _met(made, shelf)
    nodes = shelf.put(met.select(F.col("node").alias("hash")).distinct())
    firsts = keep_rows(made.where(F.col("n") == LONG).select("hash", "doc_id", "at"), nodes, "hash").groupBy("hash").agg(first)
    firsts = shelf.put(firsts.select("hash", "_first.*"))
    # Rows of equal ids: any of them may give the set.
    sets = shelf.put(paragraph_sets(known, firsts, shelf).dropDuplicates(["node"]))
    joined = components(links(met, sets, PERCENT))
    alike = shelf.put(joined.join(firsts.select(F.col("hash").alias("node"), "doc_id", "at"), "node"))
    begins = alike.groupBy("component").agg(first)
    alike = alike.join(begins, "component").select(
        F.col("node").alias("_hash"), F.col("_first.doc_id").alias("first_doc_id"), F.col("_first.at").alias("first_at")
    )
    return shelf.put(alike)


def removals(docs: DataFrame) -> DataFrame:
    """What goes: ``doc_id``, ``start``, ``end`` (code points, end exclusive), ``first_doc_id``.

    ``first_doc_id`` is the smallest document that one of the span's paragraphs is first in.
    """
    known = docs.where(F.col("doc_id").isNotNull())
    shelf = Shelf(docs.sparkSession)
    bits = docs.sparkSession.sparkContext.broadcast(repeated_grams(known, shelf))
    made = shelf.put(paragraphs(known, bits))
    bits.unpersist()
    repeated = _repeated(known, made, shelf)
    place = ["doc_id", "at", "n", "start", "end"]
    firsts = ["first_doc_id", "first_at"]
    found = made.where(F.col("n") == LONG).join(_small(repeated), F.col("hash") == F.col("_hash")).where(F.col("first_doc_id") < F.col("doc_id"))
    trimmed = {"at": F.col("at") + TRIM, "first_at": F.col("first_at") + TRIM, "n": F.col("n") - 2 * TRIM}
    found = found.withColumns(trimmed).select(*place, *firsts).unionByName(_equal(made))
    first = F.min(F.struct(*firsts)).alias("_first")
    gone = shelf.put(found.groupBy(*place).agg(first).select(*place, "_first.*"))
    kept = [t for t, _ in shelf.paths.values() if t is not gone]
    shelf.drop(*kept)

    # Of one document alone: paragraphs that overlap, touch, or are as far apart in their first document.
    order = Window.partitionBy("doc_id").orderBy("at", "n", "start")
    before = lambda c: F.lag(c).over(order)
    step = F.col("at") - before("at")
    ended = F.max(F.col("at") + F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    shared = (before("first_doc_id") == F.col("first_doc_id")) & (step == F.col("first_at") - before("first_at"))
    joined = (F.col("at") <= ended) | ((F.col("at") <= ended + REACH) & shared)
    numbered = gone.withColumn("_begins", F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1)).withColumn(
        "span", F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    ends = numbered.groupBy("doc_id", "span").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.min("first_doc_id").alias("least"),
        F.min_by(F.struct("at", "n", "first_doc_id", "first_at"), F.struct("at", "n", "start")).alias("_left"),
        F.max_by(F.struct("at", "n", "first_doc_id", "first_at"), F.struct(F.col("at") + F.col("n"), "at", "start")).alias("_right"),
    )
    ends = shelf.put(ends)
    side = lambda name, right: ends.select("doc_id", "span", F.lit(right).alias("right"), f"{name}.*")
    gains = extensions(known, side("_left", False).unionByName(side("_right", True)), shelf)
    gains = gains.groupBy("doc_id", "span").agg(
        F.max(F.when(~F.col("right"), F.col("gain"))).alias("_before"), F.max(F.when(F.col("right"), F.col("gain"))).alias("_after")
    )
    zero = F.lit(0)
    wide = ends.join(gains, ["doc_id", "span"], "left").select(
        "doc_id",
        (F.col("start") - F.coalesce("_before", zero)).alias("start"),
        (F.col("end") + F.coalesce("_after", zero)).alias("end"),
        F.col("least").alias("first_doc_id"),
    )
    # Spans that overlap or touch, now that they are whole, are one.
    order = Window.partitionBy("doc_id").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reach + 1 >= F.col("start"), 0).otherwise(1)
    merged = wide.withColumn("_begins", begins).withColumn(
        "span", F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    spans = merged.groupBy("doc_id", "span").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("first_doc_id").alias("first_doc_id")
    )
    result = stored(spans.drop("span"))
    shelf.drop()
    return result


def _small(df: DataFrame) -> DataFrame:
    """A stored table of a few numbers a row, to be broadcast if it has at most ``BROADCAST_ROWS`` rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` with the spans cut out of ``text``, and ``_cut``: whether there was any.

    White space at a cut stays as it is.  Texts are not moved if the list of
    cuts is short.  Ids must be unique where spans are given, as they are after
    near-dedup.
    """
    spans = F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_gone")
    cuts = stored(gone.groupBy("doc_id").agg(spans))
    few = cuts.agg(F.sum(F.size("_gone") + 2)).first()[0] or 0
    whole = docs.select("doc_id", F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    joined = whole.join(F.broadcast(cuts) if few <= BROADCAST_ROWS else cuts, "doc_id", "left")
    text = F.col("_row").getField("text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("made"))

    def step(acc, span):
        piece = F.substring(text, acc["at"] + 1, F.greatest(F.lit(0), span["start"] - acc["at"]))
        return F.struct(span["end"].alias("at"), F.concat(acc["made"], piece).alias("made"))

    rest = lambda acc: F.concat(acc["made"], F.substring(text, acc["at"] + 1, F.length(text)))
    cut = F.when(F.col("_gone").isNull(), text).otherwise(F.aggregate("_gone", start, step, rest))
    others = [cut.alias(c) if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns]
    return joined.select(*others, F.col("_gone").isNotNull().alias("_cut"))
