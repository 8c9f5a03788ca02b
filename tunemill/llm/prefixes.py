"""The trie of all beginnings of conversations, from SQL ROLLUP over columns of turns.

A conversation is cut into blocks of ``WIDTH`` turns; a block is a row whose
columns hold the turns' identities in order.  ``GROUP BY block, key, ROLLUP
(t1, ..., tn)`` then gives a group for every beginning of every block at once,
and ``grouping_id`` says how many turns it has.  ``key`` is the node that the
block before ends in, so blocks of long conversations are grouped in the same
statement as first ones, however many there are.

A turn's identity is a pair of 64-bit hashes of its role, text and position; a
node's key is the exclusive or of those on its path.  The texts are read once,
and only hashes and word counts move.

Sums over subtrees need no walk through the trie.  Each node is *owned* by its
smallest member.  What a member owns lies at the end of its own path, so for a
node v all that members other than its smallest one own lies below v, and the
smallest one owns its path from v on.  Adding up members therefore adds up
nodes: the second ROLLUP does so for words and for childless nodes.

Hot spots: a conversation may hold a third of all turns: positions are
numbered in stretches, blocks are chained in stretches of ``STRETCH``.  A
beginning may be common to a third of all conversations: groups combine before
the shuffle, parents with ``HOT`` children and more are joined apart, and lists of
members are joined in pieces of ``PIECE`` ids and hashed as a stream.  (SHA-256 has to read
a node's ids in order, so that stream is one task's.)

Order of turns: by ``turn``, NULL first; turns of one number by the hash of
role and text; rows that are wholly alike are turns each.  NULL role or text:
empty.  NULL ``conv_id``: no conversation.  An empty table has no nodes.  Very
long texts are hashed whole.  Other columns are not read and may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunemill.llm.common import BROADCAST_ROWS, stored
from tunemill.operators.ordering import running_total

WIDTH = 8
MIXED, HEADS = 20, 4
LARGE = 1 << 16
"""Turns that one task may sort as one conversation."""
STRETCH, PIECE, HOT = 1024, 4096, 1000
WORD = r"[^\x20\x09-\x0D]+"


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``digest`` (hex, of role and text) and ``words`` of each turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )


def numbered(each: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), ``digest`` and ``words``; ``each`` is stored."""
    columns = ["conv_id", "pos", "digest", "words"]
    large = stored(each.groupBy("conv_id").count().where(F.col("count") > LARGE).select("conv_id"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    number = F.row_number().over(order).cast("bigint").alias("pos")
    if large.isEmpty():
        return each.select("conv_id", number, "digest", "words").select(*columns)
    # At most one conversation in LARGE rows is large.
    small = each.join(F.broadcast(large), "conv_id", "left_anti").select("conv_id", number, "digest", "words")
    rows = each.join(F.broadcast(large), "conv_id")
    alike = rows.groupBy("conv_id", "turn", "digest").agg(F.count("*").alias("_n"), F.max("words").alias("words"))
    # NULL turns first: below every number.
    alike = alike.withColumns(
        {
            "_known": F.col("turn").isNotNull().cast("int"),
            "_turn": F.coalesce("turn", F.lit(0).cast("bigint")),
            "_stretch": F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(0).cast("bigint")),
            "_digits": F.substring("digest", 1, 4),
        }
    )
    levels = ["_known", "_stretch", "_turn", "_digits"]
    placed = running_total(alike, F.col("_n"), levels, [F.col("digest")], "_last", group=["conv_id"])
    start, last = F.col("_last") - F.col("_n") + 1, F.col("_last")
    pieces = placed.select("conv_id", "digest", "words", "_last", F.explode(F.sequence(start, last, F.lit(LARGE))).alias("_from"))
    until = F.least(F.col("_from") + LARGE - 1, F.col("_last"))
    many = pieces.select("conv_id", F.explode(F.sequence("_from", until)).alias("pos"), "digest", "words")
    return small.select(*columns).unionByName(many.select(*columns))


def rebuilt(places: DataFrame) -> DataFrame:
    """Conversations that begin as the first of their ``MIXED`` does; ``places`` is stored.

    The first h turns of conversation c - c % 20, then the own ones after the
    first h.  A row of position 0 stands for each conversation itself.
    """
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % HEADS).cast("bigint")
    convs = stored(places.select("conv_id").distinct().select("conv_id", (c - c % MIXED).alias("_base"), h.alias("_h")))
    heads = stored(places.where(F.col("pos") < HEADS).withColumnRenamed("conv_id", "_base"))
    given = convs.join(heads, "_base").where(F.col("pos") <= F.col("_h"))
    short = heads.groupBy("_base").agg(F.count("*").alias("_m"))
    missing = F.col("_h") - F.coalesce("_m", F.lit(0).cast("bigint"))
    gaps = stored(convs.join(short, "_base", "left").where(missing > 0).select("conv_id", missing.alias("_gap")))
    gaps = F.broadcast(gaps) if gaps.count() <= BROADCAST_ROWS else gaps
    own = places.where(F.col("pos") > h).join(gaps, "conv_id", "left")
    own = own.withColumn("pos", F.col("pos") - F.coalesce("_gap", F.lit(0).cast("bigint")))
    none = convs.select("conv_id", F.lit(0).cast("bigint").alias("pos"), F.lit("").alias("digest"), F.lit(0).cast("bigint").alias("words"))
    columns = ["conv_id", "pos", "digest", "words"]
    return given.select(*columns).unionByName(own.select(*columns)).unionByName(none)


def blocks(rows: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """The blocks and, per conversation, its length, words and end node.

    A block has ``conv_id``, ``block``, its turns ``t1`` to ``t<width>``, the
    key (``a``, ``b``) of the node before it, the conversation's ``len`` and
    ``rest``, the words from the block's beginning to the conversation's end.
    """
    named = rows.select(
        "conv_id",
        "pos",
        "words",
        F.when(F.col("pos") > 0, F.xxhash64("digest", "pos")).otherwise(0).alias("a"),
        F.when(F.col("pos") > 0, F.xxhash64("pos", "digest", F.lit("second"))).otherwise(0).alias("b"),
    )
    block = F.floor(F.greatest(F.col("pos") - 1, F.lit(0)) / width).cast("bigint")
    turn = F.struct("a", "b", "words")
    slots = [F.max(F.when(F.col("pos") == F.col("block") * width + k, turn)).alias(f"t{k}") for k in range(1, width + 1)]
    sums = [F.bit_xor("a").alias("x"), F.bit_xor("b").alias("y"), F.sum("words").alias("words")]
    made = named.withColumn("block", block).groupBy("conv_id", "block").agg(*slots, *sums, F.max("pos").alias("len"))
    made = stored(made)
    ends = made.groupBy("conv_id").agg(
        F.bit_xor("x").alias("end_a"), F.bit_xor("y").alias("end_b"), F.sum("words").alias("all"), F.max("len").alias("len")
    )
    ends = stored(ends)

    # What comes before a block: sums of whole stretches, then of the blocks of its own one.
    stretch = F.floor(F.col("block") / STRETCH).cast("bigint")
    made = made.drop("len").withColumn("_stretch", stretch)
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    coarse = before(Window.partitionBy("conv_id").orderBy("_stretch"))
    fine = before(Window.partitionBy("conv_id", "_stretch").orderBy("block"))
    zero = F.lit(0).cast("bigint")
    whole = made.groupBy("conv_id", "_stretch").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("words").alias("words"))
    whole = whole.select(
        "conv_id",
        "_stretch",
        F.coalesce(F.bit_xor("x").over(coarse), zero).alias("_x"),
        F.coalesce(F.bit_xor("y").over(coarse), zero).alias("_y"),
        F.coalesce(F.sum("words").over(coarse), zero).alias("_words"),
    )
    own = [F.coalesce(f(c).over(fine), zero).alias(f"_{c}_own") for f, c in ((F.bit_xor, "x"), (F.bit_xor, "y"), (F.sum, "words"))]
    placed = made.select("*", *own).join(whole, ["conv_id", "_stretch"]).join(ends, "conv_id")
    return placed.select(
        "conv_id",
        "block",
        *[f"t{k}" for k in range(1, width + 1)],
        F.col("_x_own").bitwiseXOR(F.col("_x")).alias("a"),
        F.col("_y_own").bitwiseXOR(F.col("_y")).alias("b"),
        "len",
        (F.col("all") - F.col("_words_own") - F.col("_words")).alias("rest"),
    ), ends


def beginnings(rows: DataFrame, measures: str, width: int = WIDTH) -> DataFrame:
    """One row a node: ``depth``, its key, its parent's, ``words`` of its last turn, ``before`` of the block's turns before that.

    ``measures`` are aggregates over the members' rows of the node's block.
    """
    columns = [f"t{k}" for k in range(1, width + 1)]
    grouped = rows.sparkSession.sql(
        f"SELECT block, a, b, {', '.join(columns)}, {width} - bit_count(grouping_id()) AS d, {measures} "
        f"FROM {{rows}} GROUP BY block, a, b, ROLLUP ({', '.join(columns)})",
        rows=rows,
    )
    # Conversations that have ended are among the groups too: their last column is NULL.
    path = F.array(*columns)
    last = F.when(F.col("d") > 0, F.get(path, F.col("d") - 1))
    kept = grouped.where(F.when(F.col("d") == 0, F.col("block") == 0).otherwise(last.isNotNull()))

    def over(name: str, first: Column, joined) -> Column:
        return reduce(joined, [F.coalesce(F.col(f"{c}.{name}"), F.lit(0).cast("bigint")) for c in columns], first)

    node = [over(c, F.col(c), lambda x, y: x.bitwiseXOR(y)) for c in ("a", "b")]
    zero = F.lit(0).cast("bigint")
    words = F.coalesce(last.getField("words"), zero)
    others = [c for c in grouped.columns if c not in {"block", "a", "b", "d", *columns}]
    return kept.select(
        (F.col("block") * width + F.col("d")).cast("bigint").alias("depth"),
        node[0].alias("a"),
        node[1].alias("b"),
        node[0].bitwiseXOR(F.coalesce(last.getField("a"), zero)).alias("parent_a"),
        node[1].bitwiseXOR(F.coalesce(last.getField("b"), zero)).alias("parent_b"),
        words.alias("words"),
        (over("words", zero, lambda x, y: x + y) - words).alias("before"),
        *others,
    )


def member_hashes(ends: DataFrame) -> DataFrame:
    """``depth``, ``a``, ``b`` and ``ends_sha256`` of the nodes that conversations end in."""
    keys = ["depth", "a", "b"]
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    named = ends.select(F.col("len").alias("depth"), F.col("end_a").alias("a"), F.col("end_b").alias("b"), "conv_id")
    pieces = named.groupBy(*keys, F.floor(F.col("conv_id") / PIECE).alias("piece")).agg(F.concat_ws(",", ids).alias("ids"))
    sorted_pieces = pieces.repartition(*keys).sortWithinPartitions(*keys, "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*keys, "ends_sha256"]
        now, sha = None, None
        for batch in batches:
            done = []
            columns = [batch.column(k).to_pylist() for k in range(3)]
            for *key, ids in zip(*columns, batch.column(4).to_pylist()):
                if key == now:
                    sha.update(b"," + ids.encode())
                else:
                    if now is not None:
                        done.append((*now, sha.hexdigest()))
                    now, sha = key, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*now, sha.hexdigest())], names=names)

    return sorted_pieces.mapInArrow(run, "depth bigint, a bigint, b bigint, ends_sha256 string")


def nodes(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """The trie of ``rows``: ``conv_id``, ``pos`` (0 for the conversation itself), ``digest`` and ``words``."""
    placed, ends = blocks(rows, width)
    placed = stored(placed)
    first = beginnings(placed, "min(conv_id) AS conv_id, max(len) AS longest", width)
    childless = (F.col("longest") == F.col("depth")).cast("bigint")
    owned = first.groupBy("conv_id").agg(
        F.min("depth").alias("own"), F.sum("words").alias("owned"), F.max(childless).alias("leaf")
    )
    owned = stored(owned)
    zero = F.lit(0).cast("bigint")
    full = placed.join(owned, "conv_id", "left").withColumns(
        {"owned": F.coalesce("owned", zero), "leaf": F.coalesce("leaf", zero)}
    )
    sums = "min(struct(conv_id, rest, owned, own)) AS least, count(*) AS n_convs, sum(rest) AS rest, sum(owned) AS owned, sum(leaf) AS n_leaves"
    found = beginnings(full, sums, width)
    every = F.col("rest") - F.col("n_convs") * F.col("before")
    once = F.col("owned") - F.col("least.owned") + F.col("least.rest") - F.col("before")
    found = stored(
        found.select(
            "depth", "a", "b", "parent_a", "parent_b", "n_convs", "n_leaves",
            F.col("least.conv_id").alias("conv_id"), F.col("least.own").alias("own"), (every - once).alias("saved_tokens"),
        )
    )

    # Children and hashes of members join the nodes by one grouping.
    keys = ["depth", "a", "b"]
    values = {"parent_a": "bigint", "parent_b": "bigint", "n_convs": "bigint", "n_leaves": "bigint", "conv_id": "bigint",
              "own": "bigint", "saved_tokens": "bigint", "n_children": "bigint", "ends_sha256": "string"}
    shaped = lambda df: df.select(*keys, *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in values.items()])
    children = found.where(F.col("depth") > 0).groupBy((F.col("depth") - 1).alias("depth"), "parent_a", "parent_b")
    children = children.agg(F.count("*").alias("n_children"))
    children = children.select("depth", F.col("parent_a").alias("a"), F.col("parent_b").alias("b"), "n_children")
    parts = shaped(found).unionByName(shaped(children)).unionByName(shaped(member_hashes(ends)))
    whole = stored(parts.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values]))

    # A node whose smallest member owns its parent too has that member's number there; the others are one a conversation at most.
    branch = (F.col("own") == F.col("depth")) & (F.col("depth") > 0)
    hot = F.col("n_children") >= HOT
    parent = lambda df: df.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("conv_id").alias("parent_conv_id"))
    up = ["depth", "parent_a", "parent_b"]
    most = stored(parent(whole.where(hot)))
    few = most.count() <= BROADCAST_ROWS
    apart = whole.where(branch).join(F.broadcast(most) if few else most, up, "left")
    rest = apart.where(F.col("parent_conv_id").isNull()).drop("parent_conv_id").join(parent(whole.where(~hot | hot.isNull())), up)
    own = F.when(F.col("depth") > 0, F.col("conv_id")).alias("parent_conv_id")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    joined = [whole.where(~branch).withColumn("parent_conv_id", own), apart.where(F.col("parent_conv_id").isNotNull()), rest]
    all_nodes = reduce(DataFrame.unionByName, [df.select(*columns) for df in joined])
    return all_nodes.withColumns(
        {
            "n_children": F.coalesce("n_children", zero),
            "ends_sha256": F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())),
        }
    )


def trie(conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """The trie of the rebuilt conversations, a row a node."""
    return nodes(stored(rebuilt(stored(numbered(stored(turns(conversations)))))), width)


ORACLE_SQL = r"""
WITH RECURSIVE bits AS (
    SELECT range AS b, list_reduce(
        list_prepend(range::UBIGINT, [0::UBIGINT,0,0,0,0,0,0,0]),
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS v
    FROM range(256)
), crc AS (SELECT list(v ORDER BY b) AS t FROM bits
), each AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), places AS (
    SELECT conv_id, length(role) || ':' || role || text AS id,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS pos
    FROM each
), convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base,
        (xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
            lambda c, x: xor(c >> 8, t[((xor(c, x) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) % 4)::BIGINT AS h
    FROM (SELECT DISTINCT conv_id FROM places), crc
), bases AS (
    SELECT c.conv_id, c.h, count(p.pos) AS m FROM convs c LEFT JOIN places p ON p.conv_id = c.base AND p.pos <= c.h GROUP BY ALL
), built AS (
    SELECT c.conv_id, p.pos, p.id, p.words FROM convs c JOIN places p ON p.conv_id = c.base AND p.pos <= c.h
    UNION ALL
    SELECT p.conv_id, p.pos - b.h + b.m, p.id, p.words FROM places p JOIN bases b ON p.conv_id = b.conv_id AND p.pos > b.h
), paths AS (
    SELECT conv_id, pos AS depth, words, list(id) OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM built
    UNION ALL SELECT conv_id, 0, 0, [] FROM convs
), lengths AS (SELECT conv_id, max(depth) AS len FROM paths GROUP BY conv_id
), grouped AS (
    SELECT path, p.depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words, max(len) AS longest,
        sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (len = p.depth), '')) AS ends_sha256
    FROM paths p JOIN lengths l ON p.conv_id = l.conv_id GROUP BY path, p.depth
), above AS (
    SELECT list_slice(path, 1, k) AS path, (longest = depth)::BIGINT AS leaf, (n_convs - 1) * words AS saved
    FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM grouped)
), below AS (SELECT path, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY path
), children AS (SELECT list_slice(path, 1, depth - 1) AS path, count(*) AS n FROM grouped WHERE depth > 0 GROUP BY 1)
SELECT g.conv_id, g.depth, CASE WHEN g.depth > 0 THEN p.conv_id END AS parent_conv_id, g.n_convs,
    coalesce(c.n, 0) AS n_children, b.n_leaves, b.saved_tokens, g.ends_sha256
FROM grouped g JOIN below b ON b.path = g.path LEFT JOIN children c ON c.path = g.path
LEFT JOIN grouped p ON g.depth > 0 AND p.path = list_slice(g.path, 1, g.depth - 1)
"""
