"""Keys of finished rows, kept so that a new batch is held against few of them.

A manifest is a folder of three tables.  ``keys`` has the keys, in ``parts``
folders by a hash.  ``filters`` has a Bloom filter for each part, cut into
``blocks`` bitmaps: a key has one block and ``PROBES`` bits in it.  ``shape``
says how many parts and blocks there are, and of what types the keys.  A batch is joined with the filters
by part and block; only keys that a filter lets pass are compared, and only
the parts they lie in are opened.  So the answer is exact, and rows that are
really new cost some twenty bits a recorded key and no more.

Filters are written before keys: if a job dies in between, the filter lets
keys pass that are not there, which are pending as they should be.  A batch
that is recorded again adds the same keys, which changes nothing.  Each record
adds a file a part; :func:`compact` brings them together and makes room for more.

A row with a NULL in its key is never done and is not recorded.  More keys
than were expected make the filters let more through, never the answer wrong.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.session import work_folder
from tunemill.sources.publish import Folders, publish

PARTS = 256
BITS = 32_768
PROBES = 10
FILTERS = "part int, block int, bits binary"
KEYS_A_BLOCK = 1_600
"""At twenty bits a key, one new key in some ten thousand passes a filter."""


class Manifest:
    """The manifest in ``folder`` for the columns ``key``; made by the first :meth:`record`."""

    def __init__(
        self, spark: SparkSession, folder: str, key: Sequence[str], expected: int = 1_000_000, parts: int = PARTS
    ) -> None:
        self.spark, self.folder, self.key = spark, folder.rstrip("/"), list(key)
        self.parts, self.blocks = parts, _blocks(expected, parts)
        if self.exists():
            self.parts, self.blocks, _ = self._shape()

    def _shape(self) -> tuple[int, int, str]:
        return self.spark.read.parquet(f"{self.folder}/shape").first()

    def exists(self) -> bool:
        return Folders(self.spark).exists(f"{self.folder}/shape")

    def keys(self) -> DataFrame:
        """All recorded keys, a column ``part`` beside them."""
        return self.spark.read.schema(self._shape()[2]).parquet(f"{self.folder}/keys")

    def _whole(self, df: DataFrame) -> DataFrame:
        """The keys of ``df`` without NULLs."""
        return df.select(*self.key).dropna(subset=self.key)

    def _placed(self, keys: DataFrame, blocks: int) -> DataFrame:
        return keys.select(
            *self.key,
            _number(self.key, "part", self.parts).alias("part"),
            _number(self.key, "block", blocks).alias("block"),
        )

    def record(self, done: DataFrame) -> None:
        """Add the keys of ``done``."""
        if self.exists():
            _same_types(self.keys(), done, self.key)
        self._add(self._whole(done).distinct(), self.folder)

    def _add(self, keys: DataFrame, folder: str) -> None:
        placed = self._placed(keys, self.blocks)
        probes = F.array(*[_number(self.key, str(i), BITS) for i in range(PROBES)])
        bits = placed.select("part", "block", F.explode(probes).alias("bit"))
        filters = bits.groupBy("part", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
        filters.write.mode("append").parquet(f"{folder}/filters")
        placed.drop("block").repartition("part").write.mode("append").partitionBy("part").parquet(f"{folder}/keys")
        types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema.fields) + ", part int"
        shape = self.spark.createDataFrame([(self.parts, self.blocks, types)], "parts int, blocks int, keys string")
        shape.coalesce(1).write.mode("overwrite").parquet(f"{folder}/shape")

    def suspects(self, df: DataFrame) -> DataFrame:
        """The distinct keys of ``df`` that a filter lets pass, with their ``part``."""
        filters = self.spark.read.schema(FILTERS).parquet(f"{self.folder}/filters").select(
            F.col("part").alias("_part"), F.col("block").alias("_block"), "bits"
        )
        placed = self._placed(self._whole(df), self.blocks).distinct()
        passes = (F.col("part") == F.col("_part")) & (F.col("block") == F.col("_block"))
        for i in range(PROBES):
            passes = passes & _is_set(F.col("bits"), _number(self.key, str(i), BITS))
        return placed.join(filters, passes, "left_semi").drop("block")

    def not_done(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` whose key is not recorded."""
        if not self.exists():
            return df
        _same_types(self.keys(), df, self.key)
        folder = f"{work_folder(self.spark)}/suspects-{uuid.uuid4().hex}"
        self.suspects(df).write.parquet(folder)
        suspects = self.spark.read.parquet(folder)
        found = suspects.join(self.opened(suspects), [*self.key, "part"], "left_semi")
        return df.join(found.drop("part"), self.key, "left_anti")

    def opened(self, suspects: DataFrame) -> DataFrame:
        """The recorded keys of the parts that ``suspects`` lie in; no other part is read."""
        touched = [row.part for row in suspects.select("part").distinct().collect()]  # numbers below ``parts``
        folder = f"{self.folder}/keys"
        there = set(Folders(self.spark).names(folder))
        paths = [f"{folder}/part={part}" for part in touched if f"part={part}" in there]
        if not paths:
            return self.keys().where(F.lit(False))
        return self.spark.read.schema(self.keys().schema).option("basePath", folder).parquet(*paths)

    def compact(self, expected: int | None = None, parts: int | None = None) -> None:
        """Write the manifest anew, a file a part and a filter row a block; the old one stays until then."""
        keys = self.keys().select(*self.key).distinct()
        self.parts = parts or self.parts
        self.blocks = _blocks(expected, self.parts) if expected else self.blocks
        publish(self.spark, self.folder, lambda folder: self._add(keys, folder))


def _blocks(expected: int, parts: int) -> int:
    return max(1, -(-expected // (parts * KEYS_A_BLOCK)))


def _number(key: Sequence[str], salt: str, limit: int) -> Column:
    """A hash of the key below ``limit``, another one for each ``salt``."""
    return F.pmod(F.xxhash64(F.lit(salt), *[F.col(k) for k in key]), F.lit(limit)).cast("int")


def _is_set(bits: Column, at: Column) -> Column:
    byte = F.substring(bits, F.shiftright(at, 3) + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(at, F.lit(8))) == 1


def _same_types(keys: DataFrame, df: DataFrame, key: Sequence[str]) -> None:
    """Hashes of values of different types differ, so a key of another type would never be found."""
    for name in key:
        if keys.schema[name].dataType != df.schema[name].dataType:
            raise ValueError(
                f"{name} is {df.schema[name].dataType.simpleString()}, "
                f"recorded as {keys.schema[name].dataType.simpleString()}"
            )
