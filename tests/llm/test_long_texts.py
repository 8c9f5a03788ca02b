"""Texts that no pattern may choke on: very many matches, and runs that begin a match everywhere."""

from __future__ import annotations

import hashlib
import re
import time

import pytest
from pyspark.sql import functions as F

from tunemill.llm import pii, secrets
from tunemill.llm.spans import apart, free, running

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
HEX = re.compile(r"[0-9a-f]{16,}")


def one(spark, text):
    return spark.createDataFrame([(1, text, "x", 0)], "doc_id bigint, text string, kind string, start int")


def digest(kind, spans):
    return hashlib.sha256(",".join(f"{kind}:{a}:{b}" for a, b in spans).encode()).hexdigest()


@pytest.mark.parametrize("text", ["a@" + "b." * 100_000 + "c", "a@b.c " * 20_000, "a [at] b dot c " * 5_000, "1 " * 100_000, "+1(" * 50_000])
def test_personal_data_in_long_texts(spark, text):
    began = time.time()
    row = pii.summary(pii.detect(one(spark, text))).collect()[0]
    if "@" in text:
        spans = [m.span() for m in EMAIL.finditer(text)]
        assert row["n_email"] == len(spans) and row["base_sha256"] == digest("email", spans)
    assert time.time() - began < 60


@pytest.mark.parametrize("text", ["eyJ" * 300_000, "eyJ" * 100_000 + ".eyJabcdefghi.abcdefghi", "0123456789abcdef " * 20_000, "AKIA" * 50_000, "token=" * 50_000])
def test_secrets_in_long_texts(spark, text):
    began = time.time()
    row = secrets.summary(secrets.scan(one(spark, text))).collect()[0]
    spans = [m.span() for m in HEX.finditer(text)]
    if spans:
        assert row["n_hex"] == len(spans) and row["base_sha256"] == digest("hex", spans)
    if text.endswith(".abcdefghi"):
        assert row["spans"] == f"web_token:0:{len(text)}"
    assert time.time() - began < 60


def test_a_run_of_two_parts_hides_no_token(spark):
    text = "eyJaaaaaaaa.eyJbbbbbbbb.eyJcccccccc.dddddddd eyJeeeeeeeeeee eyJffffffff.eyJgggggggg.short"
    want = [m.span() for m in re.finditer(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", text)]
    row = secrets.summary(secrets.scan(one(spark, text))).collect()[0]
    assert row["spans"] == ",".join(f"web_token:{a}:{b}" for a, b in want) and len(want) == 1


SPANS = "array<struct<start:int,kind:int,end:int>>"


def test_lists_of_any_length(spark):
    import random

    rng = random.Random(2)
    rows = []
    for n in (0, 1, 255, 256, 257, 700):
        make = lambda: [(s, rng.randint(0, 2), s + rng.randint(1, 9)) for s in (rng.randint(0, 4 * n + 5) for _ in range(n))]
        rows.append(([rng.randint(0, 5) for _ in range(n)], sorted(make()), make()))
    df = spark.createDataFrame(rows, f"v array<int>, s {SPANS}, o {SPANS}")
    made = df.select(
        "*",
        running(F.col("v"), 0, lambda x, y: x + y).alias("before"),
        apart(F.col("s")).alias("apart"),
        free(F.col("s"), F.col("o")).alias("free"),
        free(F.col("s"), F.col("o"), within=True).alias("out"),
    ).collect()
    for r in made:
        assert r.before == [sum(r.v[:i]) for i in range(len(r.v))]
        taken, at = [], 0
        for s in r.s:
            if s[0] >= at:
                taken.append(s)
                at = s[2]
        assert r["apart"] == taken
        meets = lambda s, o: o[0] < s[2] and s[0] < o[2]
        inside = lambda s, o: o[0] <= s[0] and s[2] <= o[2]
        assert sorted(map(tuple, r["free"])) == sorted(tuple(s) for s in r.s if not any(meets(s, o) for o in r.o))
        assert sorted(map(tuple, r["out"])) == sorted(tuple(s) for s in r.s if not any(inside(s, o) for o in r.o))
