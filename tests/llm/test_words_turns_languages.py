"""Spelling variants, the trie of conversations and languages against plain versions of them, and on odd input."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tunemill.llm import language, prefixes, spelling

SF = "/root/testdata/sf0.001"


# --- spelling variants ----------------------------------------------------------


def plain_words(rows, least=7):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain_variants(words):
    """Each word is compared with every other that has a letter deleted as it may have itself."""
    cut = defaultdict(set)
    for w in words:
        for v in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            cut[v].add(w)
    near = defaultdict(set)
    for group in cut.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (n, len(near[w]), form[w], words.get(form[w]), root(w)) for w, n in words.items()}


def found_variants(df):
    made = spelling.variants(df).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len(made) == len({r["word"] for r in made})
    return {r["word"]: tuple(r)[1:] for r in made}


def test_variants_equal_the_plain_ones(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert found_variants(docs.repartition(5)) == plain_variants(plain_words(rows))


def test_variants_of_repetitive_and_long_words(spark):
    rng = random.Random(3)
    words = ["a" * k for k in range(7, 14)] + ["ab" * k for k in range(4, 8)] + ["x" * 30_000, "x" * 30_001, "y" + "x" * 30_000]
    words += ["".join(rng.choice("abé") for _ in range(rng.randint(7, 10))) for _ in range(700)]
    rows = [(i, " ".join(rng.sample(words, 300)), "s") for i in range(12)]
    rows += [(5, "aaaaaaa " * 400, "s"), (5, "aaaaaaa " * 400, "s"), (None, "bbbbbbb bbbbbbb", "s"), (7, None, "s"), (8, "", "s")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, word string").withColumnRenamed("word", "n")
    got = found_variants(df)
    assert got == plain_variants(plain_words([r[:2] for r in rows]))
    assert any(v[4] != w and v[2] != v[4] for w, v in got.items()) or any(v[2] for v in got.values())


def test_forms_are_followed_to_the_last(spark):
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "zzzzzzzz": 5, "zzzzzzzy": 50, "zzzzzzzx": 50}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    known = spelling.forms(words, spelling.near_pairs(words))
    assert {r["word"]: r["form"] for r in known.collect()}["zzzzzzzz"] == "zzzzzzzx"
    ends = {r["word"]: r["root"] for r in spelling.roots(known).collect()}
    assert ends == {"abcdefg": "abcdefghij", "abcdefgh": "abcdefghij", "abcdefghi": "abcdefghij", "zzzzzzzz": "zzzzzzzx"}


def test_no_words_no_variants(spark):
    for rows in ([], [(1, None), (2, ""), (3, "short words only")]):
        assert found_variants(spark.createDataFrame(rows, "doc_id bigint, text string")) == {}


# --- the trie of conversations --------------------------------------------------


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, digest), role, text))
    own = {c: [t[1:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:]
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, v in sorted(built.items()):
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
            if d:
                children[tuple(v[: d - 1])].add(tuple(v[:d]))
        ends[tuple(v)].append(c)
    leaves, saved = Counter(), Counter()
    for node, who in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(who) - 1) * words
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return sorted(
        (w[0], len(p), members[p[:-1]][0] if p else -1, len(w), len(children[p]), leaves[p], saved[p], sha(ends[p]))
        for p, w in list(members.items())
    )


def found_trie(df, **more):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rows = prefixes.trie(df, **more).select(*columns).collect()
    return sorted(tuple(-1 if v is None else v for v in r) for r in rows)


TURNS = "conv_id bigint, turn bigint, role string, text string, digest string"


def odd_turns():
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", "", None]), "d")
            for c in range(-45, 60) for t in range(rng.randint(1, 6))]
    rows += [(None, 0, "user", "lost", "d"), (3, None, "system", "first", "d"), (3, None, "system", "also first", "d")]
    rows += [(1000, 7, "user", "same", "d")] * 9 + [(1001, t % 5, "user", f"w{t % 3} " * 3, "d") for t in range(40)]
    return rows + [(1003, 0, "user", "long " * 40_000, "d"), (1021, -4, "user", "before", "d")]


def test_trie_equals_the_plain_one(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert found_trie(table) == plain_trie(rows)


@pytest.mark.parametrize("width", [1, 3, 8])
def test_trie_of_odd_turns(spark, width, monkeypatch):
    for name, value in {"LARGE": 6, "STRETCH": 2, "HOT": 3, "PIECE": 4}.items():
        monkeypatch.setattr(prefixes, name, value)
    rows = odd_turns()
    assert found_trie(spark.createDataFrame(rows, TURNS).repartition(7), width=width) == plain_trie([r[:4] for r in rows])


def test_trie_of_nothing(spark):
    assert found_trie(spark.createDataFrame([], TURNS)) == []
    assert found_trie(spark.createDataFrame([(None, 1, "a", "b", "c")], TURNS)) == []


# --- languages ------------------------------------------------------------------


class PlainModel:
    """Counts in dictionaries, contexts tried one after another."""

    def __init__(self, texts, order):
        self.order, self.follow = order, defaultdict(Counter)
        for text in texts:
            data = bytes(order) + text.encode()
            for i in range(order, len(data)):
                for k in range(order + 1):
                    self.follow[data[i - k : i]][data[i]] += 1

    def bits(self, text):
        data, total = bytes(self.order) + text.encode(), 0.0
        for i in range(self.order, len(data)):
            for k in range(self.order, -1, -1):
                seen = self.follow.get(data[i - k : i])
                if not seen:
                    continue
                whole = sum(seen.values()) + len(seen)
                if data[i] in seen:
                    total -= math.log2(seen[data[i]] / whole)
                    break
                total -= math.log2(len(seen) / whole)
            else:
                total += 8
        return total


LEARN = [("en", "the cat and the dog"), ("en", "a thing of the sea"), ("fr", "le chat et le chien été"), ("de", "der Hund und die Kühe")]


@pytest.mark.parametrize("order", [1, 4])
def test_code_lengths_equal_the_plain_ones(spark, order, monkeypatch):
    model = language.fit(spark.createDataFrame(LEARN, "lang string, text string").repartition(3), order=order)
    assert model.langs == ["de", "en", "fr"]
    plain = [PlainModel([t for x, t in LEARN if x == lang], order) for lang in model.langs]
    texts = ["the dog", "", "zzz 中", "le chien", "Und die the été " * 50, "\x00\x00a"]
    want = np.array([[m.bits(t) for m in plain] for t in texts])
    assert np.allclose(model.bits(texts), want, rtol=1e-5)
    monkeypatch.setattr(language, "PIECE", 7)
    assert np.allclose(model.bits(texts), want, rtol=1e-5)


def test_languages_of_odd_texts(spark):
    rows = [(i, text, lang, "x") for i, (lang, text) in enumerate(LEARN * 3)]
    rows += [(None, "the dog", "xx", "x"), (90, None, "en", "x"), (91, "", "en", "x"), (92, "12 34!", "en", "x"), (93, "the cat", None, "x")]
    rows += [(94, "the dog and " * 60_000, "en", "x"), (93, "the cat", None, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    got = language.identify(df.repartition(4)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert {by[k]["lang_pred"] for k in (90, 91, 92)} == {"und"} and by[92]["score"] == 0.0
    assert by[93]["lang_pred"] == by[94]["lang_pred"] == by[None]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in got) and by[None]["held_out"] is False
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got if r["doc_id"] is not None)


def test_nothing_learned_is_unknown(spark):
    df = spark.createDataFrame([(1, "words", None), (2, None, "en")], "doc_id bigint, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in language.identify(df).collect()} == {("und", 0.0)}
    assert language.identify(df.limit(0)).count() == 0


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    made = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert made.where("lang = lang_pred").count() >= 0.97 * made.count() > 0
