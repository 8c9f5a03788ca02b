"""Byte-pair encoding by a walk over a trie of words, and decoding.

The distinct words of a batch form a trie of byte characters.  A node stands
for a prefix; its state is the last token of the prefix's encoding.  That one
token is enough: the encoding of ``prefix`` ends in ``token`` exactly if
``token`` is a suffix of it and may follow the last token of what is left.  So a
depth-first walk computes each shared prefix once, and a word's encoding is
read off backwards along its path.

Two tokens may follow each other if merging the symbols of both by rank gives
just these two again; that is remembered per pair.

The tokenizer file is one with word ends: text is normalised (NFC, white space
runs to one space, lower case) and split by its pattern, and the last character
of a word carries the suffix for ends.  Special tokens in a text are cut out
before that.  A NULL text is an empty one and has no tokens; a NULL id stays.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_CACHED_WORDS = 400_000
"""Words a worker remembers; it then starts anew, which changes no result."""

BATCH_CHARS = 4_000_000
"""Characters of text after which a batch is encoded, however few its rows."""


def byte_characters() -> list[str]:
    """The printable character of each byte: itself if it has one, else one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class TrieEncoder:
    """Encodes words given as strings of byte characters."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str) -> None:
        self.vocab, self.end = vocab, end
        self.ranks = {tuple(m): i for i, m in enumerate(merges)}
        self.tokens = {i: t for t, i in vocab.items()}
        self.symbols = {i: self._symbols(t) for i, t in self.tokens.items()}
        self.reachable = {i for i, s in self.symbols.items() if self._merge(s) == [i]}
        self.inner = {self.tokens[i]: i for i in self.reachable if not self.tokens[i].endswith(end)}
        self.final = {
            self.tokens[i].removesuffix(end): i for i in self.reachable if self.tokens[i].endswith(end)
        }
        self.inner_lengths, self.final_lengths = self._lengths(self.inner), self._lengths(self.final)
        self.follows: dict[int, bool] = {}

    @staticmethod
    def _lengths(tokens: dict[str, int]) -> dict[str, list[int]]:
        """The lengths of tokens by their last two characters, longest first."""
        found: dict[str, set[int]] = {}
        for token in tokens:
            found.setdefault(token[-2:], set()).add(len(token))
        for end in list(found):  # a single character may end any word
            if len(end) == 2 and end[-1] in tokens:
                found[end].add(1)
        return {end: sorted(lengths, reverse=True) for end, lengths in found.items()}

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(self.end) and token != self.end:
            body = token.removesuffix(self.end)
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def _merge(self, symbols: list[str]) -> list[int]:
        """Merging by rank, lowest first and leftmost among equals: for short strings only."""
        symbols = list(symbols)
        while len(symbols) > 1:
            ranks = [self.ranks.get(pair, 1 << 60) for pair in zip(symbols, symbols[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            at = ranks.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return [self.vocab.get(s, -1) for s in symbols]

    def _may_follow(self, first: int, second: int) -> bool:
        pair = first << 32 | second
        known = self.follows.get(pair)
        if known is None:
            if len(self.follows) > MAX_CACHED_WORDS:
                self.follows.clear()
            known = self._merge(self.symbols[first] + self.symbols[second]) == [first, second]
            self.follows[pair] = known
        return known

    def encode(self, words: list[str]) -> list[list[int]]:
        """The tokens of each word, in the order given.

        In sorted order, words that share a prefix stand together: the stack
        ``path`` is the walk's way down, cut back to the prefix shared with the
        word before.  ``path[n]`` is the last token after ``n`` characters and
        its length.
        """
        made: dict[str, list[int]] = {}
        path: list[tuple[int, int]] = [(-1, 0)]
        before = ""
        for word in sorted(set(words)):
            shared = 0
            for a, b in zip(before[:-1], word[:-1]):
                if a != b:
                    break
                shared += 1
            shared = min(shared, len(path) - 1)
            del path[shared + 1 :]
            for n in range(shared + 1, len(word)):
                path.append(self._last(word, n, path, self.inner, self.inner_lengths))
            token, length = self._last(word, len(word), path, self.final, self.final_lengths)
            tokens, n = [token], len(word) - length
            while n > 0:
                token, length = path[n]
                tokens.append(token)
                n -= length
            made[word] = tokens[::-1]
            before = word
        return [made[w] for w in words]

    def _last(
        self,
        word: str,
        n: int,
        path: list[tuple[int, int]],
        tokens: dict[str, int],
        lengths: dict[str, list[int]],
    ) -> tuple[int, int]:
        for length in lengths.get(word[max(0, n - 2) : n], (1,)):
            if length > n:
                continue
            token = tokens.get(word[n - length : n])
            if token is not None:
                left = path[n - length][0]
                if left < 0 or self._may_follow(left, token):
                    return token, length
        raise ValueError(f"the vocabulary lacks the byte characters of {word!r}")


class WordTokenizer:
    """A tokenizer file of the kind described above: texts to token numbers and back.

    ``known`` has of each word the numbers as little-endian bytes and the
    tokens' strings joined by spaces, so that a text is two joins.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.trie = TrieEncoder(model["vocab"], merges, model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.pattern = regex.compile(data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.characters = byte_characters()
        self.names = dict(self.trie.tokens) | {i: t for t, i in self.special.items()}
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, bytes] = {}
        self.shown: dict[str, str] = {}
        for text, number in self.special.items():  # never a word: the pattern parts < and letters
            self._remember(text, [number])

    def _remember(self, word: str, tokens: list[int]) -> None:
        self.known[word] = np.array(tokens, "<u4").tobytes()
        self.shown[word] = " ".join([self.names[t] for t in tokens])

    def _words(self, text: str) -> list[str]:
        """The words of a text, and its special tokens."""
        if "<|" not in text:
            return self.pattern.findall(normalized(text))
        words: list[str] = []
        for i, piece in enumerate(self.cut.split(text)):
            words += [piece] if i % 2 else self.pattern.findall(normalized(piece))
        return words

    def encode_batch(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Of each text the token numbers as little-endian bytes, and the decoded text."""
        if len(self.known) > MAX_CACHED_WORDS:
            self._forget()
        split = [self._words(text) for text in texts]
        unknown: set[str] = set()
        for words in split:
            unknown.update(set(words).difference(self.known))
        new = list(unknown)
        spelled = ["".join([self.characters[b] for b in w.encode("utf-8")]) for w in new]
        for word, tokens in zip(new, self.trie.encode(spelled)):
            self._remember(word, tokens)
        known, shown = self.known.__getitem__, self.shown.__getitem__
        return [(b"".join(map(known, words)), " ".join(map(shown, words))) for words in split]


def normalized(text: str) -> str:
    """NFC and lower case, each character by itself; the pattern treats white space alike, be it one or many."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()


_loaded: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


def encode_decode(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", rows: int = 512
) -> DataFrame:
    """``key``, ``ids`` (little-endian unsigned 32-bit numbers) and ``decoded`` of each text.

    Row by row, without a shuffle.  ``vocabulary`` is a path that every
    executor can open.  Up to ``rows`` texts form a batch that shares a trie;
    very long texts make smaller ones (``BATCH_CHARS``).
    """
    return _run(
        docs, vocabulary, key, text, rows, "ids binary, decoded string",
        [pa.binary(), pa.string()], lambda ids, shown: (ids, shown),
    )


def digests(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", rows: int = 512
) -> DataFrame:
    """``key``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``: :func:`encode_decode`, hashed in place."""

    def hashed(ids: bytes, shown: str) -> tuple[int, str, str]:
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(shown.encode()).hexdigest()

    return _run(
        docs, vocabulary, key, text, rows, "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        [pa.int64(), pa.string(), pa.string()], hashed,
    )


def _run(docs, vocabulary, key, text, rows, schema, types, form) -> DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = tokenizer(vocabulary)

        def made(ids: list, texts: list[str]) -> pa.RecordBatch:
            columns = zip(*[form(*pair) for pair in tool.encode_batch(texts)])
            arrays = [pa.array(values, kind) for values, kind in zip(columns, types)]
            return pa.RecordBatch.from_arrays([pa.array(ids, key_type), *arrays], names=[key, *names])

        for batch in batches:
            key_type = batch.schema.field(0).type
            ids, texts, size = [], [], 0
            for i in range(batch.num_rows):
                ids.append(batch.column(0)[i].as_py())
                texts.append(batch.column(1)[i].as_py() or "")
                size += len(texts[-1])
                if len(texts) == rows or size > BATCH_CHARS:
                    yield made(ids, texts)
                    ids, texts, size = [], [], 0
            if texts:
                yield made(ids, texts)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).alias("_text")).mapInArrow(run, f"`{key}` {kind}, {schema}")
