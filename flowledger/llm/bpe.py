"""Byte-pair encoding with a public vocabulary: batched merge rounds in numpy, and decoding.

A batch of documents is normalised and split into words as the vocabulary file says. The different words of the batch
lie in one flat array of symbols. Each round looks up the rank of every neighbouring pair by binary search over the
sorted pair keys, takes the lowest rank of each word, and merges all its occurrences from left to right; words without
a pair to merge leave the array. The number of rounds is that of the longest chain of merges, not of the words.

Special tokens are cut out of the raw text first. Null texts count as empty; an empty text has no ids and decodes to
an empty text. Texts are encoded whole. Work is local to a batch, nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from flowledger.llm.common import chunks, runs_of

NO_RANK = np.iinfo(np.int32).max
# Different words a Python worker remembers before it begins anew; bounds its memory, not what is encoded.
KEPT_WORDS = 150_000
ENCODED_CHARS = 1_000_000  # texts encoded together


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else one from U+0100 upwards."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def _for_latin(pattern: str) -> re.Pattern:
    """The splitter's pattern with its classes listed for U+0000 to U+00FF, for the faster standard engine."""
    def listed(kind: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(256) if regex.match(kind, chr(c)))

    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        pattern = pattern.replace(kind, listed(kind))
    return re.compile(pattern)


class WordTokenizer:
    """Lower-case byte-level BPE with a suffix at word ends, read from a ``tokenizers`` JSON file."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as source:
            spec = json.load(source)
        model = spec["model"]
        steps = [step["type"] for step in spec["normalizer"]["normalizers"]]
        splitter, byte_level = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or not splitter["invert"] or byte_level["use_regex"] or spec["decoder"]:
            raise ValueError(f"{file} is no vocabulary of this kind")
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.tokens = {number: token for token, number in (vocab | self.special).items()}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.words = regex.compile(splitter["pattern"]["Regex"])
        self.latin_words = _for_latin(splitter["pattern"]["Regex"])
        self.known = _Known()
        letters = _byte_characters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + suffix] for c in letters], np.int64)
        pairs = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]], np.int64)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys)
        self.keys, self.rank, self.merged = keys[order], order.astype(np.int32), pairs[order, 2]

    def normalized(self, text: str) -> str:
        """NFC and lower case. White space needs no folding: the splitter drops all of it."""
        # every character is lowered by itself: no special form of sigma at word ends
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.words.findall(text)
        return self.latin_words.findall(text)

    def pieces(self, text: str) -> list[str]:
        """Words of the text in order; special tokens stand as they are."""
        found: list[str] = []
        for k, part in enumerate(self.split_special.split(text) if "<|" in text else [text]):
            found += [part] if k % 2 else self.split(self.normalized(part))
        return found

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words, one word after the other, and the start and number of ids of each."""
        if not words:
            return (np.zeros(0, np.int64),) * 3
        parts = [word.encode() for word in words]
        flat = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.array([len(part) for part in parts])
        ends = np.cumsum(sizes) - 1
        symbols = self.inner[flat]
        symbols[ends] = self.last[flat[ends]]
        owner = np.repeat(np.arange(len(words)), sizes)
        done = []
        while len(symbols):
            position, rank = self._ranks(symbols, owner)
            firsts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, firsts), np.diff(np.r_[firsts, len(owner)]))
            finished = lowest == NO_RANK
            if finished.any():
                done.append((owner[finished], symbols[finished]))
            hit = np.flatnonzero((rank == lowest) & ~finished)
            # of hits in a row (a a a …) every other one is merged, from the left
            new_run = np.r_[True, np.diff(hit) > 1][: len(hit)]
            start = np.maximum.accumulate(np.where(new_run, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - start) % 2 == 0]
            symbols[hit] = self.merged[position[hit]]
            stays = ~finished
            stays[hit + 1] = False
            symbols, owner = symbols[stays], owner[stays]
        owner = np.concatenate([part[0] for part in done])
        order = np.argsort(owner, kind="stable")
        counts = np.bincount(owner, minlength=len(words))
        return np.concatenate([part[1] for part in done])[order], np.cumsum(counts) - counts, counts

    def _ranks(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the sorted pair keys and rank of the pair that begins at each symbol."""
        keys = symbols.copy()
        keys[:-1] = symbols[:-1] << 32 | symbols[1:]
        position = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        rank = np.where(self.keys[position] == keys, self.rank[position], NO_RANK).astype(np.int32)
        rank[:-1][owner[1:] != owner[:-1]] = NO_RANK
        rank[-1] = NO_RANK
        return position, rank

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, list[str]]]:
        """Per text its ids and, word by word, the tokens they stand for."""
        if len(self.known.words) > KEPT_WORDS:
            self.forget()
        documents = [list(map(self.known.number.__getitem__, self.pieces(text))) for text in texts]
        self._learn()
        known = self.known
        return [
            (known.ids[runs_of(known.starts[words], known.counts[words])], list(map(known.names.__getitem__, words)))
            for words in documents
        ]

    def forget(self) -> None:
        """Drop the words merged so far; a worker that outlives its task must not keep them."""
        self.known = _Known()

    def _learn(self) -> None:
        """Merge the words that came up since the last call."""
        known = self.known
        first = len(known.names)
        words = known.words[first:]
        ids, starts, counts = self.merge(words)
        for token, number in self.special.items():  # never a word: the splitter cuts before a letter
            if first <= (where := known.number.get(token, -1)) < first + len(words):
                ids[starts[where - first]], counts[where - first] = number, 1
        tokens = list(map(self.tokens.__getitem__, ids.tolist()))
        known.names += [" ".join(tokens[a:b]) for a, b in zip(starts.tolist(), (starts + counts).tolist())]
        known.starts = np.concatenate([known.starts, starts + len(known.ids)])
        known.counts = np.concatenate([known.counts, counts])
        known.ids = np.concatenate([known.ids, ids])


class _Numbers(dict):
    """Word → number; a new word gets the next number."""

    def __init__(self, words: list[str]):
        self.words = words

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number


class _Known:
    """Words already merged, their ids in one flat array."""

    def __init__(self):
        self.words: list[str] = []
        self.number = _Numbers(self.words)
        self.names: list[str] = []
        self.ids = self.starts = self.counts = np.zeros(0, np.int64)


@lru_cache(maxsize=2)
def tokenizer(file: str) -> WordTokenizer:
    return WordTokenizer(file)


def vocabulary_file(name: str = "word_bpe_49k.json") -> str:
    """Where the installed package of public tokenizers keeps a vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoded(text: Column, file: str | None = None) -> Column:
    """Column of struct<ids: array<int>, decoded: string>; ``file`` must be readable on every executor."""

    @pandas_udf("ids array<int>, decoded string")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = tokenizer(file or vocabulary_file())
        for batch in batches:
            rows = [(ids.astype(np.int32), " ".join(words)) for part in chunks(batch, ENCODED_CHARS) for ids, words in bpe.encode(part)]
            columns = zip(*rows) if rows else ([], [])
            yield pd.DataFrame({name: pd.Series(values, dtype=object) for name, values in zip(("ids", "decoded"), columns)})
        bpe.forget()

    return encode(text)


def token_ids(text: Column, file: str | None = None) -> Column:
    """Column of array<int>: the ids alone, without the text they decode to."""

    @pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = tokenizer(file or vocabulary_file())
        for batch in batches:
            yield pd.Series([ids.astype(np.int32) for part in chunks(batch, ENCODED_CHARS) for ids, _ in bpe.encode(part)], dtype=object)
        bpe.forget()

    return encode(text)


def decoded(ids: Column, file: str | None = None) -> Column:
    """The text of an array of ids: tokens joined by blanks, as the vocabulary names no decoder. Null stays null."""

    @pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = tokenizer(file or vocabulary_file()).tokens
        for batch in batches:
            yield pd.Series([None if row is None else " ".join([tokens[i] for i in row.tolist()]) for row in batch], dtype=object)

    return decode(ids)


def digest(text: Column, file: str | None = None) -> Column:
    """Struct<n_tokens, ids_sha256, decoded_sha256> of each text, made where the ids are so that they don't travel."""

    @pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = tokenizer(file or vocabulary_file())
        for batch in batches:
            rows = [
                (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(" ".join(words).encode()).hexdigest())
                for part in chunks(batch, ENCODED_CHARS)
                for ids, words in bpe.encode(part)
            ]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
        bpe.forget()

    return digests(text)


def encode_documents(docs: DataFrame, file: str | None = None) -> DataFrame:
    """doc_id, ids, decoded of every row of ``docs`` (doc_id, text); other columns are left out."""
    return docs.select("doc_id", encoded(F.col("text"), file).alias("code")).select("doc_id", "code.ids", "code.decoded")


def token_report(docs: DataFrame, file: str | None = None) -> DataFrame:
    """doc_id, number of ids, digests of the ids and of the text decoded from them."""
    return docs.select("doc_id", digest(F.col("text"), file).alias("code")).select("doc_id", "code.*")
