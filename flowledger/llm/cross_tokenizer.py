"""Alignment of two tokenizers' tokens of the same texts: a byte-level BPE (A) and a sentencepiece BPE (B).

A encodes a blank followed by the text, B the text, before which it puts a blank itself; special tokens are not added
and their strings in a text are plain text. The library's character offsets of A's tokens and the spans of B's pieces (of
the encoded proto) are coarse cuts: where a token ends at a character and the next one begins there, the end is known.
Tokens that share a character (parts of a multibyte character, byte-fallback pieces) are placed between coarse cuts by
the length of their decoded bytes. Byte offsets at which tokens of both end cut them into groups; an A and a B token are
linked if their byte ranges overlap.

A text has no tokens if it is null, empty, or if the joined bytes of A's or B's tokens are not the blank and the text
(B writes a blank for U+2581). Texts are read whole. Work is done once for each different word of a batch: both
tokenizers end a token before every blank that stands between two characters that are no white space, so words cut
there are encoded alike alone and in their text. Words seen are kept, KEPT_WORDS at most.

Every text's links are written once. How often each pair of ids is linked is counted over all texts (pre-aggregated in
every task, then summed). The table of pairs is bounded by the vocabularies; at most PAIRS_SENT of its rows go to the
tasks at a time, by ranges of B ids, and a document's sums over its links are added up range after range.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowledger.llm.bpe import _byte_characters, vocabulary_file
from flowledger.llm.common import chunks, fresh_name, runs_of, staged

BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
KEPT_WORDS = 400_000
KEPT_PAIRS = 1_000_000  # pairs a task adds up before it passes them on
ENCODED_CHARS = 1_000_000  # characters of texts handled together
LINE_WORDS = 32  # words encoded in one call: long texts cost more a character
PAIRS_SENT = 2_000_000
_BLANK = "▁"  # stands for a blank in pieces
_ODD = re.compile(r"\s | \s")


def words_of(text: str) -> list[str]:
    """The text, not empty, cut at every blank between two characters that are no white space; the blanks are left out."""
    parts = text.split(" ")
    if parts[0] and parts[-1] and not _ODD.search(text):
        return parts
    words, last = [], ""
    for part in parts:
        if words and (not last or last[-1].isspace() or not part or part[0].isspace()):
            words[-1] += " " + part
        else:
            words.append(part)
        last = part
    return words


class Tokens(NamedTuple):
    """Tokens of some lines, one line after the other: ids, the byte each ends at, counted over all lines, and how many
    tokens each line has."""

    ids: np.ndarray
    ends: np.ndarray
    counts: np.ndarray

    def bytes_of_lines(self, table: list[bytes]) -> list[bytes]:
        ids, ends = self.ids.tolist(), np.cumsum(self.counts).tolist()
        return [b"".join(map(table.__getitem__, ids[i:j])) for i, j in zip([0] + ends, ends)]


class Words:
    """Everything known about the words learned so far; words have numbers."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.good = np.zeros(0, bool)
        self.sizes = np.zeros((0, 4), np.int64)  # tokens of A, tokens of B, groups, links
        self.links = np.zeros(0, np.int64)  # A id << 32 | B id, word after word
        self.groups: list[str] = []


class Aligner:
    """Aligns words; remembers them."""

    def __init__(self, byte_file: str, piece_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        with open(byte_file, encoding="utf-8") as text:
            spec = json.load(text)
        before = spec["pre_tokenizer"]
        if spec["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"]:
            raise ValueError(f"{byte_file} is no byte-level vocabulary of this kind")
        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        byte_of = {character: byte for byte, character in enumerate(_byte_characters())}
        self.a_bytes = [b""] * (max(self.a.get_vocab(True).values()) + 1)
        for token, number in spec["model"]["vocab"].items():
            self.a_bytes[number] = bytes(byte_of[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(_BLANK in piece.lstrip(_BLANK) for piece in pieces):
            raise ValueError(f"{piece_file} has pieces that reach over a blank")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.names = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.id_type = "<u2" if len(self.names) <= 1 << 16 else "<u4"
        self.known = Words()

    # Tokens and where they end

    def _tokens_a(self, lines: list[str], at: np.ndarray, starts: np.ndarray) -> Tokens:
        """``at``: byte offset of each character of all lines; ``starts``: first character of each line."""
        coded = self.a.encode_batch([" " + line for line in lines], add_special_tokens=False)
        spans = [c.offsets for c in coded]
        counts = np.array([len(s) for s in spans])
        ids = np.fromiter(chain.from_iterable(c.ids for c in coded), np.int64, int(counts.sum()))
        flat = np.fromiter(chain.from_iterable(chain.from_iterable(spans)), np.int64, 2 * len(ids))
        spans = flat.reshape(-1, 2) + np.repeat(starts, counts)[:, None]
        following = np.r_[spans[1:, 0], spans[-1:, 1]]
        coarse = following >= spans[:, 1]  # else the next token begins inside the same character
        return Tokens(ids, _refined(at[spans[:, 1]], coarse, self.a_sizes[ids], at[starts], counts), counts)

    def _tokens_b(self, lines: list[str], starts: np.ndarray) -> Tokens:
        """``starts``: first byte of each line, that of its blank. Spans are byte offsets in the text behind the blank."""
        coded = self.b.encode(lines, return_type="proto", num_threads=1)
        rows = [[(p.id, p.begin, p.end) for p in c.pieces] for c in coded]
        counts = np.array([len(row) for row in rows])
        flat = np.fromiter(chain.from_iterable(chain.from_iterable(rows)), np.int64, 3 * int(counts.sum())).reshape(-1, 3)
        ids, begin, end = flat[:, 0], flat[:, 1], flat[:, 2]
        last = np.zeros(len(ids), bool)
        last[np.cumsum(counts)[counts > 0] - 1] = True
        # all byte pieces of a character but the last have empty spans, and so has a piece for the blank alone
        coarse = (end > begin) & (last | (np.r_[begin[1:], 0] >= end))
        return Tokens(ids, _refined(end + np.repeat(starts, counts) + 1, coarse, self.b_sizes[ids], starts, counts), counts)

    # Words

    def learn(self, words: list[str]) -> None:
        """Adds new, different words to those known."""
        plain = [w for w in words if not w[0].isspace() and not w[-1].isspace()]
        lines = [plain[i : i + LINE_WORDS] for i in range(0, len(plain), LINE_WORDS)]
        lines += [[w] for w in words if w[0].isspace() or w[-1].isspace()]
        for part in _bounded(lines):
            failed = self._learn(part)
            single = [[w] for line in failed if len(line) > 1 for w in line]
            bad = [line[0] for line in failed if len(line) == 1]
            for alone in _bounded(single):
                bad += [line[0] for line in self._learn(alone)]
            self._add(bad, np.zeros(len(bad), bool), np.zeros((len(bad), 4), np.int64), np.zeros(0, np.int64), [""] * len(bad))

    def _learn(self, lines: list[list[str]]) -> list[list[str]]:
        """Adds the words of the lines whose bytes both tokenizers give back; returns the other lines."""
        texts = [" ".join(line) for line in lines]
        data = [b" " + text.encode() for text in texts]
        char_counts = np.array([len(text) + 1 for text in texts])
        char_starts = np.cumsum(char_counts) - char_counts
        byte_counts = np.array([len(d) for d in data])
        byte_starts = np.cumsum(byte_counts) - byte_counts
        flat = np.frombuffer(b"".join(data), np.uint8)
        at = np.r_[np.flatnonzero((flat & 0xC0) != 0x80), len(flat)]
        a, b = self._tokens_a(texts, at, char_starts), self._tokens_b(texts, byte_starts)
        same = [x == y == z for x, y, z in zip(data, a.bytes_of_lines(self.a_bytes), b.bytes_of_lines(self.b_bytes))]
        if not all(same):
            whole = [line for line, fits in zip(lines, same) if fits]
            return [line for line, fits in zip(lines, same) if not fits] + (self._learn(whole) if whole else [])
        words = [word for line in lines for word in line]
        word_ends = np.cumsum([len(word.encode()) + 1 for word in words])
        both = np.sort(np.concatenate([a.ends, b.ends]), kind="stable")
        again = np.r_[False, both[1:] == both[:-1]]
        cuts = both[again]
        if not (cuts[np.minimum(np.searchsorted(cuts, word_ends), len(cuts) - 1)] == word_ends).all():
            raise ValueError("a token reaches over the blank between two words")
        # between two neighbouring ends lies the overlap of just one A and one B token
        starts = np.r_[0, both[~again][:-1]]
        links = a.ids[np.searchsorted(a.ends, starts, "right")] << 32 | b.ids[np.searchsorted(b.ends, starts, "right")]
        edges = [np.searchsorted(points, word_ends, "right") for points in (a.ends, b.ends, cuts)]
        edges.append(np.searchsorted(starts, word_ends, "left"))
        sizes = np.stack([np.diff(e, prepend=0) for e in edges], axis=1)
        a_names = list(map(self.names.__getitem__, a.ids.tolist()))
        b_names = list(map(self.names.__getitem__, b.ids.tolist()))
        a_cut, b_cut = np.searchsorted(a.ends, cuts, "right").tolist(), np.searchsorted(b.ends, cuts, "right").tolist()
        groups = [
            f"{a_names[i]}|{b_names[k]}" if j - i == 1 == m - k else f"{','.join(a_names[i:j])}|{','.join(b_names[k:m])}"
            for i, j, k, m in zip([0] + a_cut, a_cut, [0] + b_cut, b_cut)
        ]
        ends = edges[2].tolist()
        self._add(words, np.ones(len(words), bool), sizes, links, [";".join(groups[i:j]) for i, j in zip([0] + ends, ends)])
        return []

    def _add(self, words: list[str], good: np.ndarray, sizes: np.ndarray, links: np.ndarray, groups: list[str]) -> None:
        known = self.known
        known.numbers.update(zip(words, range(len(known.groups), len(known.groups) + len(words))))
        known.groups += groups
        known.good = np.r_[known.good, good]
        known.links = np.r_[known.links, links]
        known.sizes = np.concatenate([known.sizes, sizes])

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words, text after text, and how many words each text has. Empty texts have none."""
        split = [words_of(text) if text else [] for text in texts]
        numbers = self.known.numbers
        new = set(chain.from_iterable(split)).difference(numbers)
        if new:
            self.learn(list(new))
        counts = np.array([len(words) for words in split], np.int64)
        return np.fromiter(map(numbers.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum())), counts

    def full(self) -> bool:
        return len(self.known.groups) > KEPT_WORDS

    def forget(self) -> None:
        self.known = Words()


def _refined(ends: np.ndarray, coarse: np.ndarray, sizes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Where tokens end: as given at coarse cuts, elsewhere the token's size behind the end of the token before it."""
    total = np.cumsum(sizes)
    first = (np.cumsum(counts) - counts)[counts > 0]
    base = total - sizes  # bytes before the token
    known = np.full(len(sizes), -1)
    anchor = np.zeros(len(sizes), np.int64)
    anchor[first] = starts[counts > 0] - base[first]
    known[first] = first
    after = np.flatnonzero(coarse[:-1]) + 1
    anchor[after] = ends[after - 1] - base[after]
    known[after] = after
    return np.where(coarse, ends, total + anchor[np.maximum.accumulate(known)])


def _bounded(lines: list[list[str]], chars: int = 200_000) -> Iterator[list[list[str]]]:
    part, size = [], 0
    for line in lines:
        part.append(line)
        size += sum(map(len, line))
        if size > chars:
            yield part
            part, size = [], 0
    if part:
        yield part


@lru_cache(maxsize=2)
def aligner(byte_file: str, piece_file: str) -> Aligner:
    return Aligner(byte_file, piece_file)


def _files(files: tuple[str, str] | None) -> tuple[str, str]:
    return files or (vocabulary_file(BYTE_FILE), vocabulary_file(PIECE_FILE))


def _summed(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``; 0 for an empty run."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), np.int64), np.cumsum(values, axis=0)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _whole(known: Words, numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether both tokenizers give back the bytes of all of a text's words, and there are any."""
    return (counts > 0) & (_summed(~known.good[numbers] * 1, counts) == 0)


SIZES = ("n_a", "n_b", "n_groups", "n_links")
LINKED = [("doc_id", pa.int64()), *[(name, pa.int64()) for name in SIZES], ("groups_sha256", pa.string()), ("links", pa.binary())]
LINKED_SCHEMA = "doc_id long, " + ", ".join(f"{name} long" for name in SIZES) + ", groups_sha256 string, links binary"


def link_documents(docs: DataFrame, files: tuple[str, str] | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): sizes of its alignment, a digest of its groups, and all its links in text order,
    as pairs of two-byte ids (of four bytes if a vocabulary has more than 2^16)."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = aligner(*_files(files))
        for batch in batches:
            rows: list[tuple] = []
            for texts in chunks(batch.column(1).to_pylist(), ENCODED_CHARS):
                if words.full():
                    words.forget()
                numbers, counts = words.numbers(texts)
                known = words.known
                kept = _whole(known, numbers, counts)
                each = known.sizes[:, 3]
                flat = known.links[runs_of((np.cumsum(each) - each)[numbers], each[numbers])]
                pairs = np.stack([flat >> 32, flat & 0xFFFFFFFF], axis=1).astype(words.id_type)
                sizes = _summed(known.sizes[numbers], counts)
                ends = np.cumsum(sizes[:, 3])
                data = [pairs[i:j].tobytes() if whole else b"" for i, j, whole in zip((ends - sizes[:, 3]).tolist(), ends.tolist(), kept.tolist())]
                rows += zip((sizes * kept[:, None]).tolist(), _digests(known, numbers, counts, kept), data)
            columns = np.array([row[0] for row in rows], np.int64).reshape(-1, len(SIZES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c) for c in columns.T.copy()], pa.array([row[1] for row in rows], pa.string()), pa.array([row[2] for row in rows], pa.binary())],
                schema=pa.schema(LINKED),
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(linked, LINKED_SCHEMA)


def _keys(batch: pa.RecordBatch, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The links of the rows as A id << 32 | B id, and how many each row has."""
    rows = batch.column(0).to_pylist()
    pairs = np.frombuffer(b"".join(rows), kind).reshape(-1, 2).astype(np.int64)
    return pairs[:, 0] << 32 | pairs[:, 1], np.array([len(row) for row in rows], np.int64) // (2 * np.dtype(kind).itemsize)


def link_counts(linked: DataFrame, files: tuple[str, str] | None = None) -> DataFrame:
    """(a, b, n, best): how often each pair of ids is linked over all rows of ``linked`` (links), and whether no other A id
    is linked to b more often."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = aligner(*_files(files)).id_type
        keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def sums() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys >> 32, pa.int32()), pa.array(keys & 0xFFFFFFFF, pa.int32()), pa.array(n)], names=["a", "b", "n"])

        for batch in batches:
            new, times = np.unique(_keys(batch, kind)[0], return_counts=True)
            both = np.concatenate([keys, new])
            order = np.argsort(both, kind="stable")
            both, times = both[order], np.concatenate([n, times])[order]
            first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]][: len(both)])
            keys, n = both[first], np.add.reduceat(times, first) if len(first) else first
            if len(keys) > KEPT_PAIRS:
                yield sums()
                keys, n = keys[:0], n[:0]
        yield sums()

    partial = linked.select("links").mapInArrow(counted, "a int, b int, n long")
    pairs = partial.groupBy("a", "b").agg(F.sum("n").alias("n"))
    return pairs.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def id_ranges(pairs: DataFrame, most: int = PAIRS_SENT) -> list[tuple[int, int]]:
    """Ranges [first, last] of B ids with at most ``most`` pairs each (or one id). Only a count for each B id, at most
    the size of B's vocabulary, reaches the driver."""
    ranges, room = [], 0
    for row in sorted(pairs.groupBy("b").count().collect()):
        if not ranges or row["count"] > room:
            ranges.append((row.b, row.b))
            room = most
        ranges[-1] = (ranges[-1][0], row.b)
        room -= row["count"]
    return ranges


class _Pairs(NamedTuple):
    keys: np.ndarray
    n: np.ndarray
    best: np.ndarray


def _pairs(pairs: DataFrame, first: int, last: int) -> _Pairs:
    rows = pairs.filter(F.col("b").between(first, last)).toArrow()
    keys = rows["a"].to_numpy().astype(np.int64) << 32 | rows["b"].to_numpy()
    order = np.argsort(keys)
    return _Pairs(keys[order], rows["n"].to_numpy()[order], rows["best"].to_numpy()[order].astype(bool))


def _with_sums(linked: DataFrame, pairs: _Pairs, files: tuple[str, str] | None) -> DataFrame:
    """Adds the sums over the links to the given pairs to n_best and count_sum."""
    sent = linked.sparkSession.sparkContext.broadcast(pairs)
    names = linked.columns

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, table = aligner(*_files(files)).id_type, sent.value
        for batch in batches:
            keys, counts = _keys(batch.select(["links"]), kind)
            place = np.minimum(np.searchsorted(table.keys, keys), max(len(table.keys) - 1, 0))
            there = table.keys[place] == keys if len(table.keys) else np.zeros(len(keys), bool)
            values = np.zeros((len(keys), 2), np.int64)
            values[there] = np.stack([table.best[place[there]], table.n[place[there]]], axis=1)
            more = dict(zip(("n_best", "count_sum"), _summed(values, counts).T))
            columns = [pa.array(batch[name].to_numpy() + more[name]) if name in more else batch[name] for name in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return linked.mapInArrow(summed, linked.schema)


def alignment_report(docs: DataFrame, files: tuple[str, str] | None = None, most: int = PAIRS_SENT) -> DataFrame:
    """Sizes of every document's alignment and sums over its links, one row per row of ``docs`` (doc_id, text).

    Texts are encoded once; their links are written and read again to be counted and looked up.
    """
    linked = staged(link_documents(docs, files), "linked")
    pairs = staged(link_counts(linked, files), "link-counts")
    rows = linked.withColumns({name: F.lit(0).cast("long") for name in ("n_best", "count_sum")})
    for number, (first, last) in enumerate(id_ranges(pairs, most)):
        rows = _with_sums(staged(rows, "link-sums") if number else rows, _pairs(pairs, first, last), files)
    return rows.select("doc_id", *SIZES, "n_best", "count_sum", "groups_sha256")


def _texts_of_groups(known: Words, numbers: np.ndarray, counts: np.ndarray, kept: np.ndarray) -> Iterator[str]:
    flat, ends = numbers.tolist(), np.cumsum(counts).tolist()
    for start, end, whole in zip([0] + ends, ends, kept.tolist()):
        yield ";".join([known.groups[i] for i in flat[start:end]]) if whole else ""


def _digests(known: Words, numbers: np.ndarray, counts: np.ndarray, kept: np.ndarray) -> list[str]:
    return [hashlib.sha256(text.encode()).hexdigest() if text else "" for text in _texts_of_groups(known, numbers, counts, kept)]


def align_documents(docs: DataFrame, files: tuple[str, str] | None = None) -> DataFrame:
    """All rows and columns of ``docs`` (text) with a column ``groups`` (or a longer name if there is one):
    array<struct<a: array<int>, b: array<int>>> in text order; empty for a text without tokens."""
    name = fresh_name(docs, "groups")

    @F.pandas_udf("string")
    def group_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = aligner(*_files(files))
        for batch in batches:
            found: list[str] = []
            for texts in chunks(batch, ENCODED_CHARS):
                if words.full():
                    words.forget()
                numbers, counts = words.numbers(texts)
                found += _texts_of_groups(words.known, numbers, counts, _whole(words.known, numbers, counts))
            yield pd.Series(found, dtype=object)

    def ids(text: Column) -> Column:
        return F.split(text, ",").cast("array<int>")

    each = F.transform(F.split(F.col(name), ";"), lambda g: F.struct(ids(F.substring_index(g, "|", 1)).alias("a"), ids(F.substring_index(g, "|", -1)).alias("b")))
    none = F.array().cast("array<struct<a: array<int>, b: array<int>>>")
    return docs.withColumn(name, group_texts("text")).withColumn(name, F.when(F.col(name) == "", none).otherwise(each))
