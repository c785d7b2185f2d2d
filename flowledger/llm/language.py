"""Language of documents and of the spans inside them.

A word's script (by code point ranges) narrows the languages it can belong to: those that were seen to use the script;
a script no language uses leaves all. Each word is scored under every language by letter trigrams inside the word. A Viterbi
pass over the words of a document finds the labelling with the best sum of scores less a penalty for every switch, so a
passage in another language becomes a span of its own while a stray word does not. The document's language is the one
with most letters in its spans, its score their share of all letters.

Trigrams are counted over a bounded sample of the different labelled texts, about ``docs_per_language`` for each language,
chosen by a hash of the text; copies of a text count once. A language's table has a fixed number of slots. Prediction looks
at texts only, whole.

A text that is null or has no letter is ``und`` with score 0, as is every text when nothing was learned. Equally long
shares go to the first language by name. Rows without a label are not learned from. Equal texts get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from flowledger.llm.common import chunks
from flowledger.llm.letters import CODES, Words

UNKNOWN = "und"
DOCS_PER_LANGUAGE = 2000
SLOT_BITS = 16
SWITCH_PENALTY = 12.0
SCRIPT_SHARE = 0.01  # of a language's letters, to count as one of its scripts
FORBIDDEN = np.float32(-1e6)
BATCH_CHARS = 12_000_000  # texts that take the steps of the Viterbi pass together
SCORED_CHARS = 1_500_000  # of them scored at a time

# First and last code point of the letters of common scripts.
SCRIPTS = (
    ("latin", ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("devanagari", ((0x900, 0x97F), (0xA8E0, 0xA8FF))),
    ("bengali", ((0x980, 0x9FF),)),
    ("tamil", ((0xB80, 0xBFF),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF), (0x1C90, 0x1CBF))),
    ("hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))),
    ("kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF))),
    ("han", ((0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F))),
)


@lru_cache(maxsize=1)
def script_of() -> np.ndarray:
    """Code point → number of its script, 0 for any other."""
    table = np.zeros(CODES, np.uint8)
    for number, (_, ranges) in enumerate(SCRIPTS, start=1):
        for first, last in ranges:
            table[first : last + 1] = number
    return table


def _slots(words: Words) -> np.ndarray:
    """Slot of the trigram around every position of ``letters``; edges of words count as 0."""
    c = words.letters.astype(np.uint64)
    slots = np.zeros(len(c), np.int64)
    mixed = (c[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c[2:] * np.uint64(0x165667B19E3779F9))
    slots[1:-1] = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    return slots


@dataclass
class Languages:
    """What was learned: names in order, log-probabilities (language, slot), and which script may be which language."""

    names: list[str]
    logs: np.ndarray
    allowed: np.ndarray

    def word_scores(self, words: Words) -> np.ndarray:
        slots = _slots(words)
        scores = np.empty((len(words.starts), len(self.names)), np.float32)
        # sums over words from sums over all positions; 0 outside words
        inside = words.letters > 0
        for k, logs in enumerate(self.logs):
            values = np.where(inside, logs[slots], np.float32(0))
            scores[:, k] = np.add.reduceat(values, words.starts)
        scores[~self.allowed[script_of()[words.letters[words.starts]]]] = FORBIDDEN
        return scores

    def label(self, texts: list[str]) -> list[tuple[str, float, list[dict]]]:
        """(language, score, spans) of each text."""
        docs, starts, ends, scores, done = [], [], [], [], 0
        for part in chunks(texts, SCORED_CHARS) if self.names else ():
            words = Words.of(part)
            if len(words.starts):
                offset = words.doc_starts[words.doc]
                docs.append(words.doc + done)
                starts.append(words.starts - offset)
                ends.append(words.ends - offset)
                scores.append(self.word_scores(words))
            done += len(part)
        if not docs:
            return [(UNKNOWN, 0.0, [])] * len(texts)
        doc, start_at, end_at = map(np.concatenate, (docs, starts, ends))
        n = len(self.names)
        counts = np.bincount(doc, minlength=len(texts))
        labels = best_path(np.concatenate(scores), np.cumsum(counts) - counts, counts, SWITCH_PENALTY)
        letters = np.bincount(doc * n + labels, weights=end_at - start_at, minlength=len(texts) * n).reshape(-1, n)
        winner, total = letters.argmax(axis=1), letters.sum(axis=1)
        shares = letters[np.arange(len(texts)), winner] / np.maximum(total, 1)
        first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (labels[1:] != labels[:-1])])
        last = np.r_[first[1:], len(labels)] - 1
        spans: list[list[dict]] = [[] for _ in texts]
        for number, start, end, label in zip(doc[first].tolist(), start_at[first].tolist(), end_at[last].tolist(), labels[first].tolist()):
            spans[number].append({"start_at": start, "end_at": end, "lang": self.names[label]})
        return [(self.names[k], share, found) if found else (UNKNOWN, 0.0, []) for k, share, found in zip(winner.tolist(), shares.tolist(), spans)]


def best_path(scores: np.ndarray, starts: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every row: Viterbi with one penalty for any switch, all sequences step by step together.

    Sequence d has the rows starts[d] to starts[d] + counts[d]; ties keep the label, then take the first one.
    """
    rows, n = scores.shape
    came_from = np.empty((rows, n), np.uint16)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    at, sizes = starts[order], counts[order]
    alive = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), "left")  # sequences longer than t
    own = np.arange(n, dtype=np.uint16)
    end = np.empty(len(order), np.int64)
    value = scores[at].astype(np.float64)
    for t in range(1, len(alive)):
        k = alive[t]
        end[k : len(value)] = value[k:].argmax(axis=1)
        value = value[:k]
        top = value.argmax(axis=1)
        switched = value[np.arange(k), top][:, None] - penalty
        stays = value >= switched
        came_from[at[:k] + t] = np.where(stays, own, top[:, None])
        value = np.where(stays, value, switched) + scores[at[:k] + t]
    end[: len(value)] = value.argmax(axis=1)
    labels = np.empty(rows, np.int64)
    state = np.empty(0, np.int64)
    for t in range(len(alive) - 1, -1, -1):
        k = alive[t]
        state = np.r_[state, end[len(state) : k]]
        labels[at[:k] + t] = state
        if t:
            state = came_from[at[:k] + t, state].astype(np.int64)
    return labels


def learn(labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> Languages:
    """Count trigrams and scripts of ``labelled`` (text, lang). The driver gets one number per language and slot."""
    known = labelled.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {row.lang: row.n for row in known.groupBy("lang").agg(F.approx_count_distinct("text").alias("n")).collect()}
    names = sorted(sizes)
    if not names:
        return Languages([], np.zeros((0, 1 << SLOT_BITS), np.float32), np.zeros((len(SCRIPTS) + 1, 0), bool))
    shares = F.create_map(*[F.lit(x) for name in names for x in (name, min(1.0, docs_per_language / max(sizes[name], 1)))])
    share = F.element_at(shares, F.col("lang"))
    chosen = known.filter(F.shiftrightunsigned(F.xxhash64("text"), 11) < share * float(1 << 53)).distinct()
    number = {name: k for k, name in enumerate(names)}

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang").text:
                for part in chunks(texts):
                    words = Words.of(part)
                    at = np.flatnonzero(words.letters)
                    for kind, values in (("gram", _slots(words)[at]), ("script", script_of()[words.letters[at]])):
                        key, n = np.unique(values, return_counts=True)
                        yield pd.DataFrame({"lang": number[lang], "kind": kind, "key": key.astype(np.int64), "n": n})

    sums = chosen.mapInPandas(counted, "lang int, kind string, key long, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")).toPandas()
    grams, scripts = np.zeros((len(names), 1 << SLOT_BITS)), np.zeros((len(names), len(SCRIPTS) + 1))
    for kind, into in (("gram", grams), ("script", scripts)):
        own = sums[sums.kind == kind]
        into[own.lang.to_numpy(int), own.key.to_numpy(int)] = own.n.to_numpy(float)
    seen = max(np.count_nonzero(grams.any(axis=0)), 1)
    logs = np.log((grams + 0.1) / (grams.sum(axis=1, keepdims=True) + 0.1 * seen))
    allowed = (scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1) >= SCRIPT_SHARE).T
    allowed[~allowed.any(axis=1)] = True
    return Languages(names, logs.astype(np.float32), allowed)


def language(text: Column, model: Languages) -> Column:
    """Column of struct<lang, score, spans: array<struct<start_at, end_at, lang>>>; offsets are code points."""

    @pandas_udf("lang string, score double, spans array<struct<start_at:long,end_at:long,lang:string>>")
    def labelled(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [row for part in chunks(batch, BATCH_CHARS) for row in model.label(part)]
            yield pd.DataFrame(rows, columns=["lang", "score", "spans"])

    return labelled.asNondeterministic()(text)  # or Spark would run it again for a filter on its result


def has_letter(text: Column) -> Column:
    """Whether a text has a letter; false for a null text. What ``language`` gives spans to when anything was learned."""

    @pandas_udf("boolean")
    def lettered(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([found for part in chunks(batch) for found in (np.bincount(Words.of(part).doc, minlength=len(part)) > 0).tolist()], dtype=bool)

    return lettered(text)


def held_out(parts: int, part: int) -> Column:
    """Whether crc32 of doc_id as text leaves this remainder; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part, F.lit(False))


def language_report(docs: DataFrame) -> DataFrame:
    """Language and score of every document, learned from the documents that are not held out."""
    model = learn(docs.filter(~held_out(4, 2)))
    return docs.select("doc_id", held_out(4, 2).alias("held_out"), language(F.col("text"), model).alias("found")).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )
