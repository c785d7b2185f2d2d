"""Toxicity by class-conditional Kneser-Ney models over letters.

Words of the labelled documents are counted by class, once a document, so that one repetitive text vouches for nothing. Letters inside words follow an order-5 model: the highest order
has counts of its own for each class (toxic, ordinary); below it both classes share the continuation counts of the
pooled text. Every n-gram counts, and a letter never seen after a context counts with the context's back-off weights.
A word's ratio is P(toxic) / P(ordinary) of its letters and its end. A document's measure is the logarithm of the mean of
its words' ratios: how much likelier its words are if one of them, whichever, came from the toxic model. A mean over all
letters would drown one expression in what else the classes differ in, such as their languages. A logistic curve over the
measure, its size as log(1 + size), fitted on labelled documents left out of the counts, turns it into a score.

Counts cover every labelled row that may be learned from, are made and smoothed as DataFrames, and grow with the input.
What executors get are the ratios of the most frequent n-grams and contexts, at most SENT of them however large the corpus
is, under their letters, so that none is taken for another. If there are more, words with an n-gram that was not sent are
left open there: each different one is joined with all ratios, and its ratio is added to the documents that hold it. So
what is sent decides where a ratio is looked up, not whether. The curve is fitted on a sample of at most
``CALIBRATION_DOCS`` documents.

Null or empty texts have measure 0; so have all if a class has no words. Rows without label, or with a null one, are not learned from; several labels of one
document count as toxic if one does. Equal texts get equal scores. Texts are scored whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from flowledger.llm.common import chunks, code_points, runs_of, staged
from flowledger.llm.language import held_out
from flowledger.llm.letters import Words

ORDER = 5
DISCOUNT = 0.75
SENT = 1 << 21  # n-grams and contexts sent to tasks, 20 bytes each
CALIBRATION_DOCS = 20_000
CALIBRATION_PARTS = 5  # one in so many labelled documents is left out of the counts
LEAST_OF_A_CLASS = 5  # calibration documents a class needs; else the curve below stands
DEFAULT_CURVE = (4.0, -3.8)  # slope, intercept
THRESHOLD = 0.7
PLACES = 250_000  # n-grams handed on together
_CODE = 21  # bits of a code point


def spelled(letters: np.ndarray) -> str:
    return letters.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def padded(word: str) -> str:
    """The word as its n-grams see it: one of ORDER letters ends at each of its letters, one at its end."""
    return "^" * (ORDER - 1) + word + "$"


def gram_keys(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The first three and the other letters of n-grams, given as one array of code points per place; the last place of a
    context is 0."""
    first = codes[0] << 2 * _CODE | codes[1] << _CODE | codes[2]
    return first, codes[3] << _CODE | codes[4]


def buckets(first: np.ndarray, others: np.ndarray, bits: int) -> np.ndarray:
    mixed = (first * 3 + others).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def word_counts(labelled: DataFrame) -> DataFrame:
    """word, toxic and ordinary occurrences, from (text, toxic)."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            totals: dict[str, list[int]] = {}
            for toxic, texts in batch.groupby("toxic").text:
                counts: Counter = Counter()
                for part in chunks(texts):
                    words = Words.of(part)
                    letters = np.where(words.letters == 0, ord(" "), words.letters)
                    letters[words.doc_starts - 1] = ord("\n")
                    for text in spelled(letters).split("\n"):
                        counts.update(set(text.split(" ")))
                counts.pop("", None)
                for word, n in counts.items():
                    totals.setdefault(word, [0, 0])[0 if toxic else 1] += n
            yield pd.DataFrame([(word, *n) for word, n in totals.items()], columns=["word", "toxic", "ordinary"])

    parts = labelled.select("text", "toxic").mapInPandas(counted, "word string, toxic long, ordinary long")
    return parts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _shared(grams: DataFrame, size: int) -> DataFrame:
    """gram, p: Kneser-Ney probability of the last of ``size`` letters after the others, from (gram, n).

    ``n`` are distinct letters before the gram, or occurrences for a gram at the beginning of a word.
    """
    if size == 1:
        total = grams.agg(F.sum("n").alias("total"))
        return grams.crossJoin(F.broadcast(total)).select("gram", (F.col("n") / F.col("total")).alias("p"))  # one row
    lower = _shared(_continuations(grams, size - 1), size - 1)
    before = grams.groupBy(F.substring("gram", 1, size - 1).alias("before")).agg(F.sum("n").alias("sum_n"), F.count(F.lit(1)).alias("kinds"))
    joined = grams.withColumn("before", F.substring("gram", 1, size - 1)).withColumn("rest", F.substring("gram", 2, size - 1))
    joined = joined.join(before, "before").join(lower.withColumnRenamed("gram", "rest"), "rest")
    p = F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) / F.col("sum_n") + DISCOUNT * F.col("kinds") / F.col("sum_n") * F.col("p")
    return joined.select("gram", p.alias("p"))


def _continuations(grams: DataFrame, size: int) -> DataFrame:
    rest = F.substring("gram", 2, size).alias("gram")
    return grams.groupBy(rest).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).select(
        "gram", F.when(F.col("gram").startswith("^"), F.col("total")).otherwise(F.col("kinds")).alias("n")
    )


def log_ratios(words: DataFrame) -> DataFrame:
    """gram, ratio, seen: log P(toxic) / P(ordinary) of the last letter of every n-gram seen; of every context (one letter
    shorter) that of a letter never seen after it, whose shared value is the same in both classes. Nothing if a class has
    no words."""
    padded = F.concat(F.lit("^" * (ORDER - 1)), F.col("word"), F.lit("$"))
    places = F.transform(F.sequence(F.lit(1), F.length("word") + 1), lambda i: padded.substr(i, F.lit(ORDER)))
    grams = staged(
        words.select(F.explode(places).alias("gram"), "toxic", "ordinary").groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")),
        "grams",
    )
    context = F.substring("gram", 1, ORDER - 1)
    contexts = grams.groupBy(context.alias("context")).agg(
        *[F.sum(name).alias(f"{name}_n") for name in ("toxic", "ordinary")],
        *[F.count_if(F.col(name) > 0).alias(f"{name}_kinds") for name in ("toxic", "ordinary")],
    )
    pooled = grams.select("gram", (F.col("toxic") + F.col("ordinary")).alias("n"))
    lower = _shared(_continuations(pooled, ORDER - 1), ORDER - 1).withColumnRenamed("gram", "rest")

    def backoff(name: str) -> Column:
        return F.when(F.col(f"{name}_n") > 0, DISCOUNT * F.col(f"{name}_kinds") / F.col(f"{name}_n")).otherwise(1.0)

    def probability(name: str) -> Column:
        own = F.when(F.col(f"{name}_n") > 0, F.greatest(F.col(name) - DISCOUNT, F.lit(0.0)) / F.col(f"{name}_n")).otherwise(0.0)
        return own + backoff(name) * F.col("p")

    joined = grams.withColumn("context", context).withColumn("rest", F.substring("gram", 2, ORDER - 1)).join(contexts, "context").join(lower, "rest")
    ratio = F.log(probability("toxic") / probability("ordinary"))
    told = joined.select("gram", ratio.alias("ratio"), (F.col("toxic") + F.col("ordinary")).alias("seen"))
    unseen = F.log(backoff("toxic") / backoff("ordinary"))
    told = told.unionByName(contexts.select(F.col("context").alias("gram"), unseen.alias("ratio"), (F.col("toxic_n") + F.col("ordinary_n")).alias("seen")))
    both = contexts.agg(((F.sum("toxic_n") > 0) & (F.sum("ordinary_n") > 0)).alias("both"))
    return told.crossJoin(F.broadcast(both)).filter("both").drop("both")  # one row


class Measured(NamedTuple):
    """Of some texts: the logarithm of the sum of the ratios of the words that are told (-inf if there is none), the number
    of all words, and the different words left open with how often each occurs."""

    told: np.ndarray
    n_words: np.ndarray
    open: list[list[str]]
    times: list[list[int]]


@dataclass
class Model:
    """Ratios by letters, and the curve from a document's measure to its score."""

    firsts: np.ndarray  # first three letters of every n-gram and context sent, in the order of their buckets
    others: np.ndarray  # its other letters
    ratios: np.ndarray
    whole: bool = True  # whether these are all n-grams and contexts
    slope: float = DEFAULT_CURVE[0]
    intercept: float = DEFAULT_CURVE[1]

    @classmethod
    def of(cls, firsts: np.ndarray, others: np.ndarray, ratios: np.ndarray, whole: bool) -> Model:
        order = np.argsort(buckets(firsts, others, cls.bits(len(firsts))), kind="stable")
        return cls(firsts[order], others[order], ratios[order], whole)

    def __getstate__(self):
        return {name: value for name, value in vars(self).items() if name != "starts"}

    @staticmethod
    def bits(n: int) -> int:
        """Bits of a bucket's number: two to four buckets for each of ``n`` n-grams."""
        return max(n, 1).bit_length() + 1

    @cached_property
    def starts(self) -> np.ndarray:
        """Where each bucket starts, and the last one ends; made by each task, never sent."""
        bits = self.bits(len(self.firsts))
        sizes = np.bincount(buckets(self.firsts, self.others, bits), minlength=1 << bits)
        return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)

    def _looked_up(self, first: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ratios (0 where there is none), and which n-grams have one."""
        bucket = buckets(first, others, self.bits(len(self.firsts)))
        at, end = self.starts[bucket], self.starts[bucket + 1]
        value, known = np.zeros(len(first), np.float32), np.zeros(len(first), bool)
        left = np.flatnonzero(at < end)
        while len(left):
            here = at[left]
            hit = (self.firsts[here] == first[left]) & (self.others[here] == others[left])
            value[left[hit]], known[left[hit]] = self.ratios[here[hit]], True
            at[left] += 1
            left = left[~hit & (at[left] < end[left])]
        return value, known

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The logarithm of each word's ratio, and which words are open (they have 0)."""
        letters = code_points("".join(map(padded, words))).astype(np.int64)
        places = np.array([len(word) + 1 for word in words], np.int64)  # every letter of a word and its end
        ends = np.cumsum(places + ORDER - 1)
        at = runs_of(ends - places - ORDER + 1, places)
        codes = [letters[at + k] for k in range(ORDER)]
        value, known = self._looked_up(*gram_keys(codes))
        word, unseen = np.repeat(np.arange(len(words)), places), np.flatnonzero(~known)
        left = np.zeros(len(words), bool)
        if self.whole:
            context = [code[unseen] for code in codes[:-1]]
            value[unseen] = self._looked_up(*gram_keys([*context, np.zeros_like(unseen)]))[0]
        else:
            left[word[unseen]] = True
        ratio = np.bincount(word, weights=value, minlength=len(words))
        return np.where(left, 0, ratio), left

    def measured(self, texts: list[str]) -> Measured:
        words = Words.of(texts)
        n_words = np.bincount(words.doc, minlength=len(texts))
        told, found = np.full(len(texts), -np.inf), [[] for _ in texts]
        if not len(words.starts):
            return Measured(told, n_words, found, found)
        # each different word is looked up once
        number, different = pd.factorize(np.array(spelled(np.where(words.letters == 0, ord(" "), words.letters)).split(), object))
        ratio, left = (of_each[number] for of_each in self.of_words(different.tolist()))
        of_word, doc = ratio[~left], words.doc[~left]
        n_told = np.bincount(doc, minlength=len(texts))
        some = np.flatnonzero(n_told)
        if len(some):
            largest = np.zeros(len(texts))  # taken out before the exponential
            largest[some] = np.maximum.reduceat(of_word, (np.cumsum(n_told) - n_told)[some])
            sums = np.bincount(doc, weights=np.exp(of_word - largest[doc]), minlength=len(texts))
            told[some] = largest[some] + np.log(sums[some])
        if not left.any():
            return Measured(told, n_words, found, found)
        pairs, n = np.unique(words.doc[left] * len(different) + number[left], return_counts=True)
        ends = np.searchsorted(pairs // len(different), np.arange(1, len(texts)))
        names = np.split(different[pairs % len(different)], ends)
        return Measured(told, n_words, [part.tolist() for part in names], [part.tolist() for part in np.split(n, ends)])

    def measures(self, texts: list[str]) -> np.ndarray:
        """Logarithm of the mean of each text's word ratios, its size as log(1 + size). For a whole model."""
        if not self.whole:
            raise ValueError("words can be open: see measured()")
        told, n_words = self.measured(texts)[:2]
        some = np.flatnonzero(n_words)
        measure = np.zeros(len(texts))
        measure[some] = told[some] - np.log(n_words[some])
        return np.sign(measure) * np.log1p(np.abs(measure))

    def scores(self, measures: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * measures + self.intercept, -60, 60)))


def _table(ratios: DataFrame, sent: int = SENT) -> Model:
    """The model of (gram, ratio, seen): all rows, or those above a least power of two of ``seen`` that are ``sent`` at most."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            first, others = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            lengths = batch.gram.str.len().to_numpy()
            for size in np.unique(lengths):
                own = np.flatnonzero(lengths == size)
                codes = code_points("".join(batch.gram.iloc[own])).astype(np.int64).reshape(-1, size)
                first[own], others[own] = gram_keys([*codes.T, np.zeros(len(own), np.int64)][:ORDER])
            yield pd.DataFrame({"first": first, "others": others, "ratio": batch.ratio.astype(np.float32)})

    power = F.length(F.bin("seen"))
    least, total, whole = None, 0, True
    for row in ratios.groupBy(power.alias("power")).count().orderBy(F.desc("power")).collect():  # 64 rows at most
        total += row["count"]
        whole = total <= sent
        if not whole:
            break
        least = row["power"]
    kept = ratios.filter(power >= least if least is not None else F.lit(False))
    rows = kept.mapInPandas(keyed, "first long, others long, ratio float").toArrow()
    return Model.of(*[rows[name].to_numpy() for name in ("first", "others", "ratio")], whole)


def fitted_curve(measures: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton steps with a slight pull towards a flat one."""
    if min(np.count_nonzero(toxic), np.count_nonzero(~toxic)) < LEAST_OF_A_CLASS:
        return DEFAULT_CURVE
    scale = max(float(np.std(measures)), 1e-9)
    x = np.stack([measures / scale, np.ones(len(measures))], axis=1)
    w, pull = np.zeros(2), np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull, x.T @ (p - toxic) + pull @ w)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0] / scale), float(w[1])


def open_ratios(words: DataFrame, ratios: DataFrame) -> DataFrame:
    """word, ratio: the logarithm of each word's ratio, from different (word) and all (gram, ratio)."""

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns, found = ["id", "place", "gram"], []
        for batch in batches:
            for number, word in zip(batch.id, batch.word):
                letters = padded(word)
                for at in range(len(word) + 1):
                    found.append((number, at, letters[at : at + ORDER]))
                    if len(found) == PLACES:
                        yield pd.DataFrame(found, columns=columns)
                        found = []
        yield pd.DataFrame(found, columns=columns)

    words = staged(words.withColumn("id", F.monotonically_increasing_id()), "open-words")
    told = ratios.select("gram", F.col("ratio").cast("float").cast("double").alias("ratio"))
    places = words.mapInPandas(grams, "id long, place long, gram string").join(told, "gram", "left")
    context = told.select(F.col("gram").alias("context"), F.col("ratio").alias("unseen"))
    needed = F.when(F.col("ratio").isNull(), F.substring("gram", 1, ORDER - 1)).otherwise(F.col("id").cast("string"))  # no context is a number
    places = places.withColumn("context", needed).join(context, "context", "left")
    value = F.coalesce("ratio", "unseen", F.lit(0.0))
    # added up in the order of the places, as tasks do
    sums = places.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", value.alias("value")))).alias("values"))
    return words.join(sums, "id").select("word", F.aggregate("values", F.lit(0.0), lambda total, one: total + one["value"]).alias("ratio"))


def _with_open_words(parts: DataFrame, ratios: DataFrame) -> DataFrame:
    """The rows of ``parts`` (told, n_words, open, times and others), their open words told."""
    parts = staged(parts.withColumn("row", F.monotonically_increasing_id()), "measured")
    held = parts.select("row", F.explode(F.arrays_zip("open", "times")).alias("held")).select("row", F.col("held.open").alias("word"), F.col("held.times").alias("n"))
    ratio = staged(open_ratios(held.select("word").distinct(), ratios), "open-ratios")
    sums = held.join(ratio, "word").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("ratio", "n"))).alias("found"))
    joined = parts.join(sums, "row", "left").withColumn("largest", F.greatest("told", F.element_at("found", -1)["ratio"]))
    sum_of_open = F.aggregate("found", F.lit(0.0), lambda total, one: total + one["n"] * F.exp(one["ratio"] - F.col("largest")))
    told = F.col("largest") + F.log(F.exp(F.col("told") - F.col("largest")) + sum_of_open)
    return joined.withColumn("told", F.when(F.col("found").isNull(), F.col("told")).otherwise(told)).drop("row", "found", "largest")


def measured(docs: DataFrame, model: Model, ratios: DataFrame) -> DataFrame:
    """The rows with :meth:`Model.measures` of their ``text`` as ``measure`` in its place. ``ratios``: all, staged."""

    @pandas_udf("double")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.concatenate([model.measures(part) for part in chunks(batch)]) if len(batch) else np.zeros(0))

    @pandas_udf("told double, n_words long, open array<string>, times array<long>")
    def told_or_open(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [pd.DataFrame(model.measured(part)._asdict()) for part in chunks(batch)]
            yield pd.concat(parts) if parts else pd.DataFrame({name: [] for name in Measured._fields})

    if model.whole:
        return docs.withColumn("measure", measure("text")).drop("text")
    parts = docs.withColumn("parts", told_or_open("text")).select(*[name for name in docs.columns if name != "text"], "parts.*")
    parts = _with_open_words(parts, ratios).withColumn("mean", F.col("told") - F.log("n_words"))
    size = F.when(F.col("n_words") > 0, F.signum("mean") * F.log1p(F.abs("mean"))).otherwise(0.0)
    return parts.withColumn("measure", size).drop("mean", *Measured._fields)


def learn(labelled: DataFrame, calibrate: Column, sent: int = SENT) -> tuple[Model, DataFrame]:
    """The model of (doc_id, text, toxic): counts from the rows where ``calibrate`` is false, the curve from the others;
    and all ratios, staged."""
    ratios = staged(log_ratios(staged(word_counts(labelled.filter(~calibrate)), "words")), "ratios")
    model = _table(ratios, sent)
    if model.whole and not len(model.ratios):
        return model, ratios
    left_out = labelled.filter(calibrate)
    share = min(1.0, CALIBRATION_DOCS / max(left_out.count(), 1))
    chosen = left_out.filter(F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11) < share * float(1 << 53))
    pairs = measured(chosen.select("text", "toxic"), model, ratios).select("measure", "toxic").toPandas()
    model.slope, model.intercept = fitted_curve(pairs.measure.to_numpy(float), pairs.toxic.to_numpy(bool))
    return model, ratios


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic of the documents that have a label."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    # the labels are the small side of a shuffled join: hashing them saves sorting the texts
    return docs.select("doc_id", "text").join(known.hint("shuffle_hash"), "doc_id")


def toxicity_report(docs: DataFrame, labels: DataFrame, sent: int = SENT) -> DataFrame:
    """Score of every document, learned from the labelled documents that are not held out. Does not depend on ``sent``."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    usable = ~held_out(3, 1)
    calibrate = F.floor(crc / 3) % CALIBRATION_PARTS == 0
    model, ratios = learn(labelled_texts(docs.filter(usable), labels.filter(usable)), calibrate, sent)
    slope, intercept = float(model.slope), float(model.intercept)
    exponent = F.greatest(F.least(F.col("measure") * slope + intercept, F.lit(60.0)), F.lit(-60.0))
    score = 1 / (1 + F.exp(-exponent))
    return (
        measured(docs.select("doc_id", held_out(3, 1).alias("held_out"), "text"), model, ratios)
        .select("doc_id", "held_out", score.alias("score"))
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )
