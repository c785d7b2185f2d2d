"""Nearest neighbours by inner product from a permutation index.

A bounded sample of vectors serves as pivots. Every vector is represented by the order of its nearest pivots and posted
in the inverted file of each of them with its place in that order. A query walks the files of its own nearest pivots,
which gives each posted vector its footrule distance (the sum of the differences of places; a pivot not posted counts as
the last place). The nearest share by footrule, ties included, is reranked by the exact inner product in double precision.

Vectors are lengthened by one component to equal norms first, so that a larger inner product is a smaller distance;
queries get 0 there. The index lies in blocks of candidates; queries meet it in blocks, each pair of blocks in one task
of bounded size, which returns its best ``k`` for each query, and these are merged. All rows are indexed; the share
reranked is a share of each block, so it holds at every size.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows without vec_id. Only
vectors of one length are compared. Rows that repeat a vec_id count once, with the smallest of their vectors. Equal
vectors have equal footrules and scores; ties go to the smaller vec_id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowledger.llm.common import staged

NEIGHBOURS = 20
PIVOTS = 512
PLACES = 128  # nearest pivots a vector is posted under
SHARE = 0.2  # of a block's candidates that are reranked
LEAST = 500  # but so many at least
CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 2048


def usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(embedding) > 0) & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def pivots_of(vectors: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """At most ``pivots`` different vectors, those with the smallest hashes of a sample about 20 times as large; the
    smallest of all vectors if the sample has too few."""
    key = F.shiftrightunsigned(F.xxhash64("embedding"), 11)
    different = vectors.agg(F.approx_count_distinct(key)).first()[0]
    share = min(1.0, 20 * pivots / max(different, 1))
    rows = []
    for part in sorted({share, 1.0}):
        if len(rows) < pivots:
            sample = vectors.filter(key < part * float(1 << 53)).select(key.alias("key"), "embedding").dropDuplicates(["key"])
            rows = sample.orderBy("key").limit(pivots).collect()
    return np.array([row.embedding for row in rows], np.float64)


def nearest_pivots(vectors: np.ndarray, extra: np.ndarray, pivots: np.ndarray, places: int) -> np.ndarray:
    """Numbers of the nearest pivots of every vector, nearest first; ``extra`` is the added component."""
    near = vectors @ pivots[:, :-1].T + extra[:, None] * pivots[:, -1]
    if places < near.shape[1]:
        nearest = np.argpartition(-near, places - 1, axis=1)[:, :places]
    else:
        nearest = np.broadcast_to(np.arange(places), near.shape)
    order = np.argsort(-np.take_along_axis(near, nearest, axis=1), axis=1, kind="stable")
    return np.take_along_axis(nearest, order, axis=1)


class InvertedFiles:
    """One file for each pivot over the candidates of a block.

    A file holds the pivot's place in the order of every candidate, and the last place for candidates not posted under
    it. As a vector is posted under a good part of the pivots, that takes less room than pairs of candidate and place,
    and a file is added up as one vector.
    """

    def __init__(self, orders: np.ndarray, pivots: int):
        n, self.places = orders.shape
        self.files = np.full((pivots, n), self.places, np.int16)
        self.files[orders.T, np.arange(n)] = np.arange(self.places, dtype=np.int16)[:, None]
        self.own = np.arange(self.places, dtype=np.int16)[:, None]

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Distance of every candidate's order to the query's, from the files of the query's own pivots."""
        differences = self.files[order]
        differences -= self.own
        np.abs(differences, out=differences)
        return differences.sum(axis=0, dtype=np.int32)


def _searched(candidates: pd.DataFrame, queries: pd.DataFrame, pivots: np.ndarray, norm: float, k: int, share: float, least: int) -> pd.DataFrame:
    found = []
    if len(candidates) and len(queries):
        ids, vectors = candidates.vec_id.to_numpy(np.int64), np.stack(candidates.embedding.to_list()).astype(np.float64)
        asked, wanted = queries.vec_id.to_numpy(np.int64), np.stack(queries.embedding.to_list()).astype(np.float64)
        places = min(PLACES, len(pivots))
        extra = np.sqrt(np.maximum(norm - (vectors**2).sum(axis=1), 0))
        files = InvertedFiles(nearest_pivots(vectors, extra, pivots, places), len(pivots))
        depth = min(max(int(np.ceil(share * len(ids))), least) + 1, len(ids))  # one more, for the query itself
        for query, vector, order in zip(asked, wanted, nearest_pivots(wanted, np.zeros(len(wanted)), pivots, places)):
            distance = files.footrule(order)
            near = np.flatnonzero((distance <= np.partition(distance, depth - 1)[depth - 1]) & (ids != query))
            scores = (vectors[near] * vector).sum(axis=1)
            if len(near) > k:
                high = scores >= np.partition(scores, len(near) - k)[len(near) - k]
                near, scores = near[high], scores[high]
            best = np.lexsort((ids[near], -scores))[:k]
            found.append((np.full(len(best), query), ids[near][best], scores[best]))
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))


def search(vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS, share: float = SHARE, least: int = LEAST, candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest other rows found for each row of ``vectors`` (vec_id, embedding)
    that ``is_query`` holds for; other columns are left out."""
    rows = staged(
        vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).groupBy("vec_id").agg(F.min("embedding").alias("embedding")),
        "vectors",
    )
    size = F.size("embedding")
    parts = [_search_one(rows.filter(size == length), is_query, k, share, least, candidate_block, query_block) for (length,) in rows.select(size.alias("n")).distinct().orderBy("n").collect()]
    if not parts:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _search_one(rows: DataFrame, is_query: Column, k: int, share: float, least: int, candidate_block: int, query_block: int) -> DataFrame:
    squares = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    n, asked, norm = rows.agg(F.count(F.lit(1)), F.count_if(is_query), F.max(squares)).first()
    plain = pivots_of(rows)
    pivots = np.c_[plain, np.sqrt(np.maximum(norm - (plain**2).sum(axis=1), 0))]
    blocks, query_blocks = -(-n // candidate_block), max(-(-asked // query_block), 1)

    def dealt(frame: DataFrame, own: str, count: int, other: str, other_count: int) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")
        return frame.select("vec_id", "embedding", block.alias(own), F.explode(F.sequence(F.lit(0), F.lit(other_count - 1))).alias(other)).groupBy("block", "query_block")

    def searched(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        return _searched(candidates, queries, pivots, norm, k, share, least)

    met = dealt(rows, "block", blocks, "query_block", query_blocks).cogroup(dealt(rows.filter(is_query), "query_block", query_blocks, "block", blocks))
    best = met.applyInPandas(searched, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_report(vectors: DataFrame) -> DataFrame:
    """The 20 nearest rows of every row whose vec_id is divisible by 20."""
    return search(vectors, F.col("vec_id") % 20 == 0)
