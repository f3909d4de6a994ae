"""Exact top-k inner products with MaxScore (operator 3).

A vector's components are the postings of terms (dimension, sign). For a query a component adds to the score of the vectors that
have its sign there and only takes from the others, so a term's score bound is the query's weight times the list's largest
value. Per shard the query's terms are sorted by that bound; the terms whose bounds together stay below the k-th best score are not
essential. Essential postings are traversed; what may still compete is probed in the others, dropped where its bound falls short, and
scored exactly. Vectors are dealt to shards and queries to blocks of a set size, in rows and in bytes, so a task holds one shard and one block; the shards' best k
are merged at the end. Every shard meets every block, so what is shuffled falls with their sizes.

Nulls: vectors that are NULL, or hold NULL or non-finite components, take no part, nor do NULL ids. Ties go to the smaller id. Vectors
of different lengths are compared as if padded with zeros. An id that repeats among the queries asks once (with its greatest vector);
among the candidates each row counts, but no row with the query's own id. Fewer candidates than k give them all; empty tables give an empty result. Scores are 64-bit integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quantised(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    """No NULL and nothing that is not finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


class Shard:
    """Postings of one shard: per dimension and sign the vectors and their values, and the largest value."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.matrix = ids[order], matrix[order]
        self.lists = {}
        for d in range(matrix.shape[1]):
            for sign in (1, -1):
                at = np.flatnonzero(sign * self.matrix[:, d] > 0)
                values = sign * self.matrix[at, d]
                if len(at):
                    self.lists[d, sign] = (int(values.max()), at, values)

    def search(self, query: np.ndarray, own: int, k: int, first: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best, ties to the smaller id."""
        others = self.ids != own
        seeds = np.flatnonzero(others)[: 4 * k]
        best = self._best(seeds, self.matrix[seeds] @ query, k)
        if len(best[0]) < k:
            return self.ids[best[0]], best[1]
        least = best[1][-1]
        if least <= 0:  # vectors that match no term may compete: every one is scored
            every = np.flatnonzero(others)
            best = self._best(every, self.matrix[every] @ query, k)
            return self.ids[best[0]], best[1]
        terms = []
        for d in np.flatnonzero(query).tolist():
            held = self.lists.get((d, 1 if query[d] > 0 else -1))
            if held is not None:
                most, at, values = held
                weight = abs(int(query[d]))
                terms.append((weight * most, d, weight, at, values))
        terms.sort(key=lambda t: (-t[0], t[1]))
        rest = sum(t[0] for t in terms)
        reached = np.zeros(len(self.ids), np.int64)
        essential = 0
        while essential < len(terms) and rest >= least:
            bound, _, weight, at, values = terms[essential]
            reached[at] += weight * values
            rest -= bound
            essential += 1
        open_ = np.flatnonzero(others & (reached + rest >= least))
        for bound, d, weight, _, _ in terms[essential:]:
            rest -= bound
            sign = 1 if query[d] > 0 else -1
            reached[open_] += weight * np.maximum(sign * self.matrix[open_, d], 0)
            open_ = open_[reached[open_] + rest >= least]
        # the likeliest first: their exact scores raise the bar for the others
        open_ = open_[np.argsort(-reached[open_], kind="stable")]
        head = open_[:first]
        best = self._best(head, self.matrix[head] @ query, k)
        tail = open_[first:]
        if len(best[0]) == k:
            tail = tail[reached[tail] >= best[1][-1]]
        both = np.concatenate([best[0], tail])
        best = self._best(both, np.concatenate([best[1], self.matrix[tail] @ query]), k)
        return self.ids[best[0]], best[1]

    def _best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return rows[order], scores[order]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _width(column: pa.ChunkedArray) -> int:
    return max((int(np.diff(c.offsets.to_numpy()).max()) for c in column.chunks if len(c)), default=0)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, shard_rows: int = 8192, block_rows: int = 65536, part_bytes: int = 16 << 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every query.

    A shard and a block hold on average at most so many rows, and ``part_bytes`` at 8 bytes a component. Larger ones are copied less often;
    a task keeps the postings of its shard, too, about three times its size.
    """
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"), is_query.alias("q"))
    own = own.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).select("vec_id", quantised(F.col("v"), scale).alias("v"), "q")
    asked = own.where("q").groupBy(F.col("vec_id").alias("query_id")).agg(F.max("v").alias("v"))
    wide = F.size("v") * 8
    own_size, asked_size = F.struct(F.count("*"), F.sum(wide)), F.struct(F.count_if("q"), F.sum(F.when(F.col("q"), wide)))
    sizes = own.agg(own_size.alias("own"), asked_size.alias("asked")).first()

    def parts(size: tuple[int, int | None], rows: int) -> int:
        return max(1, -(-size[0] // rows), -(-(size[1] or 0) // part_bytes))

    shards, blocks = parts(sizes["own"], shard_rows), parts(sizes["asked"], block_rows)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [])
        if left.num_rows and right.num_rows:
            width = max(_width(left.column("v")), _width(right.column("v")))
            shard = Shard(left.column("vec_id").to_numpy(), _matrix(left.column("v"), width))
            queries = _matrix(right.column("v"), width)
            for own_id, query in zip(right.column("query_id").to_pylist(), queries, strict=True):
                ids, scores = shard.search(query, own_id, k)
                out[0].append(np.full(len(ids), own_id))
                out[1].append(ids)
                out[2].append(scores)
        arrays = [pa.array(np.concatenate(x) if x else np.zeros(0), pa.int64()) for x in out]
        return pa.table(arrays, names=["query_id", "vec_id", "score"])

    # a shard goes to every block of queries and a block to every shard: each pair of them meets once, in one task
    shard_of = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int")
    block_of = F.pmod(F.xxhash64("query_id", F.lit(2)), F.lit(blocks)).cast("int")
    left = own.select("vec_id", "v", shard_of.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = asked.select("query_id", "v", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block_of.alias("block"))
    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
