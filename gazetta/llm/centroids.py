"""Centroid clustering over dictionary-encoded subvectors (operator 11).

Vectors are cut into chunks of a fixed number of rows. In a chunk every block of dimensions becomes a dictionary of its distinct
subvectors and one code per vector, without loss. Blocks start with one dimension each; two neighbours become one where that
lowers the work of a round, so chunks full of copies end with few wide blocks and chunks of unlike vectors keep narrow ones.
The encoded chunks are written once. A round computes the distances between dictionary entries and centroids, sums them by
code, and returns per cluster and task the number of vectors and the sums of components and distances.

All numbers are integers, so nothing depends on the order of rows or tasks. What reaches the driver is at most ``k`` starting
vectors and ``k`` times a vector's numbers a round.

Nulls: vectors that are NULL, have another length, or hold NULL or non-finite components take no part. A NULL ``vec_id`` has no
hash and starts a centroid only after all others; it is assigned like any other. Repeated rows each count; starting vectors with
equal hashes go by their components. Ties between centroids go to the smaller number. Fewer vectors than ``k`` all become
centroids; an empty table gives an empty result; extra columns are ignored. A component beyond 2^27 after scaling raises an
error, since its squared distances need not fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm.common import pin_table
from gazetta.llm.topk import quantised, usable

#: Largest component: 64 squared differences of such components fit 64 bits.
LARGEST = 1 << 27
CHUNK = "ids array<long>, widths array<int>, sizes array<int>, entries binary, codes binary"
TOTALS = "cluster int, d int, value long"
ASSIGNED = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


@dataclass(frozen=True)
class Block:
    """Neighbouring dimensions: distinct subvectors, and one code per vector."""

    entries: np.ndarray
    codes: np.ndarray

    @property
    def work(self) -> int:
        """Components to compare with a centroid, and look-ups, of one round."""
        return self.entries.size + len(self.codes)


def _joined(a: Block, b: Block) -> Block:
    pair, codes = np.unique(a.codes * len(b.entries) + b.codes, return_inverse=True)
    left, right = np.divmod(pair, len(b.entries))
    return Block(np.concatenate([a.entries[left], b.entries[right]], axis=1), codes)


def encode(matrix: np.ndarray) -> list[Block]:
    """Dictionaries and codes of a chunk; blocks widen in pairs while a round gets cheaper."""
    blocks = []
    for d in range(matrix.shape[1]):
        entries, codes = np.unique(matrix[:, d], return_inverse=True)
        blocks.append(Block(entries[:, None], codes))
    widened = True
    while widened and len(blocks) > 1:
        widened, after, at = False, [], 0
        while at < len(blocks):
            pair = blocks[at : at + 2]
            both = _joined(*pair) if len(pair) == 2 else None
            if both and both.work < pair[0].work + pair[1].work:
                after.append(both)
                widened = True
            else:
                after += pair
            at += 2
        blocks = after
    return blocks


def decode(blocks: list[Block]) -> np.ndarray:
    return np.concatenate([b.entries[b.codes] for b in blocks], axis=1)


def distances(blocks: list[Block], centroids: np.ndarray) -> np.ndarray:
    """Squared distances of the chunk's vectors to every centroid, summed by code."""
    total, at = 0, 0
    for block in blocks:
        own = centroids[:, at : at + block.entries.shape[1]]
        at += own.shape[1]
        cross = block.entries @ own.T
        of_entry = (block.entries**2).sum(1)[:, None] - 2 * cross + (own**2).sum(1)
        total = total + of_entry[block.codes]
    return total


def _packed(ids: list, matrix: np.ndarray) -> pa.RecordBatch:
    blocks = encode(matrix)
    row = {
        "ids": ids,
        "widths": [b.entries.shape[1] for b in blocks],
        "sizes": [len(b.entries) for b in blocks],
        "entries": b"".join(b.entries.astype("<i4").tobytes() for b in blocks),
        "codes": b"".join(b.codes.astype("<u4").tobytes() for b in blocks),
    }
    kinds = [("ids", pa.list_(pa.int64())), ("widths", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())), ("entries", pa.binary()), ("codes", pa.binary())]
    return pa.RecordBatch.from_pylist([row], schema=pa.schema(kinds))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[Block]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids = batch.column("ids")[i].values
            entries = np.frombuffer(batch.column("entries")[i].as_py(), "<i4").astype(np.int64)
            codes = np.frombuffer(batch.column("codes")[i].as_py(), "<u4").reshape(-1, len(ids))
            blocks, at = [], 0
            for size, width, own in zip(batch.column("sizes")[i].as_py(), batch.column("widths")[i].as_py(), codes, strict=True):
                blocks.append(Block(entries[at : at + size * width].reshape(size, width), own))
                at += size * width
            yield ids, blocks


def kept_vectors(vectors: DataFrame, components: int = 64, scale: int = 256) -> DataFrame:
    """(vec_id, v): vectors of that length without odd components, as integers."""
    v = F.col("embedding")
    fits = usable(v) & (F.size(v) == components)
    return vectors.where(fits).select(F.col("vec_id").cast("long").alias("vec_id"), quantised(v, scale).alias("v"))


def encoded_chunks(kept: DataFrame, components: int = 64, rows: int = 8192) -> DataFrame:
    """One row per chunk: the ids, and dictionaries and codes of its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        held: list[np.ndarray] = []
        for batch in batches:
            matrix = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
            if len(matrix) and max(int(matrix.max()), -int(matrix.min())) > LARGEST:
                raise ValueError("components beyond 2^27: squared distances would not fit 64 bits")
            for start in range(0, len(matrix), rows):
                part = matrix[start : start + rows]
                ids += batch.column("vec_id").slice(start, len(part)).to_pylist()
                held.append(part)
                if len(ids) >= rows:
                    whole = np.concatenate(held)
                    yield _packed(ids[:rows], whole[:rows])
                    ids, held = ids[rows:], [whole[rows:]]
        if ids:
            yield _packed(ids, np.concatenate(held))

    return pin_table(kept.mapInArrow(run, CHUNK), "encoded-vectors")


def starting_vectors(kept: DataFrame, k: int = 40, prefix: str = "2:") -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in the order of the hashes."""
    hashed = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256)
    rows = kept.select(hashed.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def totals(chunks: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, int, np.ndarray]]:
    """Per cluster that has vectors: their number, summed distance and component sums."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # columns: components, distance, number
        sums = np.zeros((k, width + 2), np.int64)
        for _, blocks in _chunks(batches):
            far = distances(blocks, centroids)
            nearest = far.argmin(1)
            order = np.argsort(nearest, kind="stable")
            own, first = np.unique(nearest[order], return_index=True)
            rows = np.column_stack([decode(blocks), far[np.arange(len(far)), nearest], np.ones(len(far), np.int64)])
            sums[own] += np.add.reduceat(rows[order], first)
        used = np.flatnonzero(sums[:, -1])
        at = np.tile(np.arange(width + 2), len(used))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(used, width + 2), pa.int32()), pa.array(at, pa.int32()), pa.array(sums[used].ravel())], names=["cluster", "d", "value"])

    summed = chunks.mapInArrow(run, TOTALS).groupBy("cluster", "d").agg(F.sum("value").alias("value"))
    found: dict[int, np.ndarray] = {}
    for r in summed.collect():
        found.setdefault(r["cluster"], np.zeros(width + 2, np.int64))[r["d"]] = r["value"]
    return {c: (int(x[-1]), int(x[-2]), x[:width]) for c, x in found.items()}


def fit(chunks: DataFrame, centroids: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Centroids after that many rounds: floors of the exact means; those without vectors stay."""
    centroids = centroids.copy()
    for _ in range(rounds):
        for cluster, (n, _, sums) in totals(chunks, centroids).items():
            centroids[cluster] = sums // n
    return centroids


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def assigned(chunks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Every vector's cluster and distance, with the sums of its cluster and of all."""
    of_cluster = {c: t[1] for c, t in totals(chunks, centroids).items()}
    sums = np.array([of_cluster.get(c, 0) for c in range(len(centroids))], np.int64)
    inertia = sum(of_cluster.values())
    digests = np.array([centroid_digest(c) for c in centroids], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, blocks in _chunks(batches):
            far = distances(blocks, centroids)
            nearest = far.argmin(1)
            columns = [
                ids,
                pa.array(nearest, pa.int32()),
                pa.array(far[np.arange(len(far)), nearest]),
                pa.array(sums[nearest]),
                pa.array(np.full(len(far), inertia, np.int64)),
                pa.array(digests[nearest], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return chunks.mapInArrow(run, ASSIGNED)


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, components: int = 64, scale: int = 256, chunk_rows: int = 8192) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part."""
    kept = kept_vectors(vectors, components, scale)
    start = starting_vectors(kept, k)
    if not len(start):
        return kept.sparkSession.createDataFrame([], ASSIGNED)
    chunks = encoded_chunks(kept, components, chunk_rows)
    return assigned(chunks, fit(chunks, start, rounds))
