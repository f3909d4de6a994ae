"""Packing by cutting-stock column generation (operator 1).

Documents are cut at every ``capacity`` tokens; a full piece is a sequence of its own. The remainders are counted by length in
units of capacity/128 (rounded up). Over this histogram, of at most 128 classes whatever the table's size, a linear program
chooses patterns (how many pieces of each length share a sequence) and which lengths to cut in two, at a small cost; a knapsack
recursion prices new patterns until none is worth its sequence. Whole multiples of patterns and cuts are laid out; what rounding
leaves over is packed longest first, cutting one piece to fill a sequence up, so only the last sequence is short.
Documents are ranked within their length by counts per partition (no sort), and a rank says which sequences and
places its pieces get. Checksums at every unit let any piece's checksum be derived without its ids.

Nulls: a NULL text is empty, its piece is the end id. Repeated rows are packed one by one. Ties need no order: any
document of a length class may take any of its places. An empty table gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazetta.llm.common import pin_table, slices
from gazetta.llm.tokens import encoder

UNITS = 128


# --- the linear program over the histogram -----------------------------------------------------------------------------


def price(values: np.ndarray, sizes: np.ndarray, units: int) -> tuple[float, list[np.ndarray]]:
    """Unbounded knapsack: the worth of the best pattern of at most ``units``, and good patterns as counts per size.

    One pass of the recursion gives the best pattern that holds each size; they come most valuable first.
    """
    best, take = np.zeros(units + 1), np.full(units + 1, -1)
    for room in range(1, units + 1):
        fits = np.searchsorted(sizes, room, "right")
        best[room] = best[room - 1]
        if fits:
            gains = best[room - sizes[:fits]] + values[:fits]
            k = int(np.argmax(gains))
            if gains[k] > best[room] + 1e-12:
                best[room], take[room] = gains[k], k

    def filled(first: int) -> np.ndarray:
        pattern, room = np.zeros(len(sizes), np.int64), units - sizes[first]
        pattern[first] = 1
        while room > 0:
            if take[room] < 0:
                room -= 1
            else:
                pattern[take[room]] += 1
                room -= sizes[take[room]]
        return pattern

    worth = values + best[units - sizes]
    return float(best[units]), [filled(int(k)) for k in np.argsort(-worth, kind="stable")[:24]]


def column_generation(
    demand: np.ndarray, cut_cost: float = 0.002, gap: float = 1e-3, rounds: int = 5_000
) -> tuple[list[tuple[float, np.ndarray]], list[tuple[float, int, int]]]:
    """Fractional uses of patterns (counts per size 1, 2 ...) and of cuts (size, size of the first part).

    Revised simplex on the restricted master program over all sizes; a cut meets the demand for its size and makes demand
    for both parts. It ends at the optimum or where the bound ``used / price`` shows that no more than the share ``gap`` can be saved.
    """
    units = len(demand)
    sizes = np.arange(1, units + 1)
    columns, cost = np.diag(units // sizes).astype(float), np.ones(units)
    inverse = np.diag(1.0 / np.diag(columns))
    used = inverse @ demand

    def enter(new: np.ndarray, price_of: float) -> None:
        nonlocal used, inverse
        step = inverse @ new
        ratios = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratios))
        amount = ratios[out]
        used = np.maximum(used - amount * step, 0.0)
        used[out] = amount
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        columns[:, out], cost[out] = new, price_of

    whole, first = np.array([(s, t) for s in sizes for t in range(1, s // 2 + 1)]).T
    for _ in range(rounds):
        duals = cost @ inverse
        worst = int(np.argmin(duals))
        if duals[worst] < -1e-9:  # a place too many of this size costs nothing
            enter(-np.eye(units)[worst], 0.0)
            continue
        gain = duals[whole - 1] - duals[first - 1] - duals[whole - first - 1]
        cuts = np.argsort(-gain, kind="stable")[:8]
        for k in cuts[gain[cuts] > cut_cost + 1e-6]:
            column = np.zeros(units)
            column[whole[k] - 1] = 1
            np.subtract.at(column, [first[k] - 1, whole[k] - first[k] - 1], 1)
            if column @ (cost @ inverse) > cut_cost + 1e-6:  # the prices have moved since
                enter(column, cut_cost)
        if gain[cuts[0]] > cut_cost + 1e-6:
            continue
        worth, found = price(duals, sizes, units)
        if worth <= 1 + gap:
            break
        for new in found:
            if new @ (cost @ inverse) > 1 + gap / 2:
                enter(new.astype(float), 1.0)
    patterns = [(float(used[k]), np.rint(columns[:, k]).astype(np.int64)) for k in range(units) if cost[k] == 1.0 and used[k] > 0]
    halved = []
    for k in range(units):
        if cost[k] == cut_cost and used[k] > 0:
            parts = np.flatnonzero(columns[:, k] < 0) + 1
            halved.append((float(used[k]), int(np.flatnonzero(columns[:, k] > 0)[0]) + 1, int(parts[0])))
    return patterns, halved


class _Pieces:
    """Pieces of each size, as runs of documents: (their remainder's size, first rank, documents, first unit)."""

    def __init__(self, counts: dict[int, int]):
        self.runs: dict[int, list[tuple[int, int, int, int]]] = {s: [(s, 0, n, 0)] for s, n in counts.items() if n > 0}

    def count(self, size: int) -> int:
        return sum(r[2] for r in self.runs.get(size, []))

    def take(self, size: int, n: int) -> list[tuple[int, int, int, int]]:
        """Up to n pieces of a size."""
        out, runs = [], self.runs.get(size, [])
        while n > 0 and runs:
            own, rank, number, start = runs.pop()
            if number > n:
                runs.append((own, rank + n, number - n, start))
                number = n
            out.append((own, rank, number, start))
            n -= number
        return out

    def cut(self, size: int, first: int, n: int) -> None:
        for own, rank, number, start in self.take(size, n):
            self.runs.setdefault(first, []).append((own, rank, number, start))
            self.runs.setdefault(size - first, []).append((own, rank, number, start + first))


@dataclass(frozen=True)
class Layout:
    """Where pieces go. ``key`` = size * 2^40 + first rank of an interval of documents whose pieces lie in the same ``rows``."""

    key: np.ndarray
    first_row: np.ndarray
    n_rows: np.ndarray
    rows: np.ndarray
    rank: np.ndarray
    seq: np.ndarray
    per_seq: np.ndarray
    slot: np.ndarray
    order: np.ndarray
    unit_from: np.ndarray
    unit_len: np.ndarray
    sequences: int


def lay_out(counts: dict[int, int], units: int = UNITS) -> Layout:
    """Sequences for ``counts`` remainders of each size. Its rows are bounded by the classes, not by the documents."""
    pieces = _Pieces(counts)
    rows: list[tuple[int, ...]] = []  # size, rank, documents, seq, per_seq, slot, order, unit_from, unit_len
    seq = 0
    if pieces.runs:
        patterns, cuts = column_generation(np.array([counts.get(s, 0) for s in range(1, units + 1)], float))
        for amount, size, first in sorted(cuts, key=lambda c: -c[1]):  # parts are smaller, so they are there when their turn comes
            pieces.cut(size, first, int(amount + 1e-9))
        for amount, pattern in patterns:
            times, order = int(amount + 1e-9), 0
            if not times:
                continue
            for size in (np.flatnonzero(pattern) + 1).tolist():
                per_seq, slot = int(pattern[size - 1]), 0
                for own, rank, number, start in pieces.take(size, per_seq * times):  # a place too many stays empty
                    rows.append((own, rank, number, seq, per_seq, slot, order, start, size))
                    slot += number
                order += per_seq
            seq += times
    # the rest: longest first; where nothing fits any more, one piece is cut
    while any(pieces.runs.values()):
        room, order = units, 0
        while room and (left := [s for s, runs in pieces.runs.items() if runs]):
            size = max([s for s in left if s <= room], default=0)
            if not size:
                size = room
                pieces.cut(max(left), room, 1)
            ((own, rank, _, start),) = pieces.take(size, 1)
            rows.append((own, rank, 1, seq, 1, 0, order, start, size))
            room -= size
            order += 1
        seq += 1
    return _indexed(np.array(rows, np.int64).reshape(-1, 9), seq)


def _indexed(table: np.ndarray, sequences: int) -> Layout:
    """Intervals of ranks within each size between which the covering rows change."""
    key, first, number, flat = [], [], [], []
    for size in np.unique(table[:, 0]).tolist():
        own = np.flatnonzero(table[:, 0] == size)
        begin, end = table[own, 1], table[own, 1] + table[own, 2]
        edges = np.unique(np.concatenate([begin, end]))[:-1]
        for edge in edges.tolist():
            cover = own[(begin <= edge) & (edge < end)]
            key.append((size << 40) + edge)
            first.append(len(flat))
            number.append(len(cover))
            flat.extend(cover.tolist())
    index = [np.array(x, np.int64) for x in (key, first, number, flat)]
    return Layout(*index, *(table[:, k] for k in (1, 3, 4, 5, 6, 7, 8)), sequences)


# --- checksums of parts ---------------------------------------------------------------------------------------------------


@lru_cache(maxsize=2)
def _zero_operators(tokens: int) -> np.ndarray:
    """For n = 0 ... tokens the crc32 after n zero tokens of each single bit: the map is linear over the bits."""
    table = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
    out = np.zeros((tokens + 1, 32), np.uint32)
    out[0] = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for n in range(tokens):
        state = out[n]
        for _ in range(4):
            state = (state >> np.uint32(8)) ^ table[state & np.uint32(0xFF)]
        out[n + 1] = state
    return out


def part_crc32(before: np.ndarray, through: np.ndarray, tokens: np.ndarray, most: int) -> np.ndarray:
    """Checksums of parts from those of the text before them and of the text through them, and their lengths."""
    operators, moved = _zero_operators(most), np.zeros(len(before), np.uint32)
    before = before.astype(np.uint32)
    for bit in range(32):
        moved ^= np.where(before >> np.uint32(bit) & np.uint32(1), operators[tokens, bit], np.uint32(0))
    return moved ^ through.astype(np.uint32)


# --- the tables ---------------------------------------------------------------------------------------------------------

_COUNTED = "doc_id long, part int, size int, rank long, full_rank long, doc_tokens long, full_crc32 array<long>, rest_crc32 binary"


def count_tokens(docs: DataFrame, tokenizer: str, end_id: int | None, capacity: int) -> DataFrame:
    """One row per document: its tokens, its rank within its partition and length, and checksums.

    ``full_crc32`` are those of the full pieces, ``rest_crc32`` of the remainder up to every unit and its end, as little-endian 32-bit integers.
    """

    unit = capacity // UNITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, full = TaskContext.get().partitionId(), [0] * (UNITS + 1), 0
        step, small = 4 * capacity, 4 * unit
        for batch in slices(batches, 1024, 4 << 20):
            out: dict[str, list] = {k: [] for k in ("size", "rank", "full_rank", "doc_tokens", "full_crc32", "rest_crc32")}
            ids, edges = encoder(tokenizer).encode_column(batch.column("text"), end_id)
            held = memoryview(ids.astype("<u4")).cast("B")
            for begin, stop in itertools.pairwise((4 * edges).tolist()):
                data = held[begin:stop]
                whole = len(data) // step
                rest, crc, sums = data[whole * step :], 0, []
                for at in range(0, len(rest), small):
                    crc = zlib.crc32(rest[at : at + small], crc)
                    sums.append(crc)
                out["size"].append(len(sums))
                out["rank"].append(seen[len(sums)])
                out["full_rank"].append(full)
                out["doc_tokens"].append(len(data) // 4)
                out["full_crc32"].append([zlib.crc32(data[i * step : (i + 1) * step]) for i in range(whole)])
                out["rest_crc32"].append(np.array(sums, "<u4").tobytes())
                seen[len(sums)] += 1
                full += whole
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([part] * batch.num_rows, pa.int32()),
                    pa.array(out["size"], pa.int32()),
                    *(pa.array(out[k], pa.int64()) for k in ("rank", "full_rank", "doc_tokens")),
                    pa.array(out["full_crc32"], pa.list_(pa.int64())),
                    pa.array(out["rest_crc32"], pa.binary()),
                ],
                names=["doc_id", "part", "size", "rank", "full_rank", "doc_tokens", "full_crc32", "rest_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _COUNTED)


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, place int"
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "place"]


def _assign(counted: DataFrame, layout: Layout, capacity: int) -> DataFrame:
    """Pieces with their sequence and place in it; full pieces have place -1."""

    unit = capacity // UNITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            size, rank, tokens, full_at = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("size", "rank", "doc_tokens", "full_at"))
            rank, ids = rank + batch.column("base").to_numpy(zero_copy_only=False), batch.column("doc_id")
            rest = np.flatnonzero(size > 0)
            at = np.searchsorted(layout.key, (size[rest].astype(np.int64) << 40) + rank[rest], "right") - 1
            n = layout.n_rows[at]
            doc, nth = np.repeat(rest, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            row = layout.rows[np.repeat(layout.first_row[at], n) + nth]
            slot = layout.slot[row] + rank[doc] - layout.rank[row]
            whole = tokens // capacity * capacity
            lo = layout.unit_from[row] * unit
            last = layout.unit_from[row] + layout.unit_len[row]
            hi = np.minimum(last * unit, (tokens - whole)[doc])
            sums = np.frombuffer(b"".join(batch.column("rest_crc32").to_pylist()), "<u4")
            begin = (np.cumsum(size) - size)[doc]
            before = np.where(lo > 0, sums[begin + np.maximum(layout.unit_from[row] - 1, 0)], 0) if len(doc) else lo
            through = sums[begin + last - 1] if len(doc) else lo
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(doc)),
                    pa.array(whole[doc] + lo),
                    pa.array(hi - lo),
                    pa.array(part_crc32(before, through, hi - lo, capacity).astype(np.int64)),
                    pa.array(tokens[doc]),
                    pa.array(layout.seq[row] + slot // layout.per_seq[row]),
                    pa.array((layout.order[row] + slot % layout.per_seq[row]).astype(np.int32)),
                ],
                names=_NAMES,
            )
            full = batch.column("full_crc32")
            flat, sizes = full.flatten().to_numpy(zero_copy_only=False), np.diff(full.offsets.to_numpy())
            doc = np.repeat(np.arange(batch.num_rows), sizes)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(doc)),
                    pa.array(nth * capacity),
                    pa.array(np.full(len(doc), capacity, np.int64)),
                    pa.array(flat.astype(np.int64)),
                    pa.array(tokens[doc]),
                    pa.array(layout.sequences + full_at[doc] + nth),
                    pa.array(np.full(len(doc), -1, np.int32)),
                ],
                names=_NAMES,
            )

    return counted.mapInArrow(run, _PIECES)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int | None = 1) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece, each id in exactly one."""
    if capacity % UNITS:
        raise ValueError(f"capacity must be a multiple of {UNITS}")
    counted = pin_table(count_tokens(docs, tokenizer, end_id, capacity), "pack-counted")
    # at most 128 classes per partition; their running sums go by class, one row for each partition
    counts = counted.groupBy("part", "size").agg(F.count("*").alias("n"))
    fulls = counted.groupBy("part").agg(F.sum(F.size("full_crc32")).cast("long").alias("n")).select("part", F.lit(-1).alias("size"), "n")
    parts = counts.unionByName(fulls)
    totals = {r["size"]: r["n"] for r in parts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    layout = lay_out({s: n for s, n in totals.items() if s > 0})
    earlier = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).groupBy("part")
    bases = bases.agg(F.map_from_entries(F.collect_list(F.struct("size", "base"))).alias("bases"))
    ranked = counted.join(bases, "part").select(
        "*", F.coalesce(F.col("bases")[F.col("size")], F.lit(0)).alias("base"), (F.col("full_rank") + F.col("bases")[F.lit(-1)]).alias("full_at")
    )
    pieces = pin_table(_assign(ranked.drop("bases"), layout, capacity), "pack-pieces")
    before = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    columns = _NAMES[:-1]
    shared = pieces.where("place >= 0").select(*columns, F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))
    return pieces.where("place < 0").select(*columns, F.lit(0).cast("long").alias("offset")).unionByName(shared)


def packed_ids(docs: DataFrame, pieces: DataFrame, tokenizer: str, end_id: int | None = 1) -> DataFrame:
    """The sequences themselves: (sequence_id, doc_ids, ids), pieces in the order of their offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, edges = encoder(tokenizer).encode_column(batch.column("text"), end_id)
            coded = np.split(ids, edges[1:-1])
            own = batch.column("pieces").to_pylist()
            rows = [(d, p["sequence_id"], p["offset"], c[p["start"] : p["start"] + p["length"]].tolist()) for d, c, ps in zip(batch.column("doc_id").to_pylist(), coded, own, strict=True) for p in ps]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())))], names=["doc_id", "sequence_id", "offset", "ids"])

    lists = pieces.groupBy("doc_id").agg(F.collect_list(F.struct("sequence_id", "offset", "start", "length")).alias("pieces"))
    cut = docs.select(F.col("doc_id").cast("long"), "text").join(lists, "doc_id").mapInArrow(run, "doc_id long, sequence_id long, offset long, ids array<int>")
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return cut.groupBy("sequence_id").agg(ordered.alias("p")).select("sequence_id", F.col("p.doc_id").alias("doc_ids"), F.flatten("p.ids").alias("ids"))
