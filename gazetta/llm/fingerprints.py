"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests (operator 5).

A text is cut into paragraphs: at line feeds and sentence ends, and after ``LONGEST`` bytes where there is neither. Each paragraph (with
its number among equal ones) has a 64-bit digest that is put into three cells of the sketch; a cell holds how many digests it
has, their exclusive or and that of their checksums. Subtracting two versions' cells leaves the digests that only one of them has, and peeling recovers them: a cell with
a single digest names it, and taking it out of its other cells frees further ones. Where peeling gets stuck, the
difference was too large for the sketch, and both are drawn again with four times the cells. Likeness is the share of
digests that both have among all; the fingerprint is the sketch of ``CELLS`` cells, in Base64.

Nulls: a NULL text is empty (a sketch of empty cells); two empty texts have likeness 1. Documents follow each other by id, equal ids by text;
NULL ids come first. A table of one document compares it with itself. Empty tables give an empty result, extra columns are ignored, and repeated rows are documents of their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazetta.llm.common import mix64, pin_table, slices, texts

CELLS = 24
HASHES = 3
LONGEST = 256
_PARAGRAPHS = re.compile(rb"[^\n.!?]{1,%d}[\n.!?]*|[\n.!?]+" % LONGEST).findall
_CELL = np.dtype([("count", "<i4"), ("digests", "<u8"), ("checks", "<u4")])


def paragraphs(text: str) -> list[bytes]:
    return _PARAGRAPHS(text.encode())


def digests(text: str) -> np.ndarray:
    """64-bit digests of a text's paragraphs; the n-th of equal ones has a digest of its own."""
    seen: dict[bytes, int] = {}
    out = []
    for part in paragraphs(text):
        nth = seen.get(part, 0)
        seen[part] = nth + 1
        digest = xxhash.xxh3_64_digest(part)
        out.append(xxhash.xxh3_64_intdigest(digest + nth.to_bytes(8, "little")) if nth else int.from_bytes(digest, "big"))
    # a digest must be in a sketch once: equal ones would cancel each other
    return np.unique(np.array(out, np.uint64))


def _places(values: np.ndarray, cells: int) -> list[np.ndarray]:
    """One cell in each third of the sketch."""
    third = np.uint64(cells // HASHES)
    return [(mix64(values + np.uint64(0x9E37 * (j + 1))) % third).astype(np.int64) + j * int(third) for j in range(HASHES)]


def _checks(values: np.ndarray) -> np.ndarray:
    return mix64(values ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)


def sketch(values: np.ndarray, owner: np.ndarray, n: int, cells: int) -> list[np.ndarray]:
    """Counts, digests and checksums of n sketches, one after the other."""
    count, keys, checks = np.zeros(n * cells, np.int64), np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.uint64)
    marks = _checks(values)
    for place in _places(values, cells):
        at = owner * cells + place
        count += np.bincount(at, minlength=n * cells)
        np.bitwise_xor.at(keys, at, values)
        np.bitwise_xor.at(checks, at, marks)
    return [count, keys, checks]


def peel(cells: list[np.ndarray], n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of n subtracted sketches: which are recovered whole, and (sketch, digest, sign) of every digest found."""
    count, keys, checks = (x.copy() for x in cells)
    whose, what, sign = [], [], []
    while True:
        single = np.flatnonzero(np.abs(count) == 1)
        single = single[_checks(keys[single]) == checks[single]]
        if not len(single):
            break
        pair, value, side = single // size, keys[single], count[single]
        order = np.lexsort((value, pair))
        new = np.concatenate([[True], (pair[order][1:] != pair[order][:-1]) | (value[order][1:] != value[order][:-1])])
        pick = order[new]
        pair, value, side = pair[pick], value[pick], side[pick]
        marks = _checks(value)
        for place in _places(value, size):
            at = pair * size + place
            np.subtract.at(count, at, side)
            np.bitwise_xor.at(keys, at, value)
            np.bitwise_xor.at(checks, at, marks)
        whose.append(pair)
        what.append(value)
        sign.append(side)
    left = (count != 0) | (keys != 0) | (checks != 0)
    whole = ~left.reshape(n, size).any(axis=1)
    none = np.zeros(0, np.int64)
    return whole, *(np.concatenate(x) if x else none for x in (whose, what, sign))


def differences(first: list[np.ndarray], second: list[np.ndarray], cells: int = CELLS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per pair the digests that only the first and only the second has, by subtracting and peeling, larger on failure."""
    n = len(first)
    out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * n
    rest = np.arange(n)
    while len(rest):
        # one retry's sketches take no more memory than this many digests need, whatever the texts' lengths
        late = []
        for part in np.array_split(rest, min(len(rest), max(1, -(-len(rest) * cells // 2_000_000)))):
            a, b = ([x[i] for i in part.tolist()] for x in (first, second))
            sides = [sketch(np.concatenate(x), np.repeat(np.arange(len(part)), [len(y) for y in x]), len(part), cells) for x in (a, b)]
            cut = [sides[0][0] - sides[1][0], sides[0][1] ^ sides[1][1], sides[0][2] ^ sides[1][2]]
            whole, whose, what, sign = peel(cut, len(part), cells)
            order = np.argsort(whose, kind="stable")
            edges = np.searchsorted(whose[order], np.arange(len(part) + 1))
            for k, i in enumerate(part.tolist()):
                if whole[k]:
                    own = order[edges[k] : edges[k + 1]]
                    out[i] = what[own[sign[own] > 0]], what[own[sign[own] < 0]]
                else:
                    late.append(i)
        rest = np.array(late, np.int64)
        cells *= 4
    return out


def likeness(first: list[np.ndarray], second: list[np.ndarray]) -> list[float]:
    """Digests that both have among all that either has."""
    out = []
    for a, b, (x, y) in zip(first, second, differences(first, second), strict=True):
        common = len(a) - len(x)
        every = len(a) + len(b) - common
        assert len(b) - len(y) == common
        out.append(common / every if every else 1.0)
    return out


def encoded(values: list[np.ndarray], cells: int = CELLS) -> list[bytes]:
    """Fingerprints: the sketches of all digests as bytes."""
    if not values:
        return []
    count, keys, checks = sketch(np.concatenate(values), np.repeat(np.arange(len(values)), [len(x) for x in values]), len(values), cells)
    packed = np.zeros(len(count), _CELL)
    packed["count"], packed["digests"], packed["checks"] = count, keys, checks
    return [x.tobytes() for x in packed.reshape(len(values), cells)]


_ROWS = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def edited(text: str, following: str) -> str:
    """The last half replaced by as much of the beginning of the text that follows."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(ids: list, own: list[str], following: list[str], marks: list[np.ndarray], next_marks: list[np.ndarray]) -> list[pa.Array]:
    changed = [edited(a, b) for a, b in zip(own, following, strict=True)]
    other = [digests(x) for x in changed]
    return [
        pa.array(ids, pa.int64()),
        pa.array([len(x) for x in own], pa.int64()),
        pa.array([hashlib.sha256(x.encode()).digest() for x in changed], pa.binary()),
        pa.array(encoded(marks), pa.binary()),
        pa.array(encoded(other), pa.binary()),
        pa.array(likeness(marks, other), pa.float64()),
        pa.array(likeness(marks, next_marks), pa.float64()),
    ]


def compare_versions(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they are; one row per document."""
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, carried = TaskContext.get().partitionId(), None

        def edge(kind: str, doc_id, text: str) -> pa.RecordBatch:
            nothing = [pa.nulls(1, t) for t in (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), *nothing, pa.array([kind]), pa.array([part], pa.int32()), pa.array([text])], names=[*_NAMES, "kind", "part", "text"])

        for batch in slices(batches, 256, 4 << 20):
            ids, own = batch.column("doc_id").to_pylist(), texts(batch.column("text"))
            marks = [digests(t) for t in own]
            if carried is None:
                yield edge("first", ids[0], own[0])
            else:
                ids, own, marks = [carried[0], *ids], [carried[1], *own], [carried[2], *marks]
            carried = ids[-1], own[-1], marks[-1]
            n = len(ids) - 1
            if n:
                rows = _compared(ids[:-1], own[:-1], own[1:], marks[:-1], marks[1:])
                yield pa.RecordBatch.from_arrays([*rows, pa.array(["row"] * n), pa.array([part] * n, pa.int32()), pa.nulls(n, pa.string())], names=[*_NAMES, "kind", "part", "text"])
        if carried is not None:
            yield edge("last", carried[0], carried[1])

    found = pin_table(ordered.mapInArrow(run, f"{_ROWS}, kind string, part int, text string"), "fingerprints")
    # the last document of a partition is followed by the first of the next; two rows per partition, texts joined by partition
    firsts = found.where("kind = 'first'").select("part", F.col("text").alias("following"))
    everywhere = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("part").over(Window.orderBy("part")), F.max("part").over(everywhere))
    parts = firsts.select("part", before.alias("before"))
    lasts = found.where("kind = 'last'").select("doc_id", "part", "text")
    joined = lasts.join(parts.select(F.col("part").alias("next_part"), F.col("before").alias("part")), "part")
    joined = joined.join(firsts.withColumnRenamed("part", "next_part"), "next_part").select("doc_id", "text", "following")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64, 4 << 20):
            own, following = texts(batch.column("text")), texts(batch.column("following"))
            rows = _compared(batch.column("doc_id").to_pylist(), own, following, [digests(t) for t in own], [digests(t) for t in following])
            yield pa.RecordBatch.from_arrays(rows, names=_NAMES)

    rows = found.where("kind = 'row'").select(*_NAMES).unionByName(joined.mapInArrow(close, _ROWS))
    # bytes are pinned, text comes out
    texts_of = {"edited_sha256": F.lower(F.hex("edited_sha256")), "fingerprint": F.base64("fingerprint"), "edited_fingerprint": F.base64("edited_fingerprint")}
    return rows.withColumns(texts_of)
