"""Line dedup with per-document keep bitmaps (operator 9).

Each document sends one row per distinct long line: the line's 128-bit hash, its id and the positions, no text. The rows are
range-partitioned by hash and id and sorted by hash, id (descending) and position; a partition streams through them, keeps the
first document of each hash and drops the others from the fifth on (and the four held back). The ranges include the id,
so a line that a third of all documents share is split over many partitions; what a partition cannot decide alone (its
first hash, and the held-back rows of its last) is decided by two summary rows per partition. The result is a compressed
bitmap per document that loses lines; texts meet their bitmaps in one join.

Nulls: a NULL text is one empty line; documents with a NULL id keep all lines and count for nobody. Rows with the same id are
one document. Ties cannot occur: the largest id keeps. An empty table gives an empty result; other columns stay as they are.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm.common import pin_table, release, slices, utf8

_SPACE = b" \t\n\x0b\x0c\r"
_KEY = ["doc_id", "text_key"]


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends, A-Z in lower case."""
    return line.strip(_SPACE).lower()


def line_rows(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """(h1, h2, doc_id, text_key, positions): one row per document and distinct line of at least ``min_chars`` code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in slices(batches):
            hashes, owner, places = [], [], []
            for i, text in enumerate(utf8(batch.column("text"))):
                found: dict[bytes, list[int]] = {}
                for at, line in enumerate(text.split(b"\n")):
                    if len(line) >= min_chars:
                        key = line_key(line)
                        if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
                            found.setdefault(xxhash.xxh3_128_digest(key), []).append(at)
                for digest, at in found.items():
                    hashes.append(digest)
                    owner.append(i)
                    places.append(np.array(at, "<u4").tobytes())
            pair = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            rows = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[:, 0]), pa.array(pair[:, 1]), *(batch.column(c).take(rows) for c in _KEY), pa.array(places, pa.binary())],
                names=["h1", "h2", *_KEY, "positions"],
            )

    return _keyed(docs).where("doc_id IS NOT NULL").mapInArrow(run, "h1 long, h2 long, doc_id long, text_key long, positions binary")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").alias("text"))


_FOUND = "kind string, h1 long, h2 long, doc_id long, text_key long, positions binary, n long"


def _stream(min_docs: int):
    """Over sorted rows of one partition: dropped rows, rows it can't decide, and summaries of its first and last hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, count, top, last = None, True, 0, None, None
        held: list[tuple] = []
        out: list[tuple] = []

        def close(at_end: bool) -> None:
            if key is None or (not first and not at_end):
                held.clear()
                return
            out.append(("summary", *key, top, 0, b"", count))
            if not first:  # the last hash; what is held back may yet be dropped
                out.extend(("open", *key, *row, 0) for row in held)
            held.clear()

        def flush() -> pa.RecordBatch:
            types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
            batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["kind", "h1", "h2", *_KEY, "positions", "n"])
            out.clear()
            return batch

        for batch in slices(batches, 8192):
            h1, h2 = batch.column("h1").to_pylist(), batch.column("h2").to_pylist()
            rows = zip(h1, h2, batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), batch.column("positions").to_pylist(), strict=True)
            for a, b, doc, text_key, positions in rows:
                if key != (a, b):
                    close(False)
                    first = key is None
                    key, count, top, last = (a, b), 0, doc, None
                if doc != last:
                    count += 1
                    last = doc
                if first:
                    out.append(("open", a, b, doc, text_key, positions, 0))
                elif doc == top:
                    if count == 1:
                        held.append((doc, text_key, positions))
                elif count >= min_docs:
                    out.extend(("drop", a, b, *row, 0) for row in held if row[0] != top)
                    held.clear()
                    out.append(("drop", a, b, doc, text_key, positions, 0))
                else:
                    held.append((doc, text_key, positions))
            yield flush()
        close(True)
        yield flush()

    return run


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, text_key, bitmap) of the documents that lose lines.

    ``bitmap`` is a zlib-compressed bit per line, 1 to keep; lines after its end are kept. ``text_key`` is xxhash64 of the text.
    """
    rows = pin_table(line_rows(docs, min_chars), "line-rows")  # the ranges are sampled from it, so lines are hashed once
    dealt = rows.repartitionByRange("h1", "h2", F.col("doc_id").desc())
    ordered = dealt.sortWithinPartitions("h1", "h2", F.col("doc_id").desc(), "positions")
    found = pin_table(ordered.mapInArrow(_stream(min_docs), _FOUND), "line-drops")
    # two rows per partition at most: small enough to broadcast at any size
    whole = found.where("kind = 'summary'").groupBy("h1", "h2").agg(F.sum("n").alias("docs"), F.max("doc_id").alias("top"))
    late = found.where("kind = 'open'").select("h1", "h2", *_KEY, "positions").join(F.broadcast(whole), ["h1", "h2"])
    late = late.where((F.col("docs") >= min_docs) & (F.col("doc_id") < F.col("top")))
    drops = found.where("kind = 'drop'").select(*_KEY, "positions").unionByName(late.select(*_KEY, "positions"))

    def pack_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bitmaps = []
            for parts in batch.column("parts").to_pylist():
                at = np.frombuffer(b"".join(parts), "<u4")
                keep = np.ones(int(at.max()) + 1, bool)
                keep[at] = False
                bitmaps.append(zlib.compress(np.packbits(keep).tobytes() + bytes([len(keep) % 8])))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _KEY), pa.array(bitmaps, pa.binary())], names=[*_KEY, "bitmap"])

    # a document's own lines: as many parts as it has lines
    return drops.groupBy(*_KEY).agg(F.collect_list("positions").alias("parts")).mapInArrow(pack_bits, "doc_id long, text_key long, bitmap binary")


def dropped(bitmap: bytes | None) -> np.ndarray:
    """Positions that a bitmap drops."""
    if bitmap is None:
        return np.zeros(0, np.int64)
    data = zlib.decompress(bitmap)
    bits = np.unpackbits(np.frombuffer(data[:-1], np.uint8))
    return np.flatnonzero(bits[: len(bits) - (8 - data[-1]) % 8] == 0)


_CLEANED = "n_lines long, n_dropped long, kept_sha256 string"


def with_kept_lines(docs: DataFrame, bitmaps: DataFrame, whole: bool = True) -> DataFrame:
    """(row, n_lines, n_dropped, kept_sha256): each row as a struct whose text is without the dropped lines, or without its text.

    The text goes along in its row, once. A partition's bitmaps are far smaller than its texts: they are hashed, no text is sorted.
    """
    held = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"))
    joined = held.join(bitmaps.hint("shuffle_hash"), _KEY, "left").select("row", "bitmap")
    at = [c.lower() for c in docs.columns].index("text")
    fields = [f"`{f.name.replace('`', '``')}`: {f.dataType.simpleString()}" for i, f in enumerate(docs.schema) if whole or i != at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in slices(batches):
            row = batch.column("row")
            columns = dict(enumerate(row.flatten()))
            n_lines, n_dropped, kept, digests = [], [], [], []
            for text, bitmap in zip(utf8(columns[at]), batch.column("bitmap").to_pylist(), strict=True):
                lines = text.split(b"\n")
                drop = set(dropped(bitmap).tolist())
                rest = b"\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else text
                n_lines.append(len(lines))
                n_dropped.append(len(drop))
                kept.append(rest if drop else None)
                digests.append(hashlib.sha256(rest).hexdigest())
            if whole:
                columns[at] = pc.coalesce(pa.array(kept, pa.binary()).cast(columns[at].type), columns[at])
            else:
                del columns[at]
            rows = pa.StructArray.from_arrays(list(columns.values()), fields=[row.type.field(i) for i in columns])
            yield pa.RecordBatch.from_arrays(
                [rows, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(digests)], names=["row", "n_lines", "n_dropped", "kept_sha256"]
            )

    return joined.mapInArrow(run, f"row struct<{', '.join(fields)}>, {_CLEANED}")


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The table with repeated lines dropped from ``text``; other columns as they are (``n_chars``, if there, counted anew)."""
    cleaned = with_kept_lines(docs, keep_bitmaps(docs, min_chars, min_docs))
    new = {}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("row.text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return cleaned.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def line_digests(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row."""
    own = docs.select("doc_id", "text")
    cleaned = with_kept_lines(own, keep_bitmaps(own, min_chars, min_docs), whole=False)
    return cleaned.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", "kept_sha256")
