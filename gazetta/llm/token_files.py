"""Token ids in ORC (operator 4).

Documents are range-partitioned by id before they are encoded, so files and the rows in them ascend. ORC writes the ids with
integer run-length encoding in stripes, with row indexes and a Bloom filter on the document id: a reader may take stripes in
parallel, and a filter on ``doc_id`` is answered from the metadata wherever it can be.

Nulls: a NULL text is empty (the end id alone); NULL ids come first. Ties: repeated ids follow in the order of their texts.
An empty table gives an empty file set; extra columns are ignored; a text of any length is one row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazetta.llm.common import slices
from gazetta.llm.tokens import encoder

SCHEMA = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("start_in_part", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])


def encode_rows(docs: DataFrame, tokenizer: str, end_id: int | None = 1) -> DataFrame:
    """Ids of every row, in the order of the rows; ``part`` and ``start_in_part`` say where its ids stand in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for batch in slices(batches, 1024, 4 << 20):
            coded, edges = encoder(tokenizer).encode_column(batch.column("text"), end_id)
            sizes = np.diff(edges)
            ids = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(coded.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(sizes), part, np.int32)), pa.array(start + edges[:-1]), pa.array(sizes), ids], schema=_ARROW
            )
            start += int(edges[-1])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 1, stripe_bytes: int = 64 << 20, index_rows: int = 1000) -> str:
    """Write the ids of all documents in ascending ``doc_id`` order."""
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    (
        encode_rows(ordered, tokenizer, end_id)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(index_rows))
        .option("orc.stripe.size", str(stripe_bytes))
        .option("compression", "zstd")
        .orc(path)
    )
    return path


def read_token_files(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids). With ``doc_ids`` the filter reaches stripes' statistics and Bloom filters."""
    rows = spark.read.schema(SCHEMA).orc(path)
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # one row for each partition written, so of a proven size: it may run in one task and be broadcast
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    wanted = rows if doc_ids is None else rows.where(F.col("doc_id").isin(list(doc_ids)))
    return wanted.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids")


def token_digests(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows that were read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            edges = ids.offsets.to_numpy()
            values = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            crc = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            columns = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
