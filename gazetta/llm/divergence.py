"""Source divergence audit with count-level bitmaps (operator 12).

Within a language every (lang, source) group gives each kept term a smoothed share that depends only on how often the term
occurs in the group. So a group is stored as bitsets of term ids, one per count that occurs: 64 neighbouring ids are a word of
the bitset, and only words with a bit set are rows. For two groups the AND of two such words and its population count are the
number of terms that have both counts (a joint cell), which is multiplied by the divergence of the two shares. Terms that a group
lacks are the complement of its bitsets within the word.

Term ids are numbered along falling frequency within a partition, so that the words of rare terms hold few counts. A task gets
all groups of one tile of sources against those of another for a block of words; the tasks' sums are added up. Shares are
computed with decimals, per count and not per term, so they stay exact for counts of any size; a divergence fits 64 bits for up to
10^9 kept terms.

Nulls: text, lang and source that are NULL count as empty. Empty texts and groups without kept terms still make a group; a
language without kept terms gives 0 for every pair. Repeated rows are documents of their own. Ties go to the smaller item in
UTF-8 order. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.llm.common import pin_table, slices

UNIT = 1_000_000_000
COUNTS = "lang string, source string, term string, n long, docs long"
#: Bitset words of one side that meet all of the other side at once.
ROWS = 256
SUMS = "lang string, source string, item string, value long"
#: Bytes to what a term keeps: letters in lower case, other ASCII to blanks, the rest as it is.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Per occurrence the number of its text and the code of its term, and the terms."""
    text = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    folded = memoryview(text.buffers()[2])[offsets[0] : offsets[-1]].tobytes().translate(_FOLD) if text.buffers()[2] else b""
    folded = pa.LargeStringArray.from_buffers(len(text), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(folded))
    parts = pc.split_pattern(folded, " ")
    rows, flat = pc.list_parent_indices(parts), pc.list_flatten(parts)
    filled = pc.not_equal(flat, "")
    words = pc.dictionary_encode(pc.filter(flat, filled))
    return pc.filter(rows, filled).to_numpy(zero_copy_only=False), words.indices.to_numpy(zero_copy_only=False), words.dictionary


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Occurrences and documents per (lang, source, term) of a batch; a row without a term for every group."""
    names = [pc.dictionary_encode(pc.fill_null(batch.column(c), "")) for c in ("lang", "source")]
    lang, source = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in names)
    group = lang * len(names[1].dictionary) + source
    rows, codes, terms = _terms(batch.column("text"))
    many = max(1, len(terms))
    of_text, n = np.unique(rows.astype(np.int64) * many + codes, return_counts=True)
    of_row, term = np.divmod(of_text, many)
    key, at = np.unique(group[of_row] * many + term, return_inverse=True)
    occurrences = np.bincount(at, n, len(key)).astype(np.int64) if len(key) else np.zeros(0, np.int64)
    documents = np.bincount(at, minlength=len(key)).astype(np.int64)
    own, term = np.divmod(key, many)
    every = np.unique(group)
    groups = np.concatenate([own, every])
    lang, source = np.divmod(groups, len(names[1].dictionary))
    columns = [
        names[0].dictionary.take(pa.array(lang)),
        names[1].dictionary.take(pa.array(source)),
        pa.concat_arrays([terms.cast(pa.string()).take(pa.array(term)), pa.nulls(len(every), pa.string())]),
        pa.array(np.concatenate([occurrences, np.zeros(len(every), np.int64)])),
        pa.array(np.concatenate([documents, np.zeros(len(every), np.int64)])),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])


def term_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs), and one row with a NULL term per (lang, source)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=10_000, max_bytes=32 << 20):
            if batch.num_rows:
                yield _counted(batch)

    own = documents.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")])
    parts = own.mapInArrow(run, COUNTS)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least: int = 3) -> DataFrame:
    """(lang, term, total, postings, id): terms in enough documents of their language, with one (source, n) per source.

    Ids run without gaps within a partition, by falling frequency, and the table is written once so that they stay.
    """
    posting = F.struct("source", "n")
    terms = counts.where("term IS NOT NULL").groupBy("lang", "term")
    terms = terms.agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.collect_list(posting).alias("postings"))
    terms = terms.where(F.col("docs") >= least).drop("docs").sortWithinPartitions("lang", F.desc("total"), "term")
    return pin_table(terms.withColumn("id", F.monotonically_increasing_id()), "terms")


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 1) / (total + terms)), exact for any 64-bit counts."""
    above = F.lit(UNIT).cast("decimal(38,0)") * (n + 1).cast("decimal(20,0)")
    return F.call_function("div", above, (total + terms).cast("decimal(20,0)")) + F.lit(1)


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def group_sizes(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, size, terms, lang_size, zero): sums over kept terms, their number, and the share of a count of 0."""
    groups = counts.where("term IS NULL").select("lang", "source").distinct()
    occurrences = terms.select("lang", F.explode("postings").alias("p")).groupBy("lang", F.col("p.source").alias("source")).agg(F.sum("p.n").alias("size"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_size"))
    sizes = groups.join(occurrences, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["size", "terms", "lang_size"])
    zero = F.when(F.col("terms") > 0, share(F.lit(0), F.col("size"), F.col("terms")))
    return sizes.withColumn("zero", zero)


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(63).cast("int"))


def _block(words: int) -> Column:
    return F.floor(F.col("word") / words)


def bitmaps(terms: DataFrame) -> DataFrame:
    """(lang, source, n, word, bits): term ids of a group that occur n times, 64 ids a word; words without a bit have no row."""
    rows = terms.select("lang", "id", F.explode("postings").alias("p"))
    rows = rows.select("lang", F.col("p.source").alias("source"), F.col("p.n").alias("n"), F.shiftright("id", 6).alias("word"), _bit(F.col("id")).alias("bit"))
    return rows.groupBy("lang", "source", "n", "word").agg(F.bit_or("bit").alias("bits"))


def _with_sizes(rows: DataFrame, sizes: DataFrame, salts: int, spread: Column) -> DataFrame:
    """Join on (lang, source), large groups dealt to several keys."""
    wide = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("salt", F.pmod(spread, F.lit(salts)).cast("int")).join(wide, ["lang", "source", "salt"]).drop("salt")


class _Side:
    """Rows of one side of a tile: sources with their share of 0, and per word (source, share, bits)."""

    def __init__(self, rows: pa.Table):
        names = pc.dictionary_encode(rows.column("source").combine_chunks())
        if isinstance(names, pa.ChunkedArray):
            names = names.unify_dictionaries().combine_chunks()
        code = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.names = names.dictionary
        word, p, zero, bits = (rows.column(c).to_numpy() for c in ("word", "p", "zero", "bits"))
        self.zero = np.zeros(len(self.names), np.int64)
        self.zero[code] = zero
        own = np.flatnonzero(word >= 0)
        order = own[np.lexsort((code[own], word[own]))]
        self.word, self.code, self.p, self.bits = word[order], code[order], p[order], bits[order].view(np.uint64)
        self.words, self.first = np.unique(self.word, return_index=True)
        self.last = np.append(self.first[1:], len(order))

    def entries(self, word: int, valid: np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(source, share, bits) of a word, the last for a source being what its other bitsets leave of the valid ids."""
        at = np.searchsorted(self.words, word)
        span = slice(self.first[at], self.last[at]) if at < len(self.words) and self.words[at] == word else slice(0, 0)
        rest = np.full(len(self.zero), valid)
        np.bitwise_xor.at(rest, self.code[span], self.bits[span])
        lacking = np.flatnonzero(rest)
        return (
            np.concatenate([self.code[span], lacking]),
            np.concatenate([self.p[span], self.zero[lacking]]),
            np.concatenate([self.bits[span], rest[lacking]]),
        )


def tile_sums(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Summed divergences of every left source from every right one over a block of words.

    On the left a row without a source names a word and its valid ids.
    """
    sources, items, values = [], [], []
    words = left.filter(pc.is_null(left.column("source")))
    left, right = (x.filter(pc.is_valid(x.column("source"))) for x in (left, right))
    if left.num_rows and right.num_rows:
        a, b = _Side(left), _Side(right)
        total = np.zeros((len(a.names), len(b.names)), np.int64)
        for word, valid in zip(words.column("word").to_numpy(), words.column("bits").to_numpy().view(np.uint64), strict=True):
            code_a, p_a, bits_a = a.entries(word, valid)
            code_b, p_b, bits_b = b.entries(word, valid)
            for start in range(0, len(code_a), ROWS):
                part = slice(start, start + ROWS)
                cells = np.bitwise_count(bits_a[part, None] & bits_b[None, :])
                i, j = np.nonzero(cells)
                p, q = p_a[part][i], p_b[j]
                np.add.at(total, (code_a[part][i], code_b[j]), cells[i, j].astype(np.int64) * ((p - q) * (p - q) // q))
        i, j = (x.ravel() for x in np.indices(total.shape))
        sources, items, values = a.names.take(pa.array(i)), b.names.take(pa.array(j)), total.ravel()
    out = pa.table([pa.array(sources, pa.string()), pa.array(items, pa.string()), pa.array(values, pa.int64())], names=["source", "item", "value"])
    out = out.filter(pc.not_equal(out.column("source"), out.column("item")))
    return out.add_column(0, "lang", pa.array([key[0].as_py()] * out.num_rows, pa.string()))


def pair_values(terms: DataFrame, sizes: DataFrame, words: int = 64, tile: int = 64, salts: int = 16) -> DataFrame:
    """(lang, source, item, value): divergence of a group from every other of its language, over all kept terms."""
    widest = sizes.groupBy("lang").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    tiles = max(1, -(-widest // tile))
    maps = _with_sizes(bitmaps(terms), sizes, salts, F.col("word"))
    maps = maps.select("lang", "source", "word", share(F.col("n"), F.col("size"), F.col("terms")).alias("p"), "zero", "bits")
    # the last word of a partition or language has fewer than 64 ids
    valid = terms.groupBy("lang", F.shiftright("id", 6).alias("word")).agg(F.bit_or(_bit(F.col("id"))).alias("bits"))
    # every group takes part in every block, also where it has none of its terms
    blocks = valid.select("lang", _block(words).alias("block")).distinct()
    nothing = F.lit(0).cast("long")
    present = blocks.join(sizes.where("terms > 0"), "lang").select("lang", "block", "source", F.lit(-1).cast("long").alias("word"), nothing.alias("p"), "zero", nothing.alias("bits"))
    rows = maps.select("lang", _block(words).alias("block"), "source", "word", "p", "zero", "bits").unionByName(present)
    named = valid.select("lang", _block(words).alias("block"), F.lit(None).cast("string").alias("source"), "word", nothing.alias("p"), nothing.alias("zero"), "bits")
    own = F.pmod(F.xxhash64("source"), F.lit(tiles)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    left = rows.withColumn("tile_a", own).withColumn("tile_b", every)
    left = left.unionByName(named.withColumn("tile_a", every).withColumn("tile_b", every))
    right = rows.withColumn("tile_b", own).withColumn("tile_a", every).select(*[F.col(c).alias(c) for c in left.columns])
    by = ["lang", "block", "tile_a", "tile_b"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(tile_sums, SUMS)
    found = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    # languages without kept terms: every pair diverges by nothing
    bare = sizes.where("terms = 0").select("lang", "source")
    none = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    return found.unionByName(none.withColumn("value", nothing))


def term_values(terms: DataFrame, sizes: DataFrame, salts: int = 16) -> DataFrame:
    """(lang, source, item, value): the terms a group has more often than its language, and by how much."""
    rows = terms.select("lang", F.col("term").alias("item"), "total", F.explode("postings").alias("p"))
    rows = rows.select("lang", "item", "total", F.col("p.source").alias("source"), F.col("p.n").alias("n"))
    rows = _with_sizes(rows, sizes, salts, F.xxhash64("item"))
    p, q = share(F.col("n"), F.col("size"), F.col("terms")), share(F.col("total"), F.col("lang_size"), F.col("terms"))
    rows = rows.select("lang", "source", "item", p.alias("p"), q.alias("q")).where("p > q")
    return rows.select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))


def audit(documents: DataFrame, least: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): for every group the other sources (pair) and its ``top`` terms (term)."""
    counts = pin_table(term_counts(documents), "term-counts")
    terms = kept_terms(counts, least)
    sizes = pin_table(group_sizes(counts, terms), "group-sizes")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pair_values(terms, sizes).withColumn("rank", rank)
    own = term_values(terms, sizes).withColumn("rank", rank).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(own.withColumn("part", F.lit("term")).select(columns))
