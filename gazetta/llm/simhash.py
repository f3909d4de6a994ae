"""SimHash near-duplicates by deletion-variant signatures (operator 6).

A fingerprint has 64 bits. Cut into 3 segments, two fingerprints of at most 4 (up to 5) differing bits have a segment in which they differ by at
most one. Each distinct fingerprint is indexed under every segment with one bit blanked out (64 variants); a pair meets where such a variant
is equal, and the whole distance is verified there. Exact copies are one fingerprint before any of this, so a group of
copies costs one row. A variant shared by many fingerprints (near copies of one text) gives no list of pairs: within
it fingerprints are visited breadth first and only the links that join something new are kept, which leaves the
components as they are. Components follow by alternating large and small stars, each round written to the shared folder.

Nulls: a NULL text is empty; texts without a word have fingerprint zero and are linked like any other. Repeated rows have equal
fingerprints and so the same component. An empty table gives an empty result. Bits at a tie (set in exactly half the
hashes) are 0. Documents with a NULL id get the component of their fingerprint; it is NULL if no id is in it.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazetta.llm.common import pin_table, release, slices, utf8

BITS = 64
#: Fingerprints of one variant that are compared pair by pair; more are visited breadth first.
_SHORT = 32


def fingerprint(text: bytes, words: int = 4) -> int:
    """SimHash of one text; the batch form below agrees with it."""
    return int(_fingerprints([text], words)[0])


def _shingles(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Hashes of all shingles of the texts one after the other, how many each has, and the hash of each text's words."""
    hashes: list[int] = []
    sizes = np.zeros(len(texts), np.int64)
    wholes = []
    hash_of = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        found = text.lower().split()
        n = len(found)
        joined = b" ".join(found)
        wholes.append(hash_of(joined, 7))
        if not n:
            continue
        edges = list(itertools.accumulate(map(len, found), lambda a, b: a + b + 1))  # a word's end, so far
        starts = [0, *(e + 1 for e in edges[: max(n - words, 0)])]
        hashes.extend([hash_of(joined[a:b], 42) for a, b in zip(starts, edges[min(words, n) - 1 :], strict=True)])
        sizes[i] = max(1, n - words + 1)
    return np.array(hashes, np.uint64), sizes, wholes


def _majority(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per text the bits that are set in more than half of its hashes."""
    result = np.zeros(len(sizes), np.uint64)
    rows = np.flatnonzero(sizes)
    weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    edges = np.concatenate([[0], np.cumsum(sizes[rows])])
    for k, row in enumerate(rows.tolist()):
        own = flat[edges[k] : edges[k + 1]]
        ones = np.zeros(BITS, np.int64)
        for at in range(0, len(own), 65536):
            bits = np.unpackbits(own[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        result[row] = weights[2 * ones > len(own)].sum(dtype=np.uint64)
    return result


def _fingerprints(texts: list[bytes], words: int) -> np.ndarray:
    flat, sizes, _ = _shingles(texts, words)
    return _majority(flat, sizes)


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, text_key, fp): xxhash64 of the text and the fingerprint's 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = pa.array(_fingerprints(utf8(batch.column("text")), words).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), fps], names=["doc_id", "text_key", "fp"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").alias("text"))
    return own.mapInArrow(run, "doc_id long, text_key long, fp long")


def segments(distance: int, parts: int | None = None) -> list[tuple[int, int]]:
    """(first bit, bits) of as few segments as leave one with at most one differing bit: 2 * parts > distance."""
    parts = parts or distance // 2 + 1
    edges = [BITS * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def variants(fps: DataFrame, distance: int, parts: int | None = None) -> DataFrame:
    """(variant, fp): each fingerprint under every segment with one bit blanked out."""
    rows = []
    for start, size in segments(distance, parts):
        mask = ((1 << size) - 1) << start
        for bit in range(start, start + size):
            rows.append((bit, _signed(mask & ~(1 << bit))))
    keys = F.array(*[F.struct(F.lit(b).cast("int").alias("bit"), F.col("fp").bitwiseAND(F.lit(m)).alias("rest")) for b, m in rows])
    return fps.select("fp", F.explode(keys).alias("k")).select("k.bit", "k.rest", "fp")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _joiner(distance: int):
    """Over rows sorted by (bit, rest): links that join what is not joined yet, within equal variants."""

    def in_run(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links that span the run's components: breadth first, each fingerprint is compared with the unvisited only."""
        a, b = [], []
        rest = fps
        while len(rest):
            queue, rest = [rest[:1]], rest[1:]
            while queue and len(rest):
                for pivot in queue.pop():
                    near = np.bitwise_count(rest ^ pivot) <= distance
                    if near.any():
                        found = rest[near]
                        a.append(np.full(len(found), pivot))
                        b.append(found)
                        queue.append(found)
                        rest = rest[~near]
                        if not len(rest):
                            break
        return (np.concatenate(a), np.concatenate(b)) if a else (fps[:0], fps[:0])

    def links(bit: np.ndarray, rest: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        change = np.flatnonzero(np.concatenate([[True], (bit[1:] != bit[:-1]) | (rest[1:] != rest[:-1])]))
        size = np.diff(np.append(change, len(bit)))
        a, b = [], []
        # short runs side by side, every pair at once; long ones breadth first
        place, length = np.arange(len(bit)) - np.repeat(change, size), np.repeat(size, size)
        for gap in range(1, _SHORT):
            first = np.flatnonzero((length <= _SHORT) & (place + gap < length))
            if not len(first):
                break
            near = first[np.bitwise_count(fp[first] ^ fp[first + gap]) <= distance]
            a.append(fp[near])
            b.append(fp[near + gap])
        for start, n in zip(change[size > _SHORT].tolist(), size[size > _SHORT].tolist(), strict=True):
            x, y = in_run(fp[start : start + n])
            a.append(x)
            b.append(y)
        if not a:
            return fp[:0], fp[:0]
        return np.concatenate(a), np.concatenate(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                cut = None
            else:
                own = (batch.column("bit").to_numpy(), batch.column("rest").to_numpy(), batch.column("fp").to_numpy().view(np.uint64))
                if not len(own[0]):
                    continue
                kept.append(own)
                # the last variant may go on in the next batch
                differs = np.flatnonzero((own[0] != own[0][-1]) | (own[1] != own[1][-1]))
                if not len(differs):
                    continue
                cut = int(differs[-1]) + 1
            if not kept:
                continue
            whole = [np.concatenate(x) for x in zip(*kept, strict=True)]
            end = len(whole[0]) if cut is None else len(whole[0]) - len(kept[-1][0]) + cut
            kept = [] if cut is None else [tuple(x[end:] for x in whole)]
            if end:
                a, b = links(*(x[:end] for x in whole))
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return run


def links(fps: DataFrame, distance: int = 4, parts: int | None = None) -> DataFrame:
    """(a, b): links between distinct fingerprints of at most ``distance`` differing bits, enough to span their components.

    With fewer ``parts`` than the distance asks for, those links are found that leave a segment with at most one differing bit.
    """
    indexed = variants(fps.select("fp").distinct(), distance, parts).repartition("bit", "rest").sortWithinPartitions("bit", "rest")
    return indexed.mapInArrow(_joiner(distance), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has a link.

    Alternating large stars (every larger neighbour moves to the smallest neighbour) and small stars (smaller neighbours do),
    until nothing changes; the number of rounds grows with the logarithm of the component's size.
    """
    edges = pin_table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        near = large.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = pin_table(near.unionByName(low.withColumnRenamed("low", "v")).distinct(), "links")
        settled = small.count() == edges.count() and small.join(edges, ["u", "v"], "left_anti").isEmpty()
        edges = small
        if settled:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def with_components(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id): component_id is the smallest doc_id reachable over links, root the component's fingerprint."""
    marked = pin_table(fingerprints(docs, words), "fingerprints")
    # one row per distinct fingerprint before any join, so copies never meet in one task
    lowest = marked.groupBy("fp").agg(F.min("doc_id").alias("lowest"))
    roots = pin_table(components(links(lowest, distance)), "roots").withColumnRenamed("node", "fp")
    rooted = lowest.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def fingerprint_rows(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fingerprint as 16 lowercase hex digits, component_id)."""
    return with_components(docs, words, distance).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _only(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows with a (chosen_id, chosen_key), one of those that repeat it."""
    held = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"))
    kept = held.join(chosen, F.col("id").eqNullSafe(F.col("chosen_id")) & (F.col("key") == F.col("chosen_key")), "left_semi")
    nth = F.row_number().over(Window.partitionBy("id", "key").orderBy(F.xxhash64("row")))
    return kept.withColumn("nth", nth).where("nth = 1").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def drop_near_copies(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """The table with one row of each component: that of its smallest id (NULL ids last), and one of rows that repeat it."""
    found = with_components(docs, words, distance)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key"))
    chosen = found.groupBy("root").agg(first.alias("c")).select(F.col("c.doc_id").alias("chosen_id"), F.col("c.text_key").alias("chosen_key"))
    return _only(docs, chosen)


# --- similar texts: a common shingle among the rarest of both, then the exact similarity -----------------------------------------

#: Texts of the sample that tells which shingles are frequent (at least; one in 32 of a large table), and shingles that it lists.
_SAMPLE, _LISTED = 4096, 1 << 17
#: Shingles beyond the list go by their hash, below this; those of the list come after them, by their frequency.
_UNLISTED = 1 << 62
#: Pairs that a task gathers before it drops those it has twice.
_GATHERED = 1 << 21


def _frequent(docs: DataFrame, words: int) -> np.ndarray:
    """Shingles that several texts of a sample have, the most frequent last. They order shingles, and any order is correct."""
    share = max(1, min(32, docs.count() // _SAMPLE))
    few = docs.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0).select("text").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in slices(batches):
            flat, sizes, _ = _shingles(utf8(batch.column("text")), words)
            for x in np.split(flat, np.cumsum(sizes)[:-1]):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(x).view(np.int64))], names=["shingle"])

    counts = few.mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    top = counts.orderBy(F.desc("n"), "shingle").limit(_LISTED).toArrow()
    return top.column("shingle").to_numpy()[::-1].view(np.uint64)


def _marked(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """(doc_id, text_key, node, size, prefix): node is the hash of a text's words, size the number of its distinct shingles, and prefix as
    many of them, the rarest first, that a text as similar as asked has one of them in its own; NULL where the task had the node before."""
    frequent = _frequent(docs, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        order = np.argsort(frequent)
        listed = frequent[order]
        seen: set[int] = set()
        for batch in slices(batches):
            flat, sizes, wholes = _shingles(utf8(batch.column("text")), words)
            codes = flat >> np.uint64(2)
            if len(listed):
                at = np.minimum(np.searchsorted(listed, flat), len(listed) - 1)
                codes = np.where(listed[at] == flat, np.uint64(_UNLISTED) + order[at].astype(np.uint64), codes)
            counts, prefixes = [], []
            for own, whole in zip(np.split(codes.view(np.int64), np.cumsum(sizes)[:-1]), wholes, strict=True):
                if whole in seen:
                    counts.append(None)
                    prefixes.append(None)
                    continue
                seen.add(whole)
                own = np.unique(own)
                counts.append(len(own))
                prefixes.append(own[: len(own) - int(np.ceil(similarity * len(own) - 1e-9)) + 1])
            if len(seen) > 1 << 20:
                seen.clear()
            nodes = pa.array(np.array(wholes, np.uint64).view(np.int64))
            values = [batch.column("doc_id"), batch.column("text_key"), nodes, pa.array(counts, pa.int32()), pa.array(prefixes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(values, names=["doc_id", "text_key", "node", "size", "prefix"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").alias("text"))
    return own.mapInArrow(run, "doc_id long, text_key long, node long, size int, prefix array<long>")


def _whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of sorted batches, cut where the first column changes."""
    kept: list[list[np.ndarray]] = []
    for batch in batches:
        own = [c.to_numpy() for c in batch.columns]
        if not len(own[0]):
            continue
        kept.append(own)
        differs = np.flatnonzero(own[0] != own[0][-1])
        if len(differs):
            whole = [np.concatenate(x) for x in zip(*kept, strict=True)]
            end = len(whole[0]) - len(own[0]) + int(differs[-1]) + 1
            kept = [[x[end:] for x in whole]]
            yield [x[:end] for x in whole]
    if kept:
        yield [np.concatenate(x) for x in zip(*kept, strict=True)]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by (code, size, node): those whose code another text has as well, each once."""
    for code, node, size in _whole_runs(batches):
        new = np.concatenate([[True], (code[1:] != code[:-1]) | (node[1:] != node[:-1])])
        code, node, size = code[new], node[new], size[new]
        same = np.concatenate([[False], code[1:] == code[:-1], [False]])
        held = same[1:] | same[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(x[held]) for x in (code, node, size)], names=["code", "node", "size"])


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    both = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["a", "b"])


def _neighbours(similarity: float):
    """Over rows sorted by (code, size, node): pairs that follow each other under a code and whose sizes are near enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, node, size in _whole_runs(batches):
            near = (code[1:] == code[:-1]) & (size[:-1] >= similarity * size[1:] - 1e-9)
            yield _pair_batch(node[:-1][near], node[1:][near])

    return run


def _apart(similarity: float):
    """Over rows sorted by (code, size, node): all pairs under a code whose sizes are near enough and that are not joined yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, node, size, root in _whole_runs(batches):
            starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            ends = np.append(starts[1:], len(code))
            mixed = np.minimum.reduceat(root, starts) != np.maximum.reduceat(root, starts)
            end = np.repeat(np.where(mixed, ends, starts), ends - starts)
            first, gap, found, held = np.arange(len(code)), 0, [], 0
            while True:
                gap += 1
                first = first[first + gap < end[first]]
                # sizes grow along a code, so a row that found its last partner has no other
                first = first[size[first] >= similarity * size[first + gap] - 1e-9]
                if not len(first):
                    break
                apart = first[root[first] != root[first + gap]]
                found.append((node[apart], node[apart + gap]))
                held += len(apart)
                if held > _GATHERED:
                    yield _pair_batch(*map(np.concatenate, zip(*found, strict=True)))
                    found, held = [], 0
            if found:
                yield _pair_batch(*map(np.concatenate, zip(*found, strict=True)))

    return run


def _by_code(rows: DataFrame) -> DataFrame:
    return rows.repartition("code").sortWithinPartitions("code", "size", "node")


def _possible(pairs: DataFrame, marked: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose prefixes do not rule the similarity out: up to where the shorter one ends, both texts' shingles are known."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    held = marked.where("size > 0").join(wanted, "node", "left_semi").dropDuplicates(["node"])
    both = pairs
    for x in ("a", "b"):
        both = both.join(held.select(F.col("node").alias(x), F.col("size").alias(f"n_{x}"), F.col("prefix").alias(f"of_{x}")), x)
    end = F.least(F.element_at("of_a", -1), F.element_at("of_b", -1))
    known = [F.size(F.filter(c, lambda v: v <= F.col("end"))) for c in ("of_a", "of_b")]
    differ = known[0] + known[1] - 2 * F.size(F.array_intersect("of_a", "of_b"))
    allowed = (1 - similarity) / (1 + similarity) * (F.col("n_a") + F.col("n_b")) + 1e-6
    return both.withColumn("end", end).where(differ <= allowed).select("a", "b")


def _shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(node, held): the distinct shingle hashes of every text; a text without words has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            flat, sizes, wholes = _shingles(utf8(batch.column("text")), words)
            sets = [np.unique(x).view(np.int64) for x in np.split(flat, np.cumsum(sizes)[:-1])]
            edges = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
            held = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.concatenate(sets)))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(wholes, np.uint64).view(np.int64)), held], names=["node", "held"])

    return docs.select("text").mapInArrow(run, "node long, held array<long>")


def _verified(docs: DataFrame, marked: DataFrame, pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs whose sets of shingles are as similar as asked (Jaccard), exactly."""
    pairs = pin_table(_possible(pairs, marked, similarity), "similar-candidates")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    named = marked.join(wanted, "node", "left_semi").groupBy("node")
    rows = named.agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")).alias("c"))
    # join and rows that repeat each other go by the same keys, so the texts are dealt once
    by = ["id", "nameless", "key"]
    rows = rows.select(F.coalesce("c.doc_id", F.lit(0)).alias("id"), "c.nameless", F.col("c.text_key").alias("key"))
    own_id = F.col("doc_id").cast("long")
    held = docs.select("text", F.coalesce(own_id, F.lit(0)).alias("id"), own_id.isNull().alias("nameless"), F.xxhash64("text").alias("key"))
    texts = held.join(rows, by, "left_semi").dropDuplicates(by)
    sets = pin_table(_shingle_sets(texts, words), "shingle-sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("held").alias("of_a")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("held").alias("of_b")), "b")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    linked = both.where(shared >= similarity * (F.size("of_a") + F.size("of_b") - shared)).select("a", "b")
    return pin_table(linked, "similar-links")


def similar_components(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_key, node, root) of every row, and verified links (a, b) between texts, enough to span their components.

    Exact: two texts as similar as asked have a shingle in common among the rarest of each (prefix filter), in any fixed order of
    shingles. Under each such shingle the texts that follow each other by size are compared first; then all that are not joined by
    then, so that a crowd of near copies is not expanded into its pairs and no pair that would join two components is left out.
    Texts with equal words are one text. Fewer words than a shingle has are one shingle.
    """
    marked = pin_table(_marked(docs, words, similarity), "rarest-shingles")
    rows = marked.where("size > 0").select(F.explode("prefix").alias("code"), "node", "size")
    shared = pin_table(_by_code(rows).mapInArrow(_shared, "code long, node long, size int"), "shared-shingles")
    kind = "a long, b long"
    first = pin_table(_by_code(shared).mapInArrow(_neighbours(similarity), kind).distinct(), "similar-neighbours")
    linked = _verified(docs, marked, first, words, similarity)
    roots = pin_table(components(linked), "similar-roots")
    rooted = shared.join(roots, "node", "left").select("code", "node", "size", F.coalesce("root", "node").alias("root"))
    rest = _by_code(rooted).mapInArrow(_apart(similarity), kind).distinct().join(first, ["a", "b"], "left_anti")
    linked = linked.unionByName(_verified(docs, marked, pin_table(rest, "similar-rest"), words, similarity))
    roots = pin_table(components(linked), "similar-roots")
    return marked.join(roots, "node", "left").select("doc_id", "text_key", "node", F.coalesce("root", "node").alias("root")), linked


def drop_similar(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The table with one row of each group of similar texts: that of its smallest id (NULL ids last), and one of rows that repeat it."""
    found, _ = similar_components(docs, words, similarity)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key"))
    chosen = found.groupBy("root").agg(first.alias("c")).select(F.col("c.doc_id").alias("chosen_id"), F.col("c.text_key").alias("chosen_key"))
    return _only(docs, chosen)
