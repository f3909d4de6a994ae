"""Toxicity by class-conditional Kneser-Ney models (operator 2).

Words are spelled by character 5-gram models, one for toxic and one for ordinary documents. Each backs off to the 5-grams of both
classes together and from there to shared continuation counts (in how many contexts an ending occurs), so an expression that is
rare in one class is smoothed by what both have; a class's own estimate counts the more the more often it saw the context.
A word's evidence is its log-likelihood ratio less one baseline for the whole corpus (the median, over the ordinary documents of the sample, of their mean
ratio); nothing is centred on the text itself, so short, repeated and wholly toxic texts keep their evidence. A document's features are
normalised by its words: the mean evidence (the log-likelihood ratio per word), the logarithms of the mean excess over 2 and of the share of words over 3, and
the mean of the three largest. A logistic regression turns them into a score; it is fitted on documents that the counts
used for it have not seen.

Counts cover every labelled training row, one row per 5-gram, and grow with the corpus. Neither they nor the model are ever held by one process: totals,
continuation counts and probabilities are columns of DataFrames, and a 5-gram of the texts gets its ratio there. Documents are dealt to chunks
by hashed id; a task receives the ratios of its chunk's own 5-grams, then the chunk's documents. Features depend on a text's words and how often
each stands in it, not on their order, so what is shuffled is that bag of words, compressed, never the text. Only the logistic regression
uses a bounded sample (``sample`` rows with the smallest hashed ids).

Nulls: a NULL text is empty; rows without a label or an id teach nothing. An empty text has the features of no words and gets the score of that point.
Rows that repeat an id in the labels count once, toxic if one of them is. Without training rows of both classes every score is 0. Ties at the threshold are
toxic. Empty tables give empty results; extra columns are ignored or passed on.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetta.llm.common import id_remainder, mix64, pin_table, slices, texts

ORDER = 5
_START, _END = "\x02", "\x03"
_WORDS = re.compile(r"[^\W\d_]+").findall
#: Words remembered per chunk; beyond it the memory starts anew.
REMEMBERED = 200_000


def words_of(text: str) -> list[str]:
    return _WORDS(text.lower())


def _bag(text: str) -> bytes:
    """Words and their numbers: a line for each number, which stands before the words that occur so often."""
    by_number: dict[int, list[str]] = {}
    for word, n in Counter(words_of(text)).items():
        by_number.setdefault(n, []).append(word)
    return "\n".join(f"{n} {' '.join(found)}" for n, found in by_number.items()).encode("utf-8", "surrogatepass")


def _unbagged(bag: bytes) -> tuple[list[str], list[int]]:
    """The distinct words of a bag, and how often each occurs."""
    words: list[str] = []
    numbers: list[int] = []
    for line in bag.decode("utf-8", "surrogatepass").split("\n") if bag else []:
        n, *found = line.split(" ")
        words += found
        numbers += [int(n)] * len(found)
    return words, numbers


def _bagged(docs: DataFrame) -> DataFrame:
    """The rows with ``bag`` in place of ``text``; each where it is read, before any shuffle."""
    keep = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches):
            bags = [packer.compress(_bag(text)) for text in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(bags, pa.binary())], names=[*keep, "bag"])

    return docs.mapInArrow(run, T.StructType([*(T.StructField(c, docs.schema[c].dataType) for c in keep), T.StructField("bag", T.BinaryType())]))


def _spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all 5-grams (one row per character and word end), and the word each belongs to."""
    pad = _START * (ORDER - 1)
    flat = np.frombuffer("".join([pad + w + _END for w in words]).encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(owner)) + (owner + 1) * (ORDER - 1)
    return flat[at[:, None] + np.arange(1 - ORDER, 1)], owner


def _hash(grams: np.ndarray, first: int, last: int) -> np.ndarray:
    """64-bit hash of the columns ``first`` to ``last`` (excluded) of the code points."""
    value = np.full(len(grams), (first + 1) * 0x9E3779B97F4A7C15 % 2**64 ^ last, np.uint64)
    for column in range(first, last):
        value = mix64(value ^ (grams[:, column].astype(np.uint64) + np.uint64(1)))
    return value


class Model:
    """Log-likelihood ratios of words out of few counts per 5-gram, in memory; ``_gram_ratios`` gives the same for any number."""

    def __init__(self, grams: np.ndarray, ordinary: np.ndarray, toxic: np.ndarray, bits: int, discount: float = 0.75, trust: float = 50.0):
        seen = (ordinary + toxic) > 0
        grams, counts = grams[seen], np.stack([ordinary[seen], toxic[seen], ordinary[seen] + toxic[seen]]).astype(np.float64)
        self.mask, self.discount, self.trust = np.uint64((1 << bits) - 1), discount, trust
        slots = 1 << bits
        gram, context = self._slots(grams, 0, ORDER), self._slots(grams, 0, ORDER - 1)
        self.count = np.stack([np.bincount(gram, c, slots) for c in counts]).astype(np.float32)
        self.total = np.stack([np.bincount(context, c, slots) for c in counts]).astype(np.float32)
        self.types = np.stack([np.bincount(context, c > 0, slots) for c in counts]).astype(np.float32)
        # lower orders: in how many contexts (one character to the left) an ending occurs
        self.lower = []
        endings = grams
        for first in range(1, ORDER):
            keys = _hash(endings, first, ORDER)
            _, one, n = np.unique(keys, return_index=True, return_counts=True)
            endings = endings[one]
            ending, inner = self._slots(endings, first, ORDER), self._slots(endings, first, ORDER - 1)
            self.lower.append(tuple(np.bincount(s, w, slots).astype(np.float32) for s, w in ((ending, n), (inner, n), (inner, np.ones(len(n))))))
        self.letters = max(2, len(endings))

    def _slots(self, grams: np.ndarray, first: int, last: int) -> np.ndarray:
        return (_hash(grams, first, last) & self.mask).astype(np.int64)

    def _mixed(self, count, total, types, backoff):
        known = total > 0
        safe = np.where(known, total, 1)
        return np.where(known, (np.maximum(count - self.discount, 0) + self.discount * types * backoff) / safe, backoff)

    def ratios(self, words: list[str]) -> np.ndarray:
        """log p(word | toxic) - log p(word | ordinary)."""
        if not words:
            return np.zeros(0)
        grams, owner = _spelled(words)
        shared = np.full(len(grams), 1.0 / self.letters)
        for first in range(ORDER - 1, 0, -1):
            ending, inner = self._slots(grams, first, ORDER), self._slots(grams, first, ORDER - 1)
            count, total, types = self.lower[first - 1]
            shared = self._mixed(count[ending], total[inner], types[inner], shared)
        gram, context = self._slots(grams, 0, ORDER), self._slots(grams, 0, ORDER - 1)
        both = self._mixed(self.count[2][gram], self.total[2][context], self.types[2][context], shared)
        ordinary, toxic = (self._of_class(y, gram, context, both) for y in (0, 1))
        return np.bincount(owner, np.log(toxic) - np.log(ordinary), len(words))

    def _of_class(self, y: int, gram: np.ndarray, context: np.ndarray, both: np.ndarray) -> np.ndarray:
        """The class's own estimate, trusted as far as it knows the context, and that of both classes."""
        total = self.total[y][context]
        own = self._mixed(self.count[y][gram], total, self.types[y][context], both)
        weight = total / (total + self.trust)
        return np.maximum(weight * own + (1 - weight) * both, 1e-30)


FEATURES = ("f1", "f2", "f3", "f4")


class _Ratios:
    """Ratios of words out of those of a chunk's 5-grams, with the words spelled so far."""

    def __init__(self, grams: list[str], ratios: list[float]):
        keys = _hash(np.frombuffer("".join(grams).encode("utf-32-le"), "<u4").reshape(-1, ORDER), 0, ORDER)
        self.keys, one = np.unique(keys, return_index=True)
        self.values = np.array(ratios, float)[one]
        self.known: dict[str, float] = {}

    def ratios(self, words: list[str]) -> np.ndarray:
        grams, owner = _spelled(words)
        keys = _hash(grams, 0, ORDER)
        at = np.searchsorted(self.keys, keys)
        if len(keys) and (not len(self.keys) or (self.keys[np.minimum(at, len(self.keys) - 1)] != keys).any()):
            raise ValueError("a 5-gram of the chunk has no ratio")
        return np.bincount(owner, self.values[at], len(words))


def _features(bags: list[tuple[list[str], list[int]]], model: _Ratios, baseline: float = 0.0) -> np.ndarray:
    """Rows of (mean evidence, mean of the three largest, log mean excess over 2, log share over 3) per word."""
    known = model.known
    named = set().union(*(words for words, _ in bags))
    new = list(named.difference(known))
    if len(known) + len(new) > REMEMBERED:
        known.clear()
        new = list(named)
    for at in range(0, len(new), 8_000):
        part = new[at : at + 8_000]
        known.update(zip(part, model.ratios(part).tolist(), strict=True))
    sizes = np.array([len(words) for words, _ in bags], np.int64)
    owner = np.repeat(np.arange(len(bags)), sizes)
    values = np.fromiter(map(known.__getitem__, chain.from_iterable(words for words, _ in bags)), float, len(owner)) - baseline
    times = np.fromiter(chain.from_iterable(numbers for _, numbers in bags), float, len(owner))
    per_text = lambda weights: np.bincount(owner, weights, len(bags))
    n = per_text(times)
    some = np.maximum(n, 1)
    # the three largest: a text's words by falling value, each as often as there is room
    order = np.lexsort((-values, owner))
    before = np.cumsum(times[order]) - times[order]
    first = np.repeat((np.cumsum(n) - n), sizes)
    room = np.clip(3 - (before - first), 0, times[order])
    rows = np.zeros((len(bags), len(FEATURES)))
    rows[:, 0] = per_text(values * times) / some
    rows[:, 1] = per_text(values[order] * room) / np.minimum(some, 3)
    # the constants stand for a short text's missing words
    rows[:, 2] = np.log((per_text(np.maximum(values - 2, 0) * times) + 0.1) / (n + 20))
    rows[:, 3] = np.log((per_text((values > 3) * times) + 0.05) / (n + 20))
    return rows


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method; an intercept stands first. Classes weigh as they are."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    slope = w[1:] / scale
    return np.concatenate([[w[0] - slope @ mean], slope])


@dataclass(frozen=True)
class Fitted:
    """What scoring needs: (chunk, gram, ratio) of the documents' 5-grams, the number of chunks, the weights and the baseline."""

    ratios: DataFrame | None
    chunks: int
    weights: tuple[float, ...]
    baseline: float = 0.0


_KINDS = ("n0", "n1", "m0", "m1")


def _chunk(chunks: int) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("bag"))), F.lit(chunks)).cast("int").alias("chunk")


def _gram_rows(docs: DataFrame, known: DataFrame | None, chunks: int) -> DataFrame:
    """(chunk, gram, n0, n1, m0, m1) of every 5-gram of the documents (doc_id, part, and text or bag).

    The counts are documents per occurrence (each word once per document): ordinary and toxic ones of the first fold (``part`` 1) and of
    the second (2). Other documents only name their 5-grams. A 5-gram may have several rows in a chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # words by kind, then those that are only named
        words: list[Counter[str]] = [Counter() for _ in _KINDS]
        wanted: set[str] = set()
        labels: dict[int, int] = {}
        chunk = 0
        open_bag = zstandard.ZstdDecompressor().decompress

        def flush() -> pa.RecordBatch:
            names = list(wanted.union(*words))
            grams, owner = _spelled(names)
            _, one, group = np.unique(_hash(grams, 0, ORDER), return_index=True, return_inverse=True)
            weights = (np.fromiter(map(counts.get, names, repeat(0)), np.int64, len(names)) if counts else np.zeros(len(names), np.int64) for counts in words)
            sums = [np.bincount(group, weight[owner], len(one)).astype(np.int64) for weight in weights]
            text = grams[one].astype("<u4").tobytes().decode("utf-32-le")
            strings = [text[ORDER * i : ORDER * (i + 1)] for i in range(len(one))]
            for counts in words:
                counts.clear()
            wanted.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(one), chunk, np.int32)), pa.array(strings, pa.string()), *map(pa.array, sums)], names=["chunk", "gram", *_KINDS])

        for batch in slices(batches, max_bytes=2 << 20):
            columns = [batch.column(c).to_pylist() for c in ("chunk", "doc_id", "part", "toxic", "bag")]
            for own, doc_id, part, toxic, bag in zip(*columns, strict=True):
                if own != chunk:
                    if wanted or any(words):
                        yield flush()
                    chunk = own
                    labels.clear()
                if part < 0:
                    labels[doc_id] = toxic
                    continue
                found, _ = _unbagged(open_bag(bag))
                if part and doc_id in labels:
                    words[labels[doc_id] + 2 * (part - 1)].update(found)
                else:
                    wanted.update(found)
            if sum(map(len, words)) + len(wanted) > 200_000:
                yield flush()
        if wanted or any(words):
            yield flush()

    if "bag" not in docs.columns:
        docs = _bagged(docs.select("doc_id", "part", "text"))
    rows = docs.select(_chunk(chunks), F.col("doc_id").cast("long").alias("doc_id"), "part", F.lit(None).cast("int").alias("toxic"), "bag")
    if known is not None:
        held = known.select("doc_id", F.lit(-1).alias("part"), "toxic", F.lit(None).cast("binary").alias("bag"))
        rows = rows.unionByName(held.select(_chunk(chunks), "*"))
    # a chunk's labels stand before its documents
    dealt = rows.repartition("chunk").sortWithinPartitions("chunk", F.col("part") >= 0)
    return dealt.mapInArrow(run, "chunk int, gram string, " + ", ".join(f"{k} long" for k in _KINDS))


def _mixed(count: Column, total: Column, types: Column, backoff: Column, discount: float = 0.75) -> Column:
    return F.when(total > 0, (F.greatest(count - discount, F.lit(0.0)) + discount * types * backoff) / total).otherwise(backoff)


def _gram_ratios(counts: DataFrame, trust: float = 50.0) -> DataFrame:
    """(gram, ratio): log p(last character | toxic) - log p(last character | ordinary) of every row of (gram, ordinary, toxic).

    5-grams without counts are smoothed by what was counted. A string of n characters has at most as many rows beside it as there are letters, in
    each window and under each join key.
    """
    seen = lambda c: (F.col(c) > 0).cast("long")
    counts = counts.withColumn("both", F.col("ordinary") + F.col("toxic"))
    # in how many contexts (one character to the left) an ending occurs; those of unseen 5-grams stay with 0
    endings = [counts.select("gram", F.col("both").alias("n"))]
    for _ in range(1, ORDER):
        endings.insert(0, endings[0].groupBy(F.substring("gram", 2, ORDER).alias("gram")).agg(F.sum(seen("n")).alias("n")))
    shared = None
    for size, level in enumerate(endings[:-1], 1):
        inner = Window.partitionBy(F.substring("gram", 1, size - 1))
        level = level.select("gram", "n", F.sum("n").over(inner).alias("total"), F.sum(seen("n")).over(inner).alias("types"))
        if shared is None:
            backoff = 1 / F.greatest(F.lit(2), F.col("types"))
        else:
            level, backoff = level.withColumn("rest", F.substring("gram", 2, ORDER)).join(shared, "rest"), F.col("shared")
        shared = level.select(F.col("gram").alias("rest"), _mixed(F.col("n"), F.col("total"), F.col("types"), backoff).alias("shared"))
    context = Window.partitionBy(F.substring("gram", 1, ORDER - 1))
    kinds = ("ordinary", "toxic", "both")
    own = counts.select("*", *[F.sum(k).over(context).alias(f"{k}_total") for k in kinds], *[F.sum(seen(k)).over(context).alias(f"{k}_types") for k in kinds])
    of = lambda k, backoff: _mixed(F.col(k), F.col(f"{k}_total"), F.col(f"{k}_types"), F.col(backoff))
    mixed = own.withColumn("rest", F.substring("gram", 2, ORDER)).join(shared, "rest").withColumn("backed", of("both", "shared"))

    def log_of(k: str) -> Column:
        # the class's own estimate, trusted as far as it knows the context, and that of both classes
        weight = F.col(f"{k}_total") / (F.col(f"{k}_total") + trust)
        return F.log(F.greatest(weight * of(k, "backed") + (1 - weight) * F.col("backed"), F.lit(1e-30)))

    return mixed.select("gram", (log_of("toxic") - log_of("ordinary")).alias("ratio"))


def _chunks(docs: DataFrame) -> int:
    # a chunk's 5-grams are sent to it once: the more documents it has, the fewer are sent twice
    return max(24, docs.count() // 8192)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = 20_000) -> Fitted:
    """Learn from the rows of ``docs`` where ``learn`` holds and ``labels`` has ``toxic``.

    Every eighth training row (by hashed id) is the second fold: the logistic regression is fitted on it, with the counts of the others.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(8))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    own = own.select("doc_id", "text", F.when(~F.col("learn") | F.col("doc_id").isNull(), 0).when(fold == 0, 2).otherwise(1).alias("part"))
    chunks = _chunks(docs)
    rows = pin_table(_gram_rows(own, known, chunks), "gram-rows")
    counts = pin_table(rows.groupBy("gram").agg(*[F.sum(k).alias(k) for k in _KINDS]), "gram-counts")
    any_of = counts.agg(*[F.coalesce(F.max(k), F.lit(0)).alias(k) for k in _KINDS]).first()
    if not any_of["n0"] + any_of["m0"] or not any_of["n1"] + any_of["m1"]:
        return Fitted(None, chunks, ())
    whole = counts.select("gram", (F.col("n0") + F.col("m0")).alias("ordinary"), (F.col("n1") + F.col("m1")).alias("toxic"))
    ratios = rows.select("chunk", "gram").join(_gram_ratios(whole), "gram")
    if not any_of["n1"] or not any_of["n0"]:
        first, second = whole, own.where("part > 0")
    else:
        first, second = counts.select("gram", F.col("n0").alias("ordinary"), F.col("n1").alias("toxic")), own.where("part = 2")
    keyed = second.withColumn("key", F.xxhash64("text"))
    # ids alone meet the labels; labels grow with the documents and have no size to broadcast by
    named = keyed.select("doc_id", "key").join(known.hint("merge"), "doc_id")
    picked = named.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id", "key").limit(sample).distinct()
    sampled = pin_table(_bagged(keyed.join(F.broadcast(picked), ["doc_id", "key"])), "sample")
    few = 32
    grams = _gram_rows(sampled.withColumn("part", F.lit(0)), None, few).select("chunk", "gram")
    sampled_ratios = pin_table(grams.join(_gram_ratios(first), "gram"), "sample-ratios")

    def measured(baseline: float):
        rows = _measured(sampled, sampled_ratios, few, ["doc_id", "key", "toxic"], baseline)
        return rows.dropDuplicates(["doc_id", "key"]).orderBy("doc_id", "key").toPandas()  # at most ``sample`` rows

    table = measured(0.0)
    ordinary = table.loc[table["toxic"] == 0, "f1"]
    baseline = float(ordinary.median()) if len(ordinary) else 0.0
    y = table["toxic"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return Fitted(ratios, chunks, (-4.0, 0.0, 0.5, 0.0, 0.0), baseline)  # nothing to fit the scale on
    return Fitted(ratios, chunks, tuple(fit_logistic(measured(baseline)[list(FEATURES)].to_numpy(float), y)), baseline)


def _measured(docs: DataFrame, ratios: DataFrame, chunks: int, keep: list[str], baseline: float) -> DataFrame:
    """Columns to keep and the features of ``bag``, by the ratios of the chunks' 5-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, grams, values, model = None, [], [], None
        open_bag = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, rows=4096, max_bytes=2 << 20):
            own, is_doc = batch.column("chunk").to_numpy(), batch.column("is_doc").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero((own[1:] != own[:-1]) | (is_doc[1:] != is_doc[:-1])) + 1).tolist(), len(own)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(a, b - a)
                if own[a] != chunk:
                    chunk, grams, values, model = own[a], [], [], None
                if not is_doc[a]:
                    grams += part.column("gram").to_pylist()
                    values += part.column("ratio").to_pylist()
                    continue
                if model is None:
                    model = _Ratios(grams, values)
                    grams, values = [], []
                rows = _features([_unbagged(open_bag(bag)) for bag in part.column("bag").to_pylist()], model, baseline)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *map(pa.array, rows.T.copy())], names=[*keep, *FEATURES])

    dealt = docs.select(_chunk(chunks), F.lit(True).alias("is_doc"), *keep, "bag")
    dealt = dealt.unionByName(ratios.select("chunk", F.lit(False).alias("is_doc"), "gram", "ratio"), allowMissingColumns=True)
    dealt = dealt.repartition("chunk").sortWithinPartitions("chunk", "is_doc")
    fields = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return dealt.mapInArrow(run, ", ".join([fields, *(f"{f} double" for f in FEATURES)]))


def score_rows(docs: DataFrame, fitted: Fitted, threshold: float = 0.7, columns: list[str] | None = None) -> DataFrame:
    """(row, score, predicted): every row (its ``columns``, all if None) as a struct, its score between 0 and 1, and 1 where that reaches the threshold.

    ``docs`` are those ``fitted`` has seen: others may hold 5-grams without a ratio, which fails.
    """
    held = docs.select(F.struct(*(columns or ["*"])).alias("row"), F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    if fitted.ratios is None:
        return held.select("row", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    z = F.lit(float(fitted.weights[0]))
    for weight, feature in zip(fitted.weights[1:], FEATURES, strict=True):
        z = z + F.lit(float(weight)) * F.col(feature)
    scored = _measured(_bagged(held), fitted.ratios, fitted.chunks, ["row"], fitted.baseline).select("row", (1 / (1 + F.exp(-z))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def training_rows(docs_id: str = "doc_id") -> Column:
    """The rows that labels may be learnt from: crc32 of the id as text, modulo 3, is not 1."""
    return id_remainder(docs_id, 3) != 1


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    scored = score_rows(docs.select("doc_id", "text"), fit(docs, labels, training_rows()), threshold, ["doc_id"])
    held_out = F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False))
    return scored.select(F.col("row.doc_id").alias("doc_id"), "score", "predicted").select("doc_id", held_out.alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The table without the rows whose score reaches the threshold."""
    scored = score_rows(docs, fit(docs, labels, training_rows()), threshold)
    return scored.where("predicted = 0").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
