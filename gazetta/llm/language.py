"""Language identification by cross-parsing entropy (operator 8).

For each language a suffix automaton holds a sample of its labelled text. A text is parsed with each automaton into the longest
phrases that occur in the sample; phrases times the logarithm of the sample's size, per byte, estimates the cross entropy, and
the language with the least wins. Texts are parsed whole, in blocks of ``BLOCK`` bytes side by side (a phrase ends
with its block), so a very long text costs no more per byte than short ones.

The sample of a language is bounded: at most ``documents`` passages with a letter, of at most ``chars`` characters each, and ``size`` bytes. The number of
languages is not: every one that has a labelled text with a letter is learnt. A worker holds the automata of at most ``TOGETHER`` languages; where there are
more, each group of them reads the texts by itself, and the least and second least estimate per distinct text are reduced over the groups. Texts are compared in lower case with everything but letters as one blank.

Nulls: a NULL text, or one without a letter, is ``und`` with score 0; rows without id or language teach nothing. Ties go to the language whose name
is smaller. With no language learnt every row is ``und``. Repeated rows, empty tables and extra columns need nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.llm.common import id_remainder, pin_table, resident, slices, texts

BLOCK = 512
_NOT_LETTERS = re.compile(r"[\W\d_]+").sub
UNDETERMINED = "und"
#: Languages whose automata a worker holds at a time (some 30 MB each).
TOGETHER = 8


def normalised(text: str) -> bytes:
    """Lower case, everything but letters as one blank; empty where there is no letter."""
    found = _NOT_LETTERS(" ", text.lower()).strip()
    # the pattern's letters include a few signs for numbers
    return found.encode("utf-8", "replace") if any(map(str.isalpha, found)) else b""


def suffix_automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts the substrings of ``data``; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for byte in data:
        new = len(step)
        step.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        state = last
        while state >= 0 and byte not in step[state]:
            step[state][byte] = new
            state = link[state]
        if state >= 0:
            target = step[state][byte]
            if longest[target] == longest[state] + 1:
                link[new] = target
            else:
                copy = len(step)
                step.append(dict(step[target]))
                link.append(link[target])
                longest.append(longest[state] + 1)
                while state >= 0 and step[state].get(byte) == target:
                    step[state][byte] = copy
                    state = link[state]
                link[target] = link[new] = copy
        last = new
    return step


class Parser:
    """Phrase counts of many texts with one automaton per language."""

    def __init__(self, samples: dict[str, bytes]):
        self.languages = sorted(samples)
        used = sorted(set(b"".join(samples.values())) - {0})
        # class 0 stands for the end of a block, 1 for bytes no sample has
        self.classes = np.ones(256, np.int64)
        self.classes[used] = np.arange(2, len(used) + 2)
        self.width = len(used) + 2
        self.bits = np.array([np.log2(max(2, len(samples[x]))) for x in self.languages])
        self.tables = [self._table(suffix_automaton(samples[x])) for x in self.languages]

    def _table(self, step: list[dict[int, int]]) -> np.ndarray:
        """One entry per state and class: twice the next state's row, plus 1 where a phrase ends before the byte."""
        width = self.width
        state = np.array([s for s, out in enumerate(step) for b in out if b], np.int64)
        byte = np.array([b for out in step for b in out if b], np.int64)
        target = np.array([t for out in step for b, t in out.items() if b], np.int64)
        start = np.zeros(width, np.int64)
        first = state == 0
        start[self.classes[byte[first]]] = target[first] * width
        table = np.tile(2 * start + 1, (len(step), 1))
        table[:, 0] = 0
        table[state, self.classes[byte]] = 2 * target * width
        return table.reshape(-1).astype(np.int32)  # a sample's states are far below 2^31 / (2 * classes)

    def phrases(self, found: list[bytes]) -> np.ndarray:
        """Phrases per text (row) and language (column)."""
        sizes = np.array([len(x) for x in found], np.int64)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(found)), blocks)
        counts = np.zeros((len(found), len(self.languages)))
        for lo in range(0, len(owner), 4096):
            part = owner[lo : lo + 4096]
            nth = np.arange(lo, lo + len(part)) - (np.cumsum(blocks) - blocks)[part]
            grid = np.zeros((len(part), BLOCK), np.int32)
            for row, (i, k) in enumerate(zip(part.tolist(), nth.tolist(), strict=True)):
                piece = np.frombuffer(found[i], np.uint8, min(BLOCK, len(found[i]) - k * BLOCK), k * BLOCK)
                grid[row, : len(piece)] = self.classes[piece]
            steps = np.ascontiguousarray(grid.T[: int(min(BLOCK, sizes[part].max()))])
            for language, table in enumerate(self.tables):
                at = np.zeros(len(part), np.int32)
                ended = np.ones(len(part), np.int64)
                for column in steps:
                    at += column
                    entry = table[at]
                    ended += entry & 1
                    at = entry >> 1
                counts[:, language] += np.bincount(part, ended, len(found))
        return counts

    def estimates(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: its size in bytes, the position of the best language, its entropy, and that of the second (infinite without one)."""
        found = [normalised(t) for t in batch]
        sizes = np.array([len(x) for x in found], np.int64)
        entropy = self.phrases(found) * self.bits / np.maximum(sizes, 1)[:, None]
        best = entropy.argmin(axis=1)
        rows = np.arange(len(batch))
        least = entropy[rows, best]
        rest = entropy.copy()
        rest[rows, best] = np.inf
        return sizes, best, least, rest.min(axis=1)

    def predict(self, batch: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score: by how much the best estimate is below the second, as a share of it."""
        if not self.languages:
            return [UNDETERMINED] * len(batch), np.zeros(len(batch))
        sizes, best, least, second = self.estimates(batch)
        score = np.ones(len(batch)) if len(self.languages) == 1 else 1 - least / np.maximum(second, 1e-12)
        names = [self.languages[k] if n else UNDETERMINED for k, n in zip(best.tolist(), sizes.tolist(), strict=True)]
        return names, np.where(sizes > 0, np.clip(score, 0, 1), 0.0)


def learn_samples(docs: DataFrame, learn: Column, documents: int = 64, chars: int = 4000, size: int = 40_000) -> DataFrame:
    """(lang, sample) of every language, each bounded: the passages with the smallest hashed ids, whole documents before cut ones."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("lang"), F.col("text").alias("text"), learn.alias("learn"))
    # letterless texts take no place of a passage, nor do the signs before the first letter
    own = own.where("learn AND doc_id IS NOT NULL AND lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    passage = F.substring(F.regexp_replace("text", r"^\P{L}+", ""), 1, chars)
    cut = own.select("lang", "doc_id", (F.length("text") > chars).alias("is_cut"), (F.length("text") < 200).alias("short"), passage.alias("text"))
    order = Window.partitionBy("lang").orderBy("is_cut", "short", F.xxhash64("doc_id"), "doc_id", "text")
    picked = cut.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, parts = None, []

        def sample() -> pa.RecordBatch:
            # a zero byte between passages: no phrase runs over it
            return pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([b"\0".join(parts)[:size]], pa.binary())], names=["lang", "sample"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch.column("text")), strict=True):
                if lang != name:
                    if parts:
                        yield sample()
                    name, parts = lang, []
                data = normalised(text)
                if data and sum(map(len, parts)) < size:
                    parts.append(data)
        if parts:
            yield sample()

    dealt = picked.select("lang", "nth", "text").repartition("lang").sortWithinPartitions("lang", "nth")
    return pin_table(dealt.mapInArrow(run, "lang string, sample binary"), "samples")


def _parser(samples: dict[str, bytes]) -> Parser:
    """Built once per worker."""
    return resident(("language", hash(tuple(sorted(samples.items())))), lambda: Parser(samples))


def identify_rows(docs: DataFrame, samples: DataFrame, together: int = TOGETHER) -> DataFrame:
    """(row, lang_pred, score): every row as a struct with the language of its ``text``."""
    names = sorted(r["lang"] for r in samples.select("lang").collect())
    groups = [names[at : at + together] for at in range(0, len(names), together)]
    held = docs.select(F.struct("*").alias("row"))
    row = f"row {held.schema['row'].dataType.simpleString()}"
    if len(groups) > 1:
        return _identify_by_groups(held.withColumn("text", F.col("row").getField("text")), samples, groups)
    own = _collected(samples, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024, 4 << 20):
            # the text goes along in its row, once
            names, score = _parser(own).predict(texts(pc.struct_field(batch.column("row"), "text")))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(names, pa.string()), pa.array(score)], names=["row", "lang_pred", "score"])

    return held.mapInArrow(run, f"{row}, lang_pred string, score double")


def _collected(samples: DataFrame, names: list[str]) -> dict[str, bytes]:
    return {r["lang"]: bytes(r["sample"]) for r in samples.where(F.col("lang").isin(names)).collect()} if names else {}


def _identify_by_groups(held: DataFrame, samples: DataFrame, groups: list[list[str]]) -> DataFrame:
    """As ``identify_rows`` for more languages than a worker holds: one reading per group, written before the next one."""
    key = F.sha2(F.col("text").cast("binary"), 256)
    read = None
    for nth, names in enumerate(groups):
        own = _collected(samples, names)

        def run(batches: Iterator[pa.RecordBatch], own=own) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 1024, 4 << 20):
                parser = _parser(own)
                sizes, best, least, second = parser.estimates(texts(batch.column("text")))
                found = pa.array([parser.languages[k] for k in best.tolist()], pa.string())
                whole = pa.RecordBatch.from_arrays([batch.column("key"), found, pa.array(least), pa.array(second)], names=["key", "lang", "least", "second"])
                yield whole.filter(pa.array(sizes > 0))

        # equal texts have equal estimates and are one row from here on
        part = held.where("text IS NOT NULL").select(key.alias("key"), "text").mapInArrow(run, "key string, lang string, least double, second double")
        part = part.groupBy("key").agg(F.min(F.struct("least", "lang", "second")).alias("best"))
        part = pin_table(part, f"languages-{nth}")
        read = part if read is None else read.unionByName(part)
    values = F.array_sort(F.flatten(F.collect_list(F.array("best.least", "best.second"))))
    told = read.groupBy("key").agg(F.min("best").alias("best"), F.get(values, F.lit(1)).alias("second"))
    score = 1 - F.col("best.least") / F.greatest("second", F.lit(1e-12))
    told = told.select("key", F.col("best.lang").alias("lang"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)).alias("told"))
    rows = held.withColumn("key", key).join(told, "key", "left")
    return rows.select("row", F.coalesce("lang", F.lit(UNDETERMINED)).alias("lang_pred"), F.coalesce("told", F.lit(0.0)).alias("score"))


def training_rows() -> Column:
    """The rows that languages may be learnt from: crc32 of the id as text, modulo 4, is not 2."""
    return id_remainder("doc_id", 4) != 2


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    found = identify_rows(docs.select("doc_id", "text"), learn_samples(docs, training_rows()))
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False))
    return found.select(F.col("row.doc_id").alias("doc_id"), "lang_pred", "score").select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The table without the rows that have no letter to tell a language by."""
    found = identify_rows(docs, learn_samples(docs, training_rows()))
    return found.where(F.col("lang_pred") != UNDETERMINED).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
