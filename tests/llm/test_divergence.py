"""Source divergence against exact Python integers: nulls, empty and long texts, ties, repeats, many sources, empty tables."""

import re
from collections import Counter, defaultdict

import pytest

from gazetta.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n string, value string, rank string, word string, item string, id string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=3, top=200):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        own = Counter(TERM.findall((text or "").translate(FOLD)))
        counts[lang, source].update(own)
        docs[lang].update(own.keys())
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for x, s in groups if x == lang)
        share = {}
        for name in [*sources, None]:
            own = sum((counts[lang, s] for s in sources), Counter()) if name is None else counts[lang, name]
            total = sum(own[t] for t in kept)
            share[name] = {t: 1 + 1_000_000_000 * (own[t] + 1) // (total + len(kept)) for t in kept}
        for a in sources:
            pairs = [(-sum((share[a][t] - share[b][t]) ** 2 // share[b][t] for t in kept), b.encode(), b) for b in sources if b != a]
            terms = [(-((share[a][t] - share[None][t]) ** 2 // share[None][t]), t.encode(), t) for t in kept if counts[lang, a][t] and share[a][t] > share[None][t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, a, part, item, -value, rank) for rank, (value, _, item) in enumerate(found, 1)]
    return sorted(out)


def same(spark, rows, **options):
    df = spark.createDataFrame([(i, *r, *["x"] * 7) for i, r in enumerate(rows)], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in divergence.audit(df, **options).collect())
    assert got == brute(rows, **options)
    return got


WORDS = [f"w{i}" for i in range(90)] + ["Ärger", "ärger", "ΣΑΣ", "naïve", "中文", "x"]


def mixed(n, sources):
    rows = []
    for i in range(n):
        words = [WORDS[(i * 7 + j * j) % len(WORDS)] for j in range(i % 23)]
        rows.append((" ".join(words) + ("\nThe the THE-end_a1b" if i % 3 else ""), ("en", "de")[i % 2], f"s{i % sources}"))
    return rows


def test_mixed_texts(spark):
    got = same(spark, mixed(120, 5))
    assert {r[2] for r in got} == {"pair", "term"}


def test_nulls_empty_long_and_repeated_rows(spark):
    long = " ".join(f"common{i % 400}" for i in range(40_000))
    rows = [(long, "en", "a"), (long, "en", "a"), (None, "en", "empty"), ("", None, None), ("12 .. 34", "fr", "x"), ("one two", "fr", "y"), (long[:4000], "en", None), ("", "en", "")]
    got = same(spark, rows)
    assert ("fr", "x", "pair", "y", 0, 1) in got


def test_terms_that_only_large_letters_tell_apart_and_ties(spark):
    rows = [("Beta alpha ÀB àb", "en", s) for s in "abc" for _ in range(3)] + [("alpha gamma", "en", "d")] * 4
    same(spark, rows)
    same(spark, rows, top=1)


def test_many_sources_meet_in_tiles(spark, monkeypatch):
    rows = [(" ".join(WORDS[(i + j) % 60] for j in range(12)), "en", f"s{i % 17}") for i in range(150)]
    df = spark.createDataFrame([(i, *r, *["x"] * 7) for i, r in enumerate(rows)], SCHEMA)
    counts = divergence.term_counts(df)
    terms = divergence.kept_terms(counts)
    sizes = divergence.group_sizes(counts, terms)
    got = {(r.source, r["item"]): r["value"] for r in divergence.pair_values(terms, sizes, words=1, tile=4).collect()}
    assert got == {(r[1], r[3]): r[4] for r in brute(rows) if r[2] == "pair"}


def test_counts_beyond_64_bits_of_product(spark):
    n = 10_000_000_000_000
    got = spark.range(1).select(divergence.share(*[divergence.F.lit(x).cast("long") for x in (n, 7 * n, 11)]).alias("p")).first()["p"]
    assert got == 1 + 1_000_000_000 * (n + 1) // (7 * n + 11)


@pytest.mark.parametrize("rows", [[], [(None, None, None)]])
def test_nothing_to_compare(spark, rows):
    assert same(spark, rows) == []
