"""The chained stages on odd tables, and the recall of the near-copy stage against exact similarity."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gazetta.llm import simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "row string, key string, node string, root string, c string, f0 string, held string, score string, chunk string, id string, nth string, part string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    labels = [(i, 1, int(i % 5 == 0)) for i in range(1, 60)] + [(None, 1, 1), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def documents():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(400)]
    base = [" ".join(rnd.choice(words) for _ in range(120)) for _ in range(40)]
    rows = [(i + 1, t, "en" if i % 3 else "de") for i, t in enumerate(base)]
    rows += [(100 + i, " ".join([*t.split()[:-1], "changed"]), "en") for i, t in enumerate(base[:10])]
    rows += [(200, base[0], "en"), (200, base[0], "en"), (201, None, None), (202, "", ""), (203, " \n\t ", "en"), (None, base[1] + " tail", None), (204, " ".join(words * 60), "en")]
    return rows


def chain(spark, docs, folder):
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        out[name] = docs
    return out


def test_nulls_empty_long_and_repeated_rows_pass_every_stage(spark, folder):
    docs = spark.createDataFrame([(i, t, g, None, len(t) if t else None) for i, t, g in documents()], SCHEMA).repartition(3)
    out = chain(spark, docs, folder)
    ids = {n: sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in df.select("doc_id").collect()) for n, df in out.items()}
    assert not {201, 202, 203} & {i for _, i in ids["language"]}
    assert ids["line_dedup"] == ids["language"]
    near = {i for _, i in ids["near_dedup"]}
    assert len(ids["near_dedup"]) == len(set(ids["near_dedup"]))
    left = {i for _, i in ids["line_dedup"]}
    # the smaller of each pair of near copies stays
    assert not any(100 + i in near and 1 + i in left for i in range(10)) and near >= {i for i in left if 0 < i <= 40}
    packed = out["packing"].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert {r["doc_id"] for r in packed} == {None if nameless else i for nameless, i in ids["near_dedup"]}
    assert all(r["n"] == r["t"] for r in packed)


def test_clashing_columns_are_passed_on(spark, folder):
    extra = [c.split()[0] for c in CLASHING.split(", ")]
    docs = spark.createDataFrame([(i, t, g, None, 1, *["x"] * len(extra)) for i, t, g in documents()[:20]], f"{SCHEMA}, {CLASHING}")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == [*(c.split()[0] for c in SCHEMA.split(", ")), *extra], name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert {r["held"] for r in docs.select("held").distinct().collect()} <= {"x"}


def test_an_empty_table_stays_empty(spark, folder):
    out = chain(spark, spark.createDataFrame([], SCHEMA), folder)
    assert all(df.count() == 0 for df in out.values())


def jaccard(a, b, words=5):
    x, y = ({tuple(t.split()[i : i + words]) for i in range(len(t.split()) - words + 1)} for t in (a, b))
    return len(x & y) / len(x | y)


def test_near_copies_are_found_and_others_are_not(spark):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdefghijklmno") for _ in range(rnd.randint(2, 8))) for _ in range(3000)]
    texts, near, far = [], [], []
    for k in range(250):
        base = [rnd.choice(words) for _ in range(rnd.randint(80, 400))]
        other = list(base)
        for _ in range(max(1, int(len(base) * rnd.choice([0.005, 0.01, 0.015, 0.03])))):
            other[rnd.randrange(len(other))] = "new"
        texts += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
        (near if jaccard(texts[-2][1], texts[-1][1]) >= 0.8 else far).append(k)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    root = {r["doc_id"]: r["root"] for r in simhash.similar_components(docs)[0].collect()}
    found = [k for k in near if root[2 * k] == root[2 * k + 1]]
    assert len(near) > 120 and len(far) > 20
    assert len(found) >= 0.9 * len(near)
    assert not any(root[2 * k] == root[2 * k + 1] for k in far)
    assert len({root[2 * k] for k in range(250)}) == 250


def brute_roots(texts, words=5, similarity=0.8):
    sets = {}
    for i, t in texts:
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(sets, 2):
        if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {i: find(i) for i in sets}


def test_no_similar_pair_of_a_crowd_is_left_out(spark):
    """Texts around one text that are near it, near another of them only, or near none: each pair at the threshold counts."""
    rnd = random.Random(21)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(2000)]
    texts = []
    for size in (8, 40, 120, *range(50, 60)):
        base = [rnd.choice(words) for _ in range(size)]
        for _ in range(30):
            other = list(base)
            for _ in range(max(1, int(size * rnd.choice([0.01, 0.03, 0.05])))):
                other[rnd.randrange(size)] = rnd.choice(words)
            texts.append(" ".join(other))
    for size in range(50, 60):
        for _ in range(10):
            base = [rnd.choice(words) for _ in range(size)]
            texts += [" ".join(base), " ".join([*base[:20], "new", *base[21:]])]
    texts = list(enumerate(texts + texts[:5]))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    found, links = simhash.similar_components(docs)
    got, want = {r["doc_id"]: r["root"] for r in found.collect()}, brute_roots(texts)
    assert 100 < len(set(want.values())) < len(want) - 100
    assert {tuple(sorted(i for i in got if got[i] == r)) for r in set(got.values())} == {
        tuple(sorted(i for i in want if want[i] == r)) for r in set(want.values())
    }
    assert {r["doc_id"] for r in simhash.drop_similar(docs).collect()} == set(want.values())
