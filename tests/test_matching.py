"""Name similarity: kernel against dynamic programming, joins against brute force."""

import random
from decimal import ROUND_HALF_EVEN, Decimal
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gazetta.functions import similarity as sim
from gazetta.operators import link
from gazetta.plans import links


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for ch in a:
        new = [0]
        for j, other in enumerate(b):
            new.append(row[j] + 1 if ch == other else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def key(name):
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in name.lower()).split()
    return " ".join(sorted(words))


def ratio(a, b):
    a, b = key(a), key(b)
    if not a or not b:
        return 0
    value = Decimal(200 * lcs(a, b)) / Decimal(len(a) + len(b))
    return int(value.quantize(Decimal(1), ROUND_HALF_EVEN))


def random_names(n, seed, alphabet="abcdeinorst "):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 14))) for _ in range(n)]


def misspelt(name, rnd):
    chars = list(name)
    for _ in range(rnd.randint(0, 3)):
        i = rnd.randrange(len(chars) + 1)
        if rnd.random() < 0.5 and chars:
            del chars[min(i, len(chars) - 1)]
        else:
            chars.insert(i, rnd.choice("abcdeinorst "))
    return "".join(chars)


def test_kernel_equals_dynamic_programming():
    rnd = random.Random(3)
    pairs = []
    for size in (1, 5, 20, 61, 62, 63, 64, 90):
        for _ in range(25):
            a = "".join(rnd.choice("abcé日 ") for _ in range(rnd.randint(0, size)))
            b = "".join(rnd.choice("abcé日 ") for _ in range(rnd.randint(0, size)))
            pairs.append((a, b))
    left, right = pd.Series([p[0] for p in pairs]), pd.Series([p[1] for p in pairs])
    assert np.array_equal(sim.lcs_lengths(left, right), [lcs(a, b) for a, b in pairs])


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("Smith, Jane", "jane SMITH", 100),
        ("", "x", 0),
        (None, "x", 0),
        ("...", "x", 0),
        ("abc", "abd", 67),
        ("Jane O'Neil", "jane oneil", 86),
    ],
)
def test_token_sort_ratio(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(sim.token_sort_ratio("a", "b").alias("s")).first()["s"] == want
    assert ratio(a or "", b) == want


def test_half_even_edges(spark):
    # 13 of 40 characters twice: 200 * 169 / 400 = 84.5 -> 84, 139 / 400 -> 69.5 -> 70
    for common, total, want in ((169, 400, 84), (139, 400, 70), (119, 400, 60), (109, 400, 54)):
        half = total // 2
        a = "a" * common + "b" * (half - common)
        b = "a" * common + "c" * (half - common)
        df = spark.createDataFrame([(a, b)], "a string, b string")
        assert df.select(sim.key_ratio("a", "b").alias("s")).first()["s"] == want


def test_sequence_ratio(spark):
    from difflib import SequenceMatcher

    df = spark.createDataFrame([("abcd", "bcde"), ("x", None), ("", "")], "a string, b string")
    got = [r["r"] for r in df.select(sim.sequence_ratio("a", "b").alias("r")).collect()]
    assert got == [SequenceMatcher(None, "abcd", "bcde").ratio(), 0.0, 0.0]


@pytest.mark.parametrize("score", [90, 85, 80, 70, 55, 30])
def test_candidates_lose_no_pair(spark, score):
    rnd = random.Random(score)
    right = sorted({key(n) for n in random_names(120, 1)} - {""})
    left = sorted({key(misspelt(n, rnd)) for n in right} - {""})
    got = link.similar_keys(
        spark.createDataFrame([(k,) for k in left], "lkey string"),
        spark.createDataFrame([(k,) for k in right], "rkey string"),
        score,
    )
    want = {(a, b, ratio(a, b)) for a in left for b in right if ratio(a, b) >= score}
    assert {tuple(r) for r in got.collect()} == want


def brute_best(left, right, threshold):
    out = {}
    for lid, name in left:
        best, best_id = 0, None
        for rid, other in right:
            s = ratio(name, other)
            if s > best:
                best, best_id = s, rid
        out[lid] = (best_id if best >= threshold else None, best)
    return out


@pytest.mark.parametrize("stages", [(), (90, 75)])
def test_fuzzy_link_equals_brute_force(spark, stages):
    rnd = random.Random(9)
    names = random_names(60, 5)
    right = [(i, n) for i, n in enumerate(names + names[:20])]
    left = [(i, misspelt(rnd.choice(names), rnd)) for i in range(60)] + [(60, " . "), (61, None)]
    want = brute_best([(i, n or "") for i, n in left], right, 70)
    got = link.fuzzy_link(
        spark.createDataFrame(left, "lid long, lname string"),
        spark.createDataFrame(right, "rid long, rname string"),
        "lid", "lname", "rid", "rname", 70, stages=stages,
    )
    rows = {r["lid"]: (r["right_id"], r["score"]) for r in got.collect()}
    assert len(rows) == 62
    for lid, (rid, score) in rows.items():
        assert rid == want[lid][0]
        assert score == (want[lid][1] if want[lid][1] >= 70 else None)


def test_one_to_one_and_failing_scores(spark):
    right = [(1, "jane smith"), (2, "john brown"), (3, "smith jane")]
    left = [(10, "Jane Smith"), (11, "Smith Jane"), (12, "Jon Browne"), (13, "Zoe Quill")]
    got = link.fuzzy_link(
        spark.createDataFrame(left, "lid long, lname string"),
        spark.createDataFrame(right, "rid long, rname string"),
        "lid", "lname", "rid", "rname", 85, one_to_one=True, report_from=1, stages=(60,),
    )
    rows = {r["lid"]: (r["right_id"], r["score"]) for r in got.collect()}
    assert rows[10] == (1, 100)
    assert rows[11] == (None, 100)  # the earlier row took it
    assert rows[12] == (2, ratio("Jon Browne", "john brown"))
    assert rows[13] == (None, max(ratio("Zoe Quill", n) for _, n in right))


def test_blocked_link_stays_in_its_region(spark):
    left = spark.createDataFrame([(1, "NSW", "jane smith")], "lid long, state string, lname string")
    right = spark.createDataFrame(
        [(1, "VIC", "jane smith"), (2, "NSW", "jan smith")], "rid long, state string, rname string"
    )
    got = link.fuzzy_link(left, right, "lid", "lname", "rid", "rname", 55, block=["state"]).first()
    assert got["right_id"] == 2


def test_best_candidate_stops_at_first_good_one(spark):
    df = spark.createDataFrame(
        [("a", 1, 65, "x"), ("a", 2, 90, "y"), ("b", 1, 40, "x"), ("b", 2, 50, "y"), ("c", 1, 30, "p"), ("c", 2, 30, "q")],
        "e string, q int, score int, who string",
    )
    got = {r["e"]: (r["who"], r["is_match"]) for r in link.best_candidate(df, "e", "score", "q", ["who"], 60).collect()}
    assert got == {"a": ("x", True), "b": ("y", False), "c": ("p", False)}


@pytest.mark.parametrize("stages", [(), (70,)])
def test_few_right_names_are_compared_with_all(spark, monkeypatch, stages):
    """At a low threshold a name has thousands of signatures, more than there are right names."""
    monkeypatch.setattr(link, "similar_keys", None)
    rnd = random.Random(4)
    names = random_names(300, 5)
    right = [(i, n) for i, n in enumerate(names[:30] + names[:5])]
    left = [(i, misspelt(n, rnd)) for i, n in enumerate(names)]
    want = brute_best(left, right, 55)
    got = link.fuzzy_link(
        spark.createDataFrame(left, "lid long, lname string"), spark.createDataFrame(right, "rid long, rname string"),
        "lid", "lname", "rid", "rname", 55, stages=stages,
    )
    assert {r["lid"]: (r["right_id"], r["score"]) for r in got.collect()} == {
        i: (rid, score if rid is not None else None) for i, (rid, score) in want.items()
    }


@pytest.mark.parametrize("score", [90, 70, 55, 30])
def test_signatures_are_counted_before_they_are_formed(spark, score):
    keys = sorted({key(n) for n in random_names(40, 1)} - {""})
    df = spark.createDataFrame([(k,) for k in keys], "lkey string")
    order, _ = link.occurrence_order(df, df.withColumnRenamed("lkey", "rkey"))
    lengths = {n: sum(len(k) == n for k in keys) for n in {len(k) for k in keys}}
    assert link._signature_rows(df, "lkey", score, [], False, order).count() == link.signature_count(lengths, score)


def test_subsequences_of_few_and_many_distinct_names(monkeypatch):
    import pandas as pd

    rnd = random.Random(3)
    for masks in (1 << 21, 40):
        monkeypatch.setattr(sim, "_MASKS", masks)
        for letters in ("ab c", "aé€\U0001f600 b", "".join(map(chr, range(97, 400)))):
            words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 62))) for _ in range(120)]
            left, right = pd.Series(rnd.choices(words, k=300)), pd.Series(rnd.choices(words, k=300))
            assert sim.lcs_lengths(left, right).tolist() == [sim._lcs_long(a, b) for a, b in zip(left, right, strict=True)]


def test_key_integrity_joins_nothing(spark, capsys):
    child = spark.createDataFrame([(1,), (1,), (2,), (7,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    got = link.key_integrity(child, parent, ["k"])
    assert tuple(got.first()) == (2, 3)
    assert (link.orphans(child, parent, ["k"]).count(), link.members(child, parent, ["k"]).count()) == (2, 3)
    assert tuple(link.key_integrity(child.limit(0), parent, ["k"]).first()) == (0, 0)
    two = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k int, s string")
    assert tuple(link.key_integrity(two, two.filter("k = 1"), ["k", "s"]).first()) == (2, 1)
    capsys.readouterr()
    links.foreign_keys(spark, "/root/testdata/sf0.001").explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and "Sort" not in plan


def test_containment_equals_brute_force(spark):
    rnd = random.Random(2)
    pats = sorted({"".join(rnd.choice("ab c") for _ in range(rnd.randint(1, 6))) for _ in range(60)})
    texts = sorted({"".join(rnd.choice("ab cd") for _ in range(rnd.randint(1, 30))) for _ in range(60)})
    left = spark.createDataFrame([(rnd.choice("XY"), p) for p in pats], "s string, p string")
    right = spark.createDataFrame([(rnd.choice("XY"), t) for t in texts], "s string, t string")
    got = {tuple(r) for r in link.containment_pairs(left, right, ["s"], "p", "t").collect()}
    want = {
        (s, p, t)
        for s, p in map(tuple, left.collect())
        for s2, t in map(tuple, right.collect())
        if s == s2 and (p in t or t in p)
    }
    assert {(r[0], r[1], r[2]) for r in got} == want


def test_pairs_come_out_of_one_pass_over_the_texts(spark, monkeypatch, capsys):
    """Blocks cut on both sides, patterns of all lengths: the pairs of brute force, and nothing is shuffled once they are found."""
    monkeypatch.setattr(link, "_PIECE", 2000)
    monkeypatch.setattr(link, "_SHARD", 400)
    rnd = random.Random(5)
    texts = sorted({" ".join(rnd.choice(["the", "thé", "on", "a"]) for _ in range(rnd.randint(1, 40))) for _ in range(200)})
    pats = sorted({t[: rnd.randint(1, 60)] for t in texts} | {t[5:] for t in texts if len(t) > 40})
    right = [(rnd.choice([1, 2, None]), t, i) for i, t in enumerate(texts)]
    copies = [(b, t, i + 1000) for b, t, i in right[::3]]
    left = [(rnd.choice([1, 2, 3, None]), p) for p in pats]
    found = link.contained_in(
        spark.createDataFrame(left, "b int, p string"), spark.createDataFrame(copies + right, "b int, t string, i long"), ["b"], "p", "t", "i"
    )
    got = [tuple(r) for r in found.collect()]
    want = {(b, p, i) for b, p in left for b2, t, i in right if b is not None and b == b2 and p in t}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 500
    capsys.readouterr()
    found.explain()
    above, below = capsys.readouterr().out.split("MapInArrow", 1)
    assert "Exchange" not in above and "Exchange" in below


def test_containment_without_blocks_and_of_nothing(spark):
    left = spark.createDataFrame([("ab",), ("",), (None,)], "p string")
    right = spark.createDataFrame([("cab",), ("a",), ("",), (None,)], "t string")
    assert [tuple(r) for r in link.contained_in(left, right, [], "p", "t").collect()] == [("ab", "cab")]
    assert link.contained_in(left.limit(0), right, [], "p", "t").isEmpty()
    assert link.contained_in(left, right.limit(0), [], "p", "t").isEmpty()


def test_copies_of_a_name_are_matched_once(spark):
    """A third of all rows under one name: the candidate join sees it once per side."""
    right = spark.range(3000).select(
        F.col("id").alias("rid"), F.when(F.col("id") < 1000, "jane smith").otherwise(F.concat(F.lit("n"), "id")).alias("rname")
    )
    left = spark.range(3000).select(F.col("id").alias("lid"), F.lit("jane smyth").alias("lname"))
    got = link.fuzzy_link(left, right, "lid", "lname", "rid", "rname", 85)
    assert got.filter("right_id = 0").count() == 3000


def test_long_texts_have_their_blocks_found_in_both_ways():
    import time

    rnd = random.Random(11)
    for n in (5, 40, 300, 700):
        a = "".join(rnd.choice("abc ") for _ in range(n))
        b = "".join(rnd.choice("abc ") for _ in range(n)) if n % 2 else a[n // 3 :] + a[: n // 2]
        want = sum(m.size for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())
        assert sim.block_length(a, b) == want
        codes = [np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in (a, b)]
        assert sim._longest_by_suffixes(*codes) == sim._longest_block(*codes)
    words = [f"w{rnd.randrange(2000)}" for _ in range(2200)]
    a = " ".join(words)
    b = " ".join(w for w in words if rnd.random() > 0.05)
    assert min(len(a), len(b)) > 10_000
    start = time.perf_counter()
    assert sim.block_length(a, b) > 0.9 * len(b)
    assert time.perf_counter() - start < 20


def test_order_of_occurrences_is_measured(spark):
    left = spark.createDataFrame([("zz top",), ("za",)], "lkey string")
    right = spark.createDataFrame([("zebra",), ("qa",)], "rkey string")
    order, pairs = link.occurrence_order(left, right)
    assert pairs == 4 and order["q1"] < order["z1"] and order["z2"] < order["a1"]
    assert link.occurrence_order(left.limit(0), right.limit(0)) == ({}, 0)


def test_a_signature_that_all_names_share_is_split(spark, monkeypatch):
    monkeypatch.setattr(link, "_PAIRS", 500)
    rnd = random.Random(9)
    left = sorted({key("common " + "".join(rnd.choice("abcdefgh") for _ in range(4))) for _ in range(120)})
    right = sorted({key("common " + "".join(rnd.choice("abcdefgh") for _ in range(4))) for _ in range(150)})
    got = link.similar_keys(spark.createDataFrame([(k,) for k in left], "lkey string"), spark.createDataFrame([(k,) for k in right], "rkey string"), 80)
    want = {(a, b, ratio(a, b)) for a in left for b in right if ratio(a, b) >= 80}
    assert {tuple(r) for r in got.collect()} == want and len(want) > 50
