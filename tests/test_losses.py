"""Rows, keys, links and values that must not get lost or multiply."""

import math
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from gazetta.functions import similarity as sim
from gazetta.functions import text as tx
from gazetta.operators import dedupe as dd
from gazetta.operators import gates, geo, link, merge
from gazetta.operators import pages as pg
from gazetta.plans import celebrants, influencers
from gazetta.sources import files


def tuples(df):
    return sorted(tuple(r) for r in df.collect())


# -- keyed writes ----------------------------------------------------------------


def test_two_updates_of_a_key_give_one_row(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, name string, n int")
    updates = spark.createDataFrame([(1, "x", 5), (1, "y", 4), (3, "z", 1), (3, "z", 1)], "id int, name string, n int")
    assert tuples(merge.upsert(target, updates, ["id"])) == [(1, "y", 4), (2, "b", 2), (3, "z", 1)]
    assert tuples(merge.upsert(target, updates.withColumn("seq", -F.col("n")), ["id"], ["seq"])) == [(1, "y", 4), (2, "b", 2), (3, "z", 1)]
    assert tuples(merge.patch_non_null(target, updates, ["id"])) == [(1, "y", 4), (2, "b", 2)]
    gaps = target.withColumn("name", F.lit(""))
    assert tuples(merge.fill_gaps(gaps, updates, ["id"])) == [(1, "y", 1), (2, "", 2)]
    keys_only = merge.upsert(target.select("id"), updates.select("id"), ["id"])
    assert tuples(keys_only) == [(1,), (2,), (3,)]


@pytest.mark.parametrize("write", [merge.upsert, merge.patch_non_null, merge.fill_gaps])
def test_unknown_columns_are_refused(spark, write):
    target = spark.createDataFrame([(1, "a")], "id int, name string")
    with pytest.raises(ValueError, match="other"):
        write(target, target.withColumn("other", F.lit(1)), ["id"])


# -- files -------------------------------------------------------------------------


def test_short_lines_stay_and_long_ones_go(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text('a,b,c\n1,2,3\n4,5\n6\n7,8,9,10\n"x,y",2\n"1,1","2","3,3",4\n1,2,3,\n,,\n', encoding="utf-8")
    assert tuples(files.read_csv_strings(spark, str(path))) == sorted([("1", "2", "3"), ("4", "5", ""), ("6", "", ""), ("x,y", "2", ""), ("", "", "")])
    path.write_text('a,b\n"one\ntwo",3\n', encoding="utf-8")
    assert tuples(files.read_csv_strings(spark, str(path), multi_line=True)) == [("one\ntwo", "3")]


# -- places --------------------------------------------------------------------------


def test_unknown_coordinates_have_no_distance(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (1.0, 1.0)], "lat double, lng double")
    km = [r["km"] for r in df.select(geo.haversine_km("lat", "lng", F.lit(1.0), F.lit(1.0)).alias("km")).collect()]
    assert km == [None, None, 0.0]


def great_circle(a, b):
    la1, lo1, la2, lo2 = map(math.radians, (*a, *b))
    h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("places_n", [0, 1, 60, 700])
def test_nearest_place_with_unknown_and_crowded_coordinates(spark, places_n):
    rng = random.Random(places_n)
    crowd = [(-33.8 + rng.random() / 1000, 151.2 + rng.random() / 1000) for _ in range(places_n // 2)]
    far = [(rng.uniform(-89, 89), rng.uniform(-179, 179)) for _ in range(places_n - len(crowd))]
    places = [(i, *p, f"p{i}") for i, p in enumerate(crowd + far)] + [(-1, None, 1.0, "x"), (-2, 1.0, None, "x")]
    points = [(i, rng.uniform(-89, 89), rng.uniform(-179, 179)) for i in range(60)] + [(100 + i, -33.8 + i / 9000, 151.2) for i in range(20)]
    points += [(200, None, 5.0), (201, 5.0, None), (202, points[0][1], points[0][2])]
    got = geo.nearest(
        spark.createDataFrame(points, "k int, lat double, lng double"), spark.createDataFrame(places, "no int, lat double, lng double, name string"), ["no", "name"], "no"
    ).collect()
    assert len(got) == len(points)
    known = [p for p in places if p[0] >= 0]
    for r in got:
        if r["lat"] is None or r["lng"] is None or not known:
            assert (r["near_no"], r["near_name"], r["near_km"]) == (None, None, None)
        else:
            least = min(great_circle((r["lat"], r["lng"]), p[1:3]) for p in known)
            assert r["near_km"] == pytest.approx(least, abs=1e-6)
            assert great_circle((r["lat"], r["lng"]), places[r["near_no"]][1:3]) == pytest.approx(least, abs=1e-6)


# -- pages ---------------------------------------------------------------------------

PAGE = """<html><head><title>Caf&eacute; &#8217;A&#x27; &amp;lt; &nosuch; {}</title>
<script>var x = '<a href="/script">s</script>
<style>a::before {{ content: "<a href='/style'>" }}</style></head><body>
<a class="x" href="/a">A <b>bold</b></a>
<a href="/open">unclosed
<a href=/bare>bare &ndash; one</a>
<a title='it > is' href="/it's-on?x=1&amp;y=2">apostrophe</a>
<!-- <a href="/comment">no</a> -->
<a data-href="/data" HREF='/single'>single</a>
<abbr href="/abbr">no link</abbr><a name="x">no address</a>
<a href="mailto:me@example.org?subject=x">mail</a> <a href="tel:0400 111 222">call</a>
</body></html>""".format("long " * 100)


def test_links_of_a_page_as_written(spark):
    pages = spark.createDataFrame([(1, "https://x.org/d/p.html", PAGE), (2, "https://x.org/", ""), (3, "https://x.org/", None)], "page_id long, url string, html string")
    got = [(r["href"], r["text"]) for r in pg.extract_links(pages).orderBy("pos").collect()]
    assert got == [
        ("/a", "A bold"),
        ("/open", "unclosed"),
        ("/bare", "bare – one"),
        ("/it's-on?x=1&y=2", "apostrophe"),
        ("/single", "single"),
        ("mailto:me@example.org?subject=x", "mail"),
        ("tel:0400 111 222", "call"),
    ]
    found = pg.contacts(pages).orderBy("page_id").first()
    assert found["email"] == "me@example.org"
    ranked = pg.rank_links(pages, ["open", "bare"], 5)
    assert sorted(r["link"] for r in ranked.collect()) == ["https://x.org/bare", "https://x.org/open"]


def test_text_of_a_page_as_written(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    row = pg.page_text(pages).first()
    assert row["title"] == "Café ’A' &lt; &nosuch; " + ("long " * 100).strip()
    assert "comment" not in row["body_text"] and "content:" not in row["body_text"]
    cut = pages.select(pg.page_title("html", 10).alias("t")).first()["t"]
    assert cut == row["title"][:10]


@pytest.mark.parametrize(
    "raw, want",
    [("&amp;amp;", "&amp;"), ("a & b", "a & b"), ("&#0;&#xD800;&#x110000;", "&#0;&#xD800;&#x110000;"), ("&#128512;&nbsp;x", "😀 x"), ("&apos;&quot;", "'\""), ("&&lt;;", "&<;")],
)
def test_entities_are_decoded_once(one, raw, want):
    assert one(raw, pg.unescape) == want


def test_a_request_to_verify_is_found_anywhere(one):
    from pyspark.sql import types as T

    late = "x" * 5000 + " Please verify you are human"
    assert one(late, gates.is_blocked_page) is True
    assert one(late, lambda c: gates.is_blocked_page(c, head=2000)) is False
    assert T is not None


def test_combined_documents_are_whole_by_default(spark):
    df = spark.createDataFrame([("h", i, f"u{i}", "w " * 20_000) for i in range(5)], "host string, n int, u string, b string")
    whole = pg.combine_docs(df, ["host"], "n", "u", "b").first()["combined"]
    assert whole.count("w") == 100_000
    assert len(pg.combine_docs(df, ["host"], "n", "u", "b", total_chars=100).first()["combined"]) == 100


# -- ids -----------------------------------------------------------------------------


def test_stable_ids_carry_the_whole_digest(spark):
    got = spark.range(1).select(dd.stable_id("C-", F.lit("a")).alias("i")).first()["i"]
    assert len(got) == 2 + 64


def test_new_directory_rows_with_like_addresses_stay_apart(spark):
    master = spark.createDataFrame([(1, "CEL-1", "Somebody Else")], "row_no long, celebrant_id string, full_name string")
    slug = "the-best-wedding-celebrant-name"
    rows = [
        (1, "Ann One", f"https://e.com/{slug}-sydney/", "NSW"),
        (2, "Bob Two", f"https://e.com/{slug}-perth", "WA"),
        (3, "Cid Three", None, "SA"),
        (4, "Dot Four", None, "SA"),
        (5, "Eve Five", "", "SA"),
        (6, "Ann One again", f"https://e.com/{slug}-sydney", "NSW"),
    ]
    schema = "row_no long, brand_name string, easy_weddings_profile_url string, state string, easy_weddings_rating string, easy_weddings_review_count string, easy_weddings_price_from string, is_destination_specialist string"
    listing = spark.createDataFrame([(*r, None, None, None, None) for r in rows], schema)
    out = celebrants.cross_reference(master, {"EW": listing})
    names = sorted(r["full_name"] for r in out.collect())
    assert names == ["Ann One", "Bob Two", "Cid Three", "Dot Four", "Eve Five", "Somebody Else"]


def test_answers_with_very_many_items_keep_their_order(spark):
    items = ",".join(f'{{"name":"n{i}","url":"https://s{i}.org","source_type":"blog"}}' for i in range(30))
    answers = spark.createDataFrame([(1, "q", f"[{items}]"), (0, "q", '[{"name":"z","url":"https://z.org","source_type":"blog"}]')], "answer_no long, query string, answer string")
    known = spark.createDataFrame([("s3.org",)], "url_key string")
    got = influencers.discover(answers, known, ["blog"], 7).orderBy("source_id").collect()
    assert [r["name"] for r in got][:4] == ["z", "n0", "n1", "n2"] and got[0]["source_id"] == "INF-DISC-008"
    assert len({r["source_id"] for r in got}) == len(got)


# -- names and cells ------------------------------------------------------------------


def test_block_ratio_is_ratcliff_obershelp():
    rng = random.Random(4)
    for _ in range(400):
        a, b = ("".join(rng.choice("abc d") for _ in range(rng.randint(1, 30))) for _ in range(2))
        want = SequenceMatcher(None, a, b, autojunk=False).ratio()
        assert 2 * sim.block_length(a, b) / (len(a) + len(b)) == pytest.approx(want), (a, b)
    long = "abcdefghij" * 40
    assert sim.block_length(long, long[::-1] + "x") > 0 and sim.block_length(long, long) == 400


def test_block_ratio_in_columns(spark):
    df = spark.createDataFrame([("abcd", "bcde"), ("", "x"), (None, None), ("abcd", "bcde")], "a string, b string")
    assert [r[0] for r in df.select(sim.sequence_ratio("a", "b")).collect()] == [0.75, 0.0, 0.0, 0.75]


@pytest.mark.parametrize(
    "cell, want",
    [
        ("12 High St\nTown NSW 2000\nM: 0400 111 222\na@b.org", "12 High St Town NSW 2000"),
        ("Religious ceremonies\n12 High St\n12 High St", "12 High St"),
        ("m: 0400 111 222\nP: 02 9999", "P: 02 9999"),
        ("a@b.org\np(02) 1\nq@c.org x\nP: 3\nP: 4", "p(02) 1 x P: 3 P: 4"),
        ("", None),
        (None, None),
    ],
)
def test_address_of_a_cell(one, cell, want):
    assert one(cell, tx.address_line) == want


def test_fee_of_many_numbers(one):
    assert one("10 or 20 or 30 or 40 or 50", tx.fee_amount) == 30.0
    assert one("10 or 20 or 30 or 40 or 50", lambda c: tx.fee_amount(c, first=4)) == 25.0
    assert one("$100 - $300 per day, 5 days", tx.fee_amount) == 200.0


# -- thousands of names ----------------------------------------------------------------


def names(n, seed):
    rng = random.Random(seed)
    parts = ["an", "el", "ro", "mi", "ka", "ste", "ber", "lo", "vi", "tor", "ja", "ne"]
    return sorted({" ".join("".join(rng.choice(parts) for _ in range(rng.randint(2, 4))) for _ in range(2)) for _ in range(n)})


@pytest.mark.parametrize("score", [85, 70, 55])
def test_every_pair_of_names_is_found_once(spark, score):
    import pandas as pd

    left, right = names(250, 1), names(300, 2)
    a = spark.createDataFrame([(x,) for x in left], "lkey string")
    b = spark.createDataFrame([(x, i) for i, x in enumerate(right)], "rkey string, first int")
    got = [(r["lkey"], r["rkey"], r["score"]) for r in link.similar_keys(a, b, score).collect()]
    every = pd.DataFrame([(x, y) for x in left for y in right], columns=["x", "y"])
    lcs = sim.lcs_lengths(every["x"], every["y"])
    total = every["x"].str.len() + every["y"].str.len()
    want = [(x, y, round(200.0 * n / t)) for x, y, n, t in zip(every["x"], every["y"], lcs, total, strict=True) if round(200.0 * n / t) >= score]
    assert sorted(got) == sorted(want)
