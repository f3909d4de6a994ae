"""Places and pages against brute force and small golden pages."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gazetta.functions import payloads as pl
from gazetta.operators import gates, geo
from gazetta.operators import pages as pg


def km(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 12742.0 * math.asin(min(1.0, math.sqrt(h)))


def test_nearest_equals_brute_force(spark):
    rnd = random.Random(1)
    spots = [(i, rnd.uniform(-80, 80), rnd.uniform(-180, 180)) for i in range(80)]
    # a crowded corner, two places at the same spot, and points across the date line
    spots += [(100 + i, -33 + rnd.random() / 1000, 151 + rnd.random() / 1000) for i in range(80)]
    spots += [(300, 10.0, 179.99), (301, 10.0, 179.99)]
    points = [(i, rnd.uniform(-85, 85), rnd.uniform(-180, 180)) for i in range(150)] + [(900, 10.0, -179.99), (901, -33.0, 151.0)]
    df = geo.nearest(
        spark.createDataFrame(points, "pid int, lat double, lng double"),
        spark.createDataFrame(spots, "sid int, lat double, lng double"),
        ["sid"], "sid",
    )
    got = {r["pid"]: (r["near_sid"], r["near_km"]) for r in df.collect()}
    for pid, la, lo in points:
        best = min((round(km(la, lo, b, c), 9), s) for s, b, c in spots)
        assert got[pid][0] == best[1] and abs(got[pid][1] - best[0]) < 1e-6


def test_drive_minutes(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (75.0,), (100.0,), (None,)], "k double")
    assert [r["m"] for r in df.select(geo.drive_minutes("k").alias("m")).collect()] == [0, 5, 60, 80, None]


def test_valid_point(spark):
    data = [("-33.86543217", "151.2"), ("0", "0"), ("50", "10"), ("x", "150"), (None, "150"), ("-9", "110")]
    df = spark.createDataFrame(data, "a string, b string")
    got = [r["p"] and tuple(r["p"]) for r in df.select(geo.valid_point("a", "b").alias("p")).collect()]
    assert got == [(-33.865432, 151.2), None, None, None, None, (-9.0, 110.0)]


RINGS = {
    "square": [(150.0, -34.0), (151.0, -34.0), (151.0, -33.0), (150.0, -33.0)],
    "notch": [(150.0, -34.0), (153.5, -34.0), (153.5, -31.0), (151.9, -32.8), (150.0, -31.0)],
    "far": [(120.0, -20.0), (121.0, -20.0), (120.5, -19.0)],
}


def inside(ring, x, y):
    hit = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            hit = not hit
    return hit


@pytest.mark.parametrize("salts, cell", [(1, 1.0), (5, 0.3)])
def test_points_in_polygons(spark, salts, cell):
    rnd = random.Random(7)
    pts = [(i, rnd.uniform(-35, -30), rnd.uniform(149, 154)) for i in range(300)]
    points = spark.createDataFrame(pts, "pid int, lat double, lng double")
    polys = spark.createDataFrame([(n, [{"x": x, "y": y} for x, y in r]) for n, r in RINGS.items()], "n string, ring array<struct<x:double,y:double>>")
    got = {(r["pid"], r["n"]) for r in geo.points_in_polygons(points, polys, "ring", cell=cell, salts=salts).collect()}
    assert got == {(i, n) for i, la, lo in pts for n, r in RINGS.items() if inside(r, lo, la)}


def test_severity_wording(spark):
    words = [
        "CHECK manually", "Highly frequent", "high and frequent", "extreme", "infrequent", "Moderate", "rare", "zone", "", "Unknown",
    ]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r["s"] for r in df.select(geo.severity_of("w").alias("s")).collect()]
    assert got == [
        "CHECK_MANUALLY", "Highly Frequently", "Highly Frequently", "Highly Frequently", "Frequently", "Occasionally",
        "Rarely", "Unknown", "Unknown", "Unknown",
    ]
    assert df.select(geo.severity_of("w", in_zone=False).alias("s")).collect()[7]["s"] == "Rarely"


def test_worst_severity(spark):
    points = spark.createDataFrame([("a", -33.5, 150.5), ("b", -10.0, 140.0)], "id string, lat double, lng double")
    ring = [{"x": x, "y": y} for x, y in RINGS["square"]]
    polys = spark.createDataFrame(
        [("rare", ring), ("likely inundation", ring), ("zone", ring)], "label string, ring array<struct<x:double,y:double>>"
    )
    got = {r["id"]: r["category"] for r in geo.worst_severity(points, polys, "id", "ring", ["label"]).collect()}
    assert got == {"a": "Frequently", "b": "Rarely"}


HTML = """<html><head><title> A &amp; B
 page</title><script>var x="</p><a href='/no'>";</script></head><body><!-- <a href="/hidden">h</a> -->
<a class=x href="/one">First  <b>link</b></a><p>open <a href='two/../three'>Second</a>
<a href="https://other.org/x">Other</a><a href="/one">again</a><a href="mailto:me@site.org?subject=x">mail</a>
<a href="tel:1300 123 456">free</a><a href="tel:0412 345 678">call</a><a href="">empty</a>
<p>Text &lt;b&gt; here</body></html>"""


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(1, "https://site.org/dir/page", HTML), (2, "https://b.org", None)], "page_id int, url string, html string")


def test_links(pages, rows):
    out = rows(pg.extract_links(pages), "pos")
    resolved = [r["resolved"] for r in out]
    assert "https://site.org/one" in resolved and resolved.count("https://site.org/one") == 1
    assert "https://site.org/dir/three" in resolved and "https://other.org/x" in resolved
    assert [r["text"] for r in out if r["href"] == "/one"] == ["First link"]
    assert all(r["href"] for r in out)


def test_page_text(pages):
    out = pg.page_text(pages).filter("page_id = 1").first()
    assert out["title"] == "A & B page"
    assert out["body_text"].startswith("A & B page First link open Second")
    assert "hidden" not in out["body_text"] and out["body_text"].endswith("Text <b> here")
    cut = pg.page_text(pages, limit=10).filter("page_id = 1").first()["body_text"]
    assert cut == out["body_text"][:10] + "\n[TRUNCATED]"


def test_contacts(pages):
    out = {r["page_id"]: (r["email"], r["phone"]) for r in pg.contacts(pages).collect()}
    assert out == {1: ("me@site.org", "0412 345 678"), 2: (None, None)}


def test_contact_preferences(spark):
    def page(body):
        df = spark.createDataFrame([(1, body)], "page_id int, html string")
        return tuple(pg.contacts(df, own_words=("helpdesk", "club")).select("email", "phone").first())

    assert page('<a href="mailto:helpdesk@x.org">h</a><a href="mailto:a%20b@x.org">m</a>') == ("a b@x.org", None)
    assert page('<a href="tel:1300 111 222">x</a><a href="tel:02 9999 8888">y</a>') == (None, "02 9999 8888")
    assert page('<a href="tel:02 9999 8888">y</a> mobile 0400 000 111') == (None, "0400 000 111")
    assert page('<a href="tel:13 11 11">x</a>') == (None, None)


def test_rank_links(spark, rows):
    html = '<a href="/permit-fees">a</a><a href="/permit">b</a><a href="https://o.org/permit">c</a><a href="/x">d</a><a href="/fees">e</a>'
    df = spark.createDataFrame([(1, "https://s.org/", html)], "page_id int, url string, html string")
    out = rows(pg.rank_links(df, ("permit", "fee"), 2), "link_rank")
    assert [(r["link"], r["score"]) for r in out] == [("https://s.org/permit-fees", 2), ("https://s.org/permit", 1)]
    any_host = rows(pg.rank_links(df, ("permit", "fee"), 3, own_host=False, by_score=False), "link_rank")
    assert [r["link"] for r in any_host] == ["https://s.org/permit-fees", "https://s.org/permit", "https://o.org/permit"]


def test_article_links(spark, rows):
    html = (
        '<a href="/2024/short">A title long enough</a><a href="/about">About this very site</a>'
        '<a href="/blog">Our long blog title</a><a href="/a-slug-that-is-long">Another fine title</a>'
        '<a href="/a-slug-that-is-long">Another fine title again</a><a href="/x">Tiny</a><a href="/shorty">Long title, short slug</a>'
    )
    df = spark.createDataFrame([(1, "https://s.org/blog", html)], "page_id int, url string, html string")
    out = rows(pg.article_links(df, 5), "article_rank")
    assert [(r["title"], r["link"]) for r in out] == [
        ("A title long enough", "https://s.org/2024/short"),
        ("Another fine title", "https://s.org/a-slug-that-is-long"),
    ]


def test_gates(spark):
    data = [
        ("Alpha Council", "NSW", "https://www.alpha.nsw.gov.au", None),
        ("For councils", "NSW", "https://a.nsw.gov.au", "junk_label"),
        ("Find your local council", "NSW", "https://a.nsw.gov.au", "junk_label"),
        ("Alpha", "NSW", "https://a.nsw.gov.au", "not_an_entity_name"),
        ("Capacity", "NSW", "https://a.nsw.gov.au", "not_an_entity_name"),
        ("Beta Shire", "TAS", "https://www.lgat.tas.gov.au/x", "rejected_host"),
        ("Beta Shire", "NSW", "https://beta.com.au", "host_suffix"),
        ("Hobart City", "TAS", "https://www.hobartcity.com.au", None),
        ("Hobart City", "NSW", "https://www.hobartcity.com.au", "host_suffix"),
        ("Alpha Council", "NSW", "https://a.nsw.gov.au/news", "excluded_word"),
    ]
    df = spark.createDataFrame(data, "n string, s string, w string, want string")
    for r in df.withColumn("got", gates.reject_reason("n", "s", "w")).collect():
        assert r["got"] == r["want"], r
    good, bad = gates.split_rejects(df, gates.reject_reason("n", "s", "w"))
    assert (good.count(), bad.count()) == (2, 8)
    assert '"n":"For councils"' in bad.filter("reject_reason = 'junk_label'").first()["row_json"]


def test_page_gates(spark):
    links = '<a href="x">' * 30
    cases = [
        (None, True), ("x" * 3000, True), ("x" * 3000 + links[:36], True), ("x" * 3000 + links, False),
        ("__NEXT" + "x" * 3000 + '<a href="x">' * 10, True), ("__NEXT" + "x" * 3000 + links, False),
    ]
    df = spark.createDataFrame(cases, "h string, want boolean")
    assert all(r["want"] == r["g"] for r in df.withColumn("g", gates.is_thin_page("h")).collect())
    blocked = spark.createDataFrame([("<p>Please Verify",), ("fine",), ("x" * 2100 + "please verify",), ("/.well-known/sgcaptcha/",)], "h string")
    assert [r["b"] for r in blocked.select(gates.is_blocked_page("h").alias("b")).collect()] == [True, False, True, True]


def test_combine_docs_cuts_exactly(spark):
    rnd = random.Random(3)
    docs = [("h", i, f"u{i}", "word " * rnd.randint(0, 40)) for i in range(60)] + [("g", 1, "u", "  a  b ")]
    df = spark.createDataFrame(docs, "host string, n int, u string, b string")
    got = {r["host"]: r["combined"] for r in pg.combine_docs(df, ["host"], "n", "u", "b", 50, 700, spread=7).collect()}
    chunks = [f"URL: {u}\nCONTENT:\n{' '.join(b.split())[:50]}" for h, _, u, b in docs if h == "h"]
    assert got["h"] == "\n\n-----\n\n".join(chunks)[:700]
    assert got["g"] == "URL: u\nCONTENT:\na b"


def test_slugs(spark):
    html = '<a href="https://x.org/celebrant/jane-doe/">J</a> /celebrant/ann-lee?x /celebrant/http:'
    df = spark.createDataFrame([(html,), (html,)], "html string")
    out = pg.slugs(df, [r"/celebrant/([^/\"'?\s#]+)"])
    assert [r["slug"] for r in out.collect()] == ["ann-lee", "jane-doe"]


# -- payloads ---------------------------------------------------------------


def test_salvage(one):
    assert one('Sure: {"a": {"b": 1}} bye', pl.salvage_json) == '{"a": {"b": 1}}'
    assert one('{"a": 1} and {"b": }', pl.salvage_json) is None
    assert one('{"a": 1} and {"b": 2}', pl.salvage_json) is None
    assert one('{"a": 1}, {"b": 2}', pl.salvage_json) is None
    assert one("none", pl.salvage_json) is None
    assert one(None, pl.salvage_json) is None
    assert one('x ```json\n{"a": 1}\n``` y', pl.fenced_json) == '{"a": 1}'
    assert one('{"a": 1}', pl.fenced_json) == '{"a": 1}'


def test_salvage_items(one):
    from pyspark.sql import types as T

    item = T.StructType([T.StructField("n", T.StringType())])
    names = lambda text: [r["n"] for r in (one(text, lambda c: pl.salvage_items(c, item)) or [])]
    assert names('[{"n": "a"}, {"n": "b"}]') == ["a", "b"]
    assert names('```json\n[{"n": "a"}]\n```') == ["a"]
    assert names('Found: [{"n": "a"}] thanks') == ["a"]
    assert names('{"sources": [{"n": "a"}]}') == ["a"]
    assert names('{"other": 1}') == []
    assert names("nothing [ here") == []


def test_place_payload(spark):
    payload = (
        '{"name":"places/P1","displayName":{"text":"Hall"},"formattedAddress":"1234 X St, Town NSW 2650, Australia",'
        '"location":{"latitude":-33.5,"longitude":150.5},"rating":4.5,"userRatingCount":12,"priceLevel":"PRICE_LEVEL_FREE",'
        '"regularOpeningHours":{"open":[1,2]},"types":["a","b"],"photos":[{"name":"p1"},{"name":"p2"}],'
        '"reviews":[{"text":{"text":""},"originalText":{"text":"orig"},"rating":5,"publishTime":"2024-01-02T03:04:05Z"},{"text":{"text":"two"}}]}'
    )
    df = spark.createDataFrame([(1, payload), (2, "{broken"), (3, None)], "id int, payload string")
    out = {r["id"]: r for r in pl.flatten_place(df, "payload").collect()}
    r = out[1]
    assert (r["place_id"], r["google_name"], r["postcode"], r["price_level"]) == ("P1", "Hall", "2650", 0)
    assert r["google_maps_url"].endswith("place_id:P1") and r["opening_hours"] == '{"open":[1,2]}'
    assert (r["review_text_1"], r["review_text_2"], r["review_text_3"]) == ("orig", "two", None)
    assert (r["photo_ref_2"], r["photo_ref_3"], r["total_photo_count"]) == ("p2", None, 2)
    assert r["google_types_json"] == '["a","b"]' and len(r) >= 55
    assert out[2]["place_id"] is None and out[3]["google_rating"] is None


def test_pollen_and_air(spark):
    day = '{"dailyInfo":[{"pollenTypeInfo":[%s]}]}'
    kinds = '{"code":"grass","indexInfo":{"value":%s}},{"code":"TREE","indexInfo":{"value":%s}}'
    data = [
        (1, day % (kinds % (0, 0)), '{"indexes":[{"code":"aus","aqi":1},{"code":"UAQI","aqi":2,"dominantPollutant":"PM25"}]}'),
        (2, day % (kinds % (9, 3)), '{"indexes":[{"code":"aus","aqi":1,"category":"ok"}]}'),
        (3, day % (kinds % (1, 3)), '{"indexes":[]}'),
        (4, "{}", None),
    ]
    df = spark.createDataFrame(data, "id int, p string, a string")
    out = {r["id"]: r for r in pl.add_air(pl.add_pollen(df, "p"), "a").collect()}
    assert [out[i]["dominant_pollen_type"] for i in (1, 2, 3, 4)] == ["GRASS", "GRASS", "TREE", None]
    assert (out[2]["pollen_grass_index"], out[2]["pollen_weed_index"]) == (5, None)
    assert [out[i]["air_quality_index"] for i in (1, 2, 3, 4)] == [2, 1, None, None]
    assert out[1]["dominant_pollutant"] == "pm25"


def test_sentiment(spark):
    good = 'x {"sentiment_score": 1.7, "top_themes": ["a","b","c","d"], "one_line_summary": " s "} y'
    data = [(1, good, 2), (2, good, 1), (3, '{"sentiment_score": "x"}', 5), (4, "no", 5)]
    df = spark.createDataFrame(data, "id int, answer string, n int")
    out = {r["id"]: r for r in pl.add_sentiment(df, "answer", "n", themes=3).collect()}
    assert (out[1]["sentiment_score"], out[1]["sentiment_themes"], out[1]["red_flags"], out[1]["one_line_summary"]) == (
        1.0, ["a", "b", "c"], [], "s",
    )
    assert all(out[i]["sentiment_score"] is None and out[i]["sentiment_themes"] is None for i in (2, 3, 4))


def test_lists(one):
    assert one(" a; b,\nc ,", pl.list_of) == ["a", "b", "c"]
    assert one(None, pl.list_of) == []
    assert one("[1", pl.valid_json_text) is None and one(' {"a":1} ', pl.valid_json_text) == '{"a":1}'
    assert one("x", lambda c: F.array_join(pl.clean_list(F.array(c, F.lit(" "), F.lit(" y "))), "|")) == "x|y"


def test_entities_cost_in_proportion_to_their_number(spark):
    import time

    def seconds(n):
        html = "<p>" + " ".join(f"a&amp;b{i} &#{65 + i % 26}; &nosuch; &eacute;" for i in range(n // 4)) + "</p>"
        df = spark.createDataFrame([(i, html) for i in range(4)], "page_id long, html string").repartition(4).cache()
        df.count()
        best = []
        for _ in range(3):
            start = time.perf_counter()
            pg.page_text(df).write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - start)
        row = pg.page_text(df).first()["body_text"]
        assert row == " ".join(f"a&b{i} {chr(65 + i % 26)} &nosuch; é" for i in range(n // 4))
        return min(best)

    seconds(400)
    few, many = seconds(400), seconds(4000)
    assert many < 10 * few + 0.5


@pytest.mark.parametrize(
    "raw, want",
    [("&#65;&#x42;&#X43;", "ABC"), ("&#12345678;", "&#12345678;"), ("&#x1234567;", "&#x1234567;"), ("&amp", "&amp"), ("&;&&", "&;&&"), ("a&lt;b&amp;lt;", "a<b&lt;"), ("", ""), (None, None)],
)
def test_entities_at_any_place(one, raw, want):
    assert one(raw, pg.unescape) == want


def combined(docs, host, sep="\n\n-----\n\n"):
    own = sorted((n, u or "", " ".join((b or "").split())) for h, n, u, b in docs if h == host)
    return sep.join(f"URL: {u}\nCONTENT:\n{b}" for _, u, b in own)


@pytest.mark.parametrize("size", [50, 700, 1 << 20])
def test_parts_join_to_the_whole_text(spark, size):
    rnd = random.Random(3)
    docs = [("h", i, f"u{i}", "wörd 😀 " * rnd.randint(0, 40)) for i in range(60)]
    docs += [("g", 1, "u", "  a  b "), (None, 1, None, None), (None, 2, "x", ""), ("h", 7, "again", "tie"), ("g", 1, "u", "  a  b ")]
    df = spark.createDataFrame(docs, "host string, n int, u string, b string").repartition(5)
    got = {}
    for r in sorted(pg.combine_parts(df, ["host"], "n", "u", "b", size).collect(), key=lambda r: r["part_no"]):
        got.setdefault(r["host"], []).append(r["text"])
    assert {h: "".join(p) for h, p in got.items()} == {h: combined(docs, h) for h in ("h", "g", None)}
    for parts in got.values():
        assert all(len(p) == size for p in parts[:-1]) and 0 < len(parts[-1]) <= size


def test_parts_of_a_host_with_most_pages_are_spread_and_bounded(spark, monkeypatch):
    from gazetta.operators import dedupe as dd

    docs = spark.range(20_000).selectExpr(
        "if(id % 10 = 0, concat('h', id % 7), 'hot') AS host", "id AS n", "concat('u', id) AS u", "repeat(concat('w', id % 13, ' '), int(id % 50)) AS b"
    )
    blocks = dd.with_blocks(docs, ["host"], ["n", "u"], None, least=1000).where("host = 'hot'").groupBy("_block").count()
    sizes = sorted(r["count"] for r in blocks.collect())
    assert len(sizes) > 8 and sizes[-1] < 2500
    monkeypatch.setattr(dd.with_blocks, "__defaults__", (1000,))
    parts = pg.combine_parts(docs, ["host"], "n", "u", "b", 10_000)
    got = parts.groupBy("host").agg({"part_no": "max", "text": "count"}).collect()
    assert all(r["max(part_no)"] + 1 == r["count(text)"] for r in got)
    assert max(len(r["text"]) for r in parts.collect()) == 10_000
    hot = "".join(r["text"] for r in sorted(parts.where("host = 'hot'").collect(), key=lambda r: r["part_no"]))
    assert hot == combined([tuple(r) for r in docs.where("host = 'hot'").collect()], "hot")


def test_no_documents_give_no_parts(spark):
    assert pg.combine_parts(spark.createDataFrame([], "host string, n int, u string, b string"), ["host"], "n", "u", "b").count() == 0
