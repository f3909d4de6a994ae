"""URLs, names, codes, numbers and contacts."""

from urllib.parse import urljoin

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gazetta.functions import text as tx
from gazetta.functions import urls as ur

URLS = {
    "Example.com/Path/": "https://example.com/Path",
    "http://www.Example.com": "http://example.com",
    "HTTPS://www.www.a.com/x?q=1#f": "https://www.a.com/x",
    "https://a.com:8080/x//": "https://a.com:8080/x",
    "https://a.com/p;v=1/q;s=2": "https://a.com/p;v=1/q",
    "  ": "",
    "": "",
}


def test_norm_url(spark):
    df = spark.createDataFrame([(k, v) for k, v in URLS.items()], "u string, want string")
    out = df.select("u", "want", ur.norm_url("u").alias("k"))
    again = out.select("want", "k", ur.norm_url("k").alias("kk"))
    for r in again.collect():
        assert r["k"] == r["want"] and (r["kk"] == r["k"] or "www." in r["k"])


def test_hosts(one):
    assert one("www.A.com:80/x", ur.root_domain) == "a.com:80"
    assert one("", ur.root_domain) is None
    assert one("https://WWW.a.com/x", ur.host_key) == "a.com"
    assert one("ftp://a.com/x", ur.origin_home) == "https://a.com/"
    assert one("http://A.com/x", ur.origin_home) == "http://A.com/"
    assert one("a.com", ur.origin_home) == ""
    assert one("https://x.nsw.gov.au/a", lambda c: ur.host_under(c, "gov.au")) is True
    assert one("https://gov.au", lambda c: ur.host_under(c, "gov.au")) is True
    assert one("https://notgov.au", lambda c: ur.host_under(c, "gov.au")) is False
    assert one("https://m.facebook.com/x", ur.is_social) is True
    assert one("mailto:x", ur.is_social) is True
    assert one("https://a.org", ur.host_class) == "other"
    assert one(None, ur.is_http) is False


BASES = ["https://h.com/a/b/c.html?x=1#f", "http://h.com", "https://h.com/dir/"]
LINKS = [
    "x", "/x", "//o.com/y", "../z", "../../../z", "./k", "?q=2", "#top", "", "http://o.org/p", "mailto:a@b.c",
    "d/e/../f?r#s", "..", ".", "/a/./b/../c", "t?u=/../v",
]


def test_resolve_link_equals_urljoin(spark):
    pairs = [(b, h) for b in BASES for h in LINKS]
    df = spark.createDataFrame(pairs, "b string, h string")
    for r in df.select("b", "h", ur.resolve_link("b", "h").alias("o")).collect():
        assert r["o"] == urljoin(r["b"], r["h"]), (r["b"], r["h"])


def test_profiles(one):
    insta = lambda c: ur.social_profile(c, "instagram")
    face = lambda c: ur.social_profile(c, "facebook")
    pin = lambda c: ur.social_profile(c, "pinterest")
    assert one("@@some.one", insta) == "https://www.instagram.com/some.one/"
    assert one("https://instagram.com/x", insta) == "https://instagram.com/x"
    assert one("not found", insta) == "NOT_FOUND"
    assert one("some one", insta) == "NOT_FOUND"
    assert one("www.facebook.com/x", face) == "https://www.facebook.com/x"
    assert one("some-page/", face) == "https://www.facebook.com/some-page/"
    assert one("boards/mine", pin) == "https://www.pinterest.com/boards/mine/"
    assert one("some-name", pin) == "NOT_FOUND"
    assert one("a@b.com", ur.clean_email) == "a@b.com"
    assert one("a@b", ur.clean_email) == "NOT_FOUND"
    assert one("www.a.com", ur.clean_link) == "https://www.a.com"
    assert one("a.com", ur.clean_link) == "NOT_FOUND"


def test_names(one):
    assert one("  Jane \t DOE ", tx.squash_name) == "jane doe"
    assert one("O'Neil-Smith, J.", tx.plain_name) == "o neil smith j"
    assert one("Smith, Jane", tx.token_key) == "jane smith"
    assert one(None, tx.token_key) == ""
    assert one("Town of X (Regional) ", tx.drop_parenthetical) == "Town of X"
    assert one("Jane Doe – SITE member", lambda c: tx.drop_site_suffix(c, "SITE")) == "Jane Doe"
    assert one("--a b!c--", tx.slug_id) == "a-b-c"
    assert one("???", lambda c: tx.slug_id(c, "P-")) == "P-x"
    assert one("places/AbC", tx.strip_prefix) == "AbC"
    assert one("AbC", tx.strip_prefix) == "AbC"
    assert one("INF-WED-0012345", tx.padded_suffix) == "345"
    assert one("INF-7", tx.padded_suffix) == "007"
    assert one("INF", tx.padded_suffix) == "000"


def test_codes(one):
    assert one(" nsw, vic ;; qld", tx.code_list_text) == "NSW|VIC|QLD"
    assert one("all", tx.code_list_text) == "NSW|VIC|QLD|WA|SA|TAS|NT|ACT"
    assert one("ALL, NSW", tx.code_list_text) == "ALL|NSW"
    assert one(" ,; ", tx.code_list_text) is None
    assert one("Sydney NSW 2000", tx.region_code) == "NSW"
    assert one("the SAME place in south australia", tx.region_code) == "SA"
    assert one("nowhere", tx.region_code) is None
    assert one("sydney nsw", lambda c: tx.region_code(c, names=(), any_case=True)) == "NSW"
    addr = "1234 High St, Town NSW 2650, Australia 9999"
    assert one(addr, tx.postcode) == "1234"
    assert one(addr, lambda c: tx.postcode(c, "last")) == "2650"
    assert one("no code", lambda c: tx.postcode(c, "last")) is None


def test_numbers(one):
    assert one("from $ 1,234 each", tx.price) == 1234
    assert one("$100 - $250", tx.fee_amount) == 175.0
    assert one("10-20-60", tx.fee_amount) == 15.0
    assert one("100 or 200 or 300", tx.fee_amount) == 200.0
    assert one("a100b200c300", tx.fee_amount) == 200.0
    assert one("free", tx.fee_amount) is None
    assert one("37 Reviews here", tx.counter) == 37
    assert one("no reviews", tx.counter) is None


def test_a_street_number_is_no_postcode(one):
    assert one("9500 Main St, Town NSW 10500, Australia", lambda c: tx.postcode(c, "last")) is None
    assert one("9500 Main St, Town NSW 2650, Australia", lambda c: tx.postcode(c, "last")) == "2650"


def test_contacts(one):
    cell = "Jane Doe\nm: 0412  345 678\nCivil Ceremonies\n1 High St\n1 High St\nTown NSW 2650\njane@x.org"
    assert one(cell, tx.labelled_phone) == "0412 345 678"
    assert one(cell, tx.emails) == ["jane@x.org"]
    assert one(cell, tx.address_line) == "Jane Doe 1 High St Town NSW 2650"
    assert one("m: 0412 345 678 High St\njane@x.org 5 Low Rd\nCeremonies", tx.address_line) == "High St 5 Low Rd"
    assert one("m: 0412 345 678\njane@x.org", tx.address_line) is None
    assert one("call 0412.345.678 or 0412 345 678", tx.mobiles) == ["0412.345.678", "0412 345 678"]
    assert one("nothing", tx.emails) == []


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(words=st.lists(st.text("abcXYZ'-. ", min_size=0, max_size=12), min_size=1, max_size=8))
def test_token_key_ignores_word_order(spark, words):
    a, b = " ".join(words), " ".join(reversed(words))
    row = spark.range(1).select(tx.token_key(F.lit(a)).alias("a"), tx.token_key(F.lit(b)).alias("b")).first()
    assert row["a"] == row["b"]


@pytest.mark.parametrize("value", ["https://a.com", "http://b.org/x"])
def test_norm_url_is_idempotent(one, value):
    assert one(value, lambda c: ur.norm_url(ur.norm_url(c))) == one(value, ur.norm_url)
