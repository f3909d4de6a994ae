"""The composed directory jobs, end to end on small invented tables."""

import datetime as dt
import json

from pyspark.sql import functions as F

from gazetta.functions import values as va
from gazetta.plans import celebrants, councils, destinations, influencers, venues


def strings(spark, columns, data, number="row_no"):
    """Text columns with a leading row number."""
    schema = f"{number} long, " + ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame([(i + 1, *row) for i, row in enumerate(data)], schema)


def by(df, key):
    return {r[key]: r for r in df.collect()}


# -- celebrants -------------------------------------------------------------

REG = ["celebrant_id", "state", "full_name", "email", "data_quality_score", "merge_fuzzy_score", "is_standalone_award_entry", "data_source", "abia_winner"]
V = va.VERIFY_REQUIRED


def register(spark):
    return strings(
        spark,
        REG,
        [
            ("CEL-NSW-000001", "NSW", "Jane Smith", V, V, V, V, "AG", V),
            ("CEL-NSW-000002", "NSW", "John Brown", "j@b.org", "40", V, V, "AG", V),
            ("CEL-VIC-000001", "VIC", "Jane Smyth", V, V, V, V, "AG", V),
        ],
    )


def test_merge_awards(spark):
    awards = strings(
        spark,
        ["full_name", "email", "abia_winner"],
        [
            ("SMITH, Jane", "jane@s.org", "2025"),
            ("Jane Smith", "other@s.org", "2024"),
            ("Zed Quark", "nan", "2025"),
            ("Jon Brown", "", "yes"),
            (V, "x", "y"),
        ],
    )
    out = by(celebrants.merge_awards(register(spark), awards), "celebrant_id")
    assert len(out) == 5
    jane = out["CEL-NSW-000001"]
    assert (jane["email"], jane["abia_winner"], jane["merge_fuzzy_score"], jane["data_quality_score"]) == (
        "jane@s.org", "2025", "100", "85",
    )
    john = out["CEL-NSW-000002"]
    assert (john["full_name"], john["email"], john["data_quality_score"]) == ("Jon Brown", "j@b.org", "40")
    assert out["CEL-VIC-000001"]["full_name"] == "Jane Smyth"
    second = out["CEL-AWARD-00001"]
    assert (second["full_name"], second["email"], second["merge_fuzzy_score"]) == ("Jane Smith", "other@s.org", "100")
    alone = out["CEL-AWARD-00002"]
    assert (alone["data_source"], alone["is_standalone_award_entry"], alone["email"]) == ("AWARD_STANDALONE", "true", V)
    assert 0 < int(alone["merge_fuzzy_score"]) < 85


def test_cross_reference(spark):
    master = register(spark)
    ew = strings(
        spark,
        ["brand_name", "state", "easy_weddings_profile_url", "easy_weddings_rating", "easy_weddings_review_count", "easy_weddings_price_from", "is_destination_specialist"],
        [
            ("Jane Smith", "NSW", "https://ew/a/", "4.9", "12.0", "$900", "False"),
            ("Smith Jane", "NSW", "https://ew/b/", "", "13", "$700", "True"),
            ("Brand New Person", "QLD", "https://ew/brand--new/", "5", "1", "", "False"),
            ("Another New Person", "QLD", "https://ew/Brand-New", "5", "1", "", "False"),
        ],
    )
    afcc = strings(spark, ["full_name", "email", "afcc_profile_url"], [("Jane Smith", "", "https://afcc/x"), ("John Brown", "", "none")])
    tws = strings(spark, ["name", "profile_url"], [("john brown", "https://tws/j")])
    out = by(celebrants.cross_reference(master, {"EW": ew, "AFCC": afcc, "TWS": tws}), "celebrant_id")
    jane = out["CEL-NSW-000001"]
    assert (jane["easy_weddings_profile_url"], jane["easy_weddings_rating"], jane["easy_weddings_review_count"]) == ("https://ew/b/", "4.9", "13")
    assert (jane["easy_weddings_price_from"], jane["is_destination_specialist"], jane["afcc_member"]) == ("$900", "true", "true")
    assert (jane["directory_listing_count"], jane["active_signal_sources"], jane["is_active_market"]) == ("2", "AFCC|EW", "true")
    john = out["CEL-NSW-000002"]
    assert (john["wedding_society_profile_url"], john["afcc_member"], john["directory_listing_count"]) == ("https://tws/j", "false", "1")
    smyth = out["CEL-VIC-000001"]
    assert (smyth["is_active_market"], smyth["directory_listing_count"]) == ("false", "0")
    # one more row per address
    fresh = [out[i] for i in set(out) - set(by(master, "celebrant_id"))]
    assert len(fresh) == 2 and all(r["celebrant_id"].startswith("CEL-EWDIR-brand-new-") for r in fresh)
    new = next(r for r in fresh if r["easy_weddings_profile_url"] == "https://ew/brand--new/")
    assert (new["full_name"], new["state"], new["email"], new["active_signal_sources"]) == ("Brand New Person", "QLD", V, "EW")
    prof = celebrants.active_profile(spark.createDataFrame(list(out.values()), celebrants.cross_reference(master, {"EW": ew}).schema)).first()
    assert (prof["rows"], prof["active"], prof["in_two_or_more"]) == (5, 4, 1)


def test_load_rows(spark):
    top = strings(spark, ["celebrant_id", "email"], [("CEL-NSW-000001", "new@x.org"), ("CEL-NSW-000002", "nan")])
    out = by(celebrants.load_rows(register(spark), top, "row_no"), "celebrant_id")
    assert out["CEL-NSW-000001"]["email"] == "new@x.org" and out["CEL-NSW-000002"]["email"] == "j@b.org"
    assert len(celebrants.COLUMNS) == 53 and out["CEL-VIC-000001"]["vibe"] == V
    assert tuple(celebrants.load_rows(register(spark), None).columns) == celebrants.COLUMNS


def test_queues(spark):
    reg = strings(
        spark,
        ["full_name", "website", "abia_winner", "data_quality_score"],
        [("A B", "http://a", V, "90"), ("C D", V, "2025", "x"), ("E F", "https://e", "no", "10"), ("G H", "http://g", "yes", "5")],
    )
    awards = strings(spark, ["full_name"], [("g  h",), ("E F",)])
    assert [r["full_name"] for r in celebrants.website_queue(reg, awards).collect()] == ["E F", "G H", "A B"]
    assert [r["full_name"] for r in celebrants.top_for_places(reg, 3).collect()] == ["G H", "C D", "A B"]


def test_places_patch(spark):
    active = strings(
        spark,
        ["celebrant_id", "full_name", "easy_weddings_rating", "directory_listing_count", "abia_winner", "is_active_market", "content_tier", "easy_weddings_review_count", "google_rating"],
        [("c1", "Jane Smith", "5", "3", "yes", "true", "premium", "9", V), ("c2", "Bo Li", V, "1", "no", "true", "", "99", "3.0")],
    )
    place = json.dumps({"name": "places/P1", "displayName": {"text": "Jane Smith Celebrant"}, "rating": 5.0, "userRatingCount": 7})
    cands = spark.createDataFrame(
        [("c1", 2, "Jane Smith", place), ("c1", 1, "Jane Smith Celebrant", place), ("c2", 1, "Totally Other", place)],
        "celebrant_id string, query_no int, candidate_name string, payload string",
    )
    out = by(celebrants.patch_places(active, cands), "celebrant_id")
    assert (out["c1"]["google_place_id"], out["c1"]["google_rating"], out["c1"]["celebrant_quality_score"]) == ("P1", "5.0", 100)
    assert out["c1"]["places_match_confidence"] == "LOW"  # the first candidate at 60 is taken, its score is 67
    assert out["c2"]["google_place_id"] is None and out["c2"]["google_rating"] == "3.0" and out["c2"]["celebrant_quality_score"] is None
    assert [r["celebrant_id"] for r in celebrants.active_order(active).collect()] == ["c1", "c2"]


def test_register_rows(spark):
    data = [
        (1, 1, "State: NSW (12)", None, None),
        (1, 2, None, "m: 0412 345 678\nHigh St 1\na@b.org", "Ann"),
        (1, 3, None, "2 Low St VIC 3000", "Ben"),
        (2, 4, None, "no header on this page", "Cat"),
        (2, 5, "Queensland", None, None),
        (2, 6, None, "3 Mid St", "Dan"),
        (2, 7, "nsw", None, None),
        (2, 8, None, "p: 02 9999 9999", "Eve"),
    ]
    df = spark.createDataFrame(data, "page int, pos long, header string, cell string, full_name string")
    out = by(celebrants.register_rows(df), "full_name")
    assert {n: r["celebrant_id"] for n, r in out.items()} == {
        "Ann": "CEL-NSW-000001", "Ben": "CEL-VIC-000001", "Cat": "CEL-UNK-000001", "Dan": "CEL-UNK-000002", "Eve": "CEL-NSW-000002",
    }
    assert (out["Ann"]["phone"], out["Ann"]["email"], out["Ann"]["address_text"]) == ("0412 345 678", "a@b.org", "High St 1")
    assert (out["Ben"]["postcode"], out["Ben"]["phone"]) == ("3000", V)
    status = spark.createDataFrame([("Now INACTIVE",), ("unavailable",), ("Active",), ("odd",), ("",)], "s string")
    got = [r["o"] for r in status.select(celebrants.register_status("s").alias("o")).collect()]
    assert got == ["Inactive", "Unavailable", "Active", "odd", V]


# -- councils ---------------------------------------------------------------


def council_pages(spark):
    nsw = (
        '<a href="https://www.beta.nsw.gov.au/">Beta Shire Council (Rural)</a><a href="https://www.alpha.nsw.gov.au">Alpha Council</a>'
        '<a href="https://www.alpha.nsw.gov.au/">alpha council</a><a href="/council-jobs">Council jobs</a>'
        '<a href="https://facebook.com/c">Gamma Council</a><a href="https://delta.com">Delta City</a><a href="https://www.e.nsw.gov.au/news">E Council</a>'
    )
    tas = '<a href="https://www.hobartcity.com.au">Hobart City</a>'
    return spark.createDataFrame(
        [(1, "https://list.org/nsw", nsw, "NSW"), (2, "https://list.org/tas", tas, "TAS")],
        "page_id int, url string, html string, state_code string",
    )


def test_build_councils(spark):
    good, bad = councils.build_councils(council_pages(spark), ids="sequence")
    out = by(good, "council_name")
    assert {n: r["council_id"] for n, r in out.items()} == {
        "Alpha Council": "CNCL-NSW-001", "Beta Shire Council": "CNCL-NSW-002", "Hobart City": "CNCL-TAS-001",
    }
    assert [r["reject_reason"] for r in bad.collect()] == ["host_suffix"]
    stable, _ = councils.build_councils(council_pages(spark))
    assert stable.select("council_id").distinct().count() == 3
    cov = by(councils.council_coverage(good), "state_code")
    assert (cov["NSW"]["actual"], cov["NSW"]["missing"], cov["WA"]["actual"]) == (2, 126, 0)


def test_alignment(spark):
    cncl = spark.createDataFrame(
        [("c1", "Byron Shire Council", "NSW"), ("c2", "City of Alpha", None), ("c3", "Lonely Council", "NSW")],
        "council_id string, council_name string, state_code string",
    )
    dest = spark.createDataFrame(
        [("d2", "x", "NSW", "Byron Shire"), ("d1", "x", "NSW", "the byron shire council area"), ("d3", "x", "VIC", "Byron Shire"), ("d4", "x", None, "alpha"), ("d5", "x", "NSW", "")],
        "destination_id string, destination_name string, state_code string, lga_name string",
    )
    out = {r["council_id"]: r["aligned_destination_ids"] for r in councils.align(cncl, dest).collect()}
    assert out == {"c1": ["d1", "d2"], "c2": ["d4"], "c3": []}
    named = dest.drop("lga_name").withColumn("destination_name", F.lit("Greater Byron Shire"))
    out = {r["council_id"]: r["aligned_destination_ids"] for r in councils.align(cncl, named).collect()}
    assert out == {"c1": ["d1", "d2", "d5"], "c2": [], "c3": []}


def test_permits(spark):
    cncl = spark.createDataFrame(
        [("c2", "Two", "NSW", "https://two.gov.au", ["d1", "d2"], True), ("c1", "One", "NSW", "https://one.gov.au", ["d1"], True), ("c3", "Off", "NSW", "https://o.gov.au", ["d3"], False), ("c4", "NoSite", "NSW", "", ["d3"], True)],
        "council_id string, council_name string, state_code string, website string, aligned_destination_ids array<string>, is_active boolean",
    )
    dest = spark.createDataFrame(
        [("d1", "D1", "NSW", None), ("d2", "D2", "NSW", None), ("d3", "D3", "VIC", "https://www.h.org/p?x"), ("d4", "D4", "VIC", "http://h.org/q"), ("d5", "D5", "VIC", "n/a")],
        "destination_id string, destination_name string, state_code string, council_permit_url string",
    )
    members, groups = councils.permit_groups(dest, cncl)
    assert {r["destination_id"]: r["group_key"] for r in members.collect()} == {
        "d1": "council:c1", "d2": "council:c2", "d3": "permit_domain:h.org", "d4": "permit_domain:h.org",
    }
    grp = by(groups, "group_key")
    assert grp["permit_domain:h.org"]["website"] == "https://www.h.org/" and grp["permit_domain:h.org"]["council_name"] == "D3"
    assert [r["state_code"] for r in councils.pick_mixed(groups, 2).collect()] == ["NSW", "VIC"]
    answers = spark.createDataFrame(
        [
            ("council:c1", '{"permit_page_url":"https://one.gov.au/p","permit_required":"Yes","permit_fee_aud":"$100 - $200","permit_lead_time_days":"14 days","insurance_required":true,"approved_locations":"beach; park"}'),
            ("permit_domain:h.org", 'Sorry: {"council_name":"unknown","permit_page_url":"n/a","permit_fee_aud":null}'),
        ],
        "group_key string, answer string",
    )
    permits = councils.permit_rows(members, groups, answers, salts=3)
    out = by(permits, "destination_id")
    assert set(out) == {"d1", "d3", "d4"}
    assert (out["d1"]["permit_required"], out["d1"]["permit_lead_time_days"], out["d1"]["approved_locations"]) == (True, 14, ["beach", "park"])
    assert (out["d3"]["council_name"], out["d3"]["permit_page_url"], out["d3"]["data_confidence"]) == ("D3", None, "low")
    patched = by(councils.back_patch(dest, permits), "destination_id")
    assert patched["d1"]["council_permit_url"] == "https://one.gov.au/p" and patched["d4"]["council_permit_url"] == "http://h.org/q"
    prof = councils.permit_profile(permits).first()
    assert (prof["rows"], prof["with_permit_page"], prof["insurance_required"], prof["avg_fee"], prof["avg_lead_days"]) == (3, 1, 1, 150.0, 14.0)
    assert councils.permits_to_check(permits).count() == 3


# -- influencers ------------------------------------------------------------


def test_sources_and_discovery(spark):
    master = spark.createDataFrame(
        [(1, "One", "http://www.One.com/", "all", "@one", "HIGH", "", "sum"), (2, "Dup", "http://one.com", "", "", "x", "n", ""), (3, "", "http://two.com", "", "", "", "", ""), (4, "Two", "two.com", "nsw; vic", "two", "low", "note", "sum")],
        "n long, `NAME` string, URL string, STATES string, INSTAGRAM string, `TRUST LEVEL` string, NOTES string, SUMMARY string",
    )
    src = influencers.source_rows(master, None, "n")
    out = by(src, "name")
    assert set(out) == {"One", "Two"}
    assert (out["One"]["url"], out["One"]["states"], out["One"]["instagram_handle"], out["One"]["trust_level"], out["One"]["notes"]) == (
        "http://one.com", "NSW|VIC|QLD|WA|SA|TAS|NT|ACT", "one", "high", "sum",
    )
    assert (out["Two"]["states"], out["Two"]["country"], out["Two"]["is_active"]) == ("NSW|VIC", "Australia", True)
    table = spark.createDataFrame([("INF-WED-004", "https://two.com", "old", "keep")], "source_id string, url string, name string, notes string")
    up = by(influencers.upsert_sources(table, src), "url")
    assert (up["https://two.com"]["source_id"], up["https://two.com"]["name"]) == ("INF-WED-004", "Two")
    assert up["http://one.com"]["source_id"] == "INF-WED-005"

    answers = spark.createDataFrame(
        [
            (2, "q2", '[{"name":"C","url":"c.com","source_type":"blog"},{"name":"A again","url":"https://www.a.com/","source_type":"blog"}]'),
            (1, "q1", 'Found [{"name":"A","url":"a.com","source_type":"blog","states":"nsw","trust_level":"odd"},{"name":"K","url":"known.com","source_type":"blog"},{"name":"X","url":"x.com","source_type":"bad"},{"name":"","url":"y.com","source_type":"blog"}]'),
            (3, "q3", "nothing"),
        ],
        "answer_no long, query string, answer string",
    )
    known = spark.createDataFrame([("https://known.com",)], "url_key string")
    new = by(influencers.discover(answers, known, ["blog"], last_number=7), "name")
    assert {n: r["source_id"] for n, r in new.items()} == {"A": "INF-DISC-008", "C": "INF-DISC-009"}
    assert (new["A"]["trust_level"], new["A"]["states"], new["A"]["discovery_query"]) == ("medium", "NSW", "q1")
    counts = influencers.discovery_counts(influencers.discover(answers, known, ["blog"]))
    assert {r["state"]: r["n"] for r in counts["state"].collect()} == {"NSW": 1}


def test_enrichment_content_and_signals(spark):
    src = spark.createDataFrame(
        [("INF-1", "note", True), ("INF-2", None, True)], "source_id string, notes string, is_active boolean"
    )
    answers = spark.createDataFrame(
        [("INF-1", '{"specialism_primary":"Planning","relevance_score":"14","insurance_hook":"false","insurance_hook_reason":"rain","audience_type":"Both","founder_gender":"woman"}'), ("INF-2", "no json")],
        "source_id string, answer string",
    )
    out = by(influencers.enrich(src, answers), "source_id")
    one = out["INF-1"]
    assert (one["specialism_primary"], one["relevance_score"], one["insurance_hook"], one["audience_type"], one["founder_gender"]) == (
        "planning", 10, False, "both", "F",
    )
    assert one["notes"] == "note\nInsurance hook (enrichment): rain" and out["INF-2"]["notes"] is None
    blogs = spark.createDataFrame(
        [("INF-1", "https://b.org/blog", '<a href="/2024/rain">What if it rains today</a><a href="/2024/old">Known old article</a>'), ("INF-2", "https://c.org/blog", '<a href="https://c.org/2024/dress">Choosing a fine dress</a>')],
        "source_id string, url string, html string",
    )
    known = spark.createDataFrame([("CONT-INF-1-004", "INF-1", "https://b.org/2024/old")], "content_id string, source_id string, url string")
    rows = by(influencers.content_rows(blogs, known), "content_id")
    assert set(rows) == {"CONT-INF-1-005", "CONT-INF-2-001"} and rows["CONT-INF-1-005"]["insurance_relevant"] is True
    sig = by(
        influencers.signals(influencers.enrich(src, answers), influencers.content_rows(blogs, known), {"planning": "guide"}, "general"),
        "source_id",
    )
    assert (sig["INF-1"]["outreach_priority"], sig["INF-1"]["collab_angle"], sig["INF-1"]["insurance_hook"]) == ("p1_this_month", "guide", True)
    assert (sig["INF-2"]["outreach_priority"], sig["INF-2"]["collab_angle"], sig["INF-2"]["insurance_hook"]) == ("p3_backlog", "general", False)


# -- venues -----------------------------------------------------------------


def place(name, **extra):
    return json.dumps({"name": "places/P1", "displayName": {"text": name}, "rating": 4.5, "userRatingCount": 12, "location": {"latitude": -33.0, "longitude": 151.0}, **extra})


def test_enrich_and_publish(spark):
    sheet = spark.createDataFrame([(1, "Old Mill", "NSW"), (2, "Old Mill", "NSW"), (3, "Gone", "VIC")], "row_index int, NAME string, STATE string")
    payloads = spark.createDataFrame(
        [(1, place("The Old Mill", businessStatus="OPERATIONAL")), (2, place("Quite Different", businessStatus="OPERATIONAL"))],
        "row_index int, payload string",
    )
    out = venues.enrich_places(sheet, payloads)
    got = by(out, "row_index")
    assert (got[1]["places_match_confidence"], got[1]["lat"], got[1]["google_rating"]) == ("HIGH", -33.0, 4.5)
    assert (got[2]["places_match_confidence"], got[2]["lat"], got[2]["place_id"], got[2]["google_rating"]) == ("LOW", None, "P1", None)
    assert got[3]["places_match_confidence"] == "NO_MATCH"
    twice = out.unionByName(out.withColumn("row_index", F.col("row_index") + 10))
    pub = venues.publish_venues(twice, "row_index").collect()
    assert len(pub) == 1 and (pub[0]["name"], pub[0]["place_id"], pub[0]["google_review_count"]) == ("Old Mill", "P1", 12)


def test_monthly_snapshot(spark):
    ven = spark.createDataFrame(
        [(1, "places/P1", "-33.1", "151.0"), (2, " ", "-33", "151"), (3, "P3", "x", "151"), (4, "P4", "-33", "151")],
        "id int, place_id string, lat string, lng string",
    )
    reviews = [{"text": {"text": "good"}, "publishTime": "2024-01-02T03:04:05Z"}, {"text": {"text": "bad"}}]
    pay = spark.createDataFrame(
        [("1", place("A", reviews=reviews), "{}", '{"indexes":[{"code":"x","aqi":5}]}', '{"sentiment_score":0.5,"top_themes":["t"]}'), ("4", '{"error":{"message":"gone"}}', None, None, None)],
        "id string, place_json string, pollen_json string, air_json string, answer string",
    )
    hist = spark.createDataFrame(
        [("1", "2024-01-01", 4.0, 10), ("1", "2023-11-01", 3.0, 5), ("4", "2024-02-01", 1.0, 1)],
        "venue_id string, captured_date string, google_rating double, review_count int",
    ).withColumn("captured_date", F.to_date("captured_date"))
    now = F.lit("2024-01-31 14:00:00").cast("timestamp")
    out = venues.monthly_snapshot(ven, pay, hist, now).collect()
    assert len(out) == 1  # venue 4 has this month already
    row = out[0]
    assert (row["venue_id"], row["captured_date"], row["review_delta"], row["rating_delta"]) == ("1", dt.date(2024, 2, 1), 2, 0.5)
    assert (row["sentiment_score"], row["air_quality_index"], row["review_text_2"]) == (0.5, 5, "bad")
    assert row["review_date_1"] == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_flood_risk(spark):
    ven = spark.createDataFrame([("a", -33.5, 150.5), ("b", -10.0, 140.0)], "id string, lat double, lng double")
    ring = [{"x": 150.0, "y": -34.0}, {"x": 151.0, "y": -34.0}, {"x": 151.0, "y": -33.0}, {"x": 150.0, "y": -33.0}]
    poly = spark.createDataFrame([("rare", "occasional", ring)], "p string, q string, ring array<struct<x:double,y:double>>")
    got = {r["id"]: r["flood_risk_category"] for r in venues.flood_risk(ven, poly, ["p", "q"]).collect()}
    assert got == {"a": "Occasionally", "b": "Rarely"}
    assert {r["flood_risk_category"] for r in venues.flood_risk(ven, None, []).collect()} == {"Unknown"}


# -- destinations -----------------------------------------------------------


def test_destination_services(spark):
    dest = spark.createDataFrame([("d1", "Byron Bay", "NSW", -28.64, 153.61), ("d2", "Nowhere", "WA", -28.83, 153.56)], "destination_id string, destination_name string, state_code string, lat double, lng double")
    air = spark.createDataFrame([(1, " bnk ", "Ballina", "-28.83", "153.56"), (2, "SYD", "Sydney", "-33.94", "151.17"), (3, "BAD", "x", "?", "1")], "airport_no int, iata string, airport_name string, lat string, lng string")
    ans = spark.createDataFrame([("d1", "", None, "0", "33.6", "Yes", "")], "destination_id string, nearest_airport_name string, nearest_airport_iata string, nearest_airport_distance_km string, nearest_airport_drive_mins string, rideshare_available string, data_confidence string")
    cel = spark.createDataFrame([(1, "c1", "Byron Baye", "NSW"), (2, "c2", "Byron Bay", "VIC")], "row_no long, celebrant_id string, full_name string, state string")
    out = by(destinations.service_rows(dest, air, ans, cel), "destination_id")
    d1 = out["d1"]
    assert (d1["nearest_airport_name"], d1["nearest_airport_iata"], d1["nearest_airport_distance_km"], d1["nearest_airport_drive_mins"]) == ("Ballina", "BNK", 22, 34)
    assert (d1["rideshare_available"], d1["celebrant_crossref"], d1["data_confidence"]) == (True, "c1|Byron Baye", "medium")
    assert (out["d2"]["nearest_airport_distance_km"], out["d2"]["nearest_airport_drive_mins"], out["d2"]["celebrant_crossref"]) == (0, 0, "")


def test_pick_destinations(spark):
    df = spark.createDataFrame([("a", "hunter-valley", "Hunter Valley", "2", True, True), ("b", "nsw", "NSW", "1", False, True), ("c", "noosa", "Noosa", "2", True, False)], "destination_id string, destination_slug string, destination_name string, hierarchy_level string, is_destination_wedding_location boolean, is_active boolean")
    assert [r["destination_id"] for r in destinations.pick_destinations(df, ("noosa",)).collect()] == ["a"]


def test_gap_filling(spark):
    orgs = spark.createDataFrame(
        [("o1", "NOT_FOUND", None, "keep", "", "", "", "0", "0"), ("o2", "a@b.org", "x", "x", "x", "x", "x", "-30", "150")],
        "org_id string, visitor_centre_email string, social_instagram string, social_facebook string, social_pinterest string, website_weddings_page string, website_events_page string, lat string, lng string",
    )
    ans = spark.createDataFrame(
        [("o1", "me@x.org", "@me", "fb", None, "www.x.org", "x", "-33.1234567", "151.0"), ("o2", "n@x.org", "@me", "fb", "p", "www.x.org", "x", "-33", "151.0")],
        "org_id string, email string, instagram string, facebook string, pinterest string, weddings_url string, events_url string, lat string, lng string",
    )
    now = F.lit("2024-05-05").cast("timestamp")
    out = by(destinations.fill_tourism_gaps(orgs, ans, now), "org_id")
    o1, o2 = out["o1"], out["o2"]
    assert (o1["visitor_centre_email"], o1["social_instagram"], o1["social_facebook"], o1["social_pinterest"]) == (
        "me@x.org", "https://www.instagram.com/me/", "keep", "NOT_FOUND",
    )
    assert (o1["website_weddings_page"], o1["website_events_page"], o1["lat"], o1["lng"]) == ("https://www.x.org", "NOT_FOUND", -33.123457, 151.0)
    assert o1["updated_at"] is not None and o2["updated_at"] is None
    assert (o2["visitor_centre_email"], o2["lat"]) == ("a@b.org", -30.0)

    parks = spark.createDataFrame(
        [("p1", "https://park.org/home", V, "keep", V, None, V)],
        "npark_id string, website_homepage string, contact_email string, contact_phone string, website_weddings_permit_page string, hq_suburb string, typical_permit_fee_range_aud string",
    )
    ans = spark.createDataFrame([("p1", "unknown", "1", "/permits", "Town", "$10")], "npark_id string, email string, phone string, permit_url string, hq_suburb string, fee_range string")
    p1 = destinations.fill_park_gaps(parks, ans, now).first()
    assert (p1["contact_email"], p1["contact_phone"], p1["website_weddings_permit_page"], p1["hq_suburb"], p1["typical_permit_fee_range_aud"]) == (
        "NOT_FOUND", "keep", "https://park.org/permits", None, "$10",
    )


def test_search_texts(spark):
    df = spark.createDataFrame([(" Old Mill ", "Hunter / Newcastle", "NSW"), ("X", None, "")], "NAME string, REGION string, STATE string")
    out = destinations.search_texts(df).collect()
    assert (out[0]["primary_query"], out[0]["fallback_query"]) == ("Old Mill Hunter NSW Australia", "Old Mill wedding venue NSW Australia")
    assert out[1]["primary_query"] == "X Australia"
