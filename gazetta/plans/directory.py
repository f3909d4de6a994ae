"""Directory jobs on the test tables: alignment, coverage, profiles, gap filling, loads and keyed sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.functions import values as va
from gazetta.plans import celebrants, councils, destinations, influencers, venues
from gazetta.plans.links import CUSTOMER_POINTS, PAIR_SCORES, ZONES_SQL, _spread, _zones, edited_name
from gazetta.plans.registry import query, table

V = va.VERIFY_REQUIRED


@query(
    "council_align",
    """WITH d AS (SELECT s_suppkey, n_regionkey, lower('Port ' || n_name || ' ' || s_suppkey) AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT n_name || ' Council of all' AS council_name, n.n_regionkey::VARCHAR AS state_code,
           COALESCE(string_agg(s_suppkey::VARCHAR, ',' ORDER BY s_suppkey), '') AS aligned
    FROM nation n LEFT JOIN d ON d.n_regionkey = n.n_regionkey AND contains(d.name, lower(n_name)) GROUP BY 1, 2""",
)
def council_align(spark: SparkSession, sf: str) -> DataFrame:
    """The council's short name must occur in the destination's: NATION_1 also meets NATION_11 of its region."""
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").cast("string").alias("state_code"))
    owners = nation.select(
        F.concat("n_name", F.lit(" Council of all")).alias("council_name"), "state_code", F.lit("old").alias("aligned_destination_ids")
    )
    places = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("destination_id"), F.concat_ws(" ", F.lit("Port"), "n_name", "s_suppkey").alias("destination_name"), "state_code"
    )
    aligned = F.array_join(F.col("aligned_destination_ids").cast("array<string>"), ",").alias("aligned")
    return councils.align(owners, places).select("council_name", "state_code", aligned)


@query(
    "council_coverage",
    """WITH e(state_code, k, expected) AS (VALUES ('NSW', 0, 128), ('QLD', 1, 77), ('VIC', 2, 79), ('TAS', 3, 29), ('SA', 4, 68), ('WA', 5, 137)),
    a AS (SELECT c_nationkey % 8 AS k, COUNT(*) AS n FROM customer WHERE c_acctbal > 8000 GROUP BY 1)
    SELECT state_code, expected::BIGINT AS expected, COALESCE(n, 0) AS actual, greatest(expected - COALESCE(n, 0), 0) AS missing, COALESCE(n, 0) / expected AS share
    FROM e LEFT JOIN a USING (k)""",
)
def council_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """States that no one expects count nowhere, and those with no council count 0."""
    codes = F.array(*[F.lit(s) for s in (*councils.EXPECTED, "NT")])
    rich = table(spark, sf, "customer").filter("c_acctbal > 8000")
    return councils.council_coverage(rich.select(F.get(codes, F.col("c_nationkey") % 8).alias("state_code")))


@query(
    "permit_profile",
    """SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE o_orderstatus <> 'F') AS with_permit_page, COUNT(*) FILTER (WHERE o_custkey % 3 = 0) AS insurance_required,
              COUNT(*) FILTER (WHERE o_custkey % 5 = 0) AS online_application,
              AVG(CASE o_custkey % 4 WHEN 1 THEN o_orderkey % 300 + 26 WHEN 2 THEN o_orderkey % 2000 + 1 WHEN 3 THEN 40 END) AS avg_fee,
              AVG(CASE WHEN o_custkey % 2 = 0 THEN o_orderkey % 60 END) AS avg_lead_days FROM orders""",
)
def permit_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Fees as text: a range, a number, a sentence with two numbers, and none."""
    kind, cust, key = F.col("o_custkey") % 4, F.col("o_custkey"), F.col("o_orderkey")
    fee = (
        F.when(kind == 1, F.format_string("$%d - $%d", key % 300 + 1, key % 300 + 51))
        .when(kind == 2, F.format_string("AUD %,d", key % 2000 + 1))
        .when(kind == 3, F.lit("30 for small, 50 for large ones"))
    )
    permits = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "F", "https://p.example").alias("permit_page_url"),
        F.when(cust % 3 == 0, True).when(cust % 3 == 1, False).alias("insurance_required"),
        F.when(cust % 5 == 0, "https://a.example").alias("application_url"),
        fee.alias("permit_fee_aud"),
        F.when(cust % 2 == 0, key % 60).alias("permit_lead_time_days"),
    )
    return councils.permit_profile(permits)


@query(
    "fill_park_gaps",
    """SELECT s_suppkey AS npark_id,
              CASE s_suppkey % 3 WHEN 0 THEN CASE WHEN s_nationkey >= 20 THEN 'VERIFY_REQUIRED' WHEN s_suppkey % 2 = 1 THEN 'e' || s_suppkey || '@x.example' ELSE 'NOT_FOUND' END
                                 WHEN 1 THEN NULL ELSE 'a@b.example' END AS contact_email,
              CASE WHEN s_nationkey < 20 THEN 'NOT_FOUND' ELSE 'verify_required' END AS contact_phone,
              CASE WHEN s_nationkey < 20 THEN 'https://s' || s_suppkey || '.example/permit/' || s_suppkey ELSE 'VERIFY_REQUIRED' END AS website_weddings_permit_page,
              'Town' AS hq_suburb, CAST(NULL AS VARCHAR) AS typical_permit_fee_range_aud, s_nationkey < 20 AS stamped FROM supplier""",
)
def fill_park_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Marked gaps take the answer or NOT_FOUND; filled values and NULLs stay, and so do parks without an answer."""
    key, suppliers = F.col("s_suppkey"), table(spark, sf, "supplier")
    parks = suppliers.select(
        key.alias("npark_id"),
        F.concat(F.lit("https://s"), key, F.lit(".example/")).alias("website_homepage"),
        F.when(key % 3 == 0, V).when(key % 3 == 2, "a@b.example").alias("contact_email"),
        F.lit("verify_required").alias("contact_phone"),
        F.lit(V).alias("website_weddings_permit_page"),
        F.lit("Town").alias("hq_suburb"),
        F.lit(None).cast("string").alias("typical_permit_fee_range_aud"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )
    answers = suppliers.filter("s_nationkey < 20").select(
        key.alias("npark_id"),
        F.when(key % 2 == 1, F.concat(F.lit("e"), key, F.lit("@x.example"))).otherwise("Unknown").alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.concat(F.lit("/permit/"), key).alias("permit_url"),
        F.lit("Other").alias("hq_suburb"),
        F.lit("$5").alias("fee_range"),
    )
    out = destinations.fill_park_gaps(parks, answers, F.lit("2026-01-01").cast("timestamp"))
    return out.withColumn("stamped", F.col("updated_at").isNotNull()).drop("website_homepage", "updated_at")


@query(
    "upsert_sources",
    """WITH m AS (SELECT c_custkey // 2 AS k, MIN(c_custkey) AS seen FROM customer WHERE c_nationkey > 0 GROUP BY 1),
    u AS (SELECT k, seen, c_name AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'n' || c_custkey END AS notes FROM m JOIN customer ON c_custkey = seen),
    fresh AS (SELECT *, row_number() OVER (ORDER BY seen) + (SELECT MAX(s_suppkey) + 1 FROM supplier) AS n FROM u WHERE k NOT IN (SELECT s_suppkey FROM supplier))
    SELECT printf('INF-WED-%03d', s_suppkey + 1) AS source_id, COALESCE(name, s_name) AS name, 'https://Site' || s_suppkey || '.example/' AS url, COALESCE(notes, 'kept') AS notes
    FROM supplier LEFT JOIN u ON k = s_suppkey
    UNION ALL SELECT printf('INF-WED-%03d', n), name, 'https://site' || k || '.example', notes FROM fresh""",
)
def upsert_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Typed source rows, one per address, into a table that knows some of the addresses."""
    site = F.concat(F.lit("https://www.Site"), (F.col("c_custkey") / 2).cast("bigint"), F.lit(".example/"))
    master = table(spark, sf, "customer").select(
        "c_custkey",
        F.col("c_name").alias("NAME"),
        F.when(F.col("c_nationkey") > 0, site).otherwise("").alias("url"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("n"), "c_custkey")).otherwise("nan").alias("NOTES"),
    )
    known = table(spark, sf, "supplier").select(
        F.format_string("INF-WED-%03d", F.col("s_suppkey") + 1).alias("source_id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("https://Site"), "s_suppkey", F.lit(".example/")).alias("url"),
        F.lit("kept").alias("notes"),
    )
    rows = influencers.source_rows(master, None, "c_custkey").select("seen", "name", "url", "notes")
    return influencers.upsert_sources(known, rows)


@query(
    "enrich_sources",
    """SELECT s_suppkey AS source_id, CASE WHEN s_nationkey < 20 AND s_suppkey % 2 = 1 THEN 'budget' ELSE 'first' END AS specialism_primary,
              CASE WHEN s_nationkey < 20 THEN least(greatest(s_suppkey % 15, 1), 10) END AS relevance_score,
              CASE WHEN s_nationkey >= 20 THEN NULL WHEN s_suppkey % 15 >= 8 THEN 'p1_this_month' WHEN s_suppkey % 15 >= 6 THEN 'p2_this_quarter' ELSE 'p3_backlog' END AS outreach_priority,
              CASE WHEN s_nationkey < 20 THEN CASE s_suppkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END END AS has_advertising,
              CASE WHEN s_nationkey < 20 THEN s_suppkey % 4 = 0 END AS insurance_hook, contains(COALESCE(r, ''), 'old') AS keeps, contains(COALESCE(r, ''), 'rain ' || s_suppkey) AS adds
       FROM (SELECT *, CASE WHEN s_suppkey % 2 = 0 THEN 'old' ELSE '' END || CASE WHEN s_nationkey < 20 AND s_suppkey % 4 = 0 THEN 'rain ' || s_suppkey ELSE '' END AS r FROM supplier)""",
)
def enrich_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Answers with prose around the JSON; unknown words and sources without an answer change nothing."""
    key, suppliers = F.col("s_suppkey"), table(spark, sf, "supplier")
    sources = suppliers.select(
        key.alias("source_id"), F.when(key % 2 == 0, "old").alias("notes"), F.lit("first").alias("specialism_primary")
    )
    record = F.to_json(
        F.struct(
            F.when(key % 2 == 1, " Budget").otherwise("gardening").alias("specialism_primary"),
            (key % 15).cast("string").alias("relevance_score"),
            F.when(key % 3 == 0, "Yes").when(key % 3 == 1, "no").otherwise("perhaps").alias("has_advertising"),
            F.when(key % 4 == 0, "true").otherwise("false").alias("insurance_hook"),
            F.when(key % 4 == 0, F.concat(F.lit("rain "), key)).otherwise("").alias("insurance_hook_reason"),
        )
    )
    answers = suppliers.filter("s_nationkey < 20").select(key.alias("source_id"), F.concat(F.lit("Here it is: "), record, F.lit(" as asked.")).alias("answer"))
    notes = F.coalesce("notes", F.lit(""))
    return influencers.enrich(sources, answers).select(
        "source_id", "specialism_primary", F.col("relevance_score").cast("bigint").alias("relevance_score"), "outreach_priority", "has_advertising", "insurance_hook",
        notes.contains("old").alias("keeps"), notes.contains(F.concat(F.lit("rain "), "source_id")).alias("adds"),
    )


@query(
    "active_profile",
    """SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE c_acctbal > 0) AS active, COUNT(*) FILTER (WHERE c_nationkey < 10) AS in_easy_weddings,
              COUNT(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS afcc_members, COUNT(*) FILTER (WHERE c_nationkey % 4 IN (2, 3)) AS in_two_or_more,
              COUNT(*) FILTER (WHERE c_custkey % 6 = 1) AS specialists FROM customer""",
)
def active_profile(spark: SparkSession, sf: str) -> DataFrame:
    nation, customers = F.col("c_nationkey"), table(spark, sf, "customer")
    return celebrants.active_profile(
        customers.select(
            F.when(F.col("c_acctbal") > 0, "Yes").otherwise(V).alias("is_active_market"),
            F.when(nation < 10, "https://e.example").when(nation < 20, V).alias("easy_weddings_profile_url"),
            F.when(F.col("c_mktsegment") == "BUILDING", "true").otherwise("false").alias("afcc_member"),
            F.when(nation % 4 > 0, (nation % 4).cast("string")).otherwise("none").alias("directory_listing_count"),
            F.when(F.col("c_custkey") % 6 == 1, "1").alias("is_destination_specialist"),
        )
    )


@query(
    "load_rows",
    """WITH t AS (SELECT o_custkey, arg_max('o' || o_orderkey || '@x.example', o_orderkey) FILTER (WHERE o_orderkey % 5 > 1) AS email,
                         arg_max('Top ' || o_orderkey, o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS full_name FROM orders GROUP BY 1)
    SELECT c_custkey::VARCHAR AS celebrant_id, COALESCE(t.full_name, CASE WHEN c_nationkey > 0 THEN c_name END, 'VERIFY_REQUIRED') AS full_name,
           COALESCE(t.email, CASE WHEN c_nationkey % 2 = 0 THEN 'c' || c_custkey || '@x.example' END, 'VERIFY_REQUIRED') AS email, 'VERIFY_REQUIRED' AS brand_id
    FROM customer LEFT JOIN t ON o_custkey = c_custkey""",
)
def load_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Per column the last filled value of the enriched rows; blanks become the sentinel."""
    base = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("celebrant_id"),
        F.when(F.col("c_nationkey") > 0, F.col("c_name")).otherwise(" ").alias("full_name"),
        F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("c"), "c_custkey", F.lit("@x.example"))).otherwise("NaN").alias("email"),
        F.lit("dropped").alias("scratch"),
    )
    key = F.col("o_orderkey")
    mail = F.when(key % 5 > 1, F.concat(F.lit("o"), key, F.lit("@x.example"))).when(key % 5 == 1, "nan").otherwise("")
    top = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("celebrant_id"),
        key,
        mail.alias("email"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Top "), key)).alias("full_name"),
        F.lit("no such column").alias("unknown"),
    )
    return celebrants.load_rows(base, top, "o_orderkey").select("celebrant_id", "full_name", "email", "brand_id")


@query(
    "flood_risk",
    f"""WITH {CUSTOMER_POINTS}, {ZONES_SQL}
    SELECT p.c_custkey AS id, CASE MAX(CASE z.n_regionkey WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 5 WHEN 3 THEN 4 WHEN 4 THEN 1 END)
             WHEN 5 THEN 'Highly Frequently' WHEN 4 THEN 'Frequently' WHEN 3 THEN 'Occasionally' WHEN 1 THEN 'Unknown'
             ELSE 'Rarely' END AS flood_risk_category, 'Unknown' AS without_data
    FROM pts p LEFT JOIN inside i USING (c_custkey) LEFT JOIN zones z ON z.n_nationkey = i.n_nationkey GROUP BY 1""",
)
def flood_risk(spark: SparkSession, sf: str) -> DataFrame:
    """Venues rated by all polygons, and what they get where there are none."""
    points = _spread(table(spark, sf, "customer"), "c_custkey", ["c_custkey"]).withColumnRenamed("c_custkey", "id")
    rated = venues.flood_risk(points, _zones(table(spark, sf, "nation")), ["label"], salts=16)
    without = venues.flood_risk(points, None, ["label"]).select("id", F.col("flood_risk_category").alias("without_data"))
    return rated.select("id", "flood_risk_category").join(without, "id")


def _found(name: Column, number: Column, rating: Column) -> Column:
    """A place payload as a search returns it."""
    return F.to_json(
        F.struct(
            F.concat(F.lit("places/P"), number).alias("name"),
            F.struct(name.alias("text")).alias("displayName"),
            F.concat(number, F.lit(" Main St, Town NSW 2000, Australia")).alias("formattedAddress"),
            F.struct(F.lit(-33.5).alias("latitude"), F.lit(151.25).alias("longitude")).alias("location"),
            rating.alias("rating"),
            (rating * 3).alias("userRatingCount"),
        )
    )


@query(
    "patch_places",
    f"""WITH {PAIR_SCORES},
    own AS (SELECT n.p_partkey, n.p_size, s.score FROM named n LEFT JOIN scores s USING (lk, rk)),
    best AS (SELECT *, CASE WHEN score >= 60 THEN 0 WHEN p_size > 40 THEN 1 END AS q, p_partkey % 5 + 1 AS rating FROM own)
    SELECT 'C' || p_partkey AS celebrant_id, CASE WHEN q IS NULL THEN 'old' ELSE 'P' || p_partkey || '-' || q END AS google_place_id,
           CASE WHEN q = 1 OR (q = 0 AND score >= 85) THEN 'HIGH' WHEN q = 0 AND score >= 70 THEN 'MEDIUM' WHEN q = 0 THEN 'LOW' END AS places_match_confidence,
           CASE WHEN q IS NOT NULL THEN rating || '.0' END AS google_rating, CASE WHEN q IS NOT NULL THEN (rating * 3)::VARCHAR END AS google_review_count,
           CASE WHEN q IS NOT NULL THEN 8 * rating + 44 + CASE WHEN p_size % 2 = 0 THEN 10 ELSE 0 END END AS celebrant_quality_score
    FROM best""",
)
def patch_places(spark: SparkSession, sf: str) -> DataFrame:
    """The first candidate at 60 in the order of the searches; without one the row stays as it is."""
    part, key = table(spark, sf, "part"), F.col("p_partkey")
    ident, rating = F.concat(F.lit("C"), key).alias("celebrant_id"), key % 5 + 1
    rows = part.select(
        ident,
        F.col("p_name").alias("full_name"),
        F.lit("old").alias("google_place_id"),
        F.when(F.col("p_size") % 2 == 0, "yes").otherwise("no").alias("abia_winner"),
        F.lit("4.0").alias("easy_weddings_rating"),
        F.lit("3").alias("directory_listing_count"),
    )

    def search(number: int, name: Column) -> DataFrame:
        payload = _found(name, F.concat(key, F.lit(f"-{number}")), rating)
        return part.filter(F.lit(number == 0) | (F.col("p_size") > 40)).select(
            ident, F.lit(number).alias("query_no"), name.alias("candidate_name"), payload.alias("payload")
        )

    out = celebrants.patch_places(rows, search(0, edited_name()).unionByName(search(1, F.col("p_name"))))
    return out.select(
        "celebrant_id", "google_place_id", "places_match_confidence", "google_rating", "google_review_count",
        F.col("celebrant_quality_score").cast("bigint").alias("celebrant_quality_score"),
    )


@query(
    "enrich_places",
    f"""WITH {PAIR_SCORES}
    SELECT n.p_partkey AS row_index, CASE WHEN p_size > 5 THEN 'P' || n.p_partkey END AS place_id, CASE WHEN p_size > 5 THEN s.score END AS fuzzy_match_score,
           CASE WHEN p_size > 5 AND s.score >= 70 THEN n.p_partkey || ' Main St, Town NSW 2000, Australia' END AS formatted_address,
           CASE WHEN p_size > 5 AND s.score >= 70 THEN (n.p_partkey % 5 + 1)::DOUBLE END AS google_rating,
           CASE WHEN p_size <= 5 THEN 'NO_MATCH' WHEN s.score >= 70 THEN 'taken' ELSE 'LOW' END AS outcome
    FROM named n LEFT JOIN scores s USING (lk, rk)""",
)
def enrich_places(spark: SparkSession, sf: str) -> DataFrame:
    """Found places in full from a name score of 70, their safe part below, and rows that no search found."""
    part, key = table(spark, sf, "part"), F.col("p_partkey")
    rows = part.select(key.alias("row_index"), F.col("p_name").alias("NAME"), F.lit("stale").alias("formatted_address"))
    found = part.filter("p_size > 5").select(key.alias("row_index"), _found(edited_name(), key, key % 5 + 1).alias("payload"))
    confidence = F.col("places_match_confidence")
    return venues.enrich_places(rows, found).select(
        "row_index", "place_id", F.when(F.col("place_id").isNotNull(), F.col("fuzzy_match_score").cast("bigint")).alias("fuzzy_match_score"),
        "formatted_address", "google_rating", F.when(confidence.isin("HIGH", "MEDIUM"), "taken").otherwise(confidence).alias("outcome"),
    )


@query(
    "pick_destinations",
    """SELECT c_custkey AS destination_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 40 ELSE 0 END + CASE WHEN c_nationkey % 3 = 0 THEN 12 ELSE 0 END
              + CASE WHEN c_acctbal > 5000 THEN 15 ELSE 0 END AS score
       FROM customer WHERE c_custkey % 10 <> 3 AND c_nationkey % 4 <> 0 ORDER BY score DESC, c_custkey LIMIT 40""",
)
def pick_destinations(spark: SparkSession, sf: str) -> DataFrame:
    """The 40 best active ones; top-level regions fall below the cut-off, ties go to the smaller id."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    rows = table(spark, sf, "customer").select(
        key.alias("destination_id"),
        F.concat(F.when(nation % 3 == 0, "wine-valley-").otherwise("x-"), key).alias("destination_slug"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("QQQ Zzz "), key)).alias("destination_name"),
        F.when(nation % 4 == 0, "1").otherwise("2").alias("hierarchy_level"),
        F.when(F.col("c_acctbal") > 5000, True).alias("is_destination_wedding_location"),
        (key % 10 != 3).alias("is_active"),
    )
    out = destinations.pick_destinations(rows, ["qqq zzz"])
    return out.select("destination_id", F.col("score").cast("bigint").alias("score"))
