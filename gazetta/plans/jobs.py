"""The composed directory jobs on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.functions import urls as ur
from gazetta.functions import values as va
from gazetta.plans import celebrants, councils, destinations, influencers, venues
from gazetta.plans.links import (
    CUSTOMER_POINTS,
    EDITED,
    LCS,
    PAIR_SCORES,
    SUPPLIER_POINTS,
    edited_name,
    km_sql,
    sorted_key,
)
from gazetta.plans.registry import query, table
from gazetta.plans.webpages import LINK_HOST, LINKS, PAGE_HOST

V = va.VERIFY_REQUIRED


@query(
    "award_merge",
    f"""WITH {PAIR_SCORES},
    firsts AS (SELECT rk, MIN(p_partkey) AS rid FROM named GROUP BY 1),
    best AS (SELECT lk, arg_max(rid, (score, -rid)) AS rid, MAX(score) AS score
             FROM scores JOIN firsts USING (rk) WHERE score >= 1 GROUP BY 1),
    found AS (SELECT n.p_partkey, {EDITED} AS edited, b.rid, b.score FROM named n LEFT JOIN best b USING (lk)),
    winners AS (SELECT rid, MIN(p_partkey) AS winner FROM found WHERE score >= 85 GROUP BY 1),
    judged AS (SELECT f.*, f.score >= 85 AND f.p_partkey = w.winner AS won FROM found f LEFT JOIN winners w USING (rid))
    SELECT 'CEL-' || p.p_partkey AS celebrant_id, COALESCE(j.edited, p.p_name) AS full_name,
           CASE WHEN j.rid IS NOT NULL THEN 'a' || j.p_partkey || '@new.example' WHEN p.p_size % 2 = 0 THEN 'VERIFY_REQUIRED'
                ELSE 'p' || p.p_partkey || '@old.example' END AS email,
           CASE WHEN j.rid IS NOT NULL THEN '85' ELSE 'VERIFY_REQUIRED' END AS data_quality_score,
           COALESCE(CAST(j.score AS VARCHAR), 'VERIFY_REQUIRED') AS merge_fuzzy_score,
           'VERIFY_REQUIRED' AS is_standalone_award_entry, 'REGISTER' AS data_source
    FROM part p LEFT JOIN judged j ON j.rid = p.p_partkey AND j.won
    UNION ALL
    SELECT printf('CEL-AWARD-%05d', row_number() OVER (ORDER BY p_partkey)), edited, 'a' || p_partkey || '@new.example',
           'VERIFY_REQUIRED', CAST(COALESCE(score, 0) AS VARCHAR), 'true', 'AWARD_STANDALONE'
    FROM judged WHERE NOT COALESCE(won, FALSE)""",
)
def award_merge(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    register = part.select(
        F.col("p_partkey").alias("row_no"),
        F.concat(F.lit("CEL-"), "p_partkey").alias("celebrant_id"),
        F.col("p_name").alias("full_name"),
        F.when(F.col("p_size") % 2 == 0, V).otherwise(F.concat(F.lit("p"), "p_partkey", F.lit("@old.example"))).alias("email"),
        *[F.lit(V).alias(c) for c in ("data_quality_score", "merge_fuzzy_score", "is_standalone_award_entry")],
        F.lit("REGISTER").alias("data_source"),
    )
    awards = part.select(
        F.col("p_partkey").alias("row_no"),
        edited_name().alias("full_name"),
        F.concat(F.lit("a"), "p_partkey", F.lit("@new.example")).alias("email"),
    )
    return celebrants.merge_awards(register, awards)


# Which part kinds play which directory.
KINDS = {"EW": ("ECONOMY", "LARGE"), "AFCC": ("SMALL",), "TWS": ("MEDIUM",), "WL": ("PROMO",), "MCA": ("STANDARD",)}
_TAG = "CASE WHEN p_type IN ('ECONOMY', 'LARGE') THEN 'EW' WHEN p_type = 'SMALL' THEN 'AFCC' WHEN p_type = 'MEDIUM' THEN 'TWS' WHEN p_type = 'PROMO' THEN 'WL' ELSE 'MCA' END"


@query(
    "cross_reference",
    f"""WITH {PAIR_SCORES},
    firsts AS (SELECT rk, MIN(p_partkey) AS rid FROM named GROUP BY 1),
    best AS (SELECT lk, arg_max(rid, (score, -rid)) AS rid FROM scores JOIN firsts USING (rk) WHERE score >= 70 GROUP BY 1),
    rows AS (SELECT n.p_partkey, n.p_size, b.rid, {_TAG} AS tag FROM named n LEFT JOIN best b USING (lk)),
    hits AS (SELECT * FROM rows WHERE rid IS NOT NULL AND (tag <> 'AFCC' OR p_size > 10)),
    agg AS (SELECT rid, COUNT(DISTINCT tag) AS n, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags,
                   MAX(p_partkey) FILTER (WHERE tag = 'EW') AS last_ew, MIN(p_partkey) FILTER (WHERE tag = 'EW' AND p_size > 25) AS first_price,
                   bool_or(tag = 'EW' AND p_size > 45) AS special, bool_or(tag = 'AFCC') AS afcc FROM hits GROUP BY 1)
    SELECT 'CEL-' || p.p_partkey AS celebrant_id, p.p_name AS full_name, COALESCE('https://ew.example/' || a.last_ew, '') AS ew_url,
           COALESCE('$' || a.first_price, '') AS price, COALESCE(CAST(a.n AS VARCHAR), '0') AS listings, COALESCE(a.tags, '') AS sources,
           CASE WHEN a.n > 0 THEN 'true' ELSE 'false' END AS active, CASE WHEN a.special THEN 'true' ELSE 'false' END AS special,
           CASE WHEN a.afcc THEN 'true' ELSE 'false' END AS afcc
    FROM part p LEFT JOIN agg a ON a.rid = p.p_partkey
    UNION ALL
    SELECT 'CEL-EWDIR-' || r.p_partkey || '-' || sha256('https://ew.example/' || r.p_partkey), {EDITED}, 'https://ew.example/' || r.p_partkey, 'VERIFY_REQUIRED', '1', 'EW', 'true',
           'VERIFY_REQUIRED', 'VERIFY_REQUIRED' FROM rows r JOIN part USING (p_partkey) WHERE r.tag = 'EW' AND r.rid IS NULL""",
)
def cross_reference(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    key = F.col("p_partkey")
    master = part.select(
        key.alias("row_no"), F.concat(F.lit("CEL-"), key).alias("celebrant_id"), F.col("p_name").alias("full_name")
    )
    rows = part.select(
        key.alias("row_no"),
        "p_type",
        edited_name().alias("name"),
        edited_name().alias("brand_name"),
        edited_name().alias("full_name"),
        F.concat(F.lit("https://ew.example/"), key).alias("easy_weddings_profile_url"),
        F.when(F.col("p_size") > 25, F.concat(F.lit("$"), key)).otherwise("").alias("easy_weddings_price_from"),
        (F.col("p_size") > 45).alias("is_destination_specialist"),
        F.when(F.col("p_size") > 10, F.concat(key, F.lit("@a.example"))).alias("email"),
        F.lit("VIC").alias("state"),
    )
    lists = {tag: rows.filter(F.col("p_type").isin(*kinds)) for tag, kinds in KINDS.items()}
    out = celebrants.cross_reference(master, lists)
    return out.select(
        "celebrant_id",
        "full_name",
        F.col("easy_weddings_profile_url").alias("ew_url"),
        F.col("easy_weddings_price_from").alias("price"),
        F.col("directory_listing_count").alias("listings"),
        F.col("active_signal_sources").alias("sources"),
        F.col("is_active_market").alias("active"),
        F.col("is_destination_specialist").alias("special"),
        F.col("afcc_member").alias("afcc"),
    )


@query(
    "venue_snapshot",
    """WITH s AS (SELECT s_suppkey AS k, s_name, s_nationkey, round(s_acctbal, 2) AS bal FROM supplier),
    prev AS (SELECT s_suppkey AS k, CAST(s_nationkey AS DOUBLE) / 4 AS rating, CAST(s_nationkey * 2 AS BIGINT) AS n FROM supplier WHERE s_nationkey % 3 > 0)
    SELECT CAST(s.k AS VARCHAR) AS venue_id, '2024-02-01' AS captured_date, s.bal AS google_rating, CAST(s.k % 900 AS BIGINT) AS review_count,
           CAST(s.k % 900 AS BIGINT) - prev.n AS review_delta, s.bal - prev.rating AS rating_delta,
           CASE WHEN s.s_nationkey % 4 >= 2 THEN CAST(1 AS DOUBLE) END AS sentiment_score, CAST(5 AS BIGINT) AS pollen_tree_index, 'TREE' AS dominant_pollen_type,
           CAST(s.k % 50 AS BIGINT) AS air_quality_index
    FROM s LEFT JOIN prev USING (k) WHERE s.s_nationkey <> 7""",
)
def venue_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as venues; two earlier months of history, and nation 7 already has this month."""
    sup = table(spark, sf, "supplier")
    k, nation = F.col("s_suppkey"), F.col("s_nationkey")
    ven = sup.select(
        k.alias("id"), F.concat(F.lit("places/P"), k).alias("place_id"), F.lit("-33.5").alias("lat"), F.lit("151").alias("lng")
    )
    review = F.struct(F.struct(F.col("s_name").alias("text")).alias("text"))
    payloads = sup.select(
        k.cast("string").alias("id"),
        F.to_json(
            F.struct(
                F.round("s_acctbal", 2).alias("rating"),
                (k % 900).alias("userRatingCount"),
                F.when(nation % 4 > 0, F.array_repeat(review, (nation % 4).cast("int"))).alias("reviews"),
            )
        ).alias("place_json"),
        F.lit('{"dailyInfo":[{"pollenTypeInfo":[{"code":"TREE","indexInfo":{"value":8}}]}]}').alias("pollen_json"),
        F.to_json(F.struct(F.array(F.struct((k % 50).alias("aqi"))).alias("indexes"))).alias("air_json"),
        F.lit('Here: {"sentiment_score": 3, "top_themes": ["x"]}').alias("answer"),
    )

    def month(day: str, factor: float, only) -> DataFrame:
        return sup.filter(only).select(
            k.cast("string").alias("venue_id"),
            F.lit(day).cast("date").alias("captured_date"),
            (nation / 4 * factor).alias("google_rating"),
            (nation * 2).cast("int").alias("review_count"),
        )

    history = (
        month("2023-12-01", 2.0, nation % 3 > 0)
        .unionByName(month("2024-01-01", 1.0, nation % 3 > 0))
        .unionByName(month("2024-02-01", 1.0, nation == 7))
    )
    out = venues.monthly_snapshot(ven, payloads, history, F.lit("2024-02-10 00:00:00").cast("timestamp"))
    big = ("review_count", "review_delta", "pollen_tree_index", "air_quality_index")
    return out.select(
        "venue_id",
        va.date_text("captured_date").alias("captured_date"),
        "google_rating",
        "rating_delta",
        "sentiment_score",
        "dominant_pollen_type",
        *[F.col(c).cast("bigint").alias(c) for c in big],
    )


@query(
    "publish_venues",
    """SELECT 'P' || o_custkey AS place_id, o_orderpriority AS name, CAST(o_orderkey AS VARCHAR) AS postcode,
              CAST(floor(o_totalprice) AS BIGINT) AS capacity_max, o_orderpriority = '1-URGENT' AS parking_paid
       FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'F' AND o_totalprice >= 50000
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""",
)
def publish_venues(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as sheet rows: customers as places, with blank place ids and doubtful rows."""
    o = table(spark, sf, "orders")
    sheet = o.select(
        F.col("o_orderkey").alias("row_index"),
        F.col("o_orderpriority").alias("NAME"),
        F.when(F.col("o_totalprice") < 50000, F.lit("nan")).otherwise(F.concat(F.lit("P"), "o_custkey")).alias("place_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", "LOW").otherwise("HIGH").alias("places_match_confidence"),
        F.when(F.col("o_orderstatus") == "F", "CLOSED_PERMANENTLY").otherwise("OPERATIONAL").alias("business_status"),
        F.format_string("%.2f", "o_totalprice").alias("CAPACITY MAX"),
        F.concat("o_orderkey", F.lit(".0")).alias("postcode"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Yes").otherwise("0").alias("parking_paid"),
    )
    out = venues.publish_venues(sheet, "row_index")
    return out.select("place_id", "name", "postcode", "capacity_max", "parking_paid")


_HOST = "regexp_replace(lower(regexp_extract(url, '(?i)^https?://([^/?#]*)', 1)), '^www\\.', '')"


@query(
    "discover_sources",
    f"""WITH p AS (SELECT page_id, {_HOST} AS host, url, url LIKE 'https:%' AS secure FROM pages),
    fresh AS (SELECT host, MIN(page_id) AS first_page FROM p WHERE NOT secure AND NOT contains(url, '?') GROUP BY 1)
    SELECT printf('INF-DISC-%03d', row_number() OVER (ORDER BY first_page) + 7) AS source_id, 'https://' || host AS url,
           'Site ' || first_page AS name, 'medium' AS trust_level, 'NSW|VIC' AS states
    FROM fresh WHERE host NOT IN (SELECT host FROM p WHERE secure)""",
)
def discover_sources(spark: SparkSession, sf: str) -> DataFrame:
    """One answer per page that names its host; hosts of secure pages are known already."""
    pages = table(spark, sf, "pages").select("page_id", "url", ur.host_key("url").alias("host"))
    secure = F.col("url").startswith("https:")
    kind = F.when(F.col("url").contains("?"), "advert").otherwise("blog")
    item = F.struct(
        F.concat(F.lit("Site "), "page_id").alias("name"),
        F.concat(F.lit("www."), "host", F.lit("/")).alias("url"),
        kind.alias("source_type"),
        F.lit("nsw, vic").alias("states"),
        F.lit("great").alias("trust_level"),
    )
    answers = pages.filter(~secure).select(
        F.col("page_id").alias("answer_no"),
        F.lit("q").alias("query"),
        F.concat(F.lit("Found:\n```json\n"), F.to_json(F.array(item)), F.lit("\n```")).alias("answer"),
    )
    known = pages.filter(secure).select(ur.norm_url("host").alias("url_key"))
    out = influencers.discover(answers, known, ["blog"], last_number=7)
    return out.select("source_id", "url", "name", "trust_level", "states")


@query(
    "permit_groups",
    """WITH own AS (SELECT d.c_custkey, MIN(s.s_suppkey) AS owner FROM customer d JOIN supplier s
                    ON d.c_custkey BETWEEN s.s_suppkey * 10 AND s.s_suppkey * 10 + 14 AND s.s_nationkey <> 3 GROUP BY 1),
    mem AS (SELECT d.c_custkey, d.c_nationkey, CASE WHEN o.owner IS NOT NULL THEN 'council:' || printf('%07d', o.owner)
                   WHEN d.c_nationkey % 2 = 0 THEN 'permit_domain:site' || d.c_nationkey || '.example' END AS group_key
            FROM customer d LEFT JOIN own o USING (c_custkey))
    SELECT c_custkey, group_key, CASE WHEN group_key LIKE 'council:%' THEN 'https://council' || CAST(substr(group_key, 9) AS BIGINT) || '.example/'
             ELSE 'https://www.site' || c_nationkey || '.example/' END AS website,
           TRUE AS permit_required, CAST(length(group_key) AS BIGINT) AS lead_days
    FROM mem WHERE group_key IS NOT NULL""",
)
def permit_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as councils that list customers; every group's answer reaches all its members."""
    cust, sup = table(spark, sf, "customer"), table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    cncl = sup.select(
        F.format_string("%07d", k).alias("council_id"),
        F.col("s_name").alias("council_name"),
        F.lit("NSW").alias("state_code"),
        F.concat(F.lit("https://council"), k, F.lit(".example/")).alias("website"),
        F.transform(F.sequence(k * 10, k * 10 + 14), lambda x: x.cast("string")).alias("aligned_destination_ids"),
        (F.col("s_nationkey") != 3).alias("is_active"),
    )
    dest = cust.select(
        F.col("c_custkey").cast("string").alias("destination_id"),
        F.col("c_name").alias("destination_name"),
        F.lit("VIC").alias("state_code"),
        F.when(
            F.col("c_nationkey") % 2 == 0, F.concat(F.lit("https://www.site"), "c_nationkey", F.lit(".example/permits?x=1"))
        ).alias("council_permit_url"),
    )
    members, groups = councils.permit_groups(dest, cncl)
    answers = groups.select(
        "group_key",
        F.concat(
            F.lit('Result {"permit_required": "yes", "permit_lead_time_days": "'), F.length("group_key"), F.lit(' days"}')
        ).alias("answer"),
    )
    permits = councils.permit_rows(members, groups, answers, salts=4)
    sites = groups.select("group_key", "website")
    return permits.join(sites, "group_key").select(
        F.col("destination_id").cast("bigint").alias("c_custkey"),
        "group_key",
        "website",
        "permit_required",
        F.col("permit_lead_time_days").cast("bigint").alias("lead_days"),
    )


@query(
    "council_directory",
    r"""WITH n AS (SELECT page_id, upper(regexp_extract(url, 'https?://[^/]*/([a-z]+)', 1)) AS state_code, url,
                      'Council of ' || trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '[^A-Za-z]+', ' ', 'g')) AS name FROM pages),
    good AS (SELECT state_code, name, 'https://c' || page_id || '.gov.au/' || state_code AS website, page_id FROM n
             WHERE NOT regexp_matches(lower(name), 'councillor|councilor|mayor|election|ward|meeting|minutes|agenda|news|event')),
    firsts AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY state_code, lower(name), lower(website) ORDER BY page_id) = 1)
    SELECT printf('CNCL-%s-%03d', state_code, row_number() OVER (PARTITION BY state_code ORDER BY name, website)) AS council_id,
           state_code, name AS council_name, website FROM firsts""",
)
def council_directory(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as a list page: its own links and one council link made from its title."""
    region = F.upper(F.regexp_extract("url", r"https?://[^/]*/([a-z]+)", 1))
    name = F.btrim(F.regexp_replace(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1), "[^A-Za-z]+", " "))
    link = F.concat(
        F.lit('<a href="https://c'), "page_id", F.lit(".gov.au/"), region, F.lit('">Council of '), name,
        F.lit(' (list)</a><a href="/council-jobs">Council jobs</a>'),
    )
    pages = table(spark, sf, "pages").select("page_id", "url", region.alias("state_code"), F.concat("html", link).alias("html"))
    good, _ = councils.build_councils(pages, ids="sequence")
    return good.select("council_id", "state_code", "council_name", "website")


@query(
    "article_content",
    f"""WITH {LINKS},
    shaped AS (SELECT *, lower(regexp_extract(link, '(?i)^https?://[^/?#]*([^?#]*)', 1)) AS path FROM resolved),
    slugged AS (SELECT *, regexp_extract(regexp_replace(path, '/+$', ''), '([^/]*)$', 1) AS slug FROM shaped),
    good AS (SELECT * FROM slugged WHERE length(text) >= 12 AND {LINK_HOST} = {PAGE_HOST}
             AND NOT regexp_matches(path, '/about|/contact|/privacy|/tag/|/page/|/author/|/login')
             AND regexp_replace(link, '/+$', '') <> regexp_replace(url, '/+$', '') AND slug NOT IN ('', 'blog', 'category', 'archives')
             AND (contains(path, '/20') OR contains(path, '/blog') OR length(slug) > 14)),
    firsts AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY page_id, link ORDER BY pos) = 1),
    ranked AS (SELECT *, 'INF-' || page_id AS source_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS place FROM firsts QUALIFY place <= 10),
    fresh AS (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY link ORDER BY source_id, place) = 1)
    SELECT printf('CONT-%s-%03d', source_id, 1 + row_number() OVER (PARTITION BY source_id ORDER BY place)) AS content_id, source_id,
           text AS title, link AS url,
           regexp_matches(lower(text), 'cancel|weather|risk|permit|vendor|supplier|fail|rain|backup|insurance|cost|outdoor|policy|disaster|emergency') AS insurance_relevant
    FROM fresh WHERE link NOT IN (SELECT url FROM pages)""",
)
def article_content(spark: SparkSession, sf: str) -> DataFrame:
    """Article rows of every page's site, none known yet."""
    blogs = table(spark, sf, "pages").select(
        F.concat(F.lit("INF-"), "page_id").alias("source_id"), "url", "html"
    )
    known = blogs.select(F.concat("source_id", F.lit("-001")).alias("content_id"), "source_id", "url")
    return influencers.content_rows(blogs, known, k=10)


@query(
    "gap_filling",
    """SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN c_name || '@x.example' ELSE 'old@x.example' END AS visitor_centre_email,
              CASE WHEN c_nationkey % 2 = 0 THEN 'https://www.instagram.com/u' || c_custkey || '/' ELSE 'kept' END AS social_instagram,
              CASE WHEN c_mktsegment = 'BUILDING' THEN 'NOT_FOUND' ELSE 'https://www.x.example' END AS website_events_page,
              TRUE AS stamped
       FROM customer""",
)
def gap_filling(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as organisations with different gaps."""
    cust = table(spark, sf, "customer")
    nation = F.col("c_nationkey")
    orgs = cust.select(
        F.col("c_custkey").alias("org_id"),
        F.when(nation < 5, "VERIFY_REQUIRED").otherwise("old@x.example").alias("visitor_centre_email"),
        F.when(nation % 2 == 0, "n/a").otherwise("kept").alias("social_instagram"),
        *[F.lit("x").alias(c) for c in ("social_facebook", "social_pinterest", "website_weddings_page")],
        F.lit(None).cast("string").alias("website_events_page"),
        F.lit("0").alias("lat"),
        F.lit("0").alias("lng"),
    )
    answers = cust.select(
        F.col("c_custkey").alias("org_id"),
        F.concat("c_name", F.lit("@x.example")).alias("email"),
        F.concat(F.lit("@u"), "c_custkey").alias("instagram"),
        *[F.lit(None).cast("string").alias(c) for c in ("facebook", "pinterest", "weddings_url")],
        F.when(F.col("c_mktsegment") == "BUILDING", "not found").otherwise("www.x.example").alias("events_url"),
        F.lit("-33.5").alias("lat"),
        F.lit("151.25").alias("lng"),
    )
    out = destinations.fill_tourism_gaps(orgs, answers, F.lit("2024-01-01").cast("timestamp"))
    return out.select(
        F.col("org_id").alias("c_custkey"),
        "visitor_centre_email",
        "social_instagram",
        "website_events_page",
        F.col("updated_at").isNotNull().alias("stamped"),
    )


@query(
    "register_rows",
    """WITH r AS (SELECT conv_id, turn, role, row_number() OVER (ORDER BY conv_id, turn) AS pos FROM conversations),
    h AS (SELECT *, last_value(CASE WHEN role = 'user' THEN CASE WHEN turn % 3 = 0 THEN 'NSW' WHEN turn % 3 = 1 THEN 'VIC' ELSE 'UNK' END END IGNORE NULLS)
                 OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS region FROM r)
    SELECT conv_id, turn, printf('CEL-%s-%06d', COALESCE(region, 'UNK'),
             row_number() OVER (PARTITION BY COALESCE(region, 'UNK') ORDER BY conv_id * 1000 + turn)) AS celebrant_id
    FROM h WHERE role <> 'user'""",
)
def register_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as register pages: user turns are group headers, the others data rows."""
    conv = table(spark, sf, "conversations")
    turn = F.col("turn")
    head = F.when(turn % 3 == 0, "State: nsw").when(turn % 3 == 1, "VIC (2)").otherwise("Elsewhere")
    rows = conv.select(
        F.col("conv_id").alias("page"),
        (F.col("conv_id") * 1000 + turn).alias("pos"),
        F.when(F.col("role") == "user", head).alias("header"),
        F.lit("m: 0400 000 000").alias("cell"),
        F.col("role").alias("full_name"),
    )
    out = celebrants.register_rows(rows)
    return out.select(
        F.col("page").alias("conv_id"), (F.col("pos") - F.col("page") * 1000).alias("turn"), "celebrant_id"
    )


@query(
    "service_rows",
    f"""WITH {CUSTOMER_POINTS}, {SUPPLIER_POINTS},
    near AS (SELECT p.c_custkey, arg_min(s.s_suppkey, (round({km_sql('p', 's')}, 6), s.s_suppkey)) AS k,
                    CAST(round_even(MIN({km_sql('p', 's')}), 0) AS BIGINT) AS km FROM pts p, sup s GROUP BY 1),
    pairs AS (SELECT l.lk, r.rk FROM (SELECT DISTINCT lower(c_mktsegment) AS lk FROM customer) l,
                                     (SELECT DISTINCT {sorted_key('p_name')} AS rk FROM part) r),{LCS},
    firsts AS (SELECT p_brand, {sorted_key('p_name')} AS rk, MIN(p_partkey) AS rid FROM part GROUP BY ALL),
    best AS (SELECT f.p_brand, s.lk, arg_max(f.rid, (s.score, -f.rid)) AS rid FROM scores s JOIN firsts f USING (rk) WHERE s.score >= 55 GROUP BY ALL)
    SELECT c.c_custkey AS destination_id, 'Brand#' || (c.c_nationkey + 1) AS state_code, s.s_name AS nearest_airport_name,
           'A' || n.k AS nearest_airport_iata, CASE WHEN c.c_custkey % 2 = 0 THEN n.km ELSE 12 END AS nearest_airport_distance_km,
           CASE WHEN n.km <= 0 THEN 0 ELSE greatest(5, CAST(round_even(n.km / 75.0 * 60, 0) AS BIGINT)) END AS nearest_airport_drive_mins,
           TRUE AS rideshare_available, COALESCE(p.p_partkey || '|' || p.p_name, '') AS celebrant_crossref, 'medium' AS data_confidence
    FROM customer c JOIN near n USING (c_custkey) JOIN supplier s ON s.s_suppkey = n.k
    LEFT JOIN best b ON b.p_brand = 'Brand#' || (c.c_nationkey + 1) AND b.lk = lower(c.c_mktsegment) LEFT JOIN part p ON p.p_partkey = b.rid""",
)
def service_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as destinations, suppliers as airports, parts as celebrants of the same region."""
    cust, sup, part = (table(spark, sf, t) for t in ("customer", "supplier", "part"))
    k = F.col("c_custkey")
    dest = cust.select(
        k.alias("destination_id"),
        F.lower("c_mktsegment").alias("destination_name"),
        F.concat(F.lit("Brand#"), F.col("c_nationkey") + 1).alias("state_code"),
        (k * 7919 % 3571 / 100.0 - 45.0).alias("lat"),
        (k * 104729 % 4493 / 100.0 + 110.0).alias("lng"),
    )
    s = F.col("s_suppkey")
    air = sup.select(
        s.alias("airport_no"),
        F.concat(F.lit("a"), s).alias("iata"),
        F.col("s_name").alias("airport_name"),
        (s * 7919 % 3571 / 100.0 - 45.0).cast("string").alias("lat"),
        (s * 104729 % 4493 / 100.0 + 110.0).cast("string").alias("lng"),
    )
    answers = cust.select(
        k.alias("destination_id"),
        *[F.lit(None).cast("string").alias(c) for c in ("nearest_airport_name", "nearest_airport_iata", "data_confidence")],
        F.when(k % 2 == 0, "0").otherwise("12.5").alias("nearest_airport_distance_km"),
        F.lit("").alias("nearest_airport_drive_mins"),
        F.lit("yes").alias("rideshare_available"),
    )
    cel = part.select(
        F.col("p_partkey").alias("row_no"),
        F.col("p_partkey").cast("string").alias("celebrant_id"),
        F.col("p_name").alias("full_name"),
        F.col("p_brand").alias("state"),
    )
    return destinations.service_rows(dest, air, answers, cel)


