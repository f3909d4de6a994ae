"""Composed jobs of the directories on the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.plans import celebrants, councils, destinations, influencers
from gazetta.plans.registry import query, table


@query(
    "search_texts",
    """SELECT c_custkey, concat_ws(' ', c_name, c_mktsegment, CASE WHEN c_nationkey > 0 THEN c_nationkey::VARCHAR END, 'Australia') AS primary_query,
              concat_ws(' ', c_name, 'wedding venue', CASE WHEN c_nationkey > 0 THEN c_nationkey::VARCHAR END, 'Australia') AS fallback_query
       FROM customer""",
)
def search_texts(spark: SparkSession, sf: str) -> DataFrame:
    venues = table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit(" "), "c_name").alias("NAME"),
        F.concat("c_mktsegment", F.lit(" / elsewhere")).alias("REGION"),
        F.when(F.col("c_nationkey") > 0, F.col("c_nationkey").cast("string")).otherwise("").alias("STATE"),
    )
    return destinations.search_texts(venues).select("c_custkey", "primary_query", "fallback_query")


@query(
    "slug_names",
    """SELECT p_partkey, array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split(p_name, ' ')], ' ') AS name,
              lower(p_name) AS name_key FROM part""",
)
def slug_names(spark: SparkSession, sf: str) -> DataFrame:
    slugs = table(spark, sf, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("-")).alias("slug"))
    return destinations.slug_names(slugs, "slug").select("p_partkey", "name", "name_key")


@query(
    "website_queue",
    """SELECT c_custkey AS row_no, c_name AS full_name, s.s_name IS NOT NULL AS is_priority
       FROM customer c LEFT JOIN (SELECT DISTINCT regexp_replace(s_name, '^Supplier', 'Customer') AS s_name FROM supplier) s ON lower(c.c_name) = lower(s.s_name)
       WHERE c_acctbal > 0 ORDER BY is_priority DESC, row_no""",
)
def website_queue(spark: SparkSession, sf: str) -> DataFrame:
    site = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("https://x.example/"), "c_custkey")).otherwise("NOT_FOUND")
    register = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("row_no"), F.col("c_name").alias("full_name"), site.alias("website")
    )
    awards = table(spark, sf, "supplier").select(F.regexp_replace("s_name", "^Supplier", "CUSTOMER").alias("full_name"))
    return celebrants.website_queue(register, awards).select("row_no", "full_name", "is_priority")


@query(
    "top_for_places",
    """SELECT c_custkey AS row_no FROM customer
       ORDER BY CASE WHEN c_mktsegment = 'BUILDING' THEN 1000000 ELSE 0 END + c_acctbal DESC, c_custkey LIMIT 300""",
)
def top_for_places(spark: SparkSession, sf: str) -> DataFrame:
    won = F.when(F.col("c_mktsegment") == "BUILDING", "yes").when(F.col("c_nationkey") > 12, "No").otherwise("")
    register = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("row_no"), won.alias("abia_winner"), F.col("c_acctbal").cast("string").alias("data_quality_score")
    )
    return celebrants.top_for_places(register).select("row_no")


@query(
    "active_order",
    """SELECT c_custkey AS celebrant_id, c_nationkey::VARCHAR AS directory_listing_count FROM customer WHERE c_acctbal > 0
       ORDER BY CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE 50 END, c_acctbal DESC, c_nationkey DESC, c_custkey""",
)
def active_order(spark: SparkSession, sf: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("celebrant_id"),
        F.when(F.col("c_acctbal") > 0, "True").otherwise("no").alias("is_active_market"),
        F.when(segment == "BUILDING", "Premium").when(segment == "MACHINERY", " standard ").otherwise("other").alias("content_tier"),
        F.col("c_acctbal").cast("string").alias("easy_weddings_review_count"),
        F.col("c_nationkey").cast("string").alias("directory_listing_count"),
    )
    return celebrants.active_order(rows).select("celebrant_id", "directory_listing_count")


@query(
    "permits_to_check",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' OR o_custkey % 7 = 0""",
)
def permits_to_check(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.when(F.col("o_orderstatus") == "F", " ").otherwise("https://p.example").alias("permit_page_url"),
        F.when(F.col("o_custkey") % 7 != 0, "a@b.example").alias("contact_email"),
    )
    return councils.permits_to_check(orders).select("o_orderkey", "o_orderstatus")


@query(
    "back_patch",
    """SELECT c_custkey AS destination_id, COALESCE(p.url, CASE WHEN c_custkey % 3 = 0 THEN 'https://old.example' END) AS council_permit_url
       FROM customer LEFT JOIN (SELECT o_custkey, MAX(CASE WHEN o_orderstatus <> 'F' THEN 'https://p.example/' || o_orderkey END) AS url FROM orders GROUP BY 1) p
       ON c_custkey = p.o_custkey""",
)
def back_patch(spark: SparkSession, sf: str) -> DataFrame:
    """Several permits of a destination: one row each stays, patched by the greatest address."""
    targets = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("destination_id"), F.when(F.col("c_custkey") % 3 == 0, "https://old.example").alias("council_permit_url")
    )
    page = F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("https://p.example/"), "o_orderkey"))
    permits = table(spark, sf, "orders").select(F.col("o_custkey").alias("destination_id"), page.alias("permit_page_url"))
    return councils.back_patch(targets, permits)


@query(
    "pick_mixed",
    """SELECT c_custkey AS group_key, state_code FROM (
         SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN 'UNK' ELSE c_nationkey::VARCHAR END AS state_code,
                row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS turn FROM customer)
       ORDER BY turn, state_code LIMIT 60""",
)
def pick_mixed(spark: SparkSession, sf: str) -> DataFrame:
    groups = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("group_key"), F.when(F.col("c_nationkey") > 0, F.col("c_nationkey").cast("string")).alias("state_code")
    )
    return councils.pick_mixed(groups, 60).select("group_key", "state_code")


@query(
    "discovery_counts",
    """SELECT 'type' AS kind, c_mktsegment AS value, COUNT(*) AS n FROM customer GROUP BY 2
       UNION ALL SELECT 'trust', CASE WHEN c_acctbal > 0 THEN 'high' ELSE 'low' END, COUNT(*) FROM customer GROUP BY 2
       UNION ALL SELECT 'state', s, COUNT(*) FROM (SELECT unnest([c_nationkey::VARCHAR, 'ALL']) AS s FROM customer) GROUP BY 2""",
)
def discovery_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("source_type"),
        F.when(F.col("c_acctbal") > 0, "high").otherwise("low").alias("trust_level"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("|ALL")).alias("states"),
    )
    column = {"type": "source_type", "trust": "trust_level", "state": "state"}
    counted = influencers.discovery_counts(rows)
    named = [df.select(F.lit(kind).alias("kind"), F.col(column[kind]).alias("value"), "n") for kind, df in counted.items()]
    return reduce(lambda a, b: a.unionByName(b), named)


@query(
    "outreach_signals",
    """SELECT s_suppkey AS source_id, s_suppkey % 11 AS persona_fit_score,
              CASE WHEN s_suppkey % 11 >= 8 THEN 'p1_this_month' WHEN s_suppkey % 11 >= 6 THEN 'p2_this_quarter' ELSE 'p3_backlog' END AS outreach_priority,
              CASE WHEN s_nationkey < 8 THEN 'checklists' WHEN s_nationkey < 16 THEN 'budgets' ELSE 'general' END AS collab_angle,
              s_nationkey = 3 OR COALESCE(l.hook, FALSE) AS insurance_hook
       FROM supplier LEFT JOIN (SELECT l_suppkey, bool_or(l_quantity > 49) AS hook FROM lineitem GROUP BY 1) l ON s_suppkey = l_suppkey""",
)
def outreach_signals(spark: SparkSession, sf: str) -> DataFrame:
    nation = F.col("s_nationkey")
    sources = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("source_id"),
        (F.col("s_suppkey") % 11).alias("relevance_score"),
        F.when(nation < 8, "planning").when(nation < 16, "Budget").otherwise("flowers").alias("specialism_primary"),
        F.when(nation == 3, F.lit(True)).alias("insurance_hook"),
    )
    articles = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("source_id"), (F.col("l_quantity") > 49).alias("insurance_relevant")
    )
    return influencers.signals(sources, articles, {"planning": "checklists", "budget": "budgets"}, "general")
