"""Snapshots, windows, aggregates, rankings and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.functions import values as va
from gazetta.operators import aggregate as ag
from gazetta.operators import dedupe as dd
from gazetta.operators import gates, merge, score
from gazetta.plans.registry import cents, query, table

# -- snapshots --------------------------------------------------------------


def daily_snapshots(events: DataFrame) -> DataFrame:
    """One row per user and local day: mean value and number of events.

    Partial aggregation reduces a busy user to one row per day before the shuffle.
    """
    local = F.from_utc_timestamp("ts", "Australia/Sydney")
    return (
        events.groupBy("user_id", F.to_date(local).alias("period"))
        .agg(F.sum(cents("value")).alias("_c"), F.count("*").alias("review_count"))
        .select("user_id", "period", (F.col("_c") / F.col("review_count") / 100).alias("rating"), "review_count")
    )


# The whole table lies within Sydney summer time (UTC+11).
SNAPSHOTS = """
snaps AS (SELECT user_id, CAST(ts + INTERVAL 11 HOUR AS DATE) AS period,
                 CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) / 100 AS rating,
                 COUNT(*) AS review_count
          FROM events GROUP BY ALL)"""


@query(
    "snapshot_delta",
    f"""WITH {SNAPSHOTS}
    SELECT user_id, strftime(period, '%Y-%m-%d') AS period, rating, review_count,
           rating - lag(rating) OVER w AS rating_delta,
           review_count - lag(review_count) OVER w AS review_count_delta
    FROM snaps WINDOW w AS (PARTITION BY user_id ORDER BY period)""",
)
def snapshot_delta(spark: SparkSession, sf: str) -> DataFrame:
    snaps = daily_snapshots(table(spark, sf, "events"))
    out = dd.with_delta(snaps, ["user_id"], "period", ["rating", "review_count"])
    return out.withColumn("period", va.date_text("period"))


@query(
    "latest_before",
    f"""WITH {SNAPSHOTS}
    SELECT user_id, strftime(period, '%Y-%m-%d') AS period, rating, review_count FROM snaps
    WHERE period < DATE '2024-01-16'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY period DESC) = 1""",
)
def latest_before(spark: SparkSession, sf: str) -> DataFrame:
    snaps = daily_snapshots(table(spark, sf, "events"))
    out = dd.latest_before(snaps, ["user_id"], "period", F.lit("2024-01-16").cast("date"))
    return out.withColumn("period", va.date_text("period"))


@query(
    "month_period",
    """SELECT strftime(date_trunc('month', ts + INTERVAL 11 HOUR), '%Y-%m-%d') AS period,
              event_type, COUNT(*) AS n
       FROM events GROUP BY ALL""",
)
def month_period(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    out = ev.groupBy(merge.period_key("ts").alias("period"), "event_type").agg(F.count("*").alias("n"))
    return out.withColumn("period", va.date_text("period"))


@query(
    "previous_event",
    """SELECT event_id, lag(event_id) OVER w AS prev_event_id, lag(event_type) OVER w AS prev_event_type
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""",
)
def previous_event(spark: SparkSession, sf: str) -> DataFrame:
    """Unbounded groups: previous row per user, worked out block by block."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    out = dd.with_previous(
        ev, ["user_id"], "event_id", ["event_id", "event_type"], bounded=False, block=1 << 16
    )
    return out.select("event_id", "prev_event_id", "prev_event_type")


@query(
    "group_header_carry",
    """SELECT conv_id, turn, role,
              last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER w AS user_turn,
              last_value(CASE WHEN role = 'user' THEN length(text) END IGNORE NULLS) OVER w AS user_chars
       FROM conversations
       WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def group_header_carry(spark: SparkSession, sf: str) -> DataFrame:
    conv = table(spark, sf, "conversations")
    head = F.when(
        F.col("role") == "user",
        F.struct(F.col("turn").alias("user_turn"), F.length("text").cast("bigint").alias("user_chars")),
    )
    rows = conv.select("conv_id", "turn", "role", head.alias("_head"))
    out = dd.carry_forward(rows, ["conv_id"], "turn", "_head", "_h")
    return out.select("conv_id", "turn", "role", "_h.user_turn", "_h.user_chars")


# -- first and last per key -------------------------------------------------


@query(
    "dedupe_first",
    """SELECT doc_id, lang, source, n_chars FROM documents
       QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
)
def dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    """Exact copies by a 256-bit digest of the whole text: the text itself is not shuffled."""
    docs = table(spark, sf, "documents").select(
        "doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("_text")
    )
    return dd.keep_first(docs, ["_text"], ["doc_id"]).drop("_text")


@query(
    "dedupe_last",
    """SELECT page_id, regexp_replace(lower(regexp_extract(url, '(?i)^https?://([^/?#]*)', 1)), '^www\\.', '') AS host
       FROM pages QUALIFY row_number() OVER (PARTITION BY host ORDER BY page_id DESC) = 1""",
)
def dedupe_last(spark: SparkSession, sf: str) -> DataFrame:
    from gazetta.functions.urls import host_key

    pages = table(spark, sf, "pages").select("page_id", host_key("url").alias("host"))
    return dd.keep_last(pages, ["host"], ["page_id"])


@query(
    "top_k_per_group",
    """SELECT c_nationkey, c_custkey, c_acctbal,
              row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS place
       FROM customer QUALIFY place <= 5""",
)
def top_k_per_group(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    out = dd.top_k(cust, ["c_nationkey"], [F.desc("c_acctbal"), "c_custkey"], 5, rank="place")
    return out.withColumn("place", F.col("place").cast("bigint"))


@query(
    "round_robin_pick",
    """SELECT c_mktsegment, c_custkey, turn FROM (
         SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS turn FROM customer)
       ORDER BY turn, c_mktsegment LIMIT 37""",
)
def round_robin_pick(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer").select("c_mktsegment", "c_custkey")
    out = dd.round_robin(cust, "c_mktsegment", ["c_custkey"], 37)
    return out.withColumn("turn", F.col("turn").cast("bigint"))


@query(
    "group_sequence_ids",
    """SELECT c_custkey, printf('CUST-%d-%06d', c_nationkey,
                 row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey)) AS seq_id
       FROM customer""",
)
def group_sequence_ids(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    out = dd.sequence_ids(
        cust, ["c_nationkey"], ["c_custkey"], "CUST-%s-%06d", "seq_id", block=dd.BLOCK
    )
    return out.select("c_custkey", "seq_id")


@query(
    "ordered_sequence",
    """SELECT s_suppkey, printf('SUP-%06d', row_number() OVER (ORDER BY s_acctbal, s_suppkey)) AS seq_id
       FROM supplier""",
)
def ordered_sequence(spark: SparkSession, sf: str) -> DataFrame:
    """Numbering over the whole table in an order that is no whole number."""
    sup = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    out = dd.sequence_ids(sup, [], ["s_acctbal", "s_suppkey"], "SUP-%06d", "seq_id")
    return out.select("s_suppkey", "seq_id")


# -- aggregates -------------------------------------------------------------


@query("count_by_key", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def count_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return ag.count_by(table(spark, sf, "events"), "event_type")


@query(
    "multi_value_counts",
    """SELECT value, COUNT(*) AS n FROM (
         SELECT unnest(string_split(replace(lower(p_name), ' ', '|') || '|' || p_type, '|')) AS value FROM part)
       GROUP BY 1""",
)
def multi_value_counts(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    codes = F.concat_ws("|", F.replace(F.lower("p_name"), F.lit(" "), F.lit("|")), "p_type")
    return ag.count_values(part.select(codes.alias("codes")), F.split("codes", r"\|"))


@query(
    "distinct_sources",
    """SELECT user_id, COUNT(DISTINCT event_type) AS source_count,
              string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS sources,
              COUNT(DISTINCT event_type) > 0 AS is_active, COUNT(DISTINCT event_type) >= 2 AS is_multi_source
       FROM events GROUP BY 1""",
)
def distinct_sources(spark: SparkSession, sf: str) -> DataFrame:
    out = ag.sources_per_entity(table(spark, sf, "events"), "user_id", "event_type")
    return out.withColumn("source_count", F.col("source_count").cast("bigint"))


@query(
    "profile",
    """SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE event_type = 'error') AS errors,
              COUNT(*) FILTER (WHERE value >= 100) AS large,
              CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) AS mean_cents,
              100.0 * COUNT(*) FILTER (WHERE event_type = 'purchase') / COUNT(*) AS purchase_pct
       FROM events""",
)
def profile(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return ag.profile(
        ev,
        counts={"errors": F.col("event_type") == "error", "large": F.col("value") >= 100},
        averages={"mean_cents": cents("value")},
        shares={"purchase_pct": F.col("event_type") == "purchase"},
    )


@query(
    "outcome_counters",
    """SELECT COUNT(*) FILTER (WHERE value >= 85) AS high,
              COUNT(*) FILTER (WHERE value >= 70 AND value < 85) AS medium,
              COUNT(*) FILTER (WHERE value < 70) AS low FROM events""",
)
def outcome_counters(spark: SparkSession, sf: str) -> DataFrame:
    banded = table(spark, sf, "events").select(va.match_band("value").alias("outcome"))
    return ag.outcome_counts(banded, "outcome", ["HIGH", "MEDIUM", "LOW"])


@query(
    "worst_priority",
    """SELECT o_custkey, arg_max(o_orderpriority, r) AS o_orderpriority FROM (
         SELECT o_custkey, o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4
                WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 2 WHEN '5-LOW' THEN 1 ELSE 0 END AS r
         FROM orders) GROUP BY 1""",
)
def worst_priority(spark: SparkSession, sf: str) -> DataFrame:
    ranks = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 2, "5-LOW": 1}
    return ag.worst_of(table(spark, sf, "orders"), ["o_custkey"], "o_orderpriority", ranks)


@query(
    "max_suffix",
    """SELECT c_nationkey, COALESCE(MAX(CAST(regexp_extract(c_name, '([0-9]+)$', 1) AS BIGINT)), 0) AS max_seq
       FROM customer GROUP BY 1""",
)
def max_suffix(spark: SparkSession, sf: str) -> DataFrame:
    return ag.max_suffix(table(spark, sf, "customer"), ["c_nationkey"], "c_name")


@query(
    "any_flag",
    """SELECT source, COALESCE(bool_or(text LIKE '%@%'), FALSE) AS has_mail FROM documents GROUP BY 1""",
)
def any_flag(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return ag.any_flag(docs, ["source"], F.col("text").contains("@"), "has_mail")


@query(
    "coverage",
    """SELECT n.n_nationkey AS nation, n.expected, COALESCE(a.actual, 0) AS actual,
              greatest(n.expected - COALESCE(a.actual, 0), 0) AS missing,
              CAST(COALESCE(a.actual, 0) AS DOUBLE) / n.expected AS share
       FROM (SELECT n_nationkey, CAST(50 + n_regionkey * 10 AS BIGINT) AS expected FROM nation) n
       LEFT JOIN (SELECT c_nationkey, COUNT(*) AS actual FROM customer GROUP BY 1) a ON a.c_nationkey = n.n_nationkey""",
)
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    expected = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("nation"), (50 + F.col("n_regionkey") * 10).cast("bigint").alias("expected")
    )
    cust = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"))
    return ag.coverage(cust, expected, "nation")


@query(
    "group_members",
    """SELECT c_nationkey, COUNT(*) AS n_members, arg_min(c_name, c_custkey) AS first_c_name,
              arg_min(c_mktsegment, c_custkey) AS first_c_mktsegment
       FROM customer GROUP BY 1""",
)
def group_members(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer")
    return ag.group_members(cust, ["c_nationkey"], ["c_custkey"], ["c_name", "c_mktsegment"])


# -- scores and queues ------------------------------------------------------


@query(
    "quality_score",
    """SELECT c_custkey, CAST(round_even(least(
              COALESCE(r / 5.0 * 40.0, 0) + CASE WHEN o BETWEEN 0 AND 5 THEN o / 5.0 * 30.0 ELSE 0.0 END
              + least(CAST(n AS DOUBLE), 3.0) / 3.0 * 20.0
              + CASE WHEN c_mktsegment = 'BUILDING' THEN 10.0 ELSE 0.0 END, 100.0), 0) AS BIGINT) AS quality
       FROM (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal > 0 THEN c_acctbal / 2000 END AS r,
                    c_acctbal / 1000 AS o, c_nationkey % 6 AS n FROM customer)""",
)
def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    bal = F.col("c_acctbal")
    award = F.when(F.col("c_mktsegment") == "BUILDING", "yes")
    return table(spark, sf, "customer").select(
        "c_custkey",
        score.quality_score(F.when(bal > 0, bal / 2000), bal / 1000, F.col("c_nationkey") % 6, award).alias(
            "quality"
        ),
    )


@query(
    "award_top_n",
    """SELECT s_suppkey, CASE WHEN s_nationkey < 5 THEN 1000000.0 ELSE 0.0 END + s_acctbal AS award_score
       FROM supplier ORDER BY award_score DESC, s_suppkey LIMIT 30""",
)
def award_top_n(spark: SparkSession, sf: str) -> DataFrame:
    won = F.when(F.col("s_nationkey") < 5, "2025 winner").when(F.col("s_nationkey") < 10, "no")
    sup = table(spark, sf, "supplier").select(
        "s_suppkey", score.award_score(won, F.col("s_acctbal")).alias("award_score")
    )
    return score.top_n(sup, "award_score", ["s_suppkey"], 30)


@query(
    "scored_top_n",
    """SELECT p_partkey, score FROM (
         SELECT p_partkey, 40 * (CAST(contains(b, 'red ring') AS INT) + CAST(contains(b, 'small') AS INT) + CAST(contains(b, 'anvil') AS INT))
              + 6 * (CAST(contains(b, 'wine') AS INT) + CAST(contains(b, 'valley') AS INT) + CAST(contains(b, 'coast') AS INT)
                   + CAST(contains(b, 'island') AS INT) + CAST(contains(b, 'hinterland') AS INT) + CAST(contains(b, 'mountain') AS INT)
                   + CAST(contains(b, 'historic') AS INT) + CAST(contains(b, 'peninsula') AS INT) + CAST(contains(b, 'ranges') AS INT))
              + CASE WHEN p_retailprice > 1000 THEN 15 ELSE 0 END - CASE WHEN p_size <= 1 THEN 500 ELSE 0 END AS score
         FROM (SELECT *, lower(p_type) || ' ' || lower(p_name) AS b FROM part))
       WHERE score >= -400 ORDER BY score DESC, p_partkey LIMIT 40""",
)
def scored_top_n(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    points = score.destination_score(
        "p_type", "p_name", "p_size", F.col("p_retailprice") > 1000, ("red ring", "small", "anvil")
    )
    picked = score.pick_scored(part.select("p_partkey", points.alias("points")), F.col("points"), ["p_partkey"])
    return picked.select("p_partkey", "score")


@query(
    "tier_order",
    """SELECT p_partkey, CAST(CASE lower(p_type) WHEN 'premium' THEN 1 WHEN 'standard' THEN 2 ELSE 50 END AS BIGINT) AS tier, p_retailprice
       FROM part ORDER BY tier, p_retailprice DESC NULLS LAST, p_partkey""",
)
def tier_order(spark: SparkSession, sf: str) -> DataFrame:
    """The whole list in its order."""
    part = table(spark, sf, "part").select(
        "p_partkey", "p_type", "p_retailprice", score.tier_rank("p_type").cast("bigint").alias("tier")
    )
    return score.tier_order(part, "p_type", ["p_retailprice"], ["p_partkey"]).select("p_partkey", "tier", "p_retailprice")


@query(
    "priority_queue",
    """SELECT c.c_custkey, s.s_name IS NOT NULL AS is_priority
       FROM customer c LEFT JOIN (SELECT DISTINCT regexp_replace(s_name, '^Supplier', 'Customer') AS s_name FROM supplier) s
       ON lower(c.c_name) = lower(s.s_name)
       ORDER BY is_priority DESC, c.c_custkey""",
)
def priority_queue(spark: SparkSession, sf: str) -> DataFrame:
    from gazetta.functions.text import squash_name
    from gazetta.operators.link import flag_members

    cust, sup = table(spark, sf, "customer"), table(spark, sf, "supplier")
    listed = sup.select(F.regexp_replace("s_name", "^Supplier", "Customer").alias("s_name"))
    flagged = flag_members(
        cust.select("c_custkey", "c_name"), listed, squash_name("c_name"), squash_name("s_name"), "listed"
    )
    return score.priority_queue(flagged, F.col("listed"), ["c_custkey"]).select("c_custkey", "is_priority")


@query(
    "work_list",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P' ORDER BY o_totalprice DESC, o_orderkey LIMIT 50",
)
def work_list(spark: SparkSession, sf: str) -> DataFrame:
    todo = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select("o_orderkey", "o_totalprice")
    return score.work_list(todo, [F.desc("o_totalprice"), "o_orderkey"], 50)


@query(
    "pending_rows",
    """SELECT d.doc_id, d.source FROM documents d LEFT JOIN labels l USING (doc_id)
       WHERE d.lang = 'en' AND l.quality IS NULL""",
)
def pending_rows(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    joined = docs.select("doc_id", "source", (F.col("lang") == "en").alias("is_active")).join(labels, "doc_id", "left")
    return gates.pending(joined, "is_active", "quality").select("doc_id", "source")


# -- set operations ---------------------------------------------------------


@query(
    "union_defaults",
    """SELECT 'C' || c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation FROM customer
       UNION ALL SELECT 'S' || s_suppkey, s_name, 'VERIFY_REQUIRED', s_nationkey FROM supplier""",
)
def union_defaults(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
    )
    sup = table(spark, sf, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
    )
    return dd.union_with_defaults(cust, sup, {"segment": va.VERIFY_REQUIRED})


@query(
    "key_union",
    """SELECT DISTINCT k FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier
       UNION ALL SELECT n_nationkey FROM nation)""",
)
def key_union(spark: SparkSession, sf: str) -> DataFrame:
    return dd.key_union(
        table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")),
        table(spark, sf, "supplier").select("s_nationkey"),
        table(spark, sf, "nation").select("n_nationkey"),
    )


@query(
    "known_difference",
    """SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def known_difference(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return dd.not_known(docs, table(spark, sf, "labels"), ["doc_id"])
