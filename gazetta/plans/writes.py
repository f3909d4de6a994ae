"""Keyed writes, expectations, file round trips and streams on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetta.functions import urls as ur
from gazetta.functions import values as va
from gazetta.operators import dedupe as dd
from gazetta.operators import merge, quality
from gazetta.plans.columns import NORM
from gazetta.plans.registry import cents, query, table
from gazetta.session import work_path
from gazetta.sources import files, tables
from gazetta.streaming import keyed

# -- merges -----------------------------------------------------------------


def _suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.lit("supplier").alias("origin"),
    )


def _customer_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as updates of the supplier directory; some names are unknown."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("name"),
        F.col("c_nationkey").alias("nation"),
    )


@query(
    "upsert",
    """SELECT COALESCE(s.s_suppkey, c.c_custkey) AS id,
              CASE WHEN c.c_custkey IS NULL THEN s.s_name WHEN c.c_mktsegment <> 'BUILDING' THEN c.c_name END AS name,
              CASE WHEN c.c_custkey IS NULL THEN s.s_nationkey ELSE c.c_nationkey END AS nation,
              CASE WHEN s.s_suppkey IS NOT NULL THEN 'supplier' END AS origin
       FROM supplier s FULL JOIN customer c ON c.c_custkey = s.s_suppkey""",
)
def upsert(spark: SparkSession, sf: str) -> DataFrame:
    return merge.upsert(_suppliers(spark, sf), _customer_updates(spark, sf), ["id"])


@query(
    "upsert_last_wins",
    """SELECT COALESCE(c.c_custkey, o.o_custkey) AS id, COALESCE(o.p, c.c_mktsegment) AS label
       FROM customer c FULL JOIN (SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS p
                                  FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey""",
)
def upsert_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    target = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("label")
    )
    updates = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("label"), "o_orderdate", "o_orderkey"
    )
    return merge.upsert(target, updates, ["id"], ["o_orderdate", "o_orderkey"])


_SEEN = "(SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type IN ('view', 'click'))"


def _user_days(events: DataFrame, kinds: list[str]) -> DataFrame:
    return events.filter(F.col("event_type").isin(*kinds)).select(
        "user_id", F.to_date("ts").alias("day"), "event_id", "event_type"
    )


@query(
    "insert_only",
    f"""SELECT u.user_id, strftime(u.day, '%Y-%m-%d') AS day, u.event_id, u.event_type
        FROM (SELECT user_id, CAST(ts AS DATE) AS day, event_id, event_type FROM events
              WHERE event_type IN ('signup', 'error', 'purchase')
              QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) = 1) u
        LEFT JOIN {_SEEN} t ON t.user_id = u.user_id AND t.day = u.day WHERE t.user_id IS NULL""",
)
def insert_only(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots of three kinds of events into a table that has those of the other two."""
    ev = table(spark, sf, "events")
    target = _user_days(ev, ["view", "click"])
    updates = _user_days(ev, ["signup", "error", "purchase"])
    out = merge.insert_only(target, updates, ["user_id", "day"], ["event_id"])
    return out.withColumn("day", va.date_text("day"))


@query(
    "insert_report",
    f"""WITH u AS (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events
                  WHERE event_type IN ('signup', 'error', 'purchase') GROUP BY ALL)
        SELECT COUNT(*) FILTER (WHERE t.user_id IS NULL) AS inserted,
               CAST(SUM(n) AS BIGINT) - COUNT(*) FILTER (WHERE t.user_id IS NULL) AS skipped
        FROM u LEFT JOIN {_SEEN} t ON t.user_id = u.user_id AND t.day = u.day""",
)
def insert_report(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    target = _user_days(ev, ["view", "click"])
    return merge.insert_report(target, _user_days(ev, ["signup", "error", "purchase"]), ["user_id", "day"])


@query(
    "patch_non_null",
    """SELECT l.doc_id, CASE WHEN d.n_chars >= 500 THEN 1 ELSE l.quality END AS quality,
              CASE WHEN d.lang = 'de' THEN 0 ELSE l.toxic END AS toxic
       FROM labels l LEFT JOIN documents d USING (doc_id)""",
)
def patch_non_null(spark: SparkSession, sf: str) -> DataFrame:
    patch = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("n_chars") >= 500, 1).alias("quality"), F.when(F.col("lang") == "de", 0).alias("toxic")
    )
    return merge.patch_non_null(table(spark, sf, "labels"), patch, ["doc_id"])


@query(
    "fill_gaps",
    """SELECT id, CASE WHEN blank AND filled THEN c_name ELSE raw END AS name,
              CASE WHEN c_custkey IS NOT NULL THEN CAST(c_nationkey AS VARCHAR) ELSE CAST(s_nationkey AS VARCHAR) END AS nation,
              CASE WHEN (blank AND filled) OR (c_custkey IS NOT NULL AND c_nationkey <> s_nationkey) THEN '2024-01-01 00:00:00' END AS updated_at
       FROM (SELECT s.s_suppkey AS id, CASE WHEN s.s_nationkey < 12 THEN 'n/a' ELSE s.s_name END AS raw, s.s_nationkey < 12 AS blank,
                    c.c_mktsegment <> 'BUILDING' AS filled, c.*, s.s_nationkey
             FROM supplier s LEFT JOIN customer c ON c.c_custkey = s.s_suppkey)""",
)
def fill_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Blank names are filled, the nation always follows, unchanged rows keep no stamp."""
    target = _suppliers(spark, sf).select(
        "id",
        F.when(F.col("nation") < 12, "n/a").otherwise(F.col("name")).alias("name"),
        F.col("nation").cast("string").alias("nation"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )
    updates = _customer_updates(spark, sf).withColumn("nation", F.col("nation").cast("string"))
    stamp = ("updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    out = merge.fill_gaps(target, updates, ["id"], always=["nation"], stamp=stamp)
    return out.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))


_KEYED = "regexp_replace(lower(regexp_extract(url, '(?i)^https?://([^/?#]*)', 1)), '^www\\.', '')"


@query(
    "natural_key_upsert",
    f"""WITH p AS (SELECT page_id, url, {_KEYED} AS host, url LIKE 'https:%' AS secure FROM pages),
    tgt AS (SELECT host, MIN(page_id) AS first_page FROM p WHERE secure GROUP BY 1),
    upd AS (SELECT host, MIN(page_id) AS first_page, contains(arg_min(url, page_id), '/en/') AS english FROM p WHERE NOT secure GROUP BY 1),
    top AS (SELECT MAX(first_page) AS m FROM tgt)
    SELECT printf('SITE-%05d', t.first_page) AS site_id, t.host AS site,
           COALESCE(CASE WHEN u.english THEN u.first_page END, t.first_page) AS page FROM tgt t LEFT JOIN upd u USING (host)
    UNION ALL
    SELECT printf('SITE-%05d', row_number() OVER (ORDER BY u.first_page) + (SELECT m FROM top)), u.host,
           CASE WHEN u.english THEN u.first_page END FROM upd u WHERE u.host NOT IN (SELECT host FROM tgt)""",
)
def natural_key_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Sites known from secure pages, updated by the others; the host is the natural key."""
    pages = table(spark, sf, "pages").select("page_id", "url", ur.host_key("url").alias("site"))
    secure = F.col("url").startswith("https:")
    first = dd.keep_first(pages.filter(secure), ["site"], ["page_id"])
    target = first.select(
        F.format_string("SITE-%05d", "page_id").alias("site_id"), "site", F.col("page_id").alias("page")
    )
    updates = pages.filter(~secure).select(
        "site", F.when(F.col("url").contains("/en/"), F.col("page_id")).alias("page"), F.col("page_id").alias("seen")
    )
    return merge.natural_key_upsert(
        target, updates, "site_id", "site", lambda c: F.col(c), "seen", "SITE-%05d"
    )


@query(
    "insert_defaults",
    """SELECT 'TLIST-' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS listing_id, s_name AS listing_name,
              CASE WHEN s_nationkey < 10 THEN 'other' ELSE 'supplier' END AS listing_type, '' AS address, FALSE AS is_relevant
       FROM supplier""",
)
def insert_defaults(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "supplier").select(
        F.concat(F.lit("TLIST-"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("listing_id"),
        F.col("s_name").alias("listing_name"),
        F.when(F.col("s_nationkey") >= 10, "supplier").alias("listing_type"),
    )
    return merge.with_defaults(rows, {"listing_type": "other", "address": "", "is_relevant": False})


@query(
    "audit_stamp",
    """SELECT id, name, nation, CASE WHEN s_suppkey IS NULL OR name IS DISTINCT FROM s_name OR nation <> s_nationkey
                THEN '2024-02-01' ELSE '2024-01-01' END AS updated_at
       FROM (SELECT s.*, COALESCE(s.s_suppkey, c.c_custkey) AS id,
                    CASE WHEN c.c_custkey IS NULL THEN s.s_name WHEN c.c_mktsegment <> 'BUILDING' THEN c.c_name END AS name,
                    COALESCE(c.c_nationkey, s.s_nationkey) AS nation
             FROM supplier s FULL JOIN customer c ON c.c_custkey = s.s_suppkey)""",
)
def audit_stamp(spark: SparkSession, sf: str) -> DataFrame:
    before = _suppliers(spark, sf).drop("origin").withColumn("updated_at", F.lit("2024-01-01"))
    after = merge.upsert(before, _customer_updates(spark, sf), ["id"])
    return merge.stamp_changes(before, after, ["id"], "updated_at", F.lit("2024-02-01"))


@query(
    "change_set",
    """SELECT COALESCE(c.c_custkey, s.s_suppkey) AS id,
              CASE WHEN s.s_suppkey IS NULL THEN 'insert' WHEN c.c_custkey IS NULL THEN 'delete' ELSE 'update' END AS action,
              s.s_nationkey AS old_nation, c.c_nationkey AS new_nation
       FROM supplier s FULL JOIN customer c ON c.c_custkey = s.s_suppkey
       WHERE s.s_suppkey IS NULL OR c.c_custkey IS NULL OR s.s_nationkey <> c.c_nationkey""",
)
def change_set(spark: SparkSession, sf: str) -> DataFrame:
    """What replacing the suppliers' nations by the customers' would do, without doing it."""
    before = _suppliers(spark, sf).select("id", "nation")
    after = _customer_updates(spark, sf).select("id", "nation")
    out = merge.change_set(before, after, ["id"])
    return out.select(
        "id", "action", F.col("before.nation").alias("old_nation"), F.col("after.nation").alias("new_nation")
    )


# -- expectations -----------------------------------------------------------


@query(
    "violations",
    """SELECT o_orderkey, rule FROM (
         SELECT o_orderkey, unnest(list_filter([
           CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') THEN 'priority_enum' END,
           CASE WHEN o_totalprice < 5000 OR o_totalprice > 400000 THEN 'price_range' END,
           CASE WHEN o_custkey IS NULL THEN 'customer_set' END], lambda x: x IS NOT NULL)) AS rule FROM orders)""",
)
def violations(spark: SparkSession, sf: str) -> DataFrame:
    rules = {
        "priority_enum": quality.one_of(
            "o_orderpriority", ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
        ),
        "price_range": quality.in_range("o_totalprice", 5000, 400000),
        "customer_set": quality.not_null("o_custkey"),
    }
    return quality.violations(table(spark, sf, "orders"), ["o_orderkey"], rules)


@query(
    "key_uniqueness",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def key_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# -- files and tables -------------------------------------------------------


@query(
    "table_scan",
    "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01' AND l_returnflag = 'R'",
)
def table_scan(spark: SparkSession, sf: str) -> DataFrame:
    wanted = (F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp")) & (F.col("l_returnflag") == "R")
    return files.scan(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_partkey"], wanted)


@query(
    "csv_strings",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE 'a, "' || c_mktsegment || '"' END AS label,
              'VERIFY_REQUIRED' AS status FROM customer""",
)
def csv_strings(spark: SparkSession, sf: str) -> DataFrame:
    """CSV out and back: text columns, quotes and empty values kept, schema conformed."""
    label = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(
        F.concat(F.lit('a, "'), "c_mktsegment", F.lit('"'))
    )
    path = work_path(spark, "csv")
    rows = table(spark, sf, "customer").withColumn("label", label)
    files.write_csv(rows, ["c_custkey", "label", "c_name"], path)
    return files.conform(files.read_csv_strings(spark, path), ["c_custkey", "label", "status"])


@query(
    "json_arrays",
    """SELECT c_custkey, c_name, c_mktsegment FROM customer
       UNION ALL SELECT -s_suppkey, s_name, NULL FROM supplier WHERE s_suppkey % 2 = 0""",
)
def json_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Files of one JSON array each, read back, with seed rows of which the incomplete ones are left out."""
    path = work_path(spark, "arrays")
    files.write_json_arrays(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), path)
    schema = T.StructType.fromDDL("c_custkey bigint, c_name string, c_mktsegment string")
    read = files.read_json_array(spark, path, schema).select("c_custkey", "c_name", "c_mktsegment")
    name = F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).otherwise(" ")
    seed = table(spark, sf, "supplier").select((-F.col("s_suppkey")).cast("bigint").alias("c_custkey"), name.alias("c_name"))
    return files.with_seed(read, seed, ["c_name"])


@query(
    "key_list_file",
    f"SELECT DISTINCT {NORM} AS url_key FROM pages ORDER BY url_key",
)
def key_list_file(spark: SparkSession, sf: str) -> DataFrame:
    """Page addresses written as a key list and read back."""
    path = work_path(spark, "keys")
    pages = table(spark, sf, "pages").select("url")
    files.write_keys(pages.unionByName(spark.createDataFrame([("# comment",), (" ",)], "url string")), "url", path)
    return files.read_keys(spark, path)


@query(
    "headers",
    """SELECT c_custkey AS "KEY", c_name AS "FULL NAME", c_acctbal AS "BALANCE" FROM customer""",
)
def headers(spark: SparkSession, sf: str) -> DataFrame:
    messy = table(spark, sf, "customer").select(
        F.col("c_custkey").alias(" key "), F.col("c_name").alias("Full Name"), F.col("c_acctbal").alias("\tbalance ")
    )
    return va.tidy_headers(messy)


@query(
    "jsonl_append",
    """SELECT doc_id, lang, source FROM documents UNION ALL SELECT doc_id, NULL, 'labels' FROM labels""",
)
def jsonl_append(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "jsonl")
    files.append_jsonl(table(spark, sf, "documents").select("doc_id", "lang", "source"), path)
    late = table(spark, sf, "labels").select("doc_id", F.lit(None).cast("string").alias("lang"), F.lit("labels").alias("source"))
    files.append_jsonl(late, path)
    return spark.read.schema("doc_id bigint, lang string, source string").json(path)


@query(
    "outcome_log",
    """SELECT event_id, CASE WHEN value >= 85 THEN 'HIGH' WHEN value >= 70 THEN 'MEDIUM' ELSE 'LOW' END AS outcome FROM events""",
)
def outcome_log(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "outcomes")
    rows = table(spark, sf, "events").select("event_id", va.match_band("value").alias("outcome"))
    files.write_outcomes(rows, "outcome", path)
    return spark.read.schema("event_id bigint, outcome string").json(path)


@query(
    "versioned_table",
    """SELECT COALESCE(s.s_suppkey, c.c_custkey) AS id, COALESCE(c.c_nationkey, s.s_nationkey) AS nation
       FROM supplier s FULL JOIN customer c ON c.c_custkey = s.s_suppkey""",
)
def versioned_table(spark: SparkSession, sf: str) -> DataFrame:
    """Two published versions; the second one is read back."""
    root = work_path(spark, "table")
    tables.write_table(_suppliers(spark, sf).select("id", "nation"), root)
    updates = _customer_updates(spark, sf).select("id", "nation")
    tables.write_table(merge.upsert(tables.read_table(spark, root), updates, ["id"]), root)
    return tables.read_table(spark, root)


@query(
    "resumable_work",
    "SELECT doc_id, n_chars * 2 AS doubled FROM documents",
)
def resumable_work(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents first; the second run does only what is left."""
    path = work_path(spark, "done")
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    first = docs.join(table(spark, sf, "labels"), "doc_id", "left_semi")

    def step(df: DataFrame) -> DataFrame:
        return df.select("doc_id", (F.col("n_chars") * 2).alias("doubled"))

    keyed.process_pending(first, path, ["doc_id"], step)
    return keyed.process_pending(docs, path, ["doc_id"], step)


# -- streams ----------------------------------------------------------------


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a file stream (a pattern, as the source expects folders or patterns)."""
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/events*.parquet")


@query(
    "stream_insert_only",
    "SELECT DISTINCT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day FROM events",
)
def stream_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    """Native state store variant: one row per user and day."""
    stream = _event_stream(spark, sf).select("user_id", F.date_trunc("day", "ts").alias("day"))
    path = work_path(spark, "stream-rows")
    run = keyed.stream_insert_only(
        stream, ["user_id"], "day", "40 days", path, work_path(spark, "stream-state")
    )
    run.awaitTermination()
    out = spark.read.parquet(path)
    return out.select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query(
    "stream_insert_only_table",
    """SELECT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, MIN(event_id) AS event_id FROM events GROUP BY ALL""",
)
def stream_insert_only_table(spark: SparkSession, sf: str) -> DataFrame:
    stream = _event_stream(spark, sf).select("user_id", F.to_date("ts").alias("day"), "event_id")
    root = work_path(spark, "stream-table")
    run = keyed.stream_insert_only_table(
        stream, ["user_id"], "day", ["event_id"], root, work_path(spark, "stream-state")
    )
    run.awaitTermination()
    return spark.read.parquet(root).select("user_id", va.date_text("day").alias("day"), "event_id")


@query(
    "stream_upsert",
    """SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(CAST(round(value * 100) AS BIGINT), event_id) AS value_cents
       FROM events GROUP BY 1""",
)
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    stream = _event_stream(spark, sf).select("user_id", "event_type", cents("value").alias("value_cents"), "event_id")
    root = work_path(spark, "stream-upsert")
    run = keyed.stream_upsert(stream, ["user_id"], "event_id", root, work_path(spark, "stream-state"))
    run.awaitTermination()
    keyed.compact(spark, root, ["user_id"])
    return keyed.read_upserted(spark, root, ["user_id"])
