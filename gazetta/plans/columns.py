"""Column functions on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.functions import payloads as pl
from gazetta.functions import text as tx
from gazetta.functions import urls as ur
from gazetta.functions import values as va
from gazetta.operators import gates
from gazetta.plans.registry import query, table
from gazetta.sources.files import clean_keys

# -- URLs -------------------------------------------------------------------

_PARTS = "'(?i)^(https?)://([^/?#]*)([^?#]*)'"
NORM = f"""(lower(regexp_extract(url, {_PARTS}, 1)) || '://' || regexp_replace(lower(regexp_extract(url, {_PARTS}, 2)), '^www\\.', '')
    || regexp_replace(regexp_replace(regexp_extract(url, {_PARTS}, 3), ';[^/]*$', ''), '/+$', ''))"""


@query("norm_url", f"SELECT page_id, {NORM} AS url_key FROM pages")
def norm_url(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", ur.norm_url("url").alias("url_key"))


@query(
    "root_domain",
    f"""SELECT page_id, regexp_replace(lower(regexp_extract(url, {_PARTS}, 2)), '^www\\.', '') AS domain,
               lower(regexp_extract(url, {_PARTS}, 1)) || '://' || regexp_extract(url, {_PARTS}, 2) || '/' AS home,
               CASE WHEN lower(regexp_extract(url, {_PARTS}, 2)) LIKE '%.example.org' THEN 'public' ELSE 'other' END AS host_class
        FROM pages""",
)
def root_domain(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        "page_id",
        ur.root_domain("url").alias("domain"),
        ur.origin_home("url").alias("home"),
        ur.host_class("url", "example.org").alias("host_class"),
    )


@query("key_list", f"SELECT DISTINCT {NORM} AS url_key FROM pages")
def key_list(spark: SparkSession, sf: str) -> DataFrame:
    return clean_keys(table(spark, sf, "pages").select(F.col("url").alias("value")))


@query(
    "social_profiles",
    """SELECT c_custkey, 'https://www.instagram.com/' || replace(c_name, '#', '_') || '/' AS instagram,
              CASE c_mktsegment WHEN 'BUILDING' THEN 'NOT_FOUND' ELSE 'https://www.facebook.com/' || lower(c_mktsegment) || '/' END AS facebook,
              CASE WHEN c_nationkey < 5 THEN 'NOT_FOUND' ELSE c_custkey || '@mail.example' END AS email,
              CASE WHEN c_nationkey < 5 THEN 'https://www.site.example' WHEN c_nationkey < 10 THEN 'http://site.example' ELSE 'NOT_FOUND' END AS site
       FROM customer""",
)
def social_profiles(spark: SparkSession, sf: str) -> DataFrame:
    nation = F.col("c_nationkey")
    handle = F.concat(F.lit("@"), F.replace(F.col("c_name"), F.lit("#"), F.lit("_")))
    page = F.when(F.col("c_mktsegment") == "BUILDING", "not found").otherwise(F.lower("c_mktsegment"))
    mail = F.concat("c_custkey", F.when(nation < 5, "@mail").otherwise("@mail.example"))
    site = F.when(nation < 5, "www.site.example").when(nation < 10, "http://site.example").otherwise("site")
    return table(spark, sf, "customer").select(
        "c_custkey",
        ur.social_profile(handle, "instagram").alias("instagram"),
        ur.social_profile(page, "facebook").alias("facebook"),
        ur.clean_email(mail).alias("email"),
        ur.clean_link(site).alias("site"),
    )


# -- text -------------------------------------------------------------------

_MAIL = r"([A-Za-z0-9_.+\-]+@[A-Za-z0-9\-]+\.[A-Za-z0-9.\-]+)"
_PHONE = r"\+1 \(\d{3}\) \d{3}-\d{4}"


@query(
    "text_extract",
    rf"""SELECT doc_id, CAST(len(list_distinct(regexp_extract_all(text, '{_MAIL}', 1))) AS BIGINT) AS n_emails,
               NULLIF(regexp_extract(text, '{_MAIL}', 1), '') AS first_email,
               NULLIF(regexp_extract(text, '({_PHONE})', 1), '') AS first_phone,
               NULLIF(regexp_extract(text, '\b(\d{{4}})\b', 1), '') AS postcode,
               regexp_extract_all(text, '\b(\d{{4}})\b', 1)[-1] AS last_postcode,
               TRY_CAST(regexp_extract(text, '(?i)(\d+)\s*the?s?\b', 1) AS BIGINT) AS counted,
               regexp_matches(lower(text), 'token|license|password') AS flagged
        FROM documents""",
)
def text_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Contacts and codes in the whole text of every document."""
    return table(spark, sf, "documents").withColumn("mails", tx.emails("text")).select(
        "doc_id",
        F.size("mails").cast("bigint").alias("n_emails"),
        F.get("mails", F.lit(0)).alias("first_email"),
        F.get(tx.mobiles("text", _PHONE), F.lit(0)).alias("first_phone"),
        tx.postcode("text").alias("postcode"),
        tx.postcode("text", "last").alias("last_postcode"),
        tx.counter("text", "the?").alias("counted"),
        va.has_any("text", ("token", "license", "password")).alias("flagged"),
    )


@query(
    "names",
    r"""SELECT p_partkey, lower(p_type) || ' ' || p_name AS squashed,
              trim(regexp_replace(lower(p_brand || ' / ' || p_name), '[^a-z0-9]+', ' ', 'g')) AS plain,
              array_to_string(list_sort(string_split(trim(regexp_replace(lower(p_name || ' ' || p_type), '[^a-z0-9]+', ' ', 'g')), ' ')), ' ') AS token_key,
              substr('ID-' || regexp_replace(p_brand || '-' || p_name, '[^A-Za-z0-9]+', '-', 'g'), 1, 14) AS slug,
              p_name AS bare, p_name AS titled, regexp_extract(p_brand, '(\d+)$', 1) AS suffix,
              lpad(regexp_extract(p_brand, '(\d+)$', 1), 3, '0') AS padded
       FROM part""",
)
def names(spark: SparkSession, sf: str) -> DataFrame:
    name, kind, brand = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    return table(spark, sf, "part").select(
        "p_partkey",
        tx.squash_name(F.concat(F.lit("  "), kind, F.lit(" \t "), name)).alias("squashed"),
        tx.plain_name(F.concat(brand, F.lit(" / "), name)).alias("plain"),
        tx.token_key(F.concat(name, F.lit(" "), kind)).alias("token_key"),
        tx.slug_id(F.concat(brand, F.lit("-"), name), "ID-", 14).alias("slug"),
        tx.drop_parenthetical(F.concat(name, F.lit(" ("), kind, F.lit(")"))).alias("bare"),
        tx.drop_site_suffix(F.concat(name, F.lit(" - SITE "), kind), "SITE").alias("titled"),
        tx.id_suffix(brand).alias("suffix"),
        tx.padded_suffix(brand).alias("padded"),
    )


@query(
    "code_lists",
    """SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'NSW|VIC|QLD|WA|SA|TAS|NT|ACT'
                 WHEN p_type = 'SMALL' THEN NULL ELSE upper(replace(p_name, ' ', '|')) || '|' || p_type END AS codes,
              CASE WHEN p_name LIKE '%ring' THEN 'VIC' WHEN p_name LIKE 'red%' THEN 'QLD' WHEN p_name LIKE '%anvil' THEN 'TAS' END AS region
       FROM part""",
)
def code_lists(spark: SparkSession, sf: str) -> DataFrame:
    name, kind = F.col("p_name"), F.col("p_type")
    raw = (
        F.when(kind == "PROMO", " all ")
        .when(kind == "SMALL", " ; ,")
        .otherwise(F.concat(F.replace(name, F.lit(" "), F.lit(" ; ")), F.lit(","), kind))
    )
    prose = F.concat(
        F.when(name.endswith("ring"), "in VIC or ").otherwise(""),
        F.when(name.startswith("red"), "queensland ").otherwise(""),
        F.when(name.endswith("anvil"), "Tasmania").otherwise("abroad"),
    )
    return table(spark, sf, "part").select(
        "p_partkey", tx.code_list_text(raw).alias("codes"), tx.region_code(prose).alias("region")
    )


@query(
    "prices",
    """SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS price,
              (CAST(floor(o_totalprice) AS DOUBLE) + o_custkey) / 2 AS range_fee,
              (CAST(floor(o_totalprice) AS DOUBLE) + o_custkey + o_orderkey) / 3 AS mean_fee
       FROM orders""",
)
def prices(spark: SparkSession, sf: str) -> DataFrame:
    whole = F.floor("o_totalprice")
    money = F.concat(F.lit("from $ "), F.format_number(whole, 0), F.lit(" up"))
    ranged = F.concat(F.lit("$"), whole, F.lit(" - $"), F.col("o_custkey"), F.lit(" per day"))
    listed = F.concat_ws(" or ", whole, "o_custkey", "o_orderkey")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        tx.price(money).alias("price"),
        tx.fee_amount(ranged).alias("range_fee"),
        tx.fee_amount(listed).alias("mean_fee"),
    )


# -- values -----------------------------------------------------------------


@query(
    "casts",
    """SELECT event_id, CAST(trunc(value) AS BIGINT) AS via_float, CASE WHEN value = trunc(value) THEN CAST(value AS BIGINT) END AS strict,
              CAST(floor(value) AS BIGINT) AS digits, CASE WHEN event_type <> 'error' THEN value END AS number,
              CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) AS postcode,
              CASE event_type WHEN 'click' THEN TRUE WHEN 'view' THEN TRUE WHEN 'error' THEN FALSE END AS tri,
              CASE event_type WHEN 'click' THEN TRUE WHEN 'signup' THEN TRUE ELSE FALSE END AS flag,
              strftime(ts, '%Y-%m-%d') AS day, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS moment
       FROM events""",
)
def casts(spark: SparkSession, sf: str) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    text = F.format_string("%.2f", value)
    tri = F.when(kind == "click", "Yes ").when(kind == "view", "1").when(kind == "error", "FALSE").otherwise("maybe")
    flag = F.when(kind == "click", "Y").when(kind == "signup", "").when(kind == "view", "off").otherwise("no")
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return table(spark, sf, "events").select(
        "event_id",
        va.to_int(text).alias("via_float"),
        va.to_int(F.regexp_replace(text, r"\.00$", ""), "strict").alias("strict"),
        va.to_int(F.concat(F.floor(value), F.lit(" days")), "digits").alias("digits"),
        va.to_float(F.when(kind == "error", "nan").otherwise(text)).alias("number"),
        va.postcode_text(F.concat(F.get_json_object("props", "$.k"), F.lit(".0"))).alias("postcode"),
        va.to_bool(tri).alias("tri"),
        va.to_bool(flag, "default", True).alias("flag"),
        va.date_text(va.date_prefix(iso)).alias("day"),
        F.date_format(va.iso_timestamp(iso), "yyyy-MM-dd HH:mm:ss").alias("moment"),
    )


@query(
    "bands",
    """SELECT event_id, CASE WHEN value >= 85 THEN 'HIGH' WHEN value >= 70 THEN 'MEDIUM' ELSE 'LOW' END AS match,
              CASE WHEN k >= 80 THEN 'p1_this_month' WHEN k >= 60 THEN 'p2_this_quarter' ELSE 'p3_backlog' END AS outreach,
              CASE WHEN value > 1 THEN CASE WHEN value >= 67 THEN 'high' WHEN value >= 34 THEN 'medium' ELSE 'low' END
                   ELSE CASE WHEN value >= 0.67 THEN 'high' WHEN value >= 0.34 THEN 'medium' ELSE 'low' END END AS confidence,
              CASE event_type WHEN 'click' THEN 'high' WHEN 'view' THEN 'medium' ELSE 'low' END AS worded
       FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""",
)
def bands(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    words = F.when(kind == "click", "Very High").when(kind == "view", "fair").otherwise("0.9")
    k = va.to_int(F.get_json_object("props", "$.k"))
    return table(spark, sf, "events").select(
        "event_id",
        va.match_band("value").alias("match"),
        va.outreach_band(k / 10).alias("outreach"),
        va.confidence_band("value", numeric=True).alias("confidence"),
        va.confidence_band(words).alias("worded"),
    )


@query(
    "clamps",
    """SELECT event_id, least(greatest(value, 0.5), 5.0) AS clamped, least(greatest(k, 1), 10) AS bounded,
              CASE WHEN event_type <> 'error' THEN least(value, 1.0) END AS kept_null
       FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""",
)
def clamps(spark: SparkSession, sf: str) -> DataFrame:
    k = va.to_int(F.get_json_object("props", "$.k"))
    gap = F.when(F.col("event_type") != "error", F.col("value"))
    return table(spark, sf, "events").select(
        "event_id",
        va.clamp("value", 0.5, 5.0).alias("clamped"),
        va.clamp(k, 1, 10).alias("bounded"),
        va.clamp(gap, 0.0, 1.0).alias("kept_null"),
    )


@query(
    "enum",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN lower(o_orderpriority) ELSE 'other' END AS checked,
              CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' END AS folded,
              CASE WHEN o_orderpriority = '1-URGENT' THEN 5 WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 3 ELSE 0 END AS class
       FROM orders""",
)
def enum(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", " Woman").when(F.col("o_orderstatus") == "O", "MALE").otherwise("x")
    rules = ((("1", "urgent"), 5), (("high",), 3), (("medium",), 3))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        va.enum_or("o_orderpriority", ("1-urgent", "2-high"), "other").alias("checked"),
        va.fold_synonyms(status, pl.GENDERS).alias("folded"),
        va.classify_text("o_orderpriority", rules, 0).alias("class"),
    )


@query(
    "blanks",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS segment,
              CASE WHEN c_mktsegment = 'BUILDING' THEN 'VERIFY_REQUIRED' ELSE c_mktsegment END AS written,
              CASE WHEN c_nationkey = 0 THEN 99 ELSE c_nationkey END AS nation,
              CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 2 END AS filled,
              c_mktsegment = 'BUILDING' AS needs_work,
              c_name || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE ' ' || c_mktsegment END || ' Australia' AS search
       FROM customer""",
)
def blanks(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("c_mktsegment") == "BUILDING", " Verify_Required ").otherwise(F.col("c_mktsegment"))
    cust = table(spark, sf, "customer").withColumn("raw", raw)
    df = cust.select(
        "c_custkey",
        va.nullify("raw").alias("segment"),
        va.nullify("raw").alias("written"),
        va.first_filled("c_nationkey", F.lit(99), zero_is_blank=True).alias("nation"),
        va.count_filled(va.nullify("raw"), "c_name", F.lit("  ")).alias("filled"),
        gates.needs_work(["raw"]).alias("needs_work"),
        va.query_text("c_name", va.nullify("raw"), suffix="Australia").alias("search"),
    )
    return va.fill_sentinel(df, ["written"])


@query(
    "text_shapes",
    r"""SELECT doc_id, CASE WHEN length(trim(text)) > 80 THEN substr(trim(text), 1, 77) || '...' ELSE NULLIF(trim(text), '') END AS short,
              md5(CASE WHEN length(text) > 600 THEN substr(text, 1, 400) || '|cut|' || right(text, 150) ELSE text END) AS ends,
              trim(split_part(source || '/' || lang, '/', 1)) AS region, lang || chr(10) || source AS notes
       FROM documents""",
)
def text_shapes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id",
        va.ellipsize("text", 80).alias("short"),
        F.md5(va.head_tail("text", 600, "|cut|", 50)).alias("ends"),
        va.before_slash(F.concat_ws("/", "source", "lang")).alias("region"),
        va.append_text("lang", "source").alias("notes"),
    )


@query(
    "foreign_slugs",
    """SELECT p_partkey, length(p_name) >= 2 AND NOT contains(lower(p_name), 'bali') AND p_type IN ('SMALL', 'PROMO') AS keep FROM part""",
)
def foreign_slugs(spark: SparkSession, sf: str) -> DataFrame:
    slug = F.replace(F.col("p_name"), F.lit(" "), F.lit("-"))
    return table(spark, sf, "part").select(
        "p_partkey", gates.in_region(slug, "p_type", ["SMALL", "PROMO"]).alias("keep")
    )


# -- payloads ---------------------------------------------------------------


@query(
    "json_extract",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, props AS valid FROM events""",
)
def json_extract(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.LongType())])
    return table(spark, sf, "events").select(
        "event_id", pl.parse("props", schema)["k"].alias("k"), pl.valid_json_text("props").alias("valid")
    )


@query(
    "json_salvage",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
              CAST(json_extract(props, '$.k') AS BIGINT) AS fenced, CAST(n AS BIGINT) AS item_no, CAST(json_extract(props, '$.k') AS BIGINT) + n AS item
       FROM events, (SELECT unnest([0, 1]) AS n)""",
)
def json_salvage(spark: SparkSession, sf: str) -> DataFrame:
    """Objects out of prose (broken for 'error'), out of a fence, and items under a key."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.LongType())])
    props, k = F.col("props"), F.get_json_object("props", "$.k").try_cast("bigint")
    broken = F.when(F.col("event_type") == "error", F.lit(' and {"k": }')).otherwise(F.lit(""))
    prose = F.concat(F.lit("Here you go: "), props, broken, F.lit(" Regards"))
    fence = F.concat(F.lit("Sure\n```json\n"), props, F.lit("\n```\nDone"))
    items = F.concat(
        F.when(F.col("event_type") == "view", '{"sources": [').otherwise("List: ["),
        props, F.lit(', {"k": '), k + 1, F.lit("}]"), F.when(F.col("event_type") == "view", "}").otherwise(" ok"),
    )
    ev = table(spark, sf, "events").select(
        "event_id",
        pl.parse(pl.salvage_json(prose), schema)["k"].alias("k"),
        pl.parse(pl.fenced_json(fence), schema)["k"].alias("fenced"),
        F.posexplode(pl.salvage_items(items, schema)).alias("item_no", "_item"),
    )
    return ev.select("event_id", "k", "fenced", F.col("item_no").cast("bigint").alias("item_no"), F.col("_item.k").alias("item"))


def _place_json():
    """A place payload built from a supplier row."""
    key = F.col("s_suppkey")
    review = F.struct(
        F.struct(F.col("s_name").alias("text")).alias("text"),
        F.struct(F.lit("a guest").alias("displayName")).alias("authorAttribution"),
        (key % 5 + 1).alias("rating"),
        F.lit("2024-01-05T10:00:00Z").alias("publishTime"),
    )
    return F.to_json(
        F.struct(
            F.concat(F.lit("places/P"), key).alias("name"),
            F.struct(F.col("s_name").alias("text")).alias("displayName"),
            F.concat(key + 1000, F.lit(" Main St, Town NSW "), key + 2000, F.lit(", Australia")).alias("formattedAddress"),
            F.when(key % 3 == 0, "OPERATIONAL").otherwise("CLOSED_PERMANENTLY").alias("businessStatus"),
            F.struct((key / 8).alias("latitude"), (key / 4).alias("longitude")).alias("location"),
            (key % 50 / 10).alias("rating"),
            (key * 3).alias("userRatingCount"),
            F.array(F.struct(F.concat(F.lit("ph"), key).alias("name"))).alias("photos"),
            F.when(key % 2 == 0, "PRICE_LEVEL_MODERATE").otherwise("PRICE_LEVEL_UNSPECIFIED").alias("priceLevel"),
            F.struct((key % 2 == 1).alias("wheelchairAccessibleEntrance")).alias("accessibilityOptions"),
            F.when(key % 4 > 0, F.array_repeat(review, (key % 4).cast("int"))).alias("reviews"),
        )
    )


@query(
    "place_payload",
    """SELECT s_suppkey, 'P' || s_suppkey AS place_id, s_name AS google_name,
              'https://www.google.com/maps/place/?q=place_id:P' || s_suppkey AS google_maps_url,
              CASE WHEN s_suppkey % 3 = 0 THEN 'OPERATIONAL' ELSE 'CLOSED_PERMANENTLY' END AS business_status,
              CASE WHEN s_suppkey + 2000 <= 9999 THEN CAST(s_suppkey + 2000 AS VARCHAR) END AS postcode,
              s_suppkey / 8 AS lat, s_suppkey / 4 AS lng, s_suppkey % 50 / 10 AS google_rating,
              CAST(s_suppkey * 3 AS BIGINT) AS google_review_count, 'ph' || s_suppkey AS photo_ref_1, CAST(NULL AS VARCHAR) AS photo_ref_2,
              CAST(1 AS BIGINT) AS total_photo_count, CASE WHEN s_suppkey % 2 = 0 THEN 2 END AS price_level,
              s_suppkey % 2 = 1 AS wheelchair_accessible_entrance,
              CASE WHEN s_suppkey % 4 >= 1 THEN s_name END AS review_text_1, CASE WHEN s_suppkey % 4 >= 3 THEN s_name END AS review_text_3,
              CASE WHEN s_suppkey % 4 >= 2 THEN s_suppkey % 5 + 1 END AS review_rating_2, CAST(NULL AS VARCHAR) AS review_text_5
       FROM supplier""",
)
def place_payload(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "supplier").select("s_suppkey", _place_json().alias("payload"))
    flat = pl.flatten_place(raw, "payload")
    return flat.select(
        "s_suppkey",
        "place_id",
        "google_name",
        "google_maps_url",
        "business_status",
        "postcode",
        "lat",
        "lng",
        "google_rating",
        F.col("google_review_count").cast("bigint").alias("google_review_count"),
        "photo_ref_1",
        "photo_ref_2",
        F.col("total_photo_count").cast("bigint").alias("total_photo_count"),
        "price_level",
        "wheelchair_accessible_entrance",
        "review_text_1",
        "review_text_3",
        F.col("review_rating_2").cast("bigint").alias("review_rating_2"),
        "review_text_5",
    )


@query(
    "pollen_and_air",
    """SELECT event_id, least(k % 9, 5) AS grass, CASE WHEN event_type = 'error' THEN NULL ELSE k % 4 END AS tree, k % 3 AS weed,
              CASE WHEN least(k % 9, 5) >= COALESCE(CASE WHEN event_type <> 'error' THEN k % 4 END, -1) AND least(k % 9, 5) >= k % 3 THEN 'GRASS'
                   WHEN COALESCE(CASE WHEN event_type <> 'error' THEN k % 4 END, -1) >= k % 3 THEN 'TREE' ELSE 'WEED' END AS dominant,
              CASE WHEN event_type = 'view' THEN k ELSE k + 1 END AS air_quality_index,
              CASE WHEN event_type = 'view' THEN 'local' ELSE 'universal' END AS category
       FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""",
)
def pollen_and_air(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    kind = F.col("event_type")

    def pollen(code: str, value):
        return F.struct(F.lit(code).alias("code"), F.struct(value.alias("value")).alias("indexInfo"))

    tree = F.when(kind != "error", k % 4)
    kinds = F.array(pollen("Grass", k % 9), pollen("TREE", tree), pollen("weed", k % 3))
    day = F.to_json(F.struct(F.array(F.struct(kinds.alias("pollenTypeInfo"))).alias("dailyInfo")))
    local = F.struct(F.lit("aus").alias("code"), k.alias("aqi"), F.lit("local").alias("category"))
    world = F.struct(F.lit("UAQI").alias("code"), (k + 1).alias("aqi"), F.lit("universal").alias("category"))
    indexes = F.when(kind == "view", F.array(local)).otherwise(F.array(local, world))
    air = F.to_json(F.struct(indexes.alias("indexes")))
    raw = table(spark, sf, "events").select("event_id", day.alias("day"), air.alias("air"))
    return pl.add_air(pl.add_pollen(raw, "day"), "air").select(
        "event_id",
        F.col("pollen_grass_index").cast("bigint").alias("grass"),
        F.col("pollen_tree_index").cast("bigint").alias("tree"),
        F.col("pollen_weed_index").cast("bigint").alias("weed"),
        F.col("dominant_pollen_type").alias("dominant"),
        F.col("air_quality_index").cast("bigint").alias("air_quality_index"),
        F.col("air_quality_category").alias("category"),
    )


@query(
    "sentiment",
    """SELECT event_id, CASE WHEN k % 4 >= 2 THEN least(value, 1.0) END AS score,
              CASE WHEN k % 4 >= 2 THEN 'a|b|' || event_type END AS themes, CASE WHEN k % 4 >= 2 THEN '' END AS flags,
              CASE WHEN k % 4 >= 2 THEN 'Seen ' || event_type END AS summary
       FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""",
)
def sentiment(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").try_cast("int")
    answer = F.concat(
        F.lit("Result:\n"),
        F.to_json(
            F.struct(
                F.col("value").alias("sentiment_score"),
                F.array(F.lit("a"), F.lit("b"), kind, F.lit("d")).alias("top_themes"),
                F.concat(F.lit(" Seen "), kind).alias("one_line_summary"),
            )
        ),
    )
    raw = table(spark, sf, "events").select("event_id", answer.alias("answer"), (k % 4).alias("n"))
    return pl.add_sentiment(raw, "answer", "n", themes=3).select(
        "event_id",
        F.col("sentiment_score").alias("score"),
        F.array_join("sentiment_themes", "|").alias("themes"),
        F.array_join("red_flags", "|").alias("flags"),
        F.col("one_line_summary").alias("summary"),
    )


@query(
    "typed_records",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS permit_required,
              CAST(o_custkey AS BIGINT) AS lead_days, 'hall|park' AS places,
              CASE o_orderstatus WHEN 'F' THEN 'high' ELSE 'low' END AS confidence,
              CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS notes
       FROM orders""",
)
def typed_records(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    fields = {
        "permit_required": F.when(status == "F", "Yes").when(status == "O", "false").otherwise("unknown"),
        "permit_lead_time_days": F.concat("o_custkey", F.lit(" days")),
        "approved_locations": F.lit(" hall; park,"),
        "data_confidence": F.when(status == "F", "Excellent").otherwise("0.8"),
        "notes": F.when(status == "P", "N/A").otherwise(F.col("o_orderpriority")),
    }
    others = (
        "council_name",
        "state_code",
        "permit_page_url",
        "permit_fee_aud",
        "restricted_times",
        "insurance_min_cover_aud",
        "contact_name",
        "contact_email",
        "contact_phone",
        "application_url",
        "application_form_url",
        "insurance_required",
        "alcohol_permitted",
        "caterers_approved_list",
        "max_guests_outdoor",
    )
    rec = F.struct(
        *[c.alias(n) for n, c in fields.items()], *[F.lit(None).cast("string").alias(n) for n in others]
    )
    raw = table(spark, sf, "orders").select("o_orderkey", rec.alias("r"))
    made = pl.permit_record(F.col("r"))
    return raw.select(
        "o_orderkey",
        made["permit_required"].alias("permit_required"),
        made["permit_lead_time_days"].cast("bigint").alias("lead_days"),
        pl.list_text(made["approved_locations"]).alias("places"),
        made["data_confidence"].alias("confidence"),
        made["notes"].alias("notes"),
    )
