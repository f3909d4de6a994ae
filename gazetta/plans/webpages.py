"""Page jobs on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.functions import urls as ur
from gazetta.operators import gates
from gazetta.operators import pages as pg
from gazetta.plans.registry import query, table

def unescape_sql(x: str) -> str:
    plain = (("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&"))
    for entity, char in plain:
        x = f"replace({x}, '{entity}', '{char}')"
    return x


def hidden_sql(x: str) -> str:
    for tag in ("script", "style", "noscript"):
        x = rf"regexp_replace({x}, '(?is)<{tag}\b.*?</{tag}\s*>', ' ', 'g')"
    return f"regexp_replace({x}, '(?s)<!--.*?-->', ' ', 'g')"


def visible_sql(x: str) -> str:
    x = f"regexp_replace({hidden_sql(x)}, '(?s)<[^>]*>', ' ', 'g')"
    return rf"trim(regexp_replace({unescape_sql(x)}, '\s+', ' ', 'g'))"


ORIGIN = "regexp_extract(url, '(?i)^([a-z][a-z0-9+.\\-]*://[^/?#]*)', 1)"
FOLDER = "regexp_extract(regexp_extract(url, '(?i)^[a-z][a-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1), '^(.*/)', 1)"
LINKS = f"""
cut AS (SELECT page_id, url, string_split_regex({hidden_sql('html')}, '(?i)<a\\s')[2:] AS parts FROM pages),
anchors AS (SELECT page_id, url, unnest(parts) AS a, unnest(range(0, len(parts))) AS pos FROM cut),
tags AS (SELECT page_id, url, pos, ' ' || split_part(a, '>', 1) AS tag,
                string_split_regex(substr(a, length(split_part(a, '>', 1)) + 2), '(?i)</a')[1] AS label FROM anchors),
addresses AS (SELECT *, string_split_regex(tag, '(?i)\\shref\\s*=\\s*')[2] AS rest FROM tags),
hrefs AS (SELECT page_id, url, pos, {visible_sql('label')} AS text,
                 trim({unescape_sql("""CASE WHEN rest IS NULL THEN '' WHEN left(rest, 1) = '"' THEN split_part(rest, '"', 2)
                      WHEN left(rest, 1) = chr(39) THEN split_part(rest, chr(39), 2) ELSE string_split_regex(rest, '\\s')[1] END""")}) AS href FROM addresses),
resolved AS (SELECT *, CASE WHEN href SIMILAR TO '[A-Za-z][A-Za-z0-9+.\\-]*:.*' THEN href
                 WHEN href LIKE '//%' THEN regexp_extract(url, '^([a-z]+):', 1) || ':' || href
                 WHEN href LIKE '/%' THEN {ORIGIN} || href
                 ELSE {ORIGIN} || CASE WHEN {FOLDER} = '' THEN '/' ELSE {FOLDER} END || href END AS link
             FROM hrefs WHERE href <> ''),
links AS (SELECT * FROM resolved QUALIFY row_number() OVER (PARTITION BY page_id, link ORDER BY pos) = 1)"""
LINK_HOST = "lower(regexp_extract(link, '(?i)^https?://([^/?#]*)', 1))"
PAGE_HOST = "lower(regexp_extract(url, '(?i)^https?://([^/?#]*)', 1))"


@query(
    "links",
    f"WITH {LINKS} SELECT page_id, url AS page_url, CAST(pos AS BIGINT) AS pos, href, text, link AS resolved FROM links",
)
def links(spark: SparkSession, sf: str) -> DataFrame:
    out = pg.extract_links(table(spark, sf, "pages"))
    return out.withColumn("pos", F.col("pos").cast("bigint"))


HINTS = ("the", "an", "er", "on")
_HINT_SCORE = " + ".join(f"CAST(contains(lower(link), '{h}') AS BIGINT)" for h in HINTS)


@query(
    "rank_links",
    f"""WITH {LINKS},
    scored AS (SELECT page_id, link, pos, {_HINT_SCORE} AS score FROM links WHERE {LINK_HOST} = {PAGE_HOST})
    SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos) AS link_rank, link, score
    FROM scored WHERE score > 0 QUALIFY link_rank <= 3""",
)
def rank_links(spark: SparkSession, sf: str) -> DataFrame:
    out = pg.rank_links(table(spark, sf, "pages"), HINTS, 3)
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("link_rank", "score")})


@query(
    "article_links",
    f"""WITH {LINKS},
    shaped AS (SELECT *, lower(regexp_extract(link, '(?i)^https?://[^/?#]*([^?#]*)', 1)) AS path FROM resolved),
    slugged AS (SELECT *, regexp_extract(regexp_replace(path, '/+$', ''), '([^/]*)$', 1) AS slug FROM shaped),
    good AS (SELECT * FROM slugged WHERE length(text) >= 5 AND {LINK_HOST} = {PAGE_HOST}
             AND NOT regexp_matches(path, '/about|/contact|/privacy|/tag/|/page/|/author/|/login')
             AND regexp_replace(link, '/+$', '') <> regexp_replace(url, '/+$', '')
             AND slug NOT IN ('', 'blog', 'category', 'archives')
             AND (contains(path, '/20') OR contains(path, '/blog') OR length(slug) > 6)),
    firsts AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY page_id, link ORDER BY pos) = 1)
    SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS article_rank, text AS title, link
    FROM firsts QUALIFY article_rank <= 4""",
)
def article_links(spark: SparkSession, sf: str) -> DataFrame:
    out = pg.article_links(table(spark, sf, "pages"), k=4, min_title=5, min_slug=6)
    return out.withColumn("article_rank", F.col("article_rank").cast("bigint"))


@query(
    "entity_links",
    f"""WITH {LINKS},
    named AS (SELECT page_id, pos, regexp_extract(url, 'https?://[^/]*/([a-z]+)', 1) AS region,
                     trim(regexp_replace(regexp_replace(text, '\\s*\\(.*?\\)\\s*$', ''), '\\s+', ' ', 'g')) AS name,
                     link AS website, {LINK_HOST} AS host FROM resolved),
    good AS (SELECT *, CASE WHEN contains(lower(website), 'example.org') THEN 'region_host'
                            WHEN host LIKE '%.example.com' OR host = 'example.com' THEN 'public_host' ELSE 'name' END AS rule
             FROM named WHERE name <> '' AND regexp_matches(lower(name), 'the|an|er|le')
             AND NOT regexp_matches(lower(name || ' ' || website), 'councillor|councilor|mayor|election|ward|meeting|minutes|agenda|news|event')
             AND regexp_matches(website, '(?i)^https?://[^/?#]+')
             AND NOT regexp_matches(host, 'facebook\\.com|instagram\\.com|linkedin\\.com|youtube\\.com|x\\.com|twitter\\.com'))
    SELECT page_id, region, CAST(pos AS BIGINT) AS pos, name, website, rule FROM good
    QUALIFY row_number() OVER (PARTITION BY region, lower(name), regexp_replace(lower(website), '/+$', '') ORDER BY page_id, pos) = 1""",
)
def entity_links(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").withColumn(
        "region", F.regexp_extract("url", r"https?://[^/]*/([a-z]+)", 1)
    )
    out = pg.entity_links(
        pages, "region", suffix="example.com", region_suffix=F.lit("example.org"), pattern="the|an|er|le"
    )
    return out.withColumn("pos", F.col("pos").cast("bigint"))


TITLE = rf"""trim(regexp_replace({unescape_sql("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")}, '\s+', ' ', 'g'))"""


@query(
    "page_text",
    f"SELECT page_id, {TITLE} AS title, {visible_sql('html')} AS body_text FROM pages",
)
def page_text(spark: SparkSession, sf: str) -> DataFrame:
    return pg.page_text(table(spark, sf, "pages")).select("page_id", "title", "body_text")


@query(
    "thin_pages",
    r"""SELECT page_id, contains(lower(html), 'sgcaptcha') OR contains(lower(html), 'please verify') AS is_blocked,
              length(html) < 2500 OR n < 5 OR (regexp_matches(lower(html), '__next|_nuxt|reactroot') AND n < 20) AS is_thin
       FROM (SELECT *, len(regexp_extract_all(html, '(?i)<a\b')) AS n FROM pages)""",
)
def thin_pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        "page_id", gates.is_blocked_page("html").alias("is_blocked"), gates.is_thin_page("html").alias("is_thin")
    )


@query(
    "page_contacts",
    rf"""WITH {LINKS},
    mails AS (SELECT page_id, arg_min(href, pos) AS email FROM hrefs WHERE lower(href) LIKE 'mailto:%' GROUP BY 1)
    SELECT p.page_id, m.email, NULLIF(regexp_extract({visible_sql('html')}, '(\(\d{{3}}\) \d{{3}}-\d{{4}})', 1), '') AS phone
    FROM pages p LEFT JOIN mails m USING (page_id)""",
)
def page_contacts(spark: SparkSession, sf: str) -> DataFrame:
    return pg.contacts(table(spark, sf, "pages"), mobile=r"\(\d{3}\) \d{3}-\d{4}")


@query(
    "slug_harvest",
    """SELECT DISTINCT slug FROM (
         SELECT unnest(regexp_extract_all(html, 'href="/([^"/?#]+)"', 1)) AS slug FROM pages
         UNION ALL SELECT unnest(regexp_extract_all(html, '<h1>([A-Za-z]+)', 1)) FROM pages)
       WHERE slug <> '' AND NOT starts_with(lower(slug), 'http')""",
)
def slug_harvest(spark: SparkSession, sf: str) -> DataFrame:
    return pg.slugs(table(spark, sf, "pages"), [r'href="/([^"/?#]+)"', r"<h1>([A-Za-z]+)"])


def combined_sql(source: str, keys: str, order: str, url: str, body: str, page: int = 2**31 - 1, total: int = 2**31 - 1) -> str:
    chunk = rf"'URL: ' || {url} || chr(10) || 'CONTENT:' || chr(10) || substr(trim(regexp_replace({body}, '\s+', ' ', 'g')), 1, {page})"
    sep = "chr(10) || chr(10) || '-----' || chr(10) || chr(10)"
    return f"""SELECT {keys}, md5(substr(string_agg({chunk}, {sep} ORDER BY {order}), 1, {total})) AS digest,
        CAST(length(substr(string_agg({chunk}, {sep} ORDER BY {order}), 1, {total})) AS BIGINT) AS chars FROM {source} GROUP BY ALL"""


def _digested(df: DataFrame, key: str) -> DataFrame:
    return df.select(
        key, F.md5("combined").alias("digest"), F.length("combined").cast("bigint").alias("chars")
    )


@query("combine_turns", combined_sql("conversations", "conv_id", "turn", "role", "text", 400, 1500))
def combine_turns(spark: SparkSession, sf: str) -> DataFrame:
    conv = table(spark, sf, "conversations")
    out = pg.combine_docs(conv, ["conv_id"], "turn", "role", "text", page_chars=400, total_chars=1500)
    return _digested(out, "conv_id")


#: Characters of a part in the query: small, so that hosts of the test tables have several.
PART_CHARS = 20_000
_SEP = "chr(10) || chr(10) || '-----' || chr(10) || chr(10)"


@query(
    "combine_docs",
    rf"""WITH bodies AS (SELECT page_id, url, {visible_sql('html')} AS body, regexp_replace({PAGE_HOST}, '^www\.', '') AS host FROM pages),
    whole AS (SELECT host, string_agg('URL: ' || url || chr(10) || 'CONTENT:' || chr(10) || trim(regexp_replace(body, '\s+', ' ', 'g')), {_SEP} ORDER BY page_id, url) AS text
              FROM bodies GROUP BY host),
    parts AS (SELECT host, text, unnest(range(0, CAST((length(text) - 1) // {PART_CHARS} AS BIGINT) + 1)) AS part_no FROM whole)
    SELECT host, part_no, md5(substr(text, part_no * {PART_CHARS} + 1, {PART_CHARS})) AS digest,
           CAST(length(substr(text, part_no * {PART_CHARS} + 1, {PART_CHARS})) AS BIGINT) AS chars FROM parts""",
)
def combine_docs(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select(
        "page_id", "url", ur.host_key("url").alias("host"), pg.visible_text("html").alias("body")
    )
    parts = pg.combine_parts(pages, ["host"], "page_id", "url", "body", PART_CHARS)
    return parts.select("host", "part_no", F.md5("text").alias("digest"), F.length("text").cast("bigint").alias("chars"))


REASON = f"""CASE WHEN starts_with(lower(name), 'for council') OR starts_with(lower(name), 'council jobs') THEN 'junk_label'
    WHEN NOT regexp_matches(lower(name), 'the|an|er') THEN 'not_an_entity_name'
    WHEN NOT ({PAGE_HOST} LIKE '%.example.com' OR {PAGE_HOST} = 'example.com') THEN 'host_suffix'
    WHEN regexp_matches(lower(name || ' ' || url), 'councillor|councilor|mayor|election|ward|meeting|minutes|agenda|news|event') THEN 'excluded_word' END"""


@query(
    "quality_gate",
    f"""SELECT COALESCE(reason, 'accepted') AS outcome, COUNT(*) AS n, MIN(page_id) AS first_page
        FROM (SELECT page_id, {REASON} AS reason FROM (SELECT page_id, url, {TITLE} AS name FROM pages)) GROUP BY 1""",
)
def quality_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Both outputs of the gate, counted by outcome."""
    pages = table(spark, sf, "pages").select(
        "page_id", "url", pg.page_title("html").alias("name"), F.lit("X").alias("region")
    )
    reason = gates.reject_reason("name", "region", "url", pattern="the|an|er", suffix="example.com")
    good, bad = gates.split_rejects(pages, reason)
    row = F.from_json("row_json", "page_id bigint")
    both = good.select(F.lit("accepted").alias("outcome"), "page_id").unionByName(
        bad.select(F.col("reject_reason").alias("outcome"), row["page_id"].alias("page_id"))
    )
    return both.groupBy("outcome").agg(F.count("*").alias("n"), F.min("page_id").alias("first_page"))
