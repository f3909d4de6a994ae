"""Row filters: quality gates with a reason, needs-work tests and link filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions import urls as ur
from gazetta.functions import values as va
from gazetta.functions.values import as_col

# Labels and words that mark a link as not being a council.
JUNK_STARTS = ("for council", "council jobs")
JUNK_PARTS = ("council cost index", "council careers")
JUNK_LABELS = ("tasmanian councils", "tasmanian councils — overview", "tasmanian councils - overview")
JUNK_PATTERN = r"^find your local( council)?\.?$"
ENTITY_PATTERN = r"council|shire|\bcity\b|municipality"
EXCLUDED_PARTS = (
    "councillor",
    "councilor",
    "mayor",
    "election",
    "ward",
    "meeting",
    "minutes",
    "agenda",
    "news",
    "event",
)
REJECTED_HOSTS = ("lgat.tas.gov.au",)
# One council outside the public suffix: region, site ending, word in its name.
EXCEPTION = ("TAS", "hobartcity.com.au", "hobart")

# Words of a slug that point outside the country.
FOREIGN_SLUGS = (
    "bali",
    "fiji",
    "thailand",
    "philippines",
    "vietnam",
    "indonesia",
    "ireland",
    "new-zealand",
    "newzealand",
    "scotland",
    "england",
    "wales",
    "europe",
    "asia",
    "overseas",
    "international",
    "destination-",
    "ibiza",
    "greece",
    "italy",
    "france",
    "spain",
    "mexico",
    "canada",
    "india",
    "sri-lanka",
    "nepal",
    "jamaica",
    "uk-",
    "usa",
    "u-s-a",
)
CHALLENGE_WORDS = ("sgcaptcha", "well-known/sgcaptcha")
APP_MARKS = ("__next", "_nuxt", "reactroot")

# Paths that are navigation, and slugs that are list pages.
NAVIGATION_PATHS = ("/about", "/contact", "/privacy", "/tag/", "/page/", "/author/", "/login")
LIST_SLUGS = ("blog", "category", "archives")


def _any(flags: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags)


def is_junk_label(name: Column | str) -> Column:
    low = F.lower(va.strip(name))
    return _any(
        [low.startswith(x) for x in JUNK_STARTS]
        + [low.contains(x) for x in JUNK_PARTS]
        + [low.isin(*JUNK_LABELS), low.rlike(JUNK_PATTERN)]
    )


def looks_like_entity(name: Column | str, pattern: str = ENTITY_PATTERN) -> Column:
    return F.lower(as_col(name)).rlike(pattern)


def reject_reason(
    name: Column | str,
    region: Column | str,
    website: Column | str,
    pattern: str = ENTITY_PATTERN,
    suffix: str = "gov.au",
    excluded: Sequence[str] = EXCLUDED_PARTS,
) -> Column:
    """NULL for a good row, else the first rule it breaks."""
    site = va.strip(website)
    rejected = ur.host_key(site).isin(*REJECTED_HOSTS)
    where, ending, word = EXCEPTION
    excepted = (
        (as_col(region) == where) & F.lower(site).endswith(ending) & F.lower(as_col(name)).contains(word)
    )
    return (
        F.when(is_junk_label(name), F.lit("junk_label"))
        .when(~looks_like_entity(name, pattern), F.lit("not_an_entity_name"))
        .when(rejected, F.lit("rejected_host"))
        .when(~(ur.host_under(site, suffix) | F.coalesce(excepted, F.lit(False))), F.lit("host_suffix"))
        .when(va.has_any(F.concat_ws(" ", as_col(name), site), excluded), F.lit("excluded_word"))
    )


def split_rejects(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows as JSON text with their reason."""
    tagged = df.withColumn("reject_reason", reason)
    good = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = tagged.filter(F.col("reject_reason").isNotNull()).select(
        "reject_reason", F.to_json(F.struct(*df.columns)).alias("row_json")
    )
    return good, bad


def publishable(df: DataFrame, confidence: str, status: str) -> DataFrame:
    """HIGH confidence and in operation."""
    return df.filter((F.col(confidence) == "HIGH") & (F.col(status) == "OPERATIONAL"))


def needs_work(columns: Sequence[str], blanks: Sequence[str] = va.BLANKS["gaps"]) -> Column:
    """Is any of the columns blank?"""
    return _any([va.is_blank(c, blanks) for c in columns])


def pending(df: DataFrame, active: str, missing: str) -> DataFrame:
    """Active rows whose column is still NULL."""
    return df.filter(F.col(active) & F.col(missing).isNull())


def in_region(
    slug: Column | str, region: Column | str, allowed: Sequence[str], foreign: Sequence[str] = FOREIGN_SLUGS
) -> Column:
    """Slug of at least two characters without a foreign word, region on the allow list."""
    low = F.lower(va.strip(slug))
    return F.coalesce(
        (F.length(low) >= 2) & ~va.has_any(low, foreign) & as_col(region).isin(*allowed), F.lit(False)
    )


def is_blocked_page(html: Column | str, head: int | None = None) -> Column:
    """Challenge page instead of content; ``head`` looks for the request to verify at the beginning only."""
    low = F.lower(F.coalesce(as_col(html), F.lit("")))
    start = low if head is None else F.substring(low, 1, head)
    return va.has_any(low, CHALLENGE_WORDS) | start.contains("please verify")


def is_thin_page(
    html: Column | str, min_chars: int = 2500, min_links: int = 5, app_links: int = 20
) -> Column:
    """Too short, too few links, or an application shell with few links."""
    text = F.coalesce(as_col(html), F.lit(""))
    links = F.regexp_count(text, F.lit(r"(?i)<a\b"))
    shell = va.has_any(text, APP_MARKS)
    return (F.length(text) < min_chars) | (links < min_links) | (shell & (links < app_links))


def same_host(link: Column | str, page: Column | str) -> Column:
    return F.lower(ur.netloc(link)) == F.lower(ur.netloc(page))


def is_article_link(
    link: Column | str,
    title: Column | str,
    page: Column | str,
    min_title: int = 12,
    min_slug: int = 14,
) -> Column:
    """Own host, real title, no navigation, and a dated, blog or long-slug path."""

    def page_like(path: Column, slug: Column) -> Column:
        shaped = path.contains("/20") | path.contains("/blog") | (F.length(slug) > min_slug)
        listed = (slug == "") | slug.isin(*LIST_SLUGS) | va.has_any(path, NAVIGATION_PATHS)
        return shaped & ~listed

    def last_part(path: Column) -> Column:
        return F.element_at(F.split(F.regexp_replace(path, r"/+$", ""), "/"), -1)

    def bare(url: Column | str) -> Column:
        return F.regexp_replace(as_col(url), r"/+$", "")

    return F.coalesce(
        (F.length(va.strip(title)) >= min_title)
        & same_host(link, page)
        & (bare(link) != bare(page))
        & va.let(
            F.lower(ur.url_path(link)),
            lambda path: va.let(last_part(path), lambda slug: page_like(path, slug)),
        ),
        F.lit(False),
    )
