"""Influencer jobs: load, discovery, enrichment, articles and signals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetta.functions import payloads as pl
from gazetta.functions import text as tx
from gazetta.functions import urls as ur
from gazetta.functions import values as va
from gazetta.operators import aggregate as ag
from gazetta.operators import dedupe as dd
from gazetta.operators import merge
from gazetta.operators import pages as pg

# Accepted header spellings per field.
ALIASES = {
    "name": ("NAME", "Name", "name"),
    "url": ("URL", "url"),
    "source_type": ("SOURCE TYPE", "source_type", "Source Type"),
    "states": ("STATES", "states"),
    "specialism": ("SPECIALISM", "specialism", "Specialism"),
    "instagram": ("INSTAGRAM", "instagram", "Instagram"),
    "trust_level": ("TRUST LEVEL", "trust_level", "Trust Level"),
    "key_locations": ("KEY LOCATIONS", "key_locations", "Key Locations"),
    "about_url": ("ABOUT URL", "about_url", "About URL"),
    "blog_index_url": ("BLOG INDEX URL", "blog_index_url", "Blog Index URL"),
    "notes": ("NOTES", "notes"),
    "summary": ("SUMMARY", "summary"),
    "data_confidence": ("DATA CONFIDENCE", "data_confidence"),
    "last_verified": ("LAST VERIFIED", "last_verified"),
    "is_active": ("IS ACTIVE", "is_active"),
}
DEFAULTS = {"country": "Australia", "is_international": False, "data_confidence": "medium"}
# Specialisms of a source and title words that touch insurance.
SPECIALISMS = (
    "planning",
    "photography",
    "styling",
    "venue_discovery",
    "fashion_dress",
    "honeymoon_travel",
    "cultural",
    "elopement",
    "lgbtq",
    "budget",
    "luxury",
    "real_weddings",
    "suppliers",
    "entertainment",
    "food_cake",
    "flowers",
)
INSURANCE_WORDS = (
    "cancel",
    "weather",
    "risk",
    "permit",
    "vendor",
    "supplier",
    "fail",
    "rain",
    "backup",
    "insurance",
    "cost",
    "outdoor",
    "policy",
    "disaster",
    "emergency",
)


def source_rows(master: DataFrame, curated: DataFrame | None, order: str) -> DataFrame:
    """Typed source rows, one per URL key (first by ``order``)."""
    blanks = va.BLANKS["influencer"]
    picked = {f: va.pick_alias(master, names) for f, names in ALIASES.items()}
    # a projection of its own: the address is cleaned once and then used in several places
    cleaned = master.select(
        F.col(order).alias("seen"),
        *[(c if f == "is_active" else va.nullify(c, blanks)).alias(f) for f, c in picked.items()],
    )
    col = {f: F.col(f) for f in ALIASES}
    rows = cleaned.select(
        "seen",
        col["name"].alias("name"),
        # bound once: filters on keys made of it are pushed down to here
        va.let(ur.norm_url(col["url"]), lambda key: F.nullif(key, F.lit(""))).alias("url"),
        ur.root_domain(col["url"]).alias("root_domain"),
        col["source_type"].alias("source_type"),
        tx.code_list_text(col["states"]).alias("states"),
        col["specialism"].alias("specialism_description"),
        F.regexp_replace(col["instagram"], r"^@\s*", "").alias("instagram_handle"),
        va.enum_or(col["trust_level"], pl.TRUST_LEVELS).alias("trust_level"),
        col["key_locations"].alias("key_locations"),
        col["about_url"].alias("about_url"),
        col["blog_index_url"].alias("blog_index_url"),
        F.coalesce(col["notes"], col["summary"]).alias("notes"),
        va.to_bool(col["is_active"], "default", True).alias("is_active"),
        col["data_confidence"].alias("data_confidence"),
        col["last_verified"].alias("last_verified"),
    )
    if curated is not None:
        rows = dd.union_with_defaults(rows, curated, {"is_active": True})
    named = merge.with_defaults(rows, DEFAULTS).filter("name is not null and url is not null")
    return dd.keep_first(named, ["url"], ["seen"])


def upsert_sources(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Known URLs are patched and keep their id, new ones are numbered."""
    return merge.natural_key_upsert(table, rows, "source_id", "url", ur.norm_url, "seen", "INF-WED-%03d")


ITEM = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in (
            "name",
            "url",
            "source_type",
            "states",
            "specialism",
            "instagram",
            "trust_level",
            "key_locations",
            "data_confidence",
            "last_verified",
        )
    ]
)


def discover(
    answers: DataFrame, known: DataFrame, source_types: Sequence[str], last_number: int = 0
) -> DataFrame:
    """New sources out of search answers (answer_no, query, answer), numbered in answer order.

    ``known`` has the column ``url_key``.
    """
    items = answers.select(
        "answer_no", "query", F.posexplode(pl.salvage_items("answer", ITEM)).alias("item_no", "_rec")
    )
    made = pl.source_record(F.col("_rec"))
    typed = items.select(
        "answer_no",
        "item_no",
        F.col("query").alias("discovery_query"),
        F.col("_rec.specialism").alias("specialism"),
        *[c.alias(n) for n, c in made.items()],
    )
    good = typed.filter(
        F.col("name").isNotNull() & F.col("url").isNotNull() & F.col("source_type").isin(*source_types)
    )
    first = dd.keep_first(good, ["url"], ["answer_no", "item_no"])
    fresh = dd.not_known(first, known.select(F.col("url_key").alias("url")), ["url"])
    # answers in order, and the items of an answer within it
    return dd.sequence_ids(
        fresh, [], ["answer_no", "item_no"], "INF-DISC-%03d", "source_id", offset=last_number
    )


def enrich(sources: DataFrame, answers: DataFrame) -> DataFrame:
    """Pending sources patched by their answer (source_id, answer); the hook reason goes to the notes."""
    names = (
        "specialism_primary",
        "specialism_tags",
        "founder_gender",
        "audience_size_estimate",
        "audience_type",
        "partnership_potential",
        "has_advertising",
        "has_affiliate",
        "insurance_hook",
        "insurance_hook_reason",
        "avg_posts_per_month",
        "relevance_score",
    )
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = answers.withColumn("_rec", pl.parse(pl.salvage_json("answer"), schema))
    typed = raw.select(
        "source_id",
        *[c.alias(n) for n, c in pl.enrichment_record(F.col("_rec"), SPECIALISMS).items()],
        F.concat(
            F.lit("Insurance hook (enrichment): "),
            va.nullify("_rec.insurance_hook_reason", ("",)),
        ).alias("_note"),
    )
    pending = sources.select("source_id", "notes").join(typed, "source_id")
    patch = pending.withColumn("notes", va.append_text("notes", "_note")).drop("_note")
    wide = sources.withColumns(
        {c: F.lit(None).cast(patch.schema[c].dataType) for c in patch.columns if c not in sources.columns}
    )
    return merge.patch_non_null(wide, patch, ["source_id"])


def content_rows(blogs: DataFrame, known: DataFrame, k: int = 10) -> DataFrame:
    """New article rows of source blogs (source_id, url, html).

    Ids carry the whole source id; ``known`` holds content_id, source_id and url.
    An address that exists already is skipped and does not use up a number.
    """
    found = pg.article_links(blogs, k, page_id="source_id")
    first = dd.keep_first(found.withColumnRenamed("link", "url"), ["url"], ["source_id", "article_rank"])
    fresh = dd.not_known(first, known, ["url"])
    last = ag.max_suffix(known, ["source_id"], "content_id", "_last")
    # at most k articles per source: the rank window is bounded
    ranked = dd.top_k(fresh, ["source_id"], ["article_rank"], k, rank="_n").join(last, "source_id", "left")
    number = F.col("_n") + F.coalesce("_last", F.lit(0))
    return ranked.select(
        F.format_string("CONT-%s-%03d", "source_id", number.cast("bigint")).alias("content_id"),
        "source_id",
        "title",
        "url",
        va.has_any("title", INSURANCE_WORDS).alias("insurance_relevant"),
    )


def signals(
    sources: DataFrame, content: DataFrame, angles: Mapping[str, str], default_angle: str
) -> DataFrame:
    """Outreach priority, collaboration angle per specialism and the hook rolled up from the articles."""
    hook = ag.any_flag(content, ["source_id"], F.col("insurance_relevant"), "_article_hook")
    joined = sources.join(hook, "source_id", "left")
    by_text = {text: (special,) for special, text in angles.items()}
    return joined.select(
        "source_id",
        F.col("relevance_score").alias("persona_fit_score"),
        va.outreach_band("relevance_score").alias("outreach_priority"),
        va.fold_synonyms("specialism_primary", by_text, F.lit(default_angle)).alias("collab_angle"),
        (
            F.coalesce("insurance_hook", F.lit(False)) | F.coalesce("_article_hook", F.lit(False))
        ).alias("insurance_hook"),
    )


def discovery_counts(rows: DataFrame) -> dict[str, DataFrame]:
    """New sources by type, trust level and state."""
    return {
        "type": ag.count_by(rows, "source_type"),
        "trust": ag.count_by(rows, "trust_level"),
        "state": ag.count_values(rows, F.split("states", r"\|"), "state"),
    }
