"""Celebrant jobs: award merge, cross reference with directories, load, place patch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions import payloads as pl
from gazetta.functions import similarity as sim
from gazetta.functions import text as tx
from gazetta.functions import urls as ur
from gazetta.functions import values as va
from gazetta.operators import aggregate as ag
from gazetta.operators import dedupe as dd
from gazetta.operators import link, merge, score
from gazetta.session import pin
from gazetta.sources.files import conform

# The 53 columns of the register, in order.
COLUMNS = (
    "celebrant_id",
    "brand_id",
    "full_name",
    "ag_display_name",
    "title",
    "email",
    "phone",
    "state",
    "address_text",
    "suburb",
    "postcode",
    "website",
    "registration_date",
    "register_class",
    "status",
    "unavailability_text",
    "ceremony_type",
    "data_source",
    "abia_winner",
    "abia_awards_text",
    "vibe",
    "style_description",
    "service_area_notes",
    "min_price_aud",
    "max_price_aud",
    "years_experience",
    "estimated_ceremonies",
    "languages_non_english",
    "instagram_handle_or_url",
    "facebook_url",
    "phone_from_website",
    "celebrant_institute_member",
    "joshua_withers_mentioned",
    "data_quality_score",
    "merge_fuzzy_score",
    "is_standalone_award_entry",
    "google_place_id",
    "google_rating",
    "google_review_count",
    "website_from_places",
    "phone_from_places",
    "last_website_enrich_at",
    "last_places_enrich_at",
    "ag_scrape_page",
    "ag_scrape_index",
    "import_notes",
    "pds_ack",
    "insurance_notes",
    "public_profile_url",
    "linkedin_url",
    "raw_address_cell",
    "last_updated_source",
    "content_tier",
)

# Ordered words of a register status.
STATUS_RULES = ((("inactive",), "Inactive"), (("unavailable",), "Unavailable"), (("active",), "Active"))


def register_status(raw: Column | str) -> Column:
    """First status word contained, else the text itself."""
    return F.coalesce(va.classify_text(raw, STATUS_RULES), va.nullify(raw, ("",)), F.lit(va.VERIFY_REQUIRED))


def register_rows(rows: DataFrame) -> DataFrame:
    """Numbered register rows out of page rows.

    ``rows``: page, pos (unique and increasing over all pages), header (text of a
    group header row, else NULL), cell (address text), full_name.  The region of
    the last header on the page is carried down and used for the id.
    """
    region = F.coalesce(F.upper(F.nullif(F.regexp_extract("header", r"(?i)\b(NSW|VIC|QLD|SA|WA|TAS|NT|ACT)\b", 1), F.lit(""))), F.lit("UNK"))
    marked = rows.withColumn("_region", F.when(F.col("header").isNotNull(), region))
    carried = dd.carry_forward(marked, ["page"], "pos", "_region", "group_region")
    data = carried.filter(F.col("header").isNull()).select(
        "page",
        "pos",
        "full_name",
        F.coalesce(tx.region_code("cell", names=(), any_case=True), "group_region", F.lit("UNK")).alias("state"),
        tx.postcode("cell").alias("postcode"),
        F.get(tx.emails("cell"), F.lit(0)).alias("email"),
        tx.labelled_phone("cell").alias("phone"),
        tx.address_line("cell").alias("address_text"),
    )
    numbered = dd.sequence_ids(data, ["state"], ["pos"], "CEL-%s-%06d", "celebrant_id", block=dd.BLOCK)
    return va.fill_sentinel(numbered, ["postcode", "email", "phone", "address_text"])


def merge_awards(
    register: DataFrame, awards: DataFrame, threshold: int = 85, report_from: int = 1
) -> DataFrame:
    """Award rows into the register by name; each register row takes one award.

    Both sides have ``row_no``.  An award without a register row (or with one
    that an earlier award took) becomes a row of its own with its best score.
    """
    cols = [c for c in register.columns if c != "row_no"]
    shared = [c for c in cols if c in awards.columns]
    named = awards.filter(~va.is_blank("full_name"))
    reg = register.select(F.col("row_no").alias("reg_no"), "full_name")
    linked = link.fuzzy_link(
        named, reg, "row_no", "full_name", "reg_no", "full_name", threshold,
        one_to_one=True, stages=(70, 50, 30), report_from=report_from,
    )
    linked = pin(linked)  # matched and unmatched rows are both taken from it
    won = linked.filter(F.col("right_id").isNotNull()).select(
        F.col("right_id").alias("row_no"), F.col("score").alias("_score"), *[va.nullify(c).alias(f"_a_{c}") for c in shared]
    )
    joined = register.join(won, "row_no", "left")
    hit = F.col("_score").isNotNull()
    new: dict[str, Column] = {c: F.coalesce(f"_a_{c}", c) if c in shared else F.col(c) for c in cols}
    if "merge_fuzzy_score" in cols:
        new["merge_fuzzy_score"] = F.when(hit, F.col("_score").cast("string")).otherwise(new["merge_fuzzy_score"])
    if "is_standalone_award_entry" in cols:
        new["is_standalone_award_entry"] = F.when(hit, F.lit(va.VERIFY_REQUIRED)).otherwise(
            new["is_standalone_award_entry"]
        )
    if "data_quality_score" in cols:
        old = new["data_quality_score"]
        new["data_quality_score"] = F.when(hit & va.is_blank(old), F.lit("85")).otherwise(old)
    merged = joined.select(*[v.alias(c) for c, v in new.items()])

    alone = dd.number_rows(linked.filter(F.col("right_id").isNull()), [], ["row_no"], "_n", block=dd.BLOCK)
    own = {c: va.nullify(c) for c in shared}
    fixed = {
        "celebrant_id": F.format_string("CEL-AWARD-%05d", "_n"),
        "data_source": F.lit("AWARD_STANDALONE"),
        "is_standalone_award_entry": F.lit("true"),
        "merge_fuzzy_score": F.coalesce(F.col("score"), F.lit(0)).cast("string"),
    }
    rows = {
        c: F.coalesce(own.get(c, F.lit(None)), fixed.get(c, F.lit(None)), F.lit(va.VERIFY_REQUIRED)) for c in cols
    }
    return merged.unionByName(alone.select(*[v.alias(c) for c, v in rows.items()]))


# Directory tags in processing order, their name column and the columns they bring.
DIRECTORIES: dict[str, tuple[str, dict[str, str]]] = {
    "EW": (
        "brand_name",
        {
            "easy_weddings_profile_url": "easy_weddings_profile_url",
            "easy_weddings_rating": "easy_weddings_rating",
            "easy_weddings_review_count": "easy_weddings_review_count",
            "easy_weddings_price_from": "easy_weddings_price_from",
            "is_destination_specialist": "is_destination_specialist",
        },
    ),
    "AFCC": ("full_name", {"afcc_profile_url": "afcc_profile_url"}),
    "TWS": ("name", {"wedding_society_profile_url": "wedding_society_profile_url"}),
    "WL": ("name", {"wedlockers_profile_url": "wedlockers_profile_url"}),
    "MCA": ("name", {"mycelebrantapp_profile_url": "mycelebrantapp_profile_url"}),
}
LAST_WINS = (
    "easy_weddings_profile_url",
    "easy_weddings_rating",
    "easy_weddings_review_count",
    "afcc_profile_url",
    "wedding_society_profile_url",
    "wedlockers_profile_url",
    "mycelebrantapp_profile_url",
)
FIRST_IF_BLANK = ("easy_weddings_price_from",)
RESET_FLAGS = ("afcc_member", "is_active_market", "is_destination_specialist")
GAP = ("", "false", "0", "verify_required")


def _directory_rows(tag: str, rank: int, df: DataFrame) -> DataFrame:
    name, brings = DIRECTORIES[tag]
    has = df.columns
    own_url = [c for c in brings if c.endswith("_profile_url")][0]
    cols = {c: va.nullify(c) if c in has else F.lit(None).cast("string") for c in brings}
    if "profile_url" in has:
        cols[own_url] = F.coalesce(cols[own_url], va.nullify("profile_url"))
    every = [*LAST_WINS, *FIRST_IF_BLANK, "is_destination_specialist"]
    email = va.nullify("email") if "email" in has else F.lit(None).cast("string")
    state = va.nullify("state") if "state" in has else F.lit(None).cast("string")
    return df.select(
        F.col("row_no").alias("row_id"),
        F.col(name).alias("name"),
        F.struct(F.lit(rank).alias("s"), F.col("row_no").alias("r")).alias("_seen"),
        email.alias("_email"),
        state.alias("_state"),
        *[cols.get(c, F.lit(None).cast("string")).alias(c) for c in every],
    )


def cross_reference(
    master: DataFrame, directories: Mapping[str, DataFrame], threshold: int = 70, stages: Sequence[int] = ()
) -> DataFrame:
    """Directory listings onto the master; unmatched rows of the first directory become new rows.

    All frames have ``row_no``.  Profile links, rating and count: the last filled
    row wins.  Other columns fill gaps only.  Flags are recomputed each run.
    """
    rows = {
        tag: _directory_rows(tag, i, directories[tag]) for i, tag in enumerate(DIRECTORIES) if tag in directories
    }
    linked = link.multi_source_link(
        rows, master, "celebrant_id", "full_name", threshold, master_order="row_no", stages=stages
    )
    linked = pin(linked)  # updates, source counts and new rows are all taken from it
    contactable = F.lower("afcc_profile_url").startswith("http") | F.col("_email").isNotNull()
    hits = linked.filter(
        F.col("right_id").isNotNull() & ((F.col("source") != "AFCC") | F.coalesce(contactable, F.lit(False)))
    ).withColumnRenamed("right_id", "celebrant_id")

    rating = va.to_float("easy_weddings_rating").cast("string")
    count = va.to_int("easy_weddings_review_count").cast("string")
    tidy = hits.withColumns(
        {
            "easy_weddings_rating": F.coalesce(rating, "easy_weddings_rating"),
            "easy_weddings_review_count": F.coalesce(count, "easy_weddings_review_count"),
        }
    )
    updates = tidy.groupBy("celebrant_id").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_seen"))).alias(f"_u_{c}") for c in LAST_WINS],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_seen"))).alias(f"_u_{c}") for c in FIRST_IF_BLANK],
        F.bool_or(F.coalesce(va.to_bool("is_destination_specialist"), F.lit(False))).alias("_special"),
        F.bool_or(F.col("source") == "AFCC").alias("_afcc"),
    )
    seen = ag.sources_per_entity(hits, "celebrant_id", "source")
    extra = [*LAST_WINS, *FIRST_IF_BLANK, "active_signal_sources", "directory_listing_count"]
    base = master.withColumns({c: F.lit("") for c in extra if c not in master.columns})
    joined = base.join(updates, "celebrant_id", "left").join(seen, "celebrant_id", "left")

    def flag(c: Column) -> Column:
        return F.coalesce(c, F.lit(False)).cast("string")

    out: dict[str, Column] = {c: F.col(c) for c in base.columns}
    out.update({c: F.coalesce(f"_u_{c}", c) for c in LAST_WINS})
    out.update(
        {c: F.when(va.is_blank(c, GAP), F.coalesce(f"_u_{c}", c)).otherwise(F.col(c)) for c in FIRST_IF_BLANK}
    )
    out["directory_listing_count"] = F.coalesce(
        F.col("source_count").cast("string"), F.nullif("directory_listing_count", F.lit("")), F.lit("0")
    )
    out["active_signal_sources"] = F.coalesce("sources", "active_signal_sources")
    out["is_active_market"] = flag(F.col("is_active"))
    out["is_destination_specialist"] = flag(F.col("_special"))
    out["afcc_member"] = flag(F.col("_afcc"))
    merged = joined.select(*[v.alias(c) for c, v in out.items()])

    first = next(iter(DIRECTORIES))
    if first not in rows:
        return merged
    # the id is the whole address: two profiles whose slugs begin alike stay two rows, and rows without one stay apart
    url = F.regexp_replace(F.lower(ur.norm_url("easy_weddings_profile_url")), r"/+$", "")
    key = F.when(F.coalesce(url, F.lit("")) != "", url).otherwise(F.concat(F.lit("row "), F.col("row_id").cast("string")))
    slug = F.regexp_replace(F.element_at(F.split(key, "/"), -1), r"[^a-z0-9]+", "-")
    fresh = (
        linked.filter((F.col("source") == first) & F.col("right_id").isNull())
        .withColumn("celebrant_id", F.concat(F.lit("CEL-EWDIR-"), slug, F.lit("-"), F.sha2(key, 256)))
        .join(master.select("celebrant_id"), "celebrant_id", "left_anti")
    )
    fresh = dd.keep_first(fresh, ["celebrant_id"], ["row_id"])
    made = {
        "celebrant_id": F.col("celebrant_id"),
        "row_no": F.lit(None).cast(master.schema["row_no"].dataType),
        "full_name": F.col("name"),
        "ag_display_name": F.col("name"),
        "data_source": F.lit("EasyWeddings_directory"),
        "state": F.col("_state"),
        "easy_weddings_profile_url": F.coalesce("easy_weddings_profile_url", F.lit("")),
        "is_active_market": F.lit("true"),
        "active_signal_sources": F.lit(first),
        "directory_listing_count": F.lit("1"),
    }
    new = fresh.select(
        *[
            (made[c] if c == "row_no" else F.coalesce(made.get(c, F.lit(None)), F.lit(va.VERIFY_REQUIRED))).alias(c)
            for c in merged.columns
        ]
    )
    return merged.unionByName(new)


def load_rows(base: DataFrame, top: DataFrame | None, order: str | None = None) -> DataFrame:
    """Base rows, overlaid by the enriched ones, as the fixed columns without NULL."""
    if top is not None:
        base = link.overlay(base, top, "celebrant_id", order, lambda c: ~va.is_blank(c, va.BLANKS["load"]))
    shaped = conform(base, COLUMNS)
    clean = shaped.select(*[va.nullify(c, va.BLANKS["load"]).alias(c) for c in COLUMNS])
    return va.fill_sentinel(clean, COLUMNS)


def website_queue(register: DataFrame, awards: DataFrame) -> DataFrame:
    """Rows with a website: award winners first, then the rest, each by ``row_no``."""
    with_site = register.filter(~va.is_blank("website") & va.strip("website").startswith("http"))
    flagged = link.flag_members(
        with_site, awards, tx.squash_name("full_name"), tx.squash_name("full_name"), "_award"
    )
    return score.priority_queue(flagged, F.col("_award"), ["row_no"]).drop("_award")


def top_for_places(register: DataFrame, n: int = 300) -> DataFrame:
    """Award winners and the best quality first, ``n`` rows."""
    return score.top_n(
        register.withColumn("_score", score.award_score("abia_winner", "data_quality_score")), "_score", ["row_no"], n
    ).drop("_score")


def active_order(celebrants: DataFrame) -> DataFrame:
    """Active rows by tier, then review count and listings."""
    active = celebrants.filter(va.to_bool("is_active_market"))
    numbers = active.withColumns(
        {
            "_reviews": va.to_float("easy_weddings_review_count"),
            "_listings": va.to_float("directory_listing_count"),
        }
    )
    ordered = score.tier_order(numbers, "content_tier", ["_reviews", "_listings"], ["celebrant_id"])
    return ordered.drop("_reviews", "_listings")


def patch_places(celebrants: DataFrame, candidates: DataFrame, threshold: int = 60) -> DataFrame:
    """Celebrants patched by the first good place candidate.

    ``candidates``: celebrant_id, query_no, candidate_name, payload (JSON).
    """
    names = celebrants.select("celebrant_id", "full_name")
    scored = candidates.join(names, "celebrant_id").withColumn(
        "fuzzy", sim.token_sort_ratio("full_name", "candidate_name")
    )
    chosen = link.best_candidate(
        scored, "celebrant_id", "fuzzy", "query_no", ["candidate_name", "payload"], threshold
    ).filter("is_match")
    flat = pl.flatten_place(chosen.select("celebrant_id", "fuzzy", "payload"), "payload")
    patch = flat.select(
        "celebrant_id",
        F.col("place_id").alias("google_place_id"),
        "google_name",
        F.col("formatted_address").alias("google_address"),
        "lat",
        "lng",
        F.col("phone_local").alias("google_phone"),
        F.format_string("%.1f", "google_rating").alias("google_rating_text"),
        F.col("google_rating").alias("_rating"),
        F.col("google_review_count").cast("string").alias("google_review_count"),
        va.match_band("fuzzy").alias("places_match_confidence"),
    )
    wide = celebrants.withColumns(
        {
            c: F.lit(None).cast(patch.schema[c].dataType)
            for c in patch.columns
            if c not in celebrants.columns and c != "celebrant_id"
        }
    )
    patched = merge.patch_non_null(wide, patch, ["celebrant_id"])
    rating = F.when(F.col("_rating").isNotNull(), F.col("google_rating_text"))
    quality = score.quality_score(
        "_rating", va.to_float("easy_weddings_rating"), va.to_float("directory_listing_count"), "abia_winner"
    )
    done = F.col("places_match_confidence").isNotNull()
    out = patched.withColumn("celebrant_quality_score", F.when(done, quality))
    if "google_rating" in celebrants.columns:
        out = out.withColumn("google_rating", F.coalesce(rating, F.col("google_rating").cast("string")))
    else:
        out = out.withColumn("google_rating", rating)
    return out.drop("_rating", "google_rating_text")


def active_profile(celebrants: DataFrame) -> DataFrame:
    """One-row summary of the directory."""
    active = F.coalesce(va.to_bool("is_active_market"), F.lit(False))
    listings = F.coalesce(va.to_int("directory_listing_count"), F.lit(0))
    return ag.profile(
        celebrants,
        counts={
            "active": active,
            "in_easy_weddings": F.col("easy_weddings_profile_url").startswith("http"),
            "afcc_members": F.coalesce(va.to_bool("afcc_member"), F.lit(False)),
            "in_two_or_more": listings >= 2,
            "specialists": F.coalesce(va.to_bool("is_destination_specialist"), F.lit(False)),
        },
    )
