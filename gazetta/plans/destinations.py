"""Destination, tourism and park jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions import text as tx
from gazetta.functions import urls as ur
from gazetta.functions import values as va
from gazetta.operators import geo, link, merge, score


def pick_destinations(destinations: DataFrame, phrases: Sequence[str], n: int = 40) -> DataFrame:
    """The ``n`` most promising active destinations."""
    active = destinations.filter(F.col("is_active"))
    points = score.destination_score(
        "destination_slug", "destination_name", "hierarchy_level", "is_destination_wedding_location", phrases
    )
    return score.pick_scored(active, points, ["destination_id"], n)


def celebrant_near(destinations: DataFrame, celebrants: DataFrame, threshold: int = 55) -> DataFrame:
    """'id|name' of the celebrant of the same state whose name is closest to the destination's."""
    left = destinations.select(
        "destination_id", F.col("destination_name").alias("_dest"), F.col("state_code").alias("state")
    )
    right = celebrants.select("state", "row_no", "celebrant_id", "full_name")
    keyed = right.withColumn("_who", F.concat_ws("|", "celebrant_id", "full_name"))
    linked = link.fuzzy_link(
        left, keyed, "destination_id", "_dest", "_who", "full_name", threshold, right_order="row_no", block=["state"]
    )
    return linked.select("destination_id", F.col("right_id").alias("celebrant_crossref"))


def service_rows(
    destinations: DataFrame, airports: DataFrame, answers: DataFrame, celebrants: DataFrame
) -> DataFrame:
    """Destination services: the answer's values first, computed ones where it has none (0 counts as none).

    ``answers``: destination_id and text columns; ``airports``: airport_no, iata, airport_name, lat, lng.
    """
    usable = airports.select(
        "airport_no",
        F.upper(va.strip("iata")).alias("iata"),
        va.strip("airport_name").alias("airport_name"),
        va.to_float("lat").alias("lat"),
        va.to_float("lng").alias("lng"),
    ).filter("lat is not null and lng is not null")
    close = geo.nearest(destinations, usable, ["iata", "airport_name"], "airport_no")
    close = close.withColumns(
        {"_km": va.round_int("near_km"), "_mins": geo.drive_minutes(va.round_int("near_km"))}
    )
    joined = close.join(answers, "destination_id", "left").join(
        celebrant_near(destinations, celebrants), "destination_id", "left"
    )

    def number(c: str) -> Column:
        return va.round_int(va.to_float(c))

    return joined.select(
        "destination_id",
        "state_code",
        va.first_filled(va.strip("nearest_airport_name"), "near_airport_name").alias("nearest_airport_name"),
        va.first_filled(va.strip("nearest_airport_iata"), "near_iata").alias("nearest_airport_iata"),
        va.first_filled(number("nearest_airport_distance_km"), "_km", zero_is_blank=True).alias(
            "nearest_airport_distance_km"
        ),
        va.first_filled(number("nearest_airport_drive_mins"), "_mins", zero_is_blank=True).alias(
            "nearest_airport_drive_mins"
        ),
        va.to_bool("rideshare_available", "default").alias("rideshare_available"),
        F.coalesce("celebrant_crossref", F.lit("")).alias("celebrant_crossref"),
        va.first_filled(va.strip("data_confidence"), F.lit("medium")).alias("data_confidence"),
    )


# Tourism columns, the answer field and how it is cleaned.
TOURISM_FIELDS = {
    "visitor_centre_email": ("email", ur.clean_email),
    "social_instagram": ("instagram", lambda c: ur.social_profile(c, "instagram")),
    "social_facebook": ("facebook", lambda c: ur.social_profile(c, "facebook")),
    "social_pinterest": ("pinterest", lambda c: ur.social_profile(c, "pinterest")),
    "website_weddings_page": ("weddings_url", ur.clean_link),
    "website_events_page": ("events_url", ur.clean_link),
}


def fill_tourism_gaps(orgs: DataFrame, answers: DataFrame, now: Column) -> DataFrame:
    """Blank contact columns and coordinates of tourism organisations from their answers."""
    cleaned = answers.select(
        "org_id",
        *[clean(F.col(f)).alias(c) for c, (f, clean) in TOURISM_FIELDS.items()],
        geo.valid_point("lat", "lng").alias("_point"),
    )
    # NOT_FOUND is written too: it says that the field was looked for
    blanks = [b for b in va.BLANKS["gaps"] if b != "not_found"]
    updates = cleaned.drop("_point")
    filled = _fill(orgs, updates, ["org_id"], blanks, now)
    points = cleaned.select("org_id", "_point")
    joined = filled.join(points, "org_id", "left")
    lat, lng = va.to_float(F.col("lat").cast("string")), va.to_float(F.col("lng").cast("string"))
    empty = (F.abs(F.coalesce(lat, F.lit(0.0))) < 0.0001) & (F.abs(F.coalesce(lng, F.lit(0.0))) < 0.0001)
    gap = empty & F.col("_point").isNotNull()
    return joined.withColumns(
        {
            "lat": F.when(gap, F.col("_point.lat")).otherwise(lat),
            "lng": F.when(gap, F.col("_point.lng")).otherwise(lng),
            "updated_at": F.when(gap, now).otherwise(F.col("updated_at")),
        }
    ).drop("_point")


def _fill(target: DataFrame, updates: DataFrame, keys: list[str], update_blanks: Sequence[str], now: Column) -> DataFrame:
    """Fill target gaps, where an update of NOT_FOUND also counts as filled."""
    marked = updates.select(
        *keys, *[va.nullify(c, update_blanks).alias(c) for c in updates.columns if c not in keys]
    )
    cols = [c for c in updates.columns if c not in keys]
    joined = target.join(marked.withColumnsRenamed({c: f"_u_{c}" for c in cols}), keys, "left")
    gaps = {c: va.is_blank(c, va.BLANKS["gaps"]) & F.col(f"_u_{c}").isNotNull() for c in cols}
    changed = F.lit(False)
    for c, gap in gaps.items():
        changed = changed | (gap & ~F.col(f"_u_{c}").eqNullSafe(F.col(c)))
    old = F.col("updated_at") if "updated_at" in target.columns else F.lit(None).cast("timestamp")
    return joined.withColumns(
        {"updated_at": F.when(changed, now).otherwise(old)}
    ).withColumns({c: F.when(gap, F.col(f"_u_{c}")).otherwise(F.col(c)) for c, gap in gaps.items()}).drop(
        *[f"_u_{c}" for c in cols]
    )


# Park columns and the answer field of each.
PARK_FIELDS = {
    "contact_email": "email",
    "contact_phone": "phone",
    "website_weddings_permit_page": "permit_url",
    "hq_suburb": "hq_suburb",
    "typical_permit_fee_range_aud": "fee_range",
}


def fill_park_gaps(parks: DataFrame, answers: DataFrame, now: Column, fields: Mapping[str, str] = PARK_FIELDS) -> DataFrame:
    """Columns still marked VERIFY_REQUIRED take the answer, or NOT_FOUND; links become absolute."""
    blanks = va.BLANKS["permit"]
    base = parks.select("npark_id", F.col("website_homepage").alias("_home"))
    raw = answers.join(base, "npark_id")
    cleaned = raw.select(
        "npark_id",
        *[
            F.coalesce(
                ur.resolve_link("_home", va.nullify(f, blanks)) if f == "permit_url" else va.nullify(f, blanks),
                F.lit(va.NOT_FOUND),
            ).alias(c)
            for c, f in fields.items()
        ],
    )
    return merge.fill_gaps(
        parks,
        cleaned,
        ["npark_id"],
        blanks=("verify_required",),
        stamp=("updated_at", now),
        null_is_gap=False,
    )


def search_texts(venues: DataFrame) -> DataFrame:
    """Primary and fallback search text of a venue."""
    region = va.before_slash("REGION")
    return venues.withColumns(
        {
            "primary_query": va.query_text("NAME", region, "STATE", suffix="Australia"),
            "fallback_query": va.query_text("NAME", F.lit("wedding venue"), "STATE", suffix="Australia"),
        }
    )


def slug_names(df: DataFrame, slug: str) -> DataFrame:
    """Readable name from a slug."""
    return df.withColumn("name", F.initcap(F.replace(F.col(slug), F.lit("-"), F.lit(" ")))).withColumn(
        "name_key", tx.squash_name("name")
    )
