"""Venue jobs: publishing a checked sheet, monthly snapshots, flood risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions import payloads as pl
from gazetta.functions import similarity as sim
from gazetta.functions import text as tx
from gazetta.functions import values as va
from gazetta.operators import dedupe as dd
from gazetta.operators import gates, geo, link, merge

# Sheet columns and the table column each one fills.
SHEET_TEXTS = {
    "NAME": "name",
    "STATE": "state",
    "REGION": "region",
    "TYPE": "type",
    "WEBSITE": "website",
    "formatted_address": "address",
    "place_id": "place_id",
    "google_name": "google_name",
    "business_status": "business_status",
    "places_match_confidence": "places_match_confidence",
    "AWARD 2025": "award_2025",
    "AWARD BODY": "award_body",
    "INSTAGRAM HANDLE": "instagram_handle",
    "SETTING": "setting",
    "PRICE TIER": "price_tier",
    "ENRICHMENT STATUS": "enrichment_status",
    "DATA SOURCE": "data_source",
}
SHEET_NUMBERS = {
    "google_review_count": "google_review_count",
    "fuzzy_match_score": "fuzzy_match_score",
    "total_photo_count": "total_photo_count",
    "CAPACITY MAX": "capacity_max",
    "price_level": "price_level",
}
SHEET_FLAGS = (*pl.ACCESS_FLAGS.values(), *pl.PLACE_FLAGS.values(), *pl.PARKING_FLAGS.values())

# Fixed value: name score from which a place's full payload is taken.
ACCEPT_SCORE = 70
# Columns that stay empty below that score.
FULL_ONLY = (
    "formatted_address", "adr_address", "postcode", "lat", "lng", "google_rating",
    "google_review_count", "google_maps_url", "phone_international", "price_level",
    "editorial_summary", "google_types_json", "total_photo_count",
    *[f"photo_ref_{i}" for i in range(1, 5)], *SHEET_FLAGS,
    *[f"review_{p}_{i}" for i in range(1, 6) for p in ("text", "author", "rating", "date")],
)


def enrich_places(venues: DataFrame, payloads: DataFrame) -> DataFrame:
    """Venue columns from the found place, or only the safe part below the name score.

    ``venues``: row_index, NAME ...; ``payloads``: row_index, payload.  The
    outcome is HIGH, MEDIUM, LOW or NO_MATCH.
    """
    flat = pl.flatten_place(payloads, "payload")
    named = flat.withColumn(
        "google_name",
        va.first_filled(va.strip("google_name"), F.col("formatted_address")),
    )
    own = venues.drop(*[c for c in named.columns if c != "row_index"])
    joined = own.join(named, "row_index", "left")
    scored = joined.withColumn("fuzzy_match_score", sim.token_sort_ratio("NAME", "google_name"))
    ratio = sim.sequence_ratio(tx.spaced_name("NAME"), tx.spaced_name("google_name"))
    rated = scored.withColumn("_conf", va.name_confidence(ratio))
    out = link.accept_or_partial(rated, "fuzzy_match_score", ACCEPT_SCORE, FULL_ONLY, F.col("_conf"))
    missing = F.col("place_id").isNull()
    return out.withColumn(
        "places_match_confidence", F.when(missing, F.lit("NO_MATCH")).otherwise(F.col("confidence"))
    ).drop("_conf", "confidence")


def publish_venues(sheet: DataFrame, order: str) -> DataFrame:
    """HIGH and OPERATIONAL rows, one per place id (first by ``order``), typed."""
    good = gates.publishable(sheet, "places_match_confidence", "business_status")
    good = good.filter(~va.is_blank("place_id", va.BLANKS["load"]))
    first = dd.keep_first(good, ["place_id"], [order])
    blanks = va.BLANKS["load"]
    has = sheet.columns
    return first.select(
        *[va.nullify(F.col(f"`{s}`"), blanks, trimmed=False).alias(t) for s, t in SHEET_TEXTS.items() if s in has],
        *[va.to_int(F.col(f"`{s}`")).alias(t) for s, t in SHEET_NUMBERS.items() if s in has],
        *[va.to_bool(f).alias(f) for f in SHEET_FLAGS if f in has],
        *[va.postcode_text(c).alias(c) for c in ("postcode",) if c in has],
        *[va.to_float(c).alias(c) for c in ("lat", "lng", "google_rating") if c in has],
    )


def monthly_snapshot(
    venues: DataFrame, payloads: DataFrame, history: DataFrame, captured_at: Column
) -> DataFrame:
    """Rows to append to the rating history for the month of ``captured_at``.

    ``payloads``: id, place_json, pollen_json, air_json, answer.  Venues need a
    place id and readable coordinates.  Deltas compare with the latest earlier
    month; a venue that already has this month is skipped.
    """
    place_id = va.first_filled(
        va.strip(va.pick_alias(venues, ["place_id"])), va.strip(va.pick_alias(venues, ["google_place_id"]))
    )
    usable = venues.select(
        F.col("id").cast("string").alias("venue_id"),
        place_id.alias("place_id"),
        va.to_float(va.coalesce_alias(venues, ["latitude", "lat"])).alias("lat"),
        va.to_float(va.coalesce_alias(venues, ["longitude", "lng"])).alias("lng"),
    ).filter("venue_id is not null and place_id is not null and lat is not null and lng is not null")
    raw = usable.join(payloads.withColumnRenamed("id", "venue_id"), "venue_id", "left")
    parsed = raw.withColumn("_place", pl.parse("place_json", pl.PLACE))
    reviews = pl.review_columns(F.col("_place.reviews"), typed_date=True)
    placed = parsed.withColumns(
        {
            "google_rating": F.col("_place.rating"),
            "review_count": F.col("_place.userRatingCount"),
            **reviews,
            "captured_at": captured_at,
        }
    ).drop("_place")
    filled = va.count_filled(*[f"review_text_{i}" for i in range(1, 6)])
    full = pl.add_sentiment(
        pl.add_air(pl.add_pollen(placed, "pollen_json"), "air_json"), "answer", filled
    ).drop("place_json", "pollen_json", "air_json", "answer", "place_id", "lat", "lng")
    month = merge.period_key(captured_at)
    now = full.withColumn("captured_date", month)
    previous = dd.latest_before(history, ["venue_id"], "captured_date", month).select(
        "venue_id", F.col("google_rating").alias("_rating"), F.col("review_count").alias("_count")
    )
    out = now.join(previous, "venue_id", "left").withColumns(
        {
            "review_delta": F.col("review_count") - F.col("_count"),
            "rating_delta": F.col("google_rating") - F.col("_rating"),
        }
    )
    return merge.insert_only(history, out.drop("_rating", "_count"), ["venue_id", "captured_date"], ["captured_at"])


# Fixed value: where the flood polygons come from.
FLOOD_SOURCE = "Geoscience Australia National Flood Hazard"


def flood_risk(venues: DataFrame, polygons: DataFrame | None, attributes: list[str], **search) -> DataFrame:
    """Worst flood category per venue; Unknown where there are no polygon data at all.

    ``search`` goes to :func:`gazetta.operators.geo.points_in_polygons` (cell, salts).
    """
    if polygons is None:
        rated = venues.withColumn("category", F.lit("Unknown"))
    else:
        rated = geo.worst_severity(venues, polygons, "id", "ring", attributes, **search)
    return rated.withColumnRenamed("category", "flood_risk_category").withColumn(
        "flood_data_source", F.lit(FLOOD_SOURCE)
    )
