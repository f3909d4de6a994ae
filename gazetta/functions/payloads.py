"""Columns out of nested JSON payloads, and JSON out of prose."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetta.functions import text as tx
from gazetta.functions import urls as ur
from gazetta.functions import values as va
from gazetta.functions.values import as_col, strip

_TEXT = T.StructType([T.StructField("text", T.StringType())])

REVIEW = T.StructType(
    [
        T.StructField("text", _TEXT),
        T.StructField("originalText", _TEXT),
        T.StructField(
            "authorAttribution", T.StructType([T.StructField("displayName", T.StringType())])
        ),
        T.StructField("rating", T.IntegerType()),
        T.StructField("publishTime", T.StringType()),
    ]
)


def _flags(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.BooleanType()) for n in names])


# Payload flags and the output column each one fills.
ACCESS_FLAGS = {
    "wheelchairAccessibleEntrance": "wheelchair_accessible_entrance",
    "wheelchairAccessibleParking": "wheelchair_accessible_parking",
    "wheelchairAccessibleRestroom": "wheelchair_accessible_restroom",
    "wheelchairAccessibleSeating": "wheelchair_accessible_seating",
}
PARKING_FLAGS = {
    "freeParkingLot": "parking_free_lot",
    "paidParkingLot": "parking_paid",
    "valetParking": "parking_valet",
    "freeStreetParking": "parking_street",
}
PLACE_FLAGS = {
    "outdoorSeating": "has_outdoor_seating",
    "liveMusic": "has_live_music",
    "goodForGroups": "good_for_groups",
    "servesWine": "serves_wine",
    "servesBeer": "serves_beer",
    "reservable": "is_reservable",
}
PLACE_TEXTS = {
    "businessStatus": "business_status",
    "formattedAddress": "formatted_address",
    "adrFormatAddress": "adr_address",
    "websiteUri": "website_from_google",
    "nationalPhoneNumber": "phone_local",
    "internationalPhoneNumber": "phone_international",
    "primaryType": "google_primary_type",
}
PRICE_LEVELS = {
    "0": ("PRICE_LEVEL_FREE",),
    "1": ("PRICE_LEVEL_INEXPENSIVE",),
    "2": ("PRICE_LEVEL_MODERATE",),
    "3": ("PRICE_LEVEL_EXPENSIVE",),
    "4": ("PRICE_LEVEL_VERY_EXPENSIVE",),
}

PLACE = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("displayName", _TEXT),
        T.StructField("googleMapsUri", T.StringType()),
        *[T.StructField(n, T.StringType()) for n in PLACE_TEXTS],
        T.StructField(
            "location",
            T.StructType(
                [
                    T.StructField("latitude", T.DoubleType()),
                    T.StructField("longitude", T.DoubleType()),
                ]
            ),
        ),
        T.StructField("rating", T.DoubleType()),
        T.StructField("userRatingCount", T.IntegerType()),
        T.StructField(
            "photos", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))
        ),
        # Free-form object: read as text, so that its JSON is carried through unchanged.
        T.StructField("regularOpeningHours", T.StringType()),
        T.StructField("types", T.ArrayType(T.StringType())),
        T.StructField("priceLevel", T.StringType()),
        T.StructField("editorialSummary", _TEXT),
        *[T.StructField(n, T.BooleanType()) for n in PLACE_FLAGS],
        T.StructField("accessibilityOptions", _flags(list(ACCESS_FLAGS))),
        T.StructField("parkingOptions", _flags(list(PARKING_FLAGS))),
        T.StructField("reviews", T.ArrayType(REVIEW)),
    ]
)

POLLEN = T.StructType(
    [
        T.StructField(
            "dailyInfo",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "pollenTypeInfo",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("code", T.StringType()),
                                        T.StructField(
                                            "indexInfo",
                                            T.StructType(
                                                [T.StructField("value", T.IntegerType())]
                                            ),
                                        ),
                                    ]
                                )
                            ),
                        )
                    ]
                )
            ),
        )
    ]
)

AIR = T.StructType(
    [
        T.StructField(
            "indexes",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("code", T.StringType()),
                        T.StructField("aqi", T.IntegerType()),
                        T.StructField("category", T.StringType()),
                        T.StructField("dominantPollutant", T.StringType()),
                    ]
                )
            ),
        )
    ]
)

SENTIMENT = T.StructType(
    [
        T.StructField("sentiment_score", T.StringType()),
        T.StructField("top_themes", T.ArrayType(T.StringType())),
        T.StructField("red_flags", T.ArrayType(T.StringType())),
        T.StructField("one_line_summary", T.StringType()),
    ]
)


# -- salvage ----------------------------------------------------------------


def _fenced(value: Column) -> Column:
    """Content of the first code fence, NULL without one."""
    return F.nullif(
        F.regexp_extract(value, r"(?is)```(?:json)?\s*(.*?)```", 1), F.lit("")
    )


def _valid(json_text: Column) -> Column:
    """The text itself where it is exactly one JSON value, else NULL.

    The parser stops after the first value.  Inside an array and inside an object
    anything behind it is an error in at least one of the two.
    """

    def checked(t: Column) -> Column:
        in_array = F.try_parse_json(F.concat(F.lit("["), t, F.lit("]")))
        in_object = F.try_parse_json(F.concat(F.lit('{"x":'), t, F.lit("}")))
        return F.when(in_array.isNotNull() & in_object.isNotNull(), t)

    return va.let(json_text, checked)


def salvage_json(value: Column | str) -> Column:
    """First '{' to last '}' of the text as JSON text; NULL when it does not parse."""
    text = as_col(value)
    return _valid(F.nullif(F.regexp_extract(text, r"(?s)(\{.*\})", 1), F.lit("")))


def fenced_json(value: Column | str) -> Column:
    """The code fence's content (or the whole text) as JSON text; NULL when it does not parse."""
    text = strip(value)
    return _valid(strip(F.coalesce(_fenced(text), text)))


def salvage_items(value: Column | str, item: T.StructType, under: str = "sources") -> Column:
    """Array of objects: the whole text, a fence, an embedded ``[...]`` or the list under a key."""
    wrapper = T.StructType([T.StructField(under, T.ArrayType(item))])
    kind = T.ArrayType(item)

    def as_items(good: Column) -> Column:
        listed = F.when(good.startswith("["), F.from_json(good, kind))
        keyed = F.when(good.startswith("{"), F.coalesce(F.from_json(good, wrapper)[under], F.array().cast(kind)))
        return F.coalesce(listed, keyed)

    def pick(body: Column) -> Column:
        embedded = F.nullif(F.regexp_extract(body, r"(?s)(\[.*\])", 1), F.lit(""))
        return va.let(F.coalesce(_valid(body), _valid(embedded)), as_items)

    text = strip(value)
    return F.filter(va.let(strip(F.coalesce(_fenced(text), text)), pick), lambda x: x.isNotNull())


def parse(value: Column | str, schema: T.DataType) -> Column:
    """Typed payload; broken JSON gives NULL fields, not an error."""
    return F.from_json(as_col(value), schema)


def to_json_text(value: Column | str) -> Column:
    return F.to_json(as_col(value))


def valid_json_text(value: Column | str) -> Column:
    """Trimmed JSON text, NULL when blank or unreadable."""
    return _valid(va.nullify(value, va.BLANKS["load"]))


# -- arrays -----------------------------------------------------------------


def find_by_code(items: Column | str, code: str, fallback_first: bool = False) -> Column:
    """First array element with the code (any case); optionally the first element at all."""
    arr = as_col(items)
    hit = F.get(F.filter(arr, lambda x: F.upper(x["code"]) == code.upper()), F.lit(0))
    return F.coalesce(hit, F.get(arr, F.lit(0))) if fallback_first else hit


def arg_max(options: Sequence[tuple[str, Column | str]]) -> Column:
    """Label of the largest non-NULL value; ties go to the label listed first."""
    entries = F.array(
        *[
            F.when(
                as_col(v).isNotNull(),
                F.struct(as_col(v).alias("v"), F.lit(-i).alias("o"), F.lit(name).alias("name")),
            )
            for i, (name, v) in enumerate(options)
        ]
    )
    return F.array_max(F.filter(entries, lambda e: e.isNotNull()))["name"]


def list_of(value: Column | str, pattern: str = r"[,;\n]+") -> Column:
    """Delimited text to an array of trimmed, non-empty parts; NULL -> empty array."""
    parts = F.filter(F.transform(F.split(as_col(value), pattern), strip), lambda x: x != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def clean_list(value: Column | str) -> Column:
    """Array with trimmed, non-empty elements; NULL -> empty array."""
    parts = F.filter(F.transform(as_col(value), strip), lambda x: x != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def list_text(value: Column | str, sep: str = "|") -> Column:
    return F.array_join(as_col(value), sep)


# -- place, pollen, air and sentiment payloads ------------------------------


def review_columns(reviews: Column, n: int = 5, typed_date: bool = False) -> dict[str, Column]:
    """``review_{text,author,rating,date}_1..n`` from an array of reviews."""
    out: dict[str, Column] = {}
    for i in range(n):
        rv = F.get(reviews, F.lit(i))
        published = F.nullif(rv["publishTime"], F.lit(""))
        out[f"review_text_{i + 1}"] = va.first_filled(rv["text"]["text"], rv["originalText"]["text"])
        out[f"review_author_{i + 1}"] = F.nullif(rv["authorAttribution"]["displayName"], F.lit(""))
        out[f"review_rating_{i + 1}"] = rv["rating"]
        out[f"review_date_{i + 1}"] = va.iso_timestamp(published) if typed_date else published
    return out


def place_columns(
    place: Column, fallback_id: Column | str | None = None, photo_columns: int = 4, reviews: int = 5
) -> dict[str, Column]:
    """One column per attribute of a place payload; the number of photo and review columns is the caller's."""
    place_id = F.nullif(tx.strip_prefix(place["name"]), F.lit(""))
    if fallback_id is not None:
        place_id = F.coalesce(place_id, as_col(fallback_id))
    photos = place["photos"]
    out = {
        "place_id": place_id,
        "google_name": place["displayName"]["text"],
        "google_maps_url": F.coalesce(
            F.nullif(place["googleMapsUri"], F.lit("")),
            F.concat(F.lit("https://www.google.com/maps/place/?q=place_id:"), place_id),
        ),
        **{c: F.nullif(place[f], F.lit("")) for f, c in PLACE_TEXTS.items()},
        "postcode": tx.postcode(place["formattedAddress"], "last"),
        "lat": place["location"]["latitude"],
        "lng": place["location"]["longitude"],
        "google_rating": place["rating"],
        "google_review_count": place["userRatingCount"],
        **{
            f"photo_ref_{i + 1}": F.nullif(F.get(photos, F.lit(i))["name"], F.lit(""))
            for i in range(photo_columns)
        },
        "total_photo_count": F.coalesce(F.size(photos), F.lit(0)),
        "opening_hours": place["regularOpeningHours"],
        "price_level": price_level(place["priceLevel"]),
        "editorial_summary": F.nullif(place["editorialSummary"]["text"], F.lit("")),
        "google_types_json": F.coalesce(F.to_json(place["types"]), F.lit("[]")),
        **{c: place["accessibilityOptions"][f] for f, c in ACCESS_FLAGS.items()},
        **{c: place[f] for f, c in PLACE_FLAGS.items()},
        **{c: place["parkingOptions"][f] for f, c in PARKING_FLAGS.items()},
    }
    out.update(review_columns(place["reviews"], reviews))
    return out


def price_level(value: Column | str) -> Column:
    """Named price level or a plain 0-4 to an integer; unspecified -> NULL."""
    text = strip(value)
    named = va.fold_synonyms(value, PRICE_LEVELS)
    return F.coalesce(named, F.when(text.rlike("^[0-4]$"), text)).cast("int")


def flatten_place(df: DataFrame, payload: str, fallback_id: str | None = None) -> DataFrame:
    """Replace a JSON payload column by the columns of :func:`place_columns`."""
    parsed = df.withColumn("_place", parse(payload, PLACE))
    keep = [F.col(c) for c in df.columns if c != payload]
    made = place_columns(F.col("_place"), fallback_id)
    return parsed.select(*keep, *[c.alias(n) for n, c in made.items()])


# Pollen kinds in tie order.
POLLEN_KINDS = ("GRASS", "TREE", "WEED")


def add_pollen(df: DataFrame, payload: str) -> DataFrame:
    """Index 0-5 per pollen kind and the dominant kind (ties in list order).

    Each step is a projection of its own, so the payload is parsed once per row.
    """
    names = {k: f"pollen_{k.lower()}_index" for k in POLLEN_KINDS}
    kinds = F.get(parse(payload, POLLEN)["dailyInfo"], F.lit(0))["pollenTypeInfo"]
    found = df.withColumn("_kinds", kinds).withColumns(
        {n: find_by_code("_kinds", k)["indexInfo"]["value"] for k, n in names.items()}
    )
    bounded = found.drop("_kinds").withColumns(
        {n: va.clamp(n, 0, 5).cast("smallint") for n in names.values()}
    )
    return bounded.withColumn("dominant_pollen_type", arg_max(list(names.items())))


def add_air(df: DataFrame, payload: str) -> DataFrame:
    """The universal index if present, else the first index."""
    pick = find_by_code("_indexes", "uaqi", fallback_first=True)
    parsed = df.withColumn("_indexes", parse(payload, AIR)["indexes"]).withColumn("_air", pick)
    return parsed.withColumns(
        {
            "air_quality_index": F.col("_air.aqi"),
            "air_quality_category": F.col("_air.category"),
            "dominant_pollutant": F.nullif(F.lower("_air.dominantPollutant"), F.lit("")),
        }
    ).drop("_indexes", "_air")


def add_sentiment(
    df: DataFrame, answer: str, filled_reviews: Column | str | None = None, themes: int | None = None
) -> DataFrame:
    """Score within 0-1, themes, flags as text; NULL below two reviews or without score.

    ``themes`` takes that many themes at most.
    """
    parsed = df.withColumn("_rec", parse(salvage_json(answer), SENTIMENT)).withColumn(
        "sentiment_score", va.clamp(va.to_float("_rec.sentiment_score"), 0.0, 1.0)
    )
    if filled_reviews is not None:
        enough = as_col(filled_reviews) >= 2
        parsed = parsed.withColumn("sentiment_score", F.when(enough, F.col("sentiment_score")))
    empty = F.array().cast("array<string>")
    valid = F.col("sentiment_score").isNotNull()
    named = F.coalesce(F.col("_rec.top_themes"), empty)
    return parsed.withColumns(
        {
            "sentiment_themes": F.when(valid, named if themes is None else F.slice(named, 1, themes)),
            "red_flags": F.when(valid, F.coalesce(F.col("_rec.red_flags"), empty)),
            "one_line_summary": F.when(
                valid, F.nullif(strip("_rec.one_line_summary"), F.lit(""))
            ),
        }
    ).drop("_rec")


# -- typed records ----------------------------------------------------------

# Allowed words of a permit, source and enrichment record.
TRUST_LEVELS = ("high", "medium", "low")
GENDERS = {
    "F": ("f", "female", "woman"),
    "M": ("m", "male", "man"),
    "NB": ("nb", "nonbinary", "non-binary", "enby"),
}
AUDIENCE_SIZES = ("small", "medium", "large", "mega")
AUDIENCE_TYPES = ("couples", "industry", "both")


def permit_record(rec: Column) -> dict[str, Column]:
    """All-text permit answer to typed columns."""
    words = ("permit_required", "insurance_required", "alcohol_permitted", "caterers_approved_list")
    numbers = ("permit_lead_time_days", "max_guests_outdoor")
    texts = (
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
        "notes",
    )
    blanks = va.BLANKS["permit"]
    return {
        **{t: va.nullify(rec[t], blanks) for t in texts},
        **{w: va.to_bool(rec[w]) for w in words},
        **{n: va.to_int(rec[n], "digits").cast("int") for n in numbers},
        "approved_locations": list_of(rec["approved_locations"]),
        "data_confidence": va.confidence_band(rec["data_confidence"]),
    }


def source_record(rec: Column) -> dict[str, Column]:
    """Discovered source to typed columns; ``url`` is the dedupe key."""
    return {
        "name": va.nullify(rec["name"], ("",)),
        "url": F.nullif(ur.norm_url(rec["url"]), F.lit("")),
        "source_type": va.nullify(rec["source_type"], ("",)),
        "states": tx.code_list_text(rec["states"]),
        "instagram_handle": F.nullif(ur.bare_handle(rec["instagram"]), F.lit("")),
        "trust_level": va.enum_or(rec["trust_level"], TRUST_LEVELS, "medium"),
        "key_locations": list_text(list_of(rec["key_locations"])),
        "data_confidence": F.coalesce(va.nullify(rec["data_confidence"], ("",)), F.lit("medium")),
    }


def enrichment_record(rec: Column, specialisms: Sequence[str]) -> dict[str, Column]:
    """Enrichment answer to typed columns; enums are stored lower case."""
    score = va.clamp(va.to_int(rec["relevance_score"], "strict"), 1, 10)
    return {
        "specialism_primary": va.enum_or(rec["specialism_primary"], specialisms),
        "specialism_tags": F.nullif(list_text(list_of(rec["specialism_tags"])), F.lit("")),
        "founder_gender": va.fold_synonyms(rec["founder_gender"], GENDERS),
        "audience_size_estimate": va.enum_or(rec["audience_size_estimate"], AUDIENCE_SIZES),
        "audience_type": va.enum_or(rec["audience_type"], AUDIENCE_TYPES),
        "partnership_potential": va.enum_or(rec["partnership_potential"], TRUST_LEVELS),
        "has_advertising": va.to_bool(rec["has_advertising"]),
        "has_affiliate": va.to_bool(rec["has_affiliate"]),
        "insurance_hook": F.coalesce(va.to_bool(rec["insurance_hook"]), F.lit(False)),
        "avg_posts_per_month": va.to_int(rec["avg_posts_per_month"], "strict"),
        "relevance_score": score,
        "outreach_priority": va.outreach_band(score),
    }
