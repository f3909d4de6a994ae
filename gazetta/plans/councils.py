"""Council jobs: directory from link pages, alignment with destinations, permits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.functions import payloads as pl
from gazetta.functions import text as tx
from gazetta.functions import urls as ur
from gazetta.functions import values as va
from gazetta.operators import aggregate as ag
from gazetta.operators import dedupe as dd
from gazetta.operators import gates, link, merge
from gazetta.operators import pages as pg

# Councils expected per state.
EXPECTED = {"NSW": 128, "QLD": 77, "VIC": 79, "TAS": 29, "SA": 68, "WA": 137}


def build_councils(
    pages: DataFrame, region: str = "state_code", ids: str = "stable"
) -> tuple[DataFrame, DataFrame]:
    """Council rows and rejects out of link pages (page_id, url, html, region).

    ``stable`` ids depend on the council alone; ``sequence`` ids are positions in
    the sorted list of the state and move when a council is added.
    """
    suffix = F.concat(F.lit("."), F.lower(region), F.lit(".gov.au"))
    found = pg.entity_links(pages, region, region_suffix=suffix)
    rows = found.select(
        F.col("name").alias("council_name"), F.col(region).alias("state_code"), "website", F.col("rule").alias("url_pattern")
    )
    reason = gates.reject_reason("council_name", "state_code", "website")
    good, bad = gates.split_rejects(rows, reason)
    if ids == "stable":
        key = dd.stable_id("", "state_code", "council_name", ur.norm_url("website"))
        return good.withColumn("council_id", F.concat(F.lit("CNCL-"), "state_code", F.lit("-"), key)), bad
    order = ["council_name", "website"]
    return dd.sequence_ids(good, ["state_code"], order, "CNCL-%s-%03d", "council_id"), bad


def council_coverage(councils: DataFrame) -> DataFrame:
    expected = councils.sparkSession.createDataFrame(list(EXPECTED.items()), "state_code string, expected long")
    return ag.coverage(councils, expected, "state_code")


def align(councils: DataFrame, destinations: DataFrame) -> DataFrame:
    """Councils with their destination ids.

    With a local-government column the names are compared in both directions,
    otherwise the council's short name must occur in the destination's name.
    """
    out = "aligned_destination_ids"
    bare = councils.drop(out)
    if "lga_name" in destinations.columns:
        return link.containment_align(
            bare, destinations, ["state_code"], "council_name", "lga_name", "destination_id", out
        )
    short = bare.withColumn("_short", F.split_part(F.lower("council_name"), F.lit(" council"), F.lit(1)))
    return link.containment_align(
        short, destinations, ["state_code"], "_short", "destination_name", "destination_id", out, both_ways=False
    ).drop("_short")


def permit_groups(destinations: DataFrame, councils: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, groups): destinations by owning council, the rest by the host of their permit page."""
    active = councils.filter(F.col("is_active") & ur.is_real_href("website"))
    owners = link.array_owner(
        active, "aligned_destination_ids", "council_id", ["council_name", "state_code", "website"], "destination_id"
    )
    owned = link.members(owners, destinations, ["destination_id"])
    by_council = owned.select("destination_id", F.concat(F.lit("council:"), "council_id").alias("group_key"))
    council_groups = owned.select(
        F.concat(F.lit("council:"), "council_id").alias("group_key"), "council_name", "state_code", "website"
    ).distinct()
    loose = link.orphans(destinations, owned, ["destination_id"]).filter(ur.is_real_href("council_permit_url"))
    loose = loose.withColumn("group_key", F.concat(F.lit("permit_domain:"), ur.host_key("council_permit_url")))
    firsts = ag.group_members(
        loose, ["group_key"], ["destination_id"], ["destination_name", "state_code", "council_permit_url"]
    )
    host_groups = firsts.select(
        "group_key",
        F.col("first_destination_name").alias("council_name"),
        F.col("first_state_code").alias("state_code"),
        ur.origin_home("first_council_permit_url").alias("website"),
    )
    members = by_council.unionByName(loose.select("destination_id", "group_key"))
    return members, council_groups.unionByName(host_groups)


def pick_mixed(groups: DataFrame, n: int) -> DataFrame:
    """``n`` groups, one state after the other."""
    keyed = groups.withColumn("state_code", F.coalesce("state_code", F.lit("UNK")))
    return dd.round_robin(keyed, "state_code", ["group_key"], n)


def permit_rows(members: DataFrame, groups: DataFrame, answers: DataFrame, salts: int = 1) -> DataFrame:
    """One permit row per destination: its group's answer, typed.

    ``answers``: group_key, answer (text with a JSON object of text fields).
    """
    from pyspark.sql import types as T

    fields = (
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
        "permit_required",
        "insurance_required",
        "alcohol_permitted",
        "caterers_approved_list",
        "permit_lead_time_days",
        "max_guests_outdoor",
        "approved_locations",
        "data_confidence",
    )
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    raw = answers.withColumn("_rec", pl.parse(pl.salvage_json("answer"), schema))
    typed = raw.select("group_key", *[c.alias(n) for n, c in pl.permit_record(F.col("_rec")).items()])
    known = groups.select("group_key", F.col("council_name").alias("_cn"), F.col("state_code").alias("_sc"))
    named = typed.join(known, "group_key").withColumns(
        {"council_name": F.coalesce("council_name", "_cn"), "state_code": F.coalesce("state_code", "_sc")}
    )
    return link.fan_out(members, named.drop("_cn", "_sc"), ["group_key"], salts)


def back_patch(destinations: DataFrame, permits: DataFrame) -> DataFrame:
    """Destinations with the permit page that was found."""
    patch = permits.select("destination_id", F.col("permit_page_url").alias("council_permit_url"))
    return merge.patch_non_null(destinations, patch, ["destination_id"])


def permit_profile(permits: DataFrame) -> DataFrame:
    return ag.profile(
        permits,
        counts={
            "with_permit_page": F.col("permit_page_url").isNotNull(),
            "insurance_required": F.coalesce("insurance_required", F.lit(False)),
            "online_application": F.col("application_url").isNotNull(),
        },
        averages={
            "avg_fee": tx.fee_amount("permit_fee_aud"),
            "avg_lead_days": F.col("permit_lead_time_days"),
        },
    )


def permits_to_check(permits: DataFrame) -> DataFrame:
    """Rows with a blank key field."""
    return permits.filter(gates.needs_work(["permit_page_url", "contact_email"], va.BLANKS["permit"]))
