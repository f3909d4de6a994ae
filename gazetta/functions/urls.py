"""URL keys, hosts and link resolution as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazetta.functions.values import BLANKS, NOT_FOUND, as_col, is_blank, strip

_PARTS = r"(?i)^(https?)://([^/?#]*)([^?#]*)"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"

# Hosts that are profiles on somebody else's site.
SOCIAL_HOSTS = (
    "facebook.com",
    "instagram.com",
    "linkedin.com",
    "youtube.com",
    "x.com",
    "twitter.com",
)


def _with_scheme(url: Column | str) -> Column:
    text = F.translate(strip(url), "\t\r\n", "")
    return F.when(text.rlike(r"(?i)^https?://"), text).otherwise(F.concat(F.lit("https://"), text))


def norm_url(url: Column | str) -> Column:
    """Dedupe key of a URL.

    Adds ``https://``, lowers scheme and host, drops one ``www.``, the query,
    the fragment, the parameters of the last path segment and trailing slashes.
    Scheme, path case and port stay significant.  Blank -> ''.
    """
    full = _with_scheme(url)
    host = F.regexp_replace(F.lower(F.regexp_extract(full, _PARTS, 2)), r"^www\.", "")
    path = F.regexp_replace(
        F.regexp_replace(F.regexp_extract(full, _PARTS, 3), r";[^/]*$", ""), r"/+$", ""
    )
    key = F.concat(F.lower(F.regexp_extract(full, _PARTS, 1)), F.lit("://"), host, path)
    return F.when(is_blank(url, ("",)), F.lit("")).otherwise(key)


def netloc(url: Column | str) -> Column:
    """Authority part (host and port) as written; '' without http(s) scheme."""
    return F.regexp_extract(strip(url), _PARTS, 2)


def host_key(url: Column | str) -> Column:
    """Lower-case authority without one leading ``www.``."""
    return F.regexp_replace(F.lower(netloc(url)), r"^www\.", "")


def root_domain(url: Column | str) -> Column:
    """Host of the normalised URL, NULL when there is none."""
    return F.nullif(host_key(norm_url(url)), F.lit(""))


def origin_home(url: Column | str) -> Column:
    """``scheme://authority/`` of a URL, '' without authority."""
    text = strip(url)
    scheme = F.lower(F.regexp_extract(text, r"(?i)^([a-z][a-z0-9+.\-]*)://", 1))
    place = F.regexp_extract(text, r"(?i)^(?:[a-z][a-z0-9+.\-]*:)?//([^/?#]*)", 1)
    return F.when(place == "", F.lit("")).otherwise(
        F.concat(
            F.when(scheme.isin("http", "https"), scheme).otherwise(F.lit("https")),
            F.lit("://"),
            place,
            F.lit("/"),
        )
    )


def url_path(url: Column | str) -> Column:
    """Path of an http(s) URL as written."""
    return F.regexp_extract(strip(url), _PARTS, 3)


def is_http(url: Column | str) -> Column:
    """Starts with http(s):// (NULL -> false)."""
    return F.coalesce(strip(url).rlike(r"(?i)^https?://"), F.lit(False))


def is_real_href(url: Column | str) -> Column:
    """http(s) scheme and a non-empty authority."""
    return F.coalesce(strip(url).rlike(r"(?i)^https?://[^/?#]+"), F.lit(False))


def host_under(url: Column | str, suffix: str) -> Column:
    """Is the authority ``suffix`` itself or below it (e.g. 'gov.au')?"""
    host = F.lower(netloc(url))
    return F.coalesce(host.endswith("." + suffix) | (host == suffix), F.lit(False))


def is_social(url: Column | str, hosts: Sequence[str] = SOCIAL_HOSTS) -> Column:
    """Social-media host; something that is not an http URL counts as social, too."""
    host = F.lower(netloc(url))
    hit = F.lit(False)
    for name in hosts:
        hit = hit | host.contains(name)
    return ~is_real_href(url) | hit


def host_class(url: Column | str, public_suffix: str = "gov.au") -> Column:
    """``invalid`` / ``public`` / ``social`` / ``other``."""
    return (
        F.when(~is_real_href(url), F.lit("invalid"))
        .when(host_under(url, public_suffix), F.lit("public"))
        .when(is_social(url), F.lit("social"))
        .otherwise(F.lit("other"))
    )


def _without_dots(path: Column) -> Column:
    """Resolve '.' and '..' segments of an absolute path."""
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    kept = F.aggregate(
        F.slice(segments, F.lit(2), F.size(segments)),
        F.array().cast("array<string>"),
        lambda acc, seg: F.when(
            seg == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        )
        .when(seg == ".", acc)
        .otherwise(F.concat(acc, F.array(seg))),
    )
    closing = F.when(last.isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    clean = F.concat(F.lit("/"), F.array_join(kept, "/"), closing)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), clean).otherwise(path)


def resolve_link(base: Column | str, href: Column | str) -> Column:
    """Absolute form of ``href`` on page ``base`` (``//h``, ``/p``, ``../p``, ``?q``, ``#f``)."""
    base_text, link = strip(base), strip(href)
    scheme = F.regexp_extract(base_text, r"(?i)^([a-z][a-z0-9+.\-]*):", 1)
    origin = F.regexp_extract(base_text, r"(?i)^([a-z][a-z0-9+.\-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base_text, r"(?i)^[a-z][a-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    link_path = F.regexp_extract(link, r"^([^?#]*)", 1)
    tail = F.regexp_extract(link, r"^[^?#]*(.*)$", 1)
    return (
        F.when(link == "", base_text)
        .when(link.rlike(_SCHEME), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, _without_dots(link_path), tail))
        .when(link.startswith("?"), F.concat(origin, path, link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(base_text, r"^([^#]*)", 1), link))
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, link_path)), tail))
    )


# -- canonical contact fields ----------------------------------------------


def _or_not_found(value: Column | str, out: Column) -> Column:
    return F.when(is_blank(value, BLANKS["lookup"]), F.lit(NOT_FOUND)).otherwise(
        F.coalesce(out, F.lit(NOT_FOUND))
    )


def clean_link(value: Column | str) -> Column:
    """http(s) URL as is, ``www.`` gets https, anything else NOT_FOUND."""
    text = strip(value)
    return _or_not_found(
        value,
        F.when(text.startswith("www."), F.concat(F.lit("https://"), text)).when(
            text.rlike("^https?://"), text
        ),
    )


def social_profile(value: Column | str, site: str) -> Column:
    """Handle or link to a full profile URL on ``site`` ('instagram', 'facebook', 'pinterest')."""
    text = strip(value)
    if site == "instagram":
        text = F.regexp_replace(text, "^@+", "")
        handle = text.rlike(r"^[\w.]+$")
    elif site == "facebook":
        handle = text.rlike(r"^[\w.\-]+/?$")
    else:
        handle = text.rlike(r"^[\w.\-/]+$") & (
            text.contains("/") | text.contains(".") | text.rlike(r"^[^\W_]+$")
        )
    bare = F.btrim(text, F.lit("/"))
    own = text.rlike(rf"^(www\.)?{site}\.com")
    return _or_not_found(
        value,
        F.when(text.rlike("^https?://"), text)
        .when(own & F.lit(site != "instagram"), F.concat(F.lit("https://"), text))
        .when(handle, F.concat(F.lit(f"https://www.{site}.com/"), bare, F.lit("/"))),
    )


def clean_email(value: Column | str) -> Column:
    """An address with a dot after the last '@', else NOT_FOUND."""
    text = strip(value)
    return _or_not_found(value, F.when(text.rlike(r"@[^@]*\.[^@]*$"), text))


def bare_handle(value: Column | str) -> Column:
    """'@name' -> 'name'."""
    return F.regexp_replace(strip(value), "^@+", "")
