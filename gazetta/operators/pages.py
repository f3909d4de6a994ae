"""Links, text and contacts out of tables of HTML pages.

Everything that concerns one page happens inside its row with array functions:
no shuffle, and a page with very many links stays one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.functions import text as tx
from gazetta.functions import urls as ur
from gazetta.functions import values as va
from gazetta.functions.values import as_col, strip
from gazetta.operators import gates
from gazetta.operators.dedupe import running_total, top_k
from gazetta.session import pin

# Parts of a page that hold no text or links: comments, and elements whose content is not shown.
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|noscript)\b.*?(?:</\1\s*>|\z)"
# Start tags only: attributes with their quotes, or whatever stands before the next '>'.
_INSIDE = r"""(?:[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>|[^>]*+>)"""
_START = rf"(?is)<a\s{_INSIDE}"
_TAG = rf"(?s)<{_INSIDE}"
# The label runs to the next end or start tag of a link.
_LINK = rf"({_START}.*?)(?=</a\s*>|<a\s|\z)"
_HREF = r"""(?is)[\s"']href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))"""
# What an entity holds between '&' and the end of its ';'.
_ENTITY = r"^(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
# Words that make a link worth following.
WEEKEND_HINTS = (
    "things-to-do",
    "attractions",
    "activities",
    "experiences",
    "rainy-day",
    "indoor",
    "accommodation",
    "where-to-stay",
    "getting-here",
    "transport",
)


def _numbered(entity: Column) -> Column:
    """Character of '#65;' or '#x41;'; NULL where the number is none."""
    digits = F.when(F.lower(entity).startswith("#x"), F.conv(F.substring(entity, 3, 6), 16, 10)).otherwise(F.regexp_extract(entity, "([0-9]+)", 1))

    def char(code: Column) -> Column:
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        # a blank that does not break is a blank
        return F.when(code == 160, F.lit(" ")).when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    return va.let(F.regexp_replace(digits, ";", "").try_cast("int"), char)


def _decoded(part: Column) -> Column:
    """A text's part behind an '&': its entity as a character; unknown ones stay as they are."""
    named = {f"{name};": " " if code == 160 else chr(code) for name, code in name2codepoint.items()} | {"apos;": "'"}
    known = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])

    def whole(entity: Column) -> Column:
        char = F.when(entity.startswith("#"), _numbered(entity)).when(entity != "", F.try_element_at(known, entity))
        rest = F.substr(part, F.length(entity) + 1)
        return va.let(char, lambda c: F.when(c.isNotNull(), F.concat(c, rest)).otherwise(F.concat(F.lit("&"), part)))

    return va.let(F.regexp_extract(part, _ENTITY, 0), whole)


def unescape(value: Column | str) -> Column:
    """Named and numeric entities to characters, in one pass, so nothing is decoded twice.

    The text is cut once at every '&' and each part looks at its own beginning only: the cost grows with the text.
    """

    def decoded(text: Column) -> Column:
        # most texts hold none: the plain search spares them the cutting
        return F.when(text.contains("&"), F.array_join(F.transform(F.split(text, "&", -1), lambda part, i: F.when(i == 0, part).otherwise(_decoded(part))), "")).otherwise(text)

    return va.let(as_col(value), decoded)


def squash(value: Column | str) -> Column:
    return strip(F.regexp_replace(as_col(value), r"\s+", " "))


def shown(html: Column | str) -> Column:
    """The page without comments and hidden elements."""
    return F.regexp_replace(as_col(html), _HIDDEN, " ")


def visible_text(html: Column | str, sep: str = " ") -> Column:
    """Text without script, style, noscript, comments and tags."""
    out = F.regexp_replace(shown(html), _TAG, " ")
    return strip(F.regexp_replace(unescape(out), r"\s+", sep))


def page_title(html: Column | str, limit: int | None = None) -> Column:
    """Title text; ``limit`` cuts it to the width of a title column."""
    raw = F.regexp_extract(as_col(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    title = squash(unescape(raw))
    return title if limit is None else F.substring(title, 1, limit)


def anchors(html: Column | str) -> Column:
    """Link start tags of the shown page, each with its label."""
    return F.regexp_extract_all(shown(html), F.lit(_LINK), 1)


def _href(anchor: Column) -> Column:
    """Quoted or bare address of a link; '' without one."""

    def address(found: Column) -> Column:
        return F.concat(*[F.regexp_extract(found, _HREF, i) for i in (1, 2, 3)])

    # the attribute alone is short, so telling its three forms apart costs little
    return va.let(F.regexp_extract(F.regexp_extract(anchor, f"({_START})", 1), _HREF, 0), address)


def page_text(pages: DataFrame, html: str = "html", limit: int | None = None) -> DataFrame:
    """Adds ``title`` and ``body_text``; ``limit`` cuts the text and marks the cut."""
    text = visible_text(html)
    if limit:
        text = F.when(
            F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("\n[TRUNCATED]"))
        ).otherwise(text)
    return pages.withColumns({"title": page_title(html), "body_text": text})


def link_array(html: Column | str, base: Column | str) -> Column:
    """Links of one page in order: position, href, text and resolved URL; first per URL."""

    def parsed(a: Column, i: Column) -> Column:
        href = strip(unescape(_href(a)))
        return F.struct(i.alias("pos"), href.alias("href"), visible_text(a).alias("text"))

    filled = F.filter(F.transform(anchors(html), parsed), lambda x: x["href"] != "")
    return F.transform(
        filled, lambda x: x.withField("resolved", ur.resolve_link(base, x["href"]))
    )


def first_per_url(links: Column) -> Column:
    """Keep the first link per resolved URL."""

    def keyed(x: Column) -> Column:
        return F.struct(x["resolved"].alias("u"), x["pos"].alias("p"), x.alias("x"))

    def heads(s: Column) -> Column:
        new = F.filter(s, lambda e, i: (i == 0) | (e["u"] != F.get(s, i - 1)["u"]))
        return F.array_sort(F.transform(new, lambda e: e["x"]))

    return va.let(F.array_sort(F.transform(links, keyed)), heads)


def extract_links(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per distinct link of each page."""
    links = first_per_url(link_array(html, url))
    return pages.select(page_id, F.col(url).alias("page_url"), F.explode(links).alias("_l")).select(
        page_id, "page_url", "_l.*"
    )


def rank_links(
    pages: DataFrame,
    hints: Sequence[str],
    k: int = 8,
    own_host: bool = True,
    by_score: bool = True,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """The ``k`` links that contain most hints, in page order on ties.

    Without ``by_score`` any hint is as good as several and page order decides;
    ``own_host`` keeps links of the page's own host only.
    """
    links = first_per_url(link_array(html, url))
    if own_host:
        links = F.filter(links, lambda x: gates.same_host(x["resolved"], url))
    else:
        links = F.filter(links, lambda x: ur.is_real_href(x["resolved"]))

    def points(link: Column) -> Column:
        return va.count_hits(link, hints) if by_score else va.has_any(link, hints).cast("int")

    scored = F.transform(
        links,
        lambda x: F.struct(
            (-points(x["resolved"])).alias("neg"),
            x["pos"].alias("pos"),
            x["resolved"].alias("link"),
        ),
    )
    best = F.slice(F.array_sort(F.filter(scored, lambda x: x["neg"] < 0)), 1, k)
    return pages.select(page_id, F.posexplode(best).alias("_i", "_b")).select(
        page_id,
        (F.col("_i") + 1).alias("link_rank"),
        "_b.link",
        (-F.col("_b.neg")).alias("score"),
    )


def article_links(
    pages: DataFrame,
    k: int = 10,
    min_title: int = 12,
    min_slug: int = 14,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """The first ``k`` links per page that look like articles."""
    good = F.filter(
        link_array(html, url),
        lambda x: gates.is_article_link(x["resolved"], x["text"], F.col(url), min_title, min_slug),
    )
    picked = F.slice(first_per_url(good), 1, k)
    return pages.select(page_id, F.posexplode(picked).alias("_i", "_l")).select(
        page_id,
        (F.col("_i") + 1).alias("article_rank"),
        F.col("_l.text").alias("title"),
        F.col("_l.resolved").alias("link"),
    )


def entity_links(
    pages: DataFrame,
    region: str,
    suffix: str = "gov.au",
    region_suffix: Column | None = None,
    pattern: str = gates.ENTITY_PATTERN,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Links that name an entity, tagged by the strongest rule, distinct per region.

    Three rules in order: the name alone, a public host, the region's own host
    suffix.  All share the name test, so the later ones only add a tag.
    """
    links = pages.select(
        page_id, region, F.col(url).alias("page_url"), F.explode(link_array(html, url)).alias("_l")
    )
    named = links.select(
        page_id,
        region,
        F.col("_l.pos").alias("pos"),
        tx.drop_parenthetical("_l.text").alias("name"),
        F.col("_l.resolved").alias("website"),
    )
    keep = (
        (F.col("name") != "")
        & ~gates.is_junk_label("name")
        & ur.is_real_href("website")
        & ~ur.is_social("website")
        & ~va.has_any(F.concat_ws(" ", "name", "website"), gates.EXCLUDED_PARTS)
        & gates.looks_like_entity("name", pattern)
    )
    rule = F.when(ur.host_under("website", suffix), F.lit("public_host")).otherwise(F.lit("name"))
    if region_suffix is not None:
        rule = F.when(F.lower("website").contains(region_suffix), F.lit("region_host")).otherwise(rule)
    keyed = named.filter(keep).withColumns(
        {
            "rule": rule,
            "_name": F.lower("name"),
            "_site": F.regexp_replace(F.lower("website"), r"/+$", ""),
        }
    )
    return top_k(keyed, [region, "_name", "_site"], [page_id, "pos"], 1).drop("_name", "_site")


# Own addresses and number prefixes that are no personal contact.
OWN_CONTACTS = ("helpdesk",)
SERVICE_PREFIX = r"^1[38]"


def contacts(
    pages: DataFrame,
    own_words: Sequence[str] = OWN_CONTACTS,
    mobile: str = tx.MOBILE,
    page_id: str = "page_id",
    html: str = "html",
) -> DataFrame:
    """First foreign e-mail and the best phone: linked mobile, mobile in the text, other linked number."""
    hrefs = F.transform(anchors(html), _href)
    mails = F.transform(
        F.filter(hrefs, lambda h: F.lower(h).startswith("mailto:")),
        lambda h: strip(F.replace(F.regexp_extract(h, r"^[^:]*:([^&?#]*)", 1), F.lit("%20"), F.lit(" "))),
    )
    own = F.filter(mails, lambda m: (m != "") & ~va.has_any(m, own_words))
    tels = F.transform(
        F.filter(hrefs, lambda h: F.lower(h).startswith("tel:")), lambda h: strip(F.substring(h, 5, 2**30))
    )

    def digits(t: Column) -> Column:
        return F.regexp_replace(t, r"\D", "")

    usable = F.filter(tels, lambda t: (digits(t) != "") & ~digits(t).rlike(SERVICE_PREFIX))
    linked = F.filter(
        F.transform(usable, lambda t: F.regexp_extract(t, f"({mobile})", 1)), lambda m: m != ""
    )
    in_text = F.nullif(F.regexp_extract(visible_text(html), f"({mobile})", 1), F.lit(""))
    other = F.filter(tels, lambda t: ~digits(t).rlike(r"^13") & (F.length(digits(t)) >= 8))
    return pages.select(
        page_id,
        F.get(own, F.lit(0)).alias("email"),
        F.coalesce(F.get(linked, F.lit(0)), in_text, F.get(other, F.lit(0))).alias("phone"),
    )


def slugs(pages: DataFrame, patterns: Sequence[str], exclude: str | None = None, html: str = "html") -> DataFrame:
    """Distinct slugs found by any of the patterns (group 1)."""
    found = F.array_distinct(
        F.concat(*[F.regexp_extract_all(as_col(html), F.lit(p), 1) for p in patterns])
    )
    out = pages.select(F.explode(found).alias("slug")).filter(
        (F.col("slug") != "") & ~F.lower("slug").startswith("http")
    )
    if exclude:
        out = out.filter(~F.lower("slug").contains(exclude))
    return out.distinct().orderBy("slug")


def combine_docs(
    docs: DataFrame,
    keys: Sequence[str],
    order: str,
    url: str,
    body: str,
    page_chars: int | None = None,
    total_chars: int | None = None,
    sep: str = "\n\n-----\n\n",
    spread: int = 1024,
) -> DataFrame:
    """One text per group: documents in order.

    ``page_chars`` cuts each document and ``total_chars`` the whole; both are off
    by default.  A total also bounds the work: within ``spread`` parts of a group a document is dropped once the documents before
    it in its own part already fill the result, so a group of any size reaches
    the final task with little more than ``spread * total_chars`` characters.
    """
    content = squash(F.coalesce(F.col(body), F.lit("")))
    chunk = F.concat(
        F.lit("URL: "),
        F.coalesce(F.col(url), F.lit("")),
        F.lit("\nCONTENT:\n"),
        content if page_chars is None else F.substring(content, 1, page_chars),
    )
    part = F.pmod(F.xxhash64(order, url), F.lit(spread))
    rows = docs.select(*keys, order, chunk.alias("_chunk"), part.alias("_part"))
    for by in ([*keys, "_part"], list(keys)) if total_chars is not None else ():
        before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        used = F.coalesce(F.sum(F.length("_chunk") + len(sep)).over(before), F.lit(0))
        rows = rows.withColumn("_used", used)
        # the separator before a document may still be part of the result
        rows = rows.filter(F.col("_used") < total_chars + len(sep)).drop("_used")
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), "_chunk")))
    joined = F.array_join(F.transform(parts, lambda p: p["_chunk"]), sep)
    cut = joined if total_chars is None else F.substring(joined, 1, total_chars)
    return rows.groupBy(*keys).agg(cut.alias("combined"))


def combine_parts(
    docs: DataFrame,
    keys: Sequence[str],
    order: str,
    url: str,
    body: str,
    part_chars: int = 1 << 20,
    sep: str = "\n\n-----\n\n",
) -> DataFrame:
    """The text of :func:`combine_docs` without cuts, as rows (keys, ``part_no``, ``text``) of at most ``part_chars`` characters.

    Every document's place in its group is a running sum over blocks of the group, so a group of any size is spread over
    tasks; documents are cut where a part ends. All parts but a group's last are full. Rows of equal order go by URL.
    """
    content = squash(F.coalesce(F.col(body), F.lit("")))
    chunk = F.concat(F.lit("URL: "), F.coalesce(F.col(url), F.lit("")), F.lit("\nCONTENT:\n"), content)
    rows = docs.select(*keys, F.col(order).alias("_o"), F.coalesce(F.col(url), F.lit("")).alias("_url"), chunk.alias("_chunk"))
    # pages are read once; what follows needs lengths and texts in different steps
    rows = pin(rows.withColumns({"_h": F.xxhash64("_chunk"), "_n": F.length("_chunk") + len(sep)}))
    placed = running_total(rows, keys, ["_o", "_url", "_h"], "_n", "_before")
    start = F.when(F.col("_before") > 0, F.col("_before") - len(sep)).otherwise(0)
    piece = F.concat(F.when(F.col("_before") > 0, sep).otherwise(""), "_chunk")
    placed = placed.select(*keys, start.alias("_start"), piece.alias("_piece"))
    numbers = F.sequence(F.floor(F.col("_start") / part_chars), F.floor((F.col("_start") + F.length("_piece") - 1) / part_chars))
    cut = placed.withColumn("part_no", F.explode(numbers))
    first = F.greatest(F.col("part_no") * part_chars - F.col("_start"), F.lit(0))
    last = F.least((F.col("part_no") + 1) * part_chars - F.col("_start"), F.length("_piece"))
    own = F.substr("_piece", (first + 1).cast("int"), (last - first).cast("int"))
    cut = cut.select(*keys, "part_no", F.struct((F.col("_start") + first).alias("at"), own.alias("text")).alias("_p"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list("_p")), lambda p: p["text"]), "")
    return cut.groupBy(*keys, "part_no").agg(text.alias("text"))
