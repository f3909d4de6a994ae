"""URL filters: pattern rules found by their rarest literal token (operator 10).

Every rule is stored under the one of its literal tokens (host labels, closed path segments) that is rarest among the
URLs. A URL looks up its own tokens, and only the rules found there run their regular expression. All of it is column
expressions within the URL's row: nothing is shuffled but the token counts.

Nulls: a NULL URL, or one without ``://``, has an empty host and path and gets the default verdict. Ties: of fitting rules the
longest wins, then the greater text. Repeated rows are judged one by one; an empty table gives an empty result; extra
columns of ``pages`` are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.llm.common import ASCII_LOWER, ASCII_UPPER

_ENTRY = "struct<token:string,pattern:string,rule:string,verdict:string>"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``; ``*`` in a path stands for any characters."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        """For host and path in one string; a host holds no slash."""
        path = ".*".join(_quoted(p) for p in self.path.split("*"))
        return rf"(?s)\A(?:[^/]*\.)?{_quoted(self.host)}{path if self.path else '(?:/.*)?'}" + ("" if self.path else r"\z")

    @property
    def tokens(self) -> list[str]:
        segments = self.path.split("/")[1:-1]
        return [f"h:{x}" for x in self.host.split(".") if x] + [f"p:{x}" for x in segments if x and "*" not in x]


def _quoted(literal: str) -> str:
    return re.sub(r"([^A-Za-z0-9_/])", r"\\\1", literal)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), ASCII_UPPER, ASCII_LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    """Host labels and the path segments that a slash closes, each once."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    parts = F.split(path, "/", -1)
    segments = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0))), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(labels, segments))


def token_counts(pages: DataFrame, tokens: Sequence[str], url: str = "url") -> dict[str, int]:
    """URLs per token; one row comes back for each token of the rules."""
    if not tokens:
        return {}
    wanted = F.array(*[F.lit(t) for t in tokens])
    found = pages.select(F.explode(F.array_intersect(url_tokens(host_of(F.col(url)), path_of(F.col(url))), wanted)).alias("token"))
    return {r["token"]: r["n"] for r in found.groupBy("token").agg(F.count("*").alias("n")).collect()}


def _entries(entries: list[tuple[str, Rule]]) -> Column:
    if not entries:
        return F.array().cast(f"array<{_ENTRY}>")
    return F.array(
        *[
            F.struct(F.lit(t).alias("token"), F.lit(r.pattern).alias("pattern"), F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
            for t, r in entries
        ]
    )


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", id_column: str = "page_id", url: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) for every row."""
    counts = token_counts(pages, sorted({t for r in rules for t in r.tokens}), url)
    slots = 1
    while slots < 2 * len(rules):
        slots *= 2
    index: list[list[tuple[str, Rule]]] = [[] for _ in range(slots)]
    always: list[tuple[str, Rule]] = []
    for rule in dict.fromkeys(rules):
        if rule.tokens:
            rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
            # the same hash as Spark's xxhash64; a remainder by a power of two is the same for signed values
            index[xxhash.xxh64_intdigest(rarest.encode(), 42) % slots].append((rarest, rule))
        else:
            always.append(("", rule))
    buckets = F.array(*[_entries(b) for b in index])
    parsed = pages.select(F.col(id_column), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    tokens = url_tokens(F.col("host"), F.col("path"))
    found = F.flatten(F.transform(tokens, lambda t: F.filter(F.get(buckets, F.pmod(F.xxhash64(t), F.lit(slots)).cast("int")), lambda r: r["token"] == t)))
    candidates = F.concat(found, _entries(always)) if always else found
    place = F.concat("host", "path")
    fitting = F.filter(candidates, lambda r: F.regexp(place, r["pattern"]))
    best = F.array_max(F.transform(fitting, lambda r: F.struct(F.length(r["rule"]).alias("size"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    judged = parsed.withColumn("best", best)
    return judged.select(
        id_column, "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict")
    )
