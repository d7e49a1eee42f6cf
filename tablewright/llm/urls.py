"""URL filters with redirect equivalence.

Rules judge hosts and paths. Redirect and canonical-link edges join URLs into
components; a rule's decision on one URL reaches its aliases, and an explicit
allow comes before a block. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import ASCII_UPPER, rekeyed, staged
from tablewright.llm.components import connected_components

# The word may stand anywhere in the list of relations.
CANONICAL = (
    r"""(?is)<link\b[^>]*\brel\s*=\s*(?:"(?:[^"]*\s)?canonical(?:\s[^"]*)?"|'(?:[^']*\s)?canonical(?:\s[^']*)?'"""
    r"""|canonical(?=[\s/>]))[^>]*>"""
)
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?\s*refresh\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
REFRESH_URL = r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>;]+(?:;[^"'\s>;]+)*)"""
# What no reader of a page takes for markup.
UNREAD = r"(?is)<!--.*?(?:-->|$)|<script\b.*?(?:</script\s*>|$)"

REFERENCE = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z]{2,8});"
# The characters that addresses are written with, by their names.
NAMED = {
    "amp": "&", "apos": "'", "ast": "*", "colon": ":", "comma": ",", "commat": "@", "dollar": "$", "equals": "=",
    "excl": "!", "gt": ">", "lowbar": "_", "lpar": "(", "lt": "<", "num": "#", "percnt": "%", "period": ".", "plus": "+",
    "quest": "?", "quot": '"', "rpar": ")", "semi": ";", "sol": "/",
}


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), ASCII_UPPER, ASCII_UPPER.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``, or
    NULL. ``rules`` is a list of verdict, host and path from the caller; one
    fits its host and all subdomains where the path starts with the rule's."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        under = (host == rule_host) | host.endswith("." + rule_host)
        fits = under & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def referenced(text: Column) -> Column:
    """The text with its character references decoded: all by number, and those
    by name that addresses are written with; others stay as they are."""

    def char(ref: Column) -> Column:
        inner = F.substring(ref, F.lit(2), F.char_length(ref) - 2)
        digits = F.when(inner.rlike("^#[xX]"), F.substring(inner, F.lit(3), F.char_length(inner))).otherwise(
            F.conv(F.substring(inner, F.lit(2), F.char_length(inner)), 10, 16)
        )
        point = F.conv(digits, 16, 10).cast("long")
        valid = (point > 0) & (point <= 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
        by_number = F.when(valid, F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32"))
        named = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])
        return F.coalesce(F.when(inner.startswith("#"), by_number).otherwise(F.get(F.array(named[inner]), F.lit(0))), ref)

    refs = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))
    gaps = F.split(text, REFERENCE, -1)
    whole = F.array_join(F.zip_with(gaps, F.transform(refs, char), lambda g, r: F.concat(g, F.coalesce(r, F.lit("")))), "")
    return F.when(text.rlike(REFERENCE), whole).otherwise(text)


def without_dots(path: Column) -> Column:
    """A path with ``.`` and ``..`` resolved; ``..`` does not lead above the root."""
    parts = F.split(F.substring(path, F.lit(2), F.char_length(path)), "/", -1)

    def add(seen: Column, part: Column) -> Column:
        return (
            F.when(part == ".", seen)
            .when(part == "..", F.slice(seen, F.lit(1), F.greatest(F.size(seen) - 1, F.lit(0))))
            .otherwise(F.array_append(seen, part))
        )

    kept = F.aggregate(parts, F.array().cast("array<string>"), add)
    folder = F.when(path.rlike(r"/\.\.?$") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"), folder)).otherwise(path)


def node_of(url: Column) -> Column:
    """The URL as a node: no fragment, scheme and host in lower case, no port
    that its scheme has anyway, at least ``/`` as path, dots resolved."""
    bare = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    start = F.lower(F.regexp_extract(bare, r"(?s)^(.*?://)", 1))
    host = host_of(bare)
    known = F.when(start == "http://", F.regexp_replace(host, ":80$", "")).when(
        start == "https://", F.regexp_replace(host, ":443$", "")
    )
    path, query = path_of(bare), F.regexp_extract(bare, r"(?s)^[^?]*(\?.*)$", 1)
    rooted = F.when(path == "", F.lit("/")).otherwise(without_dots(path))
    return F.when(bare.contains("://"), F.concat(start, F.coalesce(known, host), rooted, query)).otherwise(bare)


def target_of(link: Column, url: Column) -> Column:
    """A link as a node, seen from ``url``; empty links are NULL."""
    origin = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    whole = (
        F.when(link.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(url, r"(?s)^(.*?:)//", 1), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.startswith("?"), F.concat(F.regexp_extract(url, r"(?s)^([^?#]*)", 1), link))
        .when(link.startswith("#"), url)
        .otherwise(F.concat(folder, F.when(folder.endswith("/"), F.lit("")).otherwise(F.lit("/")), link))
    )
    return F.when(link != "", node_of(whole))


def link_edges(pages: DataFrame) -> DataFrame:
    """One edge ``a``, ``b`` per redirect or canonical link of a page. Comments and
    scripts hold no links."""
    tags = F.concat(
        F.transform(F.regexp_extract_all("html", F.lit(CANONICAL), F.lit(0)), lambda t: F.regexp_extract(t, HREF, 1)),
        F.transform(F.regexp_extract_all("html", F.lit(REFRESH), F.lit(0)), lambda t: F.regexp_extract(t, REFRESH_URL, 1)),
    )
    linked = pages.where(F.col("html").rlike(CANONICAL) | F.col("html").rlike(REFRESH))
    linked = linked.select("url", F.regexp_replace("html", UNREAD, " ").alias("html"))
    found = linked.select("url", F.explode_outer(tags).alias("link"))
    found = found.where("link IS NOT NULL").select("url", referenced(F.col("link")).alias("link"))
    return found.select(node_of(F.col("url")).alias("a"), target_of(F.col("link"), F.col("url")).alias("b")).where(
        "a IS NOT NULL AND b IS NOT NULL"
    )


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``
    and ``via`` (``rule``, ``alias`` or ``default``).

    A rule that fits the page decides. Otherwise, if a URL of its component
    (pages and link targets) is allowed by a rule, it is allowed; if one is
    blocked, it is blocked; with neither it is allowed. NULL URLs and URLs
    without ``://`` have empty host and path; NULL html has no links; rows that
    repeat are each judged; an empty table gives no rows; other columns are not read.
    """
    url = F.coalesce("url", F.lit(""))
    judged = pages.select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(F.col("url")).alias("node")
    ).withColumn("own", rule_of(F.col("host"), F.col("path"), rules))
    edges = staged(link_edges(pages), "links")
    nodes = connected_components(edges, kind="string")
    ruled = nodes.withColumn("r", rule_of(host_of(F.col("node")), path_of(F.col("node")), rules))
    groups = ruled.groupBy("root").agg(
        F.max(F.col("r.verdict") == "allow").alias("allowed"), F.max(F.col("r.verdict") == "block").alias("blocked")
    )
    # only components with a decision reach a page
    decided = groups.where("allowed OR blocked").select(
        rekeyed(F.col("root"), "string").alias("at"),
        F.when(F.col("allowed"), "allow").otherwise("block").alias("passed"),
    )
    aliases = nodes.join(decided, F.col("root") == F.col("at")).select(F.col("node").alias("alias"), "passed")
    aliases = staged(aliases, "aliases")
    return judged.join(aliases, F.col("node") == F.col("alias"), "left").select(
        "page_id",
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", "passed", F.lit("allow")).alias("verdict"),
        F.when(F.col("own").isNotNull(), "rule").when(F.col("passed").isNotNull(), "alias").otherwise("default").alias("via"),
    )
