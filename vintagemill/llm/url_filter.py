"""URL filter with redirect equivalence: aliases of a blocked URL are blocked too."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagemill.llm.components import connected
from vintagemill.session import materialise

_AFTER_SCHEME = r"(?s)^.*?://"
_COMMENT = r"(?s)<!--.*?(?:-->|\z)"
_TAG = r"(?is)<(?:link|meta)\b[^<>]*>"
#: Name and value of an attribute; a quoted value is taken whole, so nothing in it is read as an attribute.
_ATTRIBUTE = r"""(?s)(?<=[\s"'/])([^\s"'<>/=]++)\s*+=\s*+("[^"<>]*"|'[^'<>]*'|[^\s"'<>]+)"""
_AROUND = "\"' \t\n\f\r"
_TARGET = r"""(?is)^[0-9.]*[\s;,]*url\s*=\s*["']?([^"']+)"""


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, _AFTER_SCHEME + r"([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _AFTER_SCHEME + r"[^/?#]*([^?#]*)", 1), F.lit(""))


def _query_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _AFTER_SCHEME + r"[^?#]*(\?[^#]*)", 1), F.lit(""))


def _absolute(href: Column, host: Column, path: Column) -> Column:
    """An absolute URL; relative ones are taken from the page's host and folder, and mail addresses, scripts and the like are none."""
    site = F.concat(F.lit("http://"), host)
    full = r"^[A-Za-z][A-Za-z0-9+.-]*:"
    return (F.when(href.rlike(full + "//"), href)
            .when(href.rlike(full), F.lit(None))
            .when(href.startswith("//"), F.concat(F.lit("http:"), href))
            .when(href.startswith("/"), F.concat(site, href))
            .when(href.startswith("?"), F.concat(site, path, href))
            .when(href.startswith("#"), F.lit(None))
            .otherwise(F.concat(site, F.regexp_replace(F.when(path == "", "/").otherwise(path), r"[^/]*$", ""), href)))


def _resolved(path: Column) -> Column:
    """The path without dot segments; an empty one is ``/``."""
    segments = F.split(F.substr(path, F.lit(2)), "/", -1)
    kept = F.aggregate(segments, F.lit(""), lambda done, x: (
        F.when(x == ".", done).when(x == "..", F.regexp_replace(done, "/[^/]*$", "")).otherwise(F.concat(done, F.lit("/"), x))))
    folder = F.when(F.element_at(segments, -1).isin(".", ".."), "/").otherwise("")
    return F.when(path == "", "/").when(path.rlike(r"/\.\.?(/|$)"), F.concat(kept, folder)).otherwise(path)


def _parts(url: Column) -> list[Column]:
    """host, path, place and node: URLs that differ in scheme, fragment or dot segments only are one node.

    Rules look at the place, host and path as written."""
    host, path = host_of(url), path_of(url)
    return [host.alias("host"), path.alias("path"), F.concat(host, path).alias("place"),
            F.concat(host, _resolved(path), _query_of(url)).alias("node")]


def _attribute(tag: Column, name: str) -> Column:
    """The value of the tag's first attribute of this name, without quotes and white space around it; else NULL."""
    names = F.transform(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(1)), F.lower)
    value = F.get(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(2)), F.array_position(names, name).cast("int") - 1)
    return F.btrim(value, F.lit(_AROUND))


def _canonical(tag: Column) -> Column:
    words = F.split(F.lower(_attribute(tag, "rel")), r"\s+")
    return F.when(F.lower(tag).startswith("<link") & F.array_contains(words, "canonical"), _attribute(tag, "href"))


def _refresh(tag: Column) -> Column:
    to = F.regexp_extract(_attribute(tag, "content"), _TARGET, 1)
    return F.when(F.lower(tag).startswith("<meta") & (F.lower(_attribute(tag, "http-equiv")) == "refresh"), F.btrim(to, F.lit(_AROUND)))


def page_links(pages: DataFrame) -> DataFrame:
    """(url, target) of the first canonical link and the first meta refresh of each page that has one.

    ``rel`` is a list of words; comments hold no links; attributes are told apart from words in
    other attributes' values and from longer names that end alike."""
    page = pages.select("url", "html").where(F.col("url").contains("://") & F.col("html").rlike("(?i)canonical|refresh"))
    tags = F.filter(F.regexp_extract_all(F.regexp_replace("html", _COMMENT, ""), F.lit(_TAG), F.lit(0)), lambda t: t.rlike("(?i)canonical|refresh"))
    first = [F.get(F.filter(F.transform(F.col("tags"), kind), lambda h: h != ""), F.lit(0)) for kind in (_canonical, _refresh)]
    found = page.select("url", tags.alias("tags")).where(F.size("tags") > 0).select("url", F.explode(F.array(*first)).alias("href")).where("href is not null")
    href = F.replace(F.col("href"), F.lit("&amp;"), F.lit("&"))
    return found.select("url", _absolute(href, host_of(F.col("url")), path_of(F.col("url"))).alias("target"))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules given as (verdict, ``host/path``), e.g. ``("block", "net/es/")``."""
    rows = [F.struct(F.lit(rule.partition("/")[0]).alias("rule_host"), F.lit("/" + rule.partition("/")[2]).alias("rule_path"),
                     F.lit(rule).alias("rule"), F.lit(verdict).alias("rule_verdict")) for verdict, rule in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def explicit_verdicts(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(place, rule, rule_verdict) of the places (place, host, path) some rule fits.

    A rule fits its host and every subdomain if the path starts with the rule's; the
    longest wins, and among equally long ones an allow.  Hosts are cut at their dots,
    so this is an equi-join on host suffixes however many rules there are.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = (places.select("place", "path", F.explode(suffixes).alias("rule_host"))
            .join(rules, "rule_host").where(F.startswith(F.col("path"), F.col("rule_path"))))
    best = F.max(F.struct(F.length("rule").alias("n"), (F.col("rule_verdict") == "allow").alias("allow"), "rule", "rule_verdict"))
    return fits.groupBy("place").agg(best.alias("best")).select("place", "best.rule", "best.rule_verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Verdict of every page: page_id, host, path, rule, verdict, alias_of, by_alias.

    A fitting rule decides.  A page without one is blocked if its URL is in a component
    of redirect and canonical links in which some URL is blocked by a rule and none is
    allowed by a rule (an explicit allow takes precedence over a block that comes by
    links); all others are allowed.  Link targets take part whether or not they are
    pages, and rules look at their paths without dot segments.  ``links`` (url, target) may
    add redirects seen while crawling.  In links an empty path is ``/``.

    One row per input row, repeated ones too.  A NULL url or one without ``://`` has an
    empty host and path, fits no rule, has no links and is allowed; a NULL html has no links.
    An empty table gives an empty table; other columns are not looked at.
    ``alias_of`` is the smallest URL of the component (NULL without links), without scheme, fragment and dot segments.
    """
    edges = page_links(pages)
    if links is not None:
        edges = edges.union(links.select("url", "target"))
    to = F.col("target")
    to = F.concat(F.lit("http://"), host_of(to), _resolved(path_of(to)), _query_of(to))
    edges = materialise(edges.where("target like '%://%'").select("url", to.alias("target")).distinct(), "links")
    page = pages.select("page_id", *_parts(F.col("url")))
    ends = edges.select(F.explode(F.array("url", "target")).alias("url")).select(*_parts(F.col("url")))
    places = page.select("host", "path", "place").union(ends.select("host", "path", "place")).distinct()
    said = explicit_verdicts(places, rules)
    if edges.isEmpty():
        judged = (page.join(said, "place", "left")
                  .withColumns({"alias_of": F.lit(None).cast("string"), "alias_blocked": F.lit(False)}))
    else:
        said = materialise(said, "verdicts")
        ids = edges.select(_parts(F.col("url"))[3].alias("u"), _parts(F.col("target"))[3].alias("v"))
        groups = connected(ids)
        members = page.select("node", "place").union(ends.select("node", "place")).join(groups, "node").select("component", "place").distinct()
        verdicts = (members.join(said, "place").groupBy("component")
                    .agg((F.bool_or(F.col("rule_verdict") == "block") & ~F.bool_or(F.col("rule_verdict") == "allow")).alias("alias_blocked")))
        aliases = groups.join(verdicts, "component", "left").select(
            "node", F.col("component").alias("alias_of"), F.coalesce("alias_blocked", F.lit(False)).alias("alias_blocked"))
        judged = page.join(said, "place", "left").join(aliases, "node", "left")
    by_alias = F.col("rule").isNull() & F.coalesce(F.col("alias_blocked"), F.lit(False))
    return judged.select(
        "page_id", "host", "path", "rule",
        F.when(F.col("rule").isNotNull(), F.col("rule_verdict")).when(by_alias, "block").otherwise("allow").alias("verdict"),
        "alias_of", by_alias.alias("by_alias"))
