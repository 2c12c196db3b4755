"""URL filters: block decisions that hold for all addresses of a page."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmart.llm.components import connected_components
from deskmart.llm.common import written


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str     # fits the host and its subdomains
    path: str     # fits paths that start with it

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(name, verdict) of the longest rule that fits; null where none does. The rules are a list the
    caller wrote, so they are part of the plan."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the longest is tested first
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
                     ).otherwise(out)
    return out


def plain_address(url: Column) -> Column:
    """The address without what never changes the page: scheme, ``www.`` or ``m.`` before the host,
    default ports, fragment, tracking parameters (utm_*, ref, gclid, fbclid), last slashes. Null
    for a null url or one without ``://``."""
    rest = F.regexp_replace(F.regexp_extract(url, r"(?s)^.*?://([^#]*)", 1), r"(?s)^((?:[^/?]*[^/?:\d]))(?::(?:80|443))(?=[/?]|$)", "$1")
    query = F.concat(F.lit("&"), F.regexp_extract(rest, r"(?s)\?(.*)$", 1))
    query = F.regexp_replace(query, r"&(?:utm_[a-z]+|ref|gclid|fbclid)(?:=[^&]*)?(?=&|$)", "")
    query = F.regexp_replace(query, r"^&+|&+$", "")
    page = F.concat(F.regexp_replace(host_of(F.concat(F.lit("x://"), rest)), r"^(?:www|m)\.", ""),
                    F.regexp_replace(path_of(F.concat(F.lit("x://"), rest)), r"/+$", ""))
    return F.when(url.contains("://"), F.concat(page, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


# a tag ends ahead of the next one, and an address stands near the beginning of a refresh, so that tags that never
# end and long runs are searched in linear time
_TAGS = r"(?is)<(?:link|meta)\b[^<>]*>"
_CANONICAL = r"""(?is)^<link\b.*?(?<![\w-])rel\s*=\s*(?:"[^">]*?\bcanonical\b|'[^'>]*?\bcanonical\b|canonical\b)"""
_HREF = r"""(?is)(?<![\w-])href\s*=\s*["']?\s*([^"'\s>]+)"""
_REFRESH = r"""(?is)^<meta\b.*?(?<![\w-])http-equiv\s*=\s*["']?\s*refresh\b"""
_URL = r"""(?is)(?<![\w-])content\s*=[^>]{0,100}?\burl\s*=\s*["']?\s*([^"'\s>]+)"""


def _without_dots(path: Column) -> Column:
    """A path from the host's root with its ``.`` and ``..`` parts carried out; ``..`` stops at the root."""
    parts = F.aggregate(F.split(path, "/", -1), F.array().cast("array<string>"), lambda acc, part: F.when(
        part == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))).when(part == ".", acc).otherwise(F.concat(acc, F.array(part))))
    return F.concat(F.array_join(parts, "/"), F.when(path.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit("")))


def resolved(url: Column, target: Column) -> Column:
    """``target`` as an address, seen from the page at ``url``; null for other schemes (``mailto:``) and for targets
    without a scheme where ``url`` has no ``://``."""
    origin = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    cut = r"(?s)^([^?#]*)"
    here = path_of(url)
    folder = F.concat(F.lit("/"), F.regexp_extract(here, r"(?s)^/(.*/)", 1))
    path = F.regexp_extract(target, cut, 1)
    rest = F.regexp_replace(target, cut, "")
    full = F.when(target.startswith("/"), path).otherwise(F.concat(folder, path))
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | (origin == "") | (target == ""), F.lit(None).cast("string"))
            .when(target.startswith("//"), F.concat(F.regexp_extract(url, r"(?s)^(.*?:)//", 1), target))
            .when(target.startswith("#"), F.concat(F.regexp_extract(url, r"(?s)^([^#]*)", 1), target))
            .when(target.startswith("?"), F.concat(origin, here, target))
            .otherwise(F.concat(origin, _without_dots(full), rest)))


def declared_targets(url: Column, html: Column) -> Column:
    """Where all canonical links and all refreshes of the page point, attributes in any order."""
    tags = F.regexp_extract_all(html, F.lit(_TAGS), F.lit(0))

    def of(kind: str, target: str) -> Column:
        return F.transform(F.filter(tags, lambda t: t.rlike(kind)), lambda t: resolved(
            url, F.regexp_replace(F.regexp_extract(t, target, 1), "&amp;", "&")))

    return F.array_compact(F.concat(of(_CANONICAL, _HREF), of(_REFRESH, _URL)))


def judge_pages(pages: DataFrame, rules: list[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, group of every row of ``pages`` (page_id, url, html).

    A url that a rule fits has that rule's verdict. All others take the decision of their group of
    equivalent addresses: allow if any address of the group is allowed by a rule, else block if any is blocked,
    else allow. Addresses are equivalent along declared canonical links and refreshes, along
    ``redirects`` (src, dst; optional, either way) and along plain forms of the address. Addresses
    that only occur as targets are judged by the rules too.

    Null urls and urls without ``://`` have no aliases. Repeated rows are all returned; null html
    declares nothing; null redirects are left out; further columns are ignored. Of rules of equal length the last by
    name counts; pages of any length are searched in linear time; an empty table gives no rows.
    """
    url = F.col("url")
    pages = pages.select("page_id", "url", "html")
    links = (pages.where("url is not null")
             .select(F.col("url").alias("src"), F.explode(declared_targets(url, F.col("html"))).alias("dst")))
    if redirects is not None:
        links = links.union(redirects.select("src", "dst"))
    links = links.where("src is not null and dst is not null").distinct()
    links = written(links, "links")
    known = written(
        pages.select("url").where("url is not null")
        .union(links.select("src")).union(links.select("dst")).distinct()
        .withColumn("plain", plain_address(F.col("url"))), "urls")
    plain = F.concat(F.lit("plain "), "plain")  # a blank keeps these apart from addresses
    groups = connected_components(
        links.union(known.where("plain is not null").select("url", plain)))
    rule = fitting_rule(host_of(url), path_of(url), rules)
    named = known.join(groups.select(F.col("node").alias("url"), F.col("component").alias("group")), "url", "left")
    said = (named.where("group is not null").select("group", rule["verdict"].alias("v")).where("v is not null")
            .groupBy("group").agg(F.min("v").alias("group_verdict")))  # allow sorts before block
    decided = named.join(said, "group", "left").select("url", "group", "group_verdict")
    return (pages.select("page_id", "url").join(decided, "url", "left")
            .select("page_id", host_of(url).alias("host"), path_of(url).alias("path"),
                    rule["name"].alias("rule"),
                    F.coalesce(rule["verdict"], "group_verdict", F.lit("allow")).alias("verdict"), "group"))
