"""URL filters with redirect equivalence.

A url's host and path are judged by the longest fitting rule.  Pages that redirect to, or
name as canonical, another url are aliases of it: connected components over these edges
carry decisions to aliases that no rule fits.  An explicit rule always wins for its own
page; among a component's explicit rules an allow takes precedence over a block; a component
without any rule is allowed.

Edges come from the page itself: ``<link rel="canonical" href>`` and ``<meta
http-equiv="refresh" content="..;url=..">``, outside comments and scripts.  Urls are equal
when host, path and query are (scheme, fragment and letter case of the host do not count);
targets that start with ``//`` or ``/`` are resolved against the page's host, other relative
targets against its path (``.`` and ``..`` are followed); ``<base>`` is not looked at.  Targets
of other kinds (``mailto:x``) and targets without a host are ignored.

Scale: host, path and edges are column expressions on one scan; only urls that have an edge
take part in the component search, which is distributed (``connected_components``) and its
result is joined to pages by url.  The rule list is a parameter, so its size is fixed.

Defined results: a null url or one without ``://`` has empty host and path and never fits a
rule; null html has no edges; repeated pages are judged alike; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake.llm.common import Spool, ascii_lower, connected_components


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """Identity of a url: host, path and query; null without a host."""
    rest = F.regexp_extract(_after_scheme(url), r"^[^/?#]+([^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), rest))


def rule_columns(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """``(rule string, verdict)`` of the longest fitting rule, nulls when none fits."""
    name, verdict = None, None
    for r in sorted(rules, key=lambda r: (-len(r.host + r.path), r.verdict)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = (F if name is None else name).when(fits, r.host + r.path)
        verdict = (F if verdict is None else verdict).when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name.otherwise(none), verdict.otherwise(none))


def _beside(url: Column, target: Column) -> Column:
    """A relative target (``page2.html``, ``../x``, ``?p=1``) as host and path of the page's url give it."""
    folder = F.coalesce(F.nullif(F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1), F.lit("")), F.lit("/"))
    steps = F.split(F.concat(folder, F.regexp_extract(target, r"(?s)^([^?#]*)", 1)), "/", -1)
    walked = F.aggregate(
        F.slice(steps, 2, F.size(steps)),
        F.array().cast("array<string>"),
        lambda done, step: F.when(step == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(step == ".", done).otherwise(F.array_append(done, step)),
    )
    walked = F.when(F.element_at(steps, -1).isin(".", ".."), F.array_append(walked, F.lit(""))).otherwise(walked)
    path = F.when(target.startswith("?"), path_of(url)).otherwise(F.concat(F.lit("/"), F.array_join(walked, "/")))
    return F.concat(F.lit("x://"), host_of(url), path, F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1))


def link_edges(spool: Spool, pages: DataFrame) -> DataFrame:
    """``(src, dst)`` url identities of redirect and canonical links."""
    bare = F.regexp_replace("html", r"(?is)<!--.*?-->|<script\b.*?</script\s*>", "")
    tags = F.expr(r"regexp_extract_all(bare, '(?is)<(?:link|meta)\\b[^>]*>', 0)")

    def value(tag: Column, name: str) -> Column:
        found = F.regexp_extract(tag, r"""(?is)\s%s\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""" % name, 1)
        return F.trim(F.btrim(found, F.lit("\"'")))

    hinted = F.lower("html")
    tag = F.col("tag")
    absolute = (
        F.when(F.col("target").rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("target"))
        .when(F.col("target").startswith("//"), F.concat(F.lit("x:"), "target"))
        .when(F.col("target").startswith("/"), F.concat(F.lit("x://"), "host", "target"))
        .when(~F.col("target").rlike("^(#|[A-Za-z][A-Za-z0-9+.-]*:)"), _beside(F.col("url"), F.col("target")))
    )
    found = (
        pages.filter(hinted.contains("canonical") | hinted.contains("http-equiv"))
        .select(F.col("url").alias("url"), bare.alias("bare"))
        .select("url", F.explode(tags).alias("tag"))
        .select("url", value(tag, "rel").alias("rel"), value(tag, "href").alias("href"), value(tag, "http-equiv").alias("equiv"), value(tag, "content").alias("content"))
        .withColumn(
            "target",
            F.when(F.lower("rel") == "canonical", F.col("href")).when(
                F.lower("equiv") == "refresh", F.regexp_extract("content", r"(?is)url\s*=\s*['\"]?([^'\"]*)", 1)
            ),
        )
        .select("url", F.trim(F.replace("target", F.lit("&amp;"), F.lit("&"))).alias("target"))
        .filter("target <> ''")
    )
    found = spool.put(found, "targets")
    resolved = found.withColumn("host", host_of(F.col("url"))).withColumn("absolute", absolute)
    return (
        resolved.select(node_of(F.col("url")).alias("src"), node_of(F.col("absolute")).alias("dst"))
        .filter("src is not null and dst is not null and dst <> src")
        .distinct()
    )


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per page row: page_id, host, path, rule, verdict, component (the alias group's smallest url
    identity, null for a page without redirect or canonical link)."""
    spool = Spool(pages.sparkSession, "url")
    edges = spool.put(link_edges(spool, pages), "links")
    base = pages.select(
        F.col("page_id").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node")
    )
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    base = base.withColumn("rule", name).withColumn("own", verdict)
    if edges.isEmpty():
        return base.select(
            "page_id", "host", "path", "rule", F.coalesce("own", F.lit("allow")).alias("verdict"), F.lit(None).cast("string").alias("component")
        )
    groups = connected_components(spool, edges, "src", "dst")
    # link targets that are no page themselves carry their own rule into the group as well
    url = F.concat(F.lit("x://"), F.col("node"))
    _, target_rule = rule_columns(host_of(url), path_of(url), rules)
    decisions = (
        groups.withColumn("own", target_rule)
        .groupBy("component")
        .agg(
            F.max(F.when(F.col("own") == "allow", 1).otherwise(0)).alias("allowed"),
            F.max(F.when(F.col("own") == "block", 1).otherwise(0)).alias("blocked"),
        )
        .select("component", F.when((F.col("blocked") == 1) & (F.col("allowed") == 0), "block").otherwise("allow").alias("carried"))
    )
    aliases = spool.put(groups.join(decisions, "component").select(F.col("node").alias("alias"), "component", "carried"), "aliases")
    return base.join(aliases, F.col("node") == F.col("alias"), "left").select(
        "page_id", "host", "path", "rule", F.coalesce("own", "carried", F.lit("allow")).alias("verdict"), "component"
    )
