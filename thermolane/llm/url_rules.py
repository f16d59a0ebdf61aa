"""Allow and block rules for URLs, carried over to aliases by redirects and canonical links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .storage import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Patterns of links in a page, and of what is no part of it; the same in Java and RE2.
COMMENT = r"(?s)<!--.*?-->"
CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
REFRESH_URL = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url):
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url):
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url):
    """A URL without scheme and fragment, its host in lower case; null if it has no host."""
    host = host_of(url)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(host != "", F.concat(host, F.when(rest == "", F.lit("/")).otherwise(rest)))


def without_dots(path):
    """The path with its ``.`` and ``..`` segments carried out; it begins with a slash."""
    ended = F.when(path.rlike(r"/\.\.?$"), F.concat(path, F.lit("/"))).otherwise(path)

    def step(done, segment):
        return (
            F.when(segment == ".", done).when(segment == "..", F.regexp_replace(done, r"/[^/]*$", ""))
            .otherwise(F.concat(done, F.lit("/"), segment))
        )

    walked = F.aggregate(F.split(F.substring(ended, 2, 1 << 30), "/", -1), F.lit(""), step)
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), walked).otherwise(path)


def absolute(link, base):
    """The link as a full URL, resolved against the base where it is relative.

    Null for a link within the page, and for one of another kind, such as ``mailto:``.
    """
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(base))
    path, query = F.regexp_extract(link, r"(?s)^([^?#]*)", 1), F.regexp_extract(link, r"(?s)^[^?#]*(\?[^#]*)", 1)
    here = path_of(base)
    folder = F.regexp_extract(here, r"(?s)^(.*/)", 1)
    whole = (
        F.when(path.startswith("/"), path)
        .when(path == "", F.when(here == "", F.lit("/")).otherwise(here))
        .otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path))
    )
    return (
        F.when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(~link.startswith("#") & ~link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(site, without_dots(whole), query))
    )


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b, target): a page's node, that of each canonical link or redirect, and the target URL.

    Links in comments are none.
    """
    url, html = F.col(url_col), F.regexp_replace(F.col(html_col), COMMENT, "")

    def links_of(tag, address):
        return F.transform(F.regexp_extract_all(html, F.lit(tag), F.lit(0)), lambda t: F.regexp_extract(t, address, 1))

    found = F.concat(links_of(CANONICAL, HREF), links_of(REFRESH, REFRESH_URL))
    links = pages.select(url.alias("u"), F.explode(found).alias("link")).where("link != ''")
    links = links.withColumn("target", absolute(F.regexp_replace("link", "&amp;", "&"), F.col("u")))
    return links.select(node_of(F.col("u")).alias("a"), node_of(F.col("target")).alias("b"), "target").where(
        "a is not null and b is not null"
    )


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, action): the longest rule that fits, for every distinct host and path with one.

    A rule fits its host and the host's subdomains, if the path starts with the rule's path. Hosts are
    joined by their suffixes; of rules of equal length the one with the longer host wins, then the
    first by text.
    """
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
    )
    keys = urls.select("host", "path").distinct().where("host != ''").withColumn("on", F.explode(suffixes))
    r = rules.where("rule_host is not null and rule_path is not null and action is not null")
    fit = keys.join(r, keys["on"] == r["rule_host"]).where("startswith(path, rule_path)")
    rule = F.concat("rule_host", "rule_path")
    best = F.max_by(
        F.struct(rule.alias("rule"), "action"),
        F.struct(F.length(rule), F.length("rule_host"), rule, F.col("action") == "allow"),
    )
    return fit.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.action")


def judge_pages(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(id, host, path, rule, verdict), one row per page.

    A page with a rule gets its rule's action. Any other gets that of its aliases, the pages and targets
    that redirects and canonical links connect it with, in any number of steps: allow, if a rule allows
    one of them; else block, if a rule blocks one; else allow. A URL that is null or has no ``://`` has
    empty host and path, and is allowed. ``rules`` has (rule_host, rule_path, action). Empty tables give
    empty results; other columns are ignored.
    """
    judged = pages.select(
        F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
        node_of(F.col(url_col)).alias("node"),
    )
    links = stage(page_links(pages, url_col, html_col).distinct(), "page_links")
    groups = stage(connected_components(links), "aliases")
    targets = links.select(host_of(F.col("target")).alias("host"), path_of(F.col("target")).alias("path"), F.col("b").alias("node"))
    linked = judged.select("host", "path", "node").unionByName(targets).join(groups, "node").distinct()
    matched = stage(match_rules(judged.select("host", "path").unionByName(targets.select("host", "path")), rules), "matched")
    spread = (
        linked.join(matched, ["host", "path"]).groupBy("component").agg(F.min("action").alias("inherited"))
    )  # allow comes before block
    inherited = stage(groups.join(spread, "component").select("node", "inherited"), "inherited")
    return (
        judged.join(matched, ["host", "path"], "left").join(inherited, "node", "left")
        .select(
            F.col("id").alias(id_col), "host", "path", "rule",
            F.coalesce("action", "inherited", F.lit("allow")).alias("verdict"),
        )
    )
