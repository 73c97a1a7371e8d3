"""URL filters with redirect equivalence.

Rules of a host and a path prefix judge the urls that they fit. Redirects and canonical links make urls aliases of one
another: distributed connected components over those edges carry decisions to aliases that no rule judges. Precedence in a
component: an explicit allow, then an explicit block, then ``allow``; a url's own rule always stands.

Edges come from the pages (canonical links and refresh redirects in their html) and from an optional table of redirects.
Urls are the same node when they differ in scheme, in the case of the host or in the fragment only.

Defined results: a null url, or one without ``://``, has empty host and path, no rule, no alias and verdict ``allow``;
repeated rows are judged alike; links that are null, empty or not web addresses add no edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower
from .components import connected_components

#: Rules of the production query: rule (host and path prefix) and its decision.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
DEFAULT = "allow"
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>]*?url\s*=\s*([^"'\s>]+)"""


def host_of(url):
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url):
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url):
    """The url without scheme and fragment, its host in lower case; null where it is not a url."""
    return F.when(url.contains("://"), F.concat(host_of(url), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)))


def link_node(link, url):
    """The node of a link found on the page of this url; null where it is no web address."""
    plain = F.substring_index(link, "#", 1)
    folder = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*/|/)", 1)
    return (
        F.when((plain == "") | (url.contains("://") == F.lit(False)), None)
        .when(link.rlike(r"(?i)^(https?:)?//"), F.concat(ascii_lower(F.regexp_extract(link, r"//([^/?#]*)", 1)), F.regexp_extract(plain, r"(?s)//[^/?#]*(.*)", 1)))
        .when(link.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), None)
        .when(link.startswith("/"), F.concat(host_of(url), plain))
        .otherwise(F.concat(host_of(url), F.when(folder == "", "/").otherwise(folder), plain))
    )


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst) nodes: from each page to its canonical link and to the target of its refresh redirect."""
    url, html = F.col("url"), F.col("html")
    some = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    # both words are needed for a link, whatever their case; only such pages meet the longer patterns
    some = some.where(url.isNotNull() & html.rlike(r"(?i)canonical|refresh"))
    link = F.explode(F.array_union(F.regexp_extract_all(html, F.lit(_CANONICAL), 1), F.regexp_extract_all(html, F.lit(_REFRESH), 1)))
    found = some.select("url", link.alias("link")).select(node_of(url).alias("src"), link_node(F.col("link"), url).alias("dst"))
    return found.where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def rule_table(spark, rules=RULES) -> DataFrame:
    """(rule, rule_host, rule_path, action) of rules written as host and path in one string."""
    rows = [(r, r.partition("/")[0].lower(), "/" + r.partition("/")[2], a) for r, a in rules]
    return spark.createDataFrame(rows, "rule string, rule_host string, rule_path string, action string")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(node, rule, action) of the longest rule that fits each row of ``urls(node, host, path)``; others are left out.

    A url meets the rules of its host and of every parent domain by equality, so a long block list is joined, not searched.
    """
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    near = urls.where(F.col("host") != "").select("node", "path", F.explode(suffix).alias("rule_host"))
    hit = near.join(rules, "rule_host").where(F.startswith(F.col("path"), F.col("rule_path")))
    best = F.max(F.struct(F.length("rule").alias("n"), (F.col("action") == "allow").alias("allow"), "rule", "action")).alias("b")
    return hit.groupBy("node").agg(best).select("node", F.col("b.rule").alias("rule"), F.col("b.action").alias("action"))


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, component) for every row of ``pages``.

    ``redirects(src, dst)``: urls, also such as no page has; a decision on one of those reaches its aliases too.
    """
    url = F.col(url_col)
    given = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    edges = page_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("src")).alias("src"), node_of(F.col("dst")).alias("dst")))
    alias = connected_components(edges)
    inner = F.regexp_extract("node", r"^[^/?#]*", 0), F.regexp_extract("node", r"^[^/?#]*([^?#]*)", 1)
    nodes = given.select("node").unionByName(alias.select("node")).where(F.col("node").isNotNull()).distinct()
    judged = match_rules(nodes.select("node", inner[0].alias("host"), inner[1].alias("path")), rules)
    judged = nodes.join(judged, "node", "left").join(alias, "node", "left")
    judged = judged.withColumn("component", F.coalesce("component", "node"))
    whole = judged.groupBy("component").agg(F.max(F.col("action") == "allow").alias("allowed"), F.max(F.col("action") == "block").alias("blocked"))
    carried = F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").otherwise(DEFAULT)
    verdicts = judged.join(whole, "component").select("node", "rule", F.coalesce("action", carried).alias("verdict"), "component")
    out = given.join(verdicts, "node", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(DEFAULT)).alias("verdict"), "component")
