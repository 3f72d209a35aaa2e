"""URL rules, carried over to aliases: pages that redirect to each other or name the same
canonical address share block decisions.

Rules are a table (``host``, ``path``, ``action``: allow or block) of any size. A rule fits
its host and all subdomains, if the URL's path starts with the rule's; the longest wins. All
matching is by equal keys: a URL meets the rules of its host's suffixes, cut to the lengths
that their paths have.

An URL without a rule of its own is blocked if an alias is blocked by a rule, else
allowed; an explicit rule, so also an explicit allow, goes before what aliases say. A null URL or one
without ``://`` has an empty host and path and no aliases, so it is allowed. Repeated URLs
get the same verdict; null or empty html has no links.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.components import connected_components
from riskflow.session import materialize

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>"
_CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
_REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
_TO = r"""(?is)\bcontent\s*=\s*["']?[^>]*?\burl\s*=\s*["']?([^"'\s>]+)"""


def _lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def host_of(url: Column) -> Column:
    return _lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(
        F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1
    )


def node_of(url: Column) -> Column:
    """The URL without fragment, scheme and host in lower case; null without ``://``."""
    scheme = _lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(
        url.contains("://"),
        F.concat(scheme, F.lit("://"), host_of(url), F.when(rest == "", "/").otherwise(rest)),
    )


def _resolved(target: Column, url: Column) -> Column:
    """A link's target as an absolute URL."""
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*/)", 1)
    return (
        F.when(target == "", None)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(~target.rlike(r"^(#|[A-Za-z][A-Za-z0-9+.\-]*:)"), F.concat(
            site, F.when(folder == "", "/").otherwise(folder), target))
    )


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(``a``, ``b``): a page's URL and where its canonical link or its refresh leads."""
    marked = pages.filter(F.col(html).rlike(r"(?i)canonical|refresh")).select(
        F.col(url).alias("url"), F.regexp_replace(html, _HIDDEN, " ").alias("html")
    )
    targets = F.array(
        F.regexp_extract(F.regexp_extract("html", _CANONICAL, 0), _HREF, 1),
        F.regexp_extract(F.regexp_extract("html", _REFRESH, 0), _TO, 1),
    )
    links = marked.select("url", F.explode(targets).alias("target"))
    return links.select(
        node_of(F.col("url")).alias("a"),
        node_of(_resolved(F.col("target"), F.col("url"))).alias("b"),
    ).filter("a IS NOT NULL AND b IS NOT NULL")


def _with_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (distinct, with ``host`` and ``path``) with the ``rule`` and ``action`` that
    fit, if any."""
    rules = rules.select(
        F.col("host").alias("r_host"), F.col("path").alias("r_path"), "action"
    ).groupBy("r_host", "r_path").agg(F.min("action").alias("action"))  # allow before block
    lengths = rules.groupBy("r_host").agg(
        F.collect_set(F.char_length("r_path")).alias("r_lengths")
    )
    sites = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    at_hosts = (
        sites.filter("host <> ''")
        .select("host", "path", F.explode(suffixes).alias("r_host"))
        .join(lengths, "r_host")
        .select("host", "path", "r_host", F.explode("r_lengths").alias("n"))
        .filter(F.col("n") <= F.char_length("path"))
        .withColumn("r_path", F.substring("path", F.lit(1), F.col("n")))
    )
    longest = (
        at_hosts.join(rules, ["r_host", "r_path"])
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    (F.char_length("r_host") + F.col("n")).alias("size"),
                    F.concat("r_host", "r_path").alias("rule"),
                    "action",
                )
            ).alias("best")
        )
        .select("host", "path", "best.rule", "best.action")
    )
    return urls.join(longest, ["host", "path"], "left")


def _located(urls: DataFrame) -> DataFrame:
    return urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})


def verdicts(urls: DataFrame, rules: DataFrame, edges: DataFrame) -> DataFrame:
    """``url``, ``host``, ``path``, ``rule``, ``verdict`` of each distinct ``url``.

    ``edges`` (``a``, ``b``) link alias nodes, see ``node_of``.
    """
    ruled = _with_rules(_located(urls.select("url").distinct()), rules)
    aliases = materialize(connected_components(edges), "aliases")
    at_nodes = _with_rules(_located(aliases.select(F.col("node").alias("url"))), rules)
    seeds = at_nodes.filter("action = 'block'").select(F.col("url").alias("node"))
    blocked = (
        aliases.join(seeds, "node").select("component").distinct()
        .join(aliases, "component")
        .select("node", F.lit("block").alias("said"))
    )
    explicit = ruled.filter("rule IS NOT NULL").withColumn("said", F.col("action"))
    others = ruled.filter("rule IS NULL").withColumn("node", node_of(F.col("url")))
    others = others.join(blocked, "node", "left").drop("node")
    return explicit.unionByName(others).select(
        "url", "host", "path", "rule", F.coalesce("said", F.lit("allow")).alias("verdict")
    )


def judge(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    html: str = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """``pages`` without ``html``, with ``host``, ``path``, ``rule`` and ``verdict``
    (columns by those names are replaced).

    ``redirects`` (``a``, ``b``: URLs) adds edges from a crawl's log to those in the pages.
    """
    edges = link_edges(pages, url, html)
    if redirects is not None:
        edges = edges.unionByName(
            redirects.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b"))
        )
    found = verdicts(pages.select(F.col(url).alias("url")), rules, edges)
    found = found.withColumnRenamed("url", "__url")
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", html)]
    return pages.select(*kept).join(
        found, F.col(url).eqNullSafe(F.col("__url")), "left"
    ).drop("__url")
