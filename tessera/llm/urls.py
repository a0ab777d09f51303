"""URL rules with redirect equivalence.

A rule is (host, path, verdict); it fits its host and all subdomains where the url's path starts
with the rule's, and the longest fitting rule decides.  Urls that redirect to each other or name
each other canonical are aliases: connected components over those links.  A url that no rule
decides takes its component's decision: allowed if an alias is explicitly allowed, else blocked if
an alias is blocked, else allowed.
"""

from __future__ import annotations

import html as markup
import re
import string
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import set_aside
from .components import connected_components
from .store import materialize

ALLOW, BLOCK = "allow", "block"
TAG = r"(?i)<(?:base|link|meta)\b[^>]*"
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*("[^"]*"?|'[^']*'?|[^\s"'>]+)""")
#: seconds, then a target after "url=" or without it, quoted or not
_REFRESH = re.compile(r"""(?is)^\s*[\d.]*\s*[;,]?\s*(?:url\s*=\s*)?(?:"([^"]*)|'([^']*)|(.*))""")


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return _ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """What tells a page for redirects: host, path and query, whatever scheme and fragment; an empty
    path is /."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host_of(url), F.when(rest.startswith("/"), "").otherwise("/"), rest))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, null if none fits.  Equal lengths: the
    longer host, then allow, then the smaller text.  The rules are a list in the plan: what fits
    there is a hand-written policy, not a table."""
    order = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[2] != ALLOW, r))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in reversed(order):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _attributes(tag: str) -> dict[str, str]:
    """Names in lower case and unescaped values; the first of a name counts."""
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(tag):
        out.setdefault(name.lower(), markup.unescape(value.strip(value[0]) if value[0] in "\"'" else value))
    return out


def _resolve(base: str, target: str) -> str | None:
    """The target as a whole url without dot segments, None if it is no url."""
    try:
        whole = urljoin(base, "".join(c for c in target.strip() if c not in "\t\n\r"))
        path = urlsplit(whole).path
        return urljoin(whole, whole[whole.index(path, whole.index("://") + 3) :]) if "/." in path else whole
    except ValueError:
        return None


def targets_of(url: str, tags: list[str]) -> list[str]:
    """Whole urls of the canonical links and refresh redirects among a page's tags, resolved against
    its first base address."""
    base, found = None, []
    for tag in tags:
        name, own = re.match(r"<(\w+)", tag)[1].lower(), _attributes(tag)
        if name == "base":
            base = base or own.get("href")
        elif name == "link" and "canonical" in own.get("rel", "").lower().split():
            found.append(own.get("href", ""))
        elif name == "meta" and own.get("http-equiv", "").strip().lower() == "refresh":
            found.append(next(filter(None, _REFRESH.match(own.get("content", "")).groups()), ""))
    start = (_resolve(url, base) if base else None) or url
    return [whole for t in found if t.strip() and (whole := _resolve(start, t))]


@F.arrow_udf(T.ArrayType(T.StringType()))
def _targets(urls: pa.Array, tags: pa.Array) -> pa.Array:
    return pa.array([targets_of(u, t) for u, t in zip(urls.to_pylist(), tags.to_pylist())], pa.list_(pa.string()))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(u, v) addresses: all canonical links and refresh redirects of each page, resolved against
    its url (or its base element)."""
    found = pages.select(F.col(url).alias("url"), F.col(html).alias("html")).where("url is not null and html is not null")
    found = found.where(F.expr("html ilike '%canonical%' or html ilike '%refresh%'"))
    found = found.select("url", F.regexp_extract_all("html", F.lit(TAG), F.lit(0)).alias("tags"))
    found = found.where(F.exists("tags", lambda t: t.rlike("(?i)canonical|refresh")))
    pairs = found.select("url", F.explode(_targets("url", "tags")).alias("target"))
    return pairs.select(address(F.col("url")).alias("u"), address(F.col("target")).alias("v")).dropna()


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], links: DataFrame | None = None, url: str = "url", html: str | None = "html") -> DataFrame:
    """pages with host, path, rule, verdict, decided_by ('rule', 'alias' or 'default') added;
    columns of those names are replaced.

    links: further redirects as (u, v) urls.  Null urls and urls without :// have empty host and
    path, no rule and no aliases, and are allowed; repeated urls share a decision; texts of any
    length are read whole; other columns, whatever their names, stay as they are; an empty table
    gives an empty result; a missing html adds no links.
    """
    base, back = set_aside(pages.drop("host", "path", "rule", "verdict", "decided_by"), ("_rule", "_address", "_node", "_alias"))
    own = base.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url)), "_address": address(F.col(url))})
    own = own.withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
    edges = None
    if html is not None and html in pages.columns:
        edges = page_links(pages, url, html)
    if links is not None:
        more = links.select(address(F.col("u")).alias("u"), address(F.col("v")).alias("v")).dropna()
        edges = more if edges is None else edges.unionByName(more)
    spark = pages.sparkSession
    if edges is None:
        edges = spark.createDataFrame([], T.StructType([T.StructField("u", T.StringType()), T.StructField("v", T.StringType())]))
    aliases = materialize(connected_components(edges), "aliases")
    # a rule may fit an alias that no page has: every node of a link is judged
    judged = aliases.withColumn("_r", fitting_rule(F.regexp_extract("node", r"(?s)^([^/?#]*)", 1), F.regexp_extract("node", r"(?s)^[^/?#]*([^?#]*)", 1), rules))
    decided = judged.groupBy("component").agg(F.max(F.coalesce(F.col("_r.verdict") == ALLOW, F.lit(False))).alias("allowed"), F.max(F.coalesce(F.col("_r.verdict") == BLOCK, F.lit(False))).alias("blocked"))
    decision = F.when(F.col("allowed"), ALLOW).when(F.col("blocked"), BLOCK)
    by_alias = aliases.join(decided, "component").select(F.col("node").alias("_node"), decision.alias("_alias")).dropna()
    out = own.join(by_alias, own["_address"] == by_alias["_node"], "left")
    out = out.withColumns(
        {
            "rule": F.col("_rule.rule"),
            "verdict": F.coalesce("_rule.verdict", "_alias", F.lit(ALLOW)),
            "decided_by": F.when(F.col("_rule").isNotNull(), "rule").when(F.col("_alias").isNotNull(), "alias").otherwise("default"),
        }
    )
    return back(out.drop("_rule", "_alias", "_node", "_address"))
