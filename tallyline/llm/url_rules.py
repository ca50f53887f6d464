"""URL filter with redirect equivalence.

A rule blocks or allows a host with its subdomains and a path prefix; the
longest rule that fits a URL decides. URLs that redirect to each other, or name
one another as canonical, are one page: connected components over these links
carry decisions to aliases that no rule fits. In a component an explicit allow
takes precedence over any block; without either, or without links, a URL is
allowed.

Links come from the pages themselves (rel=canonical, meta refresh) and, where
given, from a table of redirects (`source`, `target`). A link's end is a URL
without scheme, fragment and closing slash, so http and https forms of an
address meet. Only URLs with links enter the component search; its rounds are
grouped minima over written edges, so a page that a third of all others name as
canonical is one key whose minimum is combined before the shuffle.

Defined cases: a null url, or one without '://', has an empty host and path, no
rule and no links; null html has no links; repeated pages are judged alike; an
empty table yields no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import materialize, read
from tallyline.llm.components import components

# Fixed values of the contract: verdict, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?[^"'>]*\bcanonical\b)[^>]*\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*["']?([^"'>\s]+)"""
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), ASCII_UPPER, ASCII_LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def decide(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null where none does."""
    name = verdict = None
    for kind, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)) if name is None else name.when(fits, F.lit(h + p))
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    return name, verdict


def address(url: Column) -> Column:
    """Host, path and query of an absolute URL, without a closing slash; null where there is no host."""
    query = F.regexp_extract(url, r"(?s)^[^#]*?(\?[^#]*)", 1)
    out = F.concat(host_of(url), F.regexp_replace(path_of(url), "/$", ""), query)
    return F.when(F.coalesce(host_of(url), F.lit("")) != "", out)


def _target(url: Column, link: Column) -> Column:
    """A link's absolute URL: as it stands, with the page's scheme, host, or directory."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_replace(path_of(url), r"[^/]*$", "")
    return (F.when(link.contains("://"), link).when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(root, link)).when(link.startswith("?"), F.concat(root, path_of(url), link))
            .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), link)))


def links(pages: DataFrame) -> DataFrame:
    """(source, target) addresses that the pages declare."""
    url, page = F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit(""))
    hrefs = F.concat(*[F.regexp_extract_all(page, F.lit(CANONICAL), F.lit(g)) for g in (1, 2, 3)],
                     F.regexp_extract_all(page, F.lit(REFRESH), F.lit(1)))
    found = pages.where(page.rlike(CANONICAL) | page.rlike(REFRESH)).select(
        url.alias("url"), F.explode(F.filter(F.transform(hrefs, lambda h: F.trim(F.replace(h, F.lit("&amp;"), F.lit("&")))), lambda h: h != "")).alias("link"))
    ends = found.select(address(F.col("url")).alias("source"), address(_target(F.col("url"), F.col("link"))).alias("target"))
    return ends.where("source is not null and target is not null and source <> target").distinct()


def judge_urls(pages: DataFrame, redirects: DataFrame | None = None, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every page; component is the alias group's least address (null: no links)."""
    edges = links(pages)
    if redirects is not None:
        more = redirects.select(address(F.col("source")).alias("source"), address(F.col("target")).alias("target"))
        edges = edges.unionByName(more.where("source is not null and target is not null and source <> target"))
    edges = materialize(edges.select(F.col("source").alias("a"), F.col("target").alias("b")), "url-links")
    url = F.col("url").cast("string")
    out = pages.select("page_id", url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    name, verdict = decide(F.col("host"), F.col("path"), rules)
    out = out.withColumns({"rule": name, "own": verdict})
    if edges.isEmpty():
        return out.select("page_id", "host", "path", "rule", F.coalesce("own", F.lit("allow")).alias("verdict"),
                          F.lit(None).cast("string").alias("component"))

    groups = components(edges, "url-components")
    as_url = F.concat(F.lit("//"), F.col("node"))     # an address needs a scheme mark to be split again
    split = groups.select("node", "component", host_of(F.concat(F.lit("x:"), as_url)).alias("host"),
                          F.concat(path_of(F.concat(F.lit("x:"), as_url)), F.lit("/")).alias("path"))
    _, by_rule = decide(F.col("host"), F.col("path"), rules)
    named = split.select("component", by_rule.alias("verdict"))
    # every page's own rule speaks for its group too (the address has lost a closing slash)
    own = out.where("own is not null").select(address(F.col("url")).alias("node"), F.col("own").alias("verdict"))
    named = named.unionByName(groups.join(own.distinct(), "node").select("component", "verdict"))
    votes = named.groupBy("component").agg(F.max(F.col("verdict") == "allow").alias("allow"), F.max(F.col("verdict") == "block").alias("block"))
    decided = groups.join(votes, "component").select("node", "component", F.when(F.col("allow"), "allow").when(F.col("block"), "block").alias("alias"))
    decided = materialize(decided, "url-aliases")
    out = out.withColumn("node", address(F.col("url"))).join(decided, "node", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("own", "alias", F.lit("allow")).alias("verdict"), "component")


def op6_redirect_components(spark, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"))


ORACLE_SQL = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
fits AS (
  SELECT *,
    CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
         WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
         WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict,
       CAST(NULL AS VARCHAR) AS component
FROM fits
"""
