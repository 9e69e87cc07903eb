"""URL filters with redirect equivalence.

Explicit rules judge a url by host and path. Urls that are aliases of each other form a class: a page and its canonical
link or refresh target, known redirects and, only with ``spellings=True``, urls that differ only in scheme, fragment, tracking
parameters, a trailing slash or a leading www. Classes are connected components over those edges. A url without a rule of its own takes its class's
decision: allow if an alias is explicitly allowed, else block if an alias is explicitly blocked, else allow. DataFrame
functions only.

Defined cases: a null url, or one without ``://``, has empty host and path, no rule, no alias and verdict allow; repeated
pages are judged one by one; equally long rules that fit are taken in order of their text; relative link targets are
resolved against their page; columns named like results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arterial.operators.components import components
from arterial.session import pin

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# (verdict, host, path)
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
_TRACKING = "(utm_[a-z]+|fbclid|gclid|ref)=[^&#]*"


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.position(F.lit("://"), url) + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.when(F.coalesce(F.position(F.lit("://"), url), F.lit(0)) > 0, host).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.position(F.lit("://"), url) + 3, F.length(url))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(F.coalesce(F.position(F.lit("://"), url), F.lit(0)) > 0, path).otherwise("")


def rule_verdict(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, of, prefix in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == of) | F.endswith(host, F.lit("." + of))) & F.startswith(path, F.lit(prefix))
        found = F.coalesce(found, F.when(fits, F.struct(F.lit(of + prefix).alias("rule"), F.lit(verdict).alias("verdict"))))
    return found


def spelling(url: Column) -> Column:
    """The form shared by spellings of one address."""
    query = F.regexp_replace(F.regexp_extract(url, "\\?([^#]*)", 1), "(^|&)" + _TRACKING, "")
    query = F.regexp_replace(query, "^&", "")
    host = F.regexp_replace(host_of(url), "^www\\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), "/index\\.html?$", "/"), "/+$", "")
    return F.concat(host, path, F.when(F.length(query) > 0, F.concat(F.lit("?"), query)).otherwise(""))


def _resolved(target: Column, url: Column) -> Column:
    """A link target as an absolute url."""
    root = F.regexp_extract(url, "^[^:/?#]+://[^/?#]*", 0)
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(F.startswith(target, F.lit("//")), F.concat(F.regexp_extract(url, "^[^:/?#]+:", 0), target))
        .when(F.startswith(target, F.lit("/")), F.concat(root, target))
        .otherwise(F.concat(F.regexp_extract(url, "^([^:/?#]+://[^?#]*/|[^:/?#]+://[^/?#]*)", 0), F.lit("/"), target))
    )


def link_edges(pages: DataFrame) -> DataFrame:
    """(url, target) for canonical links and refresh redirects in the pages' heads; all of the html is searched."""
    tags = F.regexp_extract_all(
        "html", F.lit("(?is)<(?:link|meta)\\s[^>]*(?:rel\\s*=\\s*[\"']?canonical|http-equiv\\s*=\\s*[\"']?refresh)[^>]*>"), 0
    )
    target = F.coalesce(
        F.nullif(F.regexp_extract("tag", "(?i)href\\s*=\\s*[\"']?([^\"'\\s>]+)", 1), F.lit("")),
        F.nullif(F.regexp_extract("tag", "(?i)url\\s*=\\s*[\"']?([^\"'\\s>]+)", 1), F.lit("")),
    )
    return (
        pages.where(F.contains("url", F.lit("://")) & F.col("html").rlike("(?i)canonical|refresh"))
        .select("url", F.explode(tags).alias("tag"))
        .select("url", _resolved(target, F.col("url")).alias("target"))
        .where("target is not null")
    )


def judge_urls(
    pages: DataFrame, redirects: DataFrame | None = None, keep: list[str] | None = None, rules=RULES, spellings: bool = False
) -> DataFrame:
    """``pages`` (url, html; columns ``keep``, default all) with host, path, rule, verdict, alias_class.

    ``redirects`` (url, target) adds known redirects. Only urls with an alias enter the component search; their class
    decisions are one row per class and are joined back on the spelling, of which a class has one row. Without ``spellings``
    a url's spelling is the url itself.
    """
    spell = spelling if spellings else lambda url: url
    keep = [c for c in (pages.columns if keep is None else keep) if c not in ("host", "path", "rule", "verdict", "alias_class")]
    links = link_edges(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target").where("url is not null and target is not null"))
    links = pin(links.distinct())
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    own = rule_verdict(F.col("host"), F.col("path"), rules)
    # other columns travel in one struct, so that their names can be anything
    judged = pages.select(F.struct(*keep).alias("row"), "url", host.alias("host"), path.alias("path")).withColumn("own", own)
    judged = judged.withColumn("spelling", F.when(F.col("host") != "", spell(F.col("url"))))
    # decisions per spelling: urls of pages, and link targets that are no page here
    targets = links.select(host_of(F.col("target")).alias("host"), path_of(F.col("target")).alias("path"), spell(F.col("target")).alias("spelling"))
    named = judged.where("spelling is not null").select("spelling", "own.verdict").unionByName(
        targets.select("spelling", own["verdict"].alias("verdict"))
    )
    allowed, blocked = F.max(F.col("verdict") == "allow"), F.max(F.col("verdict") == "block")
    decided = named.groupBy("spelling").agg(allowed.alias("allowed"), blocked.alias("blocked"))
    edges = links.select(spell(F.col("url")).alias("a"), spell(F.col("target")).alias("b")).where("a <> b")
    if edges.isEmpty():
        classes = decided.select("spelling", F.col("spelling").alias("alias_class"), "allowed", "blocked")
    else:
        groups = components(edges).select(F.col("node").alias("spelling"), "component")
        joined = decided.join(groups, "spelling", "left").withColumn("alias_class", F.coalesce("component", "spelling"))
        of_class = joined.groupBy("alias_class").agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked"))
        classes = joined.select("spelling", "alias_class").join(of_class, "alias_class")
    verdict = F.coalesce(
        F.col("own.verdict"),
        F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").otherwise("allow"),
    )
    return judged.join(classes, "spelling", "left").select(
        "row.*", "host", "path", F.col("own.rule").alias("rule"), verdict.alias("verdict"), "alias_class"
    )
