"""URL rules with redirect equivalence.

A rule is (verdict, host, path): it fits its host and all subdomains where the
url's path starts with the rule's; the longest rule wins.  Canonical links and
refresh redirects in a page's html make its url and their targets aliases (both
where a page has both; relative ones are resolved against the page's url); the
connected components of these links are found by distributed star steps.  A
url that no rule fits takes its component's decision: allow if any alias has
an allow rule, else block if any alias has a block rule, else allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.llm.common import attach, cut
from stagewise.llm.graph import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
MOST_RULES = 1000

#: ``rel`` is a list of tokens; a comment that nothing closes goes to the end.
_CANONICAL = r"""(?i)<link\b[^>]*\brel\s*=\s*(?:"(?:[^">]*\s)?canonical(?:\s[^">]*)?"|'(?:[^'>]*\s)?canonical(?:\s[^'>]*)?'|canonical(?=[\s/>]))[^>]*>"""
_COMMENT = r"(?s)<!--.*?(?:-->|\z)"
_REFRESH = r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_HREF = r"""(?i)\bhref\s*=\s*["']?([^"'>\s]+)"""
_URL = r"""(?i)\burl\s*=\s*["']?([^"'>\s]+)"""


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node(url: Column) -> Column:
    """A url's place in the graph: host, path (an empty one is ``/``) and query, whatever its scheme and fragment."""
    whole = F.when(path(url) == "", F.lit("/")).otherwise(path(url))
    return F.xxhash64(host(url), whole, F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1))


def rule(h: Column, p: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as (rule, verdict), else null.  The list is a parameter of bounded length."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rh, rp in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((h == rh) | F.endswith(h, F.lit("." + rh))) & F.startswith(p, F.lit(rp))
        out = F.when(fits, F.struct(F.lit(rh + rp).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def without_dots(p: Column) -> Column:
    """An absolute path with its ``.`` and ``..`` segments taken out."""
    segments = F.split(F.substr(p, F.lit(2)), "/")
    kept = F.aggregate(segments, F.array().cast("array<string>"), lambda acc, s: F.when(s == ".", acc)
                       .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(s))))
    end = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.when(F.contains(p, F.lit("/.")), F.concat(F.lit("/"), F.array_join(F.concat(kept, end), "/"))).otherwise(p)


def resolve(url: Column, link: Column) -> Column:
    """``link`` as an absolute url, seen from the page ``url``; null if it has another scheme's form (``mailto:``) or ``url`` no host."""
    root = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    here = F.when(path(url) == "", "/").otherwise(path(url))
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    own, rest = F.regexp_extract(link, r"(?s)^([^?#]*)", 1), F.regexp_extract(link, r"(?s)^[^?#]*(.*)$", 1)
    near = (F.when(own == "", F.concat(path(url), F.when(F.startswith(rest, F.lit("?")), rest).otherwise(F.concat(query, rest))))
            .when(F.startswith(own, F.lit("/")), F.concat(without_dots(own), rest))
            .otherwise(F.concat(without_dots(F.concat(F.regexp_extract(here, r"(?s)^(.*/)", 1), own)), rest)))
    return (F.when(F.startswith(link, F.lit("//")), F.concat(F.lit("http:"), link)).when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(~link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") & (root != ""), F.concat(root, near)))


def targets(url: Column, html: Column) -> Column:
    """The canonical and the refresh target in a page, comments aside, as absolute urls; an empty array if there is none."""
    html = F.regexp_replace(html, _COMMENT, "")
    links = [F.replace(F.nullif(F.regexp_extract(F.regexp_extract(html, tag, 0), at, 1), F.lit("")), F.lit("&amp;"), F.lit("&")) for tag, at in ((_CANONICAL, _HREF), (_REFRESH, _URL))]
    return F.array_compact(F.array(*(resolve(url, link) for link in links)))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url, html, ...).

    A null url or one without ``://`` has an empty host and path, fits no rule
    and is allowed.  A null html has no links.  Rows with the same url or id
    are judged one by one.  An empty table gives no rows; other columns are
    not read.
    """
    url = F.col("url").cast("string")
    d = pages.select("page_id", host(url).alias("host"), path(url).alias("path"), F.when(F.contains(url, F.lit("://")), node(url)).alias("node"),
                     targets(url, F.col("html").cast("string")).alias("to"))
    d = cut(d.withColumn("r", rule(F.col("host"), F.col("path"), rules)), "urls")
    linked = d.where("node is not null").select("node", F.explode("to").alias("to"))
    to = linked.select("node", node(F.col("to")).alias("end"), rule(host(F.col("to")), path(F.col("to")), rules).alias("r"))
    parts = components(linked.select(F.col("node").alias("a"), node(F.col("to")).alias("b")))
    # the decision of each component: the rules of its urls, of pages and of targets alike
    verdicts = d.select("node", F.col("r.verdict").alias("v")).unionByName(to.select(F.col("end").alias("node"), F.col("r.verdict").alias("v")))
    nodes = verdicts.where("node is not null").groupBy("node").agg(F.count_if(F.col("v") == "allow").alias("allow"), F.count_if(F.col("v") == "block").alias("block"),
                                                                   F.count(F.lit(1)).alias("n"))
    nodes = cut(nodes.join(parts, "node"), "aliases")
    total = d.count()
    decision = nodes.groupBy("root").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"), F.count(F.lit(1)).alias("m"))
    decision = decision.withColumn("said", F.when(F.col("allow") > 0, "allow").when(F.col("block") > 0, "block"))
    said = attach(nodes.select("node", "n", "root"), decision.select("root", "m", "said"), "root", "m", max(total, 1), ["said"])
    out = attach(d, said, "node", "n", max(total, 1), ["said", "root"])
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", "said", F.lit("allow")).alias("verdict"),
                      F.col("root").alias("alias_group"))
