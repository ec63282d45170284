"""URL filtering with redirect equivalence.

Host rules decide first.  Block decisions then spread to every alias of a
blocked url: aliases are the connected components over redirect links (meta
refresh), canonical links (``rel=canonical``, ``og:url``) and the step from a
url to its normal form (lower-case scheme and host, no fragment, no tracking
parameters, no default port).  A url with a rule of its own keeps that
rule's verdict, and a component that holds an explicitly allowed url is not
blocked through its links.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecut.llm.common import let, store
from pagecut.llm.components import connected_components

#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Query parameters that name a campaign, not a page.
TRACKING = r"(?:utm_[a-z]+|gclid|fbclid|ref|source)"


def _lower(c: Column) -> Column:
    """A-Z lower-cased; other letters stay."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end; path: then up to ``?``, ``#`` or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def match_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits; null if none does.

    A rule fits its host and all subdomains, if the path starts with the
    rule's.  Length counts the rule's text.
    """
    best = None
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        made = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        best = F.when(fits, made) if best is None else best.when(fits, made)
    return best


def normal_form(url: Column) -> Column:
    """The address that a url stands for: scheme and host lower-cased, no fragment, default port or tracking parameters."""
    bare = F.regexp_replace(url, "#.*$", "")
    head = F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", 0)
    tail = F.substring(bare, F.length(head) + 1, F.length(bare))
    tail = F.regexp_replace(tail, r"([?&])" + TRACKING + r"=[^&]*(?=&|$)", "$1")
    tail = F.regexp_replace(F.regexp_replace(tail, r"&{2,}", "&"), r"\?&", "?")
    tail = F.regexp_replace(tail, r"[?&]+$", "")
    return F.concat(F.regexp_replace(_lower(head), r"^(http://[^/]*):80$|^(https://[^/]*):443$", "$1$2"), tail)


def link_target(html: Column, url: Column) -> list[Column]:
    """Absolute redirect and canonical targets of a page; null or empty where there is none."""
    attr = r"""\s*=\s*["']?\s*([^"'\s>]+)"""
    refresh = F.regexp_extract(html, r"(?i)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh)[^>]*?\burl\s*=\s*['\"]?([^\"'\s>]+)", 1)
    canonical = F.regexp_extract(html, r"(?i)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical)[^>]*?\bhref" + attr, 1)
    og = F.regexp_extract(html, r"(?i)<meta\b(?=[^>]*\bproperty\s*=\s*[\"']?og:url)[^>]*?\bcontent" + attr, 1)
    plain = lambda t: F.regexp_replace(F.nullif(t, F.lit("")), "(?i)&(?:amp|#38|#x26);", "&")
    # ``let``: the expression over the html runs once, however often its value is looked at
    return [let(plain(t), lambda found: F.when(found.isNotNull(), _resolve(found, url))) for t in (refresh, canonical, og)]


def _resolve(target: Column, url: Column) -> Column:
    """A link's target against the url of its page; null for a place on the page itself and for other schemes."""
    scheme, base = F.regexp_extract(url, r"^[^:/?#]+:", 0), F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*", 0)
    path = F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    own, rest = F.regexp_extract(target, r"^[^?#]*", 0), F.regexp_extract(target, r"^[^?#]*(.*)$", 1)
    whole = F.when(own.startswith("/"), own).otherwise(F.concat(F.regexp_replace(path, "[^/]*$", ""), own))
    parts = F.filter(F.split(F.regexp_replace(whole, "^/", ""), "/"), lambda p: p != ".")
    up = lambda acc: F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(F.array().cast("array<string>"))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, p: F.when(p == "..", up(acc)).otherwise(F.array_append(acc, p)))
    folder = F.when(own.rlike(r"(?:^|/)\.{1,2}$") & (F.size(kept) > 0), "/").otherwise("")
    return F.when(target.startswith("#"), None).when(target.startswith("//"), F.concat(scheme, target)) \
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.when(target.rlike("^[^:/?#]+://"), target)) \
        .when(target.startswith("?"), F.concat(base, path, target)) \
        .otherwise(F.concat(base, F.lit("/"), F.array_join(kept, "/"), folder, rest))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES) -> DataFrame:
    """(id, host, path, rule, verdict, root) for every row of ``pages``.

    ``verdict`` is the rule's; else block if a link component holds a blocked
    url (a page's or a link target's) and no url that a rule allows; else
    allow.  ``root`` names the component (null: the url has no aliases).  A
    null url, or one without ``://``, has empty host and path, fits no rule, has no
    aliases and is allowed.  Null html has no links; repeated urls and ids
    give a row each; an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    found = F.when(F.instr("url", "://") > 0, F.array_compact(F.array(normal_form(F.col("url")), *map(
        normal_form, link_target(F.col("html"), F.col("url"))))))
    links = rows.select("url", F.explode(found).alias("to")).where("to <> '' and to <> url").distinct()
    links = store(links, "links")  # the expressions over the html run once
    # nodes are urls; a 64-bit digest stands for each while components are sought
    links = links.select(F.xxhash64("url").alias("a"), F.xxhash64("to").alias("b"), "url", "to")
    roots = connected_components(links.select("a", "b"))
    nodes = links.select(F.explode(F.array(F.struct(F.col("a").alias("node"), "url"),
                                           F.struct(F.col("b").alias("node"), F.col("to").alias("url")))).alias("n")).select("n.*").distinct()
    nodes = nodes.withColumn("hit", match_rule(*host_and_path(F.col("url")), rules)["verdict"]).join(roots, "node")
    spread = nodes.groupBy("component").agg(
        (F.max((F.col("hit") == "block").cast("int")) == 1).alias("blocked"),
        (F.coalesce(F.max((F.col("hit") == "allow").cast("int")), F.lit(0)) == 0).alias("open"))
    spread = roots.join(spread, "component").select("node", F.col("component").alias("root"), (F.col("blocked") & F.col("open")).alias("stop"))
    own = match_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("id", host.alias("host"), path.alias("path"), F.when(F.instr("url", "://") > 0, F.xxhash64("url")).alias("node"))
    return rows.join(spread, "node", "left").select(
        "id", "host", "path", own["rule"].alias("rule"),
        F.coalesce(own["verdict"], F.when(F.col("stop"), "block").otherwise("allow")).alias("verdict"), "root")
