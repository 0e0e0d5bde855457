"""URL filters with redirect equivalence, in DataFrame operations.

A rule names a host, which stands for its subdomains as well, and the beginning of a path.
Of the rules that fit a URL the longest one decides. URLs that lead to the same page are
aliases: they differ in what a server drops or redirects, or one page names the other as its
canonical link or as the target of a refresh. The components of these edges carry a block
from one alias to all, unless one of them is explicitly allowed.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import pick, text_or_empty
from lectern.llm.components import connected_components
from lectern.staging import stage

ALLOW, BLOCK = "allow", "block"

_LINK = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
_HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
_TARGET = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"
#: What a server usually drops from a path or answers by a redirect to the bare path.
_PATH_END = r"(/|/index\.html?|\.html?)$"


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host and a path, written ``host/path``."""

    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased. Null or
    without ``://``: empty."""
    return lower_ascii(F.regexp_extract(text_or_empty(url), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(text_or_empty(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fits(rule: Rule, host: Column, path: Column) -> Column:
    own = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
    return own & F.startswith(path, F.lit(rule.path))


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The rule that decides, or null; of equally long ones the first given. The rules are
    literals of the plan, so their number is that of a hand-written list."""
    found = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.rule)):
        found = F.when(fits(rule, host, path), F.lit(rule.rule)).otherwise(found)
    return found


def alias_key(url: Column) -> Column:
    """The URL without what makes no difference: scheme, fragment, query, ``.`` and ``..``
    segments, the end of a path that a server adds or drops. Null if there is no host."""
    host, path = host_of(url), without_dots(path_of(url))
    return F.when(host != "", F.concat(host, F.regexp_replace(path, _PATH_END, "")))


def without_dots(path: Column) -> Column:
    """``path`` with its ``.`` and ``..`` segments resolved; ``..`` at the top leads nowhere."""
    parts = F.split(path, "/")

    def step(done: Column, part: Column) -> Column:
        return F.when(part == "..", F.regexp_replace(done, "/[^/]*$", "")).when(part == ".", done).otherwise(F.concat(done, F.lit("/"), part))

    # What stands before the first slash is empty.
    walked = F.aggregate(F.slice(parts, 2, F.size(parts)), F.lit(""), step)
    ended = F.concat(walked, F.when(path.rlike(r"/\.\.?\z"), "/").otherwise(""))
    return F.when(F.contains(path, F.lit("/.")), ended).otherwise(path)


def absolute(link: Column, url: Column) -> Column:
    """``link`` as found on the page ``url``, without ``.`` and ``..`` segments; null if it is
    empty or has a scheme but no host (``mailto:``)."""
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
    full = (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(site, link))
        .when(link.rlike("^[?#]"), F.concat(site, path_of(url), link))
        .when(link != "", F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
    )
    before = F.regexp_extract(full, r"(?s)^(.*?://[^/?#]*)", 1)
    behind = F.regexp_extract(full, r"(?s)^.*?://[^?#]*(.*)$", 1)
    return F.concat(before, without_dots(path_of(full)), behind)


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``a``, ``b``: alias keys of a page and of each URL that it names as its canonical link or
    as the target of a refresh; ``target``: that URL."""
    slim = pick(pages, url=url, html=html)

    def named_by(tag: str, attribute: str) -> Column:
        return F.transform(F.regexp_extract_all("html", F.lit(tag), F.lit(0)), lambda t: F.regexp_extract(t, attribute, 1))

    # Pages without either are told apart by a plain search first.
    low = F.lower("html")
    named = slim.filter(F.contains(low, F.lit("canonical")) | F.contains(low, F.lit("refresh")))
    every = F.concat(named_by(_LINK, _HREF), named_by(_REFRESH, _TARGET))
    links = named.select("url", F.explode(every).alias("link")).filter("link <> ''")
    found = links.select("url", absolute(F.col("link"), F.col("url")).alias("target"))
    return found.select(
        alias_key(F.col("url")).alias("a"), alias_key(F.col("target")).alias("b"), "target"
    ).filter("a is not null and b is not null")


def judged(
    pages: DataFrame, rules: Sequence[Rule], page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """page_id, host, path, rule, verdict, ``alias_class`` for each row of ``pages``.

    A URL that a rule fits gets its verdict. Another is blocked if a rule blocks one of its
    aliases and none allows one; else it is allowed. A URL without a host has no alias, no
    rule unless an empty host has one, and is allowed. Rows stay as often as they come; extra
    columns are not carried. No rows: none.

    Classes are judged by sums over their keys, combined before the shuffle, so one key with
    a large part of all rows sends one row from each task.
    """
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in (r.rule, r.verdict)]) if rules else None
    slim = pick(pages, page_id=page_id, url=url).select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), alias_key(F.col("url")).alias("key")
    )
    rule = longest_rule(rules, F.col("host"), F.col("path"))
    ruled = slim.withColumn("rule", rule)
    own = verdicts[F.col("rule")] if verdicts is not None else F.lit(None).cast("string")
    ruled = ruled.withColumn("own", F.when(F.col("rule").isNotNull(), own))
    links = stage(page_links(pages, url, html))
    components = stage(connected_components(links))
    keys = (
        ruled.filter("key is not null")
        .groupBy("key")
        .agg(
            F.max(F.coalesce(F.col("own") == BLOCK, F.lit(False))).alias("blocked"),
            F.max(F.coalesce(F.col("own") == ALLOW, F.lit(False))).alias("allowed"),
        )
        .join(components, F.col("key") == F.col("node"), "left")
        .select("key", F.coalesce("component", "key").alias("class"), "blocked", "allowed")
    )
    # Link targets need not be pages themselves; they are ruled by the URL in the link.
    target_rule = longest_rule(rules, host_of(F.col("target")), path_of(F.col("target")))
    target_verdict = verdicts[target_rule] if verdicts is not None else F.lit(None).cast("string")
    targets = (
        links.select(F.col("b").alias("key"), target_verdict.alias("own"))
        .filter("own is not null")
        .groupBy("key")
        .agg(F.max(F.col("own") == BLOCK).alias("blocked"), F.max(F.col("own") == ALLOW).alias("allowed"))
        .join(components, F.col("key") == F.col("node"), "left")
        .select("key", F.coalesce("component", "key").alias("class"), "blocked", "allowed")
    )
    stored = stage(keys)
    every = stored.unionByName(targets)
    classes = every.groupBy("class").agg((F.max("blocked") & ~F.max("allowed")).alias("blocks"))
    blocked = classes.filter("blocks").select(F.struct(F.col("class").alias("c")).alias("_c"))
    by_key = stage(
        stored.withColumn("_c", F.struct(F.col("class").alias("c")))
        .join(blocked.withColumn("blocks", F.lit(True)), "_c", "left")
        .select(F.col("key").alias("_key"), F.col("class").alias("alias_class"), "blocks")
    )
    return ruled.join(by_key, F.col("key") == F.col("_key"), "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("own", F.when(F.col("blocks"), BLOCK).otherwise(ALLOW)).alias("verdict"),
        "alias_class",
    )
