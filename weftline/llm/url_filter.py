"""URL filters whose decisions reach aliases: rules by host and path, then redirects and canonical links.

A rule names a host, with all its subdomains, and a path that a url's path starts with; the longest that fits decides. Pages
that lead to one another, by a redirect or a canonical link, are one resource: connected components over these links, each
url known by 128 bits of its SHA-256. Urls without a rule of their own are blocked where their component holds a blocked
url, unless it also holds one that a rule allows: an explicit allow goes before an inherited block. All others are allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import cut_lineage, set_aside
from weftline.llm.graph import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Up to so many rules are one expression; more are joined.
FEW = 32


@dataclass(frozen=True)
class Rule:
    action: str  # "allow" or "block"
    host: str
    path: str


#: The rules of the query.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else."""
    return F.translate(text, UPPER, LOWER)


def _part(url: Column, pattern: str) -> Column:
    """What the pattern's first group (or, without one, all of it) finds at the start of a url; '' of a null one."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), rf"(?s)\A{pattern}", 1 if "(" in pattern.replace("(?", "") else 0)


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case; '' without ``://``."""
    return lowered(_part(url, r".*?://([^/?#]*)"))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return _part(url, r".*?://[^/?#]*([^?#]*)")


def normal(url: Column) -> Column:
    """The name of the resource: scheme and host in lower case, no fragment; null for what has no host."""
    named = F.concat(lowered(_part(url, r".*?://[^/?#]*")), _part(url, r".*?://[^/?#]*([^#]*)"))
    return F.when(_part(url, r".*?://([^/?#]*)") != "", named)


def node(name: Column) -> Column:
    """128 bits that stand for a normal url."""
    return F.unhex(F.substring(F.sha2(name, 256), 1, 32))


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value in a tag, '' if it has none."""
    pattern = rf"""(?i)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.replace(F.trim(F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])), F.lit("&amp;"), F.lit("&"))


def resolved(target: Column, base: Column) -> Column:
    """A link's target as an absolute url; null for an empty one, a fragment, or another kind of link (mailto: and such)."""
    site, folder = _part(base, r".*?://[^/?#]*"), _part(base, r".*?://[^/?#]*((?:[^?#]*/)?)")
    return (
        F.when(target.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when((target == "") | target.rlike(r"\A(?:#|[A-Za-z][A-Za-z0-9+.-]*:)"), None)
        .when(F.startswith(target, F.lit("//")), F.concat(F.substring_index(base, "://", 1), F.lit(":"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(site, target))
        .when(F.startswith(target, F.lit("?")), F.concat(_part(base, r"[^?#]*"), target))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), target))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target): normal urls of a page and of what its canonical link or its refresh names; no links to itself."""
    text = F.coalesce(F.col(html), F.lit(""))
    tags = lambda name: F.regexp_extract_all(text, F.lit(rf"(?i)<{name}\b[^<>]*>"), 0)
    canonical = F.transform(F.filter(tags("link"), lambda t: attribute(t, "rel").rlike(r"(?i)(?:\A|\s)canonical(?:\s|\z)")), lambda t: attribute(t, "href"))
    refresh = F.filter(tags("meta"), lambda t: lowered(attribute(t, "http-equiv")) == "refresh")
    moved = F.transform(refresh, lambda t: F.regexp_extract(attribute(t, "content"), r"""(?i)\burl\s*=\s*["']?([^"']*)""", 1))
    found = pages.where(text.rlike("(?i)canonical|refresh")).select(F.col(url).alias("base"), F.explode(F.concat(canonical, moved)).alias("to"))
    # Step by step, so that no expression is written out within another.
    aimed = found.select("base", F.trim("to").alias("to")).select("base", resolved(F.col("to"), F.col("base")).alias("aim"))
    return aimed.select(normal(F.col("base")).alias("source"), normal(F.col("aim")).alias("target")).where("source <> target")


def _ranked(rules: Sequence[Rule]) -> list[Rule]:
    """Longest first; of two of one length the one with the longer host, of two alike the one that allows."""
    return sorted(set(rules), key=lambda r: (-len(r.host) - len(r.path), -len(r.host), r.action != "allow", r.host, r.path))


def with_rule(df: DataFrame, rules: Sequence[Rule] | DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    """Add ``rule`` (host and path of the longest that fits, else null) and ``action``.

    Few rules are one expression. A table of rules (action, host, path), of any size, is joined: each different host and path
    looks up its suffixes, as many as the longest rule's host has parts, with its prefixes of the lengths that rules have.
    """
    if not isinstance(rules, DataFrame):
        if len(set(rules)) <= FEW:
            rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
            for r in reversed(_ranked(rules)):
                fits = ((F.col(host) == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path))
                rule, action = F.when(fits, r.host + r.path).otherwise(rule), F.when(fits, r.action).otherwise(action)
            return df.withColumns({"rule": rule, "action": action})
        rules = df.sparkSession.createDataFrame([(r.action, r.host, r.path) for r in rules], "action string, host string, path string")
    known = cut_lineage(rules.select("action", F.col("host").alias("at"), F.col("path").alias("begins")).distinct())
    parts, lengths = known.agg(F.max(F.size(F.split("at", r"\."))), F.collect_set(F.length("begins"))).first()
    own = df.select(F.col(host).alias("h"), F.col(path).alias("p")).distinct()
    if parts is None:
        return df.withColumns({"rule": F.lit(None).cast("string"), "action": F.lit(None).cast("string")})
    ends = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(parts)), lambda k: F.call_function("substring_index", F.col("h"), F.lit("."), -k)))
    starts = F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]), lambda n: n <= F.length("p"))
    looked = own.select("h", "p", F.explode(ends).alias("at"), starts.alias("starts")).select("h", "p", "at", F.explode("starts").alias("n"))
    met = looked.select("h", "p", "at", F.substr(F.col("p"), F.lit(1), F.col("n")).alias("begins")).join(known, ["at", "begins"])
    rank = F.struct(F.length("at") + F.length("begins"), F.length("at"), F.when(F.col("action") == "allow", 1).otherwise(0))
    longest = met.groupBy("h", "p").agg(F.max_by(F.struct(F.concat("at", "begins").alias("rule"), "action"), rank).alias("found"))
    joined = df.join(longest, (F.col(host) == F.col("h")) & (F.col(path) == F.col("p")), "left")
    return joined.withColumns({"rule": F.col("found.rule"), "action": F.col("found.action")}).drop("h", "p", "found")


def blocked_aliases(links: DataFrame, rules: Sequence[Rule] | DataFrame) -> DataFrame:
    """(node) of urls without a rule of their own that are linked to a blocked one, by any number of links either way, and to
    none that a rule allows. ``links``: (source, target), normal urls; ends that no page has count too."""
    edges = cut_lineage(links.where("source <> target").distinct())
    ends = edges.select(F.explode(F.array("source", "target")).alias("name")).distinct()
    named = ends.select(node(F.col("name")).alias("node"), host_of(F.col("name")).alias("host"), path_of(F.col("name")).alias("path"))
    own = cut_lineage(with_rule(named, rules).select("node", "action"))
    rooted = cut_lineage(components(edges.select(node(F.col("source")).alias("u"), node(F.col("target")).alias("v"))))
    member = own.join(rooted.withColumnRenamed("v", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    decided = member.groupBy("root").agg(F.max((F.col("action") == "block").cast("int")).alias("block"), F.max((F.col("action") == "allow").cast("int")).alias("allow"))
    wrong = decided.where((F.coalesce("block", F.lit(0)) == 1) & (F.coalesce("allow", F.lit(0)) == 0)).select("root")
    return cut_lineage(member.where("action is null").join(wrong, "root").select("node"))


def judge(pages: DataFrame, rules: Sequence[Rule] | DataFrame = RULES, url: str = "url", html: str | None = "html", redirects: DataFrame | None = None) -> DataFrame:
    """Add host, path, rule and verdict ("allow" or "block") to each row.

    Links come from the pages' html (``html`` None: from none) and from ``redirects`` (source, target: urls as crawled). A null
    url, and one without ``://``, has an empty host and path, fits no rule, has no aliases and is allowed; null html has no links.
    Repeated rows share a verdict. Columns whose names clash with the new ones are replaced, others pass through; an empty
    table gives no rows.
    """
    new = ("host", "path", "rule", "verdict")
    kept = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c.lower() not in new])
    links = page_links(pages, url, html) if html else None
    if redirects is not None:
        given = redirects.select(normal(F.col("source")).alias("source"), normal(F.col("target")).alias("target"))
        links = given if links is None else links.unionByName(given)
    carried, restored = set_aside(kept, [url])
    judged = with_rule(carried.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))}), rules)
    verdict = F.coalesce("action", F.lit("allow"))
    if links is not None:
        found = blocked_aliases(links, rules).withColumn("alias", F.lit(True))
        judged = judged.withColumn("node", normal(F.col(url))).withColumn("node", node(F.col("node"))).join(found, "node", "left")
        verdict = F.coalesce("action", F.when(F.col("alias"), "block"), F.lit("allow"))
    done = judged.withColumn("verdict", verdict)
    names = [F.col(f"`{n}`").alias(o) for n, o in zip(carried.columns, kept.columns, strict=True)]
    return done.select(*names, *new)


def oracle_sql(rules: Sequence[Rule] = RULES) -> str:
    """The same over ``pages`` in DuckDB SQL, components by a recursive closure."""

    def parts(url: str) -> tuple[str, str, str]:
        rest = f"CASE WHEN contains({url}, '://') THEN substr({url}, strpos({url}, '://') + 3) ELSE '' END"
        host = f"translate(regexp_extract({rest}, '^[^/?#]*'), '{UPPER}', '{LOWER}')"
        return host, f"regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1)", f"regexp_extract({rest}, '^[^/?#]*([^#]*)', 1)"

    def normal_sql(url: str) -> str:
        host, _, rest = parts(url)
        return f"CASE WHEN {host} <> '' THEN translate(string_split({url}, '://')[1], '{UPPER}', '{LOWER}') || '://' || {host} || {rest} END"

    def value(tag: str, name: str) -> str:
        pattern = f"""(?i)\\s{name}\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))"""
        return "replace(trim(" + " || ".join(f"regexp_extract({tag}, '{pattern}', {k})" for k in (1, 2, 3)) + "), '&amp;', '&')"

    def fits(what: str) -> str:
        cases = [f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.host + r.path if what == 'rule' else r.action}'" for r in _ranked(rules)]
        return f"CASE {' '.join(cases)} END AS {what}"

    host, path, _ = parts("url")
    site = "string_split(base, '://')[1] || '://' || regexp_extract(substr(base, strpos(base, '://') + 3), '^[^/?#]*')"
    folder = f"regexp_extract({parts('base')[1]}, '^(.*/)?')"
    to_url = f"""CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN t = '' OR starts_with(t, '#') OR regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
            WHEN starts_with(t, '//') THEN string_split(base, '://')[1] || ':' || t WHEN starts_with(t, '/') THEN {site} || t
            WHEN starts_with(t, '?') THEN regexp_extract(base, '^[^?#]*') || t ELSE {site} || CASE WHEN {folder} = '' THEN '/' ELSE {folder} END || t END"""
    return f"""WITH RECURSIVE p AS (SELECT page_id, url, {host} AS host, {path} AS path, {normal_sql('url')} AS name FROM pages),
        tags AS (SELECT url AS base, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\\b[^<>]*>')) AS tag FROM pages WHERE regexp_matches(html, '(?i)canonical|refresh')),
        aims AS (SELECT base, trim({value('tag', 'href')}) AS t FROM tags WHERE regexp_matches(tag, '(?i)^<link') AND regexp_matches({value('tag', 'rel')}, '(?i)(?:^|\\s)canonical(?:\\s|$)')
            UNION ALL SELECT base, trim(regexp_extract({value('tag', 'content')}, '(?i)\\burl\\s*=\\s*["'']?([^"'']*)', 1)) FROM tags WHERE regexp_matches(tag, '(?i)^<meta') AND lower({value('tag', 'http-equiv')}) = 'refresh'),
        absolute AS (SELECT base, {to_url} AS aim FROM aims),
        edges AS (SELECT DISTINCT {normal_sql('base')} AS a, {normal_sql('aim')} AS b FROM absolute),
        both_ways AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
        reach AS (SELECT a, a AS b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
        ends AS (SELECT name, {fits('action')} FROM (SELECT name, {parts('name')[0]} AS host, {parts('name')[1]} AS path FROM (SELECT DISTINCT a AS name FROM both_ways) x) y),
        inherited AS (SELECT r.a AS name, count(*) FILTER (WHERE action = 'block') > 0 AND count(*) FILTER (WHERE action = 'allow') = 0 AS bad FROM reach r JOIN ends ON r.b = ends.name GROUP BY r.a),
        ruled AS (SELECT *, {fits('rule')}, {fits('action')} FROM p)
        SELECT page_id, host, path, rule, coalesce(action, CASE WHEN bad THEN 'block' END, 'allow') AS verdict FROM ruled LEFT JOIN inherited USING (name)"""
