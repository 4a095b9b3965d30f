"""Rules, links and what aliases inherit, against plain Python; the SQL twin on pages that do have links."""

from __future__ import annotations

import random
from urllib.parse import urlsplit

import duckdb
import pytest
from pyspark.sql import functions as F

from weftline.llm import url_filter as uf
from weftline.llm.queries import op12_url_filter
from weftline.llm.url_filter import RULES, Rule


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest[: min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))]
    path = rest[len(host) :]
    path = path[: min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def ruled(url, rules):
    host, path = split(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.host + r.path), len(r.host), r.action == "allow"), default=None)


def name(url):
    if not split(url)[0]:
        return None
    rest = url.split("://", 1)[1]
    rest = rest[min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest)) :].split("#")[0]
    return url.split("://", 1)[0].lower() + "://" + split(url)[0] + rest


def verdicts(urls, links, rules):
    """{url: verdict} by walking the links both ways."""
    near: dict = {}
    for a, b in links:
        if name(a) and name(b) and name(a) != name(b):
            near.setdefault(name(a), set()).add(name(b))
            near.setdefault(name(b), set()).add(name(a))
    out = {}
    for url in urls:
        own = ruled(url, rules)
        seen, todo = {name(url)}, [name(url)]
        while todo:
            for n in near.get(todo.pop(), set()) - seen:
                seen.add(n)
                todo.append(n)
        actions = {r.action for n in seen if n and (r := ruled(n, rules))}
        out[url] = own.action if own else "block" if actions == {"block"} else "allow"
    return out


def page(url, target=None, kind="canonical"):
    if target is None:
        return "<html><p>canonical refresh</p></html>"
    if kind == "canonical":
        return f"<html><head><LINK href='{target}'  rel=\"alternate Canonical\"></head><link rel=stylesheet href=/x.css>"
    return f'<meta charset="utf-8"><meta http-equiv=Refresh content="0; URL={target}"><p>'


@pytest.fixture(scope="module")
def linked():
    """(urls, links, htmls): chains, a hub with many aliases, cycles, relative targets, links out of the table."""
    rng = random.Random(7)
    urls = [f"{rng.choice(['http', 'https', 'HTTP'])}://{rng.choice(['a', 'B', 'c.d', ''])}{rng.choice(['.example.net', '.Example.com', '.example.org', '.site.info'])}{rng.choice(['/en/', '/de/', '/fr/', '/', ''])}{i}{rng.choice(['', '#top', '?q=1#x'])}" for i in range(160)]
    urls = [u.replace("://.", "://") for u in urls]
    urls += [f"http://chain{i}.info/p" for i in range(40)] + [f"http://spoke.info/{i}" for i in range(60)] + ["no url", None, "", "://", "http://", "HTTP://UPPER.NET", "http://É.NET/", "x://a?b/c", "http://hub.net/", "http://www.hub.net/"]
    links = [(f"http://chain{i}.info/p", f"http://chain{i + 1}.info/p") for i in range(39)] + [("http://chain39.info/p", "http://bad.net/x")]
    links += [(f"http://spoke.info/{i}", "http://hub.net/") for i in range(60)]
    links += [(u, rng.choice([v for v in urls[:160] if v])) for u in rng.sample(urls[:160], 70)]
    return urls, links


def rows(urls, links):
    of = dict(links)
    out = [(i, u, page(u, of.get(u), "canonical" if i % 2 else "refresh"), f"r{i}") for i, u in enumerate(urls)]
    return out + [out[3], (None, urls[5], None, None), (None, None, None, None)]


def test_links_and_verdicts(spark, linked):
    urls, links = linked
    pages = spark.createDataFrame(rows(urls, links), "page_id long, url string, html string, node string").withColumn("rule", F.lit("old"))
    want = verdicts(urls, links, RULES)
    judged = uf.judge(pages)
    assert judged.columns == ["page_id", "url", "html", "node", "host", "path", "rule", "verdict"]
    got = judged.collect()
    assert len(got) == len(urls) + 3
    for r in got:
        rule = ruled(r.url, RULES)
        assert (r.host, r.path, r["rule"], r.verdict) == (*split(r.url), rule and rule.host + rule.path, want[r.url]), r.url
        assert r.page_id is None or r.node == f"r{r.page_id}"
    assert {want[f"http://chain{i}.info/p"] for i in range(40)} == {"block"} == {want[f"http://spoke.info/{i}"] for i in range(60)}
    other = uf.judge(pages.drop("html"), html=None, redirects=spark.createDataFrame(links, "source string, target string"))
    assert {(r.url, r.verdict) for r in other.collect()} == {(u, v) for u, v in want.items()}
    assert uf.judge(pages.limit(0)).count() == 0
    db = duckdb.connect()
    frame = pages.select("page_id", "url", "html").toArrow()  # noqa: F841
    db.sql("CREATE VIEW pages AS SELECT * FROM frame")
    twin = db.sql(uf.oracle_sql()).fetchall()
    assert sorted(map(repr, twin)) == sorted(repr((r.page_id, r.host, r.path, r["rule"], r.verdict)) for r in got)


def test_an_allowed_alias_frees_those_without_a_rule(spark):
    urls = ["http://x.info/a", "http://x.info/b", "http://bad.net/", "http://www.example.net/en/1"]
    links = [(urls[0], urls[2]), (urls[1], urls[0]), (urls[1], urls[3])]
    for used, want in ((links[:2], "block"), (links, "allow")):
        got = uf.judge(spark.createDataFrame([(u,) for u in urls], "url string"), html=None, redirects=spark.createDataFrame(used, "source string, target string"))
        assert {r.url: r.verdict for r in got.collect()} == {urls[0]: want, urls[1]: want, urls[2]: "block", urls[3]: "allow"}


def test_a_table_of_rules_decides_as_the_expression(spark, linked):
    rng = random.Random(9)
    hosts = ["net", "example.net", "a.example.net", "d.example.com", "info", "chain3.info", "org", "example.org", ".", "c"]
    rules = {Rule(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(["", "/", "/en/", "/de", "/d", "/fr/1", "/p"])) for _ in range(60)}
    assert len(rules) > uf.FEW
    urls, links = linked
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    redirects = spark.createDataFrame(links, "source string, target string")
    want = verdicts(urls, links, rules)
    table = spark.createDataFrame([(r.action, r.host, r.path) for r in rules], "action string, host string, path string")
    for given in (list(rules), table):
        for r in uf.judge(pages, given, html=None, redirects=redirects).collect():
            rule = ruled(r.url, rules)
            assert (r["rule"], r.verdict) == (rule and rule.host + rule.path, want[r.url]), r.url
    assert {r.verdict for r in uf.judge(pages, table.limit(0), html=None).collect()} == {"allow"}


def test_resolved_as_a_browser_does(spark):
    base = "https://Host.com/a/b.html?x=1#f"
    cases = {"http://o.net/p": "http://o.net/p", "//o.net/p": "https://o.net/p", "/p": "https://Host.com/p", "?y=2": "https://Host.com/a/b.html?y=2", "c.html": "https://Host.com/a/c.html", "#top": None, "": None, "mailto:a@b": None}
    df = spark.createDataFrame([(t, base) for t in cases] + [("c", "http://h"), ("c", "http://h?q/r")], "t string, base string")
    got = [r.u for r in df.select(uf.resolved(F.col("t"), F.col("base")).alias("u")).collect()]
    assert got == [*cases.values(), "http://h/c", "http://h/c"]
    assert urlsplit(got[4]).path == "/a/c.html"


def test_query(spark, sf):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    want = verdicts(urls.values(), [], RULES)
    got = op12_url_filter(spark, sf).collect()
    assert {r.page_id: r.verdict for r in got} == {i: want[u] for i, u in urls.items()} and len(got) == len(urls)
    assert {r.verdict for r in got} == {"allow", "block"}
