import random
import re
from urllib.parse import urljoin

import duckdb
import pytest

from landfall.llm import url_filter as U
from landfall.llm.registry import ORACLE_SQL
from tests.llm import samples


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def parts(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    return (lower(m[1]), m[2]) if m else ("", "")


def rule_of(url, rules=U.RULES):
    host, path = parts(url)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: (len(r.name), len(r.host)), default=None)


def node(url):
    m = re.match(r"\s*([^:/?#]+://[^/?#]*)([^#]*)", url or "")
    return lower(m[1]) + m[2].rstrip() if m else None


def expected(pages, links, rules=U.RULES):
    """links: (url, target) as the pages mean them."""
    near = {}
    for a, b in links:
        a, b = node(a), node(b)
        if a and b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    bad = {u for u in near if (r := rule_of(u, rules)) and not r.allow}
    todo = list(bad)
    while todo:
        for u in near[todo.pop()] - bad:
            bad.add(u)
            todo.append(u)
    out = []
    for page_id, url, _ in pages:
        r = rule_of(url, rules)
        verdict = ("allow" if r.allow else "block") if r else "block" if node(url) in bad else "allow"
        out.append((page_id, *parts(url), r and r.name, verdict))
    return samples.plain(out)


def judge(spark, pages, **more):
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    clashing = df.selectExpr("*", "'x' as host", "'y' as path", "1 as rule", "2 as ruled", "3 as root", "4 as address", "5 as aliased", "6 as node")
    return samples.plain(U.judge_urls(clashing, **more).collect())


def canonical(target):
    return f'<html><head><link rel="canonical" href="{target}"></head>'


def redirect(target):
    return f'<meta http-equiv="refresh" content="0; url={target}">'


PLAIN = [
    (1, "http://a.example.com/en/x", "<p>"), (2, "http://www.Example.com/en/x", ""), (3, "https://b.www.example.com/en/", None),
    (4, "http://example.com/EN/x", "<p>"), (5, "http://site.net/es/1", "<p>"), (6, "http://site.net/de/1", "<p>"), (7, "http://net/fr/", "<p>"),
    (8, "http://example.com", "<p>"), (9, "http://example.com?x=/en/", "<p>"), (10, "http://example.com/#/en/", "<p>"),
    (11, None, "<p>"), (12, "", "<p>"), (13, "no address", "<p>"), (14, "http://", "<p>"), (15, "x?y://site.net/fr/z?a", "<p>"),
    (16, "http://example.com:80/en/x", "<p>"), (17, "http://user@EXAMPLE.COM/en/é", "<p>"), (18, "http://notexample.com/en/", "<p>"),
    (19, "http://ex.org/", None), (19, "http://ex.org/", None), (None, "http://ÉX.net/fr/x", "<p>"), (20, "HTTP://SITE.NET/es/1", "y" * 300_000),
    (21, "http://a.com/en/\nx", "<p>"), (22, "http://com/x", "<!--" + "<link" * 50_000),
]


def test_rules_on_plain_pages(spark):
    assert judge(spark, PLAIN) == expected(PLAIN, [])


def test_blocks_reach_aliases_and_allows_stay(spark):
    pages = [
        # a chain of redirects and canonical links, over an address that is no page, to a blocked one
        (1, "http://a.org/1", canonical("http://b.org/2")), (2, "http://B.org/2#top", redirect("http://c.org/none")),
        (3, "http://d.org/3", canonical("http://c.org/none")), (4, "http://d.org/3", None), (5, "http://d.org/4", "<p>"),
        (6, "http://c.org/none#x", redirect("http://s.net/es/9")),
        # an explicit allow stays, though its aliases are blocked, and does not free them
        (7, "http://www.example.com/en/7", canonical("http://e.org/7")), (8, "http://e.org/7", redirect("http://t.net/fr/1")),
        (9, "http://x.com/9", canonical("http://e.org/7")),
        # allowed aliases only
        (10, "http://f.org/10", canonical("http://x.com/10")), (11, "http://f.org/11", canonical("http://f.org/11")),
        # relative targets, entities, other spellings, several tags
        (12, "http://s.net/de/1", "<LINK href='../es/z?a=1&amp;b=2' REL=\"x Canonical\">"), (13, "http://g.org/13", '<meta content="5;URL=\'http://s.net/es/z?a=1&b=2\'" http-equiv=Refresh>'),
        (14, "http://h.org/14", "<link rel=canonical href=//i.org/14>" + redirect("/15")), (15, "http://i.org/14", "<p>"), (16, "http://h.org/15", canonical("http://u.net/fr/")),
        # not links: comments, scripts, other relations, no target, no address
        (17, "http://j.org/17", "<!-- " + canonical("http://s.net/es/9") + " -->"), (18, "http://j.org/18", "<script>'" + canonical("http://s.net/es/9") + "'</script >"),
        (19, "http://j.org/19", '<link rel="next" href="http://s.net/es/canonical">'), (20, "http://j.org/20", '<link rel="canonical">' + canonical("http://[bad/es/")),
        (21, "http://j.org/21", canonical("mailto:x")), (22, None, canonical("http://s.net/es/9")), (23, "http://j.org/23", "<!-- open " + canonical("http://s.net/es/9")),
        (24, "http://j.org/24", redirect("http://s.net/es/9")[:-1]),
    ]
    links = [(u, t) for (_, u, _), t in zip(pages, [
        "http://b.org/2", "http://c.org/none", "http://c.org/none", None, None, "http://s.net/es/9", "http://e.org/7", "http://t.net/fr/1", "http://e.org/7",
        "http://x.com/10", None, "http://s.net/es/z?a=1&b=2", "http://s.net/es/z?a=1&b=2", "http://i.org/14", None, "http://u.net/fr/"]) if t]
    links.append(("http://h.org/14", "http://h.org/15"))
    found = judge(spark, pages)
    assert found == expected(pages, links)
    verdicts = {r[0]: r[4] for r in found}
    assert [verdicts[i] for i in (1, 2, 3, 4, 6, 8, 12, 13, 14, 15, 16)] == ["block"] * 11
    assert [verdicts[i] for i in (5, 7, 9, 10, 11, *range(17, 25))] == ["allow"] * 13


def test_random_links_against_brute_force_and_sql(spark):
    rng = random.Random(6)
    hosts = ["a.org", "www.example.com", "s.net", "b.example.com", "c.io"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'de'])}/{i}" for i in range(300)]
    hub = urls[0]  # a third of all pages name one address
    pages, links = [], []
    for i, u in enumerate(urls * 2):
        target = hub if i % 3 == 0 else rng.choice(urls)
        html = rng.choice([None, "<p>", canonical(target), redirect(target)])
        if html and target in html:
            links.append((u, target))
        pages.append((i, u, html))
    wanted = expected(pages, links)
    assert judge(spark, pages) == wanted
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages + [p for p in PLAIN if p[0] not in (21, 22)])
    rows = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({ORACLE_SQL['op11_url_filter']})").fetchall()
    assert samples.plain(rows) == expected(pages + [p for p in PLAIN if p[0] not in (21, 22)], links)


def test_many_rules_in_a_table(spark, monkeypatch):
    rng = random.Random(3)
    rules = tuple({(r.host, r.path): r for r in (
        U.Rule(rng.choice(["com", "example.com", "a.example.com", "net", "b.net", "org"]), "/" + "".join(rng.choices("ab/", k=rng.randint(0, 3))), rng.random() < 0.5)
        for _ in range(60))}.values())
    pages = [(i, f"http://{rng.choice(['x.', ''])}{rng.choice(['a.example.com', 'example.com', 'b.net', 'net', 'c.org', 'io'])}/{''.join(rng.choices('ab/', k=4))}", None) for i in range(400)]
    pages += [(None, None, None), (500, "", None)]
    # Rules of equal length and host length cannot both fit, so the winner is unique.
    wanted = expected(pages, [], rules)
    assert judge(spark, pages, rules=rules) == wanted
    monkeypatch.setattr(U, "INLINE_RULES", 5)
    assert judge(spark, pages, rules=rules) == wanted


def test_links_seen_elsewhere(spark):
    pages = [(1, "http://a.org/1", None), (2, "http://a.org/2", None)]
    links = spark.createDataFrame([("http://a.org/1", "http://s.net/es/1"), (None, "http://a.org/2")], "url string, target string")
    assert [r[4] for r in judge(spark, pages, links=links)] == ["block", "allow"]


def test_empty(spark):
    assert judge(spark, []) == []


@pytest.mark.parametrize("base, target", [("http://a.org/x/y", "../z"), ("http://a.org/x/y", "?q"), ("http://a.org", "b")])
def test_relative_targets(base, target):
    assert U._target(f'<link rel=canonical href="{target}">', base) == urljoin(base, target)
