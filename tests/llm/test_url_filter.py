"""Decisions on addresses against a plain-Python version with a breadth-first search."""

from __future__ import annotations

import re

from tierline.llm.url_filter import RULES, judge, rule_table

SCHEMA = "page_id bigint, url string, html string, host string, address string, verdict int"


def link(target, rel="canonical"):
    return f'<html><head><LINK href="{target}" rel="{rel}"><meta charset="utf-8"></head>'


def refresh(target):
    return f"<meta http-equiv='Refresh' content='0; URL={target}'>"


PAGES = [
    (1, "https://a.example.com/x", link("https://Blocked.net/home")),  # takes the block of its canonical page
    (2, "http://b.example.com/y", refresh("/x2")), (3, "https://b.example.com/x2#part", link("//c.org/de/z")),
    (4, "https://c.org/de/z", refresh("http://d.org/fr/ok")),  # all of this class are allowed by d.org/fr/
    (5, "https://c.org/de/z", "<p>same address"), (6, "http://n.net/b", link("http://c.org/de/z")),  # own rule first
    (7, "https://example.net/en/1", None), (8, "https://www.EXAMPLE.net/en/1", ""), (9, "https://notexample.net/en/1", ""),
    (10, "https://x.example.com/de/1?q=1", ""), (11, "https://x.example.com/de", ""), (12, "http://example.net", ""),
    (13, "http://example.net?a=/en/", link("https://example.net/en/1")), (14, None, link("https://q.net/")), (15, "no address", refresh("/r")),
    (16, "", None), (17, "ftp://net/", ""), (18, "://net/x", ""), (19, "http://a.org/p?a=1&b=2", link("http://t.net/?x=1&amp;y=2")),
    (20, "http://a.org/p", "<link rel='nofollow canonical' href=q.html>"), (21, "http://a.org/q.html", refresh("javascript:go()")),
    (22, "http://a.org/q.html#2", link("#top")), (22, "http://a.org/q.html#2", link("?v")), (None, "http://a.org/q.html?v", link("http://h.net")),
    (23, "http://" + "a." * 20_000 + "net/" + "p" * 50_000, "<link " * 50_000), (24, "http://z.org/", "<meta " + "x=1 " * 50_000 + ">"),
    (25, "http://o.org/1", link("http://hub.org/")), (26, "http://o.org/2", link("http://hub.org/")), (27, "http://hub.org", ""),
    (28, "http://o.org/3", link("alternate.net/", rel="alternate")), (29, "http://net:80/", ""), (30, "http://u@net/é?ü#ß", ""),
]
REDIRECTS = [("http://far.org/1", "https://far.org/2"), ("https://far.org/2", "http://gone.net/"), ("http://m.org/", None), (None, "http://n.org/")]


def parts(url):
    if url is None or "://" not in url:
        return "", "", None
    host, path, query = re.match(r"([^/?#]*)([^?#]*)(\?[^#]*)?", url.split("://", 1)[1], re.S).groups()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    return host, path, host + (path or "/") + (query or "") if host else None


def whole(target, url):
    host, path, _ = parts(url)
    if re.match(r"[A-Za-z][\w+.-]*://", target):
        return target
    if re.match(r"[A-Za-z][\w+.-]*:", target) or not host or target.startswith("#"):
        return None
    scheme = url.split("://")[0]
    if target.startswith("//"):
        return f"{scheme}:{target}"
    begin = {"/": "", "?": path}.get(target[0], (path or "/").rpartition("/")[0] + "/")
    return f"{scheme}://{host}{begin}{target}"


def expected(pages, targets, redirects=(), rules=RULES):
    """``targets`` has the targets of each page, in the order of ``pages``."""
    near, places = {}, {}
    for (_, url, _), to in zip(pages, targets):
        places.setdefault(parts(url)[2], set()).add(parts(url)[:2])
        near.setdefault(parts(url)[2], set()).update(whole(t, url) for t in to)
    for a, b in redirects:
        places.setdefault(parts(a)[2], set()).add(parts(a)[:2])
        near.setdefault(parts(a)[2], set()).add(b)
    graph = {}
    for a, to in near.items():
        for b in to:
            b, at = parts(b)[2], parts(b)[:2]
            places.setdefault(b, set()).add(at)
            if a is not None and b is not None:
                graph.setdefault(a, set()).add(b)
                graph.setdefault(b, set()).add(a)

    def rule(host, path):
        fit = [r for r in rules if host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fit, key=lambda r: (len(r.host + r.path), r.verdict == "allow", r.host + r.path), default=None)

    def reach(start):
        found, todo = {start}, [start]
        while todo:
            todo += [n for n in graph.get(todo.pop(), ()) if n not in found and not found.add(n)]
        return found

    out = []
    for page_id, url, _ in pages:
        host, path, address = parts(url)
        own, alike = rule(host, path), {address}
        if address is not None:
            alike = reach(address)
        others = {r.verdict for a in alike if a is not None for p in places[a] if (r := rule(*p))}
        verdict = own.verdict if own else "allow" if "allow" in others or not others else "block"
        out.append((page_id, host, path, own and own.host + own.path, verdict, address, address and min(alike)))
    return out


TARGETS = {
    1: ["https://Blocked.net/home"], 2: ["/x2"], 3: ["//c.org/de/z"], 4: ["http://d.org/fr/ok"], 6: ["http://c.org/de/z"],
    13: ["https://example.net/en/1"], 14: ["https://q.net/"], 15: ["/r"], 19: ["http://t.net/?x=1&y=2"], 20: ["q.html"],
    21: ["javascript:go()"], 25: ["http://hub.org/"], 26: ["http://hub.org/"], None: ["http://h.net"],
}


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_pages_take_the_decision_of_their_aliases(spark):
    pages = spark.createDataFrame([(*p, "h", "a", 1) for p in PAGES], SCHEMA).repartition(3)
    to = [TARGETS.get(p[0], ["?v"] if p[2] == link("?v") else []) for p in PAGES]
    redirects = spark.createDataFrame(REDIRECTS, "from_url string, to_url string")
    want = expected(PAGES, to, REDIRECTS)
    assert found(judge(pages, redirects=redirects)) == sorted(want, key=repr)
    by_id = {w[0]: w for w in want}
    assert {i: by_id[i][4] for i in (1, 2, 4, 6, 12, 19, 20, 25)} == {
        1: "block", 2: "allow", 4: "allow", 6: "block", 12: "allow", 19: "block", 20: "block", 25: "allow",
    }


def test_a_long_chain_is_one_class(spark):
    rows = [(i, f"http://s{i % 7}.org/{i}", link(f"http://s{(i + 1) % 7}.org/{i + 1}")) for i in range(300)]
    rows += [(300, "http://s6.org/300", link("http://end.net/"))] + [(301 + i, f"http://hot.org/{i}", link("http://s3.org/3")) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r.verdict for r in judge(pages).collect()} == {"block"}


def test_many_rules_of_one_host(spark):
    from tierline.llm.url_filter import Rule

    rules = tuple(Rule(("allow", "block")[i % 2], "h.org", f"/{'a' * (i % 40)}{i}") for i in range(2000)) + (
        Rule("block", "h.org", "/same"), Rule("allow", "h.org", "/same"), Rule("block", "deep.x.h.org", ""),
    )
    rows = [(i, f"http://w.h.org/{'a' * (i % 40)}{i}/x", "") for i in range(0, 2000, 7)]
    rows += [(9000, "http://h.org/same/1", ""), (9001, "http://y.deep.x.h.org", ""), (9002, "http://x.h.org/zz", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert found(judge(pages, rule_table(spark, rules))) == sorted(expected(rows, [[]] * len(rows), rules=rules), key=repr)


def test_no_pages(spark):
    assert judge(spark.createDataFrame([], SCHEMA)).collect() == []
