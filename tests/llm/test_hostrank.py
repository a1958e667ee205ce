import random
import re

import pytest
from pyspark.sql import functions as F

from dqspark.llm.hostrank import DAMPING, RULES, host_edges, judge_urls, spread, url_host
from dqspark.llm.staging import Staged

PAGE = "page_id long, url string, html string, host string, path string, rule string, best int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "p", "r", 1) for r in rows], PAGE)


def parts(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return host.translate({c: c + 32 for c in range(65, 91)}), path


def rule_of(host, path):
    fits = []
    for verdict, rule in RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits, default=(0, None, None))[1:]


def slow_rank(edges, seeds, steps=200):
    total = sum(seeds.values())
    seeds = {h: w / total for h, w in seeds.items()}
    rank = dict(seeds)
    for _ in range(steps):
        new = {}
        for host, r in rank.items():
            out = {d: w for (s, d), w in edges.items() if s == host}
            for d, w in out.items():
                new[d] = new.get(d, 0) + DAMPING * r * w / sum(out.values())
        back = 1 - sum(new.values())
        for h, w in seeds.items():
            new[h] = new.get(h, 0) + back * w
        rank = new
    return rank


URLS = [
    "http://A.Example.COM/en/1?x#y", "https://www.example.com/en/", "https://x.www.example.com/en", "http://example.com/fr/?q",
    "ftp://b.net/es/1", "http://b.net/fr/", "http://b.net/de/", "http://c.org", "http://c.org#f", "no url", "", None, "://", "http://D.org/a://b/",
    "http://notnet/es/", "http://com/", "http://x.com?/", "x://É.org/Ä", "http://m.c.org/1", "http://net/es/", "a\nb://h.org/p\nq",
]


def page_rows():
    rng = random.Random(4)
    hosts = [parts(u)[0] for u in URLS]
    rows = []
    for i, u in enumerate(URLS * 3):
        links = "".join(f'<a HREF = "http{rng.choice(["", "s"])}://{rng.choice(hosts).upper()}/x">' for _ in range(rng.randint(0, 4)))
        rows.append((i, u, rng.choice([links, links + "<img src='//cdn.org/i.png'><a href='/local'>", links])))
    return rows + [(0, URLS[0], None), (None, URLS[6], "")]


def test_urls_and_rules(spark):
    rows = page_rows()
    found = {(r.id, r.host, r.path, r.rule) for r in judge_urls(pages(spark, rows)).collect()}
    assert found == {(i, *parts(u), rule_of(*parts(u))[0]) for i, u, _ in rows}


def test_scores_like_a_slow_walk(spark):
    rows = page_rows()
    known = {parts(u)[0] for _, u, _ in rows}
    edges = {}
    for _, u, html in rows:
        for dst in re.findall(r"(?i)(?:href|src)\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)", html or ""):
            key = (parts(u)[0], dst.translate({c: c + 32 for c in range(65, 91)}))
            edges[key] = edges.get(key, 0) + 1
    for h in known - {""}:
        labels = h.split(".")
        parent = next((".".join(labels[i:]) for i in range(1, len(labels)) if ".".join(labels[i:]) in known), None)
        if parent:
            for key in ((h, parent), (parent, h)):
                edges[key] = edges.get(key, 0) + 1
    edges = {(s, d): w for (s, d), w in edges.items() if s != d and s and d}
    read = pages(spark, rows).select("html", url_host(F.col("url")).alias("host"))
    got = {(r.src, r.dst): r.w for r in host_edges(read).collect()}
    assert got == edges
    seeds = {"allow": {}, "block": {}}
    for _, u, _ in rows:
        host, path = parts(u)
        verdict = rule_of(host, path)[1]
        if verdict and host:
            seeds[verdict][host] = seeds[verdict].get(host, 0) + 1
    trust = slow_rank(edges, seeds["allow"])
    distrust = slow_rank({(d, s): w for (s, d), w in edges.items()}, seeds["block"])
    for r in judge_urls(pages(spark, rows)).collect():
        t, d = trust.get(r.host, 0), distrust.get(r.host, 0)
        assert r.trust == pytest.approx(t, abs=0.02) and r.distrust == pytest.approx(d, abs=0.02)
        assert r.verdict == (rule_of(r.host, r.path)[1] or ("block" if r.distrust > 0.5 * (r.trust + r.distrust) else "allow"))


def test_ranks_sum_to_one_and_converge(spark):
    edges = spark.createDataFrame([("k", "a", "b", 1.0), ("k", "b", "c", 2.0), ("k", "b", "a", 1.0)], "kind string, src string, dst string, w double")
    seeds = spark.createDataFrame([("k", "a", 3.0), ("k", "d", 1.0), ("k", "e", 0.0)], "kind string, host string, weight double")
    found = {r.host: r.score for r in spread(edges, seeds, Staged(spark, "t")).collect()}
    assert sum(found.values()) == pytest.approx(1) and "e" not in found
    expected = slow_rank({("a", "b"): 1, ("b", "c"): 2, ("b", "a"): 1}, {"a": 3, "d": 1})
    assert found == pytest.approx(expected, abs=0.01)


@pytest.mark.parametrize("length", [40, 200])
def test_chain_of_hosts_to_a_blocked_seed(spark, length):
    urls = [f"http://h{i}.org/" for i in range(length)] + ["http://b.net/es/1"]
    rows = [(i, u, f"<a href='{after}'>") for i, (u, after) in enumerate(zip(urls, urls[1:] + [""]))]
    found = {r.id: r for r in judge_urls(pages(spark, rows + [(-1, "http://far.org/", "")])).collect()}
    assert found.pop(-1).verdict == "allow"
    every = sum(DAMPING**n for n in range(length + 1))
    for i, r in found.items():
        assert r.verdict == "block" and r.trust == 0
        assert r.distrust == pytest.approx(DAMPING ** (length - i) / every, rel=1e-6)


def test_slowly_mixing_graph_converges(spark):
    edges = {("a", "b"): 1, ("b", "a"): 1, ("b", "c"): 1, ("c", "b"): 1, ("c", "d"): 1, ("d", "c"): 3}
    listed = spark.createDataFrame([("k", s, d, float(w)) for (s, d), w in edges.items()], "kind string, src string, dst string, w double")
    seeds = spark.createDataFrame([("k", "a", 1.0)], "kind string, host string, weight double")
    found = {r.host: r.score for r in spread(listed, seeds, Staged(spark, "t")).collect()}
    assert found == pytest.approx(slow_rank(edges, {"a": 1}, 400), rel=1e-7)


def test_scores_beyond_doubles_stay_above_zero(spark):
    edges = spark.createDataFrame([("k", "a", "b", 1e-200), ("k", "a", "z", 1e200), ("k", "b", "c", 1.0)], "kind string, src string, dst string, w double")
    seeds = spark.createDataFrame([("k", "a", 1.0)], "kind string, host string, weight double")
    assert {r.host for r in spread(edges, seeds, Staged(spark, "t")).where("score > 0").collect()} == set("abcz")


def test_no_rows_and_no_seeds(spark):
    none = pages(spark, [(1, "http://c.org/", "")])
    assert [r.verdict for r in judge_urls(none).collect()] == ["allow"]
    assert judge_urls(none.where("false")).count() == 0
