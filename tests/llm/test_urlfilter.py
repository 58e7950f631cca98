from __future__ import annotations

import itertools
import math

from brindle.llm import urlfilter as u
from brindle.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string"


def rules(spark):
    return spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, verdict string")


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    stop = min([i for i in (rest.find(c, end) for c in "?#") if i >= 0], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:stop]


def rule(host, path):
    fit = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, default=(0, None, None))[1:]


URLS = [
    None, "", "nothing", "http://", "HTTP://WWW.Example.COM/en/1?x=/#y", "http://a.example.com/en/2", "http://www.example.com/de/", "http://example.com", "http://notexample.com/en/",
    "http://x.net/es/1", "http://x.net/es", "http://net/fr/", "ftp://a://b/c", "http://cheappills.org/buy/now", "http://user@h.org:80/p?q", "http://x.org#f/en/", "http://" + "a" * 90 + ".org/", "http://é.org/ü",
]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, x, None) for i, x in enumerate(URLS)] + [(4, URLS[4], "<p>again</p>"), (None, None, None)], PAGES)
    out = u.judge(df, rules(spark)).collect()
    assert len(out) == len(URLS) + 2
    for r in out:
        host, path = parts(URLS[r.page_id] if r.page_id is not None else None)
        assert (r.host, r.path) == (host, path)
        found, verdict = rule(host, path)
        assert r.rule == found and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


def test_best_cut_by_brute_force():
    words = {"cheap": 50, "pills": 30, "heap": 5, "pill": 20, "ch": 2, "she": 9, "ap": 3, "spill": 4}
    total = sum(words.values())
    unknown = -math.log(total) - math.log(10)
    for label in ("cheappills", "cheapspill", "xcheapq", "pillspills", "zz"):
        edges = {(a, z): math.log(words[label[a:z]] / total) for a, z in itertools.combinations(range(len(label) + 1), 2) if label[a:z] in words}
        best = -math.inf
        for cuts in itertools.product([0, 1], repeat=len(label) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(label)]
            score = sum(edges[a, z] if (a, z) in edges else unknown if z - a == 1 else -math.inf for a, z in itertools.pairwise(at))
            best = max(best, score)
        got = u.best_cut(label, edges, unknown)
        assert "".join(got) == label
        assert abs(sum(math.log(words[w] / total) if w in words else unknown * len(w) for w in got) - best) < 1e-9
    assert u.best_cut("cheappills", {(0, 5): -1.0, (5, 10): -1.5}, unknown) == ["cheap", "pills"]


def test_segmentation_and_bayes(spark):
    html = "<p>cheap pills spam farm good news daily paper</p>" * 5
    rows = [(i, f"http://{'cheappills' if i % 2 else 'goodnews'}{i}.{'net/es' if i % 2 else 'com'}/{'deal' if i % 2 else 'story'}/{i}", html) for i in range(40)]
    rows += [(100, "http://cheappills.org/deal/1", None), (101, "http://goodnews.org/story/1", None)]
    out = {r.page_id: r for r in u.judge(spark.createDataFrame(rows, PAGES), rules(spark)).collect()}
    assert out[1].rule == "net/es/" and out[0].rule == "com/"
    assert (out[100].verdict, out[101].verdict) == ("block", "allow")
    words = u.lexicon(spark.createDataFrame(rows, PAGES))
    cut = {r.label: r.words for r in u.segment(spark.createDataFrame([("cheappills",), ("x-1",), ("ab12",), ("z",)], "label string"), words).collect()}
    assert cut == {"cheappills": ["cheap", "pills"], "x-1": ["x-1"], "ab12": ["ab12"], "z": ["z"]}


def test_empty_tables(spark):
    none = spark.createDataFrame([], PAGES)
    assert u.judge(none, rules(spark)).count() == 0
    some = spark.createDataFrame([(1, "http://a.org/x", "<p>text</p>")], PAGES)
    assert u.judge(some, rules(spark).limit(0)).first().verdict == "allow"
