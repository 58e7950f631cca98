from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import functions as F

from brindle.llm import urlfilter as u
from brindle.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string"


def test_labels_with_digits_and_other_letters_are_segmented(spark):
    html = "<p>cheap pills good news дешево лекарство хороший журнал</p>" * 5
    bad, good = ("cheappills", "дешеволекарство"), ("goodnews", "хорошийжурнал")
    rows = [(i, f"http://{(bad if i % 2 else good)[i // 2 % 2]}{i}.{'net' if i % 2 else 'com'}/es/x", html) for i in range(40)]
    rows += [(100, "http://cheappills777.org/es/x", None), (101, "http://777goodnews.org/es/x", None), (102, "http://дешеволекарство.org/es/x", None), (103, "http://9Хорошийжурнал9.org/es/x", None)]
    pages = spark.createDataFrame(rows, PAGES)
    out = {r.page_id: r for r in u.judge(pages, spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, verdict string")).collect()}
    assert out[1].rule == "net/es/" and out[0].rule == "com/"
    assert [out[i].verdict for i in (100, 101, 102, 103)] == ["block", "allow", "block", "allow"]
    labels = spark.createDataFrame([("дешеволекарство",)], "label string")
    assert u.segment(labels, u.lexicon(pages)).first().words == ["дешево", "лекарство"]


def test_long_labels_and_words(spark):
    word = "z" * 30 + "antidisestablishmentarianism" * 3
    pages = spark.createDataFrame([(1, None, f"<p>{word} cheap pills</p>" * 3)], PAGES)
    label = word + "cheap" + word + "pills" * 20
    cut = u.segment(spark.createDataFrame([(label,)], "label string"), u.lexicon(pages)).first().words
    assert cut == [word, "cheap", word, *["pills"] * 20]


def test_scores_by_brute_force(spark):
    urls = [("a.x", "/p/q"), ("b.x", "/q/q"), ("c.x", "/r"), ("d.x", "")]
    seen = [("a.x", "/p/q", "p"), ("a.x", "/p/q", "q"), ("b.x", "/q/q", "q"), ("b.x", "/q/q", "q"), ("c.x", "/r", "q"), ("c.x", "/r", "new")]
    classes = [("a.x", "/p/q", "block", 3), ("b.x", "/q/q", "allow", 2)]
    tokens = spark.createDataFrame(seen, "host string, path string, token string")
    weights, prior = u.bayes_weights(tokens, spark.createDataFrame(classes, "host string, path string, ruled string, n long"))
    counts = {v: Counter() for v in ("block", "allow")}
    for host, path, verdict, n in classes:
        for h, p, t in seen:
            if (h, p) == (host, path):
                counts[verdict][t] += n
    words = set(counts["block"]) | set(counts["allow"])
    odds = {t: math.log((counts["block"][t] + 1) / (counts["block"].total() + len(words))) - math.log((counts["allow"][t] + 1) / (counts["allow"].total() + len(words))) for t in words}
    want = {(h, p): round(sum(odds.get(t, 0) for x, y, t in seen if (x, y) == (h, p)) + math.log(4 / 3), 6) for h, p in urls}
    got = u.bayes_scores(spark.createDataFrame(urls, "host string, path string"), tokens, weights, prior)
    assert {(r.host, r.path): round(r.score, 6) for r in got.collect()} == want


def test_language_parts_and_last_labels_are_no_features(spark):
    urls = spark.createDataFrame([("www.casino-win.example.org", "/de/571/offer"), ("localhost", "/en"), ("", "")], "host string, path string")
    named = spark.createDataFrame([("www",), ("example",)], "word string")
    words = u.lexicon(spark.createDataFrame([(1, None, "casino win")], PAGES))
    got = {(r.host, r.token) for r in u.tokens(urls, words, named, 1).collect()}
    assert got == {("www.casino-win.example.org", t) for t in ("host:casino", "host:win", "path:#", "path:offer")}


def test_held_out_hosts(spark):
    """Hosts of two kinds of words, judged by the words of other hosts of their kind."""
    kinds = {"net/es": ["cheap", "pills", "casino", "bets"], "com": ["daily", "news", "garden", "school"]}
    html = "<p>" + " ".join(w for ws in kinds.values() for w in ws) + "</p>"
    rows = []
    for tail, ws in kinds.items():
        for i, a in enumerate(ws):
            for b in ws[:i]:
                rows += [(len(rows), f"http://{a}{b}.{tail}/x/{len(rows)}", html), (1000 + len(rows), f"http://{b}{a}{i}.org/xx/1", None)]
    out = u.judge(spark.createDataFrame(rows, PAGES), spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, verdict string"))
    held = out.where(F.col("rule").isNull()).collect()
    bad = set(kinds["net/es"])
    assert len(held) == 12 and all((r.verdict == "block") == any(w in r.host for w in bad) for r in held)


def test_odds_before_words_are_read(spark):
    """Two blocked hosts for each allowed one say nothing of pages whose words are new; their odds do."""
    rules = spark.createDataFrame([("bad", "/", "block"), ("good", "/", "allow")], "rule_host string, rule_path string, verdict string")
    urls = [f"http://alpha{i}.bad/x" for i in range(20)] + [f"http://beta{i}.good/x" for i in range(10)] + ["http://gamma.open/y", "no url"]
    pages = spark.createDataFrame([(i, x, "") for i, x in enumerate(urls)], "page_id long, url string, html string")
    for odds, verdict in ((1.0, "allow"), (None, "block"), (3.0, "block"), (0.5, "allow")):
        got = {r.page_id: r.verdict for r in u.judge(pages, rules, odds=odds).collect()}
        assert (got[30], got[31]) == (verdict, verdict)
