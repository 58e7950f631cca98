"""URL filters: rules first, then naive Bayes over segmented host and path words.

Rules name a host and a path prefix; the longest that fits decides. For the other urls, host labels are cut into words
by a unigram Viterbi search over a lexicon of the pages' own text, and a multinomial naive Bayes model, trained on the
urls that the rules decide, scores the words of host and path.

What a rule is written in says which rule fits, not what a site is like: words that rules name, a host's last label and
as many first parts of a path as the longest rule path has (where the page's language stands) are no features.

The lexicon and the model stay tables. A label's possible words meet the lexicon in a join and only the label's own
lattice is gathered for the search; words meet their weights in another. Work is on distinct urls and labels. Tables that
grow with the pages always meet by sort and merge, whatever the size of their files, so that a hot host is split.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import staged

#: Words of one character are no words of the lexicon.
SHORTEST_WORD = 2
LETTERS = r"[\p{L}\p{M}]+"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without it."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (distinct ``host``, ``path``) with ``rule`` and ``ruled``, null where none fits.

    ``rules``: ``rule_host``, ``rule_path``, ``verdict``. A rule fits its host and all subdomains if the path starts
    with its own; of those that fit the longest wins, and of equally long ones the last by code point.
    """
    labels = F.split("host", r"\.", -1)
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    tried = urls.select("host", "path", F.explode(tails).alias("rule_host")).join(rules, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    best = tried.groupBy("host", "path").agg(F.max(F.struct(F.length(rule).alias("size"), rule.alias("rule"), "verdict")).alias("best"))
    return urls.join(best.hint("merge"), ["host", "path"], "left").select(*urls.columns, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("ruled"))


def lexicon(html: DataFrame, column: str = "html") -> DataFrame:
    """``word``, ``count`` over the words (letters of any script) in all pages' text, tags left out."""
    text = F.lower(F.regexp_replace(F.coalesce(F.col(column), F.lit("")), "<[^>]*>", " "))
    words = html.select(F.explode(F.split(text, r"[^\p{L}\p{M}]+")).alias("word"))
    return words.where(F.length("word") >= SHORTEST_WORD).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def best_cut(label: str, edges: dict[tuple[int, int], float], unknown: float) -> list[str]:
    """The most likely words of a label: known words by their log probabilities, any character alone at ``unknown``."""
    score, back = [0.0] + [-math.inf] * len(label), [0] * (len(label) + 1)
    ends: dict[int, list[tuple[int, float]]] = {}
    for (a, z), p in edges.items():
        ends.setdefault(z, []).append((a, p))
    for z in range(1, len(label) + 1):
        for a, p in [(z - 1, unknown), *sorted(ends.get(z, []))]:
            if score[a] + p > score[z]:
                score[z], back[z] = score[a] + p, a
    out, z, loose = [], len(label), ""
    while z:
        a = back[z]
        if z - a == 1:
            loose = label[a:z] + loose  # characters that no word covers stay together
        else:
            out += [loose] if loose else []
            out.append(label[a:z])
            loose = ""
        z = a
    return ([*out, loose] if loose else out)[::-1]


def _segment(unknown: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").to_pylist()
            words = [best_cut(s, {(e["a"], e["z"]): e["p"] for e in es or []}, unknown) for s, es in zip(labels, batch.column("edges").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(words, pa.list_(pa.string()))], names=["label", "words"])

    return run


def segment(labels: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``label``, ``words`` for every distinct ``label``; runs of letters are cut by Viterbi, all else stays whole.

    Only those stretches of a label are looked up that are as long as some word with the same first characters.
    """
    total = lexicon.agg(F.sum("count")).first()[0] or 1
    distinct = staged(labels.select("label").where(F.col("label") != "").distinct(), "labels")
    fit = F.col("label").rlike(f"^{LETTERS}$")
    head = lambda c, a: F.substring(c, a, F.lit(SHORTEST_WORD))
    sizes = lexicon.groupBy(head("word", F.lit(1)).alias("head")).agg(F.collect_set(F.length("word")).alias("sizes"))
    start = F.explode(F.sequence(F.lit(0), F.length("label") - SHORTEST_WORD)).alias("a")
    starts = distinct.where(fit & (F.length("label") >= SHORTEST_WORD)).select("label", start).withColumn("head", head("label", F.col("a") + 1))
    ends = starts.join(sizes.hint("merge"), "head").select("label", "a", F.explode(F.transform("sizes", lambda n: F.col("a") + n)).alias("z")).where(F.col("z") <= F.length("label"))
    lattice = ends.withColumn("word", F.substring("label", F.col("a") + 1, F.col("z") - F.col("a")))
    known = lattice.join(lexicon.hint("merge"), "word").select("label", F.struct("a", "z", F.log(F.col("count") / float(total)).alias("p")).alias("edge"))
    edges = known.groupBy("label").agg(F.collect_list("edge").alias("edges"))
    # A character that no word covers costs more than any word.
    cut = distinct.where(fit).join(edges.hint("merge"), "label", "left").mapInArrow(_segment(-math.log(total) - math.log(10.0)), "label string, words array<string>")
    return cut.union(distinct.where(~fit).select("label", F.array("label")))


def tokens(urls: DataFrame, lexicon: DataFrame, structure: DataFrame, depth: int = 0) -> DataFrame:
    """``host``, ``path``, ``token`` for every word of distinct urls; labels are cut into runs of
    letters and of digits first, numbers are one token, words in ``structure`` none.

    ``structure`` (``word``) holds those that rules name; the host's last label and the first ``depth`` parts of the
    path are left out too.
    """
    labels = F.filter(F.split(F.lower(F.regexp_replace("host", r"\.?[^.]*$", "")), r"[.\-_:@]+", -1), lambda s: s != "")
    runs = F.flatten(F.transform(labels, lambda s: F.regexp_extract_all(s, F.lit(rf"{LETTERS}|\p{{N}}+|[^\p{{L}}\p{{M}}\p{{N}}]+"), 0)))
    parts = F.transform(runs, lambda s: F.when(s.rlike(r"^\p{N}+$"), "#").otherwise(s))
    labels = urls.select("host", F.explode(parts).alias("label")).distinct()
    words = labels.join(segment(labels, lexicon).hint("merge"), "label").select("host", F.explode("words").alias("token"))
    of_host = staged(words.groupBy("host").agg(F.collect_list(F.concat(F.lit("host:"), "token")).alias("host_tokens")), "host-tokens")  # a scan of its own: the join can split a hot host
    deep = F.regexp_replace(F.lower("path"), f"^(/[^/]*){{0,{depth}}}", "")
    of_path = F.transform(F.filter(F.split(deep, r"[^\p{L}\p{N}]+", -1), lambda s: s != ""), lambda s: F.concat(F.lit("path:"), F.when(s.rlike(r"^\d+$"), "#").otherwise(s)))
    both = urls.join(of_host.hint("merge"), "host", "left").select("host", "path", F.explode(F.concat(F.coalesce("host_tokens", F.array()), of_path)).alias("token"))
    named = structure.select(F.explode(F.array(F.concat(F.lit("host:"), "word"), F.concat(F.lit("path:"), "word"))).alias("token"))
    return both.join(named, "token", "left_anti")


def bayes_weights(tokens: DataFrame, classes: DataFrame) -> tuple[DataFrame, float]:
    """Log odds of block against allow: ``token``, ``weight``; the prior's.

    ``classes``: ``host``, ``path``, ``ruled``, ``n`` (pages). Counts get one added.
    """
    is_block = F.col("ruled") == "block"
    prior = classes.agg(F.sum(F.when(is_block, F.col("n"))), F.sum(F.when(~is_block, F.col("n")))).first()
    blocked, allowed = (float(x or 0) for x in prior)
    counts = tokens.join(classes.hint("merge"), ["host", "path"]).groupBy("token").agg(F.sum(F.when(is_block, F.col("n")).otherwise(0)).alias("b"), F.sum(F.when(~is_block, F.col("n")).otherwise(0)).alias("a"))
    counts = staged(counts, "token-counts")
    b, a, size = (float(x or 0) for x in counts.agg(F.sum("b"), F.sum("a"), F.count(F.lit(1))).first())
    scale = math.log((a + size) / (b + size)) if size else 0.0
    weights = counts.select("token", (F.log((F.col("b") + 1.0) / (F.col("a") + 1.0)) + scale).alias("weight"))
    return weights, math.log((blocked + 1) / (allowed + 1))


def bayes_scores(urls: DataFrame, tokens: DataFrame, weights: DataFrame, prior: float) -> DataFrame:
    """``urls`` (distinct ``host``, ``path``) with ``score``, the log odds of block; words never counted say nothing."""
    sums = tokens.join(weights.hint("merge"), "token").groupBy("host", "path").agg(F.sum("weight").alias("sum"))
    return urls.join(sums.hint("merge"), ["host", "path"], "left").select("host", "path", F.round(F.coalesce("sum", F.lit(0.0)) + prior, 9).alias("score"))


def judge(pages: DataFrame, rules: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", odds: float | None = 1.0) -> DataFrame:
    """One row per row of ``pages``: ``id``, ``host``, ``path``, ``rule``, ``verdict``, ``score``.

    ``odds`` are those of block against allow before a word is read. They are even unless given: how much the rules cover
    says nothing of the pages that they leave open; None takes the rules' own share.

    The rule's verdict holds where one fits; elsewhere a url is blocked if its log odds (``score``) are above 0, not at 0.
    A null url or one without ``://`` has an empty host and path and only the prior. Without rules that fit any page all
    others are allowed. Hosts, paths and pages are read whole, however long. Repeated rows repeat; an empty table gives
    an empty table; columns beside these are not read.
    """
    rows = pages.select(F.col(id), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    urls = staged(match_rules(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")), rules), "urls")
    words = staged(lexicon(pages.select(html), html), "lexicon")
    named = rules.select(F.explode(F.split(F.lower(F.concat_ws("/", "rule_host", "rule_path")), r"[^\p{L}\p{N}]+")).alias("word")).where("word <> ''").distinct()
    depth = rules.agg(F.max(F.size(F.filter(F.split("rule_path", "/", -1), lambda s: s != "")))).first()[0] or 0
    found = staged(tokens(urls.select("host", "path"), words, named, depth), "url-tokens")
    ruled = urls.where(F.col("ruled").isNotNull())
    trained = not ruled.isEmpty()
    weights, prior = bayes_weights(found, ruled.select("host", "path", "ruled", "n"))
    prior = prior if odds is None else math.log(odds)
    scored = bayes_scores(urls.where(F.col("ruled").isNull()).select("host", "path"), found, weights, prior)
    verdict = F.coalesce("ruled", F.when(F.lit(trained) & (F.col("score") > 0), "block").otherwise("allow"))
    told = urls.join(scored.hint("merge"), ["host", "path"], "left").select("host", "path", "rule", verdict.alias("verdict"), "score")
    return rows.join(told.hint("merge"), ["host", "path"]).select(F.col(id), "host", "path", "rule", "verdict", "score")
