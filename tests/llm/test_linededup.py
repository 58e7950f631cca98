from __future__ import annotations

from collections import defaultdict

from pyspark.sql import functions as F

from brindle.llm import linededup

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(rows, min_docs, keep="none"):
    found = defaultdict(set)
    for i, t in rows:
        for p, line in enumerate((t or "").split("\n")):
            if key(line):
                found[key(line)].add((i, p))
    bad = {k for k, v in found.items() if len({i for i, _ in v}) >= min_docs}
    first = {k: min(found[k]) for k in bad}
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for p, x in enumerate(lines) if key(x) not in bad or (keep == "first" and first[key(x)] == (i, p))]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def check(docs, **how):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = brute(rows, how.get("min_docs", 10), how.get("keep", "none"))
    out = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs, **how))
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in out.collect()} == expected


def test_brute_force(docs):
    check(docs)
    check(docs, min_docs=2, keep="first")


def test_columns_null_ids_repeats_and_empty(spark, docs, no_docs):
    assert linededup.dedup_lines(no_docs).count() == 0
    rows = [(None, "x\ny"), (1, "x\nz"), (1, "x\nz"), (2, "X "), (3, None), (4, "\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_dropped", F.lit("clash"))
    out = linededup.dedup_lines(df, min_docs=3)
    assert out.columns == df.columns
    assert sorted(((r.doc_id or 0), r.text) for r in out.collect()) == [(0, "y"), (1, "z"), (1, "z"), (2, ""), (3, ""), (4, "\n")]
    # repeated rows are one document: two ids do not make three
    assert linededup.keep_bitmaps(df.where("doc_id < 3"), min_docs=3).count() == 0


def test_an_id_with_several_texts_is_one_document(spark):
    rows = [(i, f"shared\nown{i}") for i in range(9)] + [(8, "shared\nother")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert linededup.keep_bitmaps(df).count() == 0  # 10 texts, 9 documents
    more = df.union(spark.createDataFrame([(None, "shared\nnone"), (8, "Shared ")], df.schema))
    out = linededup.dedup_lines(more)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in out.collect()) == sorted([(i, f"own{i}") for i in range(9)] + [(8, "other"), (-1, "none"), (8, "")])
    first = linededup.dedup_lines(more, keep="first")
    assert [r.text for r in first.where("text LIKE '%hared%'").collect()] == ["shared\nnone"]


def test_columns_of_any_name(spark):
    rows = [(i, "same line\nown%d" % i, "_id", "_runs", 7) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id string, _runs string, n_dropped int")
    out = linededup.dedup_lines(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    assert sorted(map(tuple, out.collect())) == [(i, "own%d" % i, "_id", "_runs", 7) for i in range(12)]
    told = linededup.apply_bitmaps(df, linededup.keep_bitmaps(df))
    assert told.columns == ["doc_id", "_id", "_runs", "text", "n_lines", "n_dropped"] and {r.n_dropped for r in told.collect()} == {1}


def test_runs_are_compressed(spark):
    df = spark.createDataFrame([(i, "a\nb\nc\nown%d\na" % i) for i in range(4)], "doc_id long, text string")
    row = linededup.keep_bitmaps(df, min_docs=4).where("doc_id = 0").first()
    assert [tuple(x) for x in row.dropped] == [(0, 3), (4, 5)] and row.n_dropped == 4
