"""The registered queries over whole tables, one for each operator, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import bpe, decontaminate, embeddings, kneserney, linededup, minhash, mixing, prefixtrie, qualityrules, secretscan, suffixdedup, urlfilter, vectorcodes
from brindle.llm.common import staged


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), n=4, percent=80)


OP1_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id, d.doc_id = min(r.b) AS kept
FROM documents d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n
"""


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("word_bpe_49k.json")
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path).select("doc_id", "ids")
    return bpe.decode(ids, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: Fixed by the query: (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, verdict string")
    return urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"), rules)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP5_SQL = """
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM cut),
k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT k.doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY k.doc_id
"""


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixdedup.remove_repeats(table(spark, sf_dir, "documents"), length=50)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
o AS (SELECT doc_id, b, substring(h, 512 * b + 1, 610) AS h FROM (SELECT doc_id, h, unnest(range(0, length(h) // 512 + 1)) AS b FROM d)),
w AS (SELECT doc_id, 256 * b + j AS i, substring(h, 2 * j + 1, 100) AS s FROM (SELECT *, unnest(range(0, 256)) AS j FROM o) WHERE length(h) >= 2 * j + 100),
m AS (SELECT s, min(doc_id) AS lo FROM w GROUP BY s),
hit AS (SELECT w.doc_id, w.i FROM w JOIN m ON w.s = m.s WHERE m.lo < w.doc_id),
p AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM hit),
g AS (SELECT doc_id, i, count(*) FILTER (WHERE before IS NULL OR i > before + 50) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM p),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS z FROM g GROUP BY doc_id, g),
gaps AS (SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f, a AS t FROM spans
         UNION ALL SELECT s.doc_id, max(z), max(length(h) // 2) FROM spans s JOIN d ON d.doc_id = s.doc_id GROUP BY s.doc_id),
kept AS (SELECT d.doc_id, sha256(unhex(string_agg(substring(h, 2 * f + 1, 2 * (t - f)), '' ORDER BY f))) AS kept FROM gaps JOIN d ON d.doc_id = gaps.doc_id GROUP BY d.doc_id),
n AS (SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, coalesce(kept, sha256(unhex(h))) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT m.vec_id, coalesce(n.n, 0) AS n_links, min(r.b) AS component_id, m.vec_id = min(r.b) AS kept
FROM embeddings m JOIN r ON r.a = m.vec_id LEFT JOIN n ON n.a = m.vec_id GROUP BY m.vec_id, n.n
"""


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneserney.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = qualityrules.train(docs, table(spark, sf_dir, "labels"))
    return qualityrules.judge(docs, model).select("doc_id", *qualityrules.FEATURES, "base_failed", "kept", "quality")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    kinds = lambda *names: F.filter("spans", lambda s: s["kind"].isin(*names))
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        *[F.size(kinds(k)).cast("long").alias(f"n_{k}") for k in secretscan.KINDS[:3]],
        F.sha2(told(kinds(*secretscan.KINDS[:3])), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP11_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
i AS (SELECT item_id, least(len(ws), 10) AS n, ws FROM b WHERE len(ws) > 0),
g AS (SELECT DISTINCT item_id, n, array_to_string(ws[j:j + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS j FROM i)),
p AS (SELECT doc_id, n, j, array_to_string(ws[j:j + n - 1], ' ') AS g FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS j FROM d, (SELECT DISTINCT n FROM i))),
h AS (SELECT doc_id, p.n, j, item_id FROM p JOIN g ON g.n = p.n AND g.g = p.g),
w AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(j, j + n)) AS at FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN w ON w.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = vectorcodes.kept_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    books = vectorcodes.fit(vectors, parts=8, entries=16, rounds=6)
    coded = vectorcodes.with_label_error(staged(vectorcodes.encode(vectors, books), "codes"))
    digits = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return coded.select("vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def _rounds(n: int) -> str:
    """Assignments ``a1`` to ``a{n + 1}`` and codebooks ``c1`` to ``cn`` as common table expressions."""
    far = "list_sum([0] || list_transform(range(1, len(x) + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i])))::BIGINT"
    out = []
    for r in range(1, n + 2):
        out.append(f"a{r} AS MATERIALIZED (SELECT row, vec_id, label, part, x, arg_min(entry, far * 64 + entry) AS entry, min(far) AS far FROM (SELECT p.*, entry, {far} AS far FROM p JOIN c{r - 1} c ON c.part = p.part) GROUP BY ALL)")
        if r <= n:
            out.append(f"s{r} AS (SELECT part, entry, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM (SELECT part, entry, x, unnest(range(1, len(x) + 1)) AS i FROM a{r}) GROUP BY 1, 2, 3)")
            out.append(f"c{r} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(list((s - ((s % n) + n) % n) // n ORDER BY i) FILTER (WHERE s IS NOT NULL), any_value(y)) AS y FROM c{r - 1} c LEFT JOIN s{r} s ON s.part = c.part AND s.entry = c.entry GROUP BY c.part, c.entry)")
    return ",\n".join(out)


OP12_SQL = f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT row, vec_id, label, part, e[part * (len(e) // 8) + 1:(part + 1) * (len(e) // 8)] AS x FROM v, range(8) r(part)),
c0 AS MATERIALIZED (SELECT part, row - 1 AS entry, x AS y FROM p WHERE row <= 16),
{_rounds(6)},
f AS (SELECT row, vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM a7 GROUP BY ALL)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, entry)) FROM c6) AS codebooks_sha256 FROM f
"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie(table(spark, sf_dir, "conversations"))


OP13_SQL = """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos,
             {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, xor(4294967295, list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
        lambda crc, b: list_reduce(range(8), lambda x, _: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)), 4294967295)) % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS own, pos, said FROM c JOIN t ON t.conv_id = c.base WHERE pos <= h
      UNION ALL SELECT c.conv_id, 1, pos, said FROM c JOIN t ON t.conv_id = c.conv_id WHERE pos > h),
l AS (SELECT c.conv_id, coalesce(list(said ORDER BY own, pos) FILTER (WHERE pos IS NOT NULL), []) AS said FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
m AS (SELECT conv_id, depth, said[1:depth] AS path, len(said) = depth AS ends FROM (SELECT *, unnest(range(0, len(said) + 1)) AS depth FROM l)),
n AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM m GROUP BY depth, path),
k AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
a AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.depth > 0 THEN (n_convs - 1) * strlen(n.path[n.depth].text) ELSE 0 END AS saved FROM n LEFT JOIN k ON k.depth = n.depth AND k.path = n.path),
s AS (SELECT up AS depth, path[1:up] AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM a) GROUP BY 1, 2)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, n_leaves, saved_tokens, a.ends_sha256
FROM a JOIN s ON s.depth = a.depth AND s.path = a.path LEFT JOIN n p ON p.depth = a.depth - 1 AND p.path = a.path[1:a.depth - 1]
"""


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What rules alone decide of every page's url."""
    url = F.col("url")
    pages = table(spark, sf_dir, "pages").select("page_id", urlfilter.host_of(url).alias("host"), urlfilter.path_of(url).alias("path"))
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, verdict string")
    ruled = urlfilter.match_rules(pages.select("host", "path").distinct(), rules)
    return pages.join(ruled, ["host", "path"]).select("page_id", "host", "path", "rule", "ruled")


URL_RULES_SQL = (
    """
WITH p AS (SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
             coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(h, f, v) AS (VALUES """
    + ", ".join(str(r) for r in URL_RULES)
    + """),
m AS (SELECT page_id, arg_max({'rule': h || f, 'ruled': v}, (length(h || f), h || f)) AS best FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, f) GROUP BY page_id)
SELECT p.page_id, host, path, best.rule AS rule, best.ruled AS ruled FROM p LEFT JOIN m ON m.page_id = p.page_id
"""
)


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target of every source."""
    size = F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0))
    return mixing.targets(table(spark, sf_dir, "documents").groupBy("source").agg(F.sum(size).cast("long").alias("source_size")))


MIX_TARGETS_SQL = """
WITH s AS (SELECT source, sum(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0))::BIGINT AS source_size FROM documents GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
k AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
       / sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
l AS (SELECT coalesce(arg_min(level, (cap / weight, source)) FILTER (WHERE level * weight <= cap), max(cap / weight)) AS level FROM k)
SELECT source, source_size, least(weight * l.level, cap) AS target FROM w, l
"""


def quality_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counted features of every document and what the base rules say."""
    judged = qualityrules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), None)
    return judged.select("doc_id", *qualityrules.FEATURES, "base_failed")


QUALITY_FEATURES_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
t AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g),
r AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + unnest(range(0, 3)) AS j FROM t WHERE n >= 2) GROUP BY doc_id),
f AS (SELECT d.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))) - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS n_dup_lines,
        coalesce(r.n, 0) AS n_repeat_words FROM d LEFT JOIN r ON r.doc_id = d.doc_id)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
"""


def secret_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many spans of the base kinds every document has."""
    found = secretscan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[of(kind).alias(f"n_{kind}") for kind in secretscan.KINDS[:3]])


SECRET_WORDS = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token", "api_?key"))
SECRET_COUNTS_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, len(list_filter(regexp_extract_all(text, '({SECRET_WORDS})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2), lambda x: length(x) >= 8)) AS n_assign,
  len(list_filter(regexp_extract_all(text, 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 16)) AS n_access,
  len(list_filter(regexp_extract_all(text, '[0-9a-f]+'), lambda x: length(x) >= 32)) AS n_hex FROM d
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_bpe": op2_bpe,
    "op3_url_filter": op3_url_filter,
    "op4_mixing": op4_mixing,
    "op5_line_dedup": op5_line_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_embeddings": op7_embeddings,
    "op8_kneser_ney": op8_kneser_ney,
    "op9_quality_rules": op9_quality_rules,
    "op10_secret_scan": op10_secret_scan,
    "op11_decontamination": op11_decontamination,
    "op12_vector_codes": op12_vector_codes,
    "op13_prefix_trie": op13_prefix_trie,
    "url_rules": url_rules,
    "mix_targets": mix_targets,
    "quality_features": quality_features,
    "secret_counts": secret_counts,
}

ORACLES: dict[str, str] = {
    "op1_minhash": OP1_SQL,
    "op5_line_dedup": OP5_SQL,
    "op6_suffix_dedup": OP6_SQL,
    "op7_embeddings": OP7_SQL,
    "op11_decontamination": OP11_SQL,
    "op12_vector_codes": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
    "url_rules": URL_RULES_SQL,
    "mix_targets": MIX_TARGETS_SQL,
    "quality_features": QUALITY_FEATURES_SQL,
    "secret_counts": SECRET_COUNTS_SQL,
}
