"""From raw documents to token ids: five stages, each written to the shared folder and read by the next.

Every stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor kept, and returns the columns of
``documents``, but for the last, which returns ids. Nulls, empty texts and repeated rows fare as the operators say:
null and empty texts fail the quality rules, and of rows with one id the near-dedup stage keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import bpe, linededup, minhash, mixing, qualityrules
from brindle.llm.common import packed, staged
from brindle.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the classifier keep; the classifier is fitted on the labelled ones among them."""
    model = qualityrules.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = qualityrules.judge(docs.select("text", packed(docs, "text").alias("_all")), model)
    return judged.where("kept").select(*["text" if c == "text" else F.col("_all")[c].alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand in at least 10 of them; ``n_chars`` follows the text."""
    out = linededup.dedup_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return minhash.dedup(docs, n=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target wants them."""
    return mixing.apply(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text: ``doc_id``, ``lang``, ``source``, ``n_tokens``, ``ids``."""
    out = bpe.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_path("word_bpe_49k.json"))
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash", near_dedup),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs


#: Drawn copies, a fitted classifier and merges are beyond SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None
