"""A training corpus from raw documents: five stages, each written and read again.

Every stage works on all that the one before kept, and all but the last return the columns
of ``documents``. Quality first, since it is the cheapest way to lose text; near copies
before repeated passages, so that a passage is not taken out of copies that go anyway;
benchmark passages are looked for in the text that is left; tokens come last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from vellumflow.llm import byte_bpe, parity_join, phrase_index, site_bayes, suffix_dedup
from vellumflow.llm.parity_join import Rule
from vellumflow.llm.tables import Tables
from vellumflow.session import scratch

#: Near duplicates: shingles of five words, a similarity of 0.8 or more.
NEAR = Rule(words=5, percent=80)
#: Repeated passages: over 50 words, judged by all windows of 51, or 400 bytes; samples by grams.
PASSAGE, STRING = (51, 10, True), (400, 64, False)


def numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(row, doc, doc_id, text): ``docs`` written with a number per row, since ids may be null or repeated; ``doc``
    holds all columns, whatever their names."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc"), "doc_id", "text")
    return Tables(spark).keep(rows, "numbered")


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from ``doc`` and ``text``."""
    return rows.select(*[F.col("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    rows = docs.select("doc_id", "text", "source", "lang", doc.alias("doc"))
    return unpacked(site_bayes.classify(rows, labels, scratch(spark, "sites")).where("accepted"), docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest id, null last, and of
    rows with this id one. Documents without a word, which no set describes, all stay."""
    rows = numbered(spark, docs)
    groups = parity_join.join(rows.select(F.col("row").alias("doc_id"), "text"), NEAR)
    ranked = groups.select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", "doc_id"), "row")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    # An aggregate, so that a group of very many rows is reduced before the shuffle.
    first = ranked.groupBy("component_id").agg(F.min(rank).alias("first")).select("first.row")
    return unpacked(rows.join(first, "row", "left_semi"), docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of over 50 words and strings of 400 bytes that are repeated; documents with
    nothing left go. Words end at blanks: in a script without blanks the bytes decide."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    cut = suffix_dedup.clean(docs.select("doc_id", "text", doc.alias("doc")), *PASSAGE, also=(STRING,))
    n_chars = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("doc.n_chars"))
    cut = cut.where("size(spans) = 0 OR text <> ''").withColumn("doc", F.col("doc").withField("n_chars", n_chars))
    return unpacked(cut, docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates, judged row by row."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = numbered(spark, docs)
    found = phrase_index.decontaminate(rows.select(F.col("row").alias("doc_id"), "text"), items, scratch(spark, "index"))
    bad = found.where("contaminated").select(F.col("doc_id").alias("row"))
    return unpacked(rows.join(bad, "row", "left_anti"), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, checked by decoding them again."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("decontaminated", decontaminated),
    ("tokens", tokens),
]

#: Iterative joins, fitted weights and token merges have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
