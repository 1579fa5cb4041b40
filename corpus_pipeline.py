"""Corpus pipeline over ``documents``: each stage is one operator of lakeshore.llm.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame, which is written as Parquet and read again as the next stage's docs.
All stages but the last return the columns of ``documents``.

1. language ID: documents without a language that was learned go, also those whose
   score is far below what that language's own documents have;
2. SimHash near-dedup: of each group of near copies the smallest doc_id stays;
3. substring dedup: passages of 13 words and more that an earlier document has are
   cut out of the text, whose layout otherwise stays;
4. mixing: a document comes as often as the mix takes it (not, once, up to three
   times);
5. BPE: ids of every text, and digests of ids and of the text decoded from them.

A null text has no language and goes in stage 1; rows without doc_id stay where a
stage can name none; an empty table passes through.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeshore.llm import bpe, langid, mixing, simhash, substrings
from lakeshore.llm.store import written


def whole(docs: DataFrame) -> Column:
    """A row as one struct: columns of any name go through a stage untouched."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one that the labels teach."""
    labelled = docs.where(~langid.held_out())
    profiles = langid.learn(labelled)
    named = langid.predict(docs, profiles, keep=[whole(docs).alias("row")])
    # a row per language
    least = [(F.col("lang_pred") == lang) & (F.col("score") >= limit)
             for lang, limit in langid.limits(labelled, profiles).items()]
    good = (F.col("lang_pred") != langid.UNKNOWN) & functools.reduce(Column.__or__, least, F.lit(False))
    return named.where(good).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id. Rows
    that repeat its id and text are copies too; rows without an id stay."""
    groups = simhash.simhash_components(docs, shingle=3, radius=3)
    kept = groups.where("doc_id = component_id").select("doc_id").distinct()
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), whole(docs).alias("row"))
    once = rows.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "h"])  # in the join's partitions
    return once.select("row.*").unionByName(docs.where("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    cut = substrings.dedup_substrings(docs, k=13, carry=others)
    new = {"doc_id": F.col("doc_id"), "text": F.col("kept").alias("text"),
           "n_chars": F.length("kept").cast("long").alias("n_chars")}
    return cut.select(*[new[c] if c in new else F.col(f"rest.`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. Blocks are taken in order, so all
    documents of a source but one come whole; that one is rounded."""
    mixed = mixing.mix(docs, carry=whole(docs))
    copies = F.round(F.col("taken") / F.col("size")).cast("int")
    taken = mixed.where("size > 0").withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies)))
    return taken.select("rest.*")


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with digests of them and of what they decode to."""
    coded = bpe.encode_documents(docs, keep=["doc_id", "lang", "source"], decoded_col="decoded")
    return coded.select("doc_id", "lang", "source", "ids", *bpe.digest_columns())


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mix", mix_sources),
    ("bpe", bpe_encode),
]

#: SimHash, byte-pair encoding and the language profiles are beyond SQL; tests/llm
#: holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; every stage but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
