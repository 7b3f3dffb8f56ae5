"""From raw documents to packed training sequences: line rules, quality classifier, near duplicates, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.llm.common import durable, small, table
from concordat.llm.lines import clean_lines
from concordat.llm.ngram import BROADCAST_IDS, ngram_join
from concordat.llm.packing import cut, pack, tightest
from concordat.llm.quality import quality_scores
from concordat.llm.wordbpe import word_codec


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without the lines that fail; a text that loses nothing stays as it is.

    A null or empty text has no words, so it goes; repeated rows stay as often as they were; no documents give none. Columns pass
    through whatever their names; n_chars follows the text where there is such a column.
    """
    # an id that the filter asks for keeps the optimizer from moving the filter below the counts, which would compute them once more for each use
    judged = clean_lines(docs.select(F.struct("*").alias("__doc"), "text")).withColumn("__row", F.monotonically_increasing_id()).where("kept AND __row >= 0")
    lost, texts = F.col("lost_chars") > 0, {}
    for field in docs.schema:
        old = F.col("__doc")[field.name]
        new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast(field.dataType)}.get(field.name)
        texts[field.name] = old if new is None else F.when(lost, new).otherwise(old)
    return judged.select(*(c.alias(n) for n, c in texts.items()))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a predicted label of 1. Columns pass through whatever their names; equal texts are scored alike, a null text as an
    empty one; a null or repeated id is no label's; no documents give none."""
    return quality_scores(docs, table(spark, sf_dir, "labels"), passing=True).where("predicted = 1").select(*(F.col("row")[c].alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, by text where ids are equal, one without an id only if none has one.

    A document is an id and a text: rows that repeat both are one, and different texts that share an id are told apart. A text without words
    is nobody's copy, but repeated rows of it are one as well. Columns pass through whatever their names; no documents give none.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.md5(text).alias("digest"))
    keyed = docs.select(F.struct("*").alias("__doc"), "text", key.alias("__key"))
    found = durable(ngram_join(keyed, key="__key").groupBy("__key").agg(F.min("kept").alias("kept"), F.count("*").alias("rows")), "kept")
    drop = found.where("NOT kept OR rows > 1")
    drop = F.broadcast(drop) if small(drop, BROADCAST_IDS) else drop
    told = keyed.join(drop, "__key", "left")
    once = told.where("rows IS NULL").select("__doc")
    # of repeated rows any is as good, but for other columns: the least of them
    again = told.where("kept AND rows > 1").groupBy("__key").agg(F.min_by("__doc", F.xxhash64("__doc")).alias("__doc")).select("__doc")
    return once.unionAll(again).select(*(F.col("__doc")[c].alias(c) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 4096 tokens. A null text is an empty document, of the end id alone; ids are
    handed on as they are, null or repeated; no documents give no pieces."""
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = cut(docs, lambda: word_codec(path).encode, 4096, end_id=1)
    return pack(pieces, lambda counts: tightest(counts, 4096)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality rules", quality_rules), ("quality classifier", quality_classifier), ("n-gram Jaccard join", near_duplicates), ("best-fit packing", packing)]
#: Learned scores, MinHash joins and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
