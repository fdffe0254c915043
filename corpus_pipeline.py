"""A corpus pipeline over `documents`: five stages, each on all rows that the one before kept.

language   rows that language identification rejects (`und`: no text, or no letter in it) go
lines      repeated lines go from the texts, as line_dedup says; rows stay, if need be with an empty text
near       one row of each group of near duplicates stays: the one with the smallest id
mix        rows are emitted as often as the mix to target weights says (sources weigh 5, 2, 1, repeating)
encode     byte-level BPE ids, and a digest of the ids decoded again
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe_codec, langid_hd, line_dedup, mixing, ngram_join
from tidemark.llm.common import intermediates, new_path, packed, ship, unpacked
from tidemark.llm.queries import vocabulary

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trains on the labelled rows that aren't held out; rejects `und`. A low score is no ground to reject: short clean
    texts have one too. Where no row is labelled nothing is learned, and rows without a letter go all the same. Null
    text: goes. Repeated rows, null ids: judged each on its own. An empty table stays empty; further columns are untouched."""
    model = langid_hd.train(docs.where(F.col("doc_id").isNotNull() & ~langid_hd.is_held_out()))
    some = docs.where("text is not null")
    if not model:
        return some.where(F.regexp_like("text", F.lit("\\p{L}")))
    return unpacked(langid_hd.judged(some, model).where(F.col("lang_pred") != "und"), docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated lines out of the texts; n_chars follows the text. All rows stay, null texts as nulls, and a row that loses
    every line with an empty text. Rows with one id, or without one, are one document. An empty table stays empty; further
    columns are untouched."""
    kept = line_dedup.apply_keep(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked rows one stays, that with the smallest id (null ids last; among equal ids the smallest hash;
    of rows equal in id and text, one). Rows without words link with nothing: all stay. An empty table stays empty; further
    columns are untouched."""
    keys = ["key1", "key2"]
    marked = docs.select(packed(docs), "doc_id", "text", *[F.xxhash64(F.lit(i), "doc_id", "text").alias(k) for i, k in enumerate(keys)])
    rows = ngram_join.Join(marked, tags=keys).result()
    least = rows.where("n_shingles > 0").groupBy("root").agg(F.min(F.struct(F.col("doc").isNull().alias("null"), "doc", *keys)).alias("m"))
    words = least.select(*[F.col(f"m.{k}").alias(k) for k in keys], F.lit(True).alias("words"))
    none = rows.where("n_shingles = 0").select(*keys, F.lit(False).alias("words")).distinct()
    stay = marked.select("row", *keys).join(words.unionByName(none), keys)
    return unpacked(stay.where("words").dropDuplicates(keys).unionByName(stay.where("not words")), docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emits each row as often as the mix takes it. A null text has no words and goes by its source's ratio like all others; a
    null source is a source; rows equal in all columns are documents each. An empty table stays empty; further columns
    are untouched."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of the mix: a repeated row again, a null text as an empty one.
    An empty table gives no rows; further columns end here."""
    return bpe_codec.round_trip_digests(docs, vocabulary(VOCABULARY))


STAGES = [("language", language), ("lines", lines), ("near", near_duplicates), ("mix", mix), ("encode", encode)]

#: A trained model, hashes of ids and components are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; each result is written to the shared folder and read again. What a stage's operators wrote on the
    way goes once its result is there, and so does the result before it."""
    ship(spark)
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        with intermediates(spark) as made:
            stage(spark, docs, sf_dir).write.parquet(path)
            if last:
                made.append(last)
        docs, last = spark.read.parquet(path), path
    return docs
