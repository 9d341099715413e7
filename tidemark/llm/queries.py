"""The registered queries of this subpackage: each applies its operator to its whole table."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources.tables import read_table

from . import ann, decontam, langid, licenses, packing, pii, quality, resampling, sharding, simhash, token_files, toxicity, variants
from .common import fold

PII_KEY = "registered-query-key"       # a deployment passes its own secret


def tokenizer(name: str) -> str:
    """A file of the installed public tokenizers."""
    import public_tokenizers
    return public_tokenizers.path(name)


MAX_BROADCAST_LABELS = 2_000_000       # rows of an id and a number each: at most about 80 MB


def _labelled(spark, sf_dir, docs, label) -> DataFrame:
    """Texts with their label; a document with several label rows is learned from each.

    The labels are counted and broadcast up to ``MAX_BROADCAST_LABELS`` rows, so the texts stay where they are;
    beyond that the join shuffles.
    """
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("label_id"), F.col(label).cast("int").alias("label"))
    labels = labels.filter("label is not null and label_id is not null")
    if labels.count() <= MAX_BROADCAST_LABELS:
        labels = F.broadcast(labels)
    return docs.select("doc_id", "text").join(labels, F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "label")


def toxicity_model(spark, sf_dir, docs):
    train = _labelled(spark, sf_dir, docs, "toxic").filter(fold("doc_id", 5) != 0)
    return toxicity.fit(train, "text", "label", part=fold("doc_id", 5) == 1)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(spark, sf_dir, docs)
    scored = toxicity.with_score(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text rewritten; only documents' own columns and a mark of what changed."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("before", F.xxhash64("text"))
    rewritten, _ = pii.replace(docs, PII_KEY)
    return rewritten.select("doc_id", "text", (F.xxhash64("text") != F.col("before")).alias("changed"))


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(rows, F.pmod("vec_id", F.lit(50)) == 0).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, tokenizer("byte_bpe_50k.json"), capacity=2048, end_id=1)
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, width=3, distance=2)
    return found.select(F.col("id").alias("doc_id"), simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(_labelled(spark, sf_dir, docs, "quality").filter(fold("doc_id", 4) != 2), "text", "label")
    return (docs.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), quality.score(model, spark, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.7).cast("int")))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).withColumnRenamed("id", "doc_id")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    back = token_files.round_trip(docs, tokenizer("word_bpe_49k.json"), end_id=2)
    return back.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.overlaps(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text")).withColumnRenamed("id", "doc_id")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = langid.fit(docs.filter(fold("doc_id", 4) != 2))
    found = docs.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), langid.predict(learned, spark, F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.best").alias("lang_pred"), "p.score", "p.margin", "p.rejected")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = resampling.resample(docs, read_table(spark, sf_dir, "benchmark").select("text"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants.group(variants.word_counts(docs, drop_every=199)).select("word", "form", "root", "n", "n_near", "form_n")


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = sharding.shard(docs, shards=40, row_bytes=16)
    return found.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_pii, op3_ann, op4_packing, op5_simhash, op6_quality, op7_licenses,
                                   op8_token_files, op9_decontamination, op10_language, op11_resampling,
                                   op12_variants, op13_sharding)}
ORACLE_SQL: dict[str, str] = {}
