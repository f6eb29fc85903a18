"""The corpus pipeline: five stages from documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before
kept; its result is written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import mixing, ngram_join, packing, quality, suffix_dedup
from tripmart.llm.common import maybe_in, saved
from tripmart.llm.queries import tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.quality(docs).where("kept").select(*COLUMNS)


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with one row per document, a number ``_key`` of its own each, and
    the documents ``(_key, doc_id)`` whose key is not their id, if there are any.

    Rows equal in id and text are one document (of their other columns the least
    stay). An id of one row is its key. Rows that share an id, and rows without
    one, get a hash of id and text that no other row has as its key; only their
    texts are shuffled.
    """
    shared = saved(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null")
                   .select("doc_id"), "shared_ids")
    if shared.isEmpty():
        return docs.withColumn("_key", F.col("doc_id")), None
    # Rows that the bitmap takes for shared by chance go the same way.
    single, some = maybe_in(docs, F.col("doc_id"), shared)
    rest = ["lang", "source", "n_chars", "text"]
    some = saved(some.groupBy("doc_id", F.sha2("text", 256).alias("_sha")).agg(F.min(F.struct(*rest)).alias("_row"))
                 .select("doc_id", "_sha", "_row.*"), "shared")
    for seed in range(100):
        keyed = some.withColumn("_key", F.xxhash64(F.lit(seed), "doc_id", "_sha"))
        keys = keyed.select("_key").union(single.select("doc_id"))
        if keys.groupBy("_key").count().where("count > 1").isEmpty():
            own = [*docs.columns, "_key"]
            return (single.withColumn("_key", F.col("doc_id")).select(*own).union(keyed.select(*own)),
                    keyed.select("_key", "doc_id"))
    raise RuntimeError("no free keys for documents that share an id")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with similar texts (five-word shingles, Jaccard
    0.8 or more) the one with the smallest id stays, once; one without an id only
    if none has one. Rows equal in id and text are one document, whatever the
    text; rows that share an id, or have none, are told apart by their texts."""
    docs, named = _keyed(docs)
    group = ngram_join.ngram_join(docs, id_col="_key", k=5, num=4, den=5).select(
        F.col("doc_id").alias("_key"), F.col("component_id").alias("_group"))
    first = F.col("_group")
    if named is not None:
        # The smallest key of a group need not be that of the smallest id.
        group = saved(group, "groups").join(named.withColumn("_named", F.lit(True)), "_key", "left")
        ident = F.when(F.col("_named"), F.col("doc_id")).otherwise(F.col("_key"))
        heads = saved(group.groupBy("_group").agg(F.min(F.struct(ident.isNull(), ident, "_key")).alias("least"))
                      .select("_group", F.col("least._key").alias("_head")).where("_head <> _group"), "heads")
        group = group.join(heads, "_group", "left")
        first = F.coalesce("_head", "_group")
    drop = saved(group.where(F.col("_key") != first).select("_key"), "drop")
    apart, near = maybe_in(docs, F.col("_key"), drop)
    return apart.union(near.join(drop, "_key", "left_anti").select(*apart.columns)).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay in the first document that has them; a
    document that loses all its words goes."""
    cut = suffix_dedup.cut_repeats(docs)
    empty = (F.col("cut_words") > 0) & (F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]")) == 0)
    return (cut.where(~F.coalesce(empty, F.lit(False)))
            .withColumn("n_chars", F.when(F.col("cut_words") > 0, F.char_length("text").cast("long"))
                        .otherwise(F.col("n_chars"))).select(*COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeated(mixing.mix(docs)).select(*COLUMNS)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 1024 ids."""
    return packing.pack(docs, **tokenizer())


STAGES = [("quality", quality_rules), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("source_mix", source_mix),
          ("packing", packed_sequences)]

# Tokens are beyond SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
