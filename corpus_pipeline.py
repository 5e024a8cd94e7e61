"""From raw documents to token ids: classify, drop near copies, cut repeated passages, mix sources, encode.

Every stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes each one as Parquet to the shared
folder and rereads it as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import bpe, mixing, perplexity, repeats, resemblance, store
from riskloom.session import materialise

def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    A rejected doc_id takes all its rows along only if all of them are rejected; rows without id stay.
    """
    judged = perplexity.classify(docs, perplexity.trusted_ids(spark, sf_dir))
    rejected = judged.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).filter(~F.col("kept")).select("doc_id")
    return docs.join(rejected, "doc_id", "left_anti").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays: that with the smallest doc_id.

    Near duplicates are linked by five-word shingles with a Jaccard similarity of 0.8 or more. Rows are judged one by one, by their
    place: rows without id come after those with one, and of rows with one id the first by place stays if they are near
    duplicates; if they aren't, all stay.
    """
    rows = store.placed(docs)
    dropped = resemblance.near_copies(rows).filter(~F.col("kept")).select(store.BLOCK, store.ROW)
    return rows.join(dropped, [store.BLOCK, store.ROW], "left_anti").select("doc.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that an earlier document has are cut out, in whole characters."""
    return repeats.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    plan = mixing.plan_mix(mixing.size_documents(spark, docs, sf_dir))
    copies = plan.groupBy("doc_id").agg(F.max("copies").alias("copies")).withColumn("wanted", F.expr("explode(sequence(1, greatest(copies, 1)))")).filter("copies > 0")
    columns = [docs[c] for c in docs.columns]
    return docs.join(copies, docs["doc_id"].eqNullSafe(copies["doc_id"])).select(*columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to."""
    import public_tokenizers as public

    coded = bpe.encode(docs, public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near copies", near_copies),
    ("suffix-array repeats", repeated_passages),
    ("source mix", source_mix),
    ("byte-level bpe", token_ids),
]

#: The Kneser-Ney model, connected components and merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
