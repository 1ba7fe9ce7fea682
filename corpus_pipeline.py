"""A corpus from raw documents to training sequences: filter, deduplicate, mix and pack.

Each stage takes ``(spark, docs, sf_dir)`` and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from perfspark.llm import linededup, mixing, packing, queries, simhash, toxicity
from perfspark.session import shared_dir


#: Bytes of an Arrow batch: whole rows with their texts go through Python here, in and out.
BATCH_BYTES = 8 << 20

#: Words whose ids a worker keeps while packing; those of earlier stages are still in memory then.
PACKING_WORDS = 100_000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar does not call toxic."""
    _small_batches(spark)
    scored = toxicity.score(docs, queries.table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select(*docs.columns)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten documents or more share; ``n_chars`` follows the text."""
    _small_batches(spark)
    kept = linededup.drop_common_lines(docs, min_docs=10)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints that differ in at most 4 of 64 bits, the
    one of least id (null last); rows equal in id and text count as one."""
    return simhash.one_of_each(docs, bits=4, words=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, twice at most; empty ones, of size 0, go. Sources
    may be null; rows equal in id and text are taken or left together."""
    mixed = mixing.mix(docs).where("repeats > 0")
    times = F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))
    return mixed.select("row", times.alias("_time")).select(
        *[F.col("row")[c].alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences. Null and empty texts are an end id alone; repeated rows are
    packed as often as they stand there."""
    pieces = packing.pack_documents(docs, queries.tokenizer(), words=PACKING_WORDS)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_common_lines),
    ("simhash_near_dedup", one_of_each_group),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: No SQL: a learned grammar, XXH64 fingerprints and a tokenizer are no SQL functions. Tests hold
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {**queries.QUERIES, "pipeline": run}
SQL = {**queries.SQL, **({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})}
