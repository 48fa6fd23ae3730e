"""From raw documents to a token file: filter, de-duplicate, decontaminate, mix, encode."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from outledger.llm import decontamination, membership, mixing, near_duplicates, token_file, toxicity
from outledger.llm.frames import ship_package, stored, table
from outledger.runtime import checkpoint_dir

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted grammar doesn't reject."""
    ship_package(spark)
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.clean(docs, model).select(*DOCUMENTS)


def numbered(docs: DataFrame) -> DataFrame:
    """The rows with a stored number of their own, `_row`: ids may be NULL or repeated."""
    return stored(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")


def sound_ids(docs: DataFrame) -> bool:
    """Whether every row has an id of its own."""
    return docs.groupBy("doc_id").count().filter("doc_id is null or count > 1").isEmpty()


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest id, of each group of near duplicates; rows with a NULL id stay.

    Where ids are missing or shared, rows are told apart by a number of their own.
    """
    ship_package(spark)
    if sound_ids(docs):
        copies = near_duplicates.near_duplicates(docs).filter("not kept").select("doc_id")
        return membership.without(docs, copies, "doc_id").select(*DOCUMENTS)
    rows = numbered(docs)
    # Compared by row number; rows without an id are linked with nothing.
    own = rows.select("text", F.when(F.col("doc_id").isNotNull(), F.col("_row")).alias("_row"))
    found = near_duplicates.near_duplicates(own, "_row").select(F.col("doc_id").alias("_row"), "component_id")
    members = stored(rows.select("_row", "doc_id").join(found, "_row"), "members")
    firsts = members.groupBy("component_id").agg(F.count("*").alias("members"), F.min(F.struct("doc_id", "_row")).alias("first"))
    copies = members.join(firsts.filter("members > 1"), "component_id").filter("_row <> first._row").select("_row")
    return membership.without(rows, copies, "_row").select(*DOCUMENTS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship_package(spark)
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark")).select(*DOCUMENTS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; rows without an id of their own go by a number."""
    if sound_ids(docs):
        rows, key, mixed = docs, "doc_id", mixing.mix(docs)
    else:
        rows, key = numbered(docs), "_row"
        mixed = mixing.mix(rows, carry=(key,))
    copies = mixed.select(key, F.col("copies").alias("_copies")).filter("_copies > 0")
    repeated = rows.join(copies, key).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select(*DOCUMENTS)


def write_token_file(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each row's ids in the token file, read back from it."""
    ship_package(spark)
    folder = f"{checkpoint_dir(spark)}/pipeline-tokens-{uuid.uuid4().hex}"
    return token_file.token_table(docs, public_tokenizers.path("word_bpe_49k.json"), folder)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_file", write_token_file),
]

#: SQL has no counterpart of the fitted grammar and of the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each writes Parquet that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
