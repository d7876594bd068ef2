"""Corpus pipeline: toxicity, language, near-duplicates, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's `docs`. All but the last return
the columns of `documents`:

  toxicity         drops documents that the positive-unlabelled model rejects
  language         drops documents without a determined language
  near_duplicates  keeps one document of each near-duplicate group
  decontaminate    drops documents that hold a benchmark passage
  encode           ids of every remaining text, and the text they decode to
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from silverline.catalog import TABLE_SCHEMAS, Tables, stored
from silverline.llm import crf_language, piece_bpe, positional_index, superminhash, toxicity_pu
from silverline.llm.frames import bound_batches, held_out

COLUMNS = [c.split()[0] for c in TABLE_SCHEMAS["documents"].split(", ")]
# Mean over words of the largest posterior, below which a text's language is not determined.
LEAST_LANGUAGE_CERTAINTY = 0.5


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of `documents`, handed to Python tasks in batches of bounded bytes."""
    bound_batches(docs.sparkSession)
    return docs.select(*[F.col(f"`{c}`") for c in COLUMNS])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null texts score the model's bias, as empty ones."""
    rows = _documents(docs)
    learn = ~held_out(F.col("doc_id"), toxicity_pu.FOLDS, toxicity_pu.HELD_OUT)
    return toxicity_pu.not_toxic(rows, toxicity_pu.train(rows, Tables(spark, sf_dir).labels, learn))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter (null and empty ones too) go."""
    rows = _documents(docs)
    learn = ~held_out(F.col("doc_id"), crf_language.FOLDS, crf_language.HELD_OUT)
    return crf_language.identified(rows, crf_language.train(rows, learn), LEAST_LANGUAGE_CERTAINTY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the row with the smallest doc_id stays. Rows are told apart by
    id and text: texts that share an id are decided one by one, and a repeated row
    is one. Rows without doc_id never link to others; of equal ones, one stays."""
    rows = _documents(docs)
    with_id = rows.where("doc_id IS NOT NULL").withColumn("_key", F.xxhash64("doc_id", "text"))
    found = superminhash.near_duplicates(with_id.select(F.col("_key").alias("doc_id"), "text"))
    group = found.select(F.col("doc_id").alias("_key"), F.col("component_id").alias("_group")).distinct()
    kept = (with_id.select("_key", "doc_id").distinct().join(group, "_key")
            .groupBy("_group").agg(F.min(F.struct("doc_id", "_key")).alias("first")).select("first._key"))
    one_each = with_id.join(stored(kept, "kept"), "_key").dropDuplicates(["_key"])
    return _documents(one_each).unionByName(rows.where("doc_id IS NULL").dropDuplicates(["text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go; null texts stay. Rows are told
    apart by id and text, so rows without doc_id are decided too."""
    rows = _documents(docs).withColumn("_key", F.xxhash64("doc_id", "text"))
    found = positional_index.decontaminate(rows.select(F.col("_key").alias("doc_id"), "text"), Tables(spark, sf_dir).benchmark)
    hit = stored(found.where("size(spans) > 0").select(F.col("doc_id").alias("_key")).distinct(), "contaminated")
    return _documents(rows.join(hit, "_key", "left_anti"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of ids, digests of the ids and of the text they decode to."""
    return piece_bpe.encode_digests(_documents(docs), piece_bpe.model_path())


STAGES = [
    ("toxicity", toxicity),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

# Learned stages and encoding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written and read again."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
