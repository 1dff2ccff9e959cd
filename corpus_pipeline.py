"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next stage's docs.
All but the last return the columns of documents. Rejected: texts without a language. Dropped: all but one of each group of
near-duplicates. Changed: secrets are masked. Repeated or left out: what the mix says. Last: token pieces in sequences.

Rows that repeat a doc_id stay or go together; rows without a doc_id take part in every stage and are no near-duplicates of others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm import languages, mixing, neardup, packing, secrets
from tallywright.llm.common import cut, fresh_folder, read

#: a document is rejected if its main language holds less than this share of its letters
LEAST_SCORE = 0.4
#: near-duplicates of the pipeline share this much of their shingles of so many words; op9 has a contract of its own
WIDTH, SIMILARITY_PCT = 5, 80


#: rows of a batch given to Python; texts may be long, and a batch is held several times over in a task
BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    rows = languages.labelled(docs, languages.fit(languages.training_rows(docs)), carry=docs.columns)
    return rows.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    rows = neardup.near_duplicates(docs, WIDTH, SIMILARITY_PCT)
    gone = cut(rows.where("NOT kept").select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs, length="n_chars")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

# shingle similarity, Viterbi paths and a tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        path = fresh_folder(spark, f"stage-{name}")
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
