"""The training-data pipeline: five stages over documents, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.op1_source_mixing import mix
from tidemark.llm.op6_language_id import UNKNOWN, identify, train_profiles
from tidemark.llm.op8_jaccard_join import one_of_each
from tidemark.llm.op9_binary_output import tokenizer_path, tokens_out
from tidemark.llm.op10_decontamination import without_leaks
from tidemark.llm.store import documents, fresh
from tidemark.session import ship

#: A document whose best profile fits worse than this is in none of the languages.
LEAST_SCORE = 0.35
#: Chunks that a worker of the last stage remembers until its file is written: other stages may follow in the same worker.
REMEMBERED = 400_000


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the whole row, so that no column of it clashes with an operator's."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose text is in one of the labelled languages."""
    ship(spark)
    named = identify(_packed(docs), train_profiles(docs), keep=["row"])
    return named.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    ship(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    ship(spark)
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    ship(spark)
    mixed = mix(_packed(docs), F.array("row.source"))
    return mixed.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def binary_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records in files, and what they hold."""
    ship(spark)
    return tokens_out(docs, tokenizer_path(), cache=REMEMBERED, forget=True)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("binary_output", binary_output),
]
#: Profiles, selection by hash and token ids are not SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = fresh(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
