"""A training corpus from raw documents: toxic documents go, one document of
each group of near copies stays, benchmark passages and secrets are taken out
of the texts, and the rest is packed into token sequences.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; ``run`` writes each stage's result as Parquet in the shared folder
and reads it again for the next.

Cases: null and empty texts and null ids pass through the filters; of repeated
rows one stays; an empty table gives an empty result; extra columns keep their
values, whatever their names (``n_chars`` follows the text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import beside_text, rows_again, table
from keelson.llm.decontaminate import decontaminate
from keelson.llm.packing import pack, tokenizer_path
from keelson.llm.secrets import scan_secrets
from keelson.llm.simjoin import one_of_each
from keelson.llm.toxicity import accepted
from keelson.session import work_dir

#: a document is dropped when test items cover more of its words than this
MAX_COVERAGE = 0.8
#: near copies share this much of the union of their sets of shingles of so many words
NEAR_WORDS, NEAR_PERCENT = 5, 80


def with_length(docs: DataFrame) -> DataFrame:
    """``docs`` with its text's length where it is kept."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, size=NEAR_WORDS, percent=NEAR_PERCENT)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = docs.select("doc_id", "text", *beside_text(docs))
    found = decontaminate(named, table(spark, sf_dir, "benchmark"), max_coverage=MAX_COVERAGE, keep=tuple(named.columns))
    return with_length(rows_again(found.filter(~F.col("rejected")), docs, F.col("clean")))


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = scan_secrets(docs, carry=(*beside_text(docs), F.col("text").alias("own")))
    return with_length(rows_again(found, docs, F.coalesce("clean", "own")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("benchmark_passages", drop_benchmark_passages),
    ("secrets", drop_secrets),
    ("packing", pack_sequences),
]

# classifier, lexer and tokenizer are beyond SQL: tests/llm holds each stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = work_dir(spark, "corpus")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
