"""The corpus pipeline: five stages from raw documents to packed token rows.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
it kept; its result is written as Parquet and read again as the next one's
``docs``. All stages but the last return the columns of ``documents``.

Defined cases, in all stages: an empty table gives an empty result; extra
columns are kept by all stages but the last (names that begin with two
underscores belong to the stages); rows are told apart by position, so
repeated rows are kept or dropped one by one as stated below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.llm import decontaminate, jaccard, mixing, packing, toxicity
from doclake.llm.common import shared_folder, write_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the factorization machine scores 0.5 or more.

    Null and empty texts get the machine's bias as score; without any labelled
    row nothing is rejected; null ids are never training rows."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_texts(docs, model).filter(F.col("__score") < 0.5).drop("__score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by 5-word shingles, similarity 0.8:
    the one with the smallest id (null ids last), of equal rows one. Documents
    without words, null ones too, are linked with nothing and all stay."""
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a 10-word window of a benchmark item (an item
    of fewer words whole). Null texts and null items match nothing."""
    found = decontaminate.matched(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), slop=0)
    return found.filter(F.size("__matches") == 0).drop("__matches", "__n_words")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out whole documents so that sources meet their target
    weights. Null is a source of its own, the last one; documents without words
    have no share in any target and stay once. Rows equal in id and text share
    their copies evenly."""
    return mixing.repeat_documents(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token ids as packed matrices; one row per matrix row. Null and
    empty texts have no tokens; overlong ones are split without loss."""
    return packing.pack(docs, shared_folder(spark, "packed"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("token_packing", pack_tokens),
]

#: A trained score and a schedule have no SQL form; the tests hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
