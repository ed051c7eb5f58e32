"""The corpus pipeline: from raw documents to a mixed, encoded training set.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's result as Parquet and hands the reread table to the next. All stages but the
last return the columns of ``documents``. A row whose text is null passes the first
three stages unchanged; it has no words, so the mix takes no copy of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantagrid.llm import lines, mixing, neardup, pieces, toxicity
from vantagrid.llm.common import WORD, Scratch, table, unused


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it is trained on the documents that reach this stage."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go; ``n_chars`` follows the text. A document that has words, all of them in such chunks, is a copy and goes."""
    told = unused(docs, "lines")
    cleaned = lines.deduplicated(docs, into=told)
    lost = F.col(f"{told}.chunks") > 0
    n = F.when(lost, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.where(~lost | F.col("text").rlike(WORD)).withColumn("n_chars", n).drop(told)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the least id; documents without words are in no group and stay. Shingles are those of the operator's query."""
    return neardup.representatives(docs, shingle=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, ids): the pieces of each text of the mix, a row for each copy."""
    return pieces.encoded(docs, carried=("source",))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", keep_one_of_each),
    ("source mix", mix_sources),
    ("pieces", encode),
]

#: Trained scores and seeded merges have no SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir))
    return docs
