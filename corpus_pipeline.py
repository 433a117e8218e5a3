"""A corpus from raw documents to packed sequences: five stages, each the work of one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.llm import jaccard_join, mixing, packing, quality_ranker, secret_scan
from emberline.llm.common import written

#: A document goes if its score is under this.
QUALITY_CUT = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose pairwise quality score is above the cut; learned from `labels` outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_ranker.train(docs, labels, ~quality_ranker.held_out(), cut=QUALITY_CUT)
    score = next(name for name in ("score", *(f"score_{k}" for k in range(len(docs.columns)))) if name not in docs.columns)
    return quality_ranker.score_documents(docs, model, out=score).where(F.col(score) >= QUALITY_CUT).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts whose five-word shingles are 80 % the same."""
    return jaccard_join.one_of_each_class(docs, n=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets replaced by a mark."""
    return secret_scan.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of one stream of the mix, sources weighing their bytes to the power 0.8."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 2048 tokens, in the order of the stored stream: pieces of a length take their
    places as they come in it, and sequences are numbered by their first piece."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":  # a stored table: its files follow each other by name
        at = [F.coalesce(F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).try_cast("long"), F.lit(0).cast("long")), F.col("_metadata.row_index").cast("long")]
    else:  # the order of its partitions
        at = [F.shiftright(F.monotonically_increasing_id(), 33), F.monotonically_increasing_id()]
    stream = docs.select("doc_id", "text", at[0].alias("_part"), at[1].alias("_row"))
    return packing.pack_documents(stream, stream=("_part", "_row"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mix), ("packing", pack)]

#: Learned scores and tokens are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
