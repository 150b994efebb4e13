"""From raw documents to packed training sequences, one operator per stage.

Every stage gets all that its predecessor kept and has its operator decide; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import mixing, near_dups, packing, quality_model, suffix_dedup
from tripmart.llm.shared import written

THRESHOLD = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from ``labels``, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.classify(docs, labels).where(F.col("score") >= THRESHOLD).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row, that with the smallest id; rows without words stay."""
    return near_dups.survivors(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier text (or an earlier place) has."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    cut = suffix_dedup.without_repeats(docs, keep=others, as_text=True)
    return cut.withColumns({"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix of sources takes it."""
    return mixing.repeated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the packed sequences."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_dedup),
    ("suffix-array dedup", passage_dedup),
    ("entropy-balanced mix", mix),
    ("best-fit packing", pack),
]
#: Learnt scores, minhash links and packing have no SQL form; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
