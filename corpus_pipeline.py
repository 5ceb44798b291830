"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again for the next. All but the
last return the columns of documents; the last returns one row per piece of a sequence.
"""

from pyspark.sql import DataFrame, SparkSession

from skygauge.llm import langid, minhash, packing, quality, suffix
from skygauge.store import landed

STAGES = [
    ("quality", quality.stage),
    ("language", langid.stage),
    ("near_dedup", minhash.stage),
    ("string_dedup", suffix.stage),
    ("packing", packing.stage),
]

#: compression, factor models and suffix sorting are beyond SQL; tests/llm compares the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
