"""The corpus pipeline: stages over the whole ``documents`` table, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from muster.llm import byte_bpe, decontamination, line_dedup, minhash_dedup, quality_rules
from muster.llm.tables import table
from muster.session import scratch, shared_folder

#: (name, function); a function takes (spark, docs, folder) and returns a DataFrame. All but the last
#: return the columns of ``documents``.
STAGES = [
    ("quality_rules", quality_rules.stage),
    ("line_dedup", line_dedup.stage),
    ("minhash_dedup", minhash_dedup.stage),
    ("decontamination", decontamination.stage),
    ("byte_bpe", byte_bpe.stage),
]

#: EM weights, near-duplicate components and byte-level merges are no SQL; the tests hold the result
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on all rows that the one before kept.

    What a stage stores for itself is deleted once its result is written.
    """
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        path = shared_folder(spark, f"pipeline-{name}")
        with scratch(spark):
            kept = function(spark, docs, sf_dir)
            kept.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
