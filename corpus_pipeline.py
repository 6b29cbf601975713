"""The corpus pipeline: documents in, encoded documents of the mix out, in stages that each write a table.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all rows that its predecessor kept. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticklake.llm import pipeline_stages as stages
from ticklake.llm.common import read_table, settle

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("line dedup", stages.drop_lines),
    ("near dedup", stages.drop_near_copies),
    ("mixing", stages.mix_sources),
    ("byte-level BPE", stages.encode_texts),
]

#: The classifier and the sketches have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"))
    return docs
