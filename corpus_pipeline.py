"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written and read again before
the next one. All but the last keep the columns of documents, and further ones, whatever their names.

Results for odd input: a null text stays null up to the near duplicates, where it counts as an empty
one, and of all empty texts one stays; repeated rows get the same score and lose the same lines, and
one of them stays; rows without doc_id go through all stages, after those with one; without labels
every score is 0.5 and no row goes for its quality; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperlode.llm import bpe, decontaminate, lines, near_dedup, quality
from paperlode.llm.common import saved, table

STAGES = [
    ("quality", quality.stage),
    ("lines", lines.stage),
    ("near_duplicates", near_dedup.stage),
    ("decontamination", decontaminate.stage),
    ("tokens", bpe.stage),
]

#: Trained scores, MinHash and byte-pair merges are beyond SQL; tests hold each stage against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of documents after all stages, as the last one gives it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
