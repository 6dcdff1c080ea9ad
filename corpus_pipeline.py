"""A training corpus from the raw documents, as stages over the operators of `hackney.llm`.

Each stage gets the documents that its predecessor kept, as written and read again, and returns those
that it keeps with all their columns; the last returns the packed pieces.

1. `quality`: the classifier is fitted to the labelled documents among those it gets and not held out;
   documents that it does not predict to be good go.
2. `toxicity`: likewise; documents predicted to be toxic go.
3. `near_duplicates`: one document of each class stays, that of the least id.
4. `decontamination`: contaminated documents go.
5. `packing`: the rest is packed into sequences.

Defined results: a document without text is scored as an empty one; if it is kept, it stays through
near-duplicates and decontamination and is packed as the separator alone. A document with a null id is
judged like any other and takes no part in near-duplicates. Rows that are equal in id and text are
copies, of which one stays. Further columns are carried along as they are, up to packing. Without labels
the scores are 0.5, so no document reaches the quality threshold; that stage then rejects nothing, as it
has learned nothing. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.llm import decontaminate, near_dup, packing, quality, toxicity
from hackney.llm import queries
from hackney.llm.common import table
from hackney.session import stage

QUALITY_THRESHOLD = 0.7
TOXICITY_THRESHOLD = 0.5


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    if model.unfitted:
        return docs
    scored = quality.rows_with_score(docs, model)
    return scored.where(F.col("score") >= QUALITY_THRESHOLD).select("row.*")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    if model.unfitted:
        return docs
    scored = toxicity.rows_with_score(docs, model)
    return scored.where(F.col("score") < TOXICITY_THRESHOLD).select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.packed_pieces(docs)


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each),
    ("decontamination", uncontaminated),
    ("packing", packed),
]
#: SQL can express neither the classifiers nor the signatures; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
