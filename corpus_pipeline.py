"""Training corpus pipeline: each stage takes the documents that the one before kept.

run() writes every stage's result as Parquet into the shared folder and rereads
it. All stages but the last return the columns of documents, other columns
included. After mixing, a document stands once for each epoch that takes it.

Defined results (each operator's docstring has its own): a null or empty text has
under 10 words, so the quality rules drop it; repeated rows are near duplicates,
and one of them stays, the least by (doc_id, text hash) of its group; a null
doc_id comes before all others there, is like others in mixing and stands first in
the shards; a null lang or source is the empty one; ties in mixing go by the
seeded key of the doc_id; very long texts are worked on whole; an empty table
gives an empty table from every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridcast.llm import decontaminate, jaccard, mixing, quality, tokens
from gridcast.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the repetition rules reject."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that 5-word shingle Jaccard links of 0.8 connect."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, exact or edited."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the hierarchical budget takes, once per epoch."""
    return mixing.mix_documents(docs)[0].select(*docs.columns)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Grammar-compressed token shards of what is left, read back per document."""
    return tokens.tokenize(docs, tokens.default_tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixture),
    ("token_shards", token_shards),
]

#: The last stage runs a tokenizer, which SQL cannot express; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of sf_dir; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
