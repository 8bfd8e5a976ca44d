"""Corpus pipeline: five stages from raw documents to token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's documents. All but the last return the
columns of the documents. Each stage works on all rows its predecessor kept:

1. toxicity: documents scored 0.5 or more go.
2. near copies: of each group of similar documents the one with the smallest id stays.
3. decontamination: documents with words of a benchmark window go.
4. mixing: each source's prefix of a seeded order, up to its token budget.
5. tokens: ids of every document in the token store, read back.

Rows that repeat a doc_id are documents of their own in the first three stages (an
exact repeat goes as a near copy in the second), and null or empty texts pass
them; extra columns are kept up to the fourth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palmyra.llm import decontaminate, mixing, ngram_join, token_store, toxicity
from palmyra.llm.common import prepare_workers
from palmyra.llm.queries import MIX_SHARE, MIX_WEIGHTS, domain_of, table
from palmyra.sources.writers import cut_lineage, scratch_path


#: The workers of this stage have served the stages before, so it remembers less.
CACHE_PIECES = 200_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare_workers(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare_workers(spark)
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare_workers(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One epoch, so no document comes twice."""
    return mixing.mix(docs, F.col("all_tokens") * MIX_SHARE, MIX_WEIGHTS, domain_of()).select("doc.*")


def store_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare_workers(spark)
    out = scratch_path(spark, "tokens")
    token_store.write_tokens(docs, out, cache_pieces=CACHE_PIECES)
    return token_store.read_tokens(spark, out, with_ids=False)


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies),
          ("decontamination", drop_contaminated), ("mixing", mix_sources),
          ("tokens", store_tokens)]

#: The first stage's model is not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
