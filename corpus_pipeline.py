"""Documents to token IDs in stages; each one reads what the stage before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from leadsieve.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from leadsieve.llm.common import staged

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

#: Shares of tokens by domain. Rates are 1 at least, so that no clean document is lost: domains that fall short repeat,
#: as often as the shares need.
TARGETS = {"quality=1,toxic=0": 0.95, "quality=0,toxic=0": 0.05}
RATES = {"least": 1.0, "most": 4.0, "reach": True}


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, _labels(spark, sf_dir)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal without white space, one document stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by five-word similarity of 0.8 or more, one stays."""
    return ngram_join.drop_near_copies(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of domains below their target share repeat."""
    return mixing.mixed_rows(docs, mixing.fit(docs, _labels(spark, sf_dir)), TARGETS, **RATES)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token IDs of each row and the text decoded from them, as digests."""
    return bpe.encode_digests(docs, WORD_BPE)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies),
          ("mixing", mix_domains), ("BPE", encode)]

#: Stages score, cluster and tokenise; SQL has no form for them. Tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name.replace(" ", "-"))
    return docs
