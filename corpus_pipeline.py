"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last
return the columns of ``documents``.  ``run`` writes what each stage keeps to the
shared folder and reads it back as the next stage's input, so a lost executor costs
at most the work of one stage.

Quality drops what a rule rejects; near-dedup keeps one document of each group linked
at a similarity of 0.8 or more on five-word shingles; personal data is replaced by
marks, and ``n_chars`` follows; the mix takes and repeats documents until every source
has its share; packing turns what is left into sequences of 1,024 tokens.  An empty
table passes through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.mixing import mixed
from lakeops.llm.neardup import without_near_duplicates
from lakeops.llm.packing import pack
from lakeops.llm.pii import redact
from lakeops.llm.quality import quality_filter
from lakeops.session import materialise

NEAR_PERCENT = 80
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs, percent=NEAR_PERCENT)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, TOKENIZER)


STAGES = [
    ("quality_rules", keep_good),
    ("near_dedup", drop_near_copies),
    ("personal_data", hide_personal_data),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

# Hashing, token ids and the packing search are beyond SQL: tests/llm/test_corpus.py and
# tests/llm/test_stages.py hold the stages against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
