"""The corpus pipeline: from documents to packed sequences, in five stages that each read what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
import public_tokenizers

from shelfledger.llm import decontamination, languages, near_duplicates, packing, substrings
from shelfledger.llm.common import configured
from shelfledger.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document in sequences of 4096 ids; see packing.pack."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [(name, configured(function)) for name, function in (
    ("languages", languages.stage_languages),
    ("near_duplicates", near_duplicates.stage_near_duplicates),
    ("substrings", substrings.stage_substrings),
    ("decontamination", decontamination.stage_decontamination),
    ("packing", pack_sequences),
)]

#: SQL can express neither the sketches nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of ``sf_dir``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*[F.col(c) for c in COLUMNS])
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
