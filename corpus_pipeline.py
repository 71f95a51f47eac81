"""From raw documents to token ids: quality rules, near-duplicates, decontamination, secrets, BPE.

Each stage is a function of (spark, docs, sf_dir); ``run`` writes the result of each as Parquet in the
shared folder and gives what it reads back to the next one, so a lost executor never costs more than
the stage at work. All stages but the last return the columns of ``documents``; the last adds
``ids``, ``n_tokens`` and ``round_trip``, whether decoding the ids gives back the text.

Null and empty texts fail the quality rules; extra columns are carried along, but for ``n_chars``, which the
secret scan sets anew, and columns named like those of the last stage, which it replaces; repeated rows and equal
texts are near-duplicates of each other, of which the first by id stays, and of one id one row; texts
of any length are taken whole; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import bpe, secrets, simhash, weak_rules, winnowing
from tickloom.llm.common import packed, read
from tickloom.llm.queries import multilingual_ranks
from tickloom.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighted rules reject go."""
    return weak_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return winnowing.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.redact(docs, multilingual_ranks(), public_tokenizers.PATTERN)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, checked by decoding them."""
    encoded = packed(docs, found=bpe.round_trip(docs["text"], multilingual_ranks()))
    same = F.col("found.decoded") == F.coalesce(F.col("row.text"), F.lit("")).cast("binary")
    own = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("ids", "n_tokens", "round_trip")]
    return encoded.select(*own, "found.ids", F.size("found.ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_duplicates", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("byte_level_bpe", tokens),
]

#: Expectation-maximisation, XXH64 fingerprints and BPE have no SQL form; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
