"""Expressions and helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LAST = (1 << 63) - 1  # stands for a null id: larger than any other
WHITE = r"\x20\x09-\x0D"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower case of A-Z alone; pure ASCII texts take the fast built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def matches(text: Column, pattern: str) -> Column:
    """All matches of ``pattern`` in order; none for a null text."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(0)), F.array().cast("array<string>"))


def white_words(text: Column) -> Column:
    """Words between runs of space, tab, line and page breaks; none for a null text."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, f"[{WHITE}]+")).otherwise(F.array().cast("array<string>"))


def text_key(text: Column) -> list[Column]:
    """Two independent 64-bit hashes; rows with equal texts share them, whatever their ids."""
    return [F.xxhash64(text).alias("key_a"), F.xxhash64(F.lit("text"), text, F.octet_length(text)).alias("key_b")]


def packed(rows: DataFrame, **named: Column) -> DataFrame:
    """``rows`` as one struct column ``row`` beside the ``named`` columns, so no name can clash."""
    return rows.select(F.struct(*[rows[f"`{c}`"] for c in rows.columns]).alias("row"), *[c.alias(n) for n, c in named.items()])


def identified(docs: DataFrame, text: str) -> DataFrame:
    """``id`` (null as ``LAST``), ``key`` (hash of the text) and ``content`` of every row."""
    content = F.col(f"`{text}`")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(content).alias("key"), content.alias("content"))


def sampled(rows: DataFrame, key: Column, most: int) -> DataFrame:
    """At most ``most`` rows, those of least hash; a hash filter leaves about twice as many to be ordered.

    So what reaches the driver has a fixed size, whatever the number of rows or partitions.
    """
    total, steps = rows.count(), 1 << 30
    share = min(steps, 2 * most * steps // max(total, 1))
    return rows.filter(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(steps)) < share).orderBy(F.xxhash64(key), key).limit(most)


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)
