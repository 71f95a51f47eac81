"""Documents drawn by importance towards a target distribution of hashed n-grams.

A feature is a run of 1 to ``longest`` consecutive words; its bucket is the CRC-32 of its bytes modulo
``buckets``. Corpus and target are counted by bucket; the gain of a bucket is the logarithm of its
smoothed share in the target over that in the corpus, and the weight of a document is the sum of the
gains of its features. With Gumbel noise by document, the highest scores are a draw without
replacement in proportion to the importance.

No n-gram is put together as a string. Each document, its words lower-case and joined by one space, is
scanned once for its running CRC at every word end. A CRC is linear over GF(2): that of ``B`` is that
of ``AB`` with that of ``A``, shifted by the length of ``B``, cancelled. So the CRC of any n-gram follows
from two prefixes, in arrays over all words of a batch.

Counts are added up inside each task first: at most ``buckets`` rows leave a task, and the table of
gains, of ``buckets`` whole numbers, is all that reaches the driver and the workers. Ranks come from
a range partitioning by score, so no task orders all documents.

Defined cases: a null or empty text has no words, no features and weight 0; a null id draws its noise from
the empty string and sorts last among ties; repeated rows are counted and drawn each; with an empty
target or corpus the smoothing alone gives the gains; extra columns are carried along in ``row``.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import LAST
from tickloom.llm.licenses import word_octets
from tickloom.operators.skew import with_row_index

GAIN_UNIT = 1000
CHUNK_OCTETS = 1 << 23
_ONES = np.uint32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    """What the CRC register becomes after one more byte, by its low byte (reflected CRC-32)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


BYTE = _byte_table()


def _image(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map over GF(2), given as one table for each byte, applied to every ``crc``."""
    return tables[0][crc & 255] ^ tables[1][(crc >> 8) & 255] ^ tables[2][(crc >> 16) & 255] ^ tables[3][crc >> 24]


def _shifts(count: int) -> list[np.ndarray]:
    """Tables of the shifts by 1, 2, 4, ... zero bytes."""
    each = np.arange(256, dtype=np.uint32)
    values = [each << np.uint32(8 * i) for i in range(4)]
    found = [np.stack([(v >> np.uint32(8)) ^ BYTE[v & 255] for v in values])]
    while len(found) < count:
        found.append(np.stack([_image(found[-1], t) for t in found[-1]]))
    return found


SHIFTS = _shifts(32)


def shifted(crc: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Every CRC moved on by ``sizes`` zero bytes."""
    found, bit = crc, 0
    while (sizes >> bit).any():
        found = np.where((sizes >> bit) & 1, _image(SHIFTS[bit], found), found)
        bit += 1
    return found


def gram_crcs(texts: list[list[bytes]], longest: int) -> tuple[np.ndarray, np.ndarray]:
    """CRC of every n-gram of all texts, and the number of the text it belongs to."""
    counts = np.fromiter(map(len, texts), np.int64, len(texts))
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    # one scan a text, a space before each word
    running = itertools.chain.from_iterable(itertools.accumulate(words, lambda crc, w: zlib.crc32(b" " + w, crc), initial=0) for words in texts)
    held = np.fromiter(running, np.uint32, total + len(texts))
    text = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(total) + text  # of the prefix before each word
    before = held[place]
    # past the space: one byte more on the register itself, which the CRC holds inverted
    register = before ^ _ONES
    opened = ((register >> np.uint32(8)) ^ BYTE[(register ^ np.uint32(0x20)) & 255]) ^ _ONES
    sizes = np.fromiter(map(len, itertools.chain.from_iterable(texts)), np.int64, total)
    through = np.cumsum(sizes + 1)
    found, homes = [], []
    for n in range(1, longest + 1):
        first = np.flatnonzero(text[: total - n + 1] == text[n - 1 :])
        last = first + n - 1
        length = through[last] - through[first] + sizes[first]
        found.append(held[place[last] + 1] ^ shifted(opened[first], length))
        homes.append(text[first])
    return np.concatenate(found), np.concatenate(homes)


def _parts(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """Words of the texts, in runs of bounded size."""
    held, size = [], 0
    for value in texts.cast(pa.binary()):
        octets = value.as_py() or b""
        if held and size + len(octets) > CHUNK_OCTETS:
            yield held
            held, size = [], 0
        held.append(word_octets(octets))
        size += len(octets)
    if held:
        yield held


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """``(bucket, n)`` over all features of ``docs``; at most ``buckets`` rows leave each task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in _parts(batch.column(0)):
                crcs, _ = gram_crcs(part, longest)
                sums += np.bincount((crcs % np.uint32(buckets)).astype(np.int64), minlength=buckets)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(sums[used], pa.int64())], ["bucket", "n"])

    return docs.select(F.col(f"`{text}`")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, text: str = "text", longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """``(bucket, gain)`` for every bucket: thousandths of the log of its share in the target over that in the corpus."""
    held = bucket_counts(corpus, text, longest, buckets).selectExpr("bucket", "n as s", "0L as t")
    asked = bucket_counts(target, text, longest, buckets).selectExpr("bucket", "0L as s", "n as t")
    every = corpus.sparkSession.range(buckets).selectExpr("id as bucket", "0L as s", "0L as t")
    sums = every.unionByName(held).unionByName(asked).groupBy("bucket").agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t"))
    totals = sums.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = ((F.col("t") + 1) * (F.col("all_s") + buckets)) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    return sums.crossJoin(totals).select("bucket", F.floor(GAIN_UNIT * F.ln(ratio)).cast("long").alias("gain"))  # one row of totals


def weigh(text: Column, table: np.ndarray, longest: int = 1) -> Column:
    """Struct of ``n_words``, ``n_features`` and ``weight`` by the gain of each bucket."""
    fields = ["n_words", "n_features", "weight"]
    size = np.uint32(len(table))

    def batch(texts: pa.Array) -> pa.Array:
        found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in fields]
        for part in _parts(texts):
            crcs, homes = gram_crcs(part, longest)
            values = table[(crcs % size).astype(np.int64)]
            order = np.argsort(homes, kind="stable") if longest > 1 else slice(None)
            through = np.concatenate([[0], np.cumsum(values[order])])
            features = np.bincount(homes, minlength=len(part))
            ends = np.cumsum(features)
            for held, numbers in zip(found, (np.fromiter(map(len, part), np.int64, len(part)), features, through[ends] - through[ends - features])):
                held.append(numbers)
        return pa.StructArray.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in found], fields)

    batch.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(batch, "struct<n_words: long, n_features: long, weight: long>").asNondeterministic()(text)


def gumbel(seed: int, identity: Column) -> Column:
    """Whole thousandths of standard Gumbel noise from the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit(""))).cast("binary"), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-GAIN_UNIT * F.ln(-F.ln(share))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    text: str = "text",
    identity: str = "doc_id",
    longest: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """``row`` (all columns, or those of ``carry``), ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of every document.

    ``percent`` of the documents of ``least_words`` or more are drawn, those of the highest scores, ties
    to the smaller id; ``rank`` counts them from 1 and is null for the others.
    """
    found = gains(docs, target, text, longest, buckets).collect()  # ``buckets`` rows
    table = np.zeros(buckets, np.int64)
    for bucket, gain in found:
        table[bucket] = gain
    own = docs[f"`{identity}`"]
    weighed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in carry or docs.columns]).alias("row"),
        F.coalesce(own.cast("long"), F.lit(LAST)).alias("__id"),
        gumbel(seed, own).alias("noise"),
        weigh(docs[f"`{text}`"], table, longest).alias("found"),
    ).select("row", "__id", "found.*", (F.col("found.weight") + F.col("noise")).alias("score"))
    sorted_by = weighed.withColumns({"__short": F.col("n_words") < least_words, "__down": -F.col("score")})
    ordered = with_row_index(sorted_by, ["__short", "__down", "__id"], name="__place")
    able = ordered.agg(F.floor(F.count_if(~F.col("__short")) * percent / 100).alias("__drawn"))
    drawn = ~F.col("__short") & (F.col("__place") < F.col("__drawn"))
    return ordered.crossJoin(able).select(  # one row
        "row", "n_words", "n_features", "weight", "score", F.when(drawn, F.col("__place") + 1).alias("rank")
    )
