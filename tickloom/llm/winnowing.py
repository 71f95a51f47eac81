"""Benchmark decontamination by winnowing, in DataFrame operations alone.

A text is its words. Of every window of ``width`` consecutive words only the least hash of its k-grams
is kept as a fingerprint, so a window that a document shares with a benchmark item always shares its
fingerprint, while a run of neighbouring windows mostly shares one. Fingerprints of documents meet
those of the benchmark in one join; every window of a run that meets is then extended to its whole
text and compared with the item's windows, so a hit is exact. An item with fewer words than a window
is one window of its own length, and fingerprints of that length are kept for it as well.

Only the run's place and least hash leave a document's row; texts are read a second time for the
documents with a meeting fingerprint. Spark's own size threshold decides whether the staged
fingerprints or items are broadcast. Texts that are copies of each other are handled once.

Defined cases: a null or empty text has no words and no hits; an empty benchmark hits nothing; items
with equal texts are all listed; rows with equal texts get equal results; null item ids are not listed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import ascii_lower, let, matches, packed, text_key
from tickloom.session import stage

WIDTH = 10
GRAM = 5
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ with each character by itself: Java looks these up in one table, ranges one after another
WORD = "[^" + "".join(f"\\x{c:02X}" for c in range(128) if not (0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A)) + "]+"
KEYS = ["key_a", "key_b"]


def plain_words(text: Column) -> Column:
    return matches(ascii_lower(text), WORD)


def _window_texts(words: Column, width: int | Column) -> Column:
    """All windows of ``width`` words as texts; none where there are fewer words."""
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - width + 1, F.lit(0)))
    return F.transform(starts, lambda w, i: F.array_join(F.slice(words, i + 1, F.lit(width)), " "))


def _runs(words: Column, width: int, gram: int) -> Column:
    """Runs of neighbouring windows with one least k-gram hash: structs of first window, windows, hash, width."""
    gram = min(gram, width)
    spread = width - gram + 1

    def count(values: Column, least: int) -> Column:
        return F.slice(values, F.lit(1), F.greatest(F.size(values) - (least - 1), F.lit(0)))

    def from_least(least: Column) -> Column:
        changes = F.filter(
            F.transform(least, lambda h, i: F.struct(i.alias("first"), h.alias("hash"))),
            lambda x: (x["first"] == 0) | (F.get(least, x["first"] - 1) != x["hash"]),
        )
        return let(
            changes,
            lambda c: F.transform(
                c,
                lambda x, i: F.struct(
                    x["first"].alias("first"),
                    (F.coalesce(F.get(c, i + 1)["first"], F.size(least)) - x["first"]).alias("windows"),
                    x["hash"].alias("hash"),
                    F.lit(width).alias("width"),
                ),
            ),
        )

    def from_grams(grams: Column) -> Column:
        def least_from(g: Column, i: Column) -> Column:
            return F.least(g, *[F.get(grams, i + j) for j in range(1, spread)]) if spread > 1 else g

        return let(F.transform(count(grams, spread), least_from), from_least)

    def from_hashes(hashes: Column) -> Column:
        def gram_hash(h: Column, i: Column) -> Column:
            return F.xxhash64(h, *[F.get(hashes, i + j) for j in range(1, gram)])

        return let(F.transform(count(hashes, gram), gram_hash), from_grams)

    return let(F.transform(words, lambda w: F.xxhash64(w)), from_hashes)


def benchmark_windows(items: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """Distinct ``(item_id, width, window)`` of all items, staged."""
    item = items.select(F.col(f"`{item_id}`").cast("string").alias("item_id"), plain_words(F.col(f"`{text}`")).alias("words"))
    sized = item.filter("size(words) > 0").select("*", F.least(F.size("words"), F.lit(width)).alias("width"))
    windows = sized.select("item_id", "width", F.explode(_window_texts(F.col("words"), F.col("width"))).alias("window"))
    return stage(windows.distinct(), "benchmark-windows")


def window_hits(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """``(key_a, key_b, first, width, item_ids)``: each window of a text that an item holds.

    ``first`` is the place of its first word from 0, the keys are those of ``text_key``.
    """
    windows = benchmark_windows(items, item_id, item_text, width)
    widths = sorted(r[0] for r in windows.select("width").distinct().collect())  # at most ``width`` values
    # an item's window has one least hash: the first of its runs
    hashed = None
    for w in widths:
        part = windows.filter(F.col("width") == w).select("width", F.explode(_runs(F.split("window", " "), w, gram)["hash"]).alias("hash"))
        hashed = part if hashed is None else hashed.union(part)
    by_window = windows.groupBy("width", "window").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    if hashed is None:
        return by_window.select(F.lit(0).cast("long").alias("key_a"), F.lit(0).cast("long").alias("key_b"), F.lit(0).alias("first"), "width", "item_ids").limit(0)
    prints = stage(hashed.distinct(), "benchmark-prints")
    content = F.col(f"`{text}`")
    words = plain_words(content)
    all_runs = let(words, lambda held: F.concat(*[_runs(held, w, gram) for w in widths]))
    runs = docs.select(*text_key(content), F.explode(all_runs).alias("run")).select(*KEYS, "run.*")
    met = stage(
        runs.join(prints, ["hash", "width"], "left_semi").groupBy(*KEYS).agg(F.collect_set(F.struct("width", "first", "windows")).alias("runs")),
        "met-runs",
    )
    texts = docs.select(*text_key(content), content.alias("content")).join(met, KEYS).dropDuplicates(KEYS)
    found = texts.select(*KEYS, plain_words(F.col("content")).alias("words"), "runs").select(
        *KEYS,
        F.explode(
            F.flatten(
                F.transform(
                    "runs",
                    lambda r: F.transform(
                        F.sequence(r["first"], r["first"] + r["windows"] - 1),
                        lambda at: F.struct(
                            r["width"].alias("width"),
                            at.cast("int").alias("first"),
                            F.array_join(F.slice("words", at + 1, r["width"]), " ").alias("window"),
                        ),
                    ),
                )
            )
        ).alias("at"),
    )
    return found.select(*KEYS, "at.*").join(stage(by_window, "item-windows"), ["width", "window"]).select(*KEYS, "first", "width", "item_ids")


def hit_words(hits: DataFrame) -> DataFrame:
    """Per text: ``spans`` of hit words (first, end), their number ``n_hit``, and the sorted ``item_ids``."""

    def merged(found: Column) -> Column:
        """Ends of the windows before a place rise with it only per width, so keep the furthest."""
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

        def step(state: Column, x: Column) -> Column:
            end = x["first"] + x["width"]
            new = F.greatest(F.lit(0), end - F.greatest(state["end"], x["first"]))
            return F.struct((state["n"] + new).alias("n"), F.greatest(state["end"], end).alias("end"))

        return F.aggregate(found, start, step, lambda state: state["n"])

    grouped = hits.groupBy(*KEYS).agg(
        F.array_sort(F.collect_set(F.struct("first", "width"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"),
    )
    return grouped.select(*KEYS, "spans", merged(F.col("spans")).alias("n_hit"), "item_ids")


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", carry: Sequence[str] | None = None, **options) -> DataFrame:
    """Every row as ``row``, with ``n_words``, ``n_hit``, ``spans`` and ``item_ids`` of its text.

    Rows travel to their hits; ``carry`` names the columns that ``row`` then holds, all by default.
    """
    content = F.col(f"`{text}`")
    found = stage(hit_words(window_hits(docs, items, text, **options)), "benchmark-hits")
    keys = dict(zip(KEYS, text_key(content)))
    carried = F.struct(*[docs[f"`{c}`"] for c in carry or docs.columns]).alias("row")
    rows = docs.select(carried, F.size(plain_words(content)).cast("long").alias("n_words"), *[c.alias(n) for n, c in keys.items()])
    return rows.join(found, KEYS, "left").select(
        "row",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        "spans",
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows without any hit, with their own columns."""
    content = F.col(f"`{text}`")
    found = window_hits(docs, items, text, **options).select(*KEYS).distinct()
    rows = packed(docs, **dict(zip(KEYS, text_key(content))))
    return rows.join(stage(found, "contaminated"), KEYS, "left_anti").select("row.*")
