"""The pipeline, stage by stage, against plain Python decisions on each stage's own input."""

from __future__ import annotations

import public_tokenizers

import corpus_pipeline
from test_texts import hits_by_hand
from tickloom.llm import secrets, simhash
from tickloom.llm.queries import multilingual_ranks
from tickloom.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_stage(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    held, seen = {}, {}
    for name, apply in corpus_pipeline.STAGES:
        before = docs
        docs = stage(apply(spark, docs, tables), name)
        assert docs.columns[:5] == COLUMNS
        held[name], seen[name] = docs.toPandas().set_index("doc_id"), before.toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{tables}/labels.parquet").toPandas().set_index("doc_id")["quality"]

    long_good = [i for i in labels.index[labels == 1] if len(seen["quality_rules"].loc[i, "text"].split()) >= 50]
    assert held["quality_rules"].index.isin(long_good).sum() >= 0.99 * len(long_good)

    before, after = seen["simhash_near_duplicates"], held["simhash_near_duplicates"]
    prints = {i: simhash.text_fingerprint(t) % (1 << 64) for i, t in before["text"].items()}
    forest = simhash.Forest()
    for i in prints:
        for j in prints:
            if j < i and (prints[i] ^ prints[j]).bit_count() <= 3:
                forest.tie(i, j)
    least = {}
    for i in sorted(prints):
        least.setdefault(forest.top(i), i)
    assert sorted(after.index) == sorted(least.values())

    before, after = seen["benchmark_decontamination"], held["benchmark_decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    clean = [i for i, (_, hit, _) in zip(before.index, hits_by_hand(before["text"], items)) if not hit]
    assert sorted(after.index) == sorted(clean)

    before, after = seen["secret_scan"], held["secret_scan"]
    assert sorted(after.index) == sorted(before.index)
    for i, text in before["text"].items():
        spans = secrets.scan(text, multilingual_ranks(), public_tokenizers.PATTERN)
        assert (after.loc[i, "text"] == text) == (not spans)
        assert all(text[a:b] not in after.loc[i, "text"] for _, a, b in spans)

    last = held["byte_level_bpe"]
    assert last["round_trip"].all() and (last["n_tokens"] == last["ids"].map(len)).all() and len(last) == len(after)


def test_odd_and_empty(spark, tables, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, apply in corpus_pipeline.STAGES:
            columns, docs = docs.columns, stage(apply(spark, docs, tables), name)
            assert [c for c in columns if c not in ("ids", "n_tokens", "round_trip")] == [c for c in docs.columns if c in columns and c not in ("ids", "n_tokens", "round_trip")]
