"""The registered queries of this subpackage, and the SQL that checks those it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import (
    bpe,
    chat,
    html_crf,
    licenses,
    periodic_runs,
    phrases,
    ranking,
    resampling,
    secrets,
    simhash,
    suffix_dedup,
    weak_rules,
    winnowing,
)
from tickloom.llm.common import let, read, sha256_hex, white_words


def multilingual_ranks() -> str:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again, as counts and digests."""
    tokens = read(spark, folder, "documents").select("doc_id", bpe.round_trip(F.col("text"), multilingual_ranks()).alias("found"))
    return tokens.select(
        "doc_id",
        F.size("found.ids").cast("long").alias("n_tokens"),
        sha256_hex(F.array_join(F.col("found.ids").cast("array<string>"), ",")).alias("ids_sha256"),
        sha256_hex("found.decoded").alias("decoded_sha256"),
    )


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside a ten-word window of a benchmark item, and the items found."""
    found = winnowing.decontaminate(read(spark, folder, "documents"), read(spark, folder, "benchmark"), carry=["doc_id"])
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        sha256_hex(F.array_join("item_ids", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP2_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark),
bw as (
  select distinct item_id, least(len(words), 10) as width, array_to_string(words[i : i + least(len(words), 10) - 1], ' ') as win
  from (select *, unnest(range(1, len(words) - least(len(words), 10) + 2)) as i from b where len(words) > 0)),
widths as (select distinct width from bw),
dw as (
  select doc_id, width, i, array_to_string(words[i : i + width - 1], ' ') as win
  from (select doc_id, width, words, unnest(range(1, len(words) - width + 2)) as i from d, widths where len(words) >= width)),
hits as (select distinct doc_id, i, width, item_id from dw join bw using (width, win)),
hit_words as (
  select doc_id, count(*) as n_hit
  from (select distinct doc_id, unnest(range(i, i + width)) as at from (select distinct doc_id, i, width from hits)) group by doc_id),
hit_items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select d.doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit_words using (doc_id) left join hit_items using (doc_id)
"""


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document inside a 400-byte string that also starts elsewhere."""
    kept = suffix_dedup.remove_repeats(read(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", sha256_hex("kept").alias("kept_sha256"))


def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn of every conversation, rendered once for each of its speakers."""
    return chat.rotate(read(spark, folder, "conversations"))


OP4_SQL = r"""
with t as (
  select conv_id, turn, coalesce(nullif(role, ''), 'unknown') as speaker, coalesce(text, '') as content from conversations),
n as (
  select *, row_number() over (partition by conv_id order by turn nulls first, speaker, content) - 1 as place from t),
v as (select distinct conv_id, speaker as perspective from t where speaker <> 'system'),
r as (
  select n.conv_id, perspective, place, content,
    case when speaker = 'system' then 'system' when speaker = perspective then 'assistant' else 'user' end as role,
    case when speaker not in ('system', perspective) then speaker end as name
  from n join v on n.conv_id is not distinct from v.conv_id),
h as (select *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) as head from r),
s as (select *, head || content || '<|im_end|>' || chr(10) as segment from h),
o as (select *, sum(length(segment)) over (partition by conv_id, perspective order by place) as past from s)
select conv_id, perspective, place, role, name, segment, cast(past - length(segment) as bigint) as first, cast(past as bigint) as past,
  cast(case when role = 'assistant' then past - length(segment) + length(head) end as bigint) as loss_first,
  cast(case when role = 'assistant' then past - 1 end as bigint) as loss_past
from o
"""


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document: three-word shingles, at most three differing bits."""
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside a 13-word window that a document of smaller id has too."""
    kept = phrases.remove_repeats(read(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", sha256_hex("kept").alias("kept_sha256"))


OP6_SQL = r"""
with d as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents),
w as (select doc_id, i, array_to_string(words[i : i + 12], ' ') as win
  from (select *, unnest(range(1, len(words) - 11)) as i from d where len(words) >= 13)),
f as (select win, min(doc_id) as low from w group by win),
hit as (select distinct doc_id, unnest(range(i, i + 13)) as spot from (select doc_id, i from w join f using (win) where low < doc_id)),
gone as (select doc_id, list(spot) as places, count(*) as n from hit group by doc_id)
select d.doc_id, cast(len(words) as bigint) as n_words, coalesce(n, 0) as n_removed,
  sha256(array_to_string(case when n is null then words
    else list_filter(words, lambda x, j: not list_contains(places, j)) end, ' ')) as kept_sha256
from d left join gone using (doc_id)
"""


def _joined(found, kinds: tuple[str, ...]):
    kept = F.filter(found, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["first"], s["past"])), ",")


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secret spans of every document; the digest covers the fixed patterns alone."""
    found = secrets.spans(F.col("text"), multilingual_ranks(), public_tokenizers.PATTERN)
    scanned = read(spark, folder, "documents").select("doc_id", found.alias("found"))
    return scanned.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(found, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in secrets.KINDS],
        sha256_hex(_joined(F.col("found"), secrets.KINDS[:3])).alias("base_sha256"),
        _joined(F.col("found"), secrets.KINDS).alias("spans"),
    )


def op8_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, learned from three quarters of the labelled ids."""
    train = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    scored = ranking.score(read(spark, folder, "documents"), read(spark, folder, "labels"), train)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "score", (F.col("score") >= ranking.CUT).cast("int").alias("predicted"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base measures of every document and the verdict of the weighted rules."""
    judged = weak_rules.judge(read(spark, folder, "documents"), keep_row=False)
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good"
    )


def op10_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = read(spark, folder, "pages")
    text = html_crf.main_text(F.col("html"), html_crf.train(pages))
    return pages.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op11_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices of every document; base places are the unchanged ones of three phrases."""
    found = read(spark, folder, "documents").select("doc_id", licenses.find(F.col("text")).alias("found"))
    with_base = found.select("doc_id", "found.*", F.expr("filter(found.spans, s -> s.base and s.errors = 0)").alias("base"))

    def labels(spans: str):
        return F.array_join(F.array_sort(F.array_distinct(F.col(f"{spans}.label"))), ",")

    return with_base.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.first_word").alias("first_word"),
        F.array_max("base.first_word").alias("last_word"),
        labels("base").alias("base_labels"),
        labels("spans").alias("labels"),
        F.coalesce(F.array_max("spans.similarity"), F.lit(0.0)).alias("score"),
    )


def _repeating(words, identity):
    """In a tenth of the documents the words from a hashed place on repeat a stretch of themselves."""

    def planted(w):
        h = F.crc32(identity.cast("string").cast("binary"))
        n, g = F.size(w), F.floor(h / 10)

        def spread(start):
            period = F.floor((n - start) / (3 + g % 8)) + 1
            later = F.sequence(F.lit(0), n - start - 1)
            return let(period, lambda p: F.concat(F.slice(w, 1, start), F.transform(later, lambda i: F.get(w, (start + i % p).cast("int")))))

        return F.when((h % 10 == 0) & (n > 0), let((g % n).cast("int"), spread)).otherwise(w)

    return let(words, planted)


def op12_periodic(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words of every document, a tenth of them made to repeat, and the texts that collapsing leaves."""
    documents = read(spark, folder, "documents")
    words = documents.select("doc_id", _repeating(white_words(F.col("text")), F.col("doc_id")).alias("words"))
    found = words.select("doc_id", "words", periodic_runs.find(F.col("words")).alias("found"))
    longest = F.expr(
        "array_max(transform(found.runs, r -> struct(r.length as length, -r.start as before, -r.period as shortest)))"
    )
    listed = F.transform("found.runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("found.runs").cast("long").alias("n_runs"),
        longest.alias("longest"),
        sha256_hex(F.array_join(listed, "")).alias("runs_sha256"),
        sha256_hex(periodic_runs.collapsed(F.col("words"), F.col("found.kept"))).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        (-F.col("longest.before")).alias("start"),
        "longest.length",
        (-F.col("longest.shortest")).alias("period"),
        F.expr("1000 * longest.length div -longest.shortest").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op13_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Every document weighed by single words against the benchmark, and a tenth of the longer ones drawn."""
    drawn = resampling.resample(read(spark, folder, "documents"), read(spark, folder, "benchmark"), carry=["doc_id"])
    return drawn.select("row.doc_id", "n_features", "weight", "score", "rank")


OP13_SQL = r"""
with table_steps as (
  select i, list_reduce(list_prepend(i::bigint, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end) as entry from range(256) t(i)),
entries as (select list(entry order by i) as crc_table from table_steps),
d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
b as (
  select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark),
dw as (select doc_id, unnest(words) as word from d),
bw as (select unnest(words) as word from b),
dn as (select word, count(*) as s from dw group by word),
bn as (select word, count(*) as t from bw group by word),
octets as (
  select word, hex(encode(word)) as h from (select word from dn union select word from bn)),
crcs as (
  select word, xor(list_reduce(list_prepend(4294967295::bigint,
      list_transform(range(1, strlen(h) + 1, 2), lambda k: ('0x' || substr(h, k, 2))::bigint)),
    lambda c, o: xor(c >> 8, crc_table[(xor(c, o) & 255) + 1])), 4294967295::bigint) % 10000 as bucket
  from octets, entries),
counted as (
  select bucket, coalesce(sum(s), 0)::double as s, coalesce(sum(t), 0)::double as t
  from crcs left join dn using (word) left join bn using (word) group by bucket),
totals as (select coalesce(sum(s), 0) as all_s, coalesce(sum(t), 0) as all_t from counted),
gains as (select bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::bigint as gain from counted, totals),
weights as (select doc_id, sum(gain)::bigint as weight from dw join crcs using (word) join gains using (bucket) group by doc_id),
scored as (
  select doc_id, len(words)::bigint as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from d left join weights using (doc_id)),
ranked as (select *, n_features >= 20 as able, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place from scored)
select doc_id, n_features, weight, score,
  case when able and place <= (select count(*) from scored where n_features >= 20) * 10 // 100 then place end as rank
from ranked
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": op1_bpe,
        "op2_decontamination": op2_decontamination,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_chat": op4_chat,
        "op5_simhash": op5_simhash,
        "op6_phrases": op6_phrases,
        "op7_secrets": op7_secrets,
        "op8_ranking": op8_ranking,
        "op9_quality_rules": op9_quality_rules,
        "op10_html": op10_html,
        "op11_licenses": op11_licenses,
        "op12_periodic": op12_periodic,
        "op13_resampling": op13_resampling,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": OP2_SQL, "op4_chat": OP4_SQL, "op6_phrases": OP6_SQL, "op13_resampling": OP13_SQL}
