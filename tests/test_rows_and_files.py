"""Row numbering, joins, scaling, file formats, images, streams, plans."""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F, types as T

from tickloom.functions.values import fill_missing_int, minmax, nan_to_null, padded_tag, to_int
from tickloom.operators import aggregate, features, joins, rows, skew
from tickloom.sources import files, tables
from tickloom.streaming import bars as streaming


def test_row_index_with_hot_and_null_keys(spark):
    hot = [("hot", i) for i in range(500)]
    rest = [(None, i) for i in range(7)] + [("b", i) for i in range(3)]
    df = spark.createDataFrame(hot + rest, "k string, v int").repartition(5)
    got = skew.with_row_index(df, ["v"], ["k"]).toPandas()
    assert len(got) == 510
    assert (got["row_idx"] == got["v"]).all()
    alone = skew.with_row_index(df.filter("k = 'hot'"), ["v"]).toPandas()
    assert sorted(alone["row_idx"]) == list(range(500))


def test_blocks_give_every_row_its_predecessors(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(100)], "k string, t int, v double")
    for size in (7, 30, 1000):
        got = features.lag_window_features(df, ["k"], ["t"], "v", lags=10, block_rows=size).toPandas()
        assert len(got) == 90
        for _, row in got.iterrows():
            assert list(row["window"]) == [float(v) for v in range(row["t"] - 10, row["t"])]


def test_lag_windows_keep_nulls(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, None), ("a", 2, 3.0)], "k string, t int, v double")
    got = features.lag_window_features(df, ["k"], ["t"], "v", lags=2).collect()
    assert [r["window"] for r in got] == [[1.0, None]]


def test_attach_keeps_rows_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("z", 3)], "k string, v int")
    stats = spark.createDataFrame([(None, 10), ("a", 20)], "k string, s int")
    inner = {(r["v"], r["s"]) for r in skew.attach(df, stats, ["k"]).collect()}
    left = {(r["v"], r["s"]) for r in skew.attach(df, stats, ["k"], how="left").collect()}
    assert inner == {(1, 10), (2, 20)}
    assert left == {(1, 10), (2, 20), (3, None)}


def test_paging_and_slices(spark):
    df = spark.createDataFrame([(i,) for i in range(13)], "id int")
    pages = rows.page_rows(df, ["id"]).toPandas().sort_values("id")
    assert pages.groupby("page")["id"].apply(list).tolist() == [list(range(5)), list(range(5, 10)), [10, 11, 12]]
    assert [r["id"] for r in rows.slice_rows(df, ["id"], 3, 6).orderBy("id").collect()] == [3, 4, 5]
    assert [r["id"] for r in rows.page_after(df, "id", 9).collect()] == [10, 11, 12]
    assert [r["id"] for r in rows.show_head(df, ["id"], n=2).collect()] == [0, 1]


def test_positional_concat_fills_the_shorter_side(spark):
    a = spark.createDataFrame([("x",), ("y",), ("z",)], "l string")
    b = spark.createDataFrame([(2,), (1,)], "r int")
    got = joins.positional_concat(a, ["l"], b, ["r"]).orderBy("row_idx").collect()
    assert [(r["l"], r["r"]) for r in got] == [("x", 1), ("y", 2), ("z", None)]


def test_cleaning(spark):
    df = spark.createDataFrame([("1,234",), (None,)], "t string")
    assert [r[0] for r in df.select(fill_missing_int("t")).collect()] == [1234, 0]
    with pytest.raises(Exception):
        spark.createDataFrame([("12a",)], "t string").select(to_int("t")).collect()
    values = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", None), (None, 9.0)], "k string, v double")
    assert [tuple(r) for r in aggregate.group_mean(values, "k", ["v"]).collect()] == [("a", 1.0)]
    assert values.filter(nan_to_null("v").isNull()).count() == 2
    tag = spark.range(1).select(padded_tag(F.lit("Make"), F.lit("x")).alias("s")).first()["s"]
    assert tag == f"{'Make':25}: x"


def test_dropna_counts_the_key_column(spark):
    df = spark.createDataFrame([(None, None), ("a", None), (None, 1.0)], "k string, v double")
    assert rows.dropna_thresh(df, 1).count() == 2


def test_scaling_round_trip_and_constant_column(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("a", 3.0, 5.0), ("a", 2.0, 5.0)], "k string, v double, c double")
    fit = features.fit_minmax(df, ["k"], ["v", "c"])
    back = features.invert_minmax(features.apply_minmax(df, fit, ["k"], ["v", "c"]), ["v", "c"]).toPandas()
    assert (back["c_scaled"] == 0).all()
    assert sorted(back["v_scaled"]) == [0.0, 0.5, 1.0]
    assert np.allclose(back["v_restored"], back["v"]) and np.allclose(back["c_restored"], 5.0)
    assert spark.range(1).select(minmax(F.lit(None).cast("double"), F.lit(0.0), F.lit(1.0))).first()[0] is None


def test_splits_are_disjoint_complete_and_repeatable(spark):
    df = spark.range(1000)
    bucket = rows.hash_bucket("id")
    first = rows.kfold(rows.split_holdout(df, bucket), rows.hash_bucket("id", buckets=5, seed=7)).toPandas()
    again = rows.split_holdout(df.repartition(7), bucket).toPandas()
    assert set(first["fold"]) == set(range(5)) and len(first) == 1000
    assert 220 < first["is_test"].sum() < 380
    assert set(first.loc[first["is_test"], "id"]) == set(again.loc[again["is_test"], "id"])


def test_bars_break_ties_by_id(spark):
    ticks = spark.sql(
        """select * from values ('a', timestamp_ntz'2024-01-01 00:10:00', 2, 5.0D), ('a', timestamp_ntz'2024-01-01 00:10:00', 1, 4.0D),
        ('a', timestamp_ntz'2024-01-01 01:00:00', 3, 1.0D) as t(s, ts, id, v)"""
    )
    got = tables.bars_from_ticks(ticks, "s", "ts", "v", "id").orderBy("date").collect()
    assert [(r["open"], r["close"], r["volume"]) for r in got] == [(4.0, 5.0, 9.0), (1.0, 1.0, 1.0)]


def test_describe_matches_summary(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(11)], "k string, v double")
    row = aggregate.describe_columns(df, ["k"], ["v"]).first()
    text = {r["summary"]: float(r["v"]) for r in aggregate.summary_table(df, ["v"]).collect()}
    assert (row["count"], row["mean"], row["min"], row["p50"], row["max"]) == (11, 5.0, 0.0, 5.0, 10.0)
    assert np.isclose(row["stddev"], text["stddev"]) and row["p25"] == text["25%"]


def test_exact_median_of_large_and_small_groups(spark, monkeypatch):
    monkeypatch.setattr(aggregate, "SKETCH_ACCURACY", 100)
    rng = np.random.default_rng(2)
    data = pd.concat(
        [
            pd.DataFrame({"k": "odd", "v": rng.normal(size=5001)}),
            pd.DataFrame({"k": "even", "v": rng.exponential(size=4000)}),
            pd.DataFrame({"k": "ties", "v": np.repeat([1.0, 2.0, 3.0], [1500, 900, 600])}),
            pd.DataFrame({"k": "small", "v": [4.0, 1.0, 2.0, 3.0]}),
        ]
    )
    got = aggregate.exact_median(spark.createDataFrame(data), ["k"], "v").toPandas().set_index("k")["median"]
    assert np.allclose(got[["odd", "even", "ties", "small"]], data.groupby("k")["v"].median()[["odd", "even", "ties", "small"]], atol=0)


def test_quartiles_of_large_groups_are_exact(spark):
    """Beyond what the sketch holds: 260,000 rows, a third of them one value; a group of nulls keeps its row."""
    rows = spark.range(260_000).selectExpr(
        "'large' as k", "if(id % 3 = 0, 0.25D, pmod(xxhash64(id), 1000003) / 7.0D) as v", "cast(pmod(xxhash64(id, 1), 90) as int) as w"
    )
    rows = rows.unionByName(spark.createDataFrame([(None, 1.0, 2), (None, 3.0, None), ("empty", None, None)], "k string, v double, w int"))
    got = {(r["k"], r["column"]): r for r in aggregate.describe_columns(rows, ["k"], ["v", "w"]).collect()}
    data = rows.filter("k = 'large'").toPandas()
    for c in ("v", "w"):
        ordered = np.sort(data[c].to_numpy())
        expected = [ordered[int(np.ceil(p * len(ordered))) - 1] for p in (0.25, 0.5, 0.75)]
        assert [got["large", c][p] for p in ("p25", "p50", "p75")] == expected
        assert got["large", c]["count"] == 260_000 and np.isclose(got["large", c]["mean"], data[c].mean())
    assert got[None, "v"]["p50"] == 1.0 and got[None, "w"]["count"] == 1
    assert got["empty", "v"]["count"] == 0 and got["empty", "v"]["p50"] is None


# --- files ----------------------------------------------------------------------------------

_FIVE = "5,\nHigh, Low, Pred, Error, MSE,\n2, 3, 4, 5, 6,\n2, 2, 4, 6, 6,\n2, 9, 4, 5, 6,\n2, 3, 8, 4, 6"
_FOUR = "4,\nlow, high, no, yes,\n" + ",\n".join(["1, 2, 3, 3", "2,3,4,5"] * 4 + ["1, 2, 3, 3", "2,3,4,55"])


@pytest.mark.parametrize("split_bytes", [None, 32])
def test_flat_tables(spark, tmp_path, split_bytes):
    cases = {
        "five": (_FIVE, 4),
        "four": (_FOUR, 10),
        "comma": ("3, a, b, c, 1, 2, 3, 4, 5, 6,", 2),
        "two_columns_and_comma": ("2, a, b, 1, 2, 3, 4,", 3),
        "one_missing": ("2, a, b, 1, 2, 3", 2),
        "two_missing": ("3, a, b, c, 1, 2, 3, 4", 1),
        "blank": ("2, a, b, 1, , 3, 4\n", 2),
    }
    for name, (text, _) in cases.items():
        (tmp_path / f"{name}.txt").write_text(text)
    if split_bytes:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        long = files.scan_flat_table(spark, str(tmp_path)).toPandas()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    long["file"] = long["file"].str.extract(r"([a-z_]+)\.txt$")
    for name, (text, count) in cases.items():
        tokens = [t.strip() for t in text.split(",")]
        width = int(tokens[0])
        mine = long[long["file"] == name]
        assert mine["row"].nunique() == count == len(tokens) // width - 1
        for _, cell in mine.iterrows():
            expected = tokens[1 + width + cell["row"] * width + cell["col"]] or None
            assert cell["value"] == expected and cell["header"] == tokens[1 + cell["col"]]
    assert ((long["file"] == "five").sum(), (long["file"] == "one_missing").sum()) == (20, 3)


def test_flat_table_wide(spark, tmp_path):
    (tmp_path / "t.txt").write_text(_FIVE)
    wide = files.pivot_flat_table(files.scan_flat_table(spark, str(tmp_path)), ["High", "Low", "Pred", "Error", "MSE"])
    assert [tuple(r)[2:] for r in wide.orderBy("row").collect()][2] == ("2", "9", "4", "5", "6")


def test_metadata_lines(spark, tmp_path):
    (tmp_path / "m.txt").write_text(
        "1. Information:Intraday (1min) open, high, low, close prices and volume\n2. Symbol:AAPL\n"
        "3. Last Refreshed:2021-11-26 16:59:00\n\n6. Time Zone:US/Eastern\n"
    )
    got = files.parse_metadata_kv(files.scan_text_lines(spark, str(tmp_path))).orderBy("seq").collect()
    assert [tuple(r) for r in got][2] == (3, "Last Refreshed", "2021-11-26 16:59:00")
    assert [r["seq"] for r in got] == [1, 2, 3, 6]


_ARRESTS = 'Title\nSubtitle\n\nState,"Drug \nabuse\nviolations"\nAlabama,"9,012"\n"Iowa, north",\nOhio,17\n'
_ARREST_SCHEMA = T.StructType([T.StructField("State", T.StringType()), T.StructField("Drug Abuse", T.StringType())])


@pytest.mark.parametrize("split_bytes", [None, 40])
def test_preamble_csv(spark, tmp_path, split_bytes):
    (tmp_path / "a.csv").write_text(_ARRESTS)
    if split_bytes:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        table = files.scan_csv_preamble(spark, str(tmp_path), _ARREST_SCHEMA, skip_lines=3)
        got = [tuple(r) for r in table.select("State", fill_missing_int("Drug Abuse")).orderBy("State").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [("Alabama", 9012), ("Iowa, north", 0), ("Ohio", 17)]


def test_preamble_csv_with_line_breaks_in_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text(_ARRESTS + '"New\nYork","1,000"\n')
    table = files.scan_csv_preamble(spark, str(tmp_path), _ARREST_SCHEMA, skip_lines=3, multiline_cells=True)
    assert ("New\nYork", "1,000") in {tuple(r) for r in table.collect()}
    assert table.count() == 4


def test_bar_file_with_wrong_header_raises(spark, tmp_path):
    (tmp_path / "b.csv").write_text("date,open,high,low,volume,close,TradeDate,time\n2024-01-01 00:00:00,1,1,1,1,1,2024-01-01,x\n")
    with pytest.raises(Exception):
        files.scan_bars_csv(spark, str(tmp_path)).collect()


def _png(width: int, height: int) -> bytes:
    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    pixels = zlib.compress((b"\0" + b"\x7f" * (3 * width)) * height)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", pixels) + chunk(b"IEND", b"")


def test_image_catalog(spark, tmp_path):
    (tmp_path / "a.PNG").write_bytes(_png(4, 3))
    (tmp_path / "b.png").write_bytes(_png(7, 2))
    (tmp_path / "broken.png").write_bytes(b"no image")
    catalog = files.image_catalog(spark, str(tmp_path))
    got = {(r["width"], r["height"], r["nChannels"], r["extension"]) for r in catalog.collect()}
    assert got == {(4, 3, 3, ".png"), (7, 2, 3, ".png")}
    assert {r["line"] for r in files.image_report(catalog).collect()} >= {"width 4", "height 3"}
    routed = spark.createDataFrame([("x/a.txt",), ("x/b.png",), ("x/none",)], "p string").select(files.route_by_extension("p"))
    assert [r[0] for r in routed.collect()] == ["table", "image", "image"]


def test_metrics_table_appends(spark, tmp_path):
    schema = "symbol string, model string, metric string, param string, value double"
    for model in ("a", "b"):
        files.write_model_report(spark.createDataFrame([("s", model, "mse", "", 1.0)], schema), str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 2


# --- streams --------------------------------------------------------------------------------


def test_csv_stream_one_file_per_batch_equals_batch(spark, tmp_path):
    for day in (1, 2, 3):
        lines = [f"2024-01-0{day} {hour:02d}:00:00,1,2,0,1,5,2024-01-0{day},x" for hour in range(day)]
        lines.append("2024-01-01 09:00:00,1,2,0,1,5,2024-01-01,x")
        (tmp_path / f"{day}.csv").write_text("\n".join(["date,open,high,low,close,volume,TradeDate,time", *lines]) + "\n")
    stream = streaming.stream_files(spark, str(tmp_path), files.BAR_SCHEMA)
    counts = streaming.count_by_date(stream)
    assert counts.isStreaming
    got = {(str(r["date"]), r["count"]) for r in streaming.run_counts(counts).collect()}
    batch = aggregate.count_by(files.scan_bars_csv(spark, str(tmp_path)), F.to_date("date"), "date")
    assert got == {(str(r["date"]), r["count"]) for r in batch.collect()}
    assert ("2024-01-01", 4) in got


# --- plans ----------------------------------------------------------------------------------


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark, tables):
    from tickloom import plans

    plan = _plan(plans.queries()["project"](spark, tables))
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in plan
    plan = _plan(rows.filter_threshold(spark.read.parquet(f"{tables}/events.parquet").select("value"), "value"))
    assert "ReadSchema: struct<value:double>" in plan


def test_head_per_key_is_limited_before_the_shuffle(spark, tables):
    from tickloom import plans

    assert _plan(plans.queries()["show_head"](spark, tables)).count("WindowGroupLimit") == 2


def test_bars_combine_before_the_shuffle(spark, tables):
    from tickloom import plans

    plan = _plan(plans.queries()["bars"](spark, tables))
    assert plan.count("Exchange") == 1 and "partial_max" in plan


def test_attach_broadcasts_no_salted_copies(spark):
    stats = spark.range(300_000).selectExpr("id as k", "id as s")
    staged = skew.stage(stats, "large-side")
    rows_ = spark.range(100).selectExpr("id as k")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        plan = skew.attach(rows_, staged, ["k"], salts=16)._jdf.queryExecution().executedPlan().toString()
        assert "BuildRight" not in plan
        small = skew.attach(rows_, staged.limit(5), ["k"])._jdf.queryExecution().optimizedPlan().toString()
        assert "__salt" not in small
        assert skew.attach(rows_, staged, ["k"], salts=16).count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_preamble_scan_moves_no_line(spark, tmp_path):
    for name in ("a", "b"):
        lines = ["title", "x", *[f"h{i}" for i in range(1)], *[f"{i},{name}" for i in range(3_000)]]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines))
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])
    table = files.scan_csv_preamble(spark, str(tmp_path), schema, skip_lines=2)
    assert "Exchange" not in table._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, table.collect())) == sorted((i, s) for i in range(3_000) for s in "ab")


def _bar_lines(header, days):
    cells = {"date": "2024-01-0{} 10:00:00", "TradeDate": "2024-01-0{}", "time": "10:00:00"}
    return "\n".join([",".join(header), *[",".join(cells.get(h, "1.0").format(d) for h in header) for d in days]]) + "\n"


def test_stream_goes_on_after_a_restart(spark, tmp_path):
    names = [n for n, _ in files.BAR_FIELDS]
    source, state = tmp_path / "in", str(tmp_path / "state")
    source.mkdir()

    def counts():
        stream = streaming.stream_files(spark, str(source), files.BAR_SCHEMA)
        return {str(r["date"]): r["count"] for r in streaming.run_counts(streaming.count_by_date(stream), state).collect()}

    (source / "a.csv").write_text(_bar_lines(names, [1, 1, 2]))
    (source / "b.csv").write_text(_bar_lines(names, [2]))
    assert counts() == {"2024-01-01": 2, "2024-01-02": 2}
    assert counts() == {"2024-01-01": 2, "2024-01-02": 2}
    (source / "c.csv").write_text(_bar_lines(names, [1, 3]))
    assert counts() == {"2024-01-01": 3, "2024-01-02": 2, "2024-01-03": 1}


def test_stream_with_another_header_raises(spark, tmp_path):
    names = [n for n, _ in files.BAR_FIELDS]
    swapped = [names[0], names[4], *names[2:4], names[1], *names[5:]]
    (tmp_path / "a.csv").write_text(_bar_lines(swapped, [1]))
    stream = streaming.stream_files(spark, str(tmp_path), files.BAR_SCHEMA)
    with pytest.raises(StreamingQueryException):
        streaming.run_append(stream)


def test_store_rewrites_only_what_a_batch_touches(spark, tmp_path):
    schema = "day date, k string, n long"
    first = spark.sql("select date_add(date'2020-01-01', cast(id div 2 as int)) as day, concat('k', id % 2) as k, id as n from range(600)")
    store = streaming.UpsertStore(spark, str(tmp_path / "store"), first.schema, ["day", "k"], "day")
    assert store.read().count() == 0
    store.upsert(first, 0)

    def files():
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "store" / "data").rglob("*.parquet")}

    before = files()
    store.upsert(spark.sql("select date'2020-03-01' as day, 'k0' as k, -1L as n union all select date'2020-03-01', 'new', -2L"), 1)
    after = files()
    assert {p.split("/")[-2] for p in set(before) ^ set(after)} == {"day=2020-03-01"}
    assert store.read().filter("day = '2020-03-01'").orderBy("k").select("k", "n").collect() == [("k0", -1), ("k1", 121), ("new", -2)]
    assert store.read().count() == 601
    store.upsert(spark.sql("select date'2020-03-01' as day, 'k0' as k, 7L as n"), 1)  # the same batch again
    assert files() == after
    again = streaming.UpsertStore(spark, str(tmp_path / "store"), first.schema, ["day", "k"], "day")
    assert again.read().filter("n < 0").count() == 2


def test_upserts_go_on_with_new_files(spark, tmp_path):
    schema = "date timestamp, k string"
    source, root = tmp_path / "in", str(tmp_path / "kept")

    def run(rows):
        spark.createDataFrame(rows, "date string, k string").selectExpr("cast(date as timestamp) as date", "k").coalesce(1).write.mode("append").parquet(str(source))
        stream = streaming.stream_files(spark, str(source), spark.sql("select timestamp'2020-01-01' as date, '' as k").schema, "parquet")
        counts = stream.groupBy(F.to_date("date").alias("date"), "k").count()
        return {(str(r["date"]), r["k"]): r["count"] for r in streaming.run_upserts(counts, ["date", "k"], "date", root).read().collect()}

    assert run([("2020-01-01 10:00:00", "a"), ("2020-01-02 10:00:00", "a"), ("2020-01-02 11:00:00", "b")]) == {("2020-01-01", "a"): 1, ("2020-01-02", "a"): 1, ("2020-01-02", "b"): 1}
    assert run([("2020-01-02 12:00:00", "b")]) == {("2020-01-01", "a"): 1, ("2020-01-02", "a"): 1, ("2020-01-02", "b"): 2}


@pytest.mark.parametrize("parts", [1, 5])
def test_exact_share_of_every_key(spark, parts):
    data = pd.DataFrame({"id": np.arange(5000), "k": np.where(np.arange(5000) < 3333, "hot", np.where(np.arange(5000) < 4990, "b", None))})
    rows_ = spark.createDataFrame(data, "id long, k string").repartition(parts)
    got = rows.split_exact(rows_, ["id"], 0.3, ["k"]).toPandas().fillna({"k": "null"})
    assert got.groupby("k")["is_test"].sum().to_dict() == {"hot": 1000, "b": 498, "null": 3}
    hashes = {i: int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:12], 16) for i in data["id"]}
    hot = got[got["k"] == "hot"]
    assert max(hashes[i] for i in hot[hot["is_test"]]["id"]) < min(hashes[i] for i in hot[~hot["is_test"]]["id"])
    whole = rows.split_exact(rows_, ["id"], 0.3).toPandas()
    assert whole["is_test"].sum() == 1500 and whole.columns.tolist() == ["id", "k", "is_test"]


def test_exact_share_beyond_the_sketch(spark):
    got = rows.split_exact(spark.range(250_000), ["id"], 0.3).agg(F.count_if("is_test")).first()[0]
    assert got == 75_000


def test_ranks_of_large_groups_multiply_no_rows(spark, monkeypatch):
    monkeypatch.setattr(aggregate, "SKETCH_ACCURACY", 100)
    rng = np.random.default_rng(9)
    data = pd.DataFrame({"k": rng.choice(["a", "b"], 4000, p=[0.9, 0.1]), "v": np.round(rng.normal(size=4000), 2)})
    found = aggregate.exact_ranks(spark.createDataFrame(data), ["k"], "v", aggregate.QUARTILES)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # the values are counted before the ranks' bounds are laid beside them
    assert "Aggregate" in plan[plan.index("Generate") :]
    got = found.toPandas().set_index("k")["at"]
    for key, part in data.groupby("k"):
        values = np.sort(part["v"].to_numpy())
        assert list(got[key]) == [values[int(np.ceil(p * len(values))) - 1] for p in (0.25, 0.5, 0.75)]
