"""File and stream operators, run on files that Spark writes from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.functions.values import fill_missing_int, rounded
from tickloom.plans.checking_sql import BARS, PRICES, r
from tickloom.plans.registry import query
from tickloom.session import staging_path
from tickloom.sources import files
from tickloom.sources.tables import event_bars, read_table
from tickloom.streaming import bars as streaming

_PRICES_SQL = ", ".join(PRICES)


def _bar_file(spark: SparkSession, folder: str) -> str:
    """All bars as CSV in the eight-column layout; the symbol is the last part of ``time``."""
    path = staging_path(spark, "bars-csv")
    table = event_bars(spark, folder).select(
        F.col("date"),
        *PRICES,
        F.to_date("date").alias("TradeDate"),
        F.concat(F.date_format("date", "HH:mm:ss"), F.lit(" "), F.col("symbol")).alias("time"),
    )
    files.write_csv(table, path)
    return path


_BAR_FILE_SQL = f"""with {BARS} select date, {_PRICES_SQL}, cast(date as date) as "TradeDate",
  strftime(date, '%H:%M:%S') || ' ' || symbol as time from bars"""


@query("scan_bars_csv", _BAR_FILE_SQL)
def scan_bars_csv(spark: SparkSession, folder: str) -> DataFrame:
    table = files.scan_bars_csv(spark, _bar_file(spark, folder))
    return table.withColumn("date", F.col("date").cast("timestamp_ntz"))


@query("scan_bars_typed", f"with {BARS} select date, {_PRICES_SQL} from bars")
def scan_bars_typed(spark: SparkSession, folder: str) -> DataFrame:
    table = files.scan_bars_typed(spark, _bar_file(spark, folder), ["date", *PRICES])
    return table.withColumn("date", F.col("date").cast("timestamp_ntz"))


@query("scan_csv_usecols", f"with {BARS} select symbol, close, volume from bars")
def scan_csv_usecols(spark: SparkSession, folder: str) -> DataFrame:
    """Three of the file's eight columns; the symbol is read from the last part of ``time``."""
    table = files.scan_bars_typed(spark, _bar_file(spark, folder), ["close", "volume", "time"])
    return table.select(F.split_part("time", F.lit(" "), F.lit(2)).alias("symbol"), "close", "volume")


@query("scan_csv_infer", "select c_custkey, c_nationkey, c_acctbal, c_mktsegment from customer")
def scan_csv_infer(spark: SparkSession, folder: str) -> DataFrame:
    path = staging_path(spark, "customer-csv")
    customer = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    files.write_csv(customer, path)
    return files.scan_csv_infer(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("write_csv", "select n_nationkey, n_name from nation")
def write_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = staging_path(spark, "nation-csv")
    table = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    files.write_csv(table, path)
    return files.scan_bars_csv(spark, path, T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType())]))


@query("scan_text_lines", r"select trim(l, ' ') as line from (select unnest(string_split_regex(text, '\r\n|\r|\n')) as l from documents) where true")
def scan_text_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = staging_path(spark, "lines")
    read_table(spark, folder, "documents").select("text").write.text(path)
    return files.scan_text_lines(spark, path)


_METADATA_LINES = ["Information:Hourly open, high, low, close and volume", "Symbol:@", "Last Refreshed:%", "Interval:60min"]


@query(
    "parse_metadata_kv",
    f"""with {BARS}, s as (select symbol, strftime(max(date), '%Y-%m-%d %H:%M:%S') as latest from bars group by 1)
 select 1 as seq, 'Information' as key, 'Hourly open, high, low, close and volume' as value from s
 union all select 2, 'Symbol', symbol from s
 union all select 3, 'Last Refreshed', latest from s
 union all select 4, 'Interval', '60min' from s""",
)
def parse_metadata_kv(spark: SparkSession, folder: str) -> DataFrame:
    path = staging_path(spark, "metadata")
    latest = event_bars(spark, folder).groupBy("symbol").agg(F.max("date").alias("latest"))
    shown = F.date_format("latest", "yyyy-MM-dd HH:mm:ss")
    lines = [
        F.replace(F.replace(F.lit(f"{i}. {text}"), F.lit("@"), F.col("symbol")), F.lit("%"), shown)
        for i, text in enumerate(_METADATA_LINES, start=1)
    ]
    files.write_text_report(latest.select(F.explode(F.array(*lines)).alias("line")), path)
    return files.parse_metadata_kv(files.scan_text_lines(spark, path))


@query(
    "scan_flat_table",
    f"""with {BARS}, numbered as (
   select *, row_number() over (partition by symbol, cast(date as date) order by date) - 1 as row from bars)
 select symbol, cast(date as date) as day, row, cast(c as integer) as col,
   ['open', 'high', 'low', 'close', 'volume'][c + 1] as header, [open, high, low, close, volume][c + 1] as value
 from numbered, (values (0), (1), (2), (3), (4)) as cs(c)""",
)
def scan_flat_table(spark: SparkSession, folder: str) -> DataFrame:
    """One flat table per symbol and day, written and read back."""
    path = staging_path(spark, "flat")
    table = event_bars(spark, folder).withColumn("day", F.to_date("date"))
    cells = table.select(
        "symbol", "day", F.hour("date").alias("place"), F.concat_ws(", ", *PRICES, F.lit("")).alias("line")
    )
    head = table.select("symbol", "day").distinct().select(
        "symbol", "day", F.lit(-1).alias("place"), F.lit("5,\n" + ", ".join(PRICES) + ",").alias("line")
    )
    # a day has at most 24 bars, so one file per symbol and day is a bounded group
    (
        head.unionByName(cells)
        .repartition("symbol", "day")
        .sortWithinPartitions("symbol", "day", "place")
        .select("symbol", "day", "line")
        .write.partitionBy("symbol", "day")
        .text(path)
    )
    long = files.scan_flat_table(spark, path)
    return long.select(
        F.regexp_extract("file", "symbol=([^/]+)/", 1).alias("symbol"),
        F.to_date(F.regexp_extract("file", "day=([^/]+)/", 1)).alias("day"),
        "row",
        "col",
        "header",
        F.col("value").cast("double").alias("value"),
    )


@query(
    "scan_csv_preamble",
    "select o_orderkey, cast(round(o_totalprice + 1e-4) as integer) as amount from orders",
)
def scan_csv_preamble(spark: SparkSession, folder: str) -> DataFrame:
    """Order amounts with thousands commas below three title lines and a header cell with line breaks."""
    path = staging_path(spark, "preamble")
    lines = read_table(spark, folder, "orders").select(
        F.concat(F.col("o_orderkey"), F.lit(',"'), F.format_number(F.col("o_totalprice") + 1e-4, 0), F.lit('"')).alias("line")
    )
    titled = F.concat(F.lit('Amounts\nby order\n\nkey,"Total\norder\namount"\n'), F.col("line"))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    files.write_text_report(lines.select(F.when(first, titled).otherwise(F.col("line")).alias("line")), path)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("amount", T.StringType())])
    table = files.scan_csv_preamble(spark, path, schema, skip_lines=3)
    return table.select("o_orderkey", fill_missing_int("amount").alias("amount"))


@query(
    "write_model_report",
    f"""with {BARS} select symbol, 'mean' as model, 'mse' as metric, '' as param, {r('var_pop(close)', 4)} as value
 from bars group by 1""",
)
def write_model_report(spark: SparkSession, folder: str) -> DataFrame:
    """Error of the mean of close, written to the metrics table and read back."""
    path = staging_path(spark, "metrics")
    metrics = event_bars(spark, folder).groupBy("symbol").agg(F.var_pop("close").alias("value")).select(
        "symbol", F.lit("mean").alias("model"), F.lit("mse").alias("metric"), F.lit("").alias("param"), "value"
    )
    files.write_model_report(metrics, path)
    table = spark.read.parquet(path)
    return table.select("symbol", "model", "metric", "param", rounded("value", 4).alias("value"))


@query(
    "write_text_report",
    f"with {BARS} select symbol || ' bars: ' || cast(count(*) as varchar) as line from bars group by symbol",
)
def write_text_report(spark: SparkSession, folder: str) -> DataFrame:
    path = staging_path(spark, "report")
    counts = event_bars(spark, folder).groupBy("symbol").agg(F.count("*").alias("n"))
    files.write_text_report(counts.select(F.concat("symbol", F.lit(" bars: "), "n").alias("line")), path)
    return files.scan_text_lines(spark, path)


# --- streams --------------------------------------------------------------------------------


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = read_table(spark, folder, "events").schema
    return streaming.stream_files(spark, folder, schema, "parquet", "events.parquet")


@query("stream_bars", f"with {BARS} select date, {_PRICES_SQL} from bars")
def stream_bars(spark: SparkSession, folder: str) -> DataFrame:
    """All bars through a CSV file stream, one file per micro-batch."""
    stream = streaming.stream_files(spark, _bar_file(spark, folder), files.BAR_SCHEMA, pattern="*.csv")
    table = streaming.run_append(stream.select("date", *PRICES))
    return table.withColumn("date", F.col("date").cast("timestamp_ntz"))


@query("stream_count_by_date", "select cast(ts as date) as date, count(*) as count from events group by 1")
def stream_count_by_date(spark: SparkSession, folder: str) -> DataFrame:
    return streaming.run_counts(streaming.count_by_date(event_stream(spark, folder), "ts"))


@query(
    "stream_count_by_timestamp",
    "select date_trunc('hour', ts) as date, count(*) as count from events group by 1",
)
def stream_count_by_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    """Keyed by the hour of the event."""
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    return streaming.run_counts(streaming.count_by_date(event_stream(spark, folder), "ts", hour))


@query("stream_upsert", "select cast(ts as date) as date, event_type, count(*) as count from events group by 1, 2")
def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Counts by day and type, kept in a store that a micro-batch rewrites only where it changes."""
    counts = event_stream(spark, folder).groupBy(F.to_date("ts").alias("date"), "event_type").count()
    return streaming.run_upserts(counts, ["date", "event_type"], "date").read()


@query(
    "stream_count_watermark",
    """select cast(ts as date) as date, count(*) as count from events
 where date_trunc('day', ts) + interval 1 day <= (select max(ts) from events) - interval 1 day group by 1""",
)
def stream_count_watermark(spark: SparkSession, folder: str) -> DataFrame:
    """Days that the watermark (one day behind the newest event) has closed."""
    return streaming.run_append(streaming.count_by_date(event_stream(spark, folder), "ts", delay="1 day"))


@query("is_streaming", "select count(*) > 0 as is_streaming from events")
def is_streaming(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the declared count is a streaming plan, beside a proof that the batch table has rows."""
    flag = streaming.count_by_date(event_stream(spark, folder), "ts").isStreaming
    return read_table(spark, folder, "events").agg((F.count("*") > 0).alias("n")).select(
        (F.col("n") & F.lit(flag)).alias("is_streaming")
    )
