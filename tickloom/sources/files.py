"""File sources and sinks: bars in CSV, text tables, metadata lines, images, reports."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tickloom.functions.values import file_extension
from tickloom.operators.skew import attach
from tickloom.session import stage

# fixed values: column names and order of a bar file
BAR_FIELDS = [
    ("date", T.TimestampType()),
    ("open", T.DoubleType()),
    ("high", T.DoubleType()),
    ("low", T.DoubleType()),
    ("close", T.DoubleType()),
    ("volume", T.DoubleType()),
    ("TradeDate", T.DateType()),
    ("time", T.StringType()),
]
BAR_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in BAR_FIELDS])


# --- CSV ------------------------------------------------------------------------------------


def scan_bars_csv(spark: SparkSession, path: str, schema: T.StructType = BAR_SCHEMA) -> DataFrame:
    """Bars with all columns of the file; a header with other names, order or count raises."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def scan_bars_typed(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Chosen columns, bound by name; the reader parses only these."""
    return scan_bars_csv(spark, path).select(*columns)


def scan_csv_infer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def _header_lines(spark: SparkSession, path: str, skip_lines: int, most: int = 50) -> int:
    """Physical lines of the header record, which may hold line breaks inside quotes."""
    start = spark.read.text(path).filter("_metadata.file_block_start = 0").limit(skip_lines + most)
    head = [row[0] for row in start.collect()][skip_lines:]
    quotes = 0
    for count, line in enumerate(head, start=1):
        quotes += line.count('"')
        if quotes % 2 == 0:
            return count
    raise ValueError(f"no complete header within {most} lines after the preamble of {path}")


def _without_first_lines(lines: DataFrame, count: int) -> DataFrame:
    """Lines of the files' first splits without the first ``count`` of each file; counted inside each task."""

    def skip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for batch in batches:
            coded = batch.column("file").dictionary_encode()
            codes, keep = coded.indices.to_numpy(zero_copy_only=False), np.ones(len(batch), bool)
            for code, file in enumerate(coded.dictionary.to_pylist()):
                places = np.flatnonzero(codes == code)
                keep[places[: max(0, count - seen.get(file, 0))]] = False
                seen[file] = seen.get(file, 0) + len(places)
            yield pa.RecordBatch.from_arrays([batch.column("value").filter(pa.array(keep))], ["value"])

    return lines.select("value", F.col("_metadata.file_path").alias("file")).mapInArrow(skip, "value string")


def scan_csv_preamble(
    spark: SparkSession, path: str, schema: T.StructType, skip_lines: int, multiline_cells: bool = False
) -> DataFrame:
    """CSV files with ``skip_lines`` lines before the header, all columns named by position.

    The header may span lines. Files are read in splits, and only the first split of each looks for
    the header, so no line is moved between tasks; with ``multiline_cells`` data cells may span lines
    too, and then each file is read as one value.
    """
    header = _header_lines(spark, path, skip_lines)
    if multiline_cells:
        body = F.regexp_replace("value", rf"\A(?:[^\n]*\n){{{skip_lines}}}", "")
        # a record ends at a line break outside quotes
        found = F.regexp_extract_all(body, F.lit(r'(?:"[^"]*"|[^"\n])+'), F.lit(0))
        whole = spark.read.text(path, wholetext=True)
        records = whole.select(F.posexplode(found).alias("place", "value")).filter("place > 0")
    else:
        lines, starts_file = spark.read.text(path), F.col("_metadata.file_block_start") == 0
        body = _without_first_lines(lines.filter(starts_file), skip_lines + header)
        records = lines.filter(~starts_file).select("value").union(body).filter(F.trim("value") != "")
    options = {"multiLine": "true", "mode": "FAILFAST"}
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return records.select(F.from_csv("value", fields, options).alias("r")).select("r.*")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


# --- text -----------------------------------------------------------------------------------


def scan_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed lines of UTF-8 text files."""
    return spark.read.text(path).select(F.trim("value").alias("line"))


def parse_metadata_kv(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines ``N. Key:Value`` as ``(seq, key, value)``; the value may hold colons. Other lines are left out."""
    pattern = r"^\s*(\d+)\.\s*([^:]+):(.*)$"
    return lines.filter(F.col(line).rlike(pattern)).select(
        *[c for c in lines.columns if c != line],
        F.regexp_extract(line, pattern, 1).cast("int").alias("seq"),
        F.trim(F.regexp_extract(line, pattern, 2)).alias("key"),
        F.trim(F.regexp_extract(line, pattern, 3)).alias("value"),
    )


def write_text_report(lines: DataFrame, path: str) -> None:
    lines.select("line").write.text(path)


def scan_flat_table(spark: SparkSession, path: str) -> DataFrame:
    """Self-describing comma tables: column count, that many headers, then the cells row by row.

    Long form ``(file, row, col, header, value)``, blank cells null. The comma is the record
    delimiter of the scan, so a file of any length is read in splits; token numbers come from
    the written place of a token within its split and the number of tokens in the splits before. A file has ``tokens div columns - 1`` rows, hence a last
    row that lacks one cell is kept and a shorter one is not.
    """
    tokens = stage(
        spark.read.option("lineSep", ",").text(path).selectExpr(
            "_metadata.file_path as file",
            "_metadata.file_block_start as block",
            "monotonically_increasing_id() as at",
            r"regexp_replace(value, '^\\s+|\\s+$', '') as token",
            "octet_length(value) + 1 as bytes",
            "_metadata.file_size as file_size",
        ),
        "flat-tokens",
    )
    per_block = tokens.groupBy("file", "block").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.max("file_size").alias("file_size"), F.min("at").alias("first")
    )
    starts = per_block.selectExpr(
        "file",
        "block",
        """coalesce(sum(n) over (partition by file order by block
           rows between unbounded preceding and 1 preceding), 0) - first as shift""",
    )
    numbered = attach(tokens.select("file", "block", "at", "token"), starts, ["file", "block"]).selectExpr(
        "file", "shift + at as place", "token"
    )
    width = numbered.filter("place = 0").selectExpr("file", "cast(token as int) as width")
    # a comma at the very end of the file is followed by one more, empty token
    closed = F.sum("bytes") == F.max("file_size")
    length = per_block.groupBy("file").agg((F.sum("n") + closed.cast("int")).alias("length"), closed.alias("closed"))
    numbered = numbered.unionByName(length.filter("closed").selectExpr("file", "length - 1 as place", "'' as token"))
    length = length.drop("closed")
    shaped = attach(numbered, stage(width.join(length, "file"), "flat-shape"), ["file"])
    headers = shaped.filter("place between 1 and width").selectExpr(
        "file", "cast(place as int) - 1 as col", "token as header"
    )
    cells = shaped.filter("place > width").selectExpr(
        "file",
        "cast((place - 1 - width) div width as bigint) as row",
        "cast((place - 1 - width) % width as int) as col",
        "nullif(token, '') as value",
        "length div width - 1 as rows",
    )
    kept = cells.filter("row < rows").drop("rows")
    return attach(kept, stage(headers, "flat-headers"), ["file", "col"], salts=1).select(
        "file", "row", "col", "header", "value"
    )


def pivot_flat_table(long: DataFrame, headers: Sequence[str]) -> DataFrame:
    """One column per header, for files that share these headers."""
    return long.groupBy("file", "row").pivot("header", list(headers)).agg(F.first("value"))


# --- images ---------------------------------------------------------------------------------


def image_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Size, channels, extension, length and time of every image under ``path``; pixels are not kept."""
    pictures = (
        spark.read.format("image")
        .option("dropInvalid", True)
        .load(path)
        .select("image.origin", "image.width", "image.height", "image.nChannels")
    )
    files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    here = F.regexp_replace("path", "^file:/+", "/")
    there = F.regexp_replace("origin", "^file:/+", "/")
    return (
        pictures.withColumn("file", there)
        .join(files.withColumn("file", here), "file")
        .select(
            "file",
            F.lower(file_extension("file")).alias("extension"),
            "width",
            "height",
            "nChannels",
            "length",
            "modificationTime",
        )
    )


def image_report(catalog: DataFrame) -> DataFrame:
    """Text lines about each image."""
    return catalog.select(
        "file",
        F.explode(
            F.array(
                F.concat(F.lit("width "), F.col("width")),
                F.concat(F.lit("height "), F.col("height")),
            )
        ).alias("line"),
    )


# --- routing by extension, metrics ----------------------------------------------------------


def route_by_extension(path: Column | str) -> Column:
    """``table`` for text files, ``image`` for anything else."""
    return F.when(file_extension(path) == ".txt", "table").otherwise("image")


def write_model_report(metrics: DataFrame, path: str) -> None:
    """Append metric rows ``(symbol, model, metric, param, value)``, one folder per model."""
    metrics.write.mode("append").partitionBy("model").parquet(path)
