"""Joins and numbering that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tickloom.session import stage

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits


def salt_count(df: DataFrame) -> int:
    """Tasks to spread one key over: grows with the shuffle partitions, from 16 to 200."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(16, min(200, partitions // 8))


def dealt(df: DataFrame, *keys: str, each: int = 2) -> DataFrame:
    """Rows of equal keys together, over several tasks (``each``) for each core even where the rows are few.

    For work that is heavy beside its input; adaptive planning would put small inputs into one task.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(partitions, each * df.sparkSession.sparkContext.defaultParallelism), *keys)


def broadcast_limit(df: DataFrame) -> int:
    """Spark's own broadcast threshold in bytes."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    digits = text.rstrip("b")
    return int(digits[:-1]) * units[digits[-1]] if digits[-1:] in units else int(digits)


def planned_bytes(df: DataFrame) -> int:
    """What Spark expects ``df`` to take."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def attach(
    rows: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    salts: int | None = None,
) -> DataFrame:
    """Add the columns of ``stats`` (one row, or a few, per key) to every row.

    A plain join where Spark expects ``stats`` below its broadcast threshold, so that no row is
    moved, and where ``salts`` is 1. Otherwise rows of one key are spread over ``salts`` tasks by a
    hash of the whole row and ``stats`` is repeated, so a hot key never lands in one task. The
    planner's estimate does not see the repetition, so the salted side is kept from broadcast.
    """
    salts = salts or salt_count(rows)
    added = [f"`{c}`" for c in stats.columns if c not in keys]
    same_key = " and ".join(f"`{k}` <=> `__{k}`" for k in keys)
    renamed = [f"`{k}` as `__{k}`" for k in keys]
    if salts == 1 or planned_bytes(stats) <= broadcast_limit(rows):
        joined = rows.join(stats.selectExpr(*renamed, *added), F.expr(same_key), how)
        return joined.selectExpr(*[f"`{c}`" for c in rows.columns], *added)
    right = stats.selectExpr(*renamed, *added, f"explode(sequence(0, {salts - 1})) as __salt_r").hint("merge")
    hashed = ", ".join(f"`{c}`" for c, t in rows.dtypes if not t.startswith(("map", "variant")))
    left = rows.selectExpr("*", f"cast(pmod(xxhash64({hashed}), {salts}) as int) as __salt_l")
    joined = left.join(right, F.expr(f"__salt_l = __salt_r and {same_key}"), how)
    return joined.selectExpr(*[f"`{c}`" for c in rows.columns], *added)


def with_row_index(
    df: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    name: str = "row_idx",
) -> DataFrame:
    """Number the rows from 0 within each key, without pulling a key into one task.

    Rows are range-partitioned on (keys, order), so a hot key covers many partitions; each row
    takes its position inside its partition, and one small table of rows per (key, partition)
    gives the start of each run. ``order_by`` must identify a row within its key.
    """
    sort = [*keys, *order_by]
    placed = stage(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("__at", F.monotonically_increasing_id()),
        "row-index",
    ).selectExpr("*", f"shiftright(__at, {_POSITION_BITS}) as __part")
    # staged, so that the planner sees that it is small
    runs = stage(placed.groupBy(*keys, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n")), "row-runs")
    # at most one row per key and partition, so the running total is over a bounded group
    grouping = ", ".join(f"`{k}`" for k in keys) or "0"
    starts = runs.selectExpr(
        *[f"`{k}` as `__{k}`" for k in keys],
        "__part as __run",
        f"""__first - coalesce(sum(__n) over (partition by {grouping} order by __part
            rows between unbounded preceding and 1 preceding), 0) as __shift""",
    )
    same_run = " and ".join([f"`{k}` <=> `__{k}`" for k in keys] + ["__part = __run"])
    return placed.join(starts, F.expr(same_run)).selectExpr(
        *[f"`{c}`" for c in df.columns], f"__at - __shift as `{name}`"
    )


def windowed_blocks(
    indexed: DataFrame,
    before: int,
    block_rows: int = 50_000,
    index: str = "row_idx",
) -> DataFrame:
    """Cut numbered rows into fixed blocks, each with the ``before`` rows that precede it.

    Adds ``block`` and ``is_halo``; a window over (keys, block) then sees at most
    ``block_rows + before`` rows. Only the halo rows are written twice.
    """
    home = F.floor(F.col(index) / block_rows)
    reach = F.floor((F.col(index) + before) / block_rows)
    return indexed.withColumn("block", F.explode(F.sequence(home, reach))).withColumn(
        "is_halo", F.col("block") != F.floor(F.col(index) / block_rows)
    )
