"""Contiguous slices of an ordered table and the union of transformed batches.

``ntile(N) over (order by ...)`` without a partition key would pull every row
into one task. The exact, distributed form used here:

1. range-partition on the order keys (Spark samples the bounds) and sort inside
   each partition; ``monotonically_increasing_id`` then encodes
   (partition index, position in partition);
2. materialise that table under the shared checkpoint folder, which fixes the
   ids and cuts the lineage (a lost executor cannot renumber rows);
3. count rows per range partition (one row per partition, a small table),
   prefix-sum the counts and join them back as offsets:
   global rank = offset + position + 1;
4. slice = f(rank, n, N) with the same sizes as ``ntile`` / ``array_split``:
   the first n mod N slices have n div N + 1 rows, the others n div N.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.session import into_ranges, ranges_by_size, shared_scratch_path

_POSITION_BITS = 33  # monotonically_increasing_id: (partition index << 33) + position


def _idiv(a: Column, b: Column) -> Column:
    return F.floor(a / b).cast("long")


def global_rank(
    df: DataFrame,
    order_cols: Sequence[str],
    ranges: int | None = None,
    path: str | None = None,
    rank_col: str = "_rank",
    total_col: str = "_n",
) -> DataFrame:
    """Add a 1-based global rank by ``order_cols`` (ascending) and the row total.

    ``order_cols`` must give a total order (end them with a unique key).
    ``ranges`` fixes the number of range partitions; by default it follows the
    rows that arrive. Building the result runs a job that writes the ordered rows to ``path``.
    """
    spark = df.sparkSession
    path = path or shared_scratch_path(spark, "ranked")
    # adaptive execution merges neighbouring ranges only, so the partitions stay in global order
    ordered = (
        into_ranges(df, *order_cols, ranges=ranges)
        .sortWithinPartitions(*order_cols)
        .select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))
    )
    with ranges_by_size(df):
        ordered.write.mode("overwrite").parquet(path)
    stored = spark.read.schema(ordered.schema).parquet(path)

    # less the partition's first id, so that the position is right however many rows it has
    position = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _POSITION_BITS)
    counts = stored.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per range partition: the window below runs over that many rows only
    w_before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(w_before), F.lit(0)).alias("_offset"),
        F.sum("_cnt").over(w_all).alias(total_col),
    )
    # one row per range: AQE broadcasts that table when its real size is small
    ranked = stored.join(offsets, "_pid", "inner")
    return ranked.select(
        *[c for c in df.columns],
        (F.col("_offset") + position + F.lit(1)).alias(rank_col),
        F.col(total_col),
    )


def slice_of_rank(rank: Column, total: Column, n_slices: int) -> Column:
    """1-based slice of a 1-based rank, sizes as ``ntile`` (larger slices first)."""
    n = F.lit(n_slices)
    q = _idiv(total, n)
    r = total % n
    big = r * (q + F.lit(1))
    return (
        F.when(rank <= big, _idiv(rank - F.lit(1), q + F.lit(1)) + F.lit(1))
        .otherwise(r + _idiv(rank - F.lit(1) - big, F.greatest(q, F.lit(1))) + F.lit(1))
        .cast("int")
    )


def contiguous_slices(
    df: DataFrame,
    n_slices: int,
    order_cols: Sequence[str],
    out_col: str = "partition_id",
    ranges: int | None = None,
    path: str | None = None,
) -> DataFrame:
    """Number rows 1..n_slices in order: the row-ordered split into equal slices."""
    ranked = global_rank(df, order_cols, ranges=ranges, path=path)
    return ranked.select(
        *df.columns, slice_of_rank(F.col("_rank"), F.col("_n"), n_slices).alias(out_col)
    )


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of batches by column name."""
    return reduce(lambda a, b: a.unionByName(b), batches)


def split_by_values(df: DataFrame, column: str, first: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Two disjoint batches: rows whose ``column`` is in ``first``, and all others (NULL included)."""
    member = F.coalesce(F.col(column).isin(list(first)), F.lit(False))
    return df.filter(member), df.filter(~member)
