"""Rolling per-zone features over the last N events (current event included).

The direct form is one window partitioned by zone and ordered by event time.
That caps the parallelism at the number of zones and puts a hot zone (say a
third of all rows) into a single task. Here the zones' ordered sequences are cut
into ranges of even size instead:

1. the rows are range-partitioned by (zone, time, id, values, a hash of the whole row) and
   written to the shared folder with the number of their range, in hash buckets of (zone, range).
   Spark samples the bounds, so ranges are even whatever the keys, and adaptive execution
   merges small ones; rows that share one time and id are cut apart by their values,
   and rows that agree in every column are interchangeable;
2. every (range, zone) is a window partition: a place and N-1 lags per value column. The
   buckets are dealt out by these keys already, so the rows are not shuffled a second time;
3. halo: for every (range, zone) the last N-1 rows before it are the last N-1 of
   the tails of the ranges before. That table has N-1 rows per range and zone,
   so it grows with the number of ranges, not with the row count. Joined on the
   same keys it fills the frame slots that fall before the range's first row. Only the
   tails and the halo are shuffled.

Nothing is collected and nothing is broadcast by force. The order is total but for equal rows, so
the result is the same for any partitioning of the input.

The average is summed left to right from 0.0 and divided by the number of
non-NULL values, exactly like Spark's ``avg`` over a sliding row frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid import schemas as S
from pulsegrid.functions.columns import hour_floor, q
from pulsegrid.session import into_ranges, range_count, ranges_by_size, shared_scratch_path
from pulsegrid.sources.files import write_bucketed


def _zone_key(zone: str) -> Column:
    """Non-NULL, injective key: NULL -> "0", value x -> "1" + x.

    The NULL zone stays a group of its own, the key can be a plain equi-join
    key, and Catalyst knows it is never NULL (no inferred not-null filter).
    """
    z = q(zone)
    return F.expr(f"concat(CASE WHEN {z} IS NULL THEN '0' ELSE '1' END, coalesce(CAST({z} AS STRING), ''))")


def _order(order: str, tie: str, values: Sequence[str]) -> list[str]:
    return [*dict.fromkeys([order, tie, *values]), "_tie"]


def _row_hash(df: DataFrame) -> Column:
    """A hash of the row: the order of rows that share time, id and values. Maps have none and stay out."""
    plain = [F.col(q(f.name)) for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*plain)


def _ranged(
    df: DataFrame, zone: str, order: str, tie: str, values: Sequence[str], ranges: int | None, path: str | None
) -> DataFrame:
    """The rows with zone key ``_zk``, ``_range`` and ``_tie``, written in buckets of (``_zk``, ``_range``) and read back."""
    path = path or shared_scratch_path(df.sparkSession, "rolling")
    keyed = df.withColumns({"_zk": _zone_key(zone), "_tie": _row_hash(df)})
    keys = [F.col(q(k)).asc_nulls_first() for k in ("_zk", *_order(order, tie, values))]
    ordered = into_ranges(keyed, *keys, ranges=ranges).select("*", F.spark_partition_id().alias("_range"))
    with ranges_by_size(df):
        return write_bucketed(ordered, path, ranges or range_count(df), ["_zk", "_range"])


def _halo(ranged: DataFrame, keys: Sequence[str], values: Sequence[str], prev: int) -> DataFrame:
    """(zone, range) -> the last ``prev`` rows before the range, oldest first."""
    backwards = Window.partitionBy("_zk", "_range").orderBy(*[F.col(q(k)).desc_nulls_last() for k in keys])
    tails = (
        ranged.select("_zk", "_range", *dict.fromkeys([*keys, *values]))
        .withColumn("_rn", F.row_number().over(backwards))
        .filter(F.col("_rn") <= prev)
        .groupBy("_zk", "_range")
        .agg(F.sort_array(F.collect_list(F.struct("_rn", *values)), asc=False).alias("_tail"))
    )
    # every range that has the zone holds at least one of its rows, so `prev` ranges before are enough
    before = Window.partitionBy("_zk").orderBy("_range").rowsBetween(-prev, -1)
    found = tails.select("_zk", "_range", F.flatten(F.collect_list("_tail").over(before)).alias("_h"))
    last = F.slice("_h", F.greatest(F.size("_h") - F.lit(prev - 1), F.lit(1)), prev)
    return found.select("_zk", "_range", last.alias("_halo"))


def _fill(ranged: DataFrame, halo: DataFrame, keys: Sequence[str], values: Sequence[str], events: int, suffix: str) -> DataFrame:
    """Place and lags inside the range, then the frame's earlier slots from the halo."""
    prev = events - 1
    window = "PARTITION BY _zk, _range ORDER BY " + ", ".join(f"{q(k)} ASC NULLS FIRST" for k in keys)
    lag_cols = [
        F.expr(f"lag({q(v)}, {k}) OVER ({window})").alias(f"_{v}_lag{k}") for v in values for k in range(1, events)
    ]
    main = ranged.select("*", F.expr(f"row_number() OVER ({window})").alias("_r"), *lag_cols)
    joined = main.join(halo, on=["_zk", "_range"], how="left")

    # frame slots before the current row: in-bucket lag, else halo, else absent;
    # an absent slot is NULL, which the mean skips exactly like a NULL value
    slot_cols = []
    for v in values:
        for k in range(1, events):
            from_end = f"({k} - _r + 1)"  # position from the halo's end when k >= _r
            slot_cols.append(
                F.expr(
                    f"CAST(CASE WHEN {k} < _r THEN {q(f'_{v}_lag{k}')}"
                    f" WHEN _halo IS NOT NULL AND {from_end} <= size(_halo)"
                    f" THEN (try_element_at(_halo, -{from_end})).{q(v)} END AS DOUBLE)"
                ).alias(f"_{v}_s{k}")
            )
    helper = {"_zk", "_range", "_tie", "_r", "_halo"} | {f"_{v}_lag{k}" for v in values for k in range(1, events)}
    keep = [c for c in joined.columns if c not in helper]
    slotted = joined.select(*keep, *slot_cols)

    # mean = (((0.0 + s_oldest) + ...) + current) / non-NULL count: Spark's avg order
    out_cols = []
    for v in values:
        frame = [q(f"_{v}_s{k}") for k in range(prev, 0, -1)] + [f"CAST({q(v)} AS DOUBLE)"]
        total = "0.0D" + "".join(f" + coalesce({x}, 0.0D)" for x in frame)
        count = " + ".join(f"CASE WHEN {x} IS NOT NULL THEN 1 ELSE 0 END" for x in frame)
        out_cols.append(F.expr(f"CASE WHEN ({count}) > 0 THEN ({total}) / ({count}) END").alias(f"{v}{suffix}"))
    return slotted.select(*keep, *out_cols)


def rolling_means(
    df: DataFrame,
    values: Sequence[str],
    zone: str = "city_zone",
    order: str = "event_timestamp",
    tie: str = "vehicle_id",
    events: int = S.ROLLING_EVENTS,
    suffix: str = "_rolling_mean",
    ranges: int | None = None,
    path: str | None = None,
) -> DataFrame:
    """Add ``<value><suffix>``: mean of ``value`` over the zone's last ``events`` rows.

    Rows are ordered by (``order``, ``tie``, ``values``) ascending, NULLs first, and by a hash of the row
    where these are equal. NULL values are skipped by the mean; a frame without values gives NULL.

    Building the result runs a job: the ordered rows are written to ``path``
    (default: a fresh folder under the shared checkpoint folder). ``ranges`` fixes
    the number of ranges; by default it follows the rows that arrive.
    """
    if events < 1:
        raise ValueError("events must be at least 1")
    if events == 1:  # the frame is the row itself
        return df.select("*", *[F.col(v).cast("double").alias(f"{v}{suffix}") for v in values])
    ranged, keys = _ranged(df, zone, order, tie, values, ranges, path), _order(order, tie, values)
    return _fill(ranged, _halo(ranged, keys, values, events - 1), keys, values, events, suffix)


def rolling_zone_features(
    typed: DataFrame, events: int = S.ROLLING_EVENTS, ranges: int | None = None, path: str | None = None
) -> DataFrame:
    """Rolling density (2 dp) and rolling-mean speed minus own speed (2 dp) per zone."""
    means = rolling_means(typed, ["traffic_density", "average_speed"], events=events, ranges=ranges, path=path)
    return means.select(
        *typed.columns,
        F.round("traffic_density_rolling_mean", 2).alias("rolling_density_6_event"),
        F.round(F.col("average_speed_rolling_mean") - F.col("average_speed"), 2).alias("speed_drop_from_zone_avg"),
    )


def rows_for_targets(
    df: DataFrame, targets: DataFrame, zone: str = "city_zone", order: str = "event_timestamp", events: int = S.ROLLING_EVENTS
) -> DataFrame:
    """The rows of ``df`` that the rolling frames of some ``targets`` (rows of ``df``) can reach.

    Those are the targets' own hours and, as every hour that is present has a row, the
    ``events`` - 1 hours present before, by zone. The hours come from one aggregate
    of two columns, as large as the time span; NULL times are an hour of their own.
    """
    hours = df.select(_zone_key(zone).alias("_zk"), hour_floor(order).alias("_hour")).distinct()
    in_order = Window.partitionBy("_zk").orderBy(F.col("_hour").asc_nulls_first())
    numbered = hours.withColumn("_n", F.row_number().over(in_order))
    wanted = targets.select(_zone_key(zone).alias("_zk"), hour_floor(order).alias("_hour")).distinct()
    same = (F.col("a._zk") == F.col("b._zk")) & F.col("a._hour").eqNullSafe(F.col("b._hour"))
    last = numbered.alias("a").join(wanted.alias("b"), same).select(F.col("a._zk"), F.explode(F.sequence(F.greatest(F.col("_n") - events + 1, F.lit(1)), F.col("_n"))).alias("_n"))
    reach = numbered.join(last.distinct(), ["_zk", "_n"]).select(F.col("_zk").alias("_tz"), F.col("_hour").alias("_th"))
    keyed = df.select("*", _zone_key(zone).alias("_zk"), hour_floor(order).alias("_hour"))
    kept = keyed.join(reach, (F.col("_zk") == F.col("_tz")) & F.col("_hour").eqNullSafe(F.col("_th")), "left_semi")
    return kept.select(*df.columns)
