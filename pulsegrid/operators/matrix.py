"""Zone x hour heatmap and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions.columns import nan_to_null, q

HOURS = list(range(24))


def hour_column(h: int) -> str:
    return f"h{h:02d}"


def congestion_heatmap(prepared: DataFrame, value: str = "traffic_density") -> DataFrame:
    """Mean ``value`` per zone (rows) and hour of day (columns h00..h23), missing = 0.

    One hash aggregate with a filtered mean per hour: one shuffle of one partial
    row per zone and input partition.
    """
    v, zone = q(value), F.col("city_zone")
    means = [
        F.expr(f"coalesce(avg({v}) FILTER (WHERE hour = {h}), 0.0D)").alias(hour_column(h)) for h in HOURS
    ]
    rows = prepared.filter(zone.isNotNull() & F.col("hour").isNotNull())
    return rows.groupBy("city_zone").agg(*means).orderBy("city_zone")


def speed_histogram(
    df: DataFrame,
    bins: int = S.HISTOGRAM_MAX_BINS,
    lo: float = S.SPEED_MIN,
    hi: float = S.SPEED_MAX,
) -> DataFrame:
    """Row counts per (congestion level, speed bin); ``bins`` equal widths over [lo, hi].

    Values outside the range fall into the first/last bin. Empty bins are not
    listed.
    """
    width = F.lit(float(hi - lo)) / F.lit(float(bins))
    speed = nan_to_null("average_speed")
    raw_bin = F.floor((speed - F.lit(float(lo))) / width)
    bin_id = F.least(F.lit(bins - 1), F.greatest(F.lit(0), raw_bin)).cast("int")
    return (
        df.filter(speed.isNotNull() & F.col("congestion_level").isNotNull())
        .groupBy("congestion_level", bin_id.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "congestion_level",
            "bin",
            (F.lit(float(lo)) + F.col("bin") * width).alias("bin_start"),
            "n",
        )
        .orderBy("congestion_level", "bin")
    )


def nice_width(lo: Column, hi: Column, bins: int = S.HISTOGRAM_MAX_BINS) -> Column:
    """The smallest width of the form 1, 2 or 5 x 10^k whose bins, that begin at its multiples, cover [lo, hi] with at most ``bins``.

    Chart libraries choose bins in this way when they are given a largest number. One value, or none, has bins of width 1.
    """
    power = F.floor(F.log10((hi - lo) / F.lit(float(bins))))
    found = []
    # the logarithm may be off by one next to a power of ten
    for shift in (-1, 0, 1, 2):
        for digit in (1.0, 2.0, 5.0):
            width = F.lit(digit) * F.pow(F.lit(10.0), power + F.lit(shift))
            found.append(F.when(F.floor(hi / width) - F.floor(lo / width) < F.lit(bins), width))
    return F.when(hi > lo, F.coalesce(*found)).otherwise(F.lit(1.0))


def nice_histogram(df: DataFrame, value: str = "average_speed", by: str = "congestion_level", bins: int = S.HISTOGRAM_MAX_BINS) -> DataFrame:
    """Row counts per (``by``, bin of ``value``) with bins as wide as the data ask for (:func:`nice_width`).

    ``bin`` is the multiple of the width that the bin begins at. A first pass over the two columns finds the range, one row that the second
    takes as a scalar subquery. Rows without value or group are left out, empty bins are not listed.
    """
    known = df.select(F.col(q(by)).alias(by), nan_to_null(value).alias("_v")).filter(F.col("_v").isNotNull() & F.col(q(by)).isNotNull())
    ends = known.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    width = ends.select(nice_width(F.col("lo"), F.col("hi"), bins).alias("width")).scalar()
    counts = known.select(by, F.floor(F.col("_v") / width).alias("bin"), width.alias("bin_width")).groupBy(by, "bin", "bin_width").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(by, "bin", (F.col("bin") * F.col("bin_width")).alias("bin_start"), "bin_width", "n").orderBy(by, "bin")
