"""Approximate nearest neighbours by shifted space-filling curves.

Vectors of unit length are projected to a few dimensions, several times with
different random rotations and shifts. On each projection a Hilbert curve orders
all vectors; near vectors tend to be near on some of the curves. For each curve Spark
range-partitions the keys, numbers the vectors along the curve and deals them into
blocks of ``BLOCK`` neighbours. A query meets the vectors of its own block and of
the blocks around it, each time in a matrix product of bounded size. All scores are in
double precision; whatever the product's rounding can't tell from the last candidate
kept is scored again pair by pair, as in the final ranking, so that a block's
candidates and those of all curves are cut in the order of the result: by cosine, then
by smallest vec_id.

How many blocks around is measured, not guessed: for ``SAMPLE`` of the queries the
true neighbours are found by a scan of all vectors, and the reach is the least
that finds ``RECALL`` of them on some curve. Data without any structure need a
reach that grows with them; clustered data do not.

Vectors of one direction (v, 2v, 4v: equal when divided by their largest component) are
one point of the index, so a vector that a third of all rows share costs one point;
each point keeps its smallest ids, and results are expanded from them. A block holds
``BLOCK`` points whatever the data, so no task grows with a crowded region.

Vectors that are NULL, zero, of another length than most, or that hold NULL or
non-finite components take no part. Rows that repeat an id are one candidate per
different vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from pulsegrid.llm.common import read_table, stored

NEAREST, EVERY = 5, 50
CURVES, DIMENSIONS, BITS = 24, 8, 7
BLOCK = 512
#: queries whose true neighbours set the reach, and the share of these to be found
SAMPLE, RECALL = 200, 0.97


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points (n, dimensions) with ``bits`` bits a coordinate.

    The coordinates are turned level by level into the transposed index, whose
    bits are then interleaved; dimensions * bits must be at most 63.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where(x[n - 1] & q, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def projections(size: int, curves: int = CURVES, dimensions: int = DIMENSIONS, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal directions (curves, size, dimensions) and shifts (curves, dimensions) in cells."""
    rng = np.random.default_rng(seed)
    directions = np.stack([np.linalg.qr(rng.normal(size=(size, size)))[0][:, :dimensions] for _ in range(curves)]) if size >= dimensions else rng.normal(size=(curves, size, dimensions))
    return directions, rng.random((curves, dimensions))


def curve_keys(unit: np.ndarray, directions: np.ndarray, shifts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Keys (n, curves) of unit vectors: projected, scaled to the spread of random unit vectors, shifted, cut to cells."""
    n, size = unit.shape
    side = 1 << bits
    spread = 3.0 / np.sqrt(size)  # three standard deviations of a coordinate
    out = np.empty((n, len(directions)), np.int64)
    for c in range(len(directions)):
        place = (unit @ directions[c] / spread + 1) / 2 * (side * 0.75) + shifts[c] * side * 0.25
        out[:, c] = hilbert_key(np.clip(place, 0, side - 1).astype(np.int64), bits)
    return out


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _unit(v: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled first, so that very large and very small ones keep their direction."""
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=1)[:, None]
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def _leading(score: np.ndarray, q: np.ndarray, v: np.ndarray, low: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, exact cosine) of each row's ``most`` best columns by cosine, ties by ``low``.

    ``score`` holds the cosines of all q and v by a matrix product. Its rounding may
    differ from that of exact_cosine; what lies within it of the last one kept is compared exactly.
    """
    rounding = 8 * (v.shape[1] + 8) * np.finfo(np.float64).eps
    most = min(most, score.shape[1])
    last = -np.partition(-score, most - 1, axis=1)[:, most - 1]
    row, column = np.nonzero(score >= last[:, None] - rounding)
    exact = np.fromiter((exact_cosine(q[a], v[b]) for a, b in zip(row.tolist(), column.tolist(), strict=True)), np.float64, len(row))
    order = np.lexsort((low[column], -exact, row))
    row, column, exact = row[order], column[order], exact[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < most
    return row[keep], column[keep], exact[keep]


def _needed_distance(points: DataFrame, places: DataFrame, size: int, k: int, recall: float) -> int:
    """The distance along its nearest curve within which ``recall`` of the true neighbours of sampled queries lie."""
    sample = points.filter("asked").orderBy(F.xxhash64("point"), "point").limit(SAMPLE).select("point", "v").collect()
    if not sample:
        return 0
    known = np.array([r["point"] for r in sample])
    plain = np.array([r["v"] for r in sample], np.float64)
    asked = _unit(plain)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            point = batch.column("point").to_numpy()
            v = _matrix(batch.column("v"), size).astype(np.float64)
            score = asked @ _unit(v).T
            score[known[:, None] == point] = -2.0
            row, column, exact = _leading(score, plain, v, batch.column("low").to_numpy(), k)
            apart = known[row] != point[column]
            row, column, exact = row[apart], column[apart], exact[apart]
            yield pa.RecordBatch.from_arrays([pa.array(known[row]), pa.array(point[column]), pa.array(exact), batch.column("low").take(pa.array(column))], names=["query", "point", "score", "low"])

    order = Window.partitionBy("query").orderBy(F.desc("score"), "low", "point")
    near = points.select("point", "v", F.get("ids", F.lit(0)).alias("low")).mapInArrow(scan, "query long, point long, score double, low long")
    near = near.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).select("query", "point")
    there = places.select("curve", "point", F.col("place").alias("there"))
    here = places.select("curve", F.col("point").alias("query"), F.col("place").alias("here"))
    apart = near.join(there, "point").join(here, ["curve", "query"]).groupBy("query", "point").agg(F.min(F.abs(F.col("here") - F.col("there"))).alias("d"))
    found = apart.agg(F.percentile("d", recall).alias("d")).first()["d"]
    return int(np.ceil(found or 0))


def nearest(vectors: DataFrame, is_query: Column, k: int = NEAREST, curves: int = CURVES, block: int = BLOCK, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its ``k`` nearest other rows by cosine.

    ``vectors`` has vec_id and embedding (an array of numbers); ``is_query`` is a condition on vec_id.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    usable = rows.filter(
        F.col("vec_id").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("v", lambda x: x != 0)
    )
    sizes = usable.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    size = sizes["n"]
    usable = usable.filter(F.size("v") == size)

    # points: one a direction, with its smallest ids (one more than asked for, as a query skips its own)
    largest = F.array_max(F.transform("v", F.abs))
    usable = usable.withColumn("way", F.transform("v", lambda x: x / largest))
    by_id, of_id = Window.partitionBy("way").orderBy("vec_id"), Window.partitionBy("way", "vec_id").orderBy("v")
    ids = usable.select("way", "vec_id", "v").distinct().withColumn("_n", F.dense_rank().over(by_id)).filter(F.col("_n") <= k + 1)
    ids = ids.withColumn("_same", F.row_number().over(of_id)).filter(F.col("_same") <= k)
    points = ids.groupBy("way").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.min_by("v", F.struct("_n", "_same")).alias("v"))
    asked = usable.filter(is_query).select("way").distinct().withColumn("_asked", F.lit(True))
    points = points.join(asked, "way", "left").select(
        F.monotonically_increasing_id().alias("point"), "way", "v", "ids", F.coalesce("_asked", F.lit(False)).alias("asked")
    )
    points = stored(points, "points")

    ordered = stored(_ordered(points, size, curves), "curves")
    # number the points along each curve: counts per range partition, summed up over the ranges before
    counts = ordered.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("curve", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    in_part = Window.partitionBy("curve", "part").orderBy("key", "point")
    numbered = ordered.withColumn("_n", F.row_number().over(in_part) - 1).join(offsets, ["curve", "part"])
    places = stored(numbered.select("curve", (F.col("offset") + F.col("_n")).cast("long").alias("place"), "point"), "places")
    reach = -(-_needed_distance(points, places, size, k, recall) // block)
    blocks = places.select("curve", F.floor(F.col("place") / F.lit(block)).cast("long").alias("block"), "point")
    # vectors travel as they came: in single precision only where the table has it
    short = isinstance(vectors.schema["embedding"].dataType.elementType, FloatType)
    plain = points.select("point", F.col("v").cast("array<float>" if short else "array<double>").alias("v"), F.get("ids", F.lit(0)).alias("low"), "asked")
    with_v = blocks.join(plain, "point")
    # a query goes to its own block and to those around it
    around = F.explode(F.sequence(F.col("block") - reach, F.col("block") + reach)).alias("to_block")
    queries = with_v.filter("asked").select(F.col("curve").alias("on_curve"), around, F.col("point").alias("query"), F.col("v").alias("q"))
    members = with_v.select("curve", "block", "point", "v", "low")

    def best(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        kind = pa.schema([("query", pa.int64()), ("point", pa.int64()), ("low", pa.int64()), ("score", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_pylist([], kind)
        q, v = (_matrix(c.combine_chunks(), size).astype(np.float64) for c in (left["q"], right["v"]))
        low = right["low"].to_numpy()
        row, column, exact = _leading(_unit(q) @ _unit(v).T, q, v, low, k + 1)
        return pa.table([pa.array(left["query"].to_numpy()[row]), pa.array(right["point"].to_numpy()[column]), pa.array(low[column]), pa.array(exact)], schema=kind)

    found = queries.groupBy("on_curve", "to_block").cogroup(members.groupBy("curve", "block")).applyInArrow(best, "query long, point long, low long, score double")
    # the k + 1 best points of all curves hold the k best rows, own row left out
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "low", "point")
    merged = found.groupBy("query", "point").agg(F.first("low").alias("low"), F.max("score").alias("score"))
    merged = merged.withColumn("_n", F.row_number().over(by_score)).filter(F.col("_n") <= 2 * (k + 1))
    hits = merged.join(points.select("point", F.col("ids").alias("ids"), F.col("v").alias("w")), "point")
    lists = hits.groupBy("query").agg(F.collect_list(F.struct("w", "ids")).alias("hits"))
    lists = lists.join(points.select(F.col("point").alias("query"), "way"), "query").select("way", "hits")
    per_row = usable.filter(is_query).distinct().join(lists, "way").select(F.col("vec_id").alias("query_id"), "v", "hits")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                q = np.array(row["v"])
                found = []
                for hit in row["hits"]:
                    score = exact_cosine(q, np.array(hit["w"]))
                    found += [(-score, i) for i in hit["ids"] if i != row["query_id"]]
                found.sort()
                out += [(row["query_id"], n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "rank", "vec_id", "score"])

    return per_row.mapInArrow(rank, schema)


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine in double precision; scaled by powers of two, which rounds nothing, so that no product overflows."""
    a, b = (np.ldexp(x, -int(np.frexp(np.abs(x).max())[1])) for x in (a, b))
    return float(np.dot(a, b) / (np.sqrt(np.dot(a, a)) * np.sqrt(np.dot(b, b))))


def _ordered(points: DataFrame, size: int, curves: int) -> DataFrame:
    """(curve, key, point, part): each point on every curve, range-partitioned by curve and key."""
    directions, shifts = projections(size, curves)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _unit(_matrix(batch.column("v"), size))
            found, n = curve_keys(v, directions, shifts), len(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(curves, dtype=np.int32), n)), pa.array(found.ravel()), pa.array(np.repeat(batch.column("point").to_numpy(), curves))],
                names=["curve", "key", "point"],
            )

    placed = points.select("point", "v").mapInArrow(keys, "curve int, key long, point long")
    return placed.repartitionByRange("curve", "key", "point").withColumn("part", F.spark_partition_id())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)
