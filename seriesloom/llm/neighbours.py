"""Approximate nearest neighbours by inner product over several shifted Hilbert curves.

Every vector is projected by a few random rotations to a low dimension, shifted, cut into a grid and given its place on
the grid's Hilbert curve. Spark range-partitions the keys of each curve, which gives every vector a rank. A query meets
the vectors whose rank on a curve is within a window of its own, in blocks of consecutive ranks; the finds of all
curves are merged and ranked by the exact inner product of the original vectors.

The window is fitted, not fixed: for a bounded sample of queries the true neighbours among all vectors are found by
brute force, and the window is the distance along the best curve that reaches the wanted share of them. Vectors with
little structure need wide windows (isotropic ones about 7 % of all rows on either side for 8 curves), clustered ones
narrow windows. All vectors are indexed.

Equal vectors are indexed once and stand for their rows' smallest ids, of which one more than the result's length
suffices. Vectors that are null, zero, hold null or non-finite components, or differ from the most common length take
no part, neither do rows without id. Repeated rows count once. An empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written
from .hilbert import hilbert_keys

CURVES, DIMS, BITS, SEED = 8, 8, 7, 20
NEAREST, QUERY_STEP = 20, 20
#: Vectors the grid is fitted on and queries the window is fitted on: those with the smallest hashes.
FIT_ROWS, FIT_QUERIES, FIT_RECALL = 4000, 96, 0.95
#: Least and most ranks in a block of candidates (in between, as many as the window), and blocks whose queries meet it
#: in one group. They bound a group's memory and don't change the result.
BLOCK, MOST_BLOCK, QUERY_BLOCKS = 2048, 65536, 16

ROWS = "vec_id long, uid long, vec binary"


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f4").reshape(-1, dims)


def usable(vectors: DataFrame, dims: int | None = None) -> DataFrame:
    """Rows that take part, with their vector as bytes and a 64-bit id of the vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.array(v, dtype="<f4").tobytes() for v in batch.column("embedding").to_pylist()]
            uids = [xxhash.xxh3_64_intdigest(v) - (1 << 63) for v in raw]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(uids, pa.int64()), pa.array(raw, pa.binary())], names=["vec_id", "uid", "vec"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite & F.exists("embedding", lambda x: x != 0.0))
    return rows.where(F.size("embedding") == dims).mapInArrow(run, ROWS) if dims else rows


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """uid, vector and the smallest ids of its rows; salted, so that a vector of any frequency is spread first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() % 64
        for batch in batches:
            ids: dict[int, list[int]] = {}
            vecs: dict[int, bytes] = {}
            for vec_id, uid, vec in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                vecs[uid] = vec
                ids.setdefault(uid, []).append(vec_id)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(vecs, pa.int64()), pa.array([part] * len(vecs), pa.int32()), pa.array(vecs.values(), pa.binary()), pa.array([sorted(set(x))[:keep] for x in ids.values()], pa.list_(pa.int64()))], names=["uid", "part", "vec", "ids"])

    merged = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids")
    some = rows.mapInArrow(run, "uid long, part int, vec binary, ids array<long>")
    return some.groupBy("uid", "part").agg(F.first("vec").alias("vec"), merged).groupBy("uid").agg(F.first("vec").alias("vec"), merged)


def _curves(sample: np.ndarray, curves: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rotation, origin, width) of each curve's grid; the origin is shifted by a random part of the width."""
    rng, dims = np.random.default_rng(SEED), min(DIMS, sample.shape[1])
    out = []
    for _ in range(curves):
        turn = np.linalg.qr(rng.normal(size=(sample.shape[1], sample.shape[1])))[0][:, :dims]
        low, high = np.quantile(sample @ turn, [0.001, 0.999], axis=0)
        width = np.maximum(high - low, 1e-9) * 1.3
        out.append((turn, low - width * rng.uniform(0, 0.23, dims), width))
    return out


def curve_ranks(vectors: DataFrame, dims: int, grids: list) -> DataFrame:
    """(curve, uid, vec, rank): the place of each vector on each curve, by range partitioning and counts of partitions."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vec"), dims).astype(np.float64)
            for curve, (turn, low, width) in enumerate(grids):
                cells = np.clip((x @ turn - low) / width * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), curve, dtype=np.int32)), pa.array(hilbert_keys(cells, BITS)), batch.column("uid"), batch.column("vec")], names=["curve", "key", "uid", "vec"])

    order = ["curve", "key", "uid"]
    placed = vectors.select("uid", "vec").mapInArrow(keys, "curve int, key long, uid long, vec binary").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(placed.withColumn("place", F.monotonically_increasing_id()), "curves").withColumn("part", F.shiftright("place", 33))
    parts = placed.groupBy("curve", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    ahead = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("curve", "part", "first", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    return placed.join(parts, ["curve", "part"]).select("curve", "uid", "vec", (F.col("before") + F.col("place") - F.col("first")).alias("rank"))


def _best(scores: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of one row of scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    at = at[np.isfinite(scores[at])]
    return at[np.lexsort((tie[at], -scores[at]))][:k]


def _exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    return (v.astype(np.float64) * q.astype(np.float64)).sum(axis=1)


def fit_window(vectors: DataFrame, queries: DataFrame, ranks: DataFrame, dims: int, recall: float) -> int:
    """Least distance of ranks on the best curve that reaches `recall` of the true neighbours of the sampled queries."""
    sample = queries.select("uid").distinct().orderBy(F.xxhash64("uid"), "uid").limit(FIT_QUERIES)
    picked = vectors.join(sample, "uid").select("uid", "vec").collect()
    if not picked:
        return 0
    q_uids = [r.uid for r in picked]
    q = np.frombuffer(b"".join(bytes(r.vec) for r in picked), dtype="<f4").reshape(-1, dims).astype(np.float64)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, uids = _matrix(batch.column("vec"), dims).astype(np.float64), np.asarray(batch.column("uid"))
            rows = [(q_uids[i], int(uids[j]), float(s[j])) for i, s in enumerate(q @ x.T) for j in _best(np.where(uids == q_uids[i], -np.inf, s), uids, NEAREST)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["q", "uid", "score"])

    near = vectors.select("uid", "vec").mapInArrow(search, "q long, uid long, score double")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "uid"))
    near = near.withColumn("n", place).where(F.col("n") <= NEAREST).select("q", "uid")
    of_q = ranks.join(near.select(F.col("q").alias("uid")).distinct(), "uid").select("curve", F.col("uid").alias("q"), F.col("rank").alias("q_rank"))
    gaps = near.join(ranks.select("curve", "uid", "rank"), "uid").join(of_q, ["q", "curve"])
    gaps = gaps.groupBy("q", "uid").agg(F.min(F.abs(F.col("rank") - F.col("q_rank"))).alias("gap")).select("gap").collect()
    return int(np.quantile([r.gap for r in gaps], recall, method="higher")) if gaps else 0


def nearest(vectors: DataFrame, query_step: int = QUERY_STEP, k: int = NEAREST, curves: int = CURVES, recall: float = FIT_RECALL, window: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of each query (ids divisible by `query_step`)."""
    spark = vectors.sparkSession
    common = usable(vectors).groupBy(F.size("embedding").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = common.dims
    rows = written(usable(vectors, dims), "vectors")
    each = written(distinct_vectors(rows, k + 1), "distinct-vectors")
    queries = rows.where(F.col("vec_id") % query_step == 0).select("vec_id", "uid").distinct()
    sample = each.select("uid", "vec").orderBy(F.xxhash64("uid"), "uid").limit(FIT_ROWS).collect()
    grids = _curves(np.frombuffer(b"".join(bytes(r.vec) for r in sample), dtype="<f4").reshape(-1, dims).astype(np.float64), curves)
    ranks = written(curve_ranks(each, dims, grids), "curve-ranks")
    reach = fit_window(each, queries, ranks, dims, recall) if window is None else window
    size = min(max(BLOCK, reach), MOST_BLOCK)
    super_block = size * QUERY_BLOCKS

    def spread(low, high):
        return F.explode(F.sequence(F.greatest(low, F.lit(0)), high))

    block = F.floor(F.col("rank") / size)
    asked = ranks.join(queries.select("uid").distinct(), "uid").select(
        "curve", F.col("uid").alias("q"), F.col("vec").alias("q_vec"), F.col("rank").alias("q_rank"), F.floor(F.col("rank") / super_block).alias("chunk"),
        spread(F.floor((F.col("rank") - reach) / size), F.floor((F.col("rank") + reach) / size)).alias("block"),
    )
    met = ranks.select(F.col("curve").alias("on"), F.col("uid").alias("uid"), F.col("vec").alias("vec"), F.col("rank").alias("rank"), block.alias("own"), spread(F.floor((block * size - reach) / super_block), F.floor((block * size + size - 1 + reach) / super_block)).alias("among"))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            x, uids, x_rank = _matrix(right.column("vec"), dims), right.column("uid").to_numpy(), right.column("rank").to_numpy()
            qs, q_uids, q_rank = _matrix(left.column("q_vec"), dims), left.column("q").to_numpy(), left.column("q_rank").to_numpy()
            wide = x.astype(np.float64).T
            for at in range(0, len(qs), 256):
                some = qs[at : at + 256].astype(np.float64) @ wide
                some[np.abs(q_rank[at : at + 256, None] - x_rank[None, :]) > reach] = -np.inf
                for i, row in enumerate(some, at):
                    # One more vector than asked, and all that tie with it but for rounding.
                    least = np.partition(row, len(row) - k - 1)[len(row) - k - 1] if len(row) > k + 1 else -np.inf
                    hit = np.flatnonzero((row >= least - 1e-9) & np.isfinite(row))
                    exact = _exact(qs[i], x[hit])
                    found.append((np.full(len(hit), q_uids[i]), uids[hit], exact))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(columns, names=["q", "uid", "score"])

    pairs = asked.groupBy("curve", "block", "chunk").cogroup(met.groupBy("on", "own", "among")).applyInArrow(score, "q long, uid long, score double")
    pairs = pairs.groupBy("q", "uid").agg(F.max("score").alias("score"))
    leading = F.rank().over(Window.partitionBy("q").orderBy(F.desc("score")))
    pairs = pairs.withColumn("n", leading).where(F.col("n") <= k + 1).drop("n").join(each.select("uid", "ids"), "uid")
    first = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.col("ids")[0]))
    pairs = pairs.withColumn("n", first).where(F.col("n") <= k + 1)
    ids = pairs.select("q", F.explode("ids").alias("vec_id"), "score")
    listed = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id"))), 1, k + 1)
    lists = ids.groupBy("q").agg(listed.alias("found"))
    answers = queries.join(lists, queries["uid"] == lists["q"]).select(
        F.col("vec_id").alias("query_id"), F.posexplode(F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("vec_id")), 1, k)).alias("at", "hit"),
    )
    return answers.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.less")).alias("score"))


def op8_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


QUERIES = {"op8_hilbert": op8_hilbert}
ORACLES: dict[str, str] = {}
