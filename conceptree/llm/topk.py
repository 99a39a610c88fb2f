"""Exact top-k by inner product through a pivot-distance index.

With ``M`` the largest norm, a vector ``x`` is lifted by one component to ``(x, sqrt(M^2 - |x|^2))``;
then the squared distance of a query ``(q, 0)`` is ``|q|^2 + M^2 - 2 q.x``, and the highest inner
products are the nearest neighbours. Each vector is keyed by its nearest pivot and its distance
from it, and the vectors sorted by these are cut into blocks, the annuli. The annuli around a
query block's own place give each query a bound on its k-th score, that is a radius; by the
triangle inequality only annuli within that radius of the query's distance to their pivot can hold
better ones, and the search stops there.

Equal vectors are one class, which is indexed once: of its ids, only the ``k + 1`` smallest can be a result
of any query, and its queries share one search. Pivots grow with the square root of the classes. Blocks
meet by their numbers and borders first; vectors follow to the pairs that are left.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from conceptree.llm.words import small_batches
from conceptree.session import materialize

#: Pivots at least and at most; between them a sixteenth of the square root of the classes.
PIVOTS, MOST_PIVOTS = 32, 2048
#: Ids of an annulus, and vectors of a query block.
ANNULUS, QUERIES = 2048, 512
_EXACT = float(1 << 53)


def _quantised(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors, norms, dims = [], [], [], []
            for vec_id, v in zip(batch.column("vec_id").to_pylist(), batch.column("vector"), strict=True):
                if vec_id is None or not v.is_valid or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                x = np.floor(scale * x)
                ids.append(vec_id)
                vectors.append(x.tobytes())
                norms.append(float(x @ x))
                dims.append(len(x))
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(vectors, pa.binary()), pa.array(norms, pa.float64()), pa.array(dims, pa.int32())],
                ["vec_id", "v", "norm2", "dim"],
            )

    return run


def _matrix(rows: list[bytes], dim: int) -> np.ndarray:
    """Shorter vectors count as having zeros at the end."""
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        x = np.frombuffer(r)
        out[i, : len(x)] = x
    return out


class Pivots:
    """Pivots among the lifted vectors; ``most`` is the largest squared norm, ``ids`` an id of each."""

    def __init__(self, vectors: np.ndarray, ids: list[int], most: float):
        self.vectors = vectors
        self.single = np.unique(ids, return_index=True)[1]
        self.most = most
        self.lifts = np.sqrt(np.maximum(most - (self.vectors**2).sum(axis=1), 0))

    def distances(self, x: np.ndarray, lifted: bool) -> np.ndarray:
        """From each row of ``x`` to each pivot; data are lifted, queries not."""
        norms = (x**2).sum(axis=1)
        lift = np.sqrt(np.maximum(self.most - norms, 0)) if lifted else np.zeros(len(x))
        square = norms[:, None] + lift[:, None] ** 2 + self.most - 2 * (x @ self.vectors.T + np.outer(lift, self.lifts))
        return np.sqrt(np.maximum(square, 0))


def _keyed(pivots: Pivots, dim: int, k: int):
    """Nearest pivot and distance; and the k-th score with the pivots, which no k-th score is below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("v").to_pylist(), dim)
                d = pivots.distances(x, lifted=True)
                near = d.argmin(axis=1)
                floor = np.full(len(x), -np.inf)
                if len(pivots.single) >= k:
                    s = _scores(x, pivots.vectors[pivots.single]).astype(float)
                    floor = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
                columns = [pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near]), pa.array(floor)]
                yield pa.record_batch(
                    [*(batch.column(c) for c in ("class", "ids", "v")), *columns], ["class", "ids", "v", "pivot", "distance", "floor"]
                )

    return run


_ROW = ("class", "ids", "v", "pivot", "distance", "floor")
_BLOCK = {
    "pivot": pa.int32(), "low": pa.float64(), "high": pa.float64(), "classes": pa.list_(pa.int64()),
    "ids": pa.list_(pa.list_(pa.int64())), "vectors": pa.list_(pa.binary()), "floors": pa.list_(pa.float64()),
}


def _annuli(size: int):
    """Cuts rows sorted by pivot and distance into blocks of one pivot and about ``size`` ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: list[tuple]) -> pa.RecordBatch:
            classes, ids, vectors, pivot, distance, floors = map(list, zip(*rows, strict=True))
            values = pivot[0], distance[0], distance[-1], classes, ids, vectors, floors
            return pa.record_batch([pa.array([v], t) for v, t in zip(values, _BLOCK.values(), strict=True)], list(_BLOCK))

        held: list[tuple] = []
        n_ids = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in _ROW), strict=True):
                if held and (row[3] != held[0][3] or n_ids >= size):
                    yield done(held)
                    held, n_ids = [], 0
                held.append(row)
                n_ids += len(row[1])
        if held:
            yield done(held)

    return run


def _blocks(keyed: DataFrame, size: int, count: int, name: str) -> DataFrame:
    # Four full blocks a partition: the session's own number could cut few rows into many small blocks with weak bounds.
    ranged = keyed.repartitionByRange(count // (4 * size) + 1, "pivot", "distance", "class").sortWithinPartitions("pivot", "distance", "class")
    blocks = ranged.select(*_ROW).mapInArrow(
        _annuli(size),
        "pivot int, low double, high double, classes array<long>, ids array<array<long>>, vectors array<binary>, floors array<double>",
    )
    return materialize(blocks.withColumn(name, F.monotonically_increasing_id()), name)


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact."""
    if not len(q) or not len(x) or q.shape[1] * np.abs(q).max(initial=0) * np.abs(x).max(initial=0) < _EXACT:
        return (q @ x.T).astype(np.int64)
    whole = [[[int(c) for c in row] for row in m] for m in (q, x)]
    most = (1 << 63) - 1
    return np.array([[min(max(sum(a * b for a, b in zip(r, s, strict=True)), -most - 1), most) for s in whole[1]] for r in whole[0]], np.int64)


def _by_id(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the columns by id, and where each id starts in it."""
    order = np.argsort(ids, kind="stable")
    own = ids[order]
    return order, np.flatnonzero(np.append(True, own[1:] != own[:-1]))


def _first_bounds(k: int, dim: int):
    """The k-th score of each query within one annulus; an id of several classes counts in one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = [len(ids) for ids in row["ids"]]
                owner = np.repeat(np.arange(len(sizes)), sizes)
                held = np.bincount(owner[np.unique(np.concatenate(row["ids"]), return_index=True)[1]], minlength=len(sizes))
                if held.sum() < k:
                    continue
                used = np.flatnonzero(held)
                s = _scores(_matrix(row["q_vectors"], dim), _matrix(row["vectors"], dim)[used]).astype(float)
                top = np.argpartition(-s, min(k, len(used)) - 1, axis=1)[:, :k]
                s = np.take_along_axis(s, top, axis=1)
                order = np.argsort(-s, axis=1)
                enough = (np.cumsum(held[used][np.take_along_axis(top, order, axis=1)], axis=1) >= k).argmax(axis=1)
                bound = np.take_along_axis(s, np.take_along_axis(order, enough[:, None], axis=1), axis=1)[:, 0]
                yield pa.record_batch([pa.array(row["q_classes"], pa.int64()), pa.array(bound)], ["class", "bound"])

    return run


def _reaches(pivots: Pivots, dim: int):
    """For each query block and pivot, the distances that can hold a result of any of its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q = _matrix(row["q_vectors"], dim)
                low, high = _rings(pivots, q, np.array(row["bounds"], float))
                n = low.shape[1]
                yield pa.record_batch(
                    [pa.array([row["query_block"]] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(low.min(axis=0)), pa.array(high.max(axis=0))],
                    ["query_block", "pivot", "least", "most"],
                )

    return run


def _rings(pivots: Pivots, q: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By query and pivot: the annulus outside of which no score reaches the query's bound."""
    d = pivots.distances(q, lifted=False)
    radius = np.sqrt(np.maximum((q**2).sum(axis=1) + pivots.most - 2 * bounds, 0))
    slack = 1e-6 * (1 + d + np.sqrt(pivots.most))
    return d - radius[:, None] - slack, d + radius[:, None] + slack


def _results(k: int, pivots: Pivots, dim: int):
    """The k best ids of each query class in an annulus, of those that reach its bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array([len(own) for own in row["ids"]])
                ids, owner = np.concatenate(row["ids"]), np.repeat(np.arange(len(sizes)), sizes)
                asked, bounds = np.array(row["q_classes"], np.int64), np.array(row["bounds"], float)
                q = _matrix(row["q_vectors"], dim)
                low, high = _rings(pivots, q, bounds)
                inside = np.flatnonzero((low[:, row["pivot"]] <= row["high"]) & (high[:, row["pivot"]] >= row["low"]))
                s = _scores(q[inside], _matrix(row["vectors"], dim))[:, owner]
                order, starts = _by_id(ids)
                if len(starts) < len(ids):
                    s, ids = np.maximum.reduceat(s[:, order], starts, axis=1), ids[order][starts]
                good = s >= bounds[inside, None]
                if len(ids) > k:
                    good &= s >= np.partition(s, len(ids) - k, axis=1)[:, len(ids) - k, None]
                for i in np.flatnonzero(good.sum(axis=1) > k).tolist():  # ties for the last place: smaller ids
                    at = np.flatnonzero(good[i])
                    good[i, at[np.lexsort((ids[at], -s[i, at]))[k:]]] = False
                at, found = np.nonzero(good)
                out = asked[inside[at]], ids[found], s[at, found]
                if len(at):
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in out], ["class", "vec_id", "score"])

    return run


def exact_top_k(vectors: DataFrame, column: str = "embedding", k: int = 20, every: int = 20, scale: float = 64.0) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest scores of each query, ties to the smaller vec_id.

    ``vectors`` has vec_id and ``column``, whose components become ``floor(scale * x)``. Queries are the
    ids divisible by ``every``; candidates are all rows of other ids. Rows without an id, and
    vectors that are null or hold null or non-finite components, take no part. A shorter vector counts
    as having zeros at the end; equal rows count once, and an id with several vectors scores by
    its best pair. Scores beyond a long are cut to its range. No vectors or one give no rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    whole = materialize(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("vector"))
        .mapInArrow(_quantised(scale), "vec_id long, v binary, norm2 double, dim int"),
        "vectors",
    )
    dim, most = whole.agg(F.max("dim"), F.max("norm2")).first()
    if dim is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # A query's own id may be among its class' k + 1 best, and k are left without it.
    one_more = k + 1
    rows = whole.select("vec_id", "v").distinct()
    # The limit on the row number is applied before the shuffle too, so a hot vector sends k + 1 rows a task.
    place = F.row_number().over(W.partitionBy("v").orderBy("vec_id"))
    classes = rows.withColumn("place", place).where(F.col("place") <= one_more).groupBy("v")
    classes = classes.agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = materialize(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    asking = whole.where(F.col("vec_id") % every == 0).select("vec_id", "v").distinct()
    asking = materialize(asking.join(classes.select("v", "class"), "v").select(F.col("vec_id").alias("query_id"), "class"), "asking")

    count = classes.count()
    n = min(MOST_PIVOTS, max(PIVOTS, isqrt(count) // 16))
    spread = classes.orderBy(F.xxhash64("v"), "class").limit(n).select("v", F.col("ids")[0].alias("id")).collect()
    pivots = Pivots(_matrix([bytes(r["v"]) for r in spread], dim), [r["id"] for r in spread], most)
    keyed = materialize(
        classes.mapInArrow(
            _keyed(pivots, dim, one_more), "class long, ids array<long>, v binary, pivot int, distance double, floor double"
        ),
        "keyed",
    )
    annuli = _blocks(keyed, ANNULUS, count, "annulus").drop("classes", "floors")
    asked = keyed.join(asking.select("class").distinct(), "class", "left_semi").withColumn("ids", F.slice("ids", 1, 1))
    asked = materialize(asked, "asked")
    queries = _blocks(asked, QUERIES, asked.count(), "query_block").drop("ids").withColumnsRenamed({"classes": "q_classes", "vectors": "q_vectors"})

    # Blocks meet by pivot on their borders alone.
    borders = annuli.select("annulus", "pivot", "low", "high")
    near = queries.select("query_block", "pivot", F.col("low").alias("q_low"), F.col("high").alias("q_high"))
    near = near.join(borders, "pivot").where("low <= q_high and high >= q_low").select("query_block", "annulus")
    bounds = (
        near.join(queries.select("query_block", "q_classes", "q_vectors"), "query_block")
        .join(annuli.select("annulus", "ids", "vectors"), "annulus")
        .select("q_classes", "q_vectors", "ids", "vectors")
        .mapInArrow(_first_bounds(one_more, dim), "class long, bound double")
        .groupBy("class")
        .agg(F.max("bound").alias("bound"))
    )
    rows = queries.select("query_block", F.posexplode(F.arrays_zip("q_classes", "q_vectors", "floors")).alias("at", "q"))
    rows = rows.join(bounds, F.col("q.q_classes") == F.col("class"), "left")
    bounded = rows.groupBy("query_block").agg(
        F.sort_array(F.collect_list(F.struct("at", F.greatest("bound", "q.floors").alias("bound"), "q"))).alias("rows")
    )
    bounded = materialize(
        bounded.select(
            "query_block",
            F.col("rows.q.q_classes").alias("q_classes"),
            F.col("rows.q.q_vectors").alias("q_vectors"),
            F.col("rows.bound").alias("bounds"),
        ),
        "bounded",
    )
    reach = bounded.mapInArrow(_reaches(pivots, dim), "query_block long, pivot int, least double, most double")
    pairs = reach.join(borders, "pivot").where("low <= most and high >= least").select("query_block", "annulus")
    found = (
        pairs.join(bounded, "query_block")
        .join(annuli, "annulus")
        .select("q_classes", "q_vectors", "bounds", "pivot", "low", "high", "ids", "vectors")
        .mapInArrow(_results(one_more, pivots, dim), "class long, vec_id long, score long")
        .groupBy("class", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    first = F.row_number().over(W.partitionBy("class").orderBy(F.desc("score"), "vec_id"))
    found = materialize(found.withColumn("rank", first).where(F.col("rank") <= one_more).drop("rank"), "class_results")
    scored = asking.join(found, "class").where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
