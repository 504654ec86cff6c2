"""Exact top-k search by inner product over ball trees, one per shard.

Vectors are dealt into shards by a hash of their row, and each shard's ball tree is built once.  Queries meet a
shard by branch and bound: every node's inner product with a query q is at most ``q . centre + |q| radius``, a
node is no better than its parent, leaves are visited in descending order of that bound, and a query stops at
the first leaf that cannot reach its current k-th score.

Queries go out in waves of bounded size, sent to the tasks that hold the trees, so that neither trees nor
queries are shuffled.  In a wave every query starts at a shard of its own, then visits one more, two, four and
so on; between these steps its best k are merged and its current k-th score is shared with the next.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cohortlift.llm.staging import Stages

LEAF_ROWS = 128
#: Components that a shard and a wave of queries hold at most, about; rows follow from the dimension.
SHARD_VALUES, WAVE_VALUES = 1 << 20, 1 << 21
#: Tasks that trees are built in and searched by at most.
MOST_TASKS = 1 << 13

_FOUND = "query long, query_id long, vec_id long, row long, score long"


def _packed(**arrays: np.ndarray) -> bytes:
    buffer = io.BytesIO()
    np.savez(buffer, **arrays)
    return buffer.getvalue()


def _unpacked(packed: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(packed)) as held:
        return {name: held[name] for name in held.files}


def build(rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> dict[str, np.ndarray]:
    """A balanced ball tree: nodes split at the median along the line between two far points.

    ``begin`` and ``end`` are a node's rows, ``parent`` the node above (-1 for the root).
    """
    order = np.arange(len(ids))
    begin, end, parent, centres, radii, leaf = [], [], [], [], [], []
    waiting = [(0, len(ids), -1)]
    while waiting:
        low, high, above = waiting.pop()
        held = vectors[order[low:high]]
        centre = held.mean(axis=0)
        away = np.linalg.norm(held - centre, axis=1)
        node = len(begin)
        begin.append(low), end.append(high), parent.append(above), centres.append(centre)
        radii.append(away.max()), leaf.append(high - low <= LEAF_ROWS)
        if not leaf[-1]:
            first = held[away.argmax()]
            second = held[np.linalg.norm(held - first, axis=1).argmax()]
            along = held @ (second - first)
            order[low:high] = order[low:high][np.argsort(along, kind="stable")]
            middle = (low + high) // 2
            waiting += [(low, middle, node), (middle, high, node)]
    return {
        "rows": rows[order], "ids": ids[order], "vectors": vectors[order], "begin": np.array(begin), "end": np.array(end),
        "parent": np.array(parent), "centres": np.array(centres), "radii": np.array(radii), "leaf": np.array(leaf),
    }


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held as doubles."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if most < 2.0**53:
        return left @ right.T
    exact = np.vectorize(int, otypes=[object])
    return exact(left) @ exact(right).T


def search(
    tree: dict[str, np.ndarray], query_rows: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int
) -> tuple[np.ndarray, ...]:
    """(query, vec_id, row, score) of each query's best k in this tree that reach ``least``, its k-th
    score so far; ties go to the smaller vec_id, then row, and a query's own row takes no part."""
    norms = np.linalg.norm(queries, axis=1)
    bounds = queries @ tree["centres"].T + norms[:, None] * tree["radii"]
    bounds += 1e-9 * (np.abs(bounds) + 1) + 1e-6  # rounding must not hide a node
    for node in range(1, len(tree["parent"])):  # a parent stands before its children
        np.minimum(bounds[:, node], bounds[:, tree["parent"][node]], out=bounds[:, node])
    leaves = np.flatnonzero(tree["leaf"])
    bounds = bounds[:, leaves]
    visit = np.argsort(-bounds, axis=1, kind="stable")
    m = len(queries)
    scores = [[] for _ in range(m)]  # (-score, vec_id, row), best first, at most k
    kth = least.astype(float)
    active = np.arange(m)
    for step in range(len(leaves)):
        chosen = visit[active, step]
        going = bounds[active, chosen] >= kth[active]
        active, chosen = active[going], chosen[going]
        if not len(active):
            break
        for leaf in np.unique(chosen):
            asking = active[chosen == leaf]
            low, high = tree["begin"][leaves[leaf]], tree["end"][leaves[leaf]]
            found = _products(queries[asking], tree["vectors"][low:high])
            ids, rows = tree["ids"][low:high], tree["rows"][low:high]
            hits = (found >= kth[asking][:, None]) & (rows[None, :] != query_rows[asking][:, None])
            for at in np.flatnonzero(hits.any(axis=1)):
                query = asking[at]
                mine = np.flatnonzero(hits[at])
                best = scores[query] + [(-int(found[at, j]), int(ids[j]), int(rows[j])) for j in mine]
                best.sort()
                scores[query] = best[:k]
                if len(best) >= k:
                    kth[query] = max(kth[query], -best[k - 1][0])
    out = [(q, vec_id, row, -negative) for q in range(m) for negative, vec_id, row in scores[q]]
    columns = np.array(out, dtype=object).reshape(-1, 4)
    return tuple(columns[:, c].astype(np.int64) for c in range(4))


def _matrix(table: pa.Table) -> np.ndarray:
    column = table.column("vector").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _build_shard(table: pa.Table) -> pa.Table:
    table = table.sort_by("row").combine_chunks()
    tree = build(table.column("row").to_numpy(), table.column("vec_id").to_numpy(), _matrix(table))
    return pa.table({"shard": table.column("shard").slice(0, 1), "tree": pa.array([_packed(**tree)], pa.binary())})


def _meet(shared, shards: int, begin: int, end: int, k: int):
    """Search every tree for the queries whose turn it is: those that started ``begin`` to ``end`` shards before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave = _unpacked(shared.value)
        for batch in batches:
            for shard, packed in zip(batch.column("shard").to_pylist(), batch.column("tree")):
                steps = (shard - wave["home"]) % shards
                turn = np.flatnonzero((steps >= begin) & (steps < end))
                if len(turn):
                    query, *found = search(_unpacked(packed.as_py()), wave["rows"][turn], wave["vectors"][turn], wave["least"][turn], k)
                    query = turn[query]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in (query, wave["ids"][query], *found)],
                        names=["query", "query_id", "vec_id", "row", "score"],
                    )

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_wave(tables: Stages, trees: DataFrame, shards: int, wave: pa.Table, k: int) -> DataFrame:
    """The best k of the queries in ``wave`` over all shards."""
    spark = trees.sparkSession
    rows = wave.column("row").to_numpy()
    queries = {"rows": rows, "ids": wave.column("vec_id").to_numpy(), "vectors": _matrix(wave), "home": rows % shards}
    least, best, begin, end = np.full(len(rows), -np.inf), None, 0, 1
    while begin < shards:
        shared = spark.sparkContext.broadcast(_packed(**queries, least=least))
        found = trees.mapInArrow(_meet(shared, shards, begin, min(end, shards), k), _FOUND)
        best = tables.write(_best(found if best is None else best.drop("rank").unionByName(found), k), "best")
        kth = best.where(F.col("rank") == k).select("query", "score").toArrow()  # a row for each query of the wave
        least[kth.column("query").to_numpy()] = kth.column("score").to_numpy().astype(float)
        begin, end = end, 2 * end + 1
    return best


def top_k(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best inner products among all other rows.

    ``vectors`` has vec_id and vector, an array of whole numbers as doubles; ``is_query`` is a condition on
    vec_id.  Vectors that are null or hold a null or non-finite component, and rows with a null vec_id,
    take no part.  Rows that share a vec_id stay different candidates, and different queries with ranks of their
    own.  Vectors of different dimension never meet, and those without components have no neighbours.  Scores
    are exact; one that does not fit a long is an error.
    """
    spark = vectors.sparkSession
    tables = Stages(spark, "top-k")
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    clean = vectors.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(whole & (F.size("vector") > 0))
    clean = tables.write(clean.select(  # stored, so that a row keeps its number
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), "vector",
        F.size("vector").alias("dim"), F.coalesce(is_query, F.lit(False)).alias("asks"),
    ), "vectors")
    results = None
    per = clean.groupBy("dim").agg(F.count("*").alias("n"), F.count(F.when(F.col("asks"), 1)).alias("m"))
    for dim, n, m in per.where("m > 0").orderBy("dim").toLocalIterator():
        mine = clean.where(F.col("dim") == dim).drop("dim")
        shards, waves = -(-n * dim // SHARD_VALUES), -(-m * dim // WAVE_VALUES)
        dealt = mine.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).drop("asks")
        trees = tables.write(
            dealt.repartition(min(shards, MOST_TASKS), "shard").groupBy("shard").applyInArrow(
                _build_shard, "shard long, tree binary"), "trees")
        for number in range(waves):
            wave = mine.where(F.col("asks") & (F.pmod(F.xxhash64("row", F.lit(1)), F.lit(waves)) == number))
            best = _search_wave(tables, trees, shards, wave.select("row", "vec_id", "vector").toArrow(), k)
            best = best.select("query_id", "rank", "vec_id", "score")
            results = results or f"{tables.base}/results"
            best.write.mode("append").parquet(results)
    if results is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(results)
