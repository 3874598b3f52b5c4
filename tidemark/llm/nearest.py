"""Nearest neighbours by collision counting over sorted single-projection arrays.

Vectors are brought to one length (one more component takes up what a shorter one lacks), so that the
largest inner product is the smallest distance. The index cuts the vectors into blocks; a block holds,
for each of ``m`` orthonormal projections, its vectors' places in the sorted array of projected values.
A query opens a window around its own value in every array. Windows widen step by step (virtual
rehashing), and a vector that lies in at least ``collisions`` of the arrays' windows has reached the
threshold. A query stops widening in a block once a ``share`` of it, and no fewer than k, has; those
vectors, and no others, are verified by their exact inner products.

Query blocks meet candidate blocks in an equi-join of packed blocks. Every task holds one pair of
blocks, and the best of a query block are merged in groups of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, take

QUERY_BLOCK, BLOCK, MERGED = 1024, 2048, 32
PROJECTIONS, SEED = 64, 11
FIRST, WIDER = 1.2, 1.12
COLLISIONS, SHARE = 0.8, 0.2
SUB = 128


def usable(vectors: DataFrame, columns: Sequence[str] = ("vec_id", "embedding")) -> DataFrame:
    """Rows whose vector is whole: not NULL or empty, all components finite, not all zero."""
    vec_id, embedding = columns
    rows = take(vectors, vec_id, embedding).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding")
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("embedding", lambda x: x != 0)
    return rows.filter(F.col("vec_id").isNotNull() & F.coalesce(finite & some, F.lit(False)))


def _pack(size: int, dim: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list[np.ndarray] = []
        rows: list[np.ndarray] = []

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({"ids": [np.concatenate(ids).tobytes()], "vectors": [np.concatenate(rows).tobytes()]})
            ids.clear(), rows.clear()
            return out

        for batch in batches:
            for at in range(0, len(batch), size):
                part = batch.iloc[at : at + size]
                ids.append(part["vec_id"].to_numpy(dtype=np.int64))
                rows.append(np.stack(part["embedding"].to_list()).astype(np.float64).reshape(-1, dim))
                if sum(map(len, ids)) >= size:
                    yield flush()
        if ids:
            yield flush()

    return run


def _packed(rows: DataFrame, size: int, count: int, dim: int, name: str) -> DataFrame:
    """One row per block of at most twice ``size`` vectors, numbered from 0; written once."""
    dealt = rows.repartition(max(1, -(-count // size)))
    blocks = stored(dealt.mapInPandas(_pack(size, dim), "ids binary, vectors binary"), "vector-blocks")
    return stored(blocks.withColumn(name, F.monotonically_increasing_id()), "vector-blocks")


def projections(dim: int, m: int = PROJECTIONS) -> np.ndarray:
    """dim x m with orthonormal columns; more than ``dim`` projections take further bases."""
    rng = np.random.default_rng(SEED)
    bases = [np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(-(-m // dim))]
    return np.concatenate(bases, axis=1)[:, :m]


def lifted(vectors: np.ndarray, longest: float, queries: bool) -> np.ndarray:
    """All of length ``longest``: queries are stretched, vectors get one more component."""
    length = np.sqrt((vectors**2).sum(axis=1))
    if queries:
        return np.hstack([vectors * (longest / length)[:, None], np.zeros((len(vectors), 1))])
    return np.hstack([vectors, np.sqrt(np.maximum(longest**2 - length**2, 0))[:, None]])


def survivors(places: np.ndarray, arrays: np.ndarray, around: np.ndarray, unit: float, k: int, guess: int = 0) -> tuple[np.ndarray, int]:
    """Queries x vectors: who reached the threshold when its query stopped widening; and the step at which most stopped.

    places: per projection the vectors' places in the sorted array; arrays: the sorted values; around: queries' values.
    Windows nest, so a query's stop is looked for from step ``guess`` on, wider or narrower, and is the same for any guess.
    """
    m, n = places.shape
    need, enough = int(np.ceil(COLLISIONS * m)), min(n, max(k, int(np.ceil(SHARE * n))))
    out = np.zeros((len(around), n), dtype=bool)
    halves = [FIRST * unit]
    # Steps below ``low`` are too narrow, step ``high`` is wide enough (-1: not known yet).
    low, high = np.zeros(len(around), dtype=np.int64), np.full(len(around), -1)
    step, open_ = np.full(len(around), guess), np.arange(len(around))
    while len(open_):
        while len(halves) <= step[open_].max():
            halves.append(halves[-1] * WIDER)
        half = np.array(halves)[step[open_]]
        count = np.zeros((len(open_), n), dtype=np.uint8 if m < 256 else np.uint16)
        off, inside = np.empty(count.shape, dtype=np.uint16), np.empty(count.shape, dtype=bool)
        for j in range(m):
            first = np.searchsorted(arrays[j], around[open_, j] - half).astype(np.uint16)
            last = np.searchsorted(arrays[j], around[open_, j] + half, side="right").astype(np.uint16)
            # In the window first <= place < last; below first the difference wraps round to a large number.
            np.subtract(places[j][None, :], first[:, None], out=off)
            np.less(off, (last - first)[:, None], out=inside)
            np.add(count, inside.view(np.uint8), out=count)
        reached = count >= need
        wide = reached.sum(axis=1) >= enough
        out[open_[wide]] = reached[wide]
        high[open_[wide]] = step[open_[wide]]
        low[open_[~wide]] = step[open_[~wide]] + 1
        step[open_] += np.where(wide, -1, 1)
        open_ = open_[low[open_] != high[open_]]
    return out, int(np.median(high)) if len(high) else guess


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _search(dim: int, longest: float, k: int):
    base = projections(dim + 1)
    unit = longest / np.sqrt(dim + 1)

    def cell(query_ids, queries, ids, vectors) -> tuple[np.ndarray, np.ndarray]:
        values = lifted(vectors, longest, queries=False) @ base
        order = np.argsort(values, axis=0, kind="stable")
        arrays = np.ascontiguousarray(np.take_along_axis(values, order, axis=0).T)
        places = np.empty(values.shape[::-1], dtype=np.uint16)
        np.put_along_axis(places, np.ascontiguousarray(order.T), np.arange(len(values), dtype=np.uint16)[None, :], axis=1)
        around = lifted(queries, longest, queries=True) @ base
        found = np.full((len(queries), k), -1, dtype=np.int64)
        scores = np.full((len(queries), k), -np.inf)
        # A few queries tell where most stop.
        _, step = survivors(places, arrays, around[:4], unit, k + 1)
        for at in range(0, len(queries), SUB):
            reached, step = survivors(places, arrays, around[at : at + SUB], unit, k + 1, step)
            for i, row in enumerate(reached, start=at):
                near = np.flatnonzero(row)
                near = near[ids[near] != query_ids[i]]
                if len(near) > 2 * k:
                    # Products within rounding of the k-th largest, whose exact scores decide.
                    rough = vectors[near] @ queries[i]
                    slack = 1e-13 * dim * longest * np.sqrt((queries[i] ** 2).sum())
                    near = near[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - slack]
                exact = (vectors[near] * queries[i]).sum(axis=1)
                top = best_of(exact, ids[near], k)
                found[i, : len(top)], scores[i, : len(top)] = ids[near[top]], exact[top]
        return found, scores

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for q, b, q_ids, q_rows, ids, rows in batch[["q", "b", "q_ids", "q_vectors", "ids", "vectors"]].itertuples(index=False):
                query_ids = np.frombuffer(q_ids, dtype=np.int64)
                found, scores = cell(query_ids, np.frombuffer(q_rows).reshape(-1, dim), np.frombuffer(ids, dtype=np.int64), np.frombuffer(rows).reshape(-1, dim))
                yield pd.DataFrame({"q": [q], "b": [b], "q_ids": [q_ids], "found": [found.tobytes()], "scores": [scores.tobytes()]})

    return run


def _merge(k: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        found = np.hstack([np.frombuffer(x, dtype=np.int64).reshape(-1, k) for x in group["found"]])
        scores = np.hstack([np.frombuffer(x).reshape(-1, k) for x in group["scores"]])
        top = np.stack([np.lexsort((f, -s))[:k] for f, s in zip(found, scores, strict=True)])
        found, scores = np.take_along_axis(found, top, 1), np.take_along_axis(scores, top, 1)
        first = group.iloc[0]
        return pd.DataFrame({"q": [first["q"]], "b": [first["b"] // MERGED], "q_ids": [first["q_ids"]], "found": [found.tobytes()], "scores": [scores.tobytes()]})

    return run


def _rows(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for q_ids, found, scores in batch[["q_ids", "found", "scores"]].itertuples(index=False):
                ids, near = np.frombuffer(q_ids, dtype=np.int64), np.frombuffer(found, dtype=np.int64)
                out = pd.DataFrame({"query_id": np.repeat(ids, k), "rank": np.tile(np.arange(1, k + 1, dtype=np.int32), len(ids)), "vec_id": near, "score": np.frombuffer(scores)})
                yield out[out["score"] > -np.inf]

    return run


def nearest(vectors: DataFrame, k: int = 20, one_in: int = 20, columns: Sequence[str] = ("vec_id", "embedding")) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best found, nearest first, ties to the smaller vec_id.

    Queries are the usable rows whose id is divisible by ``one_in``; candidates are all usable rows but
    those of the query's own id. Rows with a NULL id, and vectors that are NULL, empty, zero or hold NULL
    or non-finite components, take no part, nor do those of another width than the most common one
    (the larger of equals). Repeated rows are candidates each, and repeated queries answer each. No
    usable rows give no rows; further columns are ignored.
    """
    rows = usable(vectors, columns).withColumn("dim", F.size("embedding"))
    rows = rows.withColumn("length", F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)))
    query = F.col("vec_id") % one_in == 0
    widths = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sum(query.cast("long")).alias("queries"), F.max("length").alias("longest"))
    first = widths.orderBy(F.desc("n"), F.desc("dim")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if first is None or not first["queries"]:
        return vectors.sparkSession.createDataFrame([], schema)
    dim, n, n_queries, longest = first["dim"], first["n"], first["queries"], first["longest"]
    rows = rows.filter(F.col("dim") == dim).select("vec_id", "embedding")
    blocks = _packed(rows, BLOCK, n, dim, "b")
    queries = _packed(rows.filter(query), QUERY_BLOCK, n_queries, dim, "q").toDF("q_ids", "q_vectors", "q")
    # Numbers of blocks only: the list of pairs is spread over the cluster, not over the driver.
    blocks = _numbered(blocks, "b")
    queries = _numbered(queries, "q")
    n_blocks, n_query_blocks = blocks.count(), queries.count()
    left = queries.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    right = blocks.withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_query_blocks - 1).cast("long"))))
    cells = left.join(right, ["q", "b"]).repartition(max(1, n_blocks * n_query_blocks // 4), "q", "b")
    packed = "q long, b long, q_ids binary, found binary, scores binary"
    best = cells.mapInPandas(_search(dim, longest, k), packed)
    while n_blocks > 1:
        best = best.groupBy("q", F.floor(F.col("b") / MERGED).alias("g")).applyInPandas(_merge(k), packed)
        n_blocks = -(-n_blocks // MERGED)
    return best.mapInPandas(_rows(k), schema)


def _numbered(blocks: DataFrame, name: str) -> DataFrame:
    """Blocks numbered 0, 1, ...: the counts of blocks per file part come to the driver, not the blocks."""
    part = F.shiftright(name, 33)
    counts = {r["p"]: r["n"] for r in blocks.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for p in sorted(counts):
        starts.append((p, total))
        total += counts[p]
    table = blocks.sparkSession.createDataFrame(starts, "p long, start long")
    inner = F.col(name).bitwiseAND((1 << 33) - 1)
    return (
        blocks.withColumn("p", part)
        .join(F.broadcast(table), "p")
        .withColumn(name, F.col("start") + inner)
        .drop("p", "start")
    )
