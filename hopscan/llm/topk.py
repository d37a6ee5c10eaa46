"""Exact top-k search by integer inner product with multi-resolution segment statistics.

Each component x becomes floor(64 x). For unit segments of a vector, mean and deviation bound the
distance from below: |q - v|^2 >= sum of length * ((mean difference)^2 + (deviation difference)^2),
which for the inner product means q.v <= sum of length * (mean_q mean_v + dev_q dev_v). The bound
is taken with 1, 4 and 16 segments; a vector is dropped from a query once its bound falls below the query's
k-th best exact score, and exact scores are computed for the survivors only.

Rows are packed into blocks and query rows into query blocks; a task handles one query block and one
stripe of row blocks, keeping k rows per query. Replication is one copy of the rows per query block
of ``QUERY_BLOCK`` queries, never one per query; a hot label or value plays no part.

Vectors that are null or hold null or non-finite components are left out; vectors of different
lengths are not compared. Rows with the query's own vec_id are not candidates for it; repeated rows count one by
one. Null vec_ids are left out. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

SCALE, EVERY, TOP = 64, 20, 20
SEGMENTS = (1, 4, 16)
ROW_BLOCK, QUERY_BLOCK, STRIPE_BLOCKS = 2048, 4096, 8
#: Largest inner product that doubles hold exactly.
EXACT = float(1 << 53)


def statistics(v: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each segment, scaled so that their inner products add up to the bound."""
    parts = np.array_split(np.arange(v.shape[1]), min(segments, v.shape[1]))
    out = []
    for p in parts:
        x = v[:, p]
        root = np.sqrt(len(p))
        out += [x.mean(axis=1) * root, x.std(axis=1) * root]
    return np.stack(out, axis=1)


def _slack(bound: np.ndarray) -> np.ndarray:
    """A bound made safe against rounding."""
    return bound + 1e-9 * np.abs(bound) + 1e-6


class Best:
    """The k best (score, vec_id) of each query so far."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.score = np.full((n, k), np.iinfo(np.int64).min, np.int64)
        self.id = np.full((n, k), np.iinfo(np.int64).max, np.int64)
        self.full = np.zeros(n, np.int64)

    def floor(self) -> np.ndarray:
        return np.where(self.full >= self.k, self.score[:, -1].astype(np.float64), -np.inf)

    def add(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Merge survivors given by query; only queries with survivors are touched."""
        if not len(q):
            return
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        first = np.flatnonzero(np.diff(q, prepend=-1))
        for a, b in zip(first, np.append(first[1:], len(q)), strict=True):
            i, b = q[a], min(b, a + self.k)
            n = min(self.full[i], self.k)
            s, d = np.concatenate([self.score[i, :n], scores[a:b]]), np.concatenate([self.id[i, :n], ids[a:b]])
            top = np.lexsort((d, -s))[: self.k]
            self.score[i, : len(top)], self.id[i, : len(top)] = s[top], d[top]
            self.full[i] = len(top)


def _exact(queries: np.ndarray, rows: np.ndarray, alive: np.ndarray, exact: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """(query, row, score) of the survivors: side by side where many survive, pair by pair where few do."""
    kind = np.float64 if exact else np.int64
    if alive.sum() > 0.01 * alive.size:
        some_q, some_r = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        scores = queries[some_q].astype(kind) @ rows[some_r].astype(kind).T
        q, r = np.nonzero(alive[np.ix_(some_q, some_r)])
        yield some_q[q], some_r[r], scores[q, r].astype(np.int64)
        return
    q, r = np.nonzero(alive)
    for a in range(0, len(q), 1 << 16):
        x, y = q[a : a + (1 << 16)], r[a : a + (1 << 16)]
        yield x, y, np.einsum("ij,ij->i", queries[x].astype(kind), rows[y].astype(kind)).astype(np.int64)


def search(queries: np.ndarray, query_ids: np.ndarray, blocks: Iterator[tuple[np.ndarray, np.ndarray]], k: int) -> Best:
    """Best rows of some blocks for each query."""
    best = Best(len(queries), k)
    q_stats = [statistics(queries, s) for s in SEGMENTS]
    q_most = np.abs(queries).max(initial=0)
    for rows, ids in blocks:
        v_stats = [statistics(rows, s) for s in SEGMENTS]
        exact = q_most * np.abs(rows).max(initial=0) * rows.shape[1] < EXACT
        for lo in range(0, len(queries), 256):  # a few queries at a time bound the memory
            hi = min(lo + 256, len(queries))
            floor = best.floor()[lo:hi]
            alive = _slack(q_stats[0][lo:hi] @ v_stats[0].T) >= floor[:, None]
            alive &= query_ids[lo:hi, None] != ids[None, :]
            for qs, vs in zip(q_stats[1:], v_stats[1:], strict=True):
                if not alive.any():
                    break
                alive &= _slack(qs[lo:hi] @ vs.T) >= floor[:, None]
            for q, r, scores in _exact(queries[lo:hi], rows, alive, exact):
                good = scores >= floor[q]
                best.add(lo + q[good], ids[r[good]], scores[good])
    return best


def _blocks(column: pa.Array, ids: np.ndarray, size: int) -> Iterator[dict[str, object]]:
    """Blocks of at most ``size`` vectors of one length: dim, ids, values as bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    dims = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy().astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(dims)])
    for dim in np.unique(dims):
        which = np.flatnonzero(dims == dim)
        for a in range(0, len(which), size):
            some = which[a : a + size]
            at = starts[some][:, None] + np.arange(dim)
            yield {"dim": int(dim), "ids": ids[some].tobytes(), "data": values[at].tobytes()}


_BLOCK = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())])


def _packed(rows: DataFrame) -> DataFrame:
    """Blocks of all rows as they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist(list(_blocks(batch.column(1), batch.column(0).to_numpy(), ROW_BLOCK)), _BLOCK)

    return rows.mapInArrow(run, "dim int, ids binary, data binary")


def _query_blocks(rows: DataFrame, n: int) -> DataFrame:
    """Query vectors dealt to n blocks, row by row, so that rows of one id spread too."""
    schema = _BLOCK.append(pa.field("block", pa.int64()))

    def pack(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        found = _blocks(table.column("v"), table.column("vec_id").to_numpy(), table.num_rows)
        return pa.Table.from_pylist([f | {"block": block} for f in found], schema)

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(n)))
    return dealt.groupBy("block").applyInArrow(pack, "dim int, ids binary, data binary, block long")


def _arrays(ids: bytes, data: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(data, np.int64).reshape(-1, dim).astype(np.float64), np.frombuffer(ids, np.int64)


def top_k(vectors: DataFrame, every: int = EVERY, k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows of every query."""
    x = F.col("embedding")
    usable = x.isNotNull() & F.col("vec_id").isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.filter(F.coalesce(usable, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("v"))
    n = rows.count()
    n_stripes = max(1, -(-n // (ROW_BLOCK * STRIPE_BLOCKS)))
    n_queries = max(1, -(-n // every // QUERY_BLOCK))
    numbers = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
    right = _packed(rows).withColumn("stripe", F.pmod(F.xxhash64("ids"), F.lit(n_stripes))).withColumn("block", numbers(n_queries))
    asked = _query_blocks(rows.filter(F.pmod("vec_id", F.lit(every)) == 0), n_queries)
    left = asked.withColumn("stripe", numbers(n_stripes))

    def best_of(queries: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, q in queries.iterrows():
            vectors, ids = _arrays(q["ids"], q["data"], q["dim"])
            same = blocks[blocks["dim"] == q["dim"]]
            best = search(vectors, ids, (_arrays(i, d, q["dim"]) for i, d in zip(same["ids"], same["data"], strict=True)), k)
            number, place = np.nonzero(np.arange(k)[None, :] < best.full[:, None])
            # Several query rows may share an id: number and length tell them apart.
            out.append(pd.DataFrame({"block": q["block"], "number": number + (int(q["dim"]) << 32), "query_id": ids[number],
                                     "vec_id": best.id[number, place], "score": best.score[number, place]}))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("block", "number", "query_id", "vec_id", "score")}, dtype="int64")

    found = left.groupBy("block", "stripe").cogroup(right.groupBy("block", "stripe")).applyInPandas(
        best_of, "block long, number long, query_id long, vec_id long, score long")
    order = W.partitionBy("query_id", "block", "number").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
