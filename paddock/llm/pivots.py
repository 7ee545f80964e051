"""Exact top-k inner-product search by pivot-table elimination.

Every vector keeps its distances to ``pivots`` fixed vectors (the table). For a
query q and a candidate x the triangle inequality gives d(q, x) >= max over the
pivots of |d(q, p) - d(x, p)|, and since 2<q, x> = |q|^2 + |x|^2 - d(q, x)^2,
the largest lower bound on the distance is an upper bound on the score. The
candidates of a query are evaluated in the order of that bound, a slice at a
time, until the next bound is below the k-th best score found: an exact stop.

Vectors are cut into blocks by a hash of their id, so a block holds about
``block_rows`` rows whatever the table's size. Each pair (query block,
candidate block) is one cell, one row of a join on the block number; a cell
returns its k best per query and a ranking keeps the k best of all cells. The
queries are a stated set; no pair of rows is ever a row of a frame.

Pivots are the ``pivots`` vectors of smallest hashed id (a bounded sample; any
choice gives exact results, it only moves the bounds).

Scores are integers: components become floor(scale * x), an integer in double
precision. Vectors that are null, empty, or hold a component that is null or (after
scaling) non-finite take no part, nor do null ids. Vectors of another length than
the query's are no candidates of it. Repeated rows (same id, same vector) count
once, and a query never matches its own id. An id with several different vectors
takes part with each of them: as a query they share one ranking, as candidates each
has its own row. Ties go to the smaller id. Columns besides id and vector are not read.

Scores are exact for components of any size: a product whose sum may leave 2^53 is
computed in 64-bit integers, one that may leave 2^62 in unbounded ones. Rankings
go by the exact value; the ``score`` column holds the nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
PIVOTS = 32
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
SLICE = 256
_FLOAT, _LONG = 2.0 ** 53, 2.0 ** 62          # sums below are exact in double and in 64-bit arithmetic
_MIN, _MAX = -2 ** 63, 2 ** 63 - 1
_WIDE = 600                                   # bytes: a sum of products of scaled doubles has fewer than 2,200 bits


def integer_vectors(df: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(id, v): distinct usable vectors as arrays of floor(scale * x)."""
    def whole(e: Column) -> Column:
        e = e.cast("double") * scale
        return (F.when(F.abs(e) < _FLOAT, F.floor(e).cast("double"))
                 .when(~F.isnan(e) & (F.abs(e) < float("inf")), e))          # beyond 2^53 every double is whole

    return (df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("raw"))
              .filter("id is not null and raw is not null and size(raw) > 0")
              .select("id", F.transform("raw", whole).alias("v"))
              .filter(F.forall("v", lambda e: e.isNotNull()))
              .dropDuplicates(["id", "v"]))


def _pivot_table(v: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances to the pivots and bounds on their errors, both vectors by pivots."""
    size = (v * v).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :]
    d2 = np.maximum(size - 2 * (v @ pivots.T), 0)
    off = (2 * v.shape[1] + 16) * np.finfo(float).eps * size
    if 2 * size.max(initial=0) < _FLOAT:
        off[:] = 0                                     # sums of whole numbers below 2^53 carry no error
    d = np.sqrt(d2)
    # sqrt(d2 + off) - sqrt(d2) <= off / sqrt(d2) and <= sqrt(off); a float32 is off by a share of 2^-23 or so
    err = np.minimum(np.sqrt(off), off / np.maximum(d, 1e-300)) + 1e-6 * d
    good = np.isfinite(d) & (d < 1e18)                 # keeps float32 and its square finite: no bound beyond
    return np.where(good, d, 0).astype(np.float32), np.where(good, err, np.inf).astype(np.float32)


def _bounds(q: np.ndarray, c: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Upper bounds on the inner products, queries by candidates."""
    with np.errstate(over="ignore", invalid="ignore"):
        (dq, eq), (dc, ec) = _pivot_table(q, pivots), _pivot_table(c, pivots)
    low = np.zeros((len(q), len(c)), np.float32)
    for p in range(dq.shape[1]):                       # one pivot at a time bounds the memory
        gap = np.abs(dq[:, p, None] - dc[None, :, p])
        gap -= eq[:, p, None]
        gap -= ec[None, :, p]
        np.maximum(low, gap, out=low)
    size = (q * q).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :]
    low = low.astype(np.float64)
    return (size - low * low) / 2 + (2 * q.shape[1] + 16) * np.finfo(float).eps * size


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of one vector with others: int64, or Python integers beyond it."""
    top = np.abs(q).max() * np.abs(c).max() * len(q)
    if top < _FLOAT:
        return (c @ q).astype(np.int64)
    if top < _LONG and max(np.abs(q).max(), np.abs(c).max()) < _LONG:
        return c.astype(np.int64) @ q.astype(np.int64)
    big = [int(x) for x in q]
    return np.array([sum(int(x) * y for x, y in zip(row, big, strict=True)) for row in c] + [None], object)[:-1]


def search_cell(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, pivots: np.ndarray,
                k: int) -> tuple[np.ndarray, np.ndarray, list[int], int]:
    """The k best candidates of each query in one cell: (query row, candidate
    row, score) and the number of products evaluated."""
    upper = _bounds(q, c, pivots) if len(pivots) else np.full((len(q), len(c)), np.inf)
    rows, cols, scores, work = [], [], [], 0
    large = np.abs(c).max(axis=1)
    for i in range(len(q)):
        up = upper[i]
        order = np.argsort(-up, kind="stable")
        order = order[cid[order] != qid[i]]
        best = np.empty(0, np.int64)
        got = np.empty(0, np.int64)
        exact = np.abs(q[i]).max() * len(q[i])
        for lo in range(0, len(order), SLICE):
            part = order[lo:lo + SLICE]
            if len(best) == k and float(up[part[0]]) < int(got[-1]):
                break
            work += len(part)
            best = np.concatenate((best, part))
            if exact * large[part].max() < _FLOAT:
                new = (c[part] @ q[i]).astype(np.int64)
            else:                                      # large vectors one by one, each in the width it needs
                new = np.concatenate([_products(q[i], c[j:j + 1]) for j in part])
            got = np.concatenate((got, new))
            if got.dtype == object:
                top = np.array(sorted(range(len(got)), key=lambda j: (-got[j], cid[best[j]]))[:k])
            else:
                top = np.lexsort((cid[best], -got))[:k]
            best, got = best[top], got[top]
        rows.append(np.full(len(best), i))
        cols.append(best)
        scores += [int(s) for s in got]
    return np.concatenate(rows), np.concatenate(cols), scores, work


def _wide(score: int) -> bytes:
    """Bytes that order scores which share the first or last long; empty for all others."""
    return b"" if _MIN < score < _MAX else (score + (1 << 8 * _WIDE - 1)).to_bytes(_WIDE, "big")


def _block(v: DataFrame, rows: int, total: int) -> DataFrame:
    """(dim, block, ids, vecs): packed blocks of about ``rows`` vectors."""
    n = max(1, -(-total // rows))

    def pack(t: pa.Table) -> pa.Table:
        m = t.column("v").combine_chunks()
        flat = m.flatten().to_numpy(zero_copy_only=False)
        ids = t.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        dim = len(flat) // len(ids)
        return pa.table({"dim": t.column("dim").slice(0, 1), "block": t.column("block").slice(0, 1),
                         "ids": pa.array([ids[order].astype(np.int64).tobytes()], pa.binary()),
                         "vecs": pa.array([flat.reshape(-1, dim)[order].astype(np.float64).tobytes()], pa.binary())})

    return (v.withColumn("dim", F.size("v")).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)))
             .groupBy("dim", "block").applyInArrow(pack, "dim int, block long, ids binary, vecs binary"))


def top_k(df: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
          scale: int = SCALE, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query row.

    ``is_query``: a condition on the id, written on the column ``id``.
    """
    v = integer_vectors(df, vec_id, vector, scale)
    queries = v.filter(is_query)
    size = v.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    some = (v.withColumn("dim", F.size("v")).withColumn("h", F.xxhash64("id", F.lit(7)))
             .orderBy("h", "id").limit(pivots).select("v").collect())
    table = [np.array(r["v"]) for r in some]
    n_q = max(1, -(-size["q"] // query_rows))
    cand = _block(v, block_rows, size["n"]).withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    ask = (_block(queries, query_rows, size["q"])
           .select(F.col("dim").alias("qdim"), F.col("block").cast("int").alias("qcell"),
                   F.col("ids").alias("qids"), F.col("vecs").alias("qvecs")))
    cells = (cand.join(ask, (F.col("cell") == F.col("qcell")) & (F.col("dim") == F.col("qdim")))
                 .select("dim", "ids", "vecs", "qids", "qvecs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, ids, vecs, qids, qvecs in zip(*[c.to_pylist() for c in b.columns], strict=True):
                cid, qid = np.frombuffer(ids, np.int64), np.frombuffer(qids, np.int64)
                c, q = (np.frombuffer(x).reshape(-1, dim) for x in (vecs, qvecs))
                p = np.array([x for x in table if len(x) == dim]).reshape(-1, dim)
                i, j, s, _ = search_cell(qid, q, cid, c, p, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qid[i]), pa.array(cid[j]),
                     pa.array([min(max(x, _MIN), _MAX) for x in s], pa.int64()),
                     pa.array([_wide(x) for x in s], pa.binary())],
                    ["query_id", "vec_id", "score", "wide"])

    found = cells.mapInArrow(run, "query_id long, vec_id long, score long, wide binary")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("wide"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
                 .select("query_id", "rank", "vec_id", "score"))
