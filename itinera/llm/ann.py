"""Nearest neighbours by a block matrix join.

Query and base vectors are packed into blocks; every query block meets every
base block once (a grid of bounded tasks).  In a task the vectors are int8
codes with a scale of their own; one product tile of the codes gives all
approximate inner products, and the norms of the quantisation residues bound
their error (Cauchy-Schwarz).  Pairs whose lower bound beats the current k-th
upper bound are recomputed in double precision and merged by heaps; at most k
rows per query leave a task, and a partial top-k precedes the last shuffle.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from itinera.llm.common import table


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the coded vectors, norms of the residues."""
    scale = np.abs(x).max(axis=1) / 127.0
    scale[scale == 0] = 1.0
    codes = np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8)
    coded = codes * scale[:, None]
    slack = 1 + 1e-9
    return codes, scale, np.sqrt((coded ** 2).sum(1)) * slack, np.sqrt(((x - coded) ** 2).sum(1)) * slack


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances of one query, components added in order."""
    acc = np.zeros(len(x))
    for j in range(x.shape[1]):
        d = x[:, j] - q[j]
        acc += d * d
    return np.sqrt(acc)


def block_top(qid, q, xid, x, k, tile=2048):
    """The k nearest of this base block for each query: (query's position, vec, distance)."""
    qc, qs, qn, qe = quantise(q)
    q2 = (q ** 2).sum(1)
    best: list[list[tuple[float, int]]] = [[] for _ in qid]
    # products of int8 codes stay exact in float32 up to 2**24
    kind = np.float32 if q.shape[1] * 127 * 127 < 2 ** 24 else np.float64
    for at in range(0, len(xid), tile):
        xs, ids = x[at:at + tile], xid[at:at + tile]
        xc, sc, xn, xe = quantise(xs)
        dot = (qc.astype(kind) @ xc.T.astype(kind)).astype(np.float64) * qs[:, None] * sc[None, :]
        err = qn[:, None] * xe[None, :] + qe[:, None] * (xn + xe)[None, :]
        d2 = q2[:, None] + (xs ** 2).sum(1)[None, :] - 2 * dot
        err = 2 * err + 1e-9 * (np.abs(d2) + 1)
        low, high = d2 - err, d2 + err
        high[qid[:, None] == ids[None, :]] = np.inf
        low[qid[:, None] == ids[None, :]] = np.inf
        for i in range(len(qid)):
            kth = np.partition(high[i], k - 1)[k - 1] if len(ids) >= k else np.inf
            if len(best[i]) >= k:
                kth = min(kth, best[i][-1][0] ** 2 * (1 + 1e-9))
            near = np.flatnonzero((low[i] <= kth) & np.isfinite(low[i]))
            if len(near):
                found = zip(distances(q[i], xs[near]).tolist(), ids[near].tolist())
                best[i] = heapq.nsmallest(k, [*best[i], *found])
    return [(i, v, d) for i, top in enumerate(best) for d, v in top]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, query_block: int = 256,
            base_block: int = 4096, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k nearest rows of ``vectors`` for every row of ``queries``: query_id,
    rank from 1, vec_id, score (Euclidean distance, double).

    A query never finds rows of its own id; ties go to the smaller id.  Queries that share an
    id and differ in their vector have a list each, under the same query_id.  Null,
    zero, non-finite vectors and null ids take no part; equal rows (id and
    vector) count once; vectors meet only those of their own length.  With
    fewer than k candidates all are returned; empty tables give no rows.
    """
    def valid(df):
        v = F.col(vec_col).cast("array<double>")
        ok = (F.col(id_col).isNotNull() & v.isNotNull() & F.exists(v, lambda x: x != 0)
              & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
        return (df.filter(F.coalesce(ok, F.lit(False)))
                .select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.size(v).alias("dim"))
                .dropDuplicates(["id", "v"]))

    base, asked = valid(vectors), valid(queries)
    n_base = max(1, -(-base.count() // base_block))
    n_ask = max(1, -(-asked.count() // query_block))
    asked = asked.withColumn("own", F.xxhash64("id", "v"))
    hashed = lambda n: F.pmod(F.xxhash64("id", F.lit(7)), F.lit(n)).cast("int")
    left = (asked.withColumn("qb", hashed(n_ask))
            .withColumn("bb", F.explode(F.sequence(F.lit(0), F.lit(n_base - 1)))))
    right = (base.withColumn("bb", hashed(n_base))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_ask - 1)))))

    def tile(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(a) and len(b):
            ids, own = a["id"].tolist(), a["own"].tolist()
            rows = [(ids[i], own[i], v, d) for i, v, d in block_top(
                a["id"].to_numpy(), np.stack(a["v"].to_numpy()), b["id"].to_numpy(), np.stack(b["v"].to_numpy()), k)]
        return pd.DataFrame(rows, columns=["query_id", "own", "vec_id", "score"])

    keys = ["qb", "bb", "dim"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        tile, "query_id long, own long, vec_id long, score double")
    w = Window.partitionBy("query_id", "own").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (
  SELECT q.vec_id AS query_id, b.vec_id AS vec_id, sqrt(list_reduce(list_transform(range(1, len(q.e) + 1),
           lambda i: (b.e[i] - q.e[i]) * (b.e[i] - q.e[i])), lambda x, y: x + y)) AS score
  FROM v q JOIN v b ON q.vec_id <> b.vec_id AND len(q.e) = len(b.e)
  WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rn FROM d)
SELECT query_id, CAST(rn AS INTEGER) AS rank, vec_id, score FROM r WHERE rn <= 10
"""
