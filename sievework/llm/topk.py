"""Exact top-k inner-product search by a three-phase uniform threshold."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a block of vectors and of a block of queries; a task scores one block against another.
ITEM_BLOCK, QUERY_BLOCK = 65_536, 16_384
#: Parts into which the components are divided; each is a node with its own list of partial scores.
NODES = 4
#: Scores held at a time, and the share of them up to which the rest of each is worked out on its own.
CHUNK_CELLS, FEW = 4_000_000, 0.05


def quantised(embedding: Column) -> Column:
    """``floor(64 * x)`` of every component; null if the vector or a component is null or not finite."""
    fine = ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(embedding.isNotNull() & F.coalesce(fine, F.lit(False)), F.transform(embedding, lambda x: F.floor(x.cast("double") * 64).cast("long")))


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers, shorter vectors padded with zeros."""
    flat = lists.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) and flat.num_chunks else flat
    lengths = np.asarray(pa.compute.list_value_length(flat).to_numpy(zero_copy_only=False), np.int64)
    values = np.asarray(flat.flatten().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


class _Pair:
    """A block of queries and a block of vectors, divided into nodes by components."""

    def __init__(self, queries: pa.Table, items: pa.Table):
        width = max(1, *(int(pa.compute.max(pa.compute.list_value_length(x)).as_py() or 0) for x in (queries["q"], items["vector"])))
        q, v = _matrix(queries["q"], width), _matrix(items["vector"], width)
        self.query_ids, self.ids = queries["query_id"].to_numpy(), items["vec_id"].to_numpy()
        order = np.argsort(self.ids, kind="stable")
        v, self.ids = v[order], self.ids[order]
        largest = lambda x: max(float(x.max(initial=0)), -float(x.min(initial=0)))
        bound = largest(q) * largest(v) * width
        if bound >= 2**63:
            raise OverflowError("inner products of these vectors can pass 64 bits")
        kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64  # whole numbers, kept exactly
        cuts = np.linspace(0, width, min(NODES, width) + 1).astype(int)
        self.parts = [(np.ascontiguousarray(q[:, a:b].astype(kind)), np.ascontiguousarray(v[:, a:b].T.astype(kind))) for a, b in zip(cuts, cuts[1:], strict=False)]
        #: Norms of the components after each node: no sum over those exceeds their product.
        self.rests = [tuple(np.sqrt((x[:, b:].astype(float) ** 2).sum(axis=1)) for x in (q, v)) for b in cuts[1:]]
        self.lowest = -np.inf if kind != np.int64 else np.iinfo(np.int64).min

    def chunks(self):
        """Rows of queries, and which cells are the query's own row."""
        step = max(1, CHUNK_CELLS // max(1, len(self.ids)))
        for a in range(0, len(self.query_ids), step):
            rows = slice(a, a + step)
            yield rows, self.query_ids[rows, None] == self.ids[None, :] if len(self.ids) else np.zeros((len(self.query_ids[rows]), 0), bool)


def _gather(k: int):
    """Phase 1: the rows that lead each node's local list, and the k best whole scores among them."""

    def run(queries: pa.Table, items: pa.Table) -> pa.Table:
        pair, out = _Pair(queries, items), []
        n = len(pair.ids)
        m = min(k + 1, n)  # one may be the query itself
        for rows, own in pair.chunks():
            scores = [q[rows] @ v for q, v in pair.parts]
            near = np.concatenate([np.argpartition(s, n - m, axis=1)[:, n - m :] for s in scores], axis=1) if n else np.zeros((len(own), 0), int)
            near.sort(axis=1)
            found = sum(np.take_along_axis(s, near, axis=1) for s in scores)
            found[np.take_along_axis(own, near, axis=1)] = pair.lowest
            found[:, 1:][near[:, 1:] == near[:, :-1]] = pair.lowest  # listed by several nodes
            found = np.sort(found, axis=1)[:, ::-1][:, :k]
            out += [[int(x) for x in row if x > pair.lowest] for row in found]
        return pa.table({"query_id": queries["query_id"], "query_row": queries["query_row"], "scores": pa.array(out, pa.list_(pa.int64()))})

    return run


def _survivors(pair: _Pair, rows: slice, own: np.ndarray, cutoff: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries, vectors and whole scores of the pairs that reach the cutoff, node by node.

    After each node, pairs go whose score so far and largest rest stay below. Once few are left, only their
    missing parts are worked out. Pairs that no node lists, at a part of at least its share of the cutoff, go too.
    """
    share, last = cutoff / len(pair.parts) - 1, len(pair.parts) - 1
    total, listed, q, i = 0, np.zeros(own.shape, bool), None, None
    near = np.float32 if pair.parts[0][0].dtype == np.float32 else np.float64  # for bounds, which have room for rounding
    for j, ((part_q, part_v), (rest_q, rest_v)) in enumerate(zip(pair.parts, pair.rests, strict=True)):
        if q is None:
            part = part_q[rows] @ part_v
            total = total + part
            listed |= part >= share[:, None].astype(part.dtype if near == np.float32 else float)
            if j == last:
                alive = total >= cutoff[:, None].astype(near)
            elif 2 * j + 2 >= last:  # before, the rest is too large to tell
                most = np.multiply.outer(rest_q[rows].astype(near), (-1.00001 * rest_v).astype(near))
                most += (cutoff[:, None] - 1).astype(near)
                alive = total >= most
            else:
                continue
            if j == last or np.count_nonzero(alive) <= FEW * alive.size:
                q, i = np.nonzero(alive & ~own)
                total, listed = total[q, i], listed[q, i]
        else:
            part = np.einsum("ij,ji->i", part_q[rows][q], part_v[:, i])
            total = total + part
            listed |= part >= share[q]
            alive = total >= cutoff[q] - rest_q[rows][q] * rest_v[i]
            q, i, total, listed = q[alive], i[alive], total[alive], listed[alive]
    return q[listed], i[listed], total[listed].astype(np.int64)


def _resolve(k: int):
    """Phases 2 and 3: what reaches the cutoff at any node is collected, and its missing parts are resolved."""

    def run(queries: pa.Table, items: pa.Table) -> pa.Table:
        pair, out = _Pair(queries, items), []
        cutoffs = queries["cutoff"].to_pandas().to_numpy(dtype=float, na_value=-np.inf)
        cutoffs = np.where(np.isinf(cutoffs), cutoffs, cutoffs - 1e-9 * np.abs(cutoffs) - 1)  # never above the whole number
        for rows, own in pair.chunks():
            q, i, exact = _survivors(pair, rows, own, cutoffs[rows])
            order = np.lexsort((pair.ids[i], -exact, q))
            q, i, exact = q[order], i[order], exact[order]
            first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, int)
            best = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)])) < k
            at = q[best] + rows.start
            out.append(pa.table({"query_id": queries["query_id"].take(pa.array(at)), "query_row": queries["query_row"].take(pa.array(at)), "vec_id": pair.ids[i[best]], "score": exact[best]}))
        return pa.concat_tables(out) if out else pa.table({"query_id": pa.array([], pa.int64()), "query_row": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})

    return run


def top_k(items: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` rows of ``items`` (``vec_id``, ``q`` integers) with the largest inner product for each query.

    ``queries``: ``query_id``, ``q``; a row of items with the query's id is no candidate of that query, all
    others are. Ties go to the smaller ``vec_id``. Equal query rows count once; rows of ``items`` that
    repeat are candidates each. Shorter vectors count as padded with zeros. Null vectors and ids take no part,
    other columns are left out, and an empty table gives an empty one. Components so large that a score might
    pass 64 bits stop the query with an ``OverflowError``.

    Both sides are hashed into blocks and every block of queries meets every block of vectors; a vector is
    sent once for each block of ``QUERY_BLOCK`` queries. The components are divided into nodes, each with a list
    of partial scores. Phase 1 gathers, per pair of blocks, the rows that lead a node's list, and sums theirs
    only; the k-th best whole score seen anywhere is a safe cutoff, for k rows reach it. Phase 2 gives it back to
    all blocks: a row that reaches the cutoff has at some node at least the cutoff over the number of nodes, so
    rows that no node lists go, as do rows whose parts so far and largest rest stay below. Phase 3 resolves
    the missing parts of what is left.
    """
    spark = items.sparkSession
    items = items.filter(F.col("q").isNotNull() & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("q").alias("vector"))
    queries = queries.filter(F.col("q").isNotNull() & F.col("query_id").isNotNull()).select(F.col("query_id").cast("long").alias("query_id"), F.col("q").alias("q")).distinct()
    least = max(2, spark.sparkContext.defaultParallelism)
    n_item = max(least, -(-items.count() // ITEM_BLOCK))
    n_query = max(1, -(-queries.count() // QUERY_BLOCK))
    queries = queries.withColumn("query_row", F.xxhash64("query_id", "q")).withColumn("qb", F.pmod(F.col("query_row"), F.lit(n_query)))
    copies = F.explode(F.sequence(F.lit(0), F.lit(n_item - 1))).alias("ib")
    held = items.withColumn("ib", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n_item)).cast("int"))
    held = held.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_query - 1))).alias("qb")).withColumn("qb", F.col("qb").cast("long")).groupBy("qb", "ib")

    lists = queries.select("*", copies).groupBy("qb", "ib").cogroup(held).applyInArrow(_gather(k), "query_id long, query_row long, scores array<long>")
    seen = lists.select("query_id", "query_row", F.explode("scores").alias("score"))
    by_score = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"))
    ranked = seen.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    cutoffs = ranked.filter(F.col("rank") == k).select("query_id", "query_row", F.col("score").alias("cutoff"))

    sent = queries.join(cutoffs, ["query_id", "query_row"], "left").select("query_id", "query_row", "q", "cutoff", "qb")
    found = sent.select("*", copies).groupBy("qb", "ib").cogroup(held).applyInArrow(_resolve(k), "query_id long, query_row long, vec_id long, score long")
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", quantised(F.col("embedding")).alias("q"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0).withColumnRenamed("vec_id", "query_id"), 20)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
