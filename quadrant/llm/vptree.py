"""Approximate nearest neighbours (operator 6): vantage-point trees per shard.

Nearness is the largest inner product. Vectors of a shard are lifted by one
coordinate so that all have the same length M; then the squared distance from a
query q is |q|^2 + M^2 - 2 q.x, so the nearest points are those with the largest
inner products, and the triangle inequality holds. A tree node splits its points
at the median distance from a vantage point. A branch whose distance bound,
times `factor`, is beyond the query's k-th best distance so far is left out:
factor 1 gives exact search, larger factors prune more.

Rows are dealt to shards by a hash of their id, of about `shard_rows` rows, and
the stated queries to blocks of about `block_rows`; each (shard, block) is one
group: the group's tree is built, the block's queries walk it together, and each
query's k best go on to a ranking over the shards, cut to k before its shuffle.
All rows are indexed, none is sampled.

Equal vectors of a shard are one point with their k + 1 smallest ids (a query can
have no more of them among its k nearest and itself), so a vector that a third of
all rows share stays cheap.

Defined cases: vectors that are null, zero, or hold null or non-finite components
take no part, neither as queries nor as candidates; vectors are compared only
with those of the same dimension; equal scores are ranked by smaller id; a row
whose id is that of the query is not its neighbour (rows that share an id
count as one, with the smallest of their vectors); a null id takes no part; fewer candidates than k give
fewer rows; an empty table gives an empty result; only the id and vector columns
are read, so any other column may have any name.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrant.llm.common import python_ready, written

SHARD_ROWS = 8192
BLOCK_ROWS = 2048
LEAF = 128


class Tree:
    """Vantage-point tree over the rows of `points` (all of one length)."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        self.nodes: list[tuple] = []  # (vantage, inner radius, outer radius, inner, outer) or (rows,)
        rng = np.random.default_rng(0)
        todo = [(np.arange(len(points)), None, 0)]
        while todo:
            rows, parent, side = todo.pop()
            at = len(self.nodes)
            if parent is not None:
                self.nodes[parent][3 + side] = at
            if len(rows) <= leaf:
                self.nodes.append([rows])
                continue
            vantage = int(rows[rng.integers(len(rows))])
            d = np.sqrt(np.maximum(((points[rows] - points[vantage]) ** 2).sum(1), 0))
            order = np.argsort(d, kind="stable")
            half = len(rows) // 2
            near, far = order[:half], order[half:]
            # each side keeps the range of its distances from the vantage point
            self.nodes.append([vantage, (d[near[0]], d[near[-1]]), (d[far[0]], d[far[-1]]), -1, -1])
            todo += [(rows[near], at, 0), (rows[far], at, 1)]

    def walk(self, queries: np.ndarray, offer, factor: float, limit: np.ndarray) -> None:
        """Offer to each query the leaves that may hold one of its nearest:
        offer(query numbers, rows) updates `limit`, the k-th best distance."""
        if not len(self.points) or not len(queries):
            return
        slack = 1e-9

        def visit(node: int, who: np.ndarray, bound: np.ndarray) -> None:
            keep = bound * factor <= limit[who] + slack
            who = who[keep]
            if not len(who):
                return
            bound, n = bound[keep], self.nodes[node]
            if len(n) == 1:
                offer(who, n[0])
                return
            d = np.sqrt(np.maximum(((queries[who] - self.points[n[0]]) ** 2).sum(1), 0))
            bounds = [np.maximum(bound, np.maximum(lo - d, d - hi)) for lo, hi in n[1:3]]
            first = bounds[0] <= bounds[1]  # each query goes to its nearer side first
            for mask, sides in ((first, (0, 1)), (~first, (1, 0))):
                for side in sides:
                    if mask.any():
                        visit(n[3 + side], who[mask], bounds[side][mask])
        visit(0, np.arange(len(queries)), np.zeros(len(queries)))


def search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int,
           factor: float, leaf: int = LEAF) -> list[list[tuple[float, int]]]:
    """The k best (score, id) of each query among the rows; scores in double precision."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    raw = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).reshape(-1)
    _, first, place = np.unique(raw, return_index=True, return_inverse=True)
    members = np.argsort(place, kind="stable")  # ids ascend within each distinct vector
    starts = np.searchsorted(place[members], np.arange(len(first)))
    stops = np.append(starts[1:], len(members))
    points = vectors[first].astype(np.float64)
    norms = (points ** 2).sum(1)
    top = norms.max() if len(norms) else 0.0
    lifted = np.hstack([points, np.sqrt(np.maximum(top - norms, 0))[:, None]])
    asked = np.hstack([queries, np.zeros((len(queries), 1))])
    base = (queries ** 2).sum(1) + top
    best: list[list[tuple[float, int]]] = [[] for _ in queries]  # heaps of (score, -id)
    limit = np.full(len(queries), np.inf)

    def offer(who: np.ndarray, rows: np.ndarray) -> None:
        scores = queries[who] @ points[rows].T
        worst = np.array([best[q][0][0] if len(best[q]) == k else -np.inf for q in who.tolist()])
        for i, j in zip(*(x.tolist() for x in np.nonzero(scores >= worst[:, None] - 1e-9)), strict=True):
            q, row = int(who[i]), int(rows[j])
            score = float(np.dot(queries[q], points[row]))
            heap, own = best[q], query_ids[q]
            for m in ids[members[starts[row]:min(stops[row], starts[row] + k + 1)]].tolist():
                if m == own:
                    continue
                if len(heap) < k:
                    heapq.heappush(heap, (score, -m))
                elif (score, -m) > heap[0]:
                    heapq.heapreplace(heap, (score, -m))
                else:
                    break
        for q in who.tolist():
            if len(best[q]) == k:
                limit[q] = np.sqrt(max(base[q] - 2 * best[q][0][0], 0.0))
    Tree(lifted, leaf).walk(asked, offer, factor, limit)
    return [[(s, -m) for s, m in heap] for heap in best]


def usable(vector: Column) -> Column:
    """Not null, not zero, no null and no non-finite component."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(rows: DataFrame, is_query: Column, k: int = 20, factor: float = 1.0, id_col: str = "vec_id",
            vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k nearest rows of every row that `is_query` states: query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    python_ready(spark)
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    good = rows.filter(F.col(f"`{id_col}`").isNotNull() & usable(vector))
    base = written(good.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("v"), is_query.alias("q"))
                       .select("*", F.size("v").alias("dim")), "vectors")
    total, asked = (int(x or 0) for x in base.agg(F.count("*"), F.count(F.when(F.col("q"), 1))).first())
    n_shards, n_blocks = max(1, -(-total // shard_rows)), max(1, -(-asked // block_rows))
    spread = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(n)).cast("int")
    data = base.select("dim", spread(1, n_shards).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
                       "id", "v", F.lit(False).alias("q"))
    ask = base.filter("q").select("dim", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"),
                                  spread(2, n_blocks).alias("block"), "id", "v", F.lit(True).alias("q"))
    both = data.unionByName(ask).groupBy("dim", "shard", "block")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        """One (shard, block): bounded rows."""
        if group.duplicated(["id", "q"]).any():
            group = group.assign(key=group.v.map(tuple)).sort_values("key").drop_duplicates(["id", "q"])
        mine, theirs = group[~group.q], group[group.q]
        found = []
        if len(mine) and len(theirs):
            found = search(mine.id.to_numpy(), np.stack(mine.v.to_list()), theirs.id.to_numpy(), np.stack(theirs.v.to_list()), k, factor)
        flat = [(q, m, s) for q, near in zip(theirs.id.tolist(), found, strict=False) for s, m in near]
        return pd.DataFrame(flat, columns=["query_id", "vec_id", "score"])
    found = both.applyInPandas(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
