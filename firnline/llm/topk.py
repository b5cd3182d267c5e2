"""Exact top-k search: a KD-tree per shard, best-first traversal, and the k-th score passed on.

Vectors are dealt to shards by a hash of their id. A shard's tree splits at the median of its widest component, every node
has the tight box of its vectors, and equal vectors are one entry. For a query the inner product with a box is at most the sum over the
components of the better corner; a heap visits nodes by that bound and stops below the k-th best score.

Queries go in blocks. Each block first searches one shard; its k-th scores are lower bounds of the final ones, and with
them the block searches the other shards. Work per group is one tree against one block, whatever the
number of vectors; the candidates of a query are at most k per shard.

Components become floor(scale * x) and scores are exact integers. Of equal scores the smaller id ranks first.

Cases: vectors that are null, or hold a null or non-finite component, take no part; shorter vectors count as padded
with zeros; rows with a null id take no part; rows with the query's id are the query's own; equal rows count once, and
two different vectors under one id are two candidates, and two queries; fewer candidates than k give fewer
ranks; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firnline.session import stage

K = 20
SCALE = 64
SHARD_ROWS = 8_192
BLOCK_ROWS = 512
LEAF = 256
FOUND = "query_id long, query_key long, vec_id long, vec_key long, score long"


def whole_numbers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, vec_key, v): distinct rows with v as longs."""
    v = F.col("embedding").cast("array<double>")
    sound = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.filter(sound & F.col("vec_id").isNotNull())
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(v, lambda x: F.floor(x * scale)).alias("v"))
            .distinct().withColumn("vec_key", F.xxhash64("v")))


def matrix(column: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Lists of longs as rows, padded with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    n = np.asarray(lists.value_lengths(), dtype=np.int64)
    out = np.zeros((len(n), max([width or 0, *n.tolist()])), dtype=np.int64)
    values = np.asarray(lists.flatten(), dtype=np.int64)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(n) - n, n)] = values
    return out


def tree_of(ids: np.ndarray, keys: np.ndarray, v: np.ndarray, k: int) -> dict:
    """Nodes in one array each: children, row range, box. Equal vectors share an entry with their k + 1 smallest ids."""
    order = np.lexsort((keys, ids))
    ids, keys, v = ids[order], keys[order], v[order]
    points, which = np.unique(v, axis=0, return_inverse=True)
    which = which.reshape(-1)
    by_point = np.argsort(which, kind="stable")
    first = np.searchsorted(which[by_point], np.arange(len(points) + 1))
    rows = np.arange(len(points))
    low, high, child, span = [], [], [], []
    todo = [(0, len(points), -1)]
    while todo:
        a, b, parent = todo.pop()
        box = points[rows[a:b]]
        lo, hi = box.min(0), box.max(0)
        node = len(low)
        low.append(lo), high.append(hi), child.append([-1, -1]), span.append((a, b))
        if parent >= 0:
            child[parent][0 if child[parent][0] < 0 else 1] = node
        if b - a > LEAF:
            axis = int(np.argmax(hi - lo))
            middle = (b - a) // 2
            rows[a:b] = rows[a:b][np.argpartition(box[:, axis], middle)]
            todo += [(a, a + middle, node), (a + middle, b, node)]
    kept = np.minimum(first[1:] - first[:-1], k + 1)[rows]  # the members of each entry, in the order of rows
    begin = np.concatenate([[0], np.cumsum(kept)])
    at = by_point[np.repeat(first[:-1][rows] - begin[:-1], kept) + np.arange(begin[-1])]
    return {"points": points[rows], "begin": begin, "ids": ids[at], "keys": keys[at],
            "low": np.array(low), "high": np.array(high), "child": np.array(child), "span": np.array(span)}


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer a @ b.T; through floating point where no sum can pass 2^53."""
    most = lambda x: float(np.abs(x).max()) if x.size else 0.0
    if most(a) * most(b) * max(1, a.shape[-1]) < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def exact_kind(a: np.ndarray, b: np.ndarray) -> type:
    """The number type in which products of their rows are exact: floating point where no sum can pass 2^53."""
    most = lambda x: float(np.abs(x).max()) if x.size else 0.0
    return np.float64 if most(a) * most(b) * max(1, a.shape[-1]) < 2.0 ** 53 else np.int64


def search(tree: dict, query_id: int, query: np.ndarray, bounds: np.ndarray, k: int, floor: int | None) -> list[tuple]:
    """The best k (score, -vec_id, -vec_key) of one shard that are not below ``floor``."""
    best: list[tuple] = []  # a heap, worst first
    bounds, child, span = bounds.tolist(), tree["child_list"], tree["span_list"]
    begin, ids, keys = tree["begin"], tree["ids"], tree["keys"]
    heap = [(-bounds[0], 0)]
    while heap:
        bound, node = heapq.heappop(heap)
        if floor is not None and -bound < floor or len(best) == k and -bound < best[0][0]:
            break
        left, right = child[node]
        if left >= 0:
            heapq.heappush(heap, (-bounds[left], left))
            heapq.heappush(heap, (-bounds[right], right))
            continue
        a, b = span[node]
        scores = tree["points"][a:b] @ query
        least = max(x for x in (floor, best[0][0] if len(best) == k else None, -(1 << 63)) if x is not None)
        for at in np.flatnonzero(scores >= least).tolist():
            score = int(scores[at])
            for m in range(begin[a + at], begin[a + at + 1]):
                vec_id = int(ids[m])
                if vec_id != query_id:
                    entry = (score, -vec_id, -int(keys[m]))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                    else:
                        break
    return best


def top_k(vectors: DataFrame, queries: Column, k: int = K, scale: int = SCALE, shard_rows: int = SHARD_ROWS,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, query_key, rank, vec_id, score): for each row that ``queries`` (on vec_id) picks, its k best others."""
    rows = stage(whole_numbers(vectors, scale), "vectors")
    shards = max(1, -(-rows.count() // shard_rows))
    asked = rows.filter(queries)
    blocks = max(1, -(-asked.count() // block_rows))

    def build(group: pa.Table) -> pa.Table:
        tree = tree_of(group["vec_id"].to_numpy(), group["vec_key"].to_numpy(), matrix(group["v"]), k)
        return pa.table({"shard": group["shard"][:1].cast(pa.int32()), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    trees = stage(rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
                  .groupBy("shard").applyInArrow(build, "shard int, tree binary"), "trees")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_key", "vec_id"), F.lit(blocks)).cast("int"))

    def visit(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            for blob in right["tree"].to_pylist():
                tree = pickle.loads(blob)
                v = matrix(left["v"], tree["low"].shape[1])
                low, high = (np.pad(tree[c], ((0, 0), (0, v.shape[1] - tree[c].shape[1]))) for c in ("low", "high"))
                tree["points"] = np.pad(tree["points"], ((0, 0), (0, v.shape[1] - tree["points"].shape[1])))
                bounds = product(np.maximum(v, 0), high) + product(np.minimum(v, 0), low)
                kind = exact_kind(tree["points"], v)
                tree["points"], v = tree["points"].astype(kind), v.astype(kind)
                tree["child_list"], tree["span_list"] = tree["child"].tolist(), tree["span"].tolist()
                for q, key, floor, query, bound in zip(left["vec_id"].to_pylist(), left["vec_key"].to_pylist(),
                                                       left["floor"].to_pylist(), v, bounds):
                    out += [(q, key, -e[1], -e[2], e[0]) for e in search(tree, q, query, bound, k, floor)]
        columns = list(zip(*out)) if out else [[]] * 5
        return pa.table({n: pa.array(c, pa.int64()) for n, c in
                         zip(("query_id", "query_key", "vec_id", "vec_key", "score"), columns)})

    def searched(questions: DataFrame, shard: Column, mine: Column) -> DataFrame:
        """One tree against one block per group; ``shard`` lists the shards of a block, ``mine`` the blocks of a tree."""
        q = questions.withColumn("shard", F.explode(shard))
        t = trees.withColumn("block", F.explode(mine))
        return (q.groupBy("shard", "block").cogroup(t.groupBy("shard", "block")).applyInArrow(visit, FOUND))

    every_block = F.sequence(F.lit(0), F.lit(blocks - 1))
    every_shard = F.sequence(F.lit(0), F.lit(shards - 1))
    home = F.pmod(F.col("block"), F.lit(shards)).cast("int")
    first = stage(searched(asked.withColumn("floor", F.lit(None).cast("long")), F.array(home),
                           F.filter(every_block, lambda b: F.pmod(b, F.lit(shards)) == F.col("shard"))), "home")
    found = first
    if shards > 1:
        # The k-th score at home; a query with fewer candidates there has no bound yet.
        floors = (first.groupBy("query_id", "query_key").agg(F.min("score").alias("floor"), F.count("*").alias("n"))
                  .select(F.col("query_id").alias("vec_id"), F.col("query_key").alias("vec_key"),
                          F.when(F.col("n") >= k, F.col("floor")).alias("floor")))
        away = searched(asked.join(floors, ["vec_id", "vec_key"], "left"),
                        F.filter(every_shard, lambda s: s != home),
                        F.filter(every_block, lambda b: F.pmod(b, F.lit(shards)) != F.col("shard")))
        found = first.union(away)
    place = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id", "vec_key"))
    return (found.withColumn("rank", place).filter(F.col("rank") <= k)
            .select("query_id", "query_key", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
