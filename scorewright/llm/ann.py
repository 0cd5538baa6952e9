"""Operator 9: approximate nearest neighbours over learned partitions.

A bounded sample is joined to its nearest neighbours, that graph is cut into balanced parts, and a small classifier
(softmax regression) learns which part a vector belongs to.  Every row is indexed under the part the classifier gives
it; a query looks at its most probable parts, and the candidates are ranked again by the exact inner product.  How
many parts that are is learnt too: as many as held-out vectors of the sample need to reach ``recall``.

Defined results: vectors that are null, zero or hold null or non-finite components take no part; a vector whose length
differs from the most common one of the sample takes no part; ties go to the smaller id; fewer candidates than ``k``
give fewer rows; an empty table gives none; equal vectors are ranked by id.  Rows with a null id take no part.
A row that is there several times is one candidate and one query; rows of one id that differ in content are a
candidate each, and a query each with its own ranking; a query's own id is never its neighbour.

Scale: the number of parts follows the row count (about ``part_rows`` rows each) up to one for 32 sampled vectors.  Parts are cut further into blocks
of at most ``block_rows`` rows by a hash of the id, so a part that holds a third of all rows is searched in many
tasks; each task returns its best ``k`` for a query, and these are merged.  Nothing is dropped: a block's ranking is
exact, and the best ``k`` of all are among the best ``k`` of the blocks.  Queries that look at one part are cut into chunks
of about ``query_rows`` as well, so neither side of a search grows with the table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewright.llm.common import arrow_schema, hash_sample, map_batches, sample_rate, store

SAMPLE_ROWS, PART_ROWS, BLOCK_ROWS, QUERY_ROWS, RECALL = 4000, 1024, 2048, 8192, 0.95
NEIGHBOURS = 12


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` nearest other rows by inner product."""
    score = x @ x.T
    np.fill_diagonal(score, -np.inf)
    k = min(k, len(x) - 1)
    return np.argpartition(-score, k - 1, axis=1)[:, :k] if k > 0 else np.empty((len(x), 0), int)


def balanced_parts(graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1) -> np.ndarray:
    """Cut the graph: parts grow from seeds breadth first, then vertices move to the part most of their neighbours
    are in, as long as it has room (at most ``slack`` times the even size)."""
    n = len(graph)
    room = int(np.ceil(slack * n / parts))
    links: list[list[int]] = [list(r) for r in graph.tolist()]
    for i, r in enumerate(graph.tolist()):
        for j in r:
            links[j].append(i)
    part = np.full(n, -1)
    size = np.zeros(parts, int)
    waiting = 0
    for p in range(parts):                                    # breadth first, an even share each
        queue: list[int] = []
        while size[p] < -(-n // parts):
            while queue and part[queue[0]] >= 0:
                queue.pop(0)
            if not queue:
                while waiting < n and part[waiting] >= 0:
                    waiting += 1
                if waiting == n:
                    break
                queue.append(waiting)
            v = queue.pop(0)
            part[v], size[p] = p, size[p] + 1
            queue += [u for u in links[v] if part[u] < 0]
    for _ in range(rounds):
        moved = 0
        for v in range(n):
            votes = np.bincount(part[links[v]], minlength=parts) if links[v] else np.zeros(parts, int)
            best = int(votes.argmax())
            if best != part[v] and votes[best] > votes[part[v]] and size[best] < room:
                size[part[v]] -= 1
                size[best] += 1
                part[v], moved = best, moved + 1
        if not moved:
            break
    return part


def fit_router(x: np.ndarray, part: np.ndarray, parts: int, steps: int = 200, rate: float = 0.5) -> np.ndarray:
    """Softmax regression, (dim + 1, parts); full-batch Adam."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w, m, v = (np.zeros((a.shape[1], parts)) for _ in range(3))
    goal = np.eye(parts)[part]
    for step in range(1, steps + 1):
        z = a @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = a.T @ (goal - p) / len(a) - 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w += rate * 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return w


class Index:
    """Router of one table: weights, number of parts and the number of parts a query looks at."""

    def __init__(self, weights: np.ndarray, parts: int, probes: int):
        self.weights, self.parts, self.probes = weights, parts, probes

    def logits(self, x: np.ndarray) -> np.ndarray:
        norm = np.sqrt((x * x).sum(1, keepdims=True))
        return np.hstack([x / norm, np.ones((len(x), 1))]) @ self.weights


def valid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    good = (F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()
            & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
            & F.exists(v, lambda e: e != 0))
    return df.where(good).select(F.col(id_col).cast("long").alias("id"), v.alias("v")).distinct()      # repeated rows once


def build(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, part_rows: int = PART_ROWS,
          recall: float = RECALL, k: int = 20) -> Index | None:
    """Fit the router on at most about ``sample_rows`` distinct vectors, chosen by a hash of their id.  A fifth of them
    is held out to find the number of parts to look at."""
    n = rows.count()
    # equal vectors count once, so a vector that many rows share does not fill the sample
    got = [r[0] for r in hash_sample(rows, "id", sample_rate(n, sample_rows)).select("v").distinct().collect()]
    if not got:
        return None
    dim = int(np.bincount([len(v) for v in got]).argmax())
    x = np.array(sorted(v for v in got if len(v) == dim))
    x = x[np.random.default_rng(7).permutation(len(x))] / np.sqrt((x * x).sum(1))[:, None]
    parts = max(1, min(round(n / part_rows), len(x) // 32))
    held, fitted = x[:len(x) // 5], x[len(x) // 5:]
    weights = fit_router(fitted, balanced_parts(neighbour_graph(fitted, NEIGHBOURS), parts), parts)
    index = Index(weights, parts, parts)
    if len(held) and parts > 1:
        near = np.argsort(-(held @ fitted.T), axis=1, kind="stable")[:, :k]
        place = np.argsort(np.argsort(-index.logits(held), axis=1, kind="stable"), axis=1)
        needed = np.take_along_axis(place, index.logits(fitted).argmax(1)[near], axis=1)
        reached = np.cumsum(np.bincount(needed.ravel(), minlength=parts)) / needed.size
        index.probes = int(np.searchsorted(reached, recall)) + 1
    return index


def assign(rows: DataFrame, index: Index, top: int) -> DataFrame:
    """``id, v, parts``: the ``top`` most probable parts of every row."""
    dim = len(index.weights) - 1

    def start():
        def run(r: dict) -> dict:
            at = [i for i, v in enumerate(r["v"]) if len(v) == dim]
            if not at:
                return {"id": [], "v": [], "parts": []}
            x = np.array([r["v"][i] for i in at])
            order = np.argsort(-index.logits(x), axis=1, kind="stable")[:, :top]
            return {"id": [r["id"][i] for i in at], "v": [r["v"][i] for i in at], "parts": order.astype(np.int32).tolist()}
        return run

    return map_batches(rows, "id long, v array<double>, parts array<int>", start, rows=2048)


def best_of(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int, floor: np.ndarray) -> list[tuple]:
    """(place of the query, candidate, score) of the best ``k`` of a block that reach the query's ``floor``; scores are summed in one
    fixed order."""
    out = []
    for lo in range(0, len(q), 256):
        rough = q[lo:lo + 256] @ c.T
        for i, row in enumerate(rough):
            mine = q_ids[lo + i]
            row[c_ids == mine] = -np.inf
            row[row < floor[lo + i] - 1e-9 * max(1.0, abs(floor[lo + i]))] = -np.inf
            if len(row) > k:
                edge = np.partition(row, len(row) - k)[len(row) - k]
                at = np.flatnonzero(row >= edge - 1e-9 * max(1.0, abs(edge)) if np.isfinite(edge) else row > -np.inf)
            else:
                at = np.flatnonzero(row > -np.inf)
            if not len(at):
                continue
            score = (c[at] * q[lo + i]).sum(1)
            for j in np.lexsort((c_ids[at], -score))[:k]:
                out.append((lo + i, int(c_ids[at[j]]), float(score[j])))
    return out


def search(df: DataFrame, is_query: str, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           sample_rows: int = SAMPLE_ROWS, part_rows: int = PART_ROWS, recall: float = RECALL,
           block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row for which the SQL condition
    ``is_query`` on ``id`` holds."""
    schema = "query_id long, content long, vec_id long, score double"
    rows = store(valid(df, id_col, vec_col), "vectors")
    index = build(rows, sample_rows, part_rows, recall, k)
    spark = df.sparkSession
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    placed = store(assign(rows, index, index.probes), "placed")
    part = F.col("parts")[0]
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))       # one row a part
    blocks = {r["part"]: max(1, -(-r["n"] // block_rows)) for r in sizes.collect()}
    n_blocks = F.element_at(F.create_map(*[F.lit(x) for p, b in sorted(blocks.items()) for x in (p, b)]), F.col("part"))
    split = F.xxhash64("id", F.lit(3))
    held = placed.select("id", "v", part.alias("part")).select("id", "v", "part", F.pmod(split, n_blocks).cast("int").alias("block"))
    content = F.xxhash64("v").alias("content")                # tells the queries of one id apart
    queries = placed.where(F.expr(is_query)).select("id", "v", content, "parts")
    chunks = max(1, -(-queries.count() // query_rows))
    asks = (queries.withColumn("chunk", F.pmod(F.xxhash64("id", "content", F.lit(5)), F.lit(chunks)).cast("int"))
            .select("id", "v", "content", "chunk", F.posexplode("parts").alias("nth", "part")).where(F.col("part").isin(sorted(blocks)))
            .select("id", "v", "content", "chunk", "nth", "part", F.explode(F.sequence(F.lit(0), (n_blocks - 1).cast("int"))).alias("block")))
    target = arrow_schema(schema)

    def ranked(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            q, c = (np.array(t.column("v").combine_chunks().values.to_numpy()).reshape(t.num_rows, -1) for t in (left, right))
            ids, key = left.column("id").to_numpy(), left.column("content").to_numpy()
            found = best_of(q, ids, c, right.column("id").to_numpy(), k, left.column("floor").to_numpy())
            out = [(int(ids[i]), int(key[i]), j, s) for i, j, s in found]
        cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(cols, target, strict=True)], schema=target)

    candidates = held.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def visit(asked: DataFrame) -> DataFrame:
        own = asked.select(*[F.col(c).alias(c) for c in ("id", "v", "content", "floor", "part", "block", "chunk")])      # apart from those of held
        return own.groupBy("part", "block", "chunk").cogroup(candidates.groupBy("part", "block", "chunk")).applyInArrow(ranked, schema)

    rank = F.row_number().over(Window.partitionBy("query_id", "content").orderBy(F.desc("score"), "vec_id"))
    # the most probable part first: its k-th score is a floor for what the other parts have to return
    near = store(visit(asks.where("nth = 0").withColumn("floor", F.lit(float("-inf"))))
                 .withColumn("rank", rank).where(F.col("rank") <= k).drop("rank"), "near")
    floors = near.groupBy(F.col("query_id").alias("id"), "content").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
    rest = asks.where("nth > 0").join(floors.select("id", "content", "least"), ["id", "content"], "left").withColumn("floor", F.coalesce("least", F.lit(float("-inf"))))
    found = near.unionByName(visit(rest))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
