"""Operator 13: exact integer k-means by Shallot search.

A vector is carried with its nearest and second nearest centroid, an upper bound of the distance to the first and a
lower bound of the distance to any other one.  Centroids that moved loosen the bounds; a vector whose bounds still part
keeps its cluster untouched.  For the others the distance to both remembered centroids is computed anew, and the scan
starts from the closer of the two: other centroids come in the order of their distance from it, and the scan stops when
that distance exceeds the ball (distance to the start plus distance to the second nearest so far), which shrinks with
every better one found.  Bounds are floating point with a margin; whatever they cannot part is compared in integers, so
assignments and ties (smaller number) are exact.

Components are ``floor(scale * x)``.  The first centroids are the ``k`` vectors with the least sha256 of
``<salt>:<id>``; a round assigns all vectors, then replaces each non-empty centroid by the componentwise floor of the mean.

Defined results: vectors that are null, of another length, or hold null or non-finite components take no part, nor do those
with a component of ``LIMIT`` or more in size, whose squared distances a long cannot hold.  Every row is a vector of its
own, repeated rows and ids included; equal hashes are ordered by content, null ids come last.  Fewer than ``k`` vectors
make as many centroids as there are vectors; an empty table gives no rows.  Other columns of the table are left out.

Scale: a row needs only the centroids (``k`` times ``dim`` numbers, broadcast, independent of the data), so a round is one
narrow pass over the stored rows; cluster sums are partial sums per task, so a cluster with a third of all rows is no
hot task, and ``k`` rows reach the driver.  Each round's rows are stored in the shared folder, and the round before
is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import arrow_schema, store_at
from scorewright.session import remove_folder, scratch_path

DIM, SCALE, K, ROUNDS, SALT = 64, 256, 40, 5, "2"
LIMIT = 1 << 27                 # 64 squares of differences below 2**28 fit a long
MARGIN = 1e-9                   # relative slack of every floating-point bound
STATE = "vec_id long, v array<int>, near int, second int, upper double, lower double, d2 long"


def integer_rows(df: DataFrame, id_col: str, vec_col: str, dim: int, scale: int) -> DataFrame:
    """``vec_id, v``: the rows that take part, as integers."""
    x = F.col(vec_col).cast("array<double>")
    sound = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(F.floor(e * scale)) < F.lit(float(LIMIT))))
    rows = df.where(F.col(vec_col).isNotNull() & (F.size(vec_col) == dim)).where(sound)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e * scale).cast("int")).alias("v"))


def first_centroids(rows: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` rows with the least hash (a top-k per task, then one of ``k`` rows a task)."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    got = rows.select("v", digest.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in got], np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return np.einsum("ij,ij->i", d, d)


class Neighbours:
    """Centroids with their mutual distances and, for each, the others by distance."""

    def __init__(self, centroids: np.ndarray):
        self.c = centroids
        d = np.sqrt(((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(2).astype(float))
        self.order = np.argsort(d, axis=1, kind="stable")
        self.by_order = np.take_along_axis(d, self.order, 1)


def closer(d: np.ndarray, j: np.ndarray, best: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether centroid ``j`` at ``d`` comes before ``at`` at ``best``: integers, then the smaller number."""
    return (d < best) | ((d == best) & (j < at))


def scan(x: np.ndarray, near: np.ndarray, second: np.ndarray, to: Neighbours) -> tuple[np.ndarray, ...]:
    """``near, second, d2 of near, d2 of second``, exact, for vectors that their bounds could not settle."""
    d1, d2 = squared(x, to.c[near]), squared(x, to.c[second])
    swap = closer(d2, second, d1, near)                                  # start from the closer of the two
    near, second = np.where(swap, second, near), np.where(swap, near, second)
    d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
    start, other = near.copy(), second.copy()
    from_start = np.sqrt(d1.astype(float))
    alive = np.arange(len(x))
    for step in range(to.order.shape[1]):
        ball = (from_start[alive] + np.sqrt(d2[alive].astype(float))) * (1 + MARGIN) + MARGIN
        alive = alive[to.by_order[start[alive], step] <= ball]           # sorted: what comes later is farther still
        if not len(alive):
            break
        j = to.order[start[alive], step]
        fresh = (j != start[alive]) & (j != other[alive])
        at, j = alive[fresh], j[fresh]
        if not len(at):
            continue
        d = squared(x[at], to.c[j])
        first = closer(d, j, d1[at], near[at])
        then = ~first & closer(d, j, d2[at], second[at])
        f, t = at[first], at[then]
        d2[f], second[f], d1[f], near[f] = d1[f], near[f], d[first], j[first]
        d2[t], second[t] = d[then], j[then]
    return near, second, d1, d2


def assign(x: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray, to: Neighbours,
           moved: np.ndarray) -> tuple[np.ndarray, ...]:
    """One assignment of a batch; ``moved`` is how far each centroid went since the bounds were set."""
    if len(to.c) == 1:
        return near, second, np.zeros(len(x)), np.full(len(x), np.inf)
    far = int(moved.argmax())
    rest = float(np.delete(moved, far).max())
    upper = upper + moved[near]
    drift = np.where(near == far, rest, moved[far])
    lower = lower - drift - MARGIN * (lower + drift)
    near, second = near.copy(), second.copy()
    open_ = np.flatnonzero(upper * (1 + MARGIN) + MARGIN >= lower)
    upper[open_] = np.sqrt(squared(x[open_], to.c[near[open_]]).astype(float))       # the true distance may part them
    open_ = open_[upper[open_] * (1 + MARGIN) + MARGIN >= lower[open_]]
    if len(open_):
        near[open_], second[open_], d1, d2 = scan(x[open_], near[open_], second[open_], to)
        upper[open_], lower[open_] = np.sqrt(d1.astype(float)), np.sqrt(d2.astype(float))
    return near, second, upper, lower


def step(rows: DataFrame, centroids: np.ndarray, moved: np.ndarray | None, final: bool = False) -> DataFrame:
    """All rows assigned to ``centroids``; ``moved`` None: the first time.  ``final`` adds the exact distance."""
    shared = rows.sparkSession.sparkContext.broadcast((centroids, moved))            # k x dim numbers
    target = arrow_schema(STATE)

    def run(batches):
        c, drift = shared.value
        to = Neighbours(c)
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column("v")
            x = v.flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(np.int64)
            if drift is None:
                near, second = np.zeros(b.num_rows, np.int64), np.full(b.num_rows, min(1, len(c) - 1))
                upper, lower, drift_now = np.full(b.num_rows, np.inf), np.zeros(b.num_rows), np.zeros(len(c))
            else:
                near, second = (b.column(n).to_numpy().astype(np.int64) for n in ("near", "second"))
                upper, lower = (b.column(n).to_numpy().copy() for n in ("upper", "lower"))
                drift_now = drift
            near, second, upper, lower = assign(x, near, second, upper, lower, to, drift_now)
            d2 = pa.array(squared(x, c[near])) if final else pa.nulls(b.num_rows, pa.int64())
            cols = [b.column("vec_id"), v, near, second, upper, lower, d2]
            yield pa.RecordBatch.from_arrays(
                [(a if isinstance(a, (pa.Array, pa.ChunkedArray)) else pa.array(a)).cast(f.type) for a, f in zip(cols, target, strict=True)],
                schema=target)

    return rows.mapInArrow(run, STATE)


def means(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of each cluster; empty ones stay.  A task sends one sum a cluster and component."""
    target = arrow_schema("cluster int, axis int, s long, n long")

    def run(batches):
        total = np.zeros((len(centroids), centroids.shape[1] + 1), np.int64)
        for b in batches:
            if b.num_rows:
                x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(np.int64)
                near = b.column("near").to_numpy()
                by = np.argsort(near, kind="stable")
                at = np.flatnonzero(np.diff(near[by], prepend=-1))
                total[near[by][at]] += np.add.reduceat(np.hstack([x, np.ones((len(x), 1), np.int64)])[by], at)
        seen = np.flatnonzero(total[:, -1])
        dim = total.shape[1] - 1
        cols = [np.repeat(seen, dim), np.tile(np.arange(dim), len(seen)), total[seen, :-1].ravel(), np.repeat(total[seen, -1], dim)]
        yield pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(cols, target, strict=True)], schema=target)

    sums = rows.select("v", "near").mapInArrow(run, "cluster int, axis int, s long, n long").groupBy("cluster", "axis").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"))
    out = centroids.copy()
    for r in sums.collect():                                             # k x dim rows
        out[r["cluster"], r["axis"]] = r["s"] // r["n"]
    return out


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def shallot_clusters(df: DataFrame, k: int = K, rounds: int = ROUNDS, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = DIM,
                     scale: int = SCALE, salt: str = SALT, watch: Callable[[np.ndarray], None] | None = None) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that takes part.  ``watch`` is
    shown the centroids of each assignment."""
    spark = df.sparkSession
    folder = scratch_path(spark, "llm-integer-vectors")
    rows = store_at(integer_rows(df, id_col, vec_col, dim, scale), folder)
    centroids = first_centroids(rows, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    moved = None
    for at in range(rounds + 1):
        if watch:
            watch(centroids)
        last = at == rounds
        read, folder = folder, scratch_path(spark, f"llm-assigned-{at}")
        rows = store_at(step(rows, centroids, moved, final=last), folder)
        remove_folder(spark, read)
        if not last:
            new = means(rows, centroids)
            moved, centroids = np.sqrt(((new - centroids) ** 2).sum(1).astype(float)), new
    inertia = {r["near"]: int(r["s"]) for r in rows.groupBy("near").agg(F.sum("d2").alias("s")).collect()}        # at most k rows
    total = sum(inertia.values())
    known = ", ".join(f"({c}, {s}L, {total}L, '{digest(centroids[c])}')" for c, s in sorted(inertia.items()))
    of = spark.sql(f"SELECT * FROM VALUES {known} AS t(cluster, cluster_inertia, inertia, centroid_sha256)")
    return (rows.select("vec_id", F.col("near").alias("cluster"), F.col("d2").alias("distance")).join(F.broadcast(of), "cluster")     # k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
