"""Exact k nearest neighbours inside one (minority) class, by pivot cells and the triangle inequality.

Every point belongs to the cell of its nearest pivot (a bounded sample of points); a cell of more than ``block_size``
points is dealt out to several blocks.  First each block finds its points' neighbours within itself, which bounds each
point's k-th distance from above.  Then a point visits another cell only if that cell can hold a point within its bound:
its distance to the cell's pivot, the cell's least and greatest radius and the plane between the two pivots
bound the distance from below.  Clustered points skip most cells; points without structure visit all, which
is what exact search costs.  A task holds one block and a bounded share of its visitors; what the driver holds are the
pivots and two radii a cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raresight.session import stored

PIVOTS = 4096  # at most; beyond, cells have more blocks


def _exact_rows(Q, R, qid, rid, kk):
    """Exact distances by explicit differences; (neighbour index, distance) sorted by (distance, id)."""
    diff = Q[:, None, :] - R[None, :, :]
    d = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
    d[qid[:, None] == rid[None, :]] = np.inf
    order = np.lexsort((np.broadcast_to(rid, d.shape), d), axis=1)[:, :kk]
    return order, np.take_along_axis(d, order, axis=1)


def _knn_core(Q, qid, R, rid, k: int, extra: int, chunk: int):
    """Top-k of every query row among the reference rows: candidates from the matrix-product
    form |q|^2 + |r|^2 - 2 q.r (one BLAS call per chunk), exact distances recomputed for
    the k + extra best, and a proof per query that no excluded point can enter its top k
    (the product form's rounding error is bounded); queries without that proof (e.g.
    exact ties) fall back to explicit differences.  Returns (query ids, neighbour ids, distances)."""
    nr = len(rid)
    kk = min(k, nr)
    m = min(kk + extra, nr)
    rr = np.einsum("ij,ij->i", R, R)
    out_q, out_n, out_d = [], [], []
    for s in range(0, len(qid), chunk):
        Qc, qc = Q[s:s + chunk], qid[s:s + chunk]
        qq = np.einsum("ij,ij->i", Qc, Qc)
        d2 = qq[:, None] + rr[None, :] - 2.0 * (Qc @ R.T)
        bound = 1e-12 * (qq[:, None] + rr[None, :]) + 1e-300   # rounding error of the product form
        d2[qc[:, None] == rid[None, :]] = np.inf
        cand = np.argpartition(d2, m - 1, axis=1)[:, :m] if m < nr else np.tile(np.arange(nr), (len(qc), 1))
        diff = Qc[:, None, :] - R[cand]
        dex = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
        dex[qc[:, None] == rid[cand]] = np.inf
        order = np.lexsort((rid[cand], dex), axis=1)[:, :kk]
        nn = np.take_along_axis(cand, order, axis=1)
        dd = np.take_along_axis(dex, order, axis=1)
        if m < nr:  # proof: every excluded point is strictly farther than the k-th kept one
            excl = d2.copy()
            np.put_along_axis(excl, cand, np.inf, axis=1)
            lower = np.sqrt(np.maximum(excl - bound, 0.0)).min(axis=1)
            bad = ~(lower > dd[:, -1])
            if bad.any():
                o2, d2x = _exact_rows(Qc[bad], R, qc[bad], rid, kk)
                nn[bad], dd[bad] = o2, d2x
        keep = np.isfinite(dd)
        out_q.append(np.repeat(qc, kk)[keep.ravel()])
        out_n.append(rid[nn].ravel()[keep.ravel()])
        out_d.append(dd.ravel()[keep.ravel()])
    return np.concatenate(out_q), np.concatenate(out_n), np.concatenate(out_d)


def _block_knn(k: int, extra: int = 8, chunk: int = 512):
    """Neighbours of the visiting points (``q``) among a block's (``r``); of the block's own where there are no visitors' rows."""
    def fn(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if q.empty or r.empty:
            return pd.DataFrame({"_id": pd.Series([], dtype="int64"), "nn_id": pd.Series([], dtype="int64"), "dist": pd.Series([], dtype="float64")})
        Q, R = np.stack(q["_v"].to_numpy()).astype("float64"), np.stack(r["_v"].to_numpy()).astype("float64")
        found = _knn_core(Q, q["_id"].to_numpy(dtype="int64"), R, r["_id"].to_numpy(dtype="int64"), k, extra, chunk)
        return pd.DataFrame(dict(zip(("_id", "nn_id", "dist"), found)))
    return fn


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)).astype("float64")


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2.0 * (x @ pivots.T), 0.0))


def _cells(base: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``base`` (_id, _v) with the nearest pivot (_cell) and the distance to it (_r)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = _distances(_matrix(batch.column("_v")), pivots)
                cell = d.argmin(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(cell)), cell])], ["_id", "_v", "_cell", "_r"])

    return base.mapInArrow(run, "_id long, _v array<double>, _cell int, _r double")


def _visits(bounded: DataFrame, pivots: np.ndarray, cells: Sequence) -> DataFrame:
    """(_id, _v, _bound, _home, _cell): the cells that can hold a point within ``_bound`` of each point.

    ``bounded``: _id, _v, _cell, _bound; ``cells``: rows (_cell, least, most) of the radii.  Float errors are far below the
    margin, which only adds visits."""
    at = np.array([c["_cell"] for c in cells], np.int64)
    least, most = np.array([c["least"] for c in cells]), np.array([c["most"] for c in cells])
    between = _distances(pivots, pivots[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                home, bound = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_cell", "_bound"))
                x = _matrix(batch.column("_v"))
                d = _distances(x, pivots[at])
                own = np.sqrt(((x - pivots[home]) ** 2).sum(1))
                plane = (d ** 2 - own[:, None] ** 2) / np.maximum(2 * between[home], 1e-300)
                low = np.maximum.reduce([d - most, least - d, np.where(at[None, :] == home[:, None], 0.0, plane)])
                row, cell = np.nonzero(low - 1e-6 * (1 + d + own[:, None]) <= bound[:, None])
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([taken.column("_id"), taken.column("_v"), taken.column("_bound"), taken.column("_blk"), pa.array(at[cell], pa.int32())],
                                                 ["_id", "_v", "_bound", "_home", "_cell"])

    return bounded.select("_id", "_v", "_cell", "_blk", "_bound").mapInArrow(run, "_id long, _v array<double>, _bound double, _home int, _cell int")


def _plan(points: DataFrame, key: str, features, k: int, block_size: int, seed: int):
    """(blocks, neighbours within the own block, visits): the steps before the visits are paid."""
    n = points.select(F.count(F.lit(1))).first()[0]  # one number: sizes the cells
    vec = F.array(*[F.col(c).cast("double") for c in features])
    base = points.select(F.col(key).cast("long").alias("_id"), vec.alias("_v"))
    wanted = max(1, min(PIVOTS, math.ceil(n / block_size)))
    pivots = np.array([r["_v"] for r in base.orderBy(F.xxhash64(F.lit(seed), "_id"), "_id").limit(wanted).collect()], float)
    if not len(pivots):
        pivots = np.zeros((1, len(list(features))))
    placed = stored(_cells(base, pivots), "knn-cells")
    cells = placed.groupBy("_cell").agg(F.min("_r").alias("least"), F.max("_r").alias("most"), F.ceil(F.count(F.lit(1)) / block_size).cast("int").alias("_blocks"))
    cells = stored(cells, "knn-radii")  # one row per cell
    blocks = placed.join(cells.select("_cell", "_blocks"), "_cell").withColumn("_blk", F.pmod(F.xxhash64(F.lit(seed), "_id"), "_blocks").cast("int"))
    blocks = stored(blocks, "knn-blocks")
    schema = "_id long, nn_id long, dist double"
    side = blocks.select("_id", "_v", "_cell", "_blk").groupBy("_cell", "_blk")
    of_block = _block_knn(k)
    within = stored(side.applyInPandas(lambda rows: of_block(rows, rows), schema), "knn-within")
    # a block of k points or fewer bounds nothing
    bound = within.groupBy("_id").agg(F.max("dist").alias("_kth"), F.count(F.lit(1)).alias("_c"))
    bounded = blocks.join(bound, "_id", "left").withColumn("_bound", F.when(F.col("_c") >= k, F.col("_kth")).otherwise(F.lit(float("inf"))))
    return blocks, cells, within, _visits(bounded, pivots, cells.select("_cell", "least", "most").collect())


def exact_knn(points: DataFrame, key: str, features, k: int = 5, block_size: int = 2048, seed: int = 42) -> DataFrame:
    """(key, j, nn_key, dist): the k nearest other points of each point (Euclidean),
    ties broken by the neighbour's key; ``j`` = 0..k-1 in that order.  Keys are longs."""
    blocks, cells, within, visits = _plan(points, key, features, k, block_size, seed)
    # a visitor meets every block of the cell but its own; a block's visitors are dealt out in bounded shares
    per_cell = visits.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / (4 * block_size)).cast("int").alias("_shares"))
    shares = stored(per_cell.join(cells.select("_cell", "_blocks"), "_cell"), "knn-shares")
    guests = (visits.join(shares, "_cell").withColumn("_blk", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
              .join(blocks.select("_id", F.col("_cell").alias("_own")), "_id").filter((F.col("_own") != F.col("_cell")) | (F.col("_home") != F.col("_blk")))
              .withColumn("_share", F.pmod(F.xxhash64("_id"), "_shares").cast("int")).select("_id", "_v", "_bound", "_cell", "_blk", "_share"))
    hosts = blocks.join(shares.select("_cell", "_shares"), "_cell").select("_id", "_v", "_cell", "_blk", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)).alias("_share"))
    on = ["_cell", "_blk", "_share"]
    found = guests.groupBy(*on).cogroup(hosts.groupBy(*on)).applyInPandas(_block_knn(k), "_id long, nn_id long, dist double")
    w = Window.partitionBy("_id").orderBy("dist", "nn_id")
    best = within.union(found).withColumn("j", F.row_number().over(w) - 1).filter(F.col("j") < k)
    return best.select(F.col("_id").alias(key), F.col("j").cast("int").alias("j"),
                       F.col("nn_id").alias(f"nn_{key}"), "dist")
