"""Exact k-nearest-neighbour join over blocks of rows.

No pair of rows ever becomes a Spark row. Splits learned from a bounded hash
sample cut the space into parts; a part's rows are cut further, at medians, into
blocks of at most ``BLOCK`` rows with tight bounding boxes. Then:

1. Each part answers its queries from its own blocks, which bounds every
   query's k-th distance.
2. A part is sent only those other blocks whose box is nearer to one of its
   query blocks than the largest bound in there, and updates its answers from
   them, one block at a time.

A block that is not sent cannot hold a nearer row, so the result is exact; the
boxes only decide how much work it takes. Where they prune nothing (near-uniform
vectors of many dimensions) all pairs are looked at, but only as products of
blocks inside a task: each part reads the data once, so the shuffle is
parts x data and memory stays at one part and one block.

Inside a task a matrix product gives distances up to a known rounding error;
every row that may be among the k nearest by that error is measured again with
exact differences, summed in the order of the dimensions. Distances are
Euclidean in double precision; ties are broken by id. Rows whose vector is null
or has a null or NaN in it have no neighbours and are nobody's neighbour.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstone.operators.split import key_hash
from turnstone.session import materialize, scratch_path

BLOCK = 512
PART_ROWS = 1 << 16
#: sampled rows per part from which the splits are learned
SAMPLE = 64
#: cells of one matrix of distances
CELLS = 1 << 21


def as_double_array(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("array<double>")


def _widest(x: np.ndarray) -> int:
    return int((x.max(axis=0) - x.min(axis=0)).argmax())


def _splits(sample: np.ndarray, parts: int) -> list[tuple]:
    """Nodes (dimension, cut, left, right) of a tree with ``parts`` leaves; a leaf is (-1, 0.0, part, part)."""
    nodes: list = []
    leaves = 0

    def grow(x, n):
        nonlocal leaves
        at = len(nodes)
        nodes.append(None)
        dim = _widest(x) if len(x) > 1 else -1
        cut = np.quantile(x[:, dim], (n // 2) / n, method="lower") if n > 1 and dim >= 0 else 0.0
        low = x[:, dim] <= cut if n > 1 and dim >= 0 else None
        if low is None or low.all():
            nodes[at] = (-1, 0.0, leaves, leaves)
            leaves += 1
        else:
            nodes[at] = (dim, float(cut), grow(x[low], n // 2), grow(x[~low], n - n // 2))
        return at

    grow(sample, parts)
    return nodes


def _part(x: np.ndarray, nodes: list[tuple]) -> np.ndarray:
    dim, cut, left, right = (np.array(c) for c in zip(*nodes))
    at = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    while (dim[at] >= 0).any():
        inner = dim[at] >= 0
        low = x[rows, np.maximum(dim[at], 0)] <= cut[at]
        at = np.where(inner, np.where(low, left[at], right[at]), at)
    return left[at]


def _halved(x: np.ndarray, rows: np.ndarray, most: int) -> list[np.ndarray]:
    """Row numbers in groups of at most ``most``, cut at the median of the widest dimension."""
    if len(rows) <= most:
        return [rows]
    v = x[rows, _widest(x[rows])]
    order = np.argpartition(v, len(rows) // 2)
    return _halved(x, rows[order[:len(rows) // 2]], most) + _halved(x, rows[order[len(rows) // 2:]], most)


def _gap2(lo: np.ndarray, hi: np.ndarray, x_lo: np.ndarray, x_hi: np.ndarray) -> np.ndarray:
    """Squared distance between boxes (a point is a box of its own)."""
    d = np.maximum(0.0, np.maximum(lo - x_hi, x_lo - hi))
    return np.einsum("...i,...i->...", d, d)


def _slack2(r: np.ndarray) -> np.ndarray:
    """Square of a bound, rounded up far enough that no equal distance falls outside."""
    return r * r * (1 + 1e-9) + 1e-300


class _Queries:
    """A block of query rows with the nearest rows found so far."""

    def __init__(self, ids, x, k: int, exclude_self: bool, dist=None, nid=None):
        self.ids, self.x, self.k, self.exclude_self = ids, x, k, exclude_self
        self.lo, self.hi = x.min(axis=0), x.max(axis=0)
        self.dist = np.full((len(x), k), np.inf) if dist is None else dist
        self.nid = np.repeat(ids[:, None], k, axis=1) if nid is None else nid

    def reach(self) -> float:
        return float(self.dist[:, -1].max())

    def near(self, lo, hi) -> bool:
        return bool(_gap2(lo, hi, self.lo, self.hi) <= _slack2(self.reach()))

    def probe(self, ids, y, lo, hi) -> None:
        """Take the rows ``y`` of a data block with the box ``lo``, ``hi`` into account."""
        if not self.near(lo, hi):
            return
        rows = np.flatnonzero(_gap2(lo, hi, self.x, self.x) <= _slack2(self.dist[:, -1]))
        center = (self.lo + self.hi) / 2
        y0 = y - center
        yy = np.einsum("ij,ij->i", y0, y0)
        scale = max(np.abs(self.x).max(), np.abs(y).max())
        step = max(1, CELLS // len(y))
        for i in range(0, len(rows), step):
            self._probe(rows[i:i + step], ids, y, center, y0, yy, scale)

    def _probe(self, rows, ids, y, center, y0, yy, scale) -> None:
        x0 = self.x[rows] - center
        xx = np.einsum("ij,ij->i", x0, x0)
        bound = self.dist[rows, -1]
        top = yy.max()
        # rounding of the product, and of the centred coordinates
        wide, fine = xx + top, 1e-15 * scale * (np.sqrt(xx) + np.sqrt(top))
        kind, unit = np.float64, 1e-15
        if np.isfinite(bound).all() and (x0.shape[1] * 1.2e-7 * wide <= 0.01 * bound * bound).all() and wide.max() < 1e30:
            kind, unit = np.float32, 1.2e-7
        err = (x0.shape[1] + 16) * (unit * wide + fine)
        d = x0.astype(kind) @ y0.astype(kind).T
        d *= -2
        d += xx.astype(kind)[:, None]
        d += yy.astype(kind)
        limit = _slack2(bound) + err
        open_ = np.flatnonzero(np.isinf(bound))
        if len(open_):
            limit[open_] = np.inf if len(y) <= self.k + 1 else (
                np.partition(d[open_], self.k, axis=1)[:, self.k] + 2 * err[open_])
        before = self.dist[rows[open_]], self.nid[rows[open_]]
        r, c = np.nonzero(d <= np.nextafter(limit.astype(kind), kind(np.inf))[:, None])
        self._merge(rows[r], ids[c], y[c])
        if len(y) > self.k + 1:  # equal ids left a row short of neighbours: all rows of the block
            for i in np.flatnonzero(np.isinf(self.dist[rows[open_], -1])):
                q = rows[open_[i]]
                self.dist[q], self.nid[q] = before[0][i], before[1][i]
                self._merge(np.full(len(y), q), ids, y)

    def _merge(self, q, nid, y) -> None:
        if self.exclude_self:
            other = np.asarray(self.ids[q] != nid, bool)
            q, nid, y = q[other], nid[other], y[other]
        if not len(q):
            return
        total = np.zeros(len(q))
        x = self.x[q]
        for j in range(x.shape[1]):  # the sum's order is part of the result
            diff = x[:, j] - y[:, j]
            total += diff * diff
        held = np.unique(q)
        old = np.isfinite(self.dist[held])
        q = np.concatenate([np.repeat(held, old.sum(axis=1)), q])
        nid = np.concatenate([self.nid[held][old], nid])
        dist = np.concatenate([self.dist[held][old], np.sqrt(total)])
        order = np.lexsort((nid, dist, q))
        q, nid, dist = q[order], nid[order], dist[order]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        keep = place < self.k
        q, nid, dist, place = q[keep], nid[keep], dist[keep], place[keep]
        self.dist[held] = np.inf
        self.dist[q, place] = dist
        self.nid[q, place] = nid


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


def _stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder: its last stage is too dear to run twice."""
    path = scratch_path(df.sparkSession, f"knn-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def knn_join(queries: DataFrame, data: DataFrame | None = None, k: int = 5, id_col: str = "id",
             vec: str = "vec", exclude_self: bool | None = None, cell_target: int = BLOCK,
             seed: int = 42, block_rows: int = PART_ROWS, collapse_copies: bool = True) -> DataFrame:
    """For every query row its ``k`` nearest rows of ``data`` (default: the
    same frame). Output: (id, rank, neighbor_id, distance), rank 1-based.
    By default a row is left out of its own neighbours in a self-join only.

    ``cell_target``: most rows of a block; ``block_rows``: about the rows of a part.

    For a self-join, exact copies are collapsed first (``collapse_copies``):
    the search runs on distinct vectors, so a group of identical vectors —
    even a third of all rows — is one point, not a quadratic block of pairs.
    """
    if exclude_self is None:  # equal ids of two different frames are different rows
        exclude_self = data is None
    if data is None and collapse_copies:
        return _knn_self_collapsed(queries, k, id_col, vec, cell_target, seed, block_rows)
    nn = _knn_core(queries, data, k, id_col, vec, exclude_self, cell_target, seed, block_rows)
    w = Window.partitionBy("id").orderBy("distance", "neighbor_id")  # rows that share an id share their answer
    return nn.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "id", F.col("rank").cast("int").alias("rank"), "neighbor_id", "distance")


def _knn_self_collapsed(df: DataFrame, k: int, id_col: str, vec: str, cell_target: int, seed: int,
                        block_rows: int) -> DataFrame:
    """Self kNN over distinct vectors, expanded back to rows.

    Per distinct vector only its ``k + 1`` smallest ids matter (its own
    copies are each other's nearest rows at distance 0, ordered by id). They
    are found per input partition first (each (partition, vector) group is
    bounded by the partition) and then merged, so no copy group is gathered
    whole. A vector stands in the search under its smallest id, so one that is
    not among the ``k`` nearest vectors has ``k`` rows before any of its own.
    Each neighbour vector contributes its smallest ids, and every row takes the
    first ``k`` of its vector's merged list without itself.
    """
    d = materialize(df.select(F.col(id_col).alias("id"), as_double_array(vec).alias("vec"))
                      .withColumn("_vk", F.xxhash64("vec")))
    w_part = Window.partitionBy(F.spark_partition_id(), "_vk", "vec").orderBy("id")
    few = d.withColumn("_r", F.row_number().over(w_part)).where(F.col("_r") <= k + 1)
    groups = materialize(few.groupBy("_vk", "vec").agg(
        F.slice(F.sort_array(F.collect_list("id")), 1, k + 1).alias("_ids"))
        .withColumn("_rep", F.get("_ids", F.lit(0))))
    nn = _knn_core(groups.select(F.col("_rep").alias("id"), "vec"), None, k, "id", "vec", True,
                   cell_target, seed, block_rows)
    expanded = (nn.join(groups.select(F.col("_rep").alias("neighbor_id"), F.col("_ids").alias("_nids")), "neighbor_id")
                  .select("id", "distance", F.explode("_nids").alias("nid")))
    own = groups.select(F.col("_rep").alias("id"), F.lit(0.0).alias("distance"), F.explode("_ids").alias("nid"))
    cand = own.unionByName(expanded)
    lists = cand.groupBy("id").agg(F.slice(F.array_sort(F.collect_list(F.struct("distance", "nid"))), 1, k + 1)
                                   .alias("_L")).withColumnRenamed("id", "_rep")
    rows = d.join(groups.select("_vk", "vec", "_rep"), ["_vk", "vec"]).join(lists, "_rep")
    mine = F.slice(F.filter("_L", lambda x: x["nid"] != F.col("id")), 1, k)
    return rows.select("id", F.posexplode(mine).alias("pos", "x")).select(
        "id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.nid").alias("neighbor_id"),
        F.col("x.distance").alias("distance"))


def _knn_core(queries: DataFrame, data: DataFrame | None, k: int, id_col: str, vec: str, exclude_self: bool,
              block: int, seed: int, part_rows: int) -> DataFrame:
    """(id, neighbor_id, distance): the ``k`` nearest rows of each query row."""
    def usable(df, role):  # role bits: 1 data row, 2 query row
        v = as_double_array(vec)
        whole = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x))
        return df.select(F.col(id_col).alias("id"), v.alias("vec"), F.lit(role).alias("role")).where(
            F.col("id").isNotNull() & whole)

    spark = queries.sparkSession
    pool = usable(queries, 3) if data is None else usable(queries, 2).unionByName(usable(data, 1))
    pool = materialize(pool)
    n, cores = pool.count(), spark.sparkContext.defaultParallelism
    parts = max(1, min(math.ceil(n / block), max(2 * cores, math.ceil(n / part_rows))))
    sample = [r["vec"] for r in pool.select("vec", key_hash("id", seed, 1 << 60).alias("_h"), "id")
              .orderBy("_h", "id").limit(SAMPLE * parts).collect()] if n else [[0.0]]
    nodes = _splits(np.array(sample, np.float64), parts)
    kind = pool.schema["id"].dataType.simpleString()

    def assign(batches):
        for b in batches:
            part = _part(_matrix(b.column("vec")), nodes).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part), *b.columns], ["part", *b.schema.names])

    schema = (f"part int, block int, query boolean, reach double, lo array<double>, hi array<double>, ids array<{kind}>, "
              f"vec binary, dist binary, nid array<{kind}>")
    names = [c.split()[0] for c in schema.split(", ")]

    def record(part, at, x, ids, id_type, found=None):
        lists = pa.list_(id_type)
        return pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([at], pa.int32()), pa.array([found is not None]),
            pa.array([None if found is None else found.reach()], pa.float64()),
            pa.array([x.min(axis=0)], pa.list_(pa.float64())), pa.array([x.max(axis=0)], pa.list_(pa.float64())),
            pa.array([ids.tolist()], lists), pa.array([x.tobytes()], pa.binary()),
            pa.array([None if found is None else found.dist.tobytes()], pa.binary()),
            pa.array([None if found is None else found.nid.ravel().tolist()], lists)], names)

    def local(batches):
        held: dict = {}
        id_type = None
        for b in batches:
            part, id_type = b.column("part").to_numpy(), b.column("id").type
            ids, role = b.column("id").to_numpy(zero_copy_only=False), b.column("role").to_numpy()
            x = _matrix(b.column("vec"))
            for p in np.unique(part).tolist():
                at = part == p
                held.setdefault(p, []).append((ids[at], x[at], role[at]))
        for p in sorted(held):
            ids, x, role = (np.concatenate(c) for c in zip(*held.pop(p)))
            rows = np.flatnonzero(role & 1)
            blocks = [(ids[r], x[r], x[r].min(axis=0), x[r].max(axis=0)) for r in _halved(x, rows, block)] if len(rows) else []
            for i, (bi, bx, _, _) in enumerate(blocks):
                yield record(p, i, bx, bi, id_type)
            rows = np.flatnonzero(role & 2)
            for i, r in enumerate(_halved(x, rows, block) if len(rows) else []):
                q = _Queries(ids[r], x[r], k, exclude_self)
                near = [_gap2(lo, hi, q.lo, q.hi) + 1e-9 * _gap2(lo, lo, (q.lo + q.hi) / 2, (q.lo + q.hi) / 2)
                        for _, _, lo, hi in blocks]
                for j in np.argsort(near):
                    bi, bx, lo, hi = blocks[j]
                    q.probe(bi, bx, lo, hi)
                yield record(p, i, q.x, q.ids, id_type, q)

    dealt = pool.mapInArrow(assign, f"part int, id {kind}, vec array<double>, role int")
    staged = _stage(dealt.repartitionById(parts, "part").mapInArrow(local, schema), "blocks")

    # which blocks of other parts each part needs; one box per block is collected
    boxes = staged.where("NOT query").select("part", "block", "lo", "hi").collect()
    of = np.array([r["part"] for r in boxes], np.int32)
    no = np.array([r["block"] for r in boxes], np.int32)
    lo, hi = (np.array([r[c] for r in boxes], np.float64) for c in ("lo", "hi"))

    def wanted(batches):
        for b in batches:
            for part, reach, qlo, qhi in zip(*(b.column(c).to_pylist() for c in ("part", "reach", "lo", "hi"))):
                gap = _gap2(lo, hi, np.array(qlo), np.array(qhi)) if len(of) else np.zeros(0)
                hit = np.flatnonzero((gap <= _slack2(np.float64(reach))) & (of != part))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), part, np.int32)), pa.array(of[hit]),
                                                  pa.array(no[hit]), pa.array(gap[hit])], ["to", "part", "block", "gap"])

    needs = staged.where("query").select("part", "reach", "lo", "hi").mapInArrow(
        wanted, "to int, part int, block int, gap double").groupBy("to", "part", "block").agg(F.min("gap").alias("gap"))
    sent = (staged.where("NOT query").join(needs, ["part", "block"])
            .select("to", F.lit(False).alias("query"), "gap", "lo", "hi", "ids", "vec", "dist", "nid"))
    own = staged.where("query").select(F.col("part").alias("to"), "query", F.lit(0.0).alias("gap"), "lo", "hi", "ids", "vec",
                                       "dist", "nid")

    def finish(batches):
        part, mine, id_type = None, [], None

        def answers():
            for q in mine:
                known = np.isfinite(q.dist)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(q.ids, known.sum(axis=1)).tolist(), id_type), pa.array(q.nid[known].tolist(), id_type),
                    pa.array(q.dist[known])], ["id", "neighbor_id", "distance"])

        for b in batches:
            id_type = b.schema.field("ids").type.value_type
            for i in range(b.num_rows):
                to, query = b.column("to")[i].as_py(), b.column("query")[i].as_py()
                if to != part:
                    yield from answers()
                    part, mine = to, []
                ids = b.column("ids")[i].values.to_numpy(zero_copy_only=False)
                x = np.frombuffer(b.column("vec")[i].as_buffer(), np.float64).reshape(len(ids), -1)
                if query:
                    dist = np.frombuffer(b.column("dist")[i].as_buffer(), np.float64).reshape(-1, k).copy()
                    nid = b.column("nid")[i].values.to_numpy(zero_copy_only=False).reshape(-1, k).copy()
                    mine.append(_Queries(ids, x, k, exclude_self, dist, nid))
                    continue
                box = (np.array(b.column(c)[i].as_py()) for c in ("lo", "hi"))
                lo_, hi_ = box
                for q in mine:
                    q.probe(ids, x, lo_, hi_)
        yield from answers()

    # a part's query blocks come before the blocks it is sent, the nearest of these first
    work = own.unionByName(sent).repartitionById(parts, "to").sortWithinPartitions("to", F.desc("query"), "gap")
    return _stage(work.mapInArrow(finish, f"id {kind}, neighbor_id {kind}, distance double"), "found")
